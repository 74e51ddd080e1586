"""Data profile operators: value counts, shares, numeric summary with exact quantiles, schema profile, bounds.

Every operator reads the table once in long form and aggregates with map-side combine; nothing is collected except
small fitted results (per-column totals, bucket counts of the quantile search).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascara.functions.columns import quoted
from cascara.operators.radix import double_of, image, ranked
from cascara.operators.reshape import to_long
from cascara.session import written

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def value_counts(df: DataFrame, columns: Sequence[str] | None = None, dropna: bool = True) -> DataFrame:
    """``(column, value, n)`` for every column, values as strings; one unpivot + one grouped count.

    Order by ``column, n desc, value`` for display; that global sort is range-partitioned, so one busy column is
    split over many tasks.
    """
    cols = list(columns or df.columns)
    long = to_long(df, cols, "string", "column", "value")
    if dropna:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_counts_ranked(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, n, rank)``: value counts in the order of display, most frequent first and ties by value, as a
    rank from 1 within each column. Equal counts share few distinct numbers: the rank is the number of values with a
    larger count (a table of counts, not of values) plus the place among equal counts."""
    counts = value_counts(df, columns)
    levels = counts.groupBy("column", "n").agg(F.count(F.lit(1)).alias("m"))
    ahead = Window.partitionBy("column").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select("column", "n", F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("column", "n").orderBy("value"))
    return counts.withColumn("place", place).join(levels, ["column", "n"]).select(
        "column", "value", "n", (F.col("ahead") + F.col("place")).cast("long").alias("rank"))


def value_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, n, share)``: relative frequency, NULLs excluded from counts and denominator.

    The denominator comes from a per-column total (one row per column, broadcast back) instead of a window over
    all distinct values of a column, which would put a near-unique column into one task.
    """
    counts = value_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def minmax_bounds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(feature, min, max)`` of numeric columns, one aggregate."""
    cols = list(columns or numeric_columns(df))
    long = to_long(df, cols, "double")
    return long.groupBy("feature").agg(F.min("value").alias("min"), F.max("value").alias("max"))


# ---------------------------------------------------------------------------------------------------------------
# exact quantiles without collecting a column into one task


def exact_quantiles(long: DataFrame, probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """Exact quantiles with linear interpolation (``quantile_cont`` / Spark ``percentile``) per feature.

    ``long`` has columns ``feature`` and ``value`` (double); NULL and NaN are ignored, infinities are values. The values
    at the ranks around each quantile are found by radix selection: at most five aggregates over the rows for any data.
    """
    found = ranked(long.select("feature", image(F.col("value")).alias("image")),
                   lambda n: [r for p in probs for r in _around(n, p)])
    out = {}
    for feature, (n, at) in found.items():
        for p in probs:
            low, high = _around(n, p)
            v0, v1 = double_of(at[low]), double_of(at[high])
            part = (n - 1) * p - low
            if v0 == v1 or part == 0:
                out[(feature, p)] = v0
            elif math.isinf(v1 - v0) and not math.isinf(v0) and not math.isinf(v1):  # too far apart for a difference
                out[(feature, p)] = (1 - part) * v0 + part * v1
            else:
                out[(feature, p)] = v0 + part * (v1 - v0)
    return out


def _around(n: int, p: float) -> tuple[int, int]:
    """The ranks around a quantile of n rows."""
    low = int(math.floor((n - 1) * p))
    return low, min(low + 1, n - 1)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     probs: Sequence[float] = (0.25, 0.5, 0.75), approx_accuracy: int | None = None) -> DataFrame:
    """pandas-style ``describe``: ``(feature, count, mean, std, min, p25, p50, p75, max)`` per numeric column.

    Moments come from one aggregate over the long form; the quantiles are exact (see ``exact_quantiles``). Nothing is
    cached: pass a written table if its plan is expensive. The result is one small row per column; a column without
    any value has count 0 and NULLs. ``approx_accuracy`` switches the quartiles to ``percentile_approx`` (one pass,
    data values instead of interpolated ones, rank error ≤ n / accuracy).
    """
    cols = list(columns or numeric_columns(df))
    long = to_long(df, cols, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = {r["feature"]: r for r in long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")).collect()}
    if approx_accuracy:
        q = {(r["feature"], p): v for r in long.groupBy("feature").agg(
            F.percentile_approx("value", list(probs), approx_accuracy).alias("q")).collect()
             for p, v in zip(probs, r["q"])}
    else:
        q = exact_quantiles(long, probs)
    names = [f"p{int(round(p * 100))}" for p in probs]
    none = (0, *[None] * (len(probs) + 4))
    rows = [(f, *((m["count"], m["mean"], m["std"], m["min"], *[float(q[(f, p)]) for p in probs], m["max"])
                  if (m := moments.get(f)) else none)) for f in cols]
    schema = ("feature string, count long, mean double, std double, min double, "
              + ", ".join(f"{n} double" for n in names) + ", max double")
    return df.sparkSession.createDataFrame(rows, schema)


def schema_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """``(position, column, type, n_rows, n_null, n_distinct)`` for every column.

    Each column is grouped by itself, so that its repeated values combine before the shuffle and no row is copied once per
    column; the rows are written once, and each group-by reads its own column of them. ``approx=True`` uses HyperLogLog
    distinct counts in one aggregate over the input (no shuffle of values), for very large tables.
    """
    fields = df.schema.fields
    if approx:
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, f in enumerate(fields):
            c = quoted(f.name)
            aggs += [F.count_if(c.isNull()).alias(f"__null{i}"), F.approx_count_distinct(c).alias(f"__nd{i}")]
        each = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                         F.col("__n").alias("n_rows"), F.col(f"__null{i}").alias("n_null"), F.col(f"__nd{i}").alias("n_distinct"))
                for i, f in enumerate(fields)]
        return df.agg(*aggs).select(F.inline(F.array(*each)))
    rows = written(df.toDF(*[f"c{i}" for i in range(len(fields))]), "profile")
    return reduce(DataFrame.unionByName, [
        rows.groupBy(F.col(f"c{i}").alias("v")).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
            F.count("v").alias("n_distinct")).select(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), "n_rows", "n_null", "n_distinct")
        for i, f in enumerate(fields)])


