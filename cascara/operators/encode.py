"""Feature encoding: column selection, frequency string index, one-hot (drop-last and full), label codes, min-max
scaling and the assembled feature matrix.

Index and label codes of any number of categories are fitted tables, joined back by value (adaptive execution broadcasts
them while they are small). Min/max and the categories of the full one-hot form, which make one column each, become
literal expressions of a single projection; a column with more than ``MAX_CATEGORIES`` categories is an error there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascara.functions.columns import quoted, without_nan
from cascara.operators.profile import NUMERIC_TYPES, value_counts
from cascara.session import written

MAX_CATEGORIES = 10_000


# ---------------------------------------------------------------------------------------------------------------
# column selection


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names not present are ignored."""
    return df.drop(*names)


def columns_of_type(df: DataFrame, kinds: Sequence[type]) -> list[str]:
    """Names of the columns whose type is one of ``kinds`` (e.g. ``[T.StringType]``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds))]


def all_except(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every column except ``names``, in input order."""
    skip = set(names)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in skip])


# ---------------------------------------------------------------------------------------------------------------
# frequency string index (most frequent → 0, ties alphabetical), NULLs ignored when fitting


def distributed_rank(df: DataFrame, group: str, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Adds the exact rank from 0 within each group. No group meets in one task: rows are range-partitioned in the wanted
    order and written once, and a row's rank is the number of its group's rows in earlier partitions (a table of
    groups × partitions) plus its place in its own partition."""
    parts = written(df.repartitionByRange(F.col(group), *order).withColumn("__part", F.spark_partition_id()), "rank")
    sizes = parts.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, "__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    place = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))
    return parts.withColumn("__place", place).join(sizes, [group, "__part"]).withColumn(
        out, F.col("__ahead") + F.col("__place") - 1).drop("__part", "__place", "__ahead")


def string_index_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n, index)``: one grouped count over the long form, then an exact distributed rank per column."""
    ranked = distributed_rank(value_counts(df, columns), "column", [F.col("n").desc(), F.col("value")])
    return ranked.select("column", "value", "n", F.col("rank").cast("double").alias("index"))


def _bounded_collect(distinct_long: DataFrame, n_columns: int, fields: Sequence[str]) -> list:
    """Collect the distinct (column, value, ...) rows — at most ``MAX_CATEGORIES`` per column. The fetch itself is
    bounded (``limit``), and exceeding the bound raises instead of cutting anything."""
    cap = MAX_CATEGORIES * max(1, n_columns)
    rows = distinct_long.select(*fields).limit(cap + 1).collect()
    per: dict = {}
    for r in rows:
        per[r["column"]] = per.get(r["column"], 0) + 1
    wide = {c: k for c, k in per.items() if k > MAX_CATEGORIES}
    if wide or len(rows) > cap:
        raise ValueError(f"not categorical (> {MAX_CATEGORIES} values): "
                         + (", ".join(f"{c} ({k}+)" for c, k in wide.items()) or "too many values"))
    return rows


@dataclass(frozen=True)
class StringIndexModel:
    """Fitted labels ``(column, value, index)``, most frequent first, and how many each column has."""

    labels: DataFrame
    sizes: Mapping[str, int]

    def transform(self, df: DataFrame, suffix: str = "Indexed", handle_invalid: str = "error") -> DataFrame:
        """Add ``{column}{suffix}`` (double) by a join with the fitted labels, whatever their number. NULL or unseen
        values: ``error`` raises, ``keep`` gives the number of labels, ``skip`` drops the row."""
        if handle_invalid not in ("error", "keep", "skip"):
            raise ValueError(handle_invalid)
        for c, size in self.sizes.items():
            own = self.labels.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("index").alias("__index"))
            df = df.join(own, quoted(c).cast("string") == F.col("__value"), "inner" if handle_invalid == "skip" else "left")
            idx = F.col("__index")
            if handle_invalid == "keep":
                idx = F.coalesce(idx, F.lit(float(size)))
            elif handle_invalid == "error":
                idx = F.when(idx.isNull(), F.raise_error(F.concat(
                    F.lit(f"unseen or NULL label in {c}: "), F.coalesce(quoted(c).cast("string"), F.lit("NULL"))
                ))).otherwise(idx).cast("double")
            df = df.withColumn(f"{c}{suffix}", idx).drop("__value", "__index")
        return df


def string_indexer(df: DataFrame, columns: Sequence[str]) -> StringIndexModel:
    """Fit a frequency string index; the labels stay a table, only their number per column is collected."""
    fitted = written(string_index_fit(df, columns).select("column", "value", "index"), "labels")
    sizes = {r["column"]: r["n"] for r in fitted.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return StringIndexModel(fitted, {c: sizes.get(c, 0) for c in columns})


def one_hot_sparse(df: DataFrame, index_cols: Mapping[str, int], suffix: str = "Vector") -> DataFrame:
    """One-hot of index columns as one sparse vector each, ``struct(size, indices, values)``, with the last category
    dropped: size - 1 slots, and the last index has no entry. Any number of categories takes one column."""
    out = {}
    for c, size in index_cols.items():
        base = c[: -len("Indexed")] if c.endswith("Indexed") else c
        i = quoted(c).cast("int")
        hit = i < F.lit(size - 1)
        out[f"{base}{suffix}"] = F.struct(
            F.lit(size - 1).alias("size"), F.when(hit, F.array(i)).otherwise(F.array().cast("array<int>")).alias("indices"),
            F.when(hit, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
    return df.withColumns(out)


def one_hot_drop_last(df: DataFrame, index_cols: Mapping[str, int], suffix: str = "Vector",
                      as_array: bool = False) -> DataFrame:
    """One-hot of index columns with the last category dropped: ``size - 1`` slots, the last index (and any index
    ≥ size - 1) is all zeros. Unfolded into ``{col}{suffix}_{i}`` doubles, or one ``array<double>`` column."""
    out = {}
    for c, size in index_cols.items():
        base = c[: -len("Indexed")] if c.endswith("Indexed") else c
        slots = [(F.col(f"`{c}`") == F.lit(float(i))).cast("double") for i in range(size - 1)]
        if as_array:
            out[f"{base}{suffix}"] = F.array(*slots) if slots else F.array().cast("array<double>")
        else:
            for i, s in enumerate(slots):
                out[f"{base}{suffix}_{i}"] = s
    return df.withColumns(out)


# ---------------------------------------------------------------------------------------------------------------
# one-hot of all categories, sorted (NULL is a category of its own, named "None", sorted last); unseen → zeros


@dataclass(frozen=True)
class OneHotModel:
    categories: Mapping[str, Sequence[str | None]]

    def names(self) -> list[str]:
        return [f"{c}_{'None' if v is None else v}" for c, vals in self.categories.items() for v in vals]

    def expressions(self) -> dict[str, Column]:
        out = {}
        for c, vals in self.categories.items():
            col = F.col(f"`{c}`").cast("string")
            for v in vals:
                hit = col.isNull() if v is None else F.coalesce(col == F.lit(v), F.lit(False))
                out[f"{c}_{'None' if v is None else v}"] = hit.cast("double")
        return out

    def transform(self, df: DataFrame, drop_input: bool = True) -> DataFrame:
        res = df.withColumns(self.expressions())
        return res.drop(*self.categories.keys()) if drop_input else res


def one_hot_fit(df: DataFrame, columns: Sequence[str]) -> OneHotModel:
    """Distinct values per column (one aggregate over the long form, NULL kept as a category)."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], list(columns),
                                                                                          "column", "value")
    distinct = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = _bounded_collect(distinct, len(columns), ["column", "value"])
    cats: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        cats[r["column"]].append(r["value"])
    out = {}
    for c in columns:
        vals = cats[c]
        out[c] = sorted(v for v in vals if v is not None) + ([None] if None in vals else [])
    return OneHotModel(out)


# ---------------------------------------------------------------------------------------------------------------
# label codes and min-max scaling


def label_encoder(df: DataFrame, column: str) -> DataFrame:
    """``(value, code)``: the distinct classes of a label column (NULL excluded) with their place in sorted order."""
    distinct = df.where(quoted(column).isNotNull()).select(F.lit(0).alias("__all"), quoted(column).alias("value")).distinct()
    return distributed_rank(distinct, "__all", [F.col("value")], "code").select("value", F.col("code").cast("int").alias("code"))


def label_encode(df: DataFrame, column: str, classes: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """Class → position in the sorted classes (int), by a join with the fitted table; NULL or an unseen class → NULL."""
    classes = label_encoder(df, column) if classes is None else classes
    own = classes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    return df.join(own, quoted(column) == F.col("__value"), "left").withColumn(out or f"{column}_code", F.col("__code")).drop("__value", "__code")


@dataclass(frozen=True)
class MinMaxModel:
    bounds: Mapping[str, tuple[float | None, float | None]]

    def scale(self, name: str, x: Column) -> Column:
        """(x − min) / (max − min) with the bounds fitted for ``name``; a constant column maps to 0."""
        lo, hi = self.bounds[name]
        if lo is None or hi is None or hi == lo:
            return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        return (x - F.lit(float(lo))) / F.lit(float(hi) - float(lo))

    def expressions(self) -> dict[str, Column]:
        return {c: self.scale(c, F.col(f"`{c}`").cast("double")) for c in self.bounds}

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions())


def minmax_fit(df: DataFrame, columns: Sequence[str]) -> MinMaxModel:
    """Min and max of every column in ONE aggregate (one row collected); NULL and NaN are ignored."""
    aggs = []
    for i, c in enumerate(columns):
        x = without_nan(df, c).cast("double")
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    r = df.agg(*aggs).collect()[0]
    return MinMaxModel({c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(columns)})


def model_columns(df: DataFrame, id_cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """(string columns, numeric-or-boolean columns) of ``df`` other than ``id_cols``."""
    skip = set(id_cols)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    nums = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (*NUMERIC_TYPES, T.BooleanType)) and f.name not in skip]
    return strings, nums


@dataclass(frozen=True)
class FeatureModel:
    """Fitted feature pipeline: numeric/boolean columns as doubles, one-hot of string columns, then min-max."""

    numeric: Sequence[str]
    onehot: OneHotModel
    scaler: MinMaxModel

    def feature_names(self) -> list[str]:
        return list(self.numeric) + self.onehot.names()

    def transform(self, df: DataFrame, keep: Sequence[str] = (), as_vector: str | None = None) -> DataFrame:
        """``keep`` columns plus the scaled features; ``as_vector`` packs them into one ``array<double>`` column."""
        raw = {c: F.col(f"`{c}`").cast("double") for c in self.numeric}
        raw.update(self.onehot.expressions())
        feats = [self.scaler.scale(name, raw[name]).alias(name) for name in self.feature_names()]
        if as_vector:
            return df.select(*keep, F.array(*feats).alias(as_vector))
        return df.select(*keep, *feats)


def feature_fit(df: DataFrame, id_cols: Sequence[str]) -> FeatureModel:
    """Fit the feature pipeline on ``df``: one aggregate for the categories, one for the numeric min/max (the
    bounds of the indicator columns follow from the category lists). Two jobs read the input, and the transform a
    third time: pass a written table if its plan is expensive."""
    strings, nums = model_columns(df, id_cols)
    oh = one_hot_fit(df, strings)
    numeric_bounds = minmax_fit(df, list(nums)).bounds
    # a fitted indicator column is 1 on some fitted row; it is 0 on some row unless its column has one category
    bounds = dict(numeric_bounds)
    for c, vals in oh.categories.items():
        for name in OneHotModel({c: vals}).names():
            bounds[name] = (1.0, 1.0) if len(vals) == 1 else (0.0, 1.0)
    return FeatureModel(list(nums), oh, MinMaxModel(bounds))
