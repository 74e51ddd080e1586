"""Order statistics by radix selection: the value at given ranks of a column, without sorting it.

Values are 64-bit whole numbers whose order is that of the data (for doubles their order-preserving image). A round counts
rows by the next ``DIGIT`` bits among the rows that share the bits settled so far, and settles the bits of every wanted
rank: at most five aggregates whatever the values are, ties and extremes included, and fewer where a count leaves a
single value. A round is one grouped count with map-side combining; at most 2**13 counts per range meet in one task.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 13
_SHIFTS = [max(0, 64 - DIGIT * i) for i in range(1, math.ceil(64 / DIGIT) + 1)]


def image(x: Column) -> Column:
    """The bits of a double as a long in the order of the doubles: ±(exponent and fraction). -0.0 and 0.0 are one value;
    infinities are the ends; NaN and NULL give NULL."""
    def bits(column: pa.Array) -> pa.Array:
        v = np.asarray(column.to_numpy(zero_copy_only=False), np.float64) + 0.0  # NULL becomes NaN, -0.0 becomes 0.0
        raw = v.view(np.int64)
        return pa.array(np.where(raw < 0, -(raw & np.int64(2**63 - 1)), raw), pa.int64(), mask=np.isnan(v))

    bits.__annotations__ = {"column": pa.Array, "return": pa.Array}
    # so marked, the plan neither copies it into the filters above nor computes it again for them
    return F.arrow_udf(bits, "long").asNondeterministic()(x.cast("double"))


def double_of(bits: int) -> float:
    """The double with this image."""
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


def ranked(long: DataFrame, ranks: Callable[[int], Sequence[int]]) -> dict[str, tuple[int, dict[int, int]]]:
    """``{feature: (rows, {rank: image})}`` of a frame (feature, image); NULL images are ignored. ``ranks`` gives the
    wanted ranks, from 0, of a feature with so many rows."""
    data = long.where(F.col("image").isNotNull())
    spark = long.sparkSession

    def counted(rows: DataFrame, key: str, digit: Column) -> DataFrame:
        return rows.groupBy(key, digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.min("image").alias("lo"), F.max("image").alias("hi"))

    found: dict[str, tuple[int, dict[int, int]]] = {}
    ranges: list[tuple[str, int, dict[int, int]]] = []  # feature, settled bits, {rank: rank among the rows that share them}

    def settle(feature: str, prefix: int, lo: int, hi: int, wants: dict[int, int]) -> None:
        if lo == hi:
            found[feature][1].update(dict.fromkeys(wants, lo))
        else:
            ranges.append((feature, prefix, wants))

    first: dict[str, list] = {}
    for r in counted(data, "feature", F.shiftright("image", _SHIFTS[0])).collect():  # 2**13 counts of a feature at most
        first.setdefault(r["feature"], []).append((r["digit"], r["n"], r["lo"], r["hi"]))
    for feature, cells in first.items():
        n = sum(c[1] for c in cells)
        found[feature] = (n, {})
        wanted, before = sorted(set(ranks(n))), 0
        for digit, m, lo, hi in sorted(cells):
            inside = {w: w - before for w in wanted if before <= w < before + m}
            before += m
            if inside:
                settle(feature, digit, lo, hi, inside)
    for above, shift in zip(_SHIFTS[:-1], _SHIFTS[1:], strict=True):
        if not ranges:
            break
        known = ranges[:]
        ranges.clear()
        table = spark.createDataFrame([(i, f, p, sorted(set(w.values()))) for i, (f, p, w) in enumerate(known)], "rid int, of string, prefix long, wants array<long>")
        inside = data.join(F.broadcast(table.drop("wants")), (F.col("feature") == F.col("of")) & (F.shiftright("image", above) == F.col("prefix")))  # a row per wanted rank
        cells = counted(inside, "rid", F.shiftright("image", shift))
        w = Window.partitionBy("rid").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cells = cells.withColumn("upto", F.sum("n").over(w)).join(F.broadcast(table.select("rid", "wants")), "rid")
        hit = F.filter("wants", lambda x: (F.col("upto") - F.col("n") <= x) & (x < F.col("upto")))
        for r in cells.withColumn("hit", hit).where(F.size("hit") > 0).collect():
            feature, _, wants = known[r["rid"]]
            before = r["upto"] - r["n"]
            settle(feature, r["digit"], r["lo"], r["hi"], {g: x - before for g, x in wants.items() if x in r["hit"]})
    return found
