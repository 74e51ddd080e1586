"""Resharding by minimum-cost flow.

Rows lie in old shards; new shards get equal capacities in bytes. A flow from old shard sizes to new capacities, where
a byte that stays costs nothing and a byte that moves costs one, says how many bytes go from each shard to each other
shard (the problem has old x new arcs, whatever the rows). The flow is then cut into rows, largest rows first: within
an old shard and a class of row sizes the rows are laid end to end, and each target takes a stretch of them. What a
class of large rows misses by is made up by the classes below it, so the shards end up equal to within the smallest
rows. The plan shuffles only a row's id, size, checksum and place in its file; positions come from block sums and a rank
within small blocks. Rows are laid in the order of a key, so a plan is a few hundred first keys, and the texts find
their shard by these: they are shuffled once, to where they are written. ``moved`` does all of it and reads its rows
from the files that it wrote.

Law: ``bytes`` (sizes as near to equal as whole rows allow).

Defined cases: a null text has 0 bytes (plus the fixed part) and the checksum of nothing; rows with equal ids or equal
texts are placed each for itself, a null id like any other; an empty table gives no rows; only ``doc_id`` and ``text``
are read, other columns may have any name.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from cascara.llm.common import stage
from cascara.session import scratch_path

OLD, NEW = 32, 40
FIXED = 16
#: Rows ranked together in one task, about.
RANKED = 50_000
#: Bounds between the classes of row sizes, in bytes.
CLASSES = (65_536, 16_384, 4_096, 1_024, 256)
#: The order of rows in a block; ``row`` tells rows apart that are equal in the rest.
KEY = ("doc_id", "text_crc32", "size", "row")


def min_cost_flow(supply: list[int], demand: list[int], cost: np.ndarray) -> np.ndarray:
    """Flow[i, j] of least cost that ships all supply within the demands (sum of supply <= sum of demand): successive
    shortest paths on the residual network of the bipartite arcs."""
    supply, demand = np.array(supply, np.int64), np.array(demand, np.int64)
    flow = np.zeros(cost.shape, np.int64)
    far = np.float64(np.inf)
    while supply.any():
        left = np.where(supply > 0, 0.0, far)
        came_left, right, came_right = np.full(len(supply), -1), np.full(len(demand), far), np.full(len(demand), -1)
        while True:
            via = left[:, None] + cost
            nearer = via.min(axis=0) < right - 1e-12  # only what improves changes its way: ties would close circles
            right, came_right = np.where(nearer, via.min(axis=0), right), np.where(nearer, via.argmin(axis=0), came_right)
            back = np.where(flow > 0, right[None, :] - cost, far)
            better, by = back.min(axis=1), back.argmin(axis=1)
            closer = better < left - 1e-12
            if not closer.any():
                break
            left = np.where(closer, better, left)
            came_left = np.where(closer, by, came_left)
        j = int(np.where(demand > 0, right, far).argmin())
        path, i = [], int(came_right[j])
        path.append((i, j, 1))
        while came_left[i] >= 0:
            k = int(came_left[i])
            path.append((i, k, -1))
            i = int(came_right[k])
            path.append((i, k, 1))
        amount = min(int(supply[i]), int(demand[j]), *(int(flow[a, b]) for a, b, sign in path if sign < 0))
        for a, b, sign in path:
            flow[a, b] += sign * amount
        supply[i] -= amount
        demand[j] -= amount
    return flow


def old_shard(shards: int = OLD) -> Column:
    """Where a row lay so far: by a checksum of its id."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(shards)).cast("int")


def transfers(sizes: dict[int, int], old: int, new: int) -> np.ndarray:
    """Bytes from each old shard to each new shard, fewest moved, with equal new shards."""
    supply = [int(sizes.get(i, 0)) for i in range(old)]
    total = sum(supply)
    demand = [total * (j + 1) // new - total * j // new for j in range(new)]
    cost = np.ones((old, new))
    cost[np.arange(min(old, new)), np.arange(min(old, new))] = 0
    return min_cost_flow(supply, demand, cost)


def _ranked(rows: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """Adds ``before`` (bytes) and ``place`` (rows) before each row inside its group, in the order of blocks."""
    key = [*within, "block"]
    sums = rows.groupBy(*key).agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    ahead = Window.partitionBy(*within).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*key, F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("bytes_ahead"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("rows_ahead"))
    inside = Window.partitionBy(*key).orderBy(*order)
    own = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    return rows.withColumn("own_bytes", own).withColumn("own_rows", F.row_number().over(inside) - 1).join(sums, key).withColumn("before", F.col("bytes_ahead") + F.col("own_bytes")).withColumn("place", F.col("rows_ahead") + F.col("own_rows")).drop("own_bytes", "own_rows", "bytes_ahead", "rows_ahead")


def place_in_file(docs: DataFrame) -> Column:
    """A key of every row of a table that reads the same each time: its file and its place there."""
    at = docs.metadataColumn("_metadata")
    return F.struct(at["file_path"].alias("file"), at["row_index"].alias("at"))


def _described(old: int, was: Column | None, row: Column | None) -> list[Column]:
    """Old shard, class of sizes and KEY of a document."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + FIXED
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    own = [F.col("doc_id").cast("long").alias("doc_id"), crc.alias("text_crc32"), size.alias("size"), (F.lit(None).cast("string") if row is None else row).alias("row")]
    return [(old_shard(old) if was is None else was.cast("int")).alias("old_shard"), _level(size).alias("level"), *own]


def _level(size: Column) -> Column:
    return sum((F.when(size < bound, 1).otherwise(0) for bound in CLASSES), F.lit(0))


def _block(blocks: int, of: str = "") -> Column:
    return F.pmod(F.xxhash64(*(of + c for c in ("doc_id", "text_crc32", "size"))), F.lit(blocks))


def _blocks(counts) -> int:
    return max(1, math.ceil(max(counts, default=0) / RANKED))


def _placed(docs: DataFrame, old: int, new: int, was: Column | None, row: Column | None) -> DataFrame:
    """old_shard, level, block, KEY and shard of every row."""
    spark = docs.sparkSession
    rows = stage(docs.select(*_described(old, was, row)), "reshard-rows")
    groups = {(r["old_shard"], r["level"]): (r["b"], r["n"]) for r in rows.groupBy("old_shard", "level").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}  # old shards x 6 rows
    block = _block(_blocks(n for _, n in groups.values()))
    laid = stage(_ranked(rows.withColumn("block", block), ["old_shard", "level"], [*KEY]), "reshard-laid")

    sizes: dict[int, int] = {}
    for (i, _), (b, _) in groups.items():
        sizes[i] = sizes.get(i, 0) + b
    open_ = transfers(sizes, old, new).astype(np.float64)
    cuts = []  # (old_shard, level, from, to, shard): the stretches of the laid-out bytes
    for level in range(len(CLASSES) + 1):
        stretch = []
        for i in range(old):
            b = groups.get((i, level), (0, 0))[0]
            want = np.maximum(open_[i], 0)
            if not b:
                continue
            share = want / want.sum() if want.sum() > 0 else np.eye(new)[i % new]
            ends = np.round(np.cumsum(share) * b)
            ends[-1] = b
            begin = 0
            for j in range(new):
                if ends[j] > begin or (share[j] > 0 and j == int(np.flatnonzero(share)[-1])):
                    stretch.append((i, level, int(begin), int(b + 1 if ends[j] >= b else ends[j]), j))
                    begin = ends[j]
                if begin >= b:
                    break
        if not stretch:
            continue
        cuts += stretch
        took = _taken(laid.where(F.col("level") == level), _frame(spark, stretch)).groupBy("old_shard", "shard").agg(F.sum("size").alias("b")).collect()  # old x new rows at most
        for r in took:
            open_[r["old_shard"], r["shard"]] -= r["b"]
    return _taken(laid, _frame(spark, cuts)).drop("before", "place")


def assign(docs: DataFrame, old: int = OLD, new: int = NEW, was: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard and slot (from 0 in each shard) of every row. ``was``: the old shard
    of a row, as a column of ``docs``."""
    placed = _placed(docs, old, new, was, None)
    ranked = _ranked(placed.withColumn("block", F.struct("old_shard", "level", "block")), ["shard"], [*KEY])
    return ranked.select("doc_id", "size", "text_crc32", "old_shard", "shard", F.col("place").cast("long").alias("slot"))


def _frame(spark, cuts: list[tuple]) -> DataFrame:
    """Stretches: at most old x 6 x (targets of a shard), and a flow of least cost has fewer than old + new arcs."""
    return spark.createDataFrame(cuts, "old_shard int, level int, lo long, hi long, shard int")


def _taken(laid: DataFrame, cuts: DataFrame) -> DataFrame:
    """Each row goes to the stretch that holds its middle."""
    middle = F.col("before") + F.floor(F.col("size") / 2)
    return laid.join(F.broadcast(cuts), ["old_shard", "level"]).where((middle >= F.col("lo")) & (middle < F.col("hi"))).drop("lo", "hi")


def _write(docs: DataFrame, placed: DataFrame, blocks: int, path: str, old: int, was: Column | None, row: Column | None) -> None:
    """Write every row of ``docs`` to ``path/shard=N``, in the order of slots. Only first keys are broadcast: at most as
    many as stretches."""
    laid = placed.groupBy("old_shard", "level", "shard").agg(F.min(F.struct("block", *KEY)).alias("first"))
    bounds = laid.groupBy(F.col("old_shard").alias("_old"), F.col("level").alias("_level")).agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("_bounds"))
    described = docs.withColumn("_own", F.struct(*_described(old, was, row))).drop("shard")
    own = F.struct(_block(blocks, "_own.").alias("block"), *(F.col(f"_own.{c}").alias(c) for c in KEY))
    order = F.struct("_own.old_shard", "_own.level", own.alias("own"))
    # A left join: a row without a bound would get the shard null and be missed, not be lost in silence.
    found = described.withColumn("_order", order).join(F.broadcast(bounds), (F.col("_own.old_shard") == F.col("_old")) & (F.col("_own.level") == F.col("_level")), "left")
    shard = F.element_at(F.filter("_bounds", lambda x: x["first"] <= F.col("_order.own")), -1)["shard"]
    rows = found.withColumn("shard", shard).drop("_own", "_old", "_level", "_bounds")
    rows.repartitionByRange("shard", "_order").sortWithinPartitions("shard", "_order").drop("_order").write.partitionBy("shard").parquet(path)


def stored(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row as they lie in the files below ``path``, written from
    ``docs``: a shard's files follow one another by their task's number."""
    schema = docs.drop("shard").schema.add("shard", IntegerType())
    files = docs.sparkSession.read.schema(schema).parquet(path)
    at = files.metadataColumn("_metadata")
    task = F.regexp_extract(at["file_name"], r"^part-(\d+)", 1).cast("long")
    rows = files.select("shard", task.alias("task"), at["file_name"].alias("file"), at["row_index"].alias("at"), old_shard().alias("old_shard"), *_described(OLD, None, None)[2:5])
    ahead = Window.partitionBy("shard").orderBy("task", "file").rowsBetween(Window.unboundedPreceding, -1)
    counts = files.groupBy("shard", task.alias("task"), at["file_name"].alias("file")).agg(F.count("*").alias("n"))
    counts = counts.select("shard", "file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return rows.join(F.broadcast(counts), ["shard", "file"]).select("doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("ahead") + F.col("at")).cast("long").alias("slot"))


def moved(docs: DataFrame, row: Column | None = None, new: int = NEW) -> DataFrame:
    """The rows of ``assign`` after the documents, with all their columns, were written to their new shards; read from
    these files. The documents lie in one table, not in a file per old shard, so all shards are written. ``row``: see
    ``place_in_file``; without it the documents are written once more first, to have such a key."""
    if row is None:
        docs = stage(docs, "reshard-docs")
        row = place_in_file(docs)
    placed = stage(_placed(docs, OLD, new, None, row), "reshard-placed")
    path = scratch_path(docs.sparkSession, "reshard-shards")
    counts = placed.groupBy("old_shard", "level").agg(F.count("*").alias("n")).collect()  # old shards x 6 rows
    _write(docs, placed, _blocks(r["n"] for r in counts), path, OLD, None, row)
    out = stored(docs, path)
    wrote, planned = out.where("shard is not null").count(), sum(r["n"] for r in counts)
    if wrote != planned:
        raise RuntimeError(f"{wrote} rows written of {planned}")
    return out


def rewrite(docs: DataFrame, assignment: DataFrame, path: str) -> list[int]:
    """Write the rows of every shard that gained or lost rows, ordered by slot, to ``path/shard=N``; the other shards'
    files stay as they are. Returns the written shards. Rows that share id, text and size are told apart by their rank:
    which of them goes to which shard is the same."""
    changed = [r["s"] for r in assignment.where("shard != old_shard").select(F.explode(F.array("shard", "old_shard")).alias("s")).distinct().collect()]  # at most old + new
    same = Window.partitionBy("doc_id", "text_crc32", "size")
    goes = assignment.withColumn("n", F.row_number().over(same.orderBy("shard", "slot"))).where(F.col("shard").isin(changed))
    goes = goes.select(F.struct("doc_id", "text_crc32", "size", "n").alias("_key"), "shard", F.col("slot").alias("_slot"))
    key = _described(OLD, None, None)[2:5]
    rows = docs.drop("shard").withColumn("_own", F.struct(*key))
    alike = Window.partitionBy("_own").orderBy("_own")
    rows = rows.withColumn("_key", F.struct("_own.*", F.row_number().over(alike).alias("n"))).drop("_own")
    rows = rows.join(goes, "_key").drop("_key")
    rows.repartitionByRange(F.col("shard"), F.col("_slot")).sortWithinPartitions("shard", "_slot").drop("_slot").write.partitionBy("shard").parquet(path)
    return sorted(changed)
