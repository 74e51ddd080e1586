"""Exact nearest neighbours without all pairs: blocks of near train rows, and the least distance of a row from a block's box.

A tree of cuts (a column and a value) sends every row to a leaf; the train rows of a leaf are dealt into blocks of about
``block_rows`` rows. Of every block the least and greatest value of each column is known. No row of a block is nearer to a
query row than the box of these values.

Two rounds. First every query row meets one block of its own leaf (or the one whose box lies nearest), which gives it a k-th
best distance; then it meets only those blocks whose box is not farther than that. A train block is copied only as often as
its visitors fill a task, and a query row goes only to blocks that can hold a neighbour. The cuts only guide the work: they
are fitted on a bounded sample (``SAMPLE`` rows) and every row is placed and searched; whatever they are, the result is
exact. The driver holds the sample, the tree and two values per block and column.

Bounds are compared with a margin above the rounding error of the distances, and equal distances survive. Rows with infinite
values have no finite distance, so they are nobody's neighbour and have none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascara.operators.knn_kernel import box_gap, cut, matrix_of
from cascara.session import written

#: Rows and values that the tree is fitted on at most.
SAMPLE, SAMPLE_VALUES = 8192, 2**20
#: Most partitions of a round.
TASKS = 2000


def fit_tree(train: DataFrame, n_train: int, block_rows: int) -> list[tuple]:
    """Cuts ``(column, value, node of the rows up to it, node of the others)`` until a leaf has ``block_rows`` rows or
    fewer, as far as a sample shows; a leaf is ``()``."""
    first = train.select(F.size("vec")).first()
    width = max(1, first[0] or 1) if first else 1
    some = train.select("vec").orderBy(F.xxhash64("tid")).limit(max(256, min(SAMPLE, SAMPLE_VALUES // width))).toArrow()
    v = matrix_of(some["vec"]) if some.num_rows else np.empty((0, width))
    v = v[np.isfinite(v).all(axis=1)]
    full = block_rows * len(v) / max(1, n_train)
    tree, left = [()], [(0, np.arange(len(v)))]
    while left:
        at, rows = left.pop()
        found = cut(v, rows) if len(rows) > max(1, full) else None
        if found is not None:
            low = v[rows, found[0]] <= found[1]
            tree[at] = (*found, len(tree), len(tree) + 1)
            left += [(len(tree), rows[low]), (len(tree) + 1, rows[~low])]
            tree += [(), ()]
    return tree


def leaves_of(v: np.ndarray, tree: list[tuple]) -> np.ndarray:
    leaf = np.zeros(len(v), np.int32)
    left = [(0, np.arange(len(v)))]
    while left:
        at, rows = left.pop()
        if len(rows) and tree[at]:
            column, value, below, above = tree[at]
            low = v[rows, column] <= value
            left += [(below, rows[low]), (above, rows[~low])]
        else:
            leaf[rows] = at
    return leaf


def _fields(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def place(rows: DataFrame, key: str, tree: list[tuple]) -> DataFrame:
    """The rows without infinite values, with ``h`` (hash of the key) and ``leaf``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = matrix_of(pa.chunked_array([b.column("vec")]))
            if np.isnan(v).any():
                raise ValueError("a vector holds NaN: its distances have no order")
            placed = pa.RecordBatch.from_arrays([*b.columns, pa.array(leaves_of(v, tree))], names=[*b.schema.names, "leaf"])
            yield placed.filter(pa.array(np.isfinite(v).all(axis=1)))

    hashed = rows.withColumn("h", F.xxhash64(key))
    return hashed.mapInArrow(work, f"{_fields(hashed)}, leaf int")


def into_blocks(rows: DataFrame, block_rows: int, grouped: bool) -> DataFrame:
    """Adds ``block`` (of one group, if ``grouped``): a leaf with more rows than a block takes is dealt out by key, whether
    it holds many near rows or many copies of one."""
    at = [*(["grp"] if grouped else []), "leaf"]
    sizes = rows.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("__parts"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in at])
    sized = rows.join(sizes.withColumnsRenamed({c: f"__{c}" for c in at}), same)
    return sized.withColumn("block", F.concat_ws("/", *at, F.pmod("h", F.col("__parts")))).drop("__parts", *[f"__{c}" for c in at])


def boxes(rows: DataFrame) -> DataFrame:
    """One row per block: its group and leaf, the number of rows and the ends of each column."""
    def work(_: tuple, b: pa.Table) -> pa.Table:
        v = matrix_of(b["vec"])
        ends = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (v.min(axis=0), v.max(axis=0))]
        few = b.select(["block", "grp", "leaf"]).slice(0, 1)
        return few.append_column("n", pa.array([b.num_rows], pa.int64())).append_column("low", ends[0]).append_column("high", ends[1])

    kind = rows.schema["grp"].dataType.simpleString()
    return rows.groupBy("block").applyInArrow(work, f"block string, grp {kind}, leaf int, n long, low array<double>, high array<double>")


def pruned_pairs(q: DataFrame, t: DataFrame, k: int, metric: str, kernel, schema: str, *, groups: list | None, block_rows: int,
                 n_train: int, decimals: int | None, report: dict | None = None) -> DataFrame:
    """The ``k`` nearest candidates of every query row and block that can hold a neighbour of it, for one metric.

    ``q`` has (qid, vec, grp), ``t`` (tid, vec, label, grp); ``groups``: values of ``grp``, if blocks are cut by it, and
    rows never meet blocks of their own; else the kernel leaves out pairs of one group by itself, if need be. ``n_train``:
    train rows, of one group if blocks are cut by group. ``kernel(q, t)`` returns rows of ``schema``. ``report`` takes the
    numbers of query rows, train blocks and pairs formed.
    """
    spark = q.sparkSession
    tree = fit_tree(t, n_train, block_rows)
    placed_t = written(place(t, "tid", tree), "knn-train")
    t_rows = into_blocks(placed_t, block_rows, bool(groups))
    blocks = sorted(boxes(t_rows).collect(), key=lambda r: r["block"])
    code = {g: i for i, g in enumerate(groups or [])}
    group = np.array([code.get(b["grp"], -2) for b in blocks], np.int64)
    leaf, n = (np.array([b[c] for b in blocks], np.int64) for c in ("leaf", "n"))
    low, high = (np.array([b[c] for b in blocks], np.float64) for c in ("low", "high"))
    slack = 10.0**-decimals if decimals is not None else 0.0

    def groups_of(b: pa.RecordBatch) -> np.ndarray:
        return np.array([code.get(g, -1) for g in b.column("grp").to_pylist()], np.int64) if code else np.full(b.num_rows, -1)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds ``block``: one of the row's own leaf with enough rows, else the one with the nearest box; -1 without any."""
        for b in batches:
            if not b.num_rows:
                continue
            own, grp, h = b.column("leaf").to_numpy(), groups_of(b), b.column("h").to_numpy()
            home = np.full(b.num_rows, -1, np.int32)
            v = None
            for x, g in {*zip(own.tolist(), grp.tolist(), strict=True)}:
                rows = np.flatnonzero((own == x) & (grp == g))
                others = np.flatnonzero(group != g)
                others = others[n[others] >= k] if (n[others] >= k).any() else others
                of_leaf = others[leaf[others] == x]
                if len(of_leaf):
                    home[rows] = of_leaf[h[rows] % len(of_leaf)]
                elif len(others):
                    v = matrix_of(pa.chunked_array([b.column("vec")])) if v is None else v
                    gaps = np.stack([box_gap(v[rows], v[rows], low[o], high[o], metric) for o in others])
                    home[rows] = others[gaps.argmin(axis=0)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home)], names=[*b.schema.names, "block"])

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with further blocks to meet, and ``meets``: those blocks. Rows of one leaf share a box, which leaves out
        most blocks for all of them at once."""
        for b in batches:
            if not b.num_rows:
                continue
            v, own, grp = matrix_of(pa.chunked_array([b.column("vec")])), b.column("leaf").to_numpy(), groups_of(b)
            reach, home = b.column("far").to_numpy() * (1 + 1e-9) + slack, b.column("block").to_numpy()
            at, to = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for x in np.unique(own):
                rows = np.flatnonzero(own == x)
                of = v[rows]
                gap = box_gap(of.min(axis=0), of.max(axis=0), low, high, metric)
                for c in np.flatnonzero(gap <= reach[rows].max()):
                    near = box_gap(of, of, low[c], high[c], metric) <= reach[rows]
                    met = rows[near & (grp[rows] != group[c]) & (home[rows] != c)]
                    at.append(met)
                    to.append(np.full(len(met), c, np.int32))
            at, to = np.concatenate(at), np.concatenate(to)
            order = np.argsort(at, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=b.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(to[order]))
            with_lists = pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "meets"])
            yield with_lists.filter(pa.array(np.diff(ends) > 0))

    def met(visits: DataFrame) -> tuple[DataFrame, int]:
        """The kernel's rows for every block and its visitors, who come in parts of about ``block_rows``; number of visits."""
        counts = visits.groupBy("block").count().collect()
        deal = [(blocks[r["block"]]["block"], r["block"], math.ceil(r["count"] / block_rows)) for r in counts]
        dealt = F.broadcast(spark.createDataFrame(deal, "name string, block int, parts int"))
        key = ["block", "part"]
        left = visits.join(dealt, "block").withColumn("part", F.pmod(F.xxhash64("h", F.lit(1)), "parts").cast("int"))
        left = left.select(*key, "qid", "vec", "grp", *(["far"] if "far" in visits.columns else []))
        right = t_rows.withColumnRenamed("block", "name").join(dealt, "name").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        right = right.select(*key, "tid", "vec", "label", "grp")
        # few bytes but much arithmetic: no merging of partitions, and few pairs of blocks in one
        tasks = max(4 * spark.sparkContext.defaultParallelism, min(TASKS, 2 * sum(d[2] for d in deal)))
        found = (left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key))
                 .applyInArrow(kernel, schema))
        return found, sum(r["count"] for r in counts)

    placed_q = place(q, "qid", tree)
    placed_q = written(placed_q.mapInArrow(homes, f"{_fields(placed_q)}, block int"), "knn-queries").where("block >= 0")
    first, at_home = met(placed_q)
    first = written(first, "knn-first")

    limits = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("far"))
    known = placed_q.join(limits.withColumnRenamed("qid", "id_of"), F.col("qid").eqNullSafe(F.col("id_of")), "left").drop("id_of")
    known = known.withColumn("far", F.coalesce("far", F.lit(float("inf"))))
    further = written(known.mapInArrow(reachable, f"{_fields(known)}, meets array<int>"), "knn-visits")
    second, beyond = met(further.drop("block").withColumn("block", F.explode("meets")).drop("meets"))
    if report is not None:
        report.update(query_blocks=placed_q.count(), train_blocks=len(blocks), formed=at_home + beyond)
    return first.unionByName(second)
