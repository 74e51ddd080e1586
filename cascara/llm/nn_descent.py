"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search in it.

Equal vectors are one node (a vector that a third of all rows share is one node with its least ids). The graph starts
from exact neighbours inside small cells of random hyperplanes. Then each round joins neighbours of neighbours: nodes
meet in groups together with their current neighbours, everything that meets is compared, and each node keeps its best;
rounds end when they change little. A cell that is too large (a dense cluster) is split at random, so no group grows
with the data. Inner product becomes a metric's order by one more coordinate that fills every vector up to the longest.
That coordinate is near 1 for all but the longest, so what is compared is the product less 1, a sum of terms of the size of
the short vectors' own products. Vectors travel to the groups as directions in half precision with their lengths; the search scores the original vectors in double precision.

A search starts at the query's own node and at a few fixed entries (the longest vectors, which inner products favour,
and some others) and expands the best unexpanded nodes of its beam, hop by hop, all queries at once, until the 2 k
nearest found so far are all expanded. A query expands a node once, so every beam closes in the end; a query that has
closed leaves the search, the others go on without a limit of hops.

Defined cases: rows whose vector is null, zero, of another length than most, or has null or non-finite parts take no
part, as queries or as candidates; rows that repeat an id and vector count once; fewer candidates than asked for are
all returned; an empty table gives no rows; only ``vec_id`` and ``embedding`` are read, other columns may have any name.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascara.llm.common import prepare, stage

K = 20
#: Neighbours of a node in the graph.
DEGREE = 24
#: Nodes of a first cell, first cells per node, and nodes that bring their neighbours to a group.
CELL, TREES, GROUP = 640, 3, 128
#: A round that renews less than this share of all neighbours is the last.
SETTLED = 0.01
#: Beam of a search, nodes expanded per hop, queries of a search group.
BEAM, EXPAND, QUERIES = 64, 10, 32
#: Nodes of either kind where every search starts.
ENTRIES = 128
#: Rows that the hyperplanes' medians are taken from.
SAMPLE = 4_000

#: Below every score of two nodes, which is their product less 1.
NONE = -4.0

GRAPH = "node long, near array<long>, score array<float>"


def precision(vectors: DataFrame) -> str:
    """The element type that vectors are kept in: double if they hold doubles, else float."""
    return "double" if dict(vectors.dtypes)["embedding"] == "array<double>" else "float"


def nodes_of(vectors: DataFrame, k: int = K) -> DataFrame:
    """(node, embedding, ids): each different usable vector with its least ids (k + 1 at most; node is the least)."""
    kind = precision(vectors)
    e = F.col("embedding").cast(f"array<{kind}>")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where("vec_id is not null and embedding is not null").where(usable)
    size = rows.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    rows = rows.where(F.size("embedding") == (size["size"] if size else 0))
    # -0.0 and 0.0 are the same number.
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast(kind)))
    first = rows.distinct().withColumn("place", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    return first.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select("node", "embedding", "ids")


def matrix(column: pa.ChunkedArray, kind: type = np.float32) -> np.ndarray:
    """A column of equally long vectors, as rows."""
    column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1) if n else np.zeros((0, 1), kind)


def halves(nodes: DataFrame, longest: float) -> DataFrame:
    """(node, half): each vector's direction in half precision, then its length as a share of the longest one's in single
    precision."""

    def work(batches):
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column(1)]), np.float64)
            norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
            share = np.minimum(norm / longest, 1).astype("<f4")
            half = np.hstack([(x / norm).astype("<f2").view(np.uint8).reshape(len(x), -1), share.view(np.uint8).reshape(len(x), -1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in half], pa.binary())], ["node", "half"])

    return nodes.select("node", "embedding").mapInArrow(work, "node long, half binary")


def _half(blobs: list[bytes]) -> np.ndarray:
    """Vectors at most 1 long, and by how much the coordinate that fills each up to length 1 falls short of 1."""
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)
    share = np.ascontiguousarray(raw[:, -4:]).view("<f4")
    x = np.ascontiguousarray(raw[:, :-4]).view("<f2").astype(np.float32) * share
    square = share.astype(np.float64) ** 2
    return np.hstack([x, (square / (1 + np.sqrt(1 - square))).astype(np.float32)])


def cells(points: DataFrame, count: int, size: int, seed: int) -> DataFrame:
    """(node, cell): cells of about ``size`` nodes by the sides of random hyperplanes at the medians of a sample; a cell
    with more is split at random."""
    bits = max(0, round(math.log2(max(1, count / size))))
    sample = [r["half"] for r in points.orderBy(F.xxhash64("node")).limit(SAMPLE).select("half").collect()]
    x = _half(sample) if sample else np.zeros((0, 0), np.float32)
    planes = np.random.default_rng(seed).normal(size=(x.shape[1], bits)).astype(np.float32)
    medians = np.median(x @ planes, axis=0) if bits else np.zeros(0)

    def work(batches):
        for batch in batches:
            sides = _half(batch.column(1).to_pylist()) @ planes > medians
            cell = (sides.astype(np.int64) << np.arange(bits)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell, pa.int64())], ["node", "cell"])

    own = points.select("node", "half").mapInArrow(work, "node long, cell long")
    sizes = own.groupBy("cell").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / (2 * size))
    return own.join(sizes, "cell").select("node", (F.col("cell") + F.pmod(F.xxhash64("node", F.lit(seed)), parts) * (1 << bits)).alias("cell"))


def _compare(degree: int):
    """In each cell, every node's best others that beat what it has."""

    def work(table: pa.Table) -> pa.Table:
        ids = table["node"].to_numpy()
        x = _half(table["half"].to_pylist())
        short, one = x[:, -1:], np.ones((len(x), 1), np.float32)
        left, right = np.hstack([x, -short, one]), np.hstack([x, one, -short])  # x y + (1 - a) (1 - b) - 1
        least = table["least"].to_numpy()
        n = len(ids)
        take = min(degree, n - 1)
        node, near, score = [], [], []
        for a in range(0, n, 512) if take > 0 else ():
            s = left[a : a + 512] @ right.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
            best = np.argpartition(s, n - take, axis=1)[:, n - take :]
            got = np.take_along_axis(s, best, axis=1)
            better = got > least[a : a + 512, None]
            for i in np.flatnonzero(better.any(axis=1)).tolist():
                node.append(ids[a + i])
                near.append(ids[best[i][better[i]]])
                score.append(got[i][better[i]])
        return pa.table({"node": pa.array(node, pa.int64()), "near": pa.array(near, pa.list_(pa.int64())), "score": pa.array(score, pa.list_(pa.float32()))})

    return work


def merged(proposals: DataFrame, buckets: int, degree: int) -> DataFrame:
    """Each node's best neighbours among all rows that name it."""

    def work(table: pa.Table) -> pa.Table:
        lists = table["near"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        node = np.repeat(table["node"].to_numpy(), sizes)
        near, score = lists.flatten().to_numpy(), table["score"].combine_chunks().flatten().to_numpy()
        order = np.lexsort((near, -score, node))
        node, near, score = node[order], near[order], score[order]
        # The same neighbour may come from several groups, with scores that differ by a rounding at most.
        pair = np.lexsort((np.arange(len(near)), near, node))
        again = np.zeros(len(node), bool)
        again[pair[1:]] = (node[pair[1:]] == node[pair[:-1]]) & (near[pair[1:]] == near[pair[:-1]])
        node, near, score = node[~again], near[~again], score[~again]
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        place = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
        keep = place < degree
        node, near, score = node[keep], near[keep], score[keep]
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else first
        offsets = pa.array(np.append(first, len(node)).astype(np.int32))
        return pa.table({"node": pa.array(node[first], pa.int64()), "near": pa.ListArray.from_arrays(offsets, pa.array(near, pa.int64())), "score": pa.ListArray.from_arrays(offsets, pa.array(score, pa.float32()))})

    return proposals.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets))).groupBy("bucket").applyInArrow(lambda t: work(t.select(["node", "near", "score"])), GRAPH)


def build(points: DataFrame, count: int, degree: int = DEGREE) -> DataFrame:
    """The neighbour graph (node, near, score) over (node, half)."""
    buckets = max(1, math.ceil(count * degree * 8 / 2_000_000))
    kernel = _compare(degree)
    start = None
    for seed in range(TREES):
        cell = cells(points, count, CELL, seed)
        found = cell.join(points, "node").select("cell", "node", "half", F.lit(NONE).cast("float").alias("least")).groupBy("cell").applyInArrow(kernel, GRAPH)
        start = found if start is None else start.unionByName(found)
    graph = stage(merged(start, buckets, degree), "neighbours-0")
    for turn in itertools.count(1):  # every change puts a nearer neighbour in, so the rounds come to an end
        group = stage(cells(points, count, GROUP, 1000 + turn), "neighbours-cells")
        around = group.join(graph, "node", "left").select("cell", F.explode(F.concat(F.array("node"), F.coalesce("near", F.array().cast("array<long>")))).alias("node")).distinct()
        least = graph.select("node", F.when(F.size("near") >= degree, F.element_at("score", -1)).otherwise(F.lit(NONE)).cast("float").alias("least"))
        known = points.join(least, "node", "left").select("node", "half", F.coalesce("least", F.lit(NONE).cast("float")).alias("least"))
        better = around.join(known, "node").select("cell", "node", "half", "least").groupBy("cell").applyInArrow(kernel, GRAPH)
        new = stage(merged(graph.unionByName(better), buckets, degree), f"neighbours-{turn}")
        fresh = new.join(graph.select("node", F.col("near").alias("was")), "node", "left")
        changed = fresh.agg(F.sum(F.size(F.array_except("near", F.coalesce("was", F.array().cast("array<long>"))))).alias("n")).first()["n"] or 0
        graph = new
        if changed < SETTLED * count * degree:
            return graph


BEAMS = "node long, cell long, beam array<long>, score array<double>, open array<boolean>, spent array<long>, done boolean"


def _hop(k: int, entry_ids: np.ndarray, entry: np.ndarray):
    def work(queries: pa.Table, around: pa.Table) -> pa.Table:
        q = matrix(queries["embedding"], np.float64)
        ids, x = around["near"].to_numpy(), matrix(around["vector"], np.float64)
        if len(entry_ids):
            fresh = ~np.isin(entry_ids, ids)
            ids, x = np.append(ids, entry_ids[fresh]), np.vstack([x, entry[fresh]]) if len(x) else entry[fresh]
        scores = q @ x.T if len(ids) else np.zeros((len(q), 0))
        rows = []
        for i, row in enumerate(queries.select(["node", "cell", "beam", "score", "open", "spent"]).to_pylist()):
            # Both sides are sorted out by score, then by id; a node that is known keeps its state.
            state = {b: (s, o) for b, s, o in zip(row["beam"], row["score"], row["open"], strict=True)}
            ranked = sorted(state, key=lambda b: (-state[b][0], b))
            expanded = [b for b in ranked if state[b][1]][:EXPAND]
            for b in expanded:
                state[b] = (state[b][0], False)
            spent = set(row["spent"]).union(expanded)
            take = min(BEAM, len(ids))
            best = np.argpartition(scores[i], len(ids) - take)[len(ids) - take :] if take else []
            for j in best:
                state.setdefault(int(ids[j]), (float(scores[i, j]), int(ids[j]) not in spent))
            beam = sorted(state, key=lambda b: (-state[b][0], b))[:BEAM]
            done = not any(state[b][1] for b in beam[: 2 * k])
            rows.append((row["node"], row["cell"], beam, [state[b][0] for b in beam], [state[b][1] for b in beam], sorted(spent), done))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.bool_()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        return pa.table({n.split()[0]: pa.array(c, t) for n, c, t in zip(BEAMS.split(", "), columns, kinds, strict=True)})

    return work


def search(nodes: DataFrame, points: DataFrame, graph: DataFrame, asked: DataFrame, k: int = K) -> DataFrame:
    """(node, beam, score): for the nodes asked for, the nearest nodes found, the node itself among them."""
    count = asked.count()
    place = cells(points.join(asked, "node", "left_semi"), count, QUERIES, 77)
    empty = [F.array().cast(f"array<{t}>").alias(n) for n, t in (("beam", "long"), ("score", "double"), ("open", "boolean"), ("spent", "long"))]
    beams = stage(place.select("node", "cell", *empty, F.lit(False).alias("done")), "search-0")
    vectors = nodes.select("node", "embedding")
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    entries = nodes.orderBy(F.desc(length), "node").limit(ENTRIES).unionByName(nodes.orderBy(F.xxhash64("node")).limit(ENTRIES)).select("node", "embedding").collect()
    entries = dict((r["node"], r["embedding"]) for r in entries)
    entry_ids, entry = np.array(list(entries), np.int64), np.array(list(entries.values()), np.float64)
    finished = []
    for hop in itertools.count():
        if hop == 0:
            at = beams.select("cell", F.col("node").alias("from"))
        else:
            ranked = F.filter(F.arrays_zip("beam", "open"), lambda b: b["open"])  # beams are in order of score
            at = beams.select("cell", F.explode(F.transform(F.slice(ranked, 1, EXPAND), lambda b: b["beam"])).alias("from")).distinct()
        around = at.join(graph.withColumnRenamed("node", "from"), "from", "left").select("cell", F.explode(F.concat(F.array("from"), F.coalesce("near", F.array().cast("array<long>")))).alias("near")).distinct()
        seen = around.join(vectors.withColumnRenamed("node", "near"), "near").select(F.col("cell").alias("group"), "near", F.col("embedding").alias("vector"))
        queries = beams.join(vectors, "node").select("cell", "node", "embedding", "beam", "score", "open", "spent")
        beams = stage(queries.groupBy("cell").cogroup(seen.groupBy("group")).applyInArrow(_hop(k, entry_ids[: 0 if hop else None], entry[: 0 if hop else None]), BEAMS), f"search-{hop + 1}")
        finished.append(beams.where("done").select("node", "beam", "score"))
        beams = beams.where("not done")
        if beams.isEmpty():
            break
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    return out


def nearest(vectors: DataFrame, asked: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows of every row for which ``asked`` holds."""
    prepare(vectors.sparkSession)
    nodes = stage(nodes_of(vectors, k), "neighbours-nodes")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))).alias("longest")).first()
    points = stage(halves(nodes, float(size["longest"] or 1.0)), "neighbours-points")
    if not size["n"]:
        return nodes.select(F.col("node").alias("query_id"), F.lit(1).alias("rank"), F.col("node").alias("vec_id"), F.lit(0.0).alias("score"))
    graph = build(points, size["n"])
    kind = precision(vectors)
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast(f"array<{kind}>"), lambda x: x + F.lit(0.0).cast(kind)).alias("embedding")).where(asked)
    queries = stage(ids.join(nodes.select("node", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), "node").distinct(), "neighbours-queries")
    found = search(nodes, points, graph, queries.select("node").distinct(), k)
    each = found.select("node", F.explode(F.arrays_zip("beam", "score")).alias("b")).select("node", F.col("b.beam").alias("near"), F.col("b.score").alias("score"))
    rows = each.join(nodes.select(F.col("node").alias("near"), "ids"), "near").select("node", "score", F.explode("ids").alias("vec_id"))
    best = rows.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1).select("node", "score", "vec_id")
    out = queries.join(best, "node").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
