"""Model evaluation: repeatable split, stratified folds, exact k-nearest neighbours, voting, grid search, metrics.

k-NN on few rows runs as a distributed block nested loop; on many, only block pairs that can hold a neighbour are formed
(``knn_pruned``). In the nested loop query rows are hashed into ``QB`` blocks and
train rows into ``TB`` blocks; each query row is replicated to the ``TB`` train blocks and each train row to the
``QB`` query blocks, and ``cogroup(...).applyInPandas`` receives one (query block, train block) pair per group —
bounded by ``block_rows`` on each side whatever the table size. Inside, numpy keeps the ``k`` nearest per query row and
metric by lower bounds and few exact distances (``knn_kernel``); only those leave the task (never the pairs). A final ``row_number``
over ``(query, metric)`` — at most ``TB · k`` rows per query, planned as a WindowGroupLimit — picks the global top k.
Ties are broken by train key, so the result is deterministic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascara.operators.knn_kernel import matrix_of, nearest
from cascara.operators.radix import ranked

METRICS = ("euclidean", "manhattan")
WEIGHTS = ("uniform", "distance")


# ---------------------------------------------------------------------------------------------------------------
# split and folds


def hash_of(key: str, seed: int | str) -> F.Column:
    """md5 hex of ``key || seed``: a repeatable shuffle order, independent of partitioning and engine."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))


def train_test_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int | str = 42,
                     out: str = "is_test") -> DataFrame:
    """Adds ``is_test``: a repeatable split by key hash with ``ceil(test_fraction * rows)`` test rows. The hash at that
    rank is found by radix selection (aggregates only: no shuffle of the rows, no global sort). Rows of one key stay on
    one side, so the size is exact where keys are distinct; rows without a key are one key."""
    order = hash_of(key, seed)
    # the first 60 bits of the hash, as the upper bits of a positive long
    place = F.shiftleft(F.conv(F.substring(order, 1, 15), 16, 10).cast("long"), 3)
    found = ranked(df.select(F.lit("").alias("feature"), place.alias("image")), lambda n: [max(0, math.ceil(test_fraction * n) - 1)])
    if not found or test_fraction <= 0:
        return df.withColumn(out, F.lit(False))
    (last,) = found[""][1].values()
    return df.withColumn(out, place <= F.lit(last))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 3, seed: int | str = 42,
                     out: str = "fold") -> DataFrame:
    """Adds ``fold``: rows of each label, in hash order, dealt round-robin into ``k`` folds (fold sizes per label
    differ by at most one).

    The rank within a label is computed without a window over the whole label: rows are bucketed by the first
    three hex digits of their hash (4096 buckets, monotone in the hash order), the rank inside (label, bucket)
    comes from a small window, and the offset of each bucket is a running sum over the (label, bucket) counts —
    a table of at most labels × 4096 rows. A label holding a third of all rows is thus spread over 4096 tasks.
    """
    h = hash_of(key, seed)
    tagged = df.withColumn("__h", h).withColumn("__b", F.substring("__h", 1, 3))
    counts = tagged.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n"))
    wo = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, "__b", F.coalesce(F.sum("__n").over(wo), F.lit(0)).alias("__off"))
    wr = Window.partitionBy(label, "__b").orderBy("__h", key)
    ranked = tagged.withColumn("__r", F.row_number().over(wr) - 1)
    offsets = offsets.withColumnsRenamed({label: "__label", "__b": "__bucket"})
    same = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__b") == F.col("__bucket"))  # rows without a label are a class
    return (ranked.join(offsets, same)
            .withColumn(out, ((F.col("__off") + F.col("__r")) % F.lit(k)).cast("int"))
            .drop("__h", "__b", "__r", "__off", "__label", "__bucket"))


# ---------------------------------------------------------------------------------------------------------------
# exact k nearest neighbours


def _block_counts(spark, nq: int, nt: int, block_rows: int) -> tuple[int, int]:
    tb = max(1, math.ceil(nt / block_rows))
    par = max(1, spark.sparkContext.defaultParallelism)
    qb = max(math.ceil(nq / block_rows), math.ceil(par / tb))
    qb = max(1, min(qb, max(1, nq)))
    return qb, tb


def _distances(Q: np.ndarray, T: np.ndarray, metrics: Sequence[str]) -> dict[str, np.ndarray]:
    """Distance matrices, summed over the dimensions in order (in place, no per-pair temporaries): the same
    sequence of roundings as a plain loop, so equal inputs give equal bits in any engine that sums in order."""
    shape = (len(Q), len(T))
    diff, tmp = np.empty(shape), np.empty(shape)
    acc = {m: np.zeros(shape) for m in metrics}
    for j in range(Q.shape[1]):
        np.subtract(Q[:, j, None], T[None, :, j], out=diff)
        if "manhattan" in acc:
            np.abs(diff, out=tmp)
            acc["manhattan"] += tmp
        if "euclidean" in acc:
            np.multiply(diff, diff, out=tmp)
            acc["euclidean"] += tmp
    if "euclidean" in acc:
        np.sqrt(acc["euclidean"], out=acc["euclidean"])
    return acc


def _smallest(D: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the k smallest entries per row, ties to the smaller column, in (value, column) order —
    a linear-time partition plus a sort of k entries per row instead of a full sort."""
    kth = np.partition(D, k - 1, axis=1)[:, k - 1]
    less = D < kth[:, None]
    eq = D == kth[:, None]
    need = k - less.sum(axis=1)
    take = less | (eq & (np.cumsum(eq, axis=1) <= need[:, None]))
    cols = np.nonzero(take)[1].reshape(len(D), k)
    vals = np.take_along_axis(D, cols, axis=1)
    return np.take_along_axis(cols, np.argsort(vals, axis=1, kind="stable"), axis=1)


def _topk_block(k: int, metrics: Sequence[str], has_group: bool, decimals: int | None,
                chunk_elems: int = 1 << 17):
    """The per-(query block, train block) kernel. Full distances are computed for chunks of ``chunk_elems`` cells (about 64
    rows against 2048 train rows), so the working arrays stay in cache. Query rows may have a distance ``far`` beyond
    which no neighbour is wanted."""
    metrics = list(metrics)
    for m in metrics:
        if m not in METRICS:
            raise ValueError(m)

    def full(Q: np.ndarray, T: np.ndarray, metric: str, same):
        """The k nearest by the whole distance matrix."""
        kk = min(k, len(T))
        step = max(1, chunk_elems // max(1, len(T)))
        out = []
        for s in range(0, len(Q), step):
            d = _distances(Q[s:s + step], T, [metric])[metric]
            if decimals is not None:
                # distances equal up to rounding noise must tie in every engine: rank on rounded values
                d = np.round(d, decimals)
            if same is not None:
                d = np.where(same(np.arange(s, s + len(d))[:, None], np.arange(len(T))[None, :]), np.inf, d)
            order = _smallest(d, kk)
            dd = np.take_along_axis(d, order, axis=1)
            keep = np.isfinite(dd).ravel()
            out.append((np.repeat(np.arange(s, s + len(d)), kk)[keep], order.ravel()[keep], dd.ravel()[keep]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def fn(q: pa.Table, t: pa.Table) -> pa.Table:
        names = ["qid", "metric", "tid", "tlabel", "dist"]
        out = []
        if q.num_rows and t.num_rows:
            # column order = key order: ties go to the smaller key
            t = t.take(pc.sort_indices(t, sort_keys=[("tid", "ascending")]))
            Q, T = matrix_of(q["vec"]), matrix_of(t["vec"])
            far = q["far"].to_numpy() if "far" in q.column_names else None
            same = None
            if has_group:
                qgrp, tgrp = q["grp"].to_pandas().to_numpy(), t["grp"].to_pandas().to_numpy()
                same = lambda r, c: qgrp[r] == tgrp[c]
            for m in metrics:
                found = nearest(Q, T, k, m, decimals, same, lambda a, b, m=m: _distances(a, b, [m])[m], far)
                rows, cols, dist = full(Q, T, m, same) if found is None else found
                out.append(pa.table([q["qid"].take(pa.array(rows)), pa.array([m]).take(pa.array(np.zeros(len(rows), np.int64))),
                                     t["tid"].take(pa.array(cols)), t["label"].take(pa.array(cols)), pa.array(dist)], names=names))
        none = [pa.chunked_array([], x) for x in (q["qid"].type, pa.string(), t["tid"].type, pa.int64(), pa.float64())]
        return pa.concat_tables(out) if out else pa.table(none, names=names)

    return fn


def _rows_of_blocks(train: DataFrame, n: int) -> int:
    """Rows of a block: as many blocks of a table whatever its size, so that copies of rows grow with the rows, but no
    more than 16384 rows or 64 MB of vectors."""
    if n <= 32768:
        return 2048
    width = train.agg(F.max(F.size("vec"))).first()[0] or 1
    return max(1, min(16384, max(4096, math.ceil(n / 64)), 2**23 // max(1, width)))


def _groups(train: DataFrame, column: str, most: int = 16) -> list | None:
    """The values of a column with few distinct ones (folds, say), else None."""
    rows = train.select(column).distinct().limit(most + 1).collect()
    return None if len(rows) > most or any(r[0] is None for r in rows) else [r[0] for r in rows]


def knn_neighbours(queries: DataFrame, train: DataFrame, k: int, *, qkey: str, tkey: str, vec: str = "vec",
                   label: str = "label", metrics: Sequence[str] = METRICS, exclude_same: str | None = None,
                   block_rows: int | None = None, counts: tuple[int, int] | None = None,
                   decimals: int | None = None, prune_from: int = 256, report: dict | None = None) -> DataFrame:
    """``(qid, metric, rank, tid, tlabel, dist)``: the ``k`` nearest train rows of every query row, per metric. Keys
    may be of any type with an order; equal distances go to the smaller key.

    ``exclude_same`` names a column present on both sides (e.g. the CV fold): pairs with equal values are not
    neighbours; with few values the blocks are cut by value and such pairs are never formed. ``counts`` = (query rows,
    train rows) if known; otherwise two counts are run to size the blocks. ``decimals`` rounds distances before they
    are ranked, only for comparing results with an engine that sums in another order; the default is exact.
    ``block_rows``: rows of a block on each side, by default set by the number of train rows.

    From ``prune_from`` block pairs on, blocks hold near rows and a query row goes only to blocks that can hold a neighbour
    of it (see ``knn_pruned``); below, bounding costs more than it saves, and rows are dealt into blocks by key. The result
    is the same. ``report`` takes, per metric, the numbers of query rows (``query_blocks``: each meets train blocks by
    itself), train blocks and pairs of both formed.
    """
    from cascara.session import ship_package

    spark = queries.sparkSession
    ship_package(spark)  # the distance kernel runs in Python workers
    groups = _groups(train, exclude_same) if exclude_same else None
    extra = [F.col(exclude_same).alias("grp")] if exclude_same else []
    q = queries.select(F.col(qkey).alias("qid"), F.col(vec).cast("array<double>").alias("vec"), *extra)
    t = train.select(F.col(tkey).alias("tid"), F.col(vec).cast("array<double>").alias("vec"),
                     F.col(label).cast("long").alias("label"), *extra)
    nq, nt = counts if counts is not None else (q.count(), t.count())
    block_rows = block_rows or _rows_of_blocks(t, nt)
    parts = len(groups) if groups else 1
    qb, tb = _block_counts(spark, math.ceil(nq / parts), math.ceil(nt / parts), block_rows)
    kinds = {f.name: f.dataType.simpleString() for f in [*q.schema.fields, *t.schema.fields]}
    schema = f"qid {kinds['qid']}, metric string, tid {kinds['tid']}, tlabel long, dist double"
    masked = bool(exclude_same) and not groups
    pairs = qb * tb * parts * max(1, parts - 1)
    w = Window.partitionBy("qid", "metric").orderBy("dist", "tid")
    if math.ceil(nq / block_rows) * math.ceil(nt / block_rows) >= prune_from:
        from cascara.operators.knn_pruned import pruned_pairs

        if not exclude_same:
            q, t = q.withColumn("grp", F.lit(None).cast("int")), t.withColumn("grp", F.lit(None).cast("int"))
        found = []
        for m in metrics:
            seen = None if report is None else report.setdefault(m, {})
            found.append(pruned_pairs(
                q, t, k, m, _topk_block(k, [m], masked, decimals), schema, groups=groups, block_rows=block_rows,
                n_train=math.ceil(nt / parts), decimals=decimals, report=seen))
        per_block = reduce(DataFrame.unionByName, found)
        return per_block.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    def others(column: str):
        """The groups that a row meets: all but its own."""
        if not groups:
            return F.lit(0)
        return F.explode(F.array_except(F.array(*map(F.lit, groups)), F.array(column)))

    own = F.col("grp") if groups else F.lit(0)
    q_rep = (q.withColumn("qg", own).withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(qb)).cast("int"))
             .withColumn("tg", others("grp")).withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(tb - 1)))))
    t_rep = (t.withColumn("tg", own).withColumn("tb", F.pmod(F.xxhash64("tid"), F.lit(tb)).cast("int"))
             .withColumn("qg", others("grp")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))))
    # The replicated blocks are few bytes but heavy compute: an explicit partition count, set by the cluster's size and
    # not by the number of block pairs, keeps adaptive execution from coalescing them into a couple of tasks.
    tasks = min(pairs, 4 * spark.sparkContext.defaultParallelism)
    key = ["qg", "qb", "tg", "tb"]
    per_block = (q_rep.repartition(tasks, *key).groupBy(*key).cogroup(t_rep.repartition(tasks, *key).groupBy(*key))
                 .applyInArrow(_topk_block(k, metrics, masked, decimals), schema))
    return per_block.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---------------------------------------------------------------------------------------------------------------
# voting, grid search, metrics


def knn_vote(neigh: DataFrame, ks: Sequence[int] = (3, 5, 7), weights: Sequence[str] = WEIGHTS) -> DataFrame:
    """``(qid, metric, n_neighbors, weights, pred)`` from ranked neighbours, for every (k, weights) at once.

    uniform: one vote each; distance: 1/d, and when some neighbours are at distance 0 only those vote. The class
    with the largest total wins; ties go to the smallest class.
    """
    n = (neigh.withColumn("n_neighbors", F.explode(F.array(*[F.lit(int(x)) for x in ks])))
         .where(F.col("rank") <= F.col("n_neighbors"))
         .withColumn("weights", F.explode(F.array(*[F.lit(w) for w in weights]))))
    wz = Window.partitionBy("qid", "metric", "n_neighbors", "weights")
    n = n.withColumn("__min", F.min("dist").over(wz))
    w = (F.when(F.col("weights") == "uniform", F.lit(1.0))
         .when(F.col("__min") == 0, F.when(F.col("dist") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
         .otherwise(F.lit(1.0) / F.col("dist")))
    scores = n.groupBy("qid", "metric", "n_neighbors", "weights", "tlabel").agg(F.sum(w).alias("score"))
    best = scores.groupBy("qid", "metric", "n_neighbors", "weights").agg(
        F.max(F.struct(F.col("score"), (-F.col("tlabel")).alias("neg"))).alias("__b"))
    return best.select("qid", "metric", "n_neighbors", "weights", (-F.col("__b.neg")).alias("pred"))


def grid_index(metric: F.Column, k: F.Column, weights: F.Column, ks: Sequence[int] = (3, 5, 7)) -> F.Column:
    """Position of a candidate in the search grid (keys sorted: metric, n_neighbors, weights; values as given)."""
    mi = F.when(metric == METRICS[0], 0).otherwise(1)
    ki = F.array_position(F.array(*[F.lit(int(x)) for x in ks]), k) - 1
    wi = F.when(weights == WEIGHTS[0], 0).otherwise(1)
    return (mi * len(ks) * 2 + ki * 2 + wi).cast("int")


def cv_scores(preds: DataFrame, truth: DataFrame, *, qkey: str, label: str, fold: str) -> DataFrame:
    """``(metric, n_neighbors, weights, fold, accuracy)`` per candidate and fold."""
    t = truth.select(F.col(qkey).alias("qid"), F.col(label).cast("long").alias("y"),
                     F.col(fold).alias("fold"))
    return (preds.join(t, "qid")
            .groupBy("metric", "n_neighbors", "weights", "fold")
            .agg(F.avg((F.col("pred") == F.col("y")).cast("double")).alias("accuracy")))


def grid_summary(fold_scores: DataFrame, ks: Sequence[int] = (3, 5, 7)) -> DataFrame:
    """``(metric, n_neighbors, weights, mean_score, rank_test_score, grid_index)``: mean over folds, ranked (ties
    share the smallest rank, as the reference grid search does)."""
    m = fold_scores.groupBy("metric", "n_neighbors", "weights").agg(F.avg("accuracy").alias("mean_score"))
    w = Window.orderBy(F.round("mean_score", 9).desc())  # one row per candidate: a dozen rows
    return m.withColumn("rank_test_score", F.rank().over(w)).withColumn(
        "grid_index", grid_index(F.col("metric"), F.col("n_neighbors"), F.col("weights"), ks))


def best_candidate(summary: DataFrame) -> DataFrame:
    """The winning row: best rank, then first in grid order (the top-1 is the feature here)."""
    return summary.orderBy("rank_test_score", "grid_index").limit(1)


def confusion_matrix(pairs: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """``(y, pred, n)``."""
    return pairs.groupBy(F.col(y).alias("y"), F.col(p).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def class_report(pairs: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """Per-class precision, recall, f1 and support, plus macro and weighted averages (zero division → 0).

    Every (truth, prediction) pair contributes one row to its true class (support, hit) and one to its predicted
    class (predicted count); a single grouped aggregate gives all per-class counts — no join of truth and
    prediction tables. The averages aggregate that per-class table (one row per class).
    """
    both = pairs.select(F.explode(F.array(
        F.struct(F.col(y).alias("cls"), F.lit(1).alias("sup"), (F.col(y) == F.col(p)).cast("int").alias("tp"),
                 F.lit(0).alias("np")),
        F.struct(F.col(p).alias("cls"), F.lit(0).alias("sup"), F.lit(0).alias("tp"), F.lit(1).alias("np")),
    )).alias("r")).select("r.*")
    cls = both.groupBy("cls").agg(F.sum("sup").alias("support"), F.sum("tp").alias("tp"), F.sum("np").alias("npred"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = cls.select(F.col("cls").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                     F.col("support").cast("long").alias("support"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), tot.alias("support"), F.avg("f1").alias("f1"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"), tot.alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"))
    return per.unionByName(macro).unionByName(weighted)


def accuracy(pairs: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """One row: ``accuracy``, ``n``."""
    return pairs.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))
