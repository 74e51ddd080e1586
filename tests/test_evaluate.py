"""Split, folds, blocked k-NN against brute force, voting rules, metrics edge cases, plan shape."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascara.operators import evaluate as EV


@pytest.fixture(scope="module")
def emb(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))


def test_split_and_folds_are_disjoint_and_complete(emb):
    s = EV.train_test_split(emb, "vec_id")
    n, n_test = s.count(), s.where("is_test").count()
    assert n_test == int(np.ceil(0.2 * n))
    folds = EV.stratified_folds(s.where(~F.col("is_test")), "vec_id", "label", 3).cache()
    assert folds.count() == n - n_test
    assert folds.select("vec_id").distinct().count() == n - n_test
    per = folds.groupBy("label", "fold").count().toPandas().pivot(index="label", columns="fold", values="count")
    assert ((per.max(axis=1) - per.min(axis=1)) <= 1).all()


def test_folds_equal_global_rank(emb):
    """The bucket-offset rank equals a plain per-label row_number in hash order."""
    from pyspark.sql import Window

    got = EV.stratified_folds(emb, "vec_id", "label", 3)
    w = Window.partitionBy("label").orderBy(EV.hash_of("vec_id", 42), "vec_id")
    ref = emb.withColumn("fold", ((F.row_number().over(w) - 1) % 3).cast("int"))
    assert got.select("vec_id", "fold").exceptAll(ref.select("vec_id", "fold")).count() == 0


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_knn_matches_brute_force(emb, block_rows):
    pdf = emb.toPandas()
    X = np.stack(pdf.embedding.to_numpy())
    ids = pdf.vec_id.to_numpy()
    q = emb.where(F.col("vec_id") % 5 == 0)  # a query subset only in this unit test; the train side is whole
    got = EV.knn_neighbours(q, emb, 3, qkey="vec_id", tkey="vec_id", vec="embedding", label="label",
                            block_rows=block_rows).toPandas()
    for metric in ("euclidean", "manhattan"):
        for qi in ids[ids % 5 == 0][:20]:
            xq = X[ids == qi][0]
            d = np.sqrt(((X - xq) ** 2).sum(1)) if metric == "euclidean" else np.abs(X - xq).sum(1)
            order = np.lexsort((ids, d))[:3]
            sub = got[(got.qid == qi) & (got.metric == metric)].sort_values("rank")
            assert list(sub.tid) == list(ids[order])
            assert np.allclose(sub.dist.to_numpy(), d[order])


def test_fold_exclusion(emb):
    f = EV.stratified_folds(emb, "vec_id", "label", 3)
    n = EV.knn_neighbours(f, f, 5, qkey="vec_id", tkey="vec_id", vec="embedding", label="label",
                          exclude_same="fold", block_rows=64)
    fold = f.select(F.col("vec_id").alias("k"), "fold")
    j = n.join(fold.withColumnRenamed("k", "qid"), "qid").join(
        fold.withColumnRenamed("k", "tid").withColumnRenamed("fold", "tfold"), "tid")
    assert j.where(F.col("fold") == F.col("tfold")).count() == 0


def test_vote_zero_distance_and_ties(spark):
    n = spark.createDataFrame(
        [(1, "euclidean", 1, 10, 2, 0.0), (1, "euclidean", 2, 11, 1, 0.5), (1, "euclidean", 3, 12, 1, 0.6),
         (2, "euclidean", 1, 10, 3, 1.0), (2, "euclidean", 2, 11, 2, 1.0)],
        "qid long, metric string, rank int, tid long, tlabel long, dist double")
    got = {(r.qid, r.n_neighbors, r.weights): r.pred for r in EV.knn_vote(n, [2, 3]).collect()}
    assert got[(1, 3, "uniform")] == 1       # majority
    assert got[(1, 3, "distance")] == 2      # only the zero-distance neighbour votes
    assert got[(2, 2, "uniform")] == 2       # tie → smallest class
    assert got[(2, 2, "distance")] == 2


def test_class_report_zero_division(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y long, pred long")
    rep = {r["class"]: r for r in EV.class_report(pairs).collect()}
    assert rep["2"].precision == 0.0 and rep["2"].recall == 0.0 and rep["2"].f1 == 0.0
    assert rep["1"].precision == pytest.approx(1 / 3) and rep["1"].recall == 1.0
    assert rep["macro avg"].support == 4


def test_knn_plan_uses_group_limit_and_no_cross_join(emb):
    n = EV.knn_neighbours(emb, emb, 5, qkey="vec_id", tkey="vec_id", vec="embedding", label="label")
    plan = n._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "FlatMapCoGroupsInArrow" in plan or "FlatMapCoGroupsInPandas" in plan
    opt = n._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in opt or "WindowGroupLimit" in plan


def test_package_is_shipped_to_python_workers(spark, emb):
    from cascara.session import ship_package

    ship_package(spark)
    assert any("cascara-" in p and p.endswith(".zip") for p in spark.sparkContext._python_includes)


def _clustered(spark, n=1500, dim=6):
    rng = np.random.default_rng(5)
    centres = rng.uniform(-50, 50, (25, dim))
    x = centres[rng.integers(0, 25, n)] + rng.normal(0, 0.4, (n, dim))
    x[: n // 3] = x[0]  # a third of all rows are one point
    x[n - 1] = 4000.0  # and one lies far from all
    rows = [(f"k{i:05d}", [float(v) for v in r], i % 4, i % 3) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "id string, vec array<double>, label int, fold int")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_pruned_neighbours_equal_brute_force(spark, metric):
    x, df = _clustered(spark)
    report = {}
    args = dict(qkey="id", tkey="id", metrics=[metric], block_rows=64)
    got = EV.knn_neighbours(df, df, 5, prune_from=0, report=report, **args).toPandas()
    r = report[metric]
    assert r["formed"] < 0.35 * r["query_blocks"] * r["train_blocks"]
    d = EV._distances(x, x, [metric])[metric]
    order = np.stack([np.lexsort((np.arange(len(x)), row))[:5] for row in d])
    got = got.sort_values(["qid", "rank"])
    assert got.tid.tolist() == [f"k{i:05d}" for i in order.ravel()]
    assert np.allclose(got.dist.to_numpy(), np.take_along_axis(d, order, 1).ravel())


@pytest.mark.parametrize("column", ["fold", "vec_class"])
def test_pruned_neighbours_leave_out_own_group(spark, column):
    """Few groups (blocks cut by group) and many (masked in the kernel) agree with the nested loop."""
    _, df = _clustered(spark, 500)
    df = df.withColumn("vec_class", F.substring("id", 5, 2))
    args = dict(qkey="id", tkey="id", block_rows=64, exclude_same=column, metrics=["manhattan"])
    got, want = (sorted(map(tuple, EV.knn_neighbours(df, df, 4, prune_from=n, **args).collect())) for n in (0, 10**9))
    assert got == want and len(got) == 500 * 4


def test_folds_keep_rows_without_a_label(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3).cast("int").alias("label"))
    got = EV.stratified_folds(df, "id", "label", 3)
    assert got.count() == 30 and got.columns == ["id", "label", "fold"]
    sizes = got.groupBy("label", "fold").count().collect()
    assert {r["label"] for r in sizes} == {None, 1, 2} and max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 1


def test_split_has_the_exact_size(spark):
    for n in (1, 4, 35, 1001):
        df = spark.range(n).select(F.col("id").cast("string").alias("k"))
        got = EV.train_test_split(df, "k")
        assert got.where("is_test").count() == int(np.ceil(0.2 * n)) and got.count() == n
    keyless = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert EV.train_test_split(keyless, "k").where("is_test is null").count() == 0
    assert EV.train_test_split(keyless.limit(0), "k").count() == 0 and not EV.train_test_split(keyless, "k", 0.0).where("is_test").count()


def _vectors(kind, n, rng):
    if kind == "one-hot":
        return np.column_stack([rng.integers(0, 2, (n, 12)), rng.integers(0, 100, (n, 2)) / 100]).astype(float)
    if kind == "far from zero":
        return rng.normal(size=(n, 8)) + 1e9
    if kind == "lattice":
        return rng.integers(0, 4, (n, 6)).astype(float)
    x = rng.normal(size=(n, 16))
    if kind == "copies":
        return x[rng.integers(0, n // 9, n)]
    if kind == "outliers":
        x[::97] *= 1e6
    return x


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("kind", ["spread", "one-hot", "far from zero", "lattice", "copies", "outliers"])
def test_bounded_kernel_equals_the_full_matrix(kind, metric):
    """Same neighbours and bits as the full distance matrix, ties, left out pairs and limits included; most of the matrix is
    never computed where vectors are spread."""
    from cascara.operators.knn_kernel import nearest

    rng = np.random.default_rng(3)
    t = _vectors(kind, 1500, rng)
    q = np.concatenate([t[:40], _vectors(kind, 260, rng)])
    group_q, group_t = np.arange(len(q)) % 3, np.arange(len(t)) % 3
    cells = []

    def matrix(a, b):
        cells.append(len(a) * len(b))
        return EV._distances(a, b, [metric])[metric]

    for same in (None, lambda r, c: group_q[r] == group_t[c]):
        d = np.round(EV._distances(q, t, [metric])[metric], 9)
        if same is not None:
            d[group_q[:, None] == group_t[None, :]] = np.inf
        order = np.stack([np.lexsort((np.arange(len(t)), row))[:5] for row in d])
        want = np.take_along_axis(d, order, 1)
        for limit in (None, want[:, -1]):
            cells.clear()
            r, c, dist = nearest(q, t, 5, metric, 9, same, matrix, limit)
            assert (r == np.repeat(np.arange(len(q)), 5)).all()
            assert (c.reshape(-1, 5) == order).all() and (dist.reshape(-1, 5) == want).all()
            if kind == "spread":
                assert sum(cells) <= 0.1 * d.size


def test_blocks_do_not_grow_in_number(spark):
    """Rows are copied once per block of the other side: a larger table has larger blocks, not more of them."""
    t = spark.createDataFrame([([0.0] * 64,)], "vec array<double>")
    blocks = [n / EV._rows_of_blocks(t, n) for n in (50_000, 200_000, 1_000_000)]
    assert max(blocks) <= 64 and EV._rows_of_blocks(t, 10**9) == 16384
    wide = spark.createDataFrame([([0.0] * 8192,)], "vec array<double>")
    assert EV._rows_of_blocks(wide, 10**9) == 1024


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_rows_of_many_patterns_meet_few_blocks(spark, metric):
    """One-hot rows lie in corners, far from each other but at few distances from any pivot: boxes tell them apart. Infinite
    values, blocks with fewer than k rows and repeated keys change nothing."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 2, (2000, 7)), rng.uniform(size=(2000, 2)) / 4]).astype(float)
    x[6, 0] = np.inf
    rows = [(f"k{i % 1990:05d}", [float(v) for v in r], i % 4, i % 3 if i < 1900 else 3) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, vec array<double>, label int, fold int")
    args = dict(qkey="id", tkey="id", metrics=[metric], exclude_same="fold")
    report = {}
    got = sorted(map(tuple, EV.knn_neighbours(df, df, 4, block_rows=64, prune_from=0, report=report, **args).collect()))
    assert got == sorted(map(tuple, EV.knn_neighbours(df, df, 4, prune_from=10**9, **args).collect()))
    r = report[metric]
    assert r["formed"] < 0.4 * r["query_blocks"] * r["train_blocks"]


def test_tile_meets_only_near_leaves():
    """Inside a pair of blocks, too: of rows in 32 corners a tile computes bounds for a few corners alone."""
    from cascara.operators import knn_kernel

    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 2, (4000, 5)), rng.uniform(size=(4000, 1)) / 9]).astype(float)
    q = x[:2000]
    met = []

    class Counted(knn_kernel.Euclidean):
        def near(self, s, c, reach):
            met.append(len(self.q[s]) * self.t[:, c].shape[1])
            return super().near(s, c, reach)

    d = EV._distances(q, x, ["euclidean"])["euclidean"]
    with pytest.MonkeyPatch.context() as m:
        m.setitem(knn_kernel.BOUNDS, "euclidean", Counted)
        far = np.sort(d, axis=1)[:, 4]
        r, c, dist = knn_kernel.nearest(q, x, 5, "euclidean", None, None, lambda a, b: EV._distances(a, b, ["euclidean"])["euclidean"], far)
    assert (c.reshape(-1, 5) == np.stack([np.lexsort((np.arange(len(x)), row))[:5] for row in d])).all()
    assert sum(met) < 0.5 * d.size


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_copies_of_a_row_are_not_all_compared(metric):
    from cascara.operators.knn_kernel import nearest

    x, cells = np.ones((4000, 8)), []

    def matrix(a, b):
        cells.append(len(a) * len(b))
        return EV._distances(a, b, [metric])[metric]

    _, c, dist = nearest(x[:600], x, 5, metric, 9, None, matrix, None)
    assert (c.reshape(-1, 5) == np.arange(5)).all() and not dist.any()
    assert sum(cells) < 0.1 * 600 * 4000
