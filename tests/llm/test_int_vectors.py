"""Clusters by pivot bounds and codes by equal-average search, against plain arithmetic on Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascara.llm import equal_average, ptolemaic

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code string, cluster string"


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def vectors(spark, dim, n=90, big=False):
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i * 2, [c + rng.gauss(0, 0.2) for c in centres[i % 5]], i % 3 if i % 4 else None) for i in range(n)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (9, [0.0] * dim, 2), (11, [-0.0] * dim, None), (13, [0.5] * dim, 0)]
    rows += [(None, rows[5][1], 0), (1001, None, 1), (1003, [], 1), (1005, [float("nan")] * dim, 1), (1007, [None] + [0.0] * (dim - 1), 1), (1009, [float("inf")] * dim, 1), (1011, [0.1] * (dim + 1), 1)]
    if big:
        rows += [(2001, [3e5 + i for i in range(dim)], 1), (2003, [3e5 + 2 * i for i in range(dim)], 1)]
    return spark.createDataFrame([(i, v, l, "x", "y", "z") for i, v, l in rows], SCHEMA).repartition(4)


def usable(df, dim, scale):
    out = [(r["vec_id"], tuple(math.floor(scale * x) for x in r["embedding"]), r["label"]) for r in df.collect()
           if r["embedding"] is not None and len(r["embedding"]) == dim and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    return sorted(out, key=lambda r: (r[0] is None, r[0], r[1]))


def nearest(x, points):
    return min(range(len(points)), key=lambda c: (gap(x, points[c]), c))


def brute_clusters(rows, k, rounds):
    drawn = sorted((r for r in rows if r[0] is not None), key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    c = [list(r[1]) for r in (drawn + [r for r in rows if r[0] is None])[:k]]
    for turn in range(rounds + 1):
        at = [nearest(x, c) for _, x, _ in rows]
        if turn < rounds:
            for j in range(len(c)):
                own = [x for (_, x, _), a in zip(rows, at) if a == j]
                if own:
                    c[j] = [sum(col) // len(own) for col in zip(*own)]
    d = [gap(x, c[a]) for (_, x, _), a in zip(rows, at)]
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted((str(i), a, e, sum(f for f, b in zip(d, at) if a == b), sum(d), digest[a]) for (i, _, _), a, e in zip(rows, at, d))


def brute_codes(rows, parts, entries, rounds):
    size = len(rows[0][1]) // parts
    cut = [[x[p * size : (p + 1) * size] for _, x, _ in rows] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]
    for turn in range(rounds + 1):
        at = [[nearest(x, b) for x in c] for c, b in zip(cut, books)]
        if turn < rounds:
            for c, b, a in zip(cut, books, at):
                for j in range(len(b)):
                    own = [x for x, e in zip(c, a) if e == j]
                    if own:
                        b[j] = [sum(col) // len(own) for col in zip(*own)]
    error = [sum(gap(cut[p][n], books[p][at[p][n]]) for p in range(parts)) for n in range(len(rows))]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(str(r[0]), "".join(f"{at[p][n]:02x}" for p in range(parts)), error[n], sum(e for e, s in zip(error, rows) if s[2] == r[2]), digest) for n, r in enumerate(rows)]


@pytest.mark.parametrize("big", [False, True])
def test_clusters_equal_plain_rounds(spark, big):
    df = vectors(spark, 12, big=big)
    got = ptolemaic.cluster(df, dim=12, clusters=6, rounds=3, pivots=4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    rows = usable(df, 12, 64)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_clusters(rows, 6, 3)


@pytest.mark.parametrize("big", [False, True])
def test_codes_equal_plain_rounds(spark, big):
    df = vectors(spark, 12, big=big)
    got = equal_average.encode(df, parts=4, entries=20, rounds=3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = usable(df, 12, 1024)
    have = sorted((str(r[0]), *r[1:]) for r in got.where("code is not null").collect())
    assert have == sorted(brute_codes(rows, 4, 20, 3))
    assert sorted(r["vec_id"] for r in got.where("code is null").collect()) == [1003, 1011]  # of another length


@pytest.mark.parametrize("scale", [1, 2**20, 2**34, 2**70])
def test_searches_agree_with_all_distances(scale):
    """In float64, in long and in Python integers; with many ties, equal entries and far rows."""
    rng = np.random.default_rng(1)
    entries = (np.round(rng.normal(size=(40, 8)) * 3) * scale).tolist()
    entries = [[int(x) for x in e] for e in [*entries, *entries[:5]]]
    x = np.round(rng.normal(size=(300, 8)) * 4) * scale
    rows = [[int(v) for v in r] for r in x]
    want = [nearest(r, entries) for r in rows]
    index, distance, compared = equal_average.Search(entries).nearest(x)
    assert index.tolist() == want and [int(d) for d in distance] == [gap(r, entries[w]) for r, w in zip(rows, want)]
    pivots = ptolemaic.spread(entries, 5)
    index, distance, _ = ptolemaic.Search(entries, pivots).nearest(x, ptolemaic.distances(x, pivots))
    assert index.tolist() == want and [int(d) for d in distance] == [gap(r, entries[w]) for r, w in zip(rows, want)]


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (16, 64))
    x = (centres[rng.integers(0, 16, 2000)] + rng.integers(-9, 9, (2000, 64))).astype(float)
    centroids = centres.tolist()
    pivots = ptolemaic.spread(centroids, 8)
    search = ptolemaic.Search(centroids, pivots)
    low = search.bounds(ptolemaic.distances(x, pivots))
    true = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(2))
    assert (low <= true).all()
    assert search.nearest(x, ptolemaic.distances(x, pivots))[2] < 0.3 * low.size
    compared = equal_average.Search((x[:256, :16]).astype(int).tolist()).nearest(x[:, :16])[2]
    assert compared < 0.9 * len(x) * 256


def test_empty_and_tiny_tables(spark):
    none = vectors(spark, 12).where("vec_id = 1001")
    assert ptolemaic.cluster(none, dim=12).count() == 0 and equal_average.encode(none).count() == 0
    one = vectors(spark, 12).where("vec_id = 13")
    assert [tuple(r)[:5] for r in ptolemaic.cluster(one, dim=12).collect()] == [(13, 0, 0, 0, 0)]
    assert [tuple(r)[:4] for r in equal_average.encode(one).collect()] == [(13, "00000000", 0, 0)]
    with pytest.raises(ValueError):
        equal_average.encode(one, parts=5)
    same = one.union(one).union(one).withColumn("vec_id", F.lit(1).cast("long"))
    assert [r["cluster"] for r in ptolemaic.cluster(same, dim=12).collect()] == [0, 0, 0]
