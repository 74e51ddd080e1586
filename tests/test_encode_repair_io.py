"""Encoders, fuzzy repair against brute force, sources/sinks and streaming ingest."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cascara.operators import encode as E
from cascara.operators.repair import fuzzy_repair, repair_map
from cascara.plans import churn as P
from cascara.sources import files as IO
from cascara.sources.churn import CHURN_SCHEMA


def test_one_hot_unseen_is_zero_and_null_category(spark):
    fit = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    m = E.one_hot_fit(fit, ["c"])
    assert m.names() == ["c_a", "c_b", "c_None"]
    got = m.transform(spark.createDataFrame([("z",), ("a",), (None,)], "c string")).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)]


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    got = E.minmax_fit(df, ["x", "k"]).transform(df).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (1.0, 0.0)]


def test_string_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    m = E.string_indexer(df, ["s"])
    assert [r.value for r in m.labels.orderBy("index").collect()] == ["c", "a", "b"] and m.sizes == {"s": 3}
    with pytest.raises(Exception):
        m.transform(spark.createDataFrame([("zz",)], "s string")).collect()
    kept = m.transform(spark.createDataFrame([("zz",)], "s string"), handle_invalid="keep").first()
    assert kept.sIndexed == 3.0


def _lcs(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def _lev(a: str, b: str) -> int:
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@pytest.mark.parametrize("scorer", ["indel", "levenshtein"])
def test_repair_map_matches_brute_force(churn01, scorer):
    renamed = churn01.withColumnsRenamed(P.RENAMES)
    got = {(r.column, r.value): (r.fixed, r.score) for r in repair_map(renamed, P.REPAIR_VOCAB, scorer).collect()}
    for (col, value), (fixed, score) in got.items():
        best, best_s = None, -1.0
        for w in P.REPAIR_VOCAB[col]:
            if scorer == "indel":
                s = 100.0 if not value and not w else 200.0 * _lcs(value, w) / (len(value) + len(w))
            else:
                m = max(len(value), len(w))
                s = 100.0 if m == 0 else 100.0 * (m - _lev(value, w)) / m
            if s > best_s:
                best, best_s = w, s
        assert score == pytest.approx(best_s)
        assert fixed == (best if best_s >= 80 else None)
    # the planted typos
    assert got[("Partner", "Yess")][0] == ("Yes" if scorer == "indel" else None)
    assert got[("Gender", "Femal")][0] == "Female"


def test_repair_keeps_null_and_other_columns(spark):
    df = spark.createDataFrame([(1, "Mle"), (2, None), (3, "Female")], "id int, Gender string")
    out = {r.id: r.Gender for r in fuzzy_repair(df, {"Gender": P.GENDERS}, "indel").collect()}
    assert out == {1: "Male", 2: None, 3: "Female"}


def test_missing_source_raises(spark):
    with pytest.raises(IO.NoDataSourceError):
        IO.read_csv(spark, "/tmp/definitely/not/here.csv", CHURN_SCHEMA)
    with pytest.raises(IO.NoDataSourceError):
        IO.require_path(spark, "/tmp/definitely/not/here")
    assert IO.read_snapshot(spark, "/tmp/definitely/not/here") is None


def test_csv_blank_float_is_null_and_positional_binding(spark):
    d = tempfile.mkdtemp(prefix="cascara-csv-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("X,Y\nabc, \n")
    df = IO.read_csv(spark, d, "a string, b float")
    r = df.first()
    assert (r.a, r.b) == ("abc", None)


def test_first_file_skips_empty_marker(spark):
    d = tempfile.mkdtemp(prefix="cascara-land-")
    open(os.path.join(d, "_SUCCESS"), "w").close()
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("x\n1\n")
    rows = IO.first_file(spark, d).collect()
    assert len(rows) == 1 and rows[0].path.endswith("b.csv")


def test_stream_ingest_second_run_adds_nothing(spark, churn01):
    from cascara.session import scratch_path
    from cascara.streaming.ingest import ingest_landing, read_sink

    landing = scratch_path(spark, "t-landing")
    IO.write_csv(churn01, landing, partitions=4, key="customerID")
    sink, ckpt = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, P.clean, max_files_per_trigger=2)
    n1 = read_sink(spark, sink).count()
    ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, P.clean, max_files_per_trigger=2)
    assert read_sink(spark, sink).count() == n1 == 1278


def test_snapshot_publish_replaces(spark, churn01):
    from cascara.session import scratch_path

    t = scratch_path(spark, "t-snap")
    IO.publish_snapshot(churn01.limit(5), t)
    IO.publish_snapshot(IO.read_snapshot(spark, t).limit(2), t)  # new data may read the old snapshot
    assert IO.read_snapshot(spark, t).count() == 2


def test_parquet_scan_pushes_filters_and_prunes(spark):
    from cascara.catalog import QUERIES

    plan = QUERIES["parquet_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_discount), GreaterThanOrEqual(l_shipdate" in plan \
        or "GreaterThan(l_discount" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double," \
           "l_shipdate" in plan
    assert "l_partkey" not in plan and "l_returnflag" not in plan




def test_cardinality_guard_refuses_before_collecting(spark, monkeypatch):
    monkeypatch.setattr(E, "MAX_CATEGORIES", 5)
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError, match="not categorical"):
        E.one_hot_fit(df, ["k"])


def test_index_and_codes_of_many_categories(spark):
    df = spark.range(20_000).select(F.format_string("v%05d", "id").alias("k"))
    got = E.string_indexer(df, ["k"]).transform(df)
    assert got.where(F.col("kIndexed") != F.substring("k", 2, 5).cast("int")).count() == 0 and got.count() == 20_000
    codes = E.label_encode(df, "k")
    assert codes.where(F.col("k_code") != F.substring("k", 2, 5).cast("int")).count() == 0 and codes.count() == 20_000


def test_sparse_vectors_drop_the_last_label(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "aIndexed double")
    got = [tuple(r.aVector) for r in E.one_hot_sparse(df, {"aIndexed": 3}).orderBy("aIndexed").collect()]
    assert got == [(2, [0], [1.0]), (2, [], [])]


def test_bounds_and_scaling_skip_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert E.minmax_fit(df, ["x"]).bounds == {"x": (1.0, 3.0)}


def test_ingest_keeps_one_row_per_key_over_files_and_runs(spark, churn01):
    from cascara.session import scratch_path
    from cascara.streaming.ingest import ingest_landing, read_sink

    landing, sink, ckpt = (scratch_path(spark, f"k-{n}") for n in ("landing", "sink", "ckpt"))
    expected = P.clean(churn01)
    half = F.pmod(F.xxhash64(*churn01.columns), F.lit(2))
    for i in range(2):  # rows of one key lie in files of both runs
        churn01.where(half == i).repartition(3).write.mode("append").option("header", True).csv(landing)
        ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, P.clean, max_files_per_trigger=1)
    got = read_sink(spark, sink)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_names_and_literals_with_special_characters(spark):
    from cascara.operators import clean as C
    from cascara.operators.profile import schema_profile, value_counts

    df = spark.createDataFrame([("a\\b", 1.0), ("it's", 2.0), ("bad", 3.0), ("z", None)], "`x.y` string, `o'k` double")
    rule = C.domain_rule("d", "x.y", ["a\\b", "it's", "z"])
    assert sorted(r[0] for r in C.reject(df, rule).collect()) == ["a\\b", "it's", "z"]
    assert value_counts(df).count() == 7
    assert [r["column"] for r in schema_profile(df).orderBy("position").collect()] == ["x.y", "o'k"]


def test_csv_corrupt_record_column_keeps_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="cascara-bad-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("a,n\nok,1\nbad,notanumber\n")
    rows = {r.a: r for r in IO.read_csv(spark, d, "a string, n int", corrupt_column="_bad").collect()}
    assert rows["ok"]._bad is None and rows["ok"].n == 1
    assert rows["bad"].n is None and rows["bad"]._bad == "bad,notanumber"
