"""Jobs that run again and again: ingest by key buckets and its recovery, late rows, kept snapshot versions, drift from
a stored summary."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cascara.operators import drift as DR
from cascara.plans import churn as P
from cascara.session import scratch_path
from cascara.sources import files as IO
from cascara.sources.churn import CHURN_SCHEMA
from cascara.streaming import hourly as H
from cascara.streaming import ingest as I
from cascara.streaming.manifest import folders, read_manifest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def churn(spark):
    from cascara.catalog.q_clean import raw

    return raw(spark, SF).cache()


def _same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def _land(rows, landing):
    rows.coalesce(1).write.mode("append").option("header", True).csv(landing)


def _job(spark, tag, transform=P.clean):
    landing, sink, ckpt = (scratch_path(spark, f"{tag}-{n}") for n in ("landing", "sink", "ckpt"))
    return landing, sink, lambda t=transform: I.ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, t, buckets=8)


def _fails(_):
    raise RuntimeError("no room")


def test_a_failure_between_files_and_publish_is_made_up_for(spark, churn, monkeypatch):
    half = F.pmod(F.xxhash64(*churn.columns), F.lit(2))
    landing, sink, run = _job(spark, "fail")
    _land(churn.where(half == 0), landing)
    with pytest.raises(RuntimeError):
        run(_fails)  # the stream has committed its batch, cleaning has failed
    assert I.read_sink(spark, sink) is None
    assert run() == 0  # no new batch, but the raw table is ahead of the manifest
    assert _same(I.read_sink(spark, sink), P.clean(churn.where(half == 0)))
    _land(churn.where(half == 1), landing)
    real = I._write_buckets
    with monkeypatch.context() as m:
        m.setattr(I, "_write_buckets", lambda rows, path: real(rows, path) if "/raw/" in path else _fails(rows))
        with pytest.raises(RuntimeError):
            run()  # the cleaned buckets cannot be written
    with monkeypatch.context() as m:
        m.setattr(I, "write_manifest", lambda *a: _fails(a))
        with pytest.raises(RuntimeError):
            run()  # they are written, but the manifest is not switched
    assert _same(I.read_sink(spark, sink), P.clean(churn.where(half == 0)))  # the old state, whole
    assert run() == 0 and _same(I.read_sink(spark, sink), P.clean(churn))


def test_a_failure_inside_a_batch_is_replayed(spark, churn, monkeypatch):
    landing, sink, run = _job(spark, "replay")
    _land(churn, landing)
    real = I._write_buckets

    def half_written(rows, path):
        real(rows.limit(20), path)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(I, "_write_buckets", half_written)
        with pytest.raises(Exception):
            run()
    assert run() == 1 and _same(I.read_sink(spark, sink), P.clean(churn))


def test_only_touched_buckets_are_cleaned_again(spark, churn):
    landing, sink, run = _job(spark, "touch")
    _land(churn, landing)
    run()
    before = read_manifest(spark, f"{sink}/MANIFEST")["clean"]
    reader = I.read_sink(spark, sink)
    key = churn.where("customerID is not null").first()["customerID"]
    again = churn.where(F.col("customerID") == key).withColumn("tenure", F.lit(0).cast(CHURN_SCHEMA["tenure"].dataType))
    _land(again, landing)
    seen = []
    run(lambda rows: (seen.append({r[0].split("bucket=")[1].split("/")[0] for r in rows.select(F.input_file_name()).distinct().collect()}), P.clean(rows))[1])
    after = read_manifest(spark, f"{sink}/MANIFEST")["clean"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert len(changed) <= 1 and len(before) > 4 and seen == [{str(r[0]) for r in again.select(I.bucket_of("customerID", 8)).distinct().collect()}]
    assert _same(I.read_sink(spark, sink), P.clean(churn.unionByName(again)))
    assert reader.count() == P.clean(churn).count()  # the replaced bucket is still there for an open reader
    assert I.publish(spark, CHURN_SCHEMA, sink, P.clean, "CustomerID") == []


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_any_order_of_files_gives_the_batch_chain(spark, churn, order):
    landing, sink, run = _job(spark, "order")
    part = F.pmod(F.xxhash64(*churn.columns), F.lit(3))
    for i in order:
        _land(churn.where(part == i), landing)
        run()
    assert _same(I.read_sink(spark, sink), P.clean(churn))
    empty_landing, empty_sink, empty_run = _job(spark, "empty")
    _land(churn.limit(0), empty_landing)
    empty_run()
    assert I.read_sink(spark, empty_sink) is None or I.read_sink(spark, empty_sink).count() == 0


def test_late_rows_correct_closed_hours(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    base = ev.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp"))
    src, sink, ckpt = (scratch_path(spark, f"late-{n}") for n in ("src", "sink", "ckpt"))
    shares = H.baseline_shares(base, "event_type")
    assert H.read_counts(spark, sink) is None and H.streamed_psi(spark, sink, shares).count() == 0
    part = F.pmod(F.xxhash64("ts"), F.lit(3))
    for i in (2, 0, 1):
        ev.where(part == i).coalesce(1).write.mode("append").parquet(src)
        assert H.hourly_psi_stream(spark.readStream.schema(ev.schema).parquet(src), "ts", "event_type", sink, ckpt) == 1
        if i == 0:
            H.merge_counts(spark, sink)
            H.merge_counts(spark, sink)  # nothing more to merge
            assert not folders(spark, sink, "batch_id=") and len(folders(spark, sink, "merged-")) == 1
    want = {r.window_start: (r.n, round(r.psi, 9)) for r in H.hourly_psi(ev, base, "ts", "event_type").collect()}
    assert {r.window_start: (r.n, round(r.psi, 9)) for r in H.streamed_psi(spark, sink, shares).collect()} == want


def test_open_readers_finish_and_old_versions_go(spark):
    target = scratch_path(spark, "kept")
    IO.publish_snapshot(spark.range(10), target, beside=spark.range(1))
    reader, side = IO.read_snapshot(spark, target), IO.read_beside(spark, target)
    IO.publish_snapshot(spark.range(20), target)
    assert reader.count() == 10 and side.count() == 1 and IO.read_snapshot(spark, target).count() == 20
    assert IO.read_beside(spark, target) is None
    IO.publish_snapshot(spark.range(30), target, keep_ms=0)
    assert len(folders(spark, target, "version-")) == 1 and not folders(spark, target, "beside-")
    assert IO.read_snapshot(spark, target).count() == 30


@pytest.mark.parametrize("mode", ["values", "share", "density"])
def test_drift_from_a_summary_equals_drift_from_the_table(spark, churn, mode):
    clean = P.clean(churn).cache()
    b, c = clean.where(F.col("Tenure") < 36), clean.where(F.col("Tenure") >= 20)
    cat, num = ["Contract", "Gender"], ["MonthlyCharges", "Tenure"]
    path = scratch_path(spark, "summary")
    DR.baseline_summary(b, cat, num, mode).write.parquet(path)
    drift = DR.StoredDrift(spark.read.parquet(path), c, cat, num, mode)
    want = {r.feature: r.psi for r in DR.psi_features(b, c, cat, num, mode).collect()}
    got = {r.feature: r.psi for r in drift.psi().collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[f], want[f], rel_tol=1e-9) for f in want)
    mine, plain = drift.score().first(), DR.drift_score(b, c, cat, num, mode).first()
    assert (mine.n_base, mine.n_current, mine.refresh) == (plain.n_base, plain.n_current, plain.refresh)
    assert math.isclose(mine.total_psi, plain.total_psi, rel_tol=1e-9)
    nxt = drift.current_summary()
    if mode == "values":  # the next baseline comes out of the same scan
        assert _same(nxt, DR.baseline_summary(c, cat, num, mode))
    else:
        assert nxt is None
    nothing = DR.StoredDrift(DR.baseline_summary(b.limit(0), cat, num, mode), c, cat, num, mode).score().first()
    assert (nothing.n_base, nothing.total_psi, nothing.refresh) == (0, 1.0, True)


def test_refresh_reads_the_summary_and_not_the_snapshot(spark, churn, monkeypatch):
    from cascara.plans import refresh as R

    snapshot = scratch_path(spark, "job-snapshot")
    args = (["Contract"], ["MonthlyCharges"])
    assert R.refresh_job(spark, churn, scratch_path(spark, "cleaned"), snapshot, *args).first().refresh
    with monkeypatch.context() as m:
        m.setattr(IO, "read_snapshot", _fails)
        assert not R.refresh_job(spark, churn, scratch_path(spark, "cleaned"), snapshot, *args).first().refresh


def test_quarantine_keeps_every_line(spark, churn):
    from cascara.sources import quarantine as Q

    landing = scratch_path(spark, "q-landing")
    line = F.to_csv(F.struct(*churn.columns))
    broken = F.coalesce(F.substring("customerID", -1, 1).isin("1", "2"), F.lit(False))
    churn.select(F.when(broken, F.substring_index(line, ",", 4)).otherwise(line).alias("value")).coalesce(2).write.text(landing)
    target = Q.split_landing(spark, landing, CHURN_SCHEMA, [P.RULE_NUMERIC], scratch_path(spark, "q-verdicts"), P.CleanSpec().renames, header=False)
    bad, good = Q.quarantined(spark, target), Q.accepted(spark, target)
    rules = {r["rule"]: r["count"] for r in bad.groupBy("rule").count().collect()}
    assert rules["malformed"] == churn.where(broken).count() > 0 and set(rules) <= {"malformed", "invalid_numeric"}
    assert good.count() + bad.count() == churn.count()
    assert bad.where("source is null or line is null or source not like '%part-%'").count() == 0
    assert bad.where("rule = 'malformed' and size(split(line, ',')) = 4").count() == rules["malformed"]


def test_report_comes_from_the_run_that_writes(spark, churn):
    path = scratch_path(spark, "reported")
    report = {r.rule: r for r in P.clean_and_report(churn, path).collect()}
    assert report["invalid_numeric"].rows_out == spark.read.parquet(path).count() == P.clean(churn).count()
    assert _same(spark.read.parquet(path), P.clean(churn)) and report["distinct_rows"].rows_in == churn.count()


def test_profile_copies_no_rows(spark, churn):
    from cascara.operators.profile import schema_profile

    got = schema_profile(churn)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    want = {r.column: (r.n_rows, r.n_null) for r in schema_profile(churn, approx=True).collect()}
    assert {r.column: (r.n_rows, r.n_null) for r in got.collect()} == want
    assert schema_profile(churn.limit(0)).where("n_rows + n_null + n_distinct > 0").count() == 0


@pytest.mark.parametrize("scorer", ["levenshtein", "indel"])
@pytest.mark.parametrize("threshold", [80.0, 55.0, 0.0])
def test_near_pairs_lose_no_word(spark, scorer, threshold):
    """Equal to scoring the whole product."""
    import random

    from cascara.functions.text import SCORERS
    from cascara.operators import repair as R

    rng = random.Random(1)
    words = ["", "a", "No", "Yes", "No internet service", "Männer"] + ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(40)]
    values = words[:20] + ["yess", "No internt servce", "x", "Maenner"] + ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 13))) for _ in range(60)]
    v = spark.createDataFrame([("c", x) for x in sorted(set(values))], "column string, value string")
    w = spark.createDataFrame([("c", i, x) for i, x in enumerate(words)], "column string, pos int, choice string")
    score = SCORERS[scorer](F.col("value"), F.col("choice"))
    full = v.join(w, "column").where(score >= threshold).select("value", "pos")
    near = R.near_pairs(v, w, scorer, threshold)
    assert _same(near.where(score >= threshold).select("value", "pos"), full)
    if threshold == 80.0:
        assert near.count() < v.count() * w.count() / 3
