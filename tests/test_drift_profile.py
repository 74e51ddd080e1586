"""Drift and profile: goldens on the churn fixture, PSI properties, NaN edge cases, exact quantiles."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascara.operators import drift as DR
from cascara.operators import profile as PR
from cascara.plans import churn as P


@pytest.fixture(scope="module")
def clean01(churn01):
    return P.clean(churn01).cache()


def _split(c):
    return c.where(F.col("Tenure") < 36), c.where(F.col("Tenure") >= 36)


def test_psi_goldens(clean01):
    b, c = _split(clean01)
    got = {r.feature: r.psi for r in DR.psi_categorical(b, c, ["Contract", "TotalCharges"]).collect()}
    assert round(got["Contract"], 6) == 0.003783
    assert round(got["TotalCharges"], 6) == 33.028227


def test_histogram_golden(clean01):
    b, c = _split(clean01)
    h = DR.histogram(b, c, ["MonthlyCharges"], 10, "count").orderBy("bin").collect()
    assert [r.n_cur for r in h] == [70, 60, 79, 66, 73, 64, 48, 71, 54, 47]


def test_describe_goldens(clean01):
    d = PR.describe_numeric(clean01, ["MonthlyCharges"]).first()
    assert (round(d.p25, 4), round(d.p50, 3), round(d.p75, 4)) == (22.8175, 46.185, 72.1025)
    assert round(d["std"], 5) == 28.67445


def test_psi_of_identical_is_zero_and_swap_symmetric(clean01):
    b, c = _split(clean01)
    same = DR.psi_categorical(b, b, ["Contract", "Gender"]).collect()
    assert all(abs(r.psi) < 1e-12 for r in same)
    ab = {r.feature: r.psi for r in DR.psi_categorical(b, c, ["Contract", "PaymentMethod"]).collect()}
    ba = {r.feature: r.psi for r in DR.psi_categorical(c, b, ["Contract", "PaymentMethod"]).collect()}
    for k in ab:
        assert math.isclose(ab[k], ba[k], rel_tol=1e-9)


def test_all_out_of_range_is_nan_and_no_refresh(clean01):
    b, c = _split(clean01)
    psi = {r.feature: r.psi for r in DR.psi_numeric(b, c, ["Tenure"], 10, "share").collect()}
    assert math.isnan(psi["Tenure"])
    g = DR.drift_score(b, c, [], ["Tenure"], mode="share").first()
    assert g.refresh is False


def test_empty_or_missing_baseline_forces_refresh(clean01):
    g = DR.drift_score(None, clean01, ["Contract"]).first()
    assert (g.total_psi, g.refresh) == (1.0, True)
    g2 = DR.drift_score(clean01.where("false"), clean01, ["Contract"]).first()
    assert (g2.total_psi, g2.refresh) == (1.0, True)


def test_gate_threshold(clean01):
    b, c = _split(clean01)
    assert DR.drift_score(b, c, ["Contract"], mode="values").first().refresh is False
    assert DR.drift_score(b, c, ["Contract", "TotalCharges"], mode="values").first().refresh is True


def test_exact_quantiles_match_numpy(spark):
    """Skewed, tied, tiny, log-spaced and extreme values, of both signs."""
    rng = np.random.default_rng(7)
    sets = {
        "mixed": np.concatenate([rng.exponential(5.0, 400), np.full(300, 2.5), rng.normal(0, 1e-3, 50), [1e6]]),
        "extreme": np.concatenate([rng.uniform(-1, 1, 300) * 1.7e308, [1.7e308, -1.7e308, 0.0, -0.0]]),
        "log": np.concatenate([10.0 ** rng.uniform(-300, 300, 200), -(10.0 ** rng.uniform(-320, 5, 200)), [5e-324, -5e-324]]),
        "one": np.array([4.0]),
        "infinite": np.array([float("-inf"), 1.0, 2.0, 3.0, float("inf")]),
    }
    df = spark.createDataFrame([(k, float(v)) for k, x in sets.items() for v in x] + [("mixed", None), ("mixed", float("nan"))], "feature string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = PR.exact_quantiles(df, probs)
    for k, x in sets.items():
        for p in probs if k != "infinite" else [0.0, 0.25, 0.5, 0.75, 1.0]:
            low, high = PR._around(len(x), p)
            s, part = np.sort(x), (len(x) - 1) * p - low
            want = float(s[low] if s[low] == s[high] else (1 - part) * s[low] + part * s[high] if part else s[low])
            assert got[(k, p)] == want or math.isclose(got[(k, p)], want, rel_tol=1e-12), (k, p)


def test_images_keep_the_order_of_doubles(spark):
    from cascara.operators.radix import double_of, image

    values = [s * 2.0**e * f for e in range(-1074, 1024, 7) for f in (1.0, 1.5, 1.9999999999999998, 0.9999999999999999) for s in (1, -1)]
    values += [2.0**e for e in range(-1074, 1024)] + [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), float("-inf")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", image(F.col("v")).alias("i")).collect()
    want = np.array([r.v for r in rows]) + 0.0
    bits = np.abs(want).view(np.int64) * np.where(want < 0, -1, 1)
    assert [r.i for r in rows] == bits.tolist() and [double_of(r.i) for r in rows] == want.tolist()
    nan = spark.createDataFrame([(float("nan"),), (None,)], "v double").select(image(F.col("v")).alias("i")).collect()
    assert [r.i for r in nan] == [None, None]


def test_quantiles_take_five_aggregates_at_most(spark, monkeypatch):
    """Whatever the values: evenly spread, log-spaced, or all but a few the same."""
    from cascara.operators import radix

    rounds = []
    real = F.min
    monkeypatch.setattr(radix.F, "min", lambda c: (rounds.append(1), real(c))[1])
    base = spark.range(4000).withColumn("feature", F.lit("x"))
    for value in (F.col("id").cast("double"), F.pow(F.lit(10.0), F.col("id") / 8 - 250), F.when(F.col("id") < 3990, 1.0).otherwise(F.col("id").cast("double")),
                  (F.col("id") - 2000) * 8.5e304):
        rounds.clear()
        PR.exact_quantiles(base.select("feature", value.alias("value")), [0.25, 0.5, 0.75])
        assert len(rounds) <= 5


def test_value_shares_exclude_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    got = {r.value: r.share for r in PR.value_shares(df, ["c"]).collect()}
    assert got == {"a": 2 / 3, "b": 1 / 3}


def test_hourly_psi_matches_long_form(spark):
    from cascara.streaming import hourly as H

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = ev.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp"))
    fast = {r.window_start: r.psi for r in H.hourly_psi(ev, base, "ts", "event_type").collect()}
    # brute force: full category union per hour in pandas
    pdf = ev.select("ts", "event_type").toPandas()
    bdf = base.select("event_type").toPandas()
    e = bdf.event_type.value_counts(normalize=True)
    pdf["h"] = pdf.ts.dt.floor("h")
    for h, g in list(pdf.groupby("h"))[:50]:
        a = g.event_type.value_counts(normalize=True)
        cats = set(a.index) | set(e.index)
        aa = np.array([a.get(k, 0.0) for k in cats])
        ee = np.array([e.get(k, 0.0) for k in cats])
        aa, ee = np.where(aa == 0, 1e-10, aa), np.where(ee == 0, 1e-10, ee)
        assert math.isclose(fast[h.to_pydatetime()], float(np.sum((aa - ee) * np.log(aa / ee))), rel_tol=1e-9)


def test_describe_approx_close_to_exact(clean01):
    exact = PR.describe_numeric(clean01, ["MonthlyCharges"]).first()
    approx = PR.describe_numeric(clean01, ["MonthlyCharges"], approx_accuracy=10000).first()
    assert approx["count"] == exact["count"] and approx["mean"] == exact["mean"]
    assert abs(approx.p50 - exact.p50) < 1.0


def test_drift_between_snapshot_and_new_table(spark, clean01):
    from cascara.session import scratch_path
    from cascara.sources import files as IO

    snap = scratch_path(spark, "t-drift-snap")
    IO.publish_snapshot(clean01.where(F.col("Tenure") < 36), snap)
    base = IO.read_snapshot(spark, snap)
    cur = clean01.where(F.col("Tenure") >= 36)
    via_snapshot = {r.feature: r.psi for r in DR.psi_features(base, cur, ["Contract"], ["MonthlyCharges"]).collect()}
    direct = {r.feature: r.psi for r in DR.psi_features(
        clean01.where(F.col("Tenure") < 36), cur, ["Contract"], ["MonthlyCharges"]).collect()}
    assert via_snapshot.keys() == {"Contract", "MonthlyCharges"}
    for k in direct:
        assert math.isclose(via_snapshot[k], direct[k], rel_tol=1e-12)


def test_side_by_side_one_row_frames(spark):
    a = spark.createDataFrame([(3,)], "n_base long")
    b = spark.createDataFrame([(5,)], "n_current long")
    c = spark.createDataFrame([(0.25,)], "total_psi double")
    row = DR.side_by_side(a, b, c).first()
    assert (row.n_base, row.n_current, row.total_psi) == (3, 5, 0.25)
    plan = DR.side_by_side(a, b, c)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_bins_equal_numpy(spark):
    """Edge values, values outside the range, NaN, and a constant baseline."""
    import numpy as np

    base = [round(0.01 * (i % 11), 2) for i in range(500)] + [0.07] * 3
    cur = [0.03, 0.06, 0.07, 0.1, 0.0, -1.0, 0.2, 0.05, 0.0299999]
    for b, c in ((base, cur), ([5.0] * 4, [5.0, 4.0, 6.0]), ([1.0, 4.0, 2.5], [1.3, 1.6, 4.0])):
        got = DR.histogram(spark.createDataFrame([(float(x),) for x in [*b, float("nan")]], "x double"),
                           spark.createDataFrame([(float(x),) for x in c], "x double"), ["x"], 10, "count").orderBy("bin").collect()
        edges = np.linspace(min(b), max(b), 11)
        assert [r.n_base for r in got] == np.histogram(b, edges)[0].tolist()
        assert [r.n_cur for r in got] == np.histogram(c, edges)[0].tolist()


def test_nan_is_no_category(spark):
    b = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "x double")
    c = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert DR.psi_categorical(b, c, ["x"]).first().psi == 0.0


def test_describe_with_infinity_and_an_empty_column(spark):
    from cascara.operators.profile import describe_numeric

    df = spark.range(60_001).select(F.when(F.col("id") == 7, float("inf")).otherwise(F.col("id").cast("double")).alias("x"), F.lit(None).cast("double").alias("none"))
    got = {r.feature: r for r in describe_numeric(df).collect()}
    assert got["none"]["count"] == 0 and got["none"].p50 is None
    assert got["x"]["count"] == 60_001 and got["x"].p50 == 30_001.0 and got["x"].max == float("inf")


def test_image_is_computed_once_for_a_row(spark):
    """The image is one vectorised step of the plan: written out as arithmetic, it was repeated some hundred times wherever it was used."""
    from cascara.operators.radix import image

    df = spark.createDataFrame([(1.5,), (-0.0,), (None,), (float("-inf"),)], "v double").select(image(F.col("v")).alias("i"))
    counts = df.where("i is not null").groupBy((F.col("i") % 7).alias("d")).agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("lo"))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "POWER(" not in plan and "LOG2(" not in plan
    assert {r["i"] for r in df.collect()} == {0x3FF8 << 48, 0, None, -(0x7FF0 << 48)}
