"""Cleaning chain: golden stage counts, NULL semantics, filter form = EXCEPT form, idempotence, one scan report."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.operators import clean as C
from cascara.plans import churn as P


def test_golden_stage_counts(churn01):
    renamed = C.rename_columns(churn01, P.RENAMES)
    distinct = C.distinct_rows(renamed)
    keyed = C.dedup_by_key(distinct, P.KEY, P.DEDUP_ORDER)
    req = C.drop_missing(keyed, P.REQUIRED)
    counts = [churn01.count(), distinct.count(), keyed.count(), req.count()]
    df = req
    for rule in P.PRE_FILL_RULES:
        df = C.reject(df, rule)
        counts.append(df.count())
    counts.append(P.clean(churn01).count())
    assert counts == [1550, 1520, 1485, 1417, 1397, 1380, 1354, 1322, 1320, 1278]


def test_rule_report_equals_chained_losses(churn01):
    rep = {r["rule"]: r["rows_removed"] for r in C.rule_report(P.required_stage(churn01), P.PRE_FILL_RULES).collect()}
    assert rep == {"child_phone": 20, "child_internet": 17, "domain_senior": 26, "missing_phone": 32,
                   "missing_internet": 2}


def test_null_predicate_keeps_row(spark):
    df = spark.createDataFrame([("No", None), ("No", "Yes"), ("No", "No phone service"), (None, "Yes")],
                               "PhoneService string, MultipleLines string")
    kept = C.reject(df, P.RULE_CHILD_PHONE).collect()
    assert sorted((r[0] or "", r[1] or "") for r in kept) == [("", "Yes"), ("No", ""), ("No", "No phone service")]


def test_filter_form_equals_subtract_form(churn01):
    keyed = P.dedup_stage(churn01)
    for rule in P.ALL_RULES:
        a = C.reject(keyed, rule)
        b = C.reject_by_subtract(keyed, rule)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_clean_is_idempotent_on_string_stage(churn01):
    once = P.clean_strings(churn01)
    spec = P.CleanSpec(renames={})
    twice = P.clean_strings(once, spec)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_dedup_survivor_is_smallest_by_order(spark):
    df = spark.createDataFrame([("a", 5, "x"), ("a", 3, "y"), ("a", 3, "b"), (None, 1, "q"), (None, 0, "r")],
                               "k string, t int, g string")
    got = sorted((r.k or "", r.t, r.g) for r in C.dedup_by_key(df, "k", ["t", "g"]).collect())
    assert got == [("", 0, "r"), ("a", 3, "b")]


def test_dropna_drops_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert C.drop_missing(df, ["x"]).count() == 1


def test_bool_recode_null_is_false(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,), ("Yess",)], "Churn string")
    got = [r[0] for r in C.recode_booleans(df, {"Churn": "Yes"}).collect()]
    assert got == [True, False, False, False]


def test_cleaning_plan_has_no_python_and_two_exchanges(churn01):
    plan = P.clean(churn01)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    final = P.clean(churn01)
    final.count()
    assert "Exchange" in final._jdf.queryExecution().executedPlan().toString()


def test_domain_rule_on_orders(spark):
    from cascara.catalog.q_clean import ORDERS_STATUS

    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    kept = C.reject(o, ORDERS_STATUS)
    assert kept.where(F.col("o_orderstatus") == "P").count() == 0
    assert kept.count() == o.where(F.col("o_orderstatus").isin("F", "O")).count()
