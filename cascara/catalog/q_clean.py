"""Cleaning queries: projections, rules, the whole chain and its one-scan report."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.catalog import sql_churn as S
from cascara.catalog.registry import query, table
from cascara.operators import clean as C
from cascara.plans import churn as P
from cascara.sources.churn import churn_raw


def raw(spark, sf):
    return churn_raw(spark, table(spark, sf, "customer"))


def keyed(spark, sf):
    """Stage after rename → distinct → key dedup (still holds NULLs and NaNs)."""
    return P.dedup_stage(raw(spark, sf))


def required(spark, sf):
    return P.required_stage(raw(spark, sf))


def cleaned(spark, sf):
    return P.clean(raw(spark, sf))


@query("churn_raw", S.with_chain("SELECT * FROM raw"))
def q_churn_raw(spark, sf):
    return raw(spark, sf)


@query("rename_columns", S.with_chain("SELECT * FROM renamed"))
def q_rename(spark, sf):
    return C.rename_columns(raw(spark, sf), {**P.RENAMES, "not_a_column": "ignored"})


@query("distinct_rows", S.with_chain("SELECT * FROM dist"))
def q_distinct(spark, sf):
    return C.distinct_rows(C.rename_columns(raw(spark, sf), P.RENAMES))


@query("dedup_by_key", S.with_chain("SELECT * FROM keyed"))
def q_dedup(spark, sf):
    return keyed(spark, sf)


@query("dropna_required", S.with_chain("SELECT * FROM req"))
def q_dropna(spark, sf):
    return required(spark, sf)


# Single rules run on the key-dedup stage, where NULL and NaN values are still present: NULL predicates keep rows.
@query("rule_child_phone", S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_CHILD_PHONE)}"))
def q_rule_child_phone(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_CHILD_PHONE)


@query("rule_child_internet", S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_CHILD_INTERNET)}"))
def q_rule_child_internet(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_CHILD_INTERNET)


@query("rule_domain", S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_DOMAIN)}"))
def q_rule_domain(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_DOMAIN_SENIOR)


@query("rule_missing_phone", S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_MISSING_PHONE)}"))
def q_rule_missing_phone(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_MISSING_PHONE)


@query("rule_missing_internet", S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_MISSING_INTERNET)}"))
def q_rule_missing_internet(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_MISSING_INTERNET)


@query("rule_missing_internet_strict",
       S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_MISSING_INTERNET_STRICT)}"))
def q_rule_missing_internet_strict(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_MISSING_INTERNET_STRICT)


@query("reject_invalid_numeric", S.with_chain(f"SELECT * FROM keyed WHERE {S.keep(S.P_NUMERIC)}"))
def q_reject_numeric(spark, sf):
    return C.reject(keyed(spark, sf), P.RULE_NUMERIC)


@query("reject_by_subtract", S.with_chain(f"SELECT * FROM keyed EXCEPT SELECT * FROM keyed WHERE {S.P_CHILD_PHONE}"))
def q_reject_subtract(spark, sf):
    return C.reject_by_subtract(keyed(spark, sf), P.RULE_CHILD_PHONE)


@query("fill_child_single", S.with_chain(
    "SELECT * REPLACE (CASE WHEN PhoneService = 'No' THEN 'No phone service' ELSE MultipleLines END AS MultipleLines) "
    "FROM keyed"))
def q_fill_single(spark, sf):
    return C.fill_dependent(keyed(spark, sf), P.PHONE_PARENT, "No", P.PHONE_CHILDREN, P.NO_PHONE)


@query("fill_child_many", S.with_chain(
    "SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN InternetService = 'No' THEN 'No internet service' ELSE {c} END AS {c}" for c in S.ADDONS)
    + ") FROM keyed"))
def q_fill_many(spark, sf):
    return C.fill_dependent(keyed(spark, sf), P.INTERNET_PARENT, "No", P.INTERNET_CHILDREN, P.NO_INTERNET)


@query("bool_recode", S.with_chain(
    "SELECT * REPLACE (coalesce(SeniorCitizen = 1, false) AS SeniorCitizen, coalesce(Partner = 'Yes', false) AS "
    "Partner, coalesce(Dependents = 'Yes', false) AS Dependents, coalesce(PhoneService = 'Yes', false) AS "
    "PhoneService, coalesce(PaperlessBilling = 'Yes', false) AS PaperlessBilling, coalesce(Churn = 'Yes', false) "
    "AS Churn) FROM keyed"))
def q_bool_recode(spark, sf):
    return C.recode_booleans(keyed(spark, sf), P.BOOLEANS)


@query("clean_full", S.with_chain("SELECT * FROM clean"))
def q_clean_full(spark, sf):
    return cleaned(spark, sf)


@query("churn_by_contract", S.with_chain(
    "SELECT Contract, Churn, count(*) AS n FROM clean GROUP BY Contract, Churn"))
def q_churn_by_contract(spark, sf):
    return cleaned(spark, sf).groupBy("Contract", "Churn").agg(F.count(F.lit(1)).alias("n"))


_REPORT = [("distinct_rows", "renamed", "dist"), ("dedup_by_key", "dist", "keyed"), ("dropna_required", "keyed", "req"),
           ("child_phone", "req", "r1"), ("child_internet", "r1", "r2"), ("domain_senior", "r2", "r3"),
           ("missing_phone", "r3", "r4"), ("missing_internet", "r4", "r5"), ("invalid_numeric", "r5", "r6")]
_REPORT_SQL = S.with_chain(" UNION ALL ".join(
    f"SELECT {i} AS stage, '{n}' AS rule, (SELECT count(*) FROM {a}) AS rows_in, (SELECT count(*) FROM {a}) - "
    f"(SELECT count(*) FROM {b}) AS rows_removed, (SELECT count(*) FROM {b}) AS rows_out" for i, (n, a, b) in enumerate(_REPORT)))


@query("rule_report", _REPORT_SQL)
def q_rule_report(spark, sf):
    """Rows in, removed and out of every stage of the chain, from exact duplicates to the numeric rule."""
    return P.stage_report(raw(spark, sf))


@query("except_rows", S.with_chain(
    "SELECT CustomerID FROM renamed EXCEPT SELECT CustomerID FROM clean"))
def q_except_rows(spark, sf):
    """Customers present in the raw table but not in the cleaned one (two different frames)."""
    r = C.rename_columns(raw(spark, sf), P.RENAMES).select("CustomerID")
    return C.except_rows(r, cleaned(spark, sf).select("CustomerID"))


# Generic rule kinds on the driver's own tables.
ORDERS_STATUS = C.domain_rule("orders_status", "o_orderstatus", ["F", "O"])
LINEITEM_RANGE = C.range_rule("lineitem_discount", nonnegative=["l_discount"], lower=0.0, upper=0.05)


@query("rule_domain_orders",
       "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(o_orderstatus <> 'F' AND o_orderstatus <> 'O', false)")
def q_rule_domain_orders(spark, sf):
    return C.reject(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ORDERS_STATUS)


@query("rule_range_lineitem",
       "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT coalesce(l_discount < 0.0 OR l_discount > 0.05, false)")
def q_rule_range_lineitem(spark, sf):
    return C.reject(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), LINEITEM_RANGE)


@query("rule_report_lineitem",
       "SELECT 0 AS stage, 'lineitem_discount' AS rule, count(*) AS rows_in, "
       "count(*) FILTER (WHERE coalesce(l_discount < 0.0 OR l_discount > 0.05, false)) AS rows_removed, "
       "count(*) FILTER (WHERE NOT coalesce(l_discount < 0.0 OR l_discount > 0.05, false)) AS rows_out FROM lineitem")
def q_rule_report_lineitem(spark, sf):
    return C.rule_report(table(spark, sf, "lineitem"), [LINEITEM_RANGE])
