"""Profile queries on the cleaned churn table and on the driver's lineitem/orders tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.catalog import sql_churn as S
from cascara.catalog.q_clean import cleaned
from cascara.catalog.registry import query, table
from cascara.functions.columns import rounded
from cascara.operators import profile as PR

# Column names of the profiled tables.
CHURN_CAT = ["CustomerID", "Gender", "SeniorCitizen", "Partner", "Dependents", "Tenure", "PhoneService",
             "MultipleLines", "InternetService", *S.ADDONS, "Contract", "PaperlessBilling", "PaymentMethod", "Churn"]
CHURN_NUM = ["Tenure", "MonthlyCharges", "TotalCharges"]
LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDERS_CAT = ["o_orderstatus", "o_orderpriority", "o_custkey"]


def _vc_sql(rel: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {rel} WHERE {c} IS NOT NULL "
        f"GROUP BY {c}" for c in cols)


@query("value_counts_all", S.with_chain(_vc_sql("clean", CHURN_CAT)))
def q_value_counts_all(spark, sf):
    return PR.value_counts(cleaned(spark, sf), CHURN_CAT)


@query("value_counts_ranked", S.with_chain(
    f"SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS rank FROM ({_vc_sql('clean', CHURN_CAT)}) v"))
def q_value_counts_ranked(spark, sf):
    """Value counts per column in descending order, as a rank."""
    return PR.value_counts_ranked(cleaned(spark, sf), CHURN_CAT)


_RAW_NUM = ["MonthlyCharges", "TotalCharges"]


@query("value_counts_nan", S.with_chain(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM raw "
    f"WHERE {c} IS NOT NULL AND NOT isnan({c}) AND {c} = floor({c}) GROUP BY {c}" for c in _RAW_NUM)))
def q_value_counts_nan(spark, sf):
    """Value counts of the raw charges, which hold NaN: a missing value, not a category (whole amounts only, whose
    text is the same in both engines)."""
    from cascara.catalog.q_clean import raw

    whole = raw(spark, sf).select(*[F.when((F.col(c) == F.floor(c)) | F.isnan(c), F.col(c)).alias(c) for c in _RAW_NUM])
    return PR.value_counts(whole, _RAW_NUM)


@query("minmax_bounds_nan", S.with_chain(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, min(CAST({c} AS DOUBLE)) FILTER (WHERE NOT isnan({c})) AS min, "
    f"max(CAST({c} AS DOUBLE)) FILTER (WHERE NOT isnan({c})) AS max FROM raw" for c in _RAW_NUM)))
def q_minmax_bounds_nan(spark, sf):
    """Bounds of the raw charges: NaN is neither the least nor the greatest value."""
    from cascara.catalog.q_clean import raw

    return PR.minmax_bounds(raw(spark, sf), _RAW_NUM)


@query("value_counts_orders", _vc_sql("orders", ORDERS_CAT))
def q_value_counts_orders(spark, sf):
    return PR.value_counts(table(spark, sf, "orders"), ORDERS_CAT)


@query("value_shares", S.with_chain(
    f"SELECT \"column\", value, n, round(n / sum(n) OVER (PARTITION BY \"column\"), 6) AS share "
    f"FROM ({_vc_sql('clean', CHURN_CAT)}) v"))
def q_value_shares(spark, sf):
    return PR.value_shares(cleaned(spark, sf), CHURN_CAT).withColumn("share", rounded(F.col("share")))


def _describe_sql(rel: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, "
        f"round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, "
        f"round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {rel}) t WHERE x IS NOT NULL AND NOT isnan(x)" for c in cols)


def _round_describe(df):
    return df.select("feature", "count", *[rounded(F.col(c)).alias(c)
                                           for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@query("describe_numeric", S.with_chain(_describe_sql("clean", CHURN_NUM)))
def q_describe_numeric(spark, sf):
    return _round_describe(PR.describe_numeric(cleaned(spark, sf), CHURN_NUM))


@query("describe_lineitem", _describe_sql("lineitem", LINEITEM_NUM))
def q_describe_lineitem(spark, sf):
    return _round_describe(PR.describe_numeric(table(spark, sf, "lineitem"), LINEITEM_NUM))


_CLEAN_TYPES = [("CustomerID", "string"), ("Gender", "string"), ("SeniorCitizen", "boolean"),
                ("Partner", "boolean"), ("Dependents", "boolean"), ("Tenure", "int"), ("PhoneService", "boolean"),
                ("MultipleLines", "string"), ("InternetService", "string"),
                *[(c, "string") for c in S.ADDONS], ("Contract", "string"), ("PaperlessBilling", "boolean"),
                ("PaymentMethod", "string"), ("MonthlyCharges", "float"), ("TotalCharges", "float"),
                ("Churn", "boolean")]


@query("schema_profile", S.with_chain(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct FROM clean"
    for i, (c, t) in enumerate(_CLEAN_TYPES))))
def q_schema_profile(spark, sf):
    return PR.schema_profile(cleaned(spark, sf))


@query("minmax_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max FROM lineitem"
    for c in LINEITEM_NUM))
def q_minmax_bounds(spark, sf):
    return PR.minmax_bounds(table(spark, sf, "lineitem"), LINEITEM_NUM)


@query("row_count", S.with_chain("SELECT (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM clean) AS n_clean"))
def q_row_count(spark, sf):
    from cascara.catalog.q_clean import raw

    a = raw(spark, sf).agg(F.count(F.lit(1)).alias("n_raw"))
    b = cleaned(spark, sf).agg(F.count(F.lit(1)).alias("n_clean"))
    from cascara.operators.drift import side_by_side

    return side_by_side(a, b)


@query("preview", S.with_chain("SELECT * FROM clean ORDER BY CustomerID LIMIT 20"))
def q_preview(spark, sf):
    """``show()``: the first 20 rows by key (a top-k, the limit is the feature)."""
    return cleaned(spark, sf).orderBy("CustomerID").limit(20)
