"""Drift queries: churn baseline (Tenure < 36) against current (Tenure >= 36), and lineitem before/after a ship date."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.catalog import sql_churn as S
from cascara.catalog import sql_drift as D
from cascara.catalog.q_clean import cleaned
from cascara.catalog.registry import query, table
from cascara.functions.columns import rounded, time_literal
from cascara.operators import drift as DR

# Every churn feature but the key and the target, and the lineitem columns.
FEATURES = ["Gender", "SeniorCitizen", "Partner", "Dependents", "Tenure", "PhoneService", "MultipleLines",
            "InternetService", *S.ADDONS, "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges",
            "TotalCharges"]
NUMERIC = ["Tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL = [f for f in FEATURES if f not in NUMERIC]
LI_CAT = ["l_returnflag", "l_linestatus"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CUT = "1998-01-01"

_SPLIT = "base AS (SELECT * FROM clean WHERE Tenure < 36), cur AS (SELECT * FROM clean WHERE Tenure >= 36)"
_LI_SPLIT = (f"lbase AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{LI_CUT}'), "
             f"lcur AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LI_CUT}')")


def split(spark, sf):
    c = cleaned(spark, sf)
    return c.where(F.col("Tenure") < 36), c.where(F.col("Tenure") >= 36)


def li_split(spark, sf):
    li = table(spark, sf, "lineitem")
    cut = time_literal(li, "l_shipdate", LI_CUT)
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


def _churn_sql(ctes: str, select: str) -> str:
    return S.with_chain("").rstrip() + f",\n{_SPLIT},\n{ctes}\n{select}"


def _psi_round(df):
    return df.select("feature", rounded(F.col("psi")).alias("psi"))


@query("distribution_align", _churn_sql(D.counts_ctes("base", "cur", CATEGORICAL), "SELECT feature, value, n_base, n_cur FROM cnt"))
def q_distribution_align(spark, sf):
    b, c = split(spark, sf)
    return DR.aligned_counts(b, c, CATEGORICAL)


@query("category_union", _churn_sql(
    "u AS (" + " UNION ".join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value FROM base WHERE {f} IS NOT NULL "
                               f"UNION SELECT '{f}', CAST({f} AS VARCHAR) FROM cur WHERE {f} IS NOT NULL"
                               for f in CATEGORICAL) + ")", "SELECT * FROM u"))
def q_category_union(spark, sf):
    b, c = split(spark, sf)
    return DR.category_union(b, c, CATEGORICAL)


@query("psi_values", _churn_sql(D.counts_ctes("base", "cur", FEATURES),
                                f"SELECT feature, round({D.psi_expr()}, 6) AS psi FROM sh GROUP BY feature"))
def q_psi_values(spark, sf):
    """Every feature scored value by value: the original job's effective behaviour."""
    b, c = split(spark, sf)
    return _psi_round(DR.psi_features(b, c, CATEGORICAL, NUMERIC, mode="values"))


def _hist_round(df):
    return df.select("feature", "bin", rounded(F.col("lo_edge")).alias("lo_edge"),
                     rounded(F.col("hi_edge")).alias("hi_edge"), "n_base", "n_cur",
                     rounded(F.col("e")).alias("e"), rounded(F.col("a")).alias("a"))


_HIST_SELECT = ("SELECT feature, bin, round(lo_edge, 6) AS lo_edge, round(hi_edge, 6) AS hi_edge, n_base, n_cur, "
                "round(e, 6) AS e, round(a, 6) AS a FROM hs")


@query("histogram_counts", _churn_sql(D.hist_ctes("base", "cur", NUMERIC, 10, "count"), _HIST_SELECT))
def q_histogram_counts(spark, sf):
    b, c = split(spark, sf)
    return _hist_round(DR.histogram(b, c, NUMERIC, 10, "count"))


@query("histogram_density", _churn_sql(D.hist_ctes("base", "cur", NUMERIC, 10, "density"), _HIST_SELECT))
def q_histogram_density(spark, sf):
    b, c = split(spark, sf)
    return _hist_round(DR.histogram(b, c, NUMERIC, 10, "density"))


@query("psi_density", _churn_sql(D.hist_ctes("base", "cur", NUMERIC, 10, "density"),
                                 f"SELECT feature, round({D.psi_expr()}, 6) AS psi FROM hs GROUP BY feature"))
def q_psi_density(spark, sf):
    b, c = split(spark, sf)
    return _psi_round(DR.psi_numeric(b, c, NUMERIC, 10, "density"))


@query("psi_share", _churn_sql(D.hist_ctes("base", "cur", NUMERIC, 10, "share"),
                               f"SELECT feature, round({D.psi_expr()}, 6) AS psi FROM hs GROUP BY feature"))
def q_psi_share(spark, sf):
    b, c = split(spark, sf)
    return _psi_round(DR.psi_numeric(b, c, NUMERIC, 10, "share"))


_ALL_SQL = _churn_sql(
    D.counts_ctes("base", "cur", CATEGORICAL) + ",\n" + D.hist_ctes("base", "cur", NUMERIC, 10, "share")
    + f",\npf AS (SELECT feature, {D.psi_expr()} AS psi FROM sh GROUP BY feature UNION ALL "
      f"SELECT feature, {D.psi_expr()} AS psi FROM hs GROUP BY feature)", "SELECT feature, round(psi, 6) AS psi FROM pf")


@query("psi_all_features", _ALL_SQL)
def q_psi_all_features(spark, sf):
    b, c = split(spark, sf)
    return _psi_round(DR.psi_features(b, c, CATEGORICAL, NUMERIC, mode="share"))


@query("psi_total", _churn_sql(
    D.counts_ctes("base", "cur", FEATURES) + f",\npf AS (SELECT feature, {D.psi_expr()} AS psi FROM sh GROUP BY feature)",
    "SELECT round(sum(psi), 6) AS total_psi, count(*) AS n_features FROM pf"))
def q_psi_total(spark, sf):
    b, c = split(spark, sf)
    t = DR.psi_total(DR.psi_features(b, c, CATEGORICAL, NUMERIC, mode="values"))
    return t.select(rounded(F.col("total_psi")).alias("total_psi"), "n_features")


@query("drift_gate", _churn_sql(
    D.counts_ctes("base", "cur", FEATURES) + f",\npf AS (SELECT feature, {D.psi_expr()} AS psi FROM sh GROUP BY feature)",
    "SELECT (SELECT count(*) FROM base) AS n_base, (SELECT count(*) FROM cur) AS n_current, "
    "round(sum(psi), 6) AS total_psi, 0.2 AS threshold, coalesce(sum(psi) > 0.2 AND NOT isnan(sum(psi)), false) AS refresh "
    "FROM pf"))
def q_drift_gate(spark, sf):
    b, c = split(spark, sf)
    g = DR.drift_score(b, c, CATEGORICAL, NUMERIC, mode="values")
    return g.withColumn("total_psi", rounded(F.col("total_psi")))


_GATE_SQL = _churn_sql(
    D.counts_ctes("base", "cur", FEATURES) + f",\npf AS (SELECT feature, {D.psi_expr()} AS psi FROM sh GROUP BY feature)",
    "SELECT (SELECT count(*) FROM base) AS n_base, (SELECT count(*) FROM cur) AS n_current, "
    "round(sum(psi), 6) AS total_psi, 0.2 AS threshold, coalesce(sum(psi) > 0.2 AND NOT isnan(sum(psi)), false) AS refresh "
    "FROM pf")


@query("drift_gate_stored", _GATE_SQL)
def q_drift_gate_stored(spark, sf):
    """The gate from a summary published with the snapshot: the baseline is not read again."""
    from cascara.session import scratch_path
    from cascara.sources import files as IO

    b, c = split(spark, sf)
    snapshot = scratch_path(spark, "summed-snapshot")
    IO.publish_snapshot(b, snapshot, beside=DR.baseline_summary(b, CATEGORICAL, NUMERIC, "values"))
    g = DR.StoredDrift(IO.read_beside(spark, snapshot), c, CATEGORICAL, NUMERIC, mode="values").score()
    return g.withColumn("total_psi", rounded(F.col("total_psi")))


@query("psi_all_features_stored", _ALL_SQL)
def q_psi_all_features_stored(spark, sf):
    """PSI of every feature, numeric ones in bins, from a stored baseline summary with edges."""
    from cascara.session import written

    b, c = split(spark, sf)
    summary = written(DR.baseline_summary(b, CATEGORICAL, NUMERIC, "share"), "baseline-summary")
    return _psi_round(DR.StoredDrift(summary, c, CATEGORICAL, NUMERIC, "share").psi())


@query("drift_gate_no_baseline", S.with_chain(
    "SELECT CAST(0 AS BIGINT) AS n_base, count(*) AS n_current, 1.0::DOUBLE AS total_psi, 0.2 AS threshold, "
    "true AS refresh FROM clean"))
def q_drift_gate_no_baseline(spark, sf):
    """No snapshot exists yet: score 1.0 forces the refresh."""
    return DR.drift_score(None, cleaned(spark, sf), CATEGORICAL, NUMERIC, mode="values")


@query("drift_gate_empty_baseline", S.with_chain(
    "SELECT CAST(0 AS BIGINT) AS n_base, count(*) AS n_current, 1.0::DOUBLE AS total_psi, 0.2 AS threshold, "
    "true AS refresh FROM clean"))
def q_drift_gate_empty_baseline(spark, sf):
    """An empty snapshot (no rows survive the baseline filter) also scores 1.0."""
    c = cleaned(spark, sf)
    return DR.drift_score(c.where(F.col("Tenure") < 0), c, CATEGORICAL, NUMERIC, mode="values") \
        .withColumn("total_psi", rounded(F.col("total_psi")))


def _li_sql(ctes, select):
    return f"WITH {_LI_SPLIT},\n{ctes}\n{select}"


@query("psi_lineitem", _li_sql(
    D.counts_ctes("lbase", "lcur", LI_CAT) + ",\n" + D.hist_ctes("lbase", "lcur", LI_NUM, 10, "share")
    + f",\npf AS (SELECT feature, {D.psi_expr()} AS psi FROM sh GROUP BY feature UNION ALL "
      f"SELECT feature, {D.psi_expr()} AS psi FROM hs GROUP BY feature)", "SELECT feature, round(psi, 6) AS psi FROM pf"))
def q_psi_lineitem(spark, sf):
    b, c = li_split(spark, sf)
    return _psi_round(DR.psi_features(b, c, LI_CAT, LI_NUM, mode="share"))


@query("histogram_lineitem", _li_sql(D.hist_ctes("lbase", "lcur", LI_NUM, 10, "share"), _HIST_SELECT))
def q_histogram_lineitem(spark, sf):
    b, c = li_split(spark, sf)
    return _hist_round(DR.histogram(b, c, LI_NUM, 10, "share"))


@query("drift_refresh_job", S.with_chain(
    "SELECT 1 AS run, CAST(0 AS BIGINT) AS n_base, count(*) AS n_current, 1.0::DOUBLE AS total_psi, 0.2 AS threshold, "
    "true AS refresh FROM clean UNION ALL SELECT 2, count(*), count(*), 0.0, 0.2, false FROM clean"))
def q_drift_refresh_job(spark, sf):
    """The refresh job twice over the same landing: no snapshot yet → score 1.0, publish; same data again → PSI 0,
    keep the snapshot."""
    from cascara.catalog.q_clean import raw
    from cascara.plans.refresh import refresh_job
    from cascara.session import scratch_path

    snapshot = scratch_path(spark, "train-snapshot")
    runs = []
    for run in (1, 2):
        d = refresh_job(spark, raw(spark, sf), scratch_path(spark, "cleaned"), snapshot, CATEGORICAL, NUMERIC)
        runs.append(d.select(F.lit(run).alias("run"), "n_base", "n_current",
                             rounded(F.col("total_psi")).alias("total_psi"), "threshold", "refresh"))
    return runs[0].unionByName(runs[1])
