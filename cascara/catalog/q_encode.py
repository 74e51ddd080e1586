"""Encoding queries on the cleaned churn table (and label codes on orders)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.catalog import sql_churn as S
from cascara.catalog.q_clean import cleaned
from cascara.catalog.q_profile import _vc_sql
from cascara.catalog.registry import query, table
from cascara.functions.columns import rounded
from cascara.operators import encode as E
from cascara.session import written

STRING_COLS = ["Gender", "MultipleLines", "InternetService", *S.ADDONS, "Contract", "PaymentMethod"]
BOOL_COLS = ["SeniorCitizen", "Partner", "Dependents", "PhoneService", "PaperlessBilling"]
NUM_COLS = ["Tenure"]
FLOAT_COLS = ["MonthlyCharges", "TotalCharges"]
ID_COLS = ["CustomerID", "Churn"]

# The categories the churn stand-in produces in each string column after cleaning (sorted; NULL last).
# Used only to spell out the oracle's column list.
_YNI = ["No", "No internet service", "Yes", None]
CATEGORIES = {
    "Gender": ["Femal", "Female", "Male", "Mle"],
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No", "Yes"],
    **{c: _YNI for c in S.ADDONS},
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaymentMethod": ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"],
}


def _qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _onehot_sql_cols() -> list[tuple[str, str]]:
    out = []
    for c, vals in CATEGORIES.items():
        for v in vals:
            name = f"{c}_{'None' if v is None else v}"
            expr = f"CAST({c} IS NULL AS DOUBLE)" if v is None else \
                f"CAST(coalesce({c} = '{v}', false) AS DOUBLE)"
            out.append((name, expr))
    return out


@query("feature_select", S.with_chain("SELECT * EXCLUDE (CustomerID, Churn) FROM clean"))
def q_feature_select(spark, sf):
    """Drop id and target (unknown names ignored), keep every other column."""
    return E.drop_columns(cleaned(spark, sf), ["CustomerID", "Churn", "NotThere"])


@query("string_columns", S.with_chain("SELECT " + ", ".join(STRING_COLS) + " FROM clean"))
def q_string_columns(spark, sf):
    """Select the string-typed feature columns (dtype selection on the schema)."""
    from pyspark.sql import types as T

    df = E.all_except(cleaned(spark, sf), ID_COLS)
    return df.select(*E.columns_of_type(df, [T.StringType]))


_FIT_SQL = S.with_chain(
    f"SELECT \"column\", value, n, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) - 1 AS DOUBLE)"
    f" AS \"index\" FROM ({_vc_sql('clean', STRING_COLS)}) v")


@query("string_index_fit", _FIT_SQL)
def q_string_index_fit(spark, sf):
    return E.string_index_fit(cleaned(spark, sf), STRING_COLS)


def _index_sql(c: str) -> str:
    return (f"coalesce((SELECT \"index\" FROM fit WHERE \"column\" = '{c}' AND value = clean.{c}), "
            f"(SELECT CAST(count(*) AS DOUBLE) FROM fit WHERE \"column\" = '{c}')) AS {c}Indexed")


_FIT_CTE = (f"fit AS (SELECT \"column\", value, n, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, "
            f"value) - 1 AS DOUBLE) AS \"index\" FROM ({_vc_sql('clean', STRING_COLS)}) v)")
_INDEXED = S.with_chain("").rstrip() + f",\n{_FIT_CTE},\nidx AS (SELECT CustomerID, " + ", ".join(
    _index_sql(c) for c in STRING_COLS) + " FROM clean)\n"


@query("string_index", _INDEXED + "SELECT * FROM idx")
def q_string_index(spark, sf):
    """Frequency index; NULL and unseen values go to the extra index len(labels) (``handle_invalid='keep'``)."""
    df = cleaned(spark, sf)
    model = E.string_indexer(df, STRING_COLS)
    return model.transform(df.select("CustomerID", *STRING_COLS), handle_invalid="keep").drop(*STRING_COLS)


def _droplast_sql() -> str:
    cols = []
    for c in STRING_COLS:
        n_labels = len([v for v in CATEGORIES[c] if v is not None])
        for i in range(n_labels):  # labels + the 'keep' slot, last one dropped
            cols.append(f"CAST({c}Indexed = {float(i)} AS DOUBLE) AS {c}Vector_{i}")
    return _INDEXED + "SELECT CustomerID, " + ", ".join(cols) + " FROM idx"


@query("one_hot_droplast", _droplast_sql())
def q_one_hot_droplast(spark, sf):
    df = cleaned(spark, sf)
    model = E.string_indexer(df, STRING_COLS)
    idx = model.transform(df.select("CustomerID", *STRING_COLS), handle_invalid="keep")
    sizes = {f"{c}Indexed": model.sizes[c] + 1 for c in STRING_COLS}
    return E.one_hot_drop_last(idx, sizes).drop(*STRING_COLS, *sizes.keys())


# The strict form: rows without missing labels, an error otherwise, and the last real category dropped.
_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in STRING_COLS)
_LABELS = {c: len([v for v in CATEGORIES[c] if v is not None]) for c in STRING_COLS}
_STRICT = S.with_chain("").rstrip() + f""",
strict AS (SELECT * FROM clean WHERE {_PRESENT}),
fit AS (SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS DOUBLE) AS "index"
  FROM ({_vc_sql('strict', STRING_COLS)}) v),
idx AS (SELECT strict.*, {", ".join(f"(SELECT \"index\" FROM fit WHERE \"column\" = '{c}' AND value = strict.{c}) AS {c}Indexed" for c in STRING_COLS)}
  FROM strict)
"""


def _strict(spark, sf):
    """(indexed rows, labels per index column) of the cleaned rows that have every string column."""
    df = written(cleaned(spark, sf).dropna(subset=STRING_COLS), "strict")
    model = E.string_indexer(df, STRING_COLS)
    return model.transform(df, handle_invalid="error"), {f"{c}Indexed": n for c, n in model.sizes.items()}


@query("one_hot_droplast_strict", _STRICT + "SELECT CustomerID, " + ", ".join(
    f"CAST({c}Indexed = {float(i)} AS DOUBLE) AS {c}Vector_{i}" for c in STRING_COLS for i in range(_LABELS[c] - 1)) + " FROM idx")
def q_one_hot_droplast_strict(spark, sf):
    """One-hot with the last real category dropped (no spare slot), on rows without missing labels."""
    idx, sizes = _strict(spark, sf)
    out = E.one_hot_drop_last(idx, sizes)
    return out.select("CustomerID", *[c for c in out.columns if "Vector_" in c])


@query("notebook_export", _STRICT + "SELECT idx.* EXCLUDE (Churn), Churn, " + ", ".join(
    f"'(' || (SELECT count(*) - 1 FROM fit WHERE \"column\" = '{c}') || CASE WHEN {c}Indexed < (SELECT count(*) - 1 FROM fit "
    f"WHERE \"column\" = '{c}') THEN ',[' || CAST({c}Indexed AS INTEGER) || '],[1.0])' ELSE ',[],[])' END AS {c}Vector"
    for c in STRING_COLS) + " FROM idx")
def q_notebook_export(spark, sf):
    """The exploratory notebooks' export: the cleaned columns, an index (errors on missing labels) and a sparse one-hot
    vector for each string column; vectors written as (size,[indices],[values])."""
    idx, sizes = _strict(spark, sf)
    out = E.one_hot_sparse(idx, sizes)
    text = {f"{c}Vector": F.concat(F.lit("("), F.col(f"{c}Vector.size"), F.lit(",["), F.array_join(F.col(f"{c}Vector.indices").cast("array<string>"), ","),
                                   F.lit("],["), F.array_join(F.col(f"{c}Vector.values").cast("array<string>"), ","), F.lit("])")) for c in STRING_COLS}
    return out.withColumns(text)


@query("one_hot_full", S.with_chain(
    "SELECT CustomerID, " + ", ".join(f"{e} AS {_qi(n)}" for n, e in _onehot_sql_cols()) + " FROM clean"))
def q_one_hot_full(spark, sf):
    df = cleaned(spark, sf)
    model = E.one_hot_fit(df, STRING_COLS)
    return model.transform(df.select("CustomerID", *STRING_COLS))


@query("label_encode", S.with_chain(
    "SELECT CustomerID, CAST(dense_rank() OVER (ORDER BY Churn) - 1 AS INTEGER) AS Churn_code FROM clean"))
def q_label_encode(spark, sf):
    df = cleaned(spark, sf)
    return E.label_encode(df.select("CustomerID", "Churn"), "Churn").drop("Churn")


@query("label_encode_orders",
       "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_code "
       "FROM orders")
def q_label_encode_orders(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return E.label_encode(df, "o_orderpriority").drop("o_orderpriority")


_SCALE = NUM_COLS + FLOAT_COLS + BOOL_COLS


def _scale_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    lo, hi = f"(SELECT min({x}) FROM clean)", f"(SELECT max({x}) FROM clean)"
    return f"round(CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({x} - {lo}) / ({hi} - {lo}) END, 6) AS {c}"


@query("minmax_scale", S.with_chain("SELECT CustomerID, " + ", ".join(_scale_sql(c) for c in _SCALE) + " FROM clean"))
def q_minmax_scale(spark, sf):
    df = cleaned(spark, sf)
    model = E.minmax_fit(df, _SCALE)
    out = model.transform(df.select("CustomerID", *_SCALE))
    return out.select("CustomerID", *[rounded(F.col(c)).alias(c) for c in _SCALE])


def _feature_parts(fit_on_train: bool = False) -> tuple[str, list[str], list[str]]:
    """(chain + enc CTEs, scaled expressions, names) of the feature pipeline in the oracle dialect; bounds from all
    rows, or from the training rows of the md5 split only."""
    enc = [(c, f"CAST({c} AS DOUBLE)") for c in _FEATURE_NUMERIC] + _onehot_sql_cols()
    inner = ("SELECT CustomerID, Churn, row_number() OVER (ORDER BY md5(CustomerID || '42')) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test, "
             + ", ".join(f"{e} AS {_qi(n)}" for n, e in enc) + " FROM clean")
    fit = "enc WHERE NOT is_test" if fit_on_train else "enc"
    exprs = []
    for n, _ in enc:
        q = _qi(n)
        lo, hi = f"(SELECT min({q}) FROM {fit})", f"(SELECT max({q}) FROM {fit})"
        exprs.append(f"(CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({q} - {lo}) / ({hi} - {lo}) END)")
    return S.with_chain("").rstrip() + f",\nenc AS ({inner})\n", exprs, [n for n, _ in enc]


def _feature_sql() -> str:
    ctes, exprs, names = _feature_parts()
    return ctes + "SELECT CustomerID, Churn, " + ", ".join(
        f"round({e}, 6) AS {_qi(n)}" for e, n in zip(exprs, names)) + " FROM enc"


def churn_vectors_sql(fit_on_train: bool = False) -> str:
    """``(vec_id, v, label)``: the scaled feature vector of every cleaned customer (key = its id)."""
    ctes, exprs, _ = _feature_parts(fit_on_train)
    return (ctes + "SELECT CustomerID AS vec_id, list_value(" + ", ".join(exprs)
            + ") AS v, CAST(Churn AS BIGINT) AS label FROM enc")


# numeric and boolean columns in table order, as the feature pipeline takes them
_FEATURE_NUMERIC = ["SeniorCitizen", "Partner", "Dependents", "Tenure", "PhoneService", "PaperlessBilling",
                    "MonthlyCharges", "TotalCharges"]


@query("feature_matrix", _feature_sql())
def q_feature_matrix(spark, sf):
    """Drop id/target → one-hot string columns → concat with numeric/boolean → min-max scale (fit on all rows, as
    the original job does)."""
    df = written(cleaned(spark, sf), "clean")
    model = E.feature_fit(df, ID_COLS)
    out = model.transform(df, keep=ID_COLS)
    return out.select(*ID_COLS, *[rounded(F.col(f"`{n}`")).alias(n) for n in model.feature_names()])
