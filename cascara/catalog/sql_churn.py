"""Oracle-side SQL for the churn chain, written independently of the Spark operators (DuckDB dialect)."""

from __future__ import annotations

from cascara.sources import churn_values as V
from cascara.sources.churn import churn_raw_sql

ADDONS = V.INTERNET_CHILDREN
COLS = V.COLUMNS
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in [*V.DEDUP_ORDER, *(c for c in COLS if c not in (V.KEY, *V.DEDUP_ORDER))])
_REQ_SQL = " AND ".join([f"{c} IS NOT NULL" for c in V.REQUIRED] + [f"NOT isnan({c})" for c in V.FLOATS])
_ALL = ", ".join(COLS)


def _literal(v: object) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _or(columns, test: str) -> str:
    return "(" + " OR ".join(f"{c} {test}" for c in columns) + ")"


P_CHILD_PHONE = f"{V.PHONE_PARENT} = 'No' AND {_or(V.PHONE_CHILDREN, f'<> {_literal(V.NO_PHONE)}')}"
P_CHILD_INTERNET = f"{V.INTERNET_PARENT} = 'No' AND {_or(ADDONS, f'<> {_literal(V.NO_INTERNET)}')}"
P_DOMAIN = " AND ".join(f"SeniorCitizen <> {_literal(v)}" for v in V.SENIOR)
P_MISSING_PHONE = f"{V.PHONE_PARENT} = 'Yes' AND {_or(V.PHONE_CHILDREN, 'IS NULL')}"
P_MISSING_INTERNET = f"{V.INTERNET_PARENT} = 'Yes' AND {_or(ADDONS, 'IS NULL')}"
P_MISSING_INTERNET_STRICT = f"{V.INTERNET_PARENT} <> 'No' AND {_or(ADDONS, 'IS NULL')}"
P_NUMERIC = " OR ".join([f"{c} < 0" for c in V.NUMERIC] + [f"isnan({c})" for c in V.FLOATS])


def keep(p: str) -> str:
    return f"NOT coalesce({p}, false)"


_FILLED = {c: (V.PHONE_PARENT, V.NO_PHONE) for c in V.PHONE_CHILDREN} | {c: (V.INTERNET_PARENT, V.NO_INTERNET) for c in ADDONS}
_FILL = ", ".join(
    f"CASE WHEN {_FILLED[c][0]} = 'No' THEN {_literal(_FILLED[c][1])} ELSE {c} END AS {c}" if c in _FILLED else c for c in COLS)
_RECODE = ", ".join(f"coalesce({c} = {_literal(V.BOOLEANS[c])}, false) AS {c}" if c in V.BOOLEANS else c for c in COLS)
_RENAMED = {new: old for old, new in V.RENAMES.items()}

# WITH-list of the whole chain; every stage is a named CTE the oracle queries can select from.
CHAIN = f"""raw AS ({churn_raw_sql('customer')}),
renamed AS (SELECT {', '.join(f'{_RENAMED[c]} AS {c}' if c in _RENAMED else c for c in COLS)} FROM raw),
dist AS (SELECT DISTINCT * FROM renamed),
keyed AS (SELECT {_ALL} FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY {_ORDER}) AS rn
  FROM dist) t WHERE rn = 1),
req AS (SELECT * FROM keyed WHERE {_REQ_SQL}),
r1 AS (SELECT * FROM req WHERE {keep(P_CHILD_PHONE)}),
r2 AS (SELECT * FROM r1 WHERE {keep(P_CHILD_INTERNET)}),
r3 AS (SELECT * FROM r2 WHERE {keep(P_DOMAIN)}),
r4 AS (SELECT * FROM r3 WHERE {keep(P_MISSING_PHONE)}),
r5 AS (SELECT * FROM r4 WHERE {keep(P_MISSING_INTERNET)}),
filled AS (SELECT {_FILL} FROM r5),
r6 AS (SELECT * FROM filled WHERE {keep(P_NUMERIC)}),
clean AS (SELECT {_RECODE} FROM r6)"""


def with_chain(select: str) -> str:
    """An oracle statement over the chain CTEs."""
    return f"WITH {CHAIN}\n{select}"
