"""Fuzzy vocabulary repair queries on the raw churn rows."""

from __future__ import annotations

from cascara.catalog import sql_churn as S
from cascara.catalog.q_clean import raw
from cascara.catalog.registry import query
from cascara.plans import churn as P

_COLS = list(P.REPAIR_VOCAB)
_VOCAB_ROWS = ", ".join(f"('{c}', {i}, '{w}')" for c, ws in P.REPAIR_VOCAB.items() for i, w in enumerate(ws))
_DISTINCT = " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS col, {c} AS value FROM renamed WHERE {c} IS NOT NULL" for c in _COLS)
_REPAIR_CTES = f""",
vocab AS (SELECT * FROM (VALUES {_VOCAB_ROWS}) v(col, pos, choice)),
lng AS ({_DISTINCT}),
sc AS (SELECT l.col, l.value, v.pos, v.choice,
  CASE WHEN greatest(length(l.value), length(v.choice)) = 0 THEN 100.0 ELSE
  100.0 * (greatest(length(l.value), length(v.choice)) - levenshtein(l.value, v.choice))
    / greatest(length(l.value), length(v.choice)) END AS score
  FROM lng l JOIN vocab v ON l.col = v.col),
best AS (SELECT col, value, CASE WHEN score >= 80 THEN choice END AS fixed FROM
  (SELECT *, row_number() OVER (PARTITION BY col, value ORDER BY score DESC, pos) AS rn FROM sc) x WHERE rn = 1)
"""
_SELECT = ", ".join(
    f"(SELECT fixed FROM best WHERE col = '{c}' AND value = r.{c}) AS {c}" if c in _COLS else f"r.{c}"
    for c in S.COLS)


@query("fuzzy_repair", S.with_chain("").rstrip() + _REPAIR_CTES + f"SELECT {_SELECT} FROM renamed r")
def q_fuzzy_repair(spark, sf):
    """Nearest allowed word by Levenshtein similarity (>= 80), else NULL, on 13 columns of the raw rows."""
    return P.repaired(raw(spark, sf), "levenshtein", 80.0)


def _indel_sql() -> str:
    """Indel similarity 100 * 2 * LCS / (len a + len b). The longest common subsequence by dynamic programming, one step
    per character of the value: the state is the last row of the table, one entry per character of the choice."""
    return """,
ind AS (
  SELECT col, value, pos, choice, 0 AS i, list_transform(range(length(choice) + 1), lambda x: 0) AS state
  FROM (SELECT l.col, l.value, v.pos, v.choice FROM lng l JOIN vocab v ON l.col = v.col) p
  UNION ALL
  SELECT col, value, pos, choice, i + 1, list_reduce(range(1, length(choice) + 1), lambda acc, j: list_append(acc,
      CASE WHEN substr(value, CAST(i + 1 AS BIGINT), 1) = substr(choice, j, 1) THEN state[j] + 1
           ELSE greatest(state[j + 1], acc[len(acc)]) END), [0])
  FROM ind WHERE i < length(value)),
sc AS (SELECT col, value, pos, choice, CASE WHEN length(value) + length(choice) = 0 THEN 100.0 ELSE
  200.0 * state[len(state)] / (length(value) + length(choice)) END AS score FROM ind WHERE i = length(value)),
"""


_INDEL_CTES = _REPAIR_CTES[: _REPAIR_CTES.index(",\nsc AS (")] + _indel_sql() + _REPAIR_CTES[_REPAIR_CTES.index("best AS ("):]
_RECURSIVE = S.with_chain("").rstrip().replace("WITH ", "WITH RECURSIVE ", 1)


@query("fuzzy_repair_indel", _RECURSIVE + _INDEL_CTES + f"SELECT {_SELECT} FROM renamed r")
def q_fuzzy_repair_indel(spark, sf):
    """The same with the Indel (LCS) similarity."""
    return P.repaired(raw(spark, sf), "indel", 80.0)


def _chain_on_repaired() -> str:
    """The cleaning chain with the repaired rows in place of the renamed ones."""
    head, tail = S.CHAIN.split("dist AS (", 1)
    head = head.replace("renamed AS (", "original AS (", 1)
    repair = _REPAIR_CTES.replace("FROM renamed", "FROM original").strip().lstrip(",").rstrip()
    return f"WITH {head}{repair},\nrenamed AS (SELECT {_SELECT} FROM original r),\ndist AS ({tail}\n"


@query("clean_repaired_levenshtein", _chain_on_repaired() + "SELECT * FROM clean")
def q_clean_repaired_levenshtein(spark, sf):
    """The cleaning chain with typo repair (Levenshtein scorer) after the rename."""
    return P.clean_repaired(raw(spark, sf), scorer="levenshtein")


@query("clean_repaired", _chain_on_repaired().replace("WITH ", "WITH RECURSIVE ", 1).replace(
    _REPAIR_CTES.replace("FROM renamed", "FROM original").strip().lstrip(",").rstrip(),
    _INDEL_CTES.replace("FROM renamed", "FROM original").strip().lstrip(",").rstrip()) + "SELECT * FROM clean")
def q_clean_repaired(spark, sf):
    """The cleaning chain with typo repair (Indel scorer) after the rename."""
    return P.clean_repaired(raw(spark, sf), scorer="indel")
