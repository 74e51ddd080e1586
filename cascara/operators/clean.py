"""Declarative cleaning operators: rename, distinct, key dedup, required fields, reject rules, fills, recodes.

Rules are data: a name plus a SQL predicate that selects the *invalid* rows. Rejecting keeps the rows where the
predicate is FALSE or NULL, which is exactly what subtracting ``df.where(p)`` from a distinct frame keeps, but runs
as one filter (no join, no extra shuffle) and also works on streams.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.functions.columns import fill_when_parent, is_true, not_true, recode_bool


@dataclass(frozen=True)
class Rule:
    """A reject rule: rows where ``predicate`` is TRUE are invalid."""

    name: str
    predicate: str

    def column(self) -> Column:
        return F.expr(self.predicate)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def dependency_rule(name: str, parent: str, off_value: str, children: Sequence[str], sentinel: str) -> Rule:
    """Parent says 'off' but a child does not carry the sentinel value."""
    ors = " OR ".join(f"{_q(c)} <> {_lit(sentinel)}" for c in children)
    return Rule(name, f"{_q(parent)} = {_lit(off_value)} AND ({ors})")


def domain_rule(name: str, column: str, allowed: Iterable) -> Rule:
    """Value outside the allowed set (NULL is not flagged, as in SQL)."""
    ands = " AND ".join(f"{_q(column)} <> {_lit(v)}" for v in allowed)
    return Rule(name, ands)


def required_if_rule(name: str, parent: str, on_value: str, children: Sequence[str]) -> Rule:
    """Parent equals ``on_value`` but a child is missing."""
    ors = " OR ".join(f"{_q(c)} IS NULL" for c in children)
    return Rule(name, f"{_q(parent)} = {_lit(on_value)} AND ({ors})")


def required_unless_rule(name: str, parent: str, off_value: str, children: Sequence[str]) -> Rule:
    """Parent is anything but ``off_value`` but a child is missing (stricter form of ``required_if_rule``)."""
    ors = " OR ".join(f"{_q(c)} IS NULL" for c in children)
    return Rule(name, f"{_q(parent)} <> {_lit(off_value)} AND ({ors})")


def range_rule(name: str, nonnegative: Sequence[str] = (), not_nan: Sequence[str] = (),
               lower: float | None = 0, upper: float | None = None) -> Rule:
    """A number below ``lower`` / above ``upper``, or a NaN in a float column."""
    parts = []
    for c in nonnegative:
        if lower is not None:
            parts.append(f"{_q(c)} < {lower!r}")
        if upper is not None:
            parts.append(f"{_q(c)} > {upper!r}")
    parts += [f"isnan({_q(c)})" for c in not_nan]
    return Rule(name, " OR ".join(parts))


# ---------------------------------------------------------------------------------------------------------------
# Operators


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows (NULL = NULL, NaN = NaN). A hash aggregate with a map-side partial step, so repeated rows
    collapse before the shuffle even when one row value dominates."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the survivor is the smallest row by ``order`` then by the remaining columns (ascending,
    NULLs first, NaN greatest). NULL keys collapse to one row.

    Implemented as ``groupBy(key).agg(min(struct(order..., rest...)))`` rather than a ``row_number`` window: the
    aggregate combines map-side, so a hot key (for instance the NULL key holding a third of all rows) is reduced
    per partition before the shuffle instead of being sorted whole in one task.
    """
    order = list(order or [])
    rest = [c for c in df.columns if c != key and c not in order]
    fields = order + rest
    picked = df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("__row"))
    return picked.select(*[F.col("__row")[c].alias(c) if c != key else F.col(key) for c in df.columns])


def dedup_by_key_any(df: DataFrame, key: str) -> DataFrame:
    """One row per key with an arbitrary survivor (``dropDuplicates([key])``), for callers that need no
    repeatable choice."""
    return df.dropDuplicates([key])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop a row if any listed column is NULL, or NaN for float/double columns."""
    return df.dropna(subset=list(columns))


def reject(df: DataFrame, rules: Rule | Sequence[Rule]) -> DataFrame:
    """Keep rows where no rule's predicate is TRUE (one filter, pushed down by Catalyst where possible)."""
    rules = [rules] if isinstance(rules, Rule) else list(rules)
    cond = None
    for r in rules:
        c = not_true(r.column())
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def reject_by_subtract(df: DataFrame, rule: Rule) -> DataFrame:
    """The literal EXCEPT form (``df.subtract(df.where(p))``); Catalyst rewrites it to the filter form plus a
    distinct. Kept for equivalence tests; prefer ``reject``."""
    return df.subtract(df.where(rule.column()))


def flagged(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows a rule rejects."""
    return df.where(is_true(rule.column()))


def fill_dependent(df: DataFrame, parent: str, off_value: str, children: Sequence[str], sentinel: str) -> DataFrame:
    """When the parent is ``off_value`` set every child to ``sentinel``; all children read the input values."""
    return df.withColumns({c: fill_when_parent(parent, off_value, c, sentinel) for c in children})


def recode_booleans(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """``column = truthy`` → True, anything else (NULL included) → False, for each mapped column."""
    return df.withColumns({c: recode_bool(c, v) for c, v in mapping.items()})


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows removed by each rule when the rules run in order, from ONE scan of ``df``.

    Output: ``(stage, rule, rows_in, rows_removed, rows_out)``. A row is charged to the first rule that rejects
    it, so the counts equal the row losses of the chained filters.
    """
    flags = [is_true(r.column()) for r in rules]
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    for i, r in enumerate(rules):
        earlier = [~f for f in flags[:i]]
        cond = flags[i] if not earlier else (flags[i] & _all(earlier))
        aggs.append(F.count_if(cond).alias(f"r{i}"))
    one = df.agg(*aggs)
    # running totals on the single aggregated row (plain arithmetic, no window)
    cols = [F.col("rows_in")]
    for i in range(len(rules)):
        cols.append(F.col("rows_in") - sum((F.col(f"r{j}") for j in range(i + 1)), F.lit(0)))
    one = one.select("*", *[c.alias(f"o{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"{i}, {_lit(r.name)}, o{i}, r{i}, o{i + 1}" for i, r in enumerate(rules))
    return one.selectExpr(f"stack({len(rules)}, {stack}) AS (stage, rule, rows_in, rows_removed, rows_out)")


def _all(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT with null-safe row equality (``df.subtract``): a left-anti join on all columns."""
    return left.subtract(right)
