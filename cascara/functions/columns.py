"""Column expressions shared by the operators. All are built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    """A SQL predicate string or a Column, as a Column."""
    return F.expr(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has (dots, quotes, backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def without_nan(df, name: str) -> Column:
    """A column with NaN as NULL, as pandas treats it; columns that cannot hold NaN unchanged."""
    c = quoted(name)
    return F.when(~F.isnan(c), c) if df.schema[name].dataType.typeName() in ("float", "double") else c


def not_true(predicate: ColumnLike) -> Column:
    """Rows where the predicate is FALSE or NULL: what ``df.subtract(df.where(p))`` keeps."""
    return ~F.coalesce(as_column(predicate), F.lit(False))


def is_true(predicate: ColumnLike) -> Column:
    """Rows where the predicate is TRUE (NULL counts as not true)."""
    return F.coalesce(as_column(predicate), F.lit(False))


def any_of(predicates: Iterable[Column]) -> Column:
    """OR of several predicates (three-valued, like SQL)."""
    preds = list(predicates)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def recode_bool(column: str, truthy) -> Column:
    """``column = truthy`` as a boolean; NULL and every other value become False."""
    return F.coalesce(F.col(column) == F.lit(truthy), F.lit(False))


def fill_when_parent(parent: str, off_value: str, child: str, sentinel: str) -> Column:
    """Child value, replaced by ``sentinel`` when the parent says the service is off."""
    return F.when(F.col(parent) == F.lit(off_value), F.lit(sentinel)).otherwise(F.col(child))


def clamp_zero(p: Column, eps: float = 1e-10) -> Column:
    """Replace an exact zero share by ``eps`` (keeps the PSI log finite)."""
    return F.when(p == 0, F.lit(eps)).otherwise(p)


def psi_term(actual: Column, expected: Column) -> Column:
    """(a - e) * ln(a / e), one term of the population stability index."""
    return (actual - expected) * F.ln(actual / expected)


def rounded(c: Column, digits: int = 6) -> Column:
    """Double rounded to ``digits`` decimals (stable value hashes across engines)."""
    return F.round(c.cast("double"), digits)


def time_literal(df, column: str, text: str) -> Column:
    """A date-time literal typed like ``df[column]`` (TIMESTAMP_NTZ or TIMESTAMP), so comparisons never go through
    the session time zone."""
    return F.lit(text).cast(df.schema[column].dataType)
