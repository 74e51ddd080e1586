"""Wide → long reshaping used by the profile and drift operators (one pass, no per-column loop of jobs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cascara.functions.columns import quoted, without_nan


def to_long(df: DataFrame, columns: Sequence[str], value_type: str = "string", feature_col: str = "feature",
            value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per (input row, column): ``(keep..., feature, value)`` with every value cast to ``value_type``.

    Only the listed columns are selected first, so the parquet scan reads just those. NaN becomes NULL, so that
    whatever skips missing values skips it too.
    """
    cols = list(columns)
    slim = df.select(*[quoted(k) for k in keep], *[without_nan(df, c).cast(value_type).alias(c) for c in cols])
    return slim.unpivot([quoted(k) for k in keep], [quoted(c) for c in cols], feature_col, value_col)
