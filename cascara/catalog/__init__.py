"""Registered queries: each is a Spark job over the driver's tables plus (where SQL can say it) an oracle in DuckDB SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``. Computed columns carry the same alias in
both, and floating results are rounded to 6 decimals in both so that value hashes compare across engines.
"""

from __future__ import annotations

from cascara.catalog.registry import ORACLE, QUERIES  # noqa: F401
from cascara.catalog import (  # noqa: F401  (import registers the queries)
    q_clean,
    q_drift,
    q_encode,
    q_evaluate,
    q_io,
    q_repair,
    q_profile,
)
