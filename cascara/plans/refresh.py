"""The hourly refresh decision as one Spark job: clean the landed rows, write them, score their drift against the
current training snapshot, and publish them as the new snapshot when the drift says so.

Only one row — the gate decision — is collected to the driver; every table stays in the cluster's storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cascara.operators.drift import DEFAULT_THRESHOLD, StoredDrift, baseline_summary
from cascara.plans import churn as P
from cascara.sources import files as IO


def refresh_job(spark: SparkSession, raw: DataFrame, cleaned_path: str, snapshot_path: str,
                categorical: Sequence[str], numeric: Sequence[str] = (), mode: str = "values",
                threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Run once; returns the one-row decision ``(n_base, n_current, total_psi, threshold, refresh)``.

    ``mode='values'`` scores every feature value by value, which is what the original hourly job computes. A snapshot is
    published with a summary of its distributions, so a run scans the current rows once and the snapshot not at all.
    """
    IO.write_parquet(P.clean(raw), cleaned_path)            # the cleaned table, written once
    current = IO.read_parquet(spark, cleaned_path)          # later steps read the written table, not the plan
    summary = IO.read_beside(spark, snapshot_path)
    if summary is None:
        baseline = IO.read_snapshot(spark, snapshot_path)   # None before the first publish
        known = current.limit(0) if baseline is None else baseline
        summary = baseline_summary(known, categorical, numeric, mode)
    drift = StoredDrift(summary, current, categorical, numeric, mode)
    decision = drift.score(threshold)
    row = decision.first()
    if row["refresh"]:
        fresh = drift.current_summary()
        IO.publish_snapshot(current, snapshot_path, beside=baseline_summary(current, categorical, numeric, mode) if fresh is None else fresh)
    return spark.createDataFrame([row.asDict()], decision.schema)
