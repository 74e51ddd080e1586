"""Hourly drift of a categorical column against a baseline distribution, in batch and as a streaming job.

PSI per hour without an hours × categories product: with ``K = Σ_c term(ε, e_c)`` over every baseline category,

    psi(h) = Σ_{c seen in h} term(a_hc, e'_c)  +  K  −  Σ_{c seen in h and in the baseline} term(ε, e_c)

where ``e'_c`` is the baseline share, or ε for a category the baseline never saw. Only (hour, category) counts
that exist are touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.operators.drift import EPS
from cascara.streaming.manifest import folders, now_ms, read_manifest, remove, write_manifest


def _term(a, e):
    return (a - e) * F.ln(a / e)


def baseline_shares(base: DataFrame, column: str) -> DataFrame:
    """``(value, e)`` of the baseline (NULLs excluded)."""
    counts = base.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n")).first()[0] or 0  # one number: the baseline size
    return counts.select("value", (F.col("n") / F.lit(float(tot))).alias("e"))


def hourly_counts(events: DataFrame, ts: str, column: str, width: str = "1 hour") -> DataFrame:
    """``(window_start, value, n)``: counts per tumbling window (map-side combined)."""
    return (events.where(F.col(column).isNotNull())
            .groupBy(F.window(ts, width).start.alias("window_start"), F.col(column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def psi_by_window(counts: DataFrame, shares: DataFrame) -> DataFrame:
    """``(window_start, n, psi)`` from per-window category counts and baseline shares. With n the window's total, every
    term (a − e)·ln(a/e), a = c/n, splits into sums over the window's categories that need no total beforehand:
    Σ c·(ln c − ln e)/n − ln n·Σ c/n − Σ e·(ln c − ln e) + ln n·Σ e, so one grouped pass does."""
    k_total = shares.agg(F.sum(_term(F.lit(EPS), F.col("e")))).first()[0] or 0.0  # one number per baseline
    e = F.coalesce(F.when(F.col("e") == 0, F.lit(EPS)).otherwise(F.col("e")), F.lit(EPS))
    c = F.col("n").cast("double")
    gap = F.ln(c) - F.ln(e)
    seen = counts.join(shares, "value", "left").groupBy("window_start").agg(
        F.sum("n").alias("total"), F.sum(c * gap).alias("s1"), F.sum(e * gap).alias("s2"), F.sum(e).alias("s3"),
        F.sum(F.when(F.col("e").isNotNull(), _term(F.lit(EPS), F.col("e"))).otherwise(F.lit(0.0))).alias("overlap"))
    total = F.col("total").cast("double")
    present = F.col("s1") / total - F.ln(total) - F.col("s2") + F.ln(total) * F.col("s3")
    return seen.select("window_start", F.col("total").alias("n"), (present + F.lit(float(k_total)) - F.col("overlap")).alias("psi"))


def hourly_psi(events: DataFrame, base: DataFrame, ts: str, column: str, width: str = "1 hour") -> DataFrame:
    """Batch form: PSI of ``column`` for every window of ``events`` against ``base``."""
    return psi_by_window(hourly_counts(events, ts, column, width), baseline_shares(base, column))


def hourly_psi_stream(stream: DataFrame, ts: str, column: str, sink: str, checkpoint: str, width: str = "1 hour") -> int:
    """Streaming form: adds what has arrived to the table of counts below ``sink`` (``availableNow``) and returns the number
    of batches. Counts of (window, value) can be added up in any order, so no row is ever too late: one of a closed hour
    corrects it. A batch replayed after a failure replaces its own folder."""
    sink = sink.rstrip("/")
    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        hourly_counts(batch, ts, column, width).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        batches.append(batch_id)

    (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return len(batches)


def read_counts(spark: SparkSession, sink: str) -> DataFrame | None:
    """``(window_start, value, n)`` over all batches: the merged ones and those since; None before the first."""
    sink = sink.rstrip("/")
    state = read_manifest(spark, f"{sink}/MANIFEST") or {"upto": -1, "merged": None}
    paths = [path for i, path in folders(spark, sink, "batch_id=").items() if int(i) > state["upto"]]
    paths += [f"{sink}/{state['merged']}"] if state["merged"] else []
    if not paths:
        return None
    return spark.read.parquet(*paths).groupBy("window_start", "value").agg(F.sum("n").alias("n"))


def merge_counts(spark: SparkSession, sink: str) -> None:
    """Between runs: make one folder of all batches so far, so that the number of folders does not grow with the runs. The
    manifest is switched by an atomic rename; what it replaces is removed after that."""
    sink = sink.rstrip("/")
    before = read_manifest(spark, f"{sink}/MANIFEST") or {"upto": -1, "merged": None}
    batches = {int(i): path for i, path in folders(spark, sink, "batch_id=").items()}
    upto = max([*batches, before["upto"]])
    if upto > before["upto"]:
        merged = f"merged-{upto:012d}-{now_ms()}"
        read_counts(spark, sink).write.parquet(f"{sink}/{merged}")
        write_manifest(spark, f"{sink}/MANIFEST", {"upto": upto, "merged": merged})
        if before["merged"]:
            remove(spark, f"{sink}/{before['merged']}")
    for i, path in batches.items():
        if i <= upto:
            remove(spark, path)


def streamed_psi(spark: SparkSession, sink: str, shares: DataFrame) -> DataFrame:
    """PSI of every window that the table of counts knows, against the baseline shares."""
    counts = read_counts(spark, sink)
    if counts is None:
        return spark.createDataFrame([], "window_start timestamp, n long, psi double")
    return psi_by_window(counts, shares)
