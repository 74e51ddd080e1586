"""Incremental landing ingest (Structured Streaming): every landed CSV file is read exactly once, and the cleaned table
equals the batch chain over everything landed so far.

* The file source remembers processed files in the checkpoint, so re-running over the same folder adds nothing;
  ``clean_source='archive'`` additionally moves consumed files out of the landing folder (or ``'delete'``).
* A key may occur in several files and several runs, and which of its rows survives is decided over all of them. Raw and
  cleaned rows are therefore kept in buckets by a hash of the key: all rows of a key are in one bucket, so only the
  buckets that new batches touch are cleaned again, each over all that ever landed in it; the others stay as they are.
* Each micro-batch writes to its own ``batch_id=`` folder with overwrite, so a batch replayed after a failure
  replaces its earlier partial output: the raw table is idempotent, the whole is exactly-once.
* A manifest names the folder of every cleaned bucket and the last batch they include, and is switched by an atomic
  rename. Whenever the raw table is ahead of it, at whatever point an earlier run failed, the missing batches are
  published. Replaced bucket folders stay for ``keep_ms``, so that readers of an earlier state can finish.

The transform must decide on rows of one key at a time (as the cleaning chain does) and keep the key as a column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascara.streaming.manifest import folders, now_ms, read_manifest, remove, write_manifest

BUCKETS = 64
KEEP_MS = 24 * 3600 * 1000


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def ingest_landing(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame], *, key: str = "customerID", out_key: str = "CustomerID",
                   buckets: int = BUCKETS, max_files_per_trigger: int | None = None, clean_source: str | None = None,
                   archive_dir: str | None = None, keep_ms: int = KEEP_MS) -> int:
    """Process everything currently in ``landing`` (``availableNow`` trigger) and return the number of batches. ``key`` is
    the key's column in the raw rows, ``out_key`` in the transformed ones. The number of buckets is fixed by the first
    run; about (bytes ever to land) / 1 GB is a good one."""
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            reader = reader.option("sourceArchiveDir", archive_dir)
    stream = reader.csv(landing)
    sink = sink.rstrip("/")
    n = fixed_buckets(spark, sink, buckets)
    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _write_buckets(batch.withColumn("bucket", bucket_of(key, n)), f"{sink}/raw/batch_id={batch_id}")
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    publish(spark, schema, sink, transform, out_key, keep_ms)
    return len(batches)


def _write_buckets(rows: DataFrame, path: str) -> None:
    """One folder per bucket; adaptive execution joins small buckets in a task and splits large ones over several."""
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def fixed_buckets(spark: SparkSession, sink: str, buckets: int) -> int:
    """The number of buckets of a sink: that of its first run."""
    path = f"{sink}/BUCKETS"
    known = read_manifest(spark, path)
    if known is None:
        write_manifest(spark, path, {"buckets": buckets})
        return buckets
    return known["buckets"]


def publish(spark: SparkSession, schema: T.StructType, sink: str, transform: Callable[[DataFrame], DataFrame], out_key: str,
            keep_ms: int = KEEP_MS) -> list[int]:
    """Clean the buckets that batches after the manifest's last one touch, and switch to them; returns these buckets."""
    state = read_manifest(spark, f"{sink}/MANIFEST") or {"last_batch": -1, "clean": {}, "replaced": []}
    landed = {int(i): path for i, path in folders(spark, f"{sink}/raw", "batch_id=").items()}
    new = sorted(i for i in landed if i > state["last_batch"])
    if not new:
        return []
    n = fixed_buckets(spark, sink, BUCKETS)
    touched = sorted({int(b) for i in new for b in folders(spark, landed[i], "bucket=")})
    if touched:
        raw = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])).parquet(f"{sink}/raw")
        rows = transform(raw.where(F.col("bucket").isin(touched)).drop("batch_id", "bucket"))  # only these folders are read
        version = f"clean/upto={new[-1]:012d}-{now_ms()}"
        _write_buckets(rows.withColumn("bucket", bucket_of(out_key, n)), f"{sink}/{version}")
        state["columns"] = rows.schema.jsonValue()
        left = set(folders(spark, f"{sink}/{version}", "bucket="))  # a bucket may have lost all its rows to the rules
        for b in map(str, touched):
            if b in state["clean"]:
                state["replaced"].append([now_ms(), f"{state['clean'].pop(b)}/bucket={b}"])
            if b in left:
                state["clean"][b] = version
    state["last_batch"] = new[-1]
    old = [path for at, path in state["replaced"] if at <= now_ms() - keep_ms]
    state["replaced"] = [[at, path] for at, path in state["replaced"] if path not in old]
    write_manifest(spark, f"{sink}/MANIFEST", state)
    for path in old:
        remove(spark, f"{sink}/{path}")
    return touched


def read_sink(spark: SparkSession, sink: str) -> DataFrame | None:
    """The cleaned table over everything ingested, or None before the first run."""
    sink = sink.rstrip("/")
    state = read_manifest(spark, f"{sink}/MANIFEST")
    if state is None or "columns" not in state:
        return None
    columns = T.StructType.fromJson(state["columns"])
    paths = [f"{sink}/{version}/bucket={b}" for b, version in sorted(state["clean"].items())]
    return spark.read.schema(columns).parquet(*paths) if paths else spark.createDataFrame([], columns)
