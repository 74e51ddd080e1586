"""File sources and sinks: CSV with a declared or inferred schema, parquet datasets, landing-folder listing and an
atomic-style snapshot publish. Paths are any Hadoop URI (``s3a://``, ``hdfs://``, ``file:``); every read covers
the whole directory, never one part file.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascara.streaming.manifest import file_system, folders, now_ms, remove, replace_file


class NoDataSourceError(RuntimeError):
    """The source path does not exist (or holds no data files)."""


def require_path(spark: SparkSession, path: str) -> None:
    """Raise ``NoDataSourceError`` if ``path`` is missing (checked through the path's Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise NoDataSourceError(f"source {path} does not exist")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             mode: str = "PERMISSIVE", corrupt_column: str | None = None) -> DataFrame:
    """CSV with a declared schema; columns bind by position, the header line is skipped.

    ``corrupt_column`` keeps unparsable lines in an extra string column instead of nulling their fields.
    """
    reader = spark.read.option("header", header).option("mode", mode)
    if corrupt_column:
        if isinstance(schema, str):  # DDL text
            schema = f"{schema}, `{corrupt_column}` string"
        else:
            schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    try:
        return reader.schema(schema).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise NoDataSourceError(f"source {path} does not exist") from e
        raise


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with the schema inferred from the data (an extra pass over the files; avoid on large inputs)."""
    try:
        return spark.read.option("header", header).option("inferSchema", True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise NoDataSourceError(f"source {path} does not exist") from e
        raise


def write_csv(df: DataFrame, path: str, header: bool = True, partitions: int | None = None,
              key: str | None = None) -> str:
    """Write CSV files (overwrite), one per partition of ``df`` unless ``partitions`` says otherwise. ``key`` puts all
    rows of one key value into one file."""
    out = df
    if key is not None:
        out = out.repartition(*([partitions] if partitions else []), key)
    elif partitions is not None:
        out = out.repartition(partitions)
    out.write.mode("overwrite").option("header", header).csv(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Every part file of a parquet dataset directory."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise NoDataSourceError(f"source {path} does not exist") from e
        raise


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def list_files(spark: SparkSession, path: str, min_bytes: int = 1) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below ``path`` (recursive) larger than ``min_bytes``.

    The ``binaryFile`` source prunes the ``content`` column, so only file metadata is listed.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime").where(F.col("length") > F.lit(min_bytes)))


def first_file(spark: SparkSession, path: str, min_bytes: int = 1) -> DataFrame:
    """The first qualifying file in path order (zero or one row)."""
    return list_files(spark, path, min_bytes).orderBy("path").limit(1)


_POINTER = "CURRENT"
#: A replaced version stays this long for those who read it (a day).
KEEP_MS = 24 * 3600 * 1000


def publish_snapshot(df: DataFrame, target: str, keep_ms: int = KEEP_MS, beside: DataFrame | None = None) -> str:
    """Make ``df`` the snapshot at ``target``.

    Each version has a folder of its own below ``target`` (so ``df`` may itself read the old one), and a one-line file
    names the current one. The switch is an atomic rename of that file. A failure before the switch leaves the old
    snapshot in place, never an empty path; of two publishers at once the later switch counts, whole. A frame read before
    a publish still reads its own version: versions are removed only by a publish ``keep_ms`` or more after the one that
    replaced them. ``beside`` is a table published in the same switch (see ``read_beside``).
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    version = f"version-{now_ms():015d}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{target}/{version}")
    if beside is not None:
        beside.write.parquet(f"{target}/beside-{version}")
    replace_file(spark, f"{target}/{_POINTER}", version)
    fs, path, _ = file_system(spark, target)
    found = folders(spark, target, "version-")
    versions = sorted(found)
    for old, successor in zip(versions[:-1], versions[1:], strict=True):
        replaced = fs.getFileStatus(path(found[successor])).getModificationTime()
        if f"version-{old}" != version and replaced <= now_ms() - keep_ms:
            remove(spark, f"{target}/version-{old}")
            remove(spark, f"{target}/beside-version-{old}")
    return target


def _current(spark: SparkSession, target: str) -> str | None:
    """Name of the current version below ``target``, or None."""
    try:
        require_path(spark, f"{target}/{_POINTER}")
    except NoDataSourceError:
        return None
    return spark.read.text(f"{target}/{_POINTER}").first()["value"]


def read_snapshot(spark: SparkSession, target: str) -> DataFrame | None:
    """The current snapshot, or None when none was published yet."""
    version = _current(spark, target.rstrip("/"))
    return spark.read.parquet(f"{target.rstrip('/')}/{version}") if version else None


def read_beside(spark: SparkSession, target: str) -> DataFrame | None:
    """The table published beside the current snapshot, or None when there is none."""
    target = target.rstrip("/")
    version = _current(spark, target)
    if version is None or version not in folders(spark, target, "beside-"):
        return None
    return spark.read.parquet(f"{target}/beside-{version}")
