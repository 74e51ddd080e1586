"""Session helpers: a local session for tests and the scratch folder every job writes to.

On a cluster the caller owns the session and sets ``spark.checkpoint.dir`` to a shared folder; every
intermediate table this library writes goes below it. Only when it is unset (tests, local runs) do we
create a local folder and register it as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "cascara") -> SparkSession:
    """Local session with the settings the tests and the bench use (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CASCARA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's checkpoint dir.

    Read from the running context first, then from ``spark.checkpoint.dir``; set a local one only when
    neither is present and the master is local (tests). On a cluster a missing folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cascara-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the scratch root (never reused, never cleared by us)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the scratch root and read back: several jobs can use it, and its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers that run its Arrow kernels: zip it once per application
    and register it with ``addPyFile`` — what ``spark-submit --py-files`` does — so executors fetch it from the
    driver whatever their working directory or installed packages."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="cascara-", suffix=".zip")  # a driver-side artifact Spark serves
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
