"""A table's manifest: one small JSON file that says which folders are its present state and which input they include.

It is written beside the old one and moved over it by an atomic rename, so a reader sees the old state or the new one,
and a job that fails on the way leaves the old one. Paths are any Hadoop URI with an atomic rename.
"""

from __future__ import annotations

import json
import time
import uuid
from typing import Any

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, Path class, configuration) of a path."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path
    return hpath(path).getFileSystem(conf), hpath, conf


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file by an atomic rename over the old one."""
    fs, hpath, conf = file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    fresh = hpath(f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fresh, hpath(path), overwrite)


def read_manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The manifest at ``path``, or None before the first one."""
    fs, hpath, _ = file_system(spark, path)
    if not fs.exists(hpath(path)):
        return None
    stream = fs.open(hpath(path))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_manifest(spark: SparkSession, path: str, state: dict[str, Any]) -> None:
    replace_file(spark, path, json.dumps(state, sort_keys=True))


def folders(spark: SparkSession, path: str, prefix: str) -> dict[str, str]:
    """{rest of the name: path} of the folders below ``path`` whose names start with ``prefix``."""
    fs, hpath, _ = file_system(spark, path)
    if not fs.exists(hpath(path)):
        return {}
    found = [s.getPath() for s in fs.listStatus(hpath(path)) if s.isDirectory()]
    return {p.getName()[len(prefix):]: p.toString() for p in found if p.getName().startswith(prefix)}


def remove(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = file_system(spark, path)
    fs.delete(hpath(path), True)


def now_ms() -> int:
    return int(time.time() * 1000)
