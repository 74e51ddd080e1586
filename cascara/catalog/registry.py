"""The registry the catalog modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional oracle SQL text."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a parquet dataset directory or file)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
