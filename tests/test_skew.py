"""Hot keys: one key / label / value holding a third of the rows must give exact results and stay pre-aggregated."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from cascara.operators import clean as C
from cascara.operators import evaluate as EV
from cascara.operators import profile as PR


def _hot(spark, n=3000):
    # a third of the rows share key NULL (and label 0); the rest are spread
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5).cast("long").alias("label"),
        (F.col("id") * 7 % 1000).alias("v"), F.col("id"))


def test_dedup_hot_key_exact_and_map_side(spark):
    df = _hot(spark)
    got = {r.k: (r.v, r.id) for r in C.dedup_by_key(df, "k", ["v"]).collect()}
    w = Window.partitionBy("k").orderBy("v", "label", "id")
    ref = {r.k: (r.v, r.id) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    assert got == ref
    plan = C.dedup_by_key(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # combined before the shuffle


def test_folds_with_hot_label_are_balanced(spark):
    df = _hot(spark)
    f = EV.stratified_folds(df, "id", "label", 3).groupBy("label", "fold").count().toPandas()
    per = f.pivot(index="label", columns="fold", values="count")
    assert ((per.max(axis=1) - per.min(axis=1)) <= 1).all()
    assert per.loc[0].sum() == df.where("label = 0").count()


def test_quantiles_with_hot_value(spark):
    vals = np.concatenate([np.full(1000, 3.0), np.arange(2000, dtype=float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "value double").select(F.lit("x").alias("feature"), "value")
    got = PR.exact_quantiles(df, [0.25, 0.5, 0.75])
    for p in (0.25, 0.5, 0.75):
        assert got[("x", p)] == float(np.quantile(vals, p))


def test_value_counts_hot_value(spark):
    df = _hot(spark)
    got = {r.value: r.n for r in PR.value_counts(df, ["k"]).collect()}
    assert None not in got and sum(got.values()) == 2000


def test_stream_consumes_landing_once_with_archive(spark, churn01):
    from cascara.plans import churn as P
    from cascara.session import scratch_path
    from cascara.sources import files as IO
    from cascara.sources.churn import CHURN_SCHEMA
    from cascara.streaming.ingest import ingest_landing, read_sink

    landing, archive = scratch_path(spark, "a-landing"), scratch_path(spark, "a-archive")
    IO.write_csv(churn01, landing, partitions=3, key="customerID")
    sink, ckpt = scratch_path(spark, "a-sink"), scratch_path(spark, "a-ckpt")
    ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, P.clean, max_files_per_trigger=1,
                   clean_source="archive", archive_dir=archive)
    ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, P.clean, max_files_per_trigger=1,
                   clean_source="archive", archive_dir=archive)
    assert read_sink(spark, sink).count() == 1278
    # consumed files were moved out of the landing folder (the last batch's files move on the next run)
    left = IO.list_files(spark, landing, 1).where(F.col("path").endswith(".csv")).count()
    assert left < 3
