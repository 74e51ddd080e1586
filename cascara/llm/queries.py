"""The registered queries of the operators, with production parameters over whole tables. ``ORACLE`` has DuckDB SQL
where SQL can express the query."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm import bin_slack, equal_average, html_paths, kneser_ney, ngram_join, nn_descent, ptolemaic, reshard, run_length_dedup, secrets, substring_dedup, suffix_decon, toxicity
from cascara.llm.sql import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_file() -> str:
    """The vocabulary of the packing query: a file of the installed public tokenizers."""
    import public_tokenizers

    return os.environ.get("CASCARA_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_paths.extract(table(spark, sf_dir, "pages"))


@query
def op2_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    return suffix_decon.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_level_wise_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words that repeat earlier ones, removed from every document."""
    out = substring_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secrets.spans(table(spark, sf_dir, "documents"))
    counts = [secrets.count_of(k).alias(f"n_{k}") for k in secrets.KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(secrets.written("base"), 256).alias("base_sha256"), secrets.written("spans").alias("spans"))


@query
def op5_min_cost_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from 32 old shards to 40 of equal bytes: written there, and listed from the files."""
    docs = table(spark, sf_dir, "documents")
    out = reshard.moved(docs, reshard.place_in_file(docs))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query
def op6_vertical_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under links of word 5-grams with a Jaccard similarity of 0.8 or more."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


@query
def op7_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by a 200-byte string that starts elsewhere too, removed."""
    out = run_length_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows, by inner product, of every embedding whose id is divisible by 20."""
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op9_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 1024 tokens."""
    return bin_slack.packed(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op10_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_ptolemaic_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of the embeddings after three rounds."""
    return ptolemaic.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Kneser-Ney model of the training documents."""
    out = kneser_ney.score(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})  # sums of any order agree so far


@query
def op13_equal_average_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings in four parts of 256 entries after four rounds."""
    return equal_average.encode(table(spark, sf_dir, "embeddings"))
