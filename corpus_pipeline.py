"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, benchmark text goes,
secrets are masked, and what is left is packed into sequences.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each
stage's result as Parquet to the shared checkpoint folder and reads it again as the next stage's input, so a lost
executor costs one stage's tasks at most. All stages but the last return the columns of ``documents``.

No SQL can express the stages (a trained classifier, byte-pair encoding and bin packing among them), so ``ORACLE_SQL``
is None; ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cascara.llm import bin_slack, ngram_join, secrets, suffix_decon, toxicity
from cascara.llm.common import stage
from cascara.llm.queries import table, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by word 5-grams at a Jaccard similarity of 0.8 or more, the document with the least id."""
    return ngram_join.unique(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    return suffix_decon.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of 1024."""
    return bin_slack.packed(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
