"""Fuzzy vocabulary repair: replace each value by the closest allowed word when the similarity reaches a threshold,
else by NULL; NULL stays NULL.

No per-row Python and no product of values and words. A score of the threshold allows at most k edits between strings of
given lengths; a word cut into k + 1 segments then keeps one of them unchanged, shifted by k places at most. Words and the
distinct values of a column meet only where lengths allow the threshold and such a segment is shared, by an equi-join; the
pairs are scored with native expressions, the best word per value is picked by an aggregate, and the resulting value map
is joined back to the table, one left join per column. The map is written once, so its size is known to the joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.functions.text import SCORERS
from cascara.operators.reshape import to_long
from cascara.session import written


def vocabulary_frame(spark, vocab: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(column, pos, choice)``: the allowed words per column, in their given order."""
    rows = [(c, i, w) for c, words in vocab.items() for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "column string, pos int, choice string")


def most_edits(scorer: str, threshold: float, a: Column, b: Column) -> Column:
    """Edits that strings of lengths a and b can differ by at a score of the threshold (a number of insertions and
    deletions is never below the number of edits)."""
    size = F.greatest(a, b) if scorer == "levenshtein" else a + b
    return F.floor(size * (1 - threshold / 100) + 1e-9).cast("int")


def near_lengths(scorer: str, threshold: float, own: Column, longest: int) -> Column:
    """Lengths of strings that can reach the threshold with one of length ``own``: the shorter has at least t of the
    longer (Levenshtein) or t / (2 - t) of it (insertions and deletions)."""
    t = max(0.0, threshold / 100)
    part = t if scorer == "levenshtein" else t / (2 - t)
    low = F.ceil(own * part - 1e-9).cast("int")
    high = F.least(F.lit(longest), F.floor(own / part + 1e-9).cast("int")) if part > 0 else F.lit(longest)
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def _segments(rows: DataFrame, scorer: str, threshold: float) -> DataFrame:
    """Adds the segments of a word of length ``word_n`` against a value of length ``value_n``: ``k``, ``i``, ``begin``, ``n``."""
    k = most_edits(scorer, threshold, F.col("word_n"), F.col("value_n"))
    rows = rows.withColumn("k", k).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
    rows = rows.withColumn("begin", F.expr("int(i * word_n div (k + 1))"))
    return rows.withColumn("n", F.expr("int((i + 1) * word_n div (k + 1)) - begin"))


def near_pairs(values: DataFrame, words: DataFrame, scorer: str, threshold: float) -> DataFrame:
    """``(column, value, pos, choice)``: all pairs that can reach the threshold, and few others. ``values`` is (column,
    value), ``words`` (column, pos, choice)."""
    ends = values.agg(F.max(F.length("value")).alias("a")).first()["a"], words.agg(F.max(F.length("choice")).alias("a")).first()["a"]
    longest = [e or 0 for e in ends]
    w = words.withColumn("word_n", F.length("choice")).withColumn("value_n", F.explode(near_lengths(scorer, threshold, F.col("word_n"), longest[0])))
    w = _segments(w, scorer, threshold).withColumn("segment", F.expr("substring(choice, begin + 1, n)"))
    v = values.withColumn("value_n", F.length("value")).withColumn("word_n", F.explode(near_lengths(scorer, threshold, F.col("value_n"), longest[1])))
    v = _segments(v, scorer, threshold).withColumn("low", F.greatest(F.lit(0), F.col("begin") - F.col("k"))).withColumn("high", F.least(F.col("value_n") - F.col("n"), F.col("begin") + F.col("k")))
    v = v.where("low <= high").withColumn("at", F.explode(F.sequence("low", "high"))).withColumn("segment", F.expr("substring(value, at + 1, n)"))
    key = ["column", "word_n", "value_n", "i", "segment"]
    v = v.select(*key, "value").distinct()
    return v.join(w.select(*key, "pos", "choice"), key).select("column", "value", "pos", "choice").distinct()


def repair_map(df: DataFrame, vocab: Mapping[str, Sequence[str]] | DataFrame, scorer: str = "levenshtein",
               threshold: float = 80.0, scored_from: float = 0.0) -> DataFrame:
    """``(column, value, fixed, score)`` for every distinct non-NULL value of the vocabulary columns: the best word, where
    it reaches the threshold, and its score, where that reaches ``scored_from``. From 0 on, the default, values meet all
    words of their column, which suits a report over a small vocabulary; from the threshold on only those that can reach
    it. ``vocab`` may be a frame (column, pos, choice) of any size.

    Ties between words go to the word listed first.
    """
    score = SCORERS[scorer]
    words = vocab if isinstance(vocab, DataFrame) else vocabulary_frame(df.sparkSession, vocab)
    columns = [r["column"] for r in words.select("column").distinct().collect()] if isinstance(vocab, DataFrame) else list(vocab)  # column names
    values = to_long(df, columns, "string", "column", "value").where(F.col("value").isNotNull()).distinct()
    values = written(values, "repair-values")
    pairs = near_pairs(values, words, scorer, scored_from) if scored_from > 0 else values.join(words, "column")
    scored = pairs.withColumn("score", score(F.col("value"), F.col("choice"))).where(F.col("score") >= F.lit(float(scored_from)))
    best = scored.groupBy("column", "value").agg(
        F.max(F.struct(F.col("score"), (-F.col("pos")).alias("npos"), F.col("choice"))).alias("b"))
    return values.join(best, ["column", "value"], "left").select("column", "value", F.when(F.col("b.score") >= F.lit(float(threshold)), F.col("b.choice")).alias("fixed"), F.col("b.score").alias("score"))


def fuzzy_repair(df: DataFrame, vocab: Mapping[str, Sequence[str]] | DataFrame, scorer: str = "levenshtein",
                 threshold: float = 80.0) -> DataFrame:
    """Every vocabulary column replaced by its repaired value; other columns untouched, column order kept."""
    mapping = written(repair_map(df, vocab, scorer, threshold, threshold).select("column", "value", "fixed"), "repair-map")
    out = df
    for c in [r["column"] for r in vocab.select("column").distinct().collect()] if isinstance(vocab, DataFrame) else vocab:
        m = mapping.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("fixed").alias("__fix"))
        out = (out.join(m, out[c] == m["__v"], "left")
               .withColumn(c, F.col("__fix")).drop("__v", "__fix"))
    return out.select(*df.columns)
