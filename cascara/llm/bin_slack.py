"""Packing of tokenised documents by minimum bin slack.

Every document is tokenised once and cut at multiples of the capacity; whole pieces are sequences by themselves. What
remains is a multiset of lengths below the capacity. Minimum bin slack seeds a sequence with the longest length left,
finds by a bitset subset-sum over the other lengths the multiset that comes closest to the capacity, backtracks how
many of each length it takes, and uses that pattern as often as the counts allow. The state is one count per length
(at most ``capacity`` of them), however many documents there are; pieces get their place from their rank within their
length, and no group of equal lengths meets in one task.

Defined cases: a null or empty text has the end id alone; repeated rows and equal texts are packed each for itself;
an empty table gives no rows; only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascara.llm.common import prepare, release, stage

CAPACITY = 1024
END = np.uint32(0).tobytes()
#: Pieces of one length ranked together in one task.
RANKED = 100_000
#: Chunks of text whose ids a worker remembers.
CACHED = 300_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """A byte-level BPE encoder for the vocabulary of a ``tokenizers`` file: merge ranks are ids there."""
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the file writes as themselves
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    with open(vocabulary, encoding="utf-8") as f:
        file = json.load(f)
    special = {t["content"] for t in file["added_tokens"]}
    ranks = {bytes(letter[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class _Ids(dict):
    """Ids (little-endian 32-bit) of `` `` + word, remembered up to CACHED words."""

    def __init__(self, vocabulary: str):
        self.encode = encoder(vocabulary).encode_ordinary
        with open(vocabulary, encoding="utf-8") as f:
            self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in json.load(f)["added_tokens"]}
        self.split = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        ids = np.array(self.encode(" " + word), "<u4").tobytes()
        if len(word) <= 40:
            self[word] = ids
        return ids


_BREAK = re.compile(r"\s ")


def token_bytes(text: str, ids: _Ids) -> bytes:
    """The ids of a text: those of the file's added tokens, wherever their literals stand, and of what is between them."""
    if not ids.split.search(text):
        return _between(text, ids)
    parts = [p for p in ids.split.split(text) if p]
    return b"".join(ids.added[p] if p in ids.added else _between(p, ids) for p in parts)


def _between(text: str, ids: _Ids) -> bytes:
    """The ids of a text without added tokens. Byte-level BPE never joins across a space that follows a visible character, so what stands
    between two of these is encoded alone (and mostly known already)."""
    if _BREAK.search(text):
        return np.array(ids.encode(text), "<u4").tobytes()
    head, *rest = text.split(" ")
    first = np.array(ids.encode(head), "<u4").tobytes() if head else b""
    return first + b"".join(map(ids.__getitem__, rest))


@lru_cache(maxsize=2)
def _ids(vocabulary: str) -> _Ids:
    return _Ids(vocabulary)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and the end id, cut at multiples of the capacity: a row per piece."""
    prepare(docs.sparkSession)
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = token_bytes(text.as_py() or "", ids) + END
                n = len(raw) // 4
                rows += [(doc, a // 4, min(len(raw) - a, width) // 4, zlib.crc32(raw[a : a + width]), n) for a in range(0, len(raw), width)]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def min_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (times, [(length, how many in each sequence)]) that use up ``counts``, each as full as what is left
    allows. A pattern is used until one of its lengths runs short, so there are about as many patterns as lengths."""
    left = {k: v for k, v in counts.items() if v}
    out = []
    while left:
        seed = max(left)
        target = capacity - seed
        reach, steps, full = 1, [], (1 << (target + 1)) - 1
        for length in sorted(left, reverse=True):
            if reach >> target & 1:
                break
            most = min(left[length] - (length == seed), target // length)
            if most <= 0:
                continue
            steps.append((length, most, reach))
            took = 1
            while most:  # 1, 2, 4, ... copies at once reach every number of copies
                took = min(took, most)
                reach |= reach << (took * length) & full
                most -= took
                took *= 2
        at = reach.bit_length() - 1
        picked = {seed: 1}
        for length, most, before in reversed(steps):
            n = next(j for j in range(most + 1) if at >= j * length and before >> (at - j * length) & 1)
            if n:
                picked[length] = picked.get(length, 0) + n
                at -= n * length
        times = min(left[k] // n for k, n in picked.items())
        for k, n in picked.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
        out.append((times, sorted(picked.items(), reverse=True)))
    return out


def places(patterns: list[tuple[int, list[tuple[int, int]]]], capacity: int) -> tuple[list[tuple], int]:
    """For each length the ranges of ranks that a pattern takes: (length, [(from, first sequence, per sequence,
    offset)]), and the number of sequences."""
    taken: dict[int, int] = {}
    ranges: dict[int, list[tuple]] = {}
    sequence = 0
    for times, items in patterns:
        offset = 0
        for length, n in items:
            ranges.setdefault(length, []).append((taken.get(length, 0), sequence, n, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return sorted(ranges.items()), sequence


def packed(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece with its sequence and its offset there."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, vocabulary, capacity), "packing-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    ranges, sequences = places(min_slack({k: v for k, v in counts.items() if k < capacity}, capacity), capacity)
    parts = max(1, math.ceil(max(counts.values(), default=0) / RANKED))
    part = F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts))
    cut = cut.withColumn("part", part)
    before = cut.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = cut.withColumn("at", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32"))).join(before, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("at") - 1)
    # One row per length below the capacity, each with about as many ranges as patterns use it.
    table = spark.createDataFrame([(k, v) for k, v in ranges], "length long, ranges array<struct<lo: long, sequence: long, n: long, offset: long>>")
    found = ranked.join(F.broadcast(table), "length", "left").withColumn("range", F.element_at(F.filter("ranges", lambda r: r["lo"] <= F.col("rank")), -1))
    back = F.col("rank") - F.col("range.lo")
    whole = F.col("length") == capacity
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.when(whole, F.lit(sequences) + F.col("rank")).otherwise(F.col("range.sequence") + F.floor(back / F.col("range.n"))).cast("long").alias("sequence_id"),
        F.when(whole, F.lit(0)).otherwise(F.col("range.offset") + F.pmod(back, F.col("range.n")) * F.col("length")).cast("long").alias("offset"),
    )
