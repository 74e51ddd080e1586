"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of bounded size and sorts the shard's word suffixes (prefix doubling, ranks and
positions packed in one 64-bit word so that plain sorts do the work). Every suffix of every benchmark item is then
binary-searched in the shard word by word, all of them at once; the range that is left holds the places of the verbatim
match, which is followed to its end: the longest match and its location. Words that longest matches cover are hit.
Documents stay where they are: nothing is shuffled, and the shards are as many as the data need.

The benchmark is the only side that goes to every task, in slices of about ``ITEM_BYTES`` (by item id and text) that are
searched one after the other within the same stage.

Defined cases: null and empty texts have no words and are clean; an item without words hits nothing; equal item ids
count as one item; an item with a null id is searched like any other, and its words count as hit, but it is no counted or
listed item; repeated documents are judged each for itself; an empty table of documents gives no rows, an empty
benchmark leaves every document clean; only the named columns are read, other columns may have any name (``clean``
returns them all).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import LOWER, buffers, find_words, hash_words, prepare, slices

WINDOW = 10
#: Text bytes and words of a shard; a shard has at most 2**21 suffixes unless one document is longer.
SHARD_BYTES = 4_000_000
PACKED = 21
#: Text bytes of a slice of the benchmark.
ITEM_BYTES = 8_000_000


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with a 0 after each text, and each text's first place (and the length)."""
    data, offs = buffers(texts)
    starts, ends, first = find_words(LOWER[data], offs, "alnum")
    out = np.zeros(len(starts) + len(offs) - 1, np.uint64)
    rows = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    out[np.arange(len(starts)) + rows] = hash_words(LOWER[data], starts, ends)
    return out, first + np.arange(len(offs))


def sort_packed(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of (high, low) pairs, and where a new pair begins in it."""
    n = len(high)
    if 3 * bits <= 64:
        x = np.sort((high.astype(np.uint64) << np.uint64(2 * bits)) | (low.astype(np.uint64) << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
        order = (x & np.uint64((1 << bits) - 1)).astype(np.int64)
        x >>= np.uint64(bits)
    else:
        x = (high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)
        order = np.argsort(x, kind="stable")
        x = x[order]
    new = np.ones(n, bool)
    new[1:] = x[1:] != x[:-1]
    return order, new


def suffix_array(h: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``h`` ordered by the next ``depth`` values at least (0 ends a text and precedes every value)."""
    n = len(h)
    bits = max(1, (n - 1).bit_length(), (n + 1).bit_length())
    order = np.argsort(h, kind="stable")
    new = np.ones(n, bool)
    new[1:] = h[order][1:] != h[order][:-1]
    start = np.flatnonzero(new)
    rank = np.zeros(n + 1, np.int64)  # rank n: past the end, below all
    rank[order] = np.repeat(start, np.diff(np.append(start, n))) + 1
    single = new & np.append(new[1:], True)
    rows = np.flatnonzero(~single)
    rows = rows[h[order[rows]] != 0]  # what follows the end of a text does not matter
    step = 1
    while step < depth and len(rows):
        at = order[rows]
        moved, new = sort_packed(rank[at], rank[np.minimum(at + step, n)], bits)
        at = at[moved]
        order[rows] = at
        start = np.flatnonzero(new)
        sizes = np.diff(np.append(start, len(rows)))
        rank[at] = np.repeat(rows[start], sizes) + 1
        rows = rows[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


def find_ranges(h: np.ndarray, order: np.ndarray, queries: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query ``queries[begin : begin + size]`` the range of ``order`` whose suffixes start with it."""
    low, high = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    first = h[order]
    low, high = np.searchsorted(first, queries[begin]), np.searchsorted(first, queries[begin], "right")
    alive = np.flatnonzero((high > low) & (size > 1))
    depth = 1
    while len(alive):
        want = queries[begin[alive] + depth]
        ends = []
        for right in (False, True):
            a, b = low[alive].copy(), high[alive].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                got = h[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, len(h) - 1)]
                up = open_ & ((got <= want) if right else (got < want))
                a = np.where(up, mid + 1, a)
                b = np.where(open_ & ~up, mid, b)
            ends.append(a)
        low[alive], high[alive] = ends
        depth += 1
        alive = alive[(ends[1] > ends[0]) & (size[alive] > depth)]
    return low, high


class Items:
    """The suffixes of benchmark items that are searched: each with its item, its place there and its window size."""

    def __init__(self, ids: list, texts: list[str | None], window: int):
        self.window = window
        self.ids = np.array([None if i is None else str(i) for i in ids], object)
        self.words, first = words(pa.array(texts, pa.string()))
        n = np.diff(first) - 1
        count = np.where(n >= window, n - window + 1, (n > 0).astype(np.int64))
        self.item = np.repeat(np.arange(len(n)), count)
        self.place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.begin = first[:-1][self.item] + self.place
        self.size = np.minimum(n, window)[self.item]

    def matches(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(words, first word of each text, suffix, position) of every place where a window of an item occurs."""
        h, first = words(texts)
        none = np.zeros(0, np.int64)
        if not len(self.item) or not len(h):
            return h, first, none, none
        order = suffix_array(h, self.window)
        low, high = find_ranges(h, order, self.words, self.begin, self.size)
        n = high - low
        suffix = np.repeat(np.arange(len(n)), n)
        position = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return h, first, suffix, position

    def longest(self, h: np.ndarray, suffix: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How many words each match goes on for, both texts read until they differ or one ends."""
        size = self.size[suffix].copy()
        alive = np.arange(len(suffix))
        while len(alive):
            a, b = self.begin[suffix[alive]] + size[alive], position[alive] + size[alive]
            alive = alive[(self.words[a] == h[b]) & (h[b] != 0)]
            size[alive] += 1
        return size


def item_slices(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in slices of at most about ITEM_BYTES."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = math.ceil(total / ITEM_BYTES)
    return [rows] if n <= 1 else [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _items(rows: DataFrame, window: int) -> Items:
    got = rows.collect()  # at most about ITEM_BYTES, see item_slices
    return Items([r["item_id"] for r in got], [r["text"] for r in got], window)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every verbatim match: item_id, item_start, doc_id, doc_start, n_words (the longest match from there), all in
    words from 0."""
    prepare(docs.sparkSession)
    schema = "item_id string, item_start long, doc_id long, doc_start long, n_words long"

    def search(items: Items) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", SHARD_BYTES):
                h, first, suffix, position = items.matches(batch.column("text"))
                row = np.searchsorted(first, position, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(items.ids[items.item[suffix]], pa.string()), pa.array(items.place[suffix], pa.int64()),
                        batch.column("doc_id").take(pa.array(row)), pa.array(position - first[row], pa.int64()), pa.array(items.longest(h, suffix, position), pa.int64()),
                    ],
                    ["item_id", "item_start", "doc_id", "doc_start", "n_words"],
                )

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, schema)

    out = None
    for rows in item_slices(benchmark):
        found = search(_items(rows, window))
        out = found if out is None else out.unionByName(found)
    return out


def _judge(items: Items, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
    """First word of each text (and the words' number), begins and ends of the runs of hit words (no run goes over a
    text's end), and the items that occur in each text. The runs come from the longest matches: of a match's suffixes
    only the first, which no equal word precedes, is followed to its end; it covers the others."""
    h, first, suffix, position = items.matches(texts)
    begin = items.begin[suffix]
    inner = (items.place[suffix] > 0) & (position > 0)
    inner[inner] = items.words[begin[inner] - 1] == h[position[inner] - 1]
    starts = position[~inner]
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + items.longest(h, suffix[~inner], starts), -1)
    hit = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)]))
    row = np.searchsorted(first, position, "right") - 1
    found: list[list[str]] = [[] for _ in range(len(first) - 1)]
    pairs = np.unique(row * len(items.ids) + items.item[suffix]) if len(row) else []
    for p in pairs:
        if items.ids[p % len(items.ids)] is not None:
            found[p // len(items.ids)].append(items.ids[p % len(items.ids)])
    return first, np.flatnonzero(hit == 1), np.flatnonzero(hit == -1), found


#: What a search hands on: runs of hit words (begin, end) and items found so far.
FOUND = "doc_id long, text string, n_words long, runs array<struct<a: long, b: long>>, items array<string>"


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words inside a window of an item, items with such windows and their digest, and whether
    any word is hit. The slices of the benchmark are searched one after the other, each row where it is: a search
    hands on the texts with what it and those before have found."""
    prepare(docs.sparkSession)
    none = F.array()
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), none.cast("array<struct<a: long, b: long>>").alias("runs"), none.cast("array<string>").alias("items"))
    parts = item_slices(benchmark)
    for k, part in enumerate(parts):
        out = out.mapInArrow(_search(_items(part, window), k == len(parts) - 1), FOUND)
    # Runs of several slices may overlap.
    step = F.aggregate(
        F.array_sort("runs"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["to"], x["a"]))).alias("n"), F.greatest(s["to"], x["b"]).alias("to")),
    )["n"]
    names = F.array_sort(F.array_distinct("items"))
    judged = out.select("doc_id", "n_words", step.alias("n_hit"), names.alias("items"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _search(items: Items, last: bool):
    """The rows with the runs and items that a slice adds; the last search hands on no texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            first, begins, ends, found = _judge(items, batch.column("text"))
            row = np.searchsorted(first, begins, "right") - 1
            runs = batch.column("runs").to_pylist()
            for i, a, b in zip(row.tolist(), (begins - first[row]).tolist(), (ends - first[row]).tolist(), strict=True):
                runs[i].append({"a": a, "b": b})
            names = [[*old, *new] for old, new in zip(batch.column("items").to_pylist(), found, strict=True)]
            text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, pa.array(np.diff(first) - 1, pa.int64()), pa.array(runs, batch.column("runs").type), pa.array(names, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "runs", "items"],
            )

    return work


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any word inside a window of an item, with all their columns; each row is judged for
    itself, where it is, so documents are not shuffled."""
    prepare(docs.sparkSession)
    out = docs
    for part in item_slices(benchmark):
        items = _items(part, window)

        def work(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", SHARD_BYTES):
                first, begins, _, _ = _judge(items, batch.column("text"))
                clean_ = np.ones(batch.num_rows, bool)
                clean_[np.searchsorted(first, begins, "right") - 1] = False
                yield batch.filter(pa.array(clean_))

        out = out.mapInArrow(work, docs.schema)
    return out
