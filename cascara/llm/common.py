"""Shared pieces of the text operators: sizing, chunked grouping, vectorised tokenising and hashing, and the packed
exchange that tells every chunk which of its keys occur elsewhere.

A *chunk* is a bounded group of whole documents (about ``CHUNK_BYTES`` of text) that one task handles with numpy. Keys
leave a chunk once each, sorted and packed as binary blobs (pre-aggregation: a key held by a third of all rows travels
once per chunk), are counted per key bucket, and only the keys that pass the test go back to their chunk.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.session import scratch_path, ship_package

CHUNK_BYTES = 2_000_000
BUCKET_BYTES = 4_000_000

#: ASCII white space: space and \t \n \v \f \r.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes outside a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing).
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[48:58] = _NOT_ALNUM[97:123] = _NOT_ALNUM[128:] = False

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def byte_table(seed: int = 1) -> np.ndarray:
    """A 64-bit value for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the concatenation of two strings from their hashes (not commutative)."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA0761D6478BD642F)))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def find_words(data: np.ndarray, offs: np.ndarray, kind: str = "space") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of every word, and the first word's index of each row (with the total at the end).
    ``space``: words are runs without ASCII white space; ``alnum``: runs of digits, a-z and bytes over 0x7F."""
    word = ~(_SPACE if kind == "space" else _NOT_ALNUM)[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = False, False
    edge[1:-1] = word[:-1]
    rows = offs[:-1][offs[:-1] < len(data)]
    edge[rows] = False
    starts = np.flatnonzero(word & ~edge[:-1])
    edge[:-1] = word
    edge[-1] = False
    edge[offs[1:]] = False  # what stands after a row's last byte is another row
    ends = np.flatnonzero(word & ~edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each word, never 0."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    longest = int(sizes.max())
    power = np.cumprod(np.full(longest + 1, _BASE | 1, np.uint64))
    first = int(starts[0])
    data = data[first : int(ends[-1])]
    starts, ends = starts - first, ends - first
    begins = np.zeros(len(data), np.int32)
    begins[starts] = 1
    at = np.arange(len(data), dtype=np.int32) - starts.astype(np.int32)[np.cumsum(begins, dtype=np.int32) - 1]
    inside = at < np.repeat(sizes, np.diff(np.append(starts, len(data))))
    value = byte_table(seed)[data] * power[np.minimum(at, longest)]
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts) + sizes.astype(np.uint64)) | np.uint64(1)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive items, by doubling; shorter than the input by size - 1."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    if size == 1:
        return h
    half = size // 2
    part = windows(h, half)
    out = combine(part[: len(part) - half], part[half:])
    return combine(out[:-1], h[size - 1 :]) if size % 2 else out


def pack(keys: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each key, byte plane by byte plane (high planes of sorted keys compress)."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(blob: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted array."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def release() -> None:
    """Give a worker's freed memory back to the system: the same Python workers serve one stage after another, and what
    each has once used would add up otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (one aggregate over one column)."""
    return docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0


def chunked(docs: DataFrame, total: int, target: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, doc_id, text): whole documents dealt by a hash of their id into groups of about ``target`` bytes.
    Rows with the same id meet in one chunk."""
    n = max(1, math.ceil(total / target))
    return docs.select(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(n)).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ordered(table: pa.Table) -> pa.Table:
    """A chunk's rows in the same order whenever they are computed: by id, then by text."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def doc_words(table: pa.Table, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first word of each row, word hashes) of a chunk."""
    data, offs = buffers(table["text"])
    if lower:
        data = LOWER[data]
    starts, ends, first = find_words(data, offs)
    return data, starts, ends, first, hash_words(data, starts, ends)


def key_width(total: int, spare_bits: int = 6, pairs: int = 1) -> int:
    """Bytes of a key so that ``total`` random keys seldom collide: once in 2**spare_bits per key (pairs=1), or with
    that odds in all (pairs=2)."""
    return min(8, max(3, math.ceil((pairs * math.log2(max(2, total)) + spare_bits) / 8)))


BLOBS = "chunk long, bucket int, keys binary, many binary"


def to_blobs(chunk: int, keys: np.ndarray, width: int, buckets: int) -> pa.Table:
    """A chunk's keys (multiset) as a row per bucket: each key once, with a bit that says it occurs again here."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(keys))) > 1
    keys = keys[first]
    cuts = np.searchsorted(keys, bucket_edges(width, buckets))
    at = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(at), pa.int64()),
            "bucket": pa.array(at, pa.int32()),
            "keys": pa.array([pack(keys[cuts[b] : cuts[b + 1]], width) for b in at], pa.binary()),
            "many": pa.array([np.packbits(many[cuts[b] : cuts[b + 1]]).tobytes() for b in at], pa.binary()),
        }
    )


def bucket_edges(width: int, buckets: int) -> np.ndarray:
    """Lower bounds of the key ranges, and a last bound above every key."""
    top = 256**width
    return np.array([top * b // buckets for b in range(buckets)] + [top - 1], np.uint64)


REPLIES = "chunk long, keys binary"


def repeated(blobs: DataFrame, width: int) -> DataFrame:
    """(chunk, keys): of each chunk's keys those that occur more than once over all chunks, or twice in it."""

    def count(table: pa.Table) -> pa.Table:
        release()
        rows = [unpack(k.as_py(), width) for k in table["keys"]]
        many = [np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(k)).astype(bool) for m, k in zip(table["many"], rows, strict=True)]
        keys = np.sort(np.concatenate([*rows, *(k[m] for k, m in zip(rows, many, strict=True))]))
        again = np.unique(keys[1:][keys[1:] == keys[:-1]])
        out = [k[member(k, again)] for k in rows]
        keep = [i for i, k in enumerate(out) if len(k)]
        return pa.table({"chunk": table["chunk"].combine_chunks().take(pa.array(keep, pa.int64())).cast(pa.int64()), "keys": pa.array([pack(out[i], width) for i in keep], pa.binary())})

    return blobs.groupBy("bucket").applyInArrow(count, REPLIES)


def reply_keys(replies: pa.Table, width: int) -> np.ndarray:
    """All keys that came back to a chunk, sorted."""
    parts = [unpack(k.as_py(), width) for k in replies["keys"] if k.is_valid]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def by_chunk(frame: DataFrame, replies: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each chunk of documents together with what came back to it."""

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        release()  # of the chunk before
        return work(ordered(left), right)

    return frame.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(whole, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the tasks."""
    ship_package(spark)


def slices(batches: Iterator[pa.RecordBatch], column: str, target: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``target`` text bytes (a longer single text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(buffers(batch.column(column))[1])
        group = (np.cumsum(sizes) - sizes) // target
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)
            release()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for undirected edges (a, b) of long ids: the least id that each node reaches. Alternates
    taking the least label among neighbours with jumping to the label's own label; each round is written out."""
    edges = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), f"{name}-edges")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), f"{name}-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = labels.join(near, "node").join(jump, "component", "left").select("node", F.least("component", "near", F.coalesce("far", "component")).alias("component"), F.col("component").alias("was"))
        new = stage(new, f"{name}-labels")
        labels = new.select("node", "component")
        if new.where("component != was").isEmpty():
            return labels
