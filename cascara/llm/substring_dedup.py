"""Removal of repeated word windows by level-wise doubling.

A window can only repeat if its halves do. Level by level (5, 10, 20 words for the window of 20) the windows whose
shorter windows all repeat are counted, and what repeats is extended to twice the length; the last level decides, and
the levels end early where no candidate survives in a chunk. The short levels only prune, so every second window (by
its hash, the same everywhere) and a few bytes of hash suffice there; the last level counts all candidates left with a
hash wide enough for the whole corpus.

Documents are grouped into bounded chunks once; the same shuffle serves all levels. Keys leave a chunk once each, so a
passage that a third of all documents share travels once per chunk, and what comes back is the chunk's own keys.

Defined cases: null and empty texts have no words; of rows with equal ids the one whose text sorts first counts as
earlier, a null id as later than all others; texts shorter than the window keep every word; an empty table gives no
rows; only ``doc_id`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cascara.llm.common import BLOBS, BUCKET_BYTES, buffers, by_chunk, chunked, combine, doc_words, key_width, mix, ordered, pack, prepare, repeated, reply_keys, text_bytes, to_blobs, unpack, windows

WINDOW = 20
SHORTEST = 5
LAST = "chunk long, bucket int, keys binary, rest binary, docs binary, many binary"
MINE = "chunk long, keys binary, mine binary"
RESULT = "doc_id long, text string, n_words long, n_removed long, spans array<struct<start: long, end: long>>"


def lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths of the levels: ``window`` halved while it stays whole and long enough."""
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= shortest:
        out.insert(0, out[0] // 2)
    return out


def _sampled(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(63) == 0


def _inside(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """Whether a window of ``size`` words that starts at each of n words ends in the same document."""
    end = np.repeat(first[1:], np.diff(first))
    return np.arange(n) + size <= end


def _candidates(h: np.ndarray, first: np.ndarray, shorter: int, size: int, replies: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows of ``size`` words whose counted windows of ``shorter`` words all repeat."""
    n = len(h)
    if n < size:
        return np.zeros(0, np.int64)
    part = windows(h, shorter)
    key = part & np.uint64(256**width - 1) if width < 8 else part
    asked = np.flatnonzero(_sampled(part) & _inside(first, n, shorter)[: len(part)])
    order = np.argsort(key[asked])
    again = np.zeros(len(asked), bool)
    if len(replies):
        sorted_keys = key[asked[order]]
        at = np.searchsorted(replies, sorted_keys)
        at[at == len(replies)] = 0
        again[order] = replies[at] == sorted_keys
    bad = np.zeros(len(part) + 1, np.int32)
    bad[asked[~again] + 1] = 1
    bad = np.cumsum(bad, dtype=np.int32)
    starts = np.arange(n - size + 1)
    good = bad[starts + size - shorter + 1] == bad[starts]
    return starts[good & _inside(first, n, size)[: n - size + 1]]


def _second(h: np.ndarray, size: int) -> np.ndarray:
    """Another hash of the windows, independent of the first."""
    return windows(mix(h + np.uint64(0x632BE59BD9B4E019)), size)


def deduplicate(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document the words that are left, joined by one space, and the removed spans (in words, end exclusive)."""
    prepare(docs.sparkSession)
    total = text_bytes(docs)
    frame = chunked(docs, total)
    sizes = lengths(window)
    narrow = key_width(total)
    buckets = max(1, math.ceil(total / 8 * narrow / BUCKET_BYTES))
    wide = min(16, max(9, math.ceil((2 * math.log2(max(2, total)) + 20) / 8)))  # bytes of the last level's hash

    def keys_of(table: pa.Table, size: int, starts: np.ndarray | None, h: np.ndarray, first: np.ndarray) -> pa.Table:
        part = windows(h, size)
        part = part[_inside(first, len(h), size)[: len(part)]] if starts is None else part[starts]
        part = part[_sampled(part)]
        return to_blobs(table["chunk"][0].as_py(), part & np.uint64(256**narrow - 1) if narrow < 8 else part, narrow, buckets)

    def begin(size: int):
        def work(table: pa.Table) -> pa.Table:
            _, _, _, first, h = doc_words(ordered(table), lower=False)
            return keys_of(table, size, None, h, first)

        return work

    def extend(shorter: int, size: int):
        def work(table: pa.Table, back: pa.Table) -> pa.Table:
            _, _, _, first, h = doc_words(table, lower=False)
            return keys_of(table, size, _candidates(h, first, shorter, size, reply_keys(back, narrow), narrow), h, first)

        return work

    replies = None
    for k, size in enumerate(sizes[:-1]):
        blobs = by_chunk(frame, replies, extend(sizes[k - 1], size), BLOBS) if k else frame.groupBy("chunk").applyInArrow(begin(size), BLOBS)
        replies = repeated(blobs, narrow)

    pruned = len(sizes) > 1

    def last_starts(table: pa.Table, back: pa.Table, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not pruned:
            return np.flatnonzero(_inside(first, len(h), window)[: max(0, len(h) - window + 1)])
        return _candidates(h, first, sizes[-2], window, reply_keys(back, narrow), narrow)

    def last(table: pa.Table, back: pa.Table) -> pa.Table:
        _, _, _, first, h = doc_words(table, lower=False)
        starts = last_starts(table, back, h, first)
        part = windows(h, window)[starts] if len(starts) else np.zeros(0, np.uint64)
        key, at, count = np.unique(part, return_index=True, return_counts=True)
        rest = _second(h, window)[starts[at]] if len(starts) else part
        ids = table["doc_id"].combine_chunks().fill_null(2**63 - 1).to_numpy()
        doc = ids[np.searchsorted(first, starts[at], "right") - 1] if len(starts) else np.zeros(0, np.int64)
        cuts = np.searchsorted(key, np.array([2**64 * b // buckets for b in range(buckets)], np.uint64)).tolist() + [len(key)]
        rows = [(b, slice(cuts[b], cuts[b + 1])) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        return pa.table(
            {
                "chunk": pa.array([table["chunk"][0].as_py()] * len(rows), pa.int64()),
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "keys": pa.array([pack(key[s], 8) for _, s in rows], pa.binary()),
                "rest": pa.array([pack(rest[s], wide - 8) for _, s in rows], pa.binary()),
                "docs": pa.array([pack(doc[s].view(np.uint64), 8) for _, s in rows], pa.binary()),
                "many": pa.array([np.packbits(count[s] > 1).tobytes() for _, s in rows], pa.binary()),
            }
        )

    def settle(table: pa.Table) -> pa.Table:
        """Of each chunk's windows those that occur elsewhere too, and whether the earliest of all is in the chunk."""
        blobs = table.to_pydict()
        keys = [unpack(x, 8) for x in blobs["keys"]]
        sizes_ = [len(k) for k in keys]
        key = np.concatenate(keys)
        rest = np.concatenate([unpack(x, wide - 8) for x in blobs["rest"]])
        doc = np.concatenate([unpack(x, 8) for x in blobs["docs"]]).view(np.int64)
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(blobs["many"], sizes_, strict=True)]).astype(bool)
        order = np.lexsort((doc, rest, key))
        new = np.ones(len(key), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (rest[order][1:] != rest[order][:-1])
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(key)))
        again = np.zeros(len(key), bool)
        again[order] = np.repeat((n > 1) | many[order[start]], n)
        mine = np.zeros(len(key), bool)
        mine[order[start]] = True
        out, at = [], 0
        for chunk, size in zip(blobs["chunk"], sizes_, strict=True):
            keep = again[at : at + size]
            if keep.any():
                out.append((chunk, pack(key[at : at + size][keep], 8), np.packbits(mine[at : at + size][keep]).tobytes()))
            at += size
        chunk, kept, own = zip(*out, strict=True) if out else ([], [], [])
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "keys": pa.array(kept, pa.binary()), "mine": pa.array(own, pa.binary())})

    if not pruned:
        blobs = frame.groupBy("chunk").applyInArrow(lambda table: last(ordered(table), table), LAST)
    else:
        blobs = by_chunk(frame, replies, last, LAST)
    decided = blobs.groupBy("bucket").applyInArrow(settle, MINE)

    def remove(table: pa.Table, back: pa.Table) -> pa.Table:
        data, _, _, first, h = doc_words(table, lower=False)
        covered = np.zeros(len(h), bool)
        keys = [unpack(k.as_py(), 8) for k in back["keys"]]
        if keys:
            mine = np.concatenate([np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(k)) for m, k in zip(back["mine"], keys, strict=True)]).astype(bool)
            key = np.concatenate(keys)
            order = np.argsort(key)
            key, mine = key[order], mine[order]
            part = np.where(_inside(first, len(h), window)[: len(h) - window + 1], windows(h, window), np.uint64(0))
            order = np.argsort(part, kind="stable")
            ranked = part[order]
            at = np.searchsorted(key, ranked)
            at[at == len(key)] = 0
            hit = key[at] == ranked
            earliest = np.ones(len(ranked), bool)
            earliest[1:] = ranked[1:] != ranked[:-1]
            starts = order[hit & ~(earliest & mine[at])]
            edge = np.zeros(len(h) + 1, np.int32)
            edge[starts] += 1  # starts are distinct
            edge[starts + window] -= 1
            covered = np.cumsum(edge[:-1]) > 0
        edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
        # A document's words end its spans: split what runs over two documents.
        cut = np.zeros(len(h) + 1, bool)
        cut[first] = True
        begins = np.flatnonzero((edges[:-1] == 1) | (covered & cut[:-1]))
        ends = np.flatnonzero((edges[1:] == -1) | (covered & cut[1:])) + 1
        raw = data.tobytes()
        texts, removed, spans = [], [], []
        offs = buffers(table["text"])[1]
        row = np.searchsorted(first, begins, "right") - 1
        for i in range(table.num_rows):
            words = raw[offs[i] : offs[i + 1]].split()
            a, b = first[i], first[i + 1]
            gone = covered[a:b]
            n = int(gone.sum())
            removed.append(n)
            if n:
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                j = row == i
                spans.append([{"start": x, "end": y} for x, y in zip((begins[j] - a).tolist(), (ends[j] - a).tolist(), strict=True)])
            else:
                spans.append([])
            texts.append(b" ".join(words))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }
        )

    return by_chunk(frame, decided, remove, RESULT)

