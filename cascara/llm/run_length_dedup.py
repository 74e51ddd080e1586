"""Removal of long verbatim byte matches with run-length compressed Burrows-Wheeler indexes.

Two equal strings of ``size`` bytes choose the same anchor: the least hashed ``ANCHOR``-byte substring inside them.
Every place therefore belongs to the one piece of text around its anchor, and equal strings lie in pieces with equal
anchors. Anchors that occur once in the whole corpus are dropped after a packed count; the pieces of the others meet by
anchor, equal pieces once. Over the pieces of a bucket a run-length index is built: the Burrows-Wheeler transform's
runs, the suffix positions at the ends of each run and the match lengths between neighbouring run ends. Matching
statistics follow from these samples alone, streamed along the text: inside a run a match is the one before it without
its first byte. Places whose longest match elsewhere reaches ``size`` are marked and go back to their chunk.

A passage in very many documents gives pieces that differ only at its borders. An anchor that is in ``HOT`` chunks or
more is not gathered: its strings are counted one by one by a 64-bit hash, spread over all buckets, with the same result.

Defined cases: null and empty texts have no bytes; texts shorter than ``size`` are kept; repeated rows match each other
(and are removed as far as they are long enough); a match never crosses documents; an empty table gives no rows; only
``doc_id`` and ``text`` are read, other columns may have any name. What is left may end inside a character, so it is
returned as bytes.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cascara.llm.common import BLOBS, buffers, by_chunk, byte_table, chunked, key_width, member, mix, ordered, pack, prepare, text_bytes, to_blobs, unpack

SIZE = 200
ANCHOR = 100
HOT = 64
#: Bytes of pieces in a bucket, as planned from the size of the corpus.
INDEXED = 1_500_000

ANCHORS = "chunk long, keys binary, hot binary"
PIECES = "chunk long, bucket int, hot boolean, keys binary, many binary, sizes binary, text binary"
#: ``hot`` is null in the row that brings a chunk's very common anchors back to it.
MARKS = "chunk long, hot boolean, keys binary, marks binary"
RESULT = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"

_BASE = 0x9E3779B97F4A7C15
_SEPARATOR = 255  # in no UTF-8 text


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    up, down = np.full(1 << bits, _BASE, np.uint64), np.full(1 << bits, pow(_BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Chunk:
    """The pieces of a chunk's documents."""

    def __init__(self, table: pa.Table, size: int, anchor: int):
        self.data, self.offs = buffers(table["text"])
        n = len(self.data)
        self.size, self.n = size, n
        if n < size:
            self.starts = self.counts = np.zeros(0, np.int64)
            self.keys = np.zeros(0, np.uint64)
            return
        up, self._down = _powers(max(22, n.bit_length()))  # chunks are about 2**21 bytes: one size for those just over it too
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_table(7)[self.data] * up[:n], out=self._sums[1:])
        part = self.hashes(np.arange(n - anchor + 1), anchor)
        bits = np.uint64(n.bit_length())
        at = (part >> bits << bits) | np.arange(len(part), dtype=np.uint64)
        chosen = (sliding_min(at, size - anchor + 1) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
        ends = np.repeat(self.offs[1:], np.diff(self.offs))[: len(chosen)]
        valid = np.arange(len(chosen)) + size <= ends
        begin = valid.copy()
        begin[1:] &= ~valid[:-1] | (chosen[1:] != chosen[:-1])
        self.starts = np.flatnonzero(begin)
        run = np.add.reduceat(valid, self.starts, dtype=np.int64) if len(self.starts) else np.zeros(0, np.int64)
        self.counts = run  # places of each piece
        self.keys = mix(part[chosen[self.starts]] ^ np.uint64(0x5851F42D4C957F2D))

    def hashes(self, starts: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of the bytes from each start on."""
        return mix((self._sums[starts + size] - self._sums[starts]) * self._down[starts])

    def contents(self, pick: np.ndarray) -> np.ndarray:
        """A hash of each picked piece's bytes and length."""
        sizes = self.counts[pick] + self.size - 1
        return mix(self.hashes(self.starts[pick], sizes) + sizes.astype(np.uint64))

    def places(self, pick: np.ndarray) -> np.ndarray:
        """All places of the picked pieces."""
        n = self.counts[pick]
        return np.repeat(self.starts[pick], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` consecutive values, from running minima within blocks of that size."""
    n = len(x)
    padded = np.full(math.ceil(n / size) * size, np.uint64(2**64 - 1), np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


class RunLengthIndex:
    """Burrows-Wheeler runs of a text, with the suffix positions at both ends of each run and the match length across
    each border between runs. Suffixes are ordered by their first ``depth`` bytes at least."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.n = n
        order = _suffix_order(text, depth)
        before = text[order - 1]
        before[order == 0] = 254  # nothing precedes the first byte; 254 is in no UTF-8 text either
        border = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == _SEPARATOR))  # each string has its own end
        self.letters = before[np.append(border, n - 1)]
        self.run_ends, self.run_starts = order[border], order[border + 1]
        self.across = _common(text, self.run_ends, self.run_starts, depth)

    def matching_statistics(self) -> np.ndarray:
        """At every position the length (up to the depth) of the longest string from there that starts elsewhere too.
        Away from a run's ends the neighbours' matches are those of the position before, one byte shorter."""
        sampled = np.zeros(self.n, np.int64)
        sampled[self.run_starts] = self.across
        sampled[self.run_ends] = np.maximum(sampled[self.run_ends], self.across)
        at = np.arange(self.n)
        return np.maximum.accumulate(sampled + at) - at


def _words8(text: np.ndarray, pad: int) -> np.ndarray:
    """The next 8 bytes at every position as a number, zeros past the end."""
    x = np.zeros(len(text) + pad + 8, np.uint64)
    x[: len(text)] = text
    for k in (1, 2, 4):
        x[:-k] = (x[:-k] << np.uint64(8 * k)) | x[k:]
    return x


def _suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the next ``depth`` bytes: five bytes at once, then prefix doubling over what is tied."""
    n = len(text)
    key = _words8(text, 0)[:n] >> np.uint64(24)
    if n < 1 << 24:
        x = np.sort(key << np.uint64(24) | np.arange(n, dtype=np.uint64))
        order = (x & np.uint64((1 << 24) - 1)).astype(np.int64)
        key = x >> np.uint64(24)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(start, n))
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.repeat(start, sizes) + 1
    rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
    bits, step = (n + 1).bit_length(), 5
    while step < depth and len(rows):
        at = order[rows]
        high, low = rank[at], rank[np.minimum(at + step, n)]
        if 2 * bits + len(rows).bit_length() <= 64:
            shift = len(rows).bit_length()
            x = np.sort((high.astype(np.uint64) << np.uint64(bits + shift)) | (low.astype(np.uint64) << np.uint64(shift)) | np.arange(len(rows), dtype=np.uint64))
            moved = (x & np.uint64((1 << shift) - 1)).astype(np.int64)
            x >>= np.uint64(shift)
        else:
            moved = np.lexsort((low, high))
            x = high[moved] * np.int64(n + 2) + low[moved]
        at = at[moved]
        order[rows] = at
        start = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        sizes = np.diff(np.append(start, len(rows)))
        rank[at] = np.repeat(rows[start], sizes) + 1
        rows = rows[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``depth`` rounded up to 8."""
    words = _words8(text, depth + 8)
    out = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for step in range(0, depth, 8):
        x = words[a[alive] + step] ^ words[b[alive] + step]
        same = x == 0
        ended = alive[~same]
        high = np.frexp((x[~same] >> np.uint64(11)).astype(np.float64))[1]  # bits in the upper 53
        out[ended] = step + np.where(high > 0, (53 - high) // 8, 6 + ((x[~same] >> np.uint64(8)) == 0))
        alive = alive[same]
        out[alive] = step + 8
        if not len(alive):
            break
    # The end of the text is no byte to agree on.
    return np.minimum(out, len(text) - np.maximum(a, b))


def deduplicate(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Per document the bytes that are left and the removed spans (bytes, end exclusive)."""
    prepare(docs.sparkSession)
    total = text_bytes(docs)
    frame = chunked(docs, total)
    width = key_width(total)
    low = np.uint64(256**width - 1)
    counted = max(1, math.ceil(total * 2 / (size - anchor + 2) * width / 4_000_000))
    indexed = max(1, math.ceil(total / 3 / INDEXED))
    places = size - anchor + 1

    def anchors(table: pa.Table) -> pa.Table:
        return to_blobs(table["chunk"][0].as_py(), Chunk(ordered(table), size, anchor).keys & low, width, counted)

    def again(table: pa.Table) -> pa.Table:
        """Of each chunk's anchors those that occur more than once, and whether very many chunks have them."""
        keys = [unpack(k.as_py(), width) for k in table["keys"]]
        many = [np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(k)).astype(bool) for m, k in zip(table["many"], keys, strict=True)]
        seen, n = np.unique(np.concatenate(keys), return_counts=True)
        twice = np.sort(np.concatenate([seen[n > 1], *(k[m] for k, m in zip(keys, many, strict=True))]))
        common = seen[n >= hot]
        kept = [k[member(k, twice)] for k in keys]
        rows = [(c.as_py(), pack(k, width), np.packbits(member(k, common)).tobytes()) for c, k in zip(table["chunk"], kept, strict=True) if len(k)]
        return _table(rows, [pa.int64(), pa.binary(), pa.binary()], ANCHORS)

    def pieces(table: pa.Table, back: pa.Table) -> pa.Table:
        """Each different piece whose anchor repeats; of very common anchors, each string's hash."""
        chunk = Chunk(table, size, anchor)
        number = table["chunk"][0].as_py()
        keys = [unpack(k.as_py(), width) for k in back["keys"]]
        if not keys or not len(chunk.keys):
            return _table([], [pa.int64(), pa.int32(), pa.bool_(), *[pa.binary()] * 4], PIECES)
        common = np.concatenate([np.unpackbits(np.frombuffer(h.as_py(), np.uint8), count=len(k)).astype(bool) for h, k in zip(back["hot"], keys, strict=True)])
        known = np.concatenate(keys)
        own = chunk.keys & low
        pick = np.flatnonzero(member(own, np.sort(known)))
        spread = member(own[pick], np.sort(known[common]))
        rows = []
        cold = pick[~spread]
        content, at, n = np.unique(chunk.contents(cold), return_index=True, return_counts=True)
        cold = cold[at]
        bucket = (own[cold] % np.uint64(indexed)).astype(np.int64)
        raw = chunk.data.tobytes()
        for b in np.unique(bucket).tolist():
            j = np.flatnonzero(bucket == b)
            sizes = (chunk.counts[cold[j]] + size - 1).astype("<i4")
            text = b"".join([raw[s : s + z] for s, z in zip(chunk.starts[cold[j]].tolist(), sizes.tolist(), strict=True)])
            rows.append((number, b, False, pack(content[j], 8), np.packbits(n[j] > 1).tobytes(), sizes.tobytes(), text))
        if spread.any():
            # its very common anchors come back to this chunk with the strings that repeat
            rows.append((number, indexed + number % indexed, True, pack(np.unique(own[pick[spread]]), 8), None, b"anchors", None))
            blobs = to_blobs(number, chunk.hashes(chunk.places(pick[spread]), size), 8, indexed).to_pylist()
            rows += [(number, indexed + r["bucket"], True, r["keys"], r["many"], None, None) for r in blobs]
        return _table(rows, [pa.int64(), pa.int32(), pa.bool_(), *[pa.binary()] * 4], PIECES)

    def index(table: pa.Table) -> pa.Table:
        """Marks, for each chunk's pieces, of the places whose string occurs elsewhere."""
        only = pa.compute.and_(table["hot"], pa.compute.is_valid(table["sizes"]))
        anchored = table.filter(only).select(["chunk", "keys"]).to_pylist()
        out = [(r["chunk"], None, r["keys"], None) for r in anchored]
        rows = table.filter(pa.compute.invert(only)).to_pydict()
        if not rows["keys"]:
            return _table(out, [pa.int64(), pa.bool_(), pa.binary(), pa.binary()], MARKS)
        keys = [unpack(k, 8) for k in rows["keys"]]
        lengths = [len(k) for k in keys]
        key = np.concatenate(keys)
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(rows["many"], lengths, strict=True)]).astype(bool)
        each, first, inverse, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        repeated = n > 1
        np.logical_or.at(repeated, inverse, many)
        if rows["hot"][0]:
            marks, kept = None, repeated
        else:
            sizes = np.concatenate([np.frombuffer(s, "<i4") for s in rows["sizes"]]).astype(np.int64)
            source = np.frombuffer(b"".join(rows["text"]), np.uint8)
            begin = (np.cumsum(sizes) - sizes)[first]
            sizes = sizes[first]
            at = np.cumsum(sizes + 1) - (sizes + 1)  # where each different piece starts in the indexed text
            text = np.full(int((sizes + 1).sum()), _SEPARATOR, np.uint8)
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            text[np.repeat(at, sizes) + inside] = source[np.repeat(begin, sizes) + inside]
            longest = RunLengthIndex(text, size + places).matching_statistics()
            grid = np.arange(places)
            inside = grid < (sizes - size + 1)[:, None]
            marks = inside & (repeated[:, None] | (longest[np.minimum(at[:, None] + grid, len(longest) - 1)] >= size))
            kept = marks.any(axis=1)
            marks = np.packbits(marks, axis=1)
        at = 0
        for chunk, length in zip(rows["chunk"], lengths, strict=True):
            own = inverse[at : at + length]
            own = own[kept[own]]
            at += length
            if len(own):
                out.append((chunk, rows["hot"][0], pack(each[own], 8), None if marks is None else marks[own].tobytes()))
        return _table(out, [pa.int64(), pa.bool_(), pa.binary(), pa.binary()], MARKS)

    def remove(table: pa.Table, back: pa.Table) -> pa.Table:
        chunk = Chunk(table, size, anchor)
        edge = np.zeros(chunk.n + 1, np.int32)
        rows = back.to_pydict()
        starts = []
        cold = [(unpack(k, 8), m) for k, m, h in zip(rows["keys"], rows["marks"], rows["hot"], strict=True) if h is False]
        if cold:
            key = np.concatenate([k for k, _ in cold])
            marks = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8).reshape(len(k), -1), axis=1)[:, :places] for k, m in cold])
            order = np.argsort(key)
            content = chunk.contents(np.arange(len(chunk.starts)))
            at = np.searchsorted(key[order], content)
            at[at == len(key)] = 0
            hit = np.flatnonzero(key[order[at]] == content)
            which, place = np.nonzero(marks[order[at[hit]]])
            starts.append(chunk.starts[hit[which]] + place)
        hot_keys = [unpack(k, 8) for k, h in zip(rows["keys"], rows["hot"], strict=True) if h]
        if hot_keys:
            common = np.sort(np.concatenate([unpack(k, 8) for k, h in zip(rows["keys"], rows["hot"], strict=True) if h is None]))
            at = chunk.places(np.flatnonzero(member(chunk.keys & low, common)))
            starts.append(at[member(chunk.hashes(at, size), np.sort(np.concatenate(hot_keys)))])
        if starts:
            at = np.unique(np.concatenate(starts))
            edge[at] += 1
            edge[at + size] -= 1
        covered = np.cumsum(edge[:-1]) > 0
        raw = chunk.data
        kept, removed, spans = [], [], []
        for a, b in zip(chunk.offs[:-1].tolist(), chunk.offs[1:].tolist(), strict=True):
            gone = covered[a:b]
            n = int(gone.sum())
            removed.append(n)
            kept.append(raw[a:b][~gone].tobytes() if n else raw[a:b].tobytes())
            turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist() if n else []
            spans.append([{"start": x, "end": y} for x, y in zip(turn[::2], turn[1::2], strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": table["doc_id"], "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(np.diff(chunk.offs), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, kind)})

    known = frame.groupBy("chunk").applyInArrow(anchors, BLOBS).groupBy("bucket").applyInArrow(again, ANCHORS)
    marked = by_chunk(frame, known, pieces, PIECES).groupBy("bucket").applyInArrow(index, MARKS)
    return by_chunk(frame, marked, remove, RESULT)


def _table(rows: list[tuple], kinds: list[pa.DataType], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})
