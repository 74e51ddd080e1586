"""Scoring texts with an interpolated modified Kneser-Ney n-gram model that is counted, stored and read in Spark.

The n-grams of a text are those of its words, lower-cased, behind ``order - 1`` begin marks and before one end mark. The
highest order takes how often an n-gram occurs in the training texts, every lower order how many different words precede
it; p(w | h) = max(a - D(a), 0) / total(h) + (D1 N1(h) + D2 N2(h) + D3 N3(h)) / total(h) * p(w | shorter h), with one set
of discounts D1, D2, D3 per order from its counts of counts, and 1 / (V + 1) below single words, so that a word never
seen has a probability too. A context never seen leaves the word to the shorter one.

Documents are dealt into chunks. From the highest order down a chunk sends each of its distinct n-grams once, sorted and
cut into key ranges, with its sums; one task per range adds them up, writes the range as sorted hash arrays to the shared
folder, maps that file into memory and looks up what every chunk asked. Only the sums go back, in the order of the keys
sent. One chunk is told that it owns an n-gram: it alone counts it for the n-gram's suffix and context in the next lower
order, so that all figures are exact. Hot words travel once per chunk; nothing but the counts of counts (one row per
order) is common to all tasks.

Odd cases: null and empty texts are one end mark; documents without an id are learned from and not held out; equal rows
count and are scored each; texts of any length stay whole; without training texts every probability is 1 / (V + 1) = 1;
an order whose counts of counts give no discounts in (0, 1], (0, 2] and (0, 3] takes 0.5, 1 and 1.5. Other columns are
ignored. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import LOWER, buffers, combine, find_words, hash_words, ordered, pack, prepare, release, text_bytes, unpack
from cascara.session import scratch_path

ORDER = 2
CHUNK_BYTES = 8_000_000
RANGE_BYTES = 24_000_000
#: Words hashed at a time.
HASHED = 150_000
#: Bytes of a count on its way, and what an order below the highest counts of an n-gram: different words before it, the
#: sum of the counts of its continuations, and its continuations counted once, twice and more often.
WIDTH = 6
SUMS = 5
#: Marks are even, hashes of words odd.
END, BEGIN = np.uint64(0x5851F42D4C957F2C), np.uint64(0x14057B7EF767814E)
FALLBACK = (0.5, 1.0, 1.5)

_SMALL = "chunk long, doc_id long, text binary, held_out boolean"
_ASKED = "chunk long, level int, part int, keys binary, sums binary"
_ANSWERS = "chunk long, level int, part int, sums binary, owned binary"
_TOTALS = ("ones", "twos", "threes", "fours", "kinds", "sum", "words", "tokens")
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: Column | None = None, order: int = ORDER, folder: str | None = None) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row: the model learns from all rows
    that are not held out (default: crc32 of the id as text, modulo 7, is 2) and scores all. ``n_tokens`` has the end
    mark, ``n_known`` counts tokens seen in training, ``train_tokens`` all training tokens; scores are log10
    probabilities of the text, ``base_score`` under single words with one added to every count. ``folder`` takes the
    model's arrays (default: a new one below the session's checkpoint folder)."""
    if order < 2:
        raise ValueError("the order of the model is at least 2")
    spark = docs.sparkSession
    prepare(spark)
    total = text_bytes(docs)
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    parts = max(1, math.ceil(total / 6 * 8 / RANGE_BYTES))
    folder = folder or scratch_path(spark, "kneser-ney")
    if held_out is None:
        held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    frame = docs.select(
        F.pmod(F.xxhash64("doc_id", F.col("text").cast("string")), F.lit(chunks)).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")).mapInArrow(_small, _SMALL)

    def first(table: pa.Table) -> pa.Table:
        release()
        grams = _Grams(table, order)
        return _asked(grams, order, [grams.count(order)], parts)

    def lower(level: int):
        def work(table: pa.Table, back: pa.Table) -> pa.Table:
            release()
            if not table.num_rows:
                return _empty(_ASKED)
            grams = _Grams(table, order)
            return _asked(grams, level, grams.contributions(level, *_answers(back, level + 1, order)), parts)

        return work

    answers = None
    every = []
    for level in range(order, 0, -1):
        if answers is None:
            asked = frame.groupBy("chunk").applyInArrow(first, _ASKED)
        else:
            asked = frame.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lower(level), _ASKED)
        ranges = asked.groupBy("part")
        answers = ranges.applyInArrow(_answerer(folder, level, order), _ANSWERS)
        if level > 1:
            answers = answers.repartition("chunk")  # one exchange for both readers
        every += [answers, _to_all(ranges.applyInArrow(_totals(level, order), ", ".join(f"{c} long" for c in _TOTALS)), level, chunks)]
    known = every[0]
    for more in every[1:]:
        known = known.unionByName(more)

    def finish(table: pa.Table, back: pa.Table) -> pa.Table:
        release()
        return _scores(_Grams(table, order), back, order) if table.num_rows else _empty(_SCORES)

    return frame.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(finish, _SCORES)


def perplexity(scores: DataFrame) -> DataFrame:
    """``(held_out, n_docs, n_tokens, perplexity, base_perplexity)`` of scored documents, one row per side."""
    mean = [F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens")).alias(n) for c, n in (("score", "perplexity"), ("base_score", "base_perplexity"))]
    return scores.groupBy("held_out").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), *mean)


def squeezed(data: bytes, pack_it: bool = True) -> bytes:
    """Bytes as they travel, behind their length: compressed, or (``pack_it`` false) back as they were."""
    if pack_it:
        return len(data).to_bytes(6, "little") + pa.compress(data, "zstd", asbytes=True)
    return pa.decompress(data[6:], int.from_bytes(data[:6], "little"), "zstd", asbytes=True)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the exchange that every level reads."""
    for b in batches:
        text = pa.array([t and squeezed(t) for t in b.column("text").cast(pa.binary()).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("doc_id"), text, b.column("held_out")], names=["chunk", "doc_id", "text", "held_out"])


class _Grams:
    """The n-grams of a chunk's documents by level (their length): for each token the key of the n-gram that it ends,
    the distinct keys in order, and where a key or context stands among them."""

    def __init__(self, table: pa.Table, order: int):
        texts = pa.array((t and squeezed(t, False) for t in table["text"].to_pylist()), pa.binary()).cast(pa.string())
        table = ordered(table.set_column(table.schema.get_field_index("text"), "text", texts))
        del texts
        self.order = order
        self.chunk = table["chunk"][0].as_py()
        self.ids = table["doc_id"]
        self.held_out = table["held_out"].combine_chunks().to_numpy(zero_copy_only=False)
        data, offs = buffers(table["text"])
        data = LOWER[data]
        starts, ends, first = find_words(data, offs)
        h = np.empty(len(starts), np.uint64)
        for a in range(0, len(starts), HASHED):  # hashing takes several times the bytes it reads
            h[a : a + HASHED] = hash_words(data, starts[a : a + HASHED], ends[a : a + HASHED])
        del data, starts, ends
        self.sizes = np.diff(first) + 1
        stops = np.cumsum(self.sizes)
        self.begins = stops - self.sizes
        event = np.empty(len(h) + len(self.sizes), np.uint64)
        word = np.ones(len(event), bool)
        word[stops - 1] = False
        event[word], event[~word] = h, END
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.learned = ~self.held_out[self.row]
        self.marks = {1: BEGIN}
        self.keys = {1: event}
        for level in range(2, order + 1):
            before = np.empty_like(event)
            before[1:] = self.keys[level - 1][:-1]
            before[self.begins] = self.marks[level - 1]
            self.keys[level] = combine(before, event)
            self.marks[level] = combine(np.array([self.marks[level - 1]]), np.array([BEGIN]))[0]
        self._places: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def places(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of a level, in order, and for each token where its key stands. Below the highest level the
        begin marks are a key too: they are a context."""
        if level not in self._places:
            keys = self.keys[level] if level == self.order else np.append(self.keys[level], self.marks[level])
            self._places[level] = np.unique(keys, return_inverse=True)
        return self._places[level]

    def contexts(self, level: int) -> np.ndarray:
        """For each token where the context of its n-gram stands among the keys of the level below."""
        _, at = self.places(level - 1)
        before = np.empty(len(self.row), np.int64)
        before[1:] = at[: len(self.row) - 1]
        before[self.begins] = at[-1]
        return before

    def count(self, level: int) -> np.ndarray:
        """How often each key of a level occurs in training texts."""
        keys, at = self.places(level)
        return np.bincount(at[: len(self.row)][self.learned], minlength=len(keys)).astype(np.uint64)

    def contributions(self, level: int, sums: np.ndarray, owned: np.ndarray) -> list[np.ndarray]:
        """What the chunk knows of each key of ``level`` through the longer n-grams that it owns."""
        longer, at = self.places(level + 1)
        keys, shorter = self.places(level)
        token = np.empty(len(longer), np.int64)
        token[at[: len(self.row)][::-1]] = np.arange(len(self.row))[::-1]  # a token that ends the longer n-gram
        mine = np.flatnonzero(owned)
        if level + 1 < self.order:
            mine = mine[longer[mine] != self.marks[level + 1]]
        token, count = token[mine], sums[0][mine]
        context = self.contexts(level + 1)[token]
        out = [np.bincount(shorter[token], minlength=len(keys))]
        out.append(np.bincount(context, weights=count, minlength=len(keys)))
        out += [np.bincount(context[f(count)], minlength=len(keys)) for f in (lambda c: c == 1, lambda c: c == 2, lambda c: c > 2)]
        if level == 1:
            out.append(self.count(1))
        return [c.astype(np.uint64) for c in out]


def _columns(level: int, order: int) -> int:
    """Number of sums per key: the count itself at the highest level; single words also have their plain count."""
    return 1 if level == order else SUMS + (level == 1)


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.table({n: pa.array([], kinds[k]) for n, k in (c.strip().split() for c in schema.split(","))})


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the key ranges begin and end among sorted keys."""
    edges = np.array([2**64 * p // parts for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _asked(grams: _Grams, level: int, sums: list[np.ndarray], parts: int) -> pa.Table:
    keys, _ = grams.places(level)
    cuts = _cuts(keys, parts)
    used = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "chunk": pa.array(np.full(len(used), grams.chunk, np.int64)),
            "level": pa.array(np.full(len(used), level, np.int32)),
            "part": pa.array(used.astype(np.int32)),
            "keys": pa.array([squeezed(pack(keys[cuts[p] : cuts[p + 1]], 8)) for p in used], pa.binary()),
            "sums": pa.array([squeezed(b"".join(pack(s[cuts[p] : cuts[p + 1]], WIDTH) for s in sums)) for p in used], pa.binary()),
        }
    )


def _split(blob: bytes, columns: int) -> np.ndarray:
    """The columns of packed sums."""
    blob = squeezed(blob, False)
    size = len(blob) // columns
    return np.stack([unpack(blob[c * size : (c + 1) * size], WIDTH) for c in range(columns)])


def _keys(blob: pa.Scalar) -> np.ndarray:
    return unpack(squeezed(blob.as_py(), False), 8)


def _merged(table: pa.Table, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """All keys of a range, each once and in order, with their sums; the order of what the chunks sent (by chunk), the
    first of each key in it, and how many keys each chunk sent."""
    rows = [_keys(k) for k in table["keys"]]
    sums = np.concatenate([_split(s.as_py(), columns) for s in table["sums"]], axis=1)
    keys = np.concatenate(rows)
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.stack([np.add.reduceat(s[by_key], first) for s in sums]), by_key, first, [len(r) for r in rows]


def _answerer(folder: str, level: int, order: int):
    columns = _columns(level, order)

    def work(table: pa.Table) -> pa.Table:
        release()
        table = table.sort_by("chunk")
        keys, sums, by_key, first, sent = _merged(table, columns)
        part = table["part"][0].as_py()
        known, stored = mapped(store(f"{folder}/level-{level}/part-{part:06d}", keys, sums))
        # the first chunk that has a count of the key owns it
        counted = np.concatenate([_split(s.as_py(), columns)[0] for s in table["sums"]])[by_key] > 0
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(by_key))))
        at = np.flatnonzero(counted)
        owner = at[np.concatenate([[True], np.diff(group[at]) > 0])[: len(at)]]
        owned = np.zeros(len(by_key), bool)
        owned[by_key[owner]] = True
        out_sums, out_owned, begin = [], [], 0
        for row, n in zip(table["keys"], sent, strict=True):
            asked = _keys(row)
            place = np.searchsorted(known, asked)
            place[place == len(known)] = 0
            hit = known[place] == asked if len(known) else np.zeros(n, bool)
            found = [np.where(hit, s[place], np.uint64(0)) if len(known) else np.zeros(n, np.uint64) for s in stored]
            out_sums.append(squeezed(b"".join(pack(s, WIDTH) for s in found)))
            out_owned.append(squeezed(np.packbits(owned[begin : begin + n]).tobytes()))
            begin += n
        return pa.table(
            {
                "chunk": table["chunk"],
                "level": pa.array(np.full(len(sent), level, np.int32)),
                "part": table["part"],
                "sums": pa.array(out_sums, pa.binary()),
                "owned": pa.array(out_owned, pa.binary()),
            }
        )

    return work


def _totals(level: int, order: int):
    def work(table: pa.Table) -> pa.Table:
        release()
        _, sums, *_ = _merged(table.sort_by("chunk"), _columns(level, order))
        count = sums[0]
        plain = sums[-1] if level == 1 else np.zeros(0, np.uint64)
        row = [*((count == c).sum() for c in (1, 2, 3, 4)), (count > 0).sum(), count.sum(), (plain > 0).sum(), plain.sum()]
        return pa.table({n: pa.array([int(v)], pa.int64()) for n, v in zip(_TOTALS, row, strict=True)})

    return work


def _to_all(totals: DataFrame, level: int, chunks: int) -> DataFrame:
    """The totals of a level as one row for every chunk."""
    one = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("string").alias(c) for c in _TOTALS])
    return one.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), F.lit(-level).alias("level"), F.lit(0).alias("part"),
        F.concat_ws(",", *_TOTALS).cast("binary").alias("sums"), F.lit(None).cast("binary").alias("owned"))


def _answers(back: pa.Table, level: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and ownership of a chunk's keys of one level, in the order of the keys."""
    columns = _columns(level, order)
    back = back.filter(pa.compute.equal(back["level"], level)).sort_by("part")
    sums = [_split(s.as_py(), columns) for s in back["sums"]]
    owned = [np.unpackbits(np.frombuffer(squeezed(o.as_py(), False), np.uint8), count=s.shape[1]) for o, s in zip(back["owned"], sums, strict=True)]
    return np.concatenate(sums, axis=1), np.concatenate(owned).astype(bool)


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """The discounts of n-grams counted once, twice and more often, from the counts of counts."""
    if min(ones, twos, threes) > 0:
        y = ones / (ones + 2 * twos)
        out = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
        if all(0 < d <= k for k, d in enumerate(out, 1)):
            return out
    return FALLBACK


def _scores(grams: _Grams, back: pa.Table, order: int) -> pa.Table:
    totals = {-r["level"]: dict(zip(_TOTALS, map(int, r["sums"].decode().split(",")), strict=True)) for r in back.select(["level", "sums"]).filter(pa.compute.less(back["level"], 0)).to_pylist()}
    n = len(grams.row)
    p = np.full(n, 1 / (totals[1]["words"] + 1))
    below = None
    for level in range(1, order + 1):
        t = totals[level]
        d = discounts(t["ones"], t["twos"], t["threes"], t["fours"])
        sums, _ = _answers(back, level, order)
        _, at = grams.places(level)
        at = at[:n]
        count = sums[0][at].astype(np.float64)
        if level == 1:
            rest = d[0] * t["ones"] + d[1] * t["twos"] + d[2] * (t["kinds"] - t["ones"] - t["twos"])
            total, rest = np.full(n, float(t["sum"])), np.full(n, rest)
            plain = sums[-1][at].astype(np.float64)
        else:
            context = grams.contexts(level)
            total = below[1][context].astype(np.float64)
            rest = sum(d[i] * below[2 + i][context] for i in range(3))
        cut = np.where(count > 0, count - np.choose(np.minimum(count, 3).astype(np.int64), [0.0, *d]), 0.0)
        seen = total > 0
        p = np.where(seen, (np.maximum(cut, 0.0) + rest * p) / np.where(seen, total, 1.0), p)
        below = sums
    words, tokens = totals[1]["words"], totals[1]["tokens"]
    base = np.log10((plain + 1) / (tokens + 1 * (words + 1)))
    rows = len(grams.sizes)
    return pa.table(
        {
            "doc_id": grams.ids,
            "held_out": pa.array(grams.held_out, pa.bool_()),
            "n_tokens": pa.array(grams.sizes.astype(np.int64)),
            "n_known": pa.array(np.bincount(grams.row[plain > 0], minlength=rows).astype(np.int64)),
            "train_tokens": pa.array(np.full(rows, tokens, np.int64)),
            "base_score": pa.array(np.bincount(grams.row, weights=base, minlength=rows)),
            "score": pa.array(np.bincount(grams.row, weights=np.log10(p), minlength=rows)),
        }
    )


# Sorted hash arrays in files


def _file(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri("file://" + path.removeprefix("file:").replace("//", "/") if path.startswith(("file:", "/")) else path)


class Column:
    """Whole numbers, most of them small: a byte each, and those of 255 and more apart, by position."""

    def __init__(self, small: np.ndarray, at: np.ndarray, large: np.ndarray):
        self.small, self.at, self.large = small, at, large

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        out = self.small[places].astype(np.uint64)
        high = np.flatnonzero(out == 255)
        out[high] = self.large[np.searchsorted(self.at, places[high])]
        return out


def store(path: str, keys: np.ndarray, sums: np.ndarray) -> str:
    """Write keys (sorted, those with any sum) and sums as plain arrays: the number of keys, of columns and of each column's
    large numbers, then the keys, then the columns, each with the places of its large numbers, these, and its bytes. The
    file appears whole, by a rename; a task that runs again writes the same."""
    kept = sums.any(axis=0)
    keys, sums = keys[kept], sums[:, kept]
    large = [np.flatnonzero(s >= 255) for s in sums]
    system, name = _file(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    fresh = f"{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(fresh) as out:
        out.write(np.array([len(keys), len(sums), *map(len, large)], np.int64).tobytes())
        out.write(keys.astype("<u8").tobytes())
        for s, at in zip(sums, large, strict=True):
            out.write(at.astype("<i8").tobytes() + s[at].astype("<u8").tobytes())
            out.write(np.minimum(s, 255).astype(np.uint8).tobytes())
    system.move(fresh, name)
    return path


def mapped(path: str) -> tuple[np.ndarray, list[Column]]:
    """Keys and sums of a stored range, mapped into memory. Where the shared folder is no mounted file system, the file
    is fetched first into one without a name, which goes with the mapping."""
    system, name = _file(path)
    if isinstance(system, arrow_fs.LocalFileSystem):
        data = np.memmap(name, np.uint8, "r")
    else:
        with tempfile.TemporaryFile() as local, system.open_input_stream(name) as remote:
            while block := remote.read(1 << 22):
                local.write(block)
            local.flush()
            data = np.memmap(local, np.uint8, "r")
    at = 0

    def read(n: int, kind: str) -> np.ndarray:
        nonlocal at
        size = n * np.dtype(kind).itemsize
        at += size
        return data[at - size : at].view(kind)

    n, columns = read(2, "<i8").tolist()
    large = read(columns, "<i8").tolist()
    keys = read(n, "<u8")
    sums = []
    for m in large:
        places, values = read(m, "<i8"), read(m, "<u8")
        sums.append(Column(read(n, "u1"), places, values))
    return keys, sums
