"""Codes for vectors by product quantisation, with equal-average nearest neighbour search.

A vector of whole numbers is cut into equal consecutive parts, and each part is coded as its nearest entry in the
codebook of its position. The entries of a codebook are sorted by the sum of their components. The search for a part
starts at the entries whose sums are closest to its own and goes outward; by the Cauchy-Schwarz inequality a squared
distance is at least the squared gap of the sums over the number of components, so a side ends where that strictly
exceeds the best distance found (an equal one could still tie with a lower index). Every task searches its own vectors;
codebooks (a parameter's worth of numbers) go to all tasks, and entries learn from sums that each task adds up first.

Odd cases: vectors that are null, or hold null, NaN or infinite components, are dropped. The codebooks are for the most
frequent length among the rest (of equally frequent ones the longest), which must be divisible by the number of parts;
a vector of another length, or of none, stays with null for code and error. Rows without an id come last among those that start the
codebooks, equal ids in the order of their numbers; fewer vectors than entries make fewer entries; equal rows count
each; null labels form one group; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import prepare, stage
from cascara.llm.int_vectors import Sums, cell_sums, fitting, floors, largest, longs, packed, squared, unpacked, whole

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Rows and entries that one step of the search compares.
BLOCK, STEP = 4096, 8


def encode(rows: DataFrame, vec: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` per kept vector."""
    spark = rows.sparkSession
    prepare(spark)
    kept = rows.where(whole(vec)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).alias("v"), F.col("label").alias("label"))
    sizes = kept.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.where("dim > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    dim = common["dim"] if common else parts
    if dim % parts:
        raise ValueError(f"vectors of {dim} components do not make {parts} equal parts")
    label = dict(rows.dtypes)["label"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), packed(floors(b.column("v"), dim, scale))], names=["vec_id", "label", "v"])

    ready = stage(kept.where(F.size("v") == dim).mapInArrow(read, f"vec_id long, label {label}, v binary"), "codes-vectors")
    start = ready.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()  # as many rows as a codebook has entries
    cut = unpacked([r["v"] for r in start], dim).reshape(len(start), parts, dim // parts)
    books = [[[int(x) for x in e] for e in cut[:, p]] for p in range(parts)]
    for _ in range(rounds if start else 0):
        for cell, (n, sums) in cell_sums(ready, _learner(books, dim)).items():
            books[cell // len(start)][cell % len(start)] = [s // n for s in sums]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Search(b) for b in books if b]
        for b in batches:
            if not b.num_rows:
                continue
            found = [s.nearest(x) for s, x in zip(search, _cut(b.column("v"), dim, parts), strict=True)]
            codes = np.stack([i for i, _, _ in found], axis=1)
            error = sum(d.astype(object) for _, d, _ in found)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(["".join(f"{c:02x}" for c in r) for r in codes]), longs(error)], names=["vec_id", "label", "code", "error"])

    other = kept.where(F.size("v") != dim).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = stage(ready.mapInArrow(write, f"vec_id long, label {label}, code string, error long").union(other), "codes")
    # a written table of known size: the join is a broadcast while labels are few, a shuffle with skew handling beyond
    of_label = stage(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "codes-labels")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _cut(column: pa.Array, dim: int, parts: int) -> list[np.ndarray]:
    rows = unpacked(column, dim).reshape(len(column), parts, -1)
    return [rows[:, p] for p in range(parts)]


def _learner(books: list, dim: int):
    parts, entries = len(books), len(books[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Sums:
        search = [Search(b) for b in books]
        sums = Sums(parts * entries, dim // parts)
        for b in batches:
            for p, x in enumerate(_cut(b.column("v"), dim, parts)):
                sums.add(search[p].nearest(x)[0] + p * entries, x)
        return sums

    return work


class Search:
    """A codebook in the order of its entries' component sums."""

    def __init__(self, book: list[list[int]]):
        self.book = np.array(book, object).reshape(len(book), -1)
        self.sums = self.book.sum(axis=1)
        self.order = np.array(sorted(range(len(book)), key=lambda i: (self.sums[i], i)), np.int64)
        self.most = max((abs(x) for e in book for x in e), default=0)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row the nearest entry (of equally near ones the lowest index), its squared distance, and how many
        entries were compared in all."""
        index, distance, compared = [], [], 0
        for at in range(0, len(rows), BLOCK):
            i, d, n = self._block(rows[at : at + BLOCK])
            index.append(i)
            distance.append(d)
            compared += n
        if not index:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        return np.concatenate(index), np.concatenate(distance), compared

    def _block(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        m, dim = self.book.shape
        # a distance and an index in one number, so that the least is the nearest with the lowest index
        reach = max(largest(rows), self.most)
        bound = 4.0 * reach * reach * dim * max(dim, m + 1)
        x, book, sums = fitting(bound, rows, self.book[self.order], self.sums[self.order])
        order = self.order.astype(x.dtype)
        own = x.sum(axis=1)
        up = np.searchsorted(sums, own)
        down = up - 1
        best = np.full(len(x), np.inf) if x.dtype == np.float64 else np.full(len(x), 2**63 - 1 if x.dtype == np.int64 else 2**2000, x.dtype)
        compared = 0
        active = np.arange(len(x))
        start = True
        while len(active):
            for side, step in ((up, 1), (down, -1)):
                place = side[active, None] + step * np.arange(1 if start else STEP)
                inside = (place >= 0) & (place < m)
                place = np.clip(place, 0, m - 1)
                gap = sums[place] - own[active, None]
                near = inside if start else inside & (gap * gap <= (best[active] // m * dim)[:, None])
                r, c = np.nonzero(near)
                compared += len(r)
                found = np.repeat(best[active][:, None], place.shape[1], axis=1)
                found[r, c] = squared(x[active[r]], book[place[r, c]]) * m + order[place[r, c]]
                best[active] = np.minimum(best[active], found.min(axis=1))
                side[active] += step * place.shape[1]
            start = False
            still = np.zeros(len(active), bool)
            for side in (up, down):
                place = side[active]
                inside = (place >= 0) & (place < m)
                gap = sums[np.clip(place, 0, m - 1)] - own[active]
                still |= inside & (gap * gap <= best[active] // m * dim)
            active = active[still]
        return (best % m).astype(np.int64), best // m, compared
