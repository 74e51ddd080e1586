"""Vectors of whole numbers: floor(scale * x) of float vectors, with exact squared distances and exact sums.

A number travels as the float64 that holds it. Distances are taken in float64 while all of them are whole numbers below
2**53, in int64 below 2**63, and as Python integers beyond; a result that no long holds is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vec: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    x = F.col(vec).cast("array<double>")
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def floors(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a list column whose rows all have ``dim`` components."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * values.reshape(len(column), dim))


def packed(rows: np.ndarray) -> pa.Array:
    """Rows as blobs of float64."""
    rows = np.ascontiguousarray(rows, "<f8")
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unpacked(blobs: Sequence[bytes] | pa.Array, dim: int) -> np.ndarray:
    parts = blobs.to_pylist() if isinstance(blobs, pa.Array) else blobs
    return np.frombuffer(b"".join(parts), "<f8").reshape(-1, dim)


def fitting(bound: float, *arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in the plainest kind of number that holds every whole number up to ``bound``."""
    if bound < 2**53:
        return [a.astype(np.float64) for a in arrays]
    if bound < 2**62:
        return [a.astype(np.int64) for a in arrays]
    return [np.array([int(v) for v in a.ravel()], object).reshape(a.shape) for a in arrays]


def largest(*arrays: np.ndarray) -> float:
    return max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows (of the last axis)."""
    d = a - b
    return (d * d).sum(axis=-1)


def longs(values: np.ndarray) -> pa.Array:
    """Whole numbers as longs; one that does not fit is an error."""
    return pa.array([int(v) for v in values] if values.dtype == object else values.astype(np.int64), pa.int64())


class Sums:
    """Sums and counts per cell, of whole numbers, over the batches of one task."""

    def __init__(self, cells: int, dim: int):
        self.sums = np.zeros((cells, dim), object)
        self.counts = np.zeros(cells, np.int64)

    def add(self, cell: np.ndarray, rows: np.ndarray) -> None:
        (rows,) = fitting(max(2.0**53, largest(rows) * len(rows)), rows)
        order = np.argsort(cell, kind="stable")
        found, first, count = np.unique(cell[order], return_index=True, return_counts=True)
        if len(found):
            self.sums[found] += np.add.reduceat(rows[order], first, axis=0).astype(object)
            self.counts[found] += count

    def table(self) -> pa.Table:
        used = np.flatnonzero(self.counts)
        return pa.table({"cell": pa.array(used.astype(np.int32)), "n": pa.array(self.counts[used]), "sums": pa.array([[int(v) for v in r] for r in self.sums[used]], pa.list_(pa.int64()))})


SUMS = "cell int, n long, sums array<long>"


def cell_sums(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Sums]) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of every cell over all rows: each task adds up its own rows first, and one row per cell and component
    reaches the driver (their number is a parameter of the operator, not of the data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches).table().to_batches()

    parts = rows.mapInArrow(run, SUMS).select("cell", "n", F.posexplode("sums"))
    total = parts.groupBy("cell", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(total, key=lambda r: (r["cell"], r["pos"])):
        out.setdefault(r["cell"], (r["n"], []))[1].append(int(r["s"]))
    return out
