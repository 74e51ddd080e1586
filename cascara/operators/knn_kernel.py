"""The nearest rows inside one pair of blocks: a cheap lower bound of every distance, the exact one for few pairs.

Both sides are cut into leaves of near rows (median of the column that varies most). A tile of query rows meets the train
leaves in the order of the gap between their bounding boxes, and only those within its k-th best distance. The first leaf
gives each query row a k-th best distance; of the others only pairs whose lower bound does not exceed it are computed, with
the same roundings as the full distance matrix, so the result is that of the full matrix. The bounds:

* euclidean: products of centred vectors in single precision, less the greatest rounding error they can have;
* manhattan: columns of two values (one-hot ones, say) by a product as well, the others as whole numbers of a common step;
  a difference of two such numbers is off by one step at most. Values beyond a column's usual range are moved to its end,
  which makes no difference larger.

Where bounds do not help (few rows, values out of the range of single precision, many pairs within the bound) the full
distances of the tile are computed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Query rows taken together, train rows of a leaf and of the largest tile.
ROWS, FIRST, TILE = 256, 128, 8192
#: Rows that a leaf's cut is looked for in; share by which bounds of boxes are lowered, above their rounding error.
LOOK, MARGIN = 1024, 1e-9
#: Query rows per step of the whole-number sums, whose numbers of two bytes then stay near the core.
STEP_ROWS = 32
LARGEST = 1e15
DENSE = 1 / 8


def matrix_of(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    lists = column.combine_chunks()
    if lists.null_count or pc.count_distinct(pc.list_value_length(lists)).as_py() > 1:
        raise ValueError("every row needs a vector, all of one length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(lists), -1)


def cut(v: np.ndarray, rows: np.ndarray) -> tuple[int, float] | None:
    """The column that varies most and a value near its median with rows on both sides (``<=`` and ``>``); None if all
    rows are equal."""
    for x in (v[rows[:: max(1, len(rows) // LOOK)]], v[rows]):
        column = int(x.var(axis=0).argmax())
        values = x[:, column]
        if values.min() < values.max():
            middle = float(np.median(values))
            return column, middle if middle < values.max() else float(values[values < values.max()].max())
    return None


def in_leaves(v: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in leaves of up to ``size`` near rows; equal rows stay in their order."""
    leaves, left = [], [np.arange(len(v))]
    while left:
        rows = left.pop()
        at = cut(v, rows) if len(rows) > size else None
        if at is None:
            leaves += [rows[i:i + size] for i in range(0, len(rows), size)]
        else:
            low = v[rows, at[0]] <= at[1]
            left += [rows[~low], rows[low]]
    return leaves


def box_gap(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray, metric: str) -> np.ndarray:
    """Least distance, less a margin, that rows of two boxes can have (a row is a box with ``low`` = ``high``)."""
    gap = np.maximum(0, np.maximum(low2 - high, low - high2))
    return (1 - MARGIN) * (gap.sum(axis=-1) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=-1)))


def _columns(t: np.ndarray, c: slice | np.ndarray) -> np.ndarray:
    return t[:, c] if isinstance(c, slice) else np.take(t, c, axis=1)


def _where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flat = np.flatnonzero(mask)
    return flat // mask.shape[1], flat % mask.shape[1]


class Euclidean:
    """d² = |q|² - 2 (q·t - |t|²/2): the bracket is one product of vectors with one more component."""

    def __init__(self, q: np.ndarray, t: np.ndarray) -> None:
        dim = q.shape[1]
        centre = t.mean(axis=0)
        self.shift = 2.0**-50 * dim * max(np.abs(q).max(), np.abs(t).max())
        q, t = q - centre, t - centre
        self.qq, tt = (q * q).sum(axis=1), (t * t).sum(axis=1)
        longest = np.sqrt(tt.max())
        self.error = (dim + 8) * (2.0**-23 * (np.sqrt(self.qq) * longest + tt.max() / 2) + 2.0**-50 * (self.qq + tt.max()))
        self.q = np.column_stack([q, np.ones(len(q))]).astype(np.float32)
        self.t = np.ascontiguousarray(np.column_stack([t, -tt / 2]).astype(np.float32).T)

    def near(self, s: np.ndarray, c: slice | np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = (self.qq[s] - (reach + self.shift) ** 2) / 2 - self.error[s]
        least -= np.abs(least) * 2.0**-22
        return _where(self.q[s] @ _columns(self.t, c) >= least.astype(np.float32)[:, None])


class Manhattan:
    def __init__(self, q: np.ndarray, t: np.ndarray) -> None:
        low, high = np.minimum(q.min(axis=0), t.min(axis=0)), np.maximum(q.max(axis=0), t.max(axis=0))
        two = ((q == low) | (q == high)).all(axis=0) & ((t == low) | (t == high)).all(axis=0)
        self.shift = 2.0**-50 * q.shape[1] * max(np.abs(q).max(), np.abs(t).max())
        # |x - y| of columns with two values: (high - low) * (x + y - 2xy) with x, y in 0, 1
        self.q2 = self.t2 = None
        if two.any():
            gap = (high - low)[two]
            x, y = (q[:, two] != low[two]) * gap, (t[:, two] != low[two]).astype(np.float64)
            self.own = x.sum(axis=1)
            self.error2 = (two.sum() + 8) * 2.0**-22 * 2 * gap.sum()
            self.q2 = np.column_stack([2 * x, np.ones(len(q))]).astype(np.float32)
            self.t2 = np.ascontiguousarray(np.column_stack([y, -(y @ gap)]).astype(np.float32).T)
        q, t, low, high = q[:, ~two], t[:, ~two], low[~two], high[~two]
        self.dim = q.shape[1]
        self.levels = 32767 // max(1, self.dim)
        if self.dim:
            usual = np.quantile(t[:: max(1, len(t) // 2048)], [0.002, 0.998], axis=0)
            if (usual[1] > usual[0]).all():
                low, high = usual
            self.step = (high - low).max() / self.levels
            self.q, self.t = (np.rint((np.clip(v, low, high) - low) / self.step).astype(np.int16) for v in (q, t))
            self.t = np.ascontiguousarray(self.t.T)

    def near(self, s: np.ndarray, c: slice | np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        reach = reach + self.shift
        if self.q2 is None:
            most = np.minimum(reach * (1 + 2.0**-40) / self.step + self.dim + 1, 32767).astype(np.int16)
            return self._found(self._sums(s, c), most, None)
        product = self.q2[s] @ _columns(self.t2, c)
        least = self.own[s] - reach - self.error2
        if not self.dim:
            return _where(product >= least.astype(np.float32)[:, None])
        slack = (self.dim + 1) * self.step + 2.0**-20 * self.levels * self.dim * self.step
        return self._found(self._sums(s, c), (least - slack).astype(np.float32), product)

    def _sums(self, s: np.ndarray, c: slice | np.ndarray):
        q, t = self.q[s], _columns(self.t, c)
        diff = np.empty((STEP_ROWS, t.shape[1]), np.int16)
        sums = np.empty_like(diff)
        for i in range(0, len(q), STEP_ROWS):
            part = q[i:i + STEP_ROWS]
            d, a = diff[: len(part)], sums[: len(part)]
            for j in range(self.dim):
                np.subtract(part[:, j, None], t[j], out=d)
                if j:
                    np.abs(d, out=d)
                    np.add(a, d, out=a)
                else:
                    np.abs(d, out=a)
            yield i, a

    def _found(self, sums, limit: np.ndarray, product: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = [], []
        for i, a in sums:
            at = limit[i:i + len(a), None]
            r, c = _where(a <= at if product is None else product[i:i + len(a)] - a * np.float32(self.step) >= at)
            rows.append(r + i)
            cols.append(c)
        return np.concatenate(rows), np.concatenate(cols)


BOUNDS = {"euclidean": Euclidean, "manhattan": Manhattan}


def _of_pairs(qt: np.ndarray, tt: np.ndarray, r: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Distances of single pairs, summed over the dimensions in order; vectors are columns."""
    acc = np.zeros(len(r))
    for a, b in zip(qt, tt, strict=True):
        diff = a[r] - b[c]
        acc += np.abs(diff) if metric == "manhattan" else diff * diff
    return np.sqrt(acc) if metric == "euclidean" else acc


def nearest(q: np.ndarray, t: np.ndarray, k: int, metric: str, decimals: int | None, same: Callable | None,
            matrix: Callable, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """``(row, column, distance)`` of the ``k`` nearest columns of every row, ties to the smaller column, or None where
    bounds do not help. ``same(rows, columns)`` marks pairs to leave out; ``matrix(q, t)`` is the full distance matrix.
    ``limit``: distances of the rows beyond which nothing is wanted, known from other blocks."""
    if len(t) <= 2 * FIRST or not q.shape[1] or not all(np.abs(v).max() < LARGEST for v in (q, t)):  # NaN fails as well
        return None
    leaves = in_leaves(t, FIRST)
    column = np.concatenate(leaves)
    ends = np.cumsum([len(x) for x in leaves])
    starts = ends - [len(x) for x in leaves]
    t = t[column]
    low, high = np.minimum.reduceat(t, starts), np.maximum.reduceat(t, starts)
    smallest = np.minimum.reduceat(column, starts)
    bound = BOUNDS[metric](q, t)
    if metric == "manhattan" and bound.levels < 64:
        return None
    tt = np.ascontiguousarray(t.T)
    slack = 0.0 if decimals is None else 10.0**-decimals
    limit = np.full(len(q), np.inf) if limit is None else limit
    # rows of like limits go together: one with a far limit would lead its whole tile to far leaves
    like = np.where(np.isinf(limit), 9999, np.frexp(limit)[1])
    out = []
    for some in (np.flatnonzero(like == x) for x in np.unique(like)):
        for rows in (some[x] for x in in_leaves(q[some], ROWS)):
            v, most, n = q[rows], limit[rows], len(rows)
            vt = np.ascontiguousarray(v.T)
            gap = box_gap(v.min(axis=0), v.max(axis=0), low, high, metric)
            best_d, best_c = np.full((n, k), np.inf), np.full((n, k), len(t), np.int64)
            left, seen = np.argsort(gap, kind="stable"), 0
            while len(left):
                reach = np.minimum(best_d[:, -1], most)
                far = reach.max() + slack
                left = left[gap[left] <= far]
                if best_d[:, -1].max() == 0:  # k copies of every row are known: only those of smaller columns may follow
                    left = left[smallest[left] < best_c[:, -1].max()]
                if np.isfinite(far) and 2 * len(left) > len(leaves):
                    left = np.sort(left)  # most are within: leaves in their order are slices
                size = min(TILE, max(FIRST, seen)) if np.isinf(most).any() else TILE
                take = np.sort(left[: max(1, np.searchsorted(np.cumsum((ends - starts)[left]), size, "right"))])
                left = left[len(take):]
                if not len(take):
                    break
                c = slice(starts[take[0]], ends[take[-1]])
                at = np.arange(c.start, c.stop)
                if take[-1] - take[0] + 1 > len(take):
                    c = at = np.concatenate([np.arange(starts[x], ends[x]) for x in take])
                seen += len(at)
                r = None
                if np.isfinite(far):
                    r, j = bound.near(rows, c, reach + slack)
                if r is None or len(r) > DENSE * n * len(at):
                    d = matrix(v, t[c])
                    d = d if decimals is None else np.round(d, decimals)
                    if same is not None:
                        d[same(rows[:, None], column[at][None, :])] = np.inf
                    worst = np.partition(d, k - 1, axis=1)[:, k - 1] if k <= len(at) else np.inf
                    r, j = _where((d <= np.minimum(reach, worst)[:, None]) & (d < np.inf))
                    d = d[r, j]
                else:
                    d = _of_pairs(vt, tt, r, at[j], metric)
                    d = d if decimals is None else np.round(d, decimals)
                j = column[at[j]]
                closer = ((d < best_d[r, -1]) | ((d == best_d[r, -1]) & (j < best_c[r, -1]))) & (d <= most[r])
                if same is not None:
                    closer[closer] = ~same(rows[r[closer]], j[closer])
                r, j, d = r[closer], j[closer], d[closer]
                if len(r):
                    hit = np.unique(r)
                    held = np.isfinite(best_d[hit])
                    rr = np.concatenate([np.repeat(hit, held.sum(axis=1)), r])
                    dd, cc = np.concatenate([best_d[hit][held], d]), np.concatenate([best_c[hit][held], j])
                    order = np.lexsort((cc, dd, rr))
                    rr, dd, cc = rr[order], dd[order], cc[order]
                    place = np.arange(len(rr)) - np.searchsorted(rr, rr)
                    keep = place < k
                    best_d[rr[keep], place[keep]], best_c[rr[keep], place[keep]] = dd[keep], cc[keep]
            r, j = np.nonzero(np.isfinite(best_d))
            out.append((rows[r], best_c[r, j], best_d[r, j]))
    row, col, dist = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], col[order], dist[order]
