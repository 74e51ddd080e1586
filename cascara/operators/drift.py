"""Population drift: aligned distributions, equal-width histograms on baseline edges, PSI per feature and in total,
and the refresh gate.

Plan shape (whatever the number of features): the baseline is scanned once for the numeric edges (min/max per
feature — two numbers per feature, collected as the fitted bin model), then baseline and current rows are each
scanned once more: every feature becomes a string key (the category, or the bin number for a binned numeric
feature), the rows are unpivoted, tagged by side and counted in ONE grouped aggregate. The full-outer alignment of
the two distributions (missing side → 0) falls out of that grouping — no join of the two tables — and empty bins are
completed by a features × bins grid unioned into the same aggregate. Per-feature totals are one row per feature and
are broadcast back; no window spans all values of a feature.

Modes for numeric features:
  * ``values``  — every distinct value is a category (what the original job computes in practice);
  * ``density`` — histogram densities on 10 equal-width baseline bins (the job as written);
  * ``share``   — histogram shares on the same bins (the textbook PSI; default).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.functions.columns import clamp_zero, psi_term, quoted, without_nan
from cascara.session import written

EPS = 1e-10
DEFAULT_THRESHOLD = 0.2

Edges = Mapping[str, tuple[float, float]]


# ---------------------------------------------------------------------------------------------------------------
# fitted bin edges


def baseline_edges(base: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{feature: (lo, hi)}`` of the baseline (NULL and NaN ignored), from one aggregate; features without any
    value are left out."""
    aggs = []
    for i, f in enumerate(features):
        x = quoted(f).cast("double")
        ok = F.when(~F.isnan(x), x)
        aggs += [F.min(ok).alias(f"lo{i}"), F.max(ok).alias(f"hi{i}")]
    row = base.agg(*aggs).first()
    out = {}
    for i, f in enumerate(features):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None and hi is not None:
            out[f] = (float(lo), float(hi))
    return out


def bin_edges(lo: float, hi: float, bins: int) -> list[float]:
    """The ``bins + 1`` edges of equal-width bins as evaluated numbers: lo + i · step, and hi itself as the last."""
    step = (hi - lo) / bins
    return [i * step + lo for i in range(bins)] + [hi]


def bin_of(x: Column, lo: float, hi: float, bins: int) -> Column:
    """The bin of x by comparison with the evaluated edges: half-open bins, the last one closed; NULL outside [lo, hi]
    and for NaN. On a constant baseline (hi = lo) every edge is that value, and the last, closed bin holds it."""
    passed = F.lit(0)
    for e in bin_edges(lo, hi, bins)[1:-1]:
        passed = passed + (x >= F.lit(e)).cast("int")
    return F.when(x.between(F.lit(lo), F.lit(hi)) & ~F.isnan(x), passed)


def _edge_frame(df: DataFrame, edges: Edges, bins: int) -> DataFrame:
    """``(feature, key, lo_edge, hi_edge)``: one row per bin of every binned feature (bounded by features × bins)."""
    rows = [(f, str(i), e[i], e[i + 1]) for f, (lo, hi) in edges.items() for e in [bin_edges(lo, hi, bins)] for i in range(bins)]
    return df.sparkSession.createDataFrame(rows, "feature string, key string, lo_edge double, hi_edge double")


# ---------------------------------------------------------------------------------------------------------------
# one-pass tagged counts


def _keys(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], edges: Edges, bins: int) -> DataFrame:
    """``(feature, key)`` per row and feature: the category as text (NaN is a missing value, not a category), or the
    bin number of a numeric feature."""
    cols = {c: without_nan(df, c).cast("string") for c in categorical}
    for f in numeric:
        if f in edges:
            cols[f] = bin_of(quoted(f).cast("double"), *edges[f], bins).cast("string")
    if not cols:
        raise ValueError("no feature to compare")
    slim = df.select(*[e.alias(n) for n, e in cols.items()])
    return slim.unpivot([], list(cols), "feature", "key").where(F.col("key").isNotNull())


def tagged_counts(base: DataFrame, cur: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (),
                  edges: Edges | None = None, bins: int = 10) -> DataFrame:
    """``(feature, key, n_base, n_cur)`` for every category / bin seen on either side, and every bin of the grid."""
    edges = edges if edges is not None else (baseline_edges(base, numeric) if numeric else {})
    rows = (_keys(base, categorical, numeric, edges, bins).withColumn("side", F.lit(1))
            .unionByName(_keys(cur, categorical, numeric, edges, bins).withColumn("side", F.lit(0))))
    grid_rows = [(f, str(i)) for f in numeric if f in edges for i in range(bins)]
    if grid_rows:
        grid = base.sparkSession.createDataFrame(grid_rows, "feature string, key string")
        rows = rows.unionByName(grid.withColumn("side", F.lit(None).cast("int")))
    return rows.groupBy("feature", "key").agg(
        F.count(F.when(F.col("side") == 1, 1)).alias("n_base"), F.count(F.when(F.col("side") == 0, 1)).alias("n_cur"))


def nan_divide(num: Column, den: Column) -> Column:
    """num / den, NaN when den is 0 (a side with no rows in range has no distribution; NaN then propagates to the
    feature's PSI and the total, and a NaN total never triggers a refresh)."""
    return F.when(den == 0, F.lit(float("nan"))).otherwise(F.try_divide(num.cast("double"), den.cast("double")))


def _with_shares(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    totals = counts.groupBy("feature").agg(F.sum("n_base").alias("tot_base"), F.sum("n_cur").alias("tot_cur"))
    # one row per feature: bounded by the column count
    return counts.join(F.broadcast(totals), "feature").select(
        *keys, "n_base", "n_cur", nan_divide(F.col("n_base"), F.col("tot_base")).alias("e"),
        nan_divide(F.col("n_cur"), F.col("tot_cur")).alias("a"))


def _psi(rows: DataFrame) -> DataFrame:
    term = psi_term(clamp_zero(F.col("a"), EPS), clamp_zero(F.col("e"), EPS))
    return rows.groupBy("feature").agg(F.sum(term).alias("psi"))


# ---------------------------------------------------------------------------------------------------------------
# public operators


def aligned_counts(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value, n_base, n_cur)`` over the union of categories; a side without the value counts 0."""
    return tagged_counts(base, cur, features).withColumnRenamed("key", "value")


def category_union(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value)``: categories seen on either side."""
    return aligned_counts(base, cur, features).select("feature", "value")


def aligned_shares(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value, n_base, n_cur, e, a)``: shares of each side (NULLs excluded)."""
    return _with_shares(aligned_counts(base, cur, features), ["feature", "value"])


def psi_categorical(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, psi)``: Σ (a − e)·ln(a/e) over the category union, zero shares clamped to 1e-10."""
    return _psi(aligned_shares(base, cur, features))


def histogram(base: DataFrame, cur: DataFrame, features: Sequence[str], bins: int = 10,
              normalise: str = "share", edges: Edges | None = None) -> DataFrame:
    """``(feature, bin, lo_edge, hi_edge, n_base, n_cur, e, a)`` on baseline edges for every numeric feature.

    Values outside the baseline range are dropped. ``normalise`` is ``share`` (count / in-range total), ``density``
    (share / bin width) or ``count`` (raw counts in e and a).
    """
    edges = edges if edges is not None else baseline_edges(base, features)
    counts = tagged_counts(base, cur, [], features, edges, bins).withColumn("bin", F.col("key").cast("int"))
    placed = counts.join(F.broadcast(_edge_frame(counts, edges, bins)), ["feature", "key"]).select(
        "feature", "bin", "lo_edge", "hi_edge", "n_base", "n_cur", (F.col("hi_edge") - F.col("lo_edge")).alias("width"))
    if normalise == "count":
        return placed.select("feature", "bin", "lo_edge", "hi_edge", "n_base", "n_cur",
                             F.col("n_base").cast("double").alias("e"), F.col("n_cur").cast("double").alias("a"))
    shares = _with_shares(placed, ["feature", "bin", "lo_edge", "hi_edge", "width"])
    if normalise == "density":
        shares = shares.withColumn("e", nan_divide(F.col("e"), F.col("width"))).withColumn(
            "a", nan_divide(F.col("a"), F.col("width")))
    elif normalise != "share":
        raise ValueError(f"unknown normalise {normalise!r}")
    return shares.drop("width")


def psi_numeric(base: DataFrame, cur: DataFrame, features: Sequence[str], bins: int = 10,
                normalise: str = "share") -> DataFrame:
    """``(feature, psi)`` over baseline-edge bins (``share`` or ``density``)."""
    return _psi(histogram(base, cur, features, bins, normalise))


def psi_features(base: DataFrame, cur: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (),
                 mode: str = "share", bins: int = 10) -> DataFrame:
    """``(feature, psi)`` for every feature from one counting pass. ``mode='values'`` scores numeric features
    value by value; ``share`` / ``density`` bin them on the baseline edges."""
    if mode == "values" or not numeric:
        return psi_categorical(base, cur, list(categorical) + list(numeric))
    if mode not in ("share", "density"):
        raise ValueError(f"unknown mode {mode!r}")
    edges = baseline_edges(base, numeric)
    return _psi_of_counts(tagged_counts(base, cur, categorical, numeric, edges, bins), edges, mode, bins)


def _psi_of_counts(counts: DataFrame, edges: Edges, mode: str, bins: int) -> DataFrame:
    if mode != "density" or not edges:
        return _psi(_with_shares(counts, ["feature", "key"]))
    placed = counts.join(F.broadcast(_edge_frame(counts, edges, bins)), ["feature", "key"], "left")
    shares = _with_shares(placed.withColumn("width", F.col("hi_edge") - F.col("lo_edge")), ["feature", "key", "width"])
    for side in ("e", "a"):
        shares = shares.withColumn(side, F.when(F.col("width").isNull(), F.col(side)).otherwise(nan_divide(F.col(side), F.col("width"))))
    return _psi(shares)


def psi_total(per_feature: DataFrame) -> DataFrame:
    """One row: ``total_psi`` (sum over features), ``n_features``."""
    return per_feature.agg(F.sum("psi").alias("total_psi"), F.count(F.lit(1)).alias("n_features"))


def drift_gate(total: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Adds ``refresh``: total > threshold. NaN is never a reason to refresh (SQL orders NaN greatest)."""
    t = F.col("total_psi")
    return total.withColumn("threshold", F.lit(float(threshold))).withColumn(
        "refresh", F.coalesce((t > F.lit(float(threshold))) & ~F.isnan(t), F.lit(False)))


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row: a union of the rows (missing columns NULL) and one aggregate
    taking each column's only value — no join."""
    rows = one_row[0]
    for f in one_row[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    return rows.agg(*[F.max(F.col(c)).alias(c) for c in rows.columns])


def drift_score(base: DataFrame | None, cur: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (),
                mode: str = "share", bins: int = 10, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row ``(n_base, n_current, total_psi, threshold, refresh)``.

    No baseline (``None``) or an empty one scores 1.0, which forces a refresh.
    """
    n_cur = cur.agg(F.count(F.lit(1)).alias("n_current"))
    if base is None:
        one = n_cur.select(F.lit(0).cast("long").alias("n_base"), "n_current", F.lit(1.0).alias("total_psi"))
        return drift_gate(one, threshold)
    if base.isEmpty():  # an empty snapshot has no distribution to compare with
        return drift_score(None, cur, categorical, numeric, mode, bins, threshold)
    n_base = base.agg(F.count(F.lit(1)).alias("n_base"))
    tot = psi_total(psi_features(base, cur, categorical, numeric, mode, bins)).select("total_psi")
    one = side_by_side(n_base, n_cur, tot).select("n_base", "n_current", "total_psi")
    return drift_gate(one, threshold)


# ---------------------------------------------------------------------------------------------------------------
# a stored summary of the baseline


#: The "feature" whose count is the number of rows, and the columns of a summary.
_ROWS = "*"
SUMMARY = "feature string, key string, n long, lo double, hi double"


def _counted(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], edges: Edges, bins: int) -> DataFrame:
    """``(feature, key, n)`` of every feature, and the number of rows, from one scan."""
    cols = {c: without_nan(df, c).cast("string") for c in categorical}
    cols |= {f: bin_of(quoted(f).cast("double"), *edges[f], bins).cast("string") for f in numeric if f in edges}
    slim = df.select(*[e.alias(n) for n, e in cols.items()], F.lit("").alias(_ROWS))
    long = slim.unpivot([], [quoted(c) for c in [*cols, _ROWS]], "feature", "key")
    return long.where(F.col("key").isNotNull()).groupBy("feature", "key").agg(F.count(F.lit(1)).alias("n"))


def baseline_summary(base: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (), mode: str = "share",
                     bins: int = 10) -> DataFrame:
    """All that drift needs to know of a baseline, to be stored with it: counts per feature and category or bin, the
    number of rows (feature ``*``), and the edges of binned features (rows with ``lo`` and ``hi``). One scan, two where
    features are binned; a row per distinct value of a feature."""
    numeric, categorical = ([], [*categorical, *numeric]) if mode == "values" else (list(numeric), list(categorical))
    edges = baseline_edges(base, numeric) if numeric else {}
    return _summary(_counted(base, categorical, numeric, edges, bins), edges)


def _summary(counts: DataFrame, edges: Edges) -> DataFrame:
    none = F.lit(None).cast("double")
    rows = counts.select("feature", "key", "n", none.alias("lo"), none.alias("hi"))
    if not edges:
        return rows
    return rows.unionByName(counts.sparkSession.createDataFrame([(f, None, None, lo, hi) for f, (lo, hi) in edges.items()], SUMMARY))


class StoredDrift:
    """Drift of a current table against a stored baseline summary: the current side is scanned once, the baseline never.
    The counts, a row per distinct value, are written once; every figure is derived from them."""

    def __init__(self, summary: DataFrame, cur: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (),
                 mode: str = "share", bins: int = 10):
        if mode not in ("values", "share", "density"):
            raise ValueError(f"unknown mode {mode!r}")
        if mode == "values":
            categorical, numeric = [*categorical, *numeric], []
        self.mode, self.bins = mode, bins
        self.edges = {r["feature"]: (r["lo"], r["hi"]) for r in summary.where(F.col("lo").isNotNull()).collect()} if numeric else {}  # a row per feature
        zero = F.lit(0).cast("long")
        old = summary.where(F.col("lo").isNull()).select("feature", "key", F.col("n").alias("n_base"), zero.alias("n_cur"))
        new = _counted(cur, categorical, numeric, self.edges, bins).select("feature", "key", zero.alias("n_base"), F.col("n").alias("n_cur"))
        rows = old.where(F.col("feature").isin([_ROWS, *categorical, *self.edges])).unionByName(new)
        grid = [(f, str(i), 0, 0) for f in self.edges for i in range(bins)]
        if grid:
            rows = rows.unionByName(cur.sparkSession.createDataFrame(grid, "feature string, key string, n_base long, n_cur long"))
        self.counts = written(rows.groupBy("feature", "key").agg(F.sum("n_base").alias("n_base"), F.sum("n_cur").alias("n_cur")), "drift-counts")

    def psi(self) -> DataFrame:
        """``(feature, psi)``, equal to ``psi_features`` on the tables themselves."""
        return _psi_of_counts(self.counts.where(F.col("feature") != _ROWS), self.edges, self.mode, self.bins)

    def score(self, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
        """One row ``(n_base, n_current, total_psi, threshold, refresh)``, equal to ``drift_score``."""
        rows = self.counts.where(F.col("feature") == _ROWS).agg(
            F.coalesce(F.sum("n_base"), F.lit(0)).alias("n_base"), F.coalesce(F.sum("n_cur"), F.lit(0)).alias("n_current"))
        one = side_by_side(rows, psi_total(self.psi()).select("total_psi")).select(
            "n_base", "n_current", F.when(F.col("n_base") == 0, 1.0).otherwise(F.col("total_psi")).alias("total_psi"))
        return drift_gate(one, threshold)

    def current_summary(self) -> DataFrame | None:
        """The current side as the next baseline, without another scan; None where its bins would need edges of its own."""
        if self.edges:
            return None
        return _summary(self.counts.where("n_cur > 0").select("feature", "key", F.col("n_cur").alias("n")), {})
