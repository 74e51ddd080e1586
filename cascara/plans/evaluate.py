"""k-NN model search as Spark jobs: split → stratified folds → cross-validated neighbours → votes for every grid
candidate → mean fold accuracy → best candidate → test predictions and metrics.

The neighbour search runs twice: for cross-validation with every metric at once and the largest k (the smaller k and
both weightings reuse those neighbours), and for the test rows with the best candidate's metric and k only. The fold table is checkpointed to the session's
checkpoint folder because three jobs read it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.operators import evaluate as EV
from cascara.session import scratch_root


class SearchResult:
    """The search's tables. ``fold_scores`` and ``test_pairs`` are small (candidates × folds; one row per test row)
    and are checkpointed on first use, so every report built on them reads them instead of re-running the
    neighbour search; the neighbour tables themselves stay lazy."""

    def __init__(self, split, train, test, cv_neighbours, fold_scores, find, ks, key, label):
        self.split, self.train, self.test = split, train, test
        self.cv_neighbours = cv_neighbours
        self._fold_scores, self._find, self._ks, self._key, self._label = fold_scores, find, ks, key, label
        self._memo: dict = {}

    def _ckpt(self, name, build):
        if name not in self._memo:
            df = build()
            scratch_root(df.sparkSession)
            self._memo[name] = df.checkpoint(eager=True)
        return self._memo[name]

    @property
    def fold_scores(self) -> DataFrame:
        """metric, n_neighbors, weights, fold, accuracy"""
        return self._ckpt("fold_scores", lambda: self._fold_scores)

    @property
    def summary(self) -> DataFrame:
        """metric, n_neighbors, weights, mean_score, rank_test_score, grid_index"""
        return EV.grid_summary(self.fold_scores, self._ks)

    @property
    def best(self) -> DataFrame:
        return EV.best_candidate(self.summary)

    @property
    def test_pairs(self) -> DataFrame:
        """qid, y, pred — test predictions of the best candidate"""
        def build():
            b = self.best.first()  # one row: only its metric and its k are searched
            near = self._find(b["n_neighbors"], [b["metric"]])
            preds = EV.knn_vote(near, [b["n_neighbors"]], [b["weights"]])
            truth = self.test.select(F.col(self._key).alias("qid"), F.col(self._label).alias("y"))
            return preds.join(truth, "qid").select("qid", "y", "pred")
        return self._ckpt("test_pairs", build)


def knn_search(df: DataFrame, *, key: str, vec: str, label: str, ks: Sequence[int] = (3, 5, 7),
               metrics: Sequence[str] = EV.METRICS, weights: Sequence[str] = EV.WEIGHTS, n_folds: int = 3,
               seed: int | str = 42, test_fraction: float = 0.2, block_rows: int | None = None,
               decimals: int | None = None, checkpoint: bool = True) -> SearchResult:
    base = df.select(F.col(key).alias(key), F.col(vec).cast("array<double>").alias(vec),
                     F.col(label).cast("long").alias(label))
    if checkpoint:
        # the search reads its input many times (split, folds, counts, both neighbour passes, truth): write it
        # once to the checkpoint folder, which also cuts the upstream lineage
        scratch_root(df.sparkSession)
        base = base.checkpoint(eager=True)
    split = EV.train_test_split(base, key, test_fraction, seed)
    train = EV.stratified_folds(split.where(~F.col("is_test")).drop("is_test"), key, label, n_folds, seed)
    if checkpoint:
        train = train.checkpoint(eager=True)
    test = split.where(F.col("is_test")).drop("is_test")
    kmax = max(ks)
    n_train = train.count()
    cv = EV.knn_neighbours(train, train, kmax, qkey=key, tkey=key, vec=vec, label=label, metrics=metrics,
                           exclude_same="fold", block_rows=block_rows, counts=(n_train, n_train), decimals=decimals)
    fold_scores = EV.cv_scores(EV.knn_vote(cv, ks, weights), train, qkey=key, label=label, fold="fold")

    def find(k: int, wanted: Sequence[str]) -> DataFrame:
        """The k nearest training rows of every test row."""
        return EV.knn_neighbours(test, train, k, qkey=key, tkey=key, vec=vec, label=label, metrics=wanted,
                                 block_rows=block_rows, counts=(test.count(), n_train), decimals=decimals)

    return SearchResult(split.select(key, label, "is_test"), train, test, cv, fold_scores, find, ks, key, label)


def feature_knn_search(df: DataFrame, *, key: Column, label: str, id_cols: Sequence[str], fit_on: str = "train",
                       test_fraction: float = 0.2, seed: int | str = 42, **search_kw) -> SearchResult:
    """Feature pipeline + k-NN search on a raw table: the row key (``key``, of any type) decides the split,
    the one-hot categories and min-max bounds are fitted on the training rows (``fit_on='train'``, no test
    leakage) or on all rows (``fit_on='all'``, what the original job does), and every row is encoded with them."""
    from cascara.operators.encode import feature_fit

    keyed = df.withColumn("__key", key)
    split = EV.train_test_split(keyed, "__key", test_fraction, seed)
    fit_rows = split.where(~F.col("is_test")) if fit_on == "train" else split
    if fit_on not in ("train", "all"):
        raise ValueError(fit_on)
    model = feature_fit(fit_rows, [*id_cols, "__key", "is_test"])
    vectors = model.transform(split, keep=["__key", label], as_vector="__vec").select(
        F.col("__key").alias("vec_id"), F.col("__vec").alias("vec"), F.col(label).cast("long").alias("label"))
    return knn_search(vectors, key="vec_id", vec="vec", label="label", test_fraction=test_fraction, seed=seed,
                      **search_kw)
