"""Evaluation queries over ``embeddings`` (64-d vectors, 10 labels): split, folds, k-NN joins, grid search, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.catalog import sql_knn as K
from cascara.catalog.registry import query, table
from cascara.functions.columns import rounded
from cascara.operators import evaluate as EV
from cascara.plans.evaluate import knn_search
from cascara.session import written

KEY, VEC, LABEL = "vec_id", "embedding", "label"
#: The oracle sums in another order: both sides rank rounded distances, so that equal ones tie in both.
DECIMALS = 9


def emb(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col(KEY).cast("long").alias(KEY), F.col(VEC).cast("array<double>").alias(VEC),
        F.col(LABEL).cast("long").alias(LABEL))


def search(spark, sf):
    return knn_search(emb(spark, sf), key=KEY, vec=VEC, label=LABEL, decimals=DECIMALS)


@query("train_test_split", f"WITH {K.BASE} SELECT vec_id, label, is_test FROM s")
def q_train_test_split(spark, sf):
    return EV.train_test_split(emb(spark, sf), KEY, 0.2, 42).select(KEY, LABEL, "is_test")


@query("stratified_folds", f"WITH {K.BASE} SELECT vec_id, label, fold FROM tr")
def q_stratified_folds(spark, sf):
    s = EV.train_test_split(emb(spark, sf), KEY, 0.2, 42)
    return EV.stratified_folds(s.where(~F.col("is_test")), KEY, LABEL, 3, 42).select(KEY, LABEL, "fold")


def _split(spark, sf):
    s = EV.train_test_split(emb(spark, sf), KEY, 0.2, 42)
    return s.where(F.col("is_test")), s.where(~F.col("is_test"))


def _knn_sql(metric: str, k: int) -> str:
    return (f"WITH {K.BASE},\n{K.pairs('tp', 'te', 'tr')},\n{K.ranked('trk', 'tp', k)}\n"
            f"SELECT qid, tid, tlabel, rank, round(dist, 6) AS dist FROM trk WHERE metric = '{metric}'")


def _knn(spark, sf, metric, k):
    te, tr = _split(spark, sf)
    n = EV.knn_neighbours(te, tr, k, qkey=KEY, tkey=KEY, vec=VEC, label=LABEL, metrics=[metric],
                          decimals=DECIMALS)
    return n.select("qid", "tid", "tlabel", "rank", rounded(F.col("dist")).alias("dist"))


@query("knn_join_l2", _knn_sql("euclidean", 5))
def q_knn_join_l2(spark, sf):
    """Every test row against every train row: the 5 nearest by euclidean distance."""
    return _knn(spark, sf, "euclidean", 5)


@query("knn_join_l1", _knn_sql("manhattan", 5))
def q_knn_join_l1(spark, sf):
    return _knn(spark, sf, "manhattan", 5)


@query("knn_classify", f"WITH {K.BASE},\n{K.pairs('tp', 'te', 'tr')},\n{K.ranked('trk', 'tp', 7)},\n"
                       f"{K.votes('tv', 'trk')}\nSELECT qid, pred FROM tv WHERE metric = 'euclidean' AND "
                       f"n_neighbors = 5 AND weights = 'uniform'")
def q_knn_classify(spark, sf):
    """Majority vote of the 5 nearest (euclidean, uniform weights) for every test row."""
    te, tr = _split(spark, sf)
    n = EV.knn_neighbours(te, tr, 5, qkey=KEY, tkey=KEY, vec=VEC, label=LABEL, metrics=["euclidean"],
                          decimals=DECIMALS)
    return EV.knn_vote(n, [5], ["uniform"]).select("qid", "pred")


@query("knn_classify_distance", f"WITH {K.BASE},\n{K.pairs('tp', 'te', 'tr')},\n{K.ranked('trk', 'tp', 7)},\n"
                                f"{K.votes('tv', 'trk')}\nSELECT qid, pred FROM tv WHERE metric = 'manhattan' AND "
                                f"n_neighbors = 7 AND weights = 'distance'")
def q_knn_classify_distance(spark, sf):
    """Distance-weighted vote of the 7 nearest by manhattan distance."""
    te, tr = _split(spark, sf)
    n = EV.knn_neighbours(te, tr, 7, qkey=KEY, tkey=KEY, vec=VEC, label=LABEL, metrics=["manhattan"],
                          decimals=DECIMALS)
    return EV.knn_vote(n, [7], ["distance"]).select("qid", "pred")


@query("cv_fold_scores", K.SEARCH + "SELECT metric, n_neighbors, weights, fold, round(accuracy, 6) AS accuracy FROM fs")
def q_cv_fold_scores(spark, sf):
    r = search(spark, sf)
    return r.fold_scores.select("metric", "n_neighbors", "weights", "fold", rounded(F.col("accuracy")).alias("accuracy"))


@query("knn_grid_search", K.SEARCH + "SELECT metric, n_neighbors, weights, round(mean_score, 6) AS mean_score, "
                                     "rank_test_score FROM summ")
def q_knn_grid_search(spark, sf):
    """12 candidates × 3 folds, mean accuracy and rank per candidate."""
    r = search(spark, sf)
    return r.summary.select("metric", "n_neighbors", "weights", rounded(F.col("mean_score")).alias("mean_score"),
                            F.col("rank_test_score").cast("int").alias("rank_test_score"))


@query("best_params", K.SEARCH + "SELECT * FROM best")
def q_best_params(spark, sf):
    return search(spark, sf).best.select("metric", "n_neighbors", "weights")


@query("confusion_matrix", K.SEARCH + "SELECT y, pred, count(*) AS n FROM tpairs GROUP BY y, pred")
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(search(spark, sf).test_pairs)


def _report_round(df):
    return df.select("class", rounded(F.col("precision")).alias("precision"), rounded(F.col("recall")).alias("recall"),
                     rounded(F.col("f1")).alias("f1"), "support")


@query("class_metrics", K.SEARCH + ",\n" + K.class_report_sql("tpairs") + "\n" + K.REPORT_SELECT)
def q_class_metrics(spark, sf):
    """Test-set report of the best candidate: per class, macro and weighted averages."""
    return _report_round(EV.class_report(search(spark, sf).test_pairs))


@query("test_accuracy", K.SEARCH + "SELECT round(avg(CAST(pred = y AS DOUBLE)), 6) AS accuracy, count(*) AS n "
                                   "FROM tpairs")
def q_test_accuracy(spark, sf):
    a = EV.accuracy(search(spark, sf).test_pairs)
    return a.select(rounded(F.col("accuracy")).alias("accuracy"), "n")


@query("class_metrics_labels",
       "WITH lp AS (SELECT CAST(quality AS BIGINT) AS y, CAST(toxic AS BIGINT) AS pred FROM labels),\n"
       + K.class_report_sql("lp") + "\n" + K.REPORT_SELECT)
def q_class_metrics_labels(spark, sf):
    """The metrics operator on the labels table (quality as truth, toxic as prediction)."""
    lp = table(spark, sf, "labels").select(F.col("quality").cast("long").alias("y"),
                                           F.col("toxic").cast("long").alias("pred"))
    return _report_round(EV.class_report(lp))


# ---------------------------------------------------------------------------------------------------------------
# the original training job: cleaned churn table → features → k-NN grid search → test report


def churn_vectors(spark, sf):
    """Cleaned churn rows as scaled feature vectors (one-hot + min-max fitted on all rows, as the original job)."""
    from cascara.catalog.q_clean import cleaned
    from cascara.operators import encode as E

    df = written(cleaned(spark, sf), "clean")
    model = E.feature_fit(df, ["CustomerID", "Churn"])
    X = model.transform(df, keep=["CustomerID", "Churn"], as_vector="features")
    return X.select(F.col("CustomerID").alias(KEY), F.col("features").alias(VEC),
                    F.col("Churn").cast("long").alias(LABEL))


def churn_search(spark, sf):
    return knn_search(churn_vectors(spark, sf), key=KEY, vec=VEC, label=LABEL, decimals=DECIMALS)


def _churn_search_sql() -> str:
    from cascara.catalog.q_encode import churn_vectors_sql

    return K.search_sql(churn_vectors_sql())


@query("knn_grid_search_churn", _churn_search_sql() + "SELECT metric, n_neighbors, weights, "
                                                     "round(mean_score, 6) AS mean_score, rank_test_score FROM summ")
def q_knn_grid_search_churn(spark, sf):
    """The original job's search on the churn features: 12 candidates × 3 stratified folds."""
    r = churn_search(spark, sf)
    return r.summary.select("metric", "n_neighbors", "weights", rounded(F.col("mean_score")).alias("mean_score"),
                            F.col("rank_test_score").cast("int").alias("rank_test_score"))


@query("class_metrics_churn", _churn_search_sql() + ",\n" + K.class_report_sql("tpairs") + "\n" + K.REPORT_SELECT)
def q_class_metrics_churn(spark, sf):
    """Test report of the best churn candidate (class 1 = churned)."""
    return _report_round(EV.class_report(churn_search(spark, sf).test_pairs))


def _churn_train_fit_sql() -> str:
    from cascara.catalog.q_encode import churn_vectors_sql

    return K.search_sql(churn_vectors_sql(fit_on_train=True))


def churn_search_fit_train(spark, sf):
    from cascara.catalog.q_clean import cleaned
    from cascara.plans.evaluate import feature_knn_search

    return feature_knn_search(written(cleaned(spark, sf), "clean"), key=F.col("CustomerID"), label="Churn", decimals=DECIMALS,
                              id_cols=["CustomerID", "Churn"], fit_on="train")


@query("knn_grid_search_churn_fit_train", _churn_train_fit_sql() + "SELECT metric, n_neighbors, weights, "
       "round(mean_score, 6) AS mean_score, rank_test_score FROM summ")
def q_knn_grid_search_churn_fit_train(spark, sf):
    """The churn search with encoder and scaler fitted on the training rows only (no test leakage)."""
    r = churn_search_fit_train(spark, sf)
    return r.summary.select("metric", "n_neighbors", "weights", rounded(F.col("mean_score")).alias("mean_score"),
                            F.col("rank_test_score").cast("int").alias("rank_test_score"))


@query("class_metrics_churn_fit_train", _churn_train_fit_sql() + ",\n" + K.class_report_sql("tpairs") + "\n"
       + K.REPORT_SELECT)
def q_class_metrics_churn_fit_train(spark, sf):
    return _report_round(EV.class_report(churn_search_fit_train(spark, sf).test_pairs))
