"""Oracle-side SQL for split, folds and brute-force k-NN (DuckDB dialect); distances rounded to 9 places before
ranking, as in the Spark search.

The oracle evaluates every (query, train) pair — fine for the small check fixture, and exactly the brute force the
blocked Spark search must agree with.
"""

from __future__ import annotations

EMB_SOURCE = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS BIGINT) AS label FROM embeddings"


def base_sql(source: str) -> str:
    """Split and folds over any ``(vec_id, v, label)`` relation."""
    return f"""e AS (SELECT *, md5(CAST(vec_id AS VARCHAR) || '42') AS h FROM ({source}) src),
s AS (SELECT *, row_number() OVER (ORDER BY h) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM e),
tr AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY h, vec_id) - 1) % 3 AS INTEGER) AS fold
  FROM s WHERE NOT is_test),
te AS (SELECT * FROM s WHERE is_test)"""


BASE = base_sql(EMB_SOURCE)

L1 = "list_sum(list_transform(range(1, len(q.v) + 1), lambda i: abs(q.v[i] - t.v[i])))"


def pairs(name: str, left: str, right: str, on: str = "true", extra: str = "") -> str:
    """CTE ``name(qid, y, fold?, tid, tlabel, metric, dist)`` with both metrics in long form."""
    return f"""{name}_p AS (SELECT q.vec_id AS qid, q.label AS y, {extra} t.vec_id AS tid, t.label AS tlabel,
  round(list_distance(q.v, t.v), 9) AS d2, round({L1}, 9) AS d1 FROM {left} q JOIN {right} t ON {on}),
{name} AS (SELECT * EXCLUDE (d1, d2), 'euclidean' AS metric, d2 AS dist FROM {name}_p
  UNION ALL SELECT * EXCLUDE (d1, d2), 'manhattan' AS metric, d1 AS dist FROM {name}_p)"""


def ranked(name: str, src: str, k: int) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY qid, metric ORDER BY dist, tid)
  AS INTEGER) AS rank FROM {src}) x WHERE rank <= {k})"""


def votes(name: str, src: str, group_extra: str = "") -> str:
    """CTE ``name(qid, y, <extra>, metric, n_neighbors, weights, pred)`` for k in 3,5,7 and both weightings."""
    g = f"qid, y, {group_extra} metric, n_neighbors, weights"
    return f"""{name}_k AS (SELECT * FROM (SELECT *, unnest([3, 5, 7]) AS n_neighbors FROM {src}) x
  WHERE rank <= n_neighbors),
{name}_w AS (SELECT *, unnest(['uniform', 'distance']) AS weights FROM {name}_k),
{name}_z AS (SELECT *, min(dist) OVER (PARTITION BY qid, metric, n_neighbors, weights) AS md FROM {name}_w),
{name}_s AS (SELECT {g}, tlabel, sum(CASE WHEN weights = 'uniform' THEN 1.0 WHEN md = 0 THEN
  (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END) AS score FROM {name}_z GROUP BY {g}, tlabel),
{name} AS (SELECT {g}, tlabel AS pred FROM (SELECT *, row_number() OVER (PARTITION BY qid, metric, n_neighbors,
  weights ORDER BY score DESC, tlabel) AS r FROM {name}_s) x WHERE r = 1)"""


GRID_INDEX = ("(CASE metric WHEN 'euclidean' THEN 0 ELSE 1 END) * 6 + (CASE n_neighbors WHEN 3 THEN 0 WHEN 5 THEN 1 "
              "ELSE 2 END) * 2 + (CASE weights WHEN 'uniform' THEN 0 ELSE 1 END)")

def search_sql(source: str = EMB_SOURCE) -> str:
    """The whole grid search and test predictions as CTEs over a ``(vec_id, v, label)`` relation."""
    return f"""WITH {base_sql(source)},
{pairs('cvp', 'tr', 'tr', 'q.fold <> t.fold', 'q.fold AS fold,')},
{ranked('cvr', 'cvp', 7)},
{votes('cvv', 'cvr', 'fold,')},
fs AS (SELECT metric, n_neighbors, weights, fold, avg(CAST(pred = y AS DOUBLE)) AS accuracy FROM cvv
  GROUP BY metric, n_neighbors, weights, fold),
sm AS (SELECT metric, n_neighbors, weights, avg(accuracy) AS mean_score FROM fs GROUP BY metric, n_neighbors, weights),
summ AS (SELECT *, CAST(rank() OVER (ORDER BY round(mean_score, 9) DESC) AS INTEGER) AS rank_test_score,
  {GRID_INDEX} AS grid_index FROM sm),
best AS (SELECT metric, n_neighbors, weights FROM summ ORDER BY rank_test_score, grid_index LIMIT 1),
{pairs('tp', 'te', 'tr')},
{ranked('trk', 'tp', 7)},
{votes('tv', 'trk')},
tpairs AS (SELECT qid, y, pred FROM tv JOIN best USING (metric, n_neighbors, weights))
"""


SEARCH = search_sql()


def class_report_sql(pairs_rel: str) -> str:
    """Per-class precision/recall/f1/support plus macro and weighted averages from a (y, pred) relation."""
    return f"""cm AS (SELECT y, pred, count(*) AS n FROM {pairs_rel} GROUP BY y, pred),
cls AS (SELECT y AS c FROM cm UNION SELECT pred FROM cm),
pc AS (SELECT cls.c,
  coalesce((SELECT sum(n) FROM cm WHERE cm.y = cls.c), 0) AS support,
  coalesce((SELECT sum(n) FROM cm WHERE cm.y = cls.c AND cm.pred = cls.c), 0) AS tp,
  coalesce((SELECT sum(n) FROM cm WHERE cm.pred = cls.c), 0) AS npred FROM cls),
per AS (SELECT CAST(c AS VARCHAR) AS class,
  CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
  CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, CAST(support AS BIGINT) AS support FROM pc),
per2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END
  AS f1 FROM per),
rep AS (SELECT * FROM per2
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), CAST(sum(support) AS BIGINT), avg(f1) FROM per2
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    CAST(sum(support) AS BIGINT), sum(f1 * support) / sum(support) FROM per2)"""


REPORT_SELECT = ("SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                 "round(f1, 6) AS f1, support FROM rep")
