"""Oracle-side SQL builders for distributions, histograms and PSI (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Sequence


def _long(rel: str, features: Sequence[str], tag: int, cast: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS {cast}) AS value, {tag} AS is_base FROM {rel} "
        f"WHERE {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> 'nan'" for f in features)


def counts_ctes(base: str, cur: str, features: Sequence[str]) -> str:
    """CTEs ``lng``, ``cnt(feature, value, n_base, n_cur)``, ``sh(feature, value, n_base, n_cur, e, a)``."""
    return f"""lng AS ({_long(base, features, 1, 'VARCHAR')} UNION ALL {_long(cur, features, 0, 'VARCHAR')}),
cnt AS (SELECT feature, value, CAST(sum(is_base) AS BIGINT) AS n_base, CAST(sum(1 - is_base) AS BIGINT) AS n_cur
  FROM lng GROUP BY feature, value),
tot AS (SELECT feature, sum(n_base) AS tb, sum(n_cur) AS tc FROM cnt GROUP BY feature),
sh AS (SELECT cnt.feature, value, n_base, n_cur, {nd('n_base', 'tb')} AS e, {nd('n_cur', 'tc')} AS a FROM cnt JOIN tot USING (feature))"""


def hist_ctes(base: str, cur: str, features: Sequence[str], bins: int = 10, normalise: str = "share") -> str:
    """CTE ``hs(feature, bin, lo_edge, hi_edge, n_base, n_cur, e, a)`` on baseline edges."""
    edges = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, min(CAST({f} AS DOUBLE)) AS lo, max(CAST({f} AS DOUBLE)) AS hi FROM {base} "
        f"WHERE {f} IS NOT NULL AND NOT isnan(CAST({f} AS DOUBLE))" for f in features)
    if normalise == "share":
        ea = f"{nd('n_base', 'tb')} AS e, {nd('n_cur', 'tc')} AS a"
    elif normalise == "density":
        ea = f"{nd(nd('n_base', 'tb'), 'width')} AS e, {nd(nd('n_cur', 'tc'), 'width')} AS a"
    else:
        ea = "CAST(n_base AS DOUBLE) AS e, CAST(n_cur AS DOUBLE) AS a"
    # Edges are evaluated numbers, one row each (edge i = i * step + lo, the last one hi); a value's bin is the number of
    # inner edges that it reaches.
    return f"""edg AS (SELECT feature, lo, hi FROM ({edges}) x),
eds AS (SELECT feature, lo, hi, CAST(i AS INTEGER) AS i, CASE WHEN i = {bins} THEN hi ELSE i * ((hi - lo) / {bins}) + lo END AS edge
  FROM edg, range(0, {bins + 1}) r(i)),
inn AS (SELECT feature, lo, hi, list(edge) FILTER (WHERE i BETWEEN 1 AND {bins - 1}) AS inner_edges FROM eds GROUP BY feature, lo, hi),
tl AS ({_long(base, features, 1, 'DOUBLE')} UNION ALL {_long(cur, features, 0, 'DOUBLE')}),
bnd AS (SELECT tl.feature, CAST(len(list_filter(inner_edges, lambda x: x <= value)) AS INTEGER) AS bin, is_base
  FROM tl JOIN inn USING (feature) WHERE NOT isnan(value) AND value BETWEEN lo AND hi),
bc AS (SELECT feature, bin, CAST(sum(is_base) AS BIGINT) AS n_base, CAST(sum(1 - is_base) AS BIGINT) AS n_cur
  FROM bnd GROUP BY feature, bin),
grd AS (SELECT x.feature, x.i AS bin, x.edge AS lo_edge, y.edge AS hi_edge FROM eds x JOIN eds y ON x.feature = y.feature AND y.i = x.i + 1),
full_h AS (SELECT grd.feature, grd.bin, lo_edge, hi_edge, coalesce(n_base, 0) AS n_base, coalesce(n_cur, 0) AS n_cur,
  hi_edge - lo_edge AS width FROM grd LEFT JOIN bc ON grd.feature = bc.feature AND grd.bin = bc.bin),
htot AS (SELECT feature, sum(n_base) AS tb, sum(n_cur) AS tc FROM full_h GROUP BY feature),
hs AS (SELECT full_h.feature, bin, lo_edge, hi_edge, n_base, n_cur, {ea} FROM full_h JOIN htot USING (feature))"""


def nd(num: str, den: str) -> str:
    """num / den, NaN for a zero denominator."""
    return f"(CASE WHEN {den} = 0 THEN 'NaN'::DOUBLE ELSE CAST({num} AS DOUBLE) / {den} END)"


def psi_expr() -> str:
    a = "CASE WHEN a = 0 THEN 1e-10 ELSE a END"
    e = "CASE WHEN e = 0 THEN 1e-10 ELSE e END"
    return f"sum(({a} - {e}) * ln(({a}) / ({e})))"
