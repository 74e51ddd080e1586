"""DuckDB SQL of the queries that SQL can express."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
items AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS k
          FROM b, range(0, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 9, 1) END) r(i)),
places AS (SELECT doc_id, i, z.n, array_to_string(w[i + 1:i + z.n], ' ') AS k
           FROM (SELECT DISTINCT n FROM items) z, d, range(0, greatest(len(w) - z.n + 1, 0)) r(i)),
hits AS (SELECT doc_id, i, places.n, item_id FROM places JOIN items ON places.n = items.n AND places.k = items.k),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, range(0, n) r(o) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 20], ' ') AS k FROM d, range(0, greatest(len(w) - 19, 0)) r(i)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, i + o AS p FROM later, range(0, 20) r(o)),
words AS (SELECT doc_id, p, w[p + 1] AS word FROM d, range(0, len(w)) r(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

CLASSES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i + 1:i + 5], ' ') END AS s
             FROM d, range(0, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END) r(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_ AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM least_ LEFT JOIN sizes USING (doc_id)
"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_GAP = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_MEAN = "((s - ((s % n) + n) % n) // n)::BIGINT"  # floor, also of negative sums


def _clusters(rounds: int = 3) -> str:
    """Rounds of assigning and averaging; ``a{i}`` are the assignments under the centroids ``c{i}``."""
    sql = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
                        FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INTEGER AS c, v FROM e QUALIFY c < 16)"""
    for i in range(rounds + 1):
        sql += f""",
a{i} AS MATERIALIZED (SELECT r, vec_id, e.v, c, {_GAP.format("e.v", "k.v")}::BIGINT AS d FROM e, c{i} k QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        if i < rounds:
            sql += f""",
m{i} AS (SELECT c, list({_MEAN} ORDER BY p) AS v FROM (SELECT c, p, sum(v[p]) AS s, count(*) AS n FROM a{i}, range(1, 65) q(p) GROUP BY c, p) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m ON o.c = m.c)"""
    return sql + f"""
SELECT vec_id, a.c AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON a.c = k.c
"""


def _codes(rounds: int = 4) -> str:
    """Rounds of assigning and averaging per part; ``a{i}`` are the assignments under the codebooks ``b{i}``."""
    sql = f"""
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w
           FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE}),
x AS MATERIALIZED (SELECT r, p, w[p * len(w) // 4 + 1:(p + 1) * len(w) // 4] AS v FROM e, range(0, 4) q(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS k, v FROM x WHERE r <= 256)"""
    for i in range(rounds + 1):
        sql += f""",
a{i} AS MATERIALIZED (SELECT r, x.p, x.v, k, {_GAP.format("x.v", "b.v")}::BIGINT AS d FROM x JOIN b{i} b ON x.p = b.p QUALIFY row_number() OVER (PARTITION BY r, x.p ORDER BY d, k) = 1)"""
        if i < rounds:
            sql += f""",
m{i} AS (SELECT p, k, list({_MEAN} ORDER BY j) AS v FROM (SELECT p, k, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(v) + 1)) AS j FROM a{i}) GROUP BY p, k, j) GROUP BY p, k),
b{i + 1} AS MATERIALIZED (SELECT o.p, o.k, coalesce(m.v, o.v) AS v FROM b{i} o LEFT JOIN m{i} m ON o.p = m.p AND o.k = m.k)"""
    return sql + f""",
coded AS (SELECT r, string_agg(lower(lpad(to_hex(k), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN e USING (r)
"""


def _discounts(level: str) -> str:
    """The three discounts of a level (a table with counts ``a``), or the fallback."""
    return f"""SELECT CASE WHEN ok THEN e1 ELSE 0.5 END AS d1, CASE WHEN ok THEN e2 ELSE 1 END AS d2, CASE WHEN ok THEN e3 ELSE 1.5 END AS d3, n, n1, n2, total
  FROM (SELECT *, coalesce(e1 > 0 AND e1 <= 1 AND e2 > 0 AND e2 <= 2 AND e3 > 0 AND e3 <= 3 AND n1 > 0 AND n2 > 0 AND n3 > 0, false) AS ok
    FROM (SELECT *, 1 - 2 * y * n2 / n1 AS e1, 2 - 3 * y * n3 / n2 AS e2, 3 - 4 * y * n4 / n3 AS e3
      FROM (SELECT *, n1 / (n1 + 2 * n2) AS y FROM (SELECT count(*) AS n, sum(a) AS total, count(*) FILTER (a = 1) AS n1, count(*) FILTER (a = 2) AS n2,
        count(*) FILTER (a = 3) AS n3, count(*) FILTER (a = 4) AS n4 FROM {level}))))"""


_CUT = "CASE WHEN {0} IS NULL THEN 0 WHEN {0} = 1 THEN 1 - {1}.d1 WHEN {0} = 2 THEN 2 - {1}.d2 ELSE {0} - {1}.d3 END"

# the end mark is one space and the begin mark two, which no word holds
KNESER_NEY = rf"""
WITH bits AS (SELECT list(list_reduce(list_concat([i::BIGINT], [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384::BIGINT, a >> 1) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) q(i)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 7 = 2, false) AS held_out,
         coalesce(regexp_extract_all({_LOWER.format("text")}, '[^ 	-
]+'), []) || [' '] AS w FROM documents, bits),
ev AS MATERIALIZED (SELECT r, held_out, w[i] AS w, CASE WHEN i = 1 THEN '  ' ELSE w[i - 1] END AS v FROM docs, range(1, len(w) + 1) q(i)),
two AS MATERIALIZED (SELECT v, w, count(*) AS a FROM ev WHERE NOT held_out GROUP BY v, w),
one AS MATERIALIZED (SELECT w, count(*) AS a FROM two GROUP BY w),
plain AS MATERIALIZED (SELECT w, count(*) AS c FROM ev WHERE NOT held_out GROUP BY w),
d2 AS ({_discounts("two")}),
d1 AS ({_discounts("one")}),
size AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM plain),
context AS MATERIALIZED (SELECT v, sum(a) AS total, sum(CASE WHEN a = 1 THEN d1 WHEN a = 2 THEN d2 ELSE d3 END) AS rest FROM two, d2 GROUP BY v),
words AS MATERIALIZED (SELECT plain.w, c, CASE WHEN d1.n = 0 THEN 1 / (size.v + 1) ELSE ({_CUT.format("a", "d1")}) / d1.total END AS p FROM plain LEFT JOIN one ON plain.w = one.w, d1, size),
scored AS (SELECT r, coalesce(c, 0) AS c, coalesce(words.p, 0) + CASE WHEN d1.n = 0 THEN CASE WHEN words.p IS NULL THEN 1 / (size.v + 1) ELSE 0 END
               ELSE (d1.d1 * d1.n1 + d1.d2 * d1.n2 + d1.d3 * (d1.n - d1.n1 - d1.n2)) / d1.total / (size.v + 1) END AS p1,
             {_CUT.format("two.a", "d2")} AS cut, context.total, rest, size.n, size.v
           FROM ev LEFT JOIN words ON ev.w = words.w LEFT JOIN two ON ev.v = two.v AND ev.w = two.w LEFT JOIN context ON ev.v = context.v, d1, d2, size),
sums AS (SELECT r, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, sum(log10((c + 1) / (n + 1 * (v + 1)))) AS base,
           sum(log10(CASE WHEN total IS NULL THEN p1 ELSE (cut + rest * p1) / total END)) AS score FROM scored GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, (SELECT n FROM size)::BIGINT AS train_tokens, round(base, 6) AS base_score, round(score, 6) AS score
FROM docs JOIN sums USING (r)
"""

ORACLE = {
    "op2_suffix_array_decontamination": DECONTAMINATION,
    "op3_level_wise_doubling": SUBSTRINGS,
    "op6_vertical_partition_join": CLASSES,
    "op11_ptolemaic_pivots": _clusters(),
    "op12_kneser_ney": KNESER_NEY,
    "op13_equal_average_search": _codes(),
}
