"""DuckDB SQL of the queries that SQL can state."""

from __future__ import annotations

from cadenza.llm.mixing import LEAST_QUALITY, MARKS, MAX_EPOCHS, WEIGHTS
from cadenza.llm.quality import RULES, STOP_WORDS, SYMBOLS, WINDOW

_SPLIT = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MINHASH = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_SPLIT.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * p.c >= 80 * (i.c + j.c - p.c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.x, r.root FROM r JOIN e ON e.y = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def _rule(name: str, low: float | None, high: float | None) -> str:
    ratio = {"words": "n_words", "mean_word_chars": "word_chars / greatest(n_words, 1)",
             "symbols_per_word": "n_symbols / greatest(n_words, 1)", "stop_word_share": "(n_stop + 1) / greatest(n_words, 1)",
             "dup_line_share": "n_dup_lines / greatest(n_lines, 1)", "words_per_line": "n_words / greatest(n_lines, 1)"}[name]
    return " AND ".join([f"{ratio} >= {low}"] * (low is not None) + [f"{ratio} <= {high}"] * (high is not None))


_STOPS = ", ".join(f"'{f}'" for w in STOP_WORDS for f in (w, w.capitalize()))
QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_SPLIT.format(text="text")} AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, unnest(range(1, len(w) - {WINDOW - 2})) AS i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
      FROM w WHERE len(w) >= {WINDOW}),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
m AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, range({WINDOW}) AS k(k) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(m.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop, len(l) AS n_lines
  FROM w LEFT JOIN m ON m.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {" AND ".join(_rule(*r) for r in RULES)} AS kept
FROM c"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, '~') AS src, coalesce(CAST(doc_id AS VARCHAR), '') AS id, coalesce(text, '') AS t,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
k AS (
  SELECT doc_id, src, id, size,
    -ln((CAST(CAST('0x' || substr(md5(id || '|' || md5(t) || '|0'), 1, 13) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))
        / CAST(4503599627370496 AS DOUBLE))
    / greatest(length(translate(t, '{MARKS}', '')) / greatest(length(t), 1), CAST({LEAST_QUALITY} AS DOUBLE)) AS key FROM d),
s AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size, CAST({MAX_EPOCHS} * sum(size) AS BIGINT) AS cap,
    {list(WEIGHTS)}[(row_number() OVER (ORDER BY src) - 1) % {len(WEIGHTS)} + 1] AS w FROM k GROUP BY src),
f AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0) AS DOUBLE)
    / CAST(sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS DOUBLE) AS lam FROM s
  WINDOW p AS (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT src, source_size, least(CAST(cap AS DOUBLE),
    coalesce((SELECT min_by(lam, cap / w) FROM f WHERE cap >= lam * w), CAST('inf' AS DOUBLE)) * w) AS target FROM s),
b AS (
  SELECT *, CAST(floor(target + CAST(0.5 AS DOUBLE)) AS BIGINT) AS want,
    CASE WHEN source_size > 0 THEN CAST(floor(target + CAST(0.5 AS DOUBLE)) AS BIGINT) // source_size ELSE 0 END AS epochs FROM g),
u AS (SELECT src, key, id, size, count(*) AS copies FROM k GROUP BY ALL),
v AS (
  SELECT u.*, want - epochs * source_size - (sum(size * copies) OVER (PARTITION BY src ORDER BY key, id, size) - size * copies) AS room,
    source_size, target, epochs FROM u JOIN b USING (src))
SELECT doc_id, size, source_size, target, CAST(epochs * size + CASE WHEN room <= 0 THEN 0 WHEN room > size * copies THEN size
  ELSE room // copies END AS BIGINT) AS taken FROM k JOIN v USING (src, key, id, size)"""

TRIE = """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
b AS (
  SELECT i.conv_id, p, role, text FROM i JOIN o ON o.conv_id = i.conv_id - i.conv_id % 5 AND p < h
  UNION ALL SELECT conv_id, p, role, text FROM o JOIN i USING (conv_id) WHERE p >= h),
r AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS n_bytes, list({'role': role, 'text': text}) OVER w AS prefix FROM b
  WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, [] FROM i),
e AS (SELECT conv_id, depth, n_bytes, prefix, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM r),
n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS save,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM e GROUP BY prefix, depth),
c AS (SELECT prefix[:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
t AS (
  SELECT n.prefix[:a] AS prefix, a AS depth, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum(save) AS saved_tokens
  FROM n LEFT JOIN c USING (prefix, depth), unnest(range(0, n.depth + 1)) u(a) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, t.n_leaves,
  CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN t USING (prefix, depth) LEFT JOIN c USING (prefix, depth)
LEFT JOIN n m ON n.depth > 0 AND m.depth = n.depth - 1 AND m.prefix = n.prefix[:n.depth - 1]"""
