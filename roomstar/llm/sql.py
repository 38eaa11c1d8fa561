"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from roomstar.llm.license_scan import GAP, GRAM, LOWER, MAX_STRETCH, MIN_COVERAGE, PHRASES, TEMPLATES, UPPER

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


_NOT_SPACE = r"[^\x20\x09-\x0D]+"


def _words(text: str, word: str = _TERM) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{word}')"


def _license_scan() -> str:
    rows = [(i, label, text, i < len(PHRASES)) for i, (label, text) in enumerate([*PHRASES, *TEMPLATES])]
    values = ", ".join("({}, '{}', '{}', {})".format(i, label, text.replace("'", "''"), exact) for i, label, text, exact in rows)
    ahead = ", ".join(f"lead(w, {j}) OVER (PARTITION BY k ORDER BY pos) AS w{j}" for j in range(1, GRAM))
    same = " AND ".join(f"d.w{j} = t.w{j}" for j in range(1, GRAM))
    return f"""
WITH t AS (SELECT i AS k, label, exact, {_words('text')} AS ws FROM (VALUES {values}) v(i, label, text, exact)),
d AS (SELECT row_number() OVER () AS k, doc_id, {_words('text')} AS ws FROM documents),
t_word AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM t),
d_word AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM d),
t_run AS (SELECT k, pos, w, {ahead} FROM t_word QUALIFY lead(w, {GRAM - 1}) OVER (PARTITION BY k ORDER BY pos) IS NOT NULL),
d_run AS (SELECT k, pos, w, {ahead} FROM d_word QUALIFY lead(w, {GRAM - 1}) OVER (PARTITION BY k ORDER BY pos) IS NOT NULL),
votes AS (
  SELECT d.k, t.k AS tk, d.pos - t.pos AS diagonal, list(t.pos) AS pos FROM d_run d JOIN t_run t ON d.w = t.w AND {same}
  GROUP BY ALL),
gaps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY k, tk ORDER BY diagonal) > {GAP} THEN 1 ELSE 0 END AS apart
  FROM votes),
merged AS (SELECT *, sum(apart) OVER (PARTITION BY k, tk ORDER BY diagonal) AS span FROM gaps),
spans AS (
  SELECT m.k, m.span, t.label, t.exact, len(t.ws) AS t_words,
         min(diagonal + list_min(m.pos)) AS lo, max(diagonal + list_max(m.pos) + {GRAM}) AS hi,
         count(*) FILTER (t.exact AND len(m.pos) = len(t.ws) - {GRAM - 1}) AS whole,
         min(diagonal) FILTER (t.exact AND len(m.pos) = len(t.ws) - {GRAM - 1}) AS whole_first,
         max(diagonal) FILTER (t.exact AND len(m.pos) = len(t.ws) - {GRAM - 1}) AS whole_last,
         len(list_distinct(flatten(list_transform(flatten(list(m.pos)), lambda p: range(p, p + {GRAM}))))) AS covered
  FROM merged m JOIN t ON m.tk = t.k GROUP BY m.k, m.tk, m.span, t.label, t.exact, t.ws),
judged AS (
  SELECT *, CASE WHEN NOT exact THEN covered::DOUBLE / t_words WHEN whole > 0 THEN 1.0::DOUBLE END AS share,
         CASE WHEN exact THEN whole > 0
              ELSE covered::DOUBLE / t_words >= {MIN_COVERAGE} AND hi - lo <= {MAX_STRETCH} * t_words END AS fits
  FROM spans)
SELECT d.doc_id, len(any_value(d.ws))::BIGINT AS n_words, coalesce(sum(whole), 0)::BIGINT AS n_base,
       min(whole_first)::BIGINT AS first_word, max(whole_last)::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole > 0), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (fits), '') AS labels,
       coalesce(max(share), 0.0)::DOUBLE AS score
FROM d LEFT JOIN judged j ON d.k = j.k GROUP BY d.k, d.doc_id"""


_LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_words('text')} AS ws FROM documents),
q AS (SELECT DISTINCT item_id, text FROM benchmark),
terms AS (SELECT DISTINCT item_id, text, unnest({_words('text')}) AS w FROM q),
stats AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS all_terms FROM d WHERE len(ws) > 0),
tf AS (SELECT k, doc_id, n, w, count(*) AS tf
       FROM (SELECT k, doc_id, len(ws) AS n, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM terms)
       GROUP BY k, doc_id, n, w),
weights AS (SELECT w, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tf, stats GROUP BY w),
scores AS (
  SELECT item_id, text, k, doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // all_terms))))::BIGINT AS score
  FROM terms JOIN tf USING (w) JOIN weights USING (w), stats GROUP BY item_id, text, k, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, k) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

_HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scores WHERE same QUALIFY place <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.place, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
  QUALIFY rank <= 10)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score,
       place::INTEGER AS positive_rank FROM ranked"""

# An item's windows and a document's windows of the same number of words, joined as texts.
_DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_words('text')} AS ws FROM documents),
q AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_words('text')} AS ws FROM benchmark),
item_window AS (
  SELECT DISTINCT item, least(len(ws), 13) AS m,
         unnest(list_transform(range(1, greatest(len(ws) - 11, 2)), lambda i: array_to_string(ws[i:i + 12], ' '))) AS p
  FROM q WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT m FROM item_window),
d_window AS (
  SELECT k, m, unnest(range(1, len(ws) - m + 2)) AS i,
         unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS p
  FROM d, sizes WHERE len(ws) >= m),
occurs AS (SELECT w.k, w.i, w.m, t.item FROM d_window w JOIN item_window t ON w.m = t.m AND w.p = t.p),
hit AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + m)) AS at_word FROM occurs) GROUP BY k),
items AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM occurs GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN items USING (k)"""

# Every 50 bytes of every text; a hit starts in a document with a smaller id too.
_SUFFIX_DEDUP = """
WITH size AS (SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS b,
                     octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
gram AS (SELECT k, doc_id, unnest(range(n - 49)) AS i,
                unnest(list_transform(range(n - 49), lambda i: b[i + 1:i + 50])) AS s FROM size WHERE n >= 50),
first AS (SELECT s, min(doc_id) AS least FROM gram GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT gram.k, gram.i FROM gram JOIN first USING (s) WHERE gram.doc_id > first.least),
edge AS (SELECT k, i, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
run AS (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS r FROM edge),
span AS (SELECT k, min(i) AS lo, max(i) + 50 AS hi FROM run GROUP BY k, r),
gap AS (SELECT k, coalesce(lag(hi) OVER (PARTITION BY k ORDER BY lo), 0) AS lo, lo AS hi FROM span
        UNION ALL SELECT s.k, max(s.hi), any_value(z.n) FROM span s JOIN size z USING (k) GROUP BY s.k),
kept AS (SELECT g.k, from_hex(string_agg(hex(b[g.lo + 1:g.hi]), '' ORDER BY g.lo)) AS b
         FROM gap g JOIN size USING (k) WHERE g.lo < g.hi GROUP BY g.k),
cut AS (SELECT k, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM span GROUP BY k)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN size.b ELSE coalesce(kept.b, ''::BLOB) END) AS kept_sha256
FROM size LEFT JOIN cut USING (k) LEFT JOIN kept USING (k)"""

# Pairs of different shingle sets by their common shingles, then all that can be reached.
_NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS k, doc_id,
         {_words('text', _NOT_SPACE)} AS ws FROM documents),
shingle AS (
  SELECT k, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s FROM w),
d AS (SELECT k, doc_id, s, len(s) AS n FROM shingle),
distinct_sets AS (SELECT list_sort(s) AS s, any_value(n) AS n, min(k) AS node FROM d GROUP BY list_sort(s)),
entry AS (SELECT node, n, unnest(s) AS h FROM distinct_sets),
link AS (
  SELECT a.node AS x, b.node AS y FROM entry a JOIN entry b ON a.h = b.h AND a.node < b.node
   AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(root, node) AS (SELECT node, node FROM distinct_sets UNION SELECT r.root, b.y FROM reach r JOIN both_ways b ON r.node = b.x),
placed AS (SELECT d.k, d.doc_id, d.n, s.node FROM d JOIN distinct_sets s ON list_sort(d.s) = s.s),
least AS (SELECT r.root, min(p.doc_id) AS component_id FROM reach r JOIN placed p ON p.node = r.node GROUP BY r.root)
SELECT p.doc_id, p.n::BIGINT AS n_shingles, CASE WHEN p.n = 0 THEN p.doc_id ELSE l.component_id END AS component_id,
       p.n = 0 OR p.doc_id = l.component_id AS kept
FROM placed p JOIN least l ON l.root = p.node"""

ORACLE: dict[str, str] = {
    "op7_decontaminate": _DECONTAMINATE,
    "op8_suffix_dedup": _SUFFIX_DEDUP,
    "op10_near_dedup": _NEAR_DEDUP,
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_license_scan": _license_scan(),
    "op13_lexical_search": _LEXICAL_SEARCH,
}
