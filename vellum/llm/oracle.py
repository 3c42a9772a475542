"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"

SUBSTRING = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
win AS (
  SELECT doc_id, beg, list_slice(words, beg, beg + 34) AS seq
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS beg FROM docs)),
repeated AS (
  SELECT doc_id, beg FROM (
    SELECT doc_id, beg, count(*) OVER (PARTITION BY sha256(array_to_string(seq, ' '))) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(beg, beg + 34)) AS pos FROM repeated),
lists AS (SELECT doc_id, list(pos) AS gone_at FROM gone GROUP BY doc_id),
flat AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM docs),
kept AS (
  SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.pos) AS body
  FROM flat f ANTI JOIN gone g ON f.doc_id = g.doc_id AND f.pos = g.pos GROUP BY f.doc_id)
SELECT d.doc_id, cast(len(d.words) AS BIGINT) AS n_words,
       cast(coalesce(len(l.gone_at), 0) AS BIGINT) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM docs d LEFT JOIN lists l USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

LINES = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND s.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, cast(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

EXACT = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)"""

NEAR = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(generate_series(1, len(w) - 4),
                                                          lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x)
SELECT s.doc_id, cast(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON s.doc_id = r.x"""

# the same with a limit of 85 percent, and the documents that stay
CLOSE = f"SELECT *, doc_id = component_id AS kept FROM ({NEAR.replace('>= 80 *', '>= 85 *')})"

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         cast(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, cast(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY rank <= 3"""

TRIE = """
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT cast(unnest(generate_series(0, 255)) AS BIGINT) AS i)),
turns AS (
  SELECT conv_id, sha256(coalesce(role, '') || chr(10) || coalesce(text, '')) AS turn_hash, length(coalesce(text, '')) AS points,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(coalesce(role, '') || chr(10) || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS donor,
         xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(string_split(cast(conv_id AS VARCHAR), ''), lambda c: cast(ascii(c) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 6 AS h
  FROM turns CROSS JOIN crc_table GROUP BY conv_id, t),
planned AS (SELECT c.*, least(c.h, coalesce(d.n, 0)) AS taken FROM convs c LEFT JOIN convs d ON d.conv_id = c.donor),
steps AS (
  SELECT p.conv_id, t.pos + 1 AS depth, turn_hash, points FROM planned p JOIN turns t ON t.conv_id = p.donor AND t.pos < p.h
  UNION ALL
  SELECT p.conv_id, p.taken + t.pos - p.h + 1, turn_hash, points FROM planned p JOIN turns t ON t.conv_id = p.conv_id AND t.pos >= p.h
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
keyed AS (
  SELECT conv_id, depth, points, sha256(string_agg(turn_hash, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS key,
         max(depth) OVER (PARTITION BY conv_id) AS size FROM steps),
nodes AS (
  SELECT key, depth, min(conv_id) AS rep, count(*) AS n_convs, max(points) AS points,
         sha256(coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256
  FROM keyed GROUP BY key, depth),
placed AS (SELECT k.conv_id, k.depth, n.rep FROM keyed k JOIN nodes n USING (key, depth)),
parented AS (
  SELECT n.*, p.rep AS parent_rep FROM nodes n LEFT JOIN placed p ON p.conv_id = n.rep AND p.depth = n.depth - 1),
counted AS (
  SELECT n.*, (SELECT count(*) FROM parented c WHERE c.parent_rep = n.rep AND c.depth = n.depth + 1) AS n_children
  FROM parented n),
rolled AS (
  SELECT p.rep, p.depth, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n.n_convs - 1) * n.points) AS saved_tokens
  FROM counted n JOIN placed p ON p.conv_id = n.rep AND p.depth <= n.depth GROUP BY p.rep, p.depth)
SELECT n.rep AS conv_id, cast(n.depth AS BIGINT) AS depth, n.parent_rep AS parent_conv_id, n.n_convs,
       cast(n.n_children AS BIGINT) AS n_children, cast(r.n_leaves AS BIGINT) AS n_leaves,
       cast(r.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN rolled r ON r.rep = n.rep AND r.depth = n.depth"""

ORACLE = {"op1_substring_dedup": SUBSTRING, "op2_line_dedup": LINES, "op3_exact_dedup": EXACT, "op4_ngram_join": NEAR,
          "op11_hard_negatives": NEGATIVES, "op12_chosen_path": CLOSE, "op13_prefix_trie": TRIE}
