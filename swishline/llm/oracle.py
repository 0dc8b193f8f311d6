"""DuckDB twins of the queries whose results SQL can state from the tables alone."""

from __future__ import annotations

from swishline.llm import chat, lexical, merkle

_NGRAM_TABLES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), sized AS (
  SELECT a, b, c, x.n AS na, y.n AS nb
  FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
), links AS (
  SELECT a, b FROM sized WHERE 100 * c >= 80 * (na + nb - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT doc_id, b FROM reached JOIN both_ways ON other = a
), component AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
), same AS (
  SELECT b AS doc_id, min(a) AS class_id FROM sized WHERE c = na AND c = nb GROUP BY b
), linked AS (
  SELECT a AS doc_id, count(*) AS n_links FROM both_ways GROUP BY a
)
"""

NGRAM_JOIN = f"""{_NGRAM_TABLES}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_id, doc_id) AS class_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN component USING (doc_id)
LEFT JOIN same USING (doc_id)
"""

# a document's other documents that are similar, those with an equal set among them
NGRAM_LINKS = f"""{_NGRAM_TABLES}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_id, doc_id) AS class_id,
  coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN component USING (doc_id)
LEFT JOIN same USING (doc_id) LEFT JOIN linked USING (doc_id)
"""

QUALITY_RULES = r"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10))
      IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i : i + 2] AS g FROM split, unnest(range(1, len(w) - 1)) AS t(i)
), repeated AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS t(k)
  WHERE times > 1 GROUP BY doc_id
), measured AS (
  SELECT doc_id, source AS host, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS k FROM judged GROUP BY host
), moments AS (
  SELECT sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) AS squares, count(*) / sum(n) AS each
  FROM hosts
), prior AS (
  SELECT m, least(greatest(
    m * (1 - m) / greatest(squares - m * m - m * (1 - m) * each, 1e-12) - 1, 1), 10000) AS strength
  FROM moments
), verdicts AS (
  SELECT host, n, strength, (k + m * strength) / (n + strength) AS rate,
    least(greatest(2 * m, 0.25), 0.8) AS most
  FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate - 3 * sqrt(rate * (1 - rate) / (n + strength + 1)) <= most AS kept,
  judged.host
FROM judged LEFT JOIN verdicts ON judged.host IS NOT DISTINCT FROM verdicts.host
"""

TOP_K = r"""
WITH whole AS (
  SELECT vec_id, min([floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE_SQL = {
    "op5_chat_formatting": chat.ORACLE,
    "op6_ngram_join": NGRAM_JOIN,
    "op6_ngram_links": NGRAM_LINKS,
    "op7_quality_rules": QUALITY_RULES,
    "op9_voronoi_top_k": TOP_K,
    "op11_lexical_search": lexical.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
