"""DuckDB SQL of the queries that SQL can express, by brute force over whole tables."""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format(text='text')} AS w FROM documents),
starts AS (SELECT r, doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM docs WHERE len(w) >= 50),
windows AS (SELECT r, doc_id, p, array_to_string(w[p:p + 49], ' ') AS x FROM starts),
firsts AS (SELECT x, min(doc_id) AS first FROM windows GROUP BY x),
repeated AS (SELECT r, p FROM windows JOIN firsts USING (x) WHERE first < doc_id OR doc_id IS NULL AND first IS NOT NULL),
places AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM docs),
marked AS (
  SELECT places.r, places.p, word, count(repeated.p) OVER (
           PARTITION BY places.r ORDER BY places.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM places LEFT JOIN repeated ON places.r = repeated.r AND places.p = repeated.p),
kept AS (SELECT r, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS t
         FROM marked GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

KD_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 20
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format(text=LOWER)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                 END AS s
  FROM docs),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM rows a JOIN rows b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, a AS other FROM sides
            UNION SELECT reached.doc_id, sides.b FROM reached JOIN sides ON reached.other = sides.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN least USING (doc_id)
"""

TERMS = (r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark),
t AS (SELECT r, doc_id, unnest({TERMS.format(text="coalesce(text, '')")}) AS term FROM d),
sizes AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, total GROUP BY term),
m AS (SELECT r, doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM sizes, total),
asked AS (SELECT q, item_id, term, count(*) AS c
          FROM (SELECT q, item_id, unnest({TERMS.format(text="coalesce(text, '')")}) AS term FROM i) GROUP BY ALL),
scores AS (
  SELECT q, item_id, doc_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 20
"""

SQL: dict[str, str] = {
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op9_kd_top_k": KD_TOP_K,
    "op10_jaccard_join": JACCARD_JOIN,
    "op12_lexical_search": LEXICAL_SEARCH,
}
