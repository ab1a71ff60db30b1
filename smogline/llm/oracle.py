"""The queries of this subpackage as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from smogline.llm.licenses import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NAMED = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

_WORDS = r"""CASE WHEN trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) = '' THEN []
  ELSE string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') END"""
_BIGRAMS = """list_distinct(CASE WHEN len(words) = 1 THEN words
  ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END)"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS p, words FROM w WHERE len(words) >= 20),
keyed AS MATERIALIZED (SELECT doc_id, p, sha256(array_to_string(words[p:p + 19], ' ')) AS k FROM win),
repeats AS (SELECT doc_id, p FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, p + step AS place FROM repeats, range(20) t(step)),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)
    """,
    "op5_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS words FROM benchmark),
item AS (SELECT DISTINCT item_id, least(len(words), 10) AS n,
                unnest(list_transform(range(1, len(words) - least(len(words), 10) + 2),
                                      lambda i: array_to_string(words[i:i + least(len(words), 10) - 1], ' '))) AS k
         FROM b WHERE len(words) > 0),
lengths AS (SELECT DISTINCT n FROM item),
win AS (SELECT doc_id, n, unnest(range(1, len(words) - n + 2)) AS p, words FROM d, lengths WHERE len(words) >= n),
hit AS MATERIALIZED (
  SELECT doc_id, p, n, k FROM (SELECT doc_id, p, n, array_to_string(words[p:p + n - 1], ' ') AS k FROM win)
  SEMI JOIN item USING (n, k)),
places AS (SELECT doc_id, count(DISTINCT p + step) AS n_hit FROM hit, range(10) t(step) WHERE step < n GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit JOIN item USING (n, k)) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_licenses": rf"""
WITH part AS (SELECT doc_id, unnest(list_distinct(list_concat(string_split(coalesce(text, ''), chr(10)),
                regexp_split_to_array(coalesce(text, ''), '\n[ \t\r]*\n')))) AS part FROM documents),
w AS (SELECT doc_id, part, {_WORDS.format("part", "part")} AS words FROM part),
a AS (SELECT doc_id, part, {_BIGRAMS} AS b FROM w WHERE len(words) > 0),
t AS (SELECT name, {_BIGRAMS} AS b FROM (
        SELECT name, {_WORDS.format("text", "text")} AS words FROM (VALUES {_NAMED}) v(name, text))),
tw AS (SELECT name, words, len(words) AS n, {_BIGRAMS} AS b FROM (
        SELECT name, {_WORDS.format("text", "text")} AS words FROM (VALUES {_NAMED}) v(name, text))),
dw AS (SELECT doc_id, {_WORDS.format("text", "text")} AS words FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
pos AS (SELECT doc_id, len(words) AS w, unnest(range(1, len(words))) AS i, words FROM dw),
shared AS MATERIALIZED (
  SELECT doc_id, name, n, len(b) AS m, w, i FROM (SELECT doc_id, w, i, words[i] || ' ' || words[i + 1] AS g FROM pos)
  JOIN (SELECT name, n, b, unnest(b) AS g FROM tw WHERE n > 1) USING (g)),
place AS (SELECT DISTINCT doc_id, name, n, m,
            unnest(range(least(greatest(1, i - n + 2), greatest(1, w - n + 1)), greatest(1, least(i, w - n + 1)) + 1)) AS s FROM shared),
-- a window that is similar enough holds two thirds of the bigrams, so at least so many places that do
likely AS (SELECT place.doc_id, place.name, place.s FROM place JOIN shared
           ON shared.doc_id = place.doc_id AND shared.name = place.name AND shared.i BETWEEN place.s AND place.s + place.n - 2
           GROUP BY ALL HAVING count(*) >= max(place.m) * 0.66),
win AS (SELECT doc_id, name, tw.b AS tb, dw.words[s:s + n - 1] AS words FROM likely JOIN dw USING (doc_id) JOIN tw USING (name)),
pair AS (
  SELECT doc_id, name, 2 * len(list_intersect(a.b, t.b)) / (len(a.b) + len(t.b)) AS similarity FROM a, t
  UNION ALL
  SELECT doc_id, name, 2 * len(list_intersect(b, tb)) / (len(b) + len(tb)) FROM (SELECT doc_id, name, tb, {_BIGRAMS} AS b FROM win)),
found AS (SELECT doc_id, name, max(similarity) AS s FROM pair WHERE similarity >= 0.8 GROUP BY ALL),
best AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses,
                first(name ORDER BY s DESC, name) AS best, max(s) AS similarity FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, best, coalesce(similarity, 0) AS similarity
FROM documents LEFT JOIN best USING (doc_id)""",
    "op8_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w WHERE len(words) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_
                    FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * both_ >= 75 * (na.n + nb.n - both_)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
score AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, s AS positive_score FROM score WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id,
       positive_score, s AS negative_score
FROM positive JOIN score USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * s AND 100 * s <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other)
QUALIFY row_number() OVER best <= 3""",
}
