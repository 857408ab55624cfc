"""DuckDB SQL for the queries that SQL can express.

Line dedup, the classifiers, packing, whitening and the pipeline are tested against plain Python, a round
trip or held-out labels. DuckDB has no crc32: it is made from a table of 256 codes that a query computes.
"""

from __future__ import annotations

from .quality import STOP_WORDS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FIXITY = """
SELECT page_id, 'missing' AS state, CAST(1 AS BIGINT) AS n FROM pages
WHERE page_id % 1009 = 7 AND page_id % 1013 <> 11
UNION ALL
SELECT page_id, 'changed', 1 FROM pages
WHERE page_id % 1009 <> 7 AND page_id % 997 = 5 AND page_id % 1013 <> 11
UNION ALL
SELECT page_id, 'changed', 1 FROM pages WHERE page_id % 1009 = 7 AND page_id % 1013 = 11
UNION ALL
SELECT page_id, 'missing', 1 FROM pages
WHERE page_id % 1009 <> 7 AND page_id % 997 = 5 AND page_id % 1013 = 11
UNION ALL
SELECT page_id, 'extra', 1 FROM pages
WHERE page_id % 1009 <> 7 AND page_id % 1013 = 11
UNION ALL
SELECT page_id, 'extra', 1 FROM pages
WHERE page_id % 1009 <> 7 AND page_id % 997 = 5 AND page_id % 1013 = 11
"""

_STOP = ", ".join(f"'{w}'" for w in (*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS]))

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS q FROM g WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: x IN ({_STOP}))) AS BIGINT) AS n_stop_words
  FROM d LEFT JOIN r USING (doc_id)),
n AS (
  SELECT doc_id, n_words, word_chars, n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, n_repeat_words,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CAST(len(l) AS BIGINT) AS n_lines, n_stop_words FROM m),
f AS (
  SELECT *, concat_ws(',',
    CASE WHEN word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 12
         THEN 'word_length' END,
    CASE WHEN n_symbols / greatest(n_words, 1) > 0.1 THEN 'symbols' END,
    CASE WHEN n_stop_words / greatest(n_words, 1) < 0.02 THEN 'stop_words' END,
    CASE WHEN n_dup_lines / greatest(n_lines, 1) > 0.3 THEN 'repeated_lines' END) AS failed_rules
  FROM n)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, n_lines, n_stop_words, failed_rules FROM f
"""

_ALPHABETIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_ALPHABETIC}') AS w
  FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_ALPHABETIC}') AS w
  FROM benchmark),
b AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
phrases AS (
  SELECT DISTINCT item, least(len(w), 13) AS size,
         array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS phrase FROM b),
sizes AS (SELECT DISTINCT size FROM phrases),
x AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, sizes WHERE len(w) >= size),
hits AS (
  SELECT doc_id, i, size, item FROM (
    SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS phrase FROM x)
  JOIN phrases USING (size, phrase)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + size)) AS q FROM hits) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items,
             array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""

_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC_CODES = f"""bits AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: {_CRC_STEP}) AS v FROM range(256) AS t(i)),
crc AS (SELECT list(v ORDER BY i) AS codes FROM bits)"""

SPELLING = rf"""
WITH RECURSIVE {_CRC_CODES},
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\x{{00C0}}-\x{{00FF}}]{{6,}}')) AS run
    FROM documents) GROUP BY 1, 2),
b AS (
  SELECT run, c, length(run) AS l, flatten(list_transform(range(1, length(head || run) + 1), lambda i:
    CASE WHEN unicode(substr(head || run, i, 1)) < 128 THEN [unicode(substr(head || run, i, 1))::BIGINT]
         ELSE [195::BIGINT, (unicode(substr(head || run, i, 1)) - 64)::BIGINT] END)) AS bytes FROM r),
h AS (
  SELECT run, c, l, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda a, x: xor(a >> 8, codes[1 + (xor(a, x) & 255)])), 4294967295::BIGINT) AS h FROM b, crc),
s AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % l)::BIGINT) || substr(run, (h % l)::BIGINT + 2)
              ELSE run END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, b.word AS near FROM d AS a JOIN d AS b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM d WHERE rest IN (SELECT word FROM v)
  UNION SELECT rest, word FROM d WHERE rest IN (SELECT word FROM v)),
q AS (SELECT p.word, near, m.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
             row_number() OVER (PARTITION BY p.word ORDER BY m.n DESC, near) AS k
      FROM p JOIN v AS m ON m.word = near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
             CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
      FROM v LEFT JOIN q ON q.word = v.word AND k = 1),
t AS (SELECT word, word AS root FROM f UNION
      SELECT t.word, f.form FROM t JOIN f ON f.word = t.root WHERE form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, t.root
FROM f JOIN t USING (word) JOIN f AS last ON last.word = t.root AND last.form IS NULL
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT * FROM e WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                         AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok AS a JOIN ok AS b
      ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS root FROM e UNION SELECT l.b, root FROM r JOIN l USING (a)),
m AS (SELECT a, min(root) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN m ON m.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

SHARDING = f"""
WITH {_CRC_CODES},
d AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, list_transform(
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents),
c AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda a, x: xor(a >> 8, codes[1 + (xor(a, x) & 255)])), 4294967295::BIGINT) AS text_crc32 FROM d, crc),
b AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
         sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST(least(39, ((2 * earlier + size) * 40) // greatest(1, 2 * total)) AS INTEGER) AS shard FROM b)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(name) for name in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, its place in the order of kinds, its pattern, the group with the value, the value's least length.
_SECRETS = (("assign", 0, _ASSIGN, 2, 12), ("access", 1, "AKIA[A-Z0-9]+", 0, 18), ("hex", 2, "[0-9a-f]+", 0, 16),
            ("opaque", 3, "[A-Za-z0-9+/_-]+", 0, 20))


def _matches(kind: str, nth: int, pattern: str, group: int, least: int) -> str:
    """Matches with their places: the lengths of what lies between them and of those before, added up."""
    return f"""
  SELECT row, owner, '{kind}' AS kind, {nth} AS nth, list_sum(list_transform(gaps[:i], lambda x: length(x)))::BIGINT
         + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0)::BIGINT AS start,
         found[i] AS span, regexp_extract(found[i], '{pattern}', {group}) AS value
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
          SELECT *, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS gaps FROM d
          WHERE regexp_matches(t, '{pattern}')))
  WHERE length(regexp_extract(found[i], '{pattern}', {group})) >= {least}"""


SECRETS = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         split_part(coalesce(source, ''), '/', 1) AS owner FROM documents),
m AS ({" UNION ALL ".join(_matches(*kind) for kind in _SECRETS)}),
s AS (SELECT *, start + length(span) AS stop FROM m),
c AS (
  SELECT * FROM s WHERE kind <> 'opaque' UNION ALL
  SELECT * FROM s AS o WHERE kind = 'opaque' AND list_entropy(string_split(value, '')) >= 3.5
    AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM s AS b WHERE b.row = o.row AND b.kind <> 'opaque'
                    AND o.start < b.stop AND b.start < o.stop)),
n AS (SELECT value, count(DISTINCT owner) < 3 AS live FROM c GROUP BY value),
j AS (SELECT row, kind, nth, start, kind || ':' || start || ':' || stop AS piece, live
      FROM c JOIN n USING (value) WHERE kind <> 'opaque' OR live),
g AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(piece, ',' ORDER BY start, nth) AS spans,
         string_agg(piece, ',' ORDER BY start, nth) FILTER (kind <> 'opaque') AS base,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
         count(*) FILTER (kind = 'opaque') AS n_opaque FROM j GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_opaque, 0) AS n_opaque, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (row)
"""

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
d AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(list_transform(
    CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 4, 1) + 1) END,
    lambda i: array_to_string(w[i : i + 4], ' ')))) AS shingles FROM w),
sets AS MATERIALIZED (
  SELECT min(doc_id) AS id, shingles, len(shingles) AS size FROM d WHERE len(shingles) > 0 GROUP BY shingles),
e AS MATERIALIZED (SELECT id, size, unnest(shingles) AS shingle FROM sets),
l AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM e AS a JOIN e AS b ON a.shingle = b.shingle AND a.id < b.id
  GROUP BY a.id, b.id, a.size, b.size HAVING 100 * count(*) >= 75 * (a.size + b.size - count(*))),
both_ways AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT id, id AS root FROM sets UNION SELECT b, root FROM r JOIN both_ways ON a = id),
m AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT doc_id, len(d.shingles)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN sets ON d.shingles = sets.shingles LEFT JOIN m USING (id)
"""

ORACLE: dict[str, str] = {
    "op1_merkle_fixity": FIXITY,
    "op2_sharding": SHARDING,
    "op4_quality_rules": QUALITY,
    "op8_secret_scan": SECRETS,
    "op9_ngram_jaccard_join": JACCARD,
    "op10_benchmark_decontamination": DECONTAMINATION,
    "op11_spelling_variants": SPELLING,
    "op12_embedding_dedup": EMBEDDING_DEDUP,
}
