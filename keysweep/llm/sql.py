"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

# Plain SQL over whole tables; it shares no code with the operators.
_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, {_WORDS} AS ws FROM d),
u AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT r, i, word || ' ' || lead(word) OVER x || ' ' || lead(word, 2) OVER x AS win
      FROM u WINDOW x AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g WHERE win IS NOT NULL) WHERE c > 1),
cov AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS p FROM rep, (VALUES (0), (1), (2)) v(k)) GROUP BY r),
m AS (
  SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w.ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len([x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')]) AS BIGINT) AS n_lines,
         CAST(len([x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')])
              - len(list_distinct([x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')])) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(regexp_extract_all(t, '\p{{Lu}}')) AS BIGINT) AS n_upper
  FROM d JOIN w USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
      + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
      + (CASE WHEN 2 * n_upper > word_chars THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept,
       fail_bits, n_lines, n_upper
FROM b
"""

_SECRET_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    ("hex", r"[0-9a-f]+", 0, 16, True),
    ("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1, False),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, False),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1, False),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, False),
)


def _kind_sql(position: int, kind: str, pattern: str, group: int, least: int) -> str:
    return rf"""
SELECT r, {position} AS k, '{kind}' AS kind, s, s + length(hit) AS e FROM (
  SELECT r, hit, part, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) - length(hit) AS s FROM (
    SELECT r, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(parts) AS part, unnest(gaps[1:len(hits)]) AS gap FROM (
      SELECT r, regexp_extract_all(t, '{pattern}') AS hits, regexp_extract_all(t, '{pattern}', {group}) AS parts,
             string_split_regex(t, '{pattern}') AS gaps FROM d)))
WHERE length(part) >= {least}"""


SECRETS_SQL = ("WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), spans AS ("
               + " UNION ALL ".join(_kind_sql(i, *k[:4]) for i, k in enumerate(_SECRET_KINDS)) + r""")
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k), '') AS spans
FROM d LEFT JOIN spans USING (r) GROUP BY d.r, d.doc_id
""")

LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS site FROM documents),
l AS (SELECT r, site, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (SELECT r, site, string_split(t, chr(10)) AS ls FROM d)),
x AS (SELECT *, CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]')
                     THEN regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') END AS key,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
wide AS (SELECT key FROM x WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT site) >= 8),
y AS (SELECT x.*, x.key IS NOT NULL AND x.key IN (SELECT key FROM wide) AS is_wide FROM x),
host AS (SELECT r FROM y GROUP BY r HAVING 2 * coalesce(sum(length(key)) FILTER (is_wide), 0) <= coalesce(sum(length(key)), 0)),
furniture AS (SELECT key FROM y JOIN host USING (r) WHERE is_wide GROUP BY key HAVING count(DISTINCT site) >= 8),
z AS (SELECT *, is_wide AND key IN (SELECT key FROM furniture) AS cut FROM y),
c AS (SELECT r, count(*) AS n_lines, count(*) FILTER (is_wide) AS n_wide, count(*) FILTER (cut) AS n_cut,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '') AS rest FROM z GROUP BY r)
SELECT d.doc_id, c.n_lines, c.n_wide AS n_wide_lines, c.n_cut AS n_cut_lines, sha256(rest) AS text_sha256
FROM d JOIN c USING (r)
"""

NGRAM_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, {_WORDS} AS ws FROM d),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_distinct([array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)])
                                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
root AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
deg AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT n.doc_id, n.n AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM n JOIN root ON root.x = n.doc_id LEFT JOIN deg ON deg.x = n.doc_id
"""

_PLAIN_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS_SQL = rf"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_PLAIN_WORDS} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, least(len(ws), 10) AS l, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
        FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN_WORDS} AS ws FROM documents),
cut AS (SELECT r, i, l, array_to_string(ws[i:i + l - 1], ' ') AS g
        FROM (SELECT r, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM win) WHERE len(ws) >= l)),
hit AS (SELECT r, i, cut.l, item FROM cut JOIN win ON win.g = cut.g AND win.l = cut.l),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT r, i, l FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
             CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                  WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
              ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""


def _codes_sql(rounds: int = 4) -> str:
    """The rounds of assigning and moving, one after the other."""
    steps = ["""
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM (
  SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM kept, range(4) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 256)"""]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (SELECT r, p, min(256 * CAST(list_sum([(x[i] - c[i]) * (x[i] - c[i]) for i in range(1, len(x) + 1)]) AS BIGINT) + e) AS m
  FROM parts JOIN book{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""
sums{k} AS (SELECT p, e, i, CAST(sum(y) AS BIGINT) AS s, count(*) AS n FROM (
  SELECT parts.p, m % 256 AS e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM parts JOIN near{k} USING (r, p)) GROUP BY p, e, i),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(moved, c) AS c FROM book{k} b LEFT JOIN (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM sums{k} GROUP BY p, e) USING (p, e))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(printf('%02x', m % 256), '' ORDER BY p) AS code, CAST(sum(m // 256) AS BIGINT) AS error
                FROM near{rounds} GROUP BY r) USING (r)
"""


CODES_SQL = _codes_sql()
