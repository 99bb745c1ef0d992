"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from quill.llm.quality import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM d WHERE len(words) > 8),
named AS (SELECT doc_id, i, list_slice(words, i, i + 7) AS g FROM win),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM named),
gaps AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM twice WHERE c > 1),
rep AS (SELECT doc_id, sum(least(8, i - coalesce(p, i - 8))) AS n FROM gaps GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({', '.join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop,
    coalesce(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])), 0) AS n_same
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 100 * n_symbols > 10 * n_words
       OR 100 * n_stop < 2 * n_words OR 100 * n_dup_lines > 40 * n_lines OR 100 * n_same > 30 * n_words) AS kept
FROM b
"""

OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION SELECT b.y, reach.r FROM reach JOIN both_ways b ON b.x = reach.doc_id),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)
"""

OP3 = """
WITH d AS (  -- bytes as hex digits, so that any cut of them is text
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
named AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
again AS (SELECT doc_id, i FROM named QUALIFY count(*) OVER (PARTITION BY k) > 1),
gaps AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 AS joins FROM again),
runs AS (
  SELECT doc_id, i, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM gaps),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM runs GROUP BY doc_id, g),
pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM spans
  UNION ALL SELECT doc_id, max(b), any_value(n) FROM spans JOIN d USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS k
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
named AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)),
firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM named),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM firsts, range(0, 13) AS r(k) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

# crc32 bit by bit over the digits of the id: -1 stands for one shift of the register
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END),
  4294967295::BIGINT)"""

OP12 = rf"""
WITH given AS (SELECT doc_id, {_WORDS} AS w, {_CRC} AS h FROM documents),
-- lists count from 1, so a and p are as in the contract and word i stands at i + 1
place AS (
  SELECT doc_id, w, h, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM given),
d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1]
           ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END) ELSE w END AS w FROM place),
words AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
same AS (  -- words q apart that are identical
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
named AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS length FROM named GROUP BY doc_id, q, island),
runs AS (  -- the same stretch at several periods: the smallest
  SELECT doc_id, s, length, min(q) AS q FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, s, length),
total AS (
  SELECT doc_id, count(*) AS n_runs, max(struct_pack(l := length, s := -s, q := -q)) AS best,
    sha256(string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q)) AS runs FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS k FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, -best.s AS start, best.l AS length, -best.q AS period,
  1000 * best.l // -best.q AS exponent_milli, coalesce(runs, sha256('')) AS runs_sha256,
  coalesce(k, sha256('')) AS collapsed_sha256
FROM d LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE = {
    "op2_near_duplicates": OP2,
    "op3_suffix_dedup": OP3,
    "op7_quality_rules": OP7,
    "op9_substring_dedup": OP9,
    "op12_periodic_runs": OP12,
}
