"""DuckDB SQL for the corpus operators that SQL can express, written apart from the Spark code."""

from __future__ import annotations

WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
STRIP = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP1 = rf"""
WITH RECURSIVE rules(rule, h, p, v) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
u AS (
  SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
x AS (
  SELECT page_id, coalesce({_lower("regexp_extract(rest, '^([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce({_lower("regexp_extract(rest, '^([^/?#]*)', 1)")}, '')
           || coalesce(regexp_extract(rest, '^[^/?#]*([^#]*)', 1), '') AS node,
         regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'i'),
                        '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'i') AS link
  FROM u),
edges AS (
  SELECT node AS a, {_lower("regexp_extract(link, '://([^/?#]*)', 1)")}
         || regexp_extract(link, '://[^/?#]*([^#]*)', 1) AS b
  FROM x WHERE host <> '' AND strpos(link, '://') > 0),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
nodes AS (SELECT DISTINCT a AS node FROM both_ways),
places AS (
  SELECT DISTINCT host, path FROM x UNION
  SELECT regexp_extract(node, '^([^/?#]*)', 1), regexp_extract(node, '^[^/?#]*([^?#]*)', 1) FROM nodes),
ruled AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM places JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path),
reach(node, v) AS (
  SELECT node, v FROM nodes JOIN ruled ON host = regexp_extract(node, '^([^/?#]*)', 1)
                                      AND path = regexp_extract(node, '^[^/?#]*([^?#]*)', 1)
  UNION SELECT b, v FROM reach JOIN both_ways ON node = a),
spread AS (SELECT node, min(v) AS v FROM reach GROUP BY node)
SELECT page_id, host, path, rule, coalesce(ruled.v, spread.v, 'allow') AS verdict
FROM x LEFT JOIN ruled USING (host, path) LEFT JOIN spread USING (node)
"""

OP4 = rf"""
WITH l AS (
  SELECT doc_id, i, line, {_lower(f"regexp_replace(line, '{STRIP}', '', 'g')")} AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
f AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM l LEFT JOIN f USING (key) GROUP BY doc_id
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
l AS (
  SELECT doc_id, source, t, regexp_replace({_lower(f"regexp_replace(line, '{STRIP}', '', 'g')")}, '{WS}+', ' ', 'g') AS key
  FROM (SELECT doc_id, source, t, unnest(lines) AS line FROM d)),
f AS (
  SELECT source, key, min(doc_id) AS home FROM l WHERE key <> ''
  GROUP BY source, key HAVING count(DISTINCT t) >= 50),
gone AS (
  SELECT doc_id, sum(len(string_split(l.key, ' '))) AS n
  FROM l JOIN f ON l.key = f.key AND l.source IS NOT DISTINCT FROM f.source WHERE doc_id <> home GROUP BY doc_id),
c AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(t) - len(regexp_extract_all(t, '{WS}')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '{WORD}')))
              - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '{WORD}')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, coalesce(gone.n, 0) AS removed
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND NOT (removed > 0 AND n_words - removed < 0.3 * n_words) AS kept
FROM c
"""

OP8 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
  FROM documents),
c AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS cls FROM d),
s0 AS (SELECT source, sum(size) AS source_size FROM c GROUP BY source),
s1 AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w,
         3 * source_size AS cap, sum(source_size) OVER () AS total FROM s0),
s2 AS (SELECT *, CAST(cap AS DOUBLE) / w AS ratio FROM s1),
s3 AS (
  SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY ratio, cap, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / sum(w) OVER (ORDER BY ratio, cap, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS trial FROM s2),
s4 AS (SELECT *, first_value(trial) OVER (ORDER BY CASE WHEN trial <= ratio THEN 0 ELSE 1 END, ratio, trial) AS lv,
              bool_or(trial <= ratio) OVER () AS found FROM s3),
s AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
             least(CAST(cap AS DOUBLE), CASE WHEN found THEN lv * w ELSE cap END) AS target FROM s4),
k0 AS (
  SELECT c.source, cls, sum(size) AS cs, any_value(source_size) AS source_size, any_value(target) AS target
  FROM c JOIN s ON c.source IS NOT DISTINCT FROM s.source GROUP BY c.source, cls),
k1 AS (SELECT *, CAST(3 * cs AS BIGINT) AS cap, CAST(cls * cs AS BIGINT) AS w FROM k0),
k2 AS (SELECT *, CASE WHEN w > 0 THEN CAST(cap AS DOUBLE) / w ELSE 0 END AS ratio FROM k1),
k3 AS (
  SELECT *, CASE WHEN w > 0 THEN (target - coalesce(sum(cap) OVER (PARTITION BY source ORDER BY ratio, cap, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (PARTITION BY source ORDER BY ratio, cap, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS trial FROM k2),
k4 AS (SELECT source, min(ratio) AS r FROM k3 WHERE trial <= ratio GROUP BY source),
k5 AS (SELECT k3.source, min(trial) AS lv FROM k3 JOIN k4 ON k3.source IS NOT DISTINCT FROM k4.source
       WHERE ratio = r AND trial <= ratio GROUP BY k3.source),
k6 AS (
  SELECT k3.source, cls, cs, source_size, target,
         CASE WHEN cs > 0 THEN least(3.0::DOUBLE, coalesce(lv * cls, 3.0::DOUBLE)) ELSE 0 END AS copies
  FROM k3 LEFT JOIN k5 ON k3.source IS NOT DISTINCT FROM k5.source),
k AS (
  SELECT *, CAST(floor(copies) AS INT) AS certain, copies - floor(copies) AS p,
         target - sum(CAST(floor(copies) AS INT) * cs) OVER (PARTITION BY source) AS need FROM k6),
r AS (
  SELECT c.doc_id, c.source, c.size, k.source_size, k.target, k.certain, k.p, k.need,
         (CAST(('0x' || substr(md5('7|' || coalesce(CAST(c.doc_id AS VARCHAR), '') || '|' || c.t), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM c JOIN k ON c.source IS NOT DISTINCT FROM k.source AND c.cls = k.cls),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM r),
t AS (
  SELECT *, sum(size) FILTER (p > 0) OVER (PARTITION BY source ORDER BY CASE WHEN p > 0 THEN 0 ELSE 1 END, q, doc_id, size
                                           ROWS UNBOUNDED PRECEDING) AS upto FROM q)
SELECT doc_id, size, source_size, target,
       CAST(size * (certain + CASE WHEN p > 0 AND abs(upto - need) <= abs(upto - size - need) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM t
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, [{_lower('x')} FOR x IN regexp_extract_all(coalesce(text, ''), '{WORD}')] AS w FROM documents),
x AS (
  SELECT doc_id, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
size AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
u AS (SELECT w, count(*) AS c FROM x GROUP BY w),
ud AS (SELECT doc_id, w, count(*) AS c FROM x GROUP BY doc_id, w),
b AS (SELECT v, w, count(*) AS c FROM x WHERE v IS NOT NULL GROUP BY v, w),
bd AS (SELECT doc_id, v, w, count(*) AS c FROM x WHERE v IS NOT NULL GROUP BY doc_id, v, w),
s AS (
  SELECT bd.doc_id, bd.c AS times, bd.w, b.c - bd.c AS joint, u.c - ud.c AS ctx
  FROM bd JOIN b USING (v, w) JOIN ud ON ud.doc_id = bd.doc_id AND ud.w = bd.v JOIN u ON u.w = bd.v
  UNION ALL SELECT doc_id, 1, w, NULL, NULL FROM x WHERE v IS NULL),
p AS (
  SELECT s.*, u.c - ud.c AS alone, (SELECT count(*) FROM x) - n AS rest
  FROM s JOIN ud ON ud.doc_id = s.doc_id AND ud.w = s.w JOIN u ON u.w = s.w JOIN size ON size.doc_id = s.doc_id),
t AS (
  SELECT doc_id, sum(times * log10(CASE WHEN joint > 0 THEN joint / ctx ELSE
    CASE WHEN joint IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END
      * CASE WHEN alone > 0 THEN alone / rest ELSE 1.0::DOUBLE / (rest + 1) END END)) AS score
  FROM p GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(score, 0), 6) AS log10_score,
       round(CASE WHEN len(w) > 0 THEN score / len(w) END, 6) AS mean_log10
FROM d LEFT JOIN t USING (doc_id)
"""

OP5_TRIGRAM = rf"""
WITH d AS (
  SELECT doc_id, [{_lower('x')} FOR x IN regexp_extract_all(coalesce(text, ''), '{WORD}')] AS w FROM documents),
x AS (
  SELECT doc_id, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS v, CASE WHEN i > 2 THEN w[i - 2] END AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
total AS (SELECT count(*) AS n FROM x),
size AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
ud AS (SELECT doc_id, w, count(*) AS c FROM x GROUP BY doc_id, w),
u AS (SELECT w, sum(c) AS c FROM ud GROUP BY w),
bd AS (SELECT doc_id, v, w, count(*) AS c FROM x WHERE v IS NOT NULL GROUP BY doc_id, v, w),
b AS (SELECT v, w, sum(c) AS c FROM bd GROUP BY v, w),
td AS (SELECT doc_id, t, v, w, count(*) AS c FROM x WHERE t IS NOT NULL GROUP BY doc_id, t, v, w),
t3 AS (SELECT t, v, w, sum(c) AS c FROM td GROUP BY t, v, w),
uo AS (SELECT doc_id, w, CAST(u.c - ud.c AS BIGINT) AS c FROM ud JOIN u USING (w)),
bo AS (SELECT doc_id, v, w, CAST(b.c - bd.c AS BIGINT) AS c FROM bd JOIN b USING (v, w)),
tri AS (SELECT doc_id, t, v, w, CAST(t3.c - td.c AS BIGINT) AS c FROM td JOIN t3 USING (t, v, w)),
p AS (
  SELECT x.doc_id, x.v, x.t, uo.c AS c1, vo.c AS c1v, bo.c AS c2, tv.c AS c2v, tri.c AS c3, total.n - size.n AS rest
  FROM x CROSS JOIN total JOIN size ON size.doc_id = x.doc_id
  JOIN uo ON uo.doc_id = x.doc_id AND uo.w = x.w
  LEFT JOIN uo AS vo ON vo.doc_id = x.doc_id AND vo.w = x.v
  LEFT JOIN bo ON bo.doc_id = x.doc_id AND bo.v = x.v AND bo.w = x.w
  LEFT JOIN bo AS tv ON tv.doc_id = x.doc_id AND tv.v = x.t AND tv.w = x.v
  LEFT JOIN tri ON tri.doc_id = x.doc_id AND tri.t = x.t AND tri.v = x.v AND tri.w = x.w),
s1 AS (SELECT *, CASE WHEN c1 > 0 THEN c1 / rest ELSE 1.0::DOUBLE / (rest + 1) END AS one FROM p),
s2 AS (SELECT *, CASE WHEN v IS NULL THEN one WHEN c2 > 0 THEN c2 / c1v ELSE 0.4::DOUBLE * one END AS two FROM s1),
s3 AS (SELECT *, CASE WHEN t IS NULL THEN two WHEN c3 > 0 THEN c3 / c2v ELSE 0.4::DOUBLE * two END AS three FROM s2),
s AS (SELECT doc_id, sum(log10(three)) AS score FROM s3 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(score, 0), 6) AS log10_score,
       round(CASE WHEN len(w) > 0 THEN score / len(w) END, 6) AS mean_log10
FROM d LEFT JOIN s USING (doc_id)
"""

OP10 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
late AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM late),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM w),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(0, 8), lambda i:
           array_to_string(list_transform(range(0, 4), lambda j:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((CAST('0x' || substr(sha1(h), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * j AS BIGINT)) & 31), 1)),
             '')), '') AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM m
"""


def _crc32(x: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit (DuckDB has no such function)."""
    bit = f"(ascii(substr({x}, CAST(i // 8 AS BIGINT) + 1, 1)) >> CAST(i % 8 AS INT)) & 1"
    step = "xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)"
    return (f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(8 * length({x})),"
            f" lambda i: CAST({bit} AS BIGINT))), lambda c, b: {step}))")


OP11 = rf"""
WITH t AS (
  SELECT conv_id AS c, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r FROM conversations),
own AS (SELECT c, list(x ORDER BY r) AS q, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM t GROUP BY c),
whole AS (
  SELECT own.c, list_concat(coalesce(d.q[1:own.h], []), own.q[own.h + 1:]) AS q
  FROM own LEFT JOIN own d ON d.c = own.c - own.c % 5),
node AS (
  SELECT q[1:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(q) = d), '')) AS ends_sha256
  FROM (SELECT c, q, unnest(range(0, len(q) + 1)) AS d FROM whole) GROUP BY ALL),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
one AS (
  SELECT node.p, d, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(node.p[d].text) END AS saved
  FROM node LEFT JOIN kids ON node.p = kids.p),
up AS (
  SELECT p[1:k] AS p, sum(leaf) AS n_leaves, sum(saved) AS saved
  FROM (SELECT p, leaf, saved, unnest(range(0, d + 1)) AS k FROM one) GROUP BY ALL)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n_convs,
       coalesce(kids.n, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens,
       node.ends_sha256
FROM node JOIN up ON up.p = node.p LEFT JOIN kids ON kids.p = node.p
LEFT JOIN node parent ON node.d > 0 AND parent.p = node.p[1:node.d - 1]
"""

# States: 0 nothing, 1 after s, 2 after u, 3 after a; a value is the cost in six digits and then the audit.
OP13 = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS how
  FROM conversations),
hurt AS (
  SELECT c, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM raw WHERE how <> 0),
rows AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) || left(role, 1) AS two,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid FROM hurt),
f AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM rows),
moves(frm, role, dest) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
ins(frm, dest, n) AS (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (3, 2, 1), (2, 3, 1),
                             (0, 3, 2), (1, 3, 2), (2, 2, 2), (3, 3, 2)),
edit AS (
  SELECT c, i, s.st AS frm, s.st AS dest, 4 AS cost, 'D' AS op FROM f, (VALUES (0), (1), (2), (3)) s(st)
  UNION ALL
  SELECT c, i, frm, dest, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'K'
  FROM f JOIN moves ON left(f.role, 1) = moves.role WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT c, i, frm, dest, 3 + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'R'
  FROM f, moves WHERE moves.role <> 's' AND fault NOT IN ('blank', 'duplicate')),
step AS (
  SELECT c, i, ins.frm, edit.dest, min(lpad(CAST(3 * n + cost AS VARCHAR), 6, '0') || repeat('I', n) || op) AS v
  FROM edit JOIN ins ON ins.dest = edit.frm GROUP BY ALL),
walk(c, i, st, v) AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT), 0, '000000' FROM f
  UNION ALL
  SELECT walk.c, step.i, step.dest,
         min(lpad(CAST(CAST(left(walk.v, 6) AS INT) + CAST(left(step.v, 6) AS INT) AS VARCHAR), 6, '0')
             || substr(walk.v, 7) || substr(step.v, 7))
  FROM walk JOIN step ON step.c IS NOT DISTINCT FROM walk.c AND step.i = walk.i + 1 AND step.frm = walk.st
  GROUP BY walk.c, step.i, step.dest),
size AS (SELECT c, max(i) AS n FROM f GROUP BY c),
best AS (
  SELECT walk.c, min(lpad(CAST(CAST(left(v, 6) AS INT) + 3 * ins.n AS VARCHAR), 6, '0') || substr(v, 7) || repeat('I', ins.n)) AS v
  FROM walk JOIN size ON size.c IS NOT DISTINCT FROM walk.c AND walk.i = size.n JOIN ins ON ins.frm = walk.st
  WHERE ins.dest IN (0, 3) GROUP BY walk.c),
audits AS (
  SELECT c, CAST(left(v, 6) AS BIGINT) AS cost, substr(v, 7) AS audit,
         length(replace(substr(v, 7), 'D', '')) % 2 AS with_system FROM best),
ops AS (SELECT c, with_system, audit, unnest(range(1, length(audit) + 1)) AS k, substr(audit, k, 1) AS op FROM audits),
placed AS (
  SELECT c, with_system, k, op, length(replace(left(audit, k), 'I', '')) AS i,
         length(replace(left(audit, k), 'D', '')) - 1 - with_system AS nr FROM ops),
mended AS (
  SELECT placed.c, sha256(string_agg(
    CASE WHEN op = 'K' THEN f.role WHEN nr % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN op = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY k)) AS sha
  FROM placed LEFT JOIN f ON f.c IS NOT DISTINCT FROM placed.c AND f.i = placed.i
  WHERE op <> 'D' GROUP BY placed.c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c)
SELECT raw.c AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT c FROM raw) raw LEFT JOIN counts ON counts.c IS NOT DISTINCT FROM raw.c
LEFT JOIN audits ON audits.c IS NOT DISTINCT FROM raw.c LEFT JOIN mended ON mended.c IS NOT DISTINCT FROM raw.c
"""

ORACLES = {"op1_url_filter": OP1, "op4_line_dedup": OP4, "op5_backoff_scores": OP5, "op5_trigram_scores": OP5_TRIGRAM,
           "op7_quality_rules": OP7, "op8_source_mix": OP8, "op9_warc": OP9, "op10_substring_dedup": OP10,
           "op11_prefix_trie": OP11, "op13_structure_repair": OP13}
