"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from larder.llm.licenses import TEMPLATES, LicenseParams, anchors_of, words_in

URL_FILTER = r"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         row_number() OVER () AS rn
  FROM pages),
rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT rn, max(struct_pack(n := length(rhost) + length(rpath), rule := rhost || rpath, v := rverdict)) AS best
  FROM parsed JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)
  GROUP BY rn)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict
FROM parsed LEFT JOIN fit USING (rn)
"""

# Every 50-byte string by its hex text; spans are joined where their starts lie at most 50 apart.
SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS i FROM d)),
lowest AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.i FROM w JOIN lowest USING (s) WHERE lowest.m < w.doc_id),
marked AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS new FROM hit),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
spans AS (SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY doc_id, k),
gaps AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS after FROM spans),
cut AS (SELECT g.doc_id, count(*) AS n_spans, sum(e - b) AS n_removed,
               string_agg(substr(h, 2 * after + 1, 2 * (b - after)), '' ORDER BY b) AS head, max(e) AS last
        FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN cut.doc_id IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

# All pairs of documents that share a shingle, by an inverted index; components by a recursive walk.
NEAR_DEDUP = r"""
WITH RECURSIVE ws AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM ws WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
          GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
          WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT ws.doc_id, coalesce(n, 0) AS n_shingles, least(ws.doc_id, coalesce(m, ws.doc_id)) AS component_id,
       ws.doc_id = least(ws.doc_id, coalesce(m, ws.doc_id)) AS kept
FROM ws LEFT JOIN size USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


def license_scan() -> str:
    """Every window of every template size against every template, compared exactly.

    Texts without an anchor word of some template can't reach the containment and are left out first.
    """
    anchors = sorted({a for _, text, _ in TEMPLATES for a in anchors_of(words_in(text), LicenseParams())})
    short = "|".join(a for a in anchors if len(a) <= 4)
    some = " OR ".join([rf"regexp_matches(lower(text), '(^|[^\p{{L}}\p{{N}}])({short})([^\p{{L}}\p{{N}}]|$)')",
                        *(f"contains(lower(text), '{a}')" for a in anchors if len(a) > 4)])
    quoted = ", ".join(f"({n}, '{name}', '{text.replace(chr(39), chr(39) * 2)}', CAST({list(marks)} AS VARCHAR[]))"
                       for n, (name, text, marks) in enumerate(TEMPLATES))
    shingles = "list_distinct(list_transform(range(1, greatest(len({w}) - 2, 1) + 1), lambda i: array_to_string({w}[i:i + 2], ' ')))"
    return rf"""
WITH named(template, license, notice, marks) AS (VALUES {quoted}),
tw AS (SELECT template, license, marks, regexp_extract_all(lower(notice), '[\p{{L}}\p{{N}}]+') AS w FROM named),
t AS (SELECT template, license, marks, len(w) AS size, greatest(1, len(w) // 8) AS stride, {shingles.format(w='w')} AS wanted FROM tw),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE {some}),
win AS (SELECT doc_id, template, license, marks, wanted, start, w[start + 1:start + size + stride - 1] AS part
        FROM (SELECT doc_id, w, template, license, marks, wanted, size, stride, unnest(range(0, len(w), stride)) AS start FROM d, t)),
had AS (SELECT doc_id, template, license, marks, start, len(wanted) AS n,
               list_intersect({shingles.format(w='part')}, wanted) AS held FROM win),
share AS (SELECT doc_id, template, license, start, len(held) / n AS c FROM had
          WHERE len(list_filter(marks, lambda m: len(list_filter(held, lambda s: contains(' ' || s || ' ', ' ' || m || ' '))) = 0)) = 0)
SELECT doc_id, CAST(template AS INTEGER) AS template, license, max(c) AS containment,
       CAST(arg_max(start, c * 1e12 - start) AS INTEGER) AS first_word
FROM share WHERE c >= 0.8 - 1e-9 GROUP BY doc_id, template, license
"""

# Levels of all trees by recursion; the crc32 of an id by its bytes (0xEDB88320 and 0xFFFFFFFF in decimal).
MERKLE = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, text,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
         list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                                             lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c, b) & 255, [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS not_crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         CASE WHEN not_crc & 1 = 1 THEN sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':'
                                                                || replace(text, chr(10), ''), '-')) END AS changed
  FROM f),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
nodes(tree, level, idx, n, h) AS (
  SELECT tree, 0, rank, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n),
subroots AS (SELECT tree, h AS subroot FROM nodes WHERE n = 1),
tops(level, idx, n, h) AS (
  SELECT 0, tree, (SELECT count(*) FROM subroots), subroot FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY level, idx // 3, n),
every AS (
  SELECT tree, level, idx, h FROM nodes WHERE n > 1
  UNION ALL SELECT -1, level, idx, h FROM tops WHERE n > 1),
sib AS (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  GROUP BY a.tree, a.level, a.idx),
height AS (SELECT tree, max(level) + 1 AS levels FROM sib GROUP BY tree),
walk(tree, rank, level, cur, proof) AS (
  SELECT tree, rank, 0, coalesce(changed, leaf), '' FROM placed
  UNION ALL
  SELECT w.tree, w.rank, w.level + 1, sha256(s.l || w.cur || s.r), w.proof || s.l || s.r
  FROM walk w JOIN sib s ON s.tree = w.tree AND s.level = w.level AND s.idx = w.rank // CAST(pow(3, w.level) AS BIGINT)),
ended AS (SELECT w.* FROM walk w LEFT JOIN height g USING (tree) WHERE w.level = coalesce(g.levels, 0)),
climb(tree, rank, level, cur, proof) AS (
  SELECT tree, rank, 0, cur, proof FROM ended
  UNION ALL
  SELECT c.tree, c.rank, c.level + 1, sha256(s.l || c.cur || s.r), c.proof || s.l || s.r
  FROM climb c JOIN sib s ON s.tree = -1 AND s.level = c.level AND s.idx = c.tree // CAST(pow(3, c.level) AS BIGINT))
SELECT p.doc_id, p.leaf, t.subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(c.proof) AS proof_sha256,
       c.cur AS folded_root, c.cur = (SELECT h FROM tops WHERE n = 1) AS verified
FROM placed p JOIN subroots t USING (tree) JOIN climb c ON c.tree = p.tree AND c.rank = p.rank
WHERE c.level = coalesce((SELECT levels FROM height WHERE tree = -1), 0)
"""


ORACLES = {
    "op2_suffix_dedup": SUFFIX_DEDUP,
    "op4_near_dedup": NEAR_DEDUP,
    "op5_license_scan": license_scan(),
    "op10_url_filter": URL_FILTER,
    "op13_merkle_manifest": MERKLE,
}
