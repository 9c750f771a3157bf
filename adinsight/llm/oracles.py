"""DuckDB SQL for queries whose oracle is long, by plainer methods than the operators'."""

from __future__ import annotations

#: Words ``[^\x20\x09-\x0D]+`` of a text as a list; a null text has none.
_WORDS = "list_filter(regexp_split_to_array(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

#: Windows as texts, counted over all documents.
OP4_SQL = f"""
WITH word AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS w FROM documents),
one AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM word),
win AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i, w FROM word WHERE len(w) >= 35),
hashed AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM win),
often AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM hashed SEMI JOIN often ON hashed.h = often.h),
kept AS (SELECT one.rid, count(*) AS n, string_agg(x, ' ' ORDER BY one.i) AS text
         FROM one ANTI JOIN gone ON one.rid = gone.rid AND one.i = gone.i GROUP BY one.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM word LEFT JOIN kept ON word.rid = kept.rid
"""

#: CRC-32 of a decimal number: a register, each byte followed by eight shifts (-1).
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''),
      lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

#: Runs from all pairs of equal words of a document that are up to a quarter of it apart.
OP11_SQL = f"""
WITH h AS (
  SELECT row_number() OVER () AS rid, doc_id, {_CRC.format("doc_id")} AS h, {_WORDS.format("text")} AS w FROM documents),
a AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM h),
b AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM a),
c AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM b),
d AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
        list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM c),
word AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS x FROM d),
same AS (SELECT l.rid, r.i - l.i AS q, l.i FROM word l JOIN word r
         ON l.rid = r.rid AND l.x = r.x AND r.i > l.i AND r.i - l.i <= l.n // 4),
island AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM same),
stretch AS (SELECT rid, min(i) AS start, count(*) + q AS length, q FROM island GROUP BY rid, q, k
            HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT rid, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(min(q) AS BIGINT) AS period
        FROM stretch GROUP BY rid, start, length),
listed AS (SELECT rid, count(*) AS n_runs,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
             flatten(list(range(start + period, start + length))) AS gone
           FROM run GROUP BY rid),
best AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS nth FROM run),
gone AS (SELECT DISTINCT rid, unnest(gone) AS i FROM listed),
kept AS (SELECT word.rid, string_agg(x, ' ' ORDER BY word.i) AS text
         FROM word LEFT JOIN gone ON word.rid = gone.rid AND word.i = gone.i WHERE gone.i IS NULL GROUP BY word.rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed ON d.rid = listed.rid LEFT JOIN best ON d.rid = best.rid AND nth = 1 LEFT JOIN kept ON d.rid = kept.rid
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

#: The whole tree level by level, then every path from it; folded by a recursion over the levels.
OP12_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS src,
         {_LEAF.format("text")} AS leaf,
         CASE WHEN {_CRC.format("doc_id")} % 2 = 0 THEN {_LEAF.format("replace(text, chr(10), '')")} END AS changed
  FROM documents),
ranked AS (
  SELECT rid, doc_id, src, leaf, coalesce(changed, leaf) AS tampered,
         row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaf),
node AS (
  SELECT src, 0 AS lv, i, leaf AS h FROM ranked
  UNION ALL
  SELECT src, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY src) AS m FROM node) WHERE m > 1 GROUP BY src, lv, i // 3),
height AS (SELECT src, max(lv) AS top FROM node GROUP BY src),
subroot AS (
  SELECT node.src, h, row_number() OVER (ORDER BY node.src) - 1 AS i
  FROM node JOIN height ON node.src = height.src AND lv = top),
upper AS (
  SELECT 0 AS lv, i, h FROM subroot
  UNION ALL
  SELECT lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS m FROM upper) WHERE m > 1 GROUP BY lv, i // 3),
root AS (SELECT lv AS top, h FROM upper ORDER BY lv DESC LIMIT 1),
place AS (
  SELECT rid, src, lv, i // CAST(power(3, lv) AS BIGINT) AS i
  FROM ranked JOIN height USING (src), LATERAL (SELECT unnest(range(top)) AS lv)),
over AS (
  SELECT src, lv, i // CAST(power(3, lv) AS BIGINT) AS i FROM subroot, root, LATERAL (SELECT unnest(range(top)) AS lv)),
step AS (
  SELECT rid, p.lv, coalesce(string_agg(h, '' ORDER BY n.i) FILTER (WHERE n.i < p.i), '') AS before,
         coalesce(string_agg(h, '' ORDER BY n.i) FILTER (WHERE n.i > p.i), '') AS behind
  FROM place p JOIN node n ON n.src = p.src AND n.lv = p.lv AND n.i // 3 = p.i // 3 GROUP BY rid, p.lv
  UNION ALL
  SELECT rid, 1000 + o.lv, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i < o.i), ''),
         coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i > o.i), '')
  FROM ranked r JOIN over o ON r.src = o.src JOIN upper u ON u.lv = o.lv AND u.i // 3 = o.i // 3 GROUP BY rid, o.lv),
path AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lv) AS k FROM step),
proof AS (SELECT rid, string_agg(before || behind, '' ORDER BY k) AS text, max(k) AS steps FROM path GROUP BY rid),
fold AS (
  SELECT rid, 0 AS k, tampered AS x FROM ranked
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(before || x || behind) FROM fold f JOIN path p ON p.rid = f.rid AND p.k = f.k + 1)
SELECT doc_id, leaf, s.h AS subroot, root.h AS root, sha256(coalesce(proof.text, '')) AS proof_sha256,
       fold.x AS folded_root, fold.x = root.h AS verified
FROM ranked JOIN subroot s ON ranked.src = s.src LEFT JOIN proof ON ranked.rid = proof.rid
JOIN fold ON ranked.rid = fold.rid AND fold.k = coalesce(steps, 0), root
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of documents by their common shingles, and the closure of the links.
OP13_SQL = f"""
WITH RECURSIVE word AS (SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
bag AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS bag FROM word),
shingle AS (SELECT doc_id, len(bag) AS n, unnest(bag) AS s FROM bag),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM bag
  UNION
  SELECT reach.x, pair.y FROM reach JOIN pair ON reach.y = pair.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(bag) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM bag JOIN least ON bag.doc_id = least.x
"""
