"""DuckDB SQL of the queries that SQL can express."""

import re

OP6 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM src),
limited AS (SELECT *, 3 * source_size / weight AS lim FROM weighted),
filled AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM limited
  WINDOW w AS (ORDER BY lim, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
brim AS (SELECT level AS height FROM filled WHERE level <= lim ORDER BY lim, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, height * weight) AS target
  FROM filled, brim),
rated AS (
  SELECT s.doc_id, s.size, t.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT r.*, k AS seed,
         floor(rate)::BIGINT + CASE WHEN
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || (k // 4)), (k % 4)::INT * 8 + 1, 8))::BIGINT
             / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM rated r, (SELECT unnest(range(16)) AS k)),
picked AS (
  SELECT source, seed,
         row_number() OVER (PARTITION BY source ORDER BY abs(sum(size * copies) - any_value(target)), seed) AS place
  FROM drawn GROUP BY source, seed)
SELECT d.doc_id, d.size, d.source_size, d.target, (d.size * d.copies)::BIGINT AS taken
FROM drawn d JOIN picked p ON d.source IS NOT DISTINCT FROM p.source AND d.seed = p.seed AND p.place = 1
"""

OP11 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.c, r.c)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.c) = len(r.c)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""

OP12 = r"""
WITH rules(rank, kind, pattern, grp, least) AS (VALUES
  (1, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  (2, 'access', 'AKIA[A-Z0-9]+', 0, 18),
  (3, 'hex', '[0-9a-f]+', 0, 16),
  (4, 'key', '-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+-----END [A-Z ]*PRIVATE KEY-----', 0, 1),
  (5, 'jwt', 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 0, 30),
  (6, 'login', '://[^\x00-\x20/?#:@]+:[^\x00-\x20/?#@]+@', 0, 1),
  (7, 'service', '(gh[pousr]_|xox[abprs]-)([A-Za-z0-9-]+)', 2, 20)),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
cut AS (
  {branches}),
-- the text lies between the matches: their starts follow from the lengths of both
spans AS (
  SELECT text, rank, kind, least, unnest(list_zip(
           list_transform(range(1, len(hits) + 1), lambda i:
             list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)),
           list_transform(hits, lambda x: length(x)), list_transform(parts, lambda x: length(x)))) AS s
  FROM cut JOIN rules USING (rank)),
good AS (SELECT text, rank, kind, s[1]::BIGINT AS start, (s[1] + s[2])::BIGINT AS stop FROM spans WHERE s[3] >= least),
found AS (
  SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank <= 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM good GROUP BY text)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found f ON coalesce(d.text, '') = f.text
"""


def _per_rule(sql: str) -> str:
    """DuckDB wants constant patterns: one branch for each rule of the list."""
    rules = re.findall(r"^  \((\d), '\w+', ('.*'), (\d), \d+\)", sql, re.M)
    return sql.replace("{branches}", " UNION ALL ".join(
        f"SELECT text, {rank} AS rank, regexp_split_to_array(text, {pattern}) AS gaps, regexp_extract_all(text, {pattern}) AS hits, "
        f"regexp_extract_all(text, {pattern}, {group}) AS parts FROM texts" for rank, pattern, group in rules))


OP13 = r"""
WITH RECURSIVE fields AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
            || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
         coalesce(strlen(text) || ':' || text, '-') AS z,
         -- CRC-32 of the decimal id: bytes, and -1 for each of eight bit steps after a byte
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
             lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x)
                                 WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384::BIGINT) ELSE acc // 2 END),
             4294967295::BIGINT) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS grp, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
         CASE WHEN crc % 7 = 0 THEN
           sha256(a || coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') || z) END AS changed
  FROM fields),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n
  FROM leaves),
nodes AS (
  SELECT 0 AS level, grp, pos, n, leaf AS digest FROM ordered
  UNION ALL
  SELECT level + 1, grp, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, grp, pos // 2),
subroots AS (SELECT grp, level AS height, digest AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, subroot AS digest, grp FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)), NULL
  FROM tops WHERE n > 1 GROUP BY level, pos // 2),
-- each row climbs twice: its own siblings, and its tampered leaf folded with them
climb AS (
  SELECT o.doc_id, o.grp, o.pos AS leaf_pos, 0 AS stage, 0 AS level, o.pos, o.leaf, '' AS proof, coalesce(o.changed, o.leaf) AS fold
  FROM ordered o
  UNION ALL
  SELECT c.doc_id, c.grp, c.leaf_pos, c.stage, c.level + 1, c.pos // 2, c.leaf, c.proof || coalesce(s.digest, ''),
         CASE WHEN c.pos % 2 = 1 THEN sha256(s.digest || c.fold) ELSE sha256(c.fold || coalesce(s.digest, '')) END
  FROM climb c JOIN nodes own ON own.level = c.level AND own.grp = c.grp AND own.pos = c.pos AND own.n > 1
  LEFT JOIN nodes s ON s.level = c.level AND s.grp = c.grp AND s.pos = xor(c.pos, 1)),
rise AS (
  SELECT c.doc_id, c.leaf, r.subroot, 0 AS level, t.pos, c.proof, c.fold
  FROM climb c JOIN subroots r ON r.grp = c.grp AND r.height = c.level JOIN tops t ON t.level = 0 AND t.grp = c.grp
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.pos // 2, c.proof || coalesce(s.digest, ''),
         CASE WHEN c.pos % 2 = 1 THEN sha256(s.digest || c.fold) ELSE sha256(c.fold || coalesce(s.digest, '')) END
  FROM rise c JOIN tops own ON own.level = c.level AND own.pos = c.pos AND own.n > 1
  LEFT JOIN tops s ON s.level = c.level AND s.pos = xor(c.pos, 1))
SELECT c.doc_id, c.leaf, c.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root, c.fold = t.digest AS verified
FROM rise c JOIN tops t ON t.n = 1 AND t.level = c.level
"""

ORACLES = {
    "op6_mixing": OP6,
    "op11_negatives": OP11,
    "op12_secrets": _per_rule(OP12),
    "op13_merkle": OP13,
}
