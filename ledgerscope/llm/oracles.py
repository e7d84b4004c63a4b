"""DuckDB SQL for the operators that SQL can express, over whole tables."""

_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = """
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT skey, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY skey) - 1 AS rank FROM d GROUP BY skey),
r AS (
  SELECT *, [5, 2, 1][(rank % 3 + 1)::INT]::HUGEINT AS w, 3 * source_size AS cap,
         [1.5::DOUBLE, 1.0, 0.5][(rank % 3 + 1)::INT] AS a, [0.5::DOUBLE, 1.0, 1.5][(rank % 3 + 1)::INT] AS z FROM s),
f AS (
  SELECT *, coalesce(sum(cap) OVER o, 0)::HUGEINT AS cap_before, coalesce(sum(w) OVER o, 0)::HUGEINT AS w_before,
         sum(source_size) OVER ()::HUGEINT AS total, sum(w) OVER ()::HUGEINT AS all_w
  FROM r WINDOW o AS (ORDER BY cap::DOUBLE / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (total - cap_before) * w > cap * (all_w - w_before) AS capped FROM f),
l AS (
  SELECT max(total)::HUGEINT - coalesce(sum(CASE WHEN capped THEN cap END), 0)::HUGEINT AS rest,
         sum(CASE WHEN NOT capped THEN w END)::HUGEINT AS rest_w FROM c),
t AS (
  SELECT skey, source_size, a, z,
         CASE WHEN capped THEN cap::DOUBLE ELSE w::DOUBLE * (rest::DOUBLE / rest_w::DOUBLE) END AS target
  FROM c, l),
x AS (
  SELECT doc_id, size, skey, coalesce(sum(size) OVER (
           PARTITION BY skey ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS x
  FROM d),
y AS (
  SELECT x.*, source_size::BIGINT AS source_size, target, a, z,
         greatest(0, least(size, floor(target)::BIGINT - x)) AS t0,
         greatest(0, least(size, floor(target)::BIGINT - x - source_size::BIGINT)) AS t1,
         greatest(0, least(size, floor(target)::BIGINT - x - 2 * source_size::BIGINT)) AS t2
  FROM x JOIN t USING (skey))
SELECT doc_id, size, source_size, target, (t0 + t1 + t2)::BIGINT AS taken,
       CASE WHEN t0 > 0 THEN round(2 * (x / target) / (a + sqrt(a * a + 2 * (z - a) * (x / target))), 6) END AS position
FROM y
"""

OP6 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item, m, list_slice(w, i, i + m - 1) AS win
  FROM (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM p),
o AS (
  SELECT rid, i, m, list_slice(w, i, i + m - 1) AS win
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)),
h AS (SELECT o.rid, o.i, o.m, p.item FROM o JOIN p ON o.m = p.m AND o.win = p.win),
n AS (
  SELECT rid, count(DISTINCT pos) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + m)) AS pos FROM (SELECT DISTINCT rid, i, m FROM h)) GROUP BY rid),
g AS (SELECT rid, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN g USING (rid)
"""

_ASSIGN = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
           "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")


def _matches(rank: int, pattern: str, group: int = 0) -> str:
    """SQL rows (rid, rank, s, e, v): split pieces and matches interleave."""
    return f"""
  SELECT rid, {rank} AS rank, s, s + length(m) AS e, v FROM (
    SELECT rid, m, v, (sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS s FROM (
      SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(vs) AS v,
             unnest(list_slice(gs, 1, len(ms))) AS g
      FROM (SELECT rid, regexp_extract_all(text, '{pattern}', 0) AS ms, regexp_extract_all(text, '{pattern}', {group}) AS vs,
                   string_split_regex(text, '{pattern}') AS gs
            FROM d WHERE regexp_matches(text, '{pattern}'))))"""


OP10 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS owner FROM documents),
base AS (
  SELECT * FROM ({_matches(0, _ASSIGN, 2)}) WHERE length(v) >= 12
  UNION ALL {_matches(1, 'AKIA[A-Z0-9]{14,}')}
  UNION ALL {_matches(2, '[0-9a-f]{16,}')}),
wide AS (
  SELECT * FROM ({_matches(3, '[A-Za-z0-9+/_-]{20,}')}) w
  WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b.s < w.e AND w.s < b.e)),
cand AS (SELECT * FROM base UNION ALL SELECT * FROM wide),
freq AS (
  SELECT v, count(DISTINCT owner) <= 1 AND count(DISTINCT coalesce(doc_id::VARCHAR, '') || ':' || text) <= 2 AS live
  FROM cand JOIN d USING (rid) GROUP BY v),
spans AS (SELECT rid, rank, s, e, live, ['assign', 'access', 'hex', 'live'][rank + 1] || ':' || s || ':' || e AS j
          FROM cand JOIN freq USING (v) WHERE rank < 3 OR live),
a AS (
  SELECT rid, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
         count(*) FILTER (WHERE rank = 2) AS n_hex, count(*) FILTER (WHERE NOT live) AS n_example,
         string_agg(j, ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base, string_agg(j, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN a USING (rid)
"""

OP4 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e
  FROM embeddings),
l AS (
  SELECT a.rid AS a, b.rid AS b FROM v a JOIN v b ON a.rid <> b.rid
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (
  SELECT rid, rid FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT r.a AS rid, min(v.vec_id) AS component_id FROM r JOIN v ON v.rid = r.b GROUP BY r.a),
n AS (SELECT a AS rid, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN c USING (rid) LEFT JOIN n USING (rid)
"""

OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= 2),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.first AS gone FROM k LEFT JOIN r USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


_CRC32 = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen({0}) + 1), "
          "lambda i: ascii(substr({0}, i, 1))::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), "
          "lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))")
_LEVELS = 12  # 8 ** 12 rows a language


def _merkle(levels: int = _LEVELS) -> str:
    """Levels one by one: a tree of one node stops; afterwards the proof and the folded digest climb along."""
    parts = [f"""
WITH d AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS grp, sha256({" || ".join(_field(c) for c in FIELDS)}) AS leaf,
         CASE WHEN ({_CRC32.format("doc_id::VARCHAR")}) % 3 = 0
              THEN sha256({" || ".join(_field(_LOWER.format("text") if c == "text" else c) for c in FIELDS)}) END AS tampered
  FROM documents),
l AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY grp) AS n
  FROM d),
v0 AS (SELECT grp, rank, leaf AS node, n FROM l),
f0 AS (SELECT grp, rank AS leaf_rank, rank AS at, coalesce(tampered, leaf) AS node, '' AS proof FROM l)"""]

    def climb(h: int, v: str, f: str, key: str) -> str:
        return f""",
{v}{h + 1} AS (
  SELECT grp, rank // 8 AS rank, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(node, '' ORDER BY rank)) ELSE any_value(node) END AS node,
         (any_value(n) + 7) // 8 AS n FROM {v}{h} GROUP BY grp, rank // 8),
{f}{h + 1} AS (
  SELECT f.grp, {key}, f.at // 8 AS at,
         CASE WHEN any_value(v.n) > 1 THEN sha256(string_agg(CASE WHEN v.rank = f.at THEN f.node ELSE v.node END, '' ORDER BY v.rank))
              ELSE any_value(f.node) END AS node,
         any_value(f.proof) || coalesce(string_agg(v.node, '' ORDER BY v.rank) FILTER (WHERE v.rank <> f.at), '') AS proof
  FROM {f}{h} f JOIN {v}{h} v ON v.grp = f.grp AND v.rank // 8 = f.at // 8 GROUP BY f.grp, {key}, f.at)"""

    parts += [climb(h, "v", "f", "f.leaf_rank") for h in range(levels)]
    parts.append(f""",
t AS (SELECT grp AS g, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS rank, count(*) OVER () AS n FROM v{levels}),
w0 AS (SELECT '' AS grp, rank, subroot AS node, n FROM t),
g0 AS (SELECT '' AS grp, f.grp AS g, f.leaf_rank, t.rank AS at, f.node, f.proof FROM f{levels} f JOIN t ON t.g = f.grp)""")
    parts += [climb(h, "w", "g", "f.g, f.leaf_rank") for h in range(4)]
    parts.append("""
SELECT l.doc_id, l.leaf, t.subroot, w4.node AS root, sha256(g4.proof) AS proof_sha256, g4.node AS folded_root,
       g4.node = w4.node AS verified
FROM l JOIN t ON t.g = l.grp JOIN g4 ON g4.g = l.grp AND g4.leaf_rank = l.rank CROSS JOIN w4
""")
    return "".join(parts)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
OP13 = _merkle()

ORACLES = {"op4_cover_tree": OP4, "op3_curriculum_mix": OP3, "op6_wu_manber": OP6, "op10_ownership_secrets": OP10,
           "op11_line_dedup": OP11, "op13_merkle_manifest": OP13}
