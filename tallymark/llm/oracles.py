"""DuckDB SQL that gives the rows of those queries that SQL can express: exact pairs and components, exact matches."""

from __future__ import annotations

from tallymark.llm.secrets import BASE, RULES

#: Smallest id that each node reaches over the links (a, b), from relations node(id) and link(a, b).
_COMPONENT = """reach AS (SELECT id, id AS root FROM node UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id),
  component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""

NEAR_VECTORS = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  fine AS MATERIALIZED (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
  link AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM fine x JOIN fine y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
  node AS (SELECT vec_id AS id FROM v), {_COMPONENT}, n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
  SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN component ON id = vec_id LEFT JOIN n ON a = vec_id"""

NEAR_DUPLICATES = rf"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
  classes AS MATERIALIZED (SELECT min(doc_id) AS rep, any_value(s) AS s, list(doc_id) AS ids FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
  each AS MATERIALIZED (SELECT rep, len(s) AS n, hash(unnest(s)) AS h FROM classes),
  met AS (SELECT x.rep AS a, y.rep AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS k FROM each x JOIN each y ON x.h = y.h AND x.rep <> y.rep AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n) GROUP BY x.rep, y.rep),
  link AS MATERIALIZED (SELECT a, b FROM met WHERE 100 * k >= 75 * (n + m - k)), node AS (SELECT rep AS id FROM classes), {_COMPONENT},
  named AS (SELECT unnest(ids) AS doc_id, component_id FROM classes JOIN component ON id = rep)
  SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, s.doc_id = coalesce(component_id, s.doc_id) AS kept FROM sets s LEFT JOIN named n ON n.doc_id = s.doc_id"""


def _secrets() -> str:
    """Spans of every rule from its matches and from what stands between them."""
    spans = []
    for rank, r in enumerate(RULES):
        # This engine has no lookbehind and needs no possessive repeats.
        p = r.pattern.replace("(?<![A-Za-z0-9_-])", r"\b").replace("}+", "}").replace("'", "''")
        hits, kept, gaps = f"regexp_extract_all(t, '{p}')", f"regexp_extract_all(t, '{p}', {r.group})", f"string_split_regex(t, '{p}')"
        spans.append(
            f"""SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, z, z - length(h[i]) AS a, k[i] AS kept, {r.least} AS least FROM (
              SELECT doc_id, h, k, i, list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(h[1:i], lambda x: length(x))) AS z FROM (
                SELECT doc_id, h, k, g, unnest(range(1, len(h) + 1)) AS i FROM (SELECT doc_id, {hits} AS h, {kept} AS k, {gaps} AS g FROM d)))"""
        )
    listed = "string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(z AS BIGINT), ',' ORDER BY a, rank)"
    base = f"rank < {len(BASE)}"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ({' UNION ALL '.join(spans)}),
      per AS (SELECT doc_id, {counts}, {listed} FILTER (WHERE {base}) AS base, {listed} AS spans FROM found WHERE length(kept) >= least GROUP BY doc_id)
      SELECT d.doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per ON per.doc_id = d.doc_id"""


def _crc(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of an SQL string."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(1, len({digits}), 2), lambda i: CAST('0x' || substr({digits}, i, 2) AS BIGINT))"
    shifted = "list_reduce(list_concat([xor(acc, b)], range(8)), lambda k, i: xor(k >> 1, CAST(3988292384 AS BIGINT) * (k & 1)))"
    return f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda acc, b: {shifted}))"


VARIANTS = f"""WITH RECURSIVE d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]{{7,}}')) AS run FROM documents),
  c AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM d GROUP BY doc_id, run), h AS MATERIALIZED (SELECT run, n, {_crc("concat(doc_id, ':', run)")} AS h FROM c),
  v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
  r AS MATERIALIZED (SELECT word, n, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
  p AS (SELECT x.word, y.word AS near, y.n AS near_n FROM r x JOIN r y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word UNION SELECT r.word, v.word, v.n FROM r JOIN v ON r.rest = v.word UNION SELECT v.word, r.word, r.n FROM r JOIN v ON r.rest = v.word),
  b AS (SELECT word, count(*) AS n_near, min(struct_pack(a := -near_n, w := near)) AS m FROM p GROUP BY word),
  f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -m.a >= 10 * v.n THEN m.w END AS form, CASE WHEN -m.a >= 10 * v.n THEN -m.a END AS form_n FROM v LEFT JOIN b ON b.word = v.word),
  g AS (SELECT word, form AS at FROM f WHERE form IS NOT NULL UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.at WHERE f.form IS NOT NULL),
  k AS (SELECT g.word, g.at FROM g JOIN f ON f.word = g.at WHERE f.form IS NULL)
  SELECT f.word, form, coalesce(k.at, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN k ON k.word = f.word"""

TRIE = f"""WITH t AS MATERIALIZED (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))), 1, 32)) AS k FROM conversations WHERE conv_id IS NOT NULL),
  m AS (SELECT conv_id, count(*) AS m FROM t GROUP BY conv_id), c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM m),
  u AS (SELECT c.conv_id, k AS i, r, x FROM c JOIN t ON t.conv_id = base WHERE k <= h UNION ALL SELECT c.conv_id, k - h + least(h, coalesce(m, 0)), r, x FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN m ON m.conv_id = base WHERE k > h),
  s AS MATERIALIZED (SELECT c.conv_id, coalesce(list(md5(concat(length(r), ':', r, x)) ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS s, coalesce(list(length(x) ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS z FROM c LEFT JOIN u ON u.conv_id = c.conv_id GROUP BY c.conv_id),
  p AS (SELECT conv_id, s, z, unnest(range(len(s) + 1)) AS d FROM s),
  n AS MATERIALIZED (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(z[d]), 0) AS z, coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE len(s) = d), '') AS ends FROM p GROUP BY ALL),
  k AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL), f AS MATERIALIZED (SELECT n.*, coalesce(k, 0) AS k FROM n LEFT JOIN k ON k.p = n.p),
  up AS (SELECT p[1:a] AS p, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS leaves, sum(CASE WHEN d = 0 THEN 0 ELSE (n - 1) * z END) AS saved FROM (SELECT *, unnest(range(d + 1)) AS a FROM f) GROUP BY ALL)
  SELECT f.conv_id, f.d AS depth, o.conv_id AS parent_conv_id, f.n AS n_convs, f.k AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
  FROM f JOIN up ON up.p = f.p LEFT JOIN f o ON f.d > 0 AND o.p = f.p[1:f.d - 1]"""

#: The level that sources share by weight is found at the first one, by words per weight, that does not stop at 3 times its words.
MIXTURE = r"""WITH d AS MATERIALIZED (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(concat_ws(':', 'mix', doc_id)) AS lot FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS z, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
  o AS (SELECT *, row_number() OVER (ORDER BY z / w, source NULLS LAST) AS k, sum(z) OVER () AS total FROM s),
  l AS (SELECT *, total - coalesce(sum(3 * z) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o),
  level AS (SELECT rest, free FROM l WHERE 3 * z * free > rest * w ORDER BY k LIMIT 1),
  t AS (SELECT source, z, CASE WHEN free IS NULL OR 3 * z * free <= rest * w THEN CAST(3 * z AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(rest AS DOUBLE) / CAST(free AS DOUBLE) END AS target
    FROM s LEFT JOIN level ON true),
  r AS (SELECT *, CASE WHEN z > 0 THEN target / z ELSE 0.0 END AS rate, CAST(CAST('0x' || substr(md5(concat_ws(':', 'mix', source)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM t),
  p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, lot) - 1 AS i FROM d),
  f AS (SELECT p.*, r.z, r.target, r.rate, r.u, r.rate - floor(r.rate) AS f FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source)
  SELECT doc_id, size, z AS source_size, target, CAST(size * (floor(rate) + floor((i + 1) * f + u) - floor(i * f + u)) AS BIGINT) AS taken FROM f"""

ORACLES = {"op2_epsilon_grid": NEAR_VECTORS, "op7_trigram_index": _secrets(), "op10_hyperminhash": NEAR_DUPLICATES, "op11_prefix_trie": TRIE, "op12_anagram_hash": VARIANTS, "op13_source_mix": MIXTURE}
