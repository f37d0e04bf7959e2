"""SQL counterparts of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all(" + _LOW + r", '[^\x20\x09-\x0D]+')"

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(c, e.vec_id) AS component_id, coalesce(c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
"""

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format('text')} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM.format('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, list_slice(w, p, p + least(10, len(w)) - 1) AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
found AS (SELECT doc_id, p, windows.size, item_id FROM places JOIN windows ON windows.size = places.size AND list_slice(w, p, p + places.size - 1) = run),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

LINE_RUNS = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
u AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM d),
l AS (SELECT *, len(list_filter(string_split(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), lambda x: x <> ''))
    + len(regexp_extract_all(line, '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]')) AS n FROM u),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l),
e AS (SELECT doc_id, pos, upto - n AS before, upto FROM c),
runs AS (
  SELECT a.doc_id, a.pos AS p, min(b.pos) AS q FROM e a JOIN e b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.before >= 50 GROUP BY ALL
  UNION
  SELECT a.doc_id, max(a.pos) AS p, b.pos AS q FROM e a JOIN e b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.before >= 50
  GROUP BY a.doc_id, b.pos),
named AS (SELECT runs.doc_id, p, q, list_slice(lines, p + 1, q + 1) AS run FROM runs JOIN d ON d.doc_id = runs.doc_id),
first AS (SELECT *, first_value({'d': doc_id, 'p': p}) OVER (PARTITION BY run ORDER BY doc_id, p) AS f FROM named),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, q + 1)) AS pos FROM first WHERE f.d < doc_id OR f.d = doc_id AND f.p < p),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS text FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos
  WHERE gone.pos IS NULL GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(n, 0) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

ARCHIVES = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
t AS (SELECT *, n >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY digest, n) AS again, max(page_id) OVER (PARTITION BY digest, n) AS target FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN target END AS refers_to
FROM t
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.format('text')} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, p, p + 3) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
often AS (SELECT s FROM s GROUP BY s HAVING count(*) > 1),
c AS (SELECT s.doc_id, hash(s.s) AS h, s.s FROM s JOIN often ON often.s = s.s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM c a JOIN c b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
one AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
links AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, d.doc_id) AS component_id, coalesce(m, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""

PREFIX_TRIE = """
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM t),
crc AS (
  SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) AS crc
  FROM ids),
h AS (SELECT c, crc % 9 AS h, c - c % 5 AS base FROM crc),
turns AS (
  SELECT h.c, pos, role, text FROM h JOIN t ON t.c = h.base AND pos < h
  UNION ALL SELECT h.c, pos + 0 AS pos, role, text FROM h JOIN t ON t.c = h.c AND pos >= h),
paths AS (
  SELECT ids.c, coalesce(p, []) AS path
  FROM ids LEFT JOIN (SELECT c, list({'r': role, 't': text} ORDER BY pos) AS p FROM turns GROUP BY c) x ON x.c = ids.c),
begins AS (SELECT c, len(path) AS total, d, list_slice(path, 1, d) AS node FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE total = d), '')) AS ends
  FROM begins GROUP BY node, d),
kids AS (SELECT list_slice(node, 1, d - 1) AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
up AS (
  SELECT list_slice(node, 1, a) AS node, a, sum(CASE WHEN d > 0 THEN (n - 1) * strlen(node[d].t) ELSE 0 END) AS saved, sum(leaf) AS leaves
  FROM (SELECT nodes.node, nodes.d, nodes.n, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, nodes.d + 1)) AS a
        FROM nodes LEFT JOIN kids ON kids.node = nodes.node AND kids.d = nodes.d)
  GROUP BY ALL)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0) AS n_children,
  CAST(up.leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes JOIN up ON up.node = nodes.node AND up.a = nodes.d LEFT JOIN kids ON kids.node = nodes.node AND kids.d = nodes.d
LEFT JOIN nodes above ON nodes.d > 0 AND above.d = nodes.d - 1 AND above.node = list_slice(nodes.node, 1, nodes.d - 1)
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(""" + _LOW.format("text") + r""", '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS p, count(*) AS f FROM places, (SELECT unnest(range(1, 6)) AS k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
longer AS (
  SELECT lang, p, max(f) AS f FROM (
    SELECT lang, list_slice(p, 1, len(p) - 1) AS p, f FROM grams WHERE len(p) > 2
    UNION ALL SELECT lang, list_slice(p, 2, len(p)) AS p, f FROM grams WHERE len(p) > 2) GROUP BY ALL),
kept AS (
  SELECT g.lang, g.p, g.f AS a FROM grams g LEFT JOIN longer ON longer.lang = g.lang AND longer.p = g.p
  WHERE len(g.p) > 1 AND (longer.f IS NULL OR 100 * longer.f < 100 * g.f)),
cuts AS (SELECT *, unnest(range(1, len(p))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, c.k)
  JOIN grams y ON y.lang = c.lang AND y.p = list_slice(c.p, c.k + 1, len(c.p)) JOIN total t ON t.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
placed AS (
  SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= 2000
"""

ORACLES = {
    "op3_epsilon_grid_order_join": VECTORS,
    "op5_prefix_filtered_decontamination": CONTAMINATION,
    "op7_line_run_suffix_array": LINE_RUNS,
    "op8_zstandard_warc": ARCHIVES,
    "op10_bottom_k_near_duplicates": NEAR_DUPLICATES,
    "op11_multikey_quicksort_phrases": PHRASES,
    "op13_parentheses_prefix_trie": PREFIX_TRIE,
}
