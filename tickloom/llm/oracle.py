"""DuckDB statements for the queries whose whole result SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    parts = [_field(x) for x in ("doc_id", "source", "lang", "n_chars")]
    return f"sha256({' || '.join([*parts, _field(text)])})"


_CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda ch: ascii(ch)::BIGINT),
    lambda c, b: list_reduce(
        [0, 0, 0, 0, 0, 0, 0, 0],
        lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END,
        xor(c, b)),
    4294967295::BIGINT))"""

MERKLE = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS total,
    row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id
  FROM docs),
inner_nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS node, total FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (total + 15) // 16
  FROM inner_nodes WHERE total > 1 GROUP BY tree, level, pos // 16, total),
subroots AS (SELECT tree, node FROM inner_nodes WHERE total = 1),
outer_nodes AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, node, count(*) OVER () AS total
  FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (total + 15) // 16
  FROM outer_nodes WHERE total > 1 GROUP BY level, pos // 16, total),
nodes AS (
  SELECT tree, level, pos, node, total FROM inner_nodes
  UNION ALL SELECT '', level, pos, node, total FROM outer_nodes),
beside AS (
  SELECT tree, level, pos, total,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WINDOW w AS (PARTITION BY tree, level, pos // 16 ORDER BY pos)),
inner_fold AS (
  SELECT id, tree, 0 AS level, pos, total, coalesce(changed, leaf) AS cur, '' AS proof FROM placed
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.pos // 16, (f.total + 15) // 16,
    sha256(b.l || f.cur || b.r), f.proof || b.l || b.r
  FROM inner_fold f JOIN beside b ON b.tree = f.tree AND b.level = f.level AND b.pos = f.pos
  WHERE f.total > 1),
lined AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS pos FROM subroots),
outer_fold AS (
  SELECT f.id, 0 AS level, l.pos, (SELECT count(*) FROM subroots) AS total, f.cur, f.proof
  FROM inner_fold f JOIN lined l ON l.tree = f.tree WHERE f.total = 1
  UNION ALL
  SELECT f.id, f.level + 1, f.pos // 16, (f.total + 15) // 16,
    sha256(b.l || f.cur || b.r), f.proof || b.l || b.r
  FROM outer_fold f JOIN beside b ON b.tree = '' AND b.level = f.level AND b.pos = f.pos
  WHERE f.total > 1)
SELECT p.doc_id, p.leaf, s.node AS subroot, o.node AS root, sha256(f.proof) AS proof_sha256,
  f.cur AS folded_root, f.cur = o.node AS verified
FROM placed p
JOIN subroots s ON s.tree = p.tree
JOIN outer_nodes o ON o.total = 1
JOIN outer_fold f ON f.id = p.id AND f.total = 1
"""

DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occurrences AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
langs AS (
  SELECT g.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total
  FROM (SELECT DISTINCT lang FROM docs) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY lang, source, term),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2))
      // (sum(coalesce(c.n, 0)) OVER (PARTITION BY s.lang, s.source) + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM sources s JOIN langs l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM sources a JOIN sources b
  ON a.lang = b.lang AND a.source <> b.source),
pair_values AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
results AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value
  FROM pairs LEFT JOIN pair_values USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM results)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _words(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


WINNOWING = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text')} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {_words('text')} AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS span
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM spans),
windows AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)),
hits AS (SELECT rid, i, size, item FROM windows JOIN spans USING (size, span)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT rid, i, size FROM hits)) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""
