"""SQL twins for DuckDB of the queries that SQL can express."""

from __future__ import annotations

# crc32 of an ASCII text, unsigned: bit by bit, with the usual reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split({0}, '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [k::BIGINT FOR k IN range(8)]),
    lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"""


def _encoded(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_encoded, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS id, doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC.format("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(_LOWERED)}
         ELSE {_leaf("text")} END AS shown FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
lv(source, lev, i, h) AS (
  SELECT source, 0, i, leaf FROM placed
  UNION ALL
  SELECT source, lev + 1, i // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM lv) WHERE n > 1 GROUP BY source, lev, i // 16),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM (
    SELECT * FROM lv QUALIFY lev = max(lev) OVER (PARTITION BY source))),
top(lev, i, h) AS (
  SELECT 0, i, subroot FROM subroots
  UNION ALL
  SELECT lev + 1, i // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY lev, i // 16),
steps AS (
  SELECT p.id, 0 AS phase, l.lev, string_agg(l.h, '' ORDER BY l.i) FILTER (l.i < p.i >> (4 * l.lev)) AS a,
    string_agg(l.h, '' ORDER BY l.i) FILTER (l.i > p.i >> (4 * l.lev)) AS b
  FROM placed p JOIN (SELECT *, count(*) OVER (PARTITION BY source, lev) AS n FROM lv) l
    ON l.source IS NOT DISTINCT FROM p.source AND l.i // 16 = (p.i >> (4 * l.lev)) // 16 AND l.n > 1
  GROUP BY ALL
  UNION ALL
  SELECT p.id, 1, t.lev, string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < s.i >> (4 * t.lev)),
    string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > s.i >> (4 * t.lev))
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
    JOIN (SELECT *, count(*) OVER (PARTITION BY lev) AS n FROM top) t ON t.i // 16 = (s.i >> (4 * t.lev)) // 16 AND t.n > 1
  GROUP BY p.id, t.lev),
proofs AS (
  SELECT id, string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY phase, lev) AS siblings,
    list(coalesce(a, '') || '|' || coalesce(b, '') ORDER BY phase, lev) AS runs FROM steps GROUP BY id),
told AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM top ORDER BY lev DESC LIMIT 1) AS root,
    sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(p.shown, coalesce(runs, [])),
      lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN proofs USING (id))
SELECT *, folded_root = root AS verified FROM told
"""

TRIE = f"""
WITH said AS (
  SELECT conv_id AS c, list(sha256(strlen(role) || ':' || role || text) ORDER BY turn NULLS FIRST, role, text) AS ids,
    list(length(text) ORDER BY turn NULLS FIRST, role, text) AS chars, {_CRC.format("any_value(conv_id)::VARCHAR")} % 6 AS h
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL) GROUP BY conv_id),
built AS (
  SELECT s.c, list_concat(coalesce(b.ids[1:s.h], []), s.ids[s.h + 1:]) AS ids,
    list_concat(coalesce(b.chars[1:s.h], []), s.chars[s.h + 1:]) AS chars
  FROM said s LEFT JOIN said b ON b.c = s.c - s.c % 100),
members AS (
  SELECT c, d, array_to_string(ids[1:d], ',') AS name,
    CASE WHEN d > 0 THEN array_to_string(ids[1:d - 1], ',') END AS parent, CASE WHEN d > 0 THEN chars[d] END AS last, d = len(ids) AS ends
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM built)),
nodes AS (
  SELECT name, d, min(c) AS c, max(parent) AS parent, count(*) AS n, (count(*) - 1) * coalesce(max(last), 0) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM members GROUP BY name, d),
children AS (SELECT parent AS name, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (name)),
sums AS (
  SELECT m.name, sum(w.saved) AS saved, count(*) FILTER (w.n_children = 0) AS n_leaves
  FROM whole w JOIN members m ON m.c = w.c AND m.d <= w.d GROUP BY m.name)
SELECT w.c AS conv_id, w.d AS depth, p.c AS parent_conv_id, w.n AS n_convs, w.n_children, s.n_leaves,
  s.saved::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN sums s USING (name) LEFT JOIN whole p ON p.name = w.parent
"""
