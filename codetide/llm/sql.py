"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from codetide.llm import quality, warc

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '')"

#: ``numbered`` has one row per document with its number as rid.
QUALITY = rf"""
docs AS (
  SELECT rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS lines
  FROM numbered
),
windows AS (
  SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM docs WHERE len(w) >= 3)
),
twice AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, win) AS n FROM windows),
covered AS (
  SELECT rid, count(DISTINCT q) AS n
  FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM twice WHERE n > 1) GROUP BY rid
),
base AS (
  SELECT d.rid, doc_id, host, body, lines, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '[ \t\n\x0b\x0c\r]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(translate(body, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN covered c ON d.rid = c.rid
),
line AS (
  SELECT rid, doc_id, host, trim(lower(regexp_replace(x, '[ \t\n\x0b\x0c\r]+', ' ', 'g'))) AS line
  FROM (SELECT rid, doc_id, host, unnest(lines) AS x FROM docs)
),
above AS (
  SELECT host, line, min(doc_id) AS first_id FROM (SELECT DISTINCT rid, doc_id, host, line FROM line)
  GROUP BY host, line HAVING count(*) > {quality.MOST_DOCUMENTS}
),
per_doc AS (
  SELECT l.rid, CAST(sum(length(l.line)) AS BIGINT) AS line_chars,
         CAST(coalesce(sum(CASE WHEN a.line IS NOT NULL AND a.first_id IS DISTINCT FROM l.doc_id THEN length(l.line) END), 0) AS BIGINT) AS removed_chars
  FROM line l LEFT JOIN above a ON a.host = l.host AND a.line = l.line GROUP BY l.rid
),
judged AS (
  SELECT b.rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         coalesce(line_chars, 0) AS line_chars, coalesce(removed_chars, 0) AS removed_chars,
         (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words) AS base_failed,
         coalesce(line_chars - removed_chars < {quality.LEAST_LEFT} * line_chars, false) AS depleted
  FROM base b LEFT JOIN per_doc p ON b.rid = p.rid
)"""

OP1 = f"""
WITH numbered AS (SELECT *, row_number() OVER () AS rid FROM documents), {QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line_chars, removed_chars, base_failed, depleted,
       NOT base_failed AND NOT depleted AS kept
FROM judged
"""

OP10 = f"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         coalesce(html, '') AS body
  FROM pages
),
k AS (SELECT body, max(page_id) AS keeper FROM p WHERE payload_bytes >= {warc.LEAST_REVISIT} GROUP BY body)
SELECT p.page_id, payload_bytes, payload_digest,
       CASE WHEN p.page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.body = k.body
"""


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
sized AS (SELECT rid, doc_id, t, len(t) AS n FROM doc WHERE len(t) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM sized) GROUP BY rid, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term
),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, s.rid, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // all_terms)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN sized s USING (rid), total GROUP BY item_id, s.rid
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""

_FIELDS = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")


def _leaf(text: str) -> str:
    parts = " || ".join(f"coalesce(CAST(strlen({x}) AS VARCHAR) || ':' || {x}, '-')" for x in (*_FIELDS, text))
    return f"sha256({parts})"


def _tree(name: str, base: str) -> str:
    """Nodes of all levels, and the ways of the nodes of the lowest one."""
    return f"""
{name} AS (
  {base}
  UNION ALL
  SELECT tree, lvl + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE size > 1 GROUP BY tree, lvl, place // 3, size
)"""


def _walk(name: str, tree: str, base: str) -> str:
    """From each leaf upwards: the digest that results from its replacement, and the siblings so far."""
    return f"""
{name} AS (
  {base}
  UNION ALL
  SELECT w.rid, w.tree, w.lvl + 1, w.place // 3, any_value((n.size + 2) // 3),
         sha256(string_agg(CASE WHEN n.place = w.place THEN w.folded ELSE n.digest END, '' ORDER BY n.place)),
         any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> w.place), '')
  FROM {name} w JOIN {tree} n ON n.tree = w.tree AND n.lvl = w.lvl AND n.place // 3 = w.place // 3
  WHERE w.size > 1 GROUP BY w.rid, w.tree, w.lvl, w.place
)"""


#: The last bit of the decimal id's CRC-32, bit by bit.
_CRC_ODD = """
1 - list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) & 1
"""

OP13 = f"""
WITH RECURSIVE leaf AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || source, '') AS source, {_leaf("text")} AS leaf,
         CASE WHEN ({_CRC_ODD}) = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS tampered
  FROM documents
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS size
  FROM leaf
),{_tree("node", "SELECT source AS tree, 0 AS lvl, place, size, leaf AS digest FROM numbered")},
subroot AS (
  SELECT tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM node WHERE size = 1
),{_tree("top", "SELECT '' AS tree, 0 AS lvl, place, size, digest FROM subroot")},{_walk("walk", "node",
   "SELECT rid, source AS tree, 0 AS lvl, place, size, tampered AS folded, '' AS proof FROM numbered")},{_walk("upper", "top",
   "SELECT w.rid, '' AS tree, 0 AS lvl, s.place, s.size, w.folded, w.proof FROM walk w JOIN subroot s ON w.tree = s.source WHERE w.size = 1")}
SELECT doc_id, n.leaf, s.digest AS subroot, t.digest AS root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root,
       u.folded = t.digest AS verified
FROM numbered n JOIN subroot s ON n.source = s.source JOIN upper u ON u.rid = n.rid AND u.size = 1, (SELECT digest FROM top WHERE size = 1) t
"""
