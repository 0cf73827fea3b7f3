"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

import random

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
# Lower-cases A-Z only.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _reach(nodes: str, links: str, key: str) -> str:
    """Smallest node that every node of `nodes` reaches over `links` (a, b), both directions."""
    return f"""
    reach({key}, seen) AS (
      SELECT {key}, {key} FROM {nodes}
      UNION
      SELECT r.{key}, l.b FROM reach r JOIN {links} l ON l.a = r.seen
    ),
    smallest AS (SELECT {key}, min(seen) AS component_id FROM reach GROUP BY {key})"""


ORACLES["op1_substrings"] = f"""
WITH w AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
p AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)
),
firsts AS (SELECT p, min(doc_id) AS d FROM p GROUP BY p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM p JOIN firsts USING (p) WHERE d < doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM w),
left_over AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (doc_id)
"""

ORACLES["op3_minhash"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g
  FROM w
),
sizes AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common c JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * c.n >= 85 * (s.n + t.n - c.n)
),
{_reach('documents', 'links', 'doc_id')}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN smallest USING (doc_id)
"""


def mixing_sql(docs: str, seed: int = 7) -> str:
    """CTEs that end in `mixed` (doc_id, size, source_size, target, copies, taken) over the table `docs`."""
    offset = repr(random.Random(seed).random())
    # Ascending caps per weight: the first level that does not exceed its source's ratio is the water level.
    return f"""
sized AS (SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0)::BIGINT AS size FROM {docs}),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS weight
  FROM sized GROUP BY source
),
ranked AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS ratio FROM sources),
levels AS (
  SELECT *, row_number() OVER o AS k,
    (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM ranked WINDOW o AS (ORDER BY ratio, source IS NULL, encode(source))
),
targets AS (
  SELECT source, source_size,
    least(cap, weight * (SELECT arg_min(level, k) FROM levels WHERE level <= ratio)) AS target
  FROM levels
),
placed AS (
  SELECT doc_id, size, source_size, target,
    row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) AS place,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
mixed AS (
  SELECT doc_id, size, source_size, target,
    least(greatest(floor(rate * place + {offset}::DOUBLE) - floor(rate * (place - 1) + {offset}::DOUBLE), 0), 3)::BIGINT AS copies
  FROM placed
)"""


ORACLES["op4_mixing"] = f"""
WITH {mixing_sql('documents')}
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM mixed
"""

# Base32 of a SHA-1: 40 hex digits are 8 groups of 5, each of which is 4 letters of 5 bits.
_BASE32 = """list_aggregate(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha1({0}), 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::BIGINT, 1)),
    'string_agg', '')"""

ORACLES["op6_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT h, max(page_id) AS response FROM p GROUP BY h)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, {_BASE32.format('h')} AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM p JOIN r USING (h)
"""

# Values that are null, empty, zero or not finite link with nothing.
ORACLES["op2_embeddings"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
),
{_reach('embeddings', 'links', 'vec_id')}
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest USING (vec_id)
"""

# crc32 byte by byte from a table of 256 entries, which is made from the polynomial.
_CRC_TABLE = """
crc AS (
  SELECT list(c ORDER BY i) AS crc_table
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c
        FROM (SELECT unnest(range(256)) AS i))
)"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of `text`; needs `crc_table` in scope."""
    at = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {at}), lambda c, b: xor(c // 256, crc_table[(xor(c, b) % 256) + 1])))"


ORACLES["op11_spelling"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY ALL
),
hashed AS (SELECT w, n, {_crc32("d || ':' || w")} AS h FROM runs, crc),
words AS (
  SELECT row_number() OVER (ORDER BY w) AS id, w, n
  FROM (
    SELECT CASE WHEN h % 199 = 0 THEN w[:h % length(w)] || w[(h % length(w)) + 2:] ELSE w END AS w, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1
  ) WHERE length(w) >= 6 AND n >= 5
),
skips AS (SELECT id, n, w, i, w[:i - 1] AS a, w[i + 1:] AS b FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM words)),
links AS (
  SELECT x.id, y.id AS other FROM skips x JOIN skips y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.id <> y.id
  UNION
  SELECT x.id, y.id FROM skips x JOIN words y ON x.a || x.b = y.w
  UNION
  SELECT y.id, x.id FROM skips x JOIN words y ON x.a || x.b = y.w
),
near AS (
  SELECT l.id, count(*) AS n_near, first(o.id ORDER BY o.n DESC, o.id) AS best, max(o.n) AS best_n
  FROM links l JOIN words o ON o.id = l.other GROUP BY l.id
),
forms AS (SELECT w.id, best, best_n FROM words w JOIN near USING (id) WHERE best_n >= 5 * w.n),
walk(id, here, step) AS (
  SELECT id, best, 1 FROM forms
  UNION ALL
  SELECT walk.id, f.best, step + 1 FROM walk JOIN forms f ON f.id = walk.here
),
ends AS (SELECT id, arg_max(here, step) AS root FROM walk GROUP BY id)
SELECT w.w AS word, f.w AS form, coalesce(r.w, w.w) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, forms.best_n::BIGINT AS form_n
FROM words w LEFT JOIN near USING (id) LEFT JOIN forms USING (id) LEFT JOIN words f ON f.id = forms.best
LEFT JOIN ends USING (id) LEFT JOIN words r ON r.id = ends.root
"""

# The cheapest repair as a recursion over the rows: for each state the least (cost, audit), with the text so far.
# States: 0 nothing yet, 1 a system row, 2 a user row, 3 an assistant row.
ORACLES["op12_conversations"] = f"""
WITH RECURSIVE {_CRC_TABLE},
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM damaged
),
faults AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS initial,
         CASE WHEN solid = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(solid, 1) IN ('.', '!', '?') THEN '' ELSE 't' END AS fault
  FROM placed
),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (after IS NOT NULL AND initial || after NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lead(initial) OVER (PARTITION BY conv_id ORDER BY k) AS after FROM faults) GROUP BY conv_id
),
inserts(state, audit, cost, lines, ends) AS (
  VALUES (0, '', 0, '', 0), (0, 'I', 2, chr(10) || 'user:', 2), (0, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:', 3),
         (1, '', 0, '', 1), (1, 'I', 2, chr(10) || 'user:', 2), (1, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:', 3),
         (2, '', 0, '', 2), (2, 'I', 2, chr(10) || 'assistant:', 3), (3, '', 0, '', 3), (3, 'I', 2, chr(10) || 'user:', 2)
),
walk(conv_id, k, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} FROM sums
  UNION ALL
  SELECT conv_id, k, state, min(best) FROM (
    SELECT w.conv_id, f.k, e.state,
           {{'cost': w.best.cost + i.cost + e.cost, 'audit': w.best.audit || i.audit || e.edit, 'lines': w.best.lines || i.lines || e.line}} AS best
    FROM walk w JOIN inserts i USING (state) JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1,
    LATERAL (
      SELECT 'D' AS edit, i.ends AS state, 3 AS cost, '' AS line
      UNION ALL
      SELECT 'K', CASE f.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, (f.fault = 't')::INT, chr(10) || f.role || ':' || f.text
      WHERE f.fault NOT IN ('b', 'd') AND (i.ends, f.initial) IN ((0, 's'), (0, 'u'), (1, 'u'), (2, 'a'), (3, 'u'))
      UNION ALL
      SELECT 'R', CASE i.ends WHEN 2 THEN 3 ELSE 2 END, 2 + (f.fault = 't')::INT,
             chr(10) || CASE i.ends WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || f.text
      WHERE f.fault NOT IN ('b', 'd')
    ) e
  ) GROUP BY conv_id, k, state
),
results AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.audit, 'lines': w.best.lines || i.lines}}) AS best
  FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.k JOIN inserts i USING (state)
  WHERE i.ends IN (0, 3) GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(r.best.cost, 0) AS cost,
       coalesce(r.best.audit, '') AS audit, sha256(coalesce(r.best.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN results r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""
