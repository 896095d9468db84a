"""DuckDB SQL that checks the queries which SQL can express."""

from __future__ import annotations

_ORACLES: dict[str, str] = {}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_WORDS = r"[^\x20\x09-\x0D]+"

# Words of documents with their place, lower-casing A-Z only where asked for.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCHMARK_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_ORACLES["op1_decontamination"] = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_BENCHMARK_WORDS}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_BENCHMARK_WORDS}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM windows),
found AS (
  SELECT d.doc_id, d.i, d.size, x.item_id FROM (
    SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS r(i)
  ) d JOIN windows x USING (size, win)
),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + size)) AS r(j) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_ORACLES["op2_ngram_jaccard"] = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS gram
  FROM docs, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS r(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)
),
reach AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(seen) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_ORACLES["op9_source_mixing"] = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS size FROM documents
),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM totals),
levelled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighted WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)
),
flagged AS (SELECT *, 3 * source_size < level * weight AS filled FROM levelled),
sources AS (
  SELECT source, source_size, weight,
    CASE WHEN filled THEN CAST(3 * source_size AS DOUBLE) ELSE max(CASE WHEN NOT filled THEN level END) OVER () * weight END AS target
  FROM flagged
),
cuts AS (
  SELECT *, least(blocks, CAST(floor((target - whole * source_size) / CAST(words AS DOUBLE) + 0.5) AS BIGINT)) + whole * blocks AS slots
  FROM (SELECT *, CAST(ceil(source_size / CAST(words AS DOUBLE)) AS BIGINT) AS blocks,
          CAST(floor(target / CAST(greatest(source_size, 1) AS DOUBLE)) AS BIGINT) AS whole
        FROM (SELECT *, greatest(1, CAST(ceil(source_size / CAST(1024 AS DOUBLE)) AS BIGINT)) AS words FROM sources))
),
ends AS (
  SELECT source, CAST(sum(slots) OVER (ORDER BY source NULLS LAST) AS DOUBLE) / CAST(sum(slots) OVER () AS DOUBLE) AS stop,
    lead(source_size) OVER (ORDER BY source NULLS LAST) AS later FROM cuts WHERE slots > 0
),
stretches AS (
  SELECT source, lag(stop, 1, 0.0) OVER (ORDER BY source NULLS LAST) AS start, CASE WHEN later IS NULL THEN 2.0 ELSE stop END AS stop FROM ends
),
points AS (
  SELECT i, (i + 0.5) * CAST(0.6180339887498949 AS DOUBLE) - floor((i + 0.5) * CAST(0.6180339887498949 AS DOUBLE)) AS x
  FROM (SELECT CAST(sum(slots) AS BIGINT) AS n FROM cuts), unnest(range(n)) AS r(i)
),
ranked AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS rnk
  FROM points JOIN stretches ON x >= start AND x < stop
),
turns AS (
  SELECT r.source, rnk % blocks AS block, count(*) AS times FROM ranked r JOIN cuts b ON r.source IS NOT DISTINCT FROM b.source
  WHERE rnk < 3 * blocks GROUP BY 1, 2
),
placed AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
    ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM sized
),
cut AS (
  SELECT p.source, doc_id, block, least(start + size, (block + 1) * words) - greatest(start, block * words) AS part
  FROM placed p JOIN cuts c ON p.source IS NOT DISTINCT FROM c.source,
    unnest(range(start // words, (start + size - 1) // words + 1)) AS r(block) WHERE size > 0
),
taken AS (
  SELECT c.doc_id, CAST(sum(part * times) AS BIGINT) AS taken FROM cut c
  JOIN turns t ON c.source IS NOT DISTINCT FROM t.source AND c.block = t.block GROUP BY 1
)
SELECT p.doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN taken USING (doc_id)
"""

_ORACLES["op10_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (
  SELECT page_id, body, octet_length(encode(body)) AS n, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((('0x' || substr(sha1(body) || '0', CAST(i * 5 // 4 AS INTEGER) + 1, 2))::INTEGER
      >> CAST(3 - (i * 5) % 4 AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS digest
  FROM payloads
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM digests WINDOW w AS (PARTITION BY body)
"""

_ORACLES["op7_doubling"] = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS win FROM docs, unnest(range(1, len(w) - 33)) AS r(i)
),
repeated AS (SELECT doc_id, i FROM windows WHERE win IN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1)),
removed AS (SELECT DISTINCT doc_id, j FROM repeated, unnest(range(i, i + 35)) AS r(j)),
kept AS (
  SELECT d.doc_id, string_agg(w[j], ' ' ORDER BY j) AS words, count(*) AS n
  FROM docs d, unnest(range(1, len(w) + 1)) AS r(j) ANTI JOIN removed x ON x.doc_id = d.doc_id AND x.j = r.j GROUP BY d.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

# The checksum of a decimal number, bit by bit: an odd remainder is shifted and combined with a fixed value.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
    range(1, length(CAST({0} AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST({0} AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""


def _hashed(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_LEAF = " || ".join(_hashed(c) for c in ("doc_id", "source", "lang", "n_chars"))

_ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS size
  FROM (SELECT doc_id, source, sha256({_LEAF} || {_hashed('text')}) AS leaf,
          sha256({_LEAF} || {_hashed("replace(text, chr(10), '')")}) AS other, {_CRC32.format('doc_id')} % 2 = 0 AS chosen FROM documents)
),
nodes AS (
  SELECT source, 0 AS level, place, size, leaf AS h FROM leaves
  UNION ALL
  SELECT source, level + 1, place // 3, (size + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM nodes
  WHERE size > 1 GROUP BY source, level, place // 3, size
),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS size
  FROM nodes WHERE size = 1
),
tops AS (
  SELECT 0 AS level, place, size, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (size + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM tops
  WHERE size > 1 GROUP BY level, place // 3, size
),
roots AS (SELECT h AS root FROM tops WHERE size = 1),
runs AS (
  SELECT source, level, place // 3 AS run, list(h ORDER BY place) AS hs FROM nodes WHERE size > 1 GROUP BY ALL
),
top_runs AS (SELECT level, place // 3 AS run, list(h ORDER BY place) AS hs FROM tops WHERE size > 1 GROUP BY ALL),
climb AS (
  SELECT row_number() OVER () AS id, doc_id, source, leaf, 0 AS level, place, size, false AS upper, '' AS proof,
    CASE WHEN chosen THEN other ELSE leaf END AS folded FROM leaves
  UNION ALL
  SELECT c.id, c.doc_id, c.source, c.leaf, CASE WHEN c.size = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.size = 1 THEN s.place ELSE c.place // 3 END, CASE WHEN c.size = 1 THEN s.size ELSE (c.size + 2) // 3 END,
    c.size = 1 OR c.upper,
    proof || coalesce(array_to_string(list_filter(coalesce(r.hs, t.hs), lambda x, i: i <> c.place % 3 + 1), ''), ''),
    CASE WHEN c.size = 1 THEN folded ELSE sha256(array_to_string(
      list_transform(coalesce(r.hs, t.hs), lambda x, i: CASE WHEN i = c.place % 3 + 1 THEN folded ELSE x END), '')) END
  FROM climb c
  LEFT JOIN runs r ON NOT c.upper AND c.size > 1 AND r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.place // 3
  LEFT JOIN top_runs t ON c.upper AND c.size > 1 AND t.level = c.level AND t.run = c.place // 3
  LEFT JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
  WHERE NOT (c.upper AND c.size = 1)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb JOIN subroots s ON s.source IS NOT DISTINCT FROM climb.source CROSS JOIN roots WHERE upper AND climb.size = 1
"""

_ORACLES["op11_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT c, {_CRC32.format('c')} % 6 AS h FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, role, text FROM (
    SELECT v.c, 0 AS part, t.p, role, text FROM convs v JOIN turns t ON t.c = v.c - v.c % 100 AND t.p <= v.h
    UNION ALL SELECT v.c, 1, t.p, role, text FROM convs v JOIN turns t ON t.c = v.c AND t.p > v.h)
),
steps AS (
  SELECT c, 0 AS d, '' AS node, 0 AS chars FROM convs
  UNION ALL SELECT c, d, md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '')
    OVER (PARTITION BY c ORDER BY d)), length(text) FROM rebuilt
),
paths AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY c) AS is_end FROM steps),
nodes AS (
  SELECT d, node, any_value(parent) AS parent, min(c) AS c, count(*) AS n, any_value(chars) AS chars,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end) AS ends
  FROM paths GROUP BY d, node
),
families AS (SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
subtrees AS (
  SELECT a.d, a.node, sum((v.n - 1) * v.chars) AS saved, count(*) FILTER (f.n_children IS NULL) AS leaves
  FROM nodes v JOIN paths a ON a.c = v.c AND a.d <= v.d LEFT JOIN families f ON f.d = v.d AND f.node = v.node GROUP BY ALL
)
SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM nodes x JOIN subtrees s ON s.d = x.d AND s.node = x.node LEFT JOIN families f ON f.d = x.d AND f.node = x.node
LEFT JOIN nodes p ON p.d = x.d - 1 AND p.node = x.parent
"""

_ORACLES["op13_superminhash"] = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS gram
  FROM docs, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS r(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)
),
reach AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(seen) AS component_id,
  doc_id = min(seen) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
