"""The corpus queries in SQL, where SQL expresses the whole result."""

from __future__ import annotations

#: CRC-32 without a built-in: a table from its rule (reversed polynomial 0xEDB88320), then a fold over bytes.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), LAMBDA b: list_reduce([b::BIGINT] || list_transform(range(8), LAMBDA k: 0::BIGINT),
    LAMBDA c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``t`` of crc_table is in scope."""
    taken = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), LAMBDA h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce([4294967295] || {taken}, LAMBDA c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"


def _field(column: str) -> str:
    value = f"({column})::VARCHAR"
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


#: source -1 is the tree over the sources; sources are numbered in their order.
MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s, count(*) AS n FROM documents GROUP BY source
),
leaves AS (
  SELECT d.doc_id, s.s, s.n, {_leaf("d.text")} AS leaf,
    CASE WHEN {_crc("d.doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(d.text, chr(10), '')")} ELSE {_leaf("d.text")} END AS tampered,
    row_number() OVER (PARTITION BY s.s ORDER BY d.doc_id NULLS FIRST) - 1 AS r
  FROM (SELECT doc_id, source, lang, n_chars, text FROM documents) d
  JOIN (SELECT source AS own, s, n FROM sources) s ON d.source IS NOT DISTINCT FROM s.own, crc_table
),
nodes AS (
  SELECT s, 0 AS level, r AS pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT s, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY s, level, pos // 3, n
),
subroots AS (SELECT s, max(level) AS height, any_value(digest) AS digest FROM nodes WHERE n = 1 GROUP BY s),
over AS (
  SELECT 0 AS level, s AS pos, (SELECT count(*) FROM subroots) AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM over WHERE n > 1 GROUP BY level, pos // 3, n
),
root AS (SELECT digest AS root FROM over WHERE n = 1),
places AS (
  SELECT doc_id, s, r, leaf, tampered, u.height, u.digest AS subroot FROM leaves JOIN subroots u USING (s)
),
below AS (
  SELECT p.s, p.r, n.level, n.pos, n.digest, sign(n.pos - p.r // (3::BIGINT ** n.level)::BIGINT) AS side
  FROM places p JOIN nodes n ON n.s = p.s AND n.level < p.height
    AND n.pos // 3 = p.r // (3::BIGINT ** (n.level + 1))::BIGINT
),
above AS (
  SELECT p.s, p.r, p.height + o.level AS level, o.pos, o.digest, sign(o.pos - p.s // (3::BIGINT ** o.level)::BIGINT) AS side
  FROM places p JOIN over o ON o.n > 1 AND o.pos // 3 = p.s // (3::BIGINT ** (o.level + 1))::BIGINT
),
way AS (
  SELECT s, r, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (side < 0), '') AS lefts,
    coalesce(string_agg(digest, '' ORDER BY pos) FILTER (side > 0), '') AS rights
  FROM (SELECT * FROM below UNION ALL SELECT * FROM above) GROUP BY s, r, level
),
proofs AS (SELECT s, r, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof_sha256 FROM way GROUP BY s, r),
fold AS (
  SELECT s, r, 0 AS level, tampered AS digest FROM places
  UNION ALL
  SELECT f.s, f.r, f.level + 1, sha256(w.lefts || f.digest || w.rights) FROM fold f JOIN way w USING (s, r, level)
),
folded AS (SELECT s, r, arg_max(digest, level) AS folded_root FROM fold GROUP BY s, r)
SELECT p.doc_id, p.leaf, p.subroot, root.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
  f.folded_root = root.root AS verified
FROM places p JOIN folded f USING (s, r) LEFT JOIN proofs q USING (s, r), root
"""

_LIKE_CONTROL = r"[\[<]\\*/?(?:(?:INST|SYS|OUT|ROLE)\]|s>)"
CHATS = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_LIKE_CONTROL}')) + CASE role
      WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 9
      ELSE length(role) + len(regexp_extract_all(role, '{_LIKE_CONTROL}')) + 17 END AS size
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(size) + 3)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _features(table: str, key: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    runs = " || ".join(
        f"list_transform(range(greatest(len(w) - {n - 1}, 0)), LAMBDA i: array_to_string(w[i + 1 : i + {n}], ' '))" for n in (1, 2, 3)
    )
    words = rf"SELECT {key} AS k, row_number() OVER () AS r, regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"
    return f"SELECT k, r, len(w) AS n_words, {runs} AS f FROM ({words})"


RESAMPLING = f"""
WITH {_CRC_TABLE},
d AS MATERIALIZED ({_features("documents", "doc_id")}),
b AS MATERIALIZED ({_features("benchmark", "item_id")}),
df AS MATERIALIZED (SELECT r, unnest(f) AS f FROM d),
bf AS (SELECT unnest(f) AS f FROM b),
known AS MATERIALIZED (
  SELECT f, {_crc("f")} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), crc_table
),
s AS (SELECT bucket, count(*) AS n_s FROM df JOIN known USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n_t FROM bf JOIN known USING (f) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(n_s), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(n_t), 0) FROM t)::DOUBLE AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(n_t, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(n_s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), total
),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM df JOIN known USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT k AS doc_id, r, n_words, len(f)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(k::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)
),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
"""

#: Direct pairs, then the least id reached, round by round.
VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
),
usable AS (
  SELECT vec_id, label, list_transform(e, LAMBDA x: x / sqrt(list_sum(list_transform(e, LAMBDA y: y * y)))) AS e, len(e) AS n FROM v
  WHERE label IS NOT NULL AND len(list_filter(e, LAMBDA x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND list_sum(list_transform(e, LAMBDA y: y * y)) > 0
),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.n = b.n AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) >= 0.98
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = v.vec_id
"""

#: Base 32 (its alphabet is a fixed value) of a SHA-1 digest: 160 bits as 32 groups of five.
ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha,
    regexp_extract(trim(url), '^[A-Za-z]+://([^/?#:]*)(:[0-9]+)?([^?#]*)([?][^#]*)?', ['host', 'port', 'path', 'query']) AS u
  FROM pages
),
digests AS (
  SELECT sha, array_to_string(list_transform(regexp_extract_all(bits, '.....'),
    LAMBDA g: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[('0b' || g)::INT + 1]), '') AS payload_digest
  FROM (
    SELECT sha, array_to_string(list_transform(regexp_extract_all(sha, '.'), LAMBDA h: lpad(bin(('0x' || h)::INT), 4, '0')), '') AS bits
    FROM (SELECT DISTINCT sha FROM p)
  )
),
latest AS (SELECT html, max(page_id) AS page FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> page THEN page END AS refers_to,
  lower(array_to_string(list_reverse(string_split(u.host, '.')), ',') || u.port || ')' ||
    CASE u.path WHEN '' THEN '/' ELSE u.path END || u.query) AS urlkey,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 315360000), '%Y%m%d%H%M%S') AS ts
FROM p JOIN digests USING (sha) JOIN latest USING (html)
"""

SQL = {
    "op3_metric_join": VECTORS,
    "op4_warc": ARCHIVES,
    "op11_merkle_manifest": MERKLE,
    "op12_chat_format": CHATS,
    "op13_resampling": RESAMPLING,
}
