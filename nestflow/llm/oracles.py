"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (
  SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest,
         max(page_id) OVER (PARTITION BY b) AS keep
  FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM d
"""

OP5 = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS s, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM iw WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, widths WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.k, p.n, v.item_id FROM places p JOIN win v ON p.s = v.s AND p.n = v.n),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN words h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP7 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_SPACE}) <> '') AS lines
  FROM documents),
win AS (
  SELECT doc_id, k, array_to_string(w[k:k + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS k FROM t WHERE len(w) >= 8)),
twice AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(k, k + 8)) AS i FROM twice) GROUP BY doc_id),
s AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^!?]', '', 'g')) AS marks,
         length(regexp_replace(t, '[^\p{{L}}\p{{M}}]', '', 'g')) AS letters
  FROM t LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 5 * n_symbols > n_words OR (n_dup_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines)
            OR 2 * letters < word_chars OR word_chars > 25 * n_words OR 3 * marks > n_words) AS kept
FROM b
"""


def _escaped(text: str) -> str:
    out = rf"replace({text}, '\', '\\')"
    for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


OP9 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS first FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length({_escaped("text")}) + CASE WHEN first THEN length('<|role|><|text|><|end|>') + length({_escaped("role")})
                                              ELSE length('<|sep|>') END) AS formatted_chars
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars
FROM g
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
d AS (SELECT row, doc_id, w, len(w)::BIGINT AS n FROM w WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM d),
tf AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
q AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), total),
scored AS (
  SELECT item, item_id, row, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term) JOIN d USING (row), total
  GROUP BY item, item_id, row, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, row) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

#: CRC-32 of the ASCII text of a number, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT + z))), 4294967295::BIGINT)"""

OP13 = rf"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations GROUP BY conv_id),
h AS (SELECT conv_id, turns, conv_id - conv_id % 20 AS base, ({_CRC32} % 4)::BIGINT AS h FROM own),
built AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:len(h.turns)]) AS turns
  FROM h LEFT JOIN own b ON b.conv_id = h.base),
node AS (
  SELECT key, len(key) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '') AS ends
  FROM (SELECT conv_id, turns[1:d] AS key, d = len(turns) AS ended FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built))
  GROUP BY key),
up AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (
  SELECT n.*, coalesce(up.n_children, 0) AS n_children,
         CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(n.key[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS tokens
  FROM node n LEFT JOIN up ON up.key = n.key),
below AS (
  SELECT key[1:d] AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(tokens) AS saved_tokens
  FROM (SELECT key, n_children, tokens, unnest(range(0, depth + 1)) AS d FROM full_node) GROUP BY 1)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_node f JOIN below b ON b.key = f.key LEFT JOIN node p ON f.depth > 0 AND p.key = f.key[1:f.depth - 1]
"""

LLM_ORACLES = {
    "op3_warc": OP3,
    "op5_decontamination": OP5,
    "op7_quality_rules": OP7,
    "op9_chat_formatting": OP9,
    "op11_ranked_search": OP11,
    "op13_prefix_trie": OP13,
}
