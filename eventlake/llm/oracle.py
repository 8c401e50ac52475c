"""DuckDB statements for the text operators that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BENCH_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(LOWER.format("coalesce(text, '')"))

CONTAMINATION = f"""
WITH item AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {BENCH_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS width, array_to_string(w[i:i + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, row_number() OVER () AS nr, {BENCH_WORDS} AS w FROM documents),
widths AS (SELECT DISTINCT width FROM windows),
spans AS (
  SELECT nr, i, width, array_to_string(w[i:i + width - 1], ' ') AS words
  FROM (SELECT nr, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM doc, widths WHERE len(w) >= width)
),
found AS (SELECT nr, i, s.width, item_id FROM spans s JOIN windows v ON s.width = v.width AND s.words = v.words),
hit AS (SELECT nr, count(DISTINCT p) AS n_hit FROM (SELECT nr, unnest(range(i, i + width)) AS p FROM found) GROUP BY nr),
items AS (SELECT nr, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT nr, item_id FROM found) GROUP BY nr)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (nr) LEFT JOIN items USING (nr)
"""

ESCAPED = r"regexp_replace({}, '<\|(\\*)(im_start|im_sep|im_end)\|>', '<|\\\1\2|>', 'g')"
CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) r(i)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({ESCAPED.format('role')}) + length({ESCAPED.format('text')}) + 32)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

JACCARD = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, row_number() OVER () AS nr, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS MATERIALIZED (
  SELECT doc_id, nr, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS s FROM doc
),
tokens AS MATERIALIZED (SELECT doc_id, nr, len(s) AS n, unnest(s) AS t FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.nr <> b.nr
  GROUP BY a.nr, b.nr, a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, (SELECT min(b) FROM reach WHERE reach.a = doc_id)) AS component_id FROM sets
"""

LINES = f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS nr, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, nr, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line,
    {LOWER.format("trim(unnest(lines), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM doc
),
common AS (SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, c.key IS NOT NULL AND l.doc_id <> c.keeper AS gone FROM line l LEFT JOIN common c ON l.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY nr, doc_id
"""

CRC_TABLE = """RECURSIVE crc(i, bit, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, bit + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM crc WHERE bit < 8
),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM crc WHERE bit = 8),
"""

TRIE = f"""
WITH {CRC_TABLE}
turn_rows AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL
),
conv AS (
  SELECT conv_id, list(said ORDER BY pos) AS own,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) % 9 AS h
  FROM turn_rows, crc_table GROUP BY conv_id, t
),
built AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[:c.h], c.own[c.h + 1:]) AS turns
  FROM conv c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 5
),
member AS MATERIALIZED (
  SELECT conv_id, d AS depth, sha256(turns[:d]::JSON::VARCHAR) AS node, CASE WHEN d > 0 THEN sha256(turns[:d - 1]::JSON::VARCHAR) END AS parent,
    CASE WHEN d > 0 THEN strlen(turns[d].text) ELSE 0 END AS bytes, d = len(turns) AS ended
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)
),
node AS MATERIALIZED (
  SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * bytes AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM member GROUP BY node, parent, depth, bytes
),
kids AS MATERIALIZED (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
under AS (
  SELECT m.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum(v.saved)::BIGINT AS saved_tokens
  FROM node v JOIN member m ON m.conv_id = v.conv_id AND m.depth <= v.depth LEFT JOIN kids k ON k.node = v.node GROUP BY m.node
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, u.n_leaves, u.saved_tokens, v.ends_sha256
FROM node v JOIN under u ON u.node = v.node LEFT JOIN kids k ON k.node = v.node LEFT JOIN node p ON p.node = v.parent
"""

MIDDLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents
),
numbered AS (
  SELECT doc_id, text, w, len(w) AS n, ('0x' || hex[1:8])::BIGINT % (len(w) + 1) AS c1, ('0x' || hex[9:16])::BIGINT % (len(w) + 1) AS c2,
    text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || hex[17:24])::BIGINT % 100 >= 50 AS stays, ('0x' || hex[25:32])::BIGINT % 100 < 80 AS spm
  FROM drawn
),
cut AS (
  SELECT doc_id, text, n, CASE WHEN stays THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(w[:least(c1, c2)], '') AS prefix, array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
    array_to_string(w[greatest(c1, c2) + 1:], '') AS suffix FROM numbered
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM cut
"""

STATEMENTS = {
    "op5_benchmark_decontamination": CONTAMINATION,
    "op8_ngram_jaccard_join": JACCARD,
    "op9_chat_formatting": CHAT,
    "op11_line_dedup": LINES,
    "op12_conversation_prefix_trie": TRIE,
    "op13_fill_in_middle": MIDDLE,
}


def all_sql() -> dict[str, str]:
    return dict(STATEMENTS)
