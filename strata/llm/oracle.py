"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from strata.llm.license_scan import TEMPLATES

# Words of the decontamination contract, over text with A-Z lower-cased.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP1 = rf"""
WITH item AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS size FROM item WHERE len(w) > 0),
pattern AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
word AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
hit AS (
  SELECT x.r, x.i, x.size, pattern.item_id
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM word, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size) x
  JOIN pattern ON pattern.size = x.size AND pattern.p = array_to_string(x.w[x.i:x.i + x.size - 1], ' ')),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS j FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM word LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

# Words of the other contracts: runs of anything but the six ASCII white-space characters.
_SPACED = r"'[^\x20\x09-\x0D]+'"

OP3 = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host, md5(coalesce(text, '')) AS k,
         regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
gram AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM doc)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM gram) WHERE n > 1),
marked AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
line AS (
  SELECT r, host, k, line, regexp_extract_all(line, {_SPACED}) AS w
  FROM (SELECT r, host, k, unnest(lines) AS line FROM doc) WHERE regexp_matches(line, {_SPACED})),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM line GROUP BY r),
own AS (
  SELECT DISTINCT host, k, len(w) AS n,
         translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line FROM line),
host AS (SELECT host, count(DISTINCT k) AS n_docs FROM doc GROUP BY host),
frequent AS (
  SELECT host, line FROM (SELECT host, line, count(*) AS n FROM own GROUP BY ALL) JOIN host USING (host)
  WHERE n >= 20 AND n > 0.05 * n_docs),
share AS (
  SELECT own.host, own.k, sum(n) AS n, sum(CASE WHEN frequent.line IS NULL THEN 0 ELSE n END) AS gone
  FROM own LEFT JOIN frequent ON own.host = frequent.host AND own.line = frequent.line GROUP BY ALL),
depleted AS (SELECT host, k FROM share WHERE gone > 0 AND (n - gone < 0.3 * n OR n - gone < 50)),
counted AS (
  SELECT doc.r, doc_id, host, k, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM doc LEFT JOIN dup USING (r) LEFT JOIN marked USING (r)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (SELECT count(*) FROM depleted d WHERE d.host = failed.host AND d.k = failed.k) = 0 AS kept
FROM failed
"""

OP5 = """
WITH page AS (
  SELECT row_number() OVER () AS r, page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
ranked AS (
  SELECT *, row_number() OVER same AS k, first_value(page_id) OVER same AS first_page FROM page
  WINDOW same AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN first_page END AS refers_to
FROM ranked
"""


def _spans(kind: int, pattern: str, test: str, value: str = "m") -> str:
    """SELECT of (r, start, kind, end, value): the text's split by the pattern gives the gaps before its matches."""
    return f"""
SELECT r, CAST(stop - length(m) AS BIGINT) AS start, {kind} AS kind, CAST(stop AS BIGINT) AS stop, {value} AS value FROM (
  SELECT r, found[i] AS m, length(array_to_string(found[:i], '') || array_to_string(gaps[:i], '')) AS stop
  FROM (SELECT r, found, gaps, unnest(range(1, len(found) + 1)) AS i
        FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM doc)))
WHERE {test}"""


def _either_case(word: str) -> str:
    """A word in either case of its ASCII letters; case folding would take further letters for them."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_VALUE = f"regexp_extract(m, '{_ASSIGN}', 2)"
_MIXED = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"

OP8 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
found AS (
{_spans(0, _ASSIGN, f"length({_VALUE}) >= 6", _VALUE)} UNION ALL
{_spans(1, "AKIA[A-Z0-9]{16,}", "true")} UNION ALL
{_spans(2, "[0-9a-f]{24,}", "true")} UNION ALL
{_spans(3, "[A-Za-z0-9+/_-]{20,}={0,2}", _MIXED)}),
owned AS (
  SELECT value, count(*) AS n_repositories, count(DISTINCT owner) AS n_owners
  FROM (SELECT value, md5(text), min(coalesce(source, '')) AS owner FROM found JOIN doc USING (r) GROUP BY ALL) GROUP BY value),
judged AS (
  SELECT *, n_owners <= 2 AND n_repositories <= 9 AS live, ['assign', 'access', 'hex', 'live'][kind + 1] || ':' || start || ':' || stop AS one
  FROM found JOIN owned USING (value) WHERE kind < 3 OR (n_owners <= 2 AND n_repositories <= 9)),
total AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(one, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(one, ',' ORDER BY start, kind) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM doc LEFT JOIN total USING (r)
"""



def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TEMPLATES = ", ".join(
    f"({i}, '{t.label}', {str(t.base).lower()}, {_list(t.words)}, {t.key_at}, {_list(t.words[t.key_at:t.key_at + t.key_size])})" for i, t in enumerate(TEMPLATES))

OP11 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
template(id, label, base, words, key_at, key) AS (VALUES {_TEMPLATES}),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM doc),
place AS (
  SELECT r, w, label, base, words, key_at, i - 1 AS start FROM word JOIN template ON x = key[1] JOIN doc USING (r)
  WHERE w[i:i + len(key) - 1] = key),
scored AS (
  SELECT r, label, base, start,
         len(list_filter(range(1, len(words) + 1), lambda k: start - key_at + k >= 1 AND w[greatest(start - key_at + k, 1)] = words[k])) / len(words) AS score
  FROM place),
total AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM scored GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM doc LEFT JOIN total USING (r)
"""

OP12 = """
WITH vec AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
  FROM vec a, vec b WHERE a.vec_id % 50 = 0 AND a.r <> b.r),
positive AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k
  FROM scored WHERE own = label QUALIFY k <= 5),
negative AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY r, k ORDER BY score DESC, vec_id) AS rank
  FROM positive JOIN (SELECT r, own, label, vec_id, score FROM scored) USING (r)
  WHERE own <> label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negative
"""

_TURN = "md5(strlen(role) || ':' || role || text)"
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"
_CRC_STEP = "xor(c >> 8, crc.entries[(xor(c, ord(x)) & 255) + 1])"

OP13 = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS entries),
turns AS (
  SELECT conv_id, strlen(text) AS bytes, {_TURN} AS turn_key, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN}) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
conv AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, len,
         xor(list_reduce(string_split(CAST(conv_id AS VARCHAR), ''), lambda c, x: {_CRC_STEP}, 4294967295), 4294967295) % 9 AS h
  FROM (SELECT conv_id, count(*) AS len FROM turns GROUP BY conv_id), crc),
plan AS (SELECT c.conv_id, c.base, c.h, coalesce(least(c.h, b.len), 0) AS kept FROM conv c LEFT JOIN conv b ON b.conv_id = c.base),
rebuilt AS (
  SELECT p.conv_id, i AS d, bytes, turn_key FROM plan p JOIN turns t ON t.conv_id = p.base AND i <= p.h UNION ALL
  SELECT p.conv_id, i - p.h + p.kept, bytes, turn_key FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND i > p.h),
path AS (
  SELECT conv_id, d, bytes, md5(string_agg(turn_key, '') OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM rebuilt UNION ALL
  SELECT conv_id, 0, 0, '' FROM conv),
node AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n, any_value(bytes) AS bytes FROM path GROUP BY d, key),
up AS (SELECT p.d, p.key, node.d AS below, node.conv_id, (n - 1) * node.bytes AS saved FROM node JOIN path p ON p.conv_id = node.conv_id AND p.d <= node.d),
child AS (SELECT d, key, count(*) FILTER (below = d + 1) AS n_children, sum(saved) AS saved FROM up GROUP BY d, key),
leaf AS (SELECT conv_id, d AS below FROM node JOIN child USING (d, key) WHERE n_children = 0),
leaves AS (SELECT up.d, key, count(*) AS n_leaves FROM up JOIN leaf USING (conv_id, below) GROUP BY up.d, key),
ends AS (
  SELECT d, key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id) JOIN path USING (conv_id, d) GROUP BY d, key)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, n_children, n_leaves, CAST(child.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN child ON child.d = node.d AND child.key = node.key JOIN leaves ON leaves.d = node.d AND leaves.key = node.key
LEFT JOIN ends ON ends.d = node.d AND ends.key = node.key
LEFT JOIN path own ON own.conv_id = node.conv_id AND own.d = node.d - 1
LEFT JOIN node parent ON parent.d = own.d AND parent.key = own.key
"""

ORACLE_SQL = {
    "op13_conversation_trie": OP13,
    "op12_hard_negatives": OP12,
    "op11_license_scan": OP11,
    "op5_warc_round_trip": OP5,
    "op8_secret_scan": OP8,
    "op3_quality_rules": OP3,
    "op1_benchmark_decontamination": OP1,
}
