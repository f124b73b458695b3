"""DuckDB SQL twins of the corpus queries that SQL can express, over the whole tables."""

from __future__ import annotations

from html.entities import html5

from reqlens.llm import chat_format as C
from reqlens.llm import decontamination as D
from reqlens.llm import mixing as M
from reqlens.llm import quality_rules as R
from reqlens.llm import warc_derivatives as A

WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[ \t\n\x0b\f\r]+'), lambda x: x <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {WORDS.format("text")} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS s FROM d, unnest(range(1, len(words) - 18)) AS t(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
covered AS (SELECT DISTINCT doc_id, i + j AS at FROM later, unnest(range(20)) AS t(j)),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.at) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM d) e
  ANTI JOIN covered c ON e.doc_id = c.doc_id AND e.at = c.at GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

_MATCHES = f"""
d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_TERMS} AS w FROM benchmark),
asked AS (SELECT DISTINCT item, w[i:i + 9] AS s FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(s) AS n FROM asked),
spots AS (SELECT doc_id, n, i, w[i:i + n - 1] AS s FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT doc_id, n, i, item, spots.s FROM spots JOIN asked ON spots.s = asked.s)"""

DECONTAMINATION = f"""
WITH {_MATCHES},
places AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(n)) AS t(j) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS ids FROM hits GROUP BY doc_id),
occ AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS i FROM d),
often AS (SELECT term, count(*) AS n FROM occ GROUP BY term),
rare AS (SELECT s, list(x.term ORDER BY coalesce(n, 0), x.term)[1:{D.NEAR_TERMS}] AS t
         FROM (SELECT DISTINCT s, unnest(s) AS term FROM asked) x LEFT JOIN often ON x.term = often.term GROUP BY s),
leads AS (SELECT s, t, doc_id, i FROM rare JOIN occ ON occ.term = t[1]),
others AS (SELECT s, doc_id, i, unnest(t[2:]) AS term, len(t) AS n FROM leads),
met AS (SELECT s, o.doc_id, o.i FROM others o JOIN occ ON occ.doc_id = o.doc_id AND occ.term = o.term AND abs(occ.i - o.i) <= {D.NEAR_SPAN}
        GROUP BY s, o.doc_id, o.i HAVING count(DISTINCT o.term) = any_value(n) - 1
        UNION ALL SELECT s, doc_id, i FROM leads WHERE len(t) = 1),
near AS (SELECT doc_id, count(DISTINCT item) AS n FROM (SELECT DISTINCT doc_id, s FROM met EXCEPT SELECT doc_id, s FROM hits) m
         JOIN asked ON m.s = asked.s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(near.n, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN items ON d.doc_id = items.doc_id LEFT JOIN near ON d.doc_id = near.doc_id
"""


def _chars(text: str, chars: str) -> str:
    quoted = " || ".join(f"chr({ord(c)})" for c in chars)
    return f"CAST(len({text}) - len(translate({text}, {quoted}, '')) AS BIGINT)"


def _divergence(p: str, q: str) -> str:
    share = lambda h: f"list_transform({h}, lambda x: x / nullif(list_sum({h}), 0.0))"
    pairs = f"list_zip({share(p)}, {share(q)})"
    part = lambda i: f"CASE WHEN x[{i}] > 0 THEN x[{i}] * log2(x[{i}] / ((x[1] + x[2]) / 2)) ELSE 0.0 END"
    return f"sqrt(greatest(list_sum(list_transform({pairs}, lambda x: (({part(1)}) + ({part(2)})) / 2)), 0.0))"


_BINS = {"chars": 6, "common": R.COMMON + 1}
_SUMS = ", ".join(f"[{', '.join(f'CAST(sum({c}[{i + 1}]) AS DOUBLE)' for i in range(n))}] AS ref_{c}" for c, n in _BINS.items())

QUALITY_RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS key, {WORDS.format("text")} AS words,
             list_transform(list_filter({WORDS.format("text")}, lambda x: len(x) <= {R.WORD_LENGTH}), lambda x: lower(x)) AS lowered
      FROM documents),
short AS (SELECT key, word, count(*) AS n FROM (SELECT key, unnest(lowered) AS word FROM d) GROUP BY ALL),
common AS (SELECT key, list(word ORDER BY n DESC, word) AS common FROM (
  SELECT * FROM short QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, word) <= {R.COMMON}) GROUP BY key),
w5 AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(words) - 3)) AS t(i)),
twice AS (SELECT r, i FROM w5 QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
repeats AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, unnest(range(5)) AS t(j) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^ \\t\\n\\x0b\\f\\r]') GROUP BY r),
counted AS (
  SELECT d.r, doc_id, d.key, CAST(len(words) AS BIGINT) AS n_words, CAST(len(text) AS BIGINT) AS n_chars,
         len(text) - {_chars("text", R.SPACES)} AS word_chars, {_chars("text", R.SYMBOLS)} AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         {_chars("text", R.UPPER)} AS upper, {_chars("text", R.DIGITS)} AS digits, {_chars("text", R.PUNCTUATION)} AS marks,
         list_transform(common, lambda c: len(list_filter(lowered, lambda x: x = c))) AS heads
  FROM d LEFT JOIN common ON d.key = common.key LEFT JOIN repeats ON d.r = repeats.r LEFT JOIN lines ON d.r = lines.r),
histograms AS (
  SELECT *, [upper, digits, marks, n_symbols, n_chars - word_chars, word_chars - upper - digits - marks - n_symbols] AS chars,
         list_append(heads, n_words - list_sum(heads)) AS common,
         n_words < {R.LEAST_WORDS} OR 100 * n_repeat_words > {R.MOST_REPEATED} * n_words AS base_failed FROM counted),
refs AS (SELECT key, {_SUMS} FROM histograms WHERE NOT base_failed GROUP BY key),
judged AS (SELECT h.*, len(bin(n_words)) AS class, {_divergence("CAST(chars AS DOUBLE[])", "ref_chars")} AS dc,
                  CAST(floor(1000 * {_divergence("CAST(common AS DOUBLE[])", "ref_common")}) AS BIGINT) AS dw
           FROM histograms h LEFT JOIN refs ON h.key = refs.key),
usual AS (SELECT key, class, dw, row_number() OVER (PARTITION BY key, class ORDER BY dw) AS place, count(*) OVER (PARTITION BY key, class) AS total
          FROM judged WHERE NOT base_failed AND n_words >= {R.MIN_WORDS}),
marks AS (SELECT key, class, min(dw) FILTER (2 * place >= total) AS median, min(dw) FILTER (4 * place >= total) AS lower
          FROM usual WHERE total >= {R.ENOUGH} GROUP BY ALL),
limits AS (SELECT key, class, median + {R.SPREADS} * greatest(median - lower, {R.LEAST_GAP}) AS most FROM marks)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(n_chars >= {R.MIN_CHARS} AND dc > {R.CHAR_LIMIT}, false)
       AND NOT coalesce(n_words >= {R.MIN_WORDS} AND dw > (SELECT max_by(most, l.class) FROM limits l WHERE l.key = j.key AND l.class <= j.class), false) AS kept
FROM judged j
"""

# Seats are found by ranking all quotients; the query ranks only those around the last seat.
SOURCE_MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS.format("text")}) AS BIGINT) AS size,
                  md5('{M.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS stop,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(stop) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
           FROM s WINDOW before AS (ORDER BY stop / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (SELECT source, source_size, least(CAST(stop AS DOUBLE), max(level) FILTER (level <= stop / w) OVER () * w) AS target,
                 round(sum(source_size) OVER () / {M.BLOCK})::BIGINT AS seats FROM levels),
quotas AS (SELECT source, least(count(*), 3 * ceil(any_value(source_size) / {M.BLOCK})::BIGINT) AS quota FROM (
  SELECT source, source_size, seats, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST, k) AS place
  FROM goals, unnest(range(1, seats + 1)) AS t(k) WHERE target > 0) WHERE place <= seats GROUP BY source),
cells AS (SELECT source, substr(h, 1, {M.SHARD_DIGITS}) AS shard, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
placed AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin FROM cells),
blocks AS (SELECT *, ceil(begin / {M.BLOCK})::BIGINT AS first, ceil((begin + words) / {M.BLOCK})::BIGINT - ceil(begin / {M.BLOCK})::BIGINT AS n FROM placed),
seated AS (SELECT source, shard, count(*) AS q FROM (
  SELECT b.source, shard, quota, row_number() OVER (PARTITION BY b.source ORDER BY n / (2 * k - 1) DESC, shard, k) AS place
  FROM blocks b JOIN quotas ON b.source IS NOT DISTINCT FROM quotas.source, unnest(range(1, 3 * n + 2)) AS t(k) WHERE n > 0) WHERE place <= quota GROUP BY ALL),
dealt AS (SELECT b.*, CASE WHEN n > 0 THEN coalesce(q, 0) // n ELSE 0 END AS each, CASE WHEN n > 0 THEN coalesce(q, 0) % n ELSE 0 END AS more,
                 CASE WHEN n > 0 THEN CAST('0x' || substr(md5('{M.SEED}/' || coalesce(b.source, '') || '/' || b.shard), 1, 12) AS BIGINT) % n ELSE 0 END AS start
          FROM blocks b LEFT JOIN seated ON b.source IS NOT DISTINCT FROM seated.source AND b.shard = seated.shard),
chosen AS (SELECT *, greatest(start + more - n, 0) AS past, coalesce(last_value(
             CASE WHEN n > 0 THEN each + CAST(more > 0 AND start + more >= n AS BIGINT) END IGNORE NULLS) OVER (
               PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS carried FROM dealt),
lined AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, substr(h, 1, {M.SHARD_DIGITS}) ORDER BY h, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS back FROM d),
spans AS (SELECT l.doc_id, l.size, l.source, c.*, c.begin + back AS lo, c.begin + back + size AS hi, c.first * {M.BLOCK} AS own
          FROM lined l JOIN chosen c ON l.source IS NOT DISTINCT FROM c.source AND substr(l.h, 1, {M.SHARD_DIGITS}) = c.shard)
SELECT doc_id, size, source_size, target, CAST(
  carried * greatest(least(hi, own) - lo, 0) + each * greatest(hi - greatest(lo, own), 0)
  + greatest(least(hi, own + least(start + more, n) * {M.BLOCK}) - greatest(lo, own + start * {M.BLOCK}), 0)
  + greatest(least(hi, own + past * {M.BLOCK}) - greatest(lo, own), 0) AS BIGINT) AS taken
FROM spans JOIN goals ON spans.source IS NOT DISTINCT FROM goals.source
"""

_MD5 = "md5({0})"


def _uuid(*parts: str) -> str:
    h = _MD5.format(" || '|' || ".join(parts))
    return (
        f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-8' || substr({h}, 18, 3)"
        f" || '-' || substr({h}, 21, 12) || '>'"
    )


# every named reference with its semicolon, from the language's own table
_NAMED = ", ".join(f"'&{k}': '{v.replace(chr(39), chr(39) * 2)}'" for k, v in html5.items() if k.endswith(";"))


def _decoded(text: str) -> str:
    """Named and numeric character references, each looked up by itself."""
    one = """CASE WHEN x[1] <> '&' OR len(x) < 3 THEN x
      WHEN regexp_full_match(x, '&#[0-9]+;') THEN chr(CAST(x[3:-2] AS INTEGER))
      WHEN regexp_full_match(x, '&#[xX][0-9a-fA-F]+;') THEN chr(CAST('0x' || x[4:-2] AS INTEGER))
      ELSE coalesce(named[x], x) END"""
    parts = f"regexp_extract_all({text}, '&[#0-9A-Za-z]+;|&|[^&]+')"
    return f"replace(array_to_string(list_transform({parts}, lambda x: {one}), ''), chr(160), ' ')"


def _plain(html: str) -> str:
    text = f"regexp_replace({html}, '(?s)<!--.*?(-->|\\z)', ' ', 'g')"
    for tag in A.RAW_TEXT:
        text = f"regexp_replace({text}, '(?is)<{tag}(\\s[^>]*)?>.*?(</{tag}\\s*>|\\z)', ' ', 'g')"
    for tag in A.HIDDEN:
        text = f"regexp_replace({text}, '(?is)<{tag}(\\s[^>]*)?>.*?</{tag}\\s*>', ' ', 'g')"
    text = f"regexp_replace({text}, '[ \\t\\r\\n\\f]+', ' ', 'g')"
    text = f"regexp_replace({text}, '(?i)</?({A.BREAKING})(\\s[^>]*)?/?>', chr(10), 'g')"
    text = _decoded(f"regexp_replace({text}, '<[!/?A-Za-z][^>]*>', '', 'g')")
    text = f"regexp_replace({text}, '[ \\t\\r\\f]*\\n[ \\t\\r\\n\\f]*', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({text}, '[ \\t\\r\\f]+', ' ', 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"


def _fields(**fields: str) -> str:
    lines = [
        f"coalesce('{name.replace('_', '-')}: ' || regexp_replace(CAST({value} AS VARCHAR), '[\\r\\n]+', ' ', 'g') || crlf, '')"
        for name, value in fields.items()
    ]
    return " || ".join(lines)


WARC_DERIVATIVES = f"""
WITH p AS (SELECT *, chr(13) || chr(10) AS crlf, coalesce(html, '') AS h, MAP {{{_NAMED}}} AS named FROM pages),
r AS (SELECT page_id, crlf, h, {_uuid("'response'", "CAST(page_id AS VARCHAR)", "coalesce(url, '')")} AS refers_to, url AS target_uri,
             'sha1:' || sha1(h) AS payload_digest, CAST(strlen(h) AS BIGINT) AS payload_length, {_plain("h")} AS text,
             nullif({_decoded("regexp_extract(h, '(?is)<title[^>]*>\\s*(.*?)\\s*</title', 1)")}, '') AS title,
             nullif(regexp_extract(h, '(?i)<html[^>]*\\slang=["'']?([A-Za-z-]+)', 1), '') AS language,
             len(regexp_extract_all(h, '(?i)<a\\s[^>]*href=')) AS links FROM p),
m AS (SELECT *, {_fields(title="title", language="language", outlinks="links", http_status="'200'", content_type="'text/html'", source_payload_length="payload_length", text_characters="len(text)")}
             || 'source-header: HTTP/1.1 200 OK' || crlf || 'source-header: Content-Type: text/html; charset=utf-8' || crlf
             || 'source-header: Content-Length: ' || payload_length || crlf AS facts FROM r),
both_kinds AS (
  SELECT page_id, crlf, refers_to, target_uri, payload_digest, 'conversion' AS record_type, 'text/plain; charset=utf-8' AS content_type, text AS block FROM m
  UNION ALL
  SELECT page_id, crlf, refers_to, target_uri, payload_digest, 'metadata', 'application/warc-fields', facts FROM m),
ids AS (SELECT *, {_uuid("record_type", "coalesce(refers_to, '')", "coalesce(target_uri, '')")} AS record_id,
               'sha1:' || sha1(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM both_kinds)
SELECT page_id, record_type, record_id, refers_to, target_uri, payload_digest, block_digest, content_length, '{A.VERSION}' || crlf || {_fields(
    WARC_Type="record_type", WARC_Record_ID="record_id", WARC_Date=f"'{A.NO_DATE}'", WARC_Target_URI="target_uri", WARC_Refers_To="refers_to",
    WARC_Refers_To_Target_URI="target_uri", WARC_Refers_To_Date=f"'{A.NO_DATE}'", WARC_Block_Digest="block_digest",
    WARC_Source_Payload_Digest="payload_digest", Content_Type="content_type", Content_Length="content_length")} AS headers, block
FROM ids
"""

#: crc32 of a decimal number: its bytes in turn, eight shifts each.
_CRC = """xor(list_reduce(
  list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
  lambda acc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(acc, byte)),
  CAST(4294967295 AS BIGINT)), 4294967295)"""

PREFIX_TRIE = f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
listed AS (
  SELECT conv_id, list(struct_pack(role := role, text := text)
         ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS turns FROM said GROUP BY conv_id),
heads AS (SELECT *, conv_id - conv_id % 5 AS base, {_CRC.format("conv_id")} % 9 AS h FROM listed),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM heads c LEFT JOIN listed b ON b.conv_id = c.base),
members AS (SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path FROM rebuilt, unnest(range(len(turns) + 1)) AS t(d)),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
  FROM members GROUP BY path, d),
kin AS (
  SELECT v.*, p.conv_id AS parent, (SELECT count(*) FROM nodes u WHERE u.d = v.d + 1 AND u.path[1:v.d] = v.path) AS n_children
  FROM nodes v LEFT JOIN nodes p ON p.d = v.d - 1 AND p.path = v.path[1:v.d - 1]),
below AS (
  SELECT path[1:k] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[d].text) END) AS saved_tokens
  FROM kin, unnest(range(d + 1)) AS t(k) GROUP BY path[1:k])
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM kin JOIN below USING (path)
"""

HARD_NEGATIVES = """
WITH r AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.k AS ak, a.vec_id AS anchor_id, b.k AS k, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.k <> b.k WHERE a.vec_id % 100 = 0),
pos AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.ak, p.k ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN pairs n ON p.ak = n.ak AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.ak, p.k ORDER BY n.score DESC, n.vec_id) <= 5
"""


def _escape(column: str) -> str:
    return f"regexp_replace(coalesce({column}, ''), '([<\\[])(\\\\*)(\\||/?s>|/?INST\\])', '\\1\\\\\\2\\3', 'g')"


CHAT_FORMAT = f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{C.CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{C.CONTROL_TEXT}'),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         '{C.TURN}' || {_escape("role")} || '{C.SAYS}' || {_escape("text")} || '{C.END}' AS formatted FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op2_benchmark_decontamination": DECONTAMINATION,
    "op5_warc_derivatives": WARC_DERIVATIVES,
    "op8_quality_rules": QUALITY_RULES,
    "op9_source_mixing": SOURCE_MIXING,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_chat_format": CHAT_FORMAT,
}
