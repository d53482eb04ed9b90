"""DuckDB SQL of the queries that SQL can express; the others are tested
against the tokenizer libraries, brute force or held-out rows."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_words('text', '[^\x20\x09-\x0D]+')} AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
joint AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM joint JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
    WHERE 100 * c >= 80 * (p.n + q.n - c)
),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT link.y, reach.y FROM reach JOIN link ON link.x = reach.x
),
least_of AS (SELECT x AS doc_id, MIN(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN least_of USING (doc_id)
"""

# Base 32 of the digest's 160 bits: five bits a character.
_BIT = "((instr('0123456789abcdef', substr(h, (5 * i + k) // 4 + 1, 1)) - 1) >> (3 - (5 * i + k) % 4)) & 1"
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
g AS (SELECT payload, MAX(page_id) AS keeper, sha1(payload) AS h FROM p GROUP BY payload),
d AS (
    SELECT payload, keeper,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST(list_sum(list_transform(range(0, 5), lambda k: ({_BIT}) << (4 - k))) AS INTEGER), 1)), '') AS digest
    FROM g
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN d USING (payload)
"""

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, {_words('text', '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM documents),
b AS (SELECT item_id, {_words('text', '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
),
spot AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))
),
hit AS (SELECT doc_id, i, n, item_id FROM spot JOIN win USING (n, g)),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
    SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

LEXICAL_SEARCH = rf"""
WITH d AS (SELECT doc_id, {_words('text', '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')} AS w FROM documents),
b AS (SELECT DISTINCT item_id, unnest({_words('text', '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')}) AS term FROM benchmark),
total AS (SELECT COUNT(*) AS n, CAST(SUM(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, term, COUNT(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
weight AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(total.n) + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY term
),
score AS (
    SELECT item_id, doc_id,
           CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * tf.n * total.n) // total.l)))) AS BIGINT) AS score
    FROM b JOIN tf USING (term) JOIN weight USING (term), total
    GROUP BY item_id, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS nth FROM score WHERE score > 0)
SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= 10
"""

# crc32 of a decimal number: 0xEDB88320 shifted in, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(0, 8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""

# Every run shares a gram of five words with itself one period on: pairs of
# equal grams, joined where they follow each other at one distance.
PERIODIC_RUNS = rf"""
WITH o AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC32} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM o),
d AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
        list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
    FROM a
),
gram AS (SELECT doc_id, i - 1 AS i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, n - 3)) AS i FROM d)),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS p FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
island AS (
    SELECT doc_id, p, MIN(i) AS s, MAX(i) + 5 + p - MIN(i) AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM pair) GROUP BY doc_id, p, k
),
run AS (
    SELECT doc_id, s, length, MIN(p) AS p FROM island
    WHERE length >= greatest(6, 4 * p) GROUP BY doc_id, s, length
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + length)) AS i FROM run),
left_ AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
),
best AS (
    SELECT doc_id, COUNT(*) AS n_runs, string_agg(s || ',' || length || ',' || p || chr(10), '' ORDER BY s, p) AS runs,
           arg_min(struct_pack(s := s, l := length, p := p), (-length, s, p)) AS r
    FROM run GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(r.s AS BIGINT) AS start, CAST(r.l AS BIGINT) AS length, CAST(r.p AS BIGINT) AS period,
       CAST(1000 * r.l // r.p AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(left_.text, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN left_ USING (doc_id)
"""

MERKLE = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents),
neighbours AS (
    SELECT doc_id, text, coalesce(lead(text) OVER o, first_value(text) OVER o) AS following
    FROM docs WINDOW o AS (ORDER BY doc_id DESC NULLS LAST)),
edits AS (
    SELECT *, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) AS edited FROM neighbours),
texts AS (
    SELECT DISTINCT sha256(text) AS k, text FROM (SELECT text FROM edits UNION ALL SELECT edited FROM edits)),
lines AS (
    SELECT k, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM texts),
pieces AS (
    SELECT k, p, list_transform(regexp_extract_all(line, '[^.!?]{1,96}[.!?]*|[.!?]+'), lambda x: sha256(x)) AS digests FROM lines),
paragraphs AS (
    SELECT k, p, sha256(coalesce(array_to_string(digests, ''), '')) AS digest,
           coalesce(array_to_string(list_transform(digests, lambda d: left(d, 6)), ''), '') AS short
    FROM pieces),
numbered AS (
    SELECT *, coalesce(count(*) FILTER (right(digest, 1) IN ('0', '8'))
                       OVER (PARTITION BY k ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM paragraphs),
sections AS (
    SELECT k, s, sha256(string_agg(digest, '' ORDER BY p)) AS digest, string_agg(short, ';' ORDER BY p) AS short
    FROM numbered GROUP BY k, s),
trees AS (
    SELECT k, sha256(string_agg(digest, '' ORDER BY s)) AS root, string_agg(short, '/' ORDER BY s) AS short
    FROM sections GROUP BY k),
leaves AS (
    SELECT k, leaf, count(*) AS n
    FROM (SELECT k, unnest(list_transform(digests, lambda d: left(d, 6))) AS leaf FROM pieces) GROUP BY k, leaf),
sizes AS (SELECT k, sum(n) AS n FROM leaves GROUP BY k),
keyed AS (
    SELECT doc_id, length(text) AS n_chars, sha256(text) AS own, sha256(edited) AS edited, sha256(following) AS following FROM edits),
pairs AS (SELECT own AS a, edited AS b FROM keyed UNION SELECT own, following FROM keyed),
shared AS (
    SELECT a, b, sum(least(x.n, y.n)) AS n
    FROM pairs JOIN leaves x ON x.k = a JOIN leaves y ON y.k = b AND y.leaf = x.leaf GROUP BY a, b),
alike AS (
    SELECT a, b, CASE WHEN a = b THEN 1.0::DOUBLE WHEN shared.n IS NULL THEN 0.0::DOUBLE
                      ELSE (2 * shared.n)::DOUBLE / (x.n + y.n)::DOUBLE END AS near
    FROM pairs LEFT JOIN shared USING (a, b) LEFT JOIN sizes x ON x.k = a LEFT JOIN sizes y ON y.k = b)
SELECT doc_id, n_chars, d.edited AS edited_sha256, t.root || '/' || t.short AS fingerprint,
       e.root || '/' || e.short AS edited_fingerprint, ne.near AS near_edited, nn.near AS near_next
FROM keyed d JOIN trees t ON t.k = d.own JOIN trees e ON e.k = d.edited
JOIN alike ne ON ne.a = d.own AND ne.b = d.edited JOIN alike nn ON nn.a = d.own AND nn.b = d.following
"""
