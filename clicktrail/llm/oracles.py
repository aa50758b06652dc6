"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

import math

from clicktrail.llm import chat, mixing, secrets

WORD = r"[^\x20\x09-\x0D]+"

MIXING = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{mixing.SEED}' || chr(31) || coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(md5(text), '')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
rounds AS (
  SELECT 0 AS i, (SELECT sum(source_size)::BIGINT FROM sources) AS free, (SELECT sum(weight)::BIGINT FROM sources) AS weights
  UNION ALL
  SELECT i + 1,
         (SELECT sum(s.source_size)::BIGINT FROM sources s)
           - (SELECT coalesce(sum(3 * s.source_size), 0)::BIGINT FROM sources s WHERE 3 * s.source_size * r.weights < r.free * s.weight),
         (SELECT coalesce(sum(s.weight), 0)::BIGINT FROM sources s WHERE NOT 3 * s.source_size * r.weights < r.free * s.weight)
  FROM rounds r WHERE i < 30 AND r.weights > 0),
level AS (SELECT free, weights FROM rounds ORDER BY i DESC LIMIT 1),
budgets AS (
  SELECT source, source_size,
         CASE WHEN weights = 0 OR 3 * source_size * weights < free * weight THEN (3 * source_size)::DOUBLE
              ELSE (free * weight)::DOUBLE / weights::DOUBLE END AS target,
         CASE WHEN weights = 0 OR 3 * source_size * weights < free * weight THEN 3 * source_size
              ELSE free * weight // weights END AS budget
  FROM sources, level),
placed AS (
  SELECT s.*, b.source_size, b.target, b.budget, b.budget // greatest(b.source_size, 1) AS epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target, epochs::BIGINT AS epochs,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM placed
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e, len(embedding) AS dim FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND c.dim = q.dim)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

SUBSTRINGS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS ws FROM documents WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS seq FROM w, unnest(range(1, len(ws) - 11)) t(i) WHERE len(ws) >= 13),
firsts AS (SELECT seq, min(doc_id) AS first FROM windows GROUP BY seq HAVING min(doc_id) < max(doc_id)),
covered AS (
  SELECT DISTINCT doc_id, i + d AS n FROM windows JOIN firsts USING (seq), range(13) t(d) WHERE doc_id > first),
kept AS (
  SELECT l.doc_id, count(c.n) AS n_removed, string_agg(ws[i], ' ' ORDER BY i) FILTER (c.n IS NULL) AS kept
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.n = l.i
  GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN w USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

_ESCAPED = rf"regexp_replace(text, '{chat.ESCAPABLE}', '\1\2\\\3', 'g')"

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
rendered AS (
  SELECT *, '<s>' || CASE role WHEN 'user' THEN '[INST] ' || {_ESCAPED} || ' [/INST]'
                               WHEN 'system' THEN '[SYS] ' || {_ESCAPED} || ' [/SYS]'
                               WHEN 'assistant' THEN {_ESCAPED}
                               ELSE '[ROLE]' || regexp_replace(role, '{chat.ESCAPABLE}', '\1\2\\\3', 'g') || '[/ROLE]' || {_ESCAPED} END || '</s>' AS piece
  FROM turns),
per AS (
  SELECT conv_id, count(*) AS n_turns, list(role ORDER BY turn, role, text) AS roles,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         string_agg(piece, '' ORDER BY turn, role, text) AS formatted
  FROM rendered GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       length(formatted) AS formatted_chars,
       CASE WHEN roles = ['user', 'assistant'] THEN 'prompt'
            WHEN roles = ['system', 'user', 'assistant'] THEN 'instruction'
            WHEN len([r FOR r IN roles IF r NOT IN ('user', 'assistant', 'system')]) = 0 THEN 'conversations'
            ELSE 'messages' END AS layout
FROM per
"""

#: A SHA-1 sum has 40 hexadecimal and 32 base-32 digits: five bits are taken from the bits of the former.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + bits[5 * i + 1] * 16 + bits[5 * i + 2] * 8 + bits[5 * i + 3] * 4 + bits[5 * i + 4] * 2 + bits[5 * i + 5], 1), '' ORDER BY i) AS base32, first
  FROM (SELECT hex, min(page_id) AS first,
               flatten([[(v // 8) % 2, (v // 4) % 2, (v // 2) % 2, v % 2] FOR v IN
                        [position(c IN '0123456789abcdef') - 1 FOR c IN string_split(hex, '')]]) AS bits
        FROM p GROUP BY hex), range(32) t(i)
  GROUP BY hex, first)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, base32 AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS error
FROM p JOIN d USING (hex)
"""

LEAKS = rf"""
WITH items AS (
  SELECT item_id, ws, len(ws) AS n, least(5, len(ws)) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM benchmark)
  WHERE len(ws) > 0),
item_shingles AS (
  SELECT item_id, n, k, array_to_string(ws[i:i + k - 1], ' ') AS sh, count(*) AS c
  FROM items, unnest(range(1, n - k + 2)) t(i) GROUP BY ALL),
docs AS (
  SELECT doc_id, ws, len(ws) AS nw
  FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents)),
places AS (
  SELECT doc_id, nw, pos, k, array_to_string(ws[pos:pos + k - 1], ' ') AS sh
  FROM docs, (SELECT DISTINCT k FROM items), unnest(range(1, nw - k + 2)) t(pos) WHERE nw >= k),
starts AS (
  SELECT DISTINCT p.doc_id, s.item_id, s.n, s.k, least(s.n, p.nw) AS size, start
  FROM places p JOIN item_shingles s ON s.sh = p.sh AND s.k = p.k,
       unnest(range(greatest(pos - (s.n - s.k), 1), least(pos, greatest(p.nw - s.n + 1, 1)) + 1)) t(start)),
window_shingles AS (
  SELECT st.doc_id, st.item_id, st.n, st.k, st.size, st.start, array_to_string(d.ws[j:j + st.k - 1], ' ') AS sh, count(*) AS c
  FROM starts st JOIN docs d USING (doc_id), unnest(range(st.start, st.start + st.size - st.k + 1)) t(j) GROUP BY ALL),
scored AS (
  SELECT w.doc_id, w.item_id, w.start, w.size, sum(least(w.c, s.c))::BIGINT AS shared,
         (any_value(w.size - w.k + 1) + any_value(w.n - w.k + 1))::BIGINT AS total
  FROM window_shingles w JOIN item_shingles s ON s.item_id = w.item_id AND s.sh = w.sh
  GROUP BY w.doc_id, w.item_id, w.start, w.size),
alike AS (SELECT *, shared / (total - shared) AS similarity FROM scored WHERE 100 * shared >= 80 * (total - shared))
SELECT doc_id, item_id, similarity, (start - 1)::BIGINT AS start, size::BIGINT AS n_words, n_windows
FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id) AS n_windows,
             row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS place FROM alike)
WHERE place = 1
"""

LINES = """
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, pos, ls[pos:pos + 2] AS w FROM lines, unnest(range(1, len(ls) - 1)) t(pos)
  WHERE len(ls) >= 3 AND len([l FOR l IN ls[pos:pos + 2] IF trim(l, ' ') <> '']) > 0),
later AS (
  SELECT doc_id, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1),
covered AS (SELECT DISTINCT doc_id, pos + d AS n FROM later, range(3) t(d)),
kept AS (
  SELECT l.doc_id, count(c.n) AS n_removed, string_agg(ls[i], chr(10) ORDER BY i) FILTER (c.n IS NULL) AS kept
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM lines) l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.n = l.i
  GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The CRC is computed bit by bit into a table of 256, and byte by byte for each distinct feature.
RESAMPLING = rf"""
WITH RECURSIVE steps AS (
  SELECT b, b::BIGINT AS v, 0 AS i FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END, i + 1 FROM steps WHERE i < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE i = 8),
texts AS (
  SELECT false AS target, doc_id AS id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT true, item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
features AS (
  SELECT target, id, unnest(ws) AS f FROM texts
  UNION ALL
  SELECT target, id, ws[i] || ' ' || ws[i + 1] FROM texts, unnest(range(1, len(ws))) t(i)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT FOR i IN range(1, strlen(f) + 1)]),
                            lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), crc_table),
placed AS (SELECT target, id, bucket FROM features JOIN hashed USING (f)),
totals AS (SELECT count(*) FILTER (NOT target)::DOUBLE AS s, count(*) FILTER (target)::DOUBLE AS t FROM placed),
gains AS (
  SELECT bucket, floor(1000 * ln((count(*) FILTER (target) + 1)::DOUBLE * (any_value(s) + 10000)
                                 / ((count(*) FILTER (NOT target) + 1)::DOUBLE * (any_value(t) + 10000))))::BIGINT AS gain
  FROM placed, totals GROUP BY bucket),
weights AS (
  SELECT id AS doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE NOT target GROUP BY id),
scored AS (
  SELECT x.id AS doc_id, coalesce(len(ws), 0) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT
           + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || x.id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM texts x LEFT JOIN weights w ON w.doc_id = x.id WHERE NOT target),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_words::BIGINT AS n_words, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::DOUBLE FOR x IN embedding] AS e, len(embedding) AS dim FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND c.dim = a.dim),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
windowed AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM windowed WHERE rank <= 5
"""


def _log_tail(z: str) -> str:
    """Logarithm of the normal tail beyond z."""

    def upper(x: str) -> str:
        t = f"(1 / (1 + {secrets.TAIL_SCALE} * {x}))"
        series = "0"
        for c in reversed(secrets.TAIL):
            series = f"(({series} + {c}) * {t})"
        return f"(-{x} * {x} / 2 - {math.log(2 * math.pi) / 2!r} + ln({series}))"

    return f"(CASE WHEN {z} >= 0 THEN {upper(z)} ELSE ln(1 - exp({upper(f'(-{z})')})) END)"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_ENCODINGS = ", ".join(
    f"({n}, {_quoted(e.pattern)}, '{e.alphabet}', {len(e.alphabet) - 1}::DOUBLE, {e.excess!r}::DOUBLE, {e.changes!r}::DOUBLE, {e.random_changes!r}::DOUBLE)"
    for n, e in enumerate(secrets.ENCODINGS)
)
_PATTERNS = ((0, secrets.ASSIGN, 2), (1, secrets.ACCESS, 0), (2, secrets.HEX, 0), (3, secrets.TOKEN, 0))

SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(
    f"SELECT doc_id, {kind} AS kind, regexp_extract_all(text, {_quoted(p)}) AS ms, regexp_extract_all(text, {_quoted(p)}, {group}) AS vs, string_split_regex(text, {_quoted(p)}) AS gaps FROM texts"
    for kind, p, group in _PATTERNS
)}),
matched AS (
  SELECT doc_id, kind, ms[i] AS token, vs[i] AS value,
         (list_sum([length(g) FOR g IN gaps[1:i]]) + coalesce(list_sum([length(m) FOR m IN ms[1:i - 1]]), 0))::BIGINT AS start
  FROM found, unnest(range(1, len(ms) + 1)) t(i) WHERE len(ms) > 0),
base AS (SELECT doc_id, kind, start, start + length(token) AS stop FROM matched WHERE kind < 3 AND (kind > 0 OR length(value) >= {secrets.LEAST_VALUE})),
encodings(encoding, pattern, alphabet, free, excess, rare, often) AS (VALUES {_ENCODINGS}),
cores AS (
  SELECT doc_id, start, start + length(token) AS stop, regexp_replace(token, '=+$', '') AS core FROM matched
  WHERE kind = 3 AND regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Za-z]')),
encoded AS (
  SELECT c.*, e.*, CASE WHEN encoding IN (0, 2) THEN lower(translate(core, '-_', '+/')) ELSE translate(core, '-_', '+/') END AS s
  FROM cores c JOIN encodings e ON pattern = '' OR regexp_matches(core, pattern)
  QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY encoding) = 1),
symbols AS (
  SELECT *, length(s)::DOUBLE AS n, [position(substr(s, i, 1) IN alphabet)::DOUBLE FOR i IN range(1, length(s) + 1)] AS v,
         list_sum([pow(length(s) - length(replace(s, c, '')), 2) FOR c IN list_distinct(string_split(s, ''))]) AS squares,
         length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '[+/]+', '!', 'g'), '[a-z]+', '#', 'g'), '[A-Z]+', '#a', 'g'), '[0-9]+', '#', 'g'), '#a', '#', 'g'))::DOUBLE - 1 AS changes
  FROM encoded),
sums AS (
  SELECT *, squares * (free + 1) / n - n AS chi, pow(list_sum(v), 2) AS s2, n * list_sum([x * x FOR x IN v]) AS q,
         n * list_sum([v[i] * v[i % len(v) + 1] FOR i IN range(1, len(v) + 1)]) AS p
  FROM symbols),
statistics AS (SELECT *, CASE WHEN q > s2 THEN (p - s2) / (q - s2) ELSE 1 END AS serial FROM sums),
scores AS (
  SELECT *, (free + n * excess - chi) / sqrt(2 * free + 4 * n * excess) AS z1,
         (changes - 0.5 - (n - 1) * rare) / sqrt((n - 1) * rare * (1 - rare)) AS z2,
         ({secrets.CORRELATION} - abs(serial)) * sqrt(n) / {1 - secrets.CORRELATION**2!r} AS z3,
         chi - free <= {secrets.PASS} * sqrt(2 * free) AND abs(changes - (n - 1) * often) <= {secrets.PASS} * sqrt((n - 1) * often * (1 - often))
           AND abs(serial) <= {secrets.PASS} / sqrt(n) AS random
  FROM statistics),
fisher AS (SELECT *, -({_log_tail("z1")} + {_log_tail("z2")} + {_log_tail("z3")}) AS y FROM scores),
levels AS (
  SELECT doc_id, start, stop, encoding, length(bin(n::BIGINT)) AS lengths,
         CASE WHEN random THEN least(greatest(floor((y - ln(1 + y + y * y / 2)) * {secrets.STEPS} / {math.log(10)!r}), 0), {secrets.STEPS * secrets.SMALLEST})::INTEGER ELSE 0 END AS level
  FROM fisher),
counted AS (
  SELECT encoding, lengths, level, sum(count(*)) OVER (PARTITION BY encoding, lengths ORDER BY level DESC) AS k,
         sum(count(*)) OVER (PARTITION BY encoding, lengths) AS n
  FROM levels GROUP BY encoding, lengths, level),
least_levels AS (
  SELECT encoding, lengths, min(level) AS least FROM counted
  WHERE level > 0 AND n * pow(10, -level / {secrets.STEPS}) <= {secrets.RATE} * k GROUP BY encoding, lengths),
spans AS (
  SELECT * FROM base
  UNION ALL SELECT doc_id, 3, start, stop FROM levels JOIN least_levels USING (encoding, lengths) WHERE level >= least),
named AS (SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS span FROM spans)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind, stop) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind, stop), '') AS spans
FROM documents d LEFT JOIN named n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": MIXING,
        "op4_top_k_search": TOP_K,
        "op5_substring_dedup": SUBSTRINGS,
        "op6_chat_formatting": CHAT,
        "op7_warc": WARC,
        "op8_decontamination": LEAKS,
        "op10_line_dedup": LINES,
        "op11_importance_resampling": RESAMPLING,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_secret_scan": SECRETS,
    }
