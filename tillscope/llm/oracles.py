"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tillscope.llm.textstats import all_stop_words

_STOP = ", ".join(f"'{w}'" for w in all_stop_words())

# The limits of the quality rules, in thousandths, written out here a second time.
_BROKEN = """
    1000 * word_chars < 2500 * n_words OR 1000 * word_chars > 12000 * n_words
    OR 1000 * n_symbols > 100 * n_words OR 1000 * n_exclamations > 500 * n_words
    OR 1000 * n_capitals > 400 * word_chars OR 1000 * n_stop_words < 10 * n_words
    OR 1000 * n_dup_lines > 400 * n_lines OR 1000 * n_bullet_lines > 900 * n_lines
    OR 1000 * n_ellipsis_lines > 300 * n_lines"""

OP3 = r"""
WITH split AS (
    SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents),
item AS (
    SELECT item_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, i, item_id FROM places JOIN windows USING (n, s)),
words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
hit AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
counts AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
           len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           len(list_filter(lines, lambda l: regexp_matches(l, '^ *[-*•]'))) AS n_bullet_lines,
           len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…) *$'))) AS n_ellipsis_lines,
           coalesce(n, 0) AS n_repeat_words
    FROM words LEFT JOIN repeats USING (doc_id)),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_BROKEN}) AS kept
FROM judged
"""

OP6 = """
WITH digested AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (
    SELECT *, min(page_id) OVER (PARTITION BY html) AS first,
           array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
               lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                ((('0x' || substr(hex, 5 * g + 1, 5))::INTEGER >> s) & 31) + 1, 1)), '')), '') AS digest
    FROM digested)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded
"""

OP8 = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
    SELECT *, length('<|turn|>' || role || text || '<|end|>') + 3
              + CASE WHEN conv_id = -1 THEN 3 ELSE 0 END AS formatted FROM turns)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(formatted)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP10 = r"""
WITH lines AS (
    SELECT doc_id, i - 1 AS place, parts[i] AS line, doc_id * 1000000 + i AS place_at
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
    WHERE regexp_matches(parts[i], '[^\x20\x09-\x0D]')),
firsts AS (
    SELECT line, length(line) AS n, min(place_at) AS first, len(string_split(line, ' ')) AS blanks,
           len(string_split(line, 'e')) AS e, len(string_split(line, 'a')) AS a, len(string_split(line, 'o')) AS o
    FROM lines GROUP BY line),
links AS (
    SELECT x.line AS earlier, y.line AS later
    FROM firsts x JOIN (SELECT *, unnest(range(n - 2, n + 3)) AS m FROM firsts WHERE n >= 20) y
      ON x.n = y.m AND x.n >= 20 AND x.first < y.first AND abs(x.blanks - y.blanks) <= 2 AND abs(x.e - y.e) <= 2
         AND abs(x.a - y.a) <= 2 AND abs(x.o - y.o) <= 2
    WHERE levenshtein(x.line, y.line) <= 2),
near AS (
    SELECT line, bool_or(is_later) AS is_later, count(*) AS n
    FROM (SELECT later AS line, true AS is_later FROM links UNION ALL SELECT earlier, false FROM links) GROUP BY line),
judged AS (
    SELECT doc_id, place, place_at <> first AS exact, place_at = first AND coalesce(is_later, false) AS near,
           coalesce(near.n, 0) AS n_links
    FROM lines JOIN firsts USING (line) LEFT JOIN near USING (line)),
gone AS (
    SELECT doc_id, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near) AS n_near, sum(n_links) AS n_links,
           string_agg(place::VARCHAR, ',' ORDER BY place) FILTER (exact) AS exact_lines,
           string_agg(place::VARCHAR, ',' ORDER BY place) FILTER (near) AS near_lines
    FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_exact, 0)::BIGINT AS n_exact,
       coalesce(n_near, 0)::BIGINT AS n_near, coalesce(exact_lines, '') AS exact_lines, coalesce(near_lines, '') AS near_lines,
       coalesce(n_links, 0)::BIGINT AS n_links
FROM documents LEFT JOIN gone USING (doc_id)
"""

OP11 = r"""
WITH judged AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
marks AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
    FROM judged LEFT JOIN marks USING (doc_id)),
kinds AS (
    SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                        CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
           count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failed GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
    FROM (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders)),
met AS (
    SELECT part, filter_order, step, f, fails, n, good, toxic, contains(fails, f) AS own,
           translate(fails, before, '') <> fails AS gone
    FROM kinds, steps),
counted AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (NOT own AND NOT gone), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (own AND NOT gone), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (own AND gone), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (own AND NOT gone), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (own AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""



def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_WORDS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_WORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = [
    (1, "assign", _ASSIGN, rf"len(regexp_extract(m, '{_ASSIGN}', 2)) >= 6"),
    (2, "access", "AKIA[A-Z0-9]+", "len(m) >= 20"),
    (3, "hex", "[0-9a-f]+", "len(m) >= 24"),
    (4, "github", "gh[oprsu]_[A-Za-z0-9]{36,}", "true"),
    (5, "pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
]
_PIECES = " UNION ALL ".join(
    f"""
    SELECT doc_id, copy, {rank} AS rank, '{kind}' AS kind, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs[:len(ms)]) AS g
    FROM (SELECT doc_id, copy, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gs FROM texts)"""
    for rank, kind, pattern, _ in _SECRETS
)
_HOLDS = " OR ".join(f"(kind = '{kind}' AND {holds})" for _, kind, _, holds in _SECRETS)
OP12 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS copy FROM documents),
pieces AS ({_PIECES}),
placed AS (
    SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY copy, kind ORDER BY i)::BIGINT AS e FROM pieces),
held AS (SELECT copy, rank, kind, e - length(m) AS s, e FROM placed WHERE {_HOLDS}),
found AS (
    SELECT copy, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
           string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, rank) FILTER (rank <= 3) AS base,
           string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, rank) AS spans
    FROM held GROUP BY copy)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM texts LEFT JOIN found USING (copy)
"""



def _round(k: int) -> str:
    """Assignments to the codebooks ``b{k}`` and the codebooks after it."""
    return f"""
a{k} AS MATERIALIZED (
    SELECT vec_id, label, p, u, arg_min(e, 16 * d + e) AS e, min(d) AS d
    FROM (SELECT vec_id, label, p, u, e,
                 list_sum(list_transform(range(1, len(u) + 1), lambda i: (u[i] - c[i]) * (u[i] - c[i])))::BIGINT AS d
          FROM parts JOIN b{k} USING (p))
    GROUP BY vec_id, label, p, u),
sums{k} AS (
    SELECT p, e, i, sum(u[i])::BIGINT AS s, count(*) AS n
    FROM (SELECT p, e, u, unnest(range(1, len(u) + 1)) AS i FROM a{k}) GROUP BY p, e, i),
means{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS mean FROM sums{k} GROUP BY p, e),
b{k + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(mean, c) AS c FROM b{k} LEFT JOIN means{k} USING (p, e))"""


OP13 = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
    SELECT vec_id, label, p, v[p * w + 1:p * w + w] AS u
    FROM (SELECT vec_id, label, v, len(v) // 8 AS w, unnest(range(8)) AS p FROM kept)),
b0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, u AS c FROM parts QUALIFY e < 16),
{",".join(_round(k) for k in range(7))},
books AS (
    SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM b6)),
codes AS (
    SELECT vec_id, label, string_agg(lower(printf('%02x', e::INTEGER)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
    FROM a6 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes, books
"""

ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": OP3,
    "op5_quality_rules": OP5,
    "op6_warc": OP6,
    "op8_chat_formatting": OP8,
    "op10_line_dedup": OP10,
    "op11_filter_interaction_audit": OP11,
    "op12_secret_scans": OP12,
    "op13_vector_code_compression": OP13,
}
