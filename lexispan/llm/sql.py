"""DuckDB SQL of the registered queries of this subpackage."""

from __future__ import annotations

import itertools

from lexispan.llm.chat import Template

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op1() -> str:
    template = Template()
    hidden = "replace({}, '\\', '\\\\')"
    for control in template.controls:
        broken = control[0] + template.escape + control[1:]
        hidden = f"replace({hidden}, {_quoted(control)}, {_quoted(broken)})"
    marks = len(template.turn + template.body + template.close)
    moves = ", ".join(
        f"({_quoted(state)}, {_quoted(role)})"
        for state, roles in template.follows.items() for role in roles
    )
    shouted = _quoted("</s>[INST] ok [/INST]")
    return f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', {shouted}
    UNION ALL SELECT -7, 1, 'assistant', {shouted}
), s AS (
    SELECT *, coalesce(lag(role) OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), '') AS state FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
           AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
           ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum({marks} + length({hidden.format('role')}) + length({hidden.format('text')})) AS BIGINT)
           AS formatted_chars,
       bool_and((state, role) IN ({moves})) AS valid
FROM s GROUP BY conv_id
"""


# The exponent in closed form; the library finds it by bisection on the same grid.
_OP3 = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS source,
           len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                           lambda x: x <> '')) AS n FROM documents
), s AS (SELECT source, CAST(sum(n) AS DOUBLE) AS t FROM d GROUP BY source),
a AS (SELECT sum(t) AS total, min(t) FILTER (t > 0) AS lo, max(t) AS hi FROM s),
e AS (
    SELECT total, CASE WHEN hi > lo THEN greatest(0, least(1048576, ceil(
        (1 - ln(2) / ln(hi / lo)) * 1048576))) ELSE 0 END / CAST(1048576 AS DOUBLE) AS exponent FROM a
), w AS (SELECT source, t, exponent, CASE WHEN t > 0 THEN pow(t / total, exponent) END AS raised FROM s, e),
z AS (SELECT sum(raised) AS z, max(t / raised) AS least FROM w),
g AS (
    SELECT source, t, exponent, coalesce(raised / z, 0) AS weight,
           coalesce(raised / z, 0) * (least * z) AS target FROM w, z
), m AS (SELECT greatest(1, CAST(ceil(sum(target) / 1048576) AS BIGINT)) AS blocks FROM g),
u AS (
    SELECT doc_id, source, n, weight, t, target, exponent, unnest(range(1, 1 + CAST(
        CASE WHEN t > 0 THEN greatest(1, ceil(target / t - 1e-9)) ELSE 1 END AS BIGINT))) AS epoch
    FROM d JOIN g USING (source)
), p AS (
    SELECT *, (epoch - 1) * t + coalesce(sum(n) OVER (
        PARTITION BY source, epoch ORDER BY md5('7:' || epoch || ':' || doc_id), doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM u
)
SELECT doc_id, source, n AS n_tokens, epoch,
       CAST(least(floor(coalesce(begins / nullif(target, 0), 0) * blocks), blocks - 1) AS BIGINT) AS block,
       round(weight, 9) AS weight, exponent
FROM p, m WHERE epoch <= coalesce(target / nullif(t, 0), 1) + 1e-9 OR t = 0 OR begins < target
"""

_OP4 = r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda x: x <> '') AS ws FROM documents
), p AS (
    SELECT doc_id, unnest(range(1, greatest(len(ws) - 11, 1))) AS i, ws FROM w
), g AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(ws[i : i + 12], ' ')) AS least FROM p
), c AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM g WHERE least < doc_id
), r AS (
    SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id
), k AS (
    SELECT w.doc_id, ws, CASE WHEN js IS NULL THEN ws
        ELSE list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)),
                                        lambda z: NOT list_contains(js, z[2])), lambda z: z[1]) END AS kept
    FROM w LEFT JOIN r ON w.doc_id = r.doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - len(kept) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""

_OP5 = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest FROM pages
), o AS (
    SELECT *, CASE WHEN payload_bytes >= 1000
        THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to
FROM o
"""

_HOST = _LOWER.format(
    r"regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*')")

_OP6 = rf"""
WITH u AS (
    SELECT page_id,
           CASE WHEN instr(url, '://') > 0 THEN {_HOST} ELSE '' END AS host,
           CASE WHEN instr(url, '://') > 0
                THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
                ELSE '' END AS path FROM pages
), rules(rule, r_verdict, r_host, r_path) AS (
    VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
           ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), ruled AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(r_verdict, length(rule)) AS r_verdict
    FROM u JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY page_id
), h AS (
    SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(1 - quality) AS DOUBLE) AS bad,
           array_to_string(string_split(host, '.')[-2:], '.') AS domain,
           string_split(host, '.')[-1] AS suffix
    FROM u JOIN labels ON doc_id = page_id WHERE host <> '' AND quality IS NOT NULL GROUP BY host
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
t AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS prior FROM s),
ks AS (
    SELECT CASE WHEN coalesce(sum((n - 1) * prior * (1 - prior)), 0) = 0 THEN 10000.0 ELSE round(1 / least(greatest(
        (sum(n * (bad / n - prior) * (bad / n - prior)) - sum(prior * (1 - prior)))
        / sum((n - 1) * prior * (1 - prior)), 1e-4), 0.99) - 1, 6) END AS k
    FROM (SELECT s.*, prior FROM s, t) WHERE n > 1
), sm AS (SELECT suffix, (bad + k * prior) / (n + k) AS prior FROM s, t, ks),
dp AS (SELECT d.*, prior FROM d JOIN sm USING (suffix)),
kd AS (
    SELECT CASE WHEN coalesce(sum((n - 1) * prior * (1 - prior)), 0) = 0 THEN 10000.0 ELSE round(1 / least(greatest(
        (sum(n * (bad / n - prior) * (bad / n - prior)) - sum(prior * (1 - prior)))
        / sum((n - 1) * prior * (1 - prior)), 1e-4), 0.99) - 1, 6) END AS k
    FROM dp WHERE n > 1
), dm AS (SELECT domain, (bad + k * prior) / (n + k) AS prior FROM dp, kd),
hp AS (SELECT h.*, prior FROM h JOIN dm USING (domain)),
kh AS (
    SELECT CASE WHEN coalesce(sum((n - 1) * prior * (1 - prior)), 0) = 0 THEN 10000.0 ELSE round(1 / least(greatest(
        (sum(n * (bad / n - prior) * (bad / n - prior)) - sum(prior * (1 - prior)))
        / sum((n - 1) * prior * (1 - prior)), 1e-4), 0.99) - 1, 6) END AS k
    FROM hp WHERE n > 1
), hm AS (SELECT host, bad + k * prior AS a, n - bad + k * (1 - prior) AS b FROM hp, kh)
SELECT u.page_id, u.host, u.path, rule,
       coalesce(r_verdict, CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN ruled ON u.page_id = ruled.page_id LEFT JOIN hm ON u.host = hm.host
"""

_OP9 = f"""
WITH n AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents),
g AS (
    SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""



def _op12() -> str:
    steps = ", ".join(
        f"('{''.join(order)}', {k + 1}, {1 << 'ABCDE'.index(order[k])}, {sum(1 << 'ABCDE'.index(x) for x in order[:k])})"
        for order in itertools.permutations("ABCDE") for k in range(5))
    return f"""
WITH w AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), d AS (
    SELECT doc_id, part, (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END)
           + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END)
           + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
           + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS mask
    FROM w
), c AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
    FROM d LEFT JOIN labels USING (doc_id) GROUP BY part, mask
), o(filter_order, step, own, before) AS (VALUES {steps}),
s AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, o GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM s
"""


# Every term of every pair, without collapsing or histograms.
_OP13 = f"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           coalesce(text, '') AS text FROM documents
), w AS (
    SELECT row, lang, source, unnest(regexp_extract_all({_LOWER.format('text')},
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
every AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
    FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
    FROM every JOIN v USING (lang)
), l AS (
    SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM every GROUP BY lang, term) JOIN v USING (lang)
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q)
    FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
) WHERE part = 'pair' OR rank <= 10
"""

ORACLES = {
    "op1_chat_format": _op1(),
    "op3_source_mix": _OP3,
    "op4_substring_dedup": _OP4,
    "op5_warc": _OP5,
    "op6_url_filter": _OP6,
    "op9_exact_dedup": _OP9,
    "op12_filter_audit": _op12(),
    "op13_source_divergence": _OP13,
}
