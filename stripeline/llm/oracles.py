"""The same results in DuckDB's SQL, where SQL can express an operator."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS} AS w FROM benchmark),
s AS (SELECT item, w, least(10, len(w)) AS m FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, m, w[k:k + m - 1] AS words FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM s)),
dw AS (SELECT r, m, k, w[k:k + m - 1] AS words FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d CROSS JOIN (SELECT DISTINCT m FROM s) WHERE len(w) >= m)),
hits AS (SELECT dw.r, dw.k, dw.m, iw.item FROM dw JOIN iw ON dw.m = iw.m AND dw.words = iw.words),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + m)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(f.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.r = d.r LEFT JOIN found f ON f.r = d.r
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '###', '\h\h\h'), '</turn>', '\l/turn>')"
OP10 = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
e AS (
    SELECT *, length({_ESCAPED.format("text")}) + 7 AS own, length(replace({_ESCAPED.format("role")}, chr(10), '\n')) + 6 AS head,
           lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth
    FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(own) + sum(CASE WHEN nth = 1 OR before <> role THEN head ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
