"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .mixing import CAP, SEED, SHARE

OP1 = r"""
WITH d AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(h, CAST(i // 4 AS INT) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id > first OR page_id IS NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first OR page_id IS NULL THEN first END AS refers_to
FROM d JOIN f USING (h)
"""

OP2 = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL BY NAME
           SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text)),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + 2 * length(regexp_replace(role, '([\\<>\[\]])', 'x\1', 'g')) + length(regexp_replace(text, '([\\<>\[\]])', 'x\1', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP3 = r"""
WITH rules(h, p, v) AS (VALUES ('com','/en/','block'),('example.com','/en/7','allow'),('net','/de/','allow'),('example.net','/de/8','block'),('org','/es/','block')),
t AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS t FROM pages),
u AS (SELECT page_id, translate(regexp_extract(t, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM t),
m AS (SELECT u.page_id, h || p AS rule, v, row_number() OVER (PARTITION BY u.page_id, host, path ORDER BY length(h || p) DESC) AS k
      FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT u.page_id, host, path, m.rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m ON u.page_id = m.page_id AND k = 1
"""

OP8 = rf"""
WITH sized AS (SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s),
c AS (SELECT *, source_size * {CAP}::DOUBLE AS cap, source_size * {CAP}::DOUBLE / w AS ratio FROM w),
-- the level is the candidate at which the targets add up to the budget
l AS (SELECT (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM c WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM l, c GROUP BY level ORDER BY abs(sum(least(cap, level * w)) - (SELECT sum(source_size) * {SHARE}::DOUBLE FROM c)) LIMIT 1),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM f) * w) AS target FROM c),
r AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, {CAP}::DOUBLE) ELSE 0 END AS rate
      FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, CAST('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), coalesce(md5(text), ''))), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496 AS u FROM r)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x
"""

OP11 = r"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
docs AS (SELECT d, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM t WHERE len(terms) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY d, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT n_docs FROM c) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf GROUP BY term),
m AS (SELECT d, doc_id, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM docs, c),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
s AS (SELECT i, item_id, d, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (d) GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

OP13 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
k AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

ORACLES = {"op1_warc_transactions": OP1, "op2_chat_format": OP2, "op3_url_filter": OP3, "op8_mix_sources": OP8, "op11_lexical_search": OP11, "op13_fill_in_middle": OP13}
