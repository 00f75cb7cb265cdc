"""Registered queries of row-local text helpers and gates, each with SQL for DuckDB that gives the same values."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import classify as C
from .functions import text as T
from .operators import aggregates as A
from .operators import ranking as R
from .operators import reports as P
from .places_queries import M, pick
from .queries import query, t

TITLES = (
    "<b>Census &amp; survey</b> of  persons", "UN data of THE office from Statistics Norway ", "a%26b%3Dc&amp;d", " TRUE ", "3.5", "1, 5 %", "x < y & z > w", "one two three four five", "note (12) of (3) things",
    'say {"a": {"b": 1}} tail', "a – b — c" + " and much more" * 12, "", "yes", "2024 report <i", "Living Standards Survey 2019/20",
)
URLS = ("http://a.b.org/x/file-1.PDF?y=1", "https://www.c.net/2023/11/data.csv", "http://s.t.u.gov/img/logo.png", "ftp.org", "https://d.com/", "http://e.org/a/list.xlsx#top")
X = pick("p_partkey", TITLES)
U = pick("p_partkey", URLS)


def squish(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


CLEAN = squish("regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '<.*$', ' '), '&amp;', '&'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '[–—]', '-', 'g')")


@query(f"""WITH p AS (SELECT p_partkey, {X} AS x FROM part), c AS (SELECT *, {CLEAN} AS c FROM p)
SELECT p_partkey, CASE WHEN length(c) > 110 THEN c[1:107] || '...' ELSE c END AS clean, array_to_string(list_transform(string_split(x, ' '), lambda w: CASE WHEN regexp_matches(w, '^[A-Z]{{2,}}$') THEN w ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS titled,
replace(replace(replace(x, '%26', '&'), '%3D', '='), '&amp;', '&') AS address, coalesce(nullif(trim(x), ''), 'none') AS filled, coalesce(lower(trim(x)) IN ('true', '1', 'yes'), false) AS truth, try_cast(x AS DOUBLE) AS number,
replace(regexp_replace(lower(x), '\\s', '', 'g'), ',', '.') AS normal, replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped, regexp_replace(x, '(of|and)', '<mark>\\1</mark>', 'g') AS marked,
array_to_string(string_split(x, ' ')[1:3], ' ') AS three_words, {squish("regexp_replace(x, '[(][0-9]+[)]', '', 'g')")} AS no_notes, nullif(trim(regexp_extract(x, 'from (.+?)\\s*$', 1)), '') AS entity,
{squish("concat_ws(' ', x, p_partkey::VARCHAR, x)")}[1:100] AS record, nullif(regexp_extract(x, '(?s)(\\{{.*\\}})', 1), '') AS object,
sha256(coalesce(x, '') || chr(1) || p_partkey::VARCHAR) AS key, len(list_filter(regexp_extract_all(x, '\\b((?:19|20)\\d{{2}})\\b', 1), lambda y: y <> '2024')) = 0 AS years_allowed FROM c""")
def title_helpers(spark, d):
    x, id_ = F.col("x"), F.col("p_partkey")
    return t(spark, d, "part").select("p_partkey", F.expr(X).alias("x")).select(
        "p_partkey", T.clean_title(x).alias("clean"), T.title_case(x).alias("titled"), T.repair_url(x).alias("address"), T.blank_to(x, "none").alias("filled"), T.truthy(x).alias("truth"), T.safe_num(x).alias("number"), T.norm_value(x).alias("normal"),
        T.html_escape(x).alias("escaped"), T.highlight(x, "of|and").alias("marked"), T.first_words(x, 3).alias("three_words"), T.strip_footnotes(x).alias("no_notes"), T.subject_entity(x).alias("entity"),
        T.record_text(x, id_.cast("string"), x, most=100).alias("record"), T.strip_json_object(x).alias("object"), T.content_key(x, id_).alias("key"), C.facts_allowed(x, F.array(F.lit("2024"))).alias("years_allowed"),
    )


WORDS = "list_filter(string_split(trim(regexp_replace(lower(regexp_replace(coalesce(x, ''), '([a-z])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND NOT regexp_matches(w, '^\\d+$') AND w NOT IN ('survey', 'data'))"
OWN = "regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"


SECOND = T.SECOND_LEVELS


@query(f"""WITH p AS (SELECT p_partkey, {X} AS x, {U} AS u FROM part), h AS (SELECT *, {OWN} AS host, lower(regexp_extract(u, '\\.([A-Za-z0-9]{{2,5}})(?:[?#].*)?$', 1)) AS ext, {WORDS} AS w0, nullif(regexp_extract(u, '/(20\\d{{2}})/\\d{{1,2}}/', 1), '')::INT AS uy FROM p), k AS (SELECT *, list_filter(w0, lambda x, i: list_position(w0, x) = i) AS w FROM h)
SELECT p_partkey, CASE WHEN ext IN ('csv', 'xlsx', 'xls', 'zip', 'sav', 'dta', 'json') THEN 'data' WHEN ext IN ('pdf', 'doc', 'docx') THEN 'document' WHEN ext IN ('css', 'js', 'png', 'jpg', 'gif', 'svg', 'ico') THEN 'asset' ELSE 'portal' END AS kind,
CASE WHEN length(host) - length(replace(host, '.', '')) >= 2 AND NOT regexp_matches(host, '{SECOND}') THEN host || '/*' ELSE '*.' || host END AS pattern, coalesce(CASE WHEN length(x) > 25 THEN x END, nullif(x, ''), nullif(regexp_extract(u, '([^/]+)/?$', 1), '')) AS label,
array_to_string(w, ' ') AS words, concat_ws(' ', array_to_string(w[1:3], ' '), 'Kenya') AS phrase, nullif(regexp_extract(x, '((?:19|20)\\d{{2}})', 1), '')::INT AS year, uy AS url_year,
CASE WHEN p_partkey % 4 = 0 AND p_partkey % 8 = 0 THEN 'RECENT (lastmod)' WHEN uy >= 2023 THEN 'RECENT (url year)' WHEN p_partkey % 4 = 0 OR uy IS NOT NULL THEN 'OLDER' ELSE 'UNKNOWN' END AS recency, p_partkey % 3 = 0 OR 2000 + p_partkey % 30 BETWEEN 2005 AND 2025 AS in_window FROM k""")
def address_helpers(spark, d):
    x, u, k = F.col("x"), F.col("u"), F.col("p_partkey")
    seen = F.when(k % 8 == 0, F.lit("2024-05-01")).when(k % 4 == 0, F.lit("2001-05-01")).cast("date")
    return t(spark, d, "part").select("p_partkey", F.expr(X).alias("x"), F.expr(U).alias("u")).select(
        "p_partkey", C.link_kind(u).alias("kind"), T.site_pattern(T.host_of(u)).alias("pattern"), T.title_or_basename(x, x, u, 25).alias("label"), F.array_join(T.content_tokens(x, ("survey", "data")), " ").alias("words"),
        T.search_phrase(x, F.lit("Kenya"), ("survey", "data")).alias("phrase"), T.year_of(x).alias("year"), T.url_year(u).alias("url_year"), C.recency_class(seen, u, 2023).alias("recency"),
        C.year_window([F.when(k % 3 > 0, 2000 + k % 30)], F.lit(2005), 2025).alias("in_window"),
    )


PRODUCERS = ("National Statistics Office and UNHCR", "INSEE", "World Bank", "Ministry of Finance", "Somebody", "")
ANSWERS = ("VERDICT: match\nBEST: 3\nREASON: same  title ", "verdict:NO_MATCH", "none of these", "BEST: x\nREASON: y", 'ok {"verdict": "A", "score": 5}', '{"verdict": "B"}', '{"score": 2, "verdict": null}')
CODES = ("1.2.3", "1.2", "10.3.1", "x")
KIND = "CASE " + " ".join(f"WHEN {M('p', q)} THEN '{n}'" for n, q in C.PRODUCT_TYPES) + " ELSE 'unknown' END"


@query(f"""WITH p AS (SELECT o_orderkey, lower(coalesce({pick('o_orderkey', PRODUCERS)}, '')) AS p, replace({pick('o_custkey', ANSWERS)}, '\\n', chr(10)) AS a, {pick('o_orderkey', CODES)} AS c FROM orders),
q AS (SELECT *, {M('p', C.STATISTICAL_OFFICE)} AS nso, {M('p', C.AGENCY)} AS io, nullif(regexp_extract(a, '(?s)(\\{{.*\\}})', 1), '') AS j, {KIND} AS k FROM p)
SELECT o_orderkey, CASE WHEN nso AND io THEN 'NSO + Int. org (joint)' WHEN nso THEN 'NSO' WHEN io THEN 'International org' WHEN regexp_matches(p, 'ministr|government|national') THEN 'Other government' ELSE 'Other/unknown' END AS producer,
coalesce(upper(nullif(trim(regexp_extract(a, '(?i)VERDICT:\\s*([A-Za-z_]+)', 1)), '')), 'UNSURE') AS verdict, try_cast(nullif(regexp_extract(a, '(?i)BEST:\\s*(\\d+)', 1), '') AS INT) AS best, nullif(trim(regexp_extract(a, '(?i)REASON:\\s*([^\\n]+)', 1)), '') AS reason,
coalesce(regexp_matches(c, '^\\d+\\.\\d+\\.\\d+$') AND o_orderkey % 3 > 0, false) AS code_ok, CASE WHEN list_has_all(json_keys(j), ['verdict', 'score']) THEN (j->>'score')::INT END AS score,
k = 'unknown' OR (k IN ('admin', 'integration', 'survey', 'census', 'publication')) AS goes_with_publication FROM q""")
def answer_gates(spark, d):
    p, a, c = F.col("p"), F.col("a"), F.col("c")
    rows = t(spark, d, "orders").select("o_orderkey", F.expr(pick("o_orderkey", PRODUCERS)).alias("p"), F.replace(F.expr(pick("o_custkey", [x.replace("\n", "~") for x in ANSWERS])), F.lit("~"), F.lit("\n")).alias("a"), F.expr(pick("o_orderkey", CODES)).alias("c"))
    kind = F.lower(F.coalesce(p, F.lit("")))
    told = F.coalesce(*[F.when(kind.rlike(q), n) for n, q in C.PRODUCT_TYPES], F.lit("unknown"))
    return rows.withColumn("v", C.parse_verdict(a)).select(
        "o_orderkey", C.producer_type(p).alias("producer"), "v.verdict", "v.best", "v.reason", C.code_gate(c, F.lit("idps"), F.when(F.col("o_orderkey") % 3 > 0, "1").otherwise(" "), ["idps"]).alias("code_ok"),
        C.validate_response(a, "score int, verdict string", ["verdict", "score"])["score"].alias("score"), C.type_compatible(told, F.lit("publication")).alias("goes_with_publication"),
    )


@query("""SELECT doc_id, list_filter(regexp_split_to_array(text, '\\n\\s*\\n|\\n'), lambda p: length(p) > 80)[1][1:400] AS opening FROM documents""")
def opening_paragraphs(spark, d):
    return t(spark, d, "documents").select("doc_id", T.first_paragraph(F.col("text")).alias("opening"))


@query("""WITH f AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS v FROM customer) SELECT c_nationkey, c_mktsegment, arg_max(v, c_custkey) FILTER (v IS NOT NULL) AS latest FROM f WHERE v IS NOT NULL GROUP BY 1, 2""")
def latest_balances(spark, d):
    rows = t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal")).alias("v")).where("v is not null")
    return R.latest(rows, ["c_nationkey", "c_mktsegment"], "c_custkey", []).select("c_nationkey", "c_mktsegment", F.col("v").alias("latest"))


@query("SELECT o_custkey, max(o_totalprice) > 400000 AS any_with, min(o_totalprice) <= 400000 AS any_without, count(*) AS n FROM orders GROUP BY o_custkey")
def customers_with_large_orders(spark, d):
    return A.cells_with(t(spark, d, "orders"), ["o_custkey"], F.col("o_totalprice") > 400000)


@query("""SELECT l_returnflag, median(l_tax * 1000 - l_discount * 800) AS median_delta, count(*) FILTER (l_discount * 800 < 50 AND l_tax * 1000 >= 50) AS up, count(*) FILTER (l_discount * 800 >= 50 AND l_tax * 1000 < 50) AS down, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def score_shifts(spark, d):
    rows = t(spark, d, "lineitem").select("l_returnflag", (F.col("l_discount") * 800).alias("old"), (F.col("l_tax") * 1000).alias("new"))
    return A.version_shift(rows, "old", "new", "l_returnflag")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def customers_with_more_orders(spark, d):
    return A.duplicates(t(spark, d, "orders"), "o_custkey").select("o_custkey", F.col("count").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 < 2 AND o_custkey % 3 < 2 THEN 'existing focal point' ELSE CASE o_custkey % 3 WHEN 0 THEN 'NSO direct' WHEN 1 THEN 'partner-supported follow-up' ELSE 'do not follow up yet' END END AS route FROM orders""")
def upgraded_routes(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "ACTIVE").otherwise("LAPSED")
    category = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'A. x' WHEN 1 THEN 'B. x' WHEN 2 THEN 'C. x' WHEN 3 THEN 'D. x' END")
    route = F.expr("CASE o_custkey % 3 WHEN 0 THEN 'NSO direct' WHEN 1 THEN 'partner-supported follow-up' ELSE 'do not follow up yet' END")
    return t(spark, d, "orders").select("o_orderkey", P.route_upgrade(status, category, route).alias("route"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderdate <= TIMESTAMP '1998-06-17'")
def due_followups(spark, d):
    log = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "sent").otherwise("responded").alias("status"), F.col("o_orderdate").cast("date").alias("date_sent"))
    return P.followups_due(log, F.lit("1998-07-01").cast("date")).select("o_orderkey")
