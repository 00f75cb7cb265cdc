"""Registered queries on records, leads and registers, each with SQL for DuckDB that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import records as D
from .functions import text as T
from .operators import leads as L
from .queries import query, t

#: Concepts that the synthetic texts do hold, in the place of the subject terms of real corpora.
CONCEPTS = {"nations": "tion", "queries": "que", "ends": "ing", "digits": "[0-9]{3}", "members": "ung"}


def _case(rules, x, default):
    quoted = [(label.replace("'", "''"), p.replace("'", "''")) for label, p in rules]
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{label}'" for label, p in quoted) + f" ELSE {default} END"


def _tags(dictionary, x):
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({x}, '{p}') THEN '{k}' END" for k, p in dictionary.items()) + "], lambda y: y IS NOT NULL), ', ')"


URLS = " ".join(f"WHEN regexp_matches(lower(url), '{p}') THEN '{a}|{m}|{r}'" for a, p, m, r in D.URL_TYPES)


@query(f"SELECT page_id, split_part(k, '|', 1) AS type, split_part(k, '|', 2) AS method, split_part(k, '|', 3) AS tier FROM (SELECT page_id, CASE WHEN coalesce(url, '') = '' THEN 'none|reach_out|NO_LINK' {URLS} ELSE 'web_page|scrape_html|SCRAPE' END AS k FROM pages)")
def url_sources(spark, d):
    return t(spark, d, "pages").select("page_id", D.url_source(F.col("url")).alias("s")).select("page_id", "s.type", "s.method", "s.tier")


@query(f"SELECT doc_id, {_case(D.METHODS, 'lower(text)', chr(39) + 'unknown' + chr(39))} AS method, {_case(D.RECORD_STATES, 'lower(text)', chr(39) + 'survey/dataset' + chr(39))} AS state, {_tags(CONCEPTS, 'lower(text)')} AS tags FROM documents")
def record_classes(spark, d):
    x = F.col("text")
    return t(spark, d, "documents").select("doc_id", D.method_guess(x).alias("method"), D.record_state(x, F.lit(None)).alias("state"), F.array_join(D.tags(x, CONCEPTS), ", ").alias("tags"))


TITLE_SQL = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"


def titled(spark, d):
    return t(spark, d, "pages").withColumn("title", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))


@query(f"WITH p AS (SELECT *, {TITLE_SQL} AS title FROM pages) SELECT * FROM (" + " UNION ALL ".join(f"SELECT page_id, '{k}' AS concept, CASE WHEN regexp_matches(lower(coalesce(url, '')), '{p}') THEN 'microdata' WHEN regexp_matches(lower(title), '{p}') THEN 'table' WHEN regexp_matches(lower(html), '{p}') THEN 'text' END AS level FROM p" for k, p in CONCEPTS.items()) + ") WHERE level IS NOT NULL")
def concept_evidence(spark, d):
    p = titled(spark, d)
    return p.select("page_id", F.explode(D.evidence_levels(F.col("url"), F.col("title"), F.col("html"), CONCEPTS)).alias("e")).select("page_id", "e.concept", "e.level")


@query(r"WITH v AS (SELECT source, doc_id, regexp_matches(lower(text), '\*\*\*') AS a, regexp_matches(lower(text), '[0-9]{3}') AS b FROM documents), k AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM v WHERE a OR b) SELECT source, count(*) AS n_vars, count(*) FILTER (a OR b) AS n_hits, count(*) FILTER (a) AS n_stars, count(*) FILTER (b) AS n_digits, (SELECT string_agg(doc_id::VARCHAR, ', ' ORDER BY doc_id) FROM k WHERE k <= 10 AND k.source = v.source) AS hit_vars FROM v GROUP BY source")
def term_inventory(spark, d):
    return L.variable_hits(t(spark, d, "documents"), "source", "doc_id", "text", {"stars": r"\*\*\*", "digits": "[0-9]{3}"})


@query(r"WITH p AS (SELECT doc_id, text, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '\s', '', 'g')) AS pages, regexp_replace(text[greatest(length(text) // 2, 1):greatest(length(text) // 2, 1) + 29], '\s', '', 'g') AS e FROM documents) SELECT doc_id, CASE WHEN len(pages) > 1 THEN coalesce(CASE WHEN e <> '' THEN nullif(coalesce(list_position(list_transform(pages, lambda x: contains(x, e)), true), 0), 0) END, nullif(coalesce(list_position(list_transform(pages, lambda x: contains(x, '.')), true), 0), 0)) END::INT AS page FROM p")
def quote_pages(spark, d):
    """On which line of a document thirty signs from its middle stand, else its first full stop."""
    x = F.col("text")
    middle = F.greatest(F.floor(F.length(x) / 2).cast("int"), F.lit(1))
    return t(spark, d, "documents").select("doc_id", D.page_of(F.split(x, "\n"), F.substring(x, middle, F.lit(30)), F.lit(".")).alias("page"))


@query("WITH e AS (SELECT s_suppkey, unnest(list_distinct(list_transform(string_split(p_name, ' '), lambda w: w[1:3]))) AS k FROM supplier JOIN part ON p_partkey = s_suppkey), m AS (SELECT DISTINCT s_suppkey, p_partkey AS code FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) JOIN e ON starts_with(w, k)) SELECT s_suppkey, code, rank FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY code)::INT AS rank FROM m) WHERE rank <= 6")
def catalogue_hits(spark, d):
    """Parts whose names have words that begin like those of a supplier's own first part."""
    p = t(spark, d, "part")
    examples = t(spark, d, "supplier").join(p, F.col("p_partkey") == F.col("s_suppkey")).select("s_suppkey", F.transform(F.split("p_name", " "), lambda w: F.substring(w, 1, 3)).alias("kw"))
    return L.catalogue_search(examples, p, "s_suppkey", "kw", "p_partkey", "p_name").select("s_suppkey", "code", "rank")


@query(None)
def page_best_links(spark, d):
    words = F.slice(T.content_tokens(F.col("title")), 1, 6)
    return L.relevant_links(titled(spark, d), "page_id", "url", "html", words).select("page_id", "link", "score", "rank")


@query("SELECT s_suppkey, (SELECT n_name FROM nation WHERE contains(lower(n2.n_name), lower(nation.n_name[1:8])) ORDER BY n_nationkey LIMIT 1) AS place FROM supplier JOIN nation n2 ON n2.n_nationkey = s_nationkey")
def supplier_places(spark, d):
    n = t(spark, d, "nation")
    s = t(spark, d, "supplier").join(n, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", F.col("n_name").alias("text"))
    return L.place_by_prefix(s, n, "text", "s_suppkey", "n_name", "n_nationkey", 8).select("s_suppkey", "place")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08 UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def unresolved_orders(spark, d):
    o, li = t(spark, d, "orders"), t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return L.unresolved(o, [li.where("l_returnflag = 'R'"), li.where("l_discount > 0.08"), o.where("o_orderstatus = 'P'")], "o_orderkey").select("o_orderkey")


@query("SELECT DISTINCT l_orderkey, 'returned' AS route FROM lineitem WHERE l_returnflag = 'R' UNION SELECT DISTINCT l_orderkey, 'discounted' FROM lineitem WHERE l_discount > 0.08")
def order_routes(spark, d):
    li = t(spark, d, "lineitem")
    return L.audit_pool({"returned": li.where("l_returnflag = 'R'"), "discounted": li.where("l_discount > 0.08")}, "l_orderkey")


@query("WITH f AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT o_custkey, o_orderkey, o_custkey || '_' || lpad(k::VARCHAR, greatest(2, length(k::VARCHAR))::INT, '0') AS ref, coalesce(n, 0) AS n_files FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) LEFT JOIN f ON l_orderkey = o_orderkey")
def order_archive(spark, d):
    files = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.archive_index(t(spark, d, "orders"), files, "o_custkey", "o_orderkey")


@query("WITH c AS (SELECT c_nationkey, c_custkey, c_acctbal, c_mktsegment || ';' || lower(c_mktsegment[1:4]) AS p, CASE WHEN c_acctbal > 5000 THEN 'www.' || c_custkey ELSE '' END AS portal FROM customer), k AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM c), u AS (SELECT DISTINCT c_nationkey, unnest(string_split(p, ';')) AS x FROM c) SELECT c_nationkey, count(*) AS n, max(c_acctbal) AS priority, arg_min(portal, c_custkey) FILTER (portal <> '') AS portal, (SELECT string_agg(x, '; ' ORDER BY x) FROM u WHERE u.c_nationkey = c.c_nationkey) AS populations, (SELECT string_agg(c_custkey::VARCHAR, ', ' ORDER BY c_custkey) FROM k WHERE k <= 15 AND k.c_nationkey = c.c_nationkey) AS ids FROM c GROUP BY c_nationkey")
def office_summary(spark, d):
    c = t(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal", F.concat("c_mktsegment", F.lit(";"), F.lower(F.substring("c_mktsegment", 1, 4))).alias("p"), F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("www."), F.col("c_custkey").cast("string"))).otherwise("").alias("portal"))
    return L.office_rollup(c, "c_nationkey", "c_acctbal", "p", "portal", "c_custkey")


@query(rf"WITH p AS (SELECT page_id, lower(trim({TITLE_SQL}))[1:3] AS k, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS h FROM pages), s AS (SELECT k FROM p WHERE trim(k) <> '' AND trim(h) <> '' GROUP BY k HAVING count(DISTINCT h) >= 3) SELECT page_id, CASE WHEN s.k IS NOT NULL THEN 'aggregator title' WHEN regexp_matches(h, 'example\.net') THEN 'aggregator domain' WHEN trim(h) <> '' AND NOT (h = 'example.com' OR ends_with(h, '.example.com')) THEN 'off own domain' ELSE '' END AS excl_reason FROM p LEFT JOIN s ON p.k = s.k")
def page_exclusions(spark, d):
    p = titled(spark, d).select("page_id", F.substring(F.lower(F.trim("title")), 1, 3).alias("k"), T.host_of(F.col("url")).alias("h"), F.lit("example.com").alias("own"))
    return L.exclusion_reason(p, "k", "h", "own", r"example\.net").select("page_id", "excl_reason")


@query("WITH w(language, population, phrase) AS (SELECT DISTINCT lang, source, lang || ' ' || source FROM documents), e AS (SELECT n_name, unnest(['en', CASE WHEN n_regionkey > 1 THEN 'fr' ELSE 'de' END]) AS language FROM nation) SELECT n_name, language, population, phrase || ' ' || n_name AS phrase FROM e JOIN w USING (language) UNION ALL SELECT n_name, 'en', 'all', unnest(['statistics of', 'census of']) || ' ' || n_name FROM nation")
def search_plan(spark, d):
    words = t(spark, d, "documents").select(F.col("lang").alias("language"), F.col("source").alias("population"), F.concat_ws(" ", "lang", "source").alias("phrase")).distinct()
    n = t(spark, d, "nation").withColumn("langs", F.when(F.col("n_regionkey") > 1, "en, fr").otherwise("en, de"))
    return L.query_plan(n, words, "n_name", "langs", ["statistics of", "census of"])


@query("SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'Bonjour M. ' || c_name || ',' WHEN c_nationkey % 3 = 1 THEN 'M. ' || c_name || ':' ELSE 'Dear M. ' || c_name || ',' END AS greeting, CASE WHEN c_nationkey % 3 = 0 THEN 'J''ai mis en copie A, B et C.' WHEN c_nationkey % 3 = 1 THEN 'Pongo en copia a A, B y C.' ELSE 'I have copied A, B and C.' END AS copied, CASE WHEN c_nationkey % 3 = 0 THEN 'fr' WHEN c_nationkey % 3 = 1 THEN 'es' ELSE 'en' END AS code, NOT contains(trim(regexp_replace(lower(c_mktsegment || '@x.org'), '[^a-z0-9]+', ' ', 'g')), 'machinery') AS name_absent FROM customer")
def letters(spark, d):
    k = F.col("c_nationkey") % 3
    language = F.when(k == 0, "French").when(k == 1, "Spanish").otherwise("English")
    listed = F.when(k == 0, "fr, en").when(k == 1, "es").otherwise("sv, fr")
    names = F.array(F.lit("A"), F.lit("B"), F.lit("C"))
    return t(spark, d, "customer").select("c_custkey", D.salutation(language, F.lit("M."), F.col("c_name")).alias("greeting"), D.cc_clause(language, names).alias("copied"), D.language_for(listed).alias("code"), D.name_absent(F.concat(F.col("c_mktsegment"), F.lit("@x.org")), F.lit("Machinery")).alias("name_absent"))


@query("WITH u AS (SELECT user_id, bool_or(event_type = 'purchase') AS r, bool_or(event_type = 'error') AS b, bool_or(event_type = 'click') AS s, bool_or(event_type = 'view') AS c FROM events GROUP BY 1) SELECT user_id, CASE WHEN r THEN '5_responded' WHEN b THEN '4_bounced' WHEN s THEN '4_contacted' WHEN c THEN '3_contact_ready' ELSE '2_no_contact' END AS stage FROM u")
def cycle_stages(spark, d):
    has = lambda kind: F.bool_or(F.col("event_type") == kind)
    u = t(spark, d, "events").groupBy("user_id").agg(has("purchase").alias("r"), has("error").alias("b"), has("click").alias("s"), has("view").alias("c"))
    return u.select("user_id", D.cycle_stage(F.col("r"), F.col("b"), F.when(F.col("s"), "sent").otherwise("not_started"), F.col("c")).alias("stage"))


@query("WITH z AS (SELECT o_orderkey, (o_totalprice / 5000)::INT AS kw, o_custkey % 101 AS m, o_orderstatus <> 'P' AS read, CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'medium' ELSE 'odd' END AS c FROM orders) SELECT o_orderkey, least(greatest(CASE WHEN read THEN m ELSE kw END, 0), 100)::INT AS score, CASE WHEN NOT read THEN 'unverified (keyword only)' WHEN (kw < 40 AND m >= 70) OR (kw >= 70 AND m < 40) THEN 'low - signals disagree' WHEN lower(c) IN ('high', 'medium', 'low') THEN lower(c) ELSE 'low' END AS confidence FROM z")
def verdict_confidence(spark, d):
    kw, m = F.bround(F.col("o_totalprice") / 5000).cast("int"), F.col("o_custkey") % 101
    both = kw.isNotNull() & m.isNotNull()  # a score that is not known disagrees with none
    said = F.when(F.col("o_orderpriority") == "1-URGENT", "High").when(F.col("o_orderpriority") == "2-HIGH", "medium").otherwise("odd")
    read = F.col("o_orderstatus") != "P"
    return t(spark, d, "orders").select("o_orderkey", D.final_score(read, m, kw).alias("score"), D.final_confidence(read, F.when(both, kw), F.when(both, m), said).alias("confidence"))


@query("SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_customers(spark, d):
    return t(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT l_returnflag AS g, round(median(l_extendedprice), 6) AS median_price, count(*) FILTER (l_tax > 0.04) AS n_taxed FROM lineitem GROUP BY 1")
def price_medians(spark, d):
    return t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("g")).agg(F.round(F.median("l_extendedprice"), 6).alias("median_price"), F.count_if(F.col("l_tax") > 0.04).alias("n_taxed"))
