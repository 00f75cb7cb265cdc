"""Registered queries of places and signals: names, titles and addresses told from the tables' keys, each with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import places as P
from .functions import signals as S
from .operators import campaign as K
from .queries import query, t


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def pick(key: str, values) -> str:
    """SQL that deals the values out by a key (the last: null)."""
    return f"CASE {key} % {len(values) + 1} " + " ".join(f"WHEN {k} THEN {quoted(v)}" for k, v in enumerate(values)) + " END"


def table(entries: dict[str, str], value: str) -> str:
    """SQL for what a table says of a value, else null."""
    return f"CASE {value} " + " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in entries.items()) + " END"


def cases(rules, value: str, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({value}, {quoted(p)}) THEN {quoted(n)}" for n, p in rules) + f" ELSE {default} END"


NAMES = ("Turkey*", " Iran ", "DRC", "Côte d'Ivoire", "Cote d'Ivoire", "Norway", "Netherlands", "Greece", "Slovak Republic", "Yemen, Rep.", "Austria, Cyprus, Germany...and 2 more", "World", "Europe and Central Asia", "West Africa", "State of Palestine", "Kenya", "")
PLACE = pick("c_custkey", NAMES) + " AS place"
HARMONISED = f"coalesce({table(P.ALIASES, 'trimmed')}, trimmed)"
SEVERAL = "coalesce(regexp_matches(place, 'more$') OR place IN ('Europe and Central Asia') OR length(place) - length(replace(place, ',', '')) >= 2, true)"


@query(f"""WITH p AS (SELECT c_custkey, {PLACE} FROM customer), q AS (SELECT *, trim(replace(coalesce(place, ''), '*', '')) AS trimmed FROM p), h AS (SELECT *, {HARMONISED} AS country, coalesce({table(P.GEO_CODES, 'trimmed')}, {table(P.GEO_CODES, HARMONISED)}) AS geo FROM q)
SELECT c_custkey, country, geo, CASE WHEN country = 'Norway' THEN 'SSB' WHEN geo IS NOT NULL OR country = 'Netherlands (Kingdom of the)' THEN 'Eurostat' END AS interface,
regexp_matches(coalesce(place, ''), {quoted(P.LIST_OF_PLACES)}) OR coalesce(place, '') IN ({", ".join(map(quoted, P.REGIONS))}) AS several, regexp_matches(coalesce(place, ''), {quoted(P.WIDE_LIST)}) AS several_wide FROM h""")
def customer_places(spark, d):
    p = F.col("place")
    rows = t(spark, d, "customer").selectExpr("c_custkey", PLACE)
    return rows.select("c_custkey", P.harmonize_country(p).alias("country"), P.geo_code(p).alias("geo"), P.registry_gate(p).alias("interface"), P.is_multi_country(p).alias("several"), P.is_multi_country(p, wide=True).alias("several_wide"))


@query(f"""WITH p AS (SELECT c_custkey, {PLACE} FROM customer), q AS (SELECT *, NOT {SEVERAL} AS is_single_country, CASE WHEN NOT {SEVERAL} THEN coalesce({table(P.MAP_NAMES, 'place')}, place) END AS map_country FROM p),
codes AS (SELECT coalesce({table(P.MAP_NAMES, pick('n_nationkey', NAMES))}, {pick('n_nationkey', NAMES)}) AS country, min('C' || n_nationkey) AS iso3 FROM nation GROUP BY 1)
SELECT c_custkey, map_country, iso3, is_single_country FROM q LEFT JOIN codes ON map_country = country""")
def map_places(spark, d):
    rows = t(spark, d, "customer").selectExpr("c_custkey", PLACE)
    nations = t(spark, d, "nation").select(P.recode(F.expr(pick("n_nationkey", NAMES)), P.MAP_NAMES).alias("country"), F.concat(F.lit("C"), "n_nationkey").alias("iso3"))
    return P.geo_harmonize(rows, "place", nations.groupBy("country").agg(F.min("iso3").alias("iso3"))).select("c_custkey", "map_country", "iso3", "is_single_country")


@query("""SELECT s_suppkey, CASE WHEN s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9900) THEN 'building' WHEN s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900) THEN 'debtors' ELSE 'none' END AS interface FROM supplier""")
def supplier_interfaces(spark, d):
    members = lambda cond: t(spark, d, "customer").where(cond).select(F.col("c_nationkey").alias("s_nationkey"))
    found = P.routed_registry(t(spark, d, "supplier"), "s_nationkey", [("building", members("c_mktsegment = 'BUILDING' and c_acctbal > 9900")), ("debtors", members("c_acctbal < -900"))])
    return found.select("s_suppkey", "interface")


TITLES = ("Refugee Survey 2021", "Labour Force Survey", "MICS 6 Multiple Indicator", "Population and Housing Census", "Vulnerability assessment of IDPs", "Household budget poverty", "Demographic and Health (DHS)", "Asylum seeker | CBS", "Casino bonus", "Register of persons", "Welfare panel", "pidpryiemstv")
URLS = ("https://stats.no/refugees/a.pdf", "https://x.org/migration/2", "https://www.unhcr.org/idp/1", "https://casino.net/refugee", "https://www.wikipedia.org/x", "https://ins.example.com/pidpr/1", "http://cbs.nl/methods/definitions/x", "https://office1.example.com/host-communities")
PRODUCERS = ("National Statistics Office", "UNHCR and World Bank", "Ministry of Interior", "mics.unicef.org statistics", "Eurostat", "INE", "World Food Programme")
LAYERS = ("L1:catalog", "L2:search", "L3:sitemap", "STRUCT:api")
POPULATIONS = ("Refugees", "IDPs", "stateless persons", "Returnees", "Host community", "overall", "Venezuelans", "")
RECORD = tuple(f"{pick(k, v)} AS {n}" for k, v, n in (("o_orderkey", TITLES, "title"), ("o_custkey", URLS, "url"), ("o_orderkey", PRODUCERS, "producer"), ("o_custkey", LAYERS, "layer"), ("o_orderkey", POPULATIONS, "population"), ("o_custkey", NAMES, "place")))
RECORDS = f"r AS (SELECT o_orderkey AS id, CAST(o_custkey % 5 AS INT) AS priority, {", ".join(RECORD)}, lower(coalesce({pick('o_orderkey', TITLES)}, '')) AS t, lower(coalesce({pick('o_custkey', URLS)}, '')) AS u, lower(coalesce({pick('o_orderkey', PRODUCERS)}, '')) AS p FROM orders)"


def _records(spark, d):
    return t(spark, d, "orders").selectExpr("o_orderkey AS id", "CAST(o_custkey % 5 AS INT) AS priority", *RECORD)


M = lambda value, pattern: f"regexp_matches({value}, {quoted(pattern)})"
KEEP = f"NOT {M('u', S.SPAM_URL)} AND ({M('u', S.URL_STRONG)} OR ({M('u', S.URL_WEAK)} AND priority < 3))"


@query(f"""WITH {RECORDS} SELECT id, CASE WHEN {KEEP} THEN CASE WHEN {M('u', S.URL_STRONG)} THEN 'strong' ELSE 'weak (review)' END END AS strength, CASE WHEN {KEEP} THEN regexp_extract(u, {quoted('(' + S.URL_STRONG + '|' + S.URL_WEAK + ')')}, 1) END AS keyword,
{M("lower(concat_ws(' ', title, url))", S.SUBJECT)} AS topical, {M('p', S.SOURCES)} AS sourced, {M("lower(concat_ws(' ', url, title))", S.SPAM)} AS spam,
contains(lower(concat_ws(' ', url, title)), 'idp') AND NOT {M("lower(concat_ws(' ', url, title))", '(^|[^a-z])idps?([^a-z]|$)')} AS fragment,
(coalesce({M('layer', '^(L2|L3|STRUCT):')}, false) OR {M('p', S.OFFICE_PRODUCER)}) AND NOT {M('p', S.PARTNER_SITE)} AND NOT coalesce(starts_with(place, 'Global ('), false) AS office_led,
{M('u', S.GLOSSARY)} OR {M('t', S.GLOSSARY_TITLE)} AS glossary, {cases(S.COARSE_POPULATIONS, "lower(coalesce(population, ''))", "lower(coalesce(population, ''))")} AS coarse FROM r""")
def record_signals(spark, d):
    c = F.col
    return _records(spark, d).withColumn("m", S.url_match(c("url"), c("priority"))).select(
        "id", "m.strength", "m.keyword", S.topic_filter(c("title"), c("url")).alias("topical"), S.source_filter(c("producer")).alias("sourced"), S.spam_flag(c("url"), c("title")).alias("spam"),
        S.url_fragment_only(c("url"), c("title")).alias("fragment"), S.office_led(c("layer"), c("producer"), c("place")).alias("office_led"), S.glossary_page(c("url"), c("title")).alias("glossary"), S.coarse_population(c("population")).alias("coarse"),
    )


ROUTE = "CASE WHEN id % 7 = 0 THEN 'IN HAND' WHEN access IN ('direct', 'open') THEN 'download now (no login)' WHEN access = 'public' THEN 'public-use (your login)' WHEN access IN ('licensed', 'remote') THEN 'licensed (apply)' ELSE 'gated - try UNHCR portal / login' END"
ACCESS = pick("id", ("direct", "open", "public", "licensed", "remote", "data"))


@query(f"""WITH {RECORDS}, a AS (SELECT *, {ACCESS} AS access FROM r) SELECT id, {cases(S.FAMILIES, 't', "'other'")} AS family, CASE WHEN {M('p', 'unhcr')} THEN 'UNHCR' WHEN {M('p', 'wb|world')} THEN 'World Bank' WHEN {M('t', 'mics|multiple indicator')} THEN 'UNICEF MICS' ELSE 'national/other' END AS source,
{M('t', S.SOCIO)} AND NOT {M('t', S.STOCK)} AS socio, {M("lower(concat_ws(' ', title, population))", S.DISPLACEMENT)} AS displacement, {ROUTE} AS route FROM a""")
def survey_kinds(spark, d):
    c = F.col
    rows = _records(spark, d).withColumn("access", F.expr(ACCESS))
    return rows.select("id", S.survey_family(c("title")).alias("family"), S.survey_source(c("producer"), c("title")).alias("source"), S.socio_economic(c("title")).alias("socio"), S.displacement_title(c("title"), c("population")).alias("displacement"), S.archive_route(c("id") % 7 == 0, c("access")).alias("route"))


AGENCY_LIST = "list_filter([" + ", ".join(f"CASE WHEN {M('f', p)} THEN {quoted(n)} END" for n, p in S.AGENCIES) + "], lambda x: x IS NOT NULL)"


@query(f"""WITH {RECORDS}, f AS (SELECT *, trim(regexp_replace(lower(coalesce(producer, '')), '[^a-z0-9]+', ' ', 'g')) AS f FROM (SELECT id, regexp_replace(producer, '([a-z])([A-Z])', '\\1 \\2', 'g') AS producer FROM r)), g AS (SELECT *, {AGENCY_LIST} AS a FROM f)
SELECT id, array_to_string(a, ',') AS agencies, {M('f', S.OFFICES)} AND len(a) = 0 AS is_office FROM g""")
def organisation_classes(spark, d):
    rows = _records(spark, d).withColumn("o", S.org_class(F.col("producer")))
    return rows.select("id", F.array_join("o.agencies", ",").alias("agencies"), F.col("o.is_office").alias("is_office"))


HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


@query(f"WITH h AS (SELECT page_id, {HOST} AS host FROM pages) SELECT page_id, host, {M('host', S.AGGREGATORS)} AS is_aggregator, contains(host, CASE page_id % 3 WHEN 0 THEN 'example.com' ELSE 'example.net' END) AS on_office FROM h")
def host_classes(spark, d):
    rows = t(spark, d, "pages").withColumn("h", S.host_tags(F.col("url"), F.expr("CASE page_id % 3 WHEN 0 THEN 'example.com' ELSE 'example.net' END")))
    return rows.select("page_id", "h.*")


DATED = "CASE doc_id % 5 WHEN 0 THEN 'x 2024-03-12 y' WHEN 1 THEN 'le 5 février 2023' WHEN 2 THEN 'Mayo 2022' WHEN 3 THEN '31 DECEMBER 2021, 2021-13-45' END"
SAID = f"lower(concat_ws(' ', {DATED}, text)[1:30000])"


def first_of(value: str, pattern: str) -> str:
    return f"nullif(regexp_extract({value}, {quoted('(' + pattern + ')')}, 1), '')"


@query(f"SELECT doc_id, coalesce({first_of(SAID, '20[0-9]{2}-[01][0-9]-[0-3][0-9]')}, {first_of(SAID, '[0-3]?[0-9][ ]+(?:' + S.MONTHS + ')[ ]+20[0-9]{2}')}, {first_of(SAID, '(?:' + S.MONTHS + ')[ ]+20[0-9]{2}')}) AS dated FROM documents")
def publication_dates(spark, d):
    return t(spark, d, "documents").select("doc_id", S.publication_date(F.expr(DATED), F.col("text"), F.lit(None).cast("string")).alias("dated"))


COUNTED = (
    "CAST(doc_id % 4 AS INT) AS total",
    "CAST(doc_id % 3 AS INT) AS ambiguous",
    "doc_id % 5 = 0 AS in_title",
    "CAST(doc_id % 7 % 2 AS INT) AS framework",
    "CAST(doc_id % 2 AS INT) AS activity",
    "CAST(doc_id % 6 % 2 AS INT) AS inclusion",
    "doc_id % 11 = 0 AS near",
    "CAST(doc_id % 13 % 2 AS INT) AS enterprise",
    "doc_id % 3 > 0 AS got_text",
    "CASE doc_id % 4 WHEN 0 THEN 'IDPs' WHEN 1 THEN 'refugees' WHEN 2 THEN '' END AS tags",
)


@query(f"""WITH c AS (SELECT doc_id, {", ".join(COUNTED)} FROM documents), k AS (SELECT *, greatest(total - ambiguous, 0) AS core FROM c)
SELECT doc_id, core, core = 0 AND total > 0 AND NOT in_title AND framework = 0 AS only_ambiguous, inclusion > 0 OR in_title AS included, activity > 0 AND (in_title OR (core >= 2 AND (inclusion > 0 OR in_title OR near))) AS strong,
got_text AND ((contains(lower(coalesce(tags, '')), 'idp') AND total = 0 AND (near OR enterprise > 0)) OR (core = 0 AND enterprise > 0 AND coalesce(tags, '') <> '')) AS wrong FROM k""")
def candidate_flags(spark, d):
    c = F.col
    rows = t(spark, d, "documents").selectExpr("doc_id", *COUNTED).withColumn("core", S.strong_count(c("total"), c("ambiguous"))).withColumn("included", S.has_inclusion(c("inclusion"), c("in_title")))
    return rows.select(
        "doc_id", "core", S.ambiguous_only(c("core"), c("total"), c("in_title"), c("framework")).alias("only_ambiguous"), "included",
        S.strong_candidate(c("activity"), c("in_title"), c("core"), c("included"), c("near")).alias("strong"), S.false_positive(c("got_text"), c("tags"), c("total"), c("core"), c("enterprise"), c("near")).alias("wrong"),
    )


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN NULL WHEN 'fr' THEN substr(text, 3, 400) ELSE nullif(substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 300), '') END AS excerpt FROM documents""")
def original_excerpts(spark, d):
    said = F.when(F.col("lang") == "fr", F.array(F.lit(None).cast("string"), F.expr("substr(text, 3)"))).otherwise(F.array().cast("array<string>"))
    return t(spark, d, "documents").select("doc_id", S.original_excerpt(F.col("lang"), said, F.col("text")).alias("excerpt"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-20'")
def orders_since(spark, d):
    return K.refresh_since(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), "1998-06-20", "o_orderdate")
