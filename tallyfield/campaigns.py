"""Registered queries of the campaign operators over columns told from the tables' keys, each with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import campaign as K
from .places_queries import M, pick
from .queries import query, t


@query("""SELECT DISTINCT c_nationkey, 'NEVER' AS status, 0::BIGINT AS n_responses FROM customer WHERE c_nationkey <> 3 AND c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8500)""")
def never_heard_nations(spark, d):
    answered = t(spark, d, "supplier").where("s_acctbal > 8500").select(F.col("s_nationkey").alias("c_nationkey"))
    return K.never_responded(t(spark, d, "customer"), answered, "c_nationkey", "3")


ORGS = ("National Statistics Office", "Ministry of Interior and Migration", "Central Bureau of Statistics", "Border Guard", "World Bank Group", "Statistical Institute")
WORDS = "list_distinct(list_filter(string_split(trim(regexp_replace(lower(coalesce(org, '')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND NOT regexp_matches(w, '^\\d+$')))"


@query(f"""WITH e AS (SELECT *, {WORDS} AS w FROM (SELECT o_orderkey AS example_id, o_custkey % 25 AS place, {pick('o_orderkey', ORGS)} AS org, o_orderkey % 3 = 0 AS is_office FROM orders)),
o AS (SELECT *, {WORDS} AS w FROM (SELECT s_suppkey AS org_id, s_nationkey AS place, {pick('s_suppkey', ORGS)} AS org FROM supplier)),
p AS (SELECT example_id, org_id, round(len(list_intersect(e.w, o.w)) / len(list_distinct(list_concat(e.w, o.w))) + CASE WHEN is_office AND list_has_any(o.w, ['statistics', 'statistical', 'statistik']) THEN 0.3 ELSE 0 END, 9) AS s FROM e JOIN o USING (place) WHERE len(e.w) > 0 AND len(o.w) > 0),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY s DESC, org_id) AS n FROM p) WHERE n = 1 AND s > 0)
SELECT example_id, CASE WHEN s >= 0.3 THEN org_id END AS org_id, coalesce(s, 0) AS score, coalesce(s, 0) < 0.34 AS weak FROM e LEFT JOIN b USING (example_id)""")
def organisation_matches(spark, d):
    examples = t(spark, d, "orders").selectExpr("o_orderkey AS example_id", "o_custkey % 25 AS place", f"{pick('o_orderkey', ORGS)} AS org", "o_orderkey % 3 = 0 AS is_office")
    orgs = t(spark, d, "supplier").selectExpr("s_suppkey AS org_id", "CAST(s_nationkey AS BIGINT) AS place", f"{pick('s_suppkey', ORGS)} AS org")
    return K.org_matches(examples, orgs, "place")


@query("SELECT l_orderkey, l_linenumber, l_quantity * s_acctbal AS weighted FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0")
def weighted_lines(spark, d):
    weights = t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    return K.weighted_units(t(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), weights, ["l_suppkey"]).select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("s_acctbal")).alias("weighted"))


@query("""SELECT c_custkey, c_custkey IN (SELECT s_suppkey * 3 FROM supplier WHERE s_suppkey % 4 = 0) OR c_custkey IN (SELECT s_suppkey * 5 FROM supplier WHERE s_suppkey % 4 = 1) OR c_custkey IN (SELECT s_suppkey * 5 + 1 FROM supplier WHERE s_suppkey % 4 = 1) AS bounced FROM customer""")
def bounced_customers(spark, d):
    log = t(spark, d, "customer").select("c_custkey", F.format_string(" User%d@Mail.org", "c_custkey").alias("to_email"))
    notices = t(spark, d, "supplier").selectExpr(
        "CASE WHEN s_suppkey % 4 = 0 THEN 'user' || s_suppkey * 3 || '@mail.org' WHEN s_suppkey % 4 = 1 THEN '' END AS failed_email",
        "CASE s_suppkey % 4 WHEN 0 THEN 'see user1@mail.org' WHEN 1 THEN 'to <user' || s_suppkey * 5 || '@mail.org>, USER' || (s_suppkey * 5 + 1) || '@MAIL.ORG failed; postmaster@mail.org' END AS body",
    )
    return K.bounced(log, notices).select("c_custkey", "bounced")


CATEGORIES = ("A. Strong", "B. Partner-led", "C. Evidence lead only", "D. Manual review", "E. Suppress")
TYPES = ("general", "department", "named staff", "national system", "partner", "data catalogue")
OUT = {
    "id": "o_orderkey", "category": pick("o_orderkey", CATEGORIES), "contact": "CASE WHEN o_custkey % 4 > 0 THEN 'c' || o_custkey END", "contact_type": f"CASE WHEN o_custkey % 4 > 0 THEN {pick('o_custkey', TYPES)} END",
    "contact_source": "CASE WHEN o_custkey % 3 = 0 THEN 'contact page' ELSE 'register' END", "has_office_contact": "o_custkey % 4 > 1", "lead": "CASE WHEN o_orderkey % 7 < 3 THEN 'likely partner-led' ELSE 'unclear' END",
    "humanitarian": "o_orderkey % 11 = 0", "is_new": "o_orderkey % 2 = 0", "nation": "o_custkey % 25", "title": "CASE WHEN o_orderkey % 5 > 0 THEN 'T' || o_orderkey END",
}
OUT_COLUMNS = [f"{v} AS {k}" for k, v in OUT.items()]
LEADS = f"WITH l AS (SELECT {', '.join(OUT_COLUMNS)} FROM orders)"


def _leads(spark, d):
    return t(spark, d, "orders").selectExpr(*OUT_COLUMNS)


@query(LEADS + """, c AS (SELECT *, left(category, 1) AS k, CASE WHEN contact IS NULL THEN 'none' WHEN contact_type IN ('general', 'department') AND contact_source = 'contact page' THEN 'high' WHEN contact_type IN ('general', 'department', 'named staff', 'national system') THEN 'medium' ELSE 'low' END AS contact_confidence, NOT has_office_contact AS contact_gap FROM l),
g AS (SELECT *, coalesce(contact_type = 'named staff', false) OR contact_confidence IN ('low', 'none') AS contact_validation_needed, CASE WHEN has_office_contact THEN NULL WHEN contact IS NOT NULL THEN 'only a partner''s or catalogue''s contact - not confirmed' ELSE 'no suitable public contact found' END AS contact_gap_reason FROM c)
SELECT id, contact_confidence, contact_validation_needed, contact_gap, contact_gap_reason,
CASE WHEN k IN ('E', 'C') THEN 'do not follow up yet' WHEN k = 'A' THEN 'NSO direct' WHEN k = 'B' AND lead = 'likely partner-led' AND contact IS NOT NULL THEN 'partner-supported follow-up' WHEN k = 'B' AND has_office_contact THEN 'NSO direct' WHEN k = 'B' OR contact_gap THEN 'manual contact search needed' ELSE 'do not follow up yet' END AS route,
CASE WHEN k = 'E' THEN 'none' WHEN humanitarian THEN 'low' WHEN k = 'A' THEN 'high' WHEN k IN ('B', 'D') THEN 'medium' WHEN k = 'C' THEN 'low' ELSE 'none' END AS priority,
CASE WHEN k = 'E' THEN 'Suppressed: false positive, spam or no evidence. Do not contact.' WHEN k = 'A' THEN 'Possible candidate of a national office; the office must confirm it.' || CASE WHEN contact_validation_needed THEN ' The contact needs validation.' ELSE '' END
 WHEN k = 'B' THEN 'Possible candidate led by a partner or an unclear institution; establish the office''s part first.' WHEN k = 'C' THEN 'Evidence lead only, not for outreach yet.'
 ELSE 'Manual review: contact, lead, population or source is unclear.' || CASE WHEN k = 'D' AND contact_gap THEN ' ' || upper(contact_gap_reason[1]) || contact_gap_reason[2:] || '.' ELSE '' END END AS notes FROM g""")
def outreach_routes(spark, d):
    return K.outreach(_leads(spark, d)).select("id", "contact_confidence", "contact_validation_needed", "contact_gap", "contact_gap_reason", "route", "priority", "notes")


@query(LEADS + """ SELECT nation, count(*) AS n_evidence, count(*) FILTER (is_new) AS n_new, count(*) FILTER (starts_with(category, 'A')) AS n_strong, count(*) FILTER (starts_with(category, 'B')) AS n_partner, count(*) FILTER (starts_with(category, 'D')) AS n_review,
arg_min(contact, id) FILTER (contact IS NOT NULL) AS contact, arg_min(title, id) FILTER (title IS NOT NULL) AS example FROM l GROUP BY nation""")
def nation_records(spark, d):
    return K.record_rollup(_leads(spark, d), "nation", "id")


CONCEPTS = ("refugee", "host_community", "idp", "water", "schooling", "poverty")
FACTS = {"example": "l_orderkey", "concept": pick("l_partkey", CONCEPTS), "kind": "CASE WHEN l_partkey % 7 < 3 THEN 'identification' ELSE 'indicator' END", "level": pick("l_suppkey", ("none", "text", "table", "microdata"))}
FACT_COLUMNS = [f"{v} AS {k}" for k, v in FACTS.items()]
COMPUTABLE = "kind = 'indicator' AND level IN ('microdata', 'table')"


@query(f"""WITH f AS (SELECT {", ".join(FACT_COLUMNS)} FROM lineitem), g AS (SELECT example, CASE max(CASE WHEN kind = 'identification' THEN CASE level WHEN 'none' THEN 0 WHEN 'text' THEN 1 WHEN 'table' THEN 2 WHEN 'microdata' THEN 3 ELSE 4 END END) WHEN 1 THEN 'text' WHEN 2 THEN 'table' WHEN 3 THEN 'microdata' ELSE 'none' END AS id_best,
count(*) FILTER (kind = 'identification' AND level = 'microdata') AS id_variables, coalesce(array_to_string(list_sort(list_distinct(list(concept) FILTER (kind = 'identification' AND concept IS NOT NULL))), ';'), '') AS groups, coalesce(bool_or(concept = 'host_community'), false) AS host_evidenced,
coalesce(array_to_string(list_sort(list_distinct(list(concept) FILTER ({COMPUTABLE} AND concept IS NOT NULL))), '; '), '') AS computable, coalesce(array_to_string(list_sort(list_distinct(list(concept) FILTER (kind = 'indicator' AND concept IS NOT NULL))), '; '), '') AS evidenced, count(DISTINCT concept) FILTER ({COMPUTABLE}) AS n_computable FROM f GROUP BY example)
SELECT o_orderkey AS example, coalesce(id_best, 'none') AS id_best, coalesce(id_variables, 0) AS id_variables, groups, host_evidenced, computable, evidenced, coalesce(n_computable, 0) AS n_computable,
CASE WHEN id_variables >= 3 THEN 'computable (microdata)' WHEN id_best = 'microdata' THEN 'partial (microdata)' WHEN id_best = 'table' THEN 'aggregate table' WHEN id_best = 'text' THEN 'text evidence only' ELSE 'none in downloaded data' END AS id_capability FROM orders LEFT JOIN g ON o_orderkey = example""")
def enriched_examples(spark, d):
    return K.enriched_frame(t(spark, d, "orders").select(F.col("o_orderkey").alias("example")), t(spark, d, "lineitem").selectExpr(*FACT_COLUMNS), "example")


ENTRY_URL = "CASE WHEN o_orderkey % 9 > 0 THEN 'https://c' || o_custkey % 7 || '.org/index.php/catalog/' || o_custkey % 40 || CASE WHEN o_orderkey % 2 = 0 THEN '/study' ELSE '' END ELSE 'https://c.org/other' END"
ENTRY = {"url": ENTRY_URL, "status": "CASE WHEN o_orderkey % 10 > 0 THEN 'ok' ELSE 'gone' END", "place": "CAST(o_custkey % 5 AS VARCHAR(2))", "population": pick("o_orderkey", ("refugees", "idps")), "title": "o_orderpriority"}
ENTRY_COLUMNS = [f"{v} AS {k}" for k, v in ENTRY.items()]


@query(f"""WITH m AS (SELECT {", ".join(ENTRY_COLUMNS)} FROM orders), e AS (SELECT *, regexp_extract(url, '^(https?://[^/]+)', 1) AS base, regexp_extract(url, '/catalog/([0-9]+)', 1) AS cat_id FROM m WHERE status = 'ok')
SELECT base, cat_id, array_to_string(list_sort(list_distinct(list(place))), ';') AS places, coalesce(array_to_string(list_sort(list_distinct(list(population) FILTER (population IS NOT NULL))), ';'), '') AS populations, min(url) AS url, min({{'u': url, 't': title}}).t AS title FROM e WHERE cat_id <> '' GROUP BY base, cat_id""")
def catalogue_entries(spark, d):
    return K.catalogue_entries(t(spark, d, "orders").selectExpr(*ENTRY_COLUMNS))


CENSUS = {"nation": "o_custkey % 25", "code": "CASE WHEN o_orderkey % 6 = 0 THEN 'census_2020' END", "title": pick("o_orderkey", ("Recensement general", "Yearbook", "RGPH 5", "Labour force survey")), "year": "CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' WHEN o_orderkey % 4 > 1 THEN CAST(1990 + o_orderkey % 33 AS VARCHAR(4)) END"}
CENSUS_COLUMNS = [f"{v} AS {k}" for k, v in CENSUS.items()]


@query(f"""WITH e AS (SELECT {", ".join(CENSUS_COLUMNS)} FROM orders) SELECT nation, count(*) AS n, array_to_string(list_sort(list_distinct(list(title[1:60]) FILTER (title IS NOT NULL))), ' | ') AS titles, max(try_cast(year AS INT)) AS last_year
FROM e WHERE contains(upper(coalesce(code, '')), 'CENSUS') OR {M("lower(coalesce(title, ''))", K.CENSUS_TITLE)} GROUP BY nation""")
def census_history(spark, d):
    return K.census_history(t(spark, d, "orders").selectExpr(*CENSUS_COLUMNS), "nation")


@query("""WITH r AS (SELECT l_orderkey, bool_or(l_returnflag = 'A') AS kept FROM lineitem WHERE l_discount > 0.08 GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN kept THEN 'recovered + verified' WHEN NOT kept THEN 'recovered - rejected (removed)' ELSE 'own link (trusted)' END AS provenance FROM orders LEFT JOIN r ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'""")
def file_provenance(spark, d):
    recovered = t(spark, d, "lineitem").where("l_discount > 0.08").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "A").alias("kept"))
    return K.provenance(t(spark, d, "orders").where("o_orderstatus = 'F'"), recovered, "o_orderkey")


POSITIONS = ("Director of Population Statistics", "Migration officer", "Chief Statistician", "Head of Demography", "Data manager", "Assistant", "Director General")
PEOPLE = {"id": "c_custkey", "nation": "c_nationkey", "position": pick("c_custkey", POSITIONS), "is_member": "CASE WHEN c_acctbal > 5000 THEN 'Yes' WHEN c_acctbal > 0 THEN 'no' END", "priority": "CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 5 END"}
PEOPLE_COLUMNS = [f"{v} AS {k}" for k, v in PEOPLE.items()]
PERSONS = f"WITH c AS (SELECT {', '.join(PEOPLE_COLUMNS)} FROM customer)"


@query(PERSONS + f", r AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY {M('''lower(coalesce(position, ''))''', K.ROLES)} DESC, coalesce(lower(is_member) = 'yes', false) DESC, priority NULLS LAST, id)::INT AS rank_in_place FROM c) SELECT nation, rank_in_place, id FROM r WHERE rank_in_place <= 2")
def primary_contacts(spark, d):
    people = t(spark, d, "customer").selectExpr(*PEOPLE_COLUMNS)
    return K.ranked_contacts(people, "nation", "id").where("rank_in_place <= 2").select("nation", "rank_in_place", "id")


FIT = """CASE WHEN regexp_matches(p, '(director|head|chief|deputy)') AND regexp_matches(p, '(population|demograph|social stat)') THEN 52 ELSE 0 END + CASE WHEN contains(p, 'migration') THEN 42 ELSE 0 END + CASE WHEN contains(p, 'statistician') THEN 21 ELSE 0 END
 + CASE WHEN regexp_matches(p, 'director general|president|chief executive') THEN 14 ELSE 0 END + CASE WHEN regexp_matches(p, 'international|cooperation|partnership') THEN 10 ELSE 0 END + CASE WHEN contains(p, 'census') THEN 10 ELSE 0 END
 + CASE WHEN regexp_matches(p, 'governance|peace|security') THEN 5 ELSE 0 END + CASE WHEN regexp_matches(p, 'information management|data') THEN 5 ELSE 0 END"""


@query(PERSONS + f""", f AS (SELECT id, nation, {FIT} AS title_fit FROM (SELECT *, lower(coalesce(position, '')) AS p FROM c) WHERE id % 50 < nation * 2), r AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY title_fit DESC, id)::INT AS rank_in_place, max(title_fit) OVER (PARTITION BY nation) AS best FROM f)
SELECT n_nationkey::INT AS nation, id, title_fit, rank_in_place, coalesce(best, 0) <= 0 AS no_fit FROM nation LEFT JOIN r ON n_nationkey = nation AND rank_in_place <= 3""")
def suggested_respondents(spark, d):
    people = t(spark, d, "customer").selectExpr(*PEOPLE_COLUMNS).where("id % 50 < nation * 2")
    targets = t(spark, d, "nation").select(F.col("n_nationkey").alias("nation"))
    return K.suggested_respondents(targets, people, "nation", "id").select("nation", "id", "title_fit", "rank_in_place", "no_fit")


@query(PERSONS + """, v AS (SELECT nation, count(*) AS n_contacts, count(*) FILTER (position = 'Assistant') AS n_with_position, count(*) FILTER (priority = 4 AND nation % 4 > 0) AS n_with_email FROM c WHERE id % 97 < nation AND nation % 3 > 0 GROUP BY nation),
m AS (SELECT n_nationkey::INT AS nation, 'P' || (1 + n_nationkey % 5) AS priority, CASE WHEN n_nationkey % 2 = 0 THEN 'web' END AS web_contact FROM nation)
SELECT nation, priority, CASE WHEN coalesce(n_contacts, 0) = 0 AND web_contact IS NOT NULL THEN 'no contact - one found on the web (validate before use)' WHEN coalesce(n_contacts, 0) = 0 THEN 'no contact at all' WHEN n_with_email = 0 AND web_contact IS NOT NULL THEN 'contacts lack email - one found on the web (validate before use)'
WHEN n_with_email = 0 THEN 'contacts but no email' WHEN n_with_position = 0 THEN 'contacts but no position info' ELSE 'covered' END AS gap FROM m LEFT JOIN v USING (nation) WHERE priority IN ('P1', 'P2', 'P3')""")
def nation_contact_gaps(spark, d):
    people = t(spark, d, "customer").selectExpr(*PEOPLE_COLUMNS).where("id % 97 < nation and nation % 3 > 0")
    coverage = people.groupBy("nation").agg(F.count("*").alias("n_contacts"), F.count_if(F.col("position") == "Assistant").alias("n_with_position"), F.count_if(F.expr("priority = 4 and nation % 4 > 0")).alias("n_with_email"))
    matrix = t(spark, d, "nation").selectExpr("n_nationkey AS nation", "'P' || (1 + n_nationkey % 5) AS priority", "CASE WHEN n_nationkey % 2 = 0 THEN 'web' END AS web_contact")
    return K.contact_gaps(matrix, coverage, "nation").select("nation", "priority", "gap")


MATCHES = {"id": "o_orderkey", "match_type": pick("o_orderkey", ("new_example_existing_place", "already_in_register", "new_place")), "match_confidence": pick("o_custkey", ("low", "medium", "High", "odd"))}
MATCH_COLUMNS = [f"{v} AS {k}" for k, v in MATCHES.items()]


@query(f"SELECT id, match_type, match_confidence FROM (SELECT {', '.join(MATCH_COLUMNS)} FROM orders) WHERE match_type = 'new_example_existing_place' OR (match_type = 'already_in_register' AND match_confidence = 'low')")
def matches_to_review(spark, d):
    return K.review_queue(t(spark, d, "orders").selectExpr(*MATCH_COLUMNS))


@query(f"SELECT id, match_confidence, CASE lower(match_confidence) WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 0 END AS sureness, '' AS reviewer_decision FROM (SELECT {', '.join(MATCH_COLUMNS)} FROM orders) WHERE match_type = 'already_in_register'")
def known_matches(spark, d):
    return K.known_by_confidence(t(spark, d, "orders").selectExpr(*MATCH_COLUMNS), ["id"]).select("id", "match_confidence", "sureness", "reviewer_decision")


ROSTER = {
    "id": "o_orderkey", "url": "CASE WHEN o_orderkey % 8 > 1 THEN 'http://x/' || o_orderkey WHEN o_orderkey % 8 = 1 THEN ' ' END", "source_type": "CASE WHEN o_orderkey % 3 = 0 THEN 'web_page' ELSE 'file' END", "tier": pick("o_custkey", ("AUTO", "AUTO_META", "PAGE")),
    "reachability": pick("o_custkey", ("live", "blocked", "gone", "dead_host")), "title": pick("o_orderkey", ("Water and schooling", "Poverty of refugees", "Census", "")), "description": pick("o_custkey", ("on health", "host water")), "source_tool": pick("o_orderkey", ("household survey", "administrative", "", "other")),
    "has_framework": "o_orderkey % 3 = 1", "is_microdata": "CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 2 = 0 END", "host_signal": "CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 3 = 1 END",
}
ROSTER_COLUMNS = [f"{v} AS {k}" for k, v in ROSTER.items()]
PLAN = f"""WITH r AS (SELECT {', '.join(ROSTER_COLUMNS)} FROM orders), q AS (SELECT * REPLACE (CASE WHEN trim(url) <> '' THEN reachability ELSE 'no_link' END AS reachability, CASE WHEN trim(url) <> '' THEN source_type ELSE 'none' END AS source_type) FROM r),
p AS (SELECT *, CASE WHEN reachability = 'live' AND tier IN ('AUTO', 'AUTO_META') THEN tier WHEN reachability = 'live' THEN 'SCRAPE' WHEN reachability = 'blocked' THEN 'SCRAPE_BROWSER' ELSE 'RECOVER' END AS action FROM q),
a AS (SELECT o_orderkey AS id, 'http://archive/' || o_orderkey AS archive_url FROM orders WHERE o_totalprice > 350000), m AS (SELECT o_orderkey AS id, 'http://live/' || o_orderkey AS match_url FROM orders WHERE o_orderpriority LIKE '1%'),
v AS (SELECT p.id, coalesce(archive_url, match_url) AS recovered_url, CASE WHEN archive_url IS NOT NULL THEN 'archive' WHEN match_url IS NOT NULL THEN 'crossmatch' ELSE 'none' END AS recovery FROM p LEFT JOIN a USING (id) LEFT JOIN m USING (id) WHERE action = 'RECOVER')
"""
DOMAINS = {"water": "water|sanitation", "education": "school", "poverty": "poverty", "health": "health"}


def _roster(spark, d):
    rows = t(spark, d, "orders").selectExpr(*ROSTER_COLUMNS)
    plan = K.download_plan(rows)
    archived = t(spark, d, "orders").where("o_totalprice > 350000").selectExpr("o_orderkey AS id", "'http://archive/' || o_orderkey AS archive_url")
    matched = t(spark, d, "orders").where("o_orderpriority LIKE '1%'").selectExpr("o_orderkey AS id", "'http://live/' || o_orderkey AS match_url")
    return rows, plan, K.recovery(plan, archived, matched, "id")


@query(PLAN + "SELECT id, reachability, source_type, action FROM p")
def download_plan(spark, d):
    return _roster(spark, d)[1].select("id", "reachability", "source_type", "action")


@query(PLAN + "SELECT id, recovered_url, recovery FROM v")
def recovered_sources(spark, d):
    return _roster(spark, d)[2].select("id", "recovered_url", "recovery")


HITS = "list_filter([" + ", ".join(f"CASE WHEN {M('''lower(concat_ws(' ', title, description))''', p)} THEN '{n}' END" for n, p in DOMAINS.items()) + "], lambda x: x IS NOT NULL)"


@query(PLAN + f"""SELECT p.id, CASE WHEN action LIKE 'AUTO%' THEN 'downloadable (API)' WHEN action = 'SCRAPE' THEN 'downloadable (scrape)' WHEN action = 'SCRAPE_BROWSER' THEN 'needs browser scrape' WHEN recovery <> 'none' THEN 'recovered (re-check)' ELSE 'data request needed' END AS data_access,
CASE WHEN regexp_matches(source_tool, 'survey|census') THEN 'microdata (survey/census)' WHEN regexp_matches(source_tool, 'administrative|register|integration') THEN 'admin/register data' WHEN source_tool <> '' THEN 'aggregate/other' ELSE 'unknown' END AS granularity,
CASE WHEN has_framework AND is_microdata THEN 'computable (framework + microdata)' WHEN has_framework THEN 'reported only (framework, aggregate)' WHEN is_microdata THEN 'possible (microdata, framework unstated)' ELSE 'unclear' END AS id_capability,
array_to_string({HITS}, '; ') AS domains, len({HITS}) > 0 AND coalesce(is_microdata, false) AS disaggregatable, coalesce(host_signal, false) AND coalesce(is_microdata, false) AS host_comparison FROM p LEFT JOIN v USING (id)""")
def analysis_frame(spark, d):
    rows, plan, found = _roster(spark, d)
    return K.analysis_frame(rows, plan, found, "id", DOMAINS).select("id", "data_access", "granularity", "id_capability", "domains", "disaggregatable", "host_comparison")


EASE_COLUMNS = ["o_orderkey % 17 = 0 AS in_hand", "o_orderkey % 13 = 0 AS by_interface", "o_orderkey % 11 = 0 AS has_file_link", "o_custkey % 2 = 0 AS drilled", "o_custkey % 7 = 0 AS found", pick("o_custkey", ("CONFIRMED", "SUSPECT", "MISMATCH")) + " AS verdict"]


@query(f"""WITH r AS (SELECT {', '.join(ROSTER_COLUMNS + EASE_COLUMNS)} FROM orders), e AS (SELECT *, CASE WHEN in_hand THEN 1 WHEN by_interface THEN 2 WHEN has_file_link THEN 3 WHEN reachability = 'live' AND source_type = 'web_page' AND drilled THEN 4 WHEN reachability = 'live' OR found THEN 5 WHEN reachability = 'blocked' THEN 6 ELSE 9 END AS ease_tier, coalesce(verdict, 'roster-own') AS reliability FROM r)
SELECT id, ease_tier, reliability, ['already in hand', 'statistical interface', 'direct data-file link', 'page with dataset (fetch+extract)', 'scrape live page/office site', 'needs browser (blocked)'][ease_tier] AS method FROM e WHERE ease_tier <= 6
ORDER BY ease_tier, coalesce(is_microdata, false) DESC, CASE reliability WHEN 'CONFIRMED' THEN 1 WHEN 'roster-own' THEN 2 WHEN 'SUSPECT' THEN 3 WHEN 'MISMATCH' THEN 4 ELSE 5 END, id LIMIT 150""")
def easiest_records(spark, d):
    return K.by_ease(t(spark, d, "orders").selectExpr(*ROSTER_COLUMNS, *EASE_COLUMNS), "id", 150).select("id", "ease_tier", "reliability", "method")


POINT_COLUMNS = ["l_orderkey * 10 + l_linenumber AS id", "CASE WHEN l_linenumber < 6 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR(9)) || CASE WHEN l_linenumber = 2 THEN ' ,5' ELSE '' END WHEN l_linenumber = 6 THEN ' ' END AS value", "CASE WHEN l_partkey % 9 > 0 THEN 'a share of ' || CAST(l_suppkey AS VARCHAR(9)) || '.5 percent' END AS evidence"]


@query(f"""WITH p AS (SELECT {', '.join(POINT_COLUMNS)} FROM lineitem), n AS (SELECT id, replace(regexp_replace(lower(coalesce(value, '')), '\\s', '', 'g'), ',', '.') AS v, replace(regexp_replace(lower(evidence), '\\s', '', 'g'), ',', '.') AS e FROM p) SELECT id, coalesce(v <> '' AND contains(e, v), false) AS kept FROM n""")
def regated_values(spark, d):
    return K.regated(t(spark, d, "lineitem").selectExpr(*POINT_COLUMNS)).select("id", "kept")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 = 0 AND o_orderstatus = 'F' AND o_orderkey % 5 > 0")
def pilot_ready_sets(spark, d):
    rows = t(spark, d, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderkey % 2 = 0 AS dictionary", "o_custkey % 3 = 0 AS has_displacement", "o_orderstatus = 'F' AS has_weight", "o_orderkey % 5 AS n_inputs")
    return K.pilot_ready(rows).select("o_orderkey", "o_custkey")


@query("""SELECT c_custkey, replace('Dear' || chr(10) || c_name, chr(10), '<br>') AS body_html, '' AS cc_email FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def letters_to_send(spark, d):
    emails = t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("tier"), F.when(F.col("c_acctbal") > 0, "a@b.org").otherwise(" ").alias("to_email"), F.concat(F.lit("Dear\n"), "c_name").alias("body"), F.lit(None).cast("string").alias("cc_email"))
    log = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "sent").otherwise("draft").alias("status"))
    return K.send_export(emails, log, "c_custkey", ["BUILDING", "MACHINERY"]).select("c_custkey", "body_html", "cc_email")


TIERS = ("reach out", "review - possible register match", "watch / context", "low", "not assessed")
KINDS = ("same product", "new edition", "check - likely same", "new output", "")


@query(f"""WITH k AS (SELECT o_orderkey, {pick('o_orderkey', KINDS)} AS k, {pick('o_custkey', TIERS)} AS t FROM orders) SELECT o_orderkey, CASE WHEN k = 'same product' THEN 'already in register (same product)' WHEN k = 'new edition' THEN 'new edition of an example' WHEN k LIKE 'check%' THEN 'check (undecided)' ELSE 'new - not in register' END AS in_register,
CASE WHEN t IN ('reach out', 'review - possible register match') THEN 'yes - ask for it' WHEN t = 'watch / context' THEN 'maybe' WHEN t = 'low' THEN 'no - not relevant' ELSE 'not scored' END AS relevance FROM k""")
def reviewer_terms(spark, d):
    return t(spark, d, "orders").select("o_orderkey", K.reviewer_terms(F.expr(pick("o_orderkey", KINDS)), F.expr(pick("o_custkey", TIERS))).alias("r")).select("o_orderkey", "r.*")


@query("""WITH p AS (SELECT event_id, 'k' || (user_id % 40) AS phrase FROM events WHERE event_id % 10 > 0 UNION ALL SELECT event_id, event_type FROM events WHERE event_id % 10 > 0)
SELECT phrase, 'general' AS population, CAST(NULL AS VARCHAR) AS rationale, min(event_id) AS source, '' AS approved FROM p GROUP BY phrase""")
def suggested_keywords(spark, d):
    answers = t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "no json").otherwise(F.format_string('[{"phrase": "k%d"}, {"phrase": "%s"}, {}]', F.col("user_id") % 40, F.col("event_type"))).alias("answer"))
    return K.keyword_suggestions(answers, "event_id")


@query("""WITH m AS (SELECT l_partkey AS source, l_orderkey * 10 + l_linenumber AS candidate, l_discount AS score, CASE WHEN l_linenumber < 6 THEN l_returnflag = 'A' END AS confirmed FROM lineitem)
SELECT source, candidate, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY coalesce(confirmed, false) DESC, score DESC, candidate)::INT AS rank FROM m) WHERE rank <= 3""")
def best_candidates(spark, d):
    rows = t(spark, d, "lineitem").selectExpr("l_partkey AS source", "l_orderkey * 10 + l_linenumber AS candidate", "l_discount AS score", "CASE WHEN l_linenumber < 6 THEN l_returnflag = 'A' END AS confirmed")
    return K.best_candidates(rows, "source", "candidate").select("source", "candidate", "rank")


@query("""WITH v AS (SELECT CAST(l_quantity AS INT) AS value, 'M' || l_linenumber AS measure, CAST(l_partkey % 9 AS INT) AS code, l_orderkey AS id, CASE WHEN l_returnflag = 'A' THEN 'published' ELSE 'demonstration tabulation' END AS value_type, CASE WHEN l_returnflag <> 'A' THEN l_tax END AS se FROM lineitem)
SELECT id, code, value, value_type, se, coalesce('Title ' || r_regionkey, measure) AS title, code IN (1, 3) AS is_priority FROM v LEFT JOIN region ON code = r_regionkey""")
def indicator_values(spark, d):
    rows = t(spark, d, "lineitem").selectExpr("CAST(l_quantity AS INT) AS value", "'M' || l_linenumber AS measure", "CAST(l_partkey % 9 AS INT) AS code", "l_orderkey AS id", "l_returnflag", "l_tax AS se")
    titles = t(spark, d, "region").selectExpr("r_regionkey AS code", "'Title ' || r_regionkey AS title")
    both = K.published_and_demonstrated(rows.where("l_returnflag = 'A'").drop("l_returnflag", "se"), rows.where("l_returnflag <> 'A'").drop("l_returnflag"), titles, [1, 3])
    return both.select("id", "code", "value", "value_type", "se", "title", "is_priority")
