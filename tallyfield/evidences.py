"""Registered queries of full evidence scores, overviews and letters, each with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import evidence as E
from .places_queries import pick
from .queries import query, t

RECORD = {
    "id": "o_orderkey", "nation": "o_custkey % 25", "title": "CASE WHEN o_orderkey % 9 > 0 THEN 'T' || o_orderkey END", "core": "CAST(o_orderkey % 120 AS INT)", "core_strong": "CAST(o_orderkey % 4 AS INT)", "framework": "CAST(o_custkey % 3 % 2 AS INT)",
    "migration": "CAST(o_custkey % 7 % 2 AS INT)", "has_inclusion": "o_orderkey % 5 = 0", "near": "o_orderkey % 7 = 0", "birth_near": "o_orderkey % 11 = 0", "office_led": "CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 5 = 1 END",
    "in_title": "o_orderkey % 13 = 0", "trust": pick("o_custkey", ("HIGH (curated catalog)", "LOW", "HIGH (x)")), "doc_type": "CASE WHEN o_custkey % 2 = 0 THEN 'PDF (scan)' WHEN o_custkey % 3 = 0 THEN 'html' END", "pub_year": "CASE WHEN o_orderkey % 3 > 0 THEN 2022 + CAST(o_orderkey % 7 AS INT) END",
    "spam": "o_orderkey % 29 = 0", "false_positive": "o_orderkey % 31 = 0", "override": "o_orderkey % 37 = 0", "ambiguous_only": "o_orderkey % 17 = 0", "got_text": "o_orderkey % 6 > 0", "inventory_only": "o_custkey % 2 = 1", "official": "o_orderkey % 8 = 0",
    "strong": "o_orderkey % 5 < 2", "has_office_contact": "o_custkey % 3 = 0", "lead": pick("o_custkey", ("likely country-led", "likely partner-led", "unclear")), "language": "CASE WHEN o_custkey % 4 > 0 THEN 'French' END",
    "published": "CASE WHEN o_orderkey % 2 = 0 THEN 'May 2024' END", "humanitarian": "o_orderkey % 10 = 0", "register_flag": pick("o_custkey", ("IN", "NEW")), "contact": "CASE WHEN o_custkey % 25 > 3 THEN 'c' END", "counted": "o_orderkey % 4 = 1", "match_type": pick("o_orderkey", ("new_place", "already_in_register")),
}
COLUMNS = [f"{v} AS {k}" for k, v in RECORD.items()]
RECORDS = f"""WITH l AS (SELECT * REPLACE (coalesce(office_led, false) AS office_led) FROM (SELECT {", ".join(COLUMNS)} FROM orders)),
w AS (SELECT *, core + framework * 10 + 15 * has_inclusion::INT + 15 * near::INT + 10 * birth_near::INT + 20 * office_led::INT + 25 * in_title::INT + 15 * coalesce(contains(trust, 'HIGH'), false)::INT + 10 * coalesce(starts_with(doc_type, 'PDF'), false)::INT
 + CASE WHEN pub_year >= 2026 THEN 12 WHEN pub_year = 2025 THEN 6 ELSE 0 END AS raw, got_text AND core_strong = 0 AND framework = 0 AS bare FROM l),
s AS (SELECT *, (CASE WHEN spam OR false_positive THEN 0 WHEN override THEN raw WHEN ambiguous_only THEN least(raw, 25) WHEN bare AND migration = 0 THEN least(raw, 20) WHEN bare THEN least(raw, 30) WHEN inventory_only AND NOT got_text THEN least(raw, 45) ELSE least(raw, 100) END)::INT AS score,
CASE WHEN spam OR false_positive THEN 'E. Suppress' WHEN bare AND migration = 0 AND NOT override AND NOT official AND coalesce(trust, '') <> 'HIGH (curated catalog)' THEN 'E. Suppress' WHEN official AND NOT has_inclusion AND NOT in_title AND core_strong = 0 AND NOT override THEN 'C. Evidence lead only'
 WHEN ambiguous_only AND NOT override THEN 'C. Evidence lead only' WHEN (office_led OR coalesce(lead, '') = 'likely country-led') AND strong AND has_office_contact THEN 'A. Strong NSO follow-up candidate' WHEN (office_led OR coalesce(lead, '') = 'likely country-led') AND strong THEN 'D. Manual review needed'
 WHEN strong AND lead IN ('likely partner-led', 'unclear') THEN 'B. Strong candidate but partner-led or unclear lead' WHEN NOT got_text OR core_strong > 0 THEN 'D. Manual review needed' WHEN framework > 0 OR migration > 0 THEN 'C. Evidence lead only' ELSE 'D. Manual review needed' END AS category FROM w)
"""


def _scored(spark, d):
    return E.scored(t(spark, d, "orders").selectExpr(*COLUMNS))


@query(RECORDS + "SELECT id, score, category FROM s")
def evidence_scores(spark, d):
    return _scored(spark, d).select("id", "score", "category")


@query(RECORDS + """, f AS (SELECT *, concat_ws(', ', CASE WHEN core_strong > 0 THEN 'refugee terms (' || core_strong || ')' END, CASE WHEN framework > 0 THEN 'framework terms (' || framework || ')' END) AS found FROM s)
SELECT id, concat_ws(' ', concat_ws(' ', coalesce(language, 'Unknown-language'), CASE WHEN doc_type LIKE 'PDF%' THEN 'PDF document' ELSE 'web page' END, '(' || published || ')') || '.',
CASE WHEN spam THEN 'Excluded: address or title point to unrelated commercial content.' WHEN false_positive THEN 'Suppressed: the match comes from an unrelated term.' WHEN NOT got_text THEN 'The text could not be read - check by hand.' WHEN found = '' THEN 'No terms of a population were found.' ELSE 'Screening found ' || found || '.' END,
CASE lead WHEN 'likely country-led' THEN 'It appears to be led by the country.' WHEN 'likely partner-led' THEN 'It appears to be led by a partner.' WHEN 'unclear' THEN 'The lead institution is unclear.' END, CASE WHEN has_inclusion THEN 'A displaced group may be counted; verify the table.' END, 'Next step:',
CASE left(category, 1) WHEN 'A' THEN 'Manual review, then possible follow-up with the office.' WHEN 'B' THEN 'Manual review to clarify the lead institution before any follow-up.' WHEN 'C' THEN 'Keep as landscape context; no outreach for now.' WHEN 'D' THEN 'Manual review needed.' ELSE 'No action - suppressed.' END) AS comment FROM f""")
def evidence_comments(spark, d):
    return _scored(spark, d).select("id", E.comment({"core_strong": "refugee terms", "framework": "framework terms"}).alias("comment"))


@query(RECORDS + """, g AS (SELECT n_nationkey::BIGINT AS nation, CASE n_nationkey % 3 WHEN 0 THEN 'en,fr' WHEN 1 THEN 'es' END AS languages FROM nation WHERE n_nationkey < 20), i AS (SELECT s_nationkey::BIGINT AS nation, count(*) AS total, CASE WHEN s_nationkey % 2 = 0 THEN 'NONE' ELSE 'full' END AS coverage FROM supplier WHERE s_nationkey > 2 GROUP BY s_nationkey),
q AS (SELECT c_nationkey::BIGINT AS nation, count(*) AS n_done FROM customer WHERE c_custkey % 100 < 10 AND c_nationkey % 4 > 0 GROUP BY c_nationkey), r AS (SELECT * FROM s WHERE nation % 6 > 0),
c AS (SELECT nation, count(*) AS n_records, count(*) FILTER (category NOT LIKE 'E%') AS n_candidates, count(*) FILTER (category LIKE 'A%') AS n_high, count(*) FILTER (category LIKE 'D%') AS n_review, count(*) FILTER (NOT got_text) AS n_failed, bool_or(has_office_contact) AS has_contact FROM r GROUP BY nation),
k AS (SELECT nation, string_agg('[' || category[1] || '] ' || coalesce(title, 'null') || ' (score ' || score || ')', ' | ' ORDER BY n) AS top_candidates FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY score DESC, id) AS n FROM r WHERE category NOT LIKE 'E%') WHERE n <= 3 GROUP BY nation),
o AS (SELECT nation, coverage, total, top_candidates, coalesce(n_done, 0) AS n_done, coalesce(n_records, 0) AS n_records, coalesce(n_high, 0) AS n_high, coalesce(n_review, 0) AS n_review, coalesce(n_failed, 0) AS n_failed, coalesce(has_contact, false) AS has_contact, 3 * (length(languages) - length(replace(languages, ',', '')) + 1) + 1 AS n_expected
 FROM g FULL JOIN i USING (nation) LEFT JOIN q USING (nation) LEFT JOIN c USING (nation) LEFT JOIN k USING (nation)),
u AS (SELECT *, CASE WHEN n_done = 0 AND coverage IS NULL THEN 'not started' WHEN coverage = 'NONE' AND n_done = 0 THEN 'failed' WHEN n_done > 0 AND n_done < n_expected THEN 'in progress' ELSE 'completed' END AS status,
 CASE WHEN n_records = 0 THEN 'no records to extract' WHEN n_failed = 0 THEN 'all extracted' WHEN n_failed = n_records THEN 'extraction failed' ELSE n_failed || ' of ' || n_records || ' failed' END AS extraction FROM o)
SELECT nation, status, extraction, top_candidates, CASE WHEN has_contact THEN 'contact found' WHEN n_records > 0 THEN 'no contact found - gap' ELSE 'not searched' END AS contact_search,
CASE WHEN n_high > 0 AND has_contact THEN 'candidate ready for possible follow-up (manual review first)' WHEN n_review > 0 THEN 'candidate found but manual review needed' WHEN n_records > 0 AND NOT has_contact THEN 'contact gap - manual contact search' WHEN status = 'failed' THEN 'failed website access - retry or manual check'
WHEN status = 'in progress' THEN 'continue search (resumable)' WHEN status = 'not started' THEN 'not yet processed' WHEN n_records = 0 AND total > 0 THEN 'no evidence detected' ELSE 'insufficient automated coverage - manual check' END AS next_action FROM u""")
def processing_overview(spark, d):
    registry = t(spark, d, "nation").where("n_nationkey < 20").selectExpr("CAST(n_nationkey AS BIGINT) AS nation", "CASE n_nationkey % 3 WHEN 0 THEN 'en,fr' WHEN 1 THEN 'es' END AS languages")
    inventory = t(spark, d, "supplier").where("s_nationkey > 2").groupBy(F.col("s_nationkey").cast("long").alias("nation")).agg(F.count("*").alias("total")).withColumn("coverage", F.expr("CASE WHEN nation % 2 = 0 THEN 'NONE' ELSE 'full' END"))
    searches = t(spark, d, "customer").where("c_custkey % 100 < 10 and c_nationkey % 4 > 0").select(F.col("c_nationkey").cast("long").alias("nation"))
    found = E.overview(registry, inventory, searches, _scored(spark, d).where("nation % 6 > 0"), "nation", "id")
    return found.select("nation", "status", "extraction", "top_candidates", "contact_search", "next_action")


FLAG = "count(*) FILTER ({})"
ROLLUP = ", ".join(f"{FLAG.format(c)} AS {n}" for n, c in (
    ("actionable", "category[1] IN ('A', 'B', 'D')"), ("official_actionable", "category[1] IN ('A', 'B', 'D') AND NOT humanitarian"), ("humanitarian_records", "humanitarian"), *[(f"n_{x.lower()}", f"category LIKE '{x}%'") for x in "ABCDE"],
    ("in_register", "register_flag = 'IN'"), ("not_in_register", "register_flag = 'NEW'"), ("confirmed_inclusion", "counted"), ("new_examples", "match_type = 'new_place'"), ("known_examples", "match_type = 'already_in_register'"),
))


@query(RECORDS + f"SELECT nation, count(*) AS records, {ROLLUP}, max(score) AS top_score, bool_or(contact IS NOT NULL) AS has_contact FROM s GROUP BY nation")
def place_measures(spark, d):
    return E.star_pack(_scored(spark, d), t(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("text")), "nation")["dim"]


@query("""WITH h AS (SELECT l_orderkey, bool_or(l_linenumber = 1 AND l_returnflag = 'A') AS has_data, bool_or(l_linenumber = 2) AS has_document, bool_or(l_linenumber = 7) AS has_candidate, count(*) AS n_files FROM lineitem WHERE l_tax < 0.03 GROUP BY l_orderkey)
SELECT o_orderkey AS id, coalesce(n_files, 0) AS n_files, coalesce(has_candidate AND NOT has_data, false) AS unverified_candidate, CASE WHEN o_totalprice > 400000 THEN 'confirmed dataset' WHEN has_data THEN 'data in hand' WHEN has_document THEN 'extract from report in hand' WHEN o_custkey % 2 = 0 THEN 'fetch, then extract' ELSE 'reach out (no online source)' END AS route FROM orders LEFT JOIN h ON o_orderkey = l_orderkey""")
def archive_holdings(spark, d):
    files = t(spark, d, "lineitem").where("l_tax < 0.03").selectExpr("l_orderkey AS id", "CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN 'data.CSV' WHEN l_linenumber = 2 THEN 'report.pdf' WHEN l_linenumber = 7 THEN 'Candidate.txt' ELSE 'x.bin' END AS name")
    orders = t(spark, d, "orders").selectExpr("o_orderkey AS id", "o_custkey % 2 = 0 AS has_link")
    confirmed = t(spark, d, "orders").where("o_totalprice > 400000").selectExpr("o_orderkey AS id", "'set' AS dataset")
    return E.holdings(orders, files, confirmed, "id").select("id", "n_files", "unverified_candidate", "route")


@query("""WITH k AS (SELECT l_orderkey, l_linenumber AS rank, 'fact ' || l_linenumber AS fact, l_linenumber IN (3, 6) AS meeting FROM lineitem WHERE l_linenumber < 7), p AS (SELECT l_orderkey, min(rank) AS rank, arg_min(fact, rank) AS primary_fact, arg_min(meeting, rank) AS is_meeting, arg_min(fact, rank) FILTER (meeting) AS m FROM k GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(rank, 10) AS rank, coalesce(primary_fact, 'none') AS primary_fact, CASE WHEN NOT is_meeting THEN m END AS secondary_fact FROM orders LEFT JOIN p ON o_orderkey = l_orderkey""")
def opening_facts(spark, d):
    lines = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.concat(F.lit("t"), "l_linenumber")).alias("tokens"))
    contacts = t(spark, d, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    precedence = spark.range(1, 7).selectExpr("'t' || id AS token", "CAST(id AS INT) AS rank", "'fact ' || id AS fact", "id IN (3, 6) AS meeting")
    return E.fact_precedence(contacts, precedence, "o_orderkey")


@query("""WITH e AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS k, '- ' || CASE WHEN o_orderkey % 5 > 0 THEN 'T' || o_orderkey ELSE '(untitled)' END || CASE WHEN o_orderkey % 3 > 0 THEN ' (' || year(o_orderdate) || ')' ELSE '' END || CASE WHEN o_orderkey % 2 = 0 THEN ': http://x' ELSE '' END AS line FROM orders),
l AS (SELECT o_custkey, any_value(k) AS n_examples, string_agg(line, chr(10) ORDER BY n) AS bullets FROM e WHERE n <= 4 GROUP BY o_custkey)
SELECT c_custkey AS customer, 'u' || c_custkey AS email, n_examples, CASE WHEN c_nationkey = 1 THEN 'Cher ' ELSE 'Dear ' END || CASE WHEN c_acctbal > 0 THEN c_name ELSE 'colleague' END || chr(10) || bullets || CASE WHEN n_examples > 4 THEN chr(10) || CASE WHEN c_nationkey = 1 THEN 'et ' ELSE 'and ' END || (n_examples - 4) || CASE WHEN c_nationkey = 1 THEN ' autres' ELSE ' more' END ELSE '' END AS body
FROM customer JOIN l ON c_custkey = o_custkey""")
def customer_letters(spark, d):
    examples = t(spark, d, "orders").selectExpr("o_custkey AS customer", "o_orderkey AS id", "CASE WHEN o_orderkey % 5 > 0 THEN 'T' || o_orderkey END AS title", "CASE WHEN o_orderkey % 3 > 0 THEN year(o_orderdate) END AS year", "CASE WHEN o_orderkey % 2 = 0 THEN 'http://x' END AS url", "o_totalprice AS score")
    contacts = t(spark, d, "customer").selectExpr("c_custkey AS customer", "CASE WHEN c_acctbal > 0 THEN c_name END AS name", "'u' || c_custkey AS email", "CASE c_nationkey WHEN 1 THEN 'fr' WHEN 2 THEN 'xx' WHEN 3 THEN 'en' END AS language")
    templates = spark.createDataFrame([("en", "Dear %s", "and %d more"), ("fr", "Cher %s", "et %d autres")], "language string, greeting string, more string")
    return E.letters(examples, contacts, templates, "customer", "id")


@query("""WITH m AS (SELECT l_suppkey AS org, 'P' || l_partkey % 50 AS title, bool_or(l_linenumber = 7) AS weak, min(CASE WHEN l_partkey % 4 > 0 THEN CASE WHEN l_quantity < 40 THEN 'low' ELSE 'high' END END) AS confidence FROM lineitem WHERE l_suppkey % 10 > 0 GROUP BY 1, 2),
o AS (SELECT org, count(*) AS n_titles, bool_or(weak) AS w, coalesce(avg(CASE WHEN confidence = 'low' THEN 1.0 WHEN confidence IS NOT NULL THEN 0.0 END) > 0.5, false) AS low FROM m GROUP BY org), c AS (SELECT c_custkey % 100 AS org, arg_min('u' || c_custkey, c_custkey) AS to_email, count(*) - 1 AS n_copies FROM customer WHERE c_custkey % 100 % 3 > 0 AND c_custkey % 7 = 0 GROUP BY 1)
SELECT org, n_titles, to_email, coalesce(n_copies, 0) AS n_copies, concat_ws('; ', CASE WHEN w THEN 'weak organisation match' END, CASE WHEN low THEN 'mostly low confidence' END, CASE WHEN to_email IS NULL THEN 'no contact' END) AS flags FROM o LEFT JOIN c USING (org)""")
def supplier_drafts(spark, d):
    matched = t(spark, d, "lineitem").selectExpr("CASE WHEN l_suppkey % 10 > 0 THEN l_suppkey END AS org", "'P' || l_partkey % 50 AS title", "l_linenumber = 7 AS weak", "CASE WHEN l_partkey % 4 > 0 THEN CASE WHEN l_quantity < 40 THEN 'low' ELSE 'high' END END AS confidence")
    contacts = t(spark, d, "customer").where("c_custkey % 100 % 3 > 0 and c_custkey % 7 = 0").selectExpr("c_custkey % 100 AS org", "'u' || c_custkey AS email", "1 AS rank", "c_custkey AS id")
    return E.organisation_drafts(matched, contacts, "org", "id")


@query("""WITH k AS (SELECT CASE o_custkey % 7 WHEN 0 THEN 'EL' WHEN 1 THEN 'FR' WHEN 2 THEN 'EU' WHEN 3 THEN 'EA19' WHEN 4 THEN 'UK' ELSE 'DE' END AS geo, year(o_orderdate)::INT AS year FROM orders)
SELECT CASE geo WHEN 'EL' THEN 'Greece' ELSE 'Place ' || geo END AS country, 'Stock (' || max(year) || ')' AS title, 'http://api/flow?geo=' || geo AS url, max(year) AS year, 'Statistical interface' AS producer, 'STRUCT' AS source_layer, 'HIGH (structured API)' AS trust FROM k WHERE geo NOT IN ('EU', 'EA19') GROUP BY geo""")
def structured_records(spark, d):
    cells = t(spark, d, "orders").selectExpr("CASE o_custkey % 7 WHEN 0 THEN 'EL' WHEN 1 THEN 'FR' WHEN 2 THEN 'EU' WHEN 3 THEN 'EA19' WHEN 4 THEN 'UK' ELSE 'DE' END AS geo", "year(o_orderdate) AS year").withColumn("geo_label", F.concat(F.lit("Place "), "geo"))
    return E.structured_records(cells, "http://api/flow", "Statistical interface", "Stock", {"EL": "Greece"}, ["EU"])


@query("""WITH p AS (SELECT DISTINCT CASE n_nationkey % 5 WHEN 0 THEN 'Iran' WHEN 1 THEN 'Colombia' WHEN 2 THEN 'Chad' ELSE n_name END AS place FROM nation), c AS (SELECT p_partkey::VARCHAR AS idno, CASE p_partkey % 6 WHEN 0 THEN 'Islamic Rep. of IRAN' WHEN 1 THEN 'colombian' WHEN 2 THEN 'Chad, Iran' WHEN 3 THEN 'x' WHEN 4 THEN '' END AS nation FROM part)
SELECT idno, min(place) AS place, idno IN (SELECT l_partkey::VARCHAR FROM lineitem WHERE l_quantity > 45) AS in_hand FROM c JOIN p ON contains(lower(nation), lower(place[1:6])) GROUP BY idno""")
def catalogue_places(spark, d):
    register = t(spark, d, "nation").selectExpr("CASE n_nationkey % 5 WHEN 0 THEN 'Iran' WHEN 1 THEN 'Colombia' WHEN 2 THEN 'Chad' ELSE n_name END AS place")
    entries = t(spark, d, "part").selectExpr("CAST(p_partkey AS STRING) AS idno", "CASE p_partkey % 6 WHEN 0 THEN 'Islamic Rep. of IRAN' WHEN 1 THEN 'colombian' WHEN 2 THEN 'Chad, Iran' WHEN 3 THEN 'x' WHEN 4 THEN '' END AS nation")
    held = t(spark, d, "lineitem").where("l_quantity > 45").selectExpr("CAST(l_partkey AS STRING) AS idno")
    return E.catalogue_match(entries, register, held).select("idno", "place", "in_hand")
