"""Registered queries of the audits, each with SQL for DuckDB that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import audits as U
from .operators.ranking import top_n
from .queries import query, t
from .reviews import TITLE_SQL, titled


@query("""WITH reg AS (SELECT s_suppkey AS place, 'd' || s_suppkey || '.org' AS domain, s_nationkey AS priority FROM supplier),
inv AS (SELECT 'd' || l_orderkey * 2 || '.org' AS domain, count(*) AS total_inventory, count(*) FILTER (l_returnflag = 'R') AS keyword_matches FROM lineitem GROUP BY 1),
ev AS (SELECT l_orderkey * 3 AS place, count(*) AS evidence_rows FROM lineitem GROUP BY 1),
live AS (SELECT 'd' || c_custkey || '.org' AS domain, CASE c_nationkey % 3 WHEN 1 THEN 404 WHEN 2 THEN 200 END AS http_status, CASE WHEN c_nationkey % 3 > 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'https://d' || c_custkey || '.org/' ELSE 'https://moved.org/' END END AS final_url FROM customer),
j AS (SELECT place, domain, priority, coalesce(total_inventory, 0) AS total_inventory, keyword_matches, coalesce(evidence_rows, 0) AS evidence_rows FROM reg LEFT JOIN inv USING (domain) LEFT JOIN ev USING (place))
SELECT j.*, http_status, final_url, CASE WHEN total_inventory = 0 AND http_status IS NULL THEN 'find the current site' WHEN total_inventory = 0 AND NOT contains(final_url, j.domain) THEN 'take the new address'
WHEN total_inventory = 0 AND http_status >= 400 THEN 'verify the address' WHEN total_inventory = 0 THEN 'look by hand' WHEN keyword_matches = 0 THEN 'no term matched' ELSE 'little survived scoring' END AS suggested_action
FROM j LEFT JOIN live ON live.domain = j.domain AND total_inventory = 0 WHERE evidence_rows <= 2""")
def coverage_actions(spark, d):
    named = lambda c: F.concat(F.lit("d"), F.expr(c).cast("string"), F.lit(".org")).alias("domain")
    li, k = t(spark, d, "lineitem"), F.col("c_nationkey") % 3
    registry = t(spark, d, "supplier").select(F.col("s_suppkey").alias("place"), named("s_suppkey"), F.col("s_nationkey").alias("priority"))
    inventory = li.groupBy(named("l_orderkey * 2")).agg(F.count("*").alias("total_inventory"), F.count_if(F.col("l_returnflag") == "R").alias("keyword_matches"))
    evidence = li.select((F.col("l_orderkey") * 3).alias("place"))
    own = F.concat(F.lit("https://d"), F.col("c_custkey").cast("string"), F.lit(".org/"))
    liveness = t(spark, d, "customer").select(named("c_custkey"), F.when(k == 1, 404).when(k == 2, 200).alias("http_status"), F.when(k > 0, F.when(F.col("c_custkey") % 2 == 0, own).otherwise("https://moved.org/")).alias("final_url"))
    return U.coverage_gaps(registry, inventory, evidence, liveness)


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 > 0 THEN 2020 + o_custkey % 15 END AS y, o_orderkey % 3 AS n, CASE WHEN o_orderkey % 5 > 0 THEN 2018 + o_orderkey % 10 END AS l, o_totalprice / 10 AS p FROM orders),
a AS (SELECT *, CASE WHEN y BETWEEN 2026 AND 2029 THEN 'ask now: planned' WHEN y > 2029 THEN 'later: after the window' WHEN y >= 2022 AND n = 0 THEN 'ask: recent, not in the register' WHEN n > 0 AND y > coalesce(l, 0) THEN 'in the register: ask for an update' ELSE 'context' END AS action FROM x)
SELECT o_orderkey, action, CASE WHEN action = 'context' OR action LIKE 'later%' THEN '-' WHEN p >= 10000 THEN 'high' ELSE 'normal' END AS priority FROM a""")
def round_actions(spark, d):
    year = F.when(F.col("o_custkey") % 7 > 0, 2020 + F.col("o_custkey") % 15)
    last = F.when(F.col("o_orderkey") % 5 > 0, 2018 + F.col("o_orderkey") % 10)
    return t(spark, d, "orders").select("o_orderkey", U.round_action(year, 2026, F.col("o_orderkey") % 3, last, F.col("o_totalprice") / 10).alias("x")).select("o_orderkey", "x.*")


@query("""WITH l AS (SELECT o_custkey AS product, o_orderkey AS lead_id, o_orderpriority AS title, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS year, o_totalprice > 300000 AS recent, CASE WHEN o_totalprice > 440000 THEN 1 WHEN o_totalprice > 400000 THEN 2 ELSE 3 END AS r, o_orderkey % 2 = 0 AS is_edition FROM orders),
g AS (SELECT product, count(*) AS leads, max(year) AS newest_year, count(*) FILTER (recent) AS recent_leads, count(*) FILTER (year IS NULL) AS undated, ['high', 'medium', 'low'][min(r)] AS in_register, bool_or(is_edition AND r <= 2) AS edition FROM l GROUP BY product),
k AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY lead_id) AS k FROM l)
SELECT g.*, CASE WHEN in_register = 'high' AND NOT edition THEN 'known - do not ask' WHEN in_register <> 'low' AND edition AND recent_leads > 0 THEN 'ask to update' WHEN in_register = 'medium' THEN 'check: may be known' WHEN recent_leads > 0 THEN 'ask: new' WHEN undated > 0 THEN 'undated - check by hand' ELSE 'too old - do not ask' END AS proposed,
(SELECT string_agg(title, ' || ' ORDER BY k) FROM k WHERE k <= 3 AND k.product = g.product) AS titles FROM g""")
def product_decisions(spark, d):
    price = F.col("o_totalprice")
    leads = t(spark, d, "orders").select(
        F.col("o_custkey").alias("product"), F.col("o_orderkey").alias("lead_id"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("year"),
        (price > 300000).alias("recent"), F.when(price > 440000, "high").when(price > 400000, "medium").otherwise("odd").alias("likelihood"), (F.col("o_orderkey") % 2 == 0).alias("is_edition"),
    )
    return U.product_rollup(leads)


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity::INT AS v, l_returnflag = 'N' AS e, CASE l_linestatus WHEN 'O' THEN 'related (demoted)' ELSE CASE WHEN l_linenumber = 1 THEN 'exact' ELSE 'related' END END AS m FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber, CASE WHEN NOT e AND v = 9 THEN 'P1 reject: the prompt''s example, not in the source' WHEN NOT e THEN 'P1 reject: not in the source' WHEN v = 9 THEN 'P1 check: equals the prompt''s example' WHEN m LIKE '%demoted%' THEN 'P2 check: measure not named' WHEN m = 'exact' THEN 'P3 confirm: strong match' ELSE 'P3 confirm: related' END AS review_reason FROM x)
SELECT *, review_reason[2:2]::INT AS review_priority FROM r""")
def value_reviews(spark, d):
    kind = F.when(F.col("l_linestatus") == "O", "related (demoted)").when(F.col("l_linenumber") == 1, "exact").otherwise("related")
    points = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("v"), (F.col("l_returnflag") == "N").alias("e"), kind.alias("m"))
    return U.value_review(points, "v", "e", "m", "9").select("l_orderkey", "l_linenumber", "review_reason", "review_priority")


ANSWERS = "SELECT doc_id, CASE WHEN toxic = 1 THEN 'can''t tell' WHEN quality = 1 THEN 'yes' WHEN quality = 0 THEN 'no' END AS said FROM labels"
KEYED = f"b AS (SELECT a.doc_id, said, CASE WHEN n_chars > 400 THEN 'yes' ELSE 'no' END AS truth FROM ({ANSWERS}) a JOIN documents USING (doc_id) WHERE said IN ('yes', 'no'))"


def _answers(spark, d):
    said = F.when(F.col("toxic") == 1, "can't tell").when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no")
    key = t(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 400, "yes").otherwise("no").alias("truth"))
    return U.answers_against_key(t(spark, d, "labels").select("doc_id", said.alias("said")), key, "doc_id", "said", "truth", "yes")


@query(f"WITH {KEYED} SELECT count(*) AS n, count(*) FILTER (said = truth) AS agree, round(count(*) FILTER (said = 'yes' AND truth = 'yes') / greatest(count(*) FILTER (truth = 'yes'), 1), 9) AS yes_precision, round(count(*) FILTER (said = 'yes' AND truth = 'yes') / greatest(count(*) FILTER (said = 'yes'), 1), 9) AS yes_recall FROM b")
def answer_measures(spark, d):
    return _answers(spark, d)[0].select("n", "agree", F.round("yes_precision", 9).alias("yes_precision"), F.round("yes_recall", 9).alias("yes_recall"))


@query(f"WITH {KEYED} SELECT * FROM b WHERE said <> truth")
def answer_disagreements(spark, d):
    return _answers(spark, d)[1]


@query("""SELECT o_custkey, max(o_totalprice / 6000) AS best, CASE WHEN bool_or(o_orderkey % 40 = 0 OR o_orderpriority[1:1] = '9') OR max(o_totalprice / 6000) >= 70 THEN 'sure_bet' WHEN bool_or(o_orderpriority[1:1] IN ('B', 'C')) OR max(o_totalprice / 6000) >= 45 THEN 'needs_review' ELSE 'low_bet' END AS tier FROM orders GROUP BY 1""")
def letter_tiers(spark, d):
    return U.letter_tier(t(spark, d, "orders"), ["o_custkey"], F.col("o_orderkey") % 40 == 0, F.substring("o_orderpriority", 1, 1), F.col("o_totalprice") / 6000)


@query(rf"SELECT page_id, regexp_matches(lower(coalesce(url, '')), '{U.SIGN_IN}') AS junk FROM pages")
def junk_pages(spark, d):
    return t(spark, d, "pages").select("page_id", U.is_junk(F.col("url")).alias("junk"))


@query(rf"""WITH p AS (SELECT page_id, trim(regexp_replace({TITLE_SQL}, '\s+', ' ', 'g')) AS x FROM pages)
SELECT page_id, CASE WHEN x = '' THEN 'empty' WHEN len(string_split(x, ' ')) > 38 THEN 'too long' WHEN contains(x, ':') THEN 'list' WHEN NOT regexp_matches(x, '[.!?]["''»]?$') THEN 'open end' WHEN regexp_matches(lower(x), '{U.PROVENANCE}') THEN 'claimed source' WHEN length(x[1:20]) > 12 THEN 'copied title' ELSE 'ok' END AS gate FROM p""")
def letter_gates(spark, d):
    return titled(spark, d).select("page_id", U.letter_gate(F.col("title"), F.array(F.substring(F.trim(F.regexp_replace("title", r"\s+", " ")), 1, 20))).alias("gate"))


KINDS = "CASE p_size % 6 WHEN 0 THEN 'MICS' WHEN 1 THEN 'DHS' WHEN 2 THEN 'labour force' WHEN 3 THEN 'living conditions/LSMS' WHEN 4 THEN 'FDP socio-economic' ELSE 'other' END"
_EASE = " ".join(f"WHEN '{k}' THEN {i + 1}" for i, (k, _, _) in enumerate(U.ACCESS))
_STATUS = " ".join(f"WHEN '{k}' THEN '{s}'" for k, s, _ in U.ACCESS)
_PORTAL = " ".join(f"WHEN '{k}' THEN '{p}'" for k, _, p in U.ACCESS)


@query(f"WITH x AS (SELECT *, {KINDS} AS kind FROM part), y AS (SELECT p_brand, p_partkey, (CASE kind {_EASE} ELSE 6 END)::INT AS ease, CASE kind {_STATUS} ELSE '4 CHECK record' END AS access_status, CASE kind {_PORTAL} ELSE 'https://catalog.ihsn.org' END AS portal FROM x) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY ease, p_partkey)::INT AS rank FROM y) WHERE rank <= 3")
def access_worklist(spark, d):
    x = t(spark, d, "part").select("p_brand", "p_partkey", U.access(F.expr(KINDS)).alias("a")).select("p_brand", "p_partkey", "a.*")
    return top_n(x, ["p_brand"], ["ease", "p_partkey"], 3)


@query("SELECT c_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def first_orders(spark, d):
    facts = t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return U.first_joined(t(spark, d, "customer").select("c_custkey"), facts, "c_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_or(o_orderstatus = 'O') AND bool_or(o_orderstatus <> 'O')")
def totals_with_parts(spark, d):
    return U.has_total_and_part(t(spark, d, "orders"), ["o_custkey"], "o_orderstatus", "O")
