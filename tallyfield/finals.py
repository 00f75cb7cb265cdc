"""Registered queries of the final verdict and of rollups around it."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import classify as C
from .functions.records import OPERATIONAL
from .operators import verdict as V
from .queries import query, t

# Landed columns of records, told from orders: titles of several kinds, scores, matches and questionnaire verdicts by the keys' digits.
TITLES = ("Refugee census", "MSNA household survey", "Labour force survey", "Register of asylum seekers", "Yearbook", "Migration brief")
MATCHES = ("", "", "", "same product", "check title", "new edition", "new output", "", "", "")
COLUMNS = (
    "o_orderkey AS id",
    "CASE WHEN o_orderkey % 17 = 0 THEN 'http://a.org/login?x' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'http://a.org/x' END AS url",
    "CASE o_custkey % 6 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(TITLES)) + " END AS title",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'displaced persons' WHEN o_orderkey % 3 = 1 THEN 'persons' END AS quote",
    "CASE WHEN o_orderkey % 13 > 0 THEN 2000 + CAST(o_orderkey % 25 AS INT) END AS year",
    "CAST(o_orderkey % 101 AS INT) AS rules_score",
    "CASE WHEN o_orderkey % 7 = 0 THEN 40 WHEN o_orderkey % 7 > 1 THEN CAST(o_custkey * 7 % 101 AS INT) END AS model_score",
    "o_orderstatus <> 'P' AS read",
    "o_orderkey % 2 = 0 AS counted",
    "o_orderkey % 5 > 0 AS got_text",
    "CASE o_orderkey % 4 WHEN 0 THEN 'NSO (direct)' WHEN 1 THEN 'regional body' WHEN 2 THEN 'international agency' END AS route",
    "o_orderkey % 8 = 1 AS regional",
    "CASE o_orderkey % 10 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(MATCHES)) + " END AS match_kind",
    "CASE o_orderkey % 9 WHEN 0 THEN 'questions found: 3' WHEN 1 THEN 'no displacement question' END AS questionnaire",
    "o_custkey AS series",
)


def case(rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{label.replace(chr(39), chr(39) * 2)}'" for label, c in rules) + f" ELSE '{default.replace(chr(39), chr(39) * 2)}' END"


VERDICTS = f"""WITH l AS (SELECT {", ".join(COLUMNS)} FROM orders),
s AS (SELECT *, least(greatest(coalesce(CASE WHEN read THEN model_score ELSE rules_score END, 0), 0), 100) AS final_score, coalesce(regexp_matches(url, '{V.JUNK_URL}'), false) AS junk,
  match_kind = 'same product' AS known, starts_with(match_kind, 'check') AS maybe_known, match_kind IN ('new edition', 'new output') AS new_part, coalesce(year < {V.HISTORIC_BEFORE}, false) AS historic,
  regexp_matches(lower(title), '{OPERATIONAL}') AS operational, NOT regexp_matches(lower(concat_ws(' ', title, quote)), '{V.FOCUS}') AS no_focus,
  coalesce(contains(questionnaire, 'questions found'), false) AS asks, coalesce(questionnaire = 'no displacement question', false) AS asks_not,
  read AND NOT counted AND coalesce(model_score = 40, false) AS unsure FROM l),
f AS (SELECT *, NOT got_text AND final_score < 50 AS unreadable, read AND counted AND final_score >= {V.REACH_FROM} AND NOT (operational AND route IS NOT DISTINCT FROM 'NSO (direct)') AS reach,
  NOT junk AND NOT historic AND (counted OR known OR asks) AND regexp_matches(lower(title), '{V.TABULATION_SOURCE}') AS for_tabulation FROM s),
v AS (SELECT *, {case(V.TIERS, "low")} AS tier FROM f),
w AS (SELECT *, {case(V.REQUESTS, "new example")} AS ask_type, {case(V.REASONS, "not read by the model - rules' score only")} AS reason,
  row_number() OVER (PARTITION BY series ORDER BY final_score DESC, id) = 1 AS is_primary FROM v)
"""


def _verdicts(spark, d):
    return V.series_primary(V.final_verdict(t(spark, d, "orders").selectExpr(*COLUMNS)), "series", "final_score", "id")


@query(VERDICTS + "SELECT id, final_score, tier, ask_type, reason, for_tabulation, is_primary FROM w")
def final_verdicts(spark, d):
    return _verdicts(spark, d).select("id", "final_score", "tier", "ask_type", "reason", "for_tabulation", "is_primary")


@query(VERDICTS + "SELECT id, tier, ask_type, route, final_score FROM w WHERE tier IN ('reach out', 'review then reach out') AND is_primary")
def request_shortlist(spark, d):
    return V.shortlist(_verdicts(spark, d)).select("id", "tier", "ask_type", "route", "final_score")


@query(VERDICTS + "SELECT id, title, tier = 'already in register' AS in_register FROM w WHERE for_tabulation AND is_primary")
def tabulation_list(spark, d):
    return V.tabulation_handoff(_verdicts(spark, d)).select("id", "title", "in_register")


@query(VERDICTS + "SELECT tier, reason, count(*) AS n, avg(final_score) AS mean_score FROM w GROUP BY tier, reason")
def verdict_summary(spark, d):
    return _verdicts(spark, d).groupBy("tier", "reason").agg(F.count("*").alias("n"), F.avg("final_score").alias("mean_score"))


@query("""SELECT id, queue FROM (SELECT o_orderkey AS id, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' WHEN o_totalprice > 300000 THEN 'large' ELSE 'rest' END AS queue, o_orderdate FROM orders)
ORDER BY CASE queue WHEN 'urgent' THEN 0 WHEN 'large' THEN 1 ELSE 2 END, o_orderdate, id LIMIT 500""")
def work_queue(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority", "o_totalprice", "o_orderdate")
    return V.priority_queue(rows, [("urgent", "o_orderpriority like '1%'"), ("large", "o_totalprice > 300000")], ["o_orderdate", "id"], 500).select("id", "queue")


@query("""WITH f AS (SELECT l_suppkey, l_partkey, min(l_orderkey * 10 + l_linenumber) AS k FROM lineitem GROUP BY l_suppkey, l_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY k) AS n FROM f) SELECT l_suppkey, l_partkey, k FROM r WHERE n <= 20""")
def first_parts_of_suppliers(spark, d):
    rows = t(spark, d, "lineitem").select("l_suppkey", "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return V.capped_after_twins(rows, "l_suppkey", "l_partkey", ["k"], 20)


@query("""SELECT coalesce(c.nation, s.nation) AS nation, n_customers, n_suppliers FROM (SELECT c_nationkey AS nation, count(*) AS n_customers FROM customer WHERE c_acctbal > 0 GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS nation, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 0 GROUP BY 1) s ON c.nation = s.nation""")
def nations_of_either_side(spark, d):
    count = lambda name, p, out: t(spark, d, name).where(f"{p}_acctbal > 0").groupBy(F.col(f"{p}_nationkey").alias("nation")).agg(F.count("*").alias(out))
    return V.full_registry(count("customer", "c", "n_customers"), count("supplier", "s", "n_suppliers"), ["nation"])


@query("SELECT lang, source, count(*) AS n, count(quality) AS n_quality, count(toxic) AS n_toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang, source")
def label_coverage(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "lang", "source").join(t(spark, d, "labels"), "doc_id", "left")
    return V.non_null_counts(rows, ["lang", "source"], ["quality", "toxic"])


@query(f"SELECT p_partkey, CASE WHEN regexp_matches(x, '{C.TITLE_TERMS}') THEN 'TIER1_DEDICATED' WHEN regexp_matches(x, '{C.NATIONAL}') THEN 'TIER2_INCLUSION' ELSE 'TIER3_REVIEW' END AS tier FROM (SELECT p_partkey, lower(p_name || CASE p_partkey % 5 WHEN 0 THEN ' Беженцы' WHEN 1 THEN ' Census' WHEN 2 THEN ' перемещенных' ELSE '' END) AS x FROM part)")
def title_tiers(spark, d):
    extra = F.expr("CASE p_partkey % 5 WHEN 0 THEN ' Беженцы' WHEN 1 THEN ' Census' WHEN 2 THEN ' перемещенных' ELSE '' END")
    return t(spark, d, "part").select("p_partkey", C.tier_by_title(F.concat("p_name", extra)).alias("tier"))
