"""Registered queries of resolving: phrases, populations, closest studies, programmes, worklists, drafts and the report pack, with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import classify as C
from .functions import text as T
from .operators import aggregates as A
from .operators import leads as L
from .operators import resolving as V
from .places_queries import M, pick, quoted
from .queries import query, t

TITLES = ("Enquête ménages réfugiés 2019", "Population census of displaced persons", "Joint assessment of stateless households", "Recensement général", "Asylum seekers and nationality register", "Monitoring IDP sites", "")
PLACES = ("Kenya", "Chad", "Norway", "")
POPS = ("refugees; idps", "stateless", "", "idps", "other")
ASKED = f"{pick('p_partkey', TITLES)} || ' ' || p_name AS title, {pick('p_partkey', PLACES)} AS place, {pick('(p_partkey // 3)', POPS)} AS pops"


def when(rules, value: str, default: str = "''") -> str:
    return "CASE " + " ".join(f"WHEN {M(value, p)} THEN {quoted(n)}" for n, p in rules) + f" ELSE {default} END"


def said(at: int) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN contains(pops, '{r[0]}') THEN '{r[at]}' END" for r in T.TOPICS) + "], lambda x: x IS NOT NULL), ' ')"


SQUISH = r"trim(regexp_replace({}, '\s+', ' ', 'g'))".format
WORDS = "list_filter(string_split(" + SQUISH("regexp_replace(lower(title), '[^a-z ]', ' ', 'g')") + f", ' '), lambda w: length(w) > 3 AND NOT list_contains({list(T.COMMON)}, w))"


@query(f"""WITH r AS (SELECT p_partkey, {ASKED} FROM part), k AS (SELECT *, lower(concat_ws(' ', title, pops)) AS b, lower(title) AS low, {WORDS} AS w0 FROM r), z AS (SELECT *, list_filter(w0, lambda x, i: list_position(w0, x) = i) AS w FROM k),
y AS (SELECT *, (CASE WHEN contains(pops, 'refugee') OR regexp_matches(low, 'refugee|asylum') THEN ['asylum', 'refugee'] ELSE []::VARCHAR[] END) || (CASE WHEN contains(pops, 'idp') OR contains(low, 'internally displaced') THEN ['displaced'] ELSE []::VARCHAR[] END)
  || (CASE WHEN contains(pops, 'stateless') OR regexp_matches(low, 'stateless|nationalit') THEN ['stateless', 'citizenship'] ELSE []::VARCHAR[] END) AS keys FROM z)
SELECT p_partkey, {SQUISH(f"concat_ws(' ', place, {when(T.SOUGHT, 'b')}, {when(T.INSTRUMENTS, 'b')})")} AS short, {SQUISH("concat_ws(' ', array_to_string(w[1:3], ' '), place)")} AS distinctive, coalesce(nullif({said(1)}, ''), 'forcibly displaced') AS topic,
{SQUISH(f"concat_ws(' ', place, {said(2)})")} AS catalogue, array_to_string(CASE WHEN len(keys) > 0 THEN keys ELSE ['migration', 'foreign'] END, ',') AS keywords FROM y""")
def search_forms(spark, d):
    """What to ask of catalogues for each record: five forms."""
    r = t(spark, d, "part").selectExpr("p_partkey", *_columns(ASKED))
    return r.select("p_partkey", T.search_phrases(F.col("title"), F.col("place"), F.col("pops")).alias("f")).select("p_partkey", "f.short", "f.distinctive", "f.topic", "f.catalogue", F.array_join("f.keywords", ",").alias("keywords"))


def _columns(listed: str) -> list[str]:
    """Column expressions of a list for SQL, in the dialect of Spark."""
    return [x.replace("//", "DIV") for x in listed.replace(" AS title, ", " AS title\n").replace(" AS place, ", " AS place\n").split("\n")]


NAMED = tuple(f"Report on {w} in the region" for w in ("refugiados", "pengungsi", "asile et accueil", "IDPs", "idpx", "personnes déplacées", "returnees", "apatrides", "vatansız kişiler", "避難民", "難民", "household income"))
CODED = ("REFUGEES IDPS", "idps  IDPS statelessness", "OTHER x", "", "NONE")


def tags(rules, value: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {M(value, p)} THEN {quoted(n)} END" for n, p in rules) + "], lambda x: x IS NOT NULL)"


@query(f"""WITH r AS (SELECT o_orderkey, lower({pick('o_orderkey', NAMED)}) AS x, upper({pick('o_custkey', CODED)}) AS c FROM orders)
SELECT o_orderkey, array_to_string({tags(C.POPULATIONS, 'x')}, '; ') AS populations, coalesce(nullif(array_to_string({tags(C.TITLE_POPULATIONS, 'x')}, '; '), ''), 'none in title (tier2/3)') AS in_title,
array_to_string(list_filter([CASE WHEN regexp_matches(c, '(^|\\s)REFUGEES(\\s|$)') THEN 'refugees' END, CASE WHEN regexp_matches(c, '(^|\\s)IDPS(\\s|$)') THEN 'idps' END, CASE WHEN regexp_matches(c, '(^|\\s)STATELESSNESS(\\s|$)') THEN 'stateless' END, CASE WHEN regexp_matches(c, '(^|\\s)OTHER(\\s|$)') THEN 'other' END], lambda x: x IS NOT NULL), ';') AS answered FROM r""")
def named_populations(spark, d):
    r = t(spark, d, "orders").selectExpr("o_orderkey", f"{pick('o_orderkey', NAMED)} AS x", f"{pick('o_custkey', CODED)} AS c")
    return r.select("o_orderkey", F.array_join(C.population_tags(F.col("x")), "; ").alias("populations"), C.title_populations(F.col("x")).alias("in_title"), F.array_join(C.answer_populations(F.col("c")), ";").alias("answered"))


DATED = ("https://x.org/2024/12/a", "https://x.org/241219/b", "https://x.org/220105b-c", "https://x.org/2009/1/a", "https://x.org/2013-05/a", "https://x.org/231350/a", "https://x.org/991219/b", "none")


@query(f"WITH r AS (SELECT o_orderkey, {pick('o_orderkey', DATED)} AS u FROM orders) SELECT o_orderkey, coalesce(nullif(regexp_extract(u, '/(20[12][0-9])[/-]', 1), ''), '20' || nullif(regexp_extract(u, '/(2[0-6])(0[1-9]|1[0-2])[0-3][0-9][a-z]?[/-]', 1), ''))::INT AS lead_year FROM r")
def lead_years(spark, d):
    return t(spark, d, "orders").select("o_orderkey", T.lead_year(F.expr(pick("o_orderkey", DATED))).alias("lead_year"))


SOURCE = "CASE event_id % 9 WHEN 0 THEN 'National Statistics Office' WHEN 1 THEN 'UNHCR' WHEN 2 THEN 'Enquête 2020' ELSE 'other' END"


@query(f"""WITH l AS (SELECT user_id, event_type, max(struct_pack(y := CAST(event_id % 7 AS INT) + 2000, v := value, s := {SOURCE})) AS m FROM events GROUP BY 1, 2)
SELECT user_id, round(max(m.v) FILTER (event_type = 'click'), 6) AS click, max(m.y) FILTER (event_type = 'click') AS click_year, max(m.s) FILTER (event_type = 'click') AS click_source, round(max(m.v) FILTER (event_type = 'view'), 6) AS view, max(m.y) FILTER (event_type = 'view') AS view_year, max(m.s) FILTER (event_type = 'view') AS view_source,
bool_or(regexp_matches(lower(m.s), 'statisti|census|enquête')) AS any_official, round(coalesce(max(m.v) FILTER (event_type = 'click'), 0) + coalesce(max(m.v) FILTER (event_type = 'view'), 0), 6) AS total FROM l GROUP BY user_id""")
def latest_contexts(spark, d):
    e = t(spark, d, "events").selectExpr("user_id", "event_type", "CAST(event_id % 7 AS INT) + 2000 AS y", "value", f"{SOURCE} AS s")
    out = A.latest_context(e, "user_id", "event_type", "y", "value", "s", ["click", "view"], ["click", "view"], "statisti|census|enquête")
    return out.withColumns({c: F.round(c, 6) for c in ("click", "view", "total")})


NAMES = "list_distinct(string_split(p_name, ' '))"
ORG = "CASE WHEN p_size % 6 > 0 THEN list_distinct(string_split(lower(p_type), ' ')) ELSE [] END"


@query(f"""WITH p AS (SELECT p_partkey AS id, p_brand AS b, {NAMES} AS t, {ORG} AS o FROM part), x AS (SELECT l.id, r.id AS m, CASE WHEN len(l.t) + len(r.t) > 0 THEN len(list_intersect(l.t, r.t)) / (len(l.t) + len(r.t) - len(list_intersect(l.t, r.t)))::DOUBLE ELSE 0 END AS jt,
 CASE WHEN len(l.o) + len(r.o) > 0 THEN len(list_intersect(l.o, r.o)) / (len(l.o) + len(r.o) - len(list_intersect(l.o, r.o)))::DOUBLE ELSE 0 END AS jo FROM p l JOIN p r ON l.b = r.b AND l.id % 2 = 1 AND r.id % 2 = 0),
k AS (SELECT *, 0.6::DOUBLE * jt + 0.4::DOUBLE * jo AS s FROM x), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, m) AS k FROM k WHERE s >= 0.2)
SELECT p.id, m AS match_id, round(s, 6) AS match_score FROM p LEFT JOIN n ON n.id = p.id AND k = 1 WHERE p.id % 2 = 1""")
def blended_matches(spark, d):
    """Every part with an odd key against all with an even one, of its brand; types stand for organisations."""
    p = t(spark, d, "part").selectExpr("p_partkey AS id", "p_brand AS b", "split(p_name, ' ') AS t", "CASE WHEN p_size % 6 > 0 THEN split(lower(p_type), ' ') ELSE array() END AS o")
    return V.blended_match(p.where("id % 2 = 1"), p.where("id % 2 = 0"), "b", "id", "id", "t", "o").select("id", "match_id", F.round("match_score", 6).alias("match_score"))


YEAR = "CASE WHEN p_partkey % 7 > 0 THEN 2000 + p_size % 25 END"


@query(f"""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 1 AND p_partkey % 50 = 3 THEN 'nowhere' ELSE p_brand END AS b, CASE WHEN p_partkey % 40 = 5 THEN ['unheard'] ELSE {NAMES} END AS w, {YEAR} AS y FROM part),
x AS (SELECT l.id, r.id AS m, len(list_intersect(l.w, r.w)) / (len(l.w) + len(r.w) - len(list_intersect(l.w, r.w)))::DOUBLE AS s, coalesce(abs(l.y - r.y), 9) AS g FROM p l JOIN p r ON l.b = r.b AND l.id % 2 = 1 AND r.id % 2 = 0), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, g, m) AS k FROM x)
SELECT p.id, m AS match_id, round(s, 6) AS similarity, g::INT AS gap, CASE WHEN m IS NULL THEN 'no match' WHEN s >= 0.3 OR (s >= 0.18 AND g <= 1) THEN 'STRONG' WHEN s >= 0.15 OR (s >= 0.08 AND g <= 1) THEN 'MEDIUM' ELSE 'weak' END AS confidence FROM p LEFT JOIN n ON n.id = p.id AND k = 1 WHERE p.id % 2 = 1""")
def closest_studies(spark, d):
    p = t(spark, d, "part").selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 2 = 1 AND p_partkey % 50 = 3 THEN 'nowhere' ELSE p_brand END AS b", "CASE WHEN p_partkey % 40 = 5 THEN array('unheard') ELSE split(p_name, ' ') END AS w", f"{YEAR} AS y")
    return V.closest_study(p.where("id % 2 = 1"), p.where("id % 2 = 0"), "b", "id", "id", "w", "y").select("id", "match_id", F.round("similarity", 6).alias("similarity"), "gap", "confidence")


PROGRAMMES = ("DTM", "CENSUS", "PROTMON", "DHS", "MICS", "LSMS", "RIDS")
AT = ("Kenya", "Kenya (Garissa)", "Chad", "chad", "Norway", "")


@query(f"""WITH c AS (SELECT l_orderkey AS id, list_sort(list_distinct(list({pick('l_partkey', PROGRAMMES)}))) AS codes FROM lineitem WHERE l_quantity > 25 GROUP BY 1),
o AS (SELECT o_orderkey AS id, {pick('o_custkey', AT)} AS place, CASE WHEN o_orderkey % 7 > 0 THEN year(o_orderdate) END AS y, coalesce(codes, []) AS codes, o_orderkey % 2 = 0 AS study FROM orders LEFT JOIN c ON id = o_orderkey),
s AS (SELECT place, codes, y, min(id) AS m FROM o WHERE study AND place <> '' GROUP BY 1, 2, 3), e AS (SELECT DISTINCT place, codes, y FROM o WHERE NOT study AND place <> ''),
x AS (SELECT e.*, s.m, list_sort(list_intersect(s.codes, e.codes)) AS shared, coalesce(abs(e.y - s.y), 9) AS g FROM e JOIN s ON (starts_with(lower(e.place), lower(s.place)) OR starts_with(lower(s.place), lower(e.place))) AND list_has_any(e.codes, s.codes)),
n AS (SELECT *, row_number() OVER (PARTITION BY place, codes, y ORDER BY len(shared) DESC, g, m) AS k FROM x)
SELECT o.id, m AS match_id, array_to_string(shared, ',') AS programmes, g::INT AS gap, CASE WHEN m IS NOT NULL THEN CASE WHEN list_has_all({list(V.STOCK)}, shared) THEN 'STOCK (deprioritise)' ELSE 'socio-economic' END END AS kind,
CASE WHEN g <= 2 THEN 'programme match' WHEN m IS NOT NULL THEN 'programme match (different year - check)' ELSE 'no programme match -> reach out / not published' END AS verdict
FROM o LEFT JOIN n ON k = 1 AND n.place = o.place AND n.codes = o.codes AND n.y IS NOT DISTINCT FROM o.y WHERE NOT study""")
def programme_matches(spark, d):
    """Orders with odd keys as examples, all with even keys as studies; programmes are told from what was ordered."""
    codes = t(spark, d, "lineitem").where("l_quantity > 25").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.expr(pick("l_partkey", PROGRAMMES))).alias("codes"))
    o = t(spark, d, "orders").join(codes, "o_orderkey", "left").selectExpr("o_orderkey AS id", f"{pick('o_custkey', AT)} AS place", "CASE WHEN o_orderkey % 7 > 0 THEN year(o_orderdate) END AS y", "codes")
    return V.programme_match(o.where("id % 2 = 1"), o.where("id % 2 = 0"), "place", "id", "id", "codes", "y").select("id", "match_id", "programmes", "gap", "kind", "verdict")


OFFICES = ("World Health Organization", "JIPS", "Instituto Nacional de Estadística", "Ministry", "National Bureau of Statistics")
DESCRIBED = ("will be held in 2026", "household data", "launched last year", "income of refugees", "")
HELD = f"{pick('o_custkey', OFFICES)} AS organisation, 'Study ' || o_orderkey AS title, {pick('(o_orderkey // 2)', DESCRIBED)} AS description, {pick('(o_custkey // 2)', PLACES)} AS country, o_orderpriority <> '5-LOW' AS is_microdata"


@query(f"""WITH r AS (SELECT o_orderkey AS id, {HELD} FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49))
SELECT id, country, organisation[1:40] AS organisation, title[1:50] AS title, CASE WHEN {M("lower(concat_ws(' ', title, description))", V.NOT_YET)} THEN 'forthcoming / not yet collected' {' '.join(f"WHEN {M('lower(organisation)', p)} THEN {quoted(n)}" for n, p in V.HELD_BY)} ELSE 'exact study not online - request from office' END AS reason
FROM r WHERE is_microdata AND country <> ''""")
def reach_out_orders(spark, d):
    r = t(spark, d, "orders").selectExpr("o_orderkey AS id", *[x.replace("//", "DIV") for x in (f"{pick('o_custkey', OFFICES)} AS organisation", "'Study ' || o_orderkey AS title", f"{pick('(o_orderkey // 2)', DESCRIBED)} AS description", f"{pick('(o_custkey // 2)', PLACES)} AS country", "o_orderpriority <> '5-LOW' AS is_microdata")])
    return V.reach_out_list(r, t(spark, d, "lineitem").where("l_quantity > 49").selectExpr("l_orderkey AS id"), "id")


@query("""SELECT o_orderkey AS id, v AS recovered_verdict, CASE WHEN o_custkey % 3 = 0 THEN 'roster link present but not usable/dead' ELSE 'no link in the record' END AS roster_link,
CASE WHEN o_custkey % 2 = 0 THEN 'search public availability (NSO site / statbank), then reach out' ELSE 'reach out to reporting office (likely gated microdata)' END AS suggested_action
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS v FROM lineitem WHERE l_linenumber > 3 GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07)""")
def orders_to_source(spark, d):
    roster = t(spark, d, "orders").selectExpr("o_orderkey AS id", "CASE WHEN o_custkey % 2 = 0 THEN 'country-led' ELSE 'institution-led' END AS lead_type", "o_custkey % 3 = 0 AS has_link")
    li = t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "id")
    verdicts = li.where("l_linenumber > 3").groupBy("id").agg(F.min("l_returnflag").alias("verdict"))
    return V.to_source(roster, li.where("l_tax > 0.07"), verdicts, "id").select("id", "recovered_verdict", "roster_link", "suggested_action")


TYPES = ("MICS", "DHS", "labour force", "living conditions/LSMS", "FDP socio-economic", "other")
SURVEYED = ("p_brand AS country", f"{pick('p_size', TYPES)} AS type", "p_name || ' ' || (1990 + p_partkey % 30) AS survey", "CASE WHEN p_partkey % 3 > 0 THEN '' || (2000 + p_size % 25) END AS year", "'http://c/' || p_partkey AS catalog")
WORDING = "Intended use: the {survey} ({country}), aggregate tables only."
RANKED = "CASE type " + " ".join(f"WHEN {quoted(r[0])} THEN {k}" for k, r in enumerate(V.ROUTES, 1)) + " ELSE 6 END"


def routed(at: int) -> str:
    return "CASE type " + " ".join(f"WHEN {quoted(r[0])} THEN {quoted(r[at])}" for r in V.ROUTES) + f" ELSE {quoted(V.OTHER_ROUTE[at - 1])} END"


WORK = f"WITH r AS (SELECT {', '.join(SURVEYED)} FROM part), w AS (SELECT *, ({RANKED})::INT AS ease_rank, {routed(1)} AS download_route, {routed(2)} AS access_status, {routed(3)} AS portal, coalesce(year, regexp_extract(survey, '((?:19|20)\\d{{2}})', 1))::INT AS yr FROM r)"


@query(f"{WORK} SELECT catalog, country, type, year, survey, ease_rank, download_route, yr FROM w")
def dataset_work(spark, d):
    return V.dataset_worklist(t(spark, d, "part").selectExpr(*SURVEYED)).select("catalog", "country", "type", "year", "survey", "ease_rank", "download_route", "yr")


@query(f"""{WORK} SELECT country, type, catalog, access_status, portal, CASE WHEN access_status LIKE '3%' THEN 'Intended use: the ' || survey || ' (' || country || '), aggregate tables only.' END AS application_text
FROM (SELECT *, row_number() OVER (PARTITION BY country, type ORDER BY coalesce(year::INT, 0) DESC, catalog) AS k FROM w) WHERE k = 1""")
def dataset_requests(spark, d):
    """The shortlist with its access, and the text of applications where one is needed."""
    short = V.dataset_shortlist(V.dataset_worklist(t(spark, d, "part").selectExpr(*SURVEYED)))
    asked = V.applications(short, WORDING).select("country", "type", "application_text")
    return short.join(asked, ["country", "type"], "left").select("country", "type", "catalog", "access_status", "portal", "application_text")


CO = ("Ministry of Labour / Bureau of Census", "INS; INE", "Office & Sons", "", "Agency+Partner|Third")


@query(f"""WITH u AS (SELECT o_custkey % 25 AS place, {pick('o_orderkey', CO)} AS org, CASE WHEN o_orderkey % 3 = 0 THEN 's' || o_custkey % 10 || '.org' ELSE '' END AS dom FROM orders), g AS (SELECT place, org, count(*) AS n_examples, coalesce(min(nullif(dom, '')), '') AS website FROM u GROUP BY 1, 2),
s AS (SELECT place, {SQUISH("unnest(string_split_regex(org, '\\s*(?:/|;|\\||\\+|\\n| & )\\s*'))")} AS institution, n_examples, website FROM g) SELECT *, CASE WHEN website <> '' THEN 'https://' || website ELSE '' END AS suggested_contact_page, 'no verified address' AS reason FROM s WHERE institution <> ''""")
def held_organisations(spark, d):
    u = t(spark, d, "orders").selectExpr("o_custkey % 25 AS place", f"{pick('o_orderkey', CO)} AS org", "CASE WHEN o_orderkey % 3 = 0 THEN 's' || o_custkey % 10 || '.org' ELSE '' END AS dom")
    return V.hold_list(u, "place", "org", "dom")


MATCHED = ("l_suppkey % 25 AS place", "CASE WHEN l_suppkey % 10 > 0 THEN l_suppkey END AS org", "'P' || l_partkey % 50 AS title", "l_linenumber = 7 AS weak", "CASE WHEN l_partkey % 4 > 0 THEN CASE WHEN l_quantity < 40 THEN 'low' ELSE 'high' END END AS confidence")
WRITTEN = ("c_custkey % 25 AS place", "c_custkey % 100 AS org", "c_custkey AS id", "'u' || c_custkey % 1400 AS email", "c_acctbal < -900 AS name_check", "c_nationkey = 3 AS honorific", "CAST(c_custkey % 4 AS INT) AS rank", "CASE WHEN c_nationkey % 2 = 0 THEN 'none' ELSE 'member' END AS primary_fact", "c_acctbal > 5000 AS fell_back", "c_nationkey = 5 AS flagged", "c_nationkey % 5 = 1 AS bilingual")


@query(f"""WITH m AS (SELECT {', '.join(MATCHED)} FROM lineitem), k AS (SELECT place, org, title, bool_or(weak) AS weak, min(confidence) AS c FROM m WHERE org IS NOT NULL GROUP BY 1, 2, 3), p AS (SELECT place, org, count(*) AS n_examples, bool_or(weak) AS weak, avg(CASE c WHEN 'low' THEN 1.0 WHEN 'high' THEN 0.0 END) AS low FROM k GROUP BY 1, 2),
c AS (SELECT {', '.join(WRITTEN)} FROM customer), w AS (SELECT *, row_number() OVER (PARTITION BY place, org ORDER BY rank, id) AS n, count(*) OVER (PARTITION BY place, org) AS k, bool_or(name_check) OVER (PARTITION BY place, org) AS names FROM c)
SELECT place, org, n_examples, email AS to_email, k - 1 AS n_copies, primary_fact, concat_ws(' ', CASE WHEN primary_fact = 'none' THEN '[NO RELATIONSHIP FOUND]' END, CASE WHEN weak THEN '[WEAK CONTACT MATCH]' END, CASE WHEN honorific THEN '[Ms/Mr UNRESOLVED]' END, CASE WHEN names THEN '[NAME CHECK]' END, CASE WHEN low > 0.5 THEN '[WEAK SCOPE MATCH]' END,
CASE WHEN fell_back THEN '[OPENER FELL BACK TO TEMPLATE]' END, CASE WHEN flagged THEN '[BODY SENTENCE NEEDS CHECK]' END, CASE WHEN n_examples > 10 THEN '[LONG LIST - ' || n_examples || ' EXAMPLES]' END, CASE WHEN bilingual THEN '[NEEDS NATIVE CHECK]' END) AS flags FROM p JOIN w USING (place, org) WHERE n = 1""")
def supplier_register(spark, d):
    return V.draft_register(t(spark, d, "lineitem").selectExpr(*MATCHED), t(spark, d, "customer").selectExpr(*WRITTEN), "place", "org", "id")


@query(f"WITH c AS (SELECT {', '.join(WRITTEN)} FROM customer) SELECT email, count(*) AS n FROM c WHERE (place, org) IN (SELECT (l_suppkey % 25, l_suppkey) FROM lineitem WHERE l_suppkey % 10 > 0) GROUP BY email HAVING count(*) > 1")
def addresses_in_drafts(spark, d):
    contacts = t(spark, d, "customer").selectExpr(*WRITTEN)
    drafts = V.draft_register(t(spark, d, "lineitem").selectExpr(*MATCHED), contacts, "place", "org", "id")
    copies = V.draft_copies(contacts, "place", "org", "id").join(drafts.select("place", "org"), ["place", "org"], "left_semi")
    return V.shared_addresses(drafts, copies)


LANDED = ("'N' || o_custkey % 25 AS country", "CASE WHEN o_orderkey % 5 > 0 THEN 'T' || o_orderkey END AS title", "'http://x/' || o_orderkey AS url", "CASE o_custkey % 6 WHEN 0 THEN 'A strong' WHEN 1 THEN 'B partner' WHEN 2 THEN 'C lead' WHEN 3 THEN 'D review' WHEN 4 THEN 'E out' END AS category", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 = 1 END AS humanitarian",
          "CASE o_orderkey % 6 WHEN 0 THEN 'IN' WHEN 1 THEN 'POSSIBLE' WHEN 2 THEN 'NEW' WHEN 3 THEN 'MULTI: review' WHEN 4 THEN 'odd' END AS register_flag", "CASE WHEN o_custkey % 2 = 0 THEN o_totalprice END AS relevance", "year(o_orderdate) AS year", "o_totalprice AS score",
          "CASE WHEN o_custkey % 3 > 0 THEN 'p' || o_custkey % 90 END AS primary_contact", "o_orderstatus AS primary_type", "o_orderpriority AS primary_source", "CASE WHEN o_custkey % 4 > 0 THEN 'p' || o_custkey % 70 END AS secondary_contact", "'other' AS secondary_type", "'site' AS secondary_source")


@query(f"""WITH r AS (SELECT {', '.join(LANDED)} FROM orders), k AS (SELECT *, coalesce(category[1], '?') AS category_letter FROM r) SELECT url, '[web] ' || coalesce(title, url) AS dashboard_title, category_letter, CASE WHEN register_flag IS NULL THEN 'unknown (not compared)' WHEN register_flag = 'IN' THEN 'Yes - matches a reported project' WHEN register_flag = 'POSSIBLE' THEN 'Possibly - the country reports'
WHEN register_flag = 'NEW' THEN 'No - not yet reported' WHEN register_flag LIKE 'MULTI%' THEN 'Multi-country - review per country' ELSE register_flag END AS in_register, category_letter IN ('A', 'B', 'D') AS is_actionable, category_letter = 'E' AS is_suppressed, category_letter IN ('A', 'B', 'D') AND NOT coalesce(humanitarian, false) AS is_official_actionable, relevance IS NOT NULL AS is_reviewed, NULL::VARCHAR AS iso3 FROM k""")
def fact_rows(spark, d):
    return V.fact_table(t(spark, d, "orders").selectExpr(*LANDED), "web").select("url", "dashboard_title", "category_letter", "in_register", "is_actionable", "is_suppressed", "is_official_actionable", "is_reviewed", "iso3")


@query(f"""WITH r AS (SELECT {', '.join(LANDED)} FROM orders), b AS (SELECT country, title, primary_contact AS email, primary_type AS contact_type, primary_source AS contact_source, 'primary' AS rank, 0 AS side FROM r UNION ALL SELECT country, title, secondary_contact, secondary_type, secondary_source, 'secondary', 1 FROM r)
SELECT country, email, title, contact_type, contact_source, rank FROM (SELECT *, row_number() OVER (PARTITION BY country, email ORDER BY side, title NULLS FIRST, contact_type, contact_source) AS k FROM b WHERE email IS NOT NULL) WHERE k = 1""")
def contact_rows(spark, d):
    return V.contact_table(t(spark, d, "orders").selectExpr(*LANDED), "web").select("country", "email", "title", "contact_type", "contact_source", "rank")


TOOLS = ("Household  Survey", "Administrative data", "Workshop", "")
ADVICE = ("irrs 3; IRIS 2", "iross", "none", "")
LINKS = ("see http://a.org/x, and (https://b.org/y)", "http://a.org/x", "no link", "https://c.org/z]")
ANSWERED = {
    "lead_code": "CAST(o_custkey % 4 AS {text})", "country": pick("(o_custkey // 2)", PLACES), "organisation": pick("o_custkey", OFFICES), "title": pick("o_orderkey", TITLES), "answered": pick("o_custkey", CODED), "source_tool": pick("o_orderkey", TOOLS),
    "recommendations": pick("(o_orderkey // 3)", ADVICE), "description": pick("(o_orderkey // 2)", (*DESCRIBED, "the host  community")), "results": pick("o_orderkey", LINKS), "questionnaire": pick("(o_orderkey // 5)", LINKS), "notes": pick("o_custkey", LINKS),
}
FOUND = "regexp_extract_all(coalesce({}, ''), '" + L.ADDRESS.replace("'", "''") + "', 1)"


@query(f"""WITH r AS (SELECT o_orderkey, {', '.join(f"{v.format(text='VARCHAR')} AS {k}" for k, v in ANSWERED.items())} FROM orders), k AS (SELECT *, {SQUISH("coalesce(title, '')")} AS t, {SQUISH("coalesce(description, '')")} AS ds, lower({SQUISH("coalesce(source_tool, '')")}) AS tool, upper({SQUISH("coalesce(recommendations, '')")}) AS rec, upper(coalesce(answered, '')) AS c,
 {FOUND.format('results')} AS u1, {FOUND.format('questionnaire')} AS u2, {FOUND.format('notes')} AS u3 FROM r), z AS (SELECT *, u1 || u2 || u3 AS u FROM k)
SELECT o_orderkey, CASE lead_code WHEN '1' THEN 'country-led' WHEN '2' THEN 'institution-led' WHEN '3' THEN 'other' ELSE 'unknown' END AS lead_type, coalesce(country, '') AS country, t AS title,
array_to_string(list_filter([CASE WHEN regexp_matches(c, '(^|\\s)REFUGEES(\\s|$)') THEN 'refugees' END, CASE WHEN regexp_matches(c, '(^|\\s)IDPS(\\s|$)') THEN 'idps' END, CASE WHEN regexp_matches(c, '(^|\\s)STATELESSNESS(\\s|$)') THEN 'stateless' END, CASE WHEN regexp_matches(c, '(^|\\s)OTHER(\\s|$)') THEN 'other' END], lambda x: x IS NOT NULL), ';') AS populations,
u1[1] AS link_results, u2[1] AS link_questionnaire, array_to_string(list_filter(u, lambda x, i: list_position(u, x) = i), ' ') AS urls, len(list_distinct(u))::INT AS n_urls, contains(rec, 'IRRS') AS irrs, contains(rec, 'IRRS') OR contains(rec, 'IRIS') OR contains(rec, 'IROSS') AS has_framework, {M('tool', L.MICRODATA_TOOLS)} AS is_microdata,
{M("lower(concat_ws(' ', t, ds))", L.HOSTS)} OR regexp_matches(c, '(^|\\s)OTHER(\\s|$)') AS host_signal FROM z""")
def roster_rows(spark, d):
    answers = t(spark, d, "orders").selectExpr("o_orderkey", *[f"{v.format(text='STRING').replace('//', 'DIV') if 'http' not in v else v.replace(' // ', ' DIV ')} AS {k}" for k, v in ANSWERED.items()])
    return L.roster_normalise(answers, "results", "questionnaire", ["notes"]).select(
        "o_orderkey", "lead_type", "country", "title", "populations", "link_results", "link_questionnaire", F.array_join("urls", " ").alias("urls"), "n_urls", "irrs", "has_framework", "is_microdata", "host_signal",
    )
