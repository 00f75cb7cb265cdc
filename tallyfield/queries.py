"""Registered queries over the driver's tables, each with SQL for DuckDB that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import classify as C
from .functions import text as T
from .operators import aggregates as A
from .operators import joins as J
from .operators import matching as MT
from .operators import phrases as PH
from .operators import ranking as R
from .operators import reports as P
from .plans.rules import all_matches, first_match, rank_of
from .sources import io
from .streaming import lifecycle as L

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Concepts that the synthetic texts do hold, in the place of the subject terms of real corpora.
TERMS = {"core": r"(?:the|les|der|los) (?:of|la|und|de)", "framework": r"tion", "generic": r"\*\*\*|\$\$\$", "inclusion": r"\d{3}"}
STRIP = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), 'mga=\S+', ' ', 'g'), '[A-Za-z_]+[:=]\d{3,}', ' ', 'g'), 'https?://\S+', ' ', 'g'), '[?&][A-Za-z_]+=', ' ', 'g')"
COUNTS = ", ".join(f"len(regexp_extract_all(s, '{p}'))::INT AS n_{k}" for k, p in TERMS.items())
SIGNALS = f"sig AS (SELECT *, {COUNTS} FROM (SELECT *, {STRIP} AS s FROM documents))"
STARTS = "(SELECT doc_id, unnest(list_transform(range(1, len(p)), lambda i: list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * {n})) AS at FROM (SELECT doc_id, string_split(s, '{term}') AS p FROM sig))"
NEAR = f"""a AS {STARTS.format(term="tion of", n=7)}, b AS {STARTS.format(term="the th", n=6)},
n AS (SELECT DISTINCT a.doc_id FROM a ASOF JOIN b ON a.doc_id = b.doc_id AND a.at >= b.at WHERE a.at - b.at <= 250 UNION SELECT DISTINCT a.doc_id FROM a ASOF JOIN b ON a.doc_id = b.doc_id AND a.at <= b.at WHERE b.at - a.at <= 250)"""
SCORE = """CASE WHEN n_generic > 20 THEN 0 WHEN n_core = 0 AND n_framework = 0 AND n_generic = 0 THEN least(raw, 20)
  WHEN n_core = 0 AND n_framework = 0 THEN least(raw, 30) ELSE least(raw, 100) END::INT"""
RAW = "n_core + n_framework * 10 + CASE WHEN n_inclusion > 0 THEN 15 ELSE 0 END + CASE WHEN doc_id IN (SELECT doc_id FROM n) THEN 15 ELSE 0 END + CASE WHEN regexp_matches(lower(text[1:200]), 'tion') THEN 25 ELSE 0 END"


def scored(docs: DataFrame) -> DataFrame:
    s = docs.withColumn("clean", T.strip_web_noise(F.lower("text")))
    s = s.withColumns({f"n_{k}": F.regexp_count("clean", F.lit(p)) for k, p in TERMS.items()})
    excluded = F.col("n_generic") > 20
    title = F.lower(F.substring("text", 1, 200)).rlike("tion")
    score = P.relevance(F.col("n_core"), F.col("n_framework"), F.col("n_generic"), F.col("n_inclusion") > 0, C.near_in(F.col("clean"), "tion of", "the th"), title, excluded)
    s = s.withColumn("score", score)
    return s.withColumn("category", P.category(F.col("n_core"), F.col("n_framework"), F.col("n_generic"), (F.col("n_core") >= 2) & title, excluded))


CATEGORY = """CASE WHEN n_generic > 20 THEN 'E. Suppress' WHEN n_core = 0 AND n_framework = 0 AND n_generic = 0 THEN 'E. Suppress'
  WHEN n_core >= 2 AND regexp_matches(lower(text[1:200]), 'tion') THEN 'A. Strong candidate' WHEN n_core > 0 THEN 'D. Manual review needed' ELSE 'C. Evidence lead only' END"""


@query(f"""WITH {SIGNALS}, {NEAR}, r AS (SELECT *, {RAW} AS raw FROM sig), z AS (SELECT source, lang, {SCORE} AS score, {CATEGORY} AS category FROM r)
SELECT source, lang, count(*) AS n, count(*) FILTER (category LIKE 'A%') AS n_strong, max(score) AS best, sum(score)::BIGINT AS total FROM z GROUP BY source, lang""")
def relevance_rollup(spark, d):
    s = scored(t(spark, d, "documents"))
    return s.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.col("category").startswith("A")).alias("n_strong"), F.max("score").alias("best"), F.sum("score").alias("total"))


@query(f"WITH {SIGNALS} SELECT doc_id, n_core, n_framework, n_generic, n_inclusion FROM sig")
def term_counts(spark, d):
    docs = t(spark, d, "documents").select("doc_id", T.strip_web_noise(F.lower("text")).alias("clean"))
    return docs.select("doc_id", *[F.regexp_count("clean", F.lit(p)).alias(f"n_{k}") for k, p in TERMS.items()])


@query(f"WITH {SIGNALS}, {NEAR}, r AS (SELECT *, {RAW} AS raw FROM sig) SELECT doc_id, {SCORE} AS score, {CATEGORY} AS category FROM r")
def relevance_scores(spark, d):
    return scored(t(spark, d, "documents")).select("doc_id", "score", "category")


@query(f"""WITH {SIGNALS}, {NEAR}
SELECT doc_id, doc_id IN (SELECT doc_id FROM n) AS near FROM documents""")
def near_terms(spark, d):
    docs = t(spark, d, "documents").select("doc_id", T.strip_web_noise(F.lower("text")).alias("clean"))
    return docs.select("doc_id", F.coalesce(C.near_in(F.col("clean"), "tion of", "the th"), F.lit(False)).alias("near"))


FOLD = "trim(regexp_replace(lower(regexp_replace(translate(coalesce({c}, ''), '%s', '%s'), '([a-z])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+', ' ', 'g'))" % (T.ACCENTED, T.PLAIN)


@query("SELECT doc_id, md5(" + FOLD.format(c="replace(text, 'ß', 'ss')") + ") AS folded, trim(regexp_replace(regexp_replace(lower(text[1:120]), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g')) AS norm_title FROM documents")
def fold_text(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("folded"), T.norm_title(F.substring("text", 1, 120)).alias("norm_title"))


def _language_sql() -> str:
    scripts = " ".join(f"WHEN regexp_matches(text, '{p.replace('p{Is', 'p{')}') THEN '{name}'" for name, p in T.SCRIPTS)
    words = lambda w: "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{x}'" for x in w.split("|")) + ")))"
    extra = lambda letters: "".join(f" + {k} * len(regexp_extract_all(low, '{p}'))" for p, k in letters)
    rows = ", ".join(f"('{name}', {k}, {words(w)}{extra(letters)})" for k, (name, w, letters) in enumerate(T.FUNCTION_WORDS))
    return f"""SELECT doc_id, CASE WHEN text IS NULL OR length(text) < 20 THEN NULL {scripts} ELSE (SELECT CASE WHEN n >= 3 THEN l ELSE 'Latin script (undetermined)' END FROM (VALUES {rows}) v(l, k, n) ORDER BY n DESC, k LIMIT 1) END AS language
FROM (SELECT *, lower(text) AS low, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS w FROM documents)"""


@query(_language_sql())
def language_of(spark, d):
    return t(spark, d, "documents").select("doc_id", T.detect_language(F.col("text")).alias("language"))


@query(r"""SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
 array_to_string(string_split(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', ''), '.')[-2:], '.') AS domain, regexp_replace(lower(url), '/(en|es|fr|de|pt|ru|ar)/', '/LANG/', 'g') AS lang_free FROM pages""")
def url_parts(spark, d):
    u = F.col("url")
    host = T.host_of(u)
    return t(spark, d, "pages").select("page_id", host.alias("host"), T.path_of(u).alias("path"), T.registrable_domain(host).alias("domain"), T.norm_lang_path(u).alias("lang_free"))


@query(r"""SELECT page_id, count(*) AS n_links, count(DISTINCT h) AS n_distinct FROM (SELECT page_id, trim(regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1)
    || regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2) || regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)) AS h
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+)[^>]*>.*?</a>')) AS a FROM pages)) WHERE h <> '' AND NOT regexp_matches(h, '(?i)^(mailto:|javascript:|tel:|#)') GROUP BY page_id""")
def page_links(spark, d):
    return io.extract_links(t(spark, d, "pages"), keep=("page_id",)).groupBy("page_id").agg(F.count("*").alias("n_links"), F.countDistinct("link").alias("n_distinct"))


@query(r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>|<footer\b.*?</footer>|<noscript\b.*?</noscript>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) AS text_md5 FROM pages""")
def page_text(spark, d):
    return t(spark, d, "pages").select("page_id", F.md5(T.html_to_text(F.col("html"))).alias("text_md5"))


@query(r"SELECT o_orderkey, year(o_orderdate)::INT AS y, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS level, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderstatus = 'F' THEN 'done' ELSE 'other' END AS class FROM orders")
def rule_table(spark, d):
    rules = [("large", "o_totalprice > 300000"), ("open", "o_orderstatus = 'O'"), ("done", "o_orderstatus = 'F'")]
    return t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), rank_of("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).alias("level"), first_match(rules, "other").alias("class"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(text, 'the ') THEN 'a' END, CASE WHEN contains(text, '***') THEN 'b' END, CASE WHEN n_chars > 2000 THEN 'c' END], lambda x: x IS NOT NULL), ',') AS tags FROM documents")
def tag_sets(spark, d):
    tags = all_matches([("a", F.contains("text", F.lit("the "))), ("b", F.contains("text", F.lit("***"))), ("c", F.col("n_chars") > 2000)])
    return t(spark, d, "documents").select("doc_id", F.array_join(tags, ",").alias("tags"))


@query(r"SELECT doc_id, len(list_distinct(list_filter(regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})', 1), lambda e: NOT regexp_matches(lower(e), 'noreply|no-reply|sentry|wixpress'))))::INT AS n_emails, regexp_extract(text, '((?:19|20)\d{2})', 1) AS year_text FROM documents")
def emails_and_years(spark, d):
    e = T.emails(F.col("text"), r"noreply|no-reply|sentry|wixpress", None)
    return t(spark, d, "documents").select("doc_id", F.size(e).alias("n_emails"), F.regexp_extract("text", r"((?:19|20)\d{2})", 1).alias("year_text"))


@query("SELECT doc_id, i::INT AS chunk_no, text[i * 1000 + 1 : i * 1000 + 1000] AS chunk FROM (SELECT doc_id, text, unnest(range(0, greatest(ceil(length(text) / 1000), 1)::BIGINT)) AS i FROM documents)")
def chunks(spark, d):
    return t(spark, d, "documents").select("doc_id", F.posexplode(T.chunk_text(F.col("text"), 1000)).alias("chunk_no", "chunk"))


@query(None)
def excerpts(spark, d):
    return t(spark, d, "documents").select("doc_id", T.windows_with(F.col("text"), "tion", 1500, 6000).alias("excerpt"))


@query("SELECT doc_id, item_id FROM documents JOIN benchmark ON contains(documents.text, benchmark.text)")
def quotes_in_documents(spark, d):
    """Whether an item's own words stand in a text."""
    return PH.phrases_in_texts(t(spark, d, "documents"), t(spark, d, "benchmark"), "doc_id", "text", "item_id", "text")


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 3")
def top_orders(spark, d):
    return R.top_n(t(spark, d, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


@query("SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, left(lower(text), 60) ORDER BY n_chars DESC, doc_id) AS k2 FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1) WHERE k2 = 1")
def dedupe_documents(spark, d):
    docs = t(spark, d, "documents").withColumn("head", F.lower(F.substring("text", 1, 60)))
    return R.keep_best(docs, [["text"], ["source", "head"]], [F.col("n_chars").desc(), "doc_id"]).select("doc_id")


@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 2 ORDER BY o_totalprice DESC, o_orderkey LIMIT 110")
def capped_orders(spark, d):
    return R.two_level_cap(t(spark, d, "orders"), "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2, 110).select("o_orderkey")


@query("SELECT l_partkey, l_orderkey, l_linenumber, m.also_in FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS k FROM lineitem) JOIN (SELECT l_partkey, string_agg(DISTINCT l_linestatus || l_returnflag, '; ' ORDER BY l_linestatus || l_returnflag) AS also_in FROM lineitem GROUP BY l_partkey) m USING (l_partkey) WHERE k = 1")
def survivors_with_sources(spark, d):
    li = t(spark, d, "lineitem").withColumn("src", F.concat("l_linestatus", "l_returnflag"))
    return R.also_in(li, ["l_partkey"], "src", [F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber"]).select("l_partkey", "l_orderkey", "l_linenumber", "also_in")


@query("SELECT p_partkey, n_members FROM part JOIN (SELECT p_type, count(DISTINCT p_brand) AS n_members FROM part GROUP BY p_type HAVING count(DISTINCT p_brand) >= 3) USING (p_type)")
def shared_types(spark, d):
    return R.shared_by(t(spark, d, "part"), "p_type", "p_brand", 3).select("p_partkey", "n_members")


@query("SELECT o_orderkey, printf('%d_%02d', o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS ref FROM orders")
def order_refs(spark, d):
    return R.numbered(t(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "%d_%02d", "ref").select("o_orderkey", "ref")


SAMPLED = """, {name} AS (SELECT o_orderkey, '{label}' AS stratum FROM (SELECT * FROM pool WHERE {where} AND o_orderkey NOT IN (SELECT o_orderkey FROM {before}) ORDER BY md5('1:' || o_orderkey), o_orderkey LIMIT {quota}))
, {name}_all AS (SELECT * FROM {before} UNION ALL SELECT * FROM {name})"""
REVIEW = (("urgent", "urgent and large", "o_orderpriority = '1-URGENT' AND o_totalprice > 400000", 20), ("large", "large", "o_totalprice > 300000", 30), ("rare", "rare", "o_totalprice < 0", 10), ("opened", "open", "o_orderstatus = 'O' AND o_totalprice > 300000", 10))


@query("WITH pool AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')), none_all AS (SELECT 0 AS o_orderkey, '' AS stratum WHERE false)"
       + "".join(SAMPLED.format(name=n, label=label, where=w, quota=q, before=f"{b}_all") for (n, label, w, q), b in zip(REVIEW, ("none", "urgent", "large", "rare")))
       + SAMPLED.format(name="more", label="top-up: large", where="o_totalprice > 200000", quota="(SELECT 75 - count(*) FROM opened_all)", before="opened_all")
       + " SELECT o_orderkey, stratum, row_number() OVER (ORDER BY md5('1 shuffled:' || o_orderkey), o_orderkey)::INT AS position FROM more_all")
def review_sample(spark, d):
    """Orders for review by quotas, topped up where a stratum is short, and shuffled."""
    strata = [(label, F.expr(w), q) for _, label, w, q in REVIEW]
    seen = t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.stratified_sample(t(spark, d, "orders"), strata, "o_orderkey", 1, seen, 75, [("top-up: large", F.expr("o_totalprice > 200000"))]).select("o_orderkey", "stratum", "position")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS o_orderpriority FROM orders GROUP BY o_custkey")
def collapsed_orders(spark, d):
    return A.collapse(t(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], ["o_orderkey"], "o_orderpriority").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT o_custkey, min(year(o_orderdate))::INT AS first_year, max(year(o_orderdate))::INT AS last_year, count(*) AS n_responses, CASE WHEN max(year(o_orderdate)) >= 1998 THEN 'ACTIVE' ELSE 'LAPSED' END AS status FROM orders GROUP BY o_custkey")
def response_history(spark, d):
    return A.response_status(t(spark, d, "orders").withColumn("y", F.year("o_orderdate")), "o_custkey", "y", 1998)


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY o_orderpriority")
def priority_by_status(spark, d):
    return A.cross_tab(t(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("SELECT c_nationkey, count(*) AS n, count(*) FILTER (c_acctbal > 5000) AS n_rich, count(DISTINCT c_mktsegment) AS n_segments, bool_or(c_acctbal < 0) AS any_debt, max(c_acctbal) AS best FROM customer GROUP BY c_nationkey")
def nation_rollup(spark, d):
    return t(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 5000).alias("n_rich"), F.countDistinct("c_mktsegment").alias("n_segments"), F.bool_or(F.col("c_acctbal") < 0).alias("any_debt"), F.max("c_acctbal").alias("best"))


@query("WITH r AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS x, l_quantity AS w, l_linestatus AS g FROM lineitem), d AS (SELECT g, false AS is_total, x, w FROM r UNION ALL SELECT NULL, true, x, w FROM r), p AS (SELECT g, is_total, sum(w * x) / sum(w) AS p, sum(w) AS tw, count(*) AS n FROM d GROUP BY g, is_total), s AS (SELECT d.g, d.is_total, sum(pow(d.w * (d.x - p.p) / p.tw, 2)) AS ss FROM d JOIN p ON d.g IS NOT DISTINCT FROM p.g AND d.is_total = p.is_total GROUP BY ALL) SELECT p.g AS l_linestatus, p.is_total, n, round(p * 100, 6) AS est, round(sqrt((SELECT count(*) FROM r) / ((SELECT count(*) FROM r) - 1.0) * ss) * 100, 6) AS se, n < 30 AS suppressed FROM p JOIN s ON p.g IS NOT DISTINCT FROM s.g AND p.is_total = s.is_total")
def weighted_shares(spark, d):
    li = t(spark, d, "lineitem").withColumn("x", (F.col("l_returnflag") == "R").cast("int"))
    return A.weighted_proportion(li, "x", "l_quantity", "l_linestatus").withColumn("est", F.round("est", 6)).withColumn("se", F.round("se", 6))


@query("WITH r AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS x, l_quantity AS w, l_linenumber AS h, l_suppkey AS c FROM lineitem), t AS (SELECT sum(w) AS tw, sum(w * x) / sum(w) AS p, count(*) AS n FROM r), z AS (SELECT h, c, sum(w * (x - (SELECT p FROM t))) / (SELECT tw FROM t) AS z FROM r GROUP BY h, c), s AS (SELECT h, count(*) AS m, CASE WHEN count(*) > 1 THEN count(*) * var_samp(z) ELSE pow(sum(z) - (SELECT avg(z) FROM z), 2) END AS v FROM z GROUP BY h) SELECT (SELECT n FROM t) AS n, count(*) AS strata, sum(m)::BIGINT AS clusters, round((SELECT p FROM t) * 100, 6) AS est, round(sqrt(sum(v)) * 100, 6) AS se FROM s")
def cluster_estimate(spark, d):
    li = t(spark, d, "lineitem").withColumn("x", (F.col("l_returnflag") == "R").cast("int"))
    return A.stratified_cluster(li, "x", "l_quantity", "l_linenumber", "l_suppkey").withColumn("est", F.round("est", 6)).withColumn("se", F.round("se", 6))


@query(f"WITH {SIGNALS}, {NEAR}, r AS (SELECT *, {RAW} AS raw FROM sig), z AS (SELECT doc_id, {SCORE} AS score FROM r), j AS (SELECT quality = 1 AS a, score >= 50 AS b FROM labels JOIN z USING (doc_id)) SELECT count(*) AS n, round(count(*) FILTER (a = b) / count(*)::DOUBLE, 6) AS agreement, round(count(*) FILTER (a AND b) / greatest(count(*) FILTER (b), 1)::DOUBLE, 6) AS precision, round(count(*) FILTER (a AND b) / greatest(count(*) FILTER (a), 1)::DOUBLE, 6) AS recall FROM j")
def label_agreement(spark, d):
    z = t(spark, d, "labels").join(scored(t(spark, d, "documents")).select("doc_id", "score"), "doc_id")
    return A.agreement(z, F.col("quality") == 1, F.col("score") >= 50).select("n", *[F.round(c, 6).alias(c) for c in ("agreement", "precision", "recall")])


@query("SELECT user_id, round(arg_max(value, ts) FILTER (event_type = 'click'), 6) AS click, round(arg_max(value, ts) FILTER (event_type = 'view'), 6) AS view, round(coalesce(arg_max(value, ts) FILTER (event_type = 'click'), 0) + coalesce(arg_max(value, ts) FILTER (event_type = 'view'), 0), 6) AS total FROM events GROUP BY user_id")
def latest_values(spark, d):
    out = A.latest_wide(t(spark, d, "events"), "user_id", "event_type", "ts", "value", ["click", "view"])
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("click", "view", "total")])


@query("WITH n AS (SELECT count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT') SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT' ORDER BY o_totalprice DESC, o_orderkey LIMIT (SELECT CAST(floor(n * (1 - 0.7) / 0.7) AS BIGINT) FROM n))")
def capped_mix(spark, d):
    return A.composition_cap(t(spark, d, "orders"), F.col("o_orderpriority") == "1-URGENT", 0.7, [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_orderkey")


@query("SELECT concept, count(DISTINCT CASE WHEN has THEN doc_id END) AS n_ids, count(DISTINCT doc_id) AS n_all FROM (SELECT doc_id, 'long' AS concept, n_chars > 2000 AS has FROM documents UNION ALL SELECT doc_id, 'english', lang = 'en' FROM documents) GROUP BY concept")
def concept_coverage(spark, d):
    docs = t(spark, d, "documents").select("doc_id", (F.col("n_chars") > 2000).alias("long"), (F.col("lang") == "en").alias("english"))
    return A.coverage(docs, ["long", "english"], "doc_id").select("concept", "n_ids", "n_all")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def never_ordered(spark, d):
    return J.not_covered(t(spark, d, "customer"), t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey")


@query("WITH l AS (SELECT l_orderkey, l_suppkey, l_shipdate, l_returnflag FROM lineitem), h AS (SELECT o_orderkey, bool_or(o_orderstatus = l_linestatus AND year(o_orderdate) BETWEEN year(l_shipdate) - 1 AND year(l_shipdate) + 1) AS b, bool_or(o_orderstatus = l_linestatus) AS p FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey) SELECT o_orderkey, CASE WHEN b THEN 'IN_REGISTER' WHEN b IS NOT NULL THEN 'POSSIBLE' ELSE 'NEW' END AS flag, CASE WHEN b THEN 'group and year' WHEN p THEN 'group' WHEN b IS NOT NULL THEN 'block' ELSE 'none' END AS basis FROM orders LEFT JOIN h USING (o_orderkey)")
def register_flags(spark, d):
    cand = t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("id"), F.array("o_orderstatus").alias("g"), F.year("o_orderdate").alias("y"))
    ref = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.array("l_linestatus").alias("g"), F.year("l_shipdate").alias("y0"), F.year("l_shipdate").alias("y1"))
    return J.flag_exists(cand, ref, "k", "id", ("g", "g"), "y", ("y0", "y1")).select(F.col("id").alias("o_orderkey"), "flag", "basis")


@query(r"WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS host FROM pages) SELECT page_id, host = 'example.com' OR ends_with(host, '.example.com') OR ends_with(host, '.example.org') AS own_site FROM h")
def own_site_pages(spark, d):
    pages = t(spark, d, "pages").select("page_id", "url", F.lit("x").alias("country"))
    sites = spark.createDataFrame([("x", "example.com"), ("x", "example.org")], "country string, domain string")
    return J.on_own_site(pages, sites, "url", "country", "domain").select("page_id", "own_site")


TOKENS = "list_distinct(string_split(lower(p_name), ' '))"


@query(f"WITH l AS (SELECT p_partkey, p_brand, {TOKENS} AS w FROM part), s AS (SELECT l.p_partkey, r.p_partkey AS m, len(list_intersect(l.w, r.w)) AS n, len(l.w) AS a, len(r.w) AS b FROM l JOIN l AS r ON l.p_brand = r.p_brand AND l.p_partkey <> r.p_partkey), b AS (SELECT *, n / (a + b - n)::DOUBLE AS score, row_number() OVER (PARTITION BY p_partkey ORDER BY n / (a + b - n)::DOUBLE DESC, m) AS k FROM s WHERE n > 0 AND n / (a + b - n)::DOUBLE >= 0.2) SELECT l.p_partkey, m AS match_id, round(score, 6) AS match_score, CASE WHEN score >= 0.6 THEN 'high' WHEN score >= 0.4 THEN 'medium' WHEN score IS NOT NULL THEN 'low' ELSE 'none' END AS confidence FROM l LEFT JOIN b ON l.p_partkey = b.p_partkey AND k = 1")
def part_name_matches(spark, d):
    """Every part against all others of its brand."""
    p = t(spark, d, "part").withColumn("w", F.split(F.lower("p_name"), " "))
    out = J.best_token_match(p, p, "p_brand", "p_partkey", "p_partkey", "w", same=True)
    return out.select("p_partkey", "match_id", F.round("match_score", 6).alias("match_score"), "confidence")


@query("""WITH p AS (SELECT p_partkey AS id, p_brand, p_size, p_type, p_size + 1990 AS y, list_distinct(string_split(p_name, ' ')) AS w FROM part),
x AS (SELECT c.id AS c_id, e.id AS e_id, c.p_size = e.p_size AS org_ok, (c.p_type = e.p_type)::INT AS acr, len(list_intersect(c.w, e.w)) AS ov, len(c.w) + len(e.w) AS nn, c.y AS cy, e.y AS ey FROM p c JOIN p e ON c.p_brand = e.p_brand AND c.id <> e.id),
z AS (SELECT *, ov / (nn - ov)::DOUBLE AS jac FROM x), g AS (SELECT *, acr > 0 OR ov >= 3 OR (jac >= 0.5 AND ov >= 2) AS strong FROM z),
k AS (SELECT *, CASE WHEN org_ok AND strong AND abs(cy - ey) <= 1 THEN 1 WHEN org_ok AND strong AND cy > ey + 1 THEN 2 WHEN NOT org_ok AND strong THEN 4 WHEN org_ok AND NOT strong AND ov = 1 AND jac >= 0.5 THEN 4 WHEN org_ok THEN 6 ELSE 7 END AS cat FROM g),
r AS (SELECT *, cat * 10 - jac * 5 - acr * 3 AS score FROM k), b AS (SELECT *, row_number() OVER (PARTITION BY c_id ORDER BY score, e_id) AS n FROM r)
SELECT p.id AS c_id, min(e_id) FILTER (n = 1) AS e_id, coalesce(CASE min(cat) FILTER (n = 1) WHEN 1 THEN 'same product' WHEN 2 THEN 'new edition' WHEN 4 THEN 'check - likely same' WHEN 6 THEN 'same org, other product' WHEN 7 THEN 'other producer' END, 'no reference in block') AS category, round(min(score), 6) AS score, string_agg(e_id::VARCHAR, ',' ORDER BY n) FILTER (n <= 3) AS top_ids FROM p LEFT JOIN b ON b.c_id = p.id GROUP BY p.id""")
def product_matches(spark, d):
    """Every part against all others of its brand; sizes stand for offices, types for product codes."""
    p = t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("block"), F.array("p_size").alias("org"), F.split("p_name", " ").alias("tokens"), F.array("p_type").alias("codes"), C.product_type(F.col("p_name")).alias("type"), (F.col("p_size") + 1990).alias("y0"), (F.col("p_size") + 1990).alias("y1"))
    out = MT.pair_check(p, p, same=True)
    return out.select("c_id", "e_id", "category", F.round("score", 6).alias("score"), "top_ids")


@query("WITH x AS (SELECT o_orderkey, l_partkey, year(o_orderdate) AS y, o_custkey % 10 AS blk FROM orders JOIN lineitem ON l_orderkey = o_orderkey), p AS (SELECT x.o_orderkey AS l_id, z.o_orderkey AS r_id, count(DISTINCT x.l_partkey) AS shared, min(abs(x.y - z.y)) AS gap FROM x JOIN x AS z ON x.blk = z.blk AND x.l_partkey = z.l_partkey AND x.o_orderkey <> z.o_orderkey GROUP BY ALL) SELECT l_id, r_id, shared, gap::INT AS gap, CASE WHEN gap <= 2 THEN 'same period' ELSE 'other period' END AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY l_id ORDER BY shared DESC, gap, r_id) AS k FROM p) WHERE k = 1")
def shared_parts(spark, d):
    """Every order against all others of its block of customers."""
    o = t(spark, d, "orders").join(t(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(F.collect_set("l_partkey").alias("codes"), F.first(F.year("o_orderdate")).alias("y"), F.first(F.col("o_custkey") % 10).alias("blk"))
    return J.programme_overlap(o, o, "blk", "o_orderkey", "o_orderkey", "codes", "y", same=True)


@query("WITH s AS (SELECT vec_id AS seed_id, embedding AS v FROM embeddings WHERE vec_id < 20), p AS (SELECT vec_id, seed_id, list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]) AS sim FROM embeddings, s), b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 12) DESC, seed_id) AS k FROM p) SELECT vec_id, seed_id, round(sim, 6) AS similarity FROM b WHERE k = 1")
def nearest_seeds(spark, d):
    """Every vector against twenty stated examples."""
    e = t(spark, d, "embeddings")
    out = J.nearest_seed(e, e.where("vec_id < 20"), "embedding", "vec_id", "vec_id")
    return out.select("vec_id", "seed_id", F.round("similarity", 6).alias("similarity"))


@query("WITH c AS (SELECT c_nationkey, lower(trim(c_mktsegment)) AS o, c_name AS e, c_acctbal > 9000 AS p FROM customer), x AS (SELECT DISTINCT a.c_nationkey, a.e AS to_email, b.e FROM c a JOIN c b USING (c_nationkey, o) WHERE a.p AND NOT b.p AND a.e <> b.e), k AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, to_email ORDER BY e) AS k FROM x) SELECT c_nationkey, to_email, string_agg(e, '; ' ORDER BY e) AS cc FROM k WHERE k <= 3 GROUP BY ALL")
def copies_of_office(spark, d):
    c = t(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_name", (F.col("c_acctbal") > 9000).alias("p"))
    return J.same_org_copies(c, "c_nationkey", "c_mktsegment", "c_name", "p")


@query("SELECT n_name AS name, coalesce(r.code, n.code) AS code, CASE WHEN r.code IS NOT NULL THEN 0 ELSE 1 END AS source_no FROM (SELECT n_name, n_nationkey AS code FROM nation) n LEFT JOIN (SELECT n_name, n_regionkey AS code FROM nation WHERE n_regionkey < 2) r USING (n_name)")
def name_codes(spark, d):
    n = t(spark, d, "nation")
    return J.alias_crosswalk([n.where("n_regionkey < 2").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("code")), n.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"))])


@query("WITH m AS (SELECT o_custkey % 25 AS c, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL), g AS (SELECT n_nationkey AS c, p FROM nation, (SELECT DISTINCT o_orderpriority AS p FROM orders)), pub AS (SELECT o_custkey % 25 AS c, o_orderpriority AS p, bool_or(o_totalprice > 480000) AS v, bool_or(o_totalprice > 400000) AS r FROM orders GROUP BY ALL), s AS (SELECT DISTINCT o_custkey % 25 AS c, o_orderpriority AS p FROM orders WHERE o_totalprice < 1000), u AS (SELECT o_custkey % 25 AS c, count(*) AS nd, count(*) FILTER (o_orderstatus = 'P') AS nm FROM orders GROUP BY ALL) SELECT c AS country, p AS code, CASE WHEN coalesce(v, false) THEN 'published' WHEN s.c IS NOT NULL THEN 'demonstrated' WHEN nm > 0 THEN 'tabulation candidate' WHEN coalesce(r, false) THEN 'related only (review)' ELSE 'gap' END AS cell_status FROM g LEFT JOIN pub USING (c, p) LEFT JOIN s USING (c, p) LEFT JOIN u USING (c) WHERE coalesce(nd, 0) > 0")
def gap_cells(spark, d):
    o = t(spark, d, "orders").withColumn("country", F.col("o_custkey") % 25).withColumnRenamed("o_orderpriority", "code")
    grid = J.complete_grid(t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("country")), o.select("code").distinct())
    published = o.groupBy("country", "code").agg(F.bool_or(F.col("o_totalprice") > 480000).alias("has_value"), F.bool_or(F.col("o_totalprice") > 400000).alias("has_related"))
    material = o.groupBy("country").agg(F.count("*").alias("n_docs"), F.count_if(F.col("o_orderstatus") == "P").alias("n_micro"))
    return P.gap_matrix(grid, published, o.where("o_totalprice < 1000"), material, ["country", "code"], ["country"]).select("country", "code", "cell_status")


@query("WITH st AS (SELECT c_custkey, CASE WHEN max(year(o_orderdate)) IS NULL THEN 'NEVER' WHEN max(year(o_orderdate)) >= 1998 THEN 'ACTIVE' ELSE 'LAPSED' END AS status, count(o_orderkey) AS n_evidence, count(*) FILTER (o_totalprice > 300000) AS n_new FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT *, CASE WHEN status = 'NEVER' AND n_new > 0 THEN 'P1' WHEN status = 'LAPSED' AND n_new > 0 THEN 'P2' WHEN status = 'ACTIVE' AND n_new > 0 THEN 'P3' WHEN status = 'LAPSED' THEN 'P4' WHEN status = 'NEVER' THEN 'P5' ELSE 'P6' END AS priority FROM st")
def priorities(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"), (F.col("o_totalprice") > 300000).alias("is_new"))
    status = J.attach(t(spark, d, "customer").select("c_custkey"), A.response_status(o, "c_custkey", "y", 1998), "c_custkey", {"status": "NEVER"}).select("c_custkey", "status")
    return P.priority_matrix(status, o, "c_custkey")


EVENTS = "(SELECT user_id, ts, CASE event_type WHEN 'view' THEN 'draft_ready' WHEN 'click' THEN 'sent' WHEN 'purchase' THEN 'responded' ELSE 'other' END AS kind FROM events)"


def campaign(spark, d):
    kind = F.when(F.col("event_type") == "view", "draft_ready").when(F.col("event_type") == "click", "sent").when(F.col("event_type") == "purchase", "responded").otherwise("other")
    return t(spark, d, "events").select("event_id", "user_id", "ts", kind.alias("kind"))


@query(f"SELECT user_id, count(*) AS n_events, min(ts) FILTER (kind = 'draft_ready') AS date_draft_ready, min(ts) FILTER (kind = 'sent') AS date_sent, min(ts) FILTER (kind = 'responded') AS date_responded, NULL::TIMESTAMP AS date_bounced, CASE max(CASE kind WHEN 'draft_ready' THEN 1 WHEN 'sent' THEN 2 ELSE 3 END) WHEN 1 THEN 'draft_ready' WHEN 2 THEN 'sent' ELSE 'responded' END AS status FROM {EVENTS} WHERE kind <> 'other' GROUP BY user_id")
def lifecycle(spark, d):
    return L.fold(campaign(spark, d), "user_id")


@query(f"SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, kind, count(*) AS n FROM {EVENTS} GROUP BY ALL")
def funnel_by_day(spark, d):
    return L.funnel_by_window(campaign(spark, d), "kind", "ts", "1 day")


@query("WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS f FROM events), g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n FROM g GROUP BY user_id, s")
def user_sessions(spark, d):
    return L.sessions(t(spark, d, "events"), "user_id", "ts", "6 hours")


@query("SELECT conv_id, turn, regexp_extract(text, '^(\\S+ \\S+ \\S+)', 1) AS head, md5(lower(text)) AS k FROM conversations")
def turn_heads(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", F.regexp_extract("text", r"^(\S+ \S+ \S+)", 1).alias("head"), F.md5(F.lower("text")).alias("k"))


@query("SELECT c_custkey, c_name, NULL::VARCHAR AS note, c_acctbal FROM customer")
def export_pack(spark, d):
    from pyspark.sql.types import StructType

    return io.enforce_schema(t(spark, d, "customer"), StructType.fromDDL("c_custkey bigint, c_name string, note string, c_acctbal double"))


@query("SELECT url, snapshot AS snapshot_date, page_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot DESC, page_id) AS k FROM (SELECT regexp_replace(url, '[0-9]+.*$', '') AS url, page_id % 3 AS snapshot, page_id FROM pages)) WHERE k = 1")
def newest_pages(spark, d):
    p = t(spark, d, "pages").select(F.regexp_replace("url", "[0-9]+.*$", "").alias("url"), (F.col("page_id") % 3).alias("snapshot_date"), "page_id")
    return io.union_snapshots([p.where(f"snapshot_date = {k}") for k in range(3)], "url", "snapshot_date", True, ("page_id",)).select("url", "snapshot_date", "page_id")


@query("SELECT source, string_agg(card, chr(10) ORDER BY k) AS card FROM (SELECT source, k, k || '. doc ' || doc_id || ' (' || n_chars || ')' AS card FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k <= 5) GROUP BY source")
def source_cards(spark, d):
    docs = t(spark, d, "documents").withColumn("title", F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    best = R.top_n(docs, ["source"], [F.col("n_chars").desc(), "doc_id"], 5, "k")
    line = F.format_string("%d. %s (%d)", "k", "title", "n_chars")
    return best.groupBy("source").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", line.alias("c")))), lambda x: x["c"]), "\n").alias("card"))  # five a source
