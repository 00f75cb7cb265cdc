"""Registered queries of positions, excerpts, a table function, parsed pages and nearest examples, each with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import classify as C
from .functions import spans as SP
from .operators import aggregates as A
from .operators import vectors as V
from .places_queries import pick
from .queries import query, t
from .sources import html as H

#: Literal terms, so that SQL can find their places: method, population.
METHOD, POPULATION = "tion of", "the th"
#: Places of a literal in low, from 1, as numbers: the lengths of what lies before.
PLACES = "list_transform(range(1, len(string_split(low, '{0}'))), lambda i: (list_sum(list_transform(string_split(low, '{0}')[1:i], lambda x: length(x))) + (i - 1) * {1} + 1)::INT)"


def places(term: str) -> str:
    return PLACES.format(term, len(term))


BLOCKS = "list_transform(range(0, greatest(1, ceil(length(text) / 1500.0)::INT)), lambda b: len(list_filter({}, lambda p: (p - 1) // 1500 = b)))"


@query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, lower(coalesce(text, '')) AS low FROM documents), p AS (SELECT doc_id, text, {places(METHOD)} AS pm, {places(POPULATION)} AS pp FROM d),
b AS (SELECT doc_id, text, {BLOCKS.format('pm')} AS m, {BLOCKS.format('pp')} AS p FROM p),
s AS (SELECT doc_id, text, m, p, i, 2 * m[i + 1] + p[i + 1] + CASE WHEN m[i + 1] > 0 AND p[i + 1] > 0 THEN 4 ELSE 0 END + CASE WHEN i = 0 THEN 1000 ELSE 0 END AS points FROM b, unnest(range(0, len(m))) AS u(i)),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY points DESC, i) AS n FROM s), j AS (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM k WHERE n <= 4 AND points > 0),
x AS (SELECT doc_id, string_agg(CASE WHEN before IS NOT NULL AND i > before + 1 THEN chr(10) || '[...]' || chr(10) ELSE '' END || substr(text, CAST(i * 1500 + 1 AS BIGINT), 1500), '' ORDER BY i) AS joined FROM j GROUP BY doc_id)
SELECT b.doc_id, CASE WHEN length(text) <= 6000 THEN text WHEN list_sum(m) = 0 AND list_sum(p) = 0 THEN substr(text, 1, 6000) ELSE joined END AS excerpt FROM b JOIN x ON b.doc_id = x.doc_id""")
def best_excerpts(spark, d):
    """What a reader sees of a long text: the blocks with most signs of method and of population."""
    return t(spark, d, "documents").select("doc_id", SP.smart_excerpt(F.col("text"), 6000, METHOD, POPULATION).alias("excerpt"))


PASSAGE = "trim(regexp_replace(substr(page, greatest(1, place - 200), place + {0} + 200 - greatest(1, place - 200)), '\\s+', ' ', 'g'))".format(len(METHOD))
CLEANED = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, 'mga=\\S+', ' ', 'g'), '[A-Za-z_]+[:=]\\d{{3,}}', ' ', 'g'), 'https?://\\S+', ' ', 'g'), '[?&][A-Za-z_]+=', ' ', 'g')".format


@query(f"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS pages FROM documents), l AS (SELECT doc_id, n, {CLEANED('pages[n]')} AS page FROM d, unnest(range(1, len(pages) + 1)) AS u(n)), g AS (SELECT doc_id, n, page, lower(page) AS low FROM l),
p AS (SELECT doc_id, n, page, unnest({places(METHOD)}) AS place FROM g WHERE contains(low, '{METHOD}')), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n, place) AS k FROM p),
c AS (SELECT doc_id, string_agg('p.' || n || ': ...' || {PASSAGE} || '...', ' | ' ORDER BY n, place) AS passages FROM r WHERE k <= 5 GROUP BY doc_id)
SELECT documents.doc_id, passages FROM documents LEFT JOIN c ON documents.doc_id = c.doc_id""")
def mention_passages(spark, d):
    """Up to five passages of 200 signs to each side of a mention, with the line they stand in as page."""
    return t(spark, d, "documents").select("doc_id", SP.contexts(F.split("text", "\n"), METHOD, F.lit(True)).alias("passages"))


# 'an' does not overlap itself, so 'anan' begins at each 'an' with nothing before the next
@query("""WITH d AS (SELECT doc_id, string_split(lower(text), 'an') AS s FROM documents), w AS (SELECT doc_id, s, i, sum(length(s[i]) + 2) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS place FROM d, unnest(range(1, len(s))) AS u(i)),
a AS (SELECT doc_id, count(*)::INT AS n, min(place)::INT AS first_at, max(place)::INT AS last_at FROM w WHERE s[i + 1] = '' AND i + 1 < len(s) GROUP BY doc_id) SELECT d.doc_id, coalesce(n, 0) AS n, first_at, last_at FROM d LEFT JOIN a ON d.doc_id = a.doc_id""")
def overlapping_places(spark, d):
    """Where a pattern that can overlap itself begins."""
    p = SP.positions(F.col("text"), "anan")
    return t(spark, d, "documents").select("doc_id", p.alias("p")).select("doc_id", F.size("p").alias("n"), F.get("p", F.lit(0))["at"].alias("first_at"), F.try_element_at("p", F.lit(-1))["at"].alias("last_at"))


NAMED = {"origin": "from", "method": "tion of", "licence": "licensed under"}


@query(" UNION ALL ".join(f"SELECT doc_id, '{n}' AS term, (len(string_split(lower(text), '{p}')) - 1)::INT AS n, strpos(lower(text), '{p}')::INT AS first_at FROM documents WHERE contains(lower(text), '{p}')" for n, p in NAMED.items()))
def document_terms(spark, d):
    """Named patterns of every text, by a table function that SQL calls for each row."""
    SP.register_record_terms(spark, NAMED)
    return spark.sql("SELECT doc_id, term, n, first_at FROM {docs}, LATERAL record_terms(text)", docs=t(spark, d, "documents"))


SQUISH = "trim(regexp_replace({}, '\\s+', ' ', 'g'))".format
DECODED = "replace(replace(replace(replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&')".format
LINKS = "regexp_extract_all(html, '<a href=\"([^\"]*)\">[^<]*</a>', 1)"
LABELS = "regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1)"
READ = SQUISH(DECODED("regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<nav>.*?</nav>|<footer>.*?</footer>', ' ', 'g'), '(?s)<!--.*?-->', '', 'g'), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g')"))


@query(f"""SELECT page_id, {SQUISH(DECODED("regexp_extract(html, '<title>(.*?)</title>', 1)"))} AS title, md5({READ}) AS text_md5, len({LINKS})::INT AS n_links, md5(array_to_string(list_transform(list_zip({LINKS}, {LABELS}), lambda x: {DECODED('x[1]')} || ' ' || {SQUISH(DECODED('x[2]'))}), chr(10))) AS links_md5 FROM pages""")
def parsed_pages(spark, d):
    """Title, text and links of every page, by a parser."""
    p = H.parse_pages(t(spark, d, "pages"), "html", ("page_id",))
    links = F.array_join(F.transform("links", lambda x: F.concat(x["href"], F.lit(" "), x["text"])), "\n")
    return p.select("page_id", "title", F.md5("text").alias("text_md5"), F.size("links").alias("n_links"), F.md5(links).alias("links_md5"))


ROWS = "'<tr><td rowspan=\"2\">' || CAST(o_orderkey AS {0}) || '</td><td>&#35;' || o_orderpriority || '&eacute;</td></tr><tr><td>' || o_orderstatus || '<table><tr><th>a<th>b<tr><td>' || CAST(o_orderkey AS {0}) || '<td>x &amp; y</table></td></tr>'"


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k FROM orders)
SELECT o_custkey, 0 AS table_no, 0 AS row_no, 'order|what' AS cells FROM o WHERE k = 0 UNION ALL SELECT o_custkey, 0, (2 * k + 1)::INT, o_orderkey || '|#' || o_orderpriority || 'é' FROM o UNION ALL SELECT o_custkey, 0, (2 * k + 2)::INT, o_orderkey || '|' || o_orderstatus FROM o
UNION ALL SELECT o_custkey, (k + 1)::INT, 0, 'a|b' FROM o UNION ALL SELECT o_custkey, (k + 1)::INT, 1, o_orderkey || '|x & y' FROM o""")
def order_tables(spark, d):
    """Each customer's orders as a page with spans, entities and nested tables, and the tables read back from it."""
    rows = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", F.expr(ROWS.format("STRING")).alias("row")))), lambda x: x["row"]), "")
    pages = t(spark, d, "orders").groupBy("o_custkey").agg(F.concat(F.lit("<html><body><p>Orders</p><TABLE border=1><tr><th>order</th><th>what</th></tr>"), rows, F.lit("</TABLE></body>")).alias("html"))
    return H.html_tables(pages, "html", ("o_custkey",)).select("o_custkey", "table_no", "row_no", F.array_join("cells", "|").alias("cells"))


#: Examples: every vector with some signs turned, so that likeness falls from 1; places are labels, the last of which has no example.
TURNED = "SELECT vec_id + 1000000 AS ref_id, nullif(label, 9) AS place, list_transform(embedding, lambda x, i: CASE WHEN i <= vec_id % 24 THEN -x ELSE x END) AS v FROM embeddings"


@query(f"""WITH e AS ({TURNED}), p AS (SELECT q.vec_id, ref_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v::DOUBLE[]), 9) AS sim FROM embeddings q JOIN e ON q.label = e.place WHERE label <> 3),
n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, ref_id) AS k FROM p), b AS (SELECT q.vec_id AS query_id, label, ref_id AS near_id, sim, (CASE vec_id % 3 WHEN 0 THEN NULL ELSE vec_id % 3 END) AS said FROM embeddings q LEFT JOIN n USING (vec_id) WHERE k = 1 OR k IS NULL)
SELECT query_id, CASE WHEN label = 3 THEN 'multi-country - review per country' WHEN label = 9 THEN 'new_country' WHEN sim >= 0.62 AND said = 1 THEN 'already_in_register' ELSE 'new_example_existing_country' END AS match_type, near_id, round(sim, 6) AS similarity,
CASE WHEN label NOT IN (3, 9) AND sim >= 0.62 AND said = 1 THEN near_id END AS match_id, CASE WHEN label = 3 THEN NULL WHEN label = 9 THEN 'high' WHEN sim >= 0.62 AND said IS NOT NULL THEN 'medium' ELSE 'low' END AS confidence,
CASE WHEN label IN (3, 9) THEN NULL WHEN sim >= 0.62 AND said IS NOT NULL THEN 'read by a person' WHEN sim < 0.62 THEN printf('nearest example sim %.2f below band', sim) ELSE 'not judged' END AS reason FROM b""")
def nearest_examples(spark, d):
    """Every vector against the examples of its place, with landed verdicts on the nearest."""
    q = t(spark, d, "embeddings").select("vec_id", "embedding", F.col("label").alias("place"))
    turned = F.transform("embedding", lambda x, i: F.when(i < F.col("vec_id") % 24, -x).otherwise(x))
    refs = q.select((F.col("vec_id") + 1000000).alias("ref_id"), F.nullif("place", F.lit(9)).alias("place"), turned.alias("embedding"))
    several = F.col("place") == 3
    near = V.nearest_in_block(q.where(~several), refs, "embedding", "vec_id", "ref_id", "place")
    verdicts = near.select("query_id", F.col("near_id").alias("ref_id"), F.when(F.col("query_id") % 3 == 1, True).when(F.col("query_id") % 3 == 2, False).alias("same"), F.lit("medium").alias("confidence"), F.lit("read by a person").alias("reason"))
    return V.example_match(q, refs, near, verdicts, "vec_id", "place", several).withColumn("similarity", F.round("similarity", 6))


REST = '"organization": "Office", "lead_type": "Country-led", "is_humanitarian_data": "TRUE", "instrument_or_title": "Survey {}", "recommendation_referenced": null, "evidence_quote": "' + "q" * 310 + '"'
ANSWERS = (
    '{"relevance_score": 140, "counted": true, "implementation_status": "Planned", "population": ["refugees", "IDPs"], "year": "in 2021", "confidence": "HIGH", ' + REST + "}",
    'Sure: {"relevance_score": "7.5", "counted": "yes", "implementation_status": "soon", "population": "stateless", "year": 1999, "confidence": "certain", ' + REST + "} Done.",
    '{"relevance_score": -3, "counted": false, "population": [], "confidence": null, ' + REST + "}",
    "no object", '{"relevance_score": 1', '{"relevance_score": "none", "counted": "True", "implementation_status": null, "population": "", "year": "2030-2031", "confidence": "medium", ' + REST + "}",
)
ANSWER = pick("o_orderkey", ANSWERS)
OBJECT = "CASE WHEN regexp_matches(a, '(?s)\\{.*\\}') THEN regexp_extract(a, '(?s)\\{.*\\}') ELSE a END"
FIELD = "coalesce(j ->> '$.{}', '')".format


def worded(k: str) -> str:
    allowed = C.EXTRACT_WORDS[k]
    return f"CASE WHEN lower({FIELD(k)}) IN {allowed} THEN lower({FIELD(k)}) ELSE '{allowed[0]}' END"


@query(f"""WITH p AS (SELECT o_orderkey, {ANSWER} AS a FROM orders), o AS (SELECT o_orderkey, {OBJECT} AS o FROM p), j AS (SELECT o_orderkey, CASE WHEN json_valid(o) THEN o::JSON END AS j FROM o),
k AS (SELECT o_orderkey, j FROM j WHERE len(list_intersect(json_keys(j), {list(C.EXTRACT_KEYS)})) = {len(C.EXTRACT_KEYS)})
SELECT o.o_orderkey, least(100, greatest(0, coalesce(try_cast({FIELD('relevance_score')} AS DOUBLE), 0)))::DOUBLE * CASE WHEN j IS NULL THEN NULL ELSE 1 END AS score, CASE WHEN j IS NOT NULL THEN concat_ws('/', {worded('implementation_status')}, {worded('lead_type')}, {worded('confidence')},
lower({FIELD('counted')}) = 'true', lower({FIELD('is_humanitarian_data')}) = 'true', CASE WHEN json_type(j, '$.population') = 'ARRAY' THEN array_to_string(CAST(j -> '$.population' AS VARCHAR[]), '; ') ELSE {FIELD('population')} END,
regexp_extract({FIELD('year')}, '20\\d{{2}}'), {FIELD('instrument_or_title')}, {FIELD('recommendation_referenced')}, length({FIELD('evidence_quote')}[1:300])) END AS told FROM o LEFT JOIN k ON o.o_orderkey = k.o_orderkey""")
def extracted_evidence(spark, d):
    """Answers of a model, told from the keys of orders, as fields that can be trusted."""
    x = lambda c: F.col("x").getField(c)
    rows = t(spark, d, "orders").selectExpr("o_orderkey", f"{ANSWER} AS a".replace("\\", "\\\\")).select("o_orderkey", C.validated_extract(F.col("a")).alias("x"))
    told = F.concat_ws("/", *[x(c).cast("string") for c in ("implementation_status", "lead_type", "confidence", "counted", "is_humanitarian_data", "population", "year", "instrument_or_title", "recommendation_referenced")], F.length(x("evidence_quote")).cast("string"))
    return rows.select("o_orderkey", x("relevance_score").alias("score"), F.when(F.col("x").isNotNull(), told).alias("told"))


@query("SELECT o_orderstatus AS stage, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END::INT AS place FROM orders GROUP BY o_orderstatus")
def order_funnel(spark, d):
    return A.funnel(t(spark, d, "orders").withColumnRenamed("o_orderstatus", "stage"), "stage", "o_custkey", ("O", "P"))


@query("SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'")
def parts_of_both_flags(spark, d):
    lines = t(spark, d, "lineitem")
    return A.in_both(lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'"), "l_partkey")
