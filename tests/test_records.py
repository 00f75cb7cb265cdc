"""Golden cases of record classifiers, lead operators and readers."""

import json

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import classify as C
from tallyfield.functions import records as D
from tallyfield.functions import text as T
from tallyfield.operators import leads as L
from tallyfield.sources import io


def row(spark, values, schema, *columns):
    return spark.createDataFrame([values], schema).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


def test_addresses_and_actions(spark):
    given = ["https://microdata.worldbank.org/x", "https://a.org/f.CSV?x=1", "https://a.org/r.pdf", "https://a.org/p", "", None]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(given)], "k int, u string")
    got = [x.tier for x in df.select("k", D.url_source(F.col("u")).alias("s")).orderBy("k").select("s.tier").collect()]
    assert got == ["AUTO_META", "AUTO", "SCRAPE", "SCRAPE", "NO_LINK", "NO_LINK"]
    df = spark.createDataFrame([(1, "200", None, "AUTO"), (2, "302", None, "SCRAPE"), (3, "429", None, "AUTO"), (4, "410", None, "AUTO"), (5, None, "dns", "AUTO"), (6, "500", None, "AUTO")], "k int, s string, e string, t string")
    df = df.withColumn("r", C.reachability(F.col("s"), F.col("e"))).withColumn("a", D.retrieval_action(F.col("r"), F.col("t")))
    assert [(x.r, x.a) for x in df.orderBy("k").collect()] == [("live", "AUTO"), ("live", "SCRAPE"), ("blocked", "SCRAPE_BROWSER"), ("gone", "RECOVER"), ("dead_host", "RECOVER"), ("unreachable", "RECOVER")]


def test_titles(spark):
    x = row(spark, ("Population Census and labour force survey", "MSNA of refugees, DTM site assessment"), "a string, b string", D.method_guess(F.col("a")), D.tags(F.col("b"), D.PROGRAMMES), D.stock_only(D.tags(F.lit("DTM and census"), D.PROGRAMMES)), D.stock_only(D.tags(F.lit("nothing"), D.PROGRAMMES)), D.tags(F.lit("school and water"), D.THEMES), D.record_state(F.col("a"), F.lit("will be conducted")), D.position_fit(F.lit("Director of Population and Migration Statistics, Chief Statistician")))
    assert x.c0 == "census" and x.c1 == ["MSNA", "DTM"] and x.c2 and not x.c3 and x.c4 == ["SDG4 education", "SDG6 WASH"] and x.c5.startswith("forthcoming") and x.c6 == 52 + 42 + 21


def test_leads(spark):
    no, yes, zero = F.lit(False), F.lit(True), F.lit(0)
    x = row(
        spark, ("x",), "x string",
        D.lead(F.lit("National Census"), F.lit(None), F.lit(None), no, zero, no, no, zero, no, no),
        D.lead(F.lit("National Census"), F.lit(None), F.lit(None), no, F.lit(3), no, no, zero, no, no),
        D.lead(F.lit("Protection monitoring"), F.lit("UNHCR"), F.lit("L1:x"), no, zero, no, no, zero, no, no),
        D.lead(F.lit("Anything"), F.lit(None), F.lit(None), no, zero, no, no, zero, yes, no),
        D.request_route(F.lit("t"), F.lit("Eurostat"), yes, F.lit(None)), D.request_route(F.lit("RMS round 2"), F.lit(None), no, F.lit("country-led")), D.request_route(F.lit("t"), F.lit(None), no, F.lit("country-led")),
        D.lead_agreement(F.lit("country-led"), F.lit("likely country-led")), D.lead_agreement(F.lit("partner-led"), F.lit("likely country-led")), D.lead_agreement(F.lit("partner-led"), F.lit("unclear")), D.lead_agreement(F.lit(None).cast("string"), F.lit("x")),
        D.final_confidence(yes, F.lit(20), F.lit(80), F.lit("high")), D.final_confidence(yes, F.lit(60), F.lit(80), F.lit("High")), D.final_confidence(no, F.lit(1), F.lit(1), F.lit("high")),
        D.source_type(F.lit("Bureau of Statistics")), D.request_reason(F.lit("t"), F.lit(None), F.lit("JIPS")),
    )
    assert tuple(x.c0) == ("unclear", "official statistics", True) and x.c1.lead_type == "likely country-led"
    assert tuple(x.c2) == ("likely partner-led", "humanitarian/operational data", False) and x.c3.lead_type == "not applicable"
    assert (x.c4, x.c5, x.c6) == ("regional body", "international agency", "NSO (direct)")
    assert (x.c7, x.c8, x.c9, x.c10) == ("agree", "DISAGREE", "one-unclear", None)
    assert (x.c11, x.c12, x.c13) == ("low - signals disagree", "high", "unverified (keyword only)")
    assert x.c14 == "NSO/official" and x.c15.startswith("JIPS")


def test_verdicts_of_questionnaires(spark):
    df = spark.createDataFrame([(1, False, None, None, None), (2, True, None, None, None), (3, True, 5, 2, False), (4, True, 0, 0, True), (5, True, 0, 0, False), (6, True, 5, 0, True)], "k int, f boolean, n int, h int, a boolean")
    got = [x.v for x in df.select("k", D.questionnaire_verdict(*map(F.col, "fnha")).alias("v")).orderBy("k").collect()]
    assert got == ["no DDI available", "DDI too large / not scanned", "displacement/statelessness questions found", "no variable list; abstract mentions displacement", "no variable list", "no displacement question"]


def test_persons_letters_and_keys(spark):
    x = row(
        spark, ("Contact: Dr Ana Maria Silva, director of census. x Ana", "https://a.org/nada/index.php/catalog/77/x"), "t string, u string",
        D.name_titles(F.col("t")), D.catalog_key(F.col("u")), D.catalog_key(F.lit("https://a.org")), D.salutation(F.lit("Chinese"), F.lit("Dr"), F.lit("Li")), D.cc_clause(F.lit("Spanish"), F.array(F.lit("A"), F.lit(""), F.lit("B"))), D.cc_clause(F.lit("Russian"), F.array().cast("array<string>")),
        D.language_for(F.lit(" fr, en")), D.language_for(F.lit("sv")), D.language_for(F.lit(None)), D.name_absent(F.lit("j.perez@x"), F.lit("Pérez")), D.name_absent(F.lit("info@x"), F.lit("Pérez")), D.name_absent(F.lit("info@x"), F.lit(None)),
        D.glossed(F.lit("abc def"), {"abc": "first", "xyz": "none", "def": "second"}), T.split_multi(F.lit("A / B; ;C")),
        D.page_of(F.array(F.lit("one 1 2"), F.lit("two 9,2 %")), F.lit("zz"), F.lit("9,2")), D.page_of(F.array(F.lit("one")), F.lit("one"), F.lit("one")), D.page_of(F.array(F.lit("a"), F.lit("the quo te")), F.lit("the quote"), F.lit("a")),
    )
    assert len(x.c0) == 1 and x.c0[0].startswith("Dr Ana Maria Silva, director") and tuple(x.c1) == ("https://a.org", "/nada", "77") and x.c2 is None
    assert x.c3 == "尊敬的DrLi：" and x.c4 == "Pongo en copia a A y B." and x.c5 == "" and (x.c6, x.c7, x.c8) == ("fr", "en", "en")
    assert (x.c9, x.c10, x.c11) == (False, True, False) and x.c12 == "first (abc); second (def)" and x.c13 == ["A", "B", "C"]
    assert (x.c14, x.c15, x.c16) == (2, None, 2)


def test_shared_paths_equal_brute_force(spark):
    leads = [(1, "a", "http://x.org/Census/refugees/2020"), (2, "a", "http://x.org/census/other"), (3, "b", "http://x.org/census/refugees"), (4, "a", None)]
    refs = [("a", "see /census/refugees/ here"), ("a", None), ("b", "census only"), ("a", "see /census/refugees/ here")]
    got = {x.id: x.url_overlap for x in L.shares_path(spark.createDataFrame(leads, "id int, c string, u string"), spark.createDataFrame(refs, "c string, r string"), "c", "id", "u", "r").collect()}
    want = {}
    for i, c, u in leads:
        segments = [s for s in (u or "").lower().split("/")[3:] if len(s) > 3]
        want[i] = any(b == c and r and sum(s in r.lower() for s in segments) >= 2 for b, r in refs)
    assert got == want and want[1] and not want[3]


def test_relevant_links(spark):
    html = '<a href="/data.csv">Census data</a><a href="/about">About</a><a href="http://other.com/data.csv">data</a><a href="/data.csv#x">again</a><a href="mailto:a@b">m</a><a href="/s">survey of refugees</a>'
    df = spark.createDataFrame([(1, "http://www.x.org/", html), (2, "http://y.org", ""), (3, None, None)], "id int, u string, h string")
    got = [(x.id, x.link, x.score) for x in L.relevant_links(df, "id", "u", "h", F.array(F.lit("Refugees"))).orderBy("rank").collect()]
    assert got == [(1, "http://www.x.org/data.csv", 3), (1, "http://www.x.org/s", 2)]


def test_pools(spark):
    df = spark.createDataFrame([(1, "T", "http://a, http://b", "x http://a"), (2, "U", None, None)], "id int, t string, l string, m string")
    assert {x.id: (x.urls, x.n_urls) for x in L.pooled_urls(df, ["l", "m"]).collect()} == {1: (["http://a", "http://b"], 2), 2: ([], 0)}
    a = spark.createDataFrame([(2, "B", "u1", "u2"), (1, "A", "u1", None)], "id int, t string, l string, m string")
    got = {x.url: (x.example, x.title) for x in L.docs_manifest([(a, ["l", "m"])], "id", "t", F.lit("x")).collect()}
    assert got == {"u1": (1, "A"), "u2": (2, "B")}
    log = spark.createDataFrame([("A", "sent", None, True, "2024-01-01", None), ("B", "responded", None, True, "2024-01-02", None)], "k string, status string, outcome string, responded boolean, date_responded string, follow_up_date string").withColumns({"date_responded": F.to_date("date_responded"), "follow_up_date": F.to_date("follow_up_date")})
    replies = spark.createDataFrame([("A", "out_of_office")], "k string, outcome string")
    got = {x.k: (x.status, x.responded, x.date_responded, str(x.follow_up_date)) for x in L.reply_effect(log, replies, "k", F.to_date(F.lit("2024-02-01"))).collect()}
    assert got["A"] == ("sent", False, None, "2024-02-08") and got["B"][1] is True


def test_readers(spark):
    stat = json.dumps({"dimension": {"geo": {"category": {"label": {"DE": "Germany", "EU27_2020": "EU", "EA": "Area", "FR": "France"}}}, "time": {"category": {"label": {"2019": "2019", "2021": "2021"}}}}})
    df = spark.createDataFrame([(stat,), ("broken",), (None,)], "payload string")
    assert sorted(tuple(x) for x in io.read_jsonstat_dims(df).collect()) == [("DE", "Germany", "2021"), ("FR", "France", "2021")]
    rep = json.dumps({"data": [{"fields": {"title": "T", "url": "u", "date": {"created": "2024-02-03T00:00:00"}, "source": [{"name": "A"}, {"name": "B"}]}}]})
    x = io.read_nested_reports(spark.createDataFrame([(rep,)], "payload string")).first()
    assert (x.title, str(x.created), x.sources, x.countries) == ("T", "2024-02-03", "A; B", "")


@pytest.mark.parametrize("same", [True, False])
def test_matching_equals_brute_force(spark, same):
    import random

    from tallyfield.operators import joins as J
    from tallyfield.operators import matching as MT

    r = random.Random(5)
    rows = [(k, r.choice("ab"), r.sample(["x", "y", "z", "w", "v"], r.randint(0, 3)), r.sample([1, 2, 3], r.randint(0, 1)), r.sample(["P", "Q"], r.randint(0, 1)), r.choice(["survey", "unknown", "census"]), r.choice([None, 2000, 2005])) for k in range(60)]
    schema = "id int, block string, tokens array<string>, org array<int>, codes array<string>, type string, y0 int"
    df = spark.createDataFrame(rows, schema).withColumn("y1", F.col("y0"))
    left, right = (rows, rows) if same else (rows[:30], rows[30:])
    a, b = (df, df) if same else (df.where("id < 30"), df.where("id >= 30"))
    want = {}
    for p in left:
        best = None
        for q in right:
            n, u = len(set(p[2]) & set(q[2])), len(set(p[2]) | set(q[2]))
            if p[1] == q[1] and p[0] != q[0] and n and n / u >= 0.2 and (best is None or (-n / u, q[0]) < best):
                best = (-n / u, q[0])
        want[p[0]] = best[1] if best else None
    assert {x.id: x.match_id for x in J.best_token_match(a, b, "block", "id", "id", "tokens", same=same).collect()} == want
    got = {x.c_id: (x.e_id, x.top_ids) for x in MT.pair_check(a, b, same=same).collect()}

    def score(p, q):
        ov, u = len(set(p[2]) & set(q[2])), len(set(p[2]) | set(q[2]))
        jac, acr, org = (ov / u if u else 0), len(set(p[4]) & set(q[4])), bool(set(p[3]) & set(q[3]))
        ok = p[5] == "unknown" or q[5] == "unknown" or p[5] == q[5]
        strong = acr > 0 or ov >= 3 or (jac >= 0.5 and ov >= 2)
        name = strong or (ov >= 2 and p[5] == q[5] != "unknown")
        unknown = p[6] is None or q[6] is None
        inside, later = not unknown and abs(p[6] - q[6]) <= 1, not unknown and p[6] > q[6] + 1
        rank = 1 if org and name and ok and (inside or unknown) else 1 if org and p[5] == q[5] == "census" and inside else 2 if org and name and ok and later else 4 if (not org and name and ok) or (org and not strong and ov == 1 and jac >= 0.5 and ok) else 6 if org else 7
        return (round(rank * 10 - jac * 5 - acr * 3, 9), q[0])

    for p in left:
        order = sorted(score(p, q) for q in right if q[1] == p[1] and q[0] != p[0])[:3]
        assert got[p[0]] == (order[0][1], ",".join(str(i) for _, i in order))
