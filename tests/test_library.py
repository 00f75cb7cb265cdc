"""Golden cases and properties of the library's operators."""

import random

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import classify as C
from tallyfield.functions import text as T
from tallyfield.operators import aggregates as A
from tallyfield.operators import joins as J
from tallyfield.operators import matching as MT
from tallyfield.operators import ranking as R
from tallyfield.operators import reports as P
from tallyfield.plans.rules import all_matches, first_match, first_match_no, rank_of
from tallyfield.sources import io
from tallyfield.streaming import lifecycle as L


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("given", "want"), [("TÃ¼rkiye", "Türkiye"), ("Sao", "Sao"), ("ANO", "ANO"), ("Türkiye", "Türkiye"), (None, None), ("CÃ´te dâ€™Ivoire", "Côte d’Ivoire")])
def test_mojibake(spark, given, want):
    assert one(spark, given, T.repair_mojibake) == want


@pytest.mark.parametrize(("given", "want"), [("CensusTables", "census tables"), (None, ""), ("Réfugiés  &  Co", "refugies co")])
def test_fold(spark, given, want):
    assert one(spark, given, T.fold) == want


def test_terms_leave_addresses_out(spark):
    idp = r"\bidps?\b(?![:=0-9])"
    assert one(spark, "see idp:1254735976595 here", lambda c: C.count_terms(c, idp)) == 0
    assert one(spark, "IDPs and an idp", lambda c: C.count_terms(c, idp)) == 2
    assert one(spark, "um brasileiro", lambda c: C.count_terms(c, r"\basil[eo]\b")) == 0
    assert one(spark, "alpha " + "x" * 100 + " beta", lambda c: C.cooccurs_within(c, "alpha", "beta", 250)) is True
    assert one(spark, "alpha " + "x" * 300 + " beta", lambda c: C.cooccurs_within(c, "alpha", "beta", 250)) is False


def test_product_types_and_codes(spark):
    assert one(spark, "Census Bureau improves migration estimates", C.product_type) == "publication"
    assert one(spark, "Population and Housing Census 2022", C.product_type) == "census"
    names = {"FDS": "forced(ly)? displace(ment|d) survey"}
    assert one(spark, "Forced displacement survey for Zambia", lambda c: T.acronyms(c, names=names)) == ["FDS"]
    assert one(spark, "FDS 2025 by the UN", lambda c: T.acronyms(c, ["UN"], names)) == ["FDS"]


def test_value_gate(spark):
    df = spark.createDataFrame([("9,2", "about 9.2 percent", "9.2"), ("9.2", "about 9.2", "nine"), (None, "x", "x")], "v string, e string, q string")
    assert [x[0] for x in df.select(C.value_gate(F.col("v"), F.col("e"), F.col("q"))).collect()] == [True, False, False]


def test_anchor_gate_demotes(spark):
    df = spark.createDataFrame([("exact", "The Poverty rate", "poverty"), ("exact", "other", "poverty"), ("exact", "other", None), ("related", "other", "poverty")], "m string, q string, a string")
    assert [x[0] for x in df.select(C.anchor_gate(F.col("m"), F.col("q"), F.col("a"))).collect()] == ["exact", "related", "exact", "related"]


def test_water_sources(spark):
    assert [one(spark, x, C.water_source_class) for x in ("Unprotected well", "Protected well", "Lake", None)] == [0, 1, None, None]


def test_contacts(spark):
    df = spark.createDataFrame([("census@stat.gov.xx", "stat.gov.xx"), ("info@stat.gov.xx", "www.stat.gov.xx"), ("a.b@stat.gov.xx", "stat.gov.xx"), ("x@unhcr.org", "stat.gov.xx"), (None, None)], "e string, d string")
    assert [x[0] for x in df.select(C.classify_contact(F.col("e"), F.col("d"))).collect()] == ["department", "general", "named staff", "international organization", "unknown"]


def test_rules_take_the_first_and_treat_unknown_as_false(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "a int")
    rules = [("small", "a < 3"), ("odd", "a % 2 = 1")]
    got = df.select(first_match(rules, "none").alias("l"), first_match_no(rules).alias("n"), all_matches(rules).alias("all"), rank_of(F.col("a").cast("string"), ["5", "1"]).alias("r")).collect()
    assert [tuple(x) for x in got] == [("small", 1, ["small", "odd"], 2), ("odd", 2, ["odd"], 1), ("none", 0, [], 3)]


def test_excerpt_keeps_a_deep_block(spark):
    text = "a" * 9000 + " methodology " + "b" * 9000
    out = one(spark, text, lambda c: T.windows_with(c, "methodology", 1500, 4500))
    assert "methodology" in out and out.startswith("aaa") and "[...]" in out and len(out) < 5000
    assert one(spark, "short", lambda c: T.windows_with(c, "x")) == "short"


def test_links_are_resolved(spark):
    html = '<a href="/r">Root</a><a href="//h.x/p">P</a><a href="rel.csv"><b>Rel</b></a><a href="mailto:a@b">m</a><a href="#t">t</a><a href="https://o.x/">O</a>'
    df = spark.createDataFrame([("http://a.b/c/d?q", html)], "url string, html string")
    assert [(x.link, x.anchor_text) for x in io.extract_links(df).collect()] == [("http://a.b/r", "Root"), ("http://h.x/p", "P"), ("http://a.b/c/rel.csv", "Rel"), ("https://o.x/", "O")]


def test_sources_parse_landed_payloads(spark, tmp_path):
    sitemap = spark.createDataFrame([("<urlset><url><loc>http://a/1</loc><lastmod>2024-01-02</lastmod></url><url><loc>http://a/2</loc></url></urlset>",)], "payload string")
    assert [(x.url, x.is_index) for x in io.read_sitemap(sitemap).collect()] == [("http://a/1", False), ("http://a/2", False)]
    ddi = spark.createDataFrame([("s", '<codeBook><dataDscr><var name="v1"><labl>Age</labl><catgry><labl>x</labl></catgry></var><var name="v2"><labl>Sex</labl></var></dataDscr></codeBook>')], "study string, payload string")
    assert [(x.name, x.label) for x in io.variable_inventory(ddi).collect()] == [("v1", "Age"), ("v2", "Sex")]
    rows = spark.createDataFrame([('{"result":{"rows":[{"idno":"a","year_start":"2001","repo_title":"R"},{"idno":"b","year_start":"x","authoring_entity":"E"}]}}',)], "payload string")
    assert [(x.idno, x.year_start, x.producer) for x in io.read_catalog_rows(rows).collect()] == [("a", 2001, "R"), ("b", None, "E")]
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\nbad,z\n')
    assert [(x.a, x.b) for x in io.read_landed_csv(spark, str(tmp_path / "a.csv"), types={"a": "int"}).collect()] == [(1, "x\ny"), (None, "z")]


def test_pair_check_categories(spark):
    kind = "id int, block string, org array<string>, tokens array<string>, codes array<string>, type string, y0 int, y1 int"
    ref = spark.createDataFrame([(1, "X", ["nso"], ["living", "standards"], ["LSMS"], "survey", 2018, 2019), (2, "X", ["nso"], [], [], "census", 2020, 2020), (3, "X", ["other"], ["unique"], [], "survey", 2018, 2018)], kind)
    cand = spark.createDataFrame([
        (10, "X", ["nso"], ["living"], ["LSMS"], "survey", 2019, None), (11, "X", ["nso"], ["living"], ["LSMS"], "survey", 2025, None),
        (12, "X", ["nso"], ["words"], [], "census", 2021, None), (13, "X", ["agency"], ["living"], ["LSMS"], "survey", 2018, None),
        (14, "X", ["other"], ["unique"], [], "survey", 2018, None), (15, "Y", ["nso"], [], [], "survey", 2018, None),
    ], kind)
    got = {x.c_id: (x.category, x.e_id) for x in MT.pair_check(cand, ref).collect()}
    assert got == {10: ("same product", 1), 11: ("new edition", 1), 12: ("same product", 2), 13: ("check - likely same", 1), 14: ("check - likely same", 3), 15: ("no reference in block", None)}


def test_same_org_needs_an_organisation(spark):
    c = spark.createDataFrame([("X", "", "a", True), ("X", "", "b", False), ("X", "Org", "c", True), ("X", " org ", "d", False)], "k string, o string, e string, p boolean")
    assert [(x.to_email, x.cc) for x in J.same_org_copies(c, "k", "o", "e", "p").collect()] == [("c", "d")]


def test_sticky_assignment(spark):
    log = spark.createDataFrame([("A", "x@a"), ("B", "gone@b")], "k string, e string")
    usable = spark.createDataFrame([("A", "X@a"), ("B", "new@b"), ("C", "c@c")], "k string, e string")
    ranked = spark.createDataFrame([("A", "better@a"), ("B", "new@b"), ("C", "c@c")], "k string, e string")
    got = {x.k: (x.e, x.how, x.lost) for x in J.sticky_assignment(ranked, log, usable, "k", "e").collect()}
    assert got == {"A": ("x@a", "kept", False), "B": ("new@b", "ranked", True), "C": ("c@c", "ranked", False)}


def test_estimates_suppress_small_groups(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(r.randint(0, 1), r.random() + 0.5, "g" if k < 20 else "h") for k in range(200)], "x int, w double, g string")
    got = {x.g: x for x in A.weighted_proportion(df, "x", "w", "g").collect()}
    assert got["g"].suppressed and not got["h"].suppressed and got[None].is_total
    assert all(0 <= x.est <= 100 and x.se >= 0 for x in got.values())


def test_lonely_cluster_is_centred_on_the_mean(spark):
    df = spark.createDataFrame([(1, 1.0, "a", "1"), (0, 1.0, "a", "2"), (1, 1.0, "b", "3")], "x int, w double, h string, c string")
    x = A.stratified_cluster(df, "x", "w", "h", "c").first()
    assert (x.n, x.strata, x.clusters) == (3, 2, 3) and x.se > 0


def test_composition_cap_and_samples_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(k, "core" if k < 7 else "other") for k in range(40)], "id int, c string")
    assert A.composition_cap(df, F.col("c") == "core", 0.7, [F.col("id")]).count() == 10
    strata = [("core", F.col("c") == "core", 3), ("rest", F.col("id") > 2, 4)]
    a = {tuple(x) for x in R.stratified_sample(df, strata, "id").collect()}
    assert a == {tuple(x) for x in R.stratified_sample(df.orderBy(F.desc("id")).repartition(3), strata, "id").collect()} and len(a) == 7


def test_log_keeps_what_people_wrote(spark):
    log = spark.createDataFrame([("A", "old@a", "call first"), ("B", "b@b", "note")], "key string, to_email string, comments string")
    targets = spark.createDataFrame([("A", "new@a"), ("C", "c@c")], "key string, to_email string")
    once = P.log_merge(log, targets, "key", ["comments"])
    assert {x.key: (x.to_email, x.comments) for x in once.collect()} == {"A": ("new@a", "call first"), "B": ("b@b", "note"), "C": ("c@c", None)}
    assert sorted(map(str, P.log_merge(once, targets, "key", ["comments"]).collect())) == sorted(map(str, once.collect()))


EVENTS = [(1, "A", "sent", "2024-01-02"), (2, "A", "responded", "2024-01-05"), (3, "B", "sent", "2024-01-03"), (4, "B", "bounced", "2024-01-04"), (5, "B", "responded", "2024-01-06"), (6, "C", "odd", "2024-01-01")]


def test_lifecycle_in_parts_equals_whole(spark):
    df = spark.createDataFrame(EVENTS, "event_id long, key string, kind string, d string").select("event_id", "key", "kind", F.col("d").cast("timestamp").alias("ts"))
    whole = L.fold(df, "key")
    assert {x.key: x.status for x in whole.collect()} == {"A": "responded", "B": "bounced"}
    parts = L.merge(L.fold(df.where("event_id % 2 = 0"), "key"), L.fold(df.where("event_id % 2 = 1"), "key"), "key")
    cols = sorted(whole.columns)
    assert sorted(map(str, parts.select(cols).collect())) == sorted(map(str, whole.select(cols).collect()))


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
