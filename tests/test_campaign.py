"""Golden cases of places, signals, campaign and evidence operators: nulls, empty tables, ties and repeated rows."""

from pyspark.sql import functions as F

from tallyfield.functions import places as P
from tallyfield.functions import signals as S
from tallyfield.operators import campaign as K
from tallyfield.operators import evidence as E


def one(spark, values, kinds, column):
    return [x[0] for x in spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], kinds).select(column).collect()]


def test_places(spark):
    names = [" Turkey* ", "DRC", "Kenya", "Côte d'Ivoire", None, "Czech Republic"]
    assert one(spark, names, "c string", P.harmonize_country(F.col("c"))) == ["Türkiye", "Democratic Republic of the Congo", "Kenya", "Côte d'Ivoire", "", "Czechia"]
    assert one(spark, ["Netherlands", "Czech Republic", "Kenya", None], "c string", P.geo_code(F.col("c"))) == ["NL", "CZ", None, None]
    assert one(spark, ["Norway", "Spain", "Netherlands (Kingdom of the)", "Kenya"], "c string", P.registry_gate(F.col("c"))) == ["SSB", "Eurostat", "Eurostat", None]
    assert one(spark, ["A, B", "A...and 2 more", "World", "West Africa", None], "c string", P.is_multi_country(F.col("c"))) == [True, True, True, False, False]
    assert one(spark, ["the region", "west africa", "West Africa", None], "c string", P.is_multi_country(F.col("c"), wide=True)) == [True, True, False, False]
    rows = spark.createDataFrame([(1, "Yemen, Rep."), (2, "A, B, C"), (3, "Europe and Central Asia"), (4, None), (5, "Nowhere")], "id int, country string")
    codes = spark.createDataFrame([("Yemen", "YEM")], "country string, iso3 string")
    got = {x.id: (x.country, x.map_country, x.iso3, x.is_single_country) for x in P.geo_harmonize(rows, "country", codes).collect()}
    assert got == {1: ("Yemen, Rep.", "Yemen", "YEM", True), 2: ("A, B, C", None, None, False), 3: ("Europe and Central Asia", None, None, False), 4: (None, None, None, False), 5: ("Nowhere", "Nowhere", None, True)}


def test_signals(spark):
    urls = [("http://a/refugees", 3), ("http://a/migration", 3), ("http://a/migration", None), ("http://a/idp_x", 1), ("http://a/casino-refugee", 1), (None, None)]
    got = one(spark, urls, "u string, p int", S.url_match(F.col("u"), F.col("p")))
    assert [x and tuple(x) for x in got] == [("strong", "refugee"), None, ("weak (review)", "migration"), ("strong", "/idp_"), None, None]
    dates = [("x", "12 Mai 2024 and 3 mars 2023", None), ("x", "May 2024", "http://a/2023-04-05/x"), (None, None, None), ("mayo 2021", None, None)]
    assert one(spark, dates, "t string, p string, u string", S.publication_date(F.col("t"), F.col("p"), F.col("u"))) == ["3 mars 2023", "2023-04-05", None, "mayo 2021"]
    assert one(spark, ["Refugees", "", None, "Nomads", "IDPs and refugees"], "p string", S.coarse_population(F.col("p"))) == ["refugees", "total", "total", "nomads", "refugees"]
    texts = [("en", [None], "x"), ("ar", ["abc", "لاجئ هنا"], ""), ("fr", [None, "vu"], "t"), ("fr", [], " a  b "), ("fr", None, None), (None, [], "x")]
    assert one(spark, texts, "l string, p array<string>, t string", S.original_excerpt(F.col("l"), F.col("p"), F.col("t"))) == [None, "لاجئ هنا", "vu", "a b", None, None]
    orgs = one(spark, ["UNHCR + Statistics Norway", "Statistics Norway", None], "o string", S.org_class(F.col("o")))
    assert [(x.agencies, x.is_office) for x in orgs] == [(["UNHCR"], False), ([], True), ([], False)]
    flags = [(1, 2, False, 0, True), (0, 2, False, 0, False), (1, 1, False, 1, False), (1, 0, True, 0, False)]
    assert one(spark, flags, "a int, c int, t boolean, i int, n boolean", S.strong_candidate(F.col("a"), F.col("t"), F.col("c"), F.col("i") > 0, F.col("n"))) == [True, False, False, True]
    assert one(spark, [("x/pidpr", "t"), ("x/idp", "t"), (None, None)], "u string, t string", S.url_fragment_only(F.col("u"), F.col("t"))) == [True, False, False]


def test_organisations_and_bounces(spark):
    examples = spark.createDataFrame([(1, "X", "Statistics Norway", True), (2, "X", "Border police", False), (3, "X", None, True), (4, "Y", "Statistics Norway", True), (5, "X", "Zebra", True)], "example_id int, place string, org string, is_office boolean")
    orgs = spark.createDataFrame([(10, "X", "Statistics Norway"), (11, "X", "Border guard of Norway"), (12, "X", "Statistics Norway"), (13, "X", None)], "org_id int, place string, org string")
    got = {x.example_id: (x.org_id, round(x.score, 3), x.weak) for x in K.org_matches(examples, orgs, "place").collect()}
    # 2: one of five words; 3 and 4 have no words or no candidate; 5 shares no word, so the office bonus alone makes a weak match
    assert got == {1: (10, 1.3, False), 2: (None, 0.25, True), 3: (None, 0.0, True), 4: (None, 0.0, True), 5: (10, 0.3, True)}
    log = spark.createDataFrame([(1, " A@b.org"), (2, "c@d.org"), (3, None), (4, "e@f.org")], "id int, to_email string")
    notices = spark.createDataFrame([("a@b.org", "also c@d.org"), (None, "to <E@F.org> by postmaster@f.org"), ("", None)], "failed_email string, body string")
    assert {x.id: x.bounced for x in K.bounced(log, notices).collect()} == {1: True, 2: False, 3: False, 4: True}
    assert K.bounced(log, notices.limit(0)).where("bounced").count() == 0


def test_evidence_levels_and_frames(spark):
    kinds = "e int, concept string, kind string, level string"
    facts = [(1, "idp", "identification", "microdata")] * 3 + [(1, "water", "indicator", "table"), (1, "water", "indicator", "text"), (2, "host_community", "indicator", "odd"), (3, None, None, None), (4, "idp", "identification", "odd")]
    got = {x.e: x for x in K.enriched_frame(spark.createDataFrame([(k,) for k in range(1, 6)], "e int"), spark.createDataFrame(facts, kinds), "e").collect()}
    assert (got[1].id_capability, got[1].computable, got[1].n_computable, got[1].groups) == ("computable (microdata)", "water", 1, "idp")
    assert got[2].host_evidenced and got[2].evidenced == "host_community" and got[2].n_computable == 0
    assert [got[k].id_best for k in (3, 4, 5)] == ["none", "none", "none"]
    assert K.enriched_frame(spark.createDataFrame([(1,)], "e int"), spark.createDataFrame([], kinds), "e").first().id_capability == "none in downloaded data"


def test_exports_and_suggestions(spark):
    answers = spark.createDataFrame([(2, '[{"phrase":"a","population":"idps","rationale":"r2"},{"phrase":"a"}]'), (1, '[{"phrase":"a","rationale":"r1"}]'), (3, "nonsense"), (4, None), (5, "[]")], "id int, answer string")
    assert [tuple(x) for x in K.keyword_suggestions(answers, "id").collect()] == [("a", "general", "r1", 1, "")]
    emails = spark.createDataFrame([(1, "t", "a@b", "x\ny", None), (2, "t", " ", "x", None), (3, "t", "c@d", None, "e"), (4, "u", "a@b", "x", None)], "place int, tier string, to_email string, body string, cc_email string")
    log = spark.createDataFrame([(3, "sent"), (1, "draft")], "place int, status string")
    assert [(x.place, x.body_html, x.cc_email) for x in K.send_export(emails, log, "place", ["t"]).collect()] == [(1, "x<br>y", "")]
    points = spark.createDataFrame([("1, 5", "so 1.5 %"), ("", "x"), (None, None), ("7", "8")], "value string, evidence string")
    assert [x.kept for x in K.regated(points).collect()] == [True, False, False, False]
    cards = spark.createDataFrame([("Census", None, None, 9999), ("x", "a household survey", None, 2020), (None, None, None, None)], "title string, description string, code string, y1 int")
    assert [(x.y1, x.kind) for x in K.example_cards(cards, 2026).collect()] == [(2026, "census"), (2020, "survey"), (None, "unknown")]
    rows = spark.createDataFrame([(None, "b"), ("a", "c")], "x string, y string")
    assert [tuple(x) for x in K.candidate_frame(rows, {"f": ["gone", "x", "y"], "g": ["gone"]}).collect()] == [("b", None), ("a", None)]


SCORED = {"id": 1, "core": 10, "core_strong": 3, "framework": 1, "migration": 0, "has_inclusion": True, "near": False, "birth_near": False, "office_led": True, "in_title": True, "trust": None, "doc_type": None, "pub_year": 2026, "spam": False, "false_positive": False, "override": False, "ambiguous_only": False, "got_text": True, "inventory_only": False, "official": False, "strong": True, "has_office_contact": True, "lead": None}
SCORED_KINDS = "id int, core int, core_strong int, framework int, migration int, has_inclusion boolean, near boolean, birth_near boolean, office_led boolean, in_title boolean, trust string, doc_type string, pub_year int, spam boolean, false_positive boolean, override boolean, ambiguous_only boolean, got_text boolean, inventory_only boolean, official boolean, strong boolean, has_office_contact boolean, lead string"


def test_score_and_category(spark):
    bare = {"core_strong": 0, "framework": 0}
    cases = [
        ({}, 92, "A"), ({"core": 500}, 100, "A"), ({"core": 500, "override": True}, 582, "A"), ({"spam": True}, 0, "E"), ({"ambiguous_only": True}, 25, "C"), (bare, 20, "E"), (bare | {"migration": 1}, 30, "A"), (bare | {"override": True}, 82, "A"),
        (bare | {"official": True, "has_inclusion": False, "in_title": False}, 20, "C"), ({"inventory_only": True, "got_text": False}, 45, "A"), ({"has_office_contact": None}, 92, "D"), ({"office_led": None, "lead": "unclear"}, 72, "B"), ({"strong": None}, 92, "D"),
        ({"strong": False, "core_strong": 0}, 92, "C"),
    ]
    rows = [tuple((SCORED | more | {"id": k}).values()) for k, (more, _, _) in enumerate(cases)]
    got = {x.id: (x.score, x.category[0]) for x in E.scored(spark.createDataFrame(rows, SCORED_KINDS)).collect()}
    assert [got[k] for k in range(len(cases))] == [(score, letter) for _, score, letter in cases]
    assert E.scored(spark.createDataFrame([], SCORED_KINDS)).count() == 0


def test_facts_letters_and_drafts(spark):
    contacts = spark.createDataFrame([(1, ["a", "m", "a"]), (2, ["m", "n"]), (3, ["zz"]), (4, None)], "c int, tokens array<string>")
    ranks = spark.createDataFrame([("a", 1, "A", False), ("m", 3, "M", True), ("n", 2, "N", False)], "token string, rank int, fact string, meeting boolean")
    assert sorted(tuple(x) for x in E.fact_precedence(contacts, ranks, "c").collect()) == [(1, 1, "A", "M"), (2, 2, "N", "M"), (3, 10, "none", None), (4, 10, "none", None)]
    examples = spark.createDataFrame([("x", k, f"T{k}", None, None, 1) for k in range(6)] + [("y", 9, None, 2020, "u", 1)], "e string, id int, title string, year int, url string, score int")
    people = spark.createDataFrame([("x", "Ann", "a@b", "fr"), ("y", None, "c@d", None), ("z", "Bo", "e@f", "en")], "e string, name string, email string, language string")
    words = spark.createDataFrame([("en", "Dear %s", "and %d more")], "language string, greeting string, more string")
    got = {x.e: x.body for x in E.letters(examples, people, words, "e", "id").collect()}
    assert got == {"x": "Dear Ann\n- T0\n- T1\n- T2\n- T3\nand 2 more", "y": "Dear colleague\n- (untitled) (2020): u"}
    matched = spark.createDataFrame([("o", "t", False, "low"), ("o", "t", True, "low"), ("p", "t", False, None), (None, "t", False, "low")], "org string, title string, weak boolean, confidence string")
    to = spark.createDataFrame([("o", "late", 2, 1), ("o", "first", 1, 2)], "org string, email string, rank int, id int")
    assert sorted(tuple(x) for x in E.organisation_drafts(matched, to, "org", "id").collect()) == [("o", 1, "first", 1, "weak organisation match; mostly low confidence"), ("p", 1, None, 0, "no contact")]


def test_catalogue_places(spark):
    entries = spark.createDataFrame([("1", "Republic of COLOMBIA"), ("2", "Ira"), ("3", None), ("4", "Iran and Chad")], "idno string, nation string")
    register = spark.createDataFrame([("Iran",), ("Colombia",), ("Chad",), (None,), ("",)], "place string")
    got = sorted((x.idno, x.place, x.in_hand) for x in E.catalogue_match(entries, register, spark.createDataFrame([("4",), ("4",)], "idno string")).collect())
    assert got == [("1", "Colombia", False), ("4", "Chad", True)]
