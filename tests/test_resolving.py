"""Languages, populations, phrases, closest studies, programmes, worklists, drafts and the report pack: hand-written rows."""

from pyspark.sql import functions as F

from tallyfield.functions import classify as C
from tallyfield.functions import text as T
from tallyfield.operators import aggregates as A
from tallyfield.operators import resolving as V


def test_languages_by_script_words_and_letters(spark):
    texts = {
        "이것은 한국어로 작성된 문장입니다. 감사합니다 여러분": "Korean", "این متن به زبان فارسی نوشته شده است و چند کلمه": "Persian", "هذا نص مكتوب باللغة العربية عن اللاجئين": "Arabic",
        "Це речення написане українською мовою їжак": "Ukrainian", "Это предложение было написано на русском языке": "Russian", "Ова реченица е напишана на македонски": "Cyrillic (undetermined)",
        "the people and the land of the north": "English", "het huis van een man niet voor de stad": "Dutch", "la vita della gente che sono per con": "Italian",
        "liczba osób się zmienia, ludność żyje źle": "Polish", "yang pergi dan untuk orang dari kota": "Indonesian", "nüfus ve göç için bir çalışma": "Turkish",
        "informações sobre domicílios são reúne": "Portuguese", "según el número de la población": "Spanish", "lorem ipsum dolor sit amet elit": "Latin script (undetermined)", "short": None, "": None, None: None,
    }
    df = spark.createDataFrame(list(texts.items()), "t string, want string")
    got = df.select("t", "want", T.detect_language(F.col("t")).alias("got")).collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]


def test_populations_of_texts_titles_and_answers(spark):
    rows = [("Refugiados y desplazados internos",), ("casilero",), ("derecho de asilo",), ("idps!",), ("midpoint",), ("無国籍の人",), ("returnees",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(C.population_tags(F.col("t")).alias("p"), C.title_populations(F.col("t")).alias("q")).collect()
    assert [r.p for r in got] == [["refugees", "idps"], [], ["refugees"], ["idps"], [], ["stateless"], ["idps"], []]
    assert [r.q for r in got][:2] == ["refugees; idps", "none in title (tier2/3)"] and got[-1].q == "none in title (tier2/3)"
    a = spark.createDataFrame([("IDPS refugees IDPS x",), ("",), (None,)], "c string").select(C.answer_populations(F.col("c")).alias("a")).collect()
    assert [r.a for r in a] == [["idps", "refugees"], [], []]


def test_search_phrases_and_years_of_addresses(spark):
    df = spark.createDataFrame([("National household survey of refugees in camps", "Kenya", "refugees; idps"), (None, None, None)], "t string, p string, q string")
    a, b = [r.f for r in df.select(T.search_phrases(F.col("t"), F.col("p"), F.col("q")).alias("f")).collect()]
    assert (a.short, a.distinctive, a.topic, a.catalogue, a.keywords) == ("Kenya refugee survey", "refugees camps Kenya", "refugees internally displaced", "Kenya refugee displaced", ["asylum", "refugee", "displaced"])
    assert (b.short, b.distinctive, b.topic, b.catalogue, b.keywords) == ("", "", "forcibly displaced", "", ["migration", "foreign"])
    u = spark.createDataFrame([("https://x/2019/3/",), ("https://x/241219/a",), ("https://x/241219a-b",), ("https://x/241399/a",), (None,)], "u string")
    assert [r.y for r in u.select(T.lead_year(F.col("u")).alias("y")).collect()] == [2019, 2024, 2024, None, None]


def test_latest_context_takes_latest_sources_only(spark):
    rows = [("a", "x", 2001, 5.0, "Census office"), ("a", "x", 2003, 7.0, "other"), ("a", "y", 2000, None, None), ("b", "z", 2000, 1.0, "Statistics"), ("b", "x", None, 9.0, "Statistics")]
    df = spark.createDataFrame(rows, "k string, m string, y int, v double, s string")
    a, b = A.latest_context(df, "k", "m", "y", "v", "s", ["x", "y"], ["x", "y"], "statisti|census").orderBy("k").collect()
    assert (a.x, a.x_year, a.x_source, a.y, a.y_year, a.any_official, a.total) == (7.0, 2003, "other", None, 2000, False, 7.0)
    assert (b.x, b.any_official, b.total) == (None, True, 0.0)


def brute(left, right, score, keep):
    """For each left row the right row of its block that sorts first by score, if it is to be kept."""
    out = {}
    for x in left:
        found = sorted((*score(x, y), y["id"]) for y in right if y["b"] == x["b"] and keep(*score(x, y)))
        out[x["id"]] = found[0][-1] if found else None
    return out


def random_rows(seed, n):
    import random

    r = random.Random(seed)
    return [{"id": k, "b": r.choice("pq"), "t": r.choices("abcdefg", k=r.randint(0, 4)), "o": r.choices("uvwx", k=r.randint(0, 3)), "y": r.choice([None, 2000, 2001, 2005])} for k in range(n)]


SCHEMA = "id int, b string, t array<string>, o array<string>, y int"


def jac(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def test_blended_match_equals_brute_force(spark):
    left, right = random_rows(1, 80), random_rows(2, 120)
    out = V.blended_match(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "b", "id", "id", "t", "o")
    want = brute(left, right, lambda x, y: (-(0.6 * jac(x["t"], y["t"]) + 0.4 * jac(x["o"], y["o"])),), lambda s: s <= -0.2)
    assert {r.id: r.match_id for r in out.collect()} == want


def test_closest_study_equals_brute_force(spark):
    left, right = random_rows(3, 80), random_rows(4, 120)
    left.append({"id": 999, "b": "nowhere", "t": ["a"], "o": [], "y": 2000})
    out = {r.id: r for r in V.closest_study(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "b", "id", "id", "t", "y").collect()}
    gap = lambda x, y: abs(x["y"] - y["y"]) if x["y"] and y["y"] else 9
    assert {k: r.match_id for k, r in out.items()} == brute(left, right, lambda x, y: (-jac(x["t"], y["t"]), gap(x, y)), lambda s, g: True)
    assert out[999].confidence == "no match" and out[999].similarity is None
    assert V.closest_study(spark.createDataFrame(left, SCHEMA), spark.createDataFrame([], SCHEMA), "b", "id", "id", "t", "y").where("match_id is null").count() == len(left)


def test_programmes_and_places_that_begin_alike(spark):
    s = "id int, place string, codes array<string>, y int"
    left = spark.createDataFrame([(1, "Kenya", ["DHS", "DTM"], 2010), (2, "KENYA (north)", ["DTM"], None), (3, "Chad", ["DHS"], 2010), (4, "Kenya", [], 2010), (5, "", ["DHS"], 2010), (6, None, None, None)], s)
    right = spark.createDataFrame([(10, "kenya", ["DTM"], 2010), (11, "Kenya", ["DHS", "DTM", "MICS"], 2014), (12, "Ken", ["DTM"], 2009), (13, "", ["DHS"], 2010)], s)
    got = {r.id: (r.match_id, r.programmes, r.gap, r.kind, r.verdict) for r in V.programme_match(left, right, "place", "id", "id", "codes", "y").collect()}
    none = (None, None, None, None, "no programme match -> reach out / not published")
    assert got == {1: (11, "DHS,DTM", 4, "socio-economic", "programme match (different year - check)"), 2: (10, "DTM", 9, "STOCK (deprioritise)", "programme match (different year - check)"), 3: none, 4: none, 5: none, 6: none}


def test_worklist_shortlist_and_applications(spark):
    rows = [("K", "DHS", "DHS 2010", None, "c2"), ("K", "DHS", "DHS", "2012", "c1"), ("K", "DHS", "DHS b", "2012", "c0"), ("K", "FDP socio-economic", "Study", None, "c3"), ("L", "zzz", None, None, "c4")]
    work = V.dataset_worklist(spark.createDataFrame(rows, "country string, type string, survey string, year string, catalog string"))
    assert {r.catalog: (r.ease_rank, r.yr) for r in work.collect()} == {"c2": (4, 2010), "c1": (4, 2012), "c0": (4, 2012), "c3": (5, 0), "c4": (6, 0)}
    short = V.dataset_shortlist(work)
    assert {(r.country, r.type): r.catalog for r in short.collect()} == {("K", "DHS"): "c0", ("K", "FDP socio-economic"): "c3", ("L", "zzz"): "c4"}
    assert [r.application_text for r in V.applications(short, "{survey} in {country}").collect()] == ["Study in K"]


def test_final_lists(spark):
    r = spark.createDataFrame([(1, "K", "WHO", "x", "data", True), (2, "K", None, "Plan", None, True), (3, "", "o", "x", "", True), (4, "K", "o", "x", "", None), (5, "K", "Instituto Nacional", None, "y", True), (6, "K", "o", "x", "", True)], "id int, country string, organisation string, title string, description string, is_microdata boolean")
    got = {x.id: x.reason for x in V.reach_out_list(r, spark.createDataFrame([(6,)], "id int"), "id").collect()}
    assert got == {1: "office-held (WHO)", 2: "forthcoming / not yet collected", 5: "NSO-held - request from office/site"}


def test_drafts_holds_and_shared_addresses(spark):
    matched = spark.createDataFrame([("k", "o", "T", False, "low"), ("k", "o", "T", True, "low"), ("k", "p", "U", False, None), ("k", None, "V", False, None)], "b string, org string, title string, weak boolean, confidence string")
    con = spark.createDataFrame([("k", "o", 2, "b@x", False, False, 1, "member", False, False, False), ("k", "o", 1, "A@x", True, True, 1, "none", False, False, True), ("k", "o", 3, "a@x ", False, False, 5, "member", False, False, False)], "b string, org string, id int, email string, name_check boolean, honorific boolean, rank int, primary_fact string, fell_back boolean, flagged boolean, bilingual boolean")
    drafts, copies = V.draft_register(matched, con, "b", "org", "id"), V.draft_copies(con, "b", "org", "id")
    (d,) = drafts.collect()
    assert (d.org, d.n_examples, d.to_email, d.n_copies, d.flags) == ("o", 1, "A@x", 2, "[NO RELATIONSHIP FOUND] [WEAK CONTACT MATCH] [Ms/Mr UNRESOLVED] [NAME CHECK] [WEAK SCOPE MATCH] [NEEDS NATIVE CHECK]")
    assert sorted(r.email for r in copies.collect()) == ["a@x ", "b@x"]
    assert [(r.email, r.n) for r in V.shared_addresses(drafts, copies).collect()] == [("a@x", 2)]
    holds = V.hold_list(spark.createDataFrame([("k", "A / B", ""), ("k", "A / B", "z.org"), ("k", None, "y"), ("k", "R&D", "")], "b string, org string, dom string"), "b", "org", "dom")
    assert sorted((r.institution, r.n_examples, r.suggested_contact_page) for r in holds.collect()) == [("A", 2, "https://z.org"), ("B", 2, "https://z.org"), ("R&D", 1, "")]


def test_report_pack(spark):
    r = spark.createDataFrame([("K", "T", "u", "A x", None, "MULTI a", 1.0, "p@x", "t", "s", "q@x", "t", "s"), ("K", None, "v", None, True, None, None, None, None, None, "p@x", "w", "s")], "country string, title string, url string, category string, humanitarian boolean, register_flag string, relevance double, primary_contact string, primary_type string, primary_source string, secondary_contact string, secondary_type string, secondary_source string")
    a, b = V.fact_table(r, "web").orderBy("url").collect()
    assert (a.dashboard_title, a.category_letter, a.in_register, a.is_official_actionable, a.is_reviewed, a.iso3) == ("[web] T", "A", "Multi-country - review per country", True, True, None)
    assert (b.dashboard_title, b.category_letter, b.in_register, b.is_official_actionable, b.is_reviewed) == ("[web] v", "?", "unknown (not compared)", False, False)
    assert sorted((x.email, x.rank, x.contact_type) for x in V.contact_table(r, "web").collect()) == [("p@x", "primary", "t"), ("q@x", "secondary", "t")]


def test_roster_of_answers(spark):
    from tallyfield.operators import leads as L

    cols = "lead_code string, country string, organisation string, title string, answered string, source_tool string, recommendations string, description string, results string, questionnaire string, notes string"
    rows = [("2", " Kenya ", "o", "A  title", "IDPS OTHER", "Census", "iris 1", "x", "see http://a/1, http://b/2", None, "http://a/1 http://c)"), (None,) * 11]
    a, b = L.roster_normalise(spark.createDataFrame(rows, cols), "results", "questionnaire", ["notes"]).collect()
    assert (a.lead_type, a.country, a.title, a.populations, a.link_results, a.link_questionnaire, a.urls, a.n_urls) == ("institution-led", "Kenya", "A title", "idps;other", "http://a/1", None, ["http://a/1", "http://b/2", "http://c"], 3)
    assert (a.irrs, a.iris, a.has_framework, a.is_microdata, a.host_signal, a.has_link) == (False, True, True, True, True, True)
    assert (b.lead_type, b.country, b.title, b.populations, b.urls, b.has_link, b.has_framework, b.is_microdata, b.host_signal) == ("unknown", "", "", "", [], False, False, False, False)


def test_site_patterns(spark):
    hosts = {"stats.org": "*.stats.org", "www.stats.gov.xx": "www.stats.gov.xx/*", "ine.gob.mx": "*.ine.gob.mx", "bfs.admin.ch": "bfs.admin.ch/*"}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert {r.h: r.p for r in df.select("h", T.site_pattern(F.col("h")).alias("p")).collect()} == hosts
