"""Golden cases of the final verdict, co-occurrence, links and title tiers."""

from pyspark.sql import functions as F

from tallyfield.functions import classify as C
from tallyfield.operators import verdict as V
from tallyfield.sources import io

ROW = {"id": 1, "url": "http://a", "title": "refugee census", "quote": None, "year": 2020, "rules_score": 10, "model_score": 80, "read": True, "counted": True, "got_text": True, "route": "NSO (direct)", "regional": False, "match_kind": "", "questionnaire": None, "series": 1}
KINDS = "id long, url string, title string, quote string, year int, rules_score int, model_score int, read boolean, counted boolean, got_text boolean, route string, regional boolean, match_kind string, questionnaire string, series long"


def test_tiers(spark):
    cases = [
        ({}, "reach out"), ({"url": "http://a/login"}, "junk - login/redirect page"), ({"match_kind": "same product", "year": 1990}, "already in register"), ({"year": 1990}, "historic - context only"),
        ({"match_kind": "check title"}, "review - possible register match"), ({"read": False}, "not assessed"), ({"title": "post-distribution monitoring of refugees"}, "watch / context"), ({"title": "migration"}, "watch / context"),
        ({"model_score": 55}, "review then reach out"), ({"model_score": 5, "match_kind": "new edition"}, "review then reach out"), ({"model_score": 5, "questionnaire": "3 questions found"}, "reach out"),
        ({"model_score": 45, "counted": False, "questionnaire": "no displacement question"}, "low"), ({"model_score": 45, "got_text": False}, "could not read - check by hand"), ({"model_score": 40, "counted": False}, "unsure - check questionnaire"),
        ({"model_score": 45}, "watch / context"), ({"model_score": 5}, "low"), ({"read": None, "counted": None, "got_text": None, "match_kind": None, "title": None, "url": None}, "not assessed"),
    ]
    rows = [tuple((ROW | more | {"id": k}).values()) for k, (more, _) in enumerate(cases)]
    got = {x.id: x for x in V.series_primary(V.final_verdict(spark.createDataFrame(rows, KINDS)), "series", "final_score", "id").collect()}
    assert [got[k].tier for k in range(len(cases))] == [tier for _, tier in cases]
    assert [x.id for x in got.values() if x.is_primary] == [0] and got[9].ask_type == "update example (new edition)"
    assert V.final_verdict(spark.createDataFrame([], KINDS)).count() == 0


def test_cooccurrence_counts_from_begin_to_begin(spark):
    far = lambda n: "census" + "x" * (n - 6) + "refugee"
    rows = [(1, far(250)), (2, far(251)), (3, "refugeecensus"), (4, "http://census/refugee"), (5, None), (6, "refugee " * 500 + "y" * 300 + "census")]
    got = {x.id: x.near for x in spark.createDataFrame(rows, "id int, text string").select("id", C.cooccurs_within(F.col("text"), "census", "refugee").alias("near")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: None, 6: False}
    overlap = spark.createDataFrame([("refugee census",)], "text string").select(C.cooccurs_within(F.col("text"), "refugee census", "census").alias("near")).first()
    assert overlap.near


def test_links_in_any_quotes(spark):
    html = """<a href="a">1</a><a class=x href='b?q="1"'>2</a><A HREF=c/d>3</A><a data-href="no">4</a><a href="mailto:x">5</a><a href=''>6</a>"""
    pages = spark.createDataFrame([(1, "http://h/x/y", html), (2, "http://h", None), (3, None, "")], "page_id long, url string, html string")
    got = [(x.link, x.anchor_text) for x in io.extract_links(pages, keep=("page_id",)).collect()]
    assert got == [("http://h/x/a", "1"), ('http://h/x/b?q="1"', "2"), ("http://h/x/c/d", "3")]


def test_queue_twins_and_registry(spark):
    rows = spark.createDataFrame([(1, "a", "t", 5), (2, "a", "t", 3), (3, "a", "u", 4), (4, "a", "v", 9), (5, "b", "t", 1)], "id int, g string, twin string, k int")
    assert sorted(x.id for x in V.capped_after_twins(rows, "g", "twin", ["k"], 2).collect()) == [2, 3, 5]
    assert [x.id for x in V.priority_queue(rows, [("late", "k > 4")], ["k"], 3).collect()] == [1, 4, 5]
    left, right = spark.createDataFrame([(1, "x")], "c int, d string"), spark.createDataFrame([(2, 7)], "c int, n int")
    assert sorted((x.c, x.d, x.n) for x in V.full_registry(left, right, ["c"]).collect()) == [(1, "x", None), (2, None, 7)]
    assert [x.tier for x in spark.createDataFrame([("Беженцы",), (None,)], "t string").select(C.tier_by_title(F.col("t")).alias("tier")).collect()] == ["TIER1_DEDICATED", "TIER3_REVIEW"]
