"""Audits: every branch of their rules, nulls and empty tables."""

from pyspark.sql import functions as F

from tallyfield.operators import audits as U


def test_letter_gate_names_each_fault(spark):
    texts = [(None, "empty"), ("  ", "empty"), ("a " * 39 + "b.", "too long"), ("These: one.", "list"), ("It has no end", "open end"), ("It is drawn from the census.", "claimed source"), ("It follows A title to copy here.", "copied title"), ("All is well.", "ok"), ('He said "yes."', "ok")]
    df = spark.createDataFrame(texts, "x string, want string").withColumn("titles", F.array(F.lit("A title to copy"), F.lit("short")))
    assert all(r.want == r.got for r in df.select("want", U.letter_gate(F.col("x"), F.col("titles")).alias("got")).collect())
    assert df.select(U.letter_gate(F.col("x"), F.lit(None).cast("array<string>")).alias("g")).where("g = 'ok'").count() == 3


def test_coverage_actions(spark):
    registry = spark.createDataFrame([(k, f"{k}.org") for k in "abcdefg"] + [("h", None)], "place string, domain string")
    inventory = spark.createDataFrame([("e.org", 4, 0), ("f.org", 4, 2), ("g.org", 9, 9)], "domain string, total_inventory long, keyword_matches long")
    evidence = spark.createDataFrame([("g",)] * 3 + [("f",)], "place string")
    liveness = spark.createDataFrame([("b.org", 200, "https://new.org"), ("c.org", 404, "https://c.org"), ("d.org", 200, "https://d.org"), ("f.org", 500, "x")], "domain string, http_status int, final_url string")
    got = {r.place: r for r in U.coverage_gaps(registry, inventory, evidence, liveness).collect()}
    assert {k: r.suggested_action for k, r in got.items()} == {"a": "find the current site", "b": "take the new address", "c": "verify the address", "d": "look by hand", "e": "no term matched", "f": "little survived scoring", "h": "find the current site"}
    assert got["f"].http_status is None and got["f"].evidence_rows == 1


def test_round_actions(spark):
    rows = [(2026, 0, None, 10_000, "ask now: planned", "high"), (2029, 0, None, 9, "ask now: planned", "normal"), (2030, 0, None, 99_999, "later: after the window", "-"), (2022, 0, None, None, "ask: recent, not in the register", "normal"), (2022, 1, 2021, 20_000, "in the register: ask for an update", "high"), (2022, 1, 2022, 20_000, "context", "-"), (None, 0, None, 20_000, "context", "-"), (2021, None, None, 1, "context", "-")]
    df = spark.createDataFrame(rows, "y int, n int, l int, p long, a string, b string")
    for r in df.select("a", "b", U.round_action(F.col("y"), 2026, F.col("n"), F.col("l"), F.col("p")).alias("x")).collect():
        assert (r.x.action, r.x.priority) == (r.a, r.b)


def test_product_decisions(spark):
    rows = [("k", 1, "t", 2020, False, "high", False), ("u", 1, "t", 2020, True, "high", True), ("c", 1, "t", 2020, False, "medium", False), ("n", 1, "t", 2026, True, None, False), ("d", 1, "t", None, False, "low", False), ("o", 1, "t", 2001, False, "low", None)]
    rows += [("o", k, f"t{k}", 2000, False, "low", True) for k in range(2, 7)]
    got = {r["product"]: r for r in U.product_rollup(spark.createDataFrame(rows, "product string, lead_id long, title string, year int, recent boolean, likelihood string, is_edition boolean")).collect()}
    assert {k: r.proposed for k, r in got.items()} == {"k": "known - do not ask", "u": "ask to update", "c": "check: may be known", "n": "ask: new", "d": "undated - check by hand", "o": "too old - do not ask"}
    assert got["o"].titles == "t || t2 || t3" and got["o"].leads == 6 and got["n"].in_register == "low"


def test_value_reviews(spark):
    rows = [("9.2", False, "exact", 1), ("8", None, "exact", 1), (" 9.2 ", True, "exact", 1), ("8", True, "related (demoted)", 2), ("8", True, "comparable", 3), (None, True, None, 3)]
    got = U.value_review(spark.createDataFrame(rows, "v string, e boolean, m string, want int"), "v", "e", "m", "9.2").collect()
    assert all(r.review_priority == r.want for r in got) and len({r.review_reason for r in got}) == 6


def test_answers_against_key(spark):
    said = spark.createDataFrame([(1, "yes"), (2, "no"), (3, "yes"), (4, None), (5, ""), (6, "can't tell"), (7, "no"), (9, "yes")], "id long, said string")
    key = spark.createDataFrame([(1, "yes"), (2, "yes"), (3, "no"), (4, "yes"), (5, "no"), (6, "no"), (7, "no"), (8, "yes")], "id long, truth string")
    m, wrong = U.answers_against_key(said, key, "id", "said", "truth", "yes")
    assert tuple(m.first()) == (4, 2, 0.5, 0.5) and {r.id for r in wrong.collect()} == {2, 3}
    assert tuple(U.answers_against_key(said.limit(0), key, "id", "said", "truth", "yes")[0].first()) == (0, 0, 0.0, 0.0)


def test_tiers_junk_access_first_and_parts(spark):
    rows = [("a", True, "D", 1.0), ("b", False, "A", 1.0), ("c", False, "D", 70.0), ("d", False, "C", 1.0), ("e", None, None, 45.0), ("f", False, "D", 44.0), ("f", False, "E", None)]
    got = U.letter_tier(spark.createDataFrame(rows, "g string, k boolean, c string, s double"), ["g"], F.col("k"), F.col("c"), F.col("s"))
    assert {r.g: r.tier for r in got.collect()} == dict.fromkeys("abc", "sure_bet") | dict.fromkeys("de", "needs_review") | {"f": "low_bet"}
    urls = spark.createDataFrame([("https://x.org/LOGIN?a", True), ("https://x.org/sso", True), ("https://x.org/ssoo", False), (None, False)], "u string, want boolean")
    assert all(r.want == r.got for r in urls.select("want", U.is_junk(F.col("u")).alias("got")).collect())
    kinds = spark.createDataFrame([("MICS",), ("DHS",), ("x",), (None,)], "k string").select(U.access(F.col("k")).alias("a")).collect()
    assert [r.a.ease for r in kinds[:3]] == [1, 4, 6] and kinds[3].a.access_status == "4 CHECK record"
    facts = spark.createDataFrame([(1, 5, "late"), (1, 2, "early"), (1, 2, "zz"), (3, 1, "other")], "k long, at long, v string")
    assert {r.k: r.v for r in U.first_joined(spark.createDataFrame([(1,), (2,)], "k long"), facts, "k", ["at", "v"], ["v"]).collect()} == {1: "early", 2: None}
    levels = spark.createDataFrame([(1, "all"), (1, "x"), (2, "all"), (3, "x"), (3, "y"), (4, None), (4, "all")], "k long, level string")
    assert [r.k for r in U.has_total_and_part(levels, ["k"], "level", "all").collect()] == [1]
