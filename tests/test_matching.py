"""Matching against a register: keys of offices, prefix filters and categories, by hand and by brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import signals as S
from tallyfield.operators import matching as MT
from tallyfield.operators import ranking as R
from tallyfield.operators import vectors as V


def test_same_office_is_a_key_in_common(spark):
    names = ["UNHCR", "World Bank and UNHCR", "Instituto Nacional de Estadistica", "National Bureau of Statistics", "Ministry of Interior", "Ministry of Interior Affairs", "Interior", "Police", "", None, "Ministry of Health"]
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, name string").withColumn("o", S.org_class(F.col("name")))
    a = rows.select(F.col("k").alias("a"), F.col("o").alias("ao"), MT.office_keys(F.col("o"), True).alias("x"))
    b = rows.select(F.col("k").alias("b"), F.col("o").alias("bo"), MT.office_keys(F.col("o"), False).alias("y"))
    for r in a.crossJoin(b).withColumn("hit", F.arrays_overlap("x", "y")).collect():
        shared = set(r.ao.words) & set(r.bo.words)
        want = bool(set(r.ao.agencies) & set(r.bo.agencies)) or (r.ao.is_office and r.bo.is_office) or len(shared) >= 2 or (len(shared) == 1 and min(len(r.ao.words), len(r.bo.words)) == 1)
        assert bool(r.hit) == want, (names[r.a], names[r.b])


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.8, 1.0])
def test_similar_sets_brute_force(spark, threshold):
    r = random.Random(int(threshold * 10))
    words = [f"w{k}" for k in range(14)]
    sets = [(r.choice("ab"), r.choices(words, [1 / (k + 1) for k in range(14)], k=r.randint(0, 9))) for _ in range(120)]
    df = spark.createDataFrame([(k, b, s) for k, (b, s) in enumerate(sets)], "id int, block string, tokens array<string>")
    ordered = MT.by_rarity([df])[0].join(df.select("id", "block"), "id").select("block", "words").distinct()
    got = {(x.block, frozenset(x.l_words), frozenset(x.r_words)): x.score for x in MT.similar_sets(ordered, ordered, "block", threshold).collect()}
    distinct = {(b, frozenset(s)) for b, s in sets if s}
    want = {(b, s, u): len(s & u) / len(s | u) for b, s in distinct for c, u in distinct if b == c and len(s & u) >= threshold * len(s | u) - 1e-9}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_frequent_words_bring_no_pairs_together(spark):
    """Titles that share one frequent word: the prefix filter makes no pair of them, and each candidate has a bounded number of weak ones."""
    n = 400
    df = spark.createDataFrame([(k, "X", [f"o{k}"], ["survey", f"only{k}"], [], "unknown", 2000, 2000) for k in range(n)], "id int, block string, org array<string>, tokens array<string>, codes array<string>, type string, y0 int, y1 int")
    made = df.withColumns({"family": F.lit(False), "non_en": F.lit(False)}).drop("tokens").join(MT.by_rarity([df])[0], "id")
    left, right = MT._keys(made, "block", True, 4), MT._keys(made, "block", False, 4)
    pairs = left.join(right.withColumnRenamed("id", "e"), ["__b", "key"]).count()
    assert pairs < 40 * n


LANDED = "id int, place string, org string, title string, year int, last_year int, url string, language string, summary string"


def test_register_categories(spark):
    ref = spark.createDataFrame([
        (1, "Kenya", "National Bureau of Statistics", "Labour force survey integration", 2018, 2019, None, None, None),
        (2, "Kenya", "UNHCR", "Household survey in Pemba", 2020, None, None, None, None),
        (3, "Chad", "National Bureau of Statistics", "Population census", 2009, 2009, None, None, None),
        (4, "Chad", "Eurostat", "Redeveloping statistics on population and migration", 2012, None, None, None, None),
        (5, "Chad", "Eurostat", "Quality notes", 2012, None, None, None, None),
    ], LANDED)
    cand = spark.createDataFrame([
        (10, "Kenya", "Kenya National Bureau of Statistics", "Labour force survey integration", 2019, None, None, None, None),
        (11, "Kenya", "Kenya National Bureau of Statistics", "Labour force survey integration", 2024, None, None, None, None),
        (12, "Kenya", "National Bureau of Statistics", "Labour force survey integration", 2019, None, "https://x.org/2024/12/a", None, None),  # published later
        (13, "Kenya", "National Bureau of Statistics", "Report on refugees: labour force survey integration", 2019, None, None, None, None),
        (14, "Kenya", "Police", "Labour force survey integration", 2019, None, None, None, None),
        (15, "Kenya", "World Bank", "Durable solutions survey", 2020, None, None, None, None),  # the family of agencies
        (16, "Kenya", "National Bureau of Statistics", "Verblijfsvergunningen voor bepaalde tijd", 2019, None, None, None, None),
        (17, "Kenya", "National Bureau of Statistics", "Price index of goods", 2019, None, None, None, None),
        (18, "Kenya", "Police", "Price index of goods", 2019, None, None, None, None),
        (19, "Kenya", "RPHC", "Labour force survey integration", 2019, None, "https://www.knbs.or.ke/a", None, None),  # the office's own site
        (20, "Chad", "National Bureau of Statistics", "Census tables", 2010, None, None, None, None),  # one census a round
        (21, "Kenya, Chad", "UNHCR", "Household survey", 2020, None, None, None, None),
        (22, "Peru", "UNHCR", "Household survey", 2020, None, None, None, None),
        (23, "Peru", "Eurostat", "Asylum applicants by age", 2022, None, None, None, None),
    ], LANDED)
    sites = spark.createDataFrame([("Kenya", "knbs.or.ke")], "place string, domain string")
    got = {x.c_id: (x.category, x.e_id) for x in MT.register_match(cand, ref, sites).collect()}
    assert got == {
        10: ("same product", 1), 11: ("new edition", 1), 12: ("new edition", 1), 13: ("new output of example", 1), 14: ("check - likely same", 1), 15: ("check - likely same", 2),
        16: ("check - other language", 1), 17: ("same org, other product", 1), 18: ("other producer", 1), 19: ("same product", 1), 20: ("same product", 3),
        21: ("multi-country", None), 22: ("new country", None), 23: ("same product", 4),
    }
    bare = {x.c_id: x.category for x in MT.register_match(cand.where("id = 23"), ref.where("id < 4")).collect()}
    assert bare == {23: "regional (Eurostat)"}


def test_title_tests(spark):
    rows = [("Thematic report", None, None), ("IDPs and asylum", "French", None), ("Van de stad", "English", "https://a/2023/07/x"), ("of van", "", "https://a/230915b/x"), (None, None, "https://a/2023/x")]
    x = spark.createDataFrame(rows, "t string, l string, u string").select(MT.is_output_title(F.col("t")).alias("o"), MT.is_displacement_focused(F.col("t")).alias("d"), MT.not_english(F.col("l"), F.col("t")).alias("n"), MT.published_year(F.col("u")).alias("y")).collect()
    assert [(r.o, r.d, r.n, r.y) for r in x] == [(True, False, False, None), (False, True, True, None), (False, False, True, 2023), (False, False, False, 2023), (False, False, False, None)]


def test_sample_tops_up_and_lets_later_strata_choose(spark):
    df = spark.createDataFrame([(k, k % 10) for k in range(500)], "id int, c int")
    strata = [("zero", F.col("c") == 0, 5), ("low", F.col("c") < 2, 60), ("none", F.col("c") > 10, 7)]
    seen = df.where("id < 100").select("id")
    got = R.stratified_sample(df, strata, "id", 3, seen, 90, [("nine", F.col("c") == 9), ("rest", F.col("c") > 4)]).collect()
    count = lambda s: sum(x.stratum == s for x in got)
    assert (count("zero"), count("low"), count("none"), count("nine"), len(got)) == (5, 60, 0, 25, 90)
    assert sum(x.c == 0 and x.stratum == "low" for x in got) > 0 and all(x.id >= 100 for x in got) and sorted(x.position for x in got) == list(range(1, 91))
    assert [x.id for x in sorted(got, key=lambda x: x.position)] != sorted(x.id for x in got)
    again = R.stratified_sample(df.repartition(7), strata, "id", 3, seen, 90, [("nine", F.col("c") == 9), ("rest", F.col("c") > 4)]).collect()
    assert sorted(got) == sorted(again)
    assert R.stratified_sample(df.limit(0), strata, "id").count() == 0


def vectors(spark, seed, n, d, blocks="abc", start=0):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(12)]
    rows = []
    for k in range(n):
        c = r.choice(centres)
        rows.append((start + k, r.choice(blocks), [x + r.gauss(0, 0.6) for x in c]))
    return rows


def brute(queries, refs):
    import numpy as np

    out = {}
    for i, b, q in queries:
        best = None
        for j, c, v in refs:
            if b == c:
                s = round(float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)), 9)
                if best is None or (-s, j) < best:
                    best = (-s, j)
        if best:
            out[i] = (best[1], -best[0])
    return out


def test_nearest_in_block_is_exact_and_probes_have_recall(spark):
    refs, queries = vectors(spark, 1, 700, 16), vectors(spark, 1, 150, 16, "abcd", 5000)
    refs += [(9000, "a", queries[0][2]), (8999, "a", [2 * x for x in queries[0][2]])]  # equal directions: the smaller id
    queries[0] = (queries[0][0], "a", queries[0][2])
    odd = [(6000, "a", None), (6001, "a", [0.0] * 16), (6002, None, queries[1][2]), (6003, "a", [float("nan")] * 16)]
    big = (6004, "a", [1e200 * x for x in queries[0][2]])
    schema = "id long, block string, v array<double>"
    q, r = spark.createDataFrame(queries + odd + [big], schema), spark.createDataFrame(refs, schema)
    want = brute(queries, refs)
    for tile in (4096, 16):
        got = {x.query_id: (x.near_id, round(x.similarity, 9)) for x in V.nearest_in_block(q, r, "v", "id", "id", "block", cells=8, tile=tile).collect()}
        assert got.pop(6004)[0] == 8999
        assert got == {k: (j, pytest.approx(s, abs=2e-9)) for k, (j, s) in want.items()}
    some = {x.query_id: x.near_id for x in V.nearest_in_block(q, r, "v", "id", "id", "block", probes=2, cells=8).collect()}
    recall = sum(some.get(k) == j for k, (j, _) in want.items()) / len(want)
    assert recall >= 0.9
    assert V.nearest_in_block(q, r.limit(0), "v", "id", "id", "block").count() == 0


def test_example_match_kinds(spark):
    q = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "z", [1.0, 0.0]), (4, "many", [1.0, 0.0]), (5, "a", None), (6, "a", [1.0, 0.1]), (7, "a", [1.0, 0.2])], "id long, block string, v array<double>")
    r = spark.createDataFrame([(10, "a", [1.0, 0.0]), (11, "many", [1.0, 0.0])], "id long, block string, v array<double>")
    said = spark.createDataFrame([(1, 10, True, "high", "same office"), (6, 10, False, "low", "another year"), (2, 10, True, "high", "below the band")], "query_id long, ref_id long, same boolean, confidence string, reason string")
    near = V.nearest_in_block(q, r, "v", "id", "id", "block")
    got = {x.query_id: (x.match_type, x.match_id, x.confidence, x.reason) for x in V.example_match(q, r, near, said, "id", "block", F.col("block") == "many").collect()}
    new = "new_example_existing_country"
    assert got == {
        1: ("already_in_register", 10, "high", "same office"), 2: (new, None, "low", "nearest example sim 0.00 below band"), 3: ("new_country", None, "high", None), 4: ("multi-country - review per country", None, None, None),
        5: (new, None, "low", "no vector of the record"), 6: (new, None, "low", "another year"), 7: (new, None, "low", "not judged"),
    }
