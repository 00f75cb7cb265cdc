"""Phrases in texts and answers that can be trusted, by hand and by brute force."""

import json
import random

from pyspark.sql import functions as F

from tallyfield.functions import classify as C
from tallyfield.operators import aggregates as A
from tallyfield.operators import phrases as PH


def test_phrases_are_found_as_contains_finds_them(spark):
    r = random.Random(8)
    texts = [(k, "".join(r.choices("ab é\n", k=r.randint(0, 60)))) for k in range(200)] + [(900, None), (901, ""), (7, "ab é ab"), (902, "ab " * 30_000)]
    phrases = [(k, "".join(r.choices("ab é", k=r.randint(1, 6)))) for k in range(80)] + [(300, ""), (301, None), (5, "ab é"), (302, "ab é"), (303, "b")]
    t, p = spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame(phrases, "pid long, phrase string")
    want = sorted((i, j) for i, x in texts for j, y in phrases if x and y and y in x)
    for most in (1 << 21, 10):
        assert sorted((x.id, x.pid) for x in PH.phrases_in_texts(t, p, "id", "text", "pid", "phrase", most).collect()) == want
    assert PH.phrases_in_texts(t, p.limit(0), "id", "text", "pid", "phrase").count() == PH.phrases_in_texts(t.limit(0), p, "id", "text", "pid", "phrase").count() == 0


def test_answers_are_validated(spark):
    whole = dict(relevance_score=88, counted=True, implementation_status="planned", population=["a", "b"], organization="O", lead_type="country-led", is_humanitarian_data=False, instrument_or_title="T", year="2020", recommendation_referenced="", evidence_quote="q", confidence="high")
    rows = {
        "whole": json.dumps(whole), "prose": "Here: " + json.dumps(whole | {"relevance_score": "1e3", "confidence": "sure"}) + " bye", "less": json.dumps({k: v for k, v in whole.items() if k != "year"}), "broken": json.dumps(whole)[:-3], "list": json.dumps([1]),
        "odd": json.dumps(whole | {"relevance_score": "NaN", "counted": "TRUE", "population": None, "year": 1999, "evidence_quote": "x" * 400, "implementation_status": ["planned"], "lead_type": None}), "null": None, "extra": json.dumps(whole | {"more": {"a": 1}}),
    }
    got = {x.k: x.v for x in spark.createDataFrame(list(rows.items()), "k string, a string").select("k", C.validated_extract(F.col("a")).alias("v")).collect()}
    assert {k for k, v in got.items() if v is None} == {"less", "broken", "list", "null"}
    assert tuple(got["whole"]) == (88.0, True, "planned", "a; b", "O", "country-led", False, "T", "2020", "", "q", "high") == tuple(got["extra"])
    assert (got["prose"].relevance_score, got["prose"].confidence) == (100.0, "low")
    odd = got["odd"]
    assert (odd.relevance_score, odd.counted, odd.population, odd.year, len(odd.evidence_quote), odd.implementation_status, odd.lead_type) == (0.0, True, "", "", 300, "unclear", "unclear")


def test_funnel_and_keys_in_both(spark):
    df = spark.createDataFrame([("new", 1), ("new", 1), ("sent", 1), ("new", 2), (None, 3)], "stage string, e int")
    assert {x.stage: (x.n_rows, x.n_entities, x.place) for x in A.funnel(df, "stage", "e", ("sent", "new")).collect()} == {"new": (3, 2, 2), "sent": (1, 1, 1), None: (1, 1, 3)}
    assert sorted((x.stage or "") for x in A.in_both(df.select("stage"), spark.createDataFrame([("new",), (None,), ("x",)], "stage string"), "stage").collect()) == ["", "new"]


def test_quotes_and_addresses_of_whole_tables(spark, tmp_path):
    from tallyfield import queries

    r = random.Random(3)
    word = lambda: "".join(r.choices("bcdfgaeiou", k=5))
    items = [(n, " ".join(word() for _ in range(n))) for n in range(1, 10)] + [(20, word()[:-1]), (21, None)]
    texts = [(n, f"{word()} {x} {word()}") for n, x in items if x] + [(100 + n, " ".join(x.split()[::-1])) for n, x in items if x] + [(201, ""), (202, None), (203, " ".join(f"a{k}@b.org" for k in range(1500)))]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.quotes_in_documents(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id, x.item_id) for x in got) == sorted((i, n) for i, x in texts for n, y in items if x and y and y in x)
    assert {x.doc_id: x.n_emails for x in queries.emails_and_years(spark, str(tmp_path)).collect()}[203] == 1500
