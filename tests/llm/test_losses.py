"""What must not be lost: rows without ids, vectors of any size, names of captures, columns with clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import decontaminate, lexical, mixing, neighbours, ngram_join, substring_dedup, toxicity, warc


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") + r.choice("bcdfghklmnprst") + r.choice("aeiou") * r.randint(1, 2) for _ in range(n))


def test_passages_of_rows_without_ids(spark):
    passage = prose(1, 80)
    rows = [(None, prose(2, 50) + " " + passage, 1), (2, passage + " " + prose(3, 40), 2), (None, prose(4, 30), 3), (None, prose(5, 60) + " " + passage, 4), (None, prose(5, 60) + " " + passage, 5), (7, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int").repartition(2)
    found = substring_dedup.find(docs)
    ids = [(x.doc_id, x.keep) for x in found.collect()]
    assert {i for i, _ in ids} == {2, None} and all(x.first_doc == 2 or x.doc_id is None for x in found.collect())
    left = {x.spans: x.text for x in substring_dedup.remove(docs, found).collect()}
    assert left[2] == rows[1][1] and left[3] == rows[2][1] and left[6] is None
    assert passage not in left[1] and left[1].startswith(prose(2, 50)) and passage not in left[4] and left[4] == left[5]


@pytest.mark.parametrize("block", [substring_dedup.BLOCK, 48])
def test_passages_that_very_many_share(spark, block):
    """Of 200 documents with one passage, pairs share 16 words more beyond an edit (of 120, at their begin); of 101 places of another passage, 100 are in one document."""
    passage, often, texts = prose(10, 34), prose(20, 40), []
    for k in range(200):
        texts.append((k, " ".join([prose(1000 + k, 40), passage, prose(2000 + k, 1), prose(3000 + k % 100, 16), prose(4000 + k, 40)])))
    for k in range(120):
        texts.append((400 + k, " ".join([often[::-1], prose(8000 + k, 1), prose(8200 + k % 60, 16), prose(8400 + k, 40)])))
    texts.append((300, " ".join(" ".join([prose(5000 + k, 60), often, prose(6000 + k, 60)]) for k in range(100))))
    texts.append((301, " ".join([prose(7000, 60), often, prose(7001, 60)])))
    raw, covered = {i: x.encode() for i, x in texts}, {i: set() for i, _ in texts}
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    for x in substring_dedup.find(df, block=block).collect():
        before = len(raw[x.doc_id][: x.start].split())
        covered[x.doc_id].update(range(before, before + x.words))
    assert all(set(range(40, 40 + 34 + 1 + 16)) <= covered[k] for k in range(200))
    assert all(set(range(40 + 1 + 16)) <= covered[400 + k] for k in range(120))
    assert all(set(range(160 * k + 60, 160 * k + 100)) <= covered[300] for k in range(100)) and set(range(60, 100)) <= covered[301]


@pytest.mark.parametrize("size", [1e-30, 1.0, 1e20, 1e25, 1e200])
def test_neighbours_of_vectors_of_any_size(spark, size):
    r = np.random.default_rng(4)
    x = r.normal(size=(500, 16)) * size
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    index, books = neighbours.build(df)
    got = neighbours.search(index, books, index.where("vec_id < 2").select("vec_id", "embedding")).orderBy("query_id", "rank").collect()
    assert len(got) == 20
    for q in (0, 1):
        d = neighbours.euclid(x - x[q])
        d[q] = np.inf
        want = np.argsort(d, kind="stable")[:10].tolist()
        mine = [g for g in got if g.query_id == q]
        assert [g.vec_id for g in mine] == want and [g.score for g in mine] == pytest.approx(d[want])


def test_neighbours_among_vectors_of_mixed_sizes(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 8)) * 10.0 ** r.integers(-3, 25, 300)[:, None]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    index, books = neighbours.build(df)
    got = neighbours.search(index, books, index.where("vec_id % 30 = 0").select("vec_id", "embedding")).collect()
    assert len(got) == 100
    hits = 0
    for q in range(0, 300, 30):
        d = neighbours.euclid(x - x[q])
        d[q] = np.inf
        hits += len({g.vec_id for g in got if g.query_id == q} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 90


RECORD = "record_id string, record_type string, concurrent_to string, target_uri string, date string, payload_digest string, payload_bytes long, computed_digest string, concurrent array<string>, complete boolean, info map<string,string>"


def records(spark, *rows):
    return spark.createDataFrame([(i, kind, links[0] if links else None, None, None, None, 0, None, links, True, {}) for i, kind, links in rows], RECORD)


def test_captures_keep_their_names(spark):
    known = [("z1", "response", []), ("a1", "request", ["z1"]), ("b1", "metadata", ["z1"]), ("z2", "revisit", []), ("a2", "request", ["z2"])]
    names = lambda *more: {x.capture_id: sorted(y.record_id for y in [x.request, x.response, *x.metadata, *x.others] if y) for x in warc.assemble(records(spark, *known, *more)).collect()}
    assert names() == {"z1": ["a1", "b1", "z1"], "z2": ["a2", "z2"]}
    assert names(("m", "metadata", ["gone"])) == {"z1": ["a1", "b1", "z1"], "z2": ["a2", "z2"], "m": ["m"]}
    # a response that names its request, and a record that joins two captures
    assert names(("y1", "response", ["c1"]), ("c1", "request", [])) == {"z1": ["a1", "b1", "z1"], "z2": ["a2", "z2"], "y1": ["c1", "y1"]}
    assert names(("x", "metadata", ["z1", "z2"])) == {"z1": ["a1", "a2", "b1", "x", "z1", "z2"]}
    assert names(("q", "metadata", ["a2"]), ("p", "metadata", ["gone"]), ("o", "metadata", ["gone"])) == {"z1": ["a1", "b1", "z1"], "z2": ["a2", "q", "z2"], "o": ["o", "p"]}


CLASH = ("__hits", "__id", "__th", "__h", "__source", "__size", "__copies", "row", "id", "th", "h", "n", "score", "rank", "number")


def test_columns_with_clashing_names(spark):
    texts = [prose(k, 40) for k in range(6)] + [prose(0, 40), None, "", "short item text"]
    docs = spark.createDataFrame([(k, x, "s", *[f"{c}{k}" for c in CLASH]) for k, x in enumerate(texts)], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASH))
    items = spark.createDataFrame([(1, prose(3, 40), "x")], "item_id long, text string, __hits string")
    same = lambda got: all(x[c] == f"{c}{x.doc_id}" for x in got for c in CLASH)
    clean = decontaminate.clean(docs, items).collect()
    assert sorted(x.doc_id for x in clean) == [0, 1, 2, 4, 5, 6, 7, 8, 9] and same(clean) and clean[0].asDict().keys() == set(docs.columns)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 9] and same(kept.collect())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and same(mixed.collect())
    planned = mixing.plan(docs)
    assert same(planned.collect()) and {"size", "copies"} <= set(planned.columns)
    assert {x.doc_id for x in lexical.search(docs, items).collect()} >= {3} and toxicity.classify(docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == len(texts)


def test_passages_of_a_repeated_id_are_cut_in_their_own_text(spark):
    passage = prose(11, 60)
    rows = [(1, passage), (2, prose(12, 50) + " " + passage), (2, prose(13, 120))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(x.text for x in substring_dedup.remove(docs, substring_dedup.find(docs)).where("doc_id = 2").collect())
    assert prose(13, 120) in left and passage not in left[0] + left[1]
    assert docs.select(F.count("*")).first()[0] == 3
