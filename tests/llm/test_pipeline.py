"""The whole pipeline on a small corpus with planted copies, items and junk, against a brute-force version."""

from collections import Counter

import corpus_pipeline
from tokenizers import Tokenizer

from tallyfield.llm import mixing, quality, tokens

from test_ops import DOCS, docs_of, prose, sets_of


def test_pipeline_brute_force(spark, tmp_path):
    items = [(k, prose(900 + k, 20 + k)) for k in range(6)] + [(50, None), (51, "")]
    texts = [(k, prose(k, 80)) for k in range(60)] + [(200 + k, prose(300 + k, 80).replace(" ", "$$$ ")) for k in range(30)]
    texts += [(100 + k, texts[k][1]) for k in range(5)] + [(0, texts[0][1]), (110, texts[7][1].replace(texts[7][1].split()[40], "edit", 1))]
    texts += [(120 + k, f"{prose(500 + k, 60)} {x} {prose(600 + k, 60)}") for k, x in items if x] + [(130, None), (131, ""), (None, prose(777, 80))]
    for name, df in (
        ("documents", docs_of(spark, texts)),
        ("labels", spark.createDataFrame([(i, int(i < 200), 0) for i, _ in texts if i is not None and i < 300], "doc_id long, quality int, toxic int")),
        ("benchmark", spark.createDataFrame(items, "item_id long, text string")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = Counter((x.doc_id, x.n_tokens) for x in corpus_pipeline.run(spark, str(tmp_path)).collect())

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = quality.classify(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), keep=("doc_id", "text")).where("predicted = 1").collect()
    left = sorted(((x.doc_id, x.text) for x in scored), key=lambda x: (x[0] is not None, x[0] or 0))
    assert {i for i, _ in left} >= {*range(60), *range(100, 105), 110} and not any(i is not None and i >= 200 for i, _ in left)
    sets, kept = sets_of(left), []
    for k in range(len(left)):  # in order of doc_id: one of each group stays
        if not any(len(sets[k] & sets[j]) >= 0.8 * len(sets[k] | sets[j]) - 1e-12 for j in kept):
            kept.append(k)
    left = [left[k] for k in kept]
    left = [(i, x) for i, x in left if not any(y and f" {y} " in f" {x or ''} " for _, y in items)]
    assert not {i for i, _ in left} & {110, 200, *range(100, 105), *range(120, 126)}
    plan = mixing.plan(docs_of(spark, left)).collect()
    t = Tokenizer.from_file(tokens.default_tokenizer())
    want = Counter((x.doc_id, len(t.encode(x.text or "", add_special_tokens=False).ids) + 1) for x in plan for _ in range(x.copies))
    assert got == want


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name, kind in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
