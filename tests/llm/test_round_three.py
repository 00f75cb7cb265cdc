"""Lexical search, toxicity and fill-in-the-middle on small tables: brute force, odd values, ties, repeated rows, empty tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import fim, lexical, toxicity

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=20):
    """The search by its definition."""
    held = [(i, Counter(TERM.findall((x or "").translate(ASCII)))) for i, x in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        query, found = Counter(TERM.findall((text or "").translate(ASCII))), []
        for i, c, n in held:
            m = 75 + 25 * n * len(held) // total
            score = sum(q * math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in query.items() if t in c)
            if score:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return out


def key(row):
    return [(x is None, x or 0) for x in row]


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    weight = [1 / (k + 1) for k in range(300)]
    return [(k, " ".join(r.choices(words, weight, k=r.choice((3, 20, 80, 400))))) for k in range(n)]


@pytest.mark.parametrize("most_items, most_terms", [(256, 1 << 17), (3, 1 << 17), (256, 20)])
def test_search_is_the_definition(spark, most_items, most_terms):
    r = random.Random(1)
    docs = corpus(5, 400)
    docs += [(1000, docs[3][1]), (1001, docs[3][1]), (None, docs[3][1]), (1002, None), (1003, ""), (1004, "--- !!"), (1005, "É straße É Straße"), (1000, docs[3][1]), (1006, "w0 " * 60_000)]
    items = [(k, " ".join(r.choices([f"w{j}" for j in range(320)], k=r.choice((1, 5, 30, 90))))) for k in range(12)]
    items += [(50, docs[3][1]), (51, "nothing of this occurs"), (52, None), (53, "!"), (54, "É STRASSE straße"), (None, "w1 w1 w2"), (0, items[0][1]), (55, " ".join(f"w{j}" for j in range(150)))]
    df = spark.createDataFrame([(i, x, 7) for i, x in docs], "doc_id long, text string, score long").repartition(5)
    got = lexical.search(df, spark.createDataFrame(items, "item_id long, text string"), most_items=most_items, most_terms=most_terms).collect()
    assert sorted(map(tuple, got), key=key) == sorted(ranked(docs, items), key=key)


def test_search_in_small_chunks_and_of_empty_tables(spark, monkeypatch):
    docs, items = corpus(6, 300), [(k, x) for k, x in corpus(7, 30)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert lexical.search(d.limit(0), i).count() == lexical.search(d, i.limit(0)).count() == 0
    weight = np.array([10, 20, 30], np.int64)
    own, term = np.array([0, 0, 1, 2, 2]), np.array([0, 2, 1, 0, 2])
    chunk = lexical.Chunk(np.array([5, 3, 4]), np.array([2, 1, 2]), own, term, np.array([1, 1, 1, 1, 2]), weight, 3, 5)
    none = (np.zeros(0, np.int64),) * 2
    whole = chunk.best(np.array([0, 2]), np.array([1, 1]), none, 2)
    assert whole[1].tolist() == [4, 5] and chunk.best(np.array([0, 2]), np.array([1, 1]), whole, 2)[1].tolist() == [4, 4]
    assert chunk.best(np.array([1]), np.array([3]), none, 5)[1].tolist() == [3]


def test_masks_are_left_unscored_once_the_rest_cannot_matter(spark, monkeypatch):
    seen = []
    scores = lexical.Chunk.scores
    monkeypatch.setattr(lexical.Chunk, "scores", lambda self, rows, times, docs: seen.append(len(docs)) or scores(self, rows, times, docs))
    r = np.random.default_rng(2)
    n = 5000
    cells = r.random((n, 12)) < np.array([0.002] * 4 + [0.5] * 8)
    own, term = np.nonzero(cells)
    df = cells.sum(0)
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df], np.int64)
    chunk = lexical.Chunk(np.arange(n), cells.sum(1), own, term, np.ones(len(own), np.int64), weight, n, int(cells.sum()))
    got = chunk.best(np.arange(12), np.ones(12, np.int64), (np.zeros(0, np.int64),) * 2, 20)
    every = scores(chunk, np.arange(12), np.ones(12, np.int64), np.arange(n))
    want = np.lexsort((np.arange(n), -every))[:20]
    assert got[1].tolist() == want.tolist() and sum(seen) < n / 4


UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def by_definition(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def texts(seed, n):
    r = random.Random(seed)
    signs = [" ", "\t", "\n", "\v", "\f", "\r", "  ", "a", "bc", "é", "中", "😀", "\x00", "\x0e", "\x08", "\x1f", "!", "\x7f", "\xa0", " ", "<", "P>"]
    return ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(n)]


def test_fim_is_the_definition_and_restores_every_text(spark):
    rows = list(enumerate(texts(4, 1500))) + [(None, "no id at all"), (3, None), (4, ""), (5, " \n"), (6, "has <M> in it"), (7, "word " * 300_000), (8, "x" * 100_000), (9, "same text"), (9, "same text"), (10, "a <P > <<S> b")]
    df = spark.createDataFrame([(i, x, "clash", "kept") for i, x in rows], "doc_id long, text string, form string, other string").repartition(3)
    for how in ({}, {"rate": 100, "spm": 50, "seed": 7}, {"rate": 0}):
        made = fim.transform(df, **how).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "other", F.coalesce("text", F.lit("")).alias("text"), fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
        assert all(x.back == x.text and x.other == "kept" for x in made)
        want = [by_definition(i, x, **how) for i, x in rows]
        assert sorted((tuple(x)[:6] for x in made), key=lambda r: (r[0] is None, r[0] or 0, r[5])) == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[5]))
    assert fim.transform(df.limit(0)).count() == 0


def test_marks_count_and_select_bytes():
    r = np.random.default_rng(3)
    raw = r.integers(0, 256, 4001).astype(np.uint8)
    x = np.zeros(501, np.uint64)
    x.view(np.uint8)[: len(raw)] = raw
    for marks, mine in ((fim.white_marks(x), np.isin(raw, [0x20, *range(9, 14)])), (fim.continuation_marks(x), (raw & 0xC0) == 0x80)):
        held, at = fim.Marks(marks), np.flatnonzero(mine)
        assert held.before(np.arange(len(raw) + 1)).tolist() == np.append(0, np.cumsum(mine)).tolist()
        assert held.select(np.arange(len(at))).tolist() == at.tolist()


def insulting(seed, n):
    """(doc_id, text, toxic): prose of made-up words; toxic ones hold listed insults, or words that begin with one of two made-up stems."""
    r = random.Random(seed)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    out = []
    for k in range(n):
        words = [word() for _ in range(r.choice((8, 40, 150)))]
        bad = r.random() < 0.2
        if bad:
            for _ in range(r.randint(2, 6)):
                words.insert(r.randrange(len(words)), r.choice(("you idiot", "worthless", "m0ron", "qxizo" + r.choice(syllables), "zyxxe" + r.choice(syllables))))
        out.append((k, " ".join(words), int(bad)))
    return out


def test_toxicity_on_held_out_rows(spark):
    made = insulting(9, 1500)
    odd = [(9001, None), (9002, ""), (9003, " \n"), (None, "you idiot"), (9004, "You are such an idiot, you worthless moron"), (9005, "plain words of no harm " * 20_000), (9001, None)]
    docs = spark.createDataFrame([(i, x, 0.5) for i, x, _ in made] + [(i, x, 0.5) for i, x in odd], "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + [(3, None), (None, 1), (9002, None)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(made) + len(odd) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    truth = {i: y for i, _, y in made}
    held = [(truth[x.doc_id], x.predicted) for x in got if x.held_out and x.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(b for a, b in held if a) / sum(a for a, _ in held) > 0.9
    by_id = {}
    for x in got:
        by_id.setdefault(x.doc_id, []).append(x)
    assert by_id[9004][0].predicted == 1 and by_id[9005][0].predicted == 0 and by_id[9002][0].predicted == 0 and not by_id[None][0].held_out
    assert len({x.score for x in by_id[9001] + by_id[9002]}) == 1
    # labels of held-out rows change nothing
    hidden = spark.createDataFrame([(i, 1 - y if i % 2 else y) for i, _, y in made], "doc_id long, toxic int").where(toxicity.is_held_out())
    flipped = toxicity.classify(docs, labels.where(~toxicity.is_held_out()).unionByName(hidden)).collect()
    assert sorted(map(str, flipped)) == sorted(map(str, got))


def test_toxicity_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [x.score for x in toxicity.classify(docs, none).collect()] == [0.0, 0.0]
    for y in (0, 1):
        same = spark.createDataFrame([(1, y), (2, y), (3, y)], "doc_id long, toxic int")
        assert [x.score for x in toxicity.classify(docs, same).collect()] == [float(y)] * 2
    assert toxicity.classify(docs.limit(0), none).count() == 0


def test_features_of_a_text():
    empty = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros((0, toxicity.FOLDS + 1)))
    raw, offsets = toxicity.text_buffer(pa.array(["You IDIOT! such an i.d.i.o.t. Sooo m0ron?", "", "Étrange É", None, "no one here"]))
    x = dict(zip(toxicity.FEATURES, toxicity.features(toxicity._lower(raw), raw, offsets, empty, 0).T))
    assert x["words"][0] == pytest.approx(math.log(12)) and x["words"][1] == x["words"][3] == 0
    assert x["insults"][0] == pytest.approx(1 / 11) and x["second"][0] == pytest.approx(1 / 11) and x["near"][0] == pytest.approx(1 / 11)
    assert x["hidden"][0] == pytest.approx(2 / 11) and x["drawn"][0] > 0 and x["shouted"][0] == pytest.approx(1 / 11) and x["exclaimed"][0] > 0 < x["asked"][0]
    assert x["capitals"][2] > 0 and not any(x[c][4] for c in toxicity.FEATURES if c not in ("words", "capitals"))


def test_trees_and_isotonic_regression():
    r = np.random.default_rng(1)
    x = r.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    parts = toxicity.fitted(x, y, np.arange(800) % 5)
    at, p = parts["calibration"]
    score = np.interp(toxicity.predict(toxicity.binned_by(x, parts["edges"]), parts["trees"], parts["base"]), at, p)
    assert ((score >= 0.5) == y).mean() > 0.97 and (np.diff(p) >= 0).all() and (np.diff(at) > 0).all()
    at, p = toxicity.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert p.tolist() == [0, 0.5, 1] and at.tolist() == [1, 2.5, 4]
