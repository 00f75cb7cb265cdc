"""The training-data operators on small tables: odd values, ties, repeated rows, empty tables, and brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyfield.llm import chat, common, decontaminate, mixing, neighbours, ngram_join, quality, substring_dedup, tokens, urlfilter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") + r.choice("bcdfghklmnprst") + r.choice("aeiou") * r.randint(1, 2) for _ in range(n))


def docs_of(spark, texts):
    return spark.createDataFrame([(i, x, "en", f"s{(i or 0) % 3}", len(x or "")) for i, x in texts], DOCS)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é ß 中文 word"), (None, "no id here at all"), (6, prose(1, 30_000)), (7, "one"), (4, "one")]


def test_token_hashes_are_those_of_the_words():
    texts = pa.array(["a b a", None, "", "b\tlonger-word\n", "é"])
    raw, offs = common.text_buffer(texts)
    h, s, at = common.token_hashes(raw, offs)
    assert at.tolist() == [0, 3, 3, 3, 5, 6] and h[0] == h[2] != h[1] == h[3]
    many = "word " * 700_000  # longer than a piece
    raw, offs = common.text_buffer(pa.array([many, "word"]))
    h, _, at = common.token_hashes(raw, offs)
    assert len(h) == 700_001 and len(set(h.tolist())) == 1


def test_grams_stay_within_texts():
    raw, offs = common.text_buffer(pa.array(["a b c d e f", "a b c", "", "b c d e f"]))
    h, _, at = common.token_hashes(raw, offs)
    g, begin = common.gram_hashes(h, at, 5)
    assert np.diff(begin).tolist() == [2, 1, 0, 1] and g[1] == g[3]


def test_components_match_union_find(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(200, 200 + k) for k in range(1, 40)]
    got = {x.node: x.component for x in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_warc_round_trip_and_revisits(spark):
    rows = [(1, "http://a.b/x?y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "no scheme", None), (4, "http://a/b c", ""), (5, "http://c", "x" * 300_000), (2, None, "<p>é</p>"), (9, "http://d\r\nInjected: 1", "WARC/1.1\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame([(*x, "clash") for x in rows], "page_id long, url string, html string, record_type string")
    got = warc.assemble(warc.records(warc.write(pages), payload=True)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    for x in got:
        i = int(x.metadata[0].info["page-id"])
        html = next(h for k, _, h in rows if k == i) or ""
        ref = first[html]
        assert x.response.record_type == ("response" if i == ref else "revisit")
        assert x.metadata[0].info.get("refers-to-page-id") == (None if i == ref else str(ref))
        assert x.response.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert x.request.concurrent_to == x.response.record_id
        if i == ref:
            assert bytes(x.response.payload).decode() == html
    assert warc.assemble(warc.records(warc.write(pages.limit(0)))).count() == 0


def test_warc_links_in_any_direction(spark, tmp_path):
    def member(kind, i, links, block=b"a: b", length=None):
        head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <{i}>".encode()] + [f"WARC-Concurrent-To: <{x}>".encode() for x in links]
        return b"\r\n".join(head + [b"Content-Type: application/warc-fields", f"Content-Length: {len(block) if length is None else length}".encode()]) + b"\r\n\r\n" + block + b"\r\n\r\n"

    records = [
        ("response", "r1", []), ("request", "q1", ["r1"]), ("metadata", "m1", ["q1"]), ("metadata", "m2", ["r1"]),  # a chain, two metadata records
        ("request", "q2", []), ("response", "r2", ["q2", "m3"]), ("metadata", "m3", []),  # the response names the others, in two lines
        ("metadata", "m4", []), ("resource", "x1", ["r1"]), ("response", "r3", []),
    ]
    half = len(records) // 2
    (tmp_path / "a.warc").write_bytes(b"".join(member(*x) for x in records[half:]) + member("response", "r4", [], length="odd") + member("response", "r5", [], b"cut", 100))
    (tmp_path / "b.warc").write_bytes(b"".join(member(*x) for x in records[:half]))
    files = spark.createDataFrame([(f"file://{tmp_path}", "a.warc"), (f"file://{tmp_path}", "b.warc")], "folder string, name string")
    got = {frozenset(y.record_id for y in [x.request, x.response, *x.metadata, *x.others] if y): x for x in warc.assemble(warc.records(files)).collect()}
    assert set(got) == {frozenset(x) for x in (("r1", "q1", "m1", "m2", "x1"), ("q2", "r2", "m3"), ("m4",), ("r3",), ("r4",), ("r5",))}
    assert [m.record_id for m in got[frozenset(("r1", "q1", "m1", "m2", "x1"))].metadata] == ["m1", "m2"]
    assert not got[frozenset(("r5",))].response.complete and got[frozenset(("r3",))].response.complete


def test_chat_parts_and_reversible_template(spark):
    v = chat.Visitor()
    for part in ({"type": "text", "text": "see <image_0>"}, {"type": "image", "ref": "a.png"}, {"type": "audio", "ref": "b", "units": 3}, {"type": "odd", "ref": "c"}):
        v.visit(part)
    assert "".join(v.out) == r"see \<image_0\><image_0><audio_1><document_2>" and v.tokens == 256 + 75 + 512
    texts = ["</s>[INST] ok [/INST]", "\\", "", None, "a]b[c<d>\\e", "x" * 50_000]
    rows = [(k % 2, k // 2, "assistant" if k % 3 else "user", x) for k, x in enumerate(texts)] + [(None, 0, None, "t"), (0, 0, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat.format_turns(df)
    back = [chat.parse_segment(x.segment) for x in segments.collect()]
    assert sorted((r, chat.unescape(b)) for r, b in back) == sorted((r or "", x or "") for _, _, r, x in rows)
    digest = {x.conv_id: x for x in chat.read_back(segments).collect()}
    mine = sorted((t, r or "", x or "") for c, t, r, x in rows if c == 1)
    assert digest[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
    assert digest[1].loss_chars == sum(len(x) for _, r, x in mine if r == "assistant") and digest[None].n_turns == 1
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_url_rules_brute_force(spark):
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("b.com", "", "block"), ("com", "/en/", "allow"), (None, "/", "block"), ("EXAMPLE.org", None, "block")]
    urls = [None, "", "no scheme", "http://example.com/en/71?x", "https://A.Example.COM/en/8#f", "http://xcom/en/", "http://b.com", "x://y://z.b.com/en/q", "http://example.org", "http://notexample.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    df = spark.createDataFrame(rules, "host string, path string, verdict string")
    clean = {}
    for h, p, v in rules:
        if h is not None:
            clean[h.lower(), p or ""] = min(v, clean.get((h.lower(), p or ""), v))
    want = {}
    for i, u in enumerate(urls):
        rest = (u or "").partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(h + p), h + p, v) for (h, p), v in clean.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[i] = (host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow")
    for block in (100, 2):
        got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in urlfilter.apply_rules(pages, df, block=block).collect()}
        assert got == want
    assert {x.verdict for x in urlfilter.apply_rules(pages, df.limit(0)).collect()} == {"allow"}


def test_substring_dedup_catches_passages_and_leaves_the_rest(spark):
    passage = prose(100, 64)
    texts = [(k, prose(k, 150) + (" " + passage + " " if k in (3, 8) else " ") + prose(1000 + k, 90)) for k in range(20)]
    found = substring_dedup.find(docs_of(spark, texts + [(None, texts[0][1]), (30, None), (31, "")])).collect()
    assert {x.doc_id for x in found} == {0, None, 3, 8} and {x.doc_id for x in found if x.keep} == {0, 3}  # the row without an id is a copy of 0
    raw = {i: x.encode() for i, x in texts}
    for x in (x for x in found if x.doc_id in (3, 8)):
        assert raw[x.doc_id][x.start : x.start + x.bytes].decode().strip() in passage
    df = docs_of(spark, texts)
    left = {x.doc_id: x.text for x in substring_dedup.remove(df, substring_dedup.find(df)).collect()}
    assert left[3] == dict(texts)[3] and len(left[8]) < len(dict(texts)[8]) and left[5] == dict(texts)[5]
    assert substring_dedup.find(docs_of(spark, ODD)).count() == 0
    assert substring_dedup.find(df.limit(0)).count() == 0


def test_substring_dedup_spans_brute_force(spark):
    """Passages of 51 to 80 words in the middle of two texts, whole or with an edited word: the span is what brute force finds."""
    r, texts, want = random.Random(11), [], {}
    for k in range(40):
        w = prose(5000 + k, 51 + k % 30).split()
        v = list(w)
        if k % 2:
            at = r.randrange(6, len(w) - 6)
            v[at : at + 1] = [["edit"], [], ["two", "words"]][k // 2 % 3]
        for doc, words in ((k, w), (100 + k, v)):
            head, tail = prose(6000 + doc, r.randrange(20, 60)).split(), prose(7000 + doc, r.randrange(20, 60)).split()
            texts.append((doc, " ".join(head + words + tail)))
            want[doc] = set(range(len(head), len(head) + len(words)))
    texts += [(200 + k, prose(8000 + k, 200)) for k in range(10)]
    raw, got = {i: x.encode() for i, x in texts}, {}
    df = docs_of(spark, texts)
    for x in substring_dedup.find(df).collect():
        before, span = raw[x.doc_id][: x.start].split(), raw[x.doc_id][x.start : x.start + x.bytes].split()
        assert len(span) == x.words
        got.setdefault(x.doc_id, set()).update(range(len(before), len(before) + len(span)))
    assert got == want
    left = {x.doc_id: x.text.split() for x in substring_dedup.remove(df, substring_dedup.find(df)).collect()}
    for i, x in texts:
        assert left[i] == [w for k, w in enumerate(x.split()) if not 100 <= i < 200 or k not in want[i]]


def test_substring_dedup_short_copies_and_ends(spark):
    short, passage = [prose(300 + n, n) for n in (5, 7, 8, 15)], prose(333, 60)
    texts = [(10 * k + c, x) for k, x in enumerate(short) for c in (1, 2)] + [(100, passage + " " + prose(1, 80)), (101, prose(2, 80) + " " + passage)]
    found = substring_dedup.find(docs_of(spark, texts)).collect()
    assert {x.doc_id for x in found} == {i for i, _ in texts}
    raw, covered = {i: x.encode() for i, x in texts}, {100: set(), 101: set()}
    for x in found:
        if x.doc_id < 100:
            assert (x.start, x.bytes) == (0, len(raw[x.doc_id])) and x.keep == (x.doc_id % 10 == 1)
        else:
            covered[x.doc_id].update(raw[x.doc_id][x.start : x.start + x.bytes].decode().split())
    assert covered[100] == covered[101] == set(passage.split())


def test_no_pair_at_the_threshold_is_left_to_chance(spark):
    texts = []
    for k in range(400):
        w = prose(9000 + k, 49).split()
        v = list(w)
        v[5 + k % 39] = "edit"
        texts += [(k, " ".join(w)), (1000 + k, " ".join(v))]
    found = substring_dedup.find(docs_of(spark, texts)).collect()
    assert {x.doc_id for x in found} == {i for i, _ in texts}


def sets_of(texts):
    out = {}
    for k, (i, x) in enumerate(texts):
        w = (x or "").lower().split()
        out[k] = frozenset(tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def test_ngram_join_brute_force(spark):
    base, texts = prose(7, 120).split(), []
    r = random.Random(5)
    for k in range(90):  # one large group of near copies, cut into blocks below
        w = list(base)
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = f"edit{k}"
        texts.append((k, " ".join(w)))
    texts += [(100 + k, prose(100 + k, 60)) for k in range(20)] + [(200, texts[3][1].upper()), (201, ""), (202, None), (203, "few words"), (203, "few words"), (None, "few words")]
    sets = sets_of(texts)
    keys = list(sets)
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-12
    links = {k: sum(near(sets[k], sets[j]) for j in keys if j != k) for k in keys}
    got = ngram_join.join(docs_of(spark, texts), pair_bucket=8, block=24).collect()
    assert len(got) == len(texts)
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_links) for x in got) == sorted((i is None, i or 0, links[k]) for k, (i, _) in enumerate(texts))
    kept = ngram_join.keep_one(docs_of(spark, texts), pair_bucket=8, block=24).collect()
    assert sum(x.doc_id is not None and x.doc_id >= 100 and x.doc_id < 200 for x in kept) == 20
    assert len(kept) == len({x.class_id for x in got}) and ngram_join.join(docs_of(spark, []).limit(0)).count() == 0


def test_pruning_tolerance():
    for n, m in ngram_join.least_matches(0.8, 1e-6):
        x = np.linspace(0, 1, 20_001)
        for k, low in ((m, False), (m - 1, True)):
            if k >= 0:
                p = x**k * (1 - x) ** (n - k)
                assert (p[x >= 0.8].sum() / p.sum() < 1e-6) == low


def test_neighbours_recall_ties_and_odd_vectors(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 16))
    x[50:80] = x[50]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, [1.0]), (None, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index, books = neighbours.build(df)
    got = {}
    for v in neighbours.search(index, books, index.where("vec_id % 50 = 0")).collect():
        got.setdefault(v.query_id, {})[v.rank] = (v.vec_id, v.score)
    hit = 0
    for q in range(0, 600, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(600), d))[:10]
        hit += len({got[q][k + 1][0] for k in range(10)} & set(best.tolist()))
        assert all(abs(d[i] - s) < 1e-12 for i, s in got[q].values())
    assert hit >= 0.9 * 120 and [got[50][k + 1][0] for k in range(10)] == list(range(51, 61))
    spread = neighbours.search(index.repartition(16), books, index.where("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, spread)) == sorted((q, k, *v) for q, ranks in got.items() for k, v in ranks.items())
    few, b = neighbours.build(df.where("vec_id < 4"))
    assert neighbours.search(few, b, few.where("vec_id = 0")).count() == 3
    none, b = neighbours.build(df.limit(0))
    assert neighbours.search(none, b, none).count() == 0


def test_quality_learns_and_keeps_every_row(spark):
    texts = [(k, (prose(k, 80).replace(" ", "$$$ ") if k % 4 == 0 else prose(k, 80))) for k in range(400)]
    labels = spark.createDataFrame([(k, 0 if k % 4 == 0 else 1, 0) for k in range(400)] + [(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs_of(spark, texts + [(500, None), (501, ""), (None, "x")]), labels).collect()
    held = [x for x in got if x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got if x.doc_id is not None)
    assert len(got) == 403 and np.mean([x.predicted == (0 if x.doc_id % 4 == 0 else 1) for x in held if x.doc_id < 400]) > 0.97
    assert {x.score for x in quality.classify(docs_of(spark, texts[:5]), labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs_of(spark, []).limit(0), labels).count() == 0


def test_mixing_shares_and_copies(spark):
    sizes = [(0, "a", 300), (1, "b", 100), (2, None, 50), (3, "c", 0)]
    rows = [(10 * k + j, ("w " * (n // 10)) or None, "en", s, 0) for k, s, n in sizes for j in range(10)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = mixing.plan(docs).collect()
    target = {x.source: x.target for x in plan}
    assert sum(target.values()) == pytest.approx(1.5 * 450) and all(x.target <= 2 * x.source_size + 1e-9 for x in plan)
    assert all(x.copies <= 2 for x in plan) and len(plan) == 40
    assert sorted(x.doc_id for x in mixing.mix(docs).collect()) == sorted(i for x in plan for i in [x.doc_id] * x.copies)
    assert sorted(map(str, plan)) == sorted(map(str, mixing.plan(docs.repartition(7)).collect()))
    assert mixing.plan(docs.limit(0)).count() == 0


def test_mix_draws_by_text_and_keeps_columns(spark):
    rows = [(None, prose(k, 3), "en", "s", 7) for k in range(1000)] + [(1, "same row", "en", "t", 8)] * 2 + [(2, "w " * 20_000, "en", "t", 9)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "777 as size", "'x' as copies")
    plan = mixing.plan(docs).where("source = 's'").collect()
    assert abs(sum(x["size"] * x.copies for x in plan) - plan[0].target) < 0.1 * plan[0].target
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {(x["size"], x.copies) for x in mixed.collect()} == {(777, "x")}


def test_quality_is_plain_ftrl_whatever_the_columns(spark):
    texts = [(k, prose(k, 40) + (" $$$" * 9 if k % 3 else "")) for k in range(60)] + [(5, prose(5, 40)), (70, "word " * 200_000)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0), 0) for k in range(60)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, texts).selectExpr("*", "'a' as score", "'b' as held_out", "'c' as predicted")
    got = quality.classify(docs, labels, keep=("doc_id", "score", "held_out", "predicted", "lang"))
    assert got.columns == ["doc_id", "lang", "score", "held_out", "predicted"] and got.count() == len(texts)
    few = docs_of(spark, texts).where("doc_id < 20")
    w = quality.train(few, labels, max_rows=100)
    ids = [x.doc_id for x in spark.createDataFrame([(i,) for i, _ in texts if i < 20], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id, 7) as h").orderBy("h").collect()]
    rows = [(i, x) for k, i in enumerate(ids) if i != 5 for j, x in texts if j == i]
    z, n, one = np.zeros((1 << 18) + 1), np.zeros((1 << 18) + 1), {}
    two = [x for i, x in texts if i == 5]
    assert two[0] != two[1]  # rows that repeat an id: either order is one of two
    for i, x in rows + [(5, x) for x in two]:
        at, col, value = quality.features(pa.array([x]))
        one[i, x] = dict(zip(col.tolist(), value.astype("<f4").tolist()))
    best = None
    for pair in (two, two[::-1]):
        z, n = np.zeros((1 << 18) + 1), np.zeros((1 << 18) + 1)
        for _ in range(quality.PASSES):
            for i in dict.fromkeys(ids):
                for x in pair if i == 5 else [x for j, x in texts if j == i]:
                    f = {**one[i, x], 1 << 18: 1.0}
                    wt = {c: 0.0 if abs(z[c]) <= 1e-3 else -(z[c] - np.sign(z[c]) * 1e-3) / ((1 + np.sqrt(n[c])) / 0.5 + 1e-3) for c in f}
                    g = 1 / (1 + np.exp(-sum(wt[c] * v for c, v in f.items()))) - (i % 3 == 0)
                    for c, v in f.items():
                        z[c] += g * v - (np.sqrt(n[c] + g * g * v * v) - np.sqrt(n[c])) / 0.5 * wt[c]
                        n[c] += g * g * v * v
        plain = np.where(np.abs(z) <= 1e-3, 0.0, -(z - np.sign(z) * 1e-3) / ((1 + np.sqrt(n)) / 0.5 + 1e-3))
        best = min(best or 9, float(np.abs(plain - w).max()))
    assert best < 1e-5


def test_chat_ties_and_parts_through_spark(spark):
    rows = [(1, 0, "user", '"a'), (1, 0, "user", "#b"), (1, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seq", "2 as segment")
    assert [chat.unescape(chat.parse_segment(x.segment)[1]) for x in chat.format_turns(df).orderBy("seq").collect()] == ["", '"a', "#b"]
    parts = [(1, 0, "user", [("text", "see", None, None), ("image", None, "a.png", None)]), (1, 1, "assistant", [("audio", None, "b", 3), ("text", "<x>", None, None), None]), (2, 0, None, None)]
    df = spark.createDataFrame(parts, f"conv_id long, turn long, role string, content {chat.PARTS}")
    got = {(x.conv_id, x.turn): x for x in chat.format_turns(df).collect()}
    assert got[1, 0].segment == "<s>[user] see<image_0> [/user]</s>" and got[1, 0].expanded_tokens == 256
    assert r"<audio_1>\<x\>" in got[1, 1].segment and got[1, 1].attachments[0].ref == "b" and got[2, 0].expanded_tokens == 0


def test_decontamination_brute_force(spark):
    items = [(k, prose(500 + k, 20 + 3 * k)) for k in range(30)] + [(90, prose(990, 300)), (91, ""), (92, None)]
    texts = [(k, prose(k, 100) + (" " + items[k][1] if k < 30 and k % 3 == 0 else "") + " " + prose(2000 + k, 100)) for k in range(60)]
    texts += [(70, items[30][1]), (71, items[1][1].upper().replace(" ", ", ")), (72, None), (73, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(k, k) for k in range(0, 30, 3)} | {(70, 90), (71, 1)}
    for shard in (2048, 4):
        got = decontaminate.contaminated(docs_of(spark, texts), bench, shard=shard).collect()
        assert {(x.doc_id, x.item_id) for x in got} == want
    clash = docs_of(spark, texts).selectExpr("*", "1 as hits")
    left = decontaminate.clean(clash, bench)
    assert {x.doc_id for x in left.collect()} == {i for i, _ in texts} - {i for i, _ in want} and left.columns[-1] == "hits"
    assert decontaminate.contaminated(docs_of(spark, texts), bench.limit(0)).count() == 0


def test_short_items_are_found_in_a_row(spark):
    items = [(n, prose(700 + n, n)) for n in range(1, 10)] + [(20, prose(720, 5)[:-1]), (21, None)]
    texts = [(n, f"{prose(n, 90)} {x} {prose(50 + n, 90)}") for n, x in items if x]
    texts += [(100 + n, f"{prose(n, 90)} {' '.join(x.split()[::-1])} {prose(50 + n, 90)}") for n, x in items if x and n > 1] + [(200, items[0][1]), (201, ""), (202, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs_of(spark, texts), bench).collect()
    plain = lambda x: f" {x} "
    assert sorted((x.doc_id, x.item_id) for x in got) == sorted((i, n) for i, x in texts for n, y in items if x and y and plain(y) in plain(x))


def test_wand_finds_what_full_scoring_finds():
    r = np.random.default_rng(2)
    vocab = r.integers(1, 1 << 62, 300).astype(np.uint64)
    items = [(k, w[:10], w[10:]) for k in range(60) for w in [r.choice(vocab, 20)]]
    df = {}
    for _, q, a in items:
        for t in np.unique(np.concatenate([q, a])).tolist():
            df[t] = df.get(t, 0) + 1
    index = decontaminate.Index([(k, 0) for k in range(60)], items, df, 60, 20.0)
    for _ in range(30):
        terms = np.unique(index.lookup(r.choice(vocab, 120)))
        terms = terms[terms >= 0]
        full = np.zeros(60)
        for t in terms:
            full[index.seg[index.at[t] : index.at[t + 1]]] += index.impact[index.at[t] : index.at[t + 1]]
        sums = index.block_most[terms]
        got = {s: v for b in range(index.blocks) for s, v in index.search(terms[sums[:, b] > 0], b, 0.5)}
        assert set(got) == set(np.flatnonzero(full >= 0.5)) and all(abs(full[s] - v) < 1e-9 for s, v in got.items())


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    odd = ODD + [(-(1 << 63), "least id"), (8, "a  b   c \n d\t\te <|endoftext|> 's  \u00a0x"), (9, " lead and trail ")]
    t = Tokenizer.from_file(tokens.default_tokenizer())
    clash = docs_of(spark, odd).selectExpr("*", "1 as h", "2 as n_tokens", "3 as base")
    got = tokens.read(tokens.write(clash.repartition(3))).collect()
    want = {}
    for i, x in odd:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    have = {}
    for x in got:
        have.setdefault(x.doc_id, []).append((x.n_tokens, x.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for x in sorted(got, key=lambda x: x.start):
        assert x.start == at
        at += x.n_tokens
    ids = [x.doc_id for x in sorted(got, key=lambda x: x.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert tokens.read(tokens.write(docs_of(spark, odd).limit(0))).count() == 0


def test_encoder_generations_give_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    enc = tokens.Encoder(tokens.default_tokenizer())
    texts = [prose(k % 5, 60 + k) + (".\nNext, 's  x" if k % 2 else "") for k in range(30)]
    for lo in range(0, 30, 4):
        want = [np.asarray(e.ids, enc.dtype).tobytes() for e in enc.tokenizer.encode_batch_fast(texts[lo : lo + 4], add_special_tokens=False)]
        assert enc.encode(texts[lo : lo + 4]) == want
