"""Substring dedup: MinHash of every window of words, spans grown from shared seeds, exact Jaccard, components.

A passage that recurs begins and ends anywhere, so every window of SEED + WINDOW - 1 = 24 words gives its MinHash value:
the smallest hash of its SEED-word grams. Windows that follow each other mostly share it, so a text has a seed (the place of
such a gram) about each nine words. Two texts that share 24 words in a row share a seed for certain, and so do spans of 49
words or more whose five-word shingles have a Jaccard similarity of THRESHOLD or more: their differing shingles are too few
to leave no run of 20 equal ones. No candidate is left to chance.

Of seeds that occur in two documents, those with equal words NEAR words to each side share a digest and need no comparison.
Different ones that share the seed and RUN words in a row around it are compared SIDE words to each side, in tasks
of bounded size: the shared span is all equal words around the seed, and beyond an
edit (GAPS) the next equal words as long as the whole span's exact Jaccard stays at the threshold. However many share a seed, every
one gets the longest of its spans with any other: how far it equals others is told by grouping on the words up to there, and
only pairs that part at a place and share a shingle a few words on, a second key, can cross an edit and are compared. Spans count from LEAST
words on (two common lines in a row stay below that), texts of WORDS words or more that recur as a whole whatever their
length. Components of the links are the classes. Classes found in two or more documents are returned: one
span of a class stays (the first by doc_id, then place), the others are removals. A passage of many words gives overlapping
spans, one about each nine words.

A run of one word counts as WORDS words of it, as more add no shingle; other words that repeat with a period under SEED have
one seed in PERIODIC words, so a passage of only such words is found from PERIODIC + 24 words on.

Defined cases: null and empty texts have no spans; rows with equal doc_id are one document, so what they share is no
repetition; of rows without a doc_id each distinct text is a document, and they come last in order (while at work they are known by numbers from 2**62
on, which doc_ids must stay below); other columns are kept by remove() and ignored by find(), whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _MULT, _powers, components, gram_hashes, materialise, mix64, slices, small_or_shuffled, text_buffer, tidy, token_hashes
from .ngram_join import _roots, dealt

WORDS, THRESHOLD = 5, 0.8
SEED, WINDOW, SIDE, NEAR = 8, 17, 56, 24
#: Equal words in a row around a seed for which surroundings are compared; words from which a span counts.
RUN, LEAST = 20, 32
#: Words from one seed to the next where equal seeds overlap.
PERIODIC = 48
#: Surroundings of one seed that a task takes; of more, each pair of blocks is a task.
BLOCK = 8192
#: Words left out on either side of an edit: replaced, left out, put in.
GAPS = [(1, 1), (0, 1), (1, 0), (2, 2), (0, 2), (2, 0), (1, 2), (2, 1), (3, 3), (4, 4), (0, 3), (3, 0), (0, 4), (4, 0)]
#: Pairs of surroundings that are compared at once.
PAIRS = 1 << 16
#: Numbers from here on stand for rows without a doc_id.
NAMELESS = 1 << 62
#: Edits that a span may cross on each side; within SIDE words the threshold allows no more.
EDITS = 2


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash and first byte of each word, the word at which each text begins, the texts' first bytes, and the number of bytes.

    Of a run of one word, WORDS words stay: the others add no shingle.
    """
    raw, offsets = text_buffer(texts)
    # lower case would move bytes, so it is taken of ASCII letters only
    h, first, at = token_hashes(np.where((raw >= 65) & (raw <= 90), raw | 32, raw), offsets)
    if len(h) > WORDS:
        again = np.append(False, h[1:] == h[:-1])
        again[at[:-1][at[:-1] < len(h)]] = False
        spare = np.append(np.zeros(WORDS - 1, bool), np.logical_and.reduce([again[k : len(h) - WORDS + 1 + k] for k in range(WORDS)]))
        h, first, at = h[~spare], first[~spare], at - np.append(0, np.cumsum(spare))[at]
    return h, first, at, offsets, len(raw)


def _running(op, v: np.ndarray, n: int) -> np.ndarray:
    """op over v[i : i + n] for each i."""
    done = 1
    while done < n:
        step = min(done, n - done)
        v = op(v[: len(v) - step], v[step:])
        done += step
    return v


def seeds(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, hash) of each text's seeds. A text of WORDS to SEED - 1 words is one seed."""
    g, begin = gram_hashes(h, at, SEED)
    n = len(at) - 1
    own = np.repeat(np.arange(n), np.diff(begin))
    place = np.arange(len(g)) + (WINDOW - 1) * (own + 1)
    padded = np.full(len(g) + (WINDOW - 1) * (n + 2), np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[place] = g
    least = _running(np.minimum, padded, WINDOW)  # of the window that begins there
    most = _running(np.maximum, least, WINDOW)  # of the windows that hold the place WINDOW - 1 further on
    ok = np.flatnonzero((most[place - (WINDOW - 1)] == g) & (np.diff(at)[own] >= WORDS))
    # equal grams that overlap: words that repeat with a short period; of such a chain, one a PERIODIC words
    order = np.lexsort((ok, g[ok], own[ok]))
    p, new = ok[order], np.ones(len(ok), bool)
    new[1:] = (g[p][1:] != g[p][:-1]) | (own[p][1:] != own[p][:-1]) | (np.diff(p) >= SEED)
    step = (p - p[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]) // PERIODIC
    new[1:] |= step[1:] != step[:-1]
    ok = np.sort(p[new])
    text = own[ok]
    return text, at[:-1][text] + ok - begin[text], g[ok]


def seeded(docs: DataFrame) -> DataFrame:
    """doc_id, th (the text's hash), at (word), key (the seed's hash) and digest (of the surroundings) of every seed."""
    inverse = np.uint64(pow(int(_MULT), -1, 1 << 64))

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                h, _, at, _, _ = _words(part.column("text"))
                if not len(h):
                    continue
                text, s, g = seeds(h, at)
                a, b = np.maximum(at[text], s - NEAR), np.minimum(at[text + 1], s + SEED + NEAR)
                total = np.append(np.uint64(0), np.cumsum(h * _powers(len(h) + 1)[: len(h)], dtype=np.uint64))
                back = np.full(len(h) + 1, inverse)
                back[0] = 1
                around = (total[b] - total[a]) * np.multiply.accumulate(back)[a]
                digest = mix64(mix64(around + (s - a).astype(np.uint64)) ^ g)
                ids, th = (part.column(c).take(pa.array(text)) for c in ("doc_id", "th"))
                yield pa.RecordBatch.from_arrays([ids, th, pa.array((s - at[text]).astype(np.int32)), pa.array(g.view(np.int64)), pa.array(digest.view(np.int64))], ["doc_id", "th", "at", "key", "digest"])

    return _texts(docs).mapInArrow(tidy(run), "doc_id long, th long, at int, key long, digest long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("text").isNotNull()).select(_number(docs).alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def _number(docs: DataFrame) -> Column:
    """doc_id, or a number above all doc_ids that stands for the text of a row without one."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS) + F.pmod(F.xxhash64("text", F.lit(4)), F.lit(NAMELESS)))


def _visit(docs: DataFrame, rows: DataFrame, among: DataFrame, of_text, schema: str) -> DataFrame:
    """of_text(words of a text, its rows) for each text that has rows; their columns other than doc_id and th go there as a list. among: a written table with the rows' doc_id and th."""
    wanted = small_or_shuffled(materialise(among.select("doc_id", "th").distinct()))
    texts = _texts(docs).join(wanted, ["doc_id", "th"], "left_semi")
    lists = rows.groupBy("doc_id", "th").agg(F.collect_set(F.struct(*[c for c in rows.columns if c not in ("doc_id", "th")])).alias("rows"))  # at most a text's own seeds

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                h, first, at, offsets, end = _words(part.column("text"))
                column = part.column("rows")
                k = np.asarray(pa.compute.list_parent_indices(column)).astype(np.int64)
                yield of_text(part.select(["doc_id", "th"]).take(pa.array(k)), k, column.flatten(), h, first, at, offsets)

    return texts.join(lists, ["doc_id", "th"]).select("doc_id", "th", "text", "rows").mapInArrow(tidy(run), schema)


TASK = ("task", "key", "b", "bi", "bj", "digest", "lo", "hi")


def _surroundings(ids, text, rows, h, first, at, offsets) -> pa.RecordBatch:
    """The rows with around: hashes (uint32, 0 outside the text) of SIDE words, the seed's, and SIDE words."""
    place = at[text][:, None] + np.asarray(rows.field("at")).astype(np.int64)[:, None] + np.arange(-SIDE, SEED + SIDE)
    inside = (place >= at[text][:, None]) & (place < at[text + 1][:, None])
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)
    around = np.where(inside, low[np.clip(place, 0, len(h) - 1)], np.uint32(0)).astype("<u4")
    return pa.RecordBatch.from_arrays([*[rows.field(c) for c in TASK], pa.array([x.tobytes() for x in around], pa.binary())], [*TASK, "around"])


def _bytes(ids, text, rows, h, first, at, offsets) -> pa.RecordBatch:
    """The rows' spans as bytes of the UTF-8 text: doc_id, th, start, bytes, words, class_id. Too short ones are left out."""
    place, l, r = (np.asarray(rows.field(c)).astype(np.int64) for c in ("at", "l", "r"))
    a, b = np.maximum(at[text], at[text] + place - l), np.minimum(at[text + 1], at[text] + place + SEED + r)
    ok = (b - a >= LEAST) | ((a == at[text]) & (b == at[text + 1]))
    text, a, b = text[ok], a[ok], b[ok]
    end = np.where(b < at[text + 1], first[np.minimum(b, len(h) - 1)], offsets[text + 1])
    out = [*ids.filter(pa.array(ok)).columns, pa.array((first[a] - offsets[text]).astype(np.int32)), pa.array((end - first[a]).astype(np.int32)), pa.array((b - a).astype(np.int32)), rows.field("class_id").filter(pa.array(ok))]
    return pa.RecordBatch.from_arrays(out, ["doc_id", "th", "start", "bytes", "words", "class_id"])


def _outwards(words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the 1, 2, 4 ... 32 words from each place on, and of WORDS words; 0 where they reach past the text's end.

    words: a row of word hashes for each seed, outwards from it, 0 past the text's end.
    """
    h = np.zeros((len(words), SIDE + 2 * WORDS), np.uint64)
    h[:, :SIDE] = np.where(words == 0, np.uint64(0), mix64(words.astype(np.uint64)) | np.uint64(1))
    runs = [h]
    while 2 ** len(runs) <= SIDE:
        runs.append(_joined(runs[-1], runs[-1], 2 ** (len(runs) - 1)))
    return runs, _joined(runs[2], h, 4)


def _joined(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Hash of what u tells of a place and v of the place n words on; 0 where either is."""
    out = np.zeros_like(u)
    x, y = u[:, :-n], v[:, n:]
    out[:, :-n] = np.where((x == 0) | (y == 0), np.uint64(0), mix64(x * _MULT + y) | np.uint64(1))
    return out


def _equal(runs: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal words from places i and j on (of the flattened rows)."""
    n = np.zeros(len(i), np.int64)
    for k in range(len(runs) - 1, -1, -1):
        x = runs[k].ravel()
        u = x[i + n]
        n += ((u == x[j + n]) & (u != 0)).astype(np.int64) << k
    return n


def _side(side: tuple[list[np.ndarray], np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of i, words of j, shared shingles beyond the first run) after 0 to EDITS edits, a column each.

    side: what _outwards tells of the rows, i and j: rows, a pair each. The edit is the first of GAPS after which a whole
    shingle is equal; where there is none, the columns repeat.
    """
    runs, shingle = side
    i, j, shingle = i * shingle.shape[1], j * shingle.shape[1], shingle.ravel()
    r = _equal(runs, i, j)
    px, py, s = r.copy(), r.copy(), np.zeros(len(i), np.int64)
    out = [(r, r, s.copy())]
    for _ in range(EDITS):
        open_rows = np.flatnonzero((px < SIDE - WORDS) & (py < SIDE - WORDS))
        for a, b in GAPS:
            if not len(open_rows):
                break
            at, place = i[open_rows] + px[open_rows] + a, j[open_rows] + py[open_rows] + b
            u = shingle[at]
            ok = (u == shingle[place]) & (u != 0)
            hit = open_rows[ok]
            if len(hit):
                more = _equal(runs, at[ok], place[ok])
                px[hit] += a + more
                py[hit] += b + more
                s[hit] += more - WORDS + 1
                open_rows = open_rows[~ok]
        out.append((px.copy(), py.copy(), s.copy()))
    return tuple(np.stack(c, 1) for c in zip(*out))


def spans_of(left, right, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of i before and after the seed, the same of j) of the longest span around each pair's seed whose Jaccard similarity is at least threshold.

    left, right: what _outwards tells of the rows' words before and after the seed.
    """
    lx, ly, ls = _side(left, i, j)
    rx, ry, rs = _side(right, i, j)
    best = [v[:, 0].copy() for v in (lx, rx, ly, ry)]
    for a in range(EDITS + 1):
        for b in range(EDITS + 1):
            shared = lx[:, 0] + rx[:, 0] + SEED - WORDS + 1 + ls[:, a] + rs[:, b]
            all_ = lx[:, a] + rx[:, b] + ly[:, a] + ry[:, b] + 2 * (SEED - WORDS + 1) - shared
            ok = (shared >= threshold * all_ - 1e-9) & (lx[:, a] + rx[:, b] > best[0] + best[1])
            for v, new in zip(best, (lx[:, a], rx[:, b], ly[:, a], ry[:, b])):
                v[ok] = new[ok]
    return tuple(best)


def _grouped(key: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, end, last): places sorted by key, then by then; number k of the order meets numbers end[k] to last[k], all
    further ones of its key but those with its then."""
    order = np.lexsort((then, key))
    key, then = key[order], then[order]
    new = key[1:] != key[:-1]
    here = np.arange(len(order))
    last, end = (np.append(np.flatnonzero(c) + 1, len(order)) for c in (new, new | (then[1:] != then[:-1])))
    return order, end[np.searchsorted(end, here, "right")], last[np.searchsorted(last, here, "right")]


def _met(end: np.ndarray, last: np.ndarray):
    """(k, m) of each place k with those from end[k] to last[k], PAIRS at a time."""
    total = np.append(0, np.cumsum(last - end))
    for lo in range(0, int(total[-1]), PAIRS):
        at = np.arange(lo, min(lo + PAIRS, int(total[-1])))
        k = np.searchsorted(total, at, "right") - 1
        yield k, end[k] + at - total[k]


def sharing(sides, words, seed: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(side, n, group, rows, pairs) for each side and number of words n: the rows that share the n words next to the seed
    on this side, and RUN words in a row in all, with a row of another document; group is the same for those that share them.

    sides: what _outwards tells of words. pairs: (i, j), some at a time, of these rows that part after n words and share a
    shingle a few words on, so can cross an edit; a pair may come again. Others share no more than equal words.
    """
    total = [np.concatenate([np.zeros((len(seed), 1), np.uint64), np.cumsum(mix64(w.astype(np.uint64)) * _powers(SIDE), axis=1, dtype=np.uint64)], 1) for w in words]
    key, most = mix64(seed.astype(np.uint64)), max(max(gap) for gap in GAPS)
    for side in (0, 1):
        left = np.arange(len(seed))
        for n in range(SIDE + 1):
            other = max(0, RUN - SEED - n)
            rows = left[((n == 0) | (words[side][left, n - 1] != 0)) & ((other == 0) | (words[1 - side][left, other - 1] != 0))]
            same = mix64(mix64(total[side][rows, n] ^ key[rows]) + total[1 - side][rows, other])
            order = np.argsort(same, kind="stable")
            rows, same = rows[order], same[order]
            first = np.flatnonzero(np.append(True, same[1:] != same[:-1])[: len(rows)])
            if not len(first):
                continue  # with more words on this side, fewer are needed on the other
            # rows of one document only link through those of others, which a group must have
            size = np.diff(np.append(first, len(rows)))
            group, ok = (np.repeat(v, size) for v in (rows[first], np.minimum.reduceat(low[rows], first) < np.maximum.reduceat(high[rows], first)))
            ok &= np.repeat(size > 1, size)
            rows, group = rows[ok], group[ok]
            if other == 0:
                left = rows  # only these can share more words
            yield side, n, group, rows, _crossing(sides[side][1], words[side], n, group, rows, most) if n < SIDE - WORDS else ()


def _crossing(shingle: np.ndarray, words: np.ndarray, n: int, group: np.ndarray, rows: np.ndarray, most: int):
    """(i, j), some at a time, of the rows of a group whose words differ after n ones and that share a shingle up to most words further on."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(rows)])
    if not len(first):
        return
    differ = np.minimum.reduceat(words[rows, n], first) < np.maximum.reduceat(words[rows, n], first)
    ok = np.repeat(differ, np.diff(np.append(first, len(rows))))
    rows, group = rows[ok], group[ok]
    at = np.repeat(n + np.arange(most + 1), len(rows))
    rows, group = np.tile(rows, most + 1), np.tile(group, most + 1)
    g = shingle[rows, at]
    ok = g != 0
    rows, at, key = rows[ok], at[ok], mix64(g[ok] ^ mix64(group[ok].astype(np.uint64)))
    order, end, last = _grouped(key, words[rows, n])
    rows, at = rows[order], at[order]
    for k, m in _met(end, last):
        i, j, p, q = rows[k], rows[m], at[k], at[m]
        # equal a word before too: these come with the shingle there
        ok = (p == n) | (q == n) | (words[i, p - 1] != words[j, q - 1])
        yield i[ok], j[ok]


def reaching(around: np.ndarray, seed: np.ndarray, block: np.ndarray, cross: np.ndarray, low: np.ndarray, high: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, root, words before, words after) of every row that shares RUN words around its seed with a row of another
    document: a row of its class, and the most words on each side of its spans with all such rows.

    block, cross: of rows where cross is true, those of one block need no comparison (they have a task of their own).
    low, high: the first and last document that has the row.
    """
    n = len(seed)
    words = [around[:, SIDE - 1 :: -1], around[:, SIDE + SEED :]]
    sides = [_outwards(w) for w in words]
    most = np.zeros((2, n), np.int64)
    ends = np.stack([(w != 0).sum(1) for w in words])
    links, waiting = [np.zeros(0, np.int64)], []

    def compare():
        i, j = (np.concatenate(c) for c in zip(*waiting))
        waiting.clear()
        i, j = np.minimum(i, j), np.maximum(i, j)
        li, ri, lj, rj = spans_of(*sides, i, j, threshold)
        for at, l, r in ((i, li, ri), (j, lj, rj)):
            np.maximum.at(most[0], at, l)
            np.maximum.at(most[1], at, r)

    for side, shared, group, rows, pairs in sharing(sides, words, seed, low, high):
        most[side][rows] = np.maximum(most[side][rows], shared)
        if side == 0 and shared <= RUN - SEED:
            links.append(group * n + rows)
        for i, j in pairs:
            ok = (low[i] != high[i]) | (low[j] != high[j]) | (low[i] != low[j])  # not of one document only
            ok &= ~cross[i] | (block[i] != block[j])
            done = (most == ends).all(0)  # to both ends of what is compared
            ok &= ~(done[i] & done[j])
            waiting.append((i[ok], j[ok]))
            if sum(len(i) for i, _ in waiting) >= PAIRS:
                compare()
    if waiting:
        compare()
    pair = np.unique(np.concatenate(links))
    u, v = pair // max(n, 1), pair % max(n, 1)
    at = np.unique(np.concatenate([u, v]))
    return at, _roots(n, u, v)[at] if len(at) else at, most[0][at], most[1][at]


def find(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """doc_id, th (xxhash64 of the text), start, bytes, words, class_id, first_doc, keep of every span whose class is in two documents."""
    every = materialise(seeded(docs))
    meet = materialise(every.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key"))
    held = materialise(every.join(meet, "key"))
    nodes = materialise(held.groupBy("digest").agg(F.min("key").alias("key"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min(F.struct("doc_id", "th", "at")).alias("p")))
    # surroundings that differ from others of their seed: one place for each digest
    several = materialise(nodes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    places = materialise(nodes.join(several, "key").select("digest", "key", "lo", "hi", "p.*"))
    tasks = dealt(places, "key", "digest", block).select("doc_id", "th", "at", *TASK)
    around = _visit(docs, tasks, places, _surroundings, "task long, key long, b int, bi int, bj int, digest long, lo long, hi long, around binary")

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("bi", "ascending"), ("bj", "ascending"), ("digest", "ascending")])
        names = [np.asarray(table[c]) for c in ("key", "bi", "bj", "digest")]
        again = np.append(False, np.logical_and.reduce([c[1:] == c[:-1] for c in names]))  # a row of the table that repeats
        table = table.filter(pa.array(~again))
        around = np.frombuffer(b"".join(table["around"].to_pylist()), "<u4").reshape(-1, 2 * SIDE + SEED)
        digest, low, high, own, bi, bj = (np.asarray(table[c]) for c in ("digest", "lo", "hi", "b", "bi", "bj"))
        new = np.zeros(len(digest), np.int64)
        for c in (np.asarray(table[c]) for c in ("key", "bi", "bj")):
            new[1:] |= c[1:] != c[:-1]
        at, root, l, r = reaching(around, np.cumsum(new), own, bi != bj, low, high, threshold)
        u, v = digest[at], digest[root]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "l": pa.array(l.astype(np.int32)), "r": pa.array(r.astype(np.int32))})

    # about a block of rows a task, whatever their bytes
    dealt_out = around.repartition(max(1, -(-places.count() // block)), "task")
    linked = materialise(dealt_out.groupBy("task").applyInArrow(verify, "u long, v long, l int, r int"))
    near = components(linked.select("u", "v")).select(F.col("node").alias("digest"), "component")
    reach = linked.groupBy(F.col("u").alias("digest")).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    told = nodes.join(reach.join(near, "digest", "left"), "digest", "left").where("l is not null or lo < hi")
    told = materialise(told.select("digest", "lo", "hi", "p", "l", "r", F.coalesce("component", "digest").alias("class_id")))
    # beyond NEAR words, only the place that was compared is known to go on so
    here, shared = F.struct("doc_id", "th", "at") == F.col("p"), F.when(F.col("lo") < F.col("hi"), NEAR).otherwise(0)
    side = lambda c: F.when(here, F.greatest(F.coalesce(c, F.lit(0)), shared)).otherwise(F.greatest(F.least(F.coalesce(c, F.lit(0)), F.lit(NEAR)), shared)).alias(c)
    found = materialise(held.join(told, "digest").select("doc_id", "th", "at", side("l"), side("r"), "class_id"))
    hits = materialise(_visit(docs, found, found, _bytes, "doc_id long, th long, start int, bytes int, words int, class_id long"))
    # written, so that a class of very many spans can be split where its rows join
    tops = materialise(hits.groupBy("class_id").agg(F.min(F.struct("doc_id", "start")).alias("top"), F.max("doc_id").alias("hi")).where("top.doc_id < hi").drop("hi"))
    named = lambda c: F.when(F.col(c) < NAMELESS, F.col(c))
    return hits.join(tops, "class_id").select(named("doc_id").alias("doc_id"), "th", "start", "bytes", "words", "class_id", named("top.doc_id").alias("first_doc"), (F.struct("doc_id", "start") == F.col("top")).alias("keep"))


def remove(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs without the passages that find() marks as removals."""
    spans = found.where("not keep").select("doc_id", "th", "start", "bytes").distinct().groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "bytes"))).alias("spans"))  # at most a text's own passages
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("whole"), F.xxhash64("text").alias("h"))
    rows = rows.join(spans, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th")), "left")
    raw = "encode(whole, 'UTF-8')"
    kept = f"aggregate(spans, struct(binary('') as done, 0 as at), (s, x) -> struct(concat(s.done, substring({raw}, s.at + 1, greatest(x.start - s.at, 0))) as done, greatest(s.at, x.start + x.bytes) as at), s -> concat(s.done, substring({raw}, s.at + 1)))"
    text = F.when(F.col("spans").isNull(), F.col("whole")).otherwise(F.expr(f"decode({kept}, 'UTF-8')"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
