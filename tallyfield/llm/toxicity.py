"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features of a text are shares of its words or characters: densities of a fixed lexicon of insults and of a lexicon of
word beginnings learnt from labelled rows, insults near the second person, capitals, punctuation, and obfuscation (signs or
digits within words, letters drawn out, insults that show only when those are taken away).

Fitting uses a bounded sample of the labelled rows (`max_rows`, those with the smallest id hashes), one row for each distinct text.
Their word beginnings (4 to 8 bytes of lower-cased words) are counted by Spark, by label and fold; the learnt lexicon holds at
most LEXICON of them. A row's features use counts of the other folds only, so the trees never see weights that its own label
made; exact copies share a fold. Trees of depth DEPTH over binned features are fitted in one task over the sample's features
(a few numbers a row). Scores for calibration come from trees fitted without the row's fold; isotonic regression over them
gives a probability, with linear interpolation. The model (lexicon, bins, trees, calibration) has a bounded size and is broadcast;
scoring reads every whole text once, in pieces of bounded size, and shuffles nothing.

Defined cases: a null text counts as empty; an empty text is scored by its features, all 0; a null label is no label; of
several labels of a doc_id the largest holds; without a labelled row every score is 0, with one class only its label; rows that repeat are scored
each; null doc_ids are scored, never learnt from, and not held out; an empty table gives no rows; columns other than doc_id and text of the
documents are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _CLASSES, _MULT, materialise, mix64, slices, text_buffer, tidy, token_hashes

MAX_ROWS, FOLDS, LEXICON, SUPPORT = 12_000, 5, 20_000, 3
BINS, DEPTH, TREES, RATE, LEAST = 32, 3, 60, 0.2, 4.0
#: Bytes of text whose features are made at once; words around the second person that count as near.
SLICE, NEAR = 2 << 20, 5
#: Lengths in bytes of word beginnings.
STEMS = (4, 5, 6, 7, 8)

#: Insults, lower-cased, in English, German, French and Spanish.
INSULTS = """idiot idiots moron morons stupid clown clowns loser losers pathetic worthless scum trash disgusting dumb fool fools jerk
imbecile cretin bastard filth garbage vermin useless shut hate
trottel depp dumm dummkopf abschaum widerlich erbärmlich wertlos versager arschloch blödmann hasse
imbécile crétin connard salaud ordure débile minable abruti raclure déteste
idiota imbécil estúpido estúpida basura escoria patético patética asqueroso inútil payaso odio""".split()
#: Words of the second person in the same languages.
SECOND = """you your yours yourself youre u ur du dich dir dein deine deinen euch euer ihr sie tu toi te ton ta tes vous votre vos
tú ti tuyo usted ustedes vosotros vuestro su sus""".split()
#: Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FEATURES = ("words", "insults", "stems", "stem_most", "stem_sum", "stem_kinds", "second", "near", "capitals", "shouted", "exclaimed", "asked", "signs", "mixed", "hidden", "drawn")


def _hashed(words: list[str]) -> np.ndarray:
    raw, offsets = text_buffer(pa.array(words))
    return np.unique(token_hashes(raw, offsets, words_only=False)[0])


def _lower(raw: np.ndarray) -> np.ndarray:
    """ASCII letters and, after the byte xC3, Latin-1 letters in lower case."""
    low = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
    latin = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)) + 1
    low[latin] += 0x20
    return low


_INSULTS, _SECOND = _hashed(INSULTS), _hashed(SECOND)
#: Bytes as they are read behind an obfuscation: lookalikes as letters, other signs within a word left out (0).
_PLAIN = np.where(_CLASSES == 2, 0, np.arange(256)).astype(np.uint8)
for _sign, _letter in LOOKALIKES.items():
    _PLAIN[ord(_sign)] = ord(_letter)
_POWER = np.array([pow(int(_MULT), k, 1 << 64) for k in range(max(STEMS))], np.uint64)


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, word at which each text begins) of the runs of letters and digits of lower-cased bytes."""
    h, s, at = token_hashes(raw, offsets, words_only=False)
    word = _CLASSES[raw[s]] == 1 if len(s) else np.zeros(0, bool)
    return h[word], s[word], np.concatenate([[0], np.cumsum(word)])[at]


def _beginnings(raw: np.ndarray, start: np.ndarray):
    """(hashes, whether the word is that long) of the first 4, 5, .. bytes of words, one pair a length."""
    padded = np.append(raw, np.zeros(max(STEMS), np.uint8))
    value, inside = np.zeros(len(start), np.uint64), np.ones(len(start), bool)
    for k in range(max(STEMS)):
        b = padded[start + k]
        inside = inside & (_CLASSES[b] == 1)
        value = value + np.where(inside, (b.astype(np.uint64) + np.uint64(1)) * _POWER[k], np.uint64(0))
        if k + 1 in STEMS:
            yield mix64(value + np.uint64(k)), inside


def _texts(batch, at: int):
    """(first row, stop, lower-cased bytes, bytes, offsets) of pieces of a batch of bounded size."""
    column = batch.column(at)
    for lo, hi in slices(column, SLICE):
        raw, offsets = text_buffer(column.slice(lo, hi - lo))
        yield lo, hi, _lower(raw), raw, offsets


class Lexicon:
    """Sorted hashes of word beginnings with a weight each, and a table of their low bits that tells most others at once."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weight = keys[order], weight[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys & np.uint64((1 << 20) - 1)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, places among the keys) of those that are in the lexicon."""
        maybe = np.flatnonzero(self.seen[h & np.uint64((1 << 20) - 1)])
        if not len(maybe):
            return maybe, maybe
        place = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        ok = self.keys[place] == h[maybe]
        return maybe[ok], place[ok]


def features(low: np.ndarray, raw: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, column: np.ndarray | int) -> np.ndarray:
    """A row of FEATURES for each text. column: which of the lexicon's weights a text takes, one for all or one each."""
    n = len(offsets) - 1
    h, start, at = _words(low, offsets)
    own = np.repeat(np.arange(n), np.diff(at))
    column = np.broadcast_to(np.asarray(column, np.int64), n)
    words, size = np.maximum(np.diff(at), 1), np.maximum(np.diff(offsets), 1)
    count = lambda mask: np.bincount(own[mask], minlength=n) / words
    insult, second = np.isin(h, _INSULTS), np.isin(h, _SECOND)

    # each word's weight is that of its weightiest beginning
    weight = np.zeros(len(h))
    kind = np.zeros(len(h), np.int64)
    for k, (stem, inside) in enumerate(_beginnings(low, start)):
        where, place = lexicon.find(stem)
        ok = inside[where]
        where, place = where[ok], place[ok]
        w = lexicon.weight[place, column[own[where]]]
        more = w > weight[where]
        weight[where[more]] = w[more]
        kind[where[more]] = place[more] + 1
    strong = weight > 0
    most = np.zeros(n)
    np.maximum.at(most, own[strong], weight[strong])
    pair = np.unique(own[strong] * (len(lexicon.keys) + 1) + kind[strong]) // (len(lexicon.keys) + 1)

    # insults with the second person at most NEAR words away, in the same text
    marked = np.concatenate([[0], np.cumsum(second)])
    bad = np.flatnonzero(insult | (weight > 1))
    lo, hi = np.maximum(bad - NEAR, at[:-1][own[bad]]), np.minimum(bad + NEAR + 1, at[1:][own[bad]])
    near = bad[marked[hi] > marked[lo]]

    text_of = np.repeat(np.arange(n), np.diff(offsets))
    per_char = lambda mask: np.bincount(text_of[mask], minlength=n) / size
    upper = low != raw
    letters = np.bincount(text_of[(_CLASSES[low] == 1) & ((low < 48) | (low > 57))], minlength=n)
    before = np.concatenate([[0], np.cumsum(upper)])
    long_word = np.concatenate([np.diff(start), [len(low) - start[-1]]]) if len(start) else np.zeros(0, np.int64)
    first_two = before[np.minimum(start + 2, len(low))] - before[start] == 2 if len(start) else np.zeros(0, bool)
    drawn = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & (_CLASSES[low[2:]] == 1) if len(low) > 2 else np.zeros(0, bool)
    drawn = np.append(drawn, np.zeros(len(low) - len(drawn), bool))

    # words between white space that hold letters on both sides of other signs or digits
    blank = _CLASSES[low] == 0
    sign = (_CLASSES[low] == 2) | ((low >= 48) & (low <= 57))
    letter = ~blank & ~sign
    inner = np.zeros(len(low), bool)
    if len(low) > 2:
        inner[1:-1] = sign[1:-1] & letter[:-2] & letter[2:]
    # the same bytes with lookalikes read as letters and other signs left out
    plain = _PLAIN[low]
    plain = np.where(sign & ~np.append(letter[1:], False) & ~np.append(False, letter[:-1]), 0, plain)
    keep = (plain != 0) | blank
    read_at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    g, _, g_at = token_hashes(plain[keep], read_at)
    shown = np.bincount(np.repeat(np.arange(n), np.diff(g_at))[np.isin(g, _INSULTS)], minlength=n)
    hidden = np.maximum(shown - np.bincount(own[insult], minlength=n), 0) / words

    sums = np.bincount(own[strong], weight[strong], n)
    columns = (
        np.log1p(np.diff(at)), count(insult), count(strong), most, np.log1p(sums), np.log1p(np.bincount(pair, minlength=n)), count(second),
        np.bincount(own[near], minlength=n) / words, np.bincount(text_of[upper], minlength=n) / np.maximum(letters, 1), count(first_two & (long_word > 2)),
        per_char(low == 33), per_char(low == 63), per_char(_CLASSES[low] == 2), np.bincount(text_of[inner], minlength=n) / words, hidden, per_char(drawn),
    )
    return np.column_stack(columns)


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int, depth: int = DEPTH, rate: float = RATE, least: float = LEAST, l2: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, bin, value) of the nodes of one tree, in heap order, by second-order gain. x: bins; a row goes left if its bin is at most the node's.

    least: least sum of second derivatives on either side. A node that is not split sends all rows left.
    """
    rows, width = x.shape
    feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins, np.int64)
    node = np.zeros(rows, np.int64)
    for level in range(depth):
        first, n = 2**level - 1, 2**level
        key = ((node - first)[:, None] * width + np.arange(width)) * bins + x
        sums = [np.bincount(key.ravel(), np.repeat(v, width), n * width * bins).reshape(n, width, bins).cumsum(2) for v in (g, h)]
        (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
        gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
        gain = np.where((hl >= least) & (ht - hl >= least), gain, 0).reshape(n, -1)
        best = gain.argmax(1)
        split = gain[np.arange(n), best] > 1e-9
        feature[first : first + n] = np.where(split, best // bins, 0)
        cut[first : first + n] = np.where(split, best % bins, bins)
        node = 2 * node + 1 + (x[np.arange(rows), feature[node]] > cut[node])
    leaf = node - (2**depth - 1)
    value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
    return feature, cut, value


def predict(x: np.ndarray, trees: list, base: float) -> np.ndarray:
    """Log-odds of rows of bins."""
    out, rows = np.full(len(x), base), np.arange(len(x))
    for feature, cut, value in trees:
        node = np.zeros(len(x), np.int64)
        for _ in range(len(value).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        out += value[node - len(feature)]
    return out


def boost(x: np.ndarray, y: np.ndarray, bins: int = BINS, trees: int = TREES, **how) -> tuple[list, float]:
    """(trees, base) of a logistic model of rows of bins."""
    p = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base, made = float(np.log(p / (1 - p))), []
    f = np.full(len(x), base)
    for _ in range(trees):
        q = 1 / (1 + np.exp(-f))
        tree = grow(x, q - y, q * (1 - q), bins, **how)
        f += predict(x, [tree], 0.0)
        made.append(tree)
    return made, base


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, probabilities) between which to interpolate: pooled adjacent violators, each pool at its mean score."""
    s, back = np.unique(score, return_inverse=True)
    pools: list[list[float]] = []
    for at, mean, n in zip(s, np.bincount(back, y) / np.bincount(back), np.bincount(back)):
        pools.append([at * n, mean * n, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    a, b, n = np.array(pools).T
    return a / n, b / n


def fitted(x: np.ndarray, y: np.ndarray, fold: np.ndarray, bins: int = BINS) -> dict:
    """Edges of bins, trees and calibration. Rows of one fold are scored, for calibration, by trees fitted to the others."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    # most values of a sparse feature are equal: its other values have edges of their own
    edges = [np.unique(np.concatenate([e, np.quantile(c[c > 0], np.linspace(0, 1, bins // 2)[:-1])]))[: bins - 1] if len(e) < bins // 2 and (c > 0).any() else e for e, c in zip(edges, x.T)]
    binned = binned_by(x, edges)
    out = np.empty(len(x))
    for k in np.unique(fold):
        rest = fold != k
        out[~rest] = predict(binned[~rest], *boost(binned[rest], y[rest], bins)) if rest.any() else 0.0
    trees, base = boost(binned, y, bins)
    return {"edges": edges, "trees": trees, "base": base, "calibration": isotonic(out, y)}


def binned_by(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])


def log_odds(toxic: np.ndarray, clean: np.ndarray, all_toxic: np.ndarray, all_clean: np.ndarray, support: int = SUPPORT) -> np.ndarray:
    """Weight of word beginnings that occur in so many toxic and clean texts: smoothed log-odds against all texts, 0 below the support and for ratios under 2."""
    ratio = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    return np.where((toxic >= support) & (ratio > np.log(2)), ratio, 0.0)


class Model:
    """What scores a text: a lexicon and what fitted() gives; parts is None without labelled rows."""

    def __init__(self, lexicon: Lexicon, parts: dict | None):
        self.lexicon, self.parts = lexicon, parts

    def scores(self, low, raw, offsets) -> np.ndarray:
        if self.parts is None:
            return np.zeros(len(offsets) - 1)
        x = features(low, raw, offsets, self.lexicon, FOLDS)
        at, p = self.parts["calibration"]
        return np.interp(predict(binned_by(x, self.parts["edges"]), self.parts["trees"], self.parts["base"]), at, p)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_if=None, max_rows: int = MAX_ROWS, folds: int = FOLDS) -> Model:
    """A model of at most max_rows of the labelled documents for which train_if (a column over doc_id) holds."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where("y is not null and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    known = known.where(train_if) if train_if is not None else known
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(sample), "doc_id")  # at most max_rows rows of 16 bytes
    # copies of one text are one row, and so in one fold
    rows = materialise(rows.groupBy(F.xxhash64("text").alias("th"), F.md5("text").alias("digest")).agg(F.min_by("text", "doc_id").alias("text"), F.max("y").alias("y")))
    rows = rows.select("text", F.col("y").cast("int").alias("y"), F.pmod("th", F.lit(folds)).cast("int").alias("fold"), "th")
    totals = np.zeros((folds, 2))
    for r in rows.groupBy("fold", "y").count().collect():  # two rows a fold
        totals[r["fold"], int(r["y"] > 0)] = r["count"]
    if not totals.sum():
        return Model(Lexicon(np.zeros(0, np.uint64), np.zeros((0, folds + 1))), None)

    def beginnings(batches):
        for batch in batches:
            for lo, hi, low, _, offsets in _texts(batch, 0):
                _, start, at = _words(low, offsets)
                own = np.repeat(np.arange(hi - lo), np.diff(at))
                found = [np.unique(np.rec.fromarrays([own[inside], stem[inside]])) for stem, inside in _beginnings(low, start)]
                own, stem = (np.concatenate([f[c] for f in found]) for c in ("f0", "f1"))
                place = pa.array(lo + own)
                yield pa.RecordBatch.from_arrays([pa.array(stem.view(np.int64)), batch.column(1).take(place), batch.column(2).take(place)], ["stem", "y", "fold"])

    seen = rows.select("text", "y", "fold").mapInArrow(tidy(beginnings), "stem long, y int, fold int")
    cells = [F.count_if((F.col("y") > 0) == F.lit(bool(t)) if f is None else ((F.col("y") > 0) == F.lit(bool(t))) & (F.col("fold") == f)) for t in (0, 1) for f in range(folds)]
    counts = seen.groupBy("stem").agg(*[c.cast("int").alias(f"c{k}") for k, c in enumerate(cells)])
    clean_sum, toxic_sum = "+".join(f"c{k}" for k in range(folds)), "+".join(f"c{k}" for k in range(folds, 2 * folds))
    odds = F.log((F.expr(toxic_sum) + 0.5) / (F.expr(clean_sum) + 0.5))
    counts = counts.where(F.expr(toxic_sum) >= SUPPORT).orderBy(F.desc(odds * F.sqrt(F.expr(toxic_sum))), "stem").limit(LEXICON)
    got = counts.toArrow()  # at most LEXICON rows
    c = np.array([np.asarray(got[f"c{k}"]) for k in range(2 * folds)], np.float64).reshape(2, folds, -1)
    sums = totals.sum(0)
    columns = [log_odds(c[1].sum(0) - c[1][f], c[0].sum(0) - c[0][f], sums[1] - totals[f, 1], sums[0] - totals[f, 0]) for f in range(folds)]
    columns.append(log_odds(c[1].sum(0), c[0].sum(0), sums[1], sums[0]))
    lexicon = Lexicon(np.asarray(got["stem"]).view(np.uint64), np.column_stack(columns))
    shared = spark.sparkContext.broadcast(lexicon)

    def to_rows(batches):
        for batch in batches:
            fold = np.asarray(batch.column(2))
            for lo, hi, low, raw, offsets in _texts(batch, 0):
                x = features(low, raw, offsets, shared.value, fold[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), *[batch.column(k).slice(lo, hi - lo) for k in (1, 2, 3)]], ["x", "y", "fold", "th"])

    def fit_one(table: pa.Table) -> pa.Table:
        import pickle

        table = table.sort_by([("th", "ascending"), ("y", "ascending")])
        x = np.asarray(table["x"].combine_chunks().flatten()).reshape(table.num_rows, -1)
        parts = fitted(x, (np.asarray(table["y"]) > 0).astype(np.float64), np.asarray(table["fold"]))
        return pa.table({"parts": pa.array([pickle.dumps(parts)], pa.binary())})

    made = materialise(rows.mapInArrow(tidy(to_rows), "x array<double>, y int, fold int, th long"))
    import pickle

    parts = pickle.loads(made.groupBy().applyInArrow(fit_one, "parts binary").first()[0])  # at most max_rows rows of some 150 bytes, in one task
    return Model(lexicon, parts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            out = np.empty(batch.num_rows)
            for lo, hi, low, raw, offsets in _texts(batch, 1):
                out[lo:hi] = shared.value.scores(low, raw, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, score double")


def is_held_out():
    """Rows that are never learnt from, by the id alone."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of held-out ids are not learnt from."""
    scored = score(docs, train(docs, labels, train_if=~is_held_out()))
    return scored.select("doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
