"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are hashed 1- and 2-grams of lower-cased tokens (runs of letters and digits, runs of other signs),
counted per text and scaled to unit length (a
token that follows itself is one 2-gram, whichever it is); a score is the logistic of a sparse dot product plus a bias.

Training uses a bounded sample of the labelled rows (`max_rows`, the rows with the smallest id hashes): their
features are made by Spark and written once; each FTRL pass streams them through one task, which holds a batch and
the model. The model has a fixed size (2**bits weights), so its broadcast is bounded. Scoring covers every whole text and needs no shuffle.

Defined cases: a null text counts as empty; an empty text gets the bias's score; a null label is no label; of
several labels of a doc_id the largest holds; with no labelled row at all every score is 0.5; rows that repeat are
scored each; columns of documents that are named score, held_out or predicted give way to the classifier's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, materialise, slices, text_buffer, tidy, token_hashes

BITS = 18
MAX_ROWS = 12_000
PASSES = 3
#: Columns that the classifier gives.
GIVEN = ("score", "held_out", "predicted")
#: Bytes of text whose features are made at once.
SLICE = 2 << 20
#: The hash of a token followed by itself, whichever it is.
REPEAT = np.uint64(0x51_7C_C1_B7_27_22_0A_95)


def features(texts: pa.Array, bits: int = BITS, orders: tuple[int, ...] = (1, 2)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin of each text, bucket, value) of the sparse rows; values of a text have unit length."""
    raw, offsets = text_buffer(pa.compute.utf8_lower(texts.cast(pa.large_string())))
    h, _, tokens = token_hashes(raw, offsets, words_only=False)
    n = len(offsets) - 1
    keys = []
    for order in orders:
        g, at = gram_hashes(h, tokens, order)
        if order == 2 and len(h) > 1:
            same = np.append(h[1:] == h[:-1], False)
            begin = np.repeat(tokens[:-1] - at[:-1], np.diff(at)) + np.arange(at[-1])
            g[same[begin] & (np.repeat(np.diff(tokens), np.diff(at)) > 1)] = REPEAT
        keys.append((np.repeat(np.arange(n, dtype=np.int64), np.diff(at)) << bits) | (g >> np.uint64(64 - bits)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row, col = key >> bits, key & ((1 << bits) - 1)
    at = np.searchsorted(row, np.arange(n + 1))
    value = count.astype(np.float64)
    norm = np.sqrt(np.bincount(row, value * value, n))
    return at, col, value / norm[row]


def ftrl_pass(rows, z: np.ndarray, n: np.ndarray, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> None:
    """FTRL-proximal updates of the state (z, n), whose last entries are the bias's, by (bucket array, value array, label) rows in the given order."""
    bias = len(z) - 1
    for col, value, label in rows:
        i, x = np.append(col, bias), np.append(value, 1.0)
        w = ftrl_weights(z[i], n[i], alpha, beta, l1, l2)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
        z[i] += g - step * w
        n[i] += g * g


def ftrl_weights(z: np.ndarray, n: np.ndarray, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> np.ndarray:
    """Weights that a state stands for."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", train_if=None, max_rows: int = MAX_ROWS, bits: int = BITS, passes: int = PASSES) -> np.ndarray:
    """Weights learnt from at most max_rows of the labelled documents for which train_if (a column over doc_id) holds."""
    known = labels.select("doc_id", F.col(label).cast("double").alias("y")).where("y is not null and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    known = known.where(train_if) if train_if is not None else known
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_rows rows of 16 bytes

    def to_rows(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text"), SLICE):
                part = batch.slice(lo, hi - lo)
                at, col, value = features(part.column("text"), bits)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array([col[a:b].astype("<i4").tobytes() for a, b in zip(at, at[1:])], pa.binary()), pa.array([value[a:b].astype("<f4").tobytes() for a, b in zip(at, at[1:])], pa.binary())], ["doc_id", "y", "cols", "vals"])

    made = materialise(rows.mapInArrow(tidy(to_rows), "doc_id long, y double, cols binary, vals binary"))
    # an order that does not depend on the ids' own; documents that repeat an id are told apart by their features
    dealt = made.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(7)), "doc_id", F.xxhash64("cols", "vals")).select("y", "cols", "vals")
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for _ in range(passes):
        # the state has a fixed size: it goes to the one task of a pass and comes back
        state = docs.sparkSession.sparkContext.broadcast((z, n))

        def one_pass(batches, state=state):
            z, n = (x.copy() for x in state.value)
            for batch in batches:
                ys, cols, vals = (batch.column(c) for c in ("y", "cols", "vals"))
                ftrl_pass(((np.frombuffer(c.as_buffer(), "<i4"), np.frombuffer(v.as_buffer(), "<f4"), y.as_py()) for y, c, v in zip(ys, cols, vals)), z, n)
            yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["z", "n"])

        found = dealt.mapInArrow(tidy(one_pass), "z binary, n binary").collect()
        state.unpersist()
        if found:
            z, n = (np.frombuffer(x) for x in found[0])
    return ftrl_weights(z, n).astype("<f4")


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep and text's score (0 to 1) for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    keep = tuple(c for c in dict.fromkeys(keep) if c not in GIVEN)
    at_text = keep.index("text") if "text" in keep else len(keep)
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", score double"

    def run(batches):
        w = shared.value
        for batch in batches:
            texts = batch.column(at_text)
            scores = np.empty(len(texts))
            for lo, hi in slices(texts, SLICE):
                at, col, value = features(texts.slice(lo, hi - lo), bits)
                row = np.repeat(np.arange(hi - lo), np.diff(at))
                scores[lo:hi] = np.bincount(row, w[col] * value, hi - lo) + w[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(1 / (1 + np.exp(-np.clip(scores, -35, 35))))], [*keep, "score"])

    # a text that is kept anyway is not sent twice
    return docs.select(*keep, *([] if "text" in keep else [F.col("text").alias("__text")])).mapInArrow(tidy(run), out_schema)


def is_held_out():
    """Rows that are never learnt from, by the id alone."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, held_out, score and predicted of every document; labels of held-out ids are not learnt from."""
    weights = train(docs, labels, train_if=~is_held_out())
    out = score(docs, weights, keep=("doc_id", *keep))
    return out.select("*", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted"))
