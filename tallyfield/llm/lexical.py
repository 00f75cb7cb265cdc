"""Ranked lexical search: documents grouped by the mask of query terms they hold, masks taken by descending bound.

A term is a run of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased, in the whole text. For a
block of items, one pass over all documents writes each document's length and the terms of the block that it holds,
with their counts; document frequencies, the number of documents and their length are aggregates of that table. A second pass ranks:
a task takes some thousand documents at a time and keeps, for each term, a bitmap of the documents that hold it and the largest
amount that it adds to any of their scores. For each item, the bitmaps of terms without which the least score of
the best k can't be reached are left out of the union of candidates; the candidates' bits are turned into one mask a document, and
distinct masks, each with the sum of its terms' largest amounts, are evaluated in descending order of that sum. It
is safe to stop once the sum lies below the k-th best score. So k rows an item and task are shuffled, ranked by item.

Items come in blocks of at most ITEMS items and TERMS terms (one item at least), one index and ranking pass a block, so that what is
broadcast has a bounded size however many items there are. Terms are told apart by 64-bit hashes: some other term of a
corpus of 10**10 distinct ones is taken for one of 10**4 query terms with a chance of 5 in 10**6.

Defined cases: null texts and texts without terms are no documents and no items; terms that an item repeats count as often;
each row of items is an item, whether or not its id is null or repeats; rows of documents that repeat are ranked each; equal scores go
by ascending doc_id, null ids last; scores of 0 are left out; an empty table on either side gives no rows; columns other than
doc_id, item_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _CLASSES, materialise, slices, text_buffer, tidy, token_hashes

K, ITEMS, TERMS = 20, 256, 1 << 17
#: Cells of the table of terms x documents that a task holds at once, and documents at most.
CELLS, CHUNK = 1 << 25, 8192
#: The doc_id that null ids sort as.
LAST = np.iinfo(np.int64).max


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and the term at which each text begins (one more for the end)."""
    raw, offsets = text_buffer(texts)
    h, s, at = token_hashes(np.where((raw >= 65) & (raw <= 90), raw | 32, raw), offsets, words_only=False)
    word = _CLASSES[raw[s]] == 1 if len(s) else np.zeros(0, bool)
    return h[word], np.concatenate([[0], np.cumsum(word)])[at]


def blocks(items: DataFrame, most_items: int = ITEMS, most_terms: int = TERMS):
    """Lists of (item number, item_id, distinct terms, how often the item has each), of bounded size; items are not held beyond their block."""
    held, size = [], 0
    for number, r in enumerate(items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()):
        terms, times = np.unique(terms_of(pa.array([r["text"]]))[0], return_counts=True)
        if held and (len(held) == most_items or size + len(terms) > most_terms):
            yield held
            held, size = [], 0
        if len(terms):
            held.append((number, r["item_id"], terms, times))
            size += len(terms)
    if held:
        yield held


def indexed(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (terms of the text), terms (places in the sorted vocabulary) and times of every document; a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                h, at = terms_of(part.column("text"))
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[place] == h
                own = np.repeat(np.arange(hi - lo), np.diff(at))[hit]
                key, times = np.unique(own * len(known) + place[hit], return_counts=True)
                begin = pa.array(np.searchsorted(key, np.arange(hi - lo + 1) * len(known)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(begin, pa.array(v.astype(np.int32))) for v in (key % len(known), times)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), *lists], ["doc_id", "n", "terms", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = materialise(rows.mapInArrow(tidy(run), "doc_id long, n long, terms array<int>, times array<int>"))
    shared.destroy()
    return out


def weights(index: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term of the vocabulary, number of documents with terms, number of all their terms)."""
    n, total = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # at most TERMS rows
        df[r["term"]] = r["count"]
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64), n, total


class Chunk:
    """Some documents' postings in order of terms, with what each adds to a score, and bitmaps of documents."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, own: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray, documents: int, total: int):
        self.ids, self.size = ids, len(ids)
        lengths, which = np.unique(n, return_inverse=True)
        m = np.array([75 + 25 * int(x) * documents // total for x in lengths], np.int64)[which]
        times = times.astype(np.int64)
        adds = weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[own]))
        order = np.argsort(term, kind="stable")
        self.used, begin = np.unique(term[order], return_index=True)
        row = np.zeros(len(weight), np.int64)
        row[self.used] = np.arange(len(self.used))
        self.row, self.adds = row, adds[order]
        self.key = row[term[order]] * self.size + own[order]
        self.most = np.maximum.reduceat(self.adds, begin) if len(begin) else self.adds
        cells = np.zeros((len(self.used), self.size), bool)
        cells.ravel()[self.key] = True
        self.bits = np.packbits(cells, axis=1)

    def scores(self, rows: np.ndarray, times: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of docs for the terms of rows, each counting times."""
        want = rows[:, None] * self.size + docs
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return (np.where(self.key[at] == want, self.adds[at], 0) * times[:, None]).sum(axis=0)

    def best(self, terms: np.ndarray, times: np.ndarray, before: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best of this chunk and of those before."""
        here = np.isin(terms, self.used, assume_unique=True)
        rows, times = self.row[terms[here]], times[here]
        bound = self.most[rows] * times
        order = np.argsort(bound, kind="stable")
        rows, times, bound = rows[order], times[order], bound[order]
        least = int(before[0][k - 1]) if len(before[0]) == k else 1
        # terms that together stay below the least score lead no document among the best on their own
        needed = int(np.searchsorted(np.cumsum(bound), least))
        if needed == len(rows):
            return before
        among = np.bitwise_or.reduce(self.bits[rows[needed:]], axis=0)
        docs = np.flatnonzero(np.unpackbits(among, count=self.size))
        held = np.unpackbits(self.bits[rows], axis=1, count=self.size)[:, docs]
        masks = np.ascontiguousarray(np.packbits(held, axis=0).T)
        width = -(-masks.shape[1] // 8) * 8
        whole = np.zeros((len(docs), width), np.uint8)
        whole[:, : masks.shape[1]] = masks
        _, first, group = np.unique(whole.view(np.uint64).ravel() if width == 8 else whole.view(np.dtype((np.void, width))).ravel(), return_index=True, return_inverse=True)
        most = bound @ held[:, first].astype(np.int64)
        rank = np.argsort(-most, kind="stable")
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        by_mask = np.argsort(place[group], kind="stable")  # documents, those of the best mask first
        reach = most[group[by_mask]]
        done, step = 0, 4 * k
        while done < len(docs):
            end = min(int(np.searchsorted(-reach, -least, side="right")), done + step)
            if end <= done:
                break
            end = int(np.searchsorted(-reach, -reach[end - 1], side="right"))  # whole masks
            some = docs[by_mask[done:end]]
            score = self.scores(rows, times, some)
            ok = score > 0
            before = _top(np.append(before[0], score[ok]), np.append(before[1], self.ids[some[ok]]), k)
            least = int(before[0][k - 1]) if len(before[0]) == k else 1
            done, step = end, 2 * step
        return before


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def ranked(index: DataFrame, block: list, vocabulary: np.ndarray, k: int = K) -> DataFrame:
    """number, doc_id, score: each task's k best documents of each item of the block; a written table."""
    weight, documents, total = weights(index, len(vocabulary))
    asked = [(number, np.searchsorted(vocabulary, terms), times.astype(np.int64)) for number, _, terms, times in block]
    shared = index.sparkSession.sparkContext.broadcast((weight, asked))

    def run(batches):
        weight, asked = shared.value
        most = max(64, min(CHUNK, CELLS // max(len(weight), 1)))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asked)
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                part = batch.slice(lo, most)
                ids = np.asarray(part.column("doc_id").fill_null(LAST))
                own = np.asarray(pa.compute.list_parent_indices(part.column("terms"))).astype(np.int64)
                if not len(own):
                    continue
                chunk = Chunk(ids, np.asarray(part.column("n")), own, np.asarray(part.column("terms").flatten()), np.asarray(part.column("times").flatten()), weight, documents, total)
                found = [chunk.best(terms, times, before, k) for (_, terms, times), before in zip(asked, found)]
        n = [len(s) for s, _ in found]
        if sum(n):
            ids = np.concatenate([i for _, i in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([x[0] for x in asked], n).astype(np.int64)), pa.array(ids, mask=ids == LAST), pa.array(np.concatenate([s for s, _ in found]))], ["number", "doc_id", "score"])

    out = materialise(index.select("doc_id", "n", "terms", "times").mapInArrow(tidy(run), "number long, doc_id long, score long"))
    shared.destroy()
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K, most_items: int = ITEMS, most_terms: int = TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, number long, doc_id long, score long")
    for block in blocks(items, most_items, most_terms):
        vocabulary = np.unique(np.concatenate([terms for _, _, terms, _ in block]))
        best = ranked(indexed(docs, vocabulary), block, vocabulary, k)
        names = spark.createDataFrame([(number, item_id) for number, item_id, _, _ in block], "number long, item_id long")
        found = found.unionByName(best.join(F.broadcast(names), "number"))  # at most ITEMS rows
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
