"""Benchmark decontamination: BM25 index of test items, block-max WAND, then overlap of question and answer.

Test items are cut into segments of at most SEGMENT words, each a document of an inverted index with BM25 impacts
(idf, tf and lengths over all items) divided by the segment's own full score, so a passage that holds a segment
scores 1 and one threshold serves all. Every training text is read whole, in passages of 2 * STRIDE words that begin
each STRIDE words: a run of STRIDE words lies wholly in some passage. For each passage and block of segments the sum of
its terms' largest impacts in the block bounds the score (for all passages of a batch at once); blocks that may reach
the threshold are searched by WAND with the block's maxima as bounds. Found items are verified against the passage and
its surroundings: the shares of the question's and of the answer's word n-grams that occur there. An item of one
text has its first half as question and its second as answer. An item of fewer than 2 * GRAM words counts where its words
stand in a row, all of them: its halves are too short for n-grams.

The index goes to every task in shards of at most SHARD segments (some MB); several shards are several sweeps over
the texts, each adding to the hits so far. No text is shuffled.

Defined cases: null and empty texts hit nothing; items without words are left out; repeated items each count; an
empty benchmark leaves all texts without hits; rows that repeat are scanned each; other columns of docs stay, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _CLASSES, gram_hashes, slices, text_buffer, tidy, token_hashes, unused

K1, B = 1.2, 0.75
SEGMENT, STRIDE, SHARD, BLOCK = 64, 64, 2048, 4
SCORE, OVERLAP, GRAM = 0.7, 0.5, 4
HITS = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased runs of letters and digits, and where each text's begin."""
    raw, offsets = text_buffer(pa.compute.utf8_lower(texts.cast(pa.large_string())))
    h, s, at = token_hashes(raw, offsets, words_only=False)
    word = _CLASSES[raw[s]] == 1 if len(s) else np.zeros(0, bool)
    return h[word], np.concatenate([[0], np.cumsum(word)])[at]


def _grams(h: np.ndarray, n: int = GRAM) -> np.ndarray:
    return gram_hashes(h, np.array([0, len(h)]), n)[0]


class Index:
    """Inverted index of one shard of segments."""

    def __init__(self, segments: list[tuple[int, int]], items: list[tuple[int, np.ndarray, np.ndarray]], df: dict[int, int], n: int, mean: float):
        """segments: (place in items, first word); items: (item_id, question words, answer words)."""
        self.items = []
        for i, q, a in items:
            length = len(q) + len(a)
            short = _grams(np.concatenate([q, a]), length) if length < 2 * GRAM else None
            self.items.append((i, *((_grams(q), _grams(a)) if short is None else (short, short)), length))
        self.item_of = np.array([k for k, _ in segments])
        rows = []
        for seg, (k, lo) in enumerate(segments):
            words = np.concatenate(items[k][1:])[lo : lo + SEGMENT]
            terms, tf = np.unique(words, return_counts=True)
            idf = np.array([math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            rows.append((terms, np.full(len(terms), seg), impact / impact.sum()))
        term, seg, impact = (np.concatenate(x) for x in zip(*rows))
        order = np.lexsort((seg, term))
        term, self.seg, self.impact = term[order], seg[order], impact[order]
        self.terms, at = np.unique(term, return_index=True)
        self.at = np.append(at, len(term))
        self.blocks = -(-len(segments) // BLOCK)
        self.block_most = np.zeros((len(self.terms), self.blocks), np.float32)
        np.maximum.at(self.block_most, (np.repeat(np.arange(len(self.terms)), np.diff(self.at)), self.seg // BLOCK), self.impact)
        step = np.repeat(np.arange(len(self.terms)), np.diff(self.at)) * (self.blocks + 1) + self.seg // BLOCK
        every = np.arange(len(self.terms))[:, None] * (self.blocks + 1) + np.arange(self.blocks + 1)
        self.block_at = np.searchsorted(step, every)  # where each term's postings of each block begin
        self.block_most *= np.float32(1 + 1e-6)  # stays a bound in single precision

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The place of each word among the terms; -1 for others."""
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def search(self, terms: np.ndarray, block: int, least: float) -> list[tuple[int, float]]:
        """All (segment, score) of a block with a score of at least `least` for a set of terms: WAND with the block's
        own maxima as the lists' bounds. terms: those with postings in the block."""
        most = self.block_most[terms, block].tolist()
        spans = zip(self.block_at[terms, block].tolist(), self.block_at[terms, block + 1].tolist())
        cursors = [[self.seg[a:b].tolist(), self.impact[a:b].tolist(), 0, m] for (a, b), m in zip(spans, most)]
        found = []
        while True:
            cursors = [c for c in cursors if c[2] < len(c[0])]
            cursors.sort(key=lambda c: c[0][c[2]])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[3]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            seg = cursors[pivot][0][cursors[pivot][2]]
            if cursors[0][0][cursors[0][2]] == seg:
                at = [c for c in cursors if c[0][c[2]] == seg]
                score = sum(c[1][c[2]] for c in at)
                if score >= least - 1e-9:
                    found.append((seg, score))
                for c in at:
                    c[2] += 1
            else:
                for c in cursors[:pivot]:
                    while c[2] < len(c[0]) and c[0][c[2]] < seg:
                        c[2] += 1

    def hits(self, h: np.ndarray, at: np.ndarray, least: float, overlap: float) -> dict[int, dict[int, tuple]]:
        """By text, by item: (score, question's overlap, answer's overlap) of the best verified passage."""
        t = self.lookup(h) if len(h) else np.zeros(0, np.int64)
        chunks = np.maximum(1, -(-np.diff(at) // STRIDE))  # of each text
        c_at = np.concatenate([[0], np.cumsum(chunks)])
        text = np.repeat(np.arange(len(chunks)), np.diff(at))
        chunk = c_at[:-1][text] + (np.arange(len(h)) - at[:-1][text]) // STRIDE
        known = t >= 0
        pair = np.unique(chunk[known] * len(self.terms) + t[known])
        chunk, t = pair // len(self.terms), pair % len(self.terms)
        n, own = int(c_at[-1]), np.repeat(np.arange(len(chunks)), chunks)
        c_begin = np.searchsorted(chunk, np.arange(n + 1))
        # the largest sum of any block's maxima over the terms of each passage's two chunks
        sums = np.zeros((n, self.blocks), np.float32)
        full = np.flatnonzero(np.diff(c_begin))
        for lo in range(0, len(full), 1024):
            f = full[lo : lo + 1024]
            sums[f] = np.add.reduceat(self.block_most[t[c_begin[f[0]] : c_begin[f[-1] + 1]]], c_begin[f] - c_begin[f[0]], axis=0)
        next_same = np.append(own[1:] == own[:-1], False)
        sums[:-1][next_same[:-1]] += sums[1:][next_same[:-1]]
        out: dict[int, dict[int, tuple]] = {}
        for p in np.flatnonzero(sums.max(axis=1, initial=0) >= least - 1e-5):
            if p and own[p - 1] == own[p] and not next_same[p]:
                continue  # the last words of a text lie in the passage before
            terms = np.unique(t[c_begin[p] : c_begin[p + 1 + next_same[p]]])
            blocks = self.block_most[terms]
            open_blocks = np.flatnonzero(blocks.sum(axis=0) >= least - 1e-6).tolist()
            for seg, score in [x for b in open_blocks for x in self.search(terms[blocks[:, b] > 0], b, least)]:
                item_id, q, a, length = self.items[k := int(self.item_of[seg])]
                d = int(own[p])
                lo = at[d] + (p - c_at[d]) * STRIDE
                near = _grams(h[max(at[d], lo - length) : min(at[d + 1], lo + 2 * STRIDE + length)], length if length < 2 * GRAM else GRAM)
                share = lambda g: float(np.isin(g, near).mean()) if len(g) else 1.0  # noqa: E731, B023
                qo, ao = share(q), share(a)
                if qo >= overlap and ao >= overlap:
                    best = out.setdefault(d, {})
                    best[item_id] = max(best.get(item_id, (0.0,)), (float(score), qo, ao))
        return out


def indexes(items: DataFrame, shard: int = SHARD):
    """Indexes of all items, shard segments each. Two passes: word statistics over all items, then the shards."""
    rows = items.where("item_id is not null and text is not null").select("item_id", "text").orderBy("item_id", "text")

    def each():
        for r in rows.toLocalIterator():
            h, _ = words_of(pa.array([r["text"]]))
            if len(h):
                yield r["item_id"], h

    df, n, total = Counter(), 0, 0
    for _, h in each():
        for lo in range(0, len(h), SEGMENT):
            df.update(np.unique(h[lo : lo + SEGMENT]).tolist())
            n, total = n + 1, total + len(h[lo : lo + SEGMENT])
    segments, held = [], []
    for item_id, h in each():
        half = (len(h) + 1) // 2
        held.append((item_id, h[:half], h[half:]))
        segments += [(len(held) - 1, lo) for lo in range(0, len(h), SEGMENT)]
        if len(segments) >= shard:
            yield Index(segments, held, df, n, total / n)
            segments, held = [], []
    if segments:
        yield Index(segments, held, df, n, total / n)


def scan(docs: DataFrame, items: DataFrame, least: float = SCORE, overlap: float = OVERLAP, shard: int = SHARD, into: str = "__hits") -> DataFrame:
    """docs with a column, named by into, of the verified items of each text."""
    df = docs.select("*", F.expr(f"cast(array() as {HITS})").alias(into))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))

    for index in indexes(items, shard):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                texts, before, hits = batch.column(batch.schema.get_field_index("text")), batch.column(batch.num_columns - 1), []
                for lo, hi in slices(texts):
                    found = shared.value.hits(*words_of(texts.slice(lo, hi - lo)), least, overlap)
                    hits += [[{"item_id": i, "score": s, "question_overlap": q, "answer_overlap": a} for i, (s, q, a) in sorted(found.get(d, {}).items())] for d in range(hi - lo)]
                hits = [(old or []) + new for old, new in zip(before.to_pylist(), hits)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hits, kind)], batch.schema.names)

        df = df.mapInArrow(tidy(run), df.schema)
    return df


def contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every verified pair."""
    found = scan(docs.select("doc_id", "text"), items, **how)
    return found.select("doc_id", F.explode("__hits").alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """docs without the texts that hold a test item."""
    hits = unused(docs, "__hits")
    return scan(docs, items, into=hits, **how).where(F.size(hits) == 0).drop(hits)
