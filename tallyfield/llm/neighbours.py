"""Approximate nearest neighbours by additive quantisation.

A vector is approximated by a sum of codewords, one of each of BOOKS full-dimensional codebooks. Codebooks are fitted
on a bounded sample (`sample` vectors with the smallest id hashes): residual k-means for a start, then rounds of
beam-search encoding and least squares over all codebooks at once. Every vector is encoded by beam search and stored
with its codes and the squared norm of its approximation.

A query's tables hold its dot products with all codewords; the approximate distance to a stored vector is its norm minus
twice the sum of BOOKS entries. A query's radius is the approximate distance within which a share of the sample lies (SHARE,
but at least RERANK of all rows): what lies within it, in the whole index, is ranked by exact Euclidean distance in double
precision. So the shortlist is one for the index, however its rows are dealt to tasks. Each task keeps its best k a query
while it streams over its vectors, so k rows a query and task are shuffled; queries come in blocks of bounded size, one
pass over the index a block, and a block's vectors are given up when its pass is written.

Defined cases: vectors that are null, zero, or hold null, NaN or infinite components take no part, nor do those of a
length other than the most common one, nor null ids; rows with the query's own id are no candidates; a query id that
repeats is asked for its smallest vector; repeated rows are candidates each; ties go to the smaller vec_id; fewer candidates
than k are all returned; columns other than vec_id and embedding are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, tidy

BOOKS, WORDS, BEAM, SAMPLE, ROUNDS = 16, 128, 4, 8192, 3
K, RERANK, SHARE, QUERY_BLOCK = 10, 200, 0.02, 8192


def _scale(x: np.ndarray) -> float:
    """The power of two by which the largest component comes to between 1/2 and 1; codes and orders of distances do not change by it."""
    most = float(np.abs(x).max(initial=0))
    return float(np.ldexp(1.0, int(np.clip(-np.frexp(most)[1], -1000, 1000)))) if most else 1.0


def euclid(d: np.ndarray) -> np.ndarray:
    """Lengths of the rows of d; where squares overflow or vanish, of the row scaled by its largest component."""
    with np.errstate(over="ignore", under="ignore"):
        out = np.sqrt((d**2).sum(1))
    odd = np.flatnonzero(~np.isfinite(out) | (out < 1e-140))
    if len(odd):
        most = np.abs(d[odd]).max(1, initial=0)
        unit = np.where(most > 0, most, 1)
        out[odd] = unit * np.sqrt(((d[odd] / unit[:, None]) ** 2).sum(1))
    return out


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (uint8) of the rows of x: the best of `beam` partial sums is kept after each codebook."""
    s = _scale(books)
    x = x * s
    kind = np.float32 if np.abs(x).max(initial=0) < 1e15 else np.float64  # squares of outliers must not overflow
    x, books = x.astype(kind), (books * s).astype(kind)
    n, (m, k, d) = len(x), books.shape
    out = np.empty((n, m), np.uint8)
    norms = (books**2).sum(2)
    for lo in range(0, n, 1024):
        rest = x[lo : lo + 1024, None, :]
        codes = np.zeros((len(rest), 1, 0), np.uint8)
        rows = np.arange(len(rest))[:, None]
        for b in range(m):
            cost = (rest**2).sum(2)[:, :, None] - 2 * (rest @ books[b].T) + norms[b]
            flat = cost.reshape(len(rest), -1)
            keep = np.argpartition(flat, min(beam, flat.shape[1]) - 1, axis=1)[:, : min(beam, flat.shape[1])]
            from_, word = keep // k, keep % k
            rest = rest[rows, from_] - books[b][word]
            codes = np.concatenate([codes[rows, from_], word[:, :, None].astype(np.uint8)], 2)
        out[lo : lo + 1024] = codes[np.arange(len(rest)), (rest**2).sum(2).argmin(1)]
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(books[b][codes[:, b]] for b in range(len(books)))


def fit(x: np.ndarray, m: int = BOOKS, k: int = WORDS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (m, k, d) of the rows of x."""
    rng, rest = np.random.default_rng(20), x.copy()
    books = np.zeros((m, k, x.shape[1]))
    for b in range(m):
        c = rest[rng.choice(len(rest), k, replace=len(rest) < k)]
        for _ in range(8):
            a = ((c**2).sum(1) - 2 * rest @ c.T).argmin(1)
            n = np.bincount(a, minlength=k)
            sums = np.zeros_like(c)
            np.add.at(sums, a, rest)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        books[b] = c
        rest = rest - c[((c**2).sum(1) - 2 * rest @ c.T).argmin(1)]
    for _ in range(rounds):
        codes = encode(x, books)
        at = codes.astype(np.int64) + np.arange(m) * k
        hot = np.zeros((len(x), m * k))
        hot[np.arange(len(x))[:, None], at] = 1
        books = np.linalg.solve(hot.T @ hot + 1e-2 * np.eye(m * k), hot.T @ x + 1e-2 * books.reshape(m * k, -1)).reshape(books.shape)
    return books


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    ok = "embedding is not null and vec_id is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(ok)
    # one row per length of vector
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("embedding") == (common["d"] if common else 0))


def _matrix(column) -> np.ndarray:
    values = column.flatten()
    return np.asarray(values, np.float64).reshape(len(column), -1)


def build(vectors: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, np.ndarray | None]:
    """The index (vec_id, embedding, codes, norm; a written table) and its codebooks."""
    rows = usable(vectors)

    def fit_one(table: pa.Table) -> pa.Table:
        x = _matrix(table.sort_by("vec_id")["embedding"].combine_chunks())
        return pa.table({"books": pa.array([(fit(x * _scale(x)) / _scale(x)).astype("<f8").tobytes()], pa.binary())})

    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    got = taken.groupBy().applyInArrow(fit_one, "books binary").collect()
    if not got:
        return rows.select("vec_id", "embedding", F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("norm")), None
    books = np.frombuffer(got[0][0], "<f8").reshape(BOOKS, WORDS, -1)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("embedding"))
            codes = encode(x, shared.value)
            norm = (decode(codes, shared.value * _scale(shared.value)) ** 2).sum(1)  # in the scale of the codebooks
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm)], ["vec_id", "embedding", "codes", "norm"])

    return materialise(rows.mapInArrow(tidy(run), "vec_id long, embedding array<double>, codes binary, norm double")), books


def _distances(tables: np.ndarray, codes: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Approximate squared distances, less the query's own norm, of queries (rows) and stored vectors."""
    dist = np.broadcast_to(norm, (len(tables), len(codes))).copy()
    for m in range(codes.shape[1]):
        dist -= 2 * tables[:, m][:, codes[:, m]]
    return dist


def _tables(q: np.ndarray, books: np.ndarray) -> np.ndarray:
    s = _scale(books)
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num(np.clip(np.einsum("qd,mkd->qmk", q * s, books * s), -1e30, 1e30)).astype(np.float32)


def _codes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def search(index: DataFrame, books: np.ndarray | None, queries: DataFrame, k: int = K, rerank: int = RERANK, share: float = SHARE, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query (vec_id, embedding)."""
    spark, found = index.sparkSession, None
    empty = spark.createDataFrame([], "query_id long, vec_id long, score double")
    n = index.count()
    some = index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("codes", "norm").collect() if books is not None else []  # at most sample rows of 24 bytes
    held: list = []
    if some:
        rank = min(len(some), int(np.ceil(max(share, (rerank + 1) / n) * len(some))))
        shared = spark.sparkContext.broadcast((books, _codes([r["codes"] for r in some]), np.array([r["norm"] for r in some], np.float32)))

        def radii(batches):
            books, codes, norm = shared.value
            for batch in batches:
                out = []
                for lo in range(0, batch.num_rows, 256):
                    dist = _distances(_tables(_matrix(batch.column("embedding").slice(lo, 256)), books), codes, norm)
                    out.append(np.partition(dist, rank - 1, axis=1)[:, rank - 1] if rank < len(norm) or len(norm) < n else np.full(len(dist), np.inf))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out).astype(np.float64))], [*batch.schema.names, "radius"])

        asked = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).mapInArrow(tidy(radii), "vec_id long, embedding array<double>, radius double")
        for r in asked.orderBy("vec_id").toLocalIterator():
            held.append(tuple(r))
            if len(held) == QUERY_BLOCK:
                found, held = _searched(found, index, books, held, k), []
    found = _searched(found, index, books, held, k) if held else found
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found if found is not None else empty).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _searched(before: DataFrame | None, index: DataFrame, books: np.ndarray, asked: list, k: int) -> DataFrame:
    """before and each task's k best of a block of queries (id, vector, radius), written."""
    block = index.sparkSession.sparkContext.broadcast((books, np.array([r[0] for r in asked]), np.array([r[1] for r in asked], np.float64), np.array([r[2] for r in asked], np.float32)))

    def run(batches):
        books, ids, q, radius = block.value
        tables = _tables(q, books)
        best: list = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                vec, x = np.asarray(part.column("vec_id")), _matrix(part.column("embedding"))
                codes, norm = _codes(part.column("codes").to_pylist()), np.asarray(part.column("norm")).astype(np.float32)
                for at in range(0, len(ids), 256):
                    dist = _distances(tables[at : at + 256], codes, norm)
                    for i in range(len(dist)):
                        near = np.flatnonzero((dist[i] <= radius[at + i]) & (vec != ids[at + i]))
                        s = euclid(x[near] - q[at + i])
                        s, v = np.concatenate([best[at + i][0], s]), np.concatenate([best[at + i][1], vec[near]])
                        top = np.lexsort((v, s))[:k]
                        best[at + i] = (s[top], v[top])
        n = [len(s) for s, _ in best]
        if sum(n):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.concatenate([v for _, v in best])), pa.array(np.concatenate([s for s, _ in best]))], ["query_id", "vec_id", "score"])

    part = materialise(index.mapInArrow(tidy(run), "query_id long, vec_id long, score double"))
    block.destroy()
    return part if before is None else before.unionByName(part)
