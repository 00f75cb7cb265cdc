"""N-gram Jaccard join with Bayesian candidate pruning, and the near-duplicate classes it gives.

A text is the set of its five-word shingles (lower-cased words, split at ASCII white space; a shorter text is one
shingle). Texts with equal sets are one node, so copies are never paired. The join runs in these steps:

1. one pass over the texts: node (128-bit digest of the set) and 100 MinHash values;
2. banding (25 bands of 4 values: a pair with similarity 0.8 is missed once in 500,000): buckets of up to
   `pair_bucket` nodes give candidate pairs; larger buckets give one edge a node, to the bucket's smallest node;
3. candidate pairs are compared a few MinHash values at a time and dropped once the posterior probability
   (uniform prior) that their similarity reaches the threshold falls below `tolerance`;
4. connected components of what is left are neighbourhoods; each node's text travels once to its neighbourhood,
   and a neighbourhood of over `block` nodes is cut into blocks, one task for each pair of blocks;
5. in a task every pair is pruned as in 3. and the rest verified by exact Jaccard. A task gives each node's number of
   links and its local root, never the pairs; roots of cut neighbourhoods are joined by components once more.

The exact count of links within a group of m different near copies takes m*m/2 comparisons, in blocks spread over
tasks; what is shuffled stays linear in m up to the factor m / block.

Defined cases: null texts count as empty; texts without words are copies of each other; null doc_ids keep their rows;
repeated rows are copies; an empty table gives no rows; other columns are kept by keep_one() and ignored by join(), whatever their names. The
class id is the smallest doc_id of the class.
"""

from __future__ import annotations

from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, gram_hashes, materialise, mix64, slices, small_or_shuffled, text_buffer, tidy, token_hashes

WORDS, THRESHOLD = 5, 0.8
ROWS, BANDS, TOLERANCE, STEP = 4, 25, 1e-6, 10
_RNG = np.random.default_rng(20)
_A = (_RNG.integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text end to end, and where each text's begin."""
    raw, offsets = text_buffer(pa.compute.utf8_lower(texts.cast(pa.large_string())))
    h, _, tokens = token_hashes(raw, offsets)
    g, at = gram_hashes(h, tokens, words)
    sets = [np.unique(g[a:b]) for a, b in zip(at, at[1:])]
    return (np.concatenate(sets) if sets else g), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def minhashes(g: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of each set; those of an empty set are all ones."""
    out = np.full((len(at) - 1, len(_A)), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(at))
    lo = 0
    while lo < len(full):  # some 30,000 shingles at a time stay in the cache
        hi = max(lo + 1, int(np.searchsorted(at[full + 1], at[full[lo]] + 30_000, side="right")))
        hi = min(hi, len(full))
        part, begin = g[at[full[lo]] : at[full[hi - 1] + 1]], at[full[lo:hi]] - at[full[lo]]
        for k in range(len(_A)):
            out[full[lo:hi], k] = np.minimum.reduceat(((part * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), begin)
        lo = hi
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, n: int = ROWS * BANDS, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is dropped).

    With a uniform prior, after m matches in n values the similarity is Beta(m+1, n-m+1), so
    P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    out = []
    for k in range(step, n + 1, step):
        tail, m = 0.0, 0
        while (tail := tail + comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)) < tolerance:
            m += 1
        out.append((k, m))
    return out


def _sig(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, len(_A))


def surviving(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs (a[i], b[j]) of signatures that are never dropped."""
    alive, matches, done = np.arange(len(i)), np.zeros(len(i), np.int32), 0
    for n, least in cuts:
        if not len(alive):
            break
        matches = matches + (a[i[alive], done:n] == b[j[alive], done:n]).sum(axis=1, dtype=np.int32)
        ok = matches >= least
        alive, matches, done = alive[ok], matches[ok], n
    return alive


def exact(sets_i: list[np.ndarray], sets_j: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (sets_i[i], sets_j[j]) of sorted distinct hashes."""
    if len(i) < 4 * (len(sets_i) + len(sets_j)):
        return np.array([len(np.intersect1d(sets_i[x], sets_j[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    # many pairs of few sets: products of 0/1 matrices over the hashes that both sides have, some columns at a time
    left, right = np.concatenate(sets_i), np.concatenate(sets_j)
    both = np.intersect1d(left, right)
    inter = np.zeros((len(sets_i), len(sets_j)), np.float32)
    for lo in range(0, len(both), 4096):
        part = both[lo : lo + 4096]

        def matrix(sets, part=part):
            out = np.zeros((len(sets), len(part)), np.float32)
            for r, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], side="right")]
                out[r, np.flatnonzero(np.isin(part, s, assume_unique=True))] = 1
            return out

        x = matrix(sets_i)
        inter += x @ (x if sets_i is sets_j else matrix(sets_j)).T
    return inter[i, j].astype(np.int64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(i.tolist(), j.tolist()):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    return np.array([find(x) for x in range(n)], int)


def links_of(ids: list, copies: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], first: np.ndarray | None, threshold: float, cuts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of linked nodes, of their documents, local root) of each node of one task.

    first: marks the nodes of the first of two blocks, whose pairs alone count; None: all pairs count.
    """
    n = len(ids)
    counts, docs, edges_i, edges_j = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
    rows = np.arange(n) if first is None else np.flatnonzero(first)
    cols = np.arange(n) if first is None else np.flatnonzero(~first)
    size = np.array([len(s) for s in sets], np.int64)
    for lo in range(0, len(rows), 256):
        r = rows[lo : lo + 256]
        i, j = (x.ravel() for x in np.meshgrid(r, cols, indexing="ij"))
        ok = (i < j) if first is None else np.ones(len(i), bool)
        ok &= np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
        i, j = i[ok], j[ok]
        s = surviving(sig, sig, i, j, cuts)
        i, j = i[s], j[s]
        if not len(i):
            continue
        inter = exact(sets, sets, i, j)
        ok = inter >= threshold * (size[i] + size[j] - inter) - 1e-9
        i, j = i[ok], j[ok]
        for x, y in ((i, j), (j, i)):
            counts += np.bincount(x, minlength=n)
            docs += np.bincount(x, copies[y], n).astype(np.int64)
        edges_i.append(i)
        edges_j.append(j)
    root = _roots(n, np.concatenate(edges_i), np.concatenate(edges_j)) if edges_i else np.arange(n)
    return counts, docs, root


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, th (hash of the text), node, sig of every row."""

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                g, at = shingle_sets(part.column("text"), words)
                sig = minhashes(g, at)
                node = np.zeros((hi - lo, 2), np.uint64)
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    node[full, 0] = np.add.reduceat(mix64(g), at[full])
                    node[full, 1] = np.bitwise_xor.reduceat(mix64(g + np.uint64(0x5851F42D4C957F2D)), at[full])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array([x.tobytes() for x in node], pa.binary()), pa.array([x.astype("<u4").tobytes() for x in sig], pa.binary())], ["doc_id", "th", "node", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, th long, node binary, sig binary")


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            sig = _sig(batch.column("sig")).reshape(batch.num_rows, BANDS, ROWS).astype(np.uint64)
            key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
            for r in range(ROWS):
                key = mix64(key ^ sig[:, :, r]) if r else mix64(key + sig[:, :, r])
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(tidy(run), "key long, node binary")


def _pruned(pairs: DataFrame, cuts) -> DataFrame:
    def run(batches):
        for batch in batches:
            at = np.arange(batch.num_rows)
            ok = surviving(_sig(batch.column("su")), _sig(batch.column("sv")), at, at, cuts)
            yield batch.select(["u", "v"]).take(pa.array(ok))

    return pairs.mapInArrow(tidy(run), "u binary, v binary")


def dealt(members: DataFrame, group: str, node: str, block: int) -> DataFrame:
    """members (a written table) with blocks, b, bi, bj and task, so that a task sees whole small groups or two blocks.

    Groups of at most block members are packed by hash, about block members a task. A larger one is cut into blocks by
    the members' hashes; each member goes to the task of every pair of blocks that has its own.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("__n"))
    out = members.join(sizes, group).withColumn("blocks", F.ceil(F.col("__n") / block).cast("int")).drop("__n")
    out = out.withColumn("b", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
    out = out.withColumn("__o", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    out = out.withColumn("bi", F.least("b", "__o")).withColumn("bj", F.greatest("b", "__o")).drop("__o")
    packs = max(1, ceil(members.count() / block))
    return out.withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(group), F.lit(packs))).otherwise(F.xxhash64(group, "bi", "bj")))


def join(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, pair_bucket: int = 32, block: int = 512) -> DataFrame:
    """doc_id, th, class_id, n_links (other documents at least this similar), n_text_links (the same over different
    shingle sets), keep (true for the smallest (doc_id, th) of the class) of every row."""
    cuts = least_matches(threshold, tolerance)
    rows = materialise(signatures(docs, words))
    nodes = materialise(rows.groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th")).alias("rep"), F.min("sig").alias("sig")))
    bands = _bands(nodes)
    buckets = materialise(bands.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low")).where("n > 1"))
    held = materialise(bands.join(small_or_shuffled(buckets), "key"))
    pair = "flatten(transform(sequence(0, size(a) - 2), i -> transform(slice(a, i + 2, size(a)), y -> struct(a[i] as u, y as v))))"
    few = held.where(F.col("n") <= pair_bucket).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("a"))  # lists of at most pair_bucket
    pairs = few.select(F.explode(F.expr(pair)).alias("p")).select("p.*").distinct()
    signed = nodes.select("node", "sig")
    pairs = pairs.join(signed.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u").join(signed.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v")
    stars = held.where(F.col("n") > pair_bucket).select(F.col("node").alias("u"), F.col("low").alias("v")).distinct()
    near = materialise(components(_pruned(pairs, cuts).unionByName(stars)))

    # each neighbourhood's nodes with text and signature, to one task or one for each pair of blocks
    placed = dealt(near, "component", "node", block)
    placed = placed.join(nodes.select("node", "copies", "rep", "sig"), "node").select("*", F.col("rep.doc_id").alias("r_id"), F.col("rep.th").alias("r_th")).drop("rep")
    # a text is fetched once a node (copies of a row have the same hash) before the blocks multiply it
    wanted = materialise(placed)
    asked = small_or_shuffled(materialise(wanted.select("r_id", "r_th").distinct()))
    texts = docs.select(F.col("doc_id").cast("long").alias("r_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("r_th", F.xxhash64("text"))
    texts = texts.join(asked.select(F.col("r_id").alias("q_id"), F.col("r_th").alias("q_th")), F.col("r_id").eqNullSafe(F.col("q_id")) & (F.col("r_th") == F.col("q_th"))).dropDuplicates(["q_id", "q_th"]).select("q_id", "q_th", "text")
    full = wanted.join(texts, F.col("r_id").eqNullSafe(F.col("q_id")) & (F.col("r_th") == F.col("q_th"))).select("task", "component", "blocks", "b", "bi", "bj", "node", "copies", "sig", "text")

    def verify(table: pa.Table) -> pa.Table:
        out = {"node": [], "nodes": [], "docs": [], "root": [], "cut": []}
        table = table.sort_by([("component", "ascending"), ("bi", "ascending"), ("bj", "ascending"), ("node", "ascending")])
        names = list(zip(table["component"].to_pylist(), table["bi"].to_pylist(), table["bj"].to_pylist()))
        edges = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        for lo, hi in zip(edges, edges[1:]):
            part = table.slice(lo, hi - lo)
            ids = part["node"].to_pylist()
            g, at = shingle_sets(part["text"].combine_chunks(), words)
            _, bi, bj = names[lo]
            first = None if bi == bj else np.asarray(part["b"]) == bi
            n, d, root = links_of(ids, np.asarray(part["copies"]), _sig(part["sig"]), [g[a:b] for a, b in zip(at, at[1:])], first, threshold, cuts)
            out["node"] += ids
            out["nodes"] += n.tolist()
            out["docs"] += d.tolist()
            out["root"] += [ids[k] for k in root]
            out["cut"] += [part["blocks"][0].as_py() > 1] * len(ids)
        return pa.table({"node": pa.array(out["node"], pa.binary()), "nodes": pa.array(out["nodes"], pa.int64()), "docs": pa.array(out["docs"], pa.int64()), "root": pa.array(out["root"], pa.binary()), "cut": pa.array(out["cut"], pa.bool_())})

    found = materialise(full.groupBy("task").applyInArrow(verify, "node binary, nodes long, docs long, root binary, cut boolean"))
    joined = components(found.where("cut").select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnRenamed("component", "joined")
    per_node = found.groupBy("node").agg(F.sum("nodes").alias("nodes"), F.sum("docs").alias("docs"), F.min("root").alias("root"))
    per_node = per_node.join(joined, "node", "left").select("node", "nodes", "docs", F.coalesce("joined", "root").alias("class"))
    told = nodes.select("node", "copies", "rep").join(per_node, "node", "left").withColumn("class", F.coalesce("class", "node"))
    reps = told.groupBy("class").agg(F.min("rep").alias("top"), F.min("rep.doc_id").alias("class_id"))
    told = told.join(reps, "class").select(F.col("node").alias("n"), "class_id", "top", F.coalesce("nodes", F.lit(0)).alias("n_text_links"), (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"))
    out = rows.join(told, F.col("node") == F.col("n"))
    return out.select("doc_id", "th", "class_id", "n_links", "n_text_links", F.struct("doc_id", "th").eqNullSafe(F.col("top")).alias("keep"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """docs with one row of each class: that with the smallest doc_id (then text hash); of repeated rows, one."""
    kept = join(docs, **how).where("keep").select(F.col("doc_id").alias("id"), "th").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("th")))
    return rows.dropDuplicates(["id", "th"]).select("row.*")
