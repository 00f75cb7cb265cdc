"""What the training-data operators share: shared storage, token hashing and connected components."""

from __future__ import annotations

import ctypes
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where tables go when the session names no spark.checkpoint.dir (tests on one machine).
LOCAL_SHARED = "file:///tmp/checkpoints/tallyfield"
#: Rows up to which a table of ids (8 to 40 bytes a row) may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

#: Byte classes: 0 white space (x09-x0D, x20), 1 letters, digits and every byte over x7F, 2 the rest.
_CLASSES = np.full(256, 2, np.uint8)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _CLASSES[_lo:_hi] = 1
_CLASSES[[0x20, *range(0x09, 0x0E)]] = 0
#: One class for all that is not white space.
_WORDS = (_CLASSES > 0).astype(np.uint8)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one that driver and executors share."""
    base, master = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.master", "")
    if base is None and not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    base = base or LOCAL_SHARED
    return f"{base.rstrip('/')}/tallyfield-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends there, and losing an executor loses nothing."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows; df must be cheap to count (a written table)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def open_fs(uri: str):
    """(file system, path) of a URI, through Arrow, so that any store that Arrow reaches works."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def tidy(run):
    """run, a function over the batches of a task, that gives unused memory back at the task's end: Spark keeps its Python workers."""

    def kept(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return kept


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULT, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(4096)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins (one more for the end). Null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(texts) else raw[:0], offsets - offsets[0]


def token_hashes(raw: np.ndarray, offsets: np.ndarray, words_only: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, the first byte of each, and the token at which each text begins (one more for the end).

    A token is a run without white space (words_only), or a run of letters and digits or of other signs.
    The bytes are worked through in pieces of about 1 MB that end at white space, so memory stays bounded
    by the piece except for a single token longer than that.
    """
    global _POWERS
    table = _WORDS if words_only else _CLASSES
    begins = np.zeros(len(raw) + 1, bool)
    begins[offsets[:-1]] = True
    hashes, starts, lo = [], [], 0
    while lo < len(raw):
        hi = min(len(raw), lo + _PIECE)
        while hi < len(raw) and not begins[hi]:
            nxt = raw[hi : hi + 4096]
            gap = np.flatnonzero((table[nxt] == 0) | begins[hi : hi + len(nxt)])
            hi += int(gap[0]) if len(gap) else len(nxt)
            if len(gap):
                break
        piece = raw[lo:hi]
        kind = table[piece]
        first = begins[lo:hi].copy()
        first[0] = True
        first[1:] |= kind[1:] != kind[:-1]
        first &= kind != 0
        at = np.flatnonzero(first)
        if len(at):
            length = np.diff(np.append(at, len(piece)))
            if (longest := int(length.max())) > len(_POWERS):
                _POWERS = _powers(2 * longest)
            pos = np.arange(at[0], len(piece)) - np.repeat(at, length)
            value = np.where(kind[at[0] :] != 0, piece[at[0] :].astype(np.uint64) + np.uint64(1), np.uint64(0)) * _POWERS[pos]
            hashes.append(np.add.reduceat(value, at - at[0]))
            starts.append(at + lo)
        lo = hi
    h = mix64(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return h, s, np.searchsorted(s, offsets)


def gram_hashes(h: np.ndarray, tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each text, and where each text's begin. A text of 1 to n-1 tokens has one gram of all it has."""
    counts = np.diff(tokens)
    k = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(k)]).astype(np.int64)
    text = np.repeat(np.arange(len(counts)), k)
    begin = tokens[:-1][text] + np.arange(out_at[-1]) - out_at[:-1][text]
    g = np.zeros(len(begin), np.uint64)
    end = tokens[1:][text]
    for j in range(n):
        inside = begin + j < end
        g = (g * _MULT + np.where(inside, h[np.minimum(begin + j, max(len(h) - 1, 0))], np.uint64(7))) if len(h) else g
        g ^= g >> np.uint64(29)
    return mix64(g), out_at


def slices(texts: pa.Array, most_bytes: int = 4 << 20):
    """(start, stop) row ranges of about most_bytes of text, one row at least."""
    sizes = np.asarray(pa.compute.binary_length(texts.cast(pa.large_string())).fill_null(0))
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + most_bytes, side="right")))
        yield lo, hi
        lo = hi


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node of each connected component, for every node of an edge other than a loop.

    Alternating large-star and small-star steps: each step points nodes at their smallest neighbour, so the edge
    count never grows and the number of rounds is logarithmic. Neighbour minima are partial aggregates and the
    joins are plain equi-joins (a node with very many neighbours is split by AQE's skew join); each round is
    written to the shared folder. Only two numbers a round reach the driver. Empty input: no rows.
    """
    e = materialise(edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("x"))
        e = materialise(small.select("x.u", "x.v").where("u != v").distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
