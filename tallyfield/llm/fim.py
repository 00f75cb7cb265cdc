"""Fill-in-the-middle transformation, cut by word-parallel arithmetic on UTF-8 (SWAR).

A unit is white space (x20, x09-x0D) with the run of other characters after it, or the white space that ends a text. A
batch of texts is one buffer of bytes, viewed as 64-bit words. A byte ends a unit if it is no white space and the next byte is, or
if it is its text's last; those bytes are marked in their high bits by additions that never carry over a byte, eight
bytes at once. Counts of marks (bitwise_count) are summed up over words; the k-th unit's end is found by
searching its word in the sums, then in the word by comparing the byte-wise prefix sums of its marks with the rank.
Characters are counted in the same way, as bytes less UTF-8 continuation bytes.

The draws are hashes of seed and doc_id, made by Spark, which also puts the parts together: only texts go to Python,
and three numbers a text come back. Nothing is shuffled.

Defined cases: a null text counts as empty; an empty text, or one that holds a sentinel, stays plain; a null doc_id draws as an empty
id; repeated rows are cut alike; an empty table gives no rows; columns of docs that are named n, form, prefix_chars,
middle_chars or output give way to the operator's, others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_buffer

SEED, RATE, SPM = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Columns that the operator gives.
GIVEN = ("n", "form", "prefix_chars", "middle_chars", "output")

_ONES = np.uint64(0x0101010101010101)
_HIGH, _LOW = _ONES * np.uint64(0x80), _ONES * np.uint64(0x7F)


def white_marks(x: np.ndarray) -> np.ndarray:
    """The high bit of each byte of x that is white space."""
    low = x & _LOW
    tabs = (low + _ONES * np.uint64(0x80 - 0x09)) & ~(low + _ONES * np.uint64(0x80 - 0x0E)) & ~x  # x09 <= byte < x0E
    other = x ^ (_ONES * np.uint64(0x20))
    blank = ~(((other & _LOW) + _LOW) | other)
    return (tabs | blank) & _HIGH


def continuation_marks(x: np.ndarray) -> np.ndarray:
    """The high bit of each byte 10xxxxxx of x."""
    return x & ~(x << np.uint64(1)) & _HIGH


class Marks:
    """Marked bytes with sums over words: how many lie before a byte, and where the k-th lies."""

    def __init__(self, marks: np.ndarray):
        self.marks = np.append(marks, np.uint64(0))
        self.sums = np.append(0, np.cumsum(np.bitwise_count(marks), dtype=np.int64))

    def before(self, at: np.ndarray) -> np.ndarray:
        """Number of marked bytes before byte at."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return self.sums[word] + np.bitwise_count(self.marks[word] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the marked byte that has k marked ones before it."""
        word = np.searchsorted(self.sums, k, side="right") - 1
        rank = (k - self.sums[word] + 1).astype(np.uint64)
        upto = (self.marks[word] >> np.uint64(7)) * _ONES  # in each byte, marks up to and with it
        reached = ((upto | _HIGH) - rank * _ONES) & _HIGH
        return (word << 3) + 8 - np.bitwise_count(reached).astype(np.int64)


def unit_marks(raw: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """(bytes that end a unit, continuation bytes) of texts that lie end to end."""
    x = np.zeros(len(raw) // 8 + 1, np.uint64)
    x.view(np.uint8)[: len(raw)] = raw
    x = x.astype("<u8", copy=False)
    white = white_marks(x)
    after = white >> np.uint64(8)
    after[:-1] |= white[1:] << np.uint64(56)
    ends = ~white & after & _HIGH
    last = offsets[1:][np.diff(offsets) > 0] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    return Marks(ends), Marks(continuation_marks(x))


def cut(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, characters of the prefix, characters of the middle) of each text; the prefix ends after the smaller and the
    middle after the larger of h1 and h2, each modulo units + 1."""
    raw, offsets = text_buffer(texts)
    ends, inner = unit_marks(raw, offsets)
    start, first = offsets[:-1], ends.before(offsets[:-1])
    n = ends.before(offsets[1:]) - first
    a, b = h1 % (n + 1), h2 % (n + 1)
    at = [np.where(k > 0, ends.select(np.maximum(first + k - 1, 0)) + 1, start) for k in (np.minimum(a, b), np.maximum(a, b))]
    chars = lambda lo, hi: (hi - lo) - (inner.before(hi) - inner.before(lo))
    return n, chars(start, at[0]), chars(at[0], at[1])


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("n", "prefix", "middle")]))
def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    parts = [cut(text.slice(lo, hi - lo), np.asarray(h1)[lo:hi], np.asarray(h2)[lo:hi]) for lo, hi in slices(text)]
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n", "prefix", "middle"])


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32: the first four groups of eight hex digits of the SHA-256 of seed and id."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output.

    rate: per cent of texts that are cut; spm: per cent of those that put the suffix first.
    """
    kept = [c for c in docs.columns if c not in GIVEN]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*kept).alias("row"), text.alias("text"), F.array(*draws(F.col("doc_id"), seed)).alias("h"))
    rows = rows.select("*", _cuts("text", F.col("h")[0], F.col("h")[1]).alias("c"))
    held = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | held | (F.col("h")[2] % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("h")[3] % 100 < spm, "spm").otherwise("psm"))
    one = F.lit(1)
    middle_at = F.col("c.prefix") + one
    prefix, middle = F.substring("text", one, F.col("c.prefix").cast("int")), F.substring("text", middle_at.cast("int"), F.col("c.middle").cast("int"))
    suffix = F.substring("text", (middle_at + F.col("c.middle")).cast("int"), F.length("text"))
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    cut_only = lambda c: F.when(F.col("form") != "plain", c)
    return rows.select("row.*", F.col("c.n").alias("n"), "form", cut_only(F.col("c.prefix")).alias("prefix_chars"), cut_only(F.col("c.middle")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that transform() had, from its output and form."""
    part = F.split(output, "<[PSM]>", -1)
    at = lambda k: F.element_at(part, k)
    return F.when(form == "plain", output).when(form == "psm", F.concat(at(2), at(4), at(3))).otherwise(F.concat(at(3), at(4), at(2)))
