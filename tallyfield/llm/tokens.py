"""Token-id output: flat unsigned integer files with 64-bit offsets, and their memory-mapped readers.

Layout. Documents are dealt to partitions by ranges of doc_id and sorted within; each task writes three files,
`<name>.bin` (ids of all its documents end to end, little-endian, 16 bits if the vocabulary fits, else 32),
`<name>.off` (int64, where each document begins in the .bin, one more for the end) and `<name>.doc` (int64
doc_ids). A manifest row per file set, with the partition's base (ids in all partitions before it) as prefix sum
of the partitions' counts, makes the sets one corpus. Names carry a random part, and only a task that commits has
its name in the manifest: a repeated attempt or a lost executor leaves at most files that nothing refers to.

Encoding. A byte-level BPE splits a text before a space that a visible sign follows, so ids of a text are the ids of
such chunks end to end. Chunks repeat; each worker keeps a bounded table of the ids of chunks it has met lately and gives
the tokenizer the others only.

Defined cases: null and empty texts have the end id only; null doc_ids come first (the manifest counts them, so every
other id, the smallest integer too, is itself); rows with equal doc_id are ordered by a hash of the text; columns other
than doc_id and text are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, open_fs, shared_dir, slices, tidy

END_ID = 0
#: Chunks in a generation of a worker's table; it holds two, and drops the older one when the newer is full.
REMEMBERED = 400_000
_ODD_SPACE = re.compile(r" (?![\w!-~])")
#: Letters, then up to two signs other than an apostrophe, which are a piece of their own to the pre-tokenizer.
_SIGNED = re.compile(r"([^\W\d_]+)([^\w\s']{0,2})")
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The signs that stand for bytes in a byte-level vocabulary: visible Latin-1 for themselves, others from U+0100 on in order.
_BYTE_SIGNS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_SPACE = " ".translate(_BYTE_SIGNS)
_CUT = re.compile(r" (?=[\w!-~])")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts as bytes (little-endian, of dtype), the end id not included."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            self.lengths[i] = len(piece)  # in a byte-level vocabulary a sign stands for a byte
        told = json.loads(self.tokenizer.to_str())
        cut = told.get("pre_tokenizer") or {}
        #: Whether texts may be cut at spaces; other tokenizers are given whole texts.
        self.cuts = cut.get("type") == "ByteLevel" and cut.get("use_regex") is True and not cut.get("add_prefix_space") and not told.get("normalizer") and told["model"]["type"] == "BPE"
        self.model, self.code = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
        self.tails: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return self._of(texts, alone=True)
        split = [x.split(" ") if not _ODD_SPACE.search(x) else _CUT.split(x) for x in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set().union(*(x[1:] for x in split)).difference(known)
        fresh = missing.difference(older)  # looks each up in the table, which intersection() would walk through
        known.update((w, older[w]) for w in missing.difference(fresh))
        rest = []
        for w in fresh:
            m = _SIGNED.fullmatch(w)
            if m and m[1].isalpha():
                known[w] = (known.get(m[1]) or older.get(m[1]) or self._word(m[1])) + self._tail(m[2])
            else:
                rest.append(w)
        known.update(zip(rest, self._of([f" {w}" for w in rest])))
        heads = self._of([x[0] for x in split], alone=True)
        return [h + b"".join(map(known.__getitem__, x[1:])) for h, x in zip(heads, split)]

    def _word(self, letters: str) -> bytes:
        """Ids of a space and letters: one piece to the pre-tokenizer, so its model is asked straight away."""
        piece = _SPACE + (letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_SIGNS))
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _tail(self, signs: str) -> bytes:
        if signs not in self.tails:
            self.tails[signs] = self._of([signs], alone=True)[0] if signs else b""
        return self.tails[signs]

    def _of(self, chunks: list[str], alone: bool = False) -> list[bytes]:
        """Ids of each chunk; chunks that begin with a space are encoded end to end and told apart by their bytes."""
        if alone:
            return [np.asarray(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        out = []
        for lo in range(0, len(chunks), 2000):
            part = chunks[lo : lo + 2000]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum([len(c.encode()) for c in part])
            at = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            raw, w = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            out += [raw[a * w : b * w] for a, b in zip([0, *at[:-1]], at)]
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the file sets and returns the manifest: part, name, n_docs, n_null (the first docs), n_tokens, width, base, folder.

    tokenizer is a path that every executor can read. folder: any URI that executors share.
    """
    tokenizer, folder = tokenizer or default_tokenizer(), folder or shared_dir(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        enc, files = _encoder(tokenizer), None
        fs, base = open_fs(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        end = np.array([end_id], enc.dtype).tobytes()
        w, at, n, nulls = enc.dtype.itemsize, 0, 0, 0
        try:
            for batch in batches:
                for lo, hi in slices(batch.column("text")):
                    part = batch.slice(lo, hi - lo)
                    if files is None:
                        fs.create_dir(base, recursive=True)
                        files = [fs.open_output_stream(f"{base}/{name}.{x}") for x in ("bin", "off", "doc")]
                    ids = [x + end for x in enc.encode([t or "" for t in part.column("text").to_pylist()])]
                    begins = at + np.concatenate([[0], np.cumsum([len(x) // w for x in ids])])
                    files[0].write(b"".join(ids))
                    files[1].write(begins[:-1].astype("<i8").tobytes())
                    files[2].write(np.asarray(part.column("doc_id").fill_null(0)).astype("<i8").tobytes())
                    at, n, nulls = int(begins[-1]), n + part.num_rows, nulls + part.column("doc_id").null_count
            if files:
                files[1].write(np.array([at], "<i8").tobytes())
        finally:
            for f in files or ():
                f.close()
        if files:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "name": name, "n_docs": n, "n_null": nulls, "n_tokens": at, "width": w}], pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    done = materialise(dealt.mapInArrow(tidy(run), "part int, name string, n_docs long, n_null long, n_tokens long, width int"))
    # one row a partition: the window is over a few thousand rows at most
    before = F.coalesce(F.expr("sum(n_tokens) over (order by part rows between unbounded preceding and 1 preceding)"), F.lit(0))
    return materialise(done.select("*", before.alias("base"), F.lit(folder).alias("folder")))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, from the files.

    Local files are memory-mapped; from another store 8,192 documents are read at a time.
    """

    def run(batches):
        for batch in batches:
            for m in batch.to_pylist():
                fs, base = open_fs(m["folder"])
                path, w = f"{base}/{m['name']}", m["width"]
                if fs.type_name == "local":
                    ids, offs, docs = (np.memmap(f"{path}.{x}", t, "r") if os.path.getsize(f"{path}.{x}") else np.zeros(0, t) for x, t in (("bin", f"<u{w}"), ("off", "<i8"), ("doc", "<i8")))
                    yield from rows(m, lambda a, b, v=ids: v[a:b], lambda a, b, v=offs: v[a:b], lambda a, b, v=docs: v[a:b])
                else:
                    with fs.open_input_file(f"{path}.bin") as fb, fs.open_input_file(f"{path}.off") as fo, fs.open_input_file(f"{path}.doc") as fd:
                        part = lambda f, t, k: lambda a, b: np.frombuffer(f.read_at(k * (b - a), k * a), t)
                        yield from rows(m, part(fb, f"<u{w}", w), part(fo, "<i8", 8), part(fd, "<i8", 8))

    def rows(m, ids_of, offs_of, docs_of):
        for lo in range(0, m["n_docs"], 8192):
            hi = min(lo + 8192, m["n_docs"])
            span, d = np.asarray(offs_of(lo, hi + 1)), np.asarray(docs_of(lo, hi))
            ids = ids_of(int(span[0]), int(span[-1]))
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(span - span[0], span[1:] - span[0])]
            yield pa.RecordBatch.from_arrays([pa.array(d, mask=np.arange(lo, hi) < m["n_null"]), pa.array(m["base"] + span[:-1]), pa.array(np.diff(span)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    sets = max(1, manifest.count())
    return manifest.repartition(min(sets, 10_000)).select("name", "n_docs", "n_null", "width", "base", "folder").mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
