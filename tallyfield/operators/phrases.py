"""Which of many phrases stand in which texts: one pass over the texts with an automaton of all phrases."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of phrases that one automaton holds (some 100 bytes each in a task); more phrases are more passes.
BLOCK = 1 << 21


def _blocks(phrases: DataFrame, most: int):
    held, size = [], 0
    for r in phrases.toLocalIterator():
        if held and size + len(r[1]) > most:
            yield held
            held, size = [], 0
        held.append((r[0], r[1]))
        size += len(r[1])
    if held:
        yield held


def phrases_in_texts(texts: DataFrame, phrases: DataFrame, text_id: str, text: str, phrase_id: str, phrase: str, most: int = BLOCK) -> DataFrame:
    """text_id, phrase_id of every phrase that a text contains, as F.contains() has it; each pair of rows once.

    Phrases pass in blocks of at most `most` characters (one phrase at least), one pass over the texts a block; nothing is shuffled. Null texts and phrases, and
    empty phrases, are in no pair.
    """
    listed = phrases.where((F.col(phrase) != "")).select(phrase_id, phrase)
    schema = f"`{text_id}` {dict(texts.dtypes)[text_id]}, `{phrase_id}` {dict(phrases.dtypes)[phrase_id]}"
    out = texts.sparkSession.createDataFrame([], schema)
    for block in _blocks(listed, most):
        shared = texts.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            import ahocorasick

            kinds = None
            found = ahocorasick.Automaton()
            for k, (_, p) in enumerate(shared.value):
                found.add_word(p, [*found.get(p, []), k])
            found.make_automaton()
            ids = [i for i, _ in shared.value]
            for batch in batches:
                kinds = kinds or batch.schema.field(0).type
                for lo in range(0, batch.num_rows, 512):
                    part, rows, hits = batch.slice(lo, 512), [], []
                    for r, x in enumerate(part.column(1).to_pylist()):
                        held = sorted({k for _, ks in found.iter(x) for k in ks}) if x else []
                        rows += [r] * len(held)
                        hits += [ids[k] for k in held]
                    if hits:
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(hits)], [text_id, phrase_id])

        out = out.unionByName(texts.select(text_id, text).mapInArrow(run, schema))
    return out
