"""Nearest examples by cosine: coarse cells as join keys, Arrow blocks of vectors within a cell.

Reference vectors are dealt to cells by their most similar centroid (spherical k-means on a bounded sample). A cell of a block
knows the widest angle between its centroid and a member, so by the triangle inequality no member can be closer to a
query than the query's angle to the centroid less that width. A query first visits the cell with the best such bound, then only the
cells whose bound reaches what it found: the result is exact. `probes` ends the search after so many cells; its recall is then measured, not
promised. Cells are cut into tiles of at most TILE references and TILE queries, one task's matrix product each, so no task holds a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.rules import first_match
from ..sources.store import settled

# The similarity from which the nearest example is worth a verdict.
BAND = 0.62
CELLS, SAMPLE, TILE = 64, 8192, 4096


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def centroids(refs: DataFrame, vec: str, id_: str, cells: int = CELLS, sample: int = SAMPLE, rounds: int = 10) -> np.ndarray | None:
    """Unit vectors of cells, fitted on at most `sample` vectors (those with the smallest id hashes); None without vectors."""
    got = refs.select(id_, vec).orderBy(F.xxhash64(id_), id_).limit(sample).select(vec).toArrow()  # at most `sample` vectors
    if not got.num_rows:
        return None
    x = _matrix(got[vec].combine_chunks())
    c = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(length > 0, sums / np.where(length > 0, length, 1), c)
    return c


def unit(df: DataFrame, vec: str, id_: str, block: str) -> DataFrame:
    """id, block, u (the vector scaled to length 1) of the rows whose vectors are whole, finite and not zero."""
    ok = f"`{id_}` is not null and `{block}` is not null and `{vec}` is not null and not exists(`{vec}`, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(`{vec}`, x -> x <> 0)"
    rows = df.where(ok).select(F.col(id_).alias("id"), F.col(block).alias("block"), F.col(vec).cast("array<double>").alias("v"))
    # the largest component first, so that squares neither overflow nor vanish
    rows = rows.withColumn("v", F.transform("v", lambda x: x / F.array_max(F.transform("v", F.abs))))
    return rows.select("id", "block", F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, y: s + y * y))).alias("u"))


def _with_cells(rows: DataFrame, c: np.ndarray, all_cells: bool) -> DataFrame:
    """rows with cell and cos of their own cell, or of every cell as arrays."""
    shared = rows.sparkSession.sparkContext.broadcast(c)  # at most CELLS vectors
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + (", cos array<double>" if all_cells else ", cell int, cos double")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            s = np.clip(_matrix(batch.column("u")) @ shared.value.T, -1, 1)
            own = s.argmax(1)
            more = [pa.array(list(s), pa.list_(pa.float64()))] if all_cells else [pa.array(own.astype(np.int32)), pa.array(s[np.arange(len(s)), own])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *(["cos"] if all_cells else ["cell", "cos"])])

    return rows.mapInArrow(run, schema)


def _search(visits: DataFrame, index: DataFrame, tiles: DataFrame, tile: int) -> DataFrame:
    """id, near, sim: the most similar reference of the cells that each query (id, block, u, cell) visits."""
    n = visits.groupBy("block", "cell").agg(F.count("*").alias("n_queries"))
    q = visits.join(n, ["block", "cell"]).join(tiles.select("block", "cell", "n_tiles"), ["block", "cell"])
    q = q.withColumn("qt", F.pmod(F.xxhash64("id"), F.ceil(F.col("n_queries") / tile)).cast("int")).withColumn("rt", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
    r = index.join(tiles.select("block", "cell", "n_tiles"), ["block", "cell"]).join(n.withColumnRenamed("n_queries", "nq"), ["block", "cell"])
    r = r.withColumn("rt", F.pmod(F.xxhash64("id", F.lit(1)), F.col("n_tiles")).cast("int")).withColumn("qt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("nq") / tile).cast("int") - 1)))
    keys = ["block", "cell", "rt", "qt"]

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"id": left["id"].slice(0, 0), "near": right["id"].slice(0, 0), "sim": pa.array([], pa.float64())})
        right = right.sort_by("id")  # ties go to the smaller id
        x, y = _matrix(left["u"].combine_chunks()), _matrix(right["u"].combine_chunks())
        best, at = np.full(len(x), -np.inf), np.zeros(len(x), np.int64)
        for lo in range(0, len(x), 512):
            s = np.round(x[lo : lo + 512] @ y.T, 12)  # equal vectors are equal, whatever order sums are taken in
            at[lo : lo + 512] = s.argmax(1)
            best[lo : lo + 512] = s.max(1)
        return pa.table({"id": left["id"], "near": right["id"].combine_chunks().take(pa.array(at)), "sim": pa.array(best)})

    kinds = {f.name: f.dataType.simpleString() for f in index.schema}
    found = q.select("id", "u", *keys).groupBy(*keys).cogroup(r.select("id", "u", *keys).groupBy(*keys)).applyInArrow(product, f"id {dict(visits.dtypes)['id']}, near {kinds['id']}, sim double")
    return found


def nearest_in_block(queries: DataFrame, refs: DataFrame, vec: str, query_id: str, ref_id: str, block: str, probes: int | None = None, cells: int = CELLS, sample: int = SAMPLE, tile: int = TILE) -> DataFrame:
    """query_id, near_id, similarity: each query's most similar reference of its block by cosine, ties to the smaller id.

    Queries whose block has no reference, or whose vector is null, zero or not finite, are left out. Ids should be distinct on either side.
    probes: visit at most so many cells (none: as many as an exact result needs).
    """
    spark = queries.sparkSession
    r = settled(unit(refs, vec, ref_id, block))
    c = centroids(r, "u", "id", cells, sample)
    if c is None:
        return spark.createDataFrame([], "query_id long, near_id long, similarity double")
    index = settled(_with_cells(r, c, False))
    tiles = settled(index.groupBy("block", "cell").agg(F.min("cos").alias("least"), F.count("*").alias("n")).withColumn("n_tiles", F.ceil(F.col("n") / tile).cast("int")))
    q = settled(_with_cells(unit(queries, vec, query_id, block), c, True))
    # the smallest angle to any member is the angle to the centroid less the cell's width
    reach = q.select("id", "block", F.posexplode("cos").alias("cell", "cos")).join(tiles.select("block", "cell", "least"), ["block", "cell"])
    reach = reach.select("id", "block", "cell", F.cos(F.greatest(F.acos("cos") - F.acos(F.greatest(F.col("least"), F.lit(-1.0))), F.lit(0.0))).alias("bound"))
    if probes is not None:
        order = Window.partitionBy("id").orderBy(F.desc("bound"), "cell")
        visits = reach.withColumn("k", F.row_number().over(order)).where(F.col("k") <= probes).drop("k", "bound").join(q.select("id", "u"), "id")
        found = _search(visits, index, tiles, tile)
    else:
        reach = settled(reach)
        first = reach.groupBy("id").agg(F.min_by("cell", F.struct((-F.col("bound")).alias("b"), "cell")).alias("first"))
        visits = reach.join(first, "id").where("cell = first").select("id", "block", "cell").join(q.select("id", "u"), "id")
        once = settled(_search(visits, index, tiles, tile))
        so_far = once.groupBy("id").agg(F.max("sim").alias("sim"))
        # a bound within rounding (angles near 0 have half the digits) of what was found may still hold an equal vector with a smaller id
        rest = reach.join(first, "id").join(so_far, "id").where((F.col("cell") != F.col("first")) & (F.col("bound") >= F.col("sim") - 1e-7)).select("id", "block", "cell").join(q.select("id", "u"), "id")
        found = once.unionByName(_search(rest, index, tiles, tile))
    best = found.groupBy("id").agg(F.min(F.struct((-F.col("sim")).alias("s"), "near")).alias("m"))
    return best.select(F.col("id").alias("query_id"), F.col("m.near").alias("near_id"), (-F.col("m.s")).alias("similarity"))


def example_match(queries: DataFrame, refs: DataFrame, near: DataFrame, verdicts: DataFrame, query_id: str, block: str, several=None, band: float = BAND) -> DataFrame:
    """Each query with match_type, near_id, similarity, match_id, confidence and reason.

    near: what nearest_in_block() found. verdicts (query_id, ref_id, same, confidence, reason) are landed judgements of pairs; they count from the band on. several: a
    condition under which a place is several countries, which are told apart by people. Rows of queries stay, each once.
    """
    has = refs.where(F.col(block).isNotNull()).select(F.col(block).alias("__b")).distinct().withColumn("__has", F.lit(True))
    rows = queries.select(F.col(query_id).alias("query_id"), F.col(block).alias("__b"), (several if several is not None else F.lit(False)).alias("__several"))
    rows = rows.join(has, "__b", "left").join(near, "query_id", "left")
    said = verdicts.select("query_id", F.col("ref_id").alias("near_id"), "same", F.col("confidence").alias("__c"), F.col("reason").alias("__r"))
    rows = rows.join(said.where("same is not null").dropDuplicates(["query_id", "near_id"]), ["query_id", "near_id"], "left")
    judged = F.col("same").isNotNull() & (F.col("similarity") >= band)
    kind = first_match([("multi-country - review per country", F.col("__several")), ("new_country", F.col("__has").isNull()), ("already_in_register", judged & F.col("same"))], "new_example_existing_country")
    rows = rows.withColumn("match_type", kind)
    confidence = F.when(F.col("match_type") == "new_country", "high").when(F.col("__several"), F.lit(None).cast("string")).when(judged, F.col("__c")).otherwise("low")
    reason = F.when(F.col("__several") | F.col("__has").isNull(), F.lit(None).cast("string")).when(judged, F.col("__r")).when(F.col("near_id").isNull(), "no vector of the record").when(F.col("similarity") < band, F.format_string("nearest example sim %.2f below band", "similarity")).otherwise("not judged")
    return rows.select("query_id", "match_type", "near_id", "similarity", F.when(F.col("match_type") == "already_in_register", F.col("near_id")).alias("match_id"), confidence.alias("confidence"), reason.alias("reason"))
