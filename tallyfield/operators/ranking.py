"""Deduplication, top-k, caps, sequences and samples; every order ends in a tie-break."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: list, order: list, n: int, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)


def keep_best(df: DataFrame, keys: list[list], order: list) -> DataFrame:
    """One row per key, for each list of keys in turn (say, url first, then place and title)."""
    for key in keys:
        df = top_n(df, key, order, 1, "__k").drop("__k")
    return df


def two_level_cap(df: DataFrame, by: str, order: list, per_group: int, overall: int) -> DataFrame:
    """At most per_group rows a group, then the first rows of all."""
    return top_n(df, [by], order, per_group, "__k").drop("__k").orderBy(*order).limit(overall)


def also_in(df: DataFrame, key: list[str], source: str, order: list) -> DataFrame:
    """Survivors by key, with the set of sources that had it."""
    had = df.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_set(source)), "; ").alias("also_in"))
    return keep_best(df, [key], order).join(had, key)


def shared_by(df: DataFrame, key: str, member: str, least: int) -> DataFrame:
    """Rows whose key at least `least` distinct members have."""
    many = df.groupBy(key).agg(F.countDistinct(member).alias("n_members")).where(F.col("n_members") >= least)
    return df.join(many, key)


def latest(df: DataFrame, key: list[str], at: str, ties: list[str]) -> DataFrame:
    return top_n(df, key, [F.col(at).desc_nulls_last(), *ties], 1, "__k").drop("__k")


def numbered(df: DataFrame, by: list[str], order: list, pattern: str, name: str) -> DataFrame:
    """A reference such as `12_03`: pattern is a format of the group's key and the sequence number."""
    return df.withColumn(name, F.format_string(pattern, *by, F.row_number().over(Window.partitionBy(*by).orderBy(*order))))


def hash_order(seed: int, id_: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_).cast("string")))


#: Shares into which a stratum is dealt before its first rows are taken.
SALTS = 64


def stratified_sample(df: DataFrame, strata: list[tuple[str, Column, int]], id_: str, seed: int = 1, seen: DataFrame | None = None, total: int | None = None, fill: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """df's sampled rows with stratum and position, in a fixed random order: up to a quota of rows of each (name, condition, quota).

    Strata choose one after the other: a row belongs to the first stratum that takes it, and what one leaves is open to those after it.
    Ids already seen are left out. total: if quotas leave the sample short of it, the (name, condition) pairs of fill top it up, in
    order. position is a shuffle of the whole sample, from 1. Ids should be distinct.

    As no more rows than all quotas can be taken before a stratum chooses, its first so many rows by hash are all it needs: they are taken in
    each of SALTS shares, then over the shares, so no task holds a stratum; what is left (at most strata x quotas rows) is settled in one task.
    """
    plan = [(name, condition, quota) for name, condition, quota in strata] + [(name, condition, None) for name, condition in (fill if total else ())]
    most = max(sum(q for _, _, q in strata), total or 0)
    pool = df.join(seen.select(id_).distinct(), id_, "left_anti") if seen is not None else df
    fits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, (_, c, _) in enumerate(plan)]))
    rows = pool.select(F.col(id_).alias("id"), hash_order(seed, id_).alias("u"), F.explode(fits).alias("s"))
    for by in (["s", F.pmod(F.xxhash64("id"), F.lit(SALTS))], ["s"]):
        rows = rows.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("u", "id"))).where(F.col("k") <= most).drop("k")
    names, quotas = [name for name, _, _ in plan], [q for _, _, q in plan]
    kind = dict(rows.dtypes)["id"]

    def choose(table: pa.Table) -> pa.Table:
        taken: dict = {}
        waiting: list = [[] for _ in names]
        for s, u, i in sorted(zip(table["s"].to_pylist(), table["u"].to_pylist(), table["id"].to_pylist())):
            waiting[s].append(i)
        for s, ids in enumerate(waiting):
            open_ids = [i for i in ids if i not in taken]
            for i in open_ids[: quotas[s] if quotas[s] is not None else max(0, total - len(taken))]:
                taken[i] = names[s]
        return pa.table({"id": pa.array(list(taken), table["id"].type), "stratum": pa.array(list(taken.values()), pa.string())})

    chosen = rows.groupBy().applyInArrow(choose, f"id {kind}, stratum string")
    chosen = chosen.withColumn("position", F.row_number().over(Window.orderBy(F.md5(F.concat_ws(":", F.lit(f"{seed} shuffled"), F.col("id").cast("string"))), "id")))
    return df.join(F.broadcast(chosen), df[id_] == chosen["id"]).drop("id") if id_ != "id" else df.join(F.broadcast(chosen), "id")  # at most total rows
