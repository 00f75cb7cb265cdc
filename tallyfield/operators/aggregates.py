"""Aggregations: rollups, cross-tabulations, coverage, survey estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse(df: DataFrame, key: list[str], order: list[str], first: list[str], joined: str, sep: str = "; ") -> DataFrame:
    """One row a key: the columns `first` of its first row by order, and the distinct values of `joined`."""
    by = F.struct(*dict.fromkeys([*order, *first]))
    agg = df.groupBy(*key).agg(F.min(by).alias("m"), F.array_join(F.sort_array(F.collect_set(joined)), sep).alias(joined))
    return agg.select(*key, *[F.col(f"m.{c}").alias(c) for c in first], joined)


def response_status(df: DataFrame, key: str, year: str, active_since: int) -> DataFrame:
    out = df.groupBy(key).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count("*").alias("n_responses"))
    return out.withColumn("status", F.when(F.col("last_year") >= active_since, "ACTIVE").otherwise("LAPSED"))


def cross_tab(df: DataFrame, a: str, b: str, levels: list[str]) -> DataFrame:
    return df.groupBy(a).pivot(b, levels).count().fillna(0)


def latest_wide(df: DataFrame, key: str, measure: str, year: str, value: str, measures: list[str]) -> DataFrame:
    """Each measure's value of its latest year, wide, with the row sum of what is there."""
    pick = [F.max_by(F.when(F.col(measure) == m, F.col(value)), F.when(F.col(measure) == m, F.col(year))).alias(m) for m in measures]
    out = df.groupBy(key).agg(*pick)
    return out.withColumn("total", sum((F.coalesce(F.col(m), F.lit(0.0)) for m in measures), F.lit(0.0)))


def latest_context(df: DataFrame, key: str, measure: str, year: str, value: str, source: str, measures: list[str], summed: list[str], official: str) -> DataFrame:
    """One row a key: of each measure its value, year and source in its latest year (ties to the larger value, then source), the sum of the measures
    in `summed` (absent ones count 0), and whether the latest source of any measure, listed or not, matches `official`.

    A partial aggregate by (key, measure), then one by key; no group is sorted.
    """
    last = df.where(F.col(year).isNotNull()).groupBy(key, measure).agg(F.max(F.struct(F.col(year).alias("y"), F.col(value).alias("v"), F.col(source).alias("s"))).alias("__m"))
    at = lambda m, f: F.max(F.when(F.col(measure) == m, F.col(f"__m.{f}")))
    cols = [c for m in measures for c in (at(m, "v").alias(m), at(m, "y").alias(f"{m}_year"), at(m, "s").alias(f"{m}_source"))]
    out = last.groupBy(key).agg(*cols, F.bool_or(F.lower(F.coalesce("__m.s", F.lit(""))).rlike(official)).alias("any_official"))
    return out.withColumn("total", sum((F.coalesce(F.col(m), F.lit(0.0)) for m in summed), F.lit(0.0)))


def composition_cap(df: DataFrame, is_core: Column, share: float, order: list[Column]) -> DataFrame:
    """All core rows, and of the others at most floor(n * (1 - share) / share), the first by order."""
    n = df.where(is_core).count()  # one number
    return df.where(is_core).unionByName(df.where(~is_core).orderBy(*order).limit(int(n * (1 - share) / share)))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).count().where("count > 1")


def agreement(df: DataFrame, truth: Column, said: Column) -> DataFrame:
    """n, agreement, precision and recall of yes answers; empty denominators count as 1."""
    one = lambda c: F.greatest(c, F.lit(1))
    t, s = F.coalesce(truth, F.lit(False)), F.coalesce(said, F.lit(False))
    hit = F.count_if(t & s)
    return df.agg(F.count("*").alias("n"), (F.count_if(t == s) / one(F.count("*"))).alias("agreement"), (hit / one(F.count_if(s))).alias("precision"), (hit / one(F.count_if(t))).alias("recall"))


def weighted_proportion(df: DataFrame, x: str, weight: str, group: str, least_n: int = 30) -> DataFrame:
    """Percentages with linearised standard errors, per group and in total (group null, is_total true).

    The design has weights only, drawn with replacement; a group is a domain of the whole design, so n counts all rows.
    Groups with fewer than least_n rows are marked as suppressed.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(weight).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(weight).cast("double").alias("w"), F.col(group).alias("g"))
    # sums of w, wx, w2, w2x, w2x2 say all: scores u = w (x - p) / W add up to 0 within a domain
    sums = rows.groupBy("g").agg(*_sums())
    total = sums.agg(*[F.sum(c).alias(c) for c in ("n", "w", "wx", "ww", "wwx", "wwxx")]).withColumn("is_total", F.lit(True)).withColumn("g", F.lit(None).cast(rows.schema["g"].dataType))
    design = total.select(F.col("n").alias("n_all"))
    both = sums.withColumn("is_total", F.lit(False)).unionByName(total).crossJoin(F.broadcast(design))  # one row
    p = F.col("wx") / F.col("w")
    ss = (F.col("wwxx") - 2 * p * F.col("wwx") + p * p * F.col("ww")) / (F.col("w") * F.col("w"))
    se = F.sqrt(F.greatest(F.col("n_all") / F.nullif(F.col("n_all") - 1, F.lit(0)) * ss, F.lit(0.0)))
    return both.select(F.col("g").alias(group), "is_total", "n", (p * 100).alias("est"), (se * 100).alias("se"), (F.col("n") < least_n).alias("suppressed"))


def _sums() -> list[Column]:
    w, x = F.col("w"), F.col("x")
    return [F.count("*").alias("n"), F.sum(w).alias("w"), F.sum(w * x).alias("wx"), F.sum(w * w).alias("ww"), F.sum(w * w * x).alias("wwx"), F.sum(w * w * x * x).alias("wwxx")]


def stratified_cluster(df: DataFrame, x: str, weight: str, stratum: str, psu: str) -> DataFrame:
    """Estimate and linearised standard error of a stratified cluster sample; a stratum with one cluster is centred
    on the mean of all clusters."""
    rows = df.where(F.col(x).isNotNull() & F.col(weight).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(weight).cast("double").alias("w"), F.col(stratum).alias("h"), F.col(psu).alias("c"))
    clusters = rows.groupBy("h", "c").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("x")).alias("wx"), F.count("*").alias("n"))
    total = clusters.agg(F.sum("w").alias("all_w"), F.sum("wx").alias("all_wx"), F.sum("n").alias("all_n"))
    z = clusters.crossJoin(F.broadcast(total)).withColumn("z", (F.col("wx") - F.col("all_wx") / F.col("all_w") * F.col("w")) / F.col("all_w"))  # one row
    grand = z.agg(F.avg("z").alias("grand"))
    strata = z.groupBy("h").agg(F.count("*").alias("m"), F.sum("z").alias("s"), F.sum(F.col("z") * F.col("z")).alias("s2")).crossJoin(F.broadcast(grand))
    v = F.when(F.col("m") > 1, F.col("m") / (F.col("m") - 1) * (F.col("s2") - F.col("s") * F.col("s") / F.col("m"))).otherwise(F.pow(F.col("s") - F.col("grand"), F.lit(2)))
    return strata.agg(F.sum(v).alias("v"), F.sum("m").alias("clusters"), F.count("*").alias("strata")).crossJoin(F.broadcast(total)).select(F.col("all_n").alias("n"), "strata", "clusters", (F.col("all_wx") / F.col("all_w") * 100).alias("est"), (F.sqrt(F.greatest("v", F.lit(0.0))) * 100).alias("se"))


def coverage(df: DataFrame, flags: list[str], id_: str) -> DataFrame:
    """Wide to long: for each flag column the distinct ids with it and their share."""
    long = df.unpivot(id_, flags, "concept", "has")
    return long.groupBy("concept").agg(F.countDistinct(F.when(F.col("has"), F.col(id_))).alias("n_ids"), F.countDistinct(id_).alias("n_all")).withColumn("share", F.col("n_ids") / F.col("n_all"))


def cells_with(df: DataFrame, keys: list[str], flag: Column) -> DataFrame:
    """Per cell: whether any row has the flag, whether any lacks it, and the count."""
    return df.groupBy(*keys).agg(F.bool_or(flag).alias("any_with"), F.bool_or(~flag).alias("any_without"), F.count("*").alias("n"))


def version_shift(df: DataFrame, old: str, new: str, by: str) -> DataFrame:
    """Median change, and how many cross 50 either way, per version."""
    d = F.col(new) - F.col(old)
    return df.groupBy(by).agg(F.median(d).alias("median_delta"), F.count_if((F.col(old) < 50) & (F.col(new) >= 50)).alias("up"), F.count_if((F.col(old) >= 50) & (F.col(new) < 50)).alias("down"), F.count("*").alias("n"))


def funnel(df: DataFrame, stage: str, entity: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct entities of each stage, with the stage's place in order (stages that are not listed come last)."""
    from ..plans.rules import rank_of

    out = df.groupBy(stage).agg(F.count("*").alias("n_rows"), F.countDistinct(entity).alias("n_entities"))
    return out.withColumn("place", rank_of(stage, order) if order else F.lit(1))


def in_both(a: DataFrame, b: DataFrame, key: str | list[str]) -> DataFrame:
    """The distinct keys that both tables hold (null keys are equal)."""
    keys = [key] if isinstance(key, str) else key
    return a.select(*keys).intersect(b.select(*keys))
