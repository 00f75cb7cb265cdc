"""Composite scores, matrices and logs of the identification, coverage and campaign work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import cooccurs_within, count_terms
from ..plans.rules import first_match

# The weights and caps of the relevance score.
POINTS = {"framework": 10, "inclusion": 15, "near": 15, "own_site": 20, "title": 25}
CAP_NO_TERMS, CAP_GENERIC, CAP_ALL = 20, 30, 100


def signals(docs: DataFrame, terms: dict[str, str], near: tuple[str, str], text: str = "text") -> DataFrame:
    """docs with n_<concept> counts and near (whether the two concepts occur close to each other)."""
    return docs.withColumns({f"n_{k}": count_terms(F.col(text), p) for k, p in terms.items()} | {"near": cooccurs_within(F.col(text), terms[near[0]], terms[near[1]])})


def relevance(core: Column, framework: Column, generic: Column, inclusion: Column, near: Column, in_title: Column, excluded: Column) -> Column:
    """0 to 100: counts and bonuses, capped where strong terms are missing."""
    flag = lambda c, k: F.when(c, POINTS[k]).otherwise(0)
    raw = core + framework * POINTS["framework"] + flag(inclusion, "inclusion") + flag(near, "near") + flag(in_title, "title")
    weak = (core == 0) & (framework == 0)
    return F.when(excluded, 0).when(weak & (generic == 0), F.least(raw, F.lit(CAP_NO_TERMS))).when(weak, F.least(raw, F.lit(CAP_GENERIC))).otherwise(F.least(raw, F.lit(CAP_ALL))).cast("int")


def category(core: Column, framework: Column, generic: Column, strong: Column, excluded: Column) -> Column:
    return first_match([("E. Suppress", excluded), ("E. Suppress", (core == 0) & (framework == 0) & (generic == 0)), ("A. Strong candidate", strong), ("D. Manual review needed", core > 0)], "C. Evidence lead only")


def route_upgrade(status: Column, category: Column, route: Column) -> Column:
    return F.when((status == "ACTIVE") & category.rlike("^[AB]") & route.isin("NSO direct", "partner-supported follow-up"), "existing focal point").otherwise(route)


def priority_matrix(status: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """status (key, status) with counts of evidence and a priority from P1 to P6."""
    out = status.join(evidence.groupBy(key).agg(F.count("*").alias("n_evidence"), F.count_if("is_new").alias("n_new")), key, "left").fillna(0, ["n_evidence", "n_new"])
    new = F.col("n_new") > 0
    return out.withColumn("priority", first_match([("P1", (F.col("status") == "NEVER") & new), ("P2", (F.col("status") == "LAPSED") & new), ("P3", (F.col("status") == "ACTIVE") & new), ("P4", F.col("status") == "LAPSED"), ("P5", F.col("status") == "NEVER")], "P6"))


def gap_matrix(grid: DataFrame, published: DataFrame, demonstrated: DataFrame, material: DataFrame, keys: list[str], material_keys: list[str]) -> DataFrame:
    """One status a cell, the most resolved first; cells without material are left out.

    published: keys, has_value, has_related; demonstrated: keys; material: material_keys, n_docs, n_micro.
    """
    out = grid.join(published, keys, "left").join(demonstrated.select(*keys).distinct().withColumn("shown", F.lit(True)), keys, "left").join(material, material_keys, "left")
    out = out.fillna(False, ["has_value", "has_related", "shown"]).fillna(0, ["n_docs", "n_micro"]).where("n_docs > 0")
    return out.withColumn("cell_status", first_match([("published", "has_value"), ("demonstrated", "shown"), ("tabulation candidate", "n_micro > 0"), ("related only (review)", "has_related")], "gap"))


def log_merge(log: DataFrame, targets: DataFrame, key: str, human: list[str]) -> DataFrame:
    """The current state: targets' columns where there is a target, the columns people fill from the log, logged keys kept."""
    cols = [c for c in targets.columns if c != key]
    joined = targets.alias("t").join(log.alias("l"), key, "full")
    both = [F.coalesce(f"t.{c}", f"l.{c}").alias(c) if c in log.columns else F.col(f"t.{c}") for c in cols if c not in human]
    return joined.select(key, *both, *[F.col(f"l.{c}").alias(c) for c in human])


def followups_due(log: DataFrame, today: Column, days: int = 14) -> DataFrame:
    return log.where((F.col("status") == "sent") & (F.col("date_sent") <= F.date_sub(today, days))).withColumn("days_waiting", F.datediff(today, "date_sent"))


def cards(df: DataFrame, by: str, title: str, score: str, most: int = 5) -> DataFrame:
    """One ordered text card a group, of its best rows."""
    from .ranking import top_n

    best = top_n(df, [by], [F.col(score).desc(), title], most, "__k").withColumn("__card", F.concat_ws(" ", F.format_string("%d.", "__k"), T.clean_title(F.col(title)), F.format_string("(%s)", F.col(score).cast("string"))))
    return best.groupBy(by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__k", "__card"))), lambda x: x["__card"]), "\n").alias("card"))
