"""The final verdict on discovered records: flags, tier, kind of request, one row per series, shortlist and hand-off.

The rules are data: flags are computed once as columns, and each table below names the columns that a label asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import OPERATIONAL
from ..plans.rules import first_match

# Patterns of addresses, subjects and sources, and the year before which a record is context.
JUNK_URL = r"(?i)samlrequest|/sso\b|/sso\?|/login|/signin|/idp/profile|/oauth|/auth/"
FOCUS = (
    r"refug|asylum|asile|asilo|displac|d[eé]plac|desplaz|\bidps?\b|stateless|apatrid|returnee|retourn|forcibly|temporary protection|humanitarian (visa|scheme|protection)|"
    r"ukrain|rohingya|flykt|vluchtel|fl[uü]chtling|schutzsuchend|settlement (database|outcomes)|humanitarian|resettle|status ?holder|statushouder|kvoteflykt|protection visa|visa stream|لاجئ|نازح"
)
TABULATION_SOURCE = (
    r"census|recensement|censo|\bdhs\b|demographic and health|\bmics\b|multiple indicator|labou?r force|\blfs\b|household (budget|income|survey)|integrated (household|survey)|"
    r"living standards|\blsms\b|forced displacement survey|\bfds\b|register|registre|registro"
)
NEW_PARTS = ("new edition", "new output")
HISTORIC_BEFORE, REACH_FROM = 2010, 60

#: Tier and the condition for it, over the flags below; the first that holds counts. The labels are this library's own.
TIERS = (
    ("junk - login/redirect page", "junk"),
    ("already in register", "known"),
    ("historic - context only", "historic"),
    ("review - possible register match", "maybe_known and final_score >= 50"),
    ("not assessed", "not read"),
    ("watch / context", "operational"),
    ("watch / context", "no_focus and not asks and not new_part and final_score >= 40"),
    ("reach out", "reach"),
    ("review then reach out", "counted and final_score >= 50"),
    ("review then reach out", "new_part"),
    ("reach out", "asks"),
    ("low", "asks_not and final_score < 70"),
    ("could not read - check by hand", "unreadable"),
    ("unsure - check questionnaire", "unsure"),
    ("watch / context", "final_score >= 40"),
)
REQUESTS = (
    ("update example (new edition)", "match_kind = 'new edition'"),
    ("new example (output of an example)", "match_kind = 'new output'"),
    ("new example (questionnaire identifies a group)", "asks and not counted"),
    ("regional example", "route = 'regional body' and regional"),
)
REASONS = (
    ("operational survey of an agency: context, not a request", "tier = 'watch / context' and operational"),
    ("no displaced or stateless group named in title or evidence", "tier = 'watch / context' and no_focus and read"),
    ("sign-in or redirect address, no document", "junk"),
    ("matches the register", "known"),
    ("may match the register", "maybe_known"),
    ("reference year is too early", "historic"),
    ("text not retrievable", "tier like 'could not read%'"),
    ("questionnaire identifies a group", "asks and not counted"),
    ("questionnaire read: no such question", "asks_not and tier = 'low'"),
    ("no evidence either way", "tier like 'unsure%'"),
    ("counted by the model", "tier = 'reach out'"),
    ("read by the model", "read"),
)


def flags(rows: DataFrame) -> DataFrame:
    """rows with final_score and the flags of TIERS.

    rows: id, url, title, quote, year, rules_score, model_score, read, counted, got_text, route, regional, match_kind (same
    product, check..., new edition, new output or empty), questionnaire (its verdict or null). Null flags count as false.
    """
    title = F.lower(F.coalesce("title", F.lit("")))
    said = F.when(F.col("read"), F.col("model_score")).otherwise(F.col("rules_score"))
    df = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("read", "counted", "got_text", "regional")}).withColumn("match_kind", F.coalesce("match_kind", F.lit("")))
    df = df.withColumns({
        "final_score": F.least(F.greatest(F.round(F.coalesce(said, F.lit(0))), F.lit(0)), F.lit(100)).cast("int"),
        "junk": F.coalesce(F.col("url").rlike(JUNK_URL), F.lit(False)),
        "known": F.col("match_kind") == "same product",
        "maybe_known": F.col("match_kind").startswith("check"),
        "new_part": F.col("match_kind").isin(*NEW_PARTS),
        "historic": F.coalesce(F.col("year") < HISTORIC_BEFORE, F.lit(False)),
        "operational": title.rlike(OPERATIONAL),
        "no_focus": ~F.lower(F.concat_ws(" ", "title", "quote")).rlike(FOCUS),
        "asks": F.coalesce(F.col("questionnaire").contains("questions found"), F.lit(False)),
        "asks_not": F.coalesce(F.col("questionnaire") == "no displacement question", F.lit(False)),
        "unsure": F.col("read") & ~F.col("counted") & F.coalesce(F.col("model_score") == 40, F.lit(False)),
    })
    return df.withColumns({
        "unreadable": ~F.col("got_text") & (F.col("final_score") < 50),
        "reach": F.expr(f"read and counted and final_score >= {REACH_FROM} and not (operational and route <=> 'NSO (direct)')"),
        "for_tabulation": ~F.col("junk") & ~F.col("historic") & (F.col("counted") | F.col("known") | F.col("asks")) & title.rlike(TABULATION_SOURCE),
    })


def final_verdict(rows: DataFrame) -> DataFrame:
    """flags() with tier, ask_type and reason."""
    df = flags(rows).withColumn("tier", first_match(TIERS, "low"))
    return df.withColumns({"ask_type": first_match(REQUESTS, "new example"), "reason": first_match(REASONS, "not read by the model - rules' score only")})


def series_primary(rows: DataFrame, key: str, score: str, order: str) -> DataFrame:
    """rows with is_primary: true for the row with the highest score of its key, of equal ones the first by order.

    The choice is a partial aggregate and one join, so a key with very many rows is not sorted in one task.
    """
    top = rows.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct((-F.coalesce(F.col(score), F.lit(0))).alias("s"), F.col(order).alias("o"))).alias("__top"))
    return rows.join(top, F.col(key).eqNullSafe(F.col("__key")), "left").withColumn("is_primary", F.col(order).eqNullSafe(F.col("__top.o"))).drop("__key", "__top")


def shortlist(verdicts: DataFrame) -> DataFrame:
    """What to ask for: one row a series of the two tiers that reach out."""
    return verdicts.where(F.col("tier").isin("reach out", "review then reach out") & F.col("is_primary"))


def tabulation_handoff(verdicts: DataFrame) -> DataFrame:
    """What the library's users can tabulate themselves: one row a series."""
    return verdicts.where(F.col("for_tabulation") & F.col("is_primary")).withColumn("in_register", F.col("tier") == "already in register")


def priority_queue(rows: DataFrame, ranks: list[tuple[str, Column | str]], then: list[Column | str], most: int) -> DataFrame:
    """The first `most` rows by the first rank whose condition holds, then by `then` (a top-k, not a sort of all rows)."""
    level = first_match([(f"{k:03d}", c) for k, (_, c) in enumerate(ranks)], f"{len(ranks):03d}")
    named = first_match(ranks, "rest")
    return rows.withColumns({"queue_level": level.cast("int"), "queue": named}).orderBy("queue_level", *then).limit(most)


def capped_after_twins(rows: DataFrame, group: str, twin: str, order: list[Column | str], most: int) -> DataFrame:
    """At most `most` rows a group once rows that share a twin key (language versions of one address) are reduced to the first."""
    first = rows.groupBy(group, twin).agg(F.min(F.struct(*order, F.struct(*[rows[c] for c in rows.columns]).alias("row"))).alias("m")).select("m.*")
    keys = [c for c in first.columns if c != "row"]
    at = F.row_number().over(Window.partitionBy(f"row.{group}").orderBy(*keys))
    return first.withColumn("__at", at).where(F.col("__at") <= most).select("row.*")


def full_registry(registry: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Every entity of either side, with what both know: a full outer join on the keys."""
    return registry.join(stats, keys, "full")


def non_null_counts(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows of each group, and how many of them have each column."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.count(c).alias(f"n_{c}") for c in columns])
