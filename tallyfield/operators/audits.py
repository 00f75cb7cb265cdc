"""Audits: what a register lacks, what reviewers said, and what to ask for next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.rules import first_match

# Levels of likelihood, the best first; access by type of survey, the easiest first.
LIKELIHOODS = ("high", "medium", "low")
ACCESS = (
    ("MICS", "1 DOWNLOAD NOW", "https://mics.unicef.org/surveys"),
    ("living conditions/LSMS", "2 MOSTLY PUBLIC-USE", "https://microdata.worldbank.org"),
    ("labour force", "2 MOSTLY PUBLIC-USE", "https://microdata.worldbank.org"),
    ("DHS", "1 DOWNLOAD NOW", "https://dhsprogram.com/data/available-datasets.cfm"),
    ("FDP socio-economic", "3 APPLY", "https://microdata.unhcr.org"),
)
SIGN_IN = r"samlrequest|/sso\b|/login|/signin|/idp/profile|/oauth|/auth/"
PROVENANCE = "official register|administrative register|as documented in|according to|sourced from|data come from|drawn from the"


def access(kind: Column) -> Column:
    """ease (1 is the easiest), access_status and portal of a type of survey."""
    pick = lambda values, default: first_match([(v, kind == k) for (k, _, _), v in zip(ACCESS, values)], default)
    ease = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k, _, _ in ACCESS]), kind), F.lit(0)), F.lit(len(ACCESS) + 1))
    return F.struct(ease.cast("int").alias("ease"), pick([s for _, s, _ in ACCESS], "4 CHECK record").alias("access_status"), pick([p for _, _, p in ACCESS], "https://catalog.ihsn.org").alias("portal"))


def is_junk(url: Column) -> Column:
    """Addresses of sign-in pages."""
    return F.lower(F.coalesce(url, F.lit(""))).rlike(SIGN_IN)


def letter_gate(text: Column, titles: Column, most_words: int = 38) -> Column:
    """Why a drafted sentence can't stand: length, a list, an open end, a claimed source, a title copied; else `ok`."""
    x = T.squish(F.coalesce(text, F.lit("")))
    copied = F.coalesce(F.exists(titles, lambda s: (F.length(s) > 12) & F.contains(x, s)), F.lit(False))
    return first_match([
        ("empty", x == ""), ("too long", F.size(F.split(x, " ")) > most_words), ("list", F.contains(x, F.lit(":"))),
        ("open end", ~x.rlike("[.!?][\"'»]?$")), ("claimed source", F.lower(x).rlike(PROVENANCE)), ("copied title", copied),
    ], "ok")


def coverage_gaps(registry: DataFrame, inventory: DataFrame, evidence: DataFrame, liveness: DataFrame, place: str = "place", domain: str = "domain", most: int = 2) -> DataFrame:
    """Places of the registry with at most `most` evidence rows, and what to do about each.

    inventory: domain, total_inventory, keyword_matches; evidence: one row a find, with place; liveness: domain,
    http_status, final_url of domains that were asked. Evidence is counted before it is joined.
    """
    found = evidence.groupBy(place).agg(F.count("*").alias("evidence_rows"))
    out = registry.join(inventory.select(domain, "total_inventory", "keyword_matches"), domain, "left").join(found, place, "left")
    out = out.fillna(0, ["total_inventory", "evidence_rows"]).where(F.col("evidence_rows") <= most)
    asked = liveness.select(F.col(domain).alias("__d"), "http_status", "final_url")
    # only a domain without inventory is asked
    out = out.join(asked, (F.col(domain) == F.col("__d")) & (F.col("total_inventory") == 0), "left").drop("__d")
    none, moved = F.col("total_inventory") == 0, ~F.contains("final_url", F.col(domain))
    action = first_match([
        ("find the current site", none & F.col("http_status").isNull()), ("take the new address", none & moved),
        ("verify the address", none & (F.col("http_status") >= 400)), ("look by hand", none), ("no term matched", F.col("keyword_matches") == 0),
    ], "little survived scoring")
    return out.withColumn("suggested_action", action)


def round_action(year: Column, this_year: int, examples: Column, last: Column, people: Column, window: int = 3, recent: int = 2022, least: int = 10_000) -> Column:
    """action and priority for a planned or past round of a census, given what the register holds of it."""
    n, y = F.coalesce(examples, F.lit(0)), year
    action = first_match([
        ("ask now: planned", y.between(this_year, this_year + window)), ("later: after the window", y > this_year + window),
        ("ask: recent, not in the register", (y >= recent) & (n == 0)), ("in the register: ask for an update", (n > 0) & (y > F.coalesce(last, F.lit(0)))),
    ], "context")
    priority = F.when(~action.rlike("^(ask|in the register)"), "-").when(F.coalesce(people, F.lit(0)) >= least, "high").otherwise("normal")
    return F.struct(action.alias("action"), priority.alias("priority"))


def product_rollup(leads: DataFrame, product: str = "product") -> DataFrame:
    """One decision a product from its leads (product, lead_id, title, year, recent, likelihood, is_edition).

    The best likelihood counts; an edition counts if its lead's likelihood is high or medium. Titles are those of the
    three smallest lead ids, by a bounded list.
    """
    from .ranking import top_n

    rank = F.nullif(F.array_position(F.array(*map(F.lit, LIKELIHOODS)), F.col("likelihood")), F.lit(0))
    x = leads.withColumn("__r", F.coalesce(rank, F.lit(len(LIKELIHOODS))))
    out = x.groupBy(product).agg(
        F.count("*").alias("leads"), F.max("year").alias("newest_year"), F.count_if("recent").alias("recent_leads"), F.count_if(F.col("year").isNull()).alias("undated"),
        F.element_at(F.array(*map(F.lit, LIKELIHOODS)), F.min("__r").cast("int")).alias("in_register"), F.coalesce(F.bool_or(F.col("is_edition") & (F.col("__r") <= 2)), F.lit(False)).alias("edition"),
    )
    decision = first_match([
        ("known - do not ask", "in_register = 'high' and not edition"), ("ask to update", "in_register in ('high', 'medium') and edition and recent_leads > 0"),
        ("check: may be known", "in_register = 'medium'"), ("ask: new", "recent_leads > 0"), ("undated - check by hand", "undated > 0"),
    ], "too old - do not ask")
    few = top_n(leads.select(product, "lead_id", "title"), [product], ["lead_id"], 3, "__k").groupBy(product)
    titles = few.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__k", "title"))), lambda s: s["title"]), " || ").alias("titles"))
    return out.withColumn("proposed", decision).join(titles, product, "left")


def value_review(points: DataFrame, value: str, in_evidence: str, match_type: str, echo: str) -> DataFrame:
    """points with review_priority (1 first) and review_reason; echo is the value that the prompt showed as its example."""
    missing, echoed = ~F.coalesce(F.col(in_evidence), F.lit(False)), F.coalesce(T.squish(F.col(value).cast("string")) == echo, F.lit(False))
    demoted = F.coalesce(F.contains(F.col(match_type), F.lit("demoted")), F.lit(False))
    reason = first_match([
        ("P1 reject: the prompt's example, not in the source", missing & echoed), ("P1 reject: not in the source", missing), ("P1 check: equals the prompt's example", echoed),
        ("P2 check: measure not named", demoted), ("P3 confirm: strong match", F.col(match_type).isin("exact", "comparable")),
    ], "P3 confirm: related")
    return points.withColumn("review_reason", reason).withColumn("review_priority", F.substring("review_reason", 2, 1).cast("int"))


def answers_against_key(answers: DataFrame, key: DataFrame, id_: str, said: str, truth: str, yes: str, skip: tuple[str, ...] = ("", "can't tell")) -> tuple[DataFrame, DataFrame]:
    """(measures in one row, disagreements) of reviewers' answers against the key; unanswered rows are left out."""
    both = answers.where(~F.coalesce(F.col(said), F.lit("")).isin(*skip)).join(key, id_)
    hit = (F.col(said) == yes) & (F.col(truth) == yes)
    ratio = lambda of: F.count_if(hit) / F.greatest(F.count_if(F.col(of) == yes), F.lit(1))
    measures = both.agg(F.count("*").alias("n"), F.count_if(F.col(said) == F.col(truth)).alias("agree"), ratio(truth).alias("yes_precision"), ratio(said).alias("yes_recall"))
    return measures, both.where(~F.col(said).eqNullSafe(F.col(truth)))


def letter_tier(rows: DataFrame, by: list[str], counted: Column, category: Column, score: Column, sure: int = 70, least: int = 45) -> DataFrame:
    """A group's tier from its best evidence."""
    x = rows.groupBy(*by).agg(F.bool_or(counted | (category == "A")).alias("a"), F.bool_or(category.isin("B", "C")).alias("b"), F.max(score).alias("best"))
    return x.select(*by, "best", first_match([("sure_bet", F.col("a") | (F.col("best") >= sure)), ("needs_review", F.col("b") | (F.col("best") >= least))], "low_bet").alias("tier"))


def first_joined(df: DataFrame, facts: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """df with columns of the first fact of its key; facts are reduced to one row a key before the join."""
    one = facts.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__f"))
    return df.join(one, key, "left").select(*df.columns, *[F.col(f"__f.{c}").alias(c) for c in columns])


def has_total_and_part(df: DataFrame, keys: list[str], level: str, total: str) -> DataFrame:
    """Keys with a value for the total and one for some part."""
    return df.groupBy(*keys).agg(F.countDistinct(F.when(F.col(level) == total, "total").when(F.col(level).isNotNull(), "part")).alias("__n")).where("__n = 2").select(*keys)
