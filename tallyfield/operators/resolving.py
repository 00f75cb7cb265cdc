"""Resolving register examples to studies and data: matches with years and programmes, requests, worklists, holds and the report pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..plans.rules import first_match
from ..sources.io import enforce_schema
from .joins import jaccard


def _set(c: str) -> Column:
    return F.array_sort(F.array_distinct(F.coalesce(F.col(c), F.array().cast("array<string>"))))


def prefix_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pairs (l, r) of distinct keys of which one begins with the other, in lower case; null and empty keys match nothing.

    Each key is exploded into its beginnings, so both directions are equi-joins.
    """
    names = lambda df, n: df.select(F.col(key).alias(n)).where(F.col(key) != "").distinct().withColumn(f"{n}l", F.lower(n))
    a, b = names(left, "l"), names(right, "r")
    starts = lambda c: F.explode(F.transform(F.sequence(F.lit(1), F.length(c)), lambda k: F.substring(c, F.lit(1), k)))
    long_left = a.withColumn("k", starts(F.col("ll"))).join(b, F.col("k") == F.col("rl")).select("l", "r")
    long_right = b.withColumn("k", starts(F.col("rl"))).join(a, F.col("k") == F.col("ll")).select("l", "r")
    return long_left.unionByName(long_right).distinct()


def blended_match(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, title: str, org: str, weights: tuple[float, float] = (0.6, 0.4), threshold: float = 0.2) -> DataFrame:
    """Each left row's best right row of its block by weighted Jaccard of title and organisation tokens (ties to the smaller id).

    left, right: token arrays `title` and `org` (null: empty). Below the threshold match_id is null; left rows all stay.
    Rows with equal token sets are one node. Nodes that share a title word are scored in full; all others can only score by
    their organisation, so for these distinct organisations are compared, and each gives its smallest id. That bound is
    the true score wherever it wins, so no pair is lost.
    """
    w_title, w_org = weights
    r = right.select(F.col(block).alias("b"), _set(title).alias("rt"), _set(org).alias("ro"), F.col(right_id).alias("r")).groupBy("b", "rt", "ro").agg(F.min("r").alias("r"))
    mine = left.withColumns({"__b": F.col(block), "__t": _set(title), "__o": _set(org)})
    nodes = mine.select(F.col("__b").alias("b"), F.col("__t").alias("lt"), F.col("__o").alias("lo")).distinct()
    shared = nodes.withColumn("k", F.explode("lt")).join(r.withColumn("k", F.explode("rt")), ["b", "k"]).groupBy("b", "lt", "lo", "rt", "ro", "r").agg(F.count("*").alias("n"))
    score = w_title * (F.col("n") / (F.size("lt") + F.size("rt") - F.col("n"))) + w_org * jaccard(F.col("lo"), F.col("ro"))
    by_title = shared.select("b", "lt", "lo", "r", score.alias("s")).where(F.col("s") >= threshold).groupBy("b", "lt", "lo").agg(F.min(F.struct((-F.col("s")).alias("s"), "r")).alias("m1"))
    offices = nodes.select("b", "lo").distinct().withColumn("k", F.explode("lo")).join(r.groupBy("b", "ro").agg(F.min("r").alias("r")).withColumn("k", F.explode("ro")), ["b", "k"])
    alone = offices.groupBy("b", "lo", "ro", "r").agg(F.count("*").alias("n")).withColumn("s", w_org * (F.col("n") / (F.size("lo") + F.size("ro") - F.col("n"))))
    by_org = alone.where(F.col("s") >= threshold).groupBy("b", "lo").agg(F.min(F.struct((-F.col("s")).alias("s"), "r")).alias("m2"))
    best = nodes.join(by_title, ["b", "lt", "lo"], "left").join(by_org, ["b", "lo"], "left").select(F.col("b").alias("__b"), F.col("lt").alias("__t"), F.col("lo").alias("__o"), F.least("m1", "m2").alias("__m"))
    return mine.join(best, ["__b", "__t", "__o"], "left").select(*left.columns, F.col("__m.r").alias("match_id"), (-F.col("__m.s")).alias("match_score"))


def closest_study(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, tokens: str, year: str, unknown: int = 9) -> DataFrame:
    """Each left row's study of its block by title similarity, then year gap, then smaller id, with how far it can be trusted.

    A gap with an unknown year counts `unknown`. A row whose words no study shares gets the study nearest in years (weak);
    a row without any study in its block gets `no match`. Rows with equal words and year are one node, so repeated titles
    are compared once; studies that share no word are only looked at by distinct years.
    """
    r = right.select(F.col(block).alias("b"), _set(tokens).alias("rt"), F.col(year).alias("ry"), F.col(right_id).alias("r")).groupBy("b", "rt", "ry").agg(F.min("r").alias("r"))
    mine = left.withColumns({"__b": F.col(block), "__t": _set(tokens), "__y": F.col(year)})
    nodes = mine.select(F.col("__b").alias("b"), F.col("__t").alias("lt"), F.col("__y").alias("ly")).distinct()
    gap = F.coalesce(F.abs(F.col("ly") - F.col("ry")), F.lit(unknown)).cast("int").alias("gap")
    shared = nodes.withColumn("k", F.explode("lt")).join(r.withColumn("k", F.explode("rt")), ["b", "k"]).groupBy("b", "lt", "ly", "rt", "ry", "r").agg(F.count("*").alias("n"))
    s = (-(F.col("n") / (F.size("lt") + F.size("rt") - F.col("n")))).alias("s")
    by_word = shared.select("b", "lt", "ly", F.struct(s, gap, "r").alias("m")).groupBy("b", "lt", "ly").agg(F.min("m").alias("m1"))
    years = nodes.select("b", "ly").distinct().join(r.groupBy("b", "ry").agg(F.min("r").alias("r")), "b")
    by_year = years.select("b", F.col("ly").alias("ly"), F.struct(F.lit(0.0).alias("s"), gap, "r").alias("m")).groupBy("b", "ly").agg(F.min("m").alias("m2"))
    x = by_word.toDF("__xb", "__xt", "__xy", "__m1")
    y = by_year.toDF("__yb", "__yy", "__m2")
    out = mine.join(x, (F.col("__b") == F.col("__xb")) & (F.col("__t") == F.col("__xt")) & F.col("__y").eqNullSafe(F.col("__xy")), "left")
    out = out.join(y, (F.col("__b") == F.col("__yb")) & F.col("__y").eqNullSafe(F.col("__yy")), "left").withColumn("__m", F.least("__m1", "__m2"))
    sim, near = -F.col("__m.s"), F.col("__m.gap") <= 1
    confidence = first_match([
        ("no match", F.col("__m").isNull()), ("STRONG", (sim >= 0.30) | ((sim >= 0.18) & near)), ("MEDIUM", (sim >= 0.15) | ((sim >= 0.08) & near)),
    ], "weak")
    return out.select(*left.columns, F.col("__m.r").alias("match_id"), F.abs(F.col("__m.s")).alias("similarity"), F.col("__m.gap").alias("gap"), confidence.alias("confidence"))


#: Programmes whose numbers are stocks of people, not socio-economic data.
STOCK = ("DTM", "CENSUS", "PROTMON")


def programme_match(left: DataFrame, right: DataFrame, place: str, left_id: str, right_id: str, codes: str, year: str, stock: tuple[str, ...] = STOCK, unknown: int = 9) -> DataFrame:
    """Each left row's study with most shared programme codes, then the smaller year gap, then the smaller id; kind and verdict.

    Places match if one begins with the other. Rows with equal place, codes and year are one node on either side, so work
    grows with the combinations of codes that occur, not with rows. Left rows without codes or match stay, with a verdict of their own.
    """
    names = prefix_pairs(left, right, place).select(F.col("l").alias("lp"), F.col("r").alias("rp"))
    r = right.select(F.col(place).alias("rp"), _set(codes).alias("rc"), F.col(year).alias("ry"), F.col(right_id).alias("r")).where(F.size("rc") > 0).groupBy("rp", "rc", "ry").agg(F.min("r").alias("r"))
    mine = left.withColumns({"__p": F.col(place), "__k": _set(codes), "__y": F.col(year)})
    nodes = mine.select(F.col("__p").alias("lp"), F.col("__k").alias("lc"), F.col("__y").alias("ly")).where(F.size("lc") > 0).distinct()
    # combinations of codes meet by a shared code, without their years; those that share most stay
    pairs = nodes.select("lp", "lc").distinct().join(names, "lp").withColumn("c", F.explode("lc")).join(r.select("rp", "rc", F.explode("rc").alias("c")).distinct(), ["rp", "c"])
    pairs = pairs.select("lp", "lc", "rp", "rc").distinct().withColumn("codes", F.array_intersect("rc", "lc")).withColumn("n", F.size("codes"))
    most = pairs.groupBy("lp", "lc").agg(F.max("n").alias("n"))
    studies = pairs.join(most, ["lp", "lc", "n"]).join(r, ["rp", "rc"]).groupBy("lp", "lc", "ry").agg(F.min(F.struct("r", "codes")).alias("s"))
    gap = F.coalesce(F.abs(F.col("ly") - F.col("ry")), F.lit(unknown)).cast("int").alias("gap")
    best = nodes.join(studies, ["lp", "lc"]).select("lp", "lc", "ly", F.struct(gap, "s.r", "s.codes").alias("m")).groupBy("lp", "lc", "ly").agg(F.min("m").alias("__m"))
    best = best.select(F.col("lp").alias("__lp"), F.col("lc").alias("__lc"), F.col("ly").alias("__ly"), "__m")
    out = mine.join(best, (F.col("__p") == F.col("__lp")) & (F.col("__k") == F.col("__lc")) & F.col("__y").eqNullSafe(F.col("__ly")), "left")
    found, shared = F.col("__m").isNotNull(), F.col("__m.codes")
    kind = F.when(found, F.when(F.size(F.array_except(shared, F.array(*map(F.lit, stock)))) == 0, "STOCK (deprioritise)").otherwise("socio-economic"))
    verdict = first_match([("programme match", F.col("__m.gap") <= 2), ("programme match (different year - check)", found)], "no programme match -> reach out / not published")
    return out.select(*left.columns, F.col("__m.r").alias("match_id"), F.array_join(shared, ",").alias("programmes"), F.col("__m.gap").alias("gap"), kind.alias("kind"), verdict.alias("verdict"))


def to_source(roster: DataFrame, trusted: DataFrame, recovered: DataFrame, example: str) -> DataFrame:
    """Roster rows without a trusted dataset: what became of the link that was recovered, and what to do next.

    roster: example, lead_type, has_link; recovered: example, verdict (one row an example).
    """
    out = roster.join(trusted.select(example).distinct(), example, "left_anti").join(recovered.select(example, F.col("verdict").alias("recovered_verdict")), example, "left")
    link = F.when(F.col("has_link"), "roster link present but not usable/dead").otherwise("no link in the record")
    action = F.when(F.col("lead_type") == "country-led", "search public availability (NSO site / statbank), then reach out").otherwise("reach out to reporting office (likely gated microdata)")
    return out.withColumns({"roster_link": link, "suggested_action": action})


#: Why the data of an example must be asked for, told from its title and description, then from its office.
NOT_YET = "plan|forthcoming|will |2026|under revision|mapping|launched|design"
HELD_BY = (
    ("office-held (WHO)", "who|world health"), ("JIPS exercise - not on portal", "jips|joint idp profiling"),
    ("NSO-held - request from office/site", "instituto nacional|national statistic|bureau of statistic|national institute of statist"),
)


def reach_out_list(roster: DataFrame, done: DataFrame, example: str) -> DataFrame:
    """The final list: rows with a place that may hold microdata and are neither in hand nor requested, each with its reason.

    roster: example, country, organisation, title, description, is_microdata; null texts count as empty.
    """
    said = F.lower(F.concat_ws(" ", "title", "description"))
    office = F.lower(F.coalesce("organisation", F.lit("")))
    reason = first_match([("forthcoming / not yet collected", said.rlike(NOT_YET)), *[(name, office.rlike(p)) for name, p in HELD_BY]], "exact study not online - request from office")
    wanted = roster.where(F.coalesce("is_microdata", F.lit(False)) & (F.coalesce("country", F.lit("")) != "")).join(done.select(example).distinct(), example, "left_anti")
    return wanted.select(example, "country", F.substring("organisation", 1, 40).alias("organisation"), F.substring("title", 1, 50).alias("title"), reason.alias("reason"))


#: Kind of survey, its rank of ease, how it is got, its status of access and its portal.
ROUTES = (
    ("MICS", "UNICEF MICS portal (mics.unicef.org) - register once, then free microdata download", "1 DOWNLOAD NOW - free (register once at MICS portal, request the survey)", "https://mics.unicef.org/surveys"),
    ("living conditions/LSMS", "World Bank Microdata (microdata.worldbank.org) - Public-Use: accept terms & download; Licensed: apply", "2 MOSTLY PUBLIC-USE - accept terms & download; some licensed (apply)", "https://microdata.worldbank.org"),
    ("labour force", "ILO/NSO or World Bank Microdata - often Public-Use or on the national statistics office site", "2 MOSTLY PUBLIC-USE - WB/NSO, accept terms; some on national site only", "https://microdata.worldbank.org  (or national statistics office)"),
    ("DHS", "DHS Program (dhsprogram.com) - free account + short request, approved in ~1 day", "1 DOWNLOAD NOW - free account (register at DHS, short data request ~1 day)", "https://dhsprogram.com/data/available-datasets.cfm"),
    ("FDP socio-economic", "UNHCR Microdata (microdata.unhcr.org) / World Bank - usually Licensed: apply with intended use", "3 APPLY - licensed request (intended-use form, committee review)", "https://microdata.unhcr.org"),
)
OTHER_ROUTE = ("IHSN catalog record - follow 'Get Microdata' to the hosting repository", "4 CHECK record - follow 'Get Microdata' to the host repository", "https://catalog.ihsn.org")


def dataset_worklist(surveys: DataFrame) -> DataFrame:
    """surveys with ease_rank, download_route, access_status, portal and yr (of the year, else of the survey's name, else 0).

    surveys: country, type, survey, year (text), catalog. The order of work is ease_rank, country, yr from the newest.
    """
    pick = lambda at: first_match([(row[at], F.col("type") == row[0]) for row in ROUTES], OTHER_ROUTE[at - 1])
    ease = first_match([(str(k), F.col("type") == row[0]) for k, row in enumerate(ROUTES, 1)], str(len(ROUTES) + 1)).cast("int")
    return surveys.withColumns({"ease_rank": ease, "download_route": pick(1), "access_status": pick(2), "portal": pick(3), "yr": F.coalesce(T.year_of(F.col("year")), T.year_of(F.col("survey")), F.lit(0))})


def dataset_shortlist(work: DataFrame) -> DataFrame:
    """The newest survey of each country and type by its year alone (ties to the smaller catalogue address), a partial aggregate."""
    rest = [c for c in work.columns if c not in ("country", "type", "catalog")]
    newest = F.struct((-F.coalesce(T.year_of(F.col("year")), F.lit(0))).alias("__n"), F.col("catalog"), *rest)
    return work.groupBy("country", "type").agg(F.min(newest).alias("m")).select("country", "type", "m.catalog", *[f"m.{c}" for c in rest])


def applications(resolved: DataFrame, wording: str) -> DataFrame:
    """The surveys that must be applied for, with the text of the application; wording holds {survey} and {country}."""
    text = F.replace(F.replace(F.lit(wording), F.lit("{survey}"), F.coalesce("survey", F.lit(""))), F.lit("{country}"), F.coalesce("country", F.lit("")))
    return resolved.where(F.col("access_status").startswith("3")).withColumn("application_text", text)


def hold_list(unmatched: DataFrame, block: str, org: str, domain: str) -> DataFrame:
    """Organisations that no contact is known of: one row a name (several in one text are split), its examples, site and page to ask.

    The site is the smallest domain that is not empty. An empty or null organisation is left out.
    """
    per = unmatched.groupBy(block, org).agg(F.count("*").alias("n_examples"), F.coalesce(F.min(F.nullif(F.col(domain), F.lit(""))), F.lit("")).alias("website"))
    out = per.select(block, F.explode(F.split(org, r"\s*(?:/|;|\||\+|\n| & )\s*")).alias("name"), "n_examples", "website").select(block, T.squish(F.col("name")).alias("institution"), "n_examples", "website")
    page = F.when(F.col("website") != "", F.concat(F.lit("https://"), "website")).otherwise("")
    return out.where("institution <> ''").withColumns({"suggested_contact_page": page, "reason": F.lit("no verified address")})


#: Marks of drafts that a person must look at, in their order.
DRAFT_MARKS = (
    ("[NO RELATIONSHIP FOUND]", "primary_fact = 'none'"), ("[WEAK CONTACT MATCH]", "weak"), ("[Ms/Mr UNRESOLVED]", "honorific"), ("[NAME CHECK]", "name_check"), ("[WEAK SCOPE MATCH]", "low_confidence > 0.5"),
    ("[OPENER FELL BACK TO TEMPLATE]", "fell_back"), ("[BODY SENTENCE NEEDS CHECK]", "flagged"),
)


def draft_register(matched: DataFrame, contacts: DataFrame, block: str, org: str, order: str, most: int = 10) -> DataFrame:
    """One row an organisation of a block with a contact: to whom, how many get copies, its distinct titles, and its marks.

    matched: block, org, title, weak, confidence; contacts: block, org, email, name_check, honorific, rank, primary_fact, fell_back, flagged,
    bilingual. The first contact by rank and order is written to (draft_copies() gives the others). Titles are counted once; a title
    is of low confidence if the first of its confidences in the alphabet is `low`. Organisations without contact give no row. Partial aggregates only.
    """
    titles = matched.where(F.col(org).isNotNull()).groupBy(block, org, "title").agg(F.bool_or("weak").alias("weak"), F.min("confidence").alias("c"))
    per = titles.groupBy(block, org).agg(F.count("*").alias("n_examples"), F.bool_or("weak").alias("weak"), F.avg((F.col("c") == "low").cast("int")).alias("low_confidence"))
    row = F.struct("rank", order, "email", "primary_fact", "honorific", "fell_back", "flagged", "bilingual")
    who = contacts.groupBy(block, org).agg(F.min(row).alias("to"), (F.count("*") - 1).alias("n_copies"), F.bool_or("name_check").alias("name_check"))
    out = per.join(who, [block, org]).select(block, org, "n_examples", "weak", "low_confidence", "n_copies", "name_check", "to.*")
    long, local = F.format_string("[LONG LIST - %d EXAMPLES]", F.col("n_examples")), F.coalesce("bilingual", F.lit(False))
    marks = F.array_compact(F.array(*[F.when(F.coalesce(F.expr(cond), F.lit(False)), F.lit(name)) for name, cond in DRAFT_MARKS], F.when(F.col("n_examples") > most, long), F.when(local, F.lit("[NEEDS NATIVE CHECK]"))))
    return out.select(block, org, "n_examples", F.col("email").alias("to_email"), "n_copies", "primary_fact", F.array_join(marks, " ").alias("flags"))


def draft_copies(contacts: DataFrame, block: str, org: str, order: str) -> DataFrame:
    """Every contact but the first by rank and order, one row each: who gets copies of the organisation's draft."""
    first = contacts.groupBy(block, org).agg(F.min(F.struct("rank", order)).alias("__first"))
    return contacts.join(first, [block, org]).where(F.struct("rank", order) != F.col("__first")).select(block, org, "email", "rank", order)


def shared_addresses(drafts: DataFrame, copies: DataFrame) -> DataFrame:
    """Addresses (without case and outer blanks) that stand in more than one place of drafts and copies; a sound register gives no row."""
    each = drafts.select(F.col("to_email").alias("email")).unionByName(copies.select("email")).select(F.lower(T.squish(F.col("email"))).alias("email"))
    return each.where("email <> ''").groupBy("email").agg(F.count("*").alias("n")).where("n > 1")


#: The report's columns, in a locked order: what records of the master schema give, and what is derived of them here.
FACT = (
    "data_source string, country string, title string, dashboard_title string, url string, category string, category_letter string, humanitarian boolean, register_flag string, in_register string, "
    "lead_type string, score double, language string, year int, source_layer string, trust string, populations string, priority int, route string, primary_contact string, primary_type string, comment string, "
    "is_actionable boolean, is_suppressed boolean, is_official_actionable boolean, map_country string, iso3 string, is_single_country boolean, match_type string, matched_id string, similarity double, relevance double, counted boolean, is_reviewed boolean"
)
CONTACTS = "data_source string, country string, title string, email string, contact_type string, contact_source string, rank string, map_country string, iso3 string, is_single_country boolean"
REGISTER_WORDS = (("unknown (not compared)", "register_flag is null"), ("Yes - matches a reported project", "register_flag = 'IN'"), ("Possibly - the country reports", "register_flag = 'POSSIBLE'"), ("No - not yet reported", "register_flag = 'NEW'"), ("Multi-country - review per country", "register_flag like 'MULTI%'"))


def fact_table(records: DataFrame, data_source: str, schema: str = FACT) -> DataFrame:
    """Records as the report's fact table: derived flags, columns in locked order (absent ones null, others dropped).

    records: country, title, url, category, humanitarian, register_flag, relevance (null: not reviewed) and whatever else is to be kept; the
    columns of the map come from places.geo_harmonize() before. Rows without a category have letter `?`.
    """
    letter = F.substring(F.coalesce("category", F.lit("?")), 1, 1)
    actionable = letter.isin("A", "B", "D")
    out = records.withColumns({
        "data_source": F.lit(data_source), "dashboard_title": F.concat(F.lit(f"[{data_source}] "), F.coalesce("title", "url", F.lit(""))), "category_letter": letter,
        "in_register": F.coalesce(first_match(list(REGISTER_WORDS)), F.col("register_flag")), "is_actionable": actionable, "is_suppressed": letter == "E",
        "is_official_actionable": actionable & ~F.coalesce("humanitarian", F.lit(False)), "is_reviewed": F.col("relevance").isNotNull(),
    })
    return enforce_schema(out, StructType.fromDDL(schema))


def contact_table(records: DataFrame, data_source: str, schema: str = CONTACTS) -> DataFrame:
    """One row an address of a country, first as primary, then as secondary contact (ties to the smaller title, then type).

    records: country, title, and primary_/secondary_ with contact, type and source.
    """
    side = lambda name, at: records.select("country", "title", F.col(f"{name}_contact").alias("email"), F.col(f"{name}_type").alias("contact_type"), F.col(f"{name}_source").alias("contact_source"), F.lit(name).alias("rank"), F.lit(at).alias("at"))
    both = side("primary", 0).unionByName(side("secondary", 1)).where("email is not null")
    best = both.groupBy("country", "email").agg(F.min(F.struct("at", "title", "contact_type", "contact_source", "rank")).alias("m")).select("country", "email", "m.*")
    return enforce_schema(best.withColumn("data_source", F.lit(data_source)), StructType.fromDDL(schema))
