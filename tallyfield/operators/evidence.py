"""Evidence in full: score with every bonus and cap, outreach category, comment, overview of processing, rollup by place, letters.

Rules are data; rows need the columns that the tables name. Unknown flags count as false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.places import lookup
from ..plans.rules import first_match, weighted

#: Points of the raw score beside core + 10 * framework, and what they ask for.
POINTS = (
    (15, "has_inclusion"), (15, "near"), (10, "birth_near"), (20, "office_led"), (25, "in_title"), (15, "trust like '%HIGH%'"), (10, "doc_type like 'PDF%'"),
    (12, "pub_year >= 2026"), (6, "pub_year = 2025"),
)
#: The most that a record can score, and for which; the first that holds counts. Null: no cap.
CAPS = (
    (0, "spam or false_positive"), (None, "override"), (25, "ambiguous_only"), (20, "got_text and core_strong = 0 and framework = 0 and migration = 0"),
    (30, "got_text and core_strong = 0 and framework = 0 and migration > 0"), (45, "inventory_only and not got_text"),
)
# Categories in order, with what each asks for.
CATEGORIES = (
    ("E. Suppress", "spam or false_positive"),
    ("E. Suppress", "got_text and core_strong = 0 and framework = 0 and migration = 0 and not override and not official and not (trust <=> 'HIGH (curated catalog)')"),
    ("C. Evidence lead only", "official_no_inclusion and not override"),
    ("C. Evidence lead only", "ambiguous_only and not override"),
    ("A. Strong NSO follow-up candidate", "(office_led or lead <=> 'likely country-led') and strong and has_office_contact"),
    ("D. Manual review needed", "(office_led or lead <=> 'likely country-led') and strong"),
    ("B. Strong candidate but partner-led or unclear lead", "strong and lead in ('likely partner-led', 'unclear')"),
    ("D. Manual review needed", "not got_text"),
    ("D. Manual review needed", "core_strong > 0"),
    ("C. Evidence lead only", "framework > 0 or migration > 0"),
)
FLAGS = ("has_inclusion", "near", "birth_near", "office_led", "in_title", "spam", "false_positive", "override", "ambiguous_only", "got_text", "inventory_only", "official", "strong", "has_office_contact")
NEXT_STEPS = (
    ("Manual review, then possible follow-up with the office.", "category like 'A%'"), ("Manual review to clarify the lead institution before any follow-up.", "category like 'B%'"),
    ("Keep as landscape context; no outreach for now.", "category like 'C%'"), ("Manual review needed.", "category like 'D%'"),
)


def scored(rows: DataFrame) -> DataFrame:
    """rows with score (0 to 100, beyond it only by override) and category."""
    df = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in FLAGS})
    df = df.withColumn("official_no_inclusion", F.expr("official and not has_inclusion and not in_title and core_strong = 0"))
    df = df.withColumn("__raw", F.col("core") + F.col("framework") * 10 + weighted(POINTS))
    capped = None
    for most, condition in CAPS:
        value = F.col("__raw") if most is None else F.least(F.col("__raw"), F.lit(most))
        capped = F.when(F.expr(condition), value) if capped is None else capped.when(F.expr(condition), value)
    return df.withColumns({"score": capped.otherwise(F.least(F.col("__raw"), F.lit(100))).cast("int"), "category": first_match(CATEGORIES, "D. Manual review needed")}).drop("__raw")


def comment(mentions: dict[str, str]) -> Column:
    """One plain paragraph on a scored record: what it is, what was found, who leads it, and the next step.

    mentions: count column and the words for it, in order. Other columns: language, doc_type, published, spam, false_positive, got_text, lead, has_inclusion, category.
    """
    found = F.concat_ws(", ", *[F.when(F.col(c) > 0, F.concat(F.lit(f"{words} ("), F.col(c).cast("string"), F.lit(")"))) for c, words in mentions.items()])
    finding = F.coalesce(
        first_match([
            ("Excluded: address or title point to unrelated commercial content.", "spam"), ("Suppressed: the match comes from an unrelated term.", "false_positive"), ("The text could not be read - check by hand.", "not got_text"), ("No terms of a population were found.", found == ""),
        ]), F.concat(F.lit("Screening found "), found, F.lit(".")),
    )
    kind = F.concat_ws(" ", F.coalesce("language", F.lit("Unknown-language")), F.when(F.col("doc_type").startswith("PDF"), "PDF document").otherwise("web page"), F.concat(F.lit("("), "published", F.lit(")")))
    leads = first_match([("It appears to be led by the country.", "lead = 'likely country-led'"), ("It appears to be led by a partner.", "lead = 'likely partner-led'"), ("The lead institution is unclear.", "lead = 'unclear'")])
    included = F.when(F.col("has_inclusion"), "A displaced group may be counted; verify the table.")
    return F.concat_ws(" ", F.concat(kind, F.lit(".")), finding, leads, included, F.lit("Next step:"), first_match(NEXT_STEPS, "No action - suppressed."))


def overview(registry: DataFrame, inventory: DataFrame, searches: DataFrame, records: DataFrame, place: str, order: str, most: int = 3) -> DataFrame:
    """One row a place of registry or inventory: what was done, what came of it, and what to do next.

    registry: place, languages (comma list); inventory: place, total, coverage; searches: one row a query done; records: place, title, score,
    category, got_text, has_office_contact. Each place expects three queries a language and one more. The contact test is made for each row.
    """
    done = searches.groupBy(place).agg(F.count("*").alias("n_done"))
    live = ~F.col("category").startswith("E")
    counts = records.groupBy(place).agg(
        F.count("*").alias("n_records"), F.count_if(live).alias("n_candidates"), F.count_if(F.col("category").startswith("A")).alias("n_high"), F.count_if(F.col("category").startswith("D")).alias("n_review"),
        F.count_if(~F.col("got_text")).alias("n_failed"), F.coalesce(F.bool_or("has_office_contact"), F.lit(False)).alias("has_contact"),
    )
    # suppressed records are ranked apart, not filtered: the optimiser takes very long over a filter on a nested rule table
    at = F.row_number().over(Window.partitionBy(place, "__live").orderBy(F.col("score").desc(), order))
    line = F.format_string("[%s] %s (score %d)", F.substring("category", 1, 1), F.substring("title", 1, 70), "score")
    listed = F.collect_list(F.when(F.col("__live"), F.struct("__at", line.alias("line"))))
    ranked = records.withColumn("__live", live).withColumn("__at", at).where(F.col("__at") <= most)
    top = ranked.groupBy(place).agg(F.nullif(F.array_join(F.transform(F.sort_array(listed), lambda x: x["line"]), " | "), F.lit("")).alias("top_candidates"))
    df = registry.join(inventory, place, "full")
    for more in (done, counts, top):
        df = df.join(more, place, "left")
    df = df.fillna(0, ["n_done", "n_records", "n_candidates", "n_high", "n_review", "n_failed"]).fillna(False, ["has_contact"])
    df = df.withColumn("n_expected", 3 * (F.regexp_count("languages", F.lit(",")) + 1) + 1)
    df = df.withColumn("status", first_match([("not started", "n_done = 0 and coverage is null"), ("failed", "coverage = 'NONE' and n_done = 0"), ("in progress", "n_done > 0 and n_done < n_expected")], "completed"))
    extraction = F.coalesce(first_match([("no records to extract", "n_records = 0"), ("all extracted", "n_failed = 0"), ("extraction failed", "n_failed = n_records")]), F.format_string("%d of %d failed", "n_failed", "n_records"))
    return df.withColumn("extraction", extraction).withColumns({
        "contact_search": first_match([("contact found", "has_contact"), ("no contact found - gap", "n_records > 0")], "not searched"),
        "failure": first_match([("no inventory and no search coverage", "status = 'failed'"), ("text extraction failed for all records", "extraction = 'extraction failed'")]),
        "next_action": first_match([
            ("candidate ready for possible follow-up (manual review first)", "n_high > 0 and has_contact"), ("candidate found but manual review needed", "n_review > 0"), ("contact gap - manual contact search", "n_records > 0 and not has_contact"),
            ("failed website access - retry or manual check", "status = 'failed'"), ("continue search (resumable)", "status = 'in progress'"), ("not yet processed", "status = 'not started'"), ("no evidence detected", "n_records = 0 and total > 0"),
        ], "insufficient automated coverage - manual check"),
    })


def place_rollup(fact: DataFrame, by: list[str]) -> DataFrame:
    """Sixteen measures of each place: records by category, register state and model, best score, whether there is a contact."""
    flag = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    letter, kind = F.substring("category", 1, 1), F.col("match_type")
    actionable = letter.isin("A", "B", "D")
    return fact.groupBy(*by).agg(
        F.count("*").alias("records"), flag(actionable).alias("actionable"), flag(actionable & ~F.coalesce("humanitarian", F.lit(False))).alias("official_actionable"), flag(F.col("humanitarian")).alias("humanitarian_records"),
        *[flag(letter == x).alias(f"n_{x.lower()}") for x in "ABCDE"], flag(F.col("register_flag") == "IN").alias("in_register"), flag(F.col("register_flag") == "NEW").alias("not_in_register"), F.max("score").alias("top_score"),
        F.bool_or(F.col("contact").isNotNull()).alias("has_contact"), flag(F.col("counted")).alias("confirmed_inclusion"), flag(kind.isin("new_place", "new_example_existing_place")).alias("new_examples"), flag(kind == "already_in_register").alias("known_examples"),
    )


def holdings(examples: DataFrame, files: DataFrame, confirmed: DataFrame, example: str) -> DataFrame:
    """Per example what the archive holds (files: example, name, told by its extension) and by which route the rest is got."""
    ext = F.lower(F.regexp_extract("name", r"\.([A-Za-z0-9]+)$", 1))
    held = files.groupBy(example).agg(
        F.bool_or(ext.isin("csv", "xlsx", "xls", "zip", "sav", "dta")).alias("has_data"), F.bool_or(ext.isin("pdf", "doc", "docx")).alias("has_document"), F.bool_or(F.lower("name").contains("candidate")).alias("has_candidate"), F.count("*").alias("n_files"),
    )
    df = examples.join(held, example, "left").fillna(False, ["has_data", "has_document", "has_candidate"]).fillna(0, ["n_files"]).join(confirmed.select(example, "dataset"), example, "left")
    route = [("confirmed dataset", "dataset is not null"), ("data in hand", "has_data"), ("extract from report in hand", "has_document"), ("fetch, then extract", "has_link")]
    return df.withColumns({"unverified_candidate": F.col("has_candidate") & ~F.col("has_data"), "route": first_match(route, "reach out (no online source)")})


def fact_precedence(contacts: DataFrame, precedence: DataFrame, contact: str) -> DataFrame:
    """The primary fact of each contact by rank, and as a secondary one its best meeting, unless the primary is a meeting.

    contacts: contact, tokens (array); precedence: token, rank, fact, meeting (one row a token). Contacts without any fact get none.
    """
    known = contacts.select(contact, F.explode(F.array_distinct("tokens")).alias("token")).join(precedence, "token")
    pick = lambda cond: F.min(F.when(cond, F.struct("rank", "fact", "meeting")))
    best = known.groupBy(contact).agg(pick(F.lit(True)).alias("p"), pick(F.col("meeting")).alias("m"))
    out = contacts.select(contact).join(best, contact, "left")
    return out.select(contact, F.coalesce("p.rank", F.lit(10)).alias("rank"), F.coalesce("p.fact", F.lit("none")).alias("primary_fact"), F.when(~F.col("p.meeting"), F.col("m.fact")).alias("secondary_fact"))


def letters(examples: DataFrame, contacts: DataFrame, templates: DataFrame, entity: str, order: str, most: int = 4) -> DataFrame:
    """One letter an entity with a contact: greeting, a line for each of its first `most` examples by score, and how many more there are.

    examples: entity, title, year, url, score; contacts: entity, name, email, language (one row an entity); templates: language, greeting, more
    (with %s and %d). A language without a template falls back to `en`.
    """
    at = F.row_number().over(Window.partitionBy(entity).orderBy(F.col("score").desc(), order))
    line = F.concat(F.lit("- "), F.coalesce("title", F.lit("(untitled)")), F.coalesce(F.concat(F.lit(" ("), F.col("year").cast("string"), F.lit(")")), F.lit("")), F.coalesce(F.concat(F.lit(": "), "url"), F.lit("")))
    total = examples.groupBy(entity).agg(F.count("*").alias("n_examples"))
    lines = examples.withColumn("__at", at).where(F.col("__at") <= most).groupBy(entity).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__at", line.alias("line")))), lambda x: x["line"]), "\n").alias("bullets"))
    words = templates.select(F.col("language").alias("__lang"), "greeting", "more")
    fallback = contacts.join(words, F.col("language") == F.col("__lang"), "left").join(F.broadcast(words.where("__lang = 'en'").limit(1).select(F.col("greeting").alias("__g"), F.col("more").alias("__m"))), how="left")
    df = fallback.join(lines, entity).join(total, entity)
    more = F.col("n_examples") - most
    said = F.concat_ws("\n", F.replace(F.coalesce("greeting", "__g"), F.lit("%s"), F.coalesce("name", F.lit("colleague"))), "bullets", F.when(more > 0, F.replace(F.coalesce("more", "__m"), F.lit("%d"), more.cast("string"))))
    return df.select(entity, "email", "n_examples", said.alias("body"))


def organisation_drafts(matched: DataFrame, contacts: DataFrame, org: str, order: str) -> DataFrame:
    """One draft an organisation: who it goes to, who gets copies, its number of distinct titles, and what a person must check first.

    matched: org (null: held, none made), title, weak, confidence; contacts: org, email, rank. Organisations without a contact are flagged `no contact`.
    """
    per = matched.where(F.col(org).isNotNull()).groupBy(org, "title").agg(F.bool_or("weak").alias("weak"), F.min("confidence").alias("confidence"))
    orgs = per.groupBy(org).agg(F.count("*").alias("n_titles"), F.bool_or("weak").alias("__weak"), (F.avg(F.when(F.col("confidence") == "low", 1.0).when(F.col("confidence").isNotNull(), 0.0)) > 0.5).alias("__low"))
    to = contacts.groupBy(org).agg(F.min_by("email", F.struct("rank", order)).alias("to_email"), (F.count("*") - 1).alias("n_copies"))
    flags = F.concat_ws("; ", F.when(F.col("__weak"), "weak organisation match"), F.when(F.col("__low"), "mostly low confidence"), F.when(F.col("to_email").isNull(), "no contact"))
    return orgs.join(to, org, "left").select(org, "n_titles", "to_email", F.coalesce("n_copies", F.lit(0)).alias("n_copies"), flags.alias("flags"))


def structured_records(cells: DataFrame, flow: str, source: str, label: str, names: dict[str, str], aggregates: list[str]) -> DataFrame:
    """Records of the master schema, one a place of a statistical flow (cells: geo, geo_label, year); totals of regions go."""
    geo = F.col("geo")
    rows = cells.where(geo.rlike("^[A-Z]{2}$") & ~geo.isin(*aggregates)).groupBy("geo").agg(F.max("year").alias("year"), F.min("geo_label").alias("geo_label"))
    return rows.select(
        F.coalesce(lookup(geo, names), F.col("geo_label")).alias("country"), F.format_string(f"{label} (%d)", "year").alias("title"), F.concat(F.lit(f"{flow}?geo="), geo).alias("url"), "year",
        F.lit(source).alias("producer"), F.lit("STRUCT").alias("source_layer"), F.lit("HIGH (structured API)").alias("trust"),
    )


def catalogue_match(catalogue: DataFrame, register: DataFrame, in_hand: DataFrame, letters_: int = 6) -> DataFrame:
    """Entries of a catalogue whose nation holds the first letters of a registered place, with the first such place and whether its file is in hand.

    Every substring of a nation's name with that length is a key, so the join is by equality; shorter places are tried at their own length.
    """
    places = register.select("place").distinct().withColumn("__key", F.lower(F.substring("place", 1, letters_))).where("__key != ''")
    sizes = F.sequence(F.lit(1), F.lit(letters_))
    nation = F.lower(F.coalesce("nation", F.lit("")))
    grams = F.array_distinct(F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(nation) - k + 1, F.lit(1))), lambda i: F.substr(nation, i, k)))))
    hit = catalogue.select("idno", F.explode(grams).alias("__key")).join(places, "__key").groupBy("idno").agg(F.min("place").alias("place"))
    held = in_hand.select("idno").distinct().withColumn("in_hand", F.lit(True))
    return catalogue.join(hit, "idno").join(held, "idno", "left").withColumn("in_hand", F.coalesce("in_hand", F.lit(False)))


def star_pack(records: DataFrame, contacts: DataFrame, place: str) -> dict[str, DataFrame]:
    """fact (records with letter), dim (place_rollup by place) and contacts (one row an address of a place) of a report's data model."""
    fact = records.withColumn("letter", F.substring("category", 1, 1))
    mails = contacts.select(place, F.explode(T.emails(F.col("text"), most=None)).alias("email")).distinct()
    return {"fact": fact, "dim": place_rollup(records, [place]), "contacts": mails}
