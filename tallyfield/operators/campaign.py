"""From scored records to requests: who is asked, by which route, for what; and what is got without asking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import records as N
from ..functions import text as T
from ..functions.classify import product_type
from ..plans.rules import first_match, rank_of

# Roles that fit a request, words that mark a statistical office, levels of evidence.
ROLES = "statist|population|demograph|migration|census|social statistics|vital|director general|chief statist"
LEVELS = ("none", "text", "table", "microdata")
CENSUS_TITLE = "census|recensement|censo|rgph|nphc"
ORG_LEAST, ORG_WEAK, OFFICE_BONUS = 0.30, 0.34, 0.30

#: Ease of getting a record's data: tier, method, and the condition for it; the first that holds counts.
EASE = (
    (1, "already in hand", "in_hand"),
    (2, "statistical interface", "by_interface"),
    (3, "direct data-file link", "has_file_link"),
    (4, "page with dataset (fetch+extract)", "reachability = 'live' and source_type = 'web_page' and drilled"),
    (5, "scrape live page/office site", "reachability = 'live' or found"),
    (6, "needs browser (blocked)", "reachability = 'blocked'"),
)
RELIABILITY = ("CONFIRMED", "roster-own", "SUSPECT", "MISMATCH", "-")


def never_responded(contacts: DataFrame, responses: DataFrame, key: str, sentinel: str = "INST") -> DataFrame:
    """Entities with a contact and no response, as rows of the response history (status NEVER)."""
    asked = contacts.where(F.col(key).isNotNull() & (F.col(key) != sentinel)).select(key).distinct()
    return asked.join(responses.select(key), key, "left_anti").withColumns({"status": F.lit("NEVER"), "n_responses": F.lit(0).cast("long")})


def org_matches(examples: DataFrame, orgs: DataFrame, place: str, generic: tuple[str, ...] = (), office_words: tuple[str, ...] = ("statistics", "statistical", "statistik")) -> DataFrame:
    """example_id, org_id, score, weak: the organisation of the same place whose name shares most words (Jaccard).

    examples: example_id, place, org, is_office; orgs: org_id, place, org. Offices score 0.30 more where the candidate's name
    holds an office word. Below 0.30 there is no match and org_id is null (to be held); below 0.34 it is weak. Examples of one
    place, name and kind are one node, organisations of one place with equal words another, which stands for its smallest id. Pairs of
    nodes are made by shared (place, word) keys; an office also meets the candidates of its place that hold an office word, one best of
    these by id, as without a shared word all of them score the same.
    """
    as_set = F.array_sort(T.content_tokens(F.col("org"), generic)).alias("words")
    node = [place, "org", "is_office"]
    asked = examples.select("example_id", place, "org", F.coalesce("is_office", F.lit(False)).alias("is_office"))
    left = asked.select(*node).distinct().select(*node, as_set).where(F.size("words") > 0)
    right = orgs.select("org_id", place, as_set).where(F.size("words") > 0).groupBy(place, "words").agg(F.min("org_id").alias("org_id"))
    marked = F.arrays_overlap("words", F.array(*[F.lit(w) for w in office_words]))
    a = left.select(*node, F.size("words").alias("n"), F.explode("words").alias("word"))
    b = right.select("org_id", place, F.col("words").alias("named"), marked.alias("marked"), F.size("words").alias("m"), F.explode("words").alias("word"))
    shared = a.join(b, [place, "word"]).groupBy(*node, "org_id", "named").agg(F.count("*").alias("k"), F.first("n").alias("n"), F.first("m").alias("m"), F.first(F.col("is_office") & F.col("marked")).alias("bonus"))
    bonus = F.when(F.col("bonus"), OFFICE_BONUS).otherwise(0.0)
    scored = shared.select(*node, "org_id", (F.col("k") / (F.col("n") + F.col("m") - F.col("k")) + bonus).alias("score"))
    first_office = right.where(marked).groupBy(place).agg(F.min("org_id").alias("org_id"))
    alone = left.where("is_office").join(first_office, place).select(*node, "org_id", F.lit(OFFICE_BONUS).alias("score"))
    best = scored.unionByName(alone).groupBy(*node).agg(F.min(F.struct((-F.round("score", 9)).alias("s"), "org_id")).alias("b"))
    out = asked.join(best, node, "left")
    score = F.coalesce(-F.col("b.s"), F.lit(0.0))
    return out.select("example_id", F.when(score >= ORG_LEAST, F.col("b.org_id")).alias("org_id"), score.alias("score"), (score < ORG_WEAK).alias("weak"))


def weighted_units(units: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """Units with their weights; units without a weight and weights without a unit go."""
    return units.join(weights, keys)


def bounced(log: DataFrame, notices: DataFrame, email: str = "to_email") -> DataFrame:
    """log with bounced: whether a delivery failure names its own address (as failed_email, else anywhere in its body).

    Only addresses of the log are marked, never others that a notice mentions.
    """
    norm = lambda c: F.lower(F.trim(c))
    named = F.when(F.trim(F.coalesce("failed_email", F.lit(""))) != "", F.array("failed_email")).otherwise(F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(T.EMAIL), 1))
    failed = notices.select(F.explode(named).alias("e")).select(norm(F.col("e")).alias("__email")).distinct().withColumn("bounced", F.lit(True))
    return log.withColumn("__email", norm(F.col(email))).join(failed, "__email", "left").select(*log.columns, F.coalesce("bounced", F.lit(False)).alias("bounced"))


def record_rollup(records: DataFrame, by: str, order: str) -> DataFrame:
    """Counts of records by outreach category, the first known contact and the first title of each entity, by order."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    starts = lambda x: F.count_if(F.col("category").startswith(x))
    return records.groupBy(by).agg(
        F.count("*").alias("n_evidence"), F.count_if("is_new").alias("n_new"), starts("A").alias("n_strong"), starts("B").alias("n_partner"), starts("D").alias("n_review"),
        first("contact").alias("contact"), first("title").alias("example"),
    )


def best_evidence(evidence: DataFrame, example: str) -> DataFrame:
    """Per example: best level of identification, its variables in microdata, groups named, computable and evidenced concepts.

    evidence: example, concept, kind (identification or indicator), level (of LEVELS).
    """
    ident, computable = F.col("kind") == "identification", (F.col("kind") == "indicator") & F.col("level").isin("microdata", "table")
    listed = lambda cond, sep: F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col("concept")))), sep)
    return evidence.groupBy(example).agg(
        F.coalesce(F.try_element_at(F.array(*[F.lit(x) for x in LEVELS]), F.max(F.when(ident, rank_of("level", LEVELS)))), F.lit("none")).alias("id_best"),
        F.count_if(ident & (F.col("level") == "microdata")).alias("id_variables"),
        listed(ident, ";").alias("groups"), F.coalesce(F.bool_or(F.col("concept") == "host_community"), F.lit(False)).alias("host_evidenced"),
        listed(computable, "; ").alias("computable"), listed(F.col("kind") == "indicator", "; ").alias("evidenced"), F.count_distinct(F.when(computable, F.col("concept"))).alias("n_computable"),
    )


def enriched_frame(frame: DataFrame, evidence: DataFrame, example: str) -> DataFrame:
    """frame with best_evidence() and the capability to identify groups that it shows."""
    df = frame.join(best_evidence(evidence, example), example, "left").fillna({"id_best": "none", "id_variables": 0, "n_computable": 0})
    rules = [("computable (microdata)", "id_variables >= 3"), ("partial (microdata)", "id_best = 'microdata'"), ("aggregate table", "id_best = 'table'"), ("text evidence only", "id_best = 'text'")]
    return df.withColumn("id_capability", first_match(rules, "none in downloaded data"))


def catalogue_entries(manifest: DataFrame) -> DataFrame:
    """One row a catalogue entry (base address, entry's number): places and populations as sorted lists, first url and its title."""
    base, entry = F.regexp_extract("url", "^(https?://[^/]+)", 1), F.regexp_extract("url", "/catalog/([0-9]+)", 1)
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ";")
    rows = manifest.where(F.col("status") == "ok").withColumns({"base": base, "cat_id": entry}).where("base != '' and cat_id != ''")
    return rows.groupBy("base", "cat_id").agg(listed("place").alias("places"), listed("population").alias("populations"), F.min("url").alias("url"), F.min_by("title", F.struct("url", "title")).alias("title"))


def census_history(examples: DataFrame, place: str) -> DataFrame:
    """Examples built on a census, by place: how many, their titles, and the last known year."""
    census = F.coalesce(F.upper("code"), F.lit("")).contains("CENSUS") | F.lower(F.coalesce("title", F.lit(""))).rlike(CENSUS_TITLE)
    return examples.where(census).groupBy(place).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(F.substring("title", 1, 60))), " | ").alias("titles"), F.max(F.col("year").try_cast("int")).alias("last_year"))


def provenance(saved: DataFrame, recovered: DataFrame, example: str) -> DataFrame:
    """Where each example's files come from: its own link, or recovered and then kept or rejected."""
    kept = recovered.groupBy(example).agg(F.bool_or("kept").alias("__kept"))
    rules = [("recovered + verified", "__kept"), ("recovered - rejected (removed)", "not __kept")]
    return saved.select(example).distinct().join(kept, example, "left").select(example, first_match(rules, "own link (trusted)").alias("provenance"))


def ranked_contacts(contacts: DataFrame, place: str, order: str) -> DataFrame:
    """contacts with rank_in_place: role that fits first, then members, then the given priority, then order; 1 is primary, 2 secondary."""
    fit, member = F.lower(F.coalesce("position", F.lit(""))).rlike(ROLES), F.coalesce(F.lower("is_member") == "yes", F.lit(False))
    by = Window.partitionBy(place).orderBy(fit.desc(), member.desc(), F.col("priority").asc_nulls_last(), order)
    return contacts.withColumn("rank_in_place", F.row_number().over(by))


def suggested_respondents(targets: DataFrame, contacts: DataFrame, place: str, order: str, most: int = 3) -> DataFrame:
    """The best contacts of each target place by how their title fits; places without any contact keep one row, no_fit marks places without fit."""
    fit = contacts.join(targets.select(place), place, "left_semi").withColumn("title_fit", N.position_fit(F.col("position")))
    at = F.row_number().over(Window.partitionBy(place).orderBy(F.col("title_fit").desc(), order))
    top = fit.withColumn("rank_in_place", at).where(F.col("rank_in_place") <= most)
    best = fit.groupBy(place).agg(F.max("title_fit").alias("__best"))
    out = targets.join(top, place, "left").join(best, place, "left")
    return out.withColumn("no_fit", F.coalesce(F.col("__best"), F.lit(0)) <= 0).drop("__best")


def contact_gaps(matrix: DataFrame, coverage: DataFrame, place: str) -> DataFrame:
    """What contacts lack in places of priority P1 to P3; coverage: place, n_contacts, n_with_position, n_with_email."""
    counts = ["n_contacts", "n_with_position", "n_with_email"]
    df = matrix.where(F.col("priority").rlike("^P[123]")).join(coverage.select(place, *counts), place, "left").fillna(0, counts)
    return df.withColumn("gap", first_match([
        ("no contact - one found on the web (validate before use)", "n_contacts = 0 and web_contact is not null"), ("no contact at all", "n_contacts = 0"),
        ("contacts lack email - one found on the web (validate before use)", "n_with_email = 0 and web_contact is not null"), ("contacts but no email", "n_with_email = 0"),
        ("contacts but no position info", "n_with_position = 0"),
    ], "covered"))


def review_queue(records: DataFrame) -> DataFrame:
    """Matches that a person must look at: new examples of places in the register, and known ones held with low confidence."""
    return records.where("match_type = 'new_example_existing_place' or (match_type = 'already_in_register' and match_confidence = 'low')")


def known_by_confidence(records: DataFrame, order: list[str]) -> DataFrame:
    """Records held to be in the register, least sure first, with empty columns for the reviewer."""
    known = records.where(F.col("match_type") == "already_in_register").withColumns({"reviewer_decision": F.lit(""), "reviewer_notes": F.lit("")})
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("low", 1, "medium", 2, "high", 3)]), F.lower("match_confidence")), F.lit(0))
    return known.withColumn("sureness", rank).orderBy("sureness", *order)


def contact_state(rows: DataFrame) -> DataFrame:
    """rows with contact_confidence, contact_validation_needed, contact_gap and contact_gap_reason.

    rows: contact, contact_type, contact_source, has_office_contact.
    """
    office = F.coalesce(F.col("has_office_contact"), F.lit(False))
    df = rows.withColumn("contact_confidence", first_match([
        ("none", "contact is null"), ("high", "contact_type in ('general', 'department') and contact_source = 'contact page'"),
        ("medium", "contact_type in ('general', 'department', 'named staff', 'national system')"),
    ], "low"))
    return df.withColumns({
        "contact_validation_needed": F.coalesce(F.col("contact_type") == "named staff", F.lit(False)) | F.col("contact_confidence").isin("low", "none"),
        "contact_gap": ~office,
        "contact_gap_reason": F.when(office, F.lit(None)).when(F.col("contact").isNotNull(), "only a partner's or catalogue's contact - not confirmed").otherwise("no suitable public contact found"),
    })


def outreach(rows: DataFrame) -> DataFrame:
    """contact_state() with route, priority and notes, told from category (A to E), lead and humanitarian."""
    df = contact_state(rows).withColumn("__c", F.substring("category", 1, 1))
    notes = first_match([
        ("Suppressed: false positive, spam or no evidence. Do not contact.", "__c = 'E'"), ("Possible candidate of a national office; the office must confirm it. The contact needs validation.", "__c = 'A' and contact_validation_needed"),
        ("Possible candidate of a national office; the office must confirm it.", "__c = 'A'"), ("Possible candidate led by a partner or an unclear institution; establish the office's part first.", "__c = 'B'"),
        ("Evidence lead only, not for outreach yet.", "__c = 'C'"),
    ], "Manual review: contact, lead, population or source is unclear.")
    return df.withColumns({
        "route": first_match([
            ("do not follow up yet", "__c in ('E', 'C')"), ("NSO direct", "__c = 'A'"), ("partner-supported follow-up", "__c = 'B' and lead = 'likely partner-led' and contact is not null"),
            ("NSO direct", "__c = 'B' and has_office_contact"), ("manual contact search needed", "__c = 'B' or contact_gap"),
        ], "do not follow up yet"),
        "priority": first_match([("none", "__c = 'E'"), ("low", "humanitarian"), ("high", "__c = 'A'"), ("medium", "__c in ('B', 'D')"), ("low", "__c = 'C'")], "none"),
        "notes": F.concat_ws(" ", notes, F.when(F.expr("__c not in ('A', 'B', 'C', 'E') and contact_gap"), F.concat(F.upper(F.substring("contact_gap_reason", 1, 1)), F.substring("contact_gap_reason", 2, 200), F.lit(".")))),
    }).drop("__c")


def download_plan(roster: DataFrame) -> DataFrame:
    """How each example's data will be fetched; examples without a link go to recovery like dead links.

    roster: url (null: no link), source_type, tier, reachability.
    """
    linked = F.coalesce(F.trim("url") != "", F.lit(False))
    action = first_match([("AUTO", "reachability = 'live' and tier = 'AUTO'"), ("AUTO_META", "reachability = 'live' and tier = 'AUTO_META'"), ("SCRAPE", "reachability = 'live'"), ("SCRAPE_BROWSER", "reachability = 'blocked'")], "RECOVER")
    return roster.withColumns({"reachability": F.when(linked, F.col("reachability")).otherwise("no_link"), "source_type": F.when(linked, F.col("source_type")).otherwise("none")}).withColumn("action", action)


def recovery(plan: DataFrame, archived: DataFrame, matched: DataFrame, example: str) -> DataFrame:
    """Where examples to recover were found: an archive's copy first, then a match among live records (one row an example in each)."""
    df = plan.where(F.col("action") == "RECOVER").join(archived.select(example, "archive_url"), example, "left").join(matched.select(example, "match_url"), example, "left")
    return df.withColumns({"recovered_url": F.coalesce("archive_url", "match_url"), "recovery": first_match([("archive", "archive_url is not null"), ("crossmatch", "match_url is not null")], "none")})


def analysis_frame(roster: DataFrame, plan: DataFrame, recovered: DataFrame, example: str, domains: dict[str, str]) -> DataFrame:
    """roster with data_access, granularity and what can be computed from it, by lens (identification, indicators, host communities).

    roster: title, description, source_tool, has_framework, is_microdata, host_signal; domains: name and pattern of each indicator domain.
    """
    text = F.lower(F.concat_ws(" ", "title", "description"))
    found = recovered.where(F.col("recovery") != "none").select(example).distinct().withColumn("__found", F.lit(True))
    df = roster.join(plan.select(example, "action"), example, "left").join(found, example, "left").withColumn("__domains", F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in domains.items()])))
    access = [("downloadable (API)", "action in ('AUTO', 'AUTO_META')"), ("downloadable (scrape)", "action = 'SCRAPE'"), ("needs browser scrape", "action = 'SCRAPE_BROWSER'"), ("recovered (re-check)", "__found")]
    units = [("microdata (survey/census)", "source_tool rlike 'survey|census'"), ("admin/register data", "source_tool rlike 'administrative|register|integration'"), ("aggregate/other", "source_tool != ''")]
    ident = [("computable (framework + microdata)", "has_framework and is_microdata"), ("reported only (framework, aggregate)", "has_framework"), ("possible (microdata, framework unstated)", "is_microdata")]
    micro = F.coalesce(F.col("is_microdata"), F.lit(False))
    return df.withColumns({
        "data_access": first_match(access, "data request needed"), "granularity": first_match(units, "unknown"), "id_capability": first_match(ident, "unclear"), "domains": F.array_join("__domains", "; "),
        "disaggregatable": (F.size("__domains") > 0) & micro, "host_comparison": F.coalesce(F.col("host_signal"), F.lit(False)) & micro,
    }).drop("__found", "__domains")


def by_ease(rows: DataFrame, order: str, most: int) -> DataFrame:
    """The `most` records whose data are easiest to get (tiers 1 to 6), microdata and reliable ones first within a tier."""
    tier = first_match([(str(n), c) for n, _, c in EASE], "9").cast("int")
    method = first_match([(m, f"ease_tier = {n}") for n, m, _ in EASE], "no open source")
    df = rows.withColumn("ease_tier", tier).where(F.col("ease_tier") <= 6).withColumn("method", method)
    df = df.withColumn("reliability", F.coalesce("verdict", F.when(F.col("source_type") == "none", "-").otherwise("roster-own")))
    return df.orderBy("ease_tier", F.coalesce("is_microdata", F.lit(False)).desc(), rank_of("reliability", RELIABILITY), order).limit(most)


def regated(points: DataFrame) -> DataFrame:
    """points with kept: whether the value stands in its own evidence, whatever its spaces and decimal sign."""
    v = T.norm_value(F.coalesce("value", F.lit("")))
    return points.withColumn("kept", F.coalesce((v != "") & F.contains(T.norm_value(F.col("evidence")), v), F.lit(False)))


def pilot_ready(inventory: DataFrame) -> DataFrame:
    """Datasets that can be tabulated: readable dictionary, a displacement variable, weights, and an indicator's input."""
    return inventory.where("dictionary and has_displacement and has_weight and n_inputs > 0")


def send_export(emails: DataFrame, log: DataFrame, place: str, tiers: list[str]) -> DataFrame:
    """Letters of the tiers that can go out: with an address, to places not yet sent to, bounced or answered; body also as HTML."""
    done = log.where(F.col("status").isin("sent", "bounced", "responded")).select(place)
    rows = emails.where(F.col("tier").isin(*tiers) & (F.trim(F.coalesce("to_email", F.lit(""))) != "")).join(done, place, "left_anti")
    return rows.withColumns({"cc_email": F.coalesce("cc_email", F.lit("")), "body_html": F.replace("body", F.lit("\n"), F.lit("<br>"))})


def reviewer_terms(match_kind: Column, tier: Column) -> Column:
    """Struct (in_register, relevance): the pipeline's labels in the words that reviewers use."""
    same = first_match([("already in register (same product)", match_kind == "same product"), ("new edition of an example", match_kind == "new edition"), ("check (undecided)", match_kind.startswith("check"))], "new - not in register")
    wanted = first_match([
        ("yes - ask for it", tier.isin("reach out", "review then reach out", "review - possible register match")), ("maybe", tier.isin("watch / context", "unsure - check questionnaire", "could not read - check by hand")),
        ("no - not relevant", tier.isin("low", "historic - context only", "junk - login/redirect page")),
    ], "not scored")
    return F.struct(same.alias("in_register"), wanted.alias("relevance"))


def keyword_suggestions(answers: DataFrame, order: str) -> DataFrame:
    """Distinct phrases of answers [{phrase, population, rationale}], each from its first answer by order; bad JSON gives none."""
    found = answers.select(order, F.posexplode(F.from_json("answer", "array<struct<phrase:string,population:string,rationale:string>>")).alias("at", "k")).where("k.phrase is not null")
    first = found.groupBy(F.col("k.phrase").alias("phrase")).agg(F.min_by(F.struct("k.population", "k.rationale", order), F.struct(order, "at")).alias("f"))
    return first.select("phrase", F.coalesce("f.population", F.lit("general")).alias("population"), "f.rationale", F.col(f"f.{order}").alias("source"), F.lit("").alias("approved"))


def example_cards(examples: DataFrame, this_year: int) -> DataFrame:
    """examples with y1 (9000 on: ongoing, so this year) and kind: told from title and code, else from the description."""
    kind = product_type(F.col("title"), F.col("code"))
    return examples.withColumns({"y1": F.when(F.col("y1") >= 9000, this_year).otherwise(F.col("y1")), "kind": F.when(kind == "unknown", product_type(F.col("description"))).otherwise(kind)})


def candidate_frame(rows: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """One column a field: the first of its source columns that has a value; source columns that rows lack are skipped."""
    has = set(rows.columns)
    pick = lambda names: F.coalesce(*[F.col(c) for c in names if c in has], F.lit(None))
    return rows.select(*[pick(names).alias(field) for field, names in fields.items()])


def best_candidates(matches: DataFrame, source: str, order: str, most: int = 3) -> DataFrame:
    """The `most` candidates of each source: confirmed ones first, then by score."""
    by = Window.partitionBy(source).orderBy(F.coalesce("confirmed", F.lit(False)).desc(), F.col("score").desc(), order)
    return matches.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most)


def refresh_since(rows: DataFrame, day: str, when: str) -> DataFrame:
    """The slice of rows published on or after a day, for an incremental run; undated rows stay out. The date filter reaches the scan."""
    return rows.where(F.col(when) >= F.lit(day).cast("date").cast("timestamp"))


def published_and_demonstrated(published: DataFrame, demonstrated: DataFrame, titles: DataFrame, priority: list[str]) -> DataFrame:
    """Values of both kinds by name, with the indicator's title (else the measure as stated) and whether it is a priority."""
    both = published.withColumn("value_type", F.lit("published")).unionByName(demonstrated.withColumn("value_type", F.lit("demonstration tabulation")), allowMissingColumns=True)
    df = both.join(titles.select("code", F.col("title").alias("__title")), "code", "left")
    return df.withColumns({"title": F.coalesce("__title", "measure"), "is_priority": F.col("code").isin(*priority)}).drop("__title")
