"""Leads, inventories and registers: searching, pooling and indexing records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import answer_populations
from ..functions.places import harmonize_country
from ..plans.rules import first_match
from ..sources.io import extract_links
from .ranking import top_n


def place_by_prefix(df: DataFrame, places: DataFrame, text: str, id_: str, place: str, order: str, letters: int = 6) -> DataFrame:
    """df with place: the first by order whose first letters stand in the text.

    A text's runs of as many letters are joined with the prefixes, so no row meets every place.
    """
    x = F.lower(F.col(text))
    runs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - letters + 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(letters))))
    keys = places.select(F.col(place).alias("__p"), F.col(order).alias("__o"), F.lower(F.substring(place, 1, letters)).alias("__k"))
    best = df.select(id_, F.explode(runs).alias("__k")).join(keys, "__k").groupBy(id_).agg(F.min(F.struct("__o", "__p")).alias("m"))
    return df.join(best, id_, "left").select(*df.columns, F.col("m.__p").alias("place"))


def shares_path(leads: DataFrame, refs: DataFrame, block: str, lead_id: str, url: str, ref_text: str, least: int = 2, longer_than: int = 3) -> DataFrame:
    """leads with url_overlap: whether some reference of the block holds at least `least` segments of the lead's path.

    A block's distinct segments are looked for in its distinct references once, not once a lead.
    """
    segments = F.filter(F.array_distinct(F.split(T.path_of(F.lower(F.col(url))), "/")), lambda s: F.length(s) > longer_than)
    mine = leads.select(lead_id, F.col(block).alias("__b"), F.explode(segments).alias("__s"))
    texts = refs.select(F.col(block).alias("__b"), F.lower(ref_text).alias("__r")).distinct()
    held = mine.select("__b", "__s").distinct().join(texts, "__b").where(F.contains("__r", F.col("__s")))
    hit = mine.join(held, ["__b", "__s"]).groupBy(lead_id, "__r").count().where(F.col("count") >= least).select(lead_id).distinct().withColumn("url_overlap", F.lit(True))
    return leads.join(hit, lead_id, "left").withColumn("url_overlap", F.coalesce("url_overlap", F.lit(False)))


def catalogue_search(examples: DataFrame, catalogue: DataFrame, id_: str, keywords: str, code: str, label: str, most: int = 6, shortest: int = 3, longest: int = 20) -> DataFrame:
    """For each example, up to `most` catalogue codes (by order of code) whose label has a word that begins with a keyword.

    The words' prefixes are joined with the keywords; keywords of other lengths than shortest to longest find nothing. An example's first
    codes are among the first of each of its keywords, so only these are joined.
    """
    word = F.explode(F.array_distinct(F.split(T.fold(F.col(label)), " ")))
    words = catalogue.select(F.col(code).alias("code"), word.alias("__w")).where(F.length("__w") >= shortest)
    prefixes = words.select("code", F.explode(F.transform(F.sequence(F.lit(shortest), F.least(F.length("__w"), F.lit(longest))), lambda n: F.substring("__w", F.lit(1), n))).alias("__k"))
    asked = examples.select(id_, F.explode(F.array_distinct(F.transform(keywords, T.fold))).alias("__k"))
    at = F.dense_rank().over(Window.partitionBy("__k").orderBy("code"))  # a code that a prefix finds several times counts once
    prefixes = prefixes.withColumn("__n", at).where(F.col("__n") <= most).select("code", "__k").distinct()
    return top_n(asked.join(prefixes, "__k").select(id_, "code").distinct(), [id_], ["code"], most)


def relevant_links(pages: DataFrame, id_: str, url: str, html: str, keywords: Column, data_words: str = "data|statisti|microdata|survey|census", most: int = 8) -> DataFrame:
    """The best links of each page within its own domain: keywords in address and text, 2 for a data file, 1 for a data word.

    keywords is an array column of pages. Links that score nothing are left out; ties go to the smaller address.
    """
    links = extract_links(pages.withColumn("__kw", keywords), url, html, (id_, url, "__kw")).withColumn("link", F.regexp_replace("link", "#.*$", ""))
    own = T.registrable_domain(T.host_of(F.col(url))) == T.registrable_domain(T.host_of(F.col("link")))
    text = F.lower(F.concat_ws(" ", "link", "anchor_text"))
    score = F.size(F.filter("__kw", lambda k: F.contains(text, F.lower(k)))) + F.when(text.rlike(r"\.(csv|xlsx?|zip|sav|dta|json)(\?| |$)"), 2).otherwise(0) + F.when(text.rlike(data_words), 1).otherwise(0)
    scored = links.where(own).select(id_, "link", score.alias("score")).where("score > 0").groupBy(id_, "link").agg(F.max("score").alias("score"))
    return top_n(scored, [id_], [F.col("score").desc(), "link"], most)


def unresolved(roster: DataFrame, routes: list[DataFrame], id_: str) -> DataFrame:
    """Roster rows that no route has resolved."""
    done = routes[0].select(id_)
    for r in routes[1:]:
        done = done.unionByName(r.select(id_))
    return roster.join(done.distinct(), id_, "left_anti")


def audit_pool(routes: dict[str, DataFrame], id_: str) -> DataFrame:
    """Distinct (id, route) of all routes."""
    out = None
    for name, df in routes.items():
        part = df.select(id_, F.lit(name).alias("route"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def pooled_urls(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with urls (all distinct addresses in the columns, in order) and n_urls."""
    urls = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(https?://[^\s,;<>\"]+)"), 1) for c in columns])))
    return df.withColumn("urls", urls).withColumn("n_urls", F.size("urls"))


#: Who leads an example by its code, frameworks by their recommendations, tools that may give microdata, words for hosts.
LEADS = {"1": "country-led", "2": "institution-led", "3": "other"}
FRAMEWORKS = ("IRRS", "IRIS", "IROSS")
MICRODATA_TOOLS = "survey|census|administrative|integration|register"
HOSTS = "host communit|host population|receiving communit|non-displaced|host and refugee|réfugiés et hôtes|comunidad de acogida|host household"
ADDRESS = r"(https?://[^\s,;\"'<>\]\)]+)"


def roster_normalise(df: DataFrame, results: str, questionnaire: str, others: list[str]) -> DataFrame:
    """Answers of a questionnaire as the register of examples: texts squished, addresses pooled, flags told from codes and words.

    df: lead_code, country, organisation, title, answered (codes of populations), source_tool, recommendations, description and the columns of
    addresses. link_results and link_questionnaire are their columns' first addresses; urls are the distinct ones of results,
    questionnaire and others, in that order. Null texts count as empty; unknown lead codes are `unknown`.
    """
    text = lambda c: T.squish(F.coalesce(F.col(c), F.lit("")))
    found = lambda c: F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(ADDRESS), 1)
    rows = df.withColumns({
        "lead_type": F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in LEADS.items() for x in pair]), F.col("lead_code")), F.lit("unknown")),
        "country": F.when(text("country") == "", "").otherwise(harmonize_country(text("country"))), "organisation": text("organisation"), "title": text("title"), "description": text("description"),
        "populations": F.array_join(answer_populations(F.col("answered")), ";"), "source_tool": F.lower(text("source_tool")), "recommendations": F.upper(text("recommendations")),
        "link_results": F.get(found(results), F.lit(0)), "link_questionnaire": F.get(found(questionnaire), F.lit(0)), "urls": F.array_distinct(F.flatten(F.array(*[found(c) for c in (results, questionnaire, *others)]))),
    })
    flags = {name.lower(): F.contains("recommendations", F.lit(name)) for name in FRAMEWORKS}
    rows = rows.withColumns(flags).withColumns({
        "has_framework": F.greatest(*[F.col(n) for n in flags]), "is_microdata": F.col("source_tool").rlike(MICRODATA_TOOLS), "n_urls": F.size("urls"), "has_link": F.size("urls") > 0,
        "host_signal": F.lower(F.concat_ws(" ", "title", "description")).rlike(HOSTS) | F.contains("populations", F.lit("other")),
    })
    return rows


def docs_manifest(sources: list[tuple[DataFrame, list[str]]], id_: str, title: str, method: Column) -> DataFrame:
    """One row per distinct address of several tables' link columns: doc_id, url, its example and title (the smallest), method."""
    out = None
    for df, links in sources:
        part = df.select(F.col(id_).alias("example"), F.col(title).alias("title"), F.explode(F.array_distinct(F.array_compact(F.array(*links)))).alias("url"))
        out = part if out is None else out.unionByName(part)
    best = out.where(F.trim("url") != "").groupBy("url").agg(F.min(F.struct("example", "title")).alias("m")).select("url", "m.*")
    key = F.concat(F.upper(F.substring(F.regexp_replace(F.col("example").cast("string"), "[^A-Za-z0-9]", ""), 1, 4)), F.lit("_"), F.substring(F.sha2("url", 256), 1, 10))
    return best.withColumn("doc_id", key).withColumn("method", method)


def archive_index(examples: DataFrame, files: DataFrame, submission: str, example: str) -> DataFrame:
    """Each example's reference `<submission>_<nn>` and its number of files."""
    n = files.groupBy(example).agg(F.count("*").alias("n_files"))
    ref = F.concat_ws("_", F.col(submission).cast("string"), F.format_string("%02d", F.row_number().over(Window.partitionBy(submission).orderBy(example))))
    return examples.select(submission, example).distinct().withColumn("ref", ref).join(n, example, "left").fillna(0, ["n_files"])


def office_rollup(df: DataFrame, office: str, priority: str, populations: str, portal: str, id_: str, ids: int = 15, sep: str = ";") -> DataFrame:
    """Per office: n, highest priority, its populations as a sorted set, the portal of its first id that has one, first ids."""
    base = df.groupBy(office).agg(F.count("*").alias("n"), F.max(priority).alias("priority"), F.min_by(portal, F.when(F.trim(portal) != "", F.col(id_))).alias("portal"))
    each = df.select(office, F.explode(F.split(populations, sep)).alias("p")).select(office, F.trim("p").alias("p")).where("p <> ''").distinct()
    pops = each.groupBy(office).agg(F.array_join(F.sort_array(F.collect_list("p")), "; ").alias("populations"))
    few = top_n(df.select(office, id_), [office], [id_], ids, "__k").groupBy(office).agg(F.array_join(F.transform(F.sort_array(F.collect_list(id_)), lambda x: x.cast("string")), ", ").alias("ids"))
    return base.join(pops, office, "left").join(few, office, "left")


def exclusion_reason(df: DataFrame, title_key: str, domain: str, own_domain: str, aggregators: str, least: int = 3) -> DataFrame:
    """df with excl_reason: titles that many offices share, aggregator domains, sources off the office's own domain."""
    shared = df.where((F.trim(title_key) != "") & (F.trim(domain) != "")).groupBy(title_key).agg(F.countDistinct(domain).alias("__n")).where(F.col("__n") >= least)
    out = df.join(shared, title_key, "left")
    on_own = (F.col(domain) == F.col(own_domain)) | F.endswith(domain, F.concat(F.lit("."), own_domain))
    known = (F.trim(own_domain) != "") & (F.trim(domain) != "")
    reason = first_match([("aggregator title", F.col("__n").isNotNull()), ("aggregator domain", F.col(domain).rlike(aggregators)), ("off own domain", known & ~on_own)], "")
    return out.select(*df.columns, reason.alias("excl_reason"))


def reply_effect(log: DataFrame, replies: DataFrame, key: str, today: Column, wait: int = 7) -> DataFrame:
    """The log after its replies were classed (key, outcome): automatic replies set the state back and plan another letter."""
    out = log.join(replies.select(key, F.col("outcome").alias("__o")), key, "left")
    away = F.coalesce(F.col("__o") == "out_of_office", F.lit(False))
    change = {"outcome": F.coalesce("__o", "outcome"), "responded": F.when(away, False).otherwise(F.col("responded")), "status": F.when(away, "sent").otherwise(F.col("status")), "date_responded": F.when(~away, F.col("date_responded")), "follow_up_date": F.when(away, F.date_add(today, wait)).otherwise(F.col("follow_up_date"))}
    return out.withColumns(change).select(*log.columns)


def query_plan(entities: DataFrame, words: DataFrame, entity: str, languages: str, universal: list[str]) -> DataFrame:
    """entity, language, phrase: every population's words in each of the entity's languages, and the universal phrases.

    words has language, population, phrase.
    """
    each = entities.select(entity, F.explode(F.array_distinct(F.transform(F.split(languages, ","), lambda x: F.trim(x)))).alias("language"))
    own = each.join(words, "language").select(entity, "language", "population", F.concat_ws(" ", "phrase", entity).alias("phrase"))
    common = entities.select(entity, F.lit("en").alias("language"), F.lit("all").alias("population"), F.explode(F.array(*map(F.lit, universal))).alias("phrase"))
    return own.unionByName(common.withColumn("phrase", F.concat_ws(" ", "phrase", entity)))


def variable_hits(inventory: DataFrame, study: str, name: str, text: str, signals: dict[str, str], most: int = 10) -> DataFrame:
    """Per study: variables, those with any signal, a count per signal, and the first names that have one."""
    x = F.lower(F.coalesce(text, F.lit("")))
    v = inventory.select(study, name, *[x.rlike(p).alias(f"n_{k}") for k, p in signals.items()])
    v = v.withColumn("__hit", F.greatest(*[F.col(f"n_{k}") for k in signals]) if len(signals) > 1 else F.col(f"n_{next(iter(signals))}"))
    counts = v.groupBy(study).agg(F.count("*").alias("n_vars"), F.count_if("__hit").alias("n_hits"), *[F.count_if(f"n_{k}").alias(f"n_{k}") for k in signals])
    first = top_n(v.where("__hit").select(study, name), [study], [name], most, "__k").groupBy(study).agg(F.array_join(F.transform(F.sort_array(F.collect_list(name)), lambda x: x.cast("string")), ", ").alias("hit_vars"))
    return counts.join(first, study, "left")
