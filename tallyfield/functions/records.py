"""Classifiers of links, records, leads, answers and contacts: ordered rules over columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.rules import all_matches, first_match, weighted
from . import text as T

# Kinds of addresses as (type, pattern, method, tier), tried in this order.
URL_TYPES = (
    ("unhcr_microdata", r"microdata\.unhcr\.org", "ddi_api", "AUTO_META"),
    ("wb_microdata", r"microdata\.worldbank\.org", "ddi_api", "AUTO_META"),
    ("ihsn_nada", r"catalog\.ihsn\.org|/nada|/index.php/catalog", "ddi_api", "AUTO_META"),
    ("eurostat_sdmx", r"ec\.europa\.eu|eurostat|/sdmx|sdmx|/estat", "sdmx_api", "AUTO"),
    ("pxweb", r"pxweb|/px/|statbank|/webapi/|statfin|px-x-|/pxweb/", "pxweb_api", "AUTO"),
    ("api_other", r"json-?stat|/api/v\d|/api/dataset|data\.un\.org|/rest/data", "http_api", "AUTO"),
    ("data_file", r"\.(csv|xlsx?|zip|json|px|sdmx|xml)(\?|$)", "http_file", "AUTO"),
    ("pdf", r"\.pdf(\?|$)", "pdf_extract", "SCRAPE"),
)
# Instruments by which a title tells how data were collected.
METHODS = (
    ("census", "census|recensement|censo|zensus|volkszählung|перепис"),
    ("admin data", "register|registre|registro|administrative|admin data|civil registration"),
    ("survey", "survey|enquête|encuesta|dhs|mics|lfs|labour force|household budget|inquérito"),
)
# Subject themes.
THEMES = {
    "SDG1 poverty": "poverty|poor|income|livelihood|destitut|deprivation",
    "SDG3 health": "health|mortalit|disease|vaccin|maternal|nutrition|mental",
    "SDG4 education": "education|school|enrol|literacy|learning|pupil|student",
    "SDG5 gender": "gender|women|girls|female|gender-based",
    "SDG6 WASH": r"water|sanitation|hygiene|\bwash\b|drinking water",
    "SDG8 work": r"employ|labour|labor|\bwork\b|\bjob|unemploy|wage|informal sector",
    "SDG10 inclusion": "inequalit|inclusion|discrimination|integration|social protection",
    "SDG11 housing": r"housing|shelter|settlement|\burban|\bcamp|accommodation|slum",
    "SDG16 legal identity": "birth registration|legal identity|civil registration|documentation|statelessness|nationality|asylum",
}
# Survey programmes, and those that count stocks of people only.
PROGRAMMES = {
    "FDS": r"forced displacement survey|\bfds\b",
    "SESRE": r"socio.?economic survey of refugee|\bsesre\b",
    "VASYR": r"vulnerabilit.*syrian|\bvasyr\b",
    "RHCS": r"refugee and host communit|\brhcs\b|host and refugee",
    "HFPS": r"high.?frequency phone|\bhfps\b|phone survey",
    "CBPS": r"cox.?s bazar panel|\bcbps\b",
    "RMS": r"results monitoring survey|\brms\b",
    "LMS": r"labou?r market survey|\blms\b",
    "MSNA": r"multi.?sector.*needs assessment|\bm?sna\b|jmsna",
    "IDPPROF": r"profil.*(idp|internally displaced|solution)|idp.*profil|durable solution.*analys",
    "INTENTIONS": "intention",
    "LIVELIHOOD": "livelihood",
    "DTM": r"displacement tracking|\bdtm\b|site assessment|site and village",
    "CENSUS": r"\bcensus\b|housing and population",
    "MICS": r"multiple indicator cluster|\bmics\b",
    "DHS": r"demographic and health survey|\bdhs\b",
    "LSMS": r"living (standards|conditions)|\blsms\b|integrated household",
    "LFS": r"labou?r force survey|\blfs\b",
    "VULN": r"vulnerability assessment|\bvaf\b",
    "PROTMON": r"protection monitoring|\bcbpm\b|border monitor",
}
STOCK = ("DTM", "CENSUS", "PROTMON")
# What a described record is, besides a dataset.
RECORD_STATES = (
    ("forthcoming (not yet collected)", "planned to be impl|under revision|will aim|to be implemented|planning to implement|will be (conducted|collected)|foundations for implementing"),
    ("operation/event (no microdata)", "repatriation|resettlement|launched by|voluntary return|pilot .*project|resettlement city"),
    ("method note (no dataset)", "^i use|i tend to|geospatial analytics|using .*analytics|accessibility analytics"),
    ("activity/project (may USE a survey, not a dataset itself)", "workshop|training|webinar|e-learning|academy|guidance|toolkit|expert group|technical working group|guidelines on|support to|towards greater inclusion|articulation between|south.?south|coordination|update of statistic|development of (new )?statistic|extension of publications|building the evidence|data-driven approaches"),
)
# Producers and titles of official and of operational data.
HUMANITARIAN_PRODUCER = r"unhcr|refugee agency|haut commissariat|\bwfp\b|world food|\biom\b|migration agency|unicef|\breach\b|impact initiative|\bnrc\b|norwegian refugee|danish refugee|\bdrc\b|\bjips\b|\bacted\b|save the children|mercy corps|ipsos|samuel hall|ground truth"
HUMANITARIAN_TITLE = r"results monitoring survey|\brms\b|protection monitoring|protection profiling|multi-?sector(al)? needs|\bmsna\b|post-?distribution monitoring|\bpdm\b|vulnerability assessment|socio-?economic profiling|community-?based protection|rapid household assessment|cash-?based intervention|standardi[sz]ed expanded nutrition|\bsens\b|mixed movements|intentions (survey|and perspectives)|joint post.?distribution|needs assessment|displacement tracking|\bdtm\b|high frequency phone|listening to|monitoring survey"
OFFICIAL_TITLE = r"census|population and housing|labour force|labor force|\blfs\b|demographic and health|\bdhs\b|multiple indicator cluster|\bmics\b|indicadores múltiplos|indicateurs multiples|household budget|living standards|\blsms\b|integrated household|socio-?economic survey|statistical yearbook|\bhies\b|national (household |)survey|administrative (data|records)"
OFFICE_PRODUCER = r"statisti|census bureau|bureau of stat|institut.*stat|nso\b|dane\b|inegi|pcbs|knbs|ubos|zimstat|instat|capmas|\bbps\b|\bbbs\b|\bpsa\b|\bine\b|\bins\b|geostat|armstat|destatis|istat|\bcbs\b|stats? ?(sa|south africa)|zamstats|zamstat"
PARTNER_PRODUCER = r"unhcr|world bank|\biom\b|wfp|unicef|\bdhs\b|jips|datafirst|ihsn|undp|reach|idmc|\bilo\b"
# Bodies and surveys that decide the route of a request.
REGIONAL_BODY = r"eurostat|\bescap\b|\bescwa\b|\beclac\b|\bcepal\b|\bunece\b|economic commission for (africa|europe|latin)|\buneca\b|ecowas|cedeao|east african community|\beac\b|african union|afristat|gcc.?stat|sesric|pacific community|\bspc\b|\bsiap\b|asean|caricom|oecd"
AGENCY_BODY = r"unhcr|acnur|un refugee agency|high commissioner for refugees|\biom\b|\boim\b|displacement tracking|\bdtm\b|world bank|joint data cent|\bjdc\b|\bjips\b|\bidmc\b|unicef|unfpa|undp|\bwfp\b|\breach\b|impact initiatives|\bhdx\b|\bocha\b|\bnrc\b|\bdrc\b danish"
OPERATIONAL = r"results monitoring survey|\brms\b|\bmsna\b|multi.?sector needs|post.?distribution|\bpdm\b|protection monitoring|standardi[sz]ed expanded nutrition|\bsens\b|nutrition survey"
OFFICE_BODY = r"statisti|estad[ií]st|census|\bine\b|\binsee\b|\bistat\b|bureau of stat|national population commission|high commission for planning"
# Points for words of a position, beside the rule for heads of population or social statistics.
POSITION_POINTS = (
    (42, "migration"),
    (21, "statistician"),
    (14, "director general|president|chief executive"),
    (10, "international|cooperation|partnership"),
    (10, "census"),
    (5, "governance|peace|security"),
    (5, "information management|data"),
)
# Why requested data are not at hand.
REQUEST_TEXT = "plan|forthcoming|will |2026|under revision|mapping|launched|design"
REQUEST_HOLDERS = (
    ("office-held (WHO)", "who|world health"),
    ("JIPS exercise - not on portal", "jips|joint idp profiling"),
    ("NSO-held - request from office/site", "instituto nacional|national statistic|bureau of statistic|national institute of statist"),
)
# Words of positions in person names with their office.
POSITIONS = "director|directeur|directora|deputy|head of|chief|commissioner|statistician|coordinator|manager|secretary general|directeur général|director general"
# Letters by language.
GREETINGS = {"English": "Dear %s %s,", "French": "Bonjour %s %s,", "Spanish": "%s %s:", "Arabic": "%s %s،", "Russian": "Уважаемый(ая) %s %s,", "Chinese": "尊敬的%s%s："}
COPIED = {"English": ("I have copied ", "and"), "French": ("J'ai mis en copie ", "et"), "Spanish": ("Pongo en copia a ", "y")}
WORKING_LANGUAGES = ("ar", "zh", "fr", "ru", "es")


def low(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def url_source(url: Column) -> Column:
    """struct(type, method, tier) of an address; null or empty is `none`, what no rule knows is `web_page`."""
    triple = lambda a, b, c: F.struct(F.lit(a).alias("type"), F.lit(b).alias("method"), F.lit(c).alias("tier"))
    x = low(url)
    out = F.when(x == "", triple("none", "reach_out", "NO_LINK"))
    for name, pattern, method, tier in URL_TYPES:
        out = out.when(x.rlike(pattern), triple(name, method, tier))
    return out.otherwise(triple("web_page", "scrape_html", "SCRAPE"))


def retrieval_action(reach: Column, tier: Column) -> Column:
    """How to get what an address holds, from its reachability and tier."""
    live = reach == "live"
    return first_match([("AUTO", live & (tier == "AUTO")), ("AUTO_META", live & (tier == "AUTO_META")), ("SCRAPE", live), ("SCRAPE_BROWSER", reach == "blocked")], "RECOVER")


def method_guess(title: Column) -> Column:
    return first_match([(name, low(title).rlike(p)) for name, p in METHODS], "unknown")


def tags(text: Column, dictionary: Mapping[str, str]) -> Column:
    """The dictionary's labels whose patterns occur, in its order."""
    return all_matches([(name, low(text).rlike(p)) for name, p in dictionary.items()])


def stock_only(codes: Column) -> Column:
    """Whether programmes were found and all of them only count people."""
    return (F.size(codes) > 0) & (F.size(F.array_except(codes, F.array(*map(F.lit, STOCK)))) == 0)


def evidence_levels(micro: Column, columns: Column, text: Column, concepts: Mapping[str, str]) -> Column:
    """Per concept struct(concept, level): microdata, table or text, the first that holds it; those without are left out."""
    level = lambda p: first_match([("microdata", low(micro).rlike(p)), ("table", low(columns).rlike(p)), ("text", low(text).rlike(p))])
    each = F.array(*[F.struct(F.lit(name).alias("concept"), level(p).alias("level")) for name, p in concepts.items()])
    return F.filter(each, lambda x: x["level"].isNotNull())


def record_state(title: Column, description: Column) -> Column:
    x = F.lower(F.concat_ws(" ", title, description))
    return first_match([(name, x.rlike(p)) for name, p in RECORD_STATES], "survey/dataset")


def questionnaire_verdict(found: Column, n_vars: Column, n_hits: Column, abstract_hit: Column) -> Column:
    return first_match([
        ("no DDI available", ~F.coalesce(found, F.lit(False))),
        ("DDI too large / not scanned", n_vars.isNull()),
        ("displacement/statelessness questions found", n_hits > 0),
        ("no variable list; abstract mentions displacement", (n_vars == 0) & abstract_hit),
        ("no variable list", n_vars == 0),
    ], "no displacement question")


def position_fit(position: Column) -> Column:
    """Points of a position for being the right respondent."""
    p = low(position)
    head = p.rlike("(director|head|chief|deputy)") & p.rlike("(population|demograph|social stat)")
    return weighted([(52, head), *[(n, p.rlike(pattern)) for n, pattern in POSITION_POINTS]])


def lead(title: Column, producer: Column, layer: Column, own_site: Column, core: Column, inclusion: Column, in_title: Column, activity: Column, excluded: Column, ambiguous: Column) -> Column:
    """struct(lead_type, evidence_nature, official_no_inclusion) from who made a record and what it shows."""
    t, p = low(title), low(producer)
    official, shows = t.rlike(OFFICIAL_TITLE), inclusion | in_title | (core > 0)
    operational = p.rlike(HUMANITARIAN_PRODUCER) | t.rlike(HUMANITARIAN_TITLE)
    office = own_site | p.rlike(OFFICE_PRODUCER) | t.rlike("statistic|census bureau|stats office|national bureau")
    kind = first_match([
        ("not applicable", excluded), ("unclear", ambiguous), ("likely country-led", official & shows), ("unclear", official),
        ("likely country-led", own_site & (core > 0) & (activity > 0)), ("likely country-led", office & (core > 0)),
        ("likely partner-led", operational & ~office), ("likely partner-led", low(layer).startswith("l1:") & p.rlike(PARTNER_PRODUCER) & ~office),
    ], "unclear")
    nature = first_match([("not applicable", excluded), ("official statistics", official | office), ("humanitarian/operational data", operational)], "unclear")
    return F.struct(kind.alias("lead_type"), nature.alias("evidence_nature"), (official & ~shows).alias("official_no_inclusion"))


def request_route(title: Column, producer: Column, own_site: Column, lead_type: Column) -> Column:
    t, p = low(title), low(producer)
    return first_match([
        ("regional body", p.rlike(REGIONAL_BODY)), ("NSO (direct)", own_site), ("international agency", t.rlike(OPERATIONAL) | p.rlike(AGENCY_BODY)),
        ("NSO (direct)", p.rlike(OFFICE_BODY) | (lead_type == "country-led")), ("international agency", lead_type == "partner-led"),
    ], "other / non-statistical")


def lead_agreement(said: Column, rule: Column) -> Column:
    """A model's lead type against the rules' (whose `likely ` is dropped); null where the model gave none."""
    r, sides = F.regexp_replace(F.coalesce(rule, F.lit("")), "^likely ", ""), ("country-led", "partner-led")
    return F.when(said.isNotNull(), first_match([("agree", said == r), ("DISAGREE", said.isin(*sides) & r.isin(*sides))], "one-unclear"))


def final_score(read: Column, model: Column, rules: Column) -> Column:
    """The model's score where the text was read, else the rules', from 0 to 100; halves are rounded to the even number."""
    return F.least(F.greatest(F.bround(F.coalesce(F.when(read, model).otherwise(rules), F.lit(0))), F.lit(0)), F.lit(100)).cast("int")


def final_confidence(read: Column, rules: Column, model: Column, stated: Column) -> Column:
    """Unverified if not read; low where the rules' and the model's scores lie on opposite sides (under 40, 70 and over)."""
    r, m = F.coalesce(rules, F.lit(0)), F.coalesce(model, F.lit(0))
    apart = ((r < 40) & (m >= 70)) | ((r >= 70) & (m < 40))
    known = low(stated).isin("high", "medium", "low")
    return F.when(~read, "unverified (keyword only)").when(apart, "low - signals disagree").when(known, low(stated)).otherwise("low")


def source_type(source: Column) -> Column:
    s = low(source)
    return first_match([("NSO/official", s.rlike(r"statisti|census|bureau of stat|national institut|nso\b|enquête|recensement")), ("partner (UNHCR/IDMC/UN)", s.rlike(r"unhcr|idmc|internal displacement|refugee agency|\biom\b|un desa|population division"))], "other/unknown")


def request_reason(title: Column, description: Column, holder: Column) -> Column:
    x = F.lower(F.concat_ws(" ", title, description))
    return first_match([("forthcoming / not yet collected", x.rlike(REQUEST_TEXT)), *[(name, low(holder).rlike(p)) for name, p in REQUEST_HOLDERS]], "exact study not online - request from office")


def name_absent(email: Column, surname: Column) -> Column:
    """Whether an address lacks the person's surname (a sign of a generic inbox); an unknown surname is no sign."""
    s = T.fold(surname)
    return (s != "") & ~F.contains(T.fold(email), s)


def name_titles(text: Column, most: int = 5) -> Column:
    """Persons with their positions, as an array in order of occurrence."""
    person = r"[A-Z][a-zà-ÿ]+(?:\s+[A-Z][a-zà-ÿ]+){1,2}"
    pattern = rf"((?:(?:Mr|Mrs|Ms|Dr|Prof)\.?\s+)?{person}[,\s\-]{{1,3}}(?:{POSITIONS})[^.\n]{{0,50}}|(?:{POSITIONS})[^.\n]{{0,40}}[:\-]\s*{person})"
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), T.squish))
    return F.slice(F.filter(found, lambda x: (F.length(x) > 15) & (F.length(x) < 120)), 1, most)


def glossed(text: Column, glossary: Mapping[str, str]) -> Column:
    """`gloss (term)` of each glossary term that a text holds, joined in the glossary's order."""
    return F.array_join(all_matches([(f"{gloss} ({term})", F.contains(text, F.lit(term))) for term, gloss in glossary.items()]), "; ")


def catalog_key(url: Column) -> Column:
    """struct(base, path, study) of a study's catalogue address; null for other addresses."""
    p = r"^(https?://[^/]+)(/[^?#]*)?/index\.php/catalog/([0-9]+)"
    return F.when(url.rlike(p), F.struct(F.regexp_extract(url, p, 1).alias("base"), F.regexp_extract(url, p, 2).alias("path"), F.regexp_extract(url, p, 3).alias("study")))


def salutation(language: Column, honorific: Column, surname: Column) -> Column:
    out = F.format_string(GREETINGS["English"], honorific, surname)
    for name, template in list(GREETINGS.items())[1:]:
        out = F.when(language == name, F.format_string(template, honorific, surname)).otherwise(out)
    return out


def cc_clause(language: Column, names: Column) -> Column:
    """The sentence that names who is copied; empty without names, English for languages without one."""
    clean = F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda x: x != "")
    say = lambda key: F.concat(F.lit(COPIED[key][0]), T.names_join(clean, COPIED[key][1]), F.lit("."))
    return F.when(F.size(clean) == 0, "").when(language == "French", say("French")).when(language == "Spanish", say("Spanish")).otherwise(say("English"))


def language_for(languages: Column) -> Column:
    """The first language of a list if it is a working language, else English."""
    first = F.trim(F.get(F.split(F.coalesce(languages, F.lit("en")), ","), F.lit(0)))
    return F.when(first.isin(*WORKING_LANGUAGES), first).otherwise("en")


def cycle_stage(responded: Column, bounced: Column, status: Column, has_contact: Column) -> Column:
    """The furthest stage that an example has reached with its office."""
    return first_match([("5_responded", responded), ("4_bounced", bounced), ("4_contacted", status == "sent"), ("3_contact_ready", (status == "draft_ready") | has_contact)], "2_no_contact")


def page_of(pages: Column, evidence: Column, value: Column) -> Column:
    """Number of the first page with the quote, else with the value, white space aside; null for a single page."""
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\s", "")
    at = lambda v: F.when(bare(v) != "", F.nullif(F.array_position(F.transform(pages, lambda p: F.contains(bare(p), bare(v))), F.lit(True)), F.lit(0)))
    return F.when(F.size(pages) > 1, F.coalesce(at(evidence), at(value))).cast("int")
