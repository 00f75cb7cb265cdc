"""Text functions as column expressions; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and what they fold to.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
# The signs of code page 1252 between x80 and x9F, and those positions.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_AT = "".join(map(chr, (0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E, 0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F)))


def bound(value: Column, f) -> Column:
    """f(value) with value computed once a row, however often f names it (also inside other lambdas)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def squish(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def fold(c: Column) -> Column:
    """Lower-case ASCII words: accents folded, camelCase split, other signs to single spaces; null gives ''."""
    x = F.translate(F.coalesce(c, F.lit("")), ACCENTED, PLAIN)
    x = F.regexp_replace(F.regexp_replace(x, "ß", "ss"), "([a-z])([A-Z])", "$1 $2")
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def norm_title(c: Column) -> Column:
    return squish(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", ""))


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as code page 1252, read rightly; up to two rounds, text that was right stays."""
    for _ in range(2):
        marked = c.rlike("[ÃÐÑÒÂ][^\\x00-\\x7F]")
        latin = F.translate(c, CP1252, CP1252_AT)
        ok = marked & latin.rlike("(?s)^[\\x00-\\xFF]*$")
        # encode raises on what does not fit, so it sees only what does
        bytes_ = F.encode(F.when(ok, latin).otherwise(F.lit("")), "ISO-8859-1")
        c = F.when(ok, F.coalesce(F.try_validate_utf8(bytes_.cast("string")), c)).otherwise(c)
    return c


def strip_web_noise(c: Column) -> Column:
    """Without what pages carry in addresses: parameters with long numbers, urls, query parameters."""
    for pattern in (r"mga=\S+", r"[A-Za-z_]+[:=]\d{3,}", r"https?://\S+", r"[?&][A-Za-z_]+="):
        c = F.regexp_replace(c, pattern, " ")
    return c


def clean_title(c: Column, most: int = 110) -> Column:
    x = F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "<.*$", " ")
    for entity, sign in (("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        x = F.replace(x, F.lit(entity), F.lit(sign))
    x = squish(F.regexp_replace(x, "[–—]", "-"))
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most - 3), F.lit("..."))).otherwise(x)


def title_case(c: Column) -> Column:
    """Words with a capital first; words of two or more capitals (acronyms) stay."""
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.when(w.rlike("^[A-Z]{2,}$"), w).otherwise(F.initcap(w))), " ")


def repair_url(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("%26"), F.lit("&")), F.lit("%3D"), F.lit("=")), F.lit("&amp;"), F.lit("&"))


def norm_lang_path(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "/(en|es|fr|de|pt|ru|ar)/", "/LANG/")


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def registrable_domain(host: Column) -> Column:
    parts = F.split(host, r"\.")
    return F.when(F.size(parts) <= 2, host).otherwise(F.array_join(F.slice(parts, -2, 2), "."))


def host_suffixes(host: Column) -> Column:
    """The host and each of its parent domains, longest first; for equi-joins on suffixes."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


#: Second levels below which a name of its own begins, after the name.
SECOND_LEVELS = r"^[^.]+\.(gov|go|govt|gob|gub|gc|org|or|com|co|net|ac|edu|rks-gov)\."


def site_pattern(host: Column) -> Column:
    """`*.host` for a domain of one's own, also below a public second level; `host/*` for a part of a portal that others share."""
    return F.when((F.regexp_count(host, F.lit(r"\.")) >= 2) & ~host.rlike(SECOND_LEVELS), F.concat(host, F.lit("/*"))).otherwise(F.concat(F.lit("*."), host))


def year_of(c: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(c, r"((?:19|20)\d{2})", 1), F.lit("")), F.lit("9999")).cast("int")


def max_year(c: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"((?:19|20)\d{2})"), 1), lambda y: y.cast("int")))


def url_year(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/(20\d{2})/\d{1,2}/", 1), F.lit("")).cast("int")


def lead_year(url: Column) -> Column:
    """The year of a date in an address: /2024/ or /2024-, else /241219/ (with a letter after it, if there is one)."""
    whole, short = F.regexp_extract(url, "/(20[12][0-9])[/-]", 1), F.regexp_extract(url, "/(2[0-6])(0[1-9]|1[0-2])[0-3][0-9][a-z]?[/-]", 1)
    return F.coalesce(F.nullif(whole, F.lit("")), F.concat(F.lit("20"), F.nullif(short, F.lit("")))).cast("int")


def safe_num(c: Column) -> Column:
    return c.try_cast("double")


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes"), F.lit(False))


def blank_to(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def norm_value(c: Column) -> Column:
    return F.replace(F.regexp_replace(F.lower(c), r"\s", ""), F.lit(","), F.lit("."))


# Script tests in order, and for each language in Latin script its function words and its own letters (with their weight).
SCRIPTS = (
    ("Korean", r"\p{IsHangul}"), ("Japanese", r"[\p{IsHiragana}\p{IsKatakana}]"), ("Chinese", r"\p{IsHan}"), ("Thai", r"\p{IsThai}"), ("Hebrew", r"\p{IsHebrew}"),
    ("Persian", "[پگچژ]"), ("Arabic", r"\p{IsArabic}"), ("Greek", r"\p{IsGreek}"),
    ("Ukrainian", "[іїєґ]"), ("Russian", "[ыэъё]"), ("Cyrillic (undetermined)", r"\p{IsCyrillic}"),
)
FUNCTION_WORDS = (
    ("English", "the|and|of|for|with|from", ()),
    ("French", "les|des|une|est|dans|pour|aux", ()),
    ("Spanish", "los|las|del|según|número|población|para", (("[ñ]", 2), ("[¿¡]", 2))),
    ("Portuguese", "dos|das|não|são|uma|reúne|informações|domicílios", (("ção|ões", 1), ("[ãõ]", 2))),
    ("German", "der|die|das|und|für|von|nicht", ()),
    ("Turkish", "ve|bir|için|ile|bu", (("[ığş]", 1),)),
    ("Dutch", "het|van|een|niet|voor", ()),
    ("Italian", "della|che|per|con|sono|degli", ()),
    ("Polish", "się|jest|oraz", (("[ąęłżź]", 1),)),
    ("Indonesian", "yang|dan|untuk|dari|dengan", ()),
)


def detect_language(c: Column, least: int = 3) -> Column:
    """The language's name by script, else by most function words and letters of its own (ties to the first listed).

    Null under 20 characters, undetermined if no language reaches `least`. Scripts are looked for in what is left without
    Latin letters; the listed words are taken out of the text once, and each language's are counted among those.
    """
    listed = sorted({w for _, words, _ in FUNCTION_WORDS for w in words.split("|")})
    own = "".join(p.strip("[]") for _, _, letters in FUNCTION_WORDS for p, _ in letters if p.startswith("["))

    def named(x: Column) -> Column:
        words = F.filter(F.split(x, r"[^\p{L}\p{M}\p{N}_]+"), lambda w: w.isin(*listed))
        found = F.struct(F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" ")).alias("words"), F.regexp_replace(x, f"[^{own}]+", "").alias("letters"))

        def score(f: Column, words: str, letters: tuple) -> Column:
            out = F.regexp_count(f["words"], F.lit(f" (?:{words}) "))
            for pattern, weight in letters:
                # endings hold letters of the language's own, so most texts are not searched for them
                hits = F.regexp_count(f["letters"], F.lit(pattern)) if pattern.startswith("[") else F.when(f["letters"].rlike(f"[{own}]"), F.regexp_count(x, F.lit(pattern))).otherwise(0)
                out = out + weight * hits
            return out

        best = bound(found, lambda f: F.array_max(F.array(*[F.struct(score(f, w, own_).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, (name, w, own_) in enumerate(FUNCTION_WORDS)])))
        return bound(best, lambda b: F.when(b["n"] >= least, b["name"]).otherwise("Latin script (undetermined)"))

    def scripted(other: Column) -> Column:
        out = F.when(F.length(c) < 20, F.lit(None).cast("string"))
        for name, pattern in SCRIPTS:
            out = out.when(other.rlike(pattern), F.lit(name))
        return out.otherwise(bound(F.lower(c), named))

    return F.when(c.isNotNull(), bound(F.regexp_replace(c, r"[\x00-\x{24F}\x{1E00}-\x{1EFF}]+", ""), scripted))


def windows_with(text: Column, pattern: str, size: int = 1500, budget: int = 12000) -> Column:
    """The blocks of a long text with most matches, in document order, within a budget of characters.

    The first block always counts high; runs of neighbouring blocks are joined, gaps are marked.
    """
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0))), lambda i: F.struct((F.regexp_count(F.substring(text, i * size + 1, F.lit(size)), F.lit(pattern)) + F.when(i == 0, 1000).otherwise(0)).alias("n"), (-i).alias("k"), F.substring(text, i * size + 1, F.lit(size)).alias("part")))
    top = F.slice(F.sort_array(blocks, asc=False), 1, max(2, budget // size))
    kept = F.sort_array(F.transform(top, lambda b: F.struct((-b["k"]).alias("k"), b["part"].alias("part"))))
    joined = F.aggregate(kept, F.struct(F.lit("").alias("out"), F.lit(-1).alias("last")), lambda s, b: F.struct(F.concat(s["out"], F.when((s["last"] >= 0) & (b["k"] > s["last"] + 1), F.lit("\n[...]\n")).otherwise(F.lit("")), b["part"]).alias("out"), b["k"].alias("last")), lambda s: s["out"])
    return F.when(F.length(text) <= budget, text).otherwise(joined)


def first_paragraph(text: Column, least: int = 80, most: int = 400) -> Column:
    return F.substring(F.get(F.filter(F.split(text, r"\n\s*\n|\n"), lambda p: F.length(p) > least), F.lit(0)), 1, most)


EMAIL = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"


def emails(text: Column, spam: str = r"example\.|noreply|no-reply|sentry|wixpress", most: int | None = 6) -> Column:
    """Distinct addresses in lower case, the first `most` (none: all)."""
    found = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(text, F.lit(EMAIL), 1), F.lower), lambda e: ~e.rlike(spam)))
    return found if most is None else F.slice(found, 1, most)


def chunk_text(text: Column, size: int) -> Column:
    """Pieces of `size` characters, in order."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0))), lambda i: F.substring(text, i * size + 1, F.lit(size)))


def html_escape(c: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def highlight(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, f"({pattern})", "<mark>$1</mark>")


def content_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def first_words(c: Column, k: int) -> Column:
    return F.array_join(F.slice(F.split(c, " "), 1, k), " ")


def content_tokens(c: Column, generic: Sequence[str] = (), least: int = 3) -> Column:
    """Distinct folded words of `least` letters on, without generic ones and numbers."""
    words = F.filter(F.split(fold(c), " "), lambda w: (F.length(w) >= least) & ~w.rlike(r"^\d+$"))
    return F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in generic]).cast("array<string>"))


def acronyms(c: Column, without: Sequence[str] = (), names: dict[str, str] | None = None, recode: dict[str, str] | None = None) -> Column:
    """Words of 2 to 7 capitals and digits, without those listed, recoded, with codes whose spelled-out pattern occurs."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\b([A-Z][A-Z0-9]{1,6})\b"), 1))
    found = F.array_except(found, F.array(*[F.lit(w) for w in without]).cast("array<string>"))
    if recode:
        table = F.create_map(*[F.lit(x) for pair in recode.items() for x in pair])
        found = F.transform(found, lambda a: F.coalesce(F.try_element_at(table, a), a))
    spelled = F.array_compact(F.array(*[F.when(fold(c).rlike(p), F.lit(code)) for code, p in (names or {}).items()]).cast("array<string>"))
    return F.array_union(found, spelled)


def names_join(names: Column, word: str = "and") -> Column:
    """'A', 'A and B', 'A, B and C'."""
    n = F.size(names)
    return F.when(n <= 1, F.array_join(names, "")).otherwise(F.concat(F.array_join(F.slice(names, 1, n - 1), ", "), F.lit(f" {word} "), F.element_at(names, -1)))


def title_or_basename(link_text: Column, title: Column, url: Column, least: int = 12) -> Column:
    return F.coalesce(F.when(F.length(link_text) > least, link_text), F.nullif(title, F.lit("")), F.nullif(F.regexp_extract(url, r"([^/]+)/?$", 1), F.lit("")))


def strip_footnotes(c: Column) -> Column:
    return squish(F.regexp_replace(c, r"\(\d+\)", ""))


def subject_entity(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(c, r"from (.+?)\s*$", 1)), F.lit(""))


def split_multi(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"[/;|+&\n]"), lambda x: F.trim(x)), lambda x: x != "")


def record_text(*parts: Column, most: int = 4000) -> Column:
    return F.substring(squish(F.concat_ws(" ", *parts)), 1, most)


def strip_json_object(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def search_phrase(title: Column, place: Column, generic: Sequence[str] = (), words: int = 3) -> Column:
    return F.concat_ws(" ", F.array_join(F.slice(content_tokens(title, generic), 1, words), " "), place)


# What names a kind of instrument and a population in titles, and the words that searches of catalogues know.
INSTRUMENTS = (("census", "census|recens|censo"), ("survey", "survey|enqu|encuesta|assessment|profiling|monitoring"))
SOUGHT = (("refugee", "refugee|réfugi|refugiad"), ("displaced", "idp|displaced|déplac|desplaz"), ("stateless", "stateless|apatri"))
COMMON = ("the", "of", "and", "for", "de", "la", "project", "survey", "study", "data", "report", "national", "joint", "center", "funded", "household")
TOPICS = (("refugee", "refugees", "refugee"), ("idp", "internally displaced", "displaced"), ("stateless", "stateless", "stateless"))


def search_phrases(title: Column, place: Column, populations: Column) -> Column:
    """What to ask of catalogues and search engines for one record, as a struct.

    short: place, population and kind of instrument; distinctive: three words of the title and the place; topic: the
    populations in words; catalogue: place and a word for each population; keywords: an array for table interfaces.
    Null title, place or populations count as empty.
    """
    title, place, populations = (F.coalesce(x, F.lit("")) for x in (title, place, populations))
    both, pops, low = F.lower(F.concat_ws(" ", title, populations)), F.lower(populations), F.lower(title)

    def first(rules: Sequence[tuple[str, str]]) -> Column:
        out = F.lit("")
        for name, pattern in reversed(rules):
            out = F.when(both.rlike(pattern), F.lit(name)).otherwise(out)
        return out

    words = F.array_except(F.array_distinct(F.filter(F.split(squish(F.regexp_replace(low, "[^a-z ]", " ")), " "), lambda w: F.length(w) > 3)), F.array(*map(F.lit, COMMON)))
    asked = lambda k: F.array_join(F.array_compact(F.array(*[F.when(F.contains(pops, F.lit(row[0])), F.lit(row[k])) for row in TOPICS])), " ")
    keys = F.array_distinct(F.flatten(F.array(*[
        F.when(cond, F.array(*map(F.lit, found))).otherwise(F.array().cast("array<string>"))
        for cond, found in (
            (F.contains(pops, F.lit("refugee")) | low.rlike("refugee|asylum"), ("asylum", "refugee")),
            (F.contains(pops, F.lit("idp")) | F.contains(low, F.lit("internally displaced")), ("displaced",)),
            (F.contains(pops, F.lit("stateless")) | low.rlike("stateless|nationalit"), ("stateless", "citizenship")),
        )
    ])))
    return F.struct(
        squish(F.concat_ws(" ", place, first(SOUGHT), first(INSTRUMENTS))).alias("short"), squish(F.concat_ws(" ", F.array_join(F.slice(words, 1, 3), " "), place)).alias("distinctive"),
        F.coalesce(F.nullif(asked(1), F.lit("")), F.lit("forcibly displaced")).alias("topic"), squish(F.concat_ws(" ", place, asked(2))).alias("catalogue"),
        F.when(F.size(keys) > 0, keys).otherwise(F.array(F.lit("migration"), F.lit("foreign"))).alias("keywords"),
    )


def html_to_text(html: Column, most: int | None = None) -> Column:
    """Text without tags, scripts and page furniture; `most` bounds the characters read (none: the whole page)."""
    x = html if most is None else F.substring(html, 1, most)
    x = F.regexp_replace(x, r"(?is)<(script|style|nav|footer|noscript)\b.*?</\1>", " ")
    x = F.regexp_replace(F.regexp_replace(x, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(sign))
    return squish(x)
