"""Places: one spelling a country, lists and regions told apart from countries, codes, and the interface that serves a country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.rules import first_match

# Spellings and the canonical names of the register.
ALIASES = {
    "Turkey": "Türkiye", "Netherlands": "Netherlands (Kingdom of the)", "Tanzania": "United Republic of Tanzania", "Russia": "Russian Federation",
    "Ivory Coast": "Côte d'Ivoire", "Cote d'Ivoire": "Côte d'Ivoire", "Palestine": "State of Palestine", "Moldova": "Republic of Moldova",
    "Bolivia": "Bolivia (Plurinational State of)", "Venezuela": "Venezuela (Bolivarian Republic of)", "Iran": "Iran (Islamic Republic of)", "Syria": "Syrian Arab Republic",
    "Vietnam": "Viet Nam", "Laos": "Lao People's Democratic Republic", "South Korea": "Republic of Korea", "DR Congo": "Democratic Republic of the Congo",
    "DRC": "Democratic Republic of the Congo", "Congo, Dem. Rep.": "Democratic Republic of the Congo", "Congo, Rep.": "Congo", "Yemen, Rep.": "Yemen",
    "Egypt, Arab Rep.": "Egypt", "Iran, Islamic Rep.": "Iran (Islamic Republic of)", "Kyrgyz Republic": "Kyrgyzstan", "Slovak Republic": "Slovakia",
    "Czech Republic": "Czechia", "Moldova (the Republic of)": "Republic of Moldova", "Federal Republic of Somalia": "Somalia", "United States": "United States of America",
    "Venezuela, RB": "Venezuela (Bolivarian Republic of)", "Gambia, The": "Gambia", "Lao PDR": "Lao People's Democratic Republic", "Korea, Rep.": "Republic of Korea",
    "United Kingdom of Great Britain and Northern Ireland": "United Kingdom", "UK": "United Kingdom", "Turkiye": "Türkiye",
    "Iran, Islamic Republic of": "Iran (Islamic Republic of)", "Iran (Islamic Rep. of)": "Iran (Islamic Republic of)", "Palestine, State of": "State of Palestine",
    "Guinea Bissau": "Guinea-Bissau", "Cameroon Republic of": "Cameroon", "Congo Democratic Republic of the": "Democratic Republic of the Congo",
    "Dem. Rep. of the Congo": "Democratic Republic of the Congo", "Congo Republic of the": "Congo", "Tanzania United Republic of": "United Republic of Tanzania",
    "United Rep. of Tanzania": "United Republic of Tanzania", "China - Hong Kong SAR": "China, Hong Kong SAR", "China - Macao SAR": "China, Macao SAR",
    "Korea, Republic of": "Republic of Korea", "Korea, Democratic People's Republic of": "Democratic People's Republic of Korea", "Libya Arab Jamahiriya": "Libya",
    "Micronesia, Federated States of": "Micronesia (Federated States of)", "Sao Tomé and Principé": "Sao Tome and Principe", "St. Kitts and Nevis": "Saint Kitts and Nevis",
    "St. Lucia": "Saint Lucia", "St. Vincent and the Grenadines": "Saint Vincent and the Grenadines",
}
# Names of regions, spellings that a map of the world does not know, and statistical codes of countries.
REGIONS = ("Europe and Central Asia", "Sub-Saharan Africa", "Middle East and North Africa", "East Asia and Pacific", "Latin America and the Caribbean", "South Asia", "World")
MAP_NAMES = {
    "Congo, Dem. Rep.": "Democratic Republic of the Congo", "Moldova (the Republic of)": "Moldova", "Federal Republic of Somalia": "Somalia", "Slovak Republic": "Slovakia",
    "Yemen, Rep.": "Yemen", "Kyrgyz Republic": "Kyrgyzstan", "State of Palestine": "Palestine",
}
MAP_REGIONS = ("Europe and Central Asia",)
GEO_CODES = {
    "Austria": "AT", "Belgium": "BE", "Bulgaria": "BG", "Croatia": "HR", "Cyprus": "CY", "Czechia": "CZ", "Denmark": "DK", "Estonia": "EE", "Finland": "FI",
    "France": "FR", "Germany": "DE", "Greece": "EL", "Hungary": "HU", "Ireland": "IE", "Italy": "IT", "Latvia": "LV", "Lithuania": "LT", "Luxembourg": "LU",
    "Malta": "MT", "Netherlands": "NL", "Poland": "PL", "Portugal": "PT", "Romania": "RO", "Slovakia": "SK", "Slovenia": "SI", "Spain": "ES", "Sweden": "SE",
}
LIST_OF_PLACES, WIDE_LIST = r",|\.\.\.and \d+ more", r",|and \d+ more|region|europe and|africa$|americas"


def recode(c: Column, table: dict[str, str]) -> Column:
    """What the table says of a value, else the value."""
    return F.coalesce(lookup(c, table), c)


def lookup(c: Column, table: dict[str, str]) -> Column:
    """What the table says of a value, else null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def harmonize_country(c: Column) -> Column:
    """The canonical name of a country, stars and outer spaces taken off; unknown names stay, null gives ''."""
    return recode(F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("*"), F.lit(""))), ALIASES)


def is_multi_country(c: Column, wide: bool = False) -> Column:
    """Whether a name stands for several countries: a list or a region. wide: also words that only name parts of the world."""
    x = F.coalesce(c, F.lit(""))
    return x.rlike(WIDE_LIST) if wide else x.rlike(LIST_OF_PLACES) | x.isin(*REGIONS)


def map_place(c: Column) -> Column:
    """Struct (map_country, is_single_country): lists of three names on, '... more' and regions are no single country."""
    several = c.rlike("more$") | c.isin(*MAP_REGIONS) | (F.regexp_count(c, F.lit(",")) >= 2)
    single = F.coalesce(~several, F.lit(False))
    return F.struct(F.when(single, recode(c, MAP_NAMES)).alias("map_country"), single.alias("is_single_country"))


def geo_harmonize(rows: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """rows with map_country, iso3 (from codes: country, iso3; one row a country) and is_single_country."""
    out = rows.withColumn("__place", map_place(F.col(column))).select("*", "__place.*").drop("__place")
    return out.join(codes.select(F.col("country").alias("map_country"), "iso3"), "map_country", "left").select(*out.columns, "iso3")


def geo_code(c: Column) -> Column:
    """The statistical code of a country in any spelling, null for others."""
    return F.coalesce(lookup(F.trim(c), GEO_CODES), lookup(harmonize_country(c), GEO_CODES))


def registry_gate(c: Column) -> Column:
    """The statistical interface that serves a country, null where none does."""
    return F.when(harmonize_country(c) == "Norway", "SSB").when(geo_code(c).isNotNull() | harmonize_country(c).isin("Netherlands (Kingdom of the)"), "Eurostat")


def routed_registry(registry: DataFrame, key: str, interfaces: Sequence[tuple[str, DataFrame]], default: str = "none") -> DataFrame:
    """registry with interface: the first whose members hold the row's key. interfaces: (name, members with the same key)."""
    out, found = registry, []
    for k, (name, members) in enumerate(interfaces):
        out = out.join(members.select(key).distinct().withColumn(f"__in{k}", F.lit(True)), key, "left")
        found.append((name, F.col(f"__in{k}")))
    return out.select(*registry.columns, first_match(found, default).alias("interface"))
