"""Reading landed files and writing published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column that may be absent."""
    return (df[name] if name in df.columns else F.lit(None)).cast(kind).alias(name)


def read_landed_csv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """CSV read as text, then the named columns tried as their types (null where they don't fit)."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(paths)
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in (types or {}).items() if c in df.columns})


def union_snapshots(frames: list[DataFrame], key: str = "url", order: str = "snapshot_date", newest_first: bool = True, ties: tuple[str, ...] = ()) -> DataFrame:
    """All snapshots, one row a key: from the newest (or oldest) snapshot; ties by the other columns named."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    by = [F.col(order).desc_nulls_last() if newest_first else F.col(order).asc_nulls_last(), *map(F.col, ties)]
    return out.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*by))).where("__k = 1").drop("__k")


def pending(targets: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Targets that the manifest of finished work lacks."""
    return targets.join(done.select(key if isinstance(key, list) else [key]).distinct(), key, "left_anti")


def append_manifest(done: DataFrame, path: str) -> None:
    done.write.mode("append").parquet(path)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The locked columns in their order: absent ones null, others left out."""
    return df.select(*[(df[f.name] if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def dropped_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [c for c in df.columns if c not in schema.fieldNames()]


def read_catalog_rows(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Study rows of catalogue search answers; the producer falls back to the repository's title."""
    schema = "result struct<rows:array<struct<idno:string,title:string,nation:string,year_start:string,year_end:string,authoring_entity:string,repo_title:string>>>"
    rows = raw.select(F.explode(F.from_json(column, schema)["result"]["rows"]).alias("r")).select("r.*")
    return rows.select("idno", "title", "nation", F.col("year_start").try_cast("int").alias("year_start"), F.col("year_end").try_cast("int").alias("year_end"), F.coalesce(F.nullif("authoring_entity", F.lit("")), "repo_title").alias("producer"))


def read_sitemap(raw: DataFrame, column: str = "payload") -> DataFrame:
    """url and lastmod of every entry of sitemaps and sitemap indexes; is_index tells which."""
    schema = "url array<struct<loc:string,lastmod:string>>, sitemap array<struct<loc:string,lastmod:string>>"
    parsed = raw.select(F.from_xml(F.col(column), schema).alias("x"))
    each = F.array_union(F.coalesce(F.transform("x.url", lambda u: F.struct(u["loc"].alias("url"), u["lastmod"].alias("lastmod"), F.lit(False).alias("is_index"))), F.array()), F.coalesce(F.transform("x.sitemap", lambda u: F.struct(u["loc"].alias("url"), u["lastmod"].alias("lastmod"), F.lit(True).alias("is_index"))), F.array()))
    return parsed.select(F.explode(each).alias("e")).select("e.*")


def read_cdx_jsonl(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.get_json_object(column, "$.url").alias("url")).where("url is not null").distinct()


def read_sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """iso3, indicator, year, value of countries (three capitals)."""
    df = spark.read.option("header", True).csv(path)
    return df.where(F.col("REF_AREA").rlike("^[A-Z]{3}$")).select(F.col("REF_AREA").alias("iso3"), F.col("INDICATOR").alias("indicator"), F.col("TIME_PERIOD").try_cast("int").alias("year"), F.col("OBS_VALUE").try_cast("double").alias("value"))


def variable_inventory(raw: DataFrame, key: str = "study", column: str = "payload", most: int = 60) -> DataFrame:
    """One row per variable of a study description: name, label, question, its first categories."""
    schema = "dataDscr struct<var:array<struct<_name:string,labl:string,qstn:struct<qstnLit:string>,catgry:array<struct<labl:string>>>>>"
    v = raw.select(key, F.explode(F.from_xml(F.col(column), schema)["dataDscr"]["var"]).alias("v"))
    return v.select(key, F.col("v._name").alias("name"), F.col("v.labl").alias("label"), F.col("v.qstn.qstnLit").alias("question"), F.slice(F.transform("v.catgry", lambda c: c["labl"]), 1, most).alias("categories"))


#: href in double, single or no quotes, and the text of the link.
LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""


def extract_links(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Absolute url and text of every link; mail, script, phone and in-page links are left out."""
    # a group that takes no part is empty, so the three forms join
    one, two, three, text = (F.regexp_extract_all(html, F.lit(LINK), k) for k in (1, 2, 3, 4))
    hits = F.arrays_zip(F.zip_with(F.zip_with(one, two, lambda x, y: F.concat(x, y)), three, lambda x, y: F.concat(x, y)).alias("href"), text.alias("text"))
    rows = pages.select(*keep, F.col(url).alias("base"), F.explode(hits).alias("l")).select(*keep, "base", F.trim("l.href").alias("href"), F.trim(F.regexp_replace(F.regexp_replace("l.text", "<[^>]*>", " "), r"\s+", " ")).alias("anchor_text"))
    rows = rows.where(~F.col("href").rlike("(?i)^(mailto:|javascript:|tel:|#)") & (F.col("href") != ""))
    scheme, root = F.regexp_extract("base", "^([a-z]+:)", 1), F.regexp_extract("base", "^([a-z]+://[^/?#]*)", 1)
    folder = F.regexp_extract("base", "^([a-z]+://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    link = F.when(F.col("href").rlike("^[a-zA-Z]+://"), F.col("href")).when(F.col("href").startswith("//"), F.concat(scheme, "href")).when(F.col("href").startswith("/"), F.concat(root, "href")).otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), "href"))
    return rows.select(*keep, link.alias("link"), "anchor_text")


def crawl_stats(urls: DataFrame, by: str = "domain") -> DataFrame:
    """Counts by source and a coverage class per domain; urls has domain and source (sitemap or archive)."""
    out = urls.groupBy(by).agg(F.count_if(F.col("source") == "sitemap").alias("sitemap_urls"), F.count_if(F.col("source") == "archive").alias("archive_urls"), F.count("*").alias("total"))
    return out.withColumn("coverage", F.when((F.col("sitemap_urls") > 0) & (F.col("archive_urls") > 0), "full").when(F.col("sitemap_urls") > 0, "sitemap only").when(F.col("archive_urls") > 0, "archive only").otherwise("NONE"))


def read_jsonstat_dims(raw: DataFrame, column: str = "payload", aggregates: tuple[str, ...] = ("EU", "EA")) -> DataFrame:
    """geo and label of every area of JSON-stat answers with two-letter codes, aggregates left out, and the answer's last period."""
    schema = "dimension struct<geo:struct<category:struct<label:map<string,string>>>,time:struct<category:struct<label:map<string,string>>>>"
    d = raw.select(F.from_json(column, schema)["dimension"].alias("d"))
    rows = d.select(F.explode(F.map_entries("d.geo.category.label")).alias("g"), F.array_max(F.map_keys("d.time.category.label")).alias("period"))
    return rows.select(F.col("g.key").alias("geo"), F.col("g.value").alias("label"), "period").where(F.col("geo").rlike("^[A-Z]{2}$") & ~F.col("geo").isin(*aggregates))


def read_nested_reports(raw: DataFrame, column: str = "payload") -> DataFrame:
    """title, url, date and the joined names of sources and countries of report search answers."""
    schema = "data array<struct<fields:struct<title:string,url:string,date:struct<created:string>,source:array<struct<name:string>>,country:array<struct<name:string>>>>>"
    f = raw.select(F.explode(F.from_json(column, schema)["data"]).alias("r")).select("r.fields.*")
    names = lambda c: F.array_join(F.transform(F.coalesce(c, F.array()), lambda s: s["name"]), "; ")
    return f.select("title", "url", F.substring("date.created", 1, 10).try_cast("date").alias("created"), names(F.col("source")).alias("sources"), names(F.col("country")).alias("countries"))
