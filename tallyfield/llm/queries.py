"""The queries op1_ to op13_: each applies its operator to its whole table and returns the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fim, lexical, mixing, neighbours, ngram_join, quality, substring_dedup, tokens, toxicity, urlfilter, warc

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A conversation whose texts hold control strings of common templates.
CONTROL = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.assemble(warc.records(warc.write(_read(spark, sf_dir, "pages"))))
    told = lambda name: F.try_element_at(F.try_element_at("metadata", F.lit(1))["info"], F.lit(name)).try_cast("long")
    whole = F.col("response.record_type") == "response"
    return captures.select(
        told("page-id").alias("page_id"),
        F.when(whole, F.col("response.payload_bytes")).otherwise(told("payload-bytes")).alias("payload_bytes"),
        F.when(whole, F.col("response.computed_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        told("refers-to-page-id").alias("refers_to"),
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.apply_rules(_read(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find(_read(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_text_links")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, books = neighbours.build(_read(spark, sf_dir, "embeddings"))
    return neighbours.search(index, books, index.where("vec_id % 100 = 0").select("vec_id", "embedding"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read(tokens.write(_read(spark, sf_dir, "documents")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c, 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


QUERIES = {
    f.__name__: f
    for f in (op1_warc_transactions, op2_chat_format, op3_url_filter, op4_substring_dedup, op5_ngram_jaccard_join, op6_nearest_neighbours, op7_quality_classifier, op8_mix_sources, op9_decontaminate, op10_token_files, op11_lexical_search, op12_toxicity, op13_fill_in_middle)
}
