"""Named queries over the driver's tables, one for each operator, by their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (
    conversations,
    decontamination,
    fingerprints,
    language,
    licenses,
    lm_scoring,
    mixing,
    ngram_join,
    pii,
    quality,
    tokens,
    url_filter,
    vector_codes,
)
from stockflow.llm.shipping import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    counts = tokens.count_tokens(table(spark, sf_dir, "documents"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > tokens.OVER)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it, in the order of the queue."""
    sent = mixing.queue(table(spark, sf_dir, "documents"), ["doc_id"])
    return sent.orderBy("finish", "doc_id").select("doc_id", "size", "source_size", "target", "taken")


def language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def graded_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected are documents that are more likely than not above the lowest grade."""
    documents = table(spark, sf_dir, "documents")
    model = quality.learn(documents, quality.grades_of(table(spark, sf_dir, "labels")))
    scored = quality.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        "expected_grade",
        F.col("tails")[0].alias("p_not_toxic"),
        F.col("tails")[1].alias("p_high"),
        (F.col("tails")[0] < 0.5).alias("toxic"),
        (F.col("tails")[0] >= 0.5).alias("keep"),
    )


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.find_passages(documents, benchmark, ["doc_id"])
    n_hit = "aggregate(hits, 0L, (n, x) -> n + x.end - x.first)"
    return found.select(
        "doc_id",
        "n_words",
        F.expr(n_hit).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.masked(table(spark, sf_dir, "documents").select("doc_id", "text"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", language.fold("doc_id", 4) == 2)
    filters = language.learn(documents.filter("NOT held_out"))
    return language.predict(documents, filters, ["doc_id", "held_out"])


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def compressed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


# the rules of the contract: host, path, verdict
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(table(spark, sf_dir, "pages"), rules, ["page_id"])


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with a fault put into five of twenty; `present` is false for dropped ones."""
    name = "concat(coalesce(string(conv_id), ' '), ':', coalesce(string(turn), ' '))"
    kind = F.col("kind")
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.expr(f"crc32({name}) % 20").alias("kind"))
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            (kind != 0).alias("present"),
            F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(damaged(table(spark, sf_dir, "conversations")), present="present")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts,
    "op2_license_scans": license_scan,
    "op3_mixing_sources": mix,
    "op4_lm_scoring": language_model_scores,
    "op5_quality_classifier": graded_quality,
    "op6_benchmark_decontamination": benchmark_hits,
    "op7_pii": pseudonyms,
    "op8_language_id": languages,
    "op9_document_fingerprints": document_fingerprints,
    "op10_ngram_jaccard_join": near_duplicates,
    "op11_vector_code_compression": compressed_vectors,
    "op12_url_filters": url_verdicts,
    "op13_conversation_repair": repaired_conversations,
}
