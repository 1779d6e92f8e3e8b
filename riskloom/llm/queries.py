"""The registered queries of the text operators: whole tables in, digest columns out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import (
    alignment,
    licenses,
    mixing,
    nearest,
    packing,
    personal_data,
    pieces,
    pitman_yor,
    quality_model,
    quality_rules,
    simhash,
    toxicity,
    whitening,
)
from riskloom.llm.common import table


def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    base = F.filter("places", lambda p: p["base"])
    first = F.transform(base, lambda p: p["first"])
    names = licenses.labels_of
    score = F.array_max(F.transform("places", lambda p: p["score"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.least(F.lit(1.0), F.coalesce(score, F.lit(0.0))).alias("score"),
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rows.select("doc_id", *quality_rules.STATISTICS, "base_failed", "kept")


def op5_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score(table(spark, folder, "documents"))


def op6_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_model.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, folder, "documents"), carry=["doc_id"])
    counts = [
        F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
        for kind in personal_data.KINDS
    ]
    names = personal_data.span_names
    return found.select(
        "row.doc_id",
        *counts,
        F.sha2(names(F.col("base")), 256).alias("base_sha256"),
        names(personal_data.all_spans(F.col("base"), F.col("found"))).alias("spans"),
    )


def op11_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.encode_decode(table(spark, folder, "documents"))
    return found.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(table(spark, folder, "documents"))
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return found.select("row.doc_id", *counts, F.col("digest").alias("groups_sha256"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_simhash_groups": op6_simhash_groups,
    "op7_mix_sources": op7_mix_sources,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_personal_data": op10_personal_data,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_token_alignment": op12_token_alignment,
    "op13_whitening": op13_whitening,
}

# SQL twins; the operators that SQL cannot express are tested against brute force.
ORACLE: dict[str, str] = {}
