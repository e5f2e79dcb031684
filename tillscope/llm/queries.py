"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import (
    chat,
    decontaminate,
    filter_audit,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_ledger,
    token_files,
    vector_codes,
    warc,
)
from tillscope.llm.stored import stored
from tillscope.llm.tables import table
from tillscope.llm.workers import ship_package
from tillscope.sources.shared import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = F.coalesce(language_id.fold() == 2, F.lit(False))
    scores, _ = quality_classifier.train_and_score(table(spark, sf_dir, "documents"), labels, learn=~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    found = language_id.classify(docs, language_id.fit(docs.select("doc_id", "text", "lang")))
    held_out = F.coalesce(language_id.fold() == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "cross_entropy", "rejected")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    overlaps = decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return overlaps.by_document().select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    records = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    folder = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], given.schema)
    turns = given.union(added).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.read_back(stored(chat.format_turns(turns)))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    classes = near_dedup.near_duplicates(table(spark, sf_dir, "documents")).documents
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the lines that go are joined by commas."""
    found = line_dedup.decide(table(spark, sf_dir, "documents")).documents
    return found.select(
        "doc_id", "n_lines", F.size("exact").cast("long").alias("n_exact"), F.size("near").cast("long").alias("n_near"),
        F.array_join(F.col("exact").cast("array<string>"), ",").alias("exact_lines"),
        F.array_join(F.col("near").cast("array<string>"), ",").alias("near_lines"), "n_links",
    )


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_ledger.SecretLedger(spark, fresh_folder(spark))
    ledger.record(docs)
    found = ledger.by_path(path_type=docs.schema["doc_id"].dataType.simpleString())
    kinds = [rule.kind for rule in secret_ledger.BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        F.col("path").alias("doc_id"), *[count(kind) for kind in kinds],
        F.sha2(secret_ledger.joined_spans(base), 256).alias("base_sha256"),
        secret_ledger.joined_spans(F.col("spans")).alias("spans"), F.col("blob"),
    )


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_error(stored(codes.rows))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_token_files": op7_token_files,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_filter_interaction_audit": op11_filter_interaction_audit,
    "op12_secret_scans": op12_secret_scans,
    "op13_vector_code_compression": op13_vector_code_compression,
}
