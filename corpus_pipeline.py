"""From ``documents`` to packed training sequences, in five stages.

Every stage takes what the one before kept, written as Parquet, and its decisions take effect. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from tillscope.llm.tables import table
from tillscope.llm.workers import ship_package
from tillscope.sources.shared import delete_folder, fresh_folder, scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those too unlike every learned language."""
    ship_package(spark)
    return language_id.without_rejected(docs, language_id.fit(docs.select("doc_id", "text", "lang")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts; a document of which nothing is left goes. ``n_chars`` follows."""
    return line_dedup.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class."""
    ship_package(spark)
    return near_dedup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    ship_package(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with a checksum of their ids."""
    ship_package(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Language models, alignment and tokenizers are beyond SQL; tests check what every stage keeps and that its decisions hold.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    What a stage stores on the way is deleted once its result is written, and so is the result of the stage before.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        out = fresh_folder(spark)
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(out)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(out), out
    return docs
