"""The corpus pipeline: documents to token ids, in stages that each filter or change what is left.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its
result is written as Parquet and read again as the next one's docs. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bag_minhash, byte_bpe, kneser_ney, line_dedup, qgram_filter
from gridspark.llm.common import table, text_or_empty, written

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; the model is trained on the trusted ones of `docs`."""
    judged = kneser_ney.classified(docs, table(spark, sf_dir, "labels"))
    rejected = judged.filter(~F.col("keep")).select(F.col("doc_id").alias("id"), "version").distinct()
    # By id and text: a row does not go for another text of the same id.
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(text_or_empty()) == F.col("version"))
    return docs.join(rejected, same, "left_anti")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines cut out; documents of which nothing is left go."""
    cut = line_dedup.deduplicated(docs).filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id, and one row of it
    for each of its texts."""
    copies = bag_minhash.near_duplicates(docs).filter("class_id <> doc_id").select("doc_id").distinct()
    left = docs.join(copies, "doc_id", "left_anti")
    several = docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL")
    several = written(several.select("doc_id"), "repeated-ids")
    # Only rows of ids that occur again are brought together; without any, Spark joins with nothing.
    again = left.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(several, "doc_id", "left_anti").unionByName(again)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return qgram_filter.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of the bytes they decode to."""
    coded = byte_bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, "doc_id")
    return coded.select(
        "doc_id", "n_tokens", "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("byte-level BPE", token_ids),
]

#: The classifier's model has no SQL; the result is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents` below `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
