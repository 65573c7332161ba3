"""The dealt operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import (
    bag_minhash,
    byte_bpe,
    chat,
    conversation_repair,
    html_text,
    kneser_ney,
    line_dedup,
    ngram_join,
    qgram_filter,
    syncmers,
    token_counts,
    vector_codes,
    wavelet,
)
from gridspark.llm.common import table
from gridspark.session import scratch_path

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
BPE_50K = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN, "doc_id"
    )
    return byte_bpe.digests(coded, "doc_id")


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_50K), "doc_id")


@query
def op7_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BPE_50K))
    return wavelet.read_shards(spark, path)


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", control), (-7, 1, "assistant", control)], given.schema
    )
    return chat.digests(chat.format_turns(given.unionByName(added), chat.text_parts()))


@query
def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"), "doc_id")


# The formatted text is the turn's three marks and line end (9 + 8 + 7 + 1 characters), role and
# text, and one more character for each of the three that are escaped.
ORACLES["op8_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(8 + length(role) + 8 + length(text) + 7 + 1
           + length(role || text) - length(replace(replace(replace(role || text, '\', ''), '<', ''), '[', '')))
           AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_qgram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_filter.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with what it found."""
    judged = kneser_ney.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.filter("keep").select("doc_id", "lang", "n_bytes", "perplexity", "threshold")


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(documents).select("doc_id", "text", "n_lines", "n_removed")


ORACLES["op6_line_dedup"] = line_dedup.SQL


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.label_errors(found.rows)
    digest = hashlib.sha256(vector_codes.decimal_text(found.codebooks).encode()).hexdigest()
    return rows.select(
        F.col("key").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


ORACLES["op12_vector_codes"] = vector_codes.sql()


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.repaired(conversation_repair.damaged(given))
    sums = found.conversations.withColumnRenamed("conv", "c")
    hashes = conversation_repair.digests(found.turns).withColumnRenamed("conv", "h")
    out = given.select("conv_id").distinct()
    out = out.join(sums, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    out = out.join(hashes, F.col("conv_id").eqNullSafe(F.col("h")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


ORACLES["op13_conversation_repair"] = conversation_repair.SQL
ORACLES["op11_ngram_join"] = ngram_join.SQL
