"""The operators of this subpackage over whole tables: one query each, and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poseframes.llm import byte_bpe, compression_bands, conversation_repair, embedding_dedup, hard_negatives, jaccard_join, language_id, order_minhash, source_mix, suffix_dedup, token_counts, training_order, warc_fixity
from poseframes.llm.common import bound_batches


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(_read(spark, sf_dir, "documents"), k=50)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return source_mix.systematic_copies(docs).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken")
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), 0.93)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.compression_bands(_read(spark, sf_dir, "documents"))


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc_fixity.audit(pages, warc_fixity.worn_replica(pages))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialised(_read(spark, sf_dir, "documents"), key=20_240_917)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(_read(spark, sf_dir, "documents"), k=3, percent=90)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are wrong on purpose."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings").withColumn("label", moved), "id % 100 = 0")


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(_read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_damage(_read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_language_id": op4_language_id,
    "op5_compression_bands": op5_compression_bands,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_training_order": op7_training_order,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_token_counts": op9_token_counts,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_order_minhash": op12_order_minhash,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op2_source_mix": source_mix.ORACLE_SQL,
    "op3_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op6_warc_fixity": warc_fixity.ORACLE_SQL,
    "op10_jaccard_join": jaccard_join.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_conversation_repair": conversation_repair.ORACLE_SQL,
}
