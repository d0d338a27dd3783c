"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, lm, neardup, packing, quality, shards, store, tokenfiles, toxicity, urls, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an archive that one task scans; the archives here are small.
SPLIT_BYTES = 2 << 20


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), SPLIT_BYTES)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(_table(spark, sf_dir, "documents"), order=3)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), urls.listed_urls(spark))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of")


#: Bytes of a merged shard; the tables here are small.
SHARD_BYTES = 32 << 20


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as it is read back from the last version, with what holds of all shards."""
    rows, state = shards.shard_documents(_table(spark, sf_dir, "documents"), store.fresh_dir(spark, "shards"), SHARD_BYTES)
    facts = {k: F.lit(state[k]) for k in ("rows_before", "arrivals_left", "unnamed", "surplus_shards")}
    return rows.select("doc_id", "lang", "source", "n_chars", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), *(c.cast("bigint").alias(k) for k, c in facts.items()), F.lit(state["versions"] > 1).alias("committed"))


#: Bytes of a part of the token files; the tables here are small.
PART_BYTES = 32 << 20


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(_table(spark, sf_dir, "documents"), part_bytes=PART_BYTES)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("content")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_url_filters": op3_url_filters,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_sharding": op6_sharding,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_rules": op10_quality_rules,
}
ORACLES: dict[str, str] = {
    "op3_url_filters": urls.ORACLE,
    "op6_sharding": "SELECT doc_id, lang, source, n_chars, md5(coalesce(text, '')) AS text_md5, (SELECT count(*) FROM documents) AS rows_before, 0::BIGINT AS arrivals_left, 0::BIGINT AS unnamed, 0::BIGINT AS surplus_shards, (SELECT count(*) FROM documents) > 1 AS committed FROM documents",
    "op10_quality_rules": quality.ORACLE,
}
