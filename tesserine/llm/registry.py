"""Queries opN_<name> over their whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, jaccard_join, line_dedup, mixing, pii, quality_crf, secrets, sharding, substring_dedup, vector_codes, warc, word_runs
from .common import table


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.query(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(*exact_dedup.QUERY_COLUMNS)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(*mixing.QUERY_COLUMNS)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(*warc.QUERY_COLUMNS)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.query(table(spark, sf_dir, "embeddings"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.query(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_crf, op2_line_dedup, op3_suffix_dedup, op4_exact_dedup, op5_jaccard_join, op6_secret_scan, op7_mix_sources, op8_decontaminate, op9_warc, op10_pii, op11_vector_codes, op12_word_runs, op13_sharding)}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.ORACLE_SQL, "op8_decontaminate": decontaminate.ORACLE_SQL, "op9_warc": warc.ORACLE_SQL, "op4_exact_dedup": exact_dedup.ORACLE_SQL, "op7_mix_sources": mixing.ORACLE_SQL}
