"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's
rows as Parquet in the shared folder and hands the reread table to the next, so that a
lost executor never costs a finished stage. Stages work on all that their predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserine.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_crf
from tesserine.llm.common import table, without_ids, written

#: CRF marginals, near-duplicate components and systematic sampling aren't SQL; tests hold
#: the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts are judged as one empty
    line, rows with the same text alike; a null id doesn't matter."""
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    return quality_crf.classify(docs, model).filter("_predicted = 1").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows. Every document stays, also with null
    or empty text or a null source (a source of its own); repeated rows count as pages."""
    out = line_dedup.drop_boilerplate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays. Documents
    without words, or without an id, are in no group and stay; rows that repeat the least id
    all stay. Rows that share an id are one document with all their texts, so what is near to
    any of them is in their group."""
    groups = written(jaccard_join.jaccard_components(docs), "groups")
    return without_ids(docs, groups.filter("doc_id != component_id").select("doc_id"), "doc_id")


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a benchmark item, or a chain of its words, go. Null
    and empty texts and rows without an id stay; all rows of a contaminated id go."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, found.select("doc_id"), "doc_id")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered in the new column copy (_copy where
    there is a column copy). Rows that
    share an id, or have none, are taken one by one; documents without words have size 0 and
    go with their source's rate; an empty table gives an empty one. Equal rows are alike, so
    it doesn't matter which of them is taken."""
    return mixing.mixed(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontaminate", benchmark_free), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
