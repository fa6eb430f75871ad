"""Small helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word is a run of characters other than the ASCII spaces.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Only a
    local session without that setting (tests) gets a temporary folder, removed at exit."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tesserine-")
    atexit.register(shutil.rmtree, own, True)
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/tesserine/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cuts lineage: df as a Parquet table in the shared folder, read again. A lost
    executor then costs only the tasks that read it."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds what one Arrow batch may hold, since single texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: Tables are broadcast up to so many bytes of values, else joined by shuffle.
BROADCAST_BYTES = 20 << 20


def if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, a written table, to be broadcast if the values of its rows hold at most so many
    bytes. Their length as JSON stands for it, which is about the size of a row in memory; at
    least 8 bytes a column. Rows are measured until the bound is passed only."""
    rows = most // (8 * max(1, len(df.columns)))
    size = F.sum(F.greatest(F.length(F.to_json(F.struct("*"))), F.lit(8 * len(df.columns))))
    n, used = df.limit(rows + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if n <= rows and (used or 0) <= most else df


def spread_join(rows: DataFrame, groups: DataFrame, key: str | list[str], weight: str, share: int = 1000) -> DataFrame:
    """rows joined with groups, a written table of one row a key, without weight, the number
    of rows with the key. Keys with over 1/share of all rows are at most share, so they are
    broadcast; no other key brings more than that share of the rows to one task."""
    total = groups.agg(F.sum(weight)).first()[0] or 0
    heavy = groups.filter(F.col(weight) > total / share).drop(weight)
    light = groups.filter(F.col(weight) <= total / share).drop(weight)
    return rows.join(F.broadcast(heavy), key).unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """docs less the rows whose id is in ids; rows with a null id stay."""
    ids = written(ids.select(F.col(id_col).alias("_gone")).distinct(), "ids")
    ids = if_small(ids)
    return docs.join(ids, docs[id_col] == ids["_gone"], "left_anti")
