"""Incremental and stateful operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import _typed
from ..sources.writers import merged, replace_table, without


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Key, action: add, update, delete or keep, by the version of each key."""
    a = old.select(key, F.col(version).alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select(key, F.col(version).alias("_new"), F.lit(True).alias("_in_new"))
    action = F.when(F.col("_in_old").isNull(), "add").when(F.col("_in_new").isNull(), "delete").when(F.col("_old").eqNullSafe(F.col("_new")), "keep").otherwise("update")
    return a.join(b, key, "full_outer").select(key, action.alias("action"))


def reconcile(index: DataFrame, snapshot: DataFrame, key: str, version: str, build: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The new index, and counts by action. Only added and updated keys are built."""
    actions = snapshot_diff(index, snapshot, key, version)
    fresh = build(snapshot.join(actions.filter("action in ('add', 'update')").select(key), key, "left_semi"))
    kept = index.join(actions.filter("action = 'keep'").select(key), key, "left_semi")
    return kept.unionByName(fresh, allowMissingColumns=True), actions.groupBy("action").agg(F.count("*").alias("count"))


def refresh_one(index: DataFrame, snapshot: DataFrame, key: str, value, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One key built again, or gone if it is no longer there."""
    return index.filter(~F.col(key).eqNullSafe(F.lit(value))).unionByName(build(snapshot.filter(F.col(key) == value)), allowMissingColumns=True)


def versioned(spark: SparkSession, index: DataFrame, stored: int | None, wanted: int) -> DataFrame:
    """The index, empty when its schema version isn't the wanted one."""
    return index if stored == wanted else index.limit(0)


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The event log as a stream of files."""
    return spark.readStream.schema(_typed(schema)).json(path)


def run_once(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Everything new since the checkpoint, then an end; run again to resume."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start().awaitTermination()


def upsert_into(path: str, keys: list[str], ordinal: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the last row of each key into the table at path. Replaying a
    batch gives the same table."""

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        values = [c for c in batch.columns if c not in keys]
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*values), ordinal).alias("_v")).select(*keys, "_v.*")
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)
        replace_table(spark, merged(spark.read.parquet(path), last, keys) if there else last, path)

    return apply


def paired_events(events: DataFrame, keys: list[str], time: str = "timestamp") -> DataFrame:
    """Start and end of each attempt, elapsed seconds, and whether it is still open.
    Aggregating by attempt instead of joining keeps one shuffle."""
    t = F.try_to_timestamp(time)
    is_end = F.col("event_type").endswith("_end")
    out = events.groupBy(*keys).agg(F.min(F.when(~is_end, t)).alias("started"), F.max(F.when(is_end, t)).alias("finished"), F.max_by("status", F.when(is_end, t)).alias("status"))
    return out.withColumn("elapsed_seconds", F.col("finished").cast("double") - F.col("started").cast("double")).withColumn("is_open", F.col("finished").isNull())


def remaining(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run still has to do."""
    return without(plan, done, keys)


def interrupted_action(kind: Column, status: Column, remote_id: Column) -> Column:
    """What to do with a task found at a restart. Only target models are made elsewhere;
    one with a remote id is polled again, one never sent is sent, one lost on the way failed."""
    open_ = (kind == "gen3d") & status.isin("running", "pending")
    return F.when(~F.coalesce(open_, F.lit(False)), "none").when(F.nullif(remote_id, F.lit("")).isNotNull(), "resume").when(status == "pending", "restart").otherwise("mark_failed")


def active_tasks(tasks: DataFrame, kind: str) -> DataFrame:
    """models with an open task of a kind."""
    return tasks.filter((F.col("type") == kind) & F.col("status").isin("pending", "running")).select("model_id").distinct()


def refreshed_models(models: DataFrame, tasks: DataFrame) -> DataFrame:
    """models that an open refresh covers: their own, or one of many models, whose list is
    theirs; without a list it covers all."""
    live = tasks.filter(F.col("status").isin("pending", "running"))
    own = live.filter("type = 'refresh_model_dreamsim'").select("model_id")
    many = live.filter("type = 'refresh_all_models_dreamsim'")
    named = many.select(F.explode("model_ids").alias("model_id")).select(F.trim("model_id").alias("model_id")).filter("model_id != ''")
    everything = many.filter("model_ids is null").limit(1).count() > 0
    return models if everything else models.join(own.union(named).distinct(), "model_id", "left_semi")


def backoff_seconds(attempt: Column) -> Column:
    """X11: the fixed part of the wait before an attempt."""
    return F.least(F.lit(30.0) * F.pow(F.lit(2.0), attempt - 1), F.lit(90.0))
