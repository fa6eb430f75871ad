"""Listings kept as tables (X07, X08), and progress written to several sinks.

A cache is a folder of immutable tables and one small pointer file that names the current one.
A new table is written beside the old ones, then the pointer is replaced in one step, so
readers see the old or the new one whole, and go on reading the one they have begun."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import write_document
from .incremental import upsert_into


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pointer(spark: SparkSession, root: str) -> dict | None:
    """What the pointer of a cache says, None where there is none."""
    at, fs = _path(spark, f"{root}/_current")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def point(spark: SparkSession, root: str, to: dict) -> None:
    """Replaces the pointer in one step."""
    jvm = spark.sparkContext._jvm
    new, fs = _path(spark, f"{root}/_new-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(json.dumps(to).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(new, _path(spark, f"{root}/_current")[0], options)


def fingerprint(files: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, version: one value for the paths, sizes and times of files, in any order."""
    each = F.xxhash64("path", "size", F.col("mtime").cast("string"))
    return files.groupBy(*keys).agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(each.cast("decimal(38,0)"))).alias("version"))


def cached_listing(spark: SparkSession, root: str, version: str, load: Callable[[], DataFrame], ttl: float = 30.0, now: Callable[[], float] = time.time) -> tuple[DataFrame, bool]:
    """(listing, whether it was there already): the kept table if it is of this version
    and younger than ttl seconds, else load()'s rows, kept as the new one. The age counts from
    before loading, so what changed meanwhile isn't kept longer. A failed load leaves the old
    table. Two writers at once both succeed; the later pointer stays."""
    begun, held = now(), pointer(spark, root)
    if held and held["version"] == version and begun - held["at"] < ttl:
        return spark.read.parquet(held["table"]), True
    table = f"{root}/table-{uuid.uuid4().hex}"
    load().write.parquet(table)
    point(spark, root, {"version": version, "at": begun, "table": table, "before": held and held["table"]})
    return spark.read.parquet(table), False


def sweep(spark: SparkSession, root: str) -> None:
    """Removes tables that neither the pointer nor its predecessor names; readers older than two
    versions must be done."""
    held = pointer(spark, root) or {}
    keep = {held.get("table"), held.get("before"), *held.get("parts", [])}
    at, fs = _path(spark, root)
    for found in fs.listStatus(at):
        name = found.getPath().getName()
        if not name.startswith("_") and f"{root}/{name}" not in keep:
            fs.delete(found.getPath(), True)


def read_runs(spark: SparkSession, root: str, held: dict | None = None) -> DataFrame:
    """The rows of all runs of a cache of runs, as the pointer (or one read before) says."""
    held = held or pointer(spark, root)
    if held is None:
        raise FileNotFoundError(f"no cache of runs at {root}")
    runs = spark.read.parquet(held["table"])
    parts = [spark.read.parquet(p).join(runs.filter(F.col("part") == p).select("run"), "run", "left_semi") for p in held["parts"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def refresh_runs(spark: SparkSession, root: str, files: DataFrame, build: Callable[[DataFrame], DataFrame], most_parts: int = 20) -> dict[str, int]:
    """Files (run, path, size, mtime) -> counts of runs by what was done: built, kept,
    gone. Only runs whose fingerprint is new or has changed are built: build takes the table
    of those runs (run) and returns rows with the column run. They go to a part of their own;
    a table of (run, version, part) says which part holds a run, so what is kept isn't copied.
    Beyond most_parts parts all rows are written as one. A run that build returns nothing for
    is held as empty."""
    seen = fingerprint(files, ["run"])
    held = pointer(spark, root)
    name = uuid.uuid4().hex
    old = spark.read.parquet(held["table"]) if held else spark.createDataFrame([], seen.select("run", "version", F.lit("").alias("part")).schema)
    both = seen.join(old.select("run", F.col("version").alias("_old"), "part"), "run", "left").withColumn("part", F.when(F.col("_old") == F.col("version"), F.col("part")))
    at, table = f"{root}/part-{name}", f"{root}/runs-{name}"
    both.select("run", "version", F.coalesce("part", F.lit(at)).alias("part")).write.parquet(table)
    runs = spark.read.parquet(table)
    counts = {r["part"]: r["n"] for r in runs.groupBy("part").agg(F.count("*").alias("n")).collect()}
    built = counts.get(at, 0)
    if held and not built and sum(counts.values()) == old.count():
        return {"built": 0, "kept": sum(counts.values()), "gone": 0}
    gone = old.join(runs.select("run"), "run", "left_anti").count()
    parts = [p for p in (held["parts"] if held else []) if p in counts]
    if built or not parts:
        build(runs.filter(F.col("part") == at).select("run")).write.parquet(at)
        parts.append(at)
    now = {"table": table, "parts": parts, "before": held and held["table"]}
    if len(parts) > most_parts:
        whole = f"{root}/part-{uuid.uuid4().hex}"
        read_runs(spark, root, now).write.parquet(whole)
        runs.withColumn("part", F.lit(whole)).write.parquet(f"{table}-whole")
        now |= {"table": f"{table}-whole", "parts": [whole]}
    point(spark, root, now)
    return {"built": built, "kept": sum(counts.values()) - built, "gone": gone}


def into_sinks(spark: SparkSession, ledger: str, sinks: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: a batch goes to each sink in turn, and the ledger notes each
    sink that has it. When a batch is replayed after a crash between two sinks, the first are
    left alone; a sink that was broken off itself gets it again, and must bear that."""

    def apply(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for name, sink in sinks.items():
                done, fs = _path(spark, f"{ledger}/{name}/{number}")
                if not fs.exists(done):
                    sink(batch, number)
                    fs.create(done, True).close()
        finally:
            batch.unpersist()

    return apply


def progress_sinks(spark: SparkSession, root: str, manifest: DataFrame, summary: Callable[[DataFrame, DataFrame], DataFrame], ordinal: str = "line") -> dict[str, Callable[[DataFrame, int], None]]:
    """The sinks of a run's progress, in order: edit records (upserted by source model and
    instruction), object records (by key), then the summary and the manifest, which are made
    anew from both tables. Batches have kind (object or edit), object_key, source_model_id,
    instruction_index, the ordinal and what else the records hold."""
    tables = {"edit": ["source_model_id", "instruction_index"], "object": ["object_key"]}

    def records(kind: str) -> Callable[[DataFrame, int], None]:
        put = upsert_into(f"{root}/{kind}_records", tables[kind], ordinal)
        return lambda batch, number: put(batch.filter(F.col("kind") == kind), number)

    def read(kind: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{kind}_records")

    def told(_: DataFrame, __: int) -> None:
        write_document(summary(read("object"), read("edit")), f"{root}/summary")

    def listed(_: DataFrame, __: int) -> None:
        counts = read("object").agg(F.count("*").alias("object_record_count")).crossJoin(read("edit").agg(F.count("*").alias("edit_record_count")))
        write_document(manifest.crossJoin(counts.select(F.struct("*").alias("progress"))), f"{root}/manifest")

    return {"edit_records": records("edit"), "object_records": records("object"), "summary": told, "manifest": listed}
