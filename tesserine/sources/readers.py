"""Scans (S01-S38): strict and tolerant JSON, documents, catalogs, logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import log_field


def _typed(schema: str | StructType) -> StructType:
    from pyspark.sql.types import _parse_datatype_string

    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def _missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e)


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: str, required: bool = False) -> DataFrame:
    """One object a line, blank lines skipped; a bad line fails the query. A
    missing path is empty, or an error if required."""
    kind = _typed(schema)
    try:
        return spark.read.schema(kind).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if required or not _missing(e):
            raise
        return spark.createDataFrame([], kind)


def read_jsonl_tolerant(spark: SparkSession, path: str | Sequence[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the lines that couldn't be read (line, file)."""
    kind = _typed(schema)
    try:
        raw = spark.read.text(path).select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"))
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], kind), spark.createDataFrame([], "line string, file string")
    marked = StructType([*kind.fields, *_typed("_bad string").fields])
    rows = raw.filter(F.trim("_line") != "").withColumn("_v", F.from_json("_line", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    ok = F.col("_v._bad").isNull() & F.col("_v").isNotNull()
    return rows.filter(ok).select("_v.*").drop("_bad"), rows.filter(~ok).select(F.col("_line").alias("line"), F.col("_file").alias("file"))


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file; a bad one fails the query."""
    return spark.read.schema(_typed(schema)).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_document_or(spark: SparkSession, path: str, schema: str, default: dict) -> DataFrame:
    """A document, or the default where it is missing, empty or bad; one row."""
    kind = _typed(schema)
    fallback = spark.createDataFrame([default], kind)
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return fallback
    good = raw.select(F.from_json("value", kind, {"mode": "PERMISSIVE"}).alias("v"), F.json_object_keys("value").alias("k")).filter("k is not null and v is not null").select("v.*").limit(1)
    return good.union(fallback.join(good.limit(1), F.lit(True), "left_anti"))


def tail(df: DataFrame, ordinal: str, count: int) -> DataFrame:
    """The last rows in order; all of them if count isn't positive."""
    return df.orderBy(ordinal) if count <= 0 else df.orderBy(F.desc(ordinal)).limit(count).orderBy(ordinal)


def catalog(spark: SparkSession, pattern: str, schema: str, equal: dict[str, str | None]) -> DataFrame:
    """Documents of all runs that equal the given values, newest first."""
    rows = read_document(spark, pattern, schema)
    for c, v in equal.items():
        if v:
            rows = rows.filter(F.col(c) == v)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.orderBy(text("started_at").desc(), text("finished_at").desc(), text("experiment_id").desc())


def catalog_or_rejects(spark: SparkSession, pattern: str, schema: str, equal: dict[str, str | None], required: Sequence[str] = ("experiment_id", "source_provider", "target_provider", "plan_path")) -> tuple[DataFrame, DataFrame]:
    """catalog() of the files that can be read, and (path, error) of the others: files that
    aren't one JSON object, have a field of another type, or lack a required one or have it
    blank. One bad file costs its own row. No matching file gives two empty tables."""
    kind = _typed(schema)
    try:
        raw = spark.read.text(pattern, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    except AnalysisException as e:
        if not _missing(e):
            raise
        raw = spark.createDataFrame([], "value string, path string")
    marked = StructType([*kind.fields, *_typed("_bad string").fields])
    rows = raw.withColumn("v", F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    blank = [F.when(F.coalesce(F.trim(F.col(f"v.{c}").cast("string")), F.lit("")) == "", F.lit(f"missing {c}")) for c in required]
    error = F.coalesce(F.when(F.json_object_keys("value").isNull(), "not a JSON object"), F.when(F.col("v._bad").isNotNull(), "a field has another type"), *blank)
    rows = rows.withColumn("error", error)
    good = rows.filter("error is null").select("v.*").drop("_bad")
    for c, v in equal.items():
        if v:
            good = good.filter(F.col(c) == v)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    good = good.orderBy(text("finished_at").desc(), text("started_at").desc(), text("experiment_id").desc())
    return good, rows.filter("error is not null").select("path", "error")


def prompt_batches(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """The prompts of all batch files with source_file (its name) and position, the file
    with the greatest name first, and within it in order of lines. Blank lines are skipped; a
    bad line fails the query. Lines are numbered by where they stand in their file, which stays
    the same however the file is split."""
    kind = _typed(schema)
    try:
        raw = spark.read.text(pattern).select("value", F.col("_metadata.file_name").alias("source_file"), F.monotonically_increasing_id().alias("_at"))
    except AnalysisException as e:
        if not _missing(e):
            raise
        raw = spark.createDataFrame([], "value string, source_file string, _at long")
    rows = raw.filter(F.trim("value") != "").withColumn("v", F.from_json("value", kind, {"mode": "FAILFAST"}))
    rows = rows.withColumn("keys", F.json_object_keys("value"))
    order = Window.partitionBy("source_file").orderBy("_at")
    return rows.withColumn("position", F.row_number().over(order)).select("v.*", "keys", "source_file", "position").orderBy(F.desc("source_file"), "position")


def records_or_recovered(stored: DataFrame, recovered: DataFrame, key: str) -> DataFrame:
    """Stored records; recovered ones, flagged, for keys that have none."""
    rest = recovered.join(stored.select(key).distinct(), key, "left_anti")
    return stored.withColumn("partial_recovered", F.lit(False)).unionByName(rest.withColumn("partial_recovered", F.lit(True)), allowMissingColumns=True)


def records_of_plans(manifests: DataFrame, records: DataFrame, plans: Sequence[str]) -> DataFrame:
    """Records of runs with one of the plans."""
    return records.join(manifests.filter(F.col("plan_path").isin(list(plans))).select("experiment_id"), "experiment_id", "left_semi")


def asset_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """A directory tree as path, size, mtime; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def source_ids(ids: DataFrame, col: str = "id") -> DataFrame:
    """Distinct ids that aren't targets, highest first."""
    return ids.filter(~F.col(col).contains("_edit_")).select(col).distinct().orderBy(F.desc(col))


def ids_with(files: DataFrame, wanted: Column, col: str = "id") -> DataFrame:
    """Ids with a file of a kind, highest first."""
    return files.filter(wanted).select(col).distinct().orderBy(F.desc(col))


def edit_batches(edits: DataFrame, allowed: Column | None = None) -> DataFrame:
    """Model, edit, instruction; the newest id of a model first."""
    rows = edits if allowed is None else edits.filter(allowed)
    return rows.select("model_id", "edit_id", "instruction").orderBy("model_id", F.desc("edit_id"))


def counters(frames: dict[str, DataFrame]) -> DataFrame:
    """Name and count of each frame."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count("*").alias("count")).select(F.lit(name).alias("name"), "count")
        out = part if out is None else out.union(part)
    return out


def image_paths(lines: DataFrame, suffixes: Sequence[str] = ("png", "jpg", "jpeg", "webp")) -> DataFrame:
    """Paths from lines of text, without comments, of known suffixes."""
    path = F.trim("value")
    return lines.filter((path != "") & ~path.startswith("#")).select(path.alias("path")).filter(F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1)).isin(list(suffixes)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: file, line_no from 1, value. Numbers add up over a file's parts."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"))
    return raw.withColumn("line_no", F.row_number().over(Window.partitionBy("file").orderBy("_id"))).drop("_id")


def log_experiment(lines: DataFrame, finished: str, started: str) -> DataFrame:
    """By file the id of the first line that tells of an end, else of the last that tells
    of a start, else unknown."""
    f, s = F.nullif(F.regexp_extract("value", finished, 1), F.lit("")), F.nullif(F.regexp_extract("value", started, 1), F.lit(""))
    return lines.groupBy("file").agg(F.coalesce(F.min_by(f, F.when(f.isNotNull(), F.col("line_no"))), F.max_by(s, F.when(s.isNotNull(), F.col("line_no"))), F.lit("unknown")).alias("experiment_id"))


def log_manifest(lines: DataFrame, passed: str, key: str, instruction: str, score: str) -> DataFrame:
    """Edits that passed in a log: the first line that says so gives the place, the last
    ones give instruction and score. One scan, one aggregation by edit."""
    v = F.col("value")
    edit = log_field(v, key)
    at = F.col("line_no")
    rows = lines.withColumn("edit_id", edit).filter("edit_id != ''")
    out = rows.groupBy("edit_id").agg(
        F.min(F.when(v.rlike(passed), at)).alias("passed_at"),
        F.max_by(log_field(v, instruction), F.when(log_field(v, instruction) != "", at)).alias("instruction"),
        F.max_by(log_field(v, score), F.when(log_field(v, score) != "", at)).try_cast("double").alias("score"),
    )
    return out.filter("passed_at is not null").orderBy("passed_at")


def log_pairs(lines: DataFrame, pattern: str) -> DataFrame:
    """(source, edit) pairs of a pattern with two groups, each once, by first place."""
    p = F.regexp_extract("value", pattern, 1), F.regexp_extract("value", pattern, 2)
    rows = lines.select(p[0].alias("source_id"), p[1].alias("edit_id"), "line_no").filter("source_id != ''")
    return rows.groupBy("source_id", "edit_id").agg(F.min("line_no").alias("first_line")).orderBy("first_line")


def index_scan(index: DataFrame) -> DataFrame:
    """S32, S33."""
    return index.orderBy(F.col("created_at").desc_nulls_last())


def point_lookup(payloads: DataFrame, key: str, schema: str) -> DataFrame:
    """The decoded payload of one id; no row if it is missing or bad."""
    v = F.from_json("payload_json", _typed(schema))
    return payloads.filter((F.col("id") == key) & F.json_object_keys("payload_json").isNotNull()).select("id", v.alias("payload"))


def category_objects(maps: DataFrame, col: str) -> DataFrame:
    """A map of lists to category, pos, object."""
    rows = maps.select(F.explode(col).alias("category", "_objects")).filter(~F.col("category").startswith("_"))
    return rows.select("category", F.posexplode("_objects").alias("pos", "object"))


def indexed_slice(pairs: DataFrame, start: int, count: int) -> DataFrame:
    """A range of the index; an empty one is an error."""
    rows = pairs.filter((F.col("index") >= start) & (F.col("index") < start + count))
    if rows.limit(1).count() == 0:
        raise ValueError(f"no pairs from {start} on")
    return rows


def plan_history(files: DataFrame) -> DataFrame:
    """Non-empty plan files, newest first."""
    return files.filter((F.col("size") > 0) & F.col("path").rlike(r"\.ya?ml$")).orderBy(F.desc("mtime"), F.desc("path"))


def read_plan(spark: SparkSession, text: str, schema: str, suffix: str = "json") -> DataFrame:
    """A plan of a few kB, read on the driver. YAML needs the yaml package."""
    import json

    if suffix in ("yaml", "yml"):
        import yaml

        data = yaml.safe_load(text)
    else:
        data = json.loads(text)
    return spark.createDataFrame([data], _typed(schema))
