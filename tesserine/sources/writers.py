"""Sinks and mutation (K01-K26) on Spark's writers: a table is published whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..functions.records import removal_reasons
from .scratch import written


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """K01, K04, K05."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_document(df: DataFrame, path: str) -> None:
    """One row as one JSON file."""
    df.limit(1).coalesce(1).write.mode("overwrite").json(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (ArrayType, MapType, StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; a table without rows gives the one cell "empty"."""
    if df.limit(1).count():
        flat(df).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.sparkSession.range(1).select(F.lit("empty").alias("empty")).coalesce(1).write.mode("overwrite").option("header", False).csv(path)


def write_summary(root: str, objects: DataFrame, categories: DataFrame, timings: DataFrame, totals: DataFrame) -> None:
    """Totals, objects, categories (both ways) and timings."""
    write_document(totals, f"{root}/summary")
    write_csv(objects, f"{root}/objects_csv")
    write_jsonl(categories, f"{root}/categories_json")
    write_csv(categories, f"{root}/categories_csv")
    write_csv(timings, f"{root}/timings_csv")


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows, replaced by new ones of the same key."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def without(old: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K15, K16, K18, K21."""
    return old.join(gone.select(*keys), list(keys), "left_anti")


def updated(df: DataFrame, match: Column, values: dict[str, Column]) -> DataFrame:
    """Columns set where match holds; a null value leaves the old one."""
    return df.withColumns({c: F.when(match, F.coalesce(v, F.col(c))).otherwise(F.col(c)) for c, v in values.items()})


def capped(df: DataFrame, order: str, count: int = 100) -> DataFrame:
    """The newest rows."""
    return df.orderBy(F.desc(order)).limit(count)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Writes a new version of a table beside the old one, then swaps; df may read the old one.
    The old version keeps a name until the new one has the table's: a crash in between leaves
    both whole, and the next call puts the old one back first."""
    jvm = spark.sparkContext._jvm
    at, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new", f"{path}.old"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        if fs.exists(at):
            fs.delete(old, True)
        elif not fs.rename(old, at):
            raise OSError(f"can't restore {path}")
    df.write.mode("overwrite").parquet(f"{path}.new")
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"can't move {path}")
    if not fs.rename(new, at):
        raise OSError(f"can't rename {path}.new")
    fs.delete(old, True)


def numbered(df: DataFrame, order: Sequence[Column], prefix: str, width: int = 4) -> DataFrame:
    """sample_id, zero-padded in order; rows that are equal in all of order may change
    places. The ranged rows are written once, so that ranks and the sizes of ranges are of the
    same ones, whatever is computed again; positions add up over ranges, and no task sorts the
    whole."""
    ranged = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    by = Window.partitionBy("_part").orderBy(*order)
    ranked = ranged.withColumn("_rn", F.row_number().over(by))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a range
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    n = (F.col("_before") + F.col("_rn")).cast("string")
    padded = F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n)
    return ranked.join(F.broadcast(sizes), "_part").withColumn("sample_id", F.concat(F.lit(prefix), padded)).drop("_part", "_rn", "_before")


def export_manifest(samples: DataFrame, views: Sequence[str], root: str, prefix: str) -> DataFrame:
    """Samples with paths moved from root to prefix and view maps with every key."""
    moved = lambda c: F.when(c.startswith(root), F.concat(F.lit(prefix), F.substring(c, len(root) + 1, 1 << 30))).otherwise(c)
    keys = F.array(*map(F.lit, views))
    full = lambda m: F.map_from_arrays(keys, F.transform(keys, lambda k: moved(m[k])))
    return samples.withColumns({c: full(F.col(c)) for c in ("source_views", "edited_views")})


def removed_objects(assessed: DataFrame) -> DataFrame:
    """Removed objects by category, each with its reasons, sorted."""
    own = removal_reasons(F.col("editability_score"), F.col("has_3d_unfriendly_attrs"))
    rows = assessed.filter("verdict = 'remove'").select("category", F.struct("object", "editability_score", own.alias("removal_reasons")).alias("o"))
    return rows.groupBy("category").agg(F.array_sort(F.collect_list("o")).alias("removed")).orderBy("category")


def instruction_state(edits: DataFrame) -> DataFrame:
    """The instruction list of each image, from its edit records."""
    rows = F.array_sort(F.collect_list(F.struct("instruction_index", "instruction_type", "instruction_text", "edit_id", "final_status")))
    return edits.groupBy("image_id").agg(rows.alias("instructions"))


def metric_sheet(items: DataFrame, metric: str, views: Sequence[str]) -> DataFrame:
    """Fixed columns, then one for each view, from long rows (item_id, view, value)."""
    return items.groupBy("item_id").pivot("view", list(views)).agg(F.first(metric)).withColumnsRenamed({v: f"{metric}_{v}" for v in views})


def manifest_issues(samples: DataFrame, files: DataFrame, metas: DataFrame, views: Sequence[str], root: str) -> DataFrame:
    """sample_id, issues: files of a sample that aren't there, one file for both models,
    another instruction than the edit's own (metas: path, instruction), signs of a typo."""
    edited_front = F.col("edited_views")["front"]
    pattern = r"triplets/([^/]+)/edited/([^/]+)/front\.png"
    meta = F.concat(F.lit(f"{root}/triplets/"), F.regexp_extract(edited_front, pattern, 1), F.lit("/edited/"), F.regexp_extract(edited_front, pattern, 2), F.lit("/meta.json"))
    rows = samples.withColumn("_meta", F.when(edited_front.rlike(pattern), meta))
    place = lambda name, path: F.struct(F.lit(name).alias("name"), path.alias("path"))
    named = [place(c, F.col(c)) for c in ("source_glb", "target_glb")] + [place(c, F.col(c)[v]) for c in ("source_views", "edited_views") for v in views]
    long = rows.select("sample_id", F.explode(F.array(*named)).alias("x")).select("sample_id", "x.*")
    gone = long.join(files.select("path"), "path", "left_anti").select("sample_id", F.concat(F.lit("missing:"), "name").alias("issue")).distinct()
    told = rows.join(metas.select(F.col("path").alias("_meta"), F.trim("instruction").alias("_own")), "_meta", "left")
    said = F.col("instruction")
    of_row = F.array_compact(
        F.array(
            F.when(F.col("source_glb") == F.col("target_glb"), "same_file"),
            F.when(F.col("_meta").isNull(), "no_edit_in_path").when(F.col("_own").isNull(), "missing:meta").when(F.col("_own") != F.trim(said), "instruction_mismatch"),
            F.when(said.startswith("RR") | said.contains("  "), "possible_typo"),
        )
    )
    found = gone.union(told.select("sample_id", F.explode(of_row).alias("issue"))).groupBy("sample_id").agg(F.array_sort(F.collect_set("issue")).alias("issues"))
    return samples.select("sample_id").join(found, "sample_id", "left").withColumn("issues", F.coalesce("issues", F.array().cast("array<string>")))


def write_export(head: DataFrame, samples: DataFrame, root: str, name: str, day: str) -> str:
    """The folder of a dated export: one document, manifest.json, and a line a sample in
    manifest.jsonl. The samples are in the lines only, as they don't fit a document."""
    out = f"{root}/exports/{name}_{day}"
    write_jsonl(samples, f"{out}/manifest.jsonl")
    write_document(head, f"{out}/manifest.json")
    return out
