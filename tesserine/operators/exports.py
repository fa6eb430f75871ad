"""Candidates of an export, from edit records, in one pass over what must exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.records import VIEWS
from .dedup import filter_then_latest

# What may be missing, in the order in which it is looked for.
MISSING = ("source_glb_missing", "target_glb_missing", "source_views_incomplete", "edited_views_incomplete")


def _given(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def record_candidates(records: DataFrame, files: DataFrame, images: DataFrame, most: float | None = None, line: str = "line", views: list[str] = VIEWS) -> tuple[DataFrame, Observation]:
    """(candidates, counters). records: edit records with `line`, their order; files: path below
    the root; images: model_id, category, object_name of image metas.

    Records without target, source or edit id go, as do those above the score `most` (a
    missing score too, if it is asked for). Of each edit the newest stays, the first on ties,
    and needs its source model, a target model, and all views of both sides. A category or
    object name that the record lacks is the image's. The counters pairs, kept and one for
    each of MISSING (the first that an edit lacks) fill when the candidates are first computed;
    nothing is scanned for them again."""
    named = (_given("target_model_id") != "") & (_given("source_model_id") != "") & (_given("edit_id") != "")
    fit = named if most is None else named & F.coalesce(F.col("stage2_score") <= most, F.lit(False))
    rows = filter_then_latest(records, ["source_model_id", "edit_id"], "created_at", line, fit)
    source = _given("source_provider_id")
    rows = rows.withColumns(
        {
            "source_glb": F.concat(F.lit("models_src/"), "source_model_id", F.lit("/model_"), source, F.lit(".glb")),
            "target_model_dir": F.concat(F.lit("models_src/"), "target_model_id"),
            "source_view_dir": F.concat(F.lit("triplets/"), "source_model_id", F.lit("/views/"), source),
            "edited_view_dir": F.concat(F.lit("triplets/"), "source_model_id", F.lit("/edited/"), "edit_id"),
        }
    )
    parts = files.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    wanted = parts.filter(F.col("name").isin([f"{v}.png" for v in views]))
    full = wanted.groupBy("dir").agg(F.count_distinct("name").alias("n")).filter(F.col("n") == len(views))
    models = parts.filter(F.col("name").rlike(r"^model_.*\.glb$"))
    rows = rows.join(models.select(F.col("path").alias("source_glb"), F.lit(True).alias("_source")).distinct(), "source_glb", "left")
    rows = rows.join(models.groupBy(F.col("dir").alias("target_model_dir")).agg(F.min("name").alias("_target")), "target_model_dir", "left")
    for dir_ in ("source_view_dir", "edited_view_dir"):
        rows = rows.join(full.select(F.col("dir").alias(dir_), F.lit(True).alias(f"_{dir_}")), dir_, "left")
    tests = dict(zip(MISSING, ("_source", "_target", "_source_view_dir", "_edited_view_dir"), strict=True))
    lacks = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(said)) for said, c in tests.items()])
    counters = Observation()
    counts = [F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("_lacks").isNull()).alias("kept"), *[F.count_if(F.col("_lacks") == said).alias(said) for said in MISSING]]
    rows = rows.withColumn("_lacks", lacks).observe(counters, *counts).filter("_lacks is null")
    named_by = images.select(F.col("model_id").alias("source_model_id"), F.col("category").alias("_category"), F.col("object_name").alias("_object"))
    rows = rows.join(named_by, "source_model_id", "left")
    either = lambda own, other: F.coalesce(F.nullif(own, F.lit("")), other, F.lit(""))
    at = lambda name: F.concat(F.lit("images/"), "source_model_id", F.lit(f"/{name}")).alias(name.replace(".", "_"))
    out = rows.select(
        F.col("source_model_id").alias("model_id"), "edit_id", either(F.col("category"), F.col("_category")).alias("category"), either(F.col("object_name"), F.col("_object")).alias("object_name"),
        _given("instruction_text").alias("instruction"), _given("final_status").alias("edit_status"), source.alias("source_provider_id"), F.regexp_extract("_target", r"^model_(.*)\.glb$", 1).alias("target_provider_id"),
        "source_glb", F.concat_ws("/", "target_model_dir", "_target").alias("target_glb"), "source_view_dir", "edited_view_dir", "target_model_dir", at("meta.json"), at("image.png"), at("instructions.json"), "stage2_score",
    )
    return out, counters
