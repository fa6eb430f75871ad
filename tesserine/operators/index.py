"""Entries of the model index (P11, P12), each list gathered before it is joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import optional_text


def object_context(images: DataFrame, lookup: DataFrame) -> DataFrame:
    """Images (image_id, object_name, subject, category) and lookup (object_name, category:
    planning.reverse_lookup) -> image_id, object_name, category_name. The object is the image's,
    else its subject; the category is the image's, else that of the object just as it is
    written; both trimmed, blank to null."""
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = images.withColumn("_object", F.coalesce(given("object_name"), F.col("subject")))
    by = lookup.select(F.col("object_name").alias("_object"), F.col("category").alias("_of"))
    rows = rows.join(by, "_object", "left")
    return rows.select("image_id", optional_text(F.col("_object")).alias("object_name"), optional_text(F.coalesce(given("category"), "_of")).alias("category_name"))


def model_entries(files: DataFrame, metas: DataFrame, views: DataFrame, instructions: DataFrame, edits: DataFrame, context: DataFrame) -> DataFrame:
    """A row a model that has a model file. files (model_id, path: its .glb files), metas
    (model_id, provider, generated_at), views (model_id, view, path, position), instructions
    (model_id, count), edits (model_id, edit_id, has_target_3d, ready_pair), context
    (object_context's rows). Views are in order of position; batches in order of edit_id."""
    first = files.groupBy("model_id").agg(F.min("path").alias("path"))
    drawn = views.groupBy("model_id").agg(F.count("*").alias("rendered_views_count"), F.min_by("path", F.struct("position", "view")).alias("first_rendered_view_path"))
    batch = F.struct("edit_id", "has_target_3d")
    of_edits = edits.groupBy("model_id").agg(F.count("*").alias("edit_count"), F.count_if("has_target_3d").alias("target_ready_count"), F.count_if("ready_pair").alias("ready_pair_count"), F.sort_array(F.collect_list(batch)).alias("edited_batches"))
    out = first.join(metas, "model_id", "left").join(drawn, "model_id", "left").join(instructions.withColumnRenamed("count", "instructions_count"), "model_id", "left").join(of_edits, "model_id", "left")
    out = out.join(context.withColumnRenamed("image_id", "model_id"), "model_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return out.select(
        F.col("model_id").alias("id"),
        "provider",
        F.col("generated_at").alias("created_at"),
        (zero("rendered_views_count") > 0).alias("has_views"),
        zero("rendered_views_count").alias("rendered_views_count"),
        "first_rendered_view_path",
        (zero("instructions_count") > 0).alias("has_instructions"),
        zero("instructions_count").alias("instructions_count"),
        (zero("edit_count") > 0).alias("has_edits"),
        *[zero(c).alias(c) for c in ("edit_count", "target_ready_count", "ready_pair_count")],
        (zero("target_ready_count") < zero("edit_count")).alias("edits_without_target"),
        F.coalesce("edited_batches", F.array().cast(out.schema["edited_batches"].dataType)).alias("edited_batches"),
        "category_name",
        "object_name",
        "path",
    )
