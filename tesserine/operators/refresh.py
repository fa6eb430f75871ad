"""What a listing of files says is there to be done again (J12, J13, J26), and whether edits are
whole (F20). A folder is there if a file below it is; each listing is taken apart once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payloads import masks_told
from ..functions.records import VIEWS, target_id

META, MASKS = "meta.json", [*[f"{v}_mask.png" for v in VIEWS], "edit_mask_grid.png"]
#: Names of files in an edit's folder that are told by a bit each.
KNOWN = [META, *[f"{v}.png" for v in VIEWS], *MASKS]


def _bits(names: list[str]) -> int:
    return sum(1 << KNOWN.index(n) for n in names)


def _has(names: list[str]) -> Column:
    return F.col("known").bitwiseAND(F.lit(_bits(names))) == _bits(names)


def _folders(files: DataFrame) -> DataFrame:
    """path, parts (its names), name."""
    return files.select("path", F.split("path", "/").alias("parts")).withColumn("name", F.element_at("parts", -1))


def _edit_files(files: DataFrame) -> DataFrame:
    """model_id, edit_id, name (null below the folder itself) of files of edits."""
    rows = _folders(files).filter("parts[0] = 'triplets' and parts[2] = 'edited' and size(parts) > 4")
    return rows.select(F.col("parts")[1].alias("model_id"), F.col("parts")[3].alias("edit_id"), F.when(F.size("parts") == 5, F.col("name")).alias("name"))


def edit_folders(files: DataFrame) -> DataFrame:
    """model_id, edit_id, known: the folders triplets/<model>/edited/<edit>, and which of the
    KNOWN files are right in them, a bit each. Bits are hashed together before the shuffle, where
    sets of names would be sorted and sent."""
    bit = F.lit(0)
    for i, name in enumerate(KNOWN):
        bit = F.when(F.col("name") == name, 1 << i).otherwise(bit)
    return _edit_files(files).groupBy("model_id", "edit_id").agg(F.bit_or(bit).alias("known"))


def _other_pictures(files: DataFrame) -> DataFrame:
    """model_id, edit_id, others: how many pictures with other names there are."""
    rows = _edit_files(files).filter(F.col("name").endswith(".png") & ~F.col("name").isin(KNOWN))
    return rows.groupBy("model_id", "edit_id").agg(F.count_distinct("name").cast("int").alias("others"))


def refresh_targets(models: DataFrame, files: DataFrame, providers: dict[str, str], rendered: bool = True) -> DataFrame:
    """Models (model_id) and files (path below the root) -> model_id, edit_id,
    target_model_id, provider, provider_id, reason. Rows without a reason are to be computed
    again: each edit with a meta and a target, by every provider (id to name) whose model file
    the target has, and, if rendered, whose views are drawn. Others say what they lack first. A
    model without any such target has a row of its own that says why."""
    listed = _folders(files)
    there = listed.filter("parts[0] = 'models_src' and size(parts) > 2").select(F.col("parts")[1].alias("model_id"), "name", F.size("parts").alias("_depth"))
    dirs = there.select("model_id").distinct()
    glb = there.filter(F.col("name").rlike(r"^model_.*\.glb$") & (F.col("_depth") == 3)).groupBy(F.col("model_id").alias("target_model_id")).agg(F.collect_set("name").alias("_glbs"))
    drawn = listed.filter("parts[0] = 'triplets' and parts[2] = 'views' and size(parts) = 5 and endswith(name, '.png')").select(F.col("parts")[1].alias("target_model_id"), F.col("parts")[3].alias("provider_id"), F.lit(True).alias("_drawn")).distinct()
    wanted = models.select("model_id").distinct()
    known = wanted.join(dirs.withColumn("_dir", F.lit(True)), "model_id", "left")
    edits = edit_folders(files).withColumn("_meta", _has([META])).drop("known")
    rows = known.filter("_dir").drop("_dir").join(edits, "model_id").withColumn("target_model_id", target_id(F.col("model_id"), F.col("edit_id")))
    rows = rows.join(dirs.select(F.col("model_id").alias("target_model_id"), F.lit(True).alias("_target")), "target_model_id", "left").join(glb, "target_model_id", "left")
    ok = F.col("_meta") & F.col("_target").isNotNull()
    rows = rows.withColumn("_glb", F.explode(F.when(ok & F.col("_glbs").isNotNull(), F.col("_glbs")).otherwise(F.array(F.lit(None).cast("string")))))
    names = F.create_map(*[F.lit(x) for kv in providers.items() for x in kv])
    rows = rows.withColumn("provider_id", F.replace(F.regexp_replace("_glb", r"\.glb$", ""), F.lit("model_"), F.lit("")))
    rows = rows.withColumn("provider", F.try_element_at(names, F.col("provider_id"))).join(drawn, ["target_model_id", "provider_id"], "left")
    lacks = F.when(~F.col("_meta"), "edit meta not found").when(F.col("_target").isNull(), "target model directory not found").when(F.col("_glb").isNull(), "target GLB not found").when(F.col("provider").isNull(), "unsupported provider id")
    if rendered:
        lacks = lacks.when(F.col("_drawn").isNull(), "target render views not found")
    told = F.when(F.col("_meta"), F.col("target_model_id")).alias("target_model_id")
    of_edits = rows.select("model_id", "edit_id", told, "provider", "provider_id", lacks.alias("reason"))
    good = of_edits.filter("reason is null").select("model_id", F.lit(True).alias("_good")).distinct()
    some = edits.select("model_id", F.lit(True).alias("_some")).distinct()
    of_models = known.join(some, "model_id", "left").join(good, "model_id", "left").filter("_good is null")
    why = F.when(F.col("_dir").isNull(), "model directory not found").when(F.col("_some").isNull(), "no edited batches found").otherwise("no refreshable targets found")
    none = F.lit(None).cast("string")
    return of_edits.unionByName(of_models.select("model_id", *[none.alias(c) for c in ("edit_id", "target_model_id", "provider", "provider_id")], why.alias("reason")))


def _readable(text: Column) -> Column:
    """Whether a meta's text is a JSON object."""
    return F.json_object_keys(text).isNotNull()


def mask_targets(models: DataFrame, files: DataFrame, metas: DataFrame, view_paths: Column, path: Column) -> DataFrame:
    """Models (model_id), files (path) and metas (model_id, edit_id, text) -> model_id,
    edit_id, reason: edits whose masks are to be made (no reason), others with why not, and a
    row for a model without edits. view_paths (a map by view) and path say which masks the
    meta tells of."""
    edits = edit_folders(files)
    # what a meta tells is read before it is joined, so that no text or map is shuffled
    told = metas.select("model_id", "edit_id", (F.size(F.json_object_keys("text")) > 0).alias("_read"), masks_told(view_paths, path).alias("_told"))
    complete = _has(MASKS) & F.coalesce("_told", F.lit(False))
    rows = models.select("model_id").distinct().join(edits, "model_id", "left").join(told, ["model_id", "edit_id"], "left")
    why = (
        F.when(F.col("edit_id").isNull(), "no edited batches found")
        .when(~F.coalesce(_has([META]), F.lit(False)), "edit meta not found")
        .when(~F.coalesce("_read", F.lit(False)), "edit meta invalid")
        .when(F.coalesce(complete, F.lit(False)), "mask already complete")
    )
    return rows.select("model_id", "edit_id", why.alias("reason"))


def edit_status(files: DataFrame, metas: DataFrame, views: int = 6) -> DataFrame:
    """model_id, edit_id, valid, png_count, meta_exists, instruction, reason of every edit's
    folder: exactly so many pictures, and a meta that can be read. What is wrong with the meta
    is said before a wrong number of pictures."""
    told = metas.select("model_id", "edit_id", _readable(F.col("text")).alias("_read"), F.trim(F.get_json_object("text", "$.instruction")).alias("_said"))
    rows = edit_folders(files).join(_other_pictures(files), ["model_id", "edit_id"], "left").join(told, ["model_id", "edit_id"], "left")
    pictures = _bits([n for n in KNOWN if n.endswith(".png")])
    count = F.bit_count(F.col("known").bitwiseAND(F.lit(pictures))) + F.coalesce("others", F.lit(0))
    meta = _has([META])
    reason = F.when(~meta, "Missing meta.json").when(~F.coalesce("_read", F.lit(False)), "Failed to read meta.json").when(count != views, F.concat(F.lit(f"Expected {views} png files, found "), count.cast("string"))).otherwise("")
    said = F.when(meta, F.coalesce("_said", F.lit(""))).otherwise("")
    return rows.select("model_id", "edit_id", (reason == "").alias("valid"), count.alias("png_count"), meta.alias("meta_exists"), said.alias("instruction"), reason.alias("reason"))
