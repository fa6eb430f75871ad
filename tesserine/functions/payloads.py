"""Records of several schemas, brought to one: prompts, images, objects, edits, plans, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .records import VIEWS, display_payload, optional_text, strict
from .text import clean, first_reason, first_text, legality_reject_reason

# Statuses of prompts, providers, edit modes, verdict words, legality categories.
PROMPT_STATUSES = ["pending", "completed", "failed", "deleted", "running"]
PROVIDERS = ["hunyuan", "tripo", "rodin"]
EDIT_MODES = ["single", "multiview"]
STRENGTHS = ["strong", "medium", "weak"]
# Where a final side view comes from, and by how much top and bottom turn, by
# the side that shows the front.
SIDES = {
    "front": {"front": "front", "back": "back", "left": "left", "right": "right"},
    "left": {"front": "left", "back": "right", "left": "back", "right": "front"},
    "back": {"front": "back", "back": "front", "left": "right", "right": "left"},
    "right": {"front": "right", "back": "left", "left": "front", "right": "back"},
}
TURNS = {"front": (0, 0), "right": (90, 270), "back": (180, 180), "left": (270, 90)}


def _required(c: Column, name: str) -> Column:
    return strict(optional_text(c).isNotNull(), f"{name} must be a non-empty string", optional_text(c))


def prompt_record(r: dict[str, Column], keys: Column | None = None, source_file: Column | None = None, image_there: Column | None = None) -> Column:
    """A prompt of the old schema (it has the key id) or of an experiment (the keys
    prompt_id and experiment_id) as one; anything else fails, as does an old one with an unknown
    status. keys tells the record's own keys; without it a field that isn't null counts as
    one. An experiment's image without a path is that of its image id, if image_there."""
    of = lambda k: r.get(k, F.lit(None).cast("string"))
    null, no = F.lit(None).cast("string"), F.lit(False)
    has = (lambda k: F.array_contains(keys, k)) if keys is not None else (lambda k: of(k).isNotNull())
    old, new = has("id"), has("prompt_id") & has("experiment_id")
    status = strict(of("status").isin(PROMPT_STATUSES), "unsupported legacy prompt status", of("status"))
    own, image_id, model = optional_text(of("image_path")), optional_text(of("image_id")), optional_text(of("source_model_id"))
    found = F.when(F.coalesce(image_there if image_there is not None else no, no), F.concat(F.lit("images/"), image_id, F.lit("/image.png")))
    image = F.coalesce(own, found)
    stage = F.when(model.isNotNull(), "experiment_source_model_ready").when(image.isNotNull() | image_id.isNotNull(), "experiment_image_ready").otherwise("experiment_prompt_only")
    either = lambda a, b: F.when(old, a).when(new, b).otherwise(F.raise_error(F.lit("unsupported prompt record schema")))
    label = F.element_at(F.create_map(*map(F.lit, ("experiment_source_model_ready", "source model ready", "experiment_image_ready", "image ready", "experiment_prompt_only", "experiment prompt"))), stage)
    badge = F.when(status == "deleted", "failed").otherwise(status)
    ident = either(_required(of("id"), "id"), _required(of("prompt_id"), "prompt_id"))
    return F.struct(
        *[ident.alias(name) for name in ("id", "ui_id", "raw_id")],
        either(F.lit("legacy_prompt"), F.lit("experiment_prompt")).alias("schema"),
        either(F.lit("Legacy"), F.lit("Experiment")).alias("schema_label"),
        either(optional_text(of("subject")), _required(of("object_name"), "object_name")).alias("subject"),
        _required(of("prompt"), "prompt").alias("prompt"),
        optional_text(of("created_at")).alias("created_at"),
        either(optional_text(of("updated_at")), null).alias("updated_at"),
        either(null, _required(of("experiment_id"), "experiment_id")).alias("experiment_id"),
        either(null, model).alias("source_model_id"),
        either(null, image_id).alias("image_id"),
        either(own, image).alias("image_path"),
        (null if source_file is None else source_file).alias("source_file"),
        either(status == "pending", no).alias("can_generate_image"),
        either(status == "pending", no).alias("can_batch_generate"),
        either(F.lit(True), no).alias("can_delete"),
        either(status == "completed", image.isNotNull()).alias("can_open_image"),
        either(status, stage).alias("status"),
        either(status, label).alias("status_label"),
        either(badge, F.when(stage == "experiment_prompt_only", "running").otherwise("completed")).alias("status_badge_class"),
    )


def prompt_listing(prompts: DataFrame, files: DataFrame) -> DataFrame:
    """Prompts (their fields, keys, source_file, position; readers.prompt_batches)
    as one schema, in their order; files (path below the root) tells which images there are."""
    fields = [c for c in prompts.columns if c not in ("keys", "source_file", "position")]
    there = files.filter(F.col("path").rlike("^images/[^/]+/image\\.png$")).select(F.split("path", "/")[1].alias("_image"), F.lit(True).alias("_there")).distinct()
    rows = prompts.join(there, optional_text(F.col("image_id")) == F.col("_image"), "left") if "image_id" in fields else prompts.withColumn("_there", F.lit(False))
    record = prompt_record({c: F.col(c) for c in fields}, F.col("keys"), F.col("source_file"), F.col("_there"))
    return rows.select(record.alias("p"), "position").select("p.*", "position").orderBy(F.desc("source_file"), "position")


def image_schema(keys: Column) -> Column:
    """The schema that the keys of an image's meta tell; fails where none does."""
    has = lambda *ks: F.arrays_overlap(keys, F.array(*map(F.lit, ks)))
    return F.when(has("parent_id"), "variant_image").when(has("object_name", "experiment_id"), "experiment_image").when(has("subject", "generated_at", "prompt"), "legacy_image").otherwise(F.raise_error(F.lit("unsupported image meta schema")))


def image_entries(images: DataFrame, objects: DataFrame) -> DataFrame:
    """Images (id, keys, subject, object_name, parent_id, prompt, generated_at,
    created_at) and objects (image_id, object_name) -> index entries. A subject is the image's
    own, else its object's, else that of its parent; shown is the parent's id where none is."""
    own = first_text(F.col("subject"), F.col("object_name"))
    rows = images.withColumn("_context", F.coalesce(optional_text(F.col("parent_id")), F.col("id"))).withColumn("_own", F.nullif(own, F.lit("")))
    of = objects.select(F.col("image_id").alias("_context"), optional_text(F.col("object_name")).alias("_of"))
    rows = rows.join(of, "_context", "left").withColumn("subject", F.coalesce("_own", "_of"))
    return rows.select(
        "id",
        image_schema(F.col("keys")).alias("schema_name"),
        "subject",
        F.coalesce("subject", "_context").alias("display_subject"),
        "prompt",
        F.trim(F.coalesce(F.nullif("generated_at", F.lit("")), F.col("created_at"))).alias("created_at"),
    )


def object_rows(objects: DataFrame) -> DataFrame:
    """Statistics of objects, 17 columns, under the present names of the scores, sorted; a
    field that no record has is null."""
    names = ["experiment_id", "plan_index", "object_index", "selection_mode", "category", "object_name", "prompt_id", "image_id", "source_model_id", "attempts_total", "stage1_failed_count", "stage2_entered_count", "stage2_passed_count", "stage2_failed_count", "source_pipeline_status"]
    same = [(F.col(c) if c in objects.columns else F.lit(None)).alias("edit_attempts_total" if c == "attempts_total" else c) for c in names]
    scores = [F.coalesce(f"stage2_lpips_{x}", f"stage2_dreamsim_{x}").alias(f"stage2_lpips_{x}") for x in ("mean", "std")]
    blank = lambda c: F.coalesce(c, F.lit(""))
    order = [blank("category"), blank("object_name"), blank("experiment_id"), F.coalesce("object_index", F.lit(0))]
    return objects.orderBy(*order).select(*same, *scores)


def edit_rows(edits: DataFrame, shown: Column) -> DataFrame:
    """Edits with the text they show, sorted."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    order = [blank("category"), blank("object_name"), blank("experiment_id"), F.coalesce("instruction_index", F.lit(0))]
    # Most edits tie; a hash of their plain columns after the order lets ties be dealt to
    # many tasks, where one key would go to one.
    tie = F.xxhash64(*[F.col(f"`{name}`") for name, kind in edits.dtypes if not kind.startswith(("map", "array", "struct", "variant"))])
    return edits.withColumn("instruction_text", shown).orderBy(*order, tie)


def stage2_check(by_provider: Column, single: Column, provider: str) -> Column:
    """The check of a provider's own target, else the single one if it is its or
    nobody's; its fields are the stage's."""
    return F.coalesce(by_provider[provider], F.when(F.coalesce(single["provider_id"] == provider, F.lit(True)), single))


def stage1_fields(meta: Column) -> Column:
    """What the first stage said: the reason of its detail, else the check's own."""
    check = meta["quality_check"]
    given = lambda c: F.nullif(c, F.lit(""))
    return F.struct(
        F.when(meta.isNotNull(), F.coalesce(optional_text(meta["edit_status"]), F.lit("passed"))).alias("stage1_status"),
        F.coalesce(given(check["stage_edit_correctness"]["reason"]), check["reason"]).alias("stage1_reason"),
        check["error_message"].alias("stage1_error_message"),
        check["method"].alias("stage1_method"),
    )


def plan_errors(p: Column) -> Column:
    """All that the runner finds wrong with a plan, in order; empty if it is valid.
    A plan without a target provider has its source's. The form's rules (F29, P36) are those of
    operators.plan_rules."""
    blank = lambda c: optional_text(c).isNull()
    target = F.coalesce(p["target_provider"], p["source_provider"])

    def of_category(c: Column) -> Column:
        return F.array_compact(
            F.array(
                F.when(c["random"]["category"].isNull() | c["random"]["object"].isNull(), "random"),
                F.when(c["category_name"].isNotNull() & blank(c["category_name"]), "category_name"),
                F.when(F.exists(F.coalesce(c["objects"], F.array().cast("array<string>")), blank), "objects"),
                F.when(c["style_ids"].isNotNull() & c["objects"].isNotNull() & (F.size(c["style_ids"]) != F.size(c["objects"])), "style_ids"),
                F.when(~F.coalesce(c["object_count"] > 0, F.lit(False)), "object_count"),
                F.when(~F.coalesce(c["instruction_plan"]["count"] > 0, F.lit(False)), "instruction_plan.count"),
            )
        )

    named = F.flatten(F.transform(p["categories"], lambda c, i: F.transform(of_category(c), lambda e: F.concat(F.lit("categories["), i.cast("string"), F.lit("]."), e))))
    own = F.array_compact(
        F.array(
            F.when(blank(p["name"]), "name"),
            F.when(~F.coalesce(p["source_provider"].isin(PROVIDERS), F.lit(False)), "source_provider"),
            F.when(~F.coalesce(target.isin(PROVIDERS), F.lit(False)), "target_provider"),
            F.when(~F.coalesce(p["edit_mode"].isin(EDIT_MODES), F.lit(False)), "edit_mode"),
            F.when(F.coalesce(F.size(p["categories"]), F.lit(0)) <= 0, "categories"),
        )
    )
    return F.concat(own, F.coalesce(named, F.array().cast("array<string>")))


def verdict_error(v: Column, categories: list[str]) -> Column:
    """the first fault of a judge's reply, null if it has none."""
    word = lambda c: F.lower(F.trim(c))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    blank = lambda c: optional_text(c).isNull()
    views = F.array(*map(F.lit, VIEWS))
    legal, follow, relabel = v["instruction_legality"], v["instruction_following"], v["relabel"]
    empty = F.size(v["supporting_views"]) == 0
    return first_reason(
        [
            (blank(v["observation"]), "observation"),
            (v["supporting_views"].isNull() | no(F.forall(v["supporting_views"], lambda x: F.array_contains(views, word(x)))), "supporting_views"),
            (no(word(v["evidence_strength"]).isin(STRENGTHS)), "evidence_strength"),
            (no(word(legal["decision"]).isin("allow", "reject")), "instruction_legality.decision"),
            (no(word(legal["category"]).isin(categories)), "instruction_legality.category"),
            (blank(legal["reason"]), "instruction_legality.reason"),
            ((word(legal["decision"]) == "allow") & (word(legal["category"]) != "structural_part"), "allowed_category"),
            (no(word(v["view_sanity"]["decision"]).isin("pass", "fail")), "view_sanity.decision"),
            (blank(v["view_sanity"]["reason"]), "view_sanity.reason"),
            (v["view_sanity"]["problematic_views"].isNull(), "view_sanity.problematic_views"),
            (no(word(follow["decision"]).isin("pass", "fail")), "instruction_following.decision"),
            (blank(follow["reason"]), "instruction_following.reason"),
            (((word(follow["decision"]) == "pass") | word(v["evidence_strength"]).isin("strong", "medium")) & empty, "no_supporting_views"),
            (no(word(relabel["status"]).isin("none", "rewrite", "cannot_rewrite")), "relabel.status"),
            ((word(relabel["status"]) == "rewrite") & (blank(relabel["instruction"]) | legality_reject_reason(relabel["instruction"]).isNotNull()), "relabel.instruction"),
        ]
    )


def masks_missing(names: Column, view_paths: Column, path: Column) -> Column:
    """whether an edit lacks a mask file, or its meta the path of one."""
    files = F.array(*[F.lit(f"{v}_mask.png") for v in VIEWS], F.lit("edit_mask_grid.png"))
    return ~(F.coalesce(F.size(F.array_except(files, names)) == 0, F.lit(False)) & masks_told(view_paths, path))


def masks_told(view_paths: Column, path: Column) -> Column:
    """Whether a meta has the path of the mask of every view, and of the grid."""
    told = F.coalesce(F.length(path) > 0, F.lit(False))
    for v in VIEWS:
        told = told & F.coalesce(F.length(view_paths[v]) > 0, F.lit(False))
    return told


def remapped_view(front: Column, view: Column) -> Column:
    """The view a final one is made from, and how far it is turned; an unknown front side
    fails the query."""
    known = F.create_map(*[F.lit(x) for f, sides in SIDES.items() for v, s in sides.items() for x in (f"{f}/{v}", s)])
    turns = F.create_map(*[F.lit(x) for f, (top, bottom) in TURNS.items() for x in (f"{f}/top", top, f"{f}/bottom", bottom)])
    front = F.when(front.isin(*SIDES), front).otherwise(F.raise_error(F.concat(F.lit("unknown front side "), front)).cast("string"))
    at = F.concat_ws("/", front, view)
    return F.struct(F.coalesce(known[at], view).alias("source"), F.coalesce(turns[at], F.lit(0)).alias("angle"))


def foreground_box(pixels: DataFrame, keys: list[str], level: float) -> DataFrame:
    """Pixels (keys, x, y, alpha) -> the box of those above a level; none, no row."""
    return pixels.filter(F.col("alpha") > level).groupBy(*keys).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"))


def export_candidates(edits: DataFrame, files: DataFrame, images: DataFrame, failed: list[str], views: list[str] = VIEWS) -> DataFrame:
    """Edits (model_id, edit_id, instruction, edit_status, source_provider_id) fit for an
    export: with an instruction, not failed, all views of both sides and both models there
    (files: path below the root), and a category and object (images: model_id, ...)."""
    name = F.substring_index("path", "/", -1)
    named = files.select(F.substring("path", F.lit(1), F.length("path") - F.length(name) - 1).alias("dir"), name.alias("name"))
    # a bit a view: folders are hashed, where sets of names would be sorted
    pictures = [f"{v}.png" for v in views]
    bit = F.lit(0)
    for i, picture in enumerate(pictures):
        bit = F.when(F.col("name") == picture, 1 << i).otherwise(bit)
    needed = sum(1 << i for i, picture in enumerate(pictures) if picture not in pictures[i + 1 :])
    full = named.filter(F.col("name").isin(pictures) if pictures else F.lit(True)).groupBy("dir").agg(F.bit_or(bit).alias("_seen")).filter(F.col("_seen") == needed).select("dir")
    models = named.filter(F.col("name").rlike(r"^model_.*\.glb$") & F.col("dir").startswith("models_src/"))
    rows = edits.filter(~F.col("model_id").contains("_edit_") & (F.trim("instruction") != "") & ~F.coalesce("edit_status", F.lit("")).isin(failed) & (F.col("source_provider_id") != ""))
    rows = rows.withColumn("instruction", F.trim("instruction")).withColumn("_e", F.concat_ws("/", F.lit("triplets"), "model_id", F.lit("edited"), "edit_id")).withColumn("_s", F.concat_ws("/", F.lit("triplets"), "model_id", F.lit("views"), "source_provider_id"))
    rows = rows.join(full.withColumnRenamed("dir", "_e"), "_e", "left_semi").join(full.withColumnRenamed("dir", "_s"), "_s", "left_semi")
    source = models.select(F.concat_ws("/", "dir", "name").alias("source_glb"))
    rows = rows.withColumn("source_glb", F.concat(F.lit("models_src/"), "model_id", F.lit("/model_"), "source_provider_id", F.lit(".glb"))).join(source, "source_glb", "left_semi")
    first = models.groupBy("dir").agg(F.min("name").alias("_glb"))
    rows = rows.withColumn("dir", F.concat(F.lit("models_src/"), "model_id", F.lit("_edit_"), "edit_id")).join(first, "dir")
    known = images.filter((F.col("category") != "") & (F.col("object_name") != "")).select("model_id", "category", "object_name")
    return rows.join(known, "model_id").select("model_id", "edit_id", "category", "object_name", "instruction", "source_provider_id", F.regexp_extract("_glb", r"^model_(.*)\.glb$", 1).alias("target_provider_id"), "source_glb", F.concat_ws("/", "dir", "_glb").alias("target_glb"))


def instruction_text(item: Column, is_text: bool = False) -> Column:
    """Of a text, or of a struct with the field text; missing is empty."""
    return F.coalesce(clean(item if is_text else item["text"]), F.lit(""))


def instruction_item(text: Column, display: Column) -> Column:
    """The item's own text, or the one on display where it has none."""
    return F.coalesce(F.nullif(text, F.lit("")), display)


def with_display(df: DataFrame, display: Column, text: str) -> DataFrame:
    """All fields of the struct display as columns, and its field `text` in place of
    instruction."""
    fields = df.select(display.alias("d")).schema["d"].dataType.names
    return df.withColumns({**{f: display[f] for f in fields}, "instruction": display[text]})


def manifest_items(manifest: DataFrame) -> DataFrame:
    """Schema, item: a row an item of the list triplets, else samples; a table with
    neither fails."""
    lists = {f.name for f in manifest.schema.fields if f.dataType.typeName() == "array"}
    for schema in ("triplets", "samples"):
        if schema in lists:
            return manifest.select(F.lit(schema).alias("schema"), F.explode(schema).alias("item"))
    raise ValueError("a manifest has a list of triplets or of samples")


def item_id(schema: Column, item: dict[str, Column]) -> Column:
    """Source and edit of a triplet, else the first id that isn't empty, else unknown."""
    of = lambda k: F.nullif(item.get(k, F.lit(None)).cast("string"), F.lit(""))
    pair = F.when(of("source_model_id").isNotNull() & of("edit_id").isNotNull(), F.concat(of("source_model_id"), F.lit("_edit_"), of("edit_id")))
    triplet = F.coalesce(pair, of("target_model_id"), F.lit("unknown"))
    return F.when(schema == "triplets", triplet).otherwise(F.coalesce(of("sample_id"), of("target_model_id"), of("model_id"), F.lit("unknown")))


def quality_meta(enabled: Column, method: Column, checker: Column, result: Column, detail: dict[str, Column], at: Column, error: Column) -> Column:
    """Result is a struct with status, reason, raw_response; null where no check ran, which
    counts as passed. Only the grid method has raw_response, only the other two a detail, and of
    its fields only two_stage_recon has diff_result and judge_result, only unified_judge has
    unified_result."""
    ran = result.isNotNull()
    two, unified = method == "two_stage_recon", method == "unified_judge"
    own = {"diff_result": two, "judge_result": two, "unified_result": unified}
    fields = [(F.when(own[k], c) if k in own else c).alias(k) for k, c in detail.items()]
    return F.struct(
        enabled.alias("enabled"),
        method.alias("method"),
        F.when(ran, result["status"]).otherwise("passed").alias("status"),
        F.when(ran, result["reason"]).otherwise("quality check disabled").alias("reason"),
        checker.alias("checker"),
        at.alias("checked_at"),
        F.coalesce(error, F.lit("")).alias("error_message"),
        F.when(ran & (method == "grid_vlm"), result["raw_response"]).alias("raw_response"),
        F.when(ran & (two | unified), F.struct(*fields)).alias("stage_edit_correctness"),
    )


def index_entry(row: dict[str, Column]) -> Column:
    """Flags from numbers, the list of batches from JSON text (empty where it can't be
    read), and whether edits lack a target; the other fields as they are."""
    flags = ("has_views", "has_instructions", "has_edits")
    lacks = row["has_edits"].cast("boolean") & (row["target_ready_count"] < row["edit_count"])
    batches = F.coalesce(F.from_json(row["edited_batches_json"], "array<string>"), F.array().cast("array<string>"))
    rest = [(F.coalesce(c.cast("boolean"), F.lit(False)) if k in flags else c).alias(k) for k, c in row.items() if k != "edited_batches_json"]
    return F.struct(*rest, batches.alias("edited_batches"), F.coalesce(lacks, F.lit(False)).alias("edits_without_target"))


def unified_decision(v: Column, instruction: Column, rejudged: Column | None = None, require_evidence: bool = True, require_rejudge: bool = True) -> Column:
    """what a sound reply (F17) of the judge decides, in its order of precedence: views that
    can't be, an instruction that isn't legal, weak evidence, an instruction that was followed,
    and else its rewriting, which a second judge (rejudged: decision, reason; null where there
    is none) may have to confirm. status, reason, effective, candidate, and what is on display."""
    word = lambda c: F.lower(F.trim(c))
    say = lambda tag, *parts: F.concat(F.lit(f"[{tag}] "), *[F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    legal, follow, relabel = v["instruction_legality"], v["instruction_following"], v["relabel"]
    geometry, illegal = word(v["view_sanity"]["decision"]) == "fail", word(legal["decision"]) == "reject"
    weak = F.lit(require_evidence) & (word(v["evidence_strength"]) == "weak")
    followed = word(follow["decision"]) == "pass"
    asks = ~geometry & ~illegal & ~weak & ~followed
    rewrite = asks & (word(relabel["status"]) == "rewrite") & (F.coalesce(relabel["instruction"], F.lit("")) != "")
    second = F.lit(require_rejudge) & rejudged.isNotNull() if rejudged is not None else F.lit(False)
    confirmed = F.coalesce(word(rejudged["decision"]) == "pass", F.lit(False)) if rejudged is not None else F.lit(False)
    renamed = rewrite & (~second | confirmed)
    passed = (~geometry & ~illegal & ~weak & followed) | renamed
    effective = F.when(renamed, relabel["instruction"]).otherwise(instruction)
    not_followed = say("instruction_following", follow["reason"])
    after = F.when(rewrite, say("rejudge", rejudged["reason"]) if rejudged is not None else F.lit("")).when(word(relabel["status"]) == "cannot_rewrite", say("relabel", "cannot_rewrite: ", relabel["reason"])).otherwise(F.lit("[relabel] status=none but instruction not followed"))
    failed = (
        F.when(geometry, say("view_sanity", v["view_sanity"]["reason"]))
        .when(illegal, say("instruction_legality", legal["category"], ": ", legal["reason"]))
        .when(weak, F.lit("[evidence] weak visual evidence for the requested edit"))
        .otherwise(F.concat(not_followed, F.lit("; "), after))
    )
    told = F.when(second, "relabel succeeded and rejudge passed").otherwise("relabel succeeded")
    reason = F.when(renamed & (effective != instruction), told).when(passed, "unified judge passed").otherwise(failed)
    given = F.struct(F.when(passed, "passed").otherwise("failed_quality").alias("status"), reason.alias("reason"), effective.alias("effective"), F.when(rewrite, relabel["instruction"]).alias("candidate"), F.when(word(relabel["status"]) == "rewrite", relabel["reason"]).alias("why"), instruction.alias("original"), (renamed & (effective != instruction)).alias("rewritten"))
    none = F.lit(None).cast("string")
    shown = lambda d: display_payload(d["original"], d["effective"], d["candidate"], d["status"], d["rewritten"], d["why"], none, none, F.lit(False))
    return F.transform(F.array(given), lambda d: F.struct(d["status"].alias("status"), d["reason"].alias("reason"), d["effective"].alias("effective"), d["candidate"].alias("candidate"), shown(d).alias("display")))[0]
