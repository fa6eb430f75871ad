"""The records of an interrupted run, rebuilt from what its stages left behind.

The latest prompt of each object is the spine. Its edits come from the image's instruction
list, or, where there is none, from the edit folders of its source model; each is joined to
its edit's meta, its target's meta and the folders that exist, takes its final status from
them, and is added up to its object. Where an edit was found stays in a column. All joins
are on keys; the latest prompts are written once, as several joins read them; no list is
longer than a prompt's plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import stages
from ..functions.records import ERROR, FAILED, PASSED, exclusion_reason, final_status, strict, target_id
from ..functions.stages import DISPLAY_FIELDS, RELABEL_FIELDS, Doc, base_edit_fields, display_from_item, display_from_meta, relabel_fields
from ..sources.scratch import written
from .dedup import last_write

KEY = ("plan_index", "object_index")
KINDS = ("remove", "replace")
_ENTRY = "struct<instruction_index: int, instruction_type: string, type_index: int, instruction_text: string>"


def latest_prompts(prompts: DataFrame, line: str = "line") -> DataFrame:
    """The last record of each object in order of lines; an object's number is the record's,
    or, where that is null or 0, its place in order of plan and object."""
    rows = last_write(prompts, list(KEY), line).drop(line)
    index = F.col("object_index")
    # After last_write a plan has one record without a number and one with 0 at most, so their
    # places are known from counts: no plan is sorted.
    ahead = F.count_if(index.isNull() | (index < 0)).alias("_ahead")
    counts = prompts.select(*KEY).distinct().groupBy("plan_index").agg(F.count("*").alias("_n"), ahead)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("plan_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.when(index.isNull(), 1).otherwise(F.col("_ahead") + 1) + F.col("_before")
    return rows.join(starts, "plan_index").withColumn("object_number", F.coalesce(F.nullif("object_index", F.lit(0)), place.cast("int"))).drop("_before", "_ahead")


def planned_entries(prompt: Doc, kinds: tuple[str, ...] = KINDS) -> Column:
    """The instructions that a prompt planned: those that were generated, which must be as many
    as the plan says, of its types and not blank; else as many of each type as the old counts
    say, which must not be all 0; else none."""
    plan = prompt.doc("instruction_plan")
    made, counts = prompt.get("generated_instructions", "array<struct<type: string, instruction: string>>"), prompt.doc("instruction_counts")
    allowed = plan.get("allowed_types", "array<string>")
    entry = lambda i, kind, nth, text: F.struct(i.cast("int").alias("instruction_index"), kind.alias("instruction_type"), nth.cast("int").alias("type_index"), text.alias("instruction_text"))
    nth = lambda i, x: F.size(F.filter(F.slice(made, 1, i + 1), lambda y: y["type"] == x["type"]))
    of_made = F.transform(made, lambda x, i: entry(i + 1, x["type"], nth(i, x), x["instruction"]))
    ok = (F.size(made) == plan.get("count", "int")) & F.forall(made, lambda x: F.coalesce(F.array_contains(allowed, x["type"]) & (F.trim(x["instruction"]) != ""), F.lit(False)))
    out = F.when(made.isNotNull(), strict(ok, "generated instructions don't fit their plan", of_made))
    if counts.column is not None:
        number = lambda kind: F.coalesce(counts.get(kind, "int"), F.lit(0))
        of_kind = lambda k: F.transform(F.filter(F.sequence(F.lit(0), number(k)), lambda j: j > 0), lambda j: F.struct(F.lit(k).alias("kind"), j.alias("nth")))
        each = F.concat(*map(of_kind, kinds))
        of_counts = F.transform(each, lambda x, i: entry(i + 1, x["kind"], x["nth"], F.lit("")))
        fits = F.lit(True)
        for k in kinds:
            fits = fits & (number(k) >= 0)
        out = out.when(counts.column.isNotNull(), strict(fits & (F.size(each) > 0), "instruction counts must be positive", of_counts))
    return F.coalesce(out, F.array().cast(f"array<{_ENTRY}>"))


def _doc(df: DataFrame, name: str) -> Doc:
    return Doc(F.col(name), df.schema[name].dataType)


def _apart(name: str, fields: list[str], of: str | None = None) -> list[Column]:
    """Fields of a document, or of a row, as columns of their own: joins then send those
    only that are read later."""
    return [F.col(f"{of}.`{f}`" if of else f"`{f}`").alias(f"{name}__{f}") for f in fields]


def _doc_apart(df: DataFrame, name: str) -> Doc:
    """The document that _apart took apart."""
    own = {f.name.removeprefix(f"{name}__"): f for f in df.schema if f.name.startswith(f"{name}__")}
    return Doc(F.struct(*[F.col(f"`{f.name}`").alias(n) for n, f in own.items()]), StructType([StructField(n, f.dataType) for n, f in own.items()]))


def _edits(run: dict[str, str], models: dict[str, str], prompts: DataFrame, items: DataFrame, edits: DataFrame) -> DataFrame:
    """A row an edit: the columns of its record so far, and its edit's meta."""
    job = [c for c in prompts.columns if c != "planned"]
    spine = prompts.select(*_apart("prompt", job), F.size("planned").alias("_n"), F.col("planned.instruction_type").alias("_types"), F.col("planned.type_index").alias("_nths"), F.col("image_id").alias("_image"), F.col("source_model_id").alias("_source"))
    job = [f"prompt__{c}" for c in job]
    nth = lambda at: [F.col("_types")[at].alias("planned__instruction_type"), F.col("_nths")[at].alias("planned__type_index")]
    listed = spine.join(items.filter("items is not null").select(F.col("image_id").alias("_image"), F.col("items").alias("_items")), "_image")
    by_index = lambda a, b: F.coalesce(a["item"]["instruction_index"], F.lit(0)) - F.coalesce(b["item"]["instruction_index"], F.lit(0))
    placed = F.transform("_items", lambda x, i: F.struct(x.alias("item"), i.alias("place")))
    in_turn = F.array_sort(placed, lambda a, b: F.when(by_index(a, b) != 0, by_index(a, b)).otherwise(a["place"] - b["place"]).cast("int"))
    of_list = listed.withColumn("_found", F.slice(in_turn, F.lit(1), F.col("_n")))
    of_list = of_list.select(*job, "_types", "_nths", "_source", F.posexplode("_found").alias("_at", "_x"))
    of_list = of_list.select(*job, "_source", *nth(F.col("_at")), (F.col("_at") + 1).alias("_index"), *_apart("item", items.schema["items"].dataType.elementType.names, "_x.item"))
    of_list = of_list.withColumn("_edit", F.col("item__edit_id"))
    meta = edits.select(F.col("model_id").alias("_source"), F.col("edit_id").alias("_edit"), F.col("meta").alias("edit_meta"))
    of_list = of_list.join(meta, ["_source", "_edit"], "left")
    unlisted = spine.join(items.select(F.col("image_id").alias("_image"), F.col("items").isNull().alias("_none")), "_image", "left").filter("coalesce(_none, true)").drop("_none", "_image")
    folders = unlisted.join(meta.filter("edit_meta is not null"), "_source")
    # an object has one source, by which its rows lie together already
    turn = Window.partitionBy("_source", *[f"prompt__{c}" for c in KEY]).orderBy(F.coalesce("edit_meta.created_at", F.lit("")), "_edit")
    folders = folders.withColumn("_index", F.row_number().over(turn)).filter(F.col("_index") <= F.col("_n")).select(*job, "_source", "_edit", "edit_meta", "_index", *nth(F.col("_index") - 1))
    return _from_list(run, models, of_list).unionByName(_from_folders(run, models, folders))


def _record(df: DataFrame, run: dict[str, str], models: dict[str, str], index: Column, kind: Column, shown: Column, life: Column, own: dict[str, Column], origin: str) -> DataFrame:
    df = df.withColumns({"_shown": stages.bound(shown), "_life": stages.bound(life)})
    fields = base_edit_fields(run, _doc_apart(df, "prompt"), index.cast("int"), kind, F.col("planned__type_index"), models)
    fields |= {name: F.col(f"_shown.{name}") for name in DISPLAY_FIELDS} | {name: F.col(f"_life.{name}") for name in RELABEL_FIELDS}
    fields |= {"instruction_text": F.col("_shown.instruction_display_text")} | own
    extra = [F.col("prompt__object_index").alias("object_index"), F.col("prompt__object_number").alias("object_number"), F.col("_index").alias("position")]
    return df.select(*[c.alias(name) for name, c in fields.items()], *extra, F.lit(origin).alias("found_in"), "edit_meta")


def _from_list(run: dict[str, str], models: dict[str, str], df: DataFrame) -> DataFrame:
    item = _doc_apart(df, "item")
    kept = {"edit_id": "string", "target_model_id": "string", "stage1_status": "string", "stage2_status": "string", "stage2_score": "double", "final_status": "string", "exclusion_reason": "string"}
    index = F.coalesce(F.nullif(item.get("instruction_index", "int"), F.lit(0)), F.col("_index"))
    shown = display_from_item(item)
    own = {name: item.get(name, kind).cast(kind) for name, kind in kept.items()}
    return _record(df, run, models, index, F.coalesce(item.given("type"), F.col("planned__instruction_type")), shown, relabel_fields(item, item.get("edit_id")), own, "instruction_list")


def _from_folders(run: dict[str, str], models: dict[str, str], df: DataFrame) -> DataFrame:
    meta = _doc(df, "edit_meta")
    shown = display_from_meta(meta)
    own = {"edit_id": F.col("_edit"), "edit_status": F.lit("recovered"), "target_model_id": target_id(F.col("_source"), F.col("_edit"))}
    # the record's own relabel state is that of a new record until the stages are looked at
    return _record(df, run, models, F.col("_index"), F.col("planned__instruction_type"), shown, relabel_fields(Doc(None, None), F.lit(None).cast("string")), own, "edit_folder")


def _finalised(df: DataFrame, targets: DataFrame, generated: DataFrame, rendered: DataFrame, provider_id: str) -> DataFrame:
    """Stage fields, folders that exist and the final status."""
    meta = _doc(df, "edit_meta")
    there = meta.there()
    df = df.withColumn("_one", stages.bound(stages.stage1_fields(meta)))
    own = lambda name: F.when(there, F.col(f"_one.{name}")).otherwise(F.col(name))
    fields = {name: own(name) for name in ("stage1_status", "stage1_reason", "stage1_method", "stage1_checked_views", "stage1_diff_result", "stage1_judge_result", "stage1_raw_response")}
    fields |= {name: F.when(there, F.col(f"_one.display.{name}")).otherwise(F.col(name)) for name in DISPLAY_FIELDS}
    fields |= {name: F.when(there, F.col(f"_one.relabel.{name}")).otherwise(F.col(name)) for name in RELABEL_FIELDS}
    df = df.withColumns(fields | {"stage1_error_message": F.when(there, F.col("_one.stage1_error_message"))}).drop("_one", "edit_meta")
    df = df.withColumn("_again", stages.bound(relabel_fields(_doc_of(df, (*RELABEL_FIELDS, *DISPLAY_FIELDS)), F.col("edit_id"))))
    df = df.withColumns({name: F.col(f"_again.{name}") for name in RELABEL_FIELDS}).drop("_again")
    df = df.withColumn("instruction_text", F.coalesce(F.nullif("instruction_display_text", F.lit("")), "instruction_text"))
    passed = F.coalesce(F.col("stage1_status") == PASSED, F.lit(False))
    target = F.coalesce(F.nullif("target_model_id", F.lit("")), target_id(F.col("source_model_id"), F.col("edit_id")))
    # a target is looked up by the id that the item told; that of a passed edit is its own. Both
    # look-ups go by the latter, so that rows are sent once: where nothing was told, no target's
    # meta counts, and that of an edit that hasn't passed isn't read.
    df = df.withColumn("_told", F.col("target_model_id")).withColumn("target_model_id", F.when(passed, target).otherwise(F.col("target_model_id")))
    df = df.join(targets.select(F.col("model_id").alias("target_model_id"), F.col("meta").alias("_target")), "target_model_id", "left")
    df = df.withColumn("_told", F.coalesce(F.col("_told") == F.col("target_model_id"), F.lit(False))).withColumn("_target", F.when(F.col("_told"), F.col("_target")))
    folder = lambda rows, made, drawn: rows.select(F.col("model_id").alias("target_model_id"), F.lit(made).alias("_made"), F.lit(drawn).alias("_drawn"))
    folders = folder(generated, True, False).unionByName(folder(rendered.filter(F.col("provider_id") == provider_id), False, True))
    df = df.join(folders.groupBy("target_model_id").agg(F.bool_or("_made").alias("_made"), F.bool_or("_drawn").alias("_drawn")), "target_model_id", "left")
    df = df.withColumn("_two", stages.bound(stages.stage2_fields(_doc(df, "_target"), provider_id)))
    made, drawn = F.coalesce("_made", F.lit(False)), F.coalesce("_drawn", F.lit(False))
    two = {name: F.when(passed, F.col(f"_two.{name}")).otherwise(F.col(name)) for name in (*[f"stage2_{n}" for n in stages.STAGE2], "stage2_raw_response")}
    df = df.withColumns(two | {"is_stage2_eligible": passed, "target_gen3d_status": F.when(passed & made, "passed"), "target_render_status": F.when(passed & drawn, "passed"), "target_render_provider_id": F.when(passed & drawn, provider_id)})
    final = final_status(F.col("stage1_status"), F.col("stage2_status"), passed & drawn, passed & made)
    df = df.withColumns({"final_status": final, "entered_stage2": passed & F.col("stage2_status").isNotNull()}).withColumn("exclusion_reason", exclusion_reason(F.col("final_status")))
    return df.drop("_told", "_target", "_made", "_drawn", "_two")


def _doc_of(df: DataFrame, names: tuple[str, ...]) -> Doc:
    """Columns of df as a document; the result text counts as there where it isn't null."""
    shown = df.select(F.struct(*[F.when(F.col(n).isNotNull(), F.struct(F.col(n).alias("text"))).alias(n) if n == "stage1_relabel_result" else F.col(n) for n in names]).alias("d"))
    column = F.struct(*[F.when(F.col(n).isNotNull(), F.struct(F.col(n).alias("text"))).alias(n) if n == "stage1_relabel_result" else F.col(n) for n in names])
    return Doc(column, shown.schema["d"].dataType)


def recovered_edits(run: dict[str, str], models: dict[str, str], prompts: DataFrame, items: DataFrame, edits: DataFrame, targets: DataFrame, generated: DataFrame, rendered: DataFrame) -> DataFrame:
    """A record an edit, with object_index, object_number, position and found_in besides.

    prompts: latest_prompts with `planned` (planned_entries). items: image_id, items (an array
    of structs; no row where there is no list). edits: model_id, edit_id, meta. targets:
    model_id, meta. generated: model_id of folders of models. rendered: model_id, provider_id
    of folders of views."""
    return _finalised(_edits(run, models, prompts, items, edits), targets, generated, rendered, run["target_provider_id"])


def recovered_objects(run: dict[str, str], prompts: DataFrame, edits: DataFrame, rendered: DataFrame) -> DataFrame:
    """A record an object of prompts, from recovered_edits. An object whose source views are
    missing is incomplete: it keeps counts and ids, but has no score or status counts."""
    count = lambda cond, name: F.count_if(F.coalesce(cond, F.lit(False))).alias(name)
    two, score = F.col("stage2_status"), F.col("stage2_score")
    in_turn = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.nullif(c, F.lit("")).isNotNull(), F.struct(F.col("position"), F.col(c).alias("id"))))), lambda x: x["id"])
    status = F.coalesce(F.nullif("final_status", F.lit("")), F.lit("unknown"))
    totals = edits.groupBy("plan_index", "object_index").agg(
        F.count("*").alias("attempts_total"),
        in_turn("edit_id").alias("edit_ids"),
        in_turn("target_model_id").alias("target_model_ids"),
        count(F.col("stage1_status").isin(FAILED, ERROR), "stage1_failed_count"),
        count(F.col("entered_stage2"), "stage2_entered_count"),
        count(two == PASSED, "stage2_passed_count"),
        count(two == FAILED, "stage2_failed_count"),
        count(two == ERROR, "stage2_error_count"),
        F.round(F.avg(score), 6).alias("stage2_lpips_mean"),
        F.round(F.stddev_pop(score), 6).alias("stage2_lpips_std"),
        F.collect_list(status).alias("_statuses"),
    )
    views = rendered.filter(F.col("provider_id") == run["source_provider_id"]).select(F.col("model_id").alias("source_model_id"), F.lit(True).alias("_viewed")).distinct()
    rows = prompts.join(totals, list(KEY), "left").join(views, "source_model_id", "left")
    whole = F.coalesce("_viewed", F.lit(False))
    kinds = F.array_distinct(F.coalesce("_statuses", F.array().cast("array<string>")))
    counts = F.map_from_entries(F.transform(kinds, lambda k: F.struct(k, F.size(F.filter("_statuses", lambda x: x == k)))))
    made = F.size("generated_instructions") if "generated_instructions" in prompts.columns else F.lit(None).cast("int")
    zero = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    none = lambda name: F.coalesce(name, F.array().cast("array<string>")).alias(name)
    full = lambda c: F.when(whole, c)
    job = Doc(F.struct(*[F.col(f"`{c}`") for c in prompts.columns]), prompts.schema)
    of = lambda name, kind="string": job.get(name, kind).alias(name)
    plan = job.get("instruction_plan", "struct<mode: string, count: int, allowed_types: array<string>>")
    return rows.select(
        *[F.lit(run[n]).alias(n) for n in ("experiment_id", "plan_path", "source_provider", "target_provider", "edit_mode")],
        "plan_index", F.col("object_number").alias("object_index"), of("selection_mode"), of("requested_category_name"), of("category"), of("object_name"), F.concat(job.get("category"), F.lit("::"), job.get("object_name")).alias("object_key"), of("prompt_id"), "image_id", "source_model_id",
        *[full(F.lit(run[n])).alias(n) for n in ("source_provider_id", "target_provider_id")],
        full(F.concat(F.lit(run["images_dir"]), F.lit("/"), F.col("image_id"), F.lit("/image.png"))).alias("source_image_path"),
        full(F.concat(F.lit(run["triplets_dir"]), F.lit("/"), F.col("source_model_id"), F.lit(f"/views/{run['source_provider_id']}"))).alias("source_views_dir"),
        *[full(job.get(n)).alias(n) for n in ("prompt", "style_id", "style_name_en")],
        plan.alias("instruction_plan"), plan["count"].alias("instruction_count_planned"), zero("attempts_total"), F.coalesce(F.when(made >= 0, made).cast("long"), F.col("attempts_total"), F.lit(0).cast("long")).alias("generated_instruction_count"), none("edit_ids"), none("target_model_ids"),
        *[zero(f"{n}_count") for n in ("stage1_failed", "stage2_entered", "stage2_passed", "stage2_failed", "stage2_error")],
        full(F.col("stage2_lpips_mean")).alias("stage2_lpips_mean"), full(F.col("stage2_lpips_std")).alias("stage2_lpips_std"),
        F.when(whole, counts).otherwise(F.create_map().cast("map<string,int>")).alias("final_status_counts"),
        F.when(whole, "passed").otherwise("incomplete_or_failed").alias("source_pipeline_status"),
        F.when(whole, F.coalesce(job.get("source_attempt_count", "int").cast("int"), F.lit(0))).otherwise(F.lit(0)).alias("attempt_count"),
        *[full(job.get(f"source_{n}")).alias(n) for n in ("last_error_type", "last_error_message", "failed_stage", "api_lane")],
    )


def recovered(run: dict[str, str], prompts: DataFrame, items: DataFrame, edits: DataFrame, targets: DataFrame, generated: DataFrame, rendered: DataFrame, models: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(object records, edit records) of a run; prompts with the column line, its order."""
    spine = latest_prompts(prompts)
    spine = written(spine.withColumn("planned", planned_entries(Doc(F.struct(*[F.col(f"`{c}`") for c in spine.columns]), spine.schema))), "prompts")
    found = recovered_edits(run, models or {}, spine, items, edits, targets, generated, rendered)
    return recovered_objects(run, spine.drop("planned"), found, rendered), found
