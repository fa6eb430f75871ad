"""Plans as JSON held against every rule of the form that makes them. Types and the
presence of keys matter, so plans stay variants until their fields are known to fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import plan_from_counts
from ..sources.scratch import written
from .feasibility import capacity_faults

# Providers, modes, types of instructions, and fields that are refused.
PROVIDERS, EDIT_MODES = ("hunyuan", "tripo", "rodin"), ("single", "multiview")
KINDS, ADAPTIVE = ("remove", "replace"), "adaptive_k"
OLD_FIELDS = ("category_workers", "instruction_type_ratio")
OLD_CATEGORY_FIELDS = ("name", "prompt_budget", "target_source_models", "accepted_edits_per_model", "max_instruction_attempts", "style_ids", "instruction_type_ratio")


def _is(v: Column, path: str, kind: str) -> Column:
    """Is there a value of a kind: OBJECT, ARRAY, STRING, BIGINT, BOOLEAN or VOID (a null)?
    Objects and arrays are told by a cast, as their schema takes all that they hold."""
    whole = {"OBJECT": "map<string, variant>", "ARRAY": "array<variant>"}.get(kind)
    if whole:
        return F.try_variant_get(v, path, whole).isNotNull()
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == kind, F.lit(False))


def _text(v: Column, path: str) -> Column:
    """The text at a path; empty if there is none, or another type."""
    return F.coalesce(F.when(_is(v, path, "STRING"), F.try_variant_get(v, path, "string")), F.lit(""))


def _there(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant").isNotNull()


def _given(v: Column, path: str) -> Column:
    """There, and not a JSON null."""
    return _there(v, path) & ~_is(v, path, "VOID")


def _old_fields(v: Column, fields: tuple[str, ...]) -> Column:
    """Those of the fields that are there, in order, joined by commas; looked up one by one, as
    the keys of an object need it as text."""
    return F.concat_ws(", ", *[F.when(_there(v, f"$.{k}"), k) for k in sorted(fields)])


def _whole(v: Column, path: str) -> Column:
    return F.when(_is(v, path, "BIGINT"), F.try_variant_get(v, path, "bigint"))


def _first(*rules: tuple[Column, str]) -> Column:
    out = None
    for cond, said in rules:
        out = (F if out is None else out).when(F.coalesce(cond, F.lit(False)), said)
    return out


def instruction_plan_fault(c: Column, legacy: bool = False) -> Column:
    """What is wrong with a category's instruction plan, null if nothing. With legacy the
    old counts by type stand for a plan; both at once never do."""
    p, plan, counts = "$.instruction_plan", _there(c, "$.instruction_plan"), _there(c, "$.instruction_counts")
    types = F.try_variant_get(c, f"{p}.allowed_types", "array<variant>")
    named = F.transform(types, lambda x: F.try_variant_get(x, "$", "string"))
    of_plan = _first(
        (~_is(c, p, "OBJECT"), "instruction_plan must be a mapping"),
        (F.trim(_text(c, f"{p}.mode")) == "", "instruction_plan.mode must be a text"),
        (F.trim(_text(c, f"{p}.mode")) != ADAPTIVE, f"instruction_plan.mode must be {ADAPTIVE}"),
        (~F.coalesce(_whole(c, f"{p}.count") > 0, F.lit(False)), "instruction_plan.count must be positive"),
        (~_is(c, f"{p}.allowed_types", "ARRAY"), "instruction_plan.allowed_types must be a list"),
        (~F.forall(named, lambda x: F.coalesce(x.isin(*KINDS), F.lit(False))), "instruction_plan.allowed_types has an unknown type"),
        (F.size(F.array_distinct(named)) < F.size(named), "instruction_plan.allowed_types has a type twice"),
        (F.size(named) == 0, "instruction_plan.allowed_types is empty"),
    )
    keys = F.json_object_keys(F.to_json(F.try_variant_get(c, "$.instruction_counts", "variant")))
    number = lambda k: F.when(_there(c, f"$.instruction_counts.{k}"), _whole(c, f"$.instruction_counts.{k}")).otherwise(0)
    total = sum((number(k) for k in KINDS[1:]), number(KINDS[0]))
    negative = F.lit(False)
    for k in KINDS:
        negative = negative | ~F.coalesce(number(k) >= 0, F.lit(False))
    of_counts = _first(
        (F.lit(not legacy), "instruction_counts is deprecated"),
        (~_is(c, "$.instruction_counts", "OBJECT"), "instruction_counts must be a mapping"),
        (F.size(F.array_except(keys, F.array(*map(F.lit, KINDS)))) > 0, "instruction_counts has an unknown key"),
        (negative, "instruction_counts must not be negative"),
        (total <= 0, "instruction_counts has no positive count"),
    )
    return F.when(plan & counts, "both instruction_plan and instruction_counts").when(plan, of_plan).when(counts, of_counts).otherwise("instruction_plan is required")


def instruction_plan(c: Column) -> Column:
    """Mode, count and allowed_types of a plan without fault, from old counts too."""
    p = "$.instruction_plan"
    made = F.struct(F.lit(ADAPTIVE).alias("mode"), _whole(c, f"{p}.count").cast("int").alias("count"), F.try_variant_get(c, f"{p}.allowed_types", "array<string>").alias("allowed_types"))
    old = plan_from_counts(F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*[F.coalesce(_whole(c, f"$.instruction_counts.{k}").cast("int"), F.lit(0)) for k in KINDS])), list(KINDS))
    old = F.struct(F.lit(ADAPTIVE).alias("mode"), old["count"].cast("int").alias("count"), old["allowed_types"].alias("allowed_types"))
    return F.when(_there(c, p), made).otherwise(old)


def _own_errors(v: Column) -> Column:
    """Rules of the plan itself, in order."""
    name = F.trim(_text(v, "$.name"))

    def one_of(field: str, known: tuple[str, ...]) -> Column:
        text = _text(v, f"$.{field}")
        return F.when(text == "", f"{field} is required").when(~text.isin(*known), f"{field} is unknown")

    old = _old_fields(v, OLD_FIELDS)
    return F.array(
        F.when(name == "", "name is required").when(name.contains("..") | name.contains("/") | name.contains("\\"), "name has a path"),
        one_of("source_provider", PROVIDERS),
        one_of("target_provider", PROVIDERS),
        one_of("edit_mode", EDIT_MODES),
        F.when(old != "", F.concat(F.lit("deprecated fields: "), old)),
        F.when(_there(v, "$.categories") & ~_is(v, "$.categories", "ARRAY"), "categories must be a list").when(F.coalesce(F.size(F.try_variant_get(v, "$.categories", "array<variant>")), F.lit(0)) <= 0, "a category is required"),
    )


def _entries(plans: DataFrame, vocabulary: DataFrame, legacy: bool) -> DataFrame:
    """A row a category of a plan, with its errors in order."""
    rows = plans.select("plan_id", F.posexplode(F.try_variant_get("v", "$.categories", "array<variant>")).alias("position", "c"))
    c = F.col("c")
    rows = rows.withColumns({"is_map": _is(c, "$", "OBJECT"), "random_map": _is(c, "$.random", "OBJECT"), "category_flag": _is(c, "$.random.category", "BOOLEAN"), "object_flag": _is(c, "$.random.object", "BOOLEAN")})
    rows = rows.withColumns(
        {
            "sound": F.col("is_map") & F.col("random_map") & F.col("category_flag") & F.col("object_flag"), "random_category": F.try_variant_get(c, "$.random.category", "boolean"), "random_object": F.try_variant_get(c, "$.random.object", "boolean"),
            "n": _whole(c, "$.object_count"), "name": _text(c, "$.category_name"), "listed": F.when(_is(c, "$.objects", "ARRAY"), F.transform(F.try_variant_get(c, "$.objects", "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))),
            "has_objects": _given(c, "$.objects"), "old": _old_fields(c, OLD_CATEGORY_FIELDS), "plan_fault": instruction_plan_fault(c, legacy),
        }
    )
    rows = written(rows.drop("c"), "plan-entries")  # variants are taken apart once
    sizes = vocabulary.groupBy("category").agg(F.count_distinct("object").alias("capacity")).withColumnRenamed("category", "name")
    rows = rows.join(sizes, "name", "left")
    each = rows.filter("listed is not null").select("plan_id", "position", F.col("name").alias("category"), F.explode("listed").alias("object"))
    unknown = each.join(vocabulary.withColumn("_in", F.lit(True)), ["category", "object"], "left").filter("_in is null").select("plan_id", "position", F.lit(True).alias("_unknown")).distinct()
    rows = rows.join(unknown, ["plan_id", "position"], "left")
    sound, anywhere, n = F.col("sound"), F.col("random_category"), F.col("n")
    fixed = sound & ~anywhere & F.col("capacity").isNotNull()
    listed = fixed & ~F.col("random_object") & (F.coalesce(F.size("listed"), F.lit(0)) > 0)
    rules = [
        (~F.col("is_map"), F.lit("must be a mapping")),
        (F.col("is_map") & (F.col("old") != ""), F.concat(F.lit("deprecated fields: "), F.col("old"))),
        (F.col("is_map") & ~F.col("random_map"), F.lit("random must be a mapping")),
        (F.col("is_map") & F.col("random_map") & ~F.col("category_flag"), F.lit("random.category must be a boolean")),
        (F.col("is_map") & F.col("random_map") & ~F.col("object_flag"), F.lit("random.object must be a boolean")),
        (sound & anywhere & ~F.col("random_object"), F.lit("random category without random object")),
        (sound & ~F.coalesce(n >= 1, F.lit(False)), F.lit("object_count must be positive")),
        (sound & F.col("plan_fault").isNotNull(), F.col("plan_fault")),
        (sound & anywhere & (F.col("name") != ""), F.lit("category_name not allowed")),
        (sound & anywhere & F.col("has_objects"), F.lit("objects not allowed")),
        (sound & ~anywhere & (F.col("name") == ""), F.lit("category_name required")),
        (sound & ~anywhere & (F.col("name") != "") & F.col("capacity").isNull(), F.lit("unknown category")),
        (fixed & F.col("random_object") & F.col("has_objects"), F.lit("objects not allowed")),
        (fixed & F.col("random_object") & (n > F.col("capacity")), F.lit("object_count exceeds the category")),
        (fixed & ~F.col("random_object") & ~listed, F.lit("objects required")),
        (listed & (n != F.size("listed")), F.lit("object_count differs from objects")),
        (listed & (F.size(F.array_distinct("listed")) < F.size("listed")), F.lit("duplicate objects")),
        (listed & F.col("_unknown").isNotNull(), F.lit("unknown objects")),
    ]
    return rows.withColumns({"errors": F.array_compact(F.array(*[F.when(cond, said) for cond, said in rules])), "fixed_name": F.when(fixed, F.col("name")), "demand": F.when(sound & anywhere & (n > 0), n)})


def plan_form_errors(plans: DataFrame, vocabulary: DataFrame, legacy: bool = False) -> DataFrame:
    """plans (plan_id, plan: JSON) and vocabulary (category, object) -> plan_id, errors: all
    of them, those of the plan first, then by category in order, then categories fixed twice,
    too many entries, and the demand that finds no category. A text that isn't a JSON object has
    one error. The runner's own, looser rules are functions.payloads.plan_errors."""
    whole = plans.select("plan_id", F.try_parse_json("plan").alias("v")).withColumn("is_map", _is(F.col("v"), "$", "OBJECT"))
    own = whole.select("plan_id", F.when(F.col("is_map"), F.array_compact(_own_errors(F.col("v")))).otherwise(F.array(F.lit("plan must be a mapping"))).alias("own"))
    rows = _entries(whole.filter("is_map"), vocabulary, legacy)
    told = F.transform("errors", lambda e: F.concat(F.lit("categories["), F.col("position").cast("string"), F.lit("]: "), e))
    by = rows.groupBy("plan_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("position", told.alias("e")))), lambda x: x["e"])).alias("of"), F.count("fixed_name").alias("_named"), F.count_distinct("fixed_name").alias("_distinct"), F.count("demand").alias("_random"))
    entries = rows.select("plan_id", F.col("demand").isNotNull().alias("random_category"), F.col("fixed_name").alias("category_name"), F.col("demand").alias("object_count")).filter("random_category or category_name is not null")
    total = vocabulary.agg(F.count_distinct("category").alias("_total"))
    out = own.join(by, "plan_id", "left").join(capacity_faults(entries, vocabulary), "plan_id", "left").join(F.broadcast(total))
    rest = F.array_compact(F.array(F.when(F.col("_named") > F.col("_distinct"), "duplicate category_name"), F.when(F.col("_distinct") + F.col("_random") > F.col("_total"), "more entries than categories"), F.when(F.col("demand").isNotNull(), F.concat(F.lit("no category left for object_count="), F.col("demand").cast("string")))))
    return out.select("plan_id", F.concat("own", F.coalesce("of", F.array().cast("array<string>")), rest).alias("errors"))
