"""Queries of record schemas, run states, task recovery and exports, on records made from the
driver tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payloads, records, text
from ..operators import index, planning, stats
from ..streaming import incremental
from .base import Tables, listed, query


def _text(c: Column | str) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


@query("SELECT p_partkey, CASE p_size % 4 WHEN 3 THEN 'random_category_and_object' WHEN 2 THEN 'fixed_category_random_object' ELSE 'fixed_category_fixed_object' END AS mode, 1 + p_size AS planned, CASE WHEN p_size > 0 THEN 'remove,replace' ELSE 'remove' END AS types, p_size % 3 = 0 AS types_ok FROM part")
def selection_modes(t: Tables) -> DataFrame:
    """P37, P38, P40."""
    size = F.col("p_size")
    plan = records.plan_from_counts(F.create_map(F.lit("remove"), F.lit(1), F.lit("replace"), size), ["remove", "replace"])
    types = F.element_at(F.array(F.array(F.lit("remove"), F.lit("replace")), F.array(F.lit("remove"), F.lit("remove")), F.array(F.lit("paint"))), (size % 3 + 1).cast("int"))
    return t.part.select("p_partkey", records.selection_mode(size % 4 == 3, size % 4 >= 2).alias("mode"), plan["count"].alias("planned"), listed(plan["allowed_types"]).alias("types"), records.allowed_types_ok(types, ["remove", "replace"]).alias("types_ok"))


@query("""SELECT event_id, '{"model":"m","headers":{"X-Api-Key":"***REDACTED***","list":[{"bearer":"***REDACTED***"},' || user_id || ']},"token":"' || event_type || '"}' AS said FROM events""")
def redacted_requests(t: Tables) -> DataFrame:
    """Values of any type, at any depth; other keys stay."""
    said = F.concat(F.lit('{"model": "m", "headers": {"X-Api-Key": {"a": [1]}, "list": [{"bearer": '), _text("user_id"), F.lit("}, "), _text("user_id"), F.lit(']}, "token": "'), F.col("event_type"), F.lit('"}'))
    return t.events.select("event_id", text.redacted_json(said).alias("said"))


@query(
    """WITH o AS (SELECT o_custkey AS id, count(*) AS e, count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS s1, count(*) FILTER (WHERE o_orderpriority LIKE '2%') AS s2, count(*) FILTER (WHERE o_orderpriority LIKE '3%') AS s3, count(*) FILTER (WHERE o_orderpriority LIKE '5%') AS f FROM orders GROUP BY 1),
    m AS (SELECT c_custkey AS id, nullif(CASE c_nationkey % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'completed' WHEN 2 THEN ' ' WHEN 3 THEN 'odd' ELSE 'interrupted' END, ' ') AS raw, c_nationkey % 7 = 1 AS fin, c_nationkey % 11 = 2 AS rec, CASE WHEN c_nationkey % 2 = 0 THEN 3 END AS tot FROM customer),
    r AS (SELECT m.*, coalesce(e, 0) AS edit_record_count, coalesce(tot, s1, 0)::BIGINT AS stage1_failed_count, coalesce(s2, 0) AS stage2_failed_count, coalesce(s3, 0) AS stage2_error_count, coalesce(f, 0) AS source_pipeline_failed_count FROM m LEFT JOIN o USING (id)),
    s AS (SELECT *, CASE WHEN rec THEN 'repair_needed' WHEN (fin OR coalesce(raw = 'completed', false)) AND greatest(stage1_failed_count, stage2_failed_count, stage2_error_count, source_pipeline_failed_count) > 0 THEN 'completed_with_failures'
      WHEN fin OR coalesce(raw = 'completed', false) THEN 'completed' WHEN raw IN ('running', 'interrupted') THEN 'interrupted' ELSE coalesce(raw, 'interrupted') END AS status FROM r)
    SELECT id, raw, id % 9 AS planned_edit_count, edit_record_count, stage1_failed_count, stage2_failed_count, stage2_error_count, source_pipeline_failed_count, status, status IN ('interrupted', 'repair_needed') AS resumable FROM s"""
)
def run_states(t: Tables) -> DataFrame:
    """A11."""
    n, p = F.col("c_nationkey"), F.substring("o_orderpriority", 1, 1)
    raw = F.element_at(F.array(*map(F.lit, ("running", "completed", " ", "odd", "interrupted"))), n % 5 + 1)
    runs = t.customer.select(
        F.col("c_custkey").alias("experiment_id"), raw.alias("status"), F.when(n % 7 == 1, "2024").alias("finished_at"), (n % 11 == 2).alias("partial_recovered"),
        F.struct(F.when(n % 2 == 0, F.lit(3).cast("long")).alias("stage1_failed_count"), F.lit(None).cast("long").alias("stage2_failed_count")).alias("totals"),
        F.struct(F.lit(None).cast("long").alias("object_record_count"), F.lit(None).cast("long").alias("edit_record_count"), (F.col("c_custkey") % 9).alias("planned_edit_count")).alias("progress"),
    )
    edits = t.orders.select(F.col("o_custkey").alias("experiment_id"), F.when(p == "1", "error_quality_check").otherwise("passed").alias("stage1_status"), F.when(p == "2", "failed_quality").when(p == "3", "error_quality_check").alias("stage2_status"))
    objects = t.orders.select(F.col("o_custkey").alias("experiment_id"), F.when(p == "5", "failed").alias("source_pipeline_status"))
    out = stats.run_state(runs, objects, edits)
    return out.select(F.col("experiment_id").alias("id"), F.col("raw_status").alias("raw"), "planned_edit_count", "edit_record_count", "stage1_failed_count", "stage2_failed_count", "stage2_error_count", "source_pipeline_failed_count", "status", "resumable")


@query(
    """WITH x AS (SELECT event_id, user_id, CASE WHEN user_id % 2 = 0 THEN 'gen3d' ELSE 'render' END AS kind, CASE event_type WHEN 'click' THEN 'running' WHEN 'view' THEN 'pending' ELSE 'done' END AS status, event_id % 3 = 0 AS remote FROM events)
    SELECT event_id, CASE WHEN kind <> 'gen3d' OR status = 'done' THEN 'none' WHEN remote THEN 'resume' WHEN status = 'pending' THEN 'restart' ELSE 'mark_failed' END AS action, user_id IN (SELECT user_id FROM x WHERE kind = 'gen3d' AND status <> 'done') AS busy,
    user_id IN (SELECT user_id + 1 FROM x WHERE event_id % 50 = 0 AND status <> 'done') AS refreshed FROM x"""
)
def task_recovery(t: Tables) -> DataFrame:
    """F24, F25, X14."""
    status = F.when(F.col("event_type") == "click", "running").when(F.col("event_type") == "view", "pending").otherwise("done")
    tasks = t.events.select("event_id", F.col("user_id").alias("model_id"), F.when(F.col("user_id") % 2 == 0, "gen3d").otherwise("render").alias("type"), status.alias("status"), F.when(F.col("event_id") % 3 == 0, "r").otherwise("").alias("remote"))
    busy = incremental.active_tasks(tasks, "gen3d").withColumn("busy", F.lit(True))
    lists = F.when(F.col("event_id") % 100 == 0, F.array(F.concat(F.lit(" "), _text(F.col("model_id") + 1)), F.lit(" ")))
    # Half of the refreshes are of one model, half of a list.
    refresh = tasks.filter("event_id % 50 = 0").select(F.when(lists.isNotNull(), "refresh_all_models_dreamsim").otherwise("refresh_model_dreamsim").alias("type"), "status", _text(F.col("model_id") + 1).alias("model_id"), F.coalesce(lists, F.array().cast("array<string>")).alias("model_ids"))
    models = tasks.select(_text("model_id").alias("model_id")).distinct()
    fresh = incremental.refreshed_models(models, refresh).select(F.col("model_id").cast("long").alias("model_id"), F.lit(True).alias("refreshed"))
    no = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    rows = tasks.join(busy, "model_id", "left").join(fresh, "model_id", "left")
    return rows.select("event_id", incremental.interrupted_action(F.col("type"), F.col("status"), F.col("remote")).alias("action"), no("busy"), no("refreshed"))


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'legacy_prompt' ELSE 'experiment_prompt' END AS schema, CASE WHEN o_orderkey % 2 = 0 THEN nullif(o_orderpriority, '3-MEDIUM') ELSE 'obj' END AS subject,
    CASE WHEN o_orderkey % 2 = 1 THEN CASE WHEN o_orderstatus = 'F' THEN 'experiment_source_model_ready' WHEN o_orderstatus = 'O' THEN 'experiment_image_ready' ELSE 'experiment_prompt_only' END WHEN o_orderstatus = 'F' THEN 'deleted' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'completed' END AS status,
    CASE WHEN o_orderkey % 2 = 1 THEN CASE WHEN o_orderstatus = 'P' THEN 'running' ELSE 'completed' END WHEN o_orderstatus = 'F' THEN 'failed' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'completed' END AS badge, o_orderkey % 2 = 0 AND o_orderstatus = 'P' AS can_open FROM orders"""
)
def prompt_records(t: Tables) -> DataFrame:
    """P04, P05, P06."""
    k, st = _text("o_orderkey"), F.col("o_orderstatus")
    old = F.col("o_orderkey") % 2 == 0
    r = {
        "id": F.when(old, k), "prompt_id": F.when(~old, k), "experiment_id": F.when(~old, "e"), "prompt": F.lit(" make it "), "object_name": F.when(~old, " obj"),
        "subject": F.when(F.col("o_orderpriority") == "3-MEDIUM", " ").otherwise(F.col("o_orderpriority")), "status": F.when(st == "F", "deleted").when(st == "O", "pending").otherwise("completed"),
        "source_model_id": F.when(st == "F", "m"), "image_id": F.when(st == "O", "i"),
    }
    p = payloads.prompt_record(r)
    return t.orders.select(F.col("o_orderkey").alias("k"), p.alias("p")).select("k", "p.schema", "p.subject", "p.status", F.col("p.status_badge_class").alias("badge"), F.col("p.can_open_image").alias("can_open"))


@query(
    """SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'variant_image' WHEN 1 THEN 'experiment_image' ELSE 'legacy_image' END AS schema_name, CASE WHEN p_size % 5 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'known' END ELSE p_name END AS subject,
    CASE WHEN p_size % 5 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'known' ELSE CASE WHEN p_size % 3 = 0 THEN 'p' ELSE 'i' END || p_partkey END ELSE p_name END AS display_subject FROM part"""
)
def image_entries(t: Tables) -> DataFrame:
    """P07, P08, P13."""
    z, none = F.col("p_size"), F.lit(None).cast("string")
    key = F.element_at(F.array(*[F.array(F.lit("x"), F.lit(k)) for k in ("parent_id", "experiment_id", "generated_at")]), (z % 3 + 1).cast("int"))
    subject = F.when(z % 5 != 0, F.concat(F.lit(" "), F.col("p_name")))
    images = t.part.select(
        F.concat(F.lit("i"), _text("p_partkey")).alias("id"), key.alias("keys"), F.when(z % 2 == 0, subject).otherwise(" ").alias("subject"), F.when(z % 2 == 1, subject).alias("object_name"),
        F.when(z % 3 == 0, F.concat(F.lit("p"), _text("p_partkey"))).alias("parent_id"), none.alias("prompt"), none.alias("generated_at"), none.alias("created_at"),
    )
    objects = t.part.filter("p_partkey % 2 = 0").select(F.explode(F.array(F.concat(F.lit("i"), _text("p_partkey")), F.concat(F.lit("p"), _text("p_partkey")))).alias("image_id"), F.lit("known ").alias("object_name"))
    out = payloads.image_entries(images, objects)
    return out.select(F.substring("id", 2, 20).cast("long").alias("id"), "schema_name", "subject", "display_subject")


@query("SELECT p_partkey AS plan_index, 1 AS object_index, p_brand AS category, p_name AS object_name, 'pr' || p_partkey AS prompt_id, CAST(NULL AS VARCHAR) AS image_id, p_size AS edit_attempts_total, p_size % 4 AS stage1_failed_count, p_size % 5 AS stage2_passed_count, CASE WHEN p_size % 2 = 0 THEN p_retailprice ELSE 1.5 END AS stage2_lpips_mean, CASE WHEN p_size % 3 = 0 THEN 'failed' END AS source_pipeline_status, 17 AS columns FROM part")
def object_rows(t: Tables) -> DataFrame:
    """P22."""
    none, size = F.lit(None).cast("string"), F.col("p_size")
    rows = t.part.select(
        none.alias("experiment_id"), F.col("p_partkey").alias("plan_index"), F.lit(1).alias("object_index"), F.col("p_brand").alias("category"), F.col("p_name").alias("object_name"), F.concat(F.lit("pr"), _text("p_partkey")).alias("prompt_id"), (size % 4).alias("stage1_failed_count"), (size % 5).alias("stage2_passed_count"), F.when(size % 3 == 0, "failed").alias("source_pipeline_status"),
        size.alias("attempts_total"), *[F.when(size % 2 == 0, F.col("p_retailprice")).alias(f"stage2_lpips_{x}") for x in ("mean", "std")], *[F.lit(1.5).alias(f"stage2_dreamsim_{x}") for x in ("mean", "std")],
    )
    out = payloads.object_rows(rows)
    return out.select("plan_index", "object_index", "category", "object_name", "prompt_id", F.col("image_id").cast("string").alias("image_id"), "edit_attempts_total", "stage1_failed_count", "stage2_passed_count", "stage2_lpips_mean", "source_pipeline_status", F.lit(len(out.columns)).alias("columns"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN 'new' ELSE 'old' END AS instruction_text, CASE WHEN l_returnflag = 'A' THEN 'detail' ELSE 'whole' END AS reason, CASE WHEN l_tax > 0.04 THEN 'scoped' WHEN l_discount > 0.04 THEN 'single' END AS score_of, CASE WHEN l_quantity > 25 THEN 'passed' ELSE 'failed_quality' END AS s1 FROM lineitem")
def stage_fields(t: Tables) -> DataFrame:
    """P19, P23, P24."""
    none = F.lit(None).cast("string")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_tax", "l_discount", "l_quantity", *[none.alias(c) for c in ("category", "object_name", "experiment_id")], F.col("l_linenumber").alias("instruction_index"))
    shown = records.display_payload(F.lit("old"), F.when(F.col("l_linestatus") == "F", "new"), none, F.lit("passed"), none.cast("boolean"), none, none, none, F.lit(False))["instruction_display_text"]
    rows = payloads.edit_rows(rows, shown)
    check = lambda of, who: F.struct(F.lit(of).alias("of"), who.alias("provider_id"))
    by = F.when(F.col("l_tax") > 0.04, F.create_map(F.lit("hy3"), check("scoped", F.lit("hy3"))))
    single = F.when(F.col("l_discount") > 0.02, check("single", F.when(F.col("l_discount") <= 0.04, "tp3")))
    detail = F.struct(F.when(F.col("l_returnflag") == "A", "detail").otherwise("").alias("reason"))
    meta = F.struct(F.when(F.col("l_quantity") > 25, " ").otherwise("failed_quality").alias("edit_status"), F.struct(detail.alias("stage_edit_correctness"), F.lit("whole").alias("reason"), none.alias("error_message"), none.alias("method")).alias("quality_check"))
    s1 = payloads.stage1_fields(meta)
    return rows.select("l_orderkey", "l_linenumber", "instruction_text", s1["stage1_reason"].alias("reason"), payloads.stage2_check(by, single, "hy3")["of"].alias("score_of"), s1["stage1_status"].alias("s1"))


@query(
    """SELECT p_partkey, concat_ws(',', CASE WHEN p_size % 7 = 0 THEN 'name' END, CASE WHEN p_size % 3 = 0 THEN 'source_provider,target_provider' END, CASE WHEN p_size % 5 = 0 THEN 'edit_mode' END, CASE WHEN p_size % 11 = 0 THEN 'categories' END,
    CASE WHEN p_size % 11 <> 0 THEN nullif(concat_ws(',', CASE WHEN p_size % 2 = 0 THEN 'categories[1].style_ids' END, CASE WHEN p_size % 4 = 0 THEN 'categories[1].object_count' END), '') END) AS errors FROM part"""
)
def plan_errors(t: Tables) -> DataFrame:
    """P35, P36, P39, F27, F29."""
    z, none = F.col("p_size"), F.lit(None).cast("string")

    def category(count: Column, styles: Column) -> Column:
        return F.struct(none.alias("category_name"), F.struct(F.lit(True).alias("category"), F.lit(False).alias("object")).alias("random"), count.alias("object_count"), F.array(F.lit("lamp")).alias("objects"), styles.alias("style_ids"), F.struct(F.lit(2).alias("count")).alias("instruction_plan"))

    one, two = F.array(F.lit("s")), F.array(F.lit("s"), F.lit("t"))
    whole = F.array(category(F.lit(1), one), category(F.when(z % 4 == 0, 0).otherwise(2), F.when(z % 2 == 0, two).otherwise(one)))
    plan = F.struct(F.when(z % 7 == 0, " ").otherwise("plan").alias("name"), F.when(z % 3 == 0, "other").otherwise("tripo").alias("source_provider"), none.alias("target_provider"), F.when(z % 5 != 0, "single").alias("edit_mode"), F.when(z % 11 == 0, F.slice(whole, 1, 0)).otherwise(whole).alias("categories"))
    return t.part.select("p_partkey", F.array_join(payloads.plan_errors(plan), ",").alias("errors"))


# The faults of a reply in the order in which they are found.
_FAULTS = ["observation", "supporting_views", "evidence_strength", "instruction_legality.decision", "instruction_legality.category", "instruction_legality.reason", "allowed_category", "view_sanity.decision", "view_sanity.reason", "view_sanity.problematic_views", "instruction_following.decision", "instruction_following.reason", "no_supporting_views", "relabel.status", "relabel.instruction"]


@query(f"SELECT event_id, {_FAULTS!r}[CAST(event_id % 17 AS INT) + 1] AS fault FROM events")
def verdict_faults(t: Tables) -> DataFrame:
    """every fault, replies without one, and replies with a later fault besides."""
    n = (F.col("event_id") % 17).cast("int")
    at = {name: i for i, name in enumerate(_FAULTS)}

    def field(name: str, bad: str | None, good: str) -> Column:
        # a reply with this fault, or with an earlier one and an even user, has it
        wrong = (n == at[name]) | (n < at[name]) & (F.col("user_id") % 2 == 0)
        return F.when(wrong, F.lit(bad).cast("string")).otherwise(F.lit(good)).alias(name.split(".")[-1])

    views = F.when(n == at["supporting_views"], F.array(F.lit("inside"))).when(n == at["no_supporting_views"], F.array().cast("array<string>")).otherwise(F.array(F.lit(" Front"), F.lit("top")))
    category = F.when(n == at["instruction_legality.category"], "odd").when(n == at["allowed_category"], "main_body").otherwise("Structural_Part ").alias("category")
    v = F.struct(
        field("observation", " ", "seen"), views.alias("supporting_views"), field("evidence_strength", "huge", "Strong "),
        F.struct(field("instruction_legality.decision", None, "allow"), category, field("instruction_legality.reason", "", "r")).alias("instruction_legality"),
        F.struct(field("view_sanity.decision", "maybe", "Pass"), field("view_sanity.reason", " ", "fine"), F.when(n != at["view_sanity.problematic_views"], F.array().cast("array<string>")).alias("problematic_views")).alias("view_sanity"),
        F.struct(field("instruction_following.decision", "so-so", "fail"), field("instruction_following.reason", None, "done")).alias("instruction_following"),
        F.struct(field("relabel.status", "later", "rewrite"), F.when(n == at["relabel.instruction"], "Remove the left wheel").otherwise("Remove the lamp").alias("instruction")).alias("relabel"),
    )
    return t.events.select("event_id", payloads.verdict_error(v, ["structural_part", "appearance_only", "main_body", "material_only", "unclear"]).alias("fault"))


@query(
    """SELECT 'm' || o_orderkey AS model_id, 'e' || o_custkey AS edit_id, 'obj' AS object_name, 'tp3' AS target_provider_id, 'models_src/m' || o_orderkey || '/model_hy3.glb' AS source_glb FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0"""
)
def export_candidates(t: Tables) -> DataFrame:
    """Each condition fails for some orders."""
    k, s = F.col("o_orderkey"), _text("o_orderkey")
    model, edit = F.concat(F.lit("m"), s), F.concat(F.lit("e"), _text("o_custkey"))
    at = lambda *p: F.concat_ws("/", *[F.lit(x) if isinstance(x, str) else x for x in p])
    edits = t.orders.select(model.alias("model_id"), edit.alias("edit_id"), F.lit(" Remove it ").alias("instruction"), F.when(F.col("o_orderstatus") == "P", "failed_quality").alias("edit_status"), F.lit("hy3").alias("source_provider_id"))
    paths = F.array(
        at("triplets", model, "edited", edit, "front.png"), F.when(k % 3 != 0, at("triplets", model, "edited", edit, "back.png")), at("triplets", model, "views", "hy3", "front.png"), F.when(k % 5 != 0, at("triplets", model, "views", "hy3", "back.png")),
        F.when(k % 7 != 0, at("models_src", model, "model_hy3.glb")), F.concat(F.lit("models_src/"), model, F.lit("_edit_"), edit, F.lit("/model_tp3.glb")), F.concat(F.lit("models_src/"), model, F.lit("_edit_"), edit, F.lit("/model_zz.glb")),
    )
    files = t.orders.select(F.explode(F.array_compact(paths)).alias("path"))
    images = t.orders.select(model.alias("model_id"), F.lit("c").alias("category"), F.when(k % 11 == 0, "").otherwise("obj").alias("object_name"))
    return payloads.export_candidates(edits, files, images, ["failed_quality", "error_quality_check"], ["front", "back"]).select("model_id", "edit_id", "object_name", "target_provider_id", "source_glb")


@query(
    """SELECT vec_id, CASE label % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'back' WHEN 2 THEN 'right' ELSE 'front' END AS source, CASE label % 4 WHEN 0 THEN 0 WHEN 1 THEN 270 WHEN 2 THEN 180 ELSE 90 END AS angle, label % 3 = 0 AS missing FROM embeddings"""
)
def view_remaps(t: Tables) -> DataFrame:
    """A left view and a top view by the side that shows the front; masks of an edit."""
    front = F.element_at(F.array(*map(F.lit, ("front", "left", "back", "right"))), (F.col("label") % 4 + 1).cast("int"))
    views = F.array(*map(F.lit, records.VIEWS))
    names = F.concat(F.transform(views, lambda v: F.concat(v, F.lit("_mask.png"))), F.array(F.lit("edit_mask_grid.png")))
    paths = F.map_from_arrays(views, F.transform(views, lambda v: F.when(v == "top", F.when(F.col("label") % 3 == 0, "").otherwise("p")).otherwise("p")))
    return t.embeddings.select("vec_id", payloads.remapped_view(front, F.lit("left"))["source"].alias("source"), payloads.remapped_view(front, F.lit("top"))["angle"].alias("angle"), payloads.masks_missing(names, paths, F.lit("p")).alias("missing"))


@query("SELECT user_id, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM (SELECT user_id, CAST(event_id % 97 AS BIGINT) AS x, CAST(event_id % 89 AS BIGINT) AS y, value FROM events) WHERE value > 30 GROUP BY 1")
def foreground_boxes(t: Tables) -> DataFrame:
    """M09."""
    return payloads.foreground_box(t.events.select("user_id", (F.col("event_id") % 97).alias("x"), (F.col("event_id") % 89).alias("y"), F.col("value").alias("alpha")), ["user_id"], 30.0)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'passed' WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'in_progress' WHEN o_orderstatus = 'O' THEN 'not_started' ELSE 'failed' END AS state, o_orderstatus <> 'O' AS terminal,
    CASE WHEN o_orderstatus = 'F' THEN 'passed' WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'passed' ELSE 'failed' END END AS outcome, o_orderstatus <> 'O' OR o_orderkey % 2 = 0 AS attempted, CASE WHEN o_orderkey % 3 = 0 THEN 'last' ELSE 'e' END AS last_edit, CASE WHEN o_orderstatus <> 'O' THEN 'e' END AS terminal_edit FROM orders"""
)
def relabel_lifecycles(t: Tables) -> DataFrame:
    """All six fields."""
    st, even = F.col("o_orderstatus"), F.col("o_orderkey") % 2 == 0
    r = records.relabel_lifecycle(F.when(st == "P", " failed"), F.when(st == "F", "relabel_passed"), even, F.when((st == "P") & even, "passed").otherwise("odd"), F.when(F.col("o_orderkey") % 3 == 0, "last").otherwise(""), F.lit(None).cast("string"), F.lit("e"))
    return t.orders.select("o_orderkey", r.alias("r")).select("o_orderkey", "r.state", "r.terminal", F.col("r.terminal_outcome").alias("outcome"), "r.attempted", F.col("r.last_edit_id").alias("last_edit"), F.col("r.terminal_edit_id").alias("terminal_edit"))


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'legacy_prompt' ELSE 'experiment_prompt' END AS schema, CASE WHEN o_orderkey % 3 = 0 THEN 'p' || o_orderkey ELSE 'x' || o_orderkey END AS ui_id,
    CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderstatus = 'P' THEN 'own.png' END WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN 'images/i' || o_custkey || '/image.png' END AS image_path, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 3 = 1 THEN 'i' || o_custkey END AS image_id,
    CASE WHEN o_orderkey % 3 = 0 THEN 'pending' WHEN o_orderstatus = 'F' THEN 'experiment_source_model_ready' WHEN o_orderkey % 3 = 1 THEN 'experiment_image_ready' ELSE 'experiment_prompt_only' END AS status, o_orderkey % 3 = 0 AS can_batch_generate, o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 AS can_open_image,
    'batch_' || (o_custkey % 4) || '.jsonl' AS source_file, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS VARCHAR) END AS updated_at FROM orders"""
)
def prompt_listing(t: Tables) -> DataFrame:
    """All columns, keys told by the records, images told by the files there are."""
    k, old, image = F.col("o_orderkey"), F.col("o_orderkey") % 3 == 0, F.concat(F.lit("i"), _text("o_custkey"), F.when(F.col("o_orderkey") % 2 == 1, "-none").otherwise(""))
    keys = F.when(old, F.array(F.lit("id"), F.lit("prompt"))).otherwise(F.array(F.lit("prompt_id"), F.lit("experiment_id"), F.lit("prompt")))
    rows = t.orders.select(
        F.when(old, F.concat(F.lit("p"), _text(k))).alias("id"), F.when(~old, F.concat(F.lit("x"), _text(k))).alias("prompt_id"), F.when(~old, "e").alias("experiment_id"), F.lit(" Make ").alias("prompt"), F.lit("lamp").alias("object_name"), F.when(old, "pending").alias("status"),
        F.when((k % 3 == 1), image).alias("image_id"), F.when(old & (F.col("o_orderstatus") == "P"), " own.png ").alias("image_path"), F.when(F.col("o_orderstatus") == "F", "m").alias("source_model_id"), F.col("o_orderdate").cast("string").alias("updated_at"),
        keys.alias("keys"), F.concat(F.lit("batch_"), _text(F.col("o_custkey") % 4), F.lit(".jsonl")).alias("source_file"), k.alias("position"),
    )
    files = t.customer.select(F.concat(F.lit("images/i"), _text("c_custkey"), F.lit("/image.png")).alias("path"))
    out = payloads.prompt_listing(rows, files)
    return out.select(F.col("position").alias("k"), "schema", "ui_id", "image_path", F.regexp_replace("image_id", "-none$", "").alias("image_id"), "status", "can_batch_generate", "can_open_image", "source_file", "updated_at")


@query(
    """WITH d AS (SELECT event_id, event_id % 2 = 0 AS geo, event_id % 3 = 0 AS ill, event_id % 5 = 0 AS weak, event_id % 7 = 0 AS fol, CASE user_id % 3 WHEN 0 THEN 'rewrite' WHEN 1 THEN 'cannot_rewrite' ELSE 'none' END AS rel, CASE event_type WHEN 'view' THEN 'pass' WHEN 'click' THEN 'fail' END AS again FROM events),
    r AS (SELECT *, NOT geo AND NOT ill AND NOT weak AND NOT fol AND rel = 'rewrite' AS rw FROM d), s AS (SELECT *, rw AND coalesce(again = 'pass', true) AS renamed FROM r)
    SELECT event_id, CASE WHEN NOT geo AND NOT ill AND NOT weak AND fol OR renamed THEN 'passed' ELSE 'failed_quality' END AS status, CASE WHEN renamed THEN 'Remove the cap' ELSE 'Remove it' END AS effective,
    CASE WHEN renamed THEN CASE WHEN again IS NULL THEN 'relabel succeeded' ELSE 'relabel succeeded and rejudge passed' END WHEN NOT geo AND NOT ill AND NOT weak AND fol THEN 'unified judge passed' WHEN geo THEN '[view_sanity] torn' WHEN ill THEN '[instruction_legality] main_body: whole' WHEN weak THEN '[evidence] weak visual evidence for the requested edit'
      ELSE '[instruction_following] not done; ' || CASE WHEN rw THEN '[rejudge] no' WHEN rel = 'cannot_rewrite' THEN '[relabel] cannot_rewrite: why' ELSE '[relabel] status=none but instruction not followed' END END AS reason,
    CASE WHEN renamed THEN 'relabel_passed' WHEN NOT geo AND NOT ill AND NOT weak AND fol THEN 'original_passed' WHEN rw THEN 'relabel_failed' ELSE 'stage1_failed' END AS display FROM s"""
)
def unified_decisions(t: Tables) -> DataFrame:
    """every step of the order of precedence, with and without a second judge."""
    e = F.col("event_id")
    either = lambda n, yes, no: F.when(e % n == 0, yes).otherwise(no)
    relabel = F.element_at(F.array(*map(F.lit, ("rewrite", "cannot_rewrite", "none"))), (F.col("user_id") % 3 + 1).cast("int"))
    v = F.struct(
        F.struct(either(2, "Fail", "pass").alias("decision"), F.lit("torn").alias("reason")).alias("view_sanity"), F.struct(either(3, "reject", "allow").alias("decision"), F.lit("main_body").alias("category"), F.lit("whole").alias("reason")).alias("instruction_legality"),
        either(5, " weak", "strong").alias("evidence_strength"), F.struct(either(7, "pass", "fail").alias("decision"), F.lit("not done").alias("reason")).alias("instruction_following"), F.struct(relabel.alias("status"), F.lit("Remove the cap").alias("instruction"), F.lit("why").alias("reason")).alias("relabel"),
    )
    again = F.when(F.col("event_type") == "view", "pass").when(F.col("event_type") == "click", "fail")
    second = F.when(again.isNotNull(), F.struct(again.alias("decision"), F.lit("no").alias("reason")))
    rows = t.events.select("event_id", payloads.unified_decision(v, F.lit("Remove it"), second).alias("d"))
    return rows.select("event_id", "d.status", "d.effective", "d.reason", F.col("d.display.instruction_display_status").alias("display"))


_TEXTS = ["Remove the left wheel", "replace a wheel", "Repaint the door", "Remove the entire frame", "Replace the logo", "Replace the wooden seat with a metal seat", "Remove the lamp", "REMOVE one front wheel", "Swap the colour of it", "Remove the whole object", "remove the seam line", "移除左边的门", "Remove the leftover part", None]


@query(
    f"SELECT event_id, {[t or '' for t in _TEXTS]!r}[CAST(event_id % 14 AS INT) + 1] AS said, event_id % 14 IN (0, 11) AS lateral, event_id % 14 IN (1, 7) AS ambiguous, event_id % 14 IN (2, 8) AS texture, event_id % 14 IN (3, 9) AS main_body, event_id % 14 IN (4, 10) AS appearance, event_id % 14 = 5 AS swap FROM events"
)
def term_predicates(t: Tables) -> DataFrame:
    """F06-F11, with the true lists."""
    said = F.element_at(F.array(*map(F.lit, _TEXTS)), (F.col("event_id") % 14 + 1).cast("int"))
    rules = {"lateral": text.is_lateral, "ambiguous": text.is_ambiguous_part, "texture": text.is_texture_edit, "main_body": text.is_main_body_edit, "appearance": text.is_appearance_edit, "swap": text.is_material_swap}
    return t.events.select("event_id", F.coalesce(said, F.lit("")).alias("said"), *[rule(said).alias(name) for name, rule in rules.items()])


@query(
    """WITH m AS (SELECT 'plans/p' || (o_custkey % 30) || '.yaml' AS plan_path, o_orderkey AS id, nullif(CAST(o_orderdate AS VARCHAR), CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS VARCHAR) END) AS t, o_orderpriority AS name, CASE WHEN o_orderkey % 2 = 0 THEN 'tripo' ELSE 'rodin' END AS source, o_orderkey % 5 AS cats FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY plan_path ORDER BY coalesce(t, '') DESC, 'e' || id DESC) AS r FROM m)
    SELECT plan_path, substr(plan_path, 7) AS yaml_name, name AS plan_name, source AS source_provider, cats AS category_count, (SELECT count(*) FROM m WHERE m.plan_path = n.plan_path) AS experiment_run_count, t AS latest_run_time, CAST(regexp_extract(plan_path, '[0-9]+') AS INT) % 2 = 0 AS plan_file_exists FROM n WHERE r = 1"""
)
def plan_details(t: Tables) -> DataFrame:
    """All columns of a plan's summary, told by its newest run."""
    k = F.col("o_orderkey")
    path = lambda c: F.concat(F.lit("plans/p"), c.cast("string"), F.lit(".yaml"))
    cats = F.transform(F.sequence(F.lit(0), (k % 5).cast("int")), lambda i: F.struct(i.cast("string").alias("category_name")))
    runs = t.orders.select(
        path(F.col("o_custkey") % 30).alias("plan_path"), F.concat(F.lit("e"), k.cast("string")).alias("experiment_id"), F.when(k % 4 != 0, F.col("o_orderdate").cast("string")).alias("finished_at"), F.lit(None).cast("string").alias("started_at"), F.col("o_orderpriority").alias("name"),
        F.when(k % 2 == 0, "tripo").otherwise("rodin").alias("source_provider"), F.lit("t").alias("target_provider"), F.lit("single").alias("edit_mode"), F.struct(F.slice(cats, 2, 9).alias("categories")).alias("plan"),
    )
    files = t.customer.select(path(F.col("c_custkey") % 15 * 2).alias("path"))
    return stats.plan_details(runs, files).select("plan_path", "yaml_name", "plan_name", "source_provider", "category_count", "experiment_run_count", "latest_run_time", "plan_file_exists")


@query(
    """WITH v AS (SELECT o_custkey AS c, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS n, min(o_orderkey) FILTER (WHERE o_orderkey % 4 = 0) AS f, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS e, count(*) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderstatus = 'F') AS t, count(*) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderstatus = 'F' AND o_orderkey % 2 = 0) AS r,
      string_agg('e' || o_orderkey || CASE WHEN o_orderstatus = 'F' THEN '+' ELSE '' END, ',' ORDER BY 'e' || o_orderkey) FILTER (WHERE o_orderkey % 3 = 0) AS b FROM orders GROUP BY 1)
    SELECT 'm' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS provider, coalesce(n, 0) AS rendered_views_count, CASE WHEN f IS NOT NULL THEN 'v' || f END AS first_rendered_view_path, coalesce(n, 0) > 0 AS has_views, c_custkey % 4 > 0 AS has_instructions, coalesce(e, 0) > 0 AS has_edits, coalesce(e, 0) AS edit_count, coalesce(t, 0) AS target_ready_count, coalesce(r, 0) AS ready_pair_count, coalesce(t < e, false) AS edits_without_target,
    coalesce(b, '') AS batches, CASE WHEN c_nationkey % 3 = 0 THEN 'own' WHEN c_nationkey % 5 <> 0 AND c_nationkey % 2 = 0 THEN 'region' || c_nationkey % 4 END AS category_name, CASE WHEN c_nationkey % 5 <> 0 THEN 'nation' || c_nationkey END AS object_name, 'g' || c_custkey || '/a.glb' AS path FROM customer LEFT JOIN v ON c = c_custkey WHERE c_custkey % 6 <> 5"""
)
def model_entries(t: Tables) -> DataFrame:
    """Index entries of models made from customers and their orders."""
    k, c, n = F.col("o_orderkey"), F.col("c_custkey"), F.col("c_nationkey")
    name = lambda prefix, x: F.concat(F.lit(prefix), _text(x))
    model, none = name("m", F.col("o_custkey")).alias("model_id"), F.lit(None).cast("string")
    files = t.customer.filter("c_custkey % 6 <> 5").select(name("m", c).alias("model_id"), F.explode(F.array(F.concat(name("g", c), F.lit("/b.glb")), F.concat(name("g", c), F.lit("/a.glb")))).alias("path"))
    metas = t.customer.select(name("m", c).alias("model_id"), F.when(c % 2 == 0, F.col("c_mktsegment")).alias("provider"), none.alias("generated_at"))
    views = t.orders.filter("o_orderkey % 4 = 0").select(model, name("w", k).alias("view"), name("v", k).alias("path"), k.alias("position"))
    counts = t.customer.select(name("m", c).alias("model_id"), (c % 4).alias("count"))
    edits = t.orders.filter("o_orderkey % 3 = 0").select(model, name("e", k).alias("edit_id"), (F.col("o_orderstatus") == "F").alias("has_target_3d"), ((F.col("o_orderstatus") == "F") & (k % 2 == 0)).alias("ready_pair"))
    nation = F.when(n % 5 != 0, name("nation", n))
    images = t.customer.select(name("m", c).alias("image_id"), F.when(n % 4 == 0, nation).otherwise("").alias("object_name"), nation.alias("subject"), F.when(n % 3 == 0, " own ").otherwise("").alias("category"))
    words = t.nation.filter("n_nationkey % 2 = 0").groupBy((F.col("n_nationkey") % 4).alias("pos")).agg(F.collect_list(name("nation", F.col("n_nationkey"))).alias("objects")).select("pos", name("region", F.col("pos")).alias("category"), "objects")
    out = index.model_entries(files, metas, views, counts, edits, index.object_context(images, planning.reverse_lookup(words)))
    told = F.array_join(F.transform("edited_batches", lambda b: F.concat(b["edit_id"], F.when(b["has_target_3d"], "+").otherwise(""))), ",")
    return out.select("id", "provider", "rendered_views_count", "first_rendered_view_path", "has_views", "has_instructions", "has_edits", "edit_count", "target_ready_count", "ready_pair_count", "edits_without_target", told.alias("batches"), "category_name", "object_name", "path")
