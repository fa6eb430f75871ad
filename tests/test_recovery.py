"""J23 on a small run whose records are known, and the stage fields it is built from."""

import pytest
from pyspark.sql import functions as F

from tesserine.functions import stages
from tesserine.functions.stages import Doc
from tesserine.operators import recovery

RUN = {"experiment_id": "e", "plan_path": "p.yaml", "source_provider": "s", "source_provider_id": "sid", "target_provider": "t", "target_provider_id": "tid", "edit_mode": "single", "images_dir": "images", "triplets_dir": "triplets"}
PROMPT = "line int, plan_index int, object_index int, selection_mode string, category string, object_name string, prompt_id string, image_id string, source_model_id string, instruction_plan struct<mode: string, count: int, allowed_types: array<string>>, generated_instructions array<struct<type: string, instruction: string>>, instruction_counts struct<remove: int, replace: int>"
ITEM = "image_id string, items array<struct<instruction_index: int, type: string, text: string, edit_id: string, target_model_id: string, stage1_status: string, stage1_relabel_result: struct<instruction: string, reason: string>>>"
CHECK = "struct<status: string, reason: string, method: string, error_message: string, stage_edit_correctness: struct<reason: string, checked_views: array<string>, status: string, candidate_rewrite_instruction: string, effective_instruction: string, original_instruction: string, relabel_reason: string>>"
META = f"model_id string, edit_id string, meta struct<edit_id: string, created_at: string, instruction: string, edit_status: string, quality_check: {CHECK}>"
STAGE2 = "struct<status: string, score: double, provider_id: string>"
TARGET = f"model_id string, meta struct<target_quality_checks_by_provider: map<string, {STAGE2}>, target_quality_check: {STAGE2}>"


def prompt(line, i, image, model, made=None, counts=None, n=2):
    return (line, 0, i, "fixed", "cat", f"obj{i}", f"p{i}", image, model, ("adaptive_k", n, ["remove", "replace"]), made, counts)


def run(spark, prompts, items=(), edits=(), targets=(), generated=(), rendered=()):
    frame = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    objects, edits = recovery.recovered(RUN, frame(prompts, PROMPT), frame(items, ITEM), frame(edits, META), frame(targets, TARGET), frame([(g,) for g in generated], "model_id string"), frame(rendered, "model_id string, provider_id string"), {"edit_model": "em"})
    return {r["prompt_id"]: r for r in objects.collect()}, {(r["prompt_id"], r["position"]): r for r in edits.collect()}


TWO = [("remove", "Remove a"), ("replace", "Replace b")]


def test_lists_folders_and_missing_parts(spark):
    rewritten = ("passed", "ok", "unified_judge", None, ("why", ["front"], "passed", "Remove z2", "Remove z2", "Remove z", "clearer"))
    objects, edits = run(
        spark,
        [prompt(1, 1, "old", "m0", TWO), prompt(2, 1, "i1", "m1", TWO), prompt(3, 2, "i2", "m2", [("remove", "Remove a"), ("remove", "Remove b")]), prompt(4, 3, "i3", "m3", None, (1, 2)), prompt(5, 4, "i4", "m4", TWO)],
        [("i1", [(2, "replace", "Replace b", "e2", "m1_edit_e2", "passed", None), (1, "remove", "Remove a", "e1", None, "failed_quality", ("Remove a!", "vague")), (3, "remove", "beyond the plan", "e3", None, "passed", None)]), ("i4", [])],
        [("m1", "e2", ("e2", "2024", "Replace b", "passed", None)), ("m2", "x2", ("x2", "2025", "Remove q", "error_quality_check", None)), ("m2", "x1", ("x1", "2024", "Remove z", None, rewritten)), ("m2", "x3", ("x3", "2026", "third", "passed", None)), ("m3", "b", ("b", None, "Remove 1", "", None)), ("m3", "a", ("a", None, "Remove 2", "", None)), ("m3", "c", ("c", "1", "Remove 3", "", None)), ("m3", "d", None)],
        [("m1_edit_e2", ({"tid": ("passed", 0.25, "tid"), "other": ("failed_quality", 0.9, "other")}, ("failed_quality", 0.8, None))), ("m2_edit_x1", (None, ("failed_quality", 0.5, None))), ("m3_edit_a", (None, ("passed", 0.1, "other")))],
        ["m3_edit_a", "m3_edit_b"],
        [("m1", "sid"), ("m2", "other"), ("m3", "sid"), ("m3_edit_b", "tid"), ("m3_edit_b", "tid")],
    )
    assert set(objects) == {"p1", "p2", "p3", "p4"} and objects["p1"]["image_id"] == "i1"
    assert set(edits) == {("p1", 1), ("p1", 2), ("p2", 1), ("p2", 2), ("p3", 1), ("p3", 2), ("p3", 3)}
    a, b = edits["p1", 1], edits["p1", 2]
    assert (a["edit_id"], a["found_in"], a["final_status"], a["exclusion_reason"], a["edit_model"], a["instruction_type_index"]) == ("e1", "instruction_list", "stage1_failed", "stage1_failed", "em", 1)
    assert (a["instruction_display_status"], a["relabel_lifecycle_state"], a["relabel_attempted"], a["instruction_rewrite_reason"]) == ("relabel_failed", "in_progress", True, "vague")
    assert (b["final_status"], b["stage2_score"], b["stage2_provider_id"], b["entered_stage2"], b["target_gen3d_status"]) == ("stage2_passed", 0.25, "tid", True, None)
    x, y = edits["p2", 1], edits["p2", 2]
    assert (x["edit_id"], x["edit_status"], x["target_model_id"], x["final_status"], x["stage1_reason"], x["stage1_checked_views"]) == ("x1", "recovered", "m2_edit_x1", "stage2_failed", "why", ["front"])
    assert (x["instruction_text"], x["instruction_text_original"], x["instruction_display_status"], x["instruction_display_source"], x["relabel_lifecycle_state"], x["relabel_terminal_edit_id"]) == ("Remove z2", "Remove z", "relabel_passed", "relabel", "passed", "x1")
    assert (y["final_status"], y["stage1_status"], y["instruction_display_status"], y["is_stage2_eligible"], y["instruction_type_index"]) == ("stage1_failed", "error_quality_check", "stage1_failed", False, 2)
    assert [(edits["p3", i]["edit_id"], edits["p3", i]["instruction_type"], edits["p3", i]["final_status"]) for i in (1, 2, 3)] == [("a", "remove", "target_render_failed"), ("b", "replace", "in_progress_or_unresolved"), ("c", "replace", "target_gen3d_failed")]
    assert edits["p3", 2]["target_render_provider_id"] == "tid" and edits["p3", 1]["stage2_status"] is None
    p1, p2, p3, p4 = (objects[f"p{i}"] for i in (1, 2, 3, 4))
    assert (p1["attempts_total"], p1["generated_instruction_count"], p1["stage1_failed_count"], p1["stage2_passed_count"], p1["edit_ids"], p1["target_model_ids"], p1["final_status_counts"], p1["stage2_lpips_mean"], p1["stage2_lpips_std"]) == (2, 2, 1, 1, ["e1", "e2"], ["m1_edit_e2"], {"stage1_failed": 1, "stage2_passed": 1}, 0.25, 0.0)
    assert (p2["source_pipeline_status"], p2["stage2_failed_count"], p2["stage2_lpips_mean"], p2["final_status_counts"], p2["source_views_dir"]) == ("incomplete_or_failed", 1, None, {}, None)
    assert (p3["source_pipeline_status"], p3["generated_instruction_count"], p3["instruction_count_planned"], p3["source_image_path"]) == ("passed", 3, 2, "images/i3/image.png")
    assert (p4["attempts_total"], p4["generated_instruction_count"], p4["edit_ids"]) == (0, 2, [])


@pytest.mark.parametrize(("made", "counts"), [([("remove", "one only")], None), ([("remove", "a"), ("paint", "b")], None), ([("remove", "a"), ("remove", " ")], None), (None, (0, 0)), (None, (-1, 2))])
def test_prompts_that_do_not_fit_their_plan(spark, made, counts):
    rows = spark.createDataFrame([prompt(1, 1, "i", "m", made, counts)], PROMPT)
    with pytest.raises(Exception, match="plan|counts"):
        rows.select(recovery.planned_entries(Doc(F.struct(*rows.columns), rows.schema))).collect()


def test_no_plan_no_edits(spark):
    objects, edits = run(spark, [prompt(1, 0, "i", "m"), prompt(2, 5, "i", "m5")], [], [("m", "e", ("e", "1", "Remove", "passed", None))])
    assert not edits and (objects["p0"]["object_index"], objects["p5"]["object_index"]) == (1, 5)


def test_display_of_items_and_records(spark):
    one = lambda schema, row, make: spark.createDataFrame([(row,)], f"d struct<{schema}>").select(make(Doc(F.col("d"), spark.createDataFrame([], f"d struct<{schema}>").schema["d"].dataType)).alias("x")).first()["x"]
    item = one("text: string, instruction_display_text: string", (" Remove it ", ""), stages.display_from_item)
    assert (item["instruction_text_original"], item["instruction_text_effective"], item["instruction_display_status"]) == ("Remove it", "Remove it", "legacy")
    record = one("instruction_text: string, instruction_text_effective: string, instruction_text_candidate_rewrite: string, stage1_status: string", ("Remove a", "Remove b", "Remove b", "passed"), stages.display_from_record)
    assert (record["instruction_display_status"], record["instruction_rewritten_by_stage1"], record["instruction_display_text"]) == ("relabel_passed", True, "Remove b")
    told = spark.range(1).select(stages.display_from_text(F.lit("Remove c")).alias("x")).first()["x"]
    assert (told["instruction_display_status"], told["instruction_display_source"]) == ("legacy", "original")
    none = spark.range(1).select(stages.stage1_fields(Doc(None, None)).alias("x")).first()["x"]
    assert none["stage1_status"] is None and none["display"] is None and none["relabel"]["relabel_lifecycle_state"] == "not_started"


def test_numbers_of_objects_need_no_sorted_plan(spark):
    # an object without a number or with 0 has its place in order of plan and object
    rows = [(1, 3, -2), (2, 3, None), (3, 3, 0), (4, 3, 7), (5, 1, 4), (6, 1, 0), (7, 1, 0)]
    out = recovery.latest_prompts(spark.createDataFrame(rows, "line int, plan_index int, object_index int"))
    got = {(r["plan_index"], r["object_index"]): r["object_number"] for r in out.collect()}
    assert got == {(3, -2): -2, (3, None): 3, (3, 0): 5, (3, 7): 7, (1, 4): 4, (1, 0): 1}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("windowspecdefinition" in line and "object_index" in line.split("windowspecdefinition", 1)[1] and "ASC" in line.split("object_index", 1)[1][:20] for line in plan.splitlines())


def test_joins_send_no_whole_prompts(spark, sf_dir):
    """Only the fields that the query reads are scanned and sent; the edits go through few shuffles."""
    from tesserine.plans import registry

    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()["recovered_edits"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "generated_instructions" not in plan and "instruction_plan" not in plan
    assert plan.count("Exchange hashpartitioning") <= 11
