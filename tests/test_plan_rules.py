"""One failing plan a rule, and a valid one."""

import json

import pytest
from pyspark.sql import functions as F

from tesserine.operators import plan_rules

GOOD_PLAN = {"mode": "adaptive_k", "count": 2, "allowed_types": ["remove", "replace"]}
GOOD = {
    "name": "n", "source_provider": "tripo", "target_provider": "rodin", "edit_mode": "single",
    "categories": [{"category_name": "a", "random": {"category": False, "object": False}, "objects": ["x", "y"], "object_count": 2, "instruction_plan": GOOD_PLAN}, {"random": {"category": True, "object": True}, "category_name": "", "objects": None, "object_count": 1, "instruction_plan": GOOD_PLAN}],
}
VOCABULARY = [("a", "x"), ("a", "y"), ("b", "x"), ("c", "z")]
GONE = object()
FIXED = {"category_name": "b", "random": {"category": False, "object": True}, "object_count": 1, "instruction_plan": GOOD_PLAN}
RANDOM = {"random": {"category": True, "object": True}, "object_count": 1, "instruction_plan": GOOD_PLAN}


def changed(path, value):
    plan = json.loads(json.dumps(GOOD))
    at = plan
    for key in path[:-1]:
        at = at[key]
    if value is GONE:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return plan


C = "categories"
CASES = [
    (GOOD, []),
    ([1], ["plan must be a mapping"]),
    (changed(["name"], " "), ["name is required"]),
    (changed(["name"], "a/../b"), ["name has a path"]),
    (changed(["name"], "a\\b"), ["name has a path"]),
    (changed(["source_provider"], GONE), ["source_provider is required"]),
    (changed(["source_provider"], "x"), ["source_provider is unknown"]),
    (changed(["target_provider"], GONE), ["target_provider is required"]),
    (changed(["edit_mode"], "triple"), ["edit_mode is unknown"]),
    (GOOD | {"instruction_type_ratio": 1, "category_workers": 2}, ["deprecated fields: category_workers, instruction_type_ratio"]),
    (changed([C], {}), ["categories must be a list"]),
    (changed([C], []), ["a category is required"]),
    (changed([C], GONE), ["a category is required"]),
    (changed([C, 0], 5), ["categories[0]: must be a mapping"]),
    (changed([C, 0, "style_ids"], ["s"]), ["categories[0]: deprecated fields: style_ids"]),
    (changed([C, 0, "random"], True), ["categories[0]: random must be a mapping"]),
    (changed([C, 0, "random"], {"category": "no", "object": 1}), ["categories[0]: random.category must be a boolean", "categories[0]: random.object must be a boolean"]),
    (changed([C, 1, "random", "object"], False), ["categories[1]: random category without random object"]),
    (changed([C, 0, "object_count"], 0), ["categories[0]: object_count must be positive", "categories[0]: object_count differs from objects"]),
    (changed([C, 1, "object_count"], "1"), ["categories[1]: object_count must be positive"]),
    (changed([C, 0, "instruction_plan"], GONE), ["categories[0]: instruction_plan is required"]),
    (changed([C, 0, "instruction_counts"], {}), ["categories[0]: both instruction_plan and instruction_counts"]),
    (changed([C, 0, "instruction_plan"], []), ["categories[0]: instruction_plan must be a mapping"]),
    (changed([C, 0, "instruction_plan", "mode"], " "), ["categories[0]: instruction_plan.mode must be a text"]),
    (changed([C, 0, "instruction_plan", "mode"], "fixed"), ["categories[0]: instruction_plan.mode must be adaptive_k"]),
    (changed([C, 0, "instruction_plan", "count"], 0), ["categories[0]: instruction_plan.count must be positive"]),
    (changed([C, 0, "instruction_plan", "allowed_types"], "remove"), ["categories[0]: instruction_plan.allowed_types must be a list"]),
    (changed([C, 0, "instruction_plan", "allowed_types"], ["paint"]), ["categories[0]: instruction_plan.allowed_types has an unknown type"]),
    (changed([C, 0, "instruction_plan", "allowed_types"], ["remove", "remove"]), ["categories[0]: instruction_plan.allowed_types has a type twice"]),
    (changed([C, 0, "instruction_plan", "allowed_types"], []), ["categories[0]: instruction_plan.allowed_types is empty"]),
    (changed([C, 1, "category_name"], "a"), ["categories[1]: category_name not allowed"]),
    (changed([C, 1, "objects"], []), ["categories[1]: objects not allowed"]),
    (changed([C, 0, "category_name"], GONE), ["categories[0]: category_name required"]),
    (changed([C, 0, "category_name"], "q"), ["categories[0]: unknown category"]),
    (changed([C, 0, "random", "object"], True), ["categories[0]: objects not allowed"]),
    (changed([C, 0], FIXED | {"object_count": 2}), ["categories[0]: object_count exceeds the category"]),
    (changed([C, 0, "objects"], GONE), ["categories[0]: objects required"]),
    (changed([C, 0, "objects"], ["x"]), ["categories[0]: object_count differs from objects"]),
    (changed([C, 0, "objects"], ["x", "x"]), ["categories[0]: duplicate objects"]),
    (changed([C, 0, "objects"], ["x", 7]), ["categories[0]: unknown objects"]),
    (changed([C, 0, "objects"], ["x", "z"]), ["categories[0]: unknown objects"]),
    (changed([C], [FIXED, FIXED]), ["duplicate category_name"]),
    (changed([C], [FIXED, RANDOM, RANDOM, RANDOM]), ["more entries than categories", "no category left for object_count=1"]),
    (changed([C], [FIXED, RANDOM | {"object_count": 3}]), ["no category left for object_count=3"]),
]


def errors(spark, texts, **more):
    plans = spark.createDataFrame(list(enumerate(texts)), "plan_id int, plan string").repartition(3)
    words = spark.createDataFrame(VOCABULARY, "category string, object string")
    return {r["plan_id"]: r["errors"] for r in plan_rules.plan_form_errors(plans, words, **more).collect()}


def test_every_rule(spark):
    got = errors(spark, [*[json.dumps(p) for p, _ in CASES], "{no json", None])
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]
    assert got[len(CASES)] == got[len(CASES) + 1] == ["plan must be a mapping"]


@pytest.mark.parametrize("legacy", [False, True])
def test_old_counts(spark, legacy):
    counts = [{"remove": 1}, {"paint": 1}, {"remove": -1}, {"remove": 0, "replace": 0}, 5, {"replace": "2"}]
    texts = [json.dumps(changed([C, 1], {"random": {"category": True, "object": True}, "object_count": 1, "instruction_counts": x})) for x in counts]
    got = errors(spark, texts, legacy=legacy)
    if not legacy:
        assert all(e == ["categories[1]: instruction_counts is deprecated"] for e in got.values())
    else:
        said = [None, "has an unknown key", "must not be negative", "has no positive count", "must be a mapping", "must not be negative"]
        assert [got[i] for i in range(6)] == [[] if s is None else [f"categories[1]: instruction_counts {s}"] for s in said]


def test_normalised_plans(spark):
    rows = [json.dumps({"instruction_plan": GOOD_PLAN}), json.dumps({"instruction_counts": {"replace": 3}})]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select(plan_rules.instruction_plan(F.parse_json("t")).alias("p")).collect()
    assert [(r["p"]["mode"], r["p"]["count"], list(r["p"]["allowed_types"])) for r in got] == [("adaptive_k", 2, ["remove", "replace"]), ("adaptive_k", 3, ["replace"])]


def test_variants_are_taken_apart_once(spark):
    """Rules and capacities read plain columns; only the rules of the plan itself and the pass
    that takes entries apart meet a variant."""
    plans = spark.createDataFrame([(0, json.dumps(GOOD))], "plan_id int, plan string")
    words = spark.createDataFrame(VOCABULARY, "category string, object string")
    plan = plan_rules.plan_form_errors(plans, words)._jdf.queryExecution().optimizedPlan().toString()
    assert "$.instruction_plan" not in plan and "$.categories" in plan
