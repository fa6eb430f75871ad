"""F28 against the greedy rule, one plan at a time."""

import random

import pytest

from tesserine.operators import feasibility

ENTRY = "plan_id int, position int, random_category boolean, random_object boolean, category_name string, objects array<string>, object_count int"


def greedy(entries, vocabulary):
    """The first demand, largest first, that finds no category left; None if all do."""
    fixed = {e[4] for e in entries if not e[2]}
    free = {c: len(o) for c, o in vocabulary.items() if c not in fixed}
    for need in sorted((e[6] for e in entries if e[2]), reverse=True):
        fit = sorted((n, c) for c, n in free.items() if n >= need)
        if not fit:
            return need
        del free[fit[0][1]]
    return None


def test_capacity_equals_the_greedy_rule(spark):
    r = random.Random(28)
    vocabulary = {f"c{i}": [f"o{j}" for j in range(r.randrange(1, 9))] for i in range(7)}
    entries = []
    for plan in range(300):
        for position in range(r.randrange(1, 9)):
            anywhere = r.random() < 0.7
            entries.append((plan, position, anywhere, True, None if anywhere else f"c{r.randrange(9)}", None, r.randrange(1, 8)))
    words = spark.createDataFrame([(c, o) for c, os in vocabulary.items() for o in os] * 2, "category string, object string")
    df = spark.createDataFrame(entries, ENTRY).repartition(5)
    got = {x["plan_id"]: x["demand"] for x in feasibility.capacity_faults(df, words).collect()}
    want = {p: greedy([e for e in entries if e[0] == p], vocabulary) for p in range(300)}
    assert got == {p: d for p, d in want.items() if d is not None} and 20 < len(got) < 280


def test_every_rule(spark):
    words = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z")], "category string, object string")
    plans = {
        1: [(False, False, "a", ["x", "y"], 2), (True, True, None, None, 1), (False, True, "c", None, 1)],
        2: [(True, False, "a", ["x"], 1)],
        3: [(False, True, None, None, 1), (False, True, "nope", None, 1)],
        4: [(False, True, "a", ["x"], 3)],
        5: [(False, False, "a", None, 1), (False, False, "b", [], 0)],
        6: [(False, False, "a", ["x", "x", "q"], 2)],
        7: [(False, True, "a", None, 1), (False, True, "a", None, 1), (True, True, None, None, 1), (True, True, None, None, 1), (True, True, None, None, 2)],
    }
    df = spark.createDataFrame([(p, i, *e) for p, es in plans.items() for i, e in enumerate(es)], ENTRY)
    got = {r["plan_id"]: r["faults"] for r in feasibility.plan_faults(df, words).collect()}
    assert got == {
        1: [],
        2: ["categories[0]: random category without random object", "categories[0]: category_name not allowed", "categories[0]: objects not allowed"],
        3: ["categories[0]: category_name required", "categories[1]: unknown category"],
        4: ["categories[0]: objects not allowed", "categories[0]: object_count exceeds the category"],
        5: ["categories[0]: objects required", "categories[1]: objects required"],
        6: ["categories[0]: object_count differs from objects", "categories[0]: duplicate objects", "categories[0]: unknown objects"],
        7: ["duplicate category_name", "more entries than categories", "no category left for object_count=2"],
    }


def test_assigned_categories(spark, sf_dir):
    from tesserine.plans import registry

    got = registry.queries()["assigned_categories"](spark, sf_dir).collect()
    sizes = {r["p_brand"]: r["n"] for r in spark.sql(f"SELECT p_brand, count(DISTINCT p_partkey) AS n FROM parquet.`{sf_dir}/part.parquet` GROUP BY 1").collect()}
    by = {}
    for r in got:
        by.setdefault(r["plan_id"], {})[r["position"]] = r["category"]
    assert all(len(set(x.values())) == len(x) for x in by.values()) and len({frozenset(x.values()) for x in by.values()}) > 3
    assert all(c in sizes for x in by.values() for c in x.values())
    words = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z")], "category string, object string")
    plans = spark.createDataFrame([(1, 0, True, True, None, None, 1), (1, 1, True, True, None, None, 2), (1, 2, False, True, "c", None, 1)], ENTRY)
    assert {(r["position"], r["category"]) for r in feasibility.assigned(plans, words).collect()} == {(1, "a"), (0, "b")}
    with pytest.raises(Exception, match="no category has room for 2"):
        feasibility.assigned(plans.withColumn("object_count", plans["object_count"] * 0 + 2), words).collect()
