import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tesserine.functions import metrics as M
from tesserine.functions import payloads
from tesserine.functions import records as R
from tesserine.functions import text as T
from tesserine.operators import dedup, nearest, planning, search, stats


def one(spark, col):
    return spark.range(1).select(col).first()[0]


@pytest.mark.parametrize(
    ("said", "reason"),
    [
        ("Remove the left wheel", "forbidden_lateral"),
        ("Replace a wheel", "ambiguous_symmetric_part"),
        ("Remove one rear wheel", "ambiguous_symmetric_part"),
        ("移除一个后轮", "not_remove_or_replace"),
        ("Remove 左 wheel", "forbidden_lateral"),
        ("Repaint", "not_remove_or_replace"),
        ("Replace the finish", "texture_edit"),
        ("Replace the wooden leg with a metal leg", "material_swap"),
        ("Replace the wood leg with a wood seat", None),
        ("Remove the entire chair", "main_body_edit"),
        ("Remove the logo", "appearance_edit"),
        ("Remove it, sorry", "refusal"),
        ("  ", "empty"),
        (None, "empty"),
        ("Remove the lamp", None),
    ],
)
def test_legality(spark, said, reason):
    assert one(spark, T.legality_reject_reason(F.lit(said).cast("string"))) == reason


def test_expected_type(spark):
    assert one(spark, T.text_reject_reason(F.lit("Remove it"), F.lit("replace"))) == "edit_type_mismatch"


GOOD = '{"type_judgment":{"allowed_types_used":["remove"],"preferred_types":[],"reason_short":"x"},"instructions":[{"type":"remove","instruction":"Remove the lamp"},{"type":"replace","instruction":"Replace the seat"}]}'


@pytest.mark.parametrize(
    ("reply", "reason"),
    [
        (GOOD, None),
        ("[]", "top_level_keys"),
        ("oops", "top_level_keys"),
        (GOOD.replace('"reason_short":"x"', '"reason_short":" "'), "reason_blank"),
        (GOOD.replace('["remove"]', '["remove","remove"]'), "judgment_types"),
        (GOOD.replace("Replace the seat", "Replace the color"), "item_illegal"),
        (GOOD.replace("Remove the lamp", "remove the vase"), "avoided"),
        (GOOD.replace(',{"type":"replace","instruction":"Replace the seat"}', ""), "instruction_count"),
        (GOOD.replace('{"type":"replace","instruction":"Replace the seat"}', '{"type":"remove","instruction":"REMOVE THE LAMP"}'), "duplicate"),
        (GOOD.replace('"type":"replace"', '"type":"other"'), "item_type"),
    ],
)
def test_reply(spark, reply, reason):
    assert one(spark, T.reply_reject_reason(F.lit(reply), 2, ["remove", "replace"], ["Remove the vase "])) == reason


def test_reply_parsing(spark):
    assert one(spark, T.first_object(F.lit('x {"a": "}{", "b": {"c": 1}} {"d": 2}'))) == '{"a": "}{", "b": {"c": 1}}'
    assert one(spark, T.first_object(F.lit("none {"))) is None
    assert one(spark, T.greedy_object(T.unfenced(F.lit('```json\n{"a": 1}\n```')))) == '{"a": 1}'
    assert one(spark, T.answer_tag(F.lit("<ANSWER> Yes\n</answer>"))) == "yes\n" or one(spark, F.trim(T.answer_tag(F.lit("<ANSWER>Yes</answer>")))) == "yes"
    assert one(spark, T.reply_array(F.lit('```\n[{"k": 2}]\n```'), "k int"))[0]["k"] == 2
    assert one(spark, T.redacted_json(F.lit('{"Bearer": "abc", "x": {"API_KEY": [1]}, "token": 3}'))) == '{"Bearer":"***REDACTED***","x":{"API_KEY":"***REDACTED***"},"token":3}'
    assert one(spark, T.redacted_json(F.lit("{"))) is None
    assert one(spark, T.slug(F.lit(" A/b  C! "), "d")) == "a-b-c" and one(spark, T.slug(F.lit("!!"), "d")) == "d"


def test_record_rules(spark):
    assert one(spark, R.edit_allowed(F.lit(""))) and not one(spark, R.edit_allowed(F.lit("failed_quality"), F.lit(None).cast("boolean")))
    assert one(spark, R.edit_allowed(F.lit("failed_quality"), F.lit(True)))
    assert one(spark, R.target_parts(F.lit("a_edit_b_edit_c"))).asDict() == {"source_id": "a_edit_b", "edit_id": "c"}
    assert one(spark, R.target_parts(F.lit("_edit_c"))) is None
    assert one(spark, R.provider_of(F.lit("x/model_hy3_aligned.glb"), {"hy3": "hunyuan"})) == "hy3_aligned"
    assert one(spark, R.provider_of(F.lit("x/model_hy3.glb"), {"hy3": "hunyuan"})) == "hunyuan"
    assert not one(spark, R.safe_id(F.lit("a/../b"))) and one(spark, R.safe_id(F.lit("a-b")))
    assert one(spark, R.epoch(F.lit("1970-01-01T00:01:00Z"))) == 60 and one(spark, R.epoch(F.lit("x"))) is None
    assert one(spark, R.known_views(F.array(F.lit("top"), F.lit("x"), F.lit("top"), F.lit("front")))) == ["top", "front"]
    assert one(spark, R.plan_from_counts(F.create_map(F.lit("remove"), F.lit(3), F.lit("replace"), F.lit(0)), ["remove", "replace"])).asDict()["count"] == 3
    assert one(spark, R.workers(F.lit(2), F.lit(5), F.lit(2), F.lit(1), F.lit(9))) == 7


@pytest.mark.parametrize("n", [1, 2, 10, 11, 37])
def test_percentiles(spark, n):
    import statistics

    df = spark.createDataFrame([(None, "s", "success", float(i)) for i in range(1, n + 1)], "scope string, stage_name string, status string, elapsed_seconds double")
    row = stats.timing_summary(df, "x").first()
    assert row["p90_seconds"] == math.ceil(0.9 * n) and row["median_seconds"] == statistics.median(range(1, n + 1)) and row["scope"] == "unknown"


def test_distribution_skips_what_is_not_finite(spark):
    df = spark.createDataFrame([("1",), ("x",), ("NaN",), ("Infinity",), ("3",), (None,)], "v string")
    row = stats.distribution(df, "v").first()
    assert (row["count"], row["mean"], row["p50"]) == (2, 2.0, 2.0)
    assert math.isnan(stats.distribution(df.limit(0), "v").first()["p50"])


def test_dedup_order_matters(spark):
    df = spark.createDataFrame([("k", "2", 0, 0.9), ("k", "1", 1, 0.1), ("t", "1", 2, 0.2), ("t", "1", 3, 0.3)], "k string, created_at string, ord int, score double")
    keep = F.col("score") <= 0.5
    assert {r["ord"] for r in dedup.latest_then_filter(df, ["k"], "created_at", "ord", keep).collect()} == {2}
    assert {r["ord"] for r in dedup.filter_then_latest(df, ["k"], "created_at", "ord", keep).collect()} == {1, 2}


def test_cap_counts_survivors_only(spark):
    edits = spark.createDataFrame([("m", e) for e in "abc"], "model string, edit string")
    done = spark.createDataFrame([("m", "c")], "model string, edit string")
    got = {r["edit"]: r["label"] for r in dedup.capped_work(edits, done, ["model", "edit"], ["model"], [F.desc("edit")], 1).collect()}
    assert got == {"c": "skip", "b": "run", "a": "limited"}


def allocate(total, pools):
    order = sorted(pools, key=lambda c: (-pools[c], c))
    n = len(order)
    out = {c: min(total // n + (i < total % n), pools[c]) for i, c in enumerate(order)}
    out = {c: v for c, v in out.items() if v}
    left = total - sum(out.values())
    for c in out:
        more = max(0, min(left, pools[c] - out[c]))
        out[c] += more
        left -= more
    return out


def test_allocation(spark):
    r = random.Random(2)
    cases = [(10, {"a": 3, "b": 8, "c": 1}), (2, {"a": 1, "b": 5, "c": 2})] + [(r.randrange(1, 60), {f"c{i}": r.randrange(1, 20) for i in range(r.randrange(1, 7))}) for _ in range(6)]
    for total, pools in cases:
        df = spark.createDataFrame([(c, n, c) for c, n in pools.items()], "category string, pool_size long, pos string")
        assert {r[0]: r[1] for r in planning.balanced_allocation(df, total).collect()} == allocate(total, pools)


def test_diverse_sample(spark):
    r = random.Random(4)
    rows = [(i, f"c{r.randrange(6)}", f"o{r.randrange(12)}") for i in range(80)]
    chosen, cs, os_ = [], set(), set()
    for strict in (True, False):
        for i, c, o in rows:
            if len(chosen) < 9 and o not in os_ and not (strict and c in cs):
                chosen.append(i)
                cs.add(c)
                os_.add(o)
    df = spark.createDataFrame(rows, "i int, c string, o string").repartition(5)
    assert [r["i"] for r in planning.diverse_sample(df, ["i"], "c", "o", 9).collect()] == chosen


def test_weighted_choice(spark):
    styles = spark.createDataFrame([("c", "x", 3), ("c", "y", 1), ("z", "p", 0), ("z", "q", 0)], "category string, style_id string, weight int")
    req = spark.range(4000).select(F.col("id").alias("request_id"), F.when(F.col("id") % 2 == 0, "c").otherwise("z").alias("category"))
    n = Counter((r["category"], r["style_id"]) for r in planning.weighted_choice(req, styles, 1).collect())
    assert sum(n.values()) == 4000 and abs(n["c", "x"] - 1500) < 90 and abs(n["z", "p"] - 1000) < 90
    pinned = Counter(r["style_id"] for r in planning.weighted_choice(req.filter("category = 'c'"), styles, 1, "y").collect())
    assert abs(pinned["y"] - 2000 * 0.4) < 90 and pinned["x"] == 2000 - pinned["y"]  # the others share the rest


def test_plan_checks():
    assert planning.feasible([3, 5], [5, 4]) and not planning.feasible([3, 5], [4, 4])
    got = planning.assign_categories([(0, 2), (1, 9)], {"a": 3, "b": 9})
    assert got == {1: "b", 0: "a"}
    with pytest.raises(ValueError):
        planning.assign_categories([(0, 10)], {"a": 3})


def test_search_ranks(spark):
    df = spark.createDataFrame([("abc", "x"), ("ab", "y"), ("q", "crab"), ("r", "no")], "id string, object string")
    got = search.ranked_search(df, " AB ", "id", ["object"], [F.col("id")]).collect()
    assert [(r["id"], r["rank"]) for r in got] == [("ab", 0), ("abc", 1), ("q", 2)]


def test_pages_tile_the_table(spark):
    df = spark.range(23).withColumn("k", F.col("id") % 4)
    order = [F.desc("k"), F.col("id")]
    rows, more, n = [], True, 1
    while more:
        page, more = search.page_with_more(df, order, n, 5)
        rows += [r["id"] for r in page.collect()]
        n += 1
    assert rows == [r["id"] for r in df.orderBy(*order).collect()]


def test_metrics(spark):
    a = F.array(*[F.lit(float(x)) for x in (1, 2, 3, 4)])
    m = M.mse(a, a)
    assert one(spark, m) == 0 and one(spark, M.psnr(m)) == math.inf and abs(one(spark, M.ssim(a, a)) - 1) < 1e-12
    with pytest.raises(Exception, match="differ"):
        one(spark, M.mse(a, F.array(F.lit(1.0))))
    eye = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(3)]) for i in range(3)])
    assert one(spark, M.is_rotation(eye)) and one(spark, M.matmul(eye, eye)) == [[1, 0, 0], [0, 1, 0], [0, 0, 1]]
    assert one(spark, M.consistency(F.create_map(F.lit("a"), F.lit(0.5), F.lit("b"), F.lit(float("nan"))), "mean")) == 0.5
    assert not one(spark, M.passes(F.lit(None).cast("double"), 0.5, "lower"))
    assert one(spark, M.change_ratio(F.array(F.array(F.lit(1), F.lit(9)), F.array(F.lit(1), F.lit(1))), F.array(F.array(F.lit(1), F.lit(1)), F.array(F.lit(1), F.lit(1))), 5)) == 0.5


def test_nearest(spark):
    a = spark.createDataFrame([(1, i, [float(i), 0.0]) for i in range(4)], "k int, id int, p array<double>")
    b = spark.createDataFrame([(1, 9, [0.0, 3.0]), (1, 8, [5.0, 0.0])], "k int, id int, p array<double>")
    row = nearest.chamfer(a, b, "k", "p", "id").first()
    to_b = [min(math.dist((i, 0), q) for q in ((0, 3), (5, 0))) for i in range(4)]
    to_a = [3.0, 2.0]
    assert abs(row["chamfer"] - (sum(to_b) / 4 + sum(to_a) / 2)) < 1e-12 and row["hausdorff"] == max(*to_b, *to_a)


def test_faults_fail(spark):
    ok = F.lit("left"), F.lit(0.9), F.lit(" seen ")
    assert one(spark, M.checked_decision(*ok, 0.5))["reason"] == "seen"
    with pytest.raises(Exception, match="confidence too low"):
        one(spark, M.checked_decision(F.lit("left"), F.lit(0.1), F.lit(""), 0.5))
    with pytest.raises(ValueError, match="manifest"):
        payloads.manifest_items(spark.createDataFrame([(1,)], "triplets int"))
    assert one(spark, payloads.instruction_text(F.lit(None).cast("string"), True)) == ""
    assert one(spark, M.front_rotation(F.lit("odd"))) is None


def test_ties_of_sorted_edits_are_dealt_to_many_tasks(spark):
    from tesserine.functions import payloads

    rows = spark.range(20000).selectExpr("id", "'c' AS category", "'o' AS object_name", "'e' AS experiment_id", "id % 2 AS instruction_index", "map('a', 1) AS m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = payloads.edit_rows(rows, F.lit("t")).withColumn("at", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("at").count().collect()]
        turns = [r["instruction_index"] for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2 and max(sizes) < 10000 and sum(sizes) == 20000 and turns == sorted(turns)


def test_quota_sorts_once(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 3), ("b", "x", 9), (None, "x", 1)], "g string, k string, pos int")
    out = dedup.quota(rows, ["g"], "k", [F.col("pos")], {"x": 1}, 2)
    assert {(r["g"], r["pos"]) for r in out.collect()} == {("a", 1), ("b", 9), (None, 1)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert final.count("Sort [") == 1 and final.count("Exchange hashpartitioning") == 1, plan


def test_folders_of_edits_by_bits(spark):
    from tesserine.operators import refresh

    at = lambda e, *names: [(f"triplets/m/edited/{e}/{n}",) for n in names]
    views = [f"{v}.png" for v in ("front", "back", "right", "left", "top", "bottom")]
    files = spark.createDataFrame(at("a", *views, *views, "meta.json") + at("b", *views[:4], "odd.png", "odd.png", "other.png", "meta.json") + at("c", "logs/meta.json", "front.png") + [("triplets/m/edited",)], "path string")
    metas = spark.createDataFrame([("m", "a", '{"instruction": " x "}'), ("m", "b", '{"instruction": "y"}')], "model_id string, edit_id string, text string")
    got = {r["edit_id"]: (r["png_count"], r["valid"], r["instruction"], r["reason"]) for r in refresh.edit_status(files, metas).collect()}
    assert got == {"a": (6, True, "x", ""), "b": (6, True, "y", ""), "c": (1, False, "", "Missing meta.json")}
    assert "ObjectHashAggregate" not in refresh.edit_status(files, metas)._jdf.queryExecution().executedPlan().toString()


def test_views_of_export_candidates_by_bits(spark):
    from tesserine.functions import payloads

    edits = spark.createDataFrame([("m", e, "do", None, "p") for e in "ab"], "model_id string, edit_id string, instruction string, edit_status string, source_provider_id string")
    paths = ["triplets/m/views/p/f.png", "triplets/m/views/p/g.png", "models_src/m/model_p.glb", "no_folder"] + [f"models_src/m_edit_{e}/model_t.glb" for e in "ab"] + ["triplets/m/edited/a/f.png", "triplets/m/edited/a/g.png", "triplets/m/edited/b/f.png", "triplets/m/edited/b/f.png"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    images = spark.createDataFrame([("m", "c", "o")], "model_id string, category string, object_name string")
    out = payloads.export_candidates(edits, files, images, ["failed"], ["f", "g"])
    assert [(r["edit_id"], r["target_provider_id"], r["target_glb"]) for r in out.collect()] == [("a", "t", "models_src/m_edit_a/model_t.glb")]
    assert "ObjectHashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
