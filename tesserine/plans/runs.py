"""Queries of whole runs: recovery, feasibility, view plans and progress, on records made from
the driver tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import exports, feasibility, plan_rules, recovery, refresh
from ..sources.scratch import written
from .base import Tables, listed, query, r6

RUN = {"experiment_id": "run", "plan_path": "plan.yaml", "source_provider": "src", "source_provider_id": "s", "target_provider": "tgt", "target_provider_id": "t", "edit_mode": "single", "images_dir": "images", "triplets_dir": "triplets"}


def _artifacts(t: Tables) -> dict[str, DataFrame]:
    """Orders as objects and lineitems as their edits. Every prompt is there twice, an old one
    first. Two of three objects have an instruction list, in reverse; others only folders. Every
    fourth edit has no meta, and every other item of a list names no target."""
    modes, how = F.array(*map(F.lit, ("AIR", "RAIL", "MAIL", "SHIP", "FOB", "TRUCK", "REG"))), F.array(*map(F.lit, ("NONE", "COD", "RETURN", "PERSON")))
    # Eight tables are made of the numbered lines, so these are sorted and written once, an
    # order's lines as a list: what is made of them then needs no shuffle by order again.
    turn = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag")
    nth = lambda x, i: F.named_struct(F.lit("l_linenumber"), (i + 1).cast("int"), F.lit("l_shipmode"), modes[(x["l_suppkey"] % 7).cast("int")], F.lit("l_shipinstruct"), how[(x["l_partkey"] % 4).cast("int")], *[y for c in ("l_returnflag", "l_shipdate", "l_discount") for y in (F.lit(c), x[c])])
    lists = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(turn)).alias("lines"))
    lists, o = written(lists.select("l_orderkey", F.transform("lines", nth).alias("lines")), "lines"), t.orders
    line = lists.select("l_orderkey", F.inline("lines"))
    edit = F.concat(F.lit("e"), F.col("l_linenumber").cast("string"))
    model = F.concat(F.lit("m"), F.col("l_orderkey").cast("string"))
    target = F.concat(model, F.lit("_edit_"), edit)
    status = F.when(F.col("l_returnflag") == "R", "failed_quality").when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7), "error_quality_check").when(F.col("l_returnflag") == "N", "passed")
    kind_of = lambda x: F.when(x["l_returnflag"] == "R", "replace").otherwise("remove")
    text_of = lambda x: F.concat(F.initcap(kind_of(x)), F.lit(" the "), x["l_shipmode"])
    made = lists.select("l_orderkey", F.transform("lines", lambda x: F.named_struct(F.lit("l_returnflag"), x["l_returnflag"], F.lit("l_shipmode"), x["l_shipmode"])).alias("made"), F.size("lines").alias("count"))
    key = F.col("o_orderkey").cast("string")
    plan = F.struct(F.lit("adaptive_k").alias("mode"), "count", F.array(F.lit("remove"), F.lit("replace")).alias("allowed_types"))
    fields = [(F.col("o_custkey") % 7).cast("int").alias("plan_index"), F.col("o_orderkey").cast("int").alias("object_index"), F.concat(F.lit("i"), key).alias("image_id"), F.concat(F.lit("m"), key).alias("source_model_id"), F.lit("fixed").alias("selection_mode"), F.concat(F.lit("o"), key).alias("object_name"), F.concat(F.lit("p"), key).alias("prompt_id"), plan.alias("instruction_plan"), F.transform("made", lambda x: F.named_struct(F.lit("type"), kind_of(x), F.lit("instruction"), text_of(x))).alias("generated_instructions")]
    rows = o.join(made, o["o_orderkey"] == made["l_orderkey"])
    prompts = rows.select(*fields, F.explode(F.array(F.struct(F.lit(1).alias("line"), F.lit("old").alias("category")), F.struct(F.lit(2).alias("line"), F.col("o_orderpriority").alias("category")))).alias("x")).select("*", "x.*").drop("x")
    edit_of = lambda x: F.concat(F.lit("e"), x["l_linenumber"].cast("string"))
    item = lambda x: F.named_struct(F.lit("instruction_index"), x["l_linenumber"], F.lit("type"), kind_of(x), F.lit("text"), text_of(x), F.lit("edit_id"), edit_of(x), F.lit("stage1_status"), F.when(x["l_shipmode"] != "FOB", "passed"), F.lit("target_model_id"), F.when(x["l_linenumber"] % 2 == 0, F.concat(model, F.lit("_edit_"), edit_of(x))))
    items = lists.filter("l_orderkey % 3 <> 0").select(F.concat(F.lit("i"), F.col("l_orderkey").cast("string")).alias("image_id"), F.reverse(F.transform("lines", item)).alias("items"))
    meta = F.struct(edit.alias("edit_id"), F.col("l_shipdate").cast("string").alias("created_at"), F.concat(F.lit("Remove "), F.col("l_shipinstruct")).alias("instruction"), status.alias("edit_status"))
    edits = line.filter("l_linenumber % 4 <> 0").select(model.alias("model_id"), edit.alias("edit_id"), meta.alias("meta"))
    check = F.struct(F.when(F.col("l_shipmode") == "AIR", "passed").when(F.col("l_shipmode") == "RAIL", "failed_quality").otherwise("error_quality_check").alias("status"), F.col("l_discount").cast("double").alias("score"), F.when(F.col("l_shipmode") == "MAIL", "other").alias("provider_id"))
    of = F.struct(F.when(F.col("l_shipmode") == "AIR", F.create_map(F.lit("t"), check)).alias("target_quality_checks_by_provider"), F.when(F.col("l_shipmode") != "AIR", check).alias("target_quality_check"))
    targets = line.filter("l_shipmode IN ('AIR', 'RAIL', 'MAIL', 'SHIP')").select(target.alias("model_id"), of.alias("meta"))
    generated = line.filter("l_shipmode <> 'TRUCK'").select(target.alias("model_id"))
    rendered = line.filter("l_shipinstruct <> 'NONE'").select(target.alias("model_id"), F.lit("t").alias("provider_id")).unionByName(o.filter("o_orderstatus <> 'P'").select(F.concat(F.lit("m"), key).alias("model_id"), F.lit("s").alias("provider_id")))
    return {"prompts": prompts, "items": items, "edits": edits, "targets": targets, "generated": generated, "rendered": rendered}


_EDITS = """WITH lines AS (SELECT * EXCLUDE (l_linenumber), row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate, l_returnflag) AS l_linenumber, ['AIR', 'RAIL', 'MAIL', 'SHIP', 'FOB', 'TRUCK', 'REG'][l_suppkey % 7 + 1] AS l_shipmode, ['NONE', 'COD', 'RETURN', 'PERSON'][l_partkey % 4 + 1] AS l_shipinstruct FROM lineitem),
    x AS (SELECT l_orderkey AS k, l_linenumber AS n, l_orderkey % 3 <> 0 AS listed, l_linenumber % 4 <> 0 AS has_meta, l_shipdate, l_shipmode, l_shipinstruct, l_returnflag, o_orderstatus, o_custkey % 7 AS plan_index,
      CASE WHEN l_linenumber % 4 = 0 THEN CASE WHEN l_shipmode <> 'FOB' THEN 'passed' END WHEN l_returnflag = 'R' THEN 'failed_quality' WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 'error_quality_check' ELSE 'passed' END AS s1,
      CASE WHEN l_orderkey % 3 <> 0 AND l_linenumber % 2 = 1 THEN NULL WHEN l_shipmode = 'AIR' THEN 'passed' WHEN l_shipmode = 'RAIL' THEN 'failed_quality' WHEN l_shipmode = 'SHIP' THEN 'error_quality_check' END AS s2, CAST(l_discount AS DOUBLE) AS d
      FROM lines JOIN orders ON l_orderkey = o_orderkey),
    y AS (SELECT *, row_number() OVER (PARTITION BY k, listed ORDER BY CASE WHEN listed THEN '' ELSE CAST(l_shipdate AS VARCHAR) END, CASE WHEN NOT listed THEN 'e' || n END, n) AS position FROM x WHERE listed OR has_meta),
    z AS (SELECT *, coalesce(s1 = 'passed', false) AS ok, CASE WHEN coalesce(s1 = 'passed', false) THEN s2 END AS stage2_status FROM y),
    e AS (SELECT *, CASE WHEN s1 IN ('failed_quality', 'error_quality_check') THEN 'stage1_failed' WHEN NOT ok THEN 'in_progress_or_unresolved' WHEN s2 = 'passed' THEN 'stage2_passed' WHEN s2 = 'failed_quality' THEN 'stage2_failed' WHEN s2 = 'error_quality_check' THEN 'stage2_error'
      WHEN l_shipinstruct <> 'NONE' THEN 'in_progress_or_unresolved' WHEN l_shipmode <> 'TRUCK' THEN 'target_render_failed' ELSE 'target_gen3d_failed' END AS final_status FROM z)"""


@query(
    _EDITS
    + """SELECT k, 'e' || n AS edit_id, plan_index, position, CASE WHEN listed THEN 'instruction_list' ELSE 'edit_folder' END AS found_in, s1 AS stage1_status, stage2_status, CASE WHEN stage2_status IS NOT NULL THEN d END AS score, final_status,
    CASE WHEN final_status = 'in_progress_or_unresolved' THEN 'recovered_partial' WHEN final_status <> 'stage2_passed' THEN final_status END AS exclusion_reason, CASE WHEN ok OR NOT listed OR n % 2 = 0 THEN 'm' || k || '_edit_e' || n END AS target_model_id, CASE WHEN ok AND l_shipmode <> 'TRUCK' THEN 'passed' END AS made, ok AND stage2_status IS NOT NULL AS entered,
    CASE WHEN has_meta THEN 'Remove ' || l_shipinstruct ELSE CASE WHEN l_returnflag = 'R' THEN 'Replace' ELSE 'Remove' END || ' the ' || l_shipmode END AS text,
    CASE WHEN has_meta AND s1 IN ('failed_quality', 'error_quality_check') THEN 'stage1_failed' WHEN has_meta AND l_returnflag = 'A' THEN 'legacy' WHEN s1 = 'passed' THEN 'original_passed' ELSE 'legacy' END AS display FROM e"""
)
def recovered_edits(t: Tables) -> DataFrame:
    """The edit records of a run, rebuilt."""
    _, edits = recovery.recovered(RUN, **_artifacts(t))
    return edits.select(F.col("object_index").cast("long").alias("k"), "edit_id", "plan_index", "position", "found_in", "stage1_status", "stage2_status", F.col("stage2_score").alias("score"), "final_status", "exclusion_reason", "target_model_id", F.col("target_gen3d_status").alias("made"), F.col("entered_stage2").alias("entered"), F.col("instruction_text").alias("text"), F.col("instruction_display_status").alias("display"))


@query(
    _EDITS
    + """, c AS (SELECT k, final_status || '=' || count(*) AS told FROM e GROUP BY k, final_status), h AS (SELECT k, string_agg(told, ',' ORDER BY told) AS told FROM c GROUP BY k),
    g AS (SELECT k, count(*) AS attempts, string_agg('e' || n, ',' ORDER BY position) AS ids, count(*) FILTER (WHERE s1 IN ('failed_quality', 'error_quality_check')) AS failed1, count(*) FILTER (WHERE stage2_status IS NOT NULL) AS entered, count(*) FILTER (WHERE stage2_status = 'passed') AS passed2, count(*) FILTER (WHERE stage2_status = 'failed_quality') AS failed2, count(*) FILTER (WHERE stage2_status = 'error_quality_check') AS error2,
      avg(d) FILTER (WHERE stage2_status IS NOT NULL) AS m, stddev_pop(d) FILTER (WHERE stage2_status IS NOT NULL) AS s FROM e GROUP BY k),
    l AS (SELECT l_orderkey AS k, count(*) AS planned FROM lineitem GROUP BY 1)
    SELECT coalesce(nullif(o_orderkey, 0), row_number() OVER (ORDER BY o_custkey % 7, o_orderkey)) AS k, o_orderpriority AS category, planned, coalesce(attempts, 0) AS attempts, coalesce(ids, '') AS ids, coalesce(failed1, 0) AS failed1, coalesce(entered, 0) AS entered, coalesce(passed2, 0) AS passed2, coalesce(failed2, 0) AS failed2, coalesce(error2, 0) AS error2, CASE WHEN o_orderstatus <> 'P' THEN round(round(m, 6), 6) END AS mean, CASE WHEN o_orderstatus <> 'P' THEN round(round(s, 6), 6) END AS std,
    CASE WHEN o_orderstatus <> 'P' THEN coalesce(told, '') ELSE '' END AS statuses, CASE WHEN o_orderstatus <> 'P' THEN 'passed' ELSE 'incomplete_or_failed' END AS source_status FROM orders JOIN l ON o_orderkey = l.k LEFT JOIN g ON o_orderkey = g.k LEFT JOIN h ON o_orderkey = h.k"""
)
def recovered_objects(t: Tables) -> DataFrame:
    """The object records of a run, rebuilt."""
    objects, _ = recovery.recovered(RUN, **_artifacts(t))
    told = listed(F.transform(F.map_entries("final_status_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return objects.select(
        F.col("object_index").cast("long").alias("k"), "category", F.col("instruction_count_planned").cast("long").alias("planned"), F.col("attempts_total").alias("attempts"), F.array_join("edit_ids", ",").alias("ids"), F.col("stage1_failed_count").alias("failed1"), F.col("stage2_entered_count").alias("entered"), F.col("stage2_passed_count").alias("passed2"), F.col("stage2_failed_count").alias("failed2"), F.col("stage2_error_count").alias("error2"),
        r6("stage2_lpips_mean").alias("mean"), r6("stage2_lpips_std").alias("std"), told.alias("statuses"), F.col("source_pipeline_status").alias("source_status"),
    )


@query(
    """WITH v AS (SELECT DISTINCT 'cat' || (p_partkey % 23) AS category, 'o' || p_size AS object FROM part WHERE p_size <= 1 + (p_partkey % 23) // 2),
    s AS (SELECT category, count(*) AS size, list(object) AS objs FROM v GROUP BY 1),
    e AS (SELECT o_custkey AS plan_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position, o_orderkey % 3 = 0 AS ac, o_orderkey % 4 <> 0 AS ao, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 31 <> 0 OR o_orderkey % 42 = 0 THEN 'cat' || (o_orderkey % 25) END AS name,
      CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 5 <> 0 OR o_orderkey % 37 = 0 THEN ['o' || (o_orderkey % 7), 'o' || (1 + o_orderkey % 11)] END AS objects, 1 + (o_orderkey * 13) % 9 AS n FROM orders),
    k AS (SELECT e.*, size, list_filter(objects, lambda o: NOT list_contains(objs, o)) AS bad FROM e LEFT JOIN s ON s.category = name),
    f AS (SELECT plan_id, position, unnest([[CASE WHEN ac AND NOT ao THEN 'random category without random object' END], [CASE WHEN ac AND name IS NOT NULL THEN 'category_name not allowed' END], [CASE WHEN ac AND objects IS NOT NULL THEN 'objects not allowed' END], [CASE WHEN NOT ac AND name IS NULL THEN 'category_name required' END], [CASE WHEN NOT ac AND name IS NOT NULL AND size IS NULL THEN 'unknown category' END],
      [CASE WHEN NOT ac AND size IS NOT NULL AND ao AND objects IS NOT NULL THEN 'objects not allowed' END], [CASE WHEN NOT ac AND ao AND n > size THEN 'object_count exceeds the category' END], [CASE WHEN NOT ac AND size IS NOT NULL AND NOT ao AND objects IS NULL THEN 'objects required' END], [CASE WHEN NOT ac AND size IS NOT NULL AND NOT ao AND n <> len(objects) THEN 'object_count differs from objects' END],
      [CASE WHEN NOT ac AND size IS NOT NULL AND NOT ao AND objects[1] = objects[2] THEN 'duplicate objects' END], [CASE WHEN NOT ac AND size IS NOT NULL AND NOT ao AND len(bad) > 0 THEN 'unknown objects' END]]) AS told, unnest(range(11)) AS rule FROM k),
    own AS (SELECT plan_id, string_agg('categories[' || position || ']: ' || told[1], ';' ORDER BY position, rule) AS own FROM f WHERE told[1] IS NOT NULL GROUP BY plan_id),
    p AS (SELECT plan_id, count(name) FILTER (WHERE NOT ac) AS named, count(DISTINCT name) FILTER (WHERE NOT ac) AS dist, count(*) FILTER (WHERE ac) AS rnd FROM e GROUP BY plan_id),
    h AS (SELECT a.plan_id, max(a.n) AS demand FROM (SELECT DISTINCT plan_id, n FROM e WHERE ac) a WHERE (SELECT count(*) FROM e b WHERE b.plan_id = a.plan_id AND b.ac AND b.n >= a.n) > (SELECT count(*) FROM s WHERE size >= a.n AND category NOT IN (SELECT name FROM e c WHERE c.plan_id = a.plan_id AND NOT c.ac AND c.name IS NOT NULL)) GROUP BY a.plan_id)
    SELECT plan_id, concat_ws(';', own, CASE WHEN named > dist THEN 'duplicate category_name' END, CASE WHEN dist + rnd > (SELECT count(*) FROM s) THEN 'more entries than categories' END, CASE WHEN demand IS NOT NULL THEN 'no category left for object_count=' || demand END) AS faults FROM p LEFT JOIN own USING (plan_id) LEFT JOIN h USING (plan_id)"""
)
def plan_feasibility(t: Tables) -> DataFrame:
    """every customer's orders as a plan, against categories of parts."""
    k = F.col("o_orderkey")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    words = t.part.filter("p_size <= 1 + (p_partkey % 23) div 2").select(text("cat", F.col("p_partkey") % 23).alias("category"), text("o", F.col("p_size")).alias("object"))
    entries = t.orders.select(
        F.col("o_custkey").alias("plan_id"), (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("position"), (k % 3 == 0).alias("random_category"), (k % 4 != 0).alias("random_object"),
        F.when((k % 3 != 0) & (k % 31 != 0) | (k % 42 == 0), text("cat", k % 25)).alias("category_name"), F.when((k % 4 == 0) & (k % 5 != 0) | (k % 37 == 0), F.array(text("o", k % 7), text("o", 1 + k % 11))).alias("objects"), (1 + k * 13 % 9).cast("int").alias("object_count"),
    )
    return feasibility.plan_faults(entries, words).select("plan_id", F.array_join("faults", ";").alias("faults"))


@query()
def assigned_categories(t: Tables) -> DataFrame:
    """Every supplier's parts as a plan of random categories; the choice is by hash, so
    tests hold it against the rule, not SQL."""
    words = t.part.select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("object"))
    most = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    entries = t.lineitem.groupBy("l_suppkey", (F.col("l_partkey") % 11).alias("slot")).agg(F.max_by("l_quantity", most).alias("q"))
    plans = entries.select(F.col("l_suppkey").alias("plan_id"), F.col("slot").cast("int").alias("position"), F.lit(True).alias("random_category"), F.lit(None).cast("string").alias("category_name"), (F.col("q") % 4 + 1).cast("int").alias("object_count"))
    return feasibility.assigned(plans, words, seed=7)


_PAIRS = """WITH d AS (SELECT event_id AS id, 's' || (user_id % 40) AS src, 'e' || (event_id % 60) AS edit, event_type, user_id, nullif(event_id % 11, 0) AS score, CAST(ts AS VARCHAR) AS made_at FROM events),
    k AS (SELECT * FROM d WHERE id % 17 <> 0 AND score <= 8 QUALIFY row_number() OVER (PARTITION BY src, edit ORDER BY made_at DESC, id) = 1),
    r AS (SELECT *, CAST(substr(src, 2) AS INT) AS s, CAST(substr(edit, 2) AS INT) AS e, CASE WHEN s % 9 = 4 THEN 'source_glb_missing' WHEN (s + e) % 7 = 3 THEN 'target_glb_missing' WHEN s % 8 = 5 THEN 'source_views_incomplete' WHEN (s * e) % 6 = 1 THEN 'edited_views_incomplete' END AS lacks FROM k)"""


def _pairs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as edit records of 40 sources and 60 edits, and the files that there are."""
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    src, edit = F.col("user_id") % 40, F.col("event_id") % 60
    target = F.when(F.col("event_id") % 17 != 0, F.concat(text("s", src), text("_edit_e", edit)))
    records = t.events.select(
        F.col("event_id").alias("line"), text("s", src).alias("source_model_id"), text("e", edit).alias("edit_id"), target.alias("target_model_id"), F.lit("p").alias("source_provider_id"), F.nullif(F.col("event_id") % 11, F.lit(0)).cast("double").alias("stage2_score"),
        F.col("ts").cast("string").alias("created_at"), F.when(F.col("event_type") == "view", F.col("event_type")).alias("category"), F.col("event_type").alias("object_name"), F.lit("Remove it").alias("instruction_text"), F.lit("stage2_passed").alias("final_status"),
    )
    s, e = F.col("s"), F.col("e")
    pairs = t.events.select(src.alias("s"), edit.alias("e")).distinct()
    views = F.array(*[F.lit(f"{v}.png") for v in ("front", "back", "right", "left", "top", "bottom")])
    at = lambda dir_, short: F.transform(F.when(short, F.slice(views, 1, 5)).otherwise(views), lambda v: F.concat(dir_, F.lit("/"), v))
    files = F.concat(
        F.when(s % 9 != 4, F.array(F.concat(text("models_src/s", s), F.lit("/model_p.glb")))).otherwise(F.array().cast("array<string>")),
        F.when((s + e) % 7 != 3, F.transform(F.array(F.lit("z"), F.lit("t")), lambda m: F.concat(text("models_src/s", s), text("_edit_e", e), F.lit("/model_"), m, F.lit(".glb")))).otherwise(F.array().cast("array<string>")),
        at(F.concat(text("triplets/s", s), F.lit("/views/p")), s % 8 == 5),
        at(F.concat(text("triplets/s", s), text("/edited/e", e)), s * e % 6 == 1),
    )
    images = pairs.select(text("s", s).alias("model_id"), F.lit("cat").alias("category"), F.lit("other").alias("object_name")).distinct()
    return records, pairs.select(F.explode(files).alias("path")).distinct(), images


@query(_PAIRS + """ SELECT src AS model_id, edit AS edit_id, CASE WHEN event_type = 'view' THEN event_type ELSE 'cat' END AS category, event_type AS object_name, 't' AS target_provider_id, 'models_src/' || src || '/model_p.glb' AS source_glb, 'models_src/' || src || '_edit_' || edit || '/model_t.glb' AS target_glb, CAST(score AS DOUBLE) AS score FROM r WHERE lacks IS NULL""")
def record_candidates(t: Tables) -> DataFrame:
    """Candidates of an export from edit records."""
    rows, _ = exports.record_candidates(*_pairs(t), most=8.0)
    return rows.select("model_id", "edit_id", "category", "object_name", "target_provider_id", "source_glb", "target_glb", F.col("stage2_score").alias("score"))


@query(_PAIRS + """, c AS (SELECT coalesce(lacks, 'kept') AS what, count(*) AS n FROM r GROUP BY 1 UNION ALL SELECT 'pairs', count(*) FROM r)
    SELECT w AS what, coalesce(n, 0) AS n FROM (SELECT unnest(['pairs', 'kept', 'source_glb_missing', 'target_glb_missing', 'source_views_incomplete', 'edited_views_incomplete']) AS w) LEFT JOIN c ON what = w""")
def candidate_counters(t: Tables) -> DataFrame:
    """How many pairs were kept, and what others lacked first, as observed in the pass that
    computes the candidates."""
    rows, counters = exports.record_candidates(*_pairs(t), most=8.0)
    rows.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame(list(counters.get.items()), "what string, n long")


@query(
    """WITH s AS (SELECT vec_id, map_from_entries(list_filter([{'k': 'front', 'v': embedding[1]}, {'k': 'left', 'v': embedding[2]}, {'k': 'back', 'v': embedding[3]}, {'k': 'right', 'v': embedding[4]}, {'k': 'top', 'v': embedding[5]}, {'k': 'bottom', 'v': embedding[6]}], lambda e: vec_id % 3 <> 0 OR e.k IN ('left', 'right') OR abs(e.v) > 0.1)) AS m, vec_id % 3 <> 0 AS sel, CAST(embedding[5] AS DOUBLE) - CAST(embedding[1] AS DOUBLE) > 0.05 AND vec_id % 5 < 3 AS up FROM embeddings),
    b AS (SELECT *, list_sort(list_filter([{'s': -coalesce(m['front'], -9), 'i': 0, 'k': 'front'}, {'s': -coalesce(m['left'], -9), 'i': 1, 'k': 'left'}, {'s': -coalesce(m['back'], -9), 'i': 2, 'k': 'back'}, {'s': -coalesce(m['right'], -9), 'i': 3, 'k': 'right'}, {'s': -coalesce(m['top'], -9), 'i': 4, 'k': 'top'}, {'s': -coalesce(m['bottom'], -9), 'i': 5, 'k': 'bottom'}], lambda e: e.s < 9))[1].k AS best FROM s)
    SELECT vec_id, CASE WHEN sel THEN CASE WHEN up THEN 'top' ELSE 'front' END WHEN m['front'] IS NOT NULL THEN 'front' ELSE best END AS front, CASE WHEN sel THEN CASE WHEN up THEN 'bottom' ELSE 'back' END WHEN m['back'] IS NOT NULL THEN 'back' END AS back, CASE WHEN sel AND up THEN 'bottom' ELSE 'top' END AS virtual_up, CASE WHEN sel AND up THEN '0,270,180,90' ELSE '0,0,0,0' END AS turns, CASE WHEN sel OR m['back'] IS NOT NULL THEN 4 ELSE 3 END AS views FROM b"""
)
def view_plans(t: Tables) -> DataFrame:
    """Which view goes into each slot, with and without selection."""
    names = F.array(*map(F.lit, ("front", "left", "back", "right", "top", "bottom")))
    every = F.map_from_arrays(names, F.transform(F.slice("embedding", 1, 6), lambda x: x.cast("double")))
    selects = F.col("vec_id") % 3 != 0
    scores = F.map_filter(every, lambda k, v: selects | k.isin("left", "right") | (F.abs(v.cast("float")) > 0.1))
    plan = metrics.view_plan(scores, selects, F.lit("entropy_edge"), F.lit(0.05), F.col("vec_id") % 5 < 3)
    rows = t.embeddings.select("vec_id", plan.alias("p"))
    return rows.select("vec_id", F.col("p.slots")["front"].alias("front"), F.col("p.slots")["back"].alias("back"), "p.virtual_up", F.array_join(F.transform(F.array(*map(F.lit, metrics.SLOTS)), lambda s: F.col("p.turns")[s].cast("string")), ",").alias("turns"), F.col("p.input_count").alias("views"))


@query(
    """WITH v AS (SELECT DISTINCT 'cat' || (p_partkey % 23) AS category, 'o' || p_size AS object FROM part), s AS (SELECT category, count(*) AS size FROM v GROUP BY 1),
    p AS (SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN '' ELSE 'cat' || (o_orderkey % 25) END AS name, 'o' || (1 + o_orderkey % 50) AS a, 'o' || (1 + o_custkey % 50) AS b, CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE 2 - o_orderkey % 6 % 3 END AS n FROM orders),
    q AS (SELECT p.*, s.size, coalesce(name, '') <> '' AND s.size IS NOT NULL AS known FROM p LEFT JOIN s ON s.category = name),
    e AS (SELECT k, list_filter([CASE WHEN k % 7 = 0 THEN 'name is required' WHEN k % 7 = 1 THEN 'name has a path' END, CASE WHEN k % 5 = 0 THEN 'source_provider is unknown' END, CASE WHEN k % 5 = 1 THEN 'target_provider is required' END, CASE WHEN k % 3 = 0 THEN 'edit_mode is unknown' END, CASE WHEN k % 11 = 0 THEN 'deprecated fields: category_workers' END,
      CASE WHEN k % 4 <> 0 THEN 'categories[0]: deprecated fields: style_ids' END, CASE WHEN k % 13 = 0 THEN 'categories[0]: random must be a mapping' END,
      CASE WHEN k % 13 <> 0 AND n < 1 THEN 'categories[0]: object_count must be positive' END, CASE WHEN k % 13 <> 0 AND k % 8 = 1 THEN 'categories[0]: instruction_plan.mode must be adaptive_k' WHEN k % 13 <> 0 AND k % 8 = 2 THEN 'categories[0]: instruction_plan is required' END,
      CASE WHEN k % 13 <> 0 AND coalesce(name, '') = '' THEN 'categories[0]: category_name required' WHEN k % 13 <> 0 AND NOT known THEN 'categories[0]: unknown category' END, CASE WHEN k % 13 <> 0 AND known AND n <> 2 THEN 'categories[0]: object_count differs from objects' END,
      CASE WHEN k % 13 <> 0 AND known AND a = b THEN 'categories[0]: duplicate objects' END, CASE WHEN k % 13 <> 0 AND known AND (NOT EXISTS (SELECT 1 FROM v WHERE category = name AND object = a) OR NOT EXISTS (SELECT 1 FROM v WHERE category = name AND object = b)) THEN 'categories[0]: unknown objects' END], lambda x: x IS NOT NULL) AS errors FROM q)
    SELECT k, array_to_string(errors, ';') AS errors FROM e"""
)
def plan_form_errors(t: Tables) -> DataFrame:
    """Every order as the JSON of a plan with one fixed category."""
    k, text = F.col("o_orderkey"), lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    name = F.when(k % 29 == 0, F.lit(None).cast("string")).when(k % 31 == 0, "").otherwise(text("cat", k % 25))
    count = F.when(k % 6 == 0, 0).otherwise(2 - k % 6 % 3)
    made = F.when(k % 8 != 2, F.struct(F.when(k % 8 == 1, "fixed").otherwise("adaptive_k").alias("mode"), F.lit(2).alias("count"), F.array(F.lit("remove")).alias("allowed_types")))
    category = F.struct(
        name.alias("category_name"), F.when(k % 13 != 0, F.struct(F.lit(False).alias("category"), F.lit(False).alias("object"))).alias("random"), F.array(text("o", 1 + k % 50), text("o", 1 + F.col("o_custkey") % 50)).alias("objects"),
        count.cast("int").alias("object_count"), made.alias("instruction_plan"), F.when(k % 4 != 0, F.array(F.lit("s"))).alias("style_ids"),
    )
    plan = F.struct(
        F.when(k % 7 == 0, " ").when(k % 7 == 1, "a/b").otherwise("plan").alias("name"), F.when(k % 5 == 0, "other").otherwise("tripo").alias("source_provider"), F.when(k % 5 != 1, "rodin").alias("target_provider"),
        F.when(k % 3 == 0, "triple").otherwise("single").alias("edit_mode"), F.when(k % 11 == 0, 3).alias("category_workers"), F.array(category).alias("categories"),
    )
    words = t.part.select(text("cat", F.col("p_partkey") % 23).alias("category"), text("o", F.col("p_size")).alias("object")).distinct()
    plans = t.orders.select(k.alias("plan_id"), F.to_json(plan).alias("plan"))
    return plan_rules.plan_form_errors(plans, words).select(F.col("plan_id").alias("k"), F.array_join("errors", ";").alias("errors"))


_REFRESH = """WITH m AS (SELECT 'c' || c_custkey AS model_id, c_custkey AS c, c_custkey % 7 <> 0 AS dir FROM customer),
    e AS (SELECT model_id, dir, o_orderkey AS k, 'o' || o_orderkey AS edit_id, o_orderkey % 5 <> 0 AS meta, o_orderkey % 4 <> 0 AS tdir, o_orderkey % 9 <> 0 AS glb FROM m JOIN orders ON o_custkey = c),
    g AS (SELECT *, unnest(CASE WHEN meta AND tdir AND glb THEN ['tp3', 'zz'] ELSE [NULL] END) AS pid FROM e WHERE dir),
    r AS (SELECT model_id, edit_id, CASE WHEN meta THEN model_id || '_edit_' || edit_id END AS target_model_id, CASE WHEN pid = 'tp3' THEN 'tripo' END AS provider, pid AS provider_id,
      CASE WHEN NOT meta THEN 'edit meta not found' WHEN NOT tdir THEN 'target model directory not found' WHEN pid IS NULL THEN 'target GLB not found' WHEN pid = 'zz' THEN 'unsupported provider id' {views} END AS reason FROM g),
    b AS (SELECT model_id, CASE WHEN NOT dir THEN 'model directory not found' WHEN NOT EXISTS (SELECT 1 FROM e WHERE e.model_id = m.model_id) THEN 'no edited batches found' ELSE 'no refreshable targets found' END AS reason FROM m WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.model_id = m.model_id AND reason IS NULL))
    SELECT * FROM r UNION ALL SELECT model_id, NULL, NULL, NULL, NULL, reason FROM b"""


def _listing(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers as models, their orders as edits, and the files that there are."""
    k = F.col("o_orderkey")
    model, edit = F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.concat(F.lit("o"), k.cast("string"))
    target = F.concat(model, F.lit("_edit_"), edit)
    at = lambda *p: F.concat_ws("/", *[F.lit(x) if isinstance(x, str) else x for x in p])
    paths = F.array(
        at("triplets", model, "edited", edit, "front.png"), F.when(k % 5 != 0, at("triplets", model, "edited", edit, "meta.json")), F.when(k % 4 != 0, at("models_src", target, "meta.json")), F.when((k % 4 != 0) & (k % 9 != 0), at("models_src", target, "model_tp3.glb")),
        F.when((k % 4 != 0) & (k % 9 != 0), at("models_src", target, "model_zz.glb")), F.when(k % 11 != 0, at("triplets", target, "views", "tp3", "front.png")), at("triplets", model, "edited", edit, "logs", "back.png"),
    )
    files = t.orders.select(F.explode(F.array_compact(paths)).alias("path"))
    own = t.customer.filter("c_custkey % 7 <> 0").select(F.concat(F.lit("models_src/c"), F.col("c_custkey").cast("string"), F.lit("/model_tp3.glb")).alias("path"))
    return t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("model_id")), files.unionByName(own)


@query(_REFRESH.format(views="WHEN k % 11 = 0 THEN 'target render views not found'"))
def refresh_targets(t: Tables) -> DataFrame:
    """Targets to be scored again, and why others aren't."""
    return refresh.refresh_targets(*_listing(t), {"tp3": "tripo", "hy3": "hunyuan"})


@query(_REFRESH.format(views=""))
def refresh_targets_undrawn(t: Tables) -> DataFrame:
    """The same without asking for drawn views."""
    return refresh.refresh_targets(*_listing(t), {"tp3": "tripo", "hy3": "hunyuan"}, rendered=False)


@query(
    """SELECT 'm' || o_custkey AS model_id, 'o' || o_orderkey AS edit_id, o_orderkey % 3 AS n, CASE WHEN o_orderkey % 4 = 0 THEN 'Missing meta.json' WHEN o_orderkey % 4 = 1 THEN 'Failed to read meta.json' WHEN o_orderkey % 3 <> 0 THEN 'Expected 6 png files, found ' || (6 - o_orderkey % 3) ELSE '' END AS reason, o_orderkey % 4 > 1 AND o_orderkey % 3 = 0 AS valid, CASE WHEN o_orderkey % 4 > 1 THEN 'Remove it' ELSE '' END AS instruction,
    CASE WHEN o_orderkey % 4 = 0 THEN 'edit meta not found' WHEN o_orderkey % 4 = 1 THEN 'edit meta invalid' WHEN o_orderkey % 5 <> 0 AND o_orderkey % 4 = 2 THEN 'mask already complete' END AS mask_reason FROM orders"""
)
def edit_folder_states(t: Tables) -> DataFrame:
    """Whether edits are whole, and which need masks."""
    k = F.col("o_orderkey")
    model, edit = F.concat(F.lit("m"), F.col("o_custkey").cast("string")), F.concat(F.lit("o"), k.cast("string"))
    views = ["front", "back", "right", "left", "top", "bottom"]
    # pictures are counted in a listing without masks
    names = F.concat(F.slice(F.array(*[F.lit(f"{v}.png") for v in views]), 1, (6 - k % 3).cast("int")), F.when(k % 4 != 0, F.array(F.lit("meta.json"))).otherwise(F.array().cast("array<string>")))
    files = t.orders.select(F.explode(F.transform(names, lambda n: F.concat(F.lit("triplets/"), model, F.lit("/edited/"), edit, F.lit("/"), n))).alias("path"))
    masks = t.orders.filter("o_orderkey % 5 <> 0").select(F.explode(F.array(*[F.concat(F.lit("triplets/"), model, F.lit("/edited/"), edit, F.lit(f"/{v}_mask.png")) for v in views], F.concat(F.lit("triplets/"), model, F.lit("/edited/"), edit, F.lit("/edit_mask_grid.png")))).alias("path"))
    text = F.when(k % 4 == 1, "{broken").when(k % 4 > 1, '{"instruction": " Remove it ", "a": 1}')
    metas = t.orders.select(model.alias("model_id"), edit.alias("edit_id"), text.alias("text"), F.map_from_arrays(F.array(*map(F.lit, views)), F.array_repeat(F.when(k % 4 == 2, "p").otherwise(""), 6)).alias("views"))
    whole = refresh.edit_status(files, metas)
    need = refresh.mask_targets(metas.select("model_id"), files.unionByName(masks), metas, F.col("views"), F.lit("grid"))
    out = whole.join(need.withColumnRenamed("reason", "mask_reason"), ["model_id", "edit_id"])
    return out.select("model_id", "edit_id", (6 - F.col("png_count")).alias("n"), "reason", "valid", F.when(F.col("reason").startswith("Failed"), "").otherwise(F.col("instruction")).alias("instruction"), "mask_reason")
