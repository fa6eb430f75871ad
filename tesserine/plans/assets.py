"""Queries of manifests, index entries, quality records, views and clean-up, on records made
from the driver tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics, payloads
from ..operators import dedup
from .base import Tables, listed, query


@query(
    """SELECT 'triplets' AS schema, CASE WHEN p_partkey % 3 > 0 THEN 's' || p_partkey || '_edit_e' || p_size WHEN p_size % 2 = 0 THEN 't' || p_size ELSE 'unknown' END AS id FROM part
    UNION ALL SELECT 'samples', CASE WHEN p_size % 3 = 0 THEN 'a' || p_partkey WHEN p_size % 3 = 1 THEN 'm' || p_size ELSE 'unknown' END FROM part
    UNION ALL SELECT 'samples', 't' || p_partkey FROM part"""
)
def manifest_ids(t: Tables) -> DataFrame:
    """P30, P31."""
    p = t.part.withColumns({c: F.col(c).cast("string") for c in ("p_partkey", "p_size")})
    key, size = F.col("p_partkey"), F.col("p_size")
    name = lambda prefix, c: F.concat(F.lit(prefix), c)
    triplet = F.struct(F.when(key.cast("long") % 3 > 0, name("s", key)).otherwise("").alias("source_model_id"), name("e", size).alias("edit_id"), F.when(size.cast("int") % 2 == 0, name("t", size)).alias("target_model_id"))
    first = F.struct(F.when(size.cast("int") % 3 == 0, name("a", key)).alias("sample_id"), F.lit("").alias("target_model_id"), F.when(size.cast("int") % 3 == 1, name("m", size)).alias("model_id"))
    second = F.struct(F.lit(None).cast("string").alias("sample_id"), name("t", key).alias("target_model_id"), F.lit("no").alias("model_id"))
    out = None
    for manifest in (p.select(F.array(triplet).alias("triplets")), p.select(F.array(first, second).alias("samples"))):
        items = payloads.manifest_items(manifest)
        fields = items.schema["item"].dataType.names
        part = items.select("schema", payloads.item_id(F.col("schema"), {f: F.col("item")[f] for f in fields}).alias("id"))
        out = part if out is None else out.union(part)
    return out


@query(
    """SELECT o_orderkey AS id, o_orderkey % 2 = 1 AS has_edits, o_orderkey % 7 > 0 AS has_views, CAST(o_orderkey % 5 AS BIGINT) AS edit_count, CASE o_orderkey % 4 WHEN 0 THEN 'a,b' ELSE '' END AS batches,
    o_orderkey % 2 = 1 AND o_orderkey % 3 < o_orderkey % 5 AS edits_without_target FROM orders"""
)
def index_entries(t: Tables) -> DataFrame:
    """P45."""
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, '["b", "a"]').when(k % 4 == 1, "not a list").when(k % 4 == 2, "")
    entry = payloads.index_entry({"id": k, "has_views": k % 7, "has_instructions": F.lit(None).cast("int"), "has_edits": k % 2, "edit_count": k % 5, "target_ready_count": k % 3, "edited_batches_json": text})
    e = t.orders.select(entry.alias("e")).select("e.*")
    return e.select("id", "has_edits", "has_views", F.col("edit_count").cast("long").alias("edit_count"), listed("edited_batches").alias("batches"), "edits_without_target")


@query(
    """WITH x AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'grid_vlm' WHEN 1 THEN 'two_stage_recon' ELSE 'unified_judge' END AS method, o_orderstatus <> 'F' AS ran, o_orderpriority AS p FROM orders)
    SELECT o_orderkey, method, CASE WHEN ran THEN 'failed_quality' ELSE 'passed' END AS status, CASE WHEN ran THEN p ELSE 'quality check disabled' END AS reason, CASE WHEN ran AND method = 'grid_vlm' THEN 'raw' END AS raw,
    CASE WHEN ran AND method <> 'grid_vlm' THEN p END AS policy, CASE WHEN ran AND method = 'two_stage_recon' THEN 'd' END AS diff, CASE WHEN ran AND method = 'unified_judge' THEN 'u' END AS unified FROM x"""
)
def quality_records(t: Tables) -> DataFrame:
    """P41."""
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    method = F.when(k % 3 == 0, "grid_vlm").when(k % 3 == 1, "two_stage_recon").otherwise("unified_judge")
    result = F.when(F.col("o_orderstatus") != "F", F.struct(F.lit("failed_quality").alias("status"), p.alias("reason"), F.lit("raw").alias("raw_response")))
    detail = {"view_policy": p, "diff_result": F.lit("d"), "judge_result": F.lit("j"), "unified_result": F.lit("u")}
    q = t.orders.select("o_orderkey", payloads.quality_meta(F.lit(True), method, F.lit("m"), result, detail, F.lit("2024"), F.lit(None).cast("string")).alias("q"))
    d = "q.stage_edit_correctness."
    return q.select("o_orderkey", "q.method", "q.status", "q.reason", F.col("q.raw_response").alias("raw"), F.col(d + "view_policy").alias("policy"), F.col(d + "diff_result").alias("diff"), F.col(d + "unified_result").alias("unified"))


@query(
    """SELECT vec_id, CASE label % 7 WHEN 0 THEN '1,0,0,0,1,0,0,0,1' WHEN 1 THEN '-1,0,0,0,-1,0,0,0,1' WHEN 2 THEN '0,1,0,-1,0,0,0,0,1' WHEN 3 THEN '0,-1,0,1,0,0,0,0,1' WHEN 4 THEN '1,0,0,0,0,-1,0,1,0' WHEN 5 THEN '-1,0,0,0,0,1,0,1,0' END AS matrix,
    label % 7 < 6 AS is_rotation, CASE WHEN vec_id % 9 = 0 THEN 'missing field' WHEN label % 7 = 6 THEN 'unknown side' WHEN vec_id % 9 < 3 THEN 'confidence too low' WHEN vec_id % 9 = 8 THEN 'confidence above 1' END AS fault FROM embeddings"""
)
def front_rotations(t: Tables) -> DataFrame:
    """Matrices worked out by hand."""
    side = F.element_at(F.array(*map(F.lit, ("front", "back", "left", "right", "top", "bottom", "above"))), (F.col("label") % 7 + 1).cast("int"))
    turn = metrics.front_rotation(side)
    confidence = F.when(F.col("vec_id") % 9 > 0, F.col("vec_id") % 9 / 7.0)
    matrix = F.array_join(F.transform(F.flatten(turn), lambda x: x.cast("int").cast("string")), ",")
    return t.embeddings.select("vec_id", matrix.alias("matrix"), metrics.is_rotation(turn).alias("is_rotation"), metrics.decision_fault(side, confidence, F.lit(" r "), 0.4).alias("fault"))


@query(
    """WITH x AS (SELECT p_partkey, p_size % 2 = 0 AS f, p_size % 3 = 0 AS l, p_size % 5 AS b, p_size % 7 AS t FROM part)
    SELECT p_partkey, CASE WHEN f THEN 'front' WHEN l AND t <= 4 THEN 'left' WHEN NOT l AND b >= t THEN 'back' ELSE 'top' END AS front, CASE WHEN l THEN 'left' END AS left_slot, 'back' AS back_slot, CAST(NULL AS VARCHAR) AS right_slot FROM x"""
)
def slot_choice(t: Tables) -> DataFrame:
    """A left view scores 4, a back one p_size modulo 5, a top one modulo 7."""
    size = F.col("p_size")
    there = F.array_compact(F.array(*[F.when(on, F.struct(F.lit(v).alias("key"), s.cast("int").alias("value"))) for v, on, s in (("front", size % 2 == 0, F.lit(0)), ("left", size % 3 == 0, F.lit(4)), ("back", F.lit(True), size % 5), ("top", F.lit(True), size % 7))]))
    s = t.part.select("p_partkey", metrics.slot_views(F.map_from_entries(there)).alias("s"))
    return s.select("p_partkey", "s.front", F.col("s.left").alias("left_slot"), F.col("s.back").alias("back_slot"), F.col("s.right").alias("right_slot"))


@query(
    """WITH i AS (SELECT l_orderkey AS m, l_linenumber AS pos, l_linenumber % 3 AS kind, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 3 ORDER BY l_linenumber) AS rn FROM lineitem),
    k AS (SELECT m, pos FROM i WHERE n <= 4 OR kind > 0 AND rn <= 2)
    SELECT o_orderkey AS model_id, o_custkey AS edit_id, CASE WHEN o_orderkey % 4 = 0 THEN 'Incomplete: 5/6 views' ELSE 'Orphan: instruction not in kept list' END AS reason FROM orders
    WHERE o_orderkey % 4 = 0 OR o_custkey % 5 > 0 AND o_orderkey IN (SELECT m FROM k) AND NOT EXISTS (SELECT 1 FROM k WHERE m = o_orderkey AND pos = o_custkey % 7)"""
)
def edits_to_clean(t: Tables) -> DataFrame:
    """F19, F21."""
    kind = F.element_at(F.array(*map(F.lit, ("other", "remove", "replace"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    said = t.lineitem.select(F.col("l_orderkey").alias("model_id"), kind.alias("kind"), F.concat(F.lit(" t"), F.col("l_linenumber").cast("string")).alias("text"), F.col("l_linenumber").alias("pos"))
    k = F.col("o_custkey")
    edits = t.orders.select(F.col("o_orderkey").alias("model_id"), k.alias("edit_id"), F.when(F.col("o_orderkey") % 4 == 0, 5).otherwise(6).alias("png_count"), F.when(k % 5 > 0, F.concat(F.lit("t"), (k % 7).cast("string"))).otherwise("").alias("instruction"))
    return dedup.edits_to_delete(edits, said)


@query(
    """SELECT o_orderkey, trim(o_comment) AS text, CASE o_orderkey % 3 WHEN 0 THEN 'Shown' WHEN 1 THEN 'own' ELSE 'Shown' END AS item, 'Shown' AS instruction, o_orderstatus AS shown_status FROM (SELECT o_orderkey, o_orderstatus, '  ' || o_orderpriority || ' ' AS o_comment FROM orders)"""
)
def instruction_payloads(t: Tables) -> DataFrame:
    """P14, P15, T11."""
    k = F.col("o_orderkey")
    shown = F.struct(F.lit("Shown").alias("shown_text"), F.col("o_orderstatus").alias("shown_status"))
    own = F.when(k % 3 == 0, "").when(k % 3 == 1, "own")
    rows = t.orders.withColumn("instruction", F.lit("before"))
    item = F.struct(F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("text"))
    rows = payloads.with_display(rows, shown, "shown_text").withColumns({"text": payloads.instruction_text(item), "item": payloads.instruction_item(own, F.col("shown_text"))})
    return rows.select("o_orderkey", "text", "item", "instruction", "shown_status")
