"""Queries of text rules, record fields and parsing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records, text
from ..operators import stats
from ..sources import readers
from .base import Tables, query


@query(
    """SELECT doc_id, CASE WHEN text = '' THEN 'empty' WHEN regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])(license|licensed)([^\\p{L}\\p{N}_]|$)') THEN 'license' WHEN contains(lower(text), 'apache') THEN 'apache'
    WHEN contains(text, '@') THEN 'contact' WHEN regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])und([^\\p{L}\\p{N}_]|$)') THEN 'german' END AS reason FROM documents"""
)
def instruction_rules(t: Tables) -> DataFrame:
    """the first rule that holds; the lists are parameters."""
    c = F.col("text")
    rules = [(c == "", "empty"), (text.has_word(c, ["license", "licensed"]), "license"), (text.has_phrase(c, ["apache"]), "apache"), (text.has_phrase(c, ["@"]), "contact"), (text.has_word(c, ["und"]), "german")]
    return t.documents.select("doc_id", text.first_reason(rules).alias("reason"))


@query("SELECT coalesce(r, 'valid') AS reason, count(*) AS n FROM (SELECT CASE WHEN p_size % 5 = 0 THEN 'forbidden_lateral' WHEN p_size % 5 = 1 THEN 'not_remove_or_replace' WHEN p_size % 5 = 2 THEN 'texture_edit' WHEN p_size % 5 = 3 THEN 'material_swap' END AS r FROM part) GROUP BY 1")
def legality_reasons(t: Tables) -> DataFrame:
    """Instructions made from part sizes."""
    said = F.element_at(F.array(*map(F.lit, ["Remove the left wheel", "Shrink the handle", "Replace the finish", "Replace the wooden leg with a metal leg", "Remove the lamp"])), (F.col("p_size") % 5 + 1).cast("int"))
    return t.part.select(F.coalesce(text.legality_reject_reason(said), F.lit("valid")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "SELECT doc_id, CAST("
    + " + ".join(f"CAST(regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){w}([^\\p{{L}}\\p{{N}}_]|$)') AS INT)" for w in ("that", "with", "this", "from"))
    + " AS INT) AS terms FROM documents"
)
def term_count(t: Tables) -> DataFrame:
    """F11."""
    return t.documents.select("doc_id", text.count_terms(F.col("text"), ["that", "with", "this", "from"]).alias("terms"))


@query("SELECT conv_id, turn, contains(lower(text), 'cannot') OR contains(lower(text), 'sorry') OR contains(lower(text), 'the') AS refused FROM conversations")
def refusal_flag(t: Tables) -> DataFrame:
    """F12."""
    return t.conversations.select("conv_id", "turn", text.is_refusal(F.col("text"), ["cannot", "sorry", "the"]).alias("refused"))


@query(
    """SELECT event_id, CASE WHEN value > 90 THEN 'api_server_error' WHEN value > 80 THEN 'api_http_error' WHEN event_type = 'error' AND k < 50 THEN 'api_timeout' WHEN event_type = 'error' THEN 'quality_check_execution_error'
    WHEN event_type = 'click' THEN 'quality_check_failed' WHEN k < 50 THEN 'api_timeout' WHEN event_type = 'view' THEN 'quality_check_failed' ELSE 'unknown' END AS class FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"""
)
def error_class(t: Tables) -> DataFrame:
    """F33."""
    k = F.get_json_object("props", "$.k").cast("int")
    message = F.when(k < 50, "Gateway Timeout").otherwise("other")
    code = F.when(F.col("value") > 90, 503).when(F.col("value") > 80, 404)
    status = F.when(F.col("event_type") == "error", "error_quality_check").when(F.col("event_type") == "click", "failed_quality")
    kind = F.when(F.col("event_type") == "view", "StageValidationFailed")
    return t.events.select("event_id", text.stage_error_class(message, kind, code, status).alias("class"))


@query("SELECT event_id, CASE user_id % 5 WHEN 0 THEN 'quota_limit' WHEN 1 THEN 'subject_too_small' WHEN 2 THEN 'upload_error' WHEN 3 THEN 'provider_failed' ELSE 'unknown' END AS class FROM events")
def target_error_class(t: Tables) -> DataFrame:
    """F32."""
    said = F.element_at(F.array(*map(F.lit, ["RequestLimitExceeded.JobNumExceed", "主体占比值低于阈值", "Upload broke", "status=FAILED", " "])), (F.col("user_id") % 5 + 1).cast("int"))
    return t.events.select("event_id", text.target_error_class(said).alias("class"))


@query("SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) = 1")
def keep_default(t: Tables) -> DataFrame:
    """F22."""
    rows = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")
    return rows.filter(F.coalesce("quality", F.lit(1)) == 1).select("doc_id", "source")


@query("SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang, regexp_extract(url, '[?&]page=([0-9]+)', 1) AS page FROM pages")
def url_fields(t: Tables) -> DataFrame:
    """S25."""
    at = lambda p: F.regexp_extract("url", p, 1)
    return t.pages.select("page_id", at("^https?://([^/?#]+)").alias("host"), at("^https?://[^/]+/([a-z]{2})/").alias("lang"), at("[?&]page=([0-9]+)").alias("page"))


@query("SELECT event_id, 'run ' || event_type AS said FROM events")
def log_fields(t: Tables) -> DataFrame:
    """A field with spaces in its value, out of a log line."""
    line = F.concat(F.lit("id="), F.col("event_id"), F.lit(" said=run "), F.col("event_type"), F.lit(" k="), F.col("user_id"))
    return t.events.select("event_id", text.log_field(line, "said").alias("said"))


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS k FROM events")
def json_field(t: Tables) -> DataFrame:
    """Fenced, padded and broken replies."""
    reply = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("{"), F.col("props"))).when(F.col("user_id") % 3 == 1, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).otherwise(F.concat(F.lit("Here: "), F.col("props"), F.lit(" done")))
    v = F.from_json(text.greedy_object(text.unfenced(reply)), "k int")
    return t.events.select("event_id", v["k"].alias("k"))


@query("SELECT conv_id, turn, lower(trim(CASE WHEN turn % 2 = 0 THEN role END)) AS answer FROM conversations")
def answer_tags(t: Tables) -> DataFrame:
    """T07."""
    said = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("so <Answer>\n"), F.upper("role"), F.lit("\n</ANSWER> end"))).otherwise("none")
    return t.conversations.select("conv_id", "turn", F.btrim(text.answer_tag(said), F.lit("\n ")).alias("answer"))


@query("SELECT event_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'm' || user_id || '_edit_' || event_type END AS source_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'e' || event_id END AS edit_id FROM events")
def target_id_parse(t: Tables) -> DataFrame:
    """P32, P33."""
    source = F.concat(F.lit("m"), "user_id", F.lit("_edit_"), "event_type")
    target = F.when(F.col("user_id") % 4 == 0, F.lit("_edit_x")).otherwise(records.target_id(source, F.concat(F.lit("e"), "event_id")))
    return t.events.select("event_id", records.target_parts(target).alias("p")).select("event_id", "p.source_id", "p.edit_id")


@query("SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'A' THEN 'stage1_failed' WHEN l_linestatus = 'O' THEN 'target_render_failed' WHEN l_returnflag = 'N' THEN 'stage2_passed' ELSE 'stage2_failed' END AS final_status, CASE WHEN l_returnflag = 'A' THEN 'stage1_failed' WHEN l_linestatus = 'O' THEN 'target_render_failed' WHEN l_returnflag = 'N' THEN NULL ELSE 'stage2_failed' END AS exclusion_reason, count(*) AS n FROM lineitem GROUP BY ALL")
def final_status(t: Tables) -> DataFrame:
    """P28."""
    flag, f = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    s1 = F.when(flag == "A", "error_quality_check").otherwise("passed")
    s2 = F.when(f & (flag == "N"), "passed").when(f, "failed_quality")
    rows = t.lineitem.withColumn("final_status", records.final_status(s1, s2, F.lit(False), F.lit(True)))
    rows = rows.withColumn("exclusion_reason", records.exclusion_reason(F.col("final_status")))
    return rows.groupBy("l_returnflag", "l_linestatus", "final_status", "exclusion_reason").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'relabel_passed' WHEN 'O' THEN 'original_passed' ELSE 'legacy' END AS status, CASE o_orderstatus WHEN 'F' THEN 'new text' ELSE 'old text' END AS shown, CASE o_orderstatus WHEN 'F' THEN 'relabel' ELSE 'original' END AS source FROM orders")
def display_payload(t: Tables) -> DataFrame:
    """P16-P20."""
    none = F.lit(None).cast("string")
    f = F.col("o_orderstatus") == "F"
    p = records.display_payload(F.lit(" old text "), F.when(f, "new text"), F.when(f, "new text"), F.when(F.col("o_orderstatus") != "P", "passed"), none.cast("boolean"), none, none, none, F.lit(False))
    return t.orders.select("o_orderkey", p["instruction_display_status"].alias("status"), p["instruction_display_text"].alias("shown"), p["instruction_display_source"].alias("source"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS score, trim(lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g')), '-') AS slug FROM part")
def safe_fields(t: Tables) -> DataFrame:
    """P42, P44."""
    said = F.when(F.col("p_size") % 3 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", records.safe_float(said).alias("score"), text.slug(F.col("p_name"), "object").alias("slug"))


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) = 3 AS complete FROM orders GROUP BY 1")
def view_completeness(t: Tables) -> DataFrame:
    """F20, F34, F35."""
    sets = t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("v"))
    return sets.select("o_custkey", records.views_complete(records.known_views(F.col("v"), ["F", "O", "P"]), ["F", "O", "P"]).alias("complete"))


@query(
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'data/' || page_id WHEN 1 THEN 'pipeline/' || page_id ELSE '/else/' || page_id END AS rel, CASE page_id % 3 WHEN 0 THEN '/srv/app/data/pipeline/' || page_id WHEN 1 THEN '/big/pipe/' || page_id ELSE '/else/' || page_id END AS abs,
    CASE page_id % 3 WHEN 0 THEN 'hunyuan' WHEN 1 THEN 'xhy3' ELSE 'tp3' END AS provider, CASE WHEN page_id % 3 = 0 THEN 'chair_' || page_id ELSE 'chair_' || page_id || '_e7a' END AS name, CASE WHEN page_id % 3 = 0 THEN '7a' END AS variant, page_id % 3 = 1 AS source FROM pages"""
)
def relative_paths(t: Tables) -> DataFrame:
    """P01, P02, P03, P34."""
    i, s = F.col("page_id") % 3, F.col("page_id").cast("string")
    pick = lambda *c: F.element_at(F.array(*c), (i + 1).cast("int"))
    lit = lambda x: F.concat(F.lit(x), s)
    image = F.concat(pick(F.lit("a/edited_dir/chair_"), F.lit("a/source_dir/chair_"), F.lit("b/chair_")), s, F.lit("_e7a.png"))
    parts = records.image_path_parts(image, "edited_dir", "source_dir")
    return t.pages.select(
        "page_id",
        records.relative_path(pick(lit("/srv/app/data/"), lit("/big/pipe/"), lit("/else/")), "/srv/app", "/big/pipe").alias("rel"),
        records.absolute_path(pick(lit("data/pipeline/"), lit("pipeline/"), lit("/else/")), "/srv/app", "/big/pipe").alias("abs"),
        records.provider_of(pick(F.lit("m/model_hy3.glb"), F.lit("m/xmodel_hy3.glb"), F.lit("m/model_tp3.glb")), {"hy3": "hunyuan"}).alias("provider"),
        parts["name"].alias("name"), parts["variant_id"].alias("variant"), parts["is_source"].alias("source"),
    )


@query("SELECT 'kept' AS class, count(*) AS count FROM events WHERE user_id % 2 = 0 UNION ALL SELECT 'rejected', count(*) FROM events WHERE user_id % 2 = 1")
def tolerant_parse(t: Tables) -> DataFrame:
    """Good and bad lines of JSON."""
    line = F.when(F.col("user_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("!"), F.col("props")))
    ok = F.from_json(line, "k int, _bad string", {"columnNameOfCorruptRecord": "_bad"})["_bad"].isNull()
    return stats.group_counts(t.events.select(F.when(ok, "kept").otherwise("rejected").alias("class")), ["class"])


@query("SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 4 <> 0")
def source_ids(t: Tables) -> DataFrame:
    """S14, S15, S23."""
    ids = t.orders.select(F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 4 == 0, "_edit_1").otherwise("")).alias("id"))
    return readers.source_ids(ids)
