"""Queries of statistics: a part is an object (brand its category), a line item an edit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions import records
from ..operators import stats
from .base import Tables, listed, query, r6


def objects(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("category"), F.col("p_type").alias("object_name"), "p_partkey")


def edits(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    flag, entered = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    return rows.select(
        F.col("p_brand").alias("category"),
        F.when(flag == "A", "failed_quality").otherwise("passed").alias("stage1_status"),
        entered.alias("entered_stage2"),
        F.when(entered & (flag == "N"), "passed").when(entered & (flag == "R"), "failed_quality").alias("stage2_status"),
        F.when(entered, F.col("l_discount")).alias("stage2_score"),
        F.when(flag == "R", "remove").when(flag == "N", "replace").alias("instruction_type"),
    )


_EDITS = """e AS (SELECT p_brand AS category, l_returnflag AS f, l_linestatus = 'F' AS entered, CASE WHEN l_linestatus = 'F' THEN l_discount END AS score
  FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT category, count(*) AS edit_attempts_total, count(*) FILTER (WHERE f = 'A') AS stage1_failed_count, count(*) FILTER (WHERE entered) AS stage2_entered_count,
  count(*) FILTER (WHERE entered AND f = 'N') AS stage2_passed_count, count(*) FILTER (WHERE entered AND f = 'R') AS stage2_failed_count,
  avg(score) AS m, stddev_pop(score) AS s, min(score) AS lo, max(score) AS hi,
  count(*) FILTER (WHERE f = 'R') AS n_remove, count(*) FILTER (WHERE f = 'N') AS n_replace, avg(score) FILTER (WHERE f = 'R') AS m_remove, avg(score) FILTER (WHERE f = 'N') AS m_replace
  FROM e GROUP BY category),
o AS (SELECT p_brand AS category, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS distinct_objects, count(*) AS sample_count FROM part GROUP BY p_brand)"""
_FUNNEL = """coalesce(edit_attempts_total, 0) AS edit_attempts_total, coalesce(stage1_failed_count, 0) AS stage1_failed_count, coalesce(stage2_entered_count, 0) AS stage2_entered_count,
  coalesce(stage2_passed_count, 0) AS stage2_passed_count, coalesce(stage2_failed_count, 0) AS stage2_failed_count, round(stage1_failed_count / edit_attempts_total, 6) AS stage1_failed_rate,
  round(stage2_entered_count / edit_attempts_total, 6) AS stage2_entered_rate, round(m, 6) AS score_mean, round(s, 6) AS score_std"""


@query(f"WITH {_EDITS} SELECT category, coalesce(distinct_objects, '') AS distinct_objects, coalesce(sample_count, 0) AS sample_count, {_FUNNEL} FROM o FULL JOIN g USING (category)")
def category_stats(t: Tables) -> DataFrame:
    """A01."""
    out = stats.category_stats(objects(t), edits(t))
    return out.withColumn("distinct_objects", listed("distinct_objects")).withColumns({c: r6(c) for c in ("stage1_failed_rate", "stage2_entered_rate", "score_mean", "score_std")})


@query(
    f"""WITH {_EDITS} SELECT category, distinct_objects, sample_count, {_FUNNEL}, lo AS score_min, hi AS score_max, coalesce(n_remove, 0) AS remove_attempts_total, coalesce(n_replace, 0) AS replace_attempts_total,
    CASE WHEN n_remove > 0 THEN CAST(0 AS DOUBLE) END AS remove_stage1_failed_rate, CASE WHEN n_replace > 0 THEN CAST(0 AS DOUBLE) END AS replace_stage1_failed_rate, round(m_remove, 6) AS remove_score_mean, round(m_replace, 6) AS replace_score_mean,
    round(stage2_failed_count / nullif(stage2_entered_count, 0), 6) AS stage2_failed_rate FROM o LEFT JOIN g USING (category)"""
)
def category_stats_objects_only(t: Tables) -> DataFrame:
    """A02."""
    out = stats.category_stats_of_objects(objects(t), edits(t))
    rates = [c for c in out.columns if c.endswith(("_rate", "_mean", "_std"))]
    return out.withColumn("distinct_objects", listed("distinct_objects")).withColumns({c: r6(c) for c in rates})


@query(f"WITH {_EDITS} SELECT sum(edit_attempts_total)::BIGINT AS edit_attempts_total, sum(stage1_failed_count)::BIGINT AS stage1_failed_count, sum(stage2_entered_count)::BIGINT AS stage2_entered_count, sum(stage2_passed_count)::BIGINT AS stage2_passed_count, sum(stage2_failed_count)::BIGINT AS stage2_failed_count, (SELECT count(*) FROM part) AS object_count FROM g")
def run_totals(t: Tables) -> DataFrame:
    """A03, A29."""
    return stats.run_totals(edits(t), objects(t))


@query("SELECT sum(ps * n)::BIGINT AS planned_total FROM (SELECT p_size AS ps, 3 AS n FROM part)")
def planned_totals(t: Tables) -> DataFrame:
    """A28."""
    return stats.planned_totals(t.part.select(F.col("p_size").cast("long").alias("object_count"), F.lit(3).cast("long").alias("edit_count")))


def timings(t: Tables, blank: bool) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    # Stages for user ids, some of an object, some of an edit.
    stages = F.array(*map(F.lit, ["source_t2i", "source_render", "edit_apply", "target_gen3d", "target_render", "other", "object_total", "stage1_total"]))
    scope = F.nullif("event_type", F.lit("error")) if blank else F.col("event_type")
    return t.events.select(
        scope.alias("scope"), F.element_at(stages, (F.col("user_id") % 8 + 1).cast("int")).alias("stage_name"), F.when(k < 33, "success").when(k < 66, "skipped").otherwise("failed").alias("status"), F.col("value").alias("elapsed_seconds")
    )


_STAGE = "(ARRAY['source_t2i','source_render','edit_apply','target_gen3d','target_render','other','object_total','stage1_total'])[user_id % 8 + 1]"
_TIMING = """SELECT scope, stage_name, count(*) AS count, count(*) FILTER (WHERE k < 33) AS success_count, count(*) FILTER (WHERE k >= 33 AND k < 66) AS skipped_count, count(*) FILTER (WHERE k >= 66) AS failed_count,
  round(sum(value), 6) AS total_seconds, round(avg(value), 6) AS mean_seconds, round(median(value), 6) AS median_seconds, quantile_disc(value, 0.9) AS p90_seconds, min(value) AS min_seconds, max(value) AS max_seconds, '{basis}' AS aggregation_basis
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, {stage} AS stage_name, {scope} AS scope FROM events) GROUP BY scope, stage_name"""
_DERIVED = f"coalesce(nullif(event_type, 'error'), CASE WHEN {_STAGE} IN ('source_t2i','source_render','object_total') THEN 'object' WHEN {_STAGE} = 'other' THEN 'experiment' ELSE 'edit' END)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r6(c) for c in ("total_seconds", "mean_seconds", "median_seconds")})


@query(_TIMING.format(basis="attempt", stage=_STAGE, scope="coalesce(nullif(event_type, 'error'), 'unknown')"))
def timing_summary(t: Tables) -> DataFrame:
    """A04."""
    return _rounded(stats.timing_summary(timings(t, True), "attempt"))


@query(_TIMING.format(basis="final_record", stage=_STAGE, scope=_DERIVED))
def timing_summary_scope_default(t: Tables) -> DataFrame:
    """A06, P29."""
    return _rounded(stats.timing_summary(timings(t, True), "final_record", derive_scope=True))


@query("SELECT l_orderkey AS orderkey, l_quantity AS elapsed_seconds, l_returnflag AS status FROM lineitem")
def timing_flatten(t: Tables) -> DataFrame:
    """Line items as a map of lists of entries, and back."""
    lists = t.lineitem.groupBy("l_orderkey", "l_linestatus").agg(F.collect_list(F.struct(F.col("l_quantity").alias("elapsed_seconds"), F.col("l_returnflag").alias("status"))).alias("v"))
    maps = lists.groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.map_from_entries(F.collect_list(F.struct("l_linestatus", "v"))).alias("timing_attempts"))
    return stats.flatten_timings(maps, "timing_attempts", ["orderkey"])


@query("SELECT l_returnflag, count(*) AS count, round(avg(l_extendedprice), 4) AS mean, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{round(p * 100):02d}" for p in (0.1, 0.25, 0.5, 0.75, 0.9)) + " FROM lineitem GROUP BY 1")
def metric_distribution(t: Tables) -> DataFrame:
    """A17, A21."""
    out = stats.distribution(t.lineitem, "l_extendedprice", ["l_returnflag"])
    return out.withColumns({c: F.round(c, 4) for c in out.columns[2:]})


@query("SELECT o_custkey, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def status_histogram(t: Tables) -> DataFrame:
    """A05."""
    out = stats.status_histogram(t.orders, ["o_custkey"], "o_orderstatus")
    return out.select("o_custkey", F.explode("status_counts").alias("status", "n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL")
def group_counts(t: Tables) -> DataFrame:
    """A19."""
    return stats.group_counts(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("SELECT view, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END)::BIGINT AS missing FROM (SELECT c_custkey, view, count(o_orderkey) FILTER (WHERE o_orderstatus = view) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey CROSS JOIN (VALUES ('F'), ('O'), ('P')) v(view) GROUP BY ALL) GROUP BY view")
def missing_counts(t: Tables) -> DataFrame:
    """Customers that lack an order of each status."""
    maps = stats.status_histogram(t.orders, ["o_custkey"], "o_orderstatus")
    rows = t.customer.join(maps, F.col("c_custkey") == F.col("o_custkey"), "left")
    return stats.missing_counts(rows, "status_counts", ["F", "O", "P"])


@query("SELECT l_returnflag, count(*) AS count, round(avg(a / b), 6) AS mean_ratio, round(avg(abs(a - b) / b * 100), 6) AS mean_change_pct, count(*) FILTER (WHERE abs(a - b) / b * 100 <= 2) AS within_2, count(*) FILTER (WHERE abs(a - b) / b * 100 <= 5.5) AS \"within_5.5\" FROM (SELECT l_returnflag, l_extendedprice AS b, l_extendedprice * (1 - l_discount) AS a FROM lineitem) GROUP BY 1")
def size_report(t: Tables) -> DataFrame:
    """A22."""
    rows = t.lineitem.withColumn("after", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    out = stats.size_report(rows, "l_extendedprice", "after", ["l_returnflag"], [2, 5.5])
    return out.withColumns({c: r6(c) for c in ("mean_ratio", "mean_change_pct")})


@query("SELECT source, CAST(grouping(source) AS TINYINT) AS is_total, count(*) FILTER (WHERE v = 'keep') AS kept, count(*) FILTER (WHERE v <> 'keep') AS removed, round(100.0 * count(*) FILTER (WHERE v = 'keep') / count(*), 6) AS kept_pct FROM (SELECT source, CASE WHEN coalesce(quality, 1) = 1 THEN 'keep' ELSE 'remove' END AS v FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY ROLLUP (source)")
def verdict_review(t: Tables) -> DataFrame:
    """A23."""
    rows = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left").withColumn("verdict", F.when(F.coalesce("quality", F.lit(1)) == 1, "keep").otherwise("remove"))
    return stats.review_counts(rows, "source", "verdict").withColumn("kept_pct", r6("kept_pct"))


@query("SELECT term, count(*) AS count FROM (SELECT lower(trim(split_part(unnest(string_split(url, '/')), '?', 1))) AS term FROM pages) WHERE term <> '' GROUP BY term")
def reason_terms(t: Tables) -> DataFrame:
    """A24."""
    rows = t.pages.select(F.split("url", "/").alias("parts"))
    return stats.term_histogram(rows, "parts", lambda c: F.lower(F.trim(F.split(c, r"\?")[0])))


@query("SELECT CASE WHEN l_quantity < 3 AND l_discount > 0.05 THEN 'both' WHEN l_quantity < 3 THEN 'too_simple_only' ELSE '3d_unfriendly_only' END AS class, count(*) AS count FROM lineitem WHERE l_quantity < 3 OR l_discount > 0.05 GROUP BY 1")
def reason_classes(t: Tables) -> DataFrame:
    """A25."""
    return stats.reason_classes(t.lineitem, records.removal_reasons(F.col("l_quantity"), F.col("l_discount") > 0.05))


@query("SELECT p_size, count(*) AS pairs, count(DISTINCT p_brand) AS categories, sum(count(*)) OVER (ORDER BY p_size)::BIGINT AS running_total FROM part GROUP BY p_size")
def round_summary(t: Tables) -> DataFrame:
    """A26."""
    return stats.round_summary(t.part, "p_size", "p_brand")


@query("SELECT p_brand, string_agg(p_name, ',' ORDER BY p_partkey) AS names, string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_partkey) AS sizes FROM part GROUP BY 1")
def grouped_lists(t: Tables) -> DataFrame:
    """A27."""
    out = stats.grouped_lists(t.part, "p_brand", "p_partkey", ["p_name", "p_size"])
    return out.select("p_brand", F.array_join("p_name", ",").alias("names"), F.array_join(F.col("p_size").cast("array<string>"), ",").alias("sizes"))


@query("SELECT o_custkey AS plan_path, count(*) AS run_count, max(t) AS latest FROM (SELECT o_custkey, o_orderpriority AS name, CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 9 DAY, '%Y-%m-%d') ELSE '' END AS t FROM orders) GROUP BY 1")
def plan_summary(t: Tables) -> DataFrame:
    """A run is dated by its end, else by its start, else not at all."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    rows = t.orders.select(
        F.col("o_custkey").alias("plan_path"), F.col("o_orderpriority").alias("name"),
        F.when(status == "F", day(F.col("o_orderdate") + F.expr("interval 9 days"))).when(status == "O", "").alias("finished_at"),
        F.when(status != "P", day("o_orderdate")).alias("started_at"),
    )
    return stats.plan_summary(rows).drop("name")


@query("SELECT DISTINCT n_regionkey AS source_provider, c_mktsegment AS target_provider FROM customer JOIN nation ON c_nationkey = n_nationkey")
def provider_pairs(t: Tables) -> DataFrame:
    """A15."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return stats.provider_pairs(rows.select(F.col("n_regionkey").alias("source_provider"), F.col("c_mktsegment").alias("target_provider")))


@query("SELECT m, count(*) AS total, sum(n)::BIGINT AS total_edits, sum(r)::BIGINT AS total_with_target_3d FROM (SELECT 'all' AS m, n, r FROM (SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS r FROM orders GROUP BY o_custkey) WHERE n > 0 UNION ALL SELECT 'target', r, r FROM (SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS r FROM orders GROUP BY o_custkey) WHERE r > 0) GROUP BY 1")
def pair_counters(t: Tables) -> DataFrame:
    """Both modes."""
    models = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") != "P").alias("edit_count"), F.count_if(F.col("o_orderstatus") == "F").alias("ready_pair_count"))
    return stats.pair_counters(models).select(F.lit("all").alias("m"), "*").union(stats.pair_counters(models, True).select(F.lit("target").alias("m"), "*"))


@query("SELECT l_orderkey AS model_id, count(*) FILTER (WHERE l_returnflag <> 'A') AS edit_count, count(*) FILTER (WHERE l_returnflag <> 'A' AND l_linestatus = 'F') AS target_ready_count, count(*) FILTER (WHERE l_returnflag <> 'A' AND l_tax > 0.03) AS passed_count FROM lineitem GROUP BY 1")
def edit_summaries(t: Tables) -> DataFrame:
    """A09, A35, F01."""
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("model_id"), F.when(F.col("l_returnflag") == "A", "failed_quality").otherwise("").alias("status"), (F.col("l_linestatus") == "F").alias("has_target"),
        F.create_map(F.lit("x"), F.when(F.col("l_tax") > 0.03, "passed").otherwise("failed")).alias("provider_status"),
    )
    from ..functions.records import edit_allowed

    return stats.edit_summaries(rows, edit_allowed(F.col("status")))


@query("SELECT n_regionkey AS id, min(n_name) AS provider_id, string_agg(DISTINCT CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) FILTER (WHERE n_name = m) AS views FROM (SELECT *, min(n_name) OVER (PARTITION BY n_regionkey) AS m FROM nation) GROUP BY 1")
def views_summary(t: Tables) -> DataFrame:
    """A32."""
    return stats.views_summary(t.nation.select(F.col("n_regionkey").alias("id"), F.col("n_name").alias("provider_id"), F.col("n_nationkey").cast("string").alias("view"))).withColumn("views", listed("views"))


@query("SELECT a.vec_id AS vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::DOUBLE - x[2]) * (x[1]::DOUBLE - x[2]))) / 64, 6) AS mse, round(20 * log10(255) - 10 * log10(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::DOUBLE - x[2]) * (x[1]::DOUBLE - x[2]))) / 64), 6) AS psnr FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def pair_mse_psnr(t: Tables) -> DataFrame:
    """M01."""
    m = metrics.mse(F.col("embedding"), F.col("_b"))
    return _pairs(t).withColumn("mse", m).select("vec_id", r6("mse").alias("mse"), r6(metrics.psnr(F.col("mse"))).alias("psnr"))


def _pairs(t: Tables) -> DataFrame:
    nxt = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("_b"))
    return t.embeddings.select("vec_id", "embedding").join(nxt, "vec_id")


@query("""WITH p AS (SELECT a.vec_id, unnest(a.embedding)::DOUBLE AS x, unnest(b.embedding)::DOUBLE AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
s AS (SELECT vec_id, avg(x) AS ma, avg(y) AS mb, var_pop(x) AS va, var_pop(y) AS vb, covar_pop(x, y) AS c FROM p GROUP BY vec_id)
SELECT vec_id, round((2 * ma * mb + 6.5025) * (2 * c + 58.5225) / ((ma * ma + mb * mb + 6.5025) * (va + vb + 58.5225)), 6) AS ssim FROM s""")
def pair_ssim(t: Tables) -> DataFrame:
    """M02."""
    return _pairs(t).select("vec_id", r6(metrics.ssim(F.col("embedding"), F.col("_b"))).alias("ssim"))


@query("SELECT vec_id, round(len(list_filter(embedding, lambda x: x > 0)) / 64, 6) AS ratio FROM embeddings")
def mask_area(t: Tables) -> DataFrame:
    """M04."""
    return t.embeddings.select("vec_id", r6(metrics.area_ratio(F.col("embedding"), 0)).alias("ratio"))


@query("WITH c AS (SELECT doc_id, ch, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS t FROM c) SELECT doc_id, round(-sum(n / t * log2(n / t)), 6) AS bits FROM s GROUP BY doc_id")
def entropy_score(t: Tables) -> DataFrame:
    """Shannon bits over each text's characters. An empty text counts as one empty
    character, a null one has no row, and no bits are the SQL's -0.0."""
    each = t.documents.select("doc_id", F.explode(F.split("text", "")).alias("ch"))
    counts = each.groupBy("doc_id", "ch").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.sort_array(F.collect_list("n")).alias("ns"))
    bits = counts.select("doc_id", metrics.entropy_bits(F.col("ns")).alias("bits"))
    return bits.withColumn("bits", F.when(F.col("bits") == 0, F.lit(-0.0)).otherwise(r6("bits")))


@query("""WITH b AS (SELECT label, min(embedding[1]) AS x0, max(embedding[1]) AS x1, min(embedding[2]) AS y0, max(embedding[2]) AS y1, min(embedding[3]) AS z0, max(embedding[3]) AS z1 FROM embeddings GROUP BY label),
d AS (SELECT label, x1::DOUBLE - x0 AS a, y1::DOUBLE - y0 AS b, z1::DOUBLE - z0 AS c FROM b) SELECT label, round(sqrt(a * a + b * b + c * c), 5) AS diagonal, round(a * b * c, 5) AS volume FROM d""")
def bbox_stats(t: Tables) -> DataFrame:
    """M07, M08."""
    at = lambda i: F.col("embedding")[i].cast("double")
    mm = t.embeddings.groupBy("label").agg(*[f(at(i)).alias(f"{n}{i}") for i in range(3) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    box = metrics.bbox([F.col(f"lo{i}") for i in range(3)], [F.col(f"hi{i}") for i in range(3)])
    return mm.select("label", F.round(box["diagonal"], 5).alias("diagonal"), F.round(box["volume"], 5).alias("volume"))


@query("SELECT doc_id, CASE WHEN n_chars <= 4000 THEN n_chars / 4000 ELSE CAST(1 AS DOUBLE) END AS confidence, n_chars <= 1000 AS passes_distance, CASE WHEN n_chars > 4000 THEN 1.0 ELSE n_chars / 4000 END >= 0.5 AS passes_confidence FROM documents")
def verdict_directions(t: Tables) -> DataFrame:
    """The same score judged as a distance and as a confidence."""
    c = metrics.clamped(F.col("n_chars") / 4000)
    return t.documents.select("doc_id", c.alias("confidence"), metrics.passes(F.col("n_chars"), 1000, "lower").alias("passes_distance"), metrics.passes(c, 0.5, "higher").alias("passes_confidence"))
