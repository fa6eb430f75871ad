"""Queries of deduplication, work lists, pairs, search and paging."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records
from ..operators import dedup, nearest, planning, search
from ..sources import readers, writers
from ..streaming import incremental
from .base import Tables, listed, query

_ALL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LATEST = "SELECT user_id, event_type, event_id, value FROM {} QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1"


def _events(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type", "event_id", "value", "ts")


@query(f"SELECT * FROM ({_LATEST.format('events')}) WHERE value <= 50")
def latest_then_filter(t: Tables) -> DataFrame:
    """W01."""
    return dedup.latest_then_filter(_events(t), ["user_id", "event_type"], "ts", "event_id", F.col("value") <= 50).drop("ts")


@query(_LATEST.format("(SELECT * FROM events WHERE value <= 50)"))
def filter_then_latest(t: Tables) -> DataFrame:
    """S20."""
    return dedup.filter_then_latest(_events(t), ["user_id", "event_type"], "ts", "event_id", F.col("value") <= 50).drop("ts")


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def last_turn(t: Tables) -> DataFrame:
    """W02."""
    return dedup.last_write(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], "turn")


@query("SELECT user_id, min(event_id) AS position, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def keyed_upsert(t: Tables) -> DataFrame:
    """W03, W04."""
    return dedup.keyed_upsert(t.events.select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@query("SELECT doc_id, coalesce(nullif(trim(CASE WHEN lang = 'en' THEN '' ELSE lang END), ''), source || '::' || CAST(doc_id AS VARCHAR) || '::' || lang) AS key FROM documents")
def record_keys(t: Tables) -> DataFrame:
    """W05."""
    return t.documents.select("doc_id", dedup.record_key(F.when(F.col("lang") == "en", "").otherwise(F.col("lang")), F.col("source"), F.col("doc_id"), F.col("lang")).alias("key"))


@query(
    "WITH s AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY " + ", ".join(_ALL) + ") AS rn FROM lineitem) "
    "SELECT l_orderkey, l_returnflag, count(*) AS kept FROM s WHERE n <= 4 OR (l_returnflag = 'R' AND rn <= 2) OR (l_returnflag = 'N' AND rn <= 1) GROUP BY ALL"
)
def quota_per_group(t: Tables) -> DataFrame:
    """F19, J10."""
    rows = dedup.quota(t.lineitem, ["l_orderkey"], "l_returnflag", [F.col(c) for c in _ALL], {"R": 2, "N": 1}, 4)
    return rows.groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("kept"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def work_list(t: Tables) -> DataFrame:
    """J08, J25, W22."""
    return planning.work_list(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("SELECT count(*) AS n, sum(o_totalprice > 1000)::BIGINT AS large FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def with_asset(t: Tables) -> DataFrame:
    """J05-J07."""
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return planning.with_asset(t.orders, done, ["o_orderkey"]).agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 1000).alias("large"))


@query(
    "WITH d AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), m AS (SELECT o_orderkey, o_custkey, l_orderkey IS NOT NULL AS skip FROM orders LEFT JOIN d ON l_orderkey = o_orderkey) "
    "SELECT o_orderkey, o_custkey, CASE WHEN skip THEN 'skip' WHEN row_number() OVER (PARTITION BY o_custkey, skip ORDER BY o_orderkey DESC) <= 2 THEN 'run' ELSE 'limited' END AS label FROM m"
)
def work_list_capped(t: Tables) -> DataFrame:
    """J11."""
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedup.capped_work(t.orders.select("o_orderkey", "o_custkey"), done, ["o_orderkey"], ["o_custkey"], [F.desc("o_orderkey")], 2)


@query("SELECT CASE WHEN n_regionkey = 0 THEN 'region_closed' WHEN o_totalprice < 50000 THEN 'too_small' WHEN c_acctbal < 0 THEN 'in_debt' ELSE 'accepted' END AS reason, count(*) AS count FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def reason_breakdown(t: Tables) -> DataFrame:
    """The common form of J12 and J13: counts by the first rule that a row breaks."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return planning.reason_counts(rows, [(F.col("n_regionkey") == 0, "region_closed"), (F.col("o_totalprice") < 50000, "too_small"), (F.col("c_acctbal") < 0, "in_debt")])


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS batches, count(*) AS batch_count FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING max(l_discount) <= 0.06) GROUP BY 1")
def whitelist_attach(t: Tables) -> DataFrame:
    """J14."""
    allowed = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_discount").alias("score")).filter("score <= 0.06")
    out = planning.attach_allowed(t.orders.select("o_custkey", "o_orderkey"), allowed, ["o_orderkey"], "o_custkey", ["score"], "o_orderkey")
    return out.withColumn("batches", F.array_join(F.col("batches.o_orderkey").cast("array<string>"), ","))


@query("SELECT r_name, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS n_name_list, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS c_mktsegment_list FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def experiment_index(t: Tables) -> DataFrame:
    """J15."""
    runs = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).withColumn("c_nationkey", F.col("n_nationkey"))
    out = planning.membership_index(runs, t.customer, ["c_nationkey"], "r_name", ["n_name", "c_mktsegment"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("n_name_list", "c_mktsegment_list")})


@query("SELECT p_name AS object_name, arg_min(p_brand, pos) AS category FROM (SELECT p_name, p_brand, row_number() OVER (ORDER BY p_brand) AS pos FROM (SELECT DISTINCT p_name, p_brand FROM part)) GROUP BY 1")
def reverse_lookup(t: Tables) -> DataFrame:
    """J17."""
    maps = t.part.groupBy(F.col("p_brand").alias("category")).agg(F.collect_set("p_name").alias("objects")).withColumn("pos", F.col("category"))
    return planning.reverse_lookup(maps)


@query("SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '') AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def assembled_models(t: Tables) -> DataFrame:
    """J01-J04, S16, P12."""
    child = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    out = planning.assemble(t.customer.select("c_custkey"), {"found": child}, "c_custkey")
    return out.select("c_custkey", F.size("found").cast("long").alias("n_orders"), F.array_join(F.col("found.o_orderkey").cast("array<string>"), ",").alias("orders"))


_PRIORITY = """p AS (SELECT category, style_id, row_number() OVER (PARTITION BY category ORDER BY weight DESC, cover DESC, pos) - 1 AS rank
  FROM (SELECT p_brand AS category, p_type AS style_id, min(p_partkey) AS pos, length(p_type) AS weight, count(*) OVER (PARTITION BY p_type) AS cover FROM part GROUP BY p_brand, p_type))"""


def _priority(t: Tables) -> DataFrame:
    mapping = t.part.groupBy(F.col("p_brand").alias("category"), F.col("p_type").alias("style_id")).agg(F.min("p_partkey").alias("pos"))
    styles = mapping.select("style_id").distinct().withColumn("weight", F.length("style_id"))
    return planning.style_priority(styles, mapping)


@query(f"WITH {_PRIORITY} SELECT * FROM p")
def style_priority(t: Tables) -> DataFrame:
    """J19."""
    return _priority(t)


@query(f"WITH {_PRIORITY}, o AS (SELECT DISTINCT p_brand AS category, p_name AS object_name FROM part) SELECT row_number() OVER (ORDER BY rank, category, object_name) - 1 AS index, rank AS round, category, object_name, style_id FROM o JOIN p USING (category) WHERE rank < 4")
def matrix_pairs(t: Tables) -> DataFrame:
    """J18."""
    objects = t.part.select(F.col("p_brand").alias("category"), F.col("p_name").alias("object_name")).distinct()
    return planning.matrix_pairs(objects, _priority(t), 4)


@query(
    """WITH p AS (SELECT c_mktsegment AS category, least(count(*), 20 + length(c_mktsegment) * 9) AS pool_size FROM customer GROUP BY 1),
b AS (SELECT *, least(pool_size, 500 // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY pool_size DESC, category) - 1 < 500 % count(*) OVER () THEN 1 ELSE 0 END) AS c FROM p),
s AS (SELECT *, 500 - sum(c) OVER () AS rest, coalesce(sum(pool_size - c) OVER (ORDER BY pool_size DESC, category ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b WHERE c > 0)
SELECT category, CAST(c + least(pool_size - c, greatest(0, rest - before)) AS BIGINT) AS object_count, pool_size FROM s"""
)
def balanced_allocation(t: Tables) -> DataFrame:
    """A33."""
    pools = t.customer.groupBy(F.col("c_mktsegment").alias("category")).agg(F.count("*").alias("n"))
    pools = pools.select("category", F.least("n", F.lit(20) + F.length("category") * 9).cast("long").alias("pool_size"), F.col("category").alias("pos"))
    return planning.balanced_allocation(pools, 500)


@query("WITH a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position FROM orders), l AS (SELECT c_nationkey AS o_custkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS position FROM customer) SELECT o_custkey, position, o_orderkey, c_name FROM a JOIN l USING (o_custkey, position)")
def zipped_by_position(t: Tables) -> DataFrame:
    """J22, J24, W21."""
    right = t.customer.select(F.col("c_nationkey").cast("long").alias("o_custkey"), "c_name", "c_custkey")
    return planning.zipped(t.orders.select("o_custkey", "o_orderkey"), right, "o_custkey", ["o_orderkey"], ["c_custkey"]).select("o_custkey", "position", "o_orderkey", "c_name")


@query("SELECT o_custkey, batch, count(*) AS n, min(o_orderkey) AS first FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS batch FROM orders) GROUP BY ALL")
def batched_work(t: Tables) -> DataFrame:
    """J25."""
    return planning.batched(t.orders, ["o_orderkey"], 3, "o_custkey").groupBy("o_custkey", "batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("SELECT d.doc_id, min(e.doc_id) AS edit_id FROM documents d LEFT JOIN documents e ON e.source = d.source AND lower(trim(e.text)) = lower(trim(d.text)) AND e.lang <> 'fr' GROUP BY d.doc_id")
def dup_normalised(t: Tables) -> DataFrame:
    """The least allowed document of the same source with the same text."""
    rows = t.documents.select(F.col("source").alias("model_id"), F.col("text").alias("instruction"), "doc_id", "lang")
    known = rows.select("model_id", "instruction", F.col("doc_id").alias("edit_id"), "lang")
    return planning.reuse_lookup(rows.drop("lang"), known, F.col("lang") != "fr").select("doc_id", "edit_id")


@query()
def diverse_sample(t: Tables) -> DataFrame:
    """W08; tests hold it against a plain loop."""
    return planning.diverse_sample(t.part.select("p_partkey", "p_brand", "p_name"), ["p_partkey"], "p_brand", "p_name", 40)


@query(
    """WITH s AS (SELECT p_brand AS c, p_type AS s, sum(p_size)::DOUBLE AS w FROM part WHERE p_type <> 'PROMO' OR p_partkey % 2 = 0 GROUP BY ALL),
    q AS (SELECT p_partkey AS request_id, CASE WHEN p_partkey % 10 = 0 THEN 'none' ELSE p_brand END AS category FROM part),
    a AS (SELECT c, s, w FROM s UNION ALL SELECT 'all', s, max(w) FROM s GROUP BY s),
    k AS (SELECT c, s = 'PROMO' AS side, s, CASE WHEN sum(w) OVER p > 0 THEN w ELSE 1 END AS w FROM a WINDOW p AS (PARTITION BY c, s = 'PROMO')),
    h AS (SELECT *, sum(w) OVER (PARTITION BY c, side ORDER BY s) AS hi, sum(w) OVER (PARTITION BY c, side) AS total FROM k),
    m AS (SELECT c, bool_or(side) AS pin, bool_and(side) AS only FROM h GROUP BY c),
    r AS (SELECT *, CASE WHEN category IN (SELECT c FROM s) THEN category ELSE 'all' END AS own,
      CAST('0x' || substr(md5('7:u:' || request_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u, CAST('0x' || substr(md5('7:p:' || request_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS p FROM q)
    SELECT request_id, category, s AS style_id FROM r JOIN m ON own = m.c JOIN h ON own = h.c AND h.side = (m.only OR (m.pin AND p < 0.4)) WHERE u * total >= hi - w AND u * total < hi"""
)
def weighted_styles(t: Tables) -> DataFrame:
    """By md5 in place of a generator; some requests name a category without styles."""
    styles = t.part.filter("p_type != 'PROMO' or p_partkey % 2 = 0").groupBy(F.col("p_brand").alias("category"), F.col("p_type").alias("style_id")).agg(F.sum("p_size").alias("weight"))
    requests = t.part.select(F.col("p_partkey").alias("request_id"), F.when(F.col("p_partkey") % 10 == 0, "none").otherwise(F.col("p_brand")).alias("category"))
    return planning.weighted_choice(requests, styles, 7, "PROMO")


@query("SELECT p_partkey, p_brand, h <= 40 AS in_sample FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY md5('7:' || p_partkey), p_partkey) AS g, row_number() OVER (ORDER BY md5('9:' || p_partkey), p_partkey) AS h FROM part) WHERE g <= 5")
def sampled_per_group(t: Tables) -> DataFrame:
    """So many of each group, and of all, by md5."""
    parts = t.part.select("p_partkey", "p_brand")
    some = planning.hash_sample(parts, 40, 9, "p_partkey").select(F.col("p_partkey").alias("_k"))
    rows = planning.sample_per_group(parts, "p_brand", F.lit(5), 7, "p_partkey")
    return rows.join(F.broadcast(some), F.col("p_partkey") == F.col("_k"), "left").select("p_partkey", "p_brand", F.col("_k").isNotNull().alias("in_sample"))


@query("SELECT p_partkey, p_name, rank FROM (SELECT p_partkey, p_name, CASE WHEN CAST(p_partkey AS VARCHAR) = '12' THEN 0 WHEN CAST(p_partkey AS VARCHAR) LIKE '12%' THEN 1 WHEN contains(CAST(p_partkey AS VARCHAR), '12') OR contains(lower(p_name), '12') THEN 2 END AS rank FROM part) WHERE rank IS NOT NULL ORDER BY rank, p_partkey LIMIT 20")
def ranked_search(t: Tables) -> DataFrame:
    """F26."""
    return search.ranked_search(t.part.select("p_partkey", "p_name"), "12", "p_partkey", ["p_name"], [F.col("p_partkey")])


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey ORDER BY CASE WHEN o_orderkey IN (7, 1005) THEN 0 ELSE 1 END, o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 25")
def priority_page(t: Tables) -> DataFrame:
    """The second page."""
    index = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return search.priority_page(t.orders, index, ["o_custkey"], F.col("o_orderkey").isin(7, 1005), [F.desc("o_totalprice"), F.col("o_orderkey")], 2, 25).select("o_orderkey", "c_name")


@query("SELECT v.pos, part.* FROM (VALUES (1, 5), (2, 3), (3, -1), (4, 9)) v(pos, p_partkey) JOIN part USING (p_partkey)")
def rows_by_ids(t: Tables) -> DataFrame:
    """J27."""
    ids = t.spark.createDataFrame([(1, 5), (2, 3), (3, -1), (4, 9)], "pos int, p_partkey long")
    return search.by_ids(t.part, ids, "p_partkey")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '3-MEDIUM' THEN 1 ELSE 99 END AS rank FROM orders ORDER BY rank, o_orderkey")
def custom_order(t: Tables) -> DataFrame:
    """W07."""
    r = records.view_rank(F.col("o_orderpriority"), ["1-URGENT", "3-MEDIUM"])
    return t.orders.select("o_orderkey", r.alias("rank")).orderBy("rank", "o_orderkey")


@query("SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS place FROM events QUALIFY place <= 50")
def newest_first(t: Tables) -> DataFrame:
    """W06."""
    rows = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("key"))
    out = rows.orderBy(*search.newest_first(F.col("created"), F.col("key"))).limit(50)
    from pyspark.sql import Window

    return out.select("event_id", F.row_number().over(Window.orderBy(F.desc("created"), F.desc("key"))).alias("place"))


@query("(SELECT l_orderkey, l_extendedprice, 'low' AS side FROM lineitem ORDER BY l_extendedprice, " + ", ".join(_ALL) + " LIMIT 12) UNION ALL (SELECT l_orderkey, l_extendedprice, 'high' AS side FROM lineitem ORDER BY l_extendedprice DESC, " + ", ".join(f"{c} DESC" for c in _ALL) + " LIMIT 12)")
def topk_outliers(t: Tables) -> DataFrame:
    """W13."""
    return search.ends(t.lineitem, ["l_extendedprice", *_ALL], 12).select("l_orderkey", "l_extendedprice", "side")


@query("SELECT o_orderkey, o_orderstatus, o_orderdate FROM (SELECT * REPLACE ('P' AS o_orderstatus) FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT * FROM orders WHERE o_orderkey % 3 <> 0) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100")
def newest_tasks(t: Tables) -> DataFrame:
    """S37."""
    stored = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    live = stored.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("P"))
    return search.newest_tasks(live, stored, "o_orderkey", "o_orderdate")


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 30")
def log_tail(t: Tables) -> DataFrame:
    """S05."""
    return readers.tail(t.events.select("event_id", "event_type"), "event_id", 30)


@query("SELECT name, n AS count FROM (SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'parts', count(*) FROM part UNION ALL SELECT 'customers', count(*) FROM customer)")
def home_counters(t: Tables) -> DataFrame:
    """S18."""
    return readers.counters({"orders": t.orders, "parts": t.part, "customers": t.customer})


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region")
def union_distinct(t: Tables) -> DataFrame:
    """W23, A15, W24."""
    return t.nation.select(F.col("n_name").alias("name")).unionByName(t.region.select(F.col("r_name").alias("name"))).distinct().orderBy("name")


@query(
    """WITH o AS (SELECT o_orderkey, o_totalprice AS v FROM orders WHERE o_orderkey % 10 <> 0), n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 7 <> 0)
SELECT o_orderkey, CASE WHEN o.v IS NULL THEN 'add' WHEN n.v IS NULL THEN 'delete' WHEN o.v = n.v THEN 'keep' ELSE 'update' END AS action FROM o FULL JOIN n USING (o_orderkey)"""
)
def snapshot_diff(t: Tables) -> DataFrame:
    """X01-X03, W22."""
    old, new = _snapshots(t)
    return incremental.snapshot_diff(old, new, "o_orderkey", "v")


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("v"))
    return rows.filter("o_orderkey % 10 <> 0"), rows.filter("o_orderkey % 7 <> 0").withColumn("v", F.when(F.col("o_orderkey") % 5 == 1, F.col("v") + 1).otherwise(F.col("v")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 7 <> 0")
def reconciled_index(t: Tables) -> DataFrame:
    """The index after a reconcile equals a full rebuild."""
    old, new = _snapshots(t)
    return incremental.reconcile(old, new, "o_orderkey", "v", lambda df: df)[0]


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'P' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 9 <> 0")
def merged_table(t: Tables) -> DataFrame:
    """K13-K16, K18, K19."""
    base = t.orders.select("o_orderkey", "o_orderstatus")
    new = base.filter("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("P"))
    return writers.without(writers.merged(base, new, ["o_orderkey"]), base.filter("o_orderkey % 9 = 0"), ["o_orderkey"])


@query("SELECT user_id, round(epoch(max(ts)) - epoch(min(ts)), 3) AS elapsed_seconds FROM events GROUP BY user_id")
def paired_events(t: Tables) -> DataFrame:
    """First and last event of a user as start and end."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id")
    kind = F.when(F.col("ts") == F.max("ts").over(w), "x_end").otherwise("x_start")
    rows = t.events.withColumn("kind", kind)
    both = rows.filter("kind = 'x_end'").withColumn("kind", F.lit("x_end")).unionByName(t.events.withColumn("kind", F.lit("x_start")))
    ev = both.select("user_id", F.col("kind").alias("event_type"), F.col("ts").cast("string").alias("timestamp"), F.lit("ok").alias("status"))
    return incremental.paired_events(ev, ["user_id"]).select("user_id", F.round("elapsed_seconds", 3).alias("elapsed_seconds"))


@query("SELECT 'S' || CASE WHEN n < 10 THEN '000' WHEN n < 100 THEN '00' WHEN n < 1000 THEN '0' ELSE '' END || n AS sample_id, o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders)")
def numbered_samples(t: Tables) -> DataFrame:
    """K11."""
    return writers.numbered(t.orders, [F.col("o_totalprice"), F.col("o_orderkey")], "S").select("sample_id", "o_orderkey")


@query("SELECT p_brand AS category, string_agg(p_partkey || ':' || concat_ws('+', CASE WHEN p_size < 3 THEN 'too_simple' END, CASE WHEN p_retailprice > 1000 THEN '3d_unfriendly' END), ',' ORDER BY p_partkey) AS removed FROM part WHERE p_size % 3 = 0 OR p_size < 5 GROUP BY 1")
def removed_objects(t: Tables) -> DataFrame:
    """K23."""
    rows = t.part.select(
        F.col("p_brand").alias("category"), F.col("p_partkey").alias("object"), F.when((F.col("p_size") % 3 == 0) | (F.col("p_size") < 5), "remove").otherwise("keep").alias("verdict"),
        F.col("p_size").cast("double").alias("editability_score"), (F.col("p_retailprice") > 1000).alias("has_3d_unfriendly_attrs"),
    )
    said = F.transform("removed", lambda o: F.concat(o["object"].cast("string"), F.lit(":"), F.array_join(o["removal_reasons"], "+")))
    return writers.removed_objects(rows).select("category", F.array_join(said, ",").alias("removed"))


@query("SELECT l_orderkey AS item_id, max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS q_A, max(l_quantity) FILTER (WHERE l_returnflag = 'N') AS q_N, max(l_quantity) FILTER (WHERE l_returnflag = 'R') AS q_R FROM lineitem GROUP BY 1")
def metric_sheet(t: Tables) -> DataFrame:
    """K22."""
    long = t.lineitem.groupBy(F.col("l_orderkey").alias("item_id"), F.col("l_returnflag").alias("view")).agg(F.max("l_quantity").alias("q"))
    return writers.metric_sheet(long, "q", ["A", "N", "R"])


@query(
    """SELECT o_orderkey AS sample_id, concat_ws(',', CASE WHEN k % 7 = 4 THEN 'instruction_mismatch' END, CASE WHEN k % 2 = 1 THEN 'missing:edited_views' END, CASE WHEN k % 7 = 5 THEN 'missing:meta' END, CASE WHEN k % 3 = 1 THEN 'missing:source_glb' END, CASE WHEN k % 5 = 0 AND k % 3 = 1 THEN 'missing:target_glb' END,
    CASE WHEN k % 7 = 6 THEN 'no_edit_in_path' END, CASE WHEN k % 11 < 2 THEN 'possible_typo' END, CASE WHEN k % 5 = 0 THEN 'same_file' END) AS issues FROM (SELECT *, o_orderkey AS k FROM orders)"""
)
def manifest_issues(t: Tables) -> DataFrame:
    """all six checks, over paths made from orders."""
    k = F.col("o_orderkey")
    s = k.cast("string")
    # Where one file serves for both models, its own path is there or not as the source's.
    source = F.concat(F.lit("src/"), s)
    front = F.when(k % 7 == 6, F.concat(F.lit("other/"), s)).otherwise(F.concat(F.lit("/r/triplets/m"), s, F.lit("/edited/e"), s, F.lit("/front.png")))
    said = F.when(k % 11 == 0, "RRemove it").when(k % 11 == 1, "Remove  it").otherwise("Remove it")
    rows = t.orders.select(
        k.alias("sample_id"), source.alias("source_glb"), F.when(k % 5 == 0, source).otherwise(F.concat(F.lit("tgt/"), s)).alias("target_glb"), said.alias("instruction"),
        F.create_map(F.lit("front"), F.concat(F.lit("v/"), s)).alias("source_views"), F.create_map(F.lit("front"), front).alias("edited_views"), (k % 2 == 1).alias("odd"),
    )
    paths = F.array(F.when(k % 3 != 1, source), F.concat(F.lit("tgt/"), s), F.concat(F.lit("v/"), s), F.when(k % 2 == 0, front))
    files = t.orders.select(F.explode(F.array_compact(paths)).alias("path")).union(t.orders.filter((k % 5 == 0) & (k % 3 == 1)).select(F.concat(F.lit("x/"), s)))
    metas = rows.filter((F.col("sample_id") % 7 != 5)).select(F.concat(F.lit("/r/triplets/m"), F.col("sample_id").cast("string"), F.lit("/edited/e"), F.col("sample_id").cast("string"), F.lit("/meta.json")).alias("path"), F.when(F.col("sample_id") % 7 == 4, "Else").otherwise(F.concat(F.lit(" "), F.col("instruction"))).alias("instruction"))
    found = writers.manifest_issues(rows, files, metas, ["front"], "/r")
    return found.withColumn("issues", listed("issues"))


_NEAR = "SELECT min(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::DOUBLE - x[2]) ** 2)))) AS d FROM embeddings a, embeddings b WHERE a.label = {0} AND b.label = {1} GROUP BY a.vec_id"


@query(f"WITH x AS ({_NEAR.format(0, 1)}), y AS ({_NEAR.format(1, 0)}) SELECT 0 AS pair, round((SELECT avg(d) FROM x) + (SELECT avg(d) FROM y), 5) AS chamfer, round(greatest((SELECT max(d) FROM x), (SELECT max(d) FROM y)), 5) AS hausdorff")
def nn_chamfer(t: Tables) -> DataFrame:
    """J20, J21."""
    points = lambda label: t.embeddings.filter(F.col("label") == label).select(F.lit(0).alias("pair"), "vec_id", "embedding")
    out = nearest.chamfer(points(0), points(1), "pair", "embedding", "vec_id")
    return out.select("pair", F.round("chamfer", 5).alias("chamfer"), F.round("hausdorff", 5).alias("hausdorff"))


@query()
def nn_chamfer_all(t: Tables) -> DataFrame:
    """J20, J21 for every label and the next one, over the whole table; tests hold it against brute force."""
    points = lambda pair: t.embeddings.select(pair.alias("pair"), "vec_id", "embedding")
    out = nearest.chamfer(points(F.col("label")), points(F.col("label") - 1), "pair", "embedding", "vec_id")
    return out.select("pair", F.round("chamfer", 5).alias("chamfer"), F.round("hausdorff", 5).alias("hausdorff"))
