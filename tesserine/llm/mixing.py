"""Mixing sources to target weights by systematic sampling (operator 7).

Only DataFrame functions. Within a source every document is expected equally often
(target / source size), so the prefix sum of expected copies up to a document is its
rank times that rate. A document is emitted once for each integer that the prefix sum,
shifted by one random offset a source, passes on it. Ranks follow size, so the words
taken stay close to the target whatever the sizes are.

Ranks are exact and need no large window: they add up over the levels source > size
band > size > hash bucket > row, and each window sees only the children of one parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Sizes of a band, and hash buckets of a size: they bound every window.
BAND, HEX_DIGITS = 1024, 3
WEIGHTS = (3, 1, 2)
TOTAL_PERCENT, MAX_COPIES = 150, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_percent: int = TOTAL_PERCENT, max_copies: int = MAX_COPIES) -> DataFrame:
    """sizes (source, source_size, n) -> with target: the share by weight of total_percent
    of all sizes, at most max_copies times the source's size; what is cut off is shared
    among the rest by weight until none is above. Sources that reach their limit are those
    with the least limit for their weight, so one running sum over the sources (one row
    each) finds the level at which the rest stand: in that order, levels rise as long as
    sources reach their limit and fall after, so it is the greatest of those within it."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "rank")
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", w.cast("long"))
        .withColumn("cap", F.lit(max_copies) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("goal", F.sum("source_size").over(everything) * F.lit(total_percent / 100))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("level", (F.col("goal") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
        .withColumn("open_level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("open_level").isNull() | (F.col("ratio") <= F.col("open_level")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("open_level")))
        .select("source", "source_size", "n", "target")
    )


def _hex(x: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(x.cast("string").cast("binary")), 1, digits), 16, 10).cast("long")


def placed(rows: DataFrame) -> DataFrame:
    """rows with the band of their size and the hash bucket of their id."""
    return rows.withColumn("band", F.expr(f"size div {BAND}")).withColumn("bucket", F.coalesce(_hex(F.col("id"), HEX_DIGITS), F.lit(-1)))


def ranked(rows: DataFrame, thin: DataFrame) -> DataFrame:
    """rows (id, source, size, ...) -> with rank from 1 within source, by size, then bucket,
    then id, then a hash of the whole row. Equal rows take ranks in any order, which changes
    nothing in the result. Counts are of thin, the same rows without what else they hold."""
    rows = placed(rows)
    leaf = ["source", "band", "size", "bucket"]
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = placed(thin).groupBy(*leaf).agg(F.count("*").alias("n"))
    sizes = cells.groupBy(*leaf[:3]).agg(F.sum("n").alias("n"))
    bands = sizes.groupBy(*leaf[:2]).agg(F.sum("n").alias("n"))
    bands = bands.withColumn("at_band", before(Window.partitionBy("source").orderBy("band"))).drop("n")
    sizes = sizes.withColumn("at_size", before(Window.partitionBy("source", "band").orderBy("size"))).drop("n")
    cells = cells.withColumn("at_bucket", before(Window.partitionBy(*leaf[:3]).orderBy("bucket"))).drop("n")
    null_safe = lambda a, b, keys: a.join(b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys]), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])
    starts = null_safe(null_safe(cells, sizes, leaf[:3]), bands, leaf[:2])
    starts = starts.select(*leaf, (F.col("at_band") + F.col("at_size") + F.col("at_bucket")).alias("start"))
    inside = F.row_number().over(Window.partitionBy(*leaf).orderBy("id", F.xxhash64(*rows.columns)))
    out = null_safe(rows.withColumn("inside", inside), starts, leaf)
    return out.withColumn("rank", F.col("start") + F.col("inside")).drop("start", "inside", "band", "bucket")


def _copies(rows: DataFrame, thin: DataFrame, seed: int) -> DataFrame:
    """rows (id, source, size, ...) with source_size, target and copies."""
    targets = source_targets(thin.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    offset = _hex(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("\0null"))), 8) / F.lit(2.0**32)
    targets = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).withColumn("offset", offset)
    targets = targets.withColumnRenamed("source", "_source").drop("n")
    out = ranked(rows, thin).join(targets, F.col("source").eqNullSafe(F.col("_source")))
    passed = lambda rank: F.floor(F.col("offset") + rank * F.col("rate"))
    return out.withColumn("copies", passed(F.col("rank")) - passed(F.col("rank") - 1)).drop("_source", "rank", "rate", "offset")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source: one row a document.

    Size is the number of words; null text has 0. A null source is a source of its own, the
    last. Empty documents take part with size 0, a source without words has target 0 and
    gives nothing. Documents with null or equal ids take part like others. Reruns agree:
    the offset of a source comes from its name and the seed. An empty table gives an empty
    result. Other columns are ignored.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")
    out = _copies(rows, rows, seed)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """docs, each row as often as the mix takes it, with its number in the new column copy (with
    underscores before it where docs has a column of that name).
    The rules are mix()'s. Each row carries its own count, so rows that share an id are
    taken one by one; columns of any names stay as they are."""
    taken, name = {c.lower() for c in docs.columns}, "copy"
    while name in taken:
        name = f"_{name}"
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    thin = written(whole.select("id", "source", "size"), "sizes")
    out = _copies(whole, thin, seed).filter("copies > 0")
    return out.select("doc.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(name))


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
c AS (SELECT *, 2 * source_size AS cap, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
r AS (SELECT *, cap / weight AS ratio, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS goal, sum(weight) OVER () AS all_weight FROM c),
l AS (SELECT *, (goal - coalesce(sum(cap) OVER p, 0)) / CAST(all_weight - coalesce(sum(weight) OVER p, 0) AS DOUBLE) AS level
      FROM r WINDOW p AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS open_level FROM l),
t AS (SELECT source, source_size, CASE WHEN open_level IS NULL OR ratio <= open_level THEN CAST(cap AS DOUBLE) ELSE weight * open_level END AS target FROM o),
e AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
        CAST(CAST('0x' || substr(md5('17:' || coalesce(source, chr(0) || 'null')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS shift FROM t),
k AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.rate, e.shift,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size, substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 3), d.doc_id) AS rank
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(shift + rank * rate) - floor(shift + (rank - 1) * rate)) AS BIGINT) * size AS taken
FROM k
"""
QUERY_COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]
