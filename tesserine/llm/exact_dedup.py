"""Exact deduplication with an extendible-hash index on shared files (operator 4).

Only DataFrame functions. A text's key is the first `key_bits` of a 64-bit hash.

1. Directory. It starts with `min_depth` bits; while a bucket has more than `capacity`
   distinct keys, the directory doubles: such buckets are split by one more bit. A bucket
   of one key is never overfull, so doubling ends; there is no greatest depth.
2. Owner tasks. Keys are dealt by range of bucket, so a task owns whole buckets and builds
   the chain of each key: its distinct texts. A key met once has a chain of one, and its
   bytes stay where they are. The bytes of keys met twice are compared: the grouping by
   bucket, key and text combines copies before the shuffle, so a text that holds a third of
   all rows costs a task one row. The index is written in order of bucket and key.
3. Look-up. A row goes by its key to its bucket's chain. Where the chain has one text, that
   is the row's; where texts collide, the row's own bytes choose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, if_small, new_path, spread_join, written

#: Words of the bitmap of keys met twice: 2**18 rows, a bound on what is broadcast.
WORD_BITS = 18


def _prefix(key: str, bits: Column | int, key_bits: int) -> Column:
    return F.expr(f"shiftright({key}, {key_bits} - {bits})")


def directory(keys: DataFrame, capacity: int, min_depth: int, key_bits: int) -> DataFrame:
    """keys (key, one row each) -> depth, prefix: the buckets. Each round counts the keys of
    the buckets that were overfull only."""
    cells = written(keys.groupBy(_prefix("key", min_depth, key_bits).alias("prefix")).agg(F.count("*").alias("n")), "buckets")
    depth, leaves = min_depth, None
    while True:
        fits = cells.filter((F.col("n") <= capacity) | F.lit(depth >= key_bits)).select(F.lit(depth).alias("depth"), "prefix")
        leaves = fits if leaves is None else leaves.unionByName(fits)
        over = cells.filter(F.col("n") > capacity).select("prefix")
        if depth >= key_bits or not over.limit(1).count():
            return written(leaves, "directory")
        inside = keys.withColumn("prefix", _prefix("key", depth, key_bits)).join(if_small(over), "prefix", "left_semi")
        depth += 1
        cells = written(inside.groupBy(_prefix("key", depth, key_bits).alias("prefix")).agg(F.count("*").alias("n")), "buckets")


def in_buckets(rows: DataFrame, buckets: DataFrame, key_bits: int) -> DataFrame:
    """rows (key, ...) with bucket, the least key of its bucket, and bucket_depth. One look-up
    a depth that occurs; depths differ by few bits, as keys are hashes."""
    out = None
    for depth in sorted(r["depth"] for r in buckets.select("depth").distinct().collect()):
        here = if_small(buckets.filter(F.col("depth") == depth).select("prefix"))
        part = rows.withColumn("prefix", _prefix("key", depth, key_bits)).join(here, "prefix")
        part = part.withColumn("bucket", F.expr(f"shiftleft(prefix, {key_bits} - {depth})")).withColumn("bucket_depth", F.lit(depth)).drop("prefix")
        out = part if out is None else out.unionByName(part)
    return rows.withColumn("bucket", F.col("key")).withColumn("bucket_depth", F.lit(0)).limit(0) if out is None else out


def _seen(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """rows whose key's bit is set in the bitmap of some keys, and a few others."""
    word = F.expr(f"shiftright(key, 6) & {(1 << WORD_BITS) - 1}")
    words = keys.groupBy(word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(key & 63 as int)))").alias("bits"))
    met = rows.withColumn("word", word).join(F.broadcast(words), "word").filter("shiftrightunsigned(bits, cast(key & 63 as int)) & 1 = 1")
    return met.drop("word", "bits")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 100_000, min_depth: int = 4, key_bits: int = 60) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket, bucket_depth: one row for
    each row of docs.

    Texts are equal when identical after lower-casing A-Z. Null text counts as empty, and
    empty texts are copies of each other. The largest id of a group stays; a null id never
    stays unless the group has no other, and then keep_id is null and kept is false.
    Repeated rows (same id) are each counted; all rows with the id that stays are kept.
    An empty table gives an empty result. Other columns are ignored.
    """
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn("key", F.expr(f"shiftrightunsigned(xxhash64(norm), {64 - key_bits})"))
    rows = written(texts.select("id", "key", F.unhex(F.sha2("norm", 256)).alias("sha")), "rows")
    keys = written(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("id"), F.max("sha").alias("sha")), "keys")
    buckets = directory(keys.select("key"), capacity, min_depth, key_bits)

    # The index: bucket, bucket_depth, key, n, chain. Bytes move for keys met twice only.
    link = lambda sha, keep, size: F.struct(F.col(sha).alias("sha"), F.col(keep).alias("keep_id"), F.col(size).cast("long").alias("group_size"))
    once = in_buckets(keys.filter("n = 1"), buckets, key_bits).select("bucket", "bucket_depth", "key", "n", F.array(link("sha", "id", "n")).alias("chain"))
    twice = in_buckets(_seen(texts, keys.filter("n > 1").select("key")), buckets, key_bits)
    distinct = twice.groupBy("bucket", "bucket_depth", "key", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    distinct = distinct.select("bucket", "bucket_depth", "key", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    owned = distinct.repartitionByRange("bucket").groupBy("bucket", "bucket_depth", "key").agg(F.sum("group_size").alias("n"), F.sort_array(F.collect_list(link("sha", "keep_id", "group_size"))).alias("chain")).filter("n > 1")
    path = new_path(docs.sparkSession, "hash-index")
    once.unionByName(owned).repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key").write.parquet(path)
    index = docs.sparkSession.read.schema(once.schema).parquet(path)

    # Look-up. A chain of one text answers for all rows of its key.
    alone = index.filter("size(chain) = 1").select("key", "n", F.col("chain")[0]["keep_id"].alias("keep_id"), F.col("chain")[0]["group_size"].alias("group_size"), "bucket", "bucket_depth")
    found = spread_join(rows, alone, "key", "n")
    out = found.select("id", "sha", "keep_id", "group_size", "bucket", "bucket_depth")
    collided = written(index.filter("size(chain) > 1").select("key", "bucket", "bucket_depth"), "collided")
    if collided.limit(1).count():  # the bytes of such rows choose among the chain's texts
        mine = _seen(texts, collided.select("key")).join(if_small(collided), "key")
        several = mine.groupBy("key", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        mine = mine.join(several.withColumnRenamed("key", "_key").withColumnRenamed("norm", "_norm"), (F.col("key") == F.col("_key")) & (F.col("norm") == F.col("_norm")))
        out = out.unionByName(mine.select("id", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size", "bucket", "bucket_depth"))
    return out.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "bucket",
        "bucket_depth",
    )


#: The index's bucket columns are checked by tests; the oracle has the contract's columns.
QUERY_COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]

ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, false) AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
