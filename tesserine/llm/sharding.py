"""Sharding by a hierarchical weighted hash tree (operator 13).

Only DataFrame functions. A tree has regions, racks and shards; a shard has a weight, up to
the room kept for it, and the room of a rack or region is that of the shards below. Slots
for shards to come are part of the tree, with weight 0.

1. Descent. A key draws a region, then a rack in it, then a shard in that: at each level
   every child gets the waiting time -ln(u) / room, u hashed from the key, the child's path
   and the attempt, and the least one wins, so children win in proportion to their room.
2. Acceptance. The shard takes the key with chance weight / room, by another hash; else the
   key descends again as the next attempt. So shards get keys in proportion to weight.
3. Movement. Attempts depend on rooms only. Raising a shard's weight, or putting one into a
   vacant slot, only lets it accept keys that it refused, so rows move into it alone;
   lowering it moves rows out of it alone. Where nothing is vacant, changing a room moves
   rows only into, out of or within the subtrees whose room changes.
   After `ATTEMPTS` refusals (a chance of vacant room ** ATTEMPTS) one flat draw among all
   shards by weight decides, for which the same holds.

Places within a shard (slots) are numbered by file and row of the written table, so no
shard, however large, is gathered or sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, new_path, written

ATTEMPTS = 48


class Shard(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float
    room: float = 1.0


def even_tree(shards: int, regions: int = 2, racks: int = 2, slots: int = 3) -> list[Shard]:
    """regions x racks x slots of room 1 each, of which the first `shards`, dealt over
    regions, then racks, have weight 1 and the others 0."""
    if shards > regions * racks * slots:
        raise ValueError("the tree has no such room; give it more regions, racks or slots")
    return [Shard(f"region{s % regions}", f"rack{s // regions % racks}", s, float(s < shards)) for s in range(regions * racks * slots)]


def _uniform(key: Column, path: str, attempt: Column) -> Column:
    """In (0, 1), hashed from the key, the child's path and the attempt."""
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(path), attempt), 12) + F.lit(0.5)) / F.lit(2.0**52)


def _wait(key: Column, path: str, rate: float, attempt: Column) -> Column:
    return -F.log(_uniform(key, path, attempt)) / F.lit(rate)


def _least(choices: Sequence[tuple[Column, int | str]]) -> Column:
    """The value with the least waiting time, the first of equals."""
    if len(choices) == 1:
        return F.lit(choices[0][1])
    return F.array_min(F.array(*[F.struct(wait.alias("wait"), F.lit(i).alias("i"), F.lit(value).alias("value")) for i, (wait, value) in enumerate(choices)]))["value"]


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), value computed once."""
    return F.transform(F.array(value), then)[0]


def _descend(tree: Sequence[Shard], key: Column, attempt: Column, path: str = "") -> Column:
    """The shard where one attempt arrives, null if it refuses. path names the levels above."""
    depth = path.count("/")
    if depth == 2:
        arrive = _least([(_wait(key, f"{path}/{s.shard}", s.room, attempt), s.shard) for s in tree])
        taken = lambda s: F.lit(True) if s.weight >= s.room else _uniform(key, f"{path}/{s.shard}?", attempt) < s.weight / s.room
        open_ = [s for s in tree if s.weight > 0]
        return _with(arrive, lambda at: F.coalesce(F.lit(None).cast("int"), *[F.when((at == s.shard) & taken(s), F.lit(s.shard)) for s in open_]))
    below: dict[str, list[Shard]] = {}
    for s in tree:
        below.setdefault(s[depth], []).append(s)
    arrive = _least([(_wait(key, f"{path}/{name}", sum(s.room for s in under), attempt), name) for name, under in below.items()])
    return _with(arrive, lambda at: F.coalesce(*[F.when(at == name, _descend(under, key, attempt, f"{path}/{name}")) for name, under in below.items()]))


def shard_of(key: Column, tree: Sequence[Shard]) -> Column:
    """The shard of a key of any type; null is a key of its own. Equal keys go together."""
    if not any(s.weight > 0 for s in tree):
        raise ValueError("a tree needs a shard with some weight")
    if any(not 0 <= s.weight <= s.room or s.room <= 0 for s in tree) or len({s.shard for s in tree}) < len(tree):
        raise ValueError("weights lie between 0 and the room, and shards have numbers of their own")
    key = key.cast("string")
    none = F.lit(None).cast("int")
    found = F.aggregate(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1)), none, lambda held, attempt: F.coalesce(held, _descend(tree, key, attempt)))
    flat = _least([(_wait(key, f"flat/{s.shard}", s.weight, F.lit(ATTEMPTS)), s.shard) for s in tree if s.weight > 0])
    return F.coalesce(found, flat)


def numbered(rows: DataFrame, by: str, name: str, file_rows: int = 1_000_000) -> DataFrame:
    """rows with their number from 0 among those of equal `by`, without gaps. They are
    written in files of at most `file_rows`; a window sees the rows of one file and value
    only, and one over files adds up what came before."""
    path = new_path(rows.sparkSession, "numbered")
    rows.write.option("maxRecordsPerFile", file_rows).parquet(path)
    held = rows.sparkSession.read.schema(rows.schema).parquet(path)
    held = held.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = held.groupBy("_file", by).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(by).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(counts.select("_file", by, F.coalesce(before, F.lit(0)).alias("_start")), "starts")
    inside = F.row_number().over(Window.partitionBy("_file", by).orderBy("_row")) - 1
    out = held.withColumn("_inside", inside).join(if_small(starts), ["_file", by])
    return out.withColumn(name, (F.col("_start") + F.col("_inside")).cast("long")).drop("_file", "_row", "_inside", "_start")


def movement(docs: DataFrame, before: Sequence[Shard], after: Sequence[Shard], id_col: str = "doc_id") -> DataFrame:
    """from_shard, to_shard, rows: what a change of the tree moves, and what stays."""
    key = F.col(id_col)
    return docs.select(shard_of(key, before).alias("from_shard"), shard_of(key, after).alias("to_shard")).groupBy("from_shard", "to_shard").agg(F.count("*").alias("rows"))


def write_shards(docs: DataFrame, path: str, tree: Sequence[Shard], id_col: str = "doc_id", shard_col: str = "shard") -> None:
    """Writes docs under path, a folder a shard. Rows are rebalanced by shard, which splits a
    shard larger than a file among tasks. docs must have no column named shard_col."""
    if shard_col in docs.columns:
        raise ValueError(f"there is a column {shard_col} already; name another")
    docs.withColumn(shard_col, shard_of(F.col(id_col), tree)).hint("rebalance", shard_col).write.partitionBy(shard_col).parquet(path)


def sharded(docs: DataFrame, tree: Sequence[Shard], grown: Sequence[Shard], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row a document.

    Size is the text's UTF-8 bytes and 1; a null text has none, and the checksum of no bytes.
    The key is the id: rows with one id, or without any, go to one shard, each with a slot
    of its own. Slots follow the written rows. An empty table gives an empty result; other
    columns are ignored."""
    key, raw = F.col(id_col), F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(key.alias("doc_id"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"), shard_of(key, tree).alias("shard"), shard_of(key, grown).alias("grown_shard"))
    return numbered(rows, "shard", "slot").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def query(docs: DataFrame, shards: int = 8) -> DataFrame:
    """documents in shards 0 to 7, and with one shard more."""
    return sharded(docs, even_tree(shards), even_tree(shards + 1))
