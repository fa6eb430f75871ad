"""Operator 13 against the same descent in plain code, and its law of movement."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tesserine.llm import registry, sharding
from tesserine.llm.sharding import Shard, even_tree

SCHEMA = "doc_id long, text string, shard string, slot int, size int, law string, _file int"


def uniform(key, path, attempt):
    h = xxhash.xxh64(key.encode(), seed=42).intdigest() if key is not None else 42
    h = xxhash.xxh64(path.encode(), seed=h).intdigest()
    return ((xxhash.xxh64(attempt.to_bytes(4, "little"), seed=h).intdigest() >> 12) + 0.5) / 2.0**52


def plain(key, tree, attempts=sharding.ATTEMPTS):
    key = None if key is None else str(key)
    for t in range(attempts):
        path, under = "", tree
        for depth in range(3):
            room = defaultdict(float)
            for s in under:
                room[s[depth]] += s.room
            at = min(room, key=lambda c: -math.log(uniform(key, f"{path}/{c}", t)) / room[c] if len(room) > 1 else 0)
            path, under = f"{path}/{at}", [s for s in under if s[depth] == at]
        s = under[0]
        if s.weight >= s.room or s.weight > 0 and uniform(key, f"{path}?", t) < s.weight / s.room:
            return s.shard
    open_ = [s for s in tree if s.weight > 0]
    return min(open_, key=lambda s: -math.log(uniform(key, f"flat/{s.shard}", attempts)) / s.weight).shard


UNEVEN = [Shard("a", "x", 0, 0.5, 2.0), Shard("a", "x", 4, 2.0, 2.0), Shard("a", "y", 1, 1.0, 1.0), Shard("b", "x", 2, 0.0, 3.0), Shard("b", "z", 3, 1.5, 2.0)]


@pytest.mark.parametrize("tree", [even_tree(8), even_tree(9), even_tree(1), UNEVEN])
def test_equals_plain_descent(spark, tree):
    ids = [*range(400), None, -5, 2**62]
    got = spark.createDataFrame([(i,) for i in ids], "k long").select("k", sharding.shard_of(F.col("k"), tree).alias("s")).collect()
    assert {(r["k"], r["s"]) for r in got} == {(i, plain(i, tree)) for i in ids}


def test_few_attempts_end_in_a_flat_draw(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ATTEMPTS", 1)
    for tree in (even_tree(2), even_tree(3)):
        got = spark.range(300).select("id", sharding.shard_of(F.col("id"), tree).alias("s")).collect()
        assert {(r["id"], r["s"]) for r in got} == {(i, plain(i, tree, 1)) for i in range(300)}


@pytest.mark.parametrize("shards", range(1, 12))
def test_one_more_shard_takes_rows_only_into_itself(spark, shards):
    moved = sharding.movement(spark.range(6000).withColumnRenamed("id", "doc_id"), even_tree(shards), even_tree(shards + 1)).collect()
    assert all(r["from_shard"] == r["to_shard"] or r["to_shard"] == shards for r in moved)
    took = sum(r["rows"] for r in moved if r["to_shard"] == shards)
    assert abs(took - 6000 / (shards + 1)) < 6 * math.sqrt(6000 / (shards + 1))


def test_weights_and_their_changes(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    count = Counter({r["to_shard"]: r["rows"] for r in sharding.movement(ids, [Shard("a", "x", 0, 1.0)], UNEVEN).collect()})
    assert set(count) == {0, 1, 3, 4} and all(abs(count[s.shard] - 20000 * s.weight / 5) < 400 for s in UNEVEN)
    for at, weight in ((0, 1.8), (2, 3.0), (3, 0.25)):
        other = [s._replace(weight=weight) if s.shard == at else s for s in UNEVEN]
        rise = weight > next(s.weight for s in UNEVEN if s.shard == at)
        for r in sharding.movement(ids, UNEVEN, other).collect():
            assert r["from_shard"] == r["to_shard"] or at == r["to_shard" if rise else "from_shard"]
    # with nothing vacant, another room in region b moves rows only into b, or within it
    full = [s._replace(weight=s.room) for s in UNEVEN]
    other = [s._replace(room=6.0, weight=6.0) if s.shard == 2 else s for s in full]
    moved = [r for r in sharding.movement(ids, full, other).collect() if r["from_shard"] != r["to_shard"]]
    assert moved and all(r["to_shard"] in (2, 3) for r in moved)


def test_bad_trees(spark):
    for tree in ([], [Shard("a", "x", 0, 0.0)], [Shard("a", "x", 0, 2.0)], [Shard("a", "x", 0, 1.0), Shard("b", "x", 0, 1.0)]):
        with pytest.raises(ValueError, match="weight"):
            sharding.shard_of(F.lit(1), tree)
    with pytest.raises(ValueError, match="room"):
        even_tree(13)


def answer(rows):
    return [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", plain(i, even_tree(8)), plain(i, even_tree(9))) for i, t in rows]


def test_rows(spark):
    rows = [(i, f"text é {i % 7}") for i in range(500)] + [(3, None), (None, None), (None, "a"), (3, "text"), (3, "text"), (9, ""), (10, "x" * 3_000_000)] + [(77, "hot")] * 300
    df = spark.createDataFrame([(*r, "s", 1, 2, "l", 3) for r in rows], SCHEMA).repartition(6)
    got = sharding.sharded(df, even_tree(8), even_tree(9)).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got), key=repr) == sorted(answer(rows), key=repr)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.query(df.limit(0)).count() == 0


def test_many_small_files(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"))
    got = sharding.numbered(df.repartition(5), "g", "n", file_rows=97).collect()
    for g in range(3):
        assert sorted(r["n"] for r in got if r["g"] == g) == list(range(sum(i % 3 == g for i in range(5000))))


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    sharding.write_shards(df, str(tmp_path / "out"), even_tree(8))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r["doc_id"], r["text"], r["shard"]) for r in got} == {(i, f"t{i}", plain(i, even_tree(8))) for i in range(200)}
    with pytest.raises(ValueError, match="already"):
        sharding.write_shards(df.withColumn("shard", F.lit(1)), str(tmp_path / "more"), even_tree(8))


def test_query_over_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.queries()["op13_sharding"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got) == sorted(answer(rows))
