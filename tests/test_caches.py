"""Hits, expiry, versions, readers at once, and crashes in between."""

import pytest
from pyspark.sql import functions as F

from tesserine.streaming import caches, incremental


def test_listing_hits_expires_and_follows_its_version(spark, tmp_path):
    root, loads, clock = f"file://{tmp_path}/c", [], [100.0]

    def load():
        loads.append(1)
        return spark.range(len(loads))

    get = lambda v: caches.cached_listing(spark, root, v, load, 30, lambda: clock[0])
    one, hit = get("v1")
    assert (one.count(), hit) == (1, False)
    clock[0] = 129.9
    assert [x if isinstance(x, bool) else x.count() for x in get("v1")] == [1, True]
    two, hit = get("v2")
    assert (two.count(), hit, len(loads)) == (2, False, 2)
    clock[0] = 160.0
    three, hit = get("v2")
    assert (three.count(), hit) == (3, False)
    # the table of the version before is still there for its readers; older ones go
    caches.sweep(spark, root)
    assert (two.count(), three.count()) == (2, 3)
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT"):
        one.collect()


def test_failed_load_leaves_the_old_listing(spark, tmp_path):
    root = f"file://{tmp_path}/c"
    caches.cached_listing(spark, root, "v1", lambda: spark.range(4))
    held = caches.pointer(spark, root)

    def broken():
        return spark.range(9).select(F.raise_error(F.lit("no disk")).cast("long").alias("id"))

    with pytest.raises(Exception, match="no disk"):
        caches.cached_listing(spark, root, "v2", broken)
    assert caches.pointer(spark, root) == held and caches.cached_listing(spark, root, "v1", broken)[0].count() == 4


def test_two_readers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/c"
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: caches.cached_listing(spark, root, f"v{i % 2}", lambda: spark.range(10))[0].count(), range(8)))
    assert got == [10] * 8 and caches.cached_listing(spark, root, caches.pointer(spark, root)["version"], lambda: spark.range(0))[1]


def test_only_changed_runs_are_built(spark, tmp_path):
    root, built = f"file://{tmp_path}/r", []

    def build(runs):
        built.append(sorted(r["run"] for r in runs.collect()))
        return runs.select("run", F.lit(len(built)).alias("round"), F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))

    def refresh(files, **more):
        df = spark.createDataFrame([(r, f"{r}/{p}", s, m) for r, p, s, m in files], "run string, path string, size long, mtime long")
        return caches.refresh_runs(spark, root, df, build, **more)

    rows = lambda: {(r["run"], r["round"]) for r in caches.read_runs(spark, root).collect()}
    files = [("a", "m", 1, 1), ("a", "n", 1, 1), ("b", "m", 1, 1), ("c", "m", 1, 1)]
    assert refresh(files) == {"built": 3, "kept": 0, "gone": 0}
    pinned = caches.read_runs(spark, root)
    assert refresh(files[::-1]) == {"built": 0, "kept": 3, "gone": 0} and len(built) == 1
    assert refresh([("a", "m", 1, 2), *files[1:3], ("d", "m", 1, 1)]) == {"built": 2, "kept": 1, "gone": 1}
    assert built[1] == ["a", "d"] and rows() == {("a", 2), ("b", 1), ("d", 2)}
    assert {(r["run"], r["round"]) for r in pinned.collect()} == {("a", 1), ("b", 1), ("c", 1)}
    assert refresh([("b", "m", 1, 1), ("d", "m", 1, 1)]) == {"built": 0, "kept": 2, "gone": 1} and rows() == {("b", 1), ("d", 2)}
    assert refresh([("b", "m", 5, 1), ("d", "m", 1, 1)], most_parts=1) == {"built": 1, "kept": 1, "gone": 0}
    assert rows() == {("b", 3), ("d", 2)} and len(caches.pointer(spark, root)["parts"]) == 1
    assert caches.read_runs(spark, root).count() == 4
    with pytest.raises(FileNotFoundError):
        caches.read_runs(spark, f"{root}-none")


RECORD = "kind string, object_key string, source_model_id string, instruction_index int, status string, line long"


def test_progress_survives_a_crash_between_sinks(spark, tmp_path):
    inbox, root = tmp_path / "in", f"file://{tmp_path}/out"
    inbox.mkdir()
    manifest = spark.createDataFrame([("run", "running")], "experiment_id string, status string")
    sums = []

    def summary(objects, edits):
        sums.append(1)
        if len(sums) == 2:
            raise RuntimeError("lost the driver")
        return edits.groupBy("status").agg(F.count("*").alias("n"))

    sinks = caches.progress_sinks(spark, root, manifest, summary)
    calls = []
    counted = {name: (lambda b, i, name=name, sink=sink: (calls.append((name, i)), sink(b, i))) for name, sink in sinks.items()}

    def run():
        incremental.run_once(incremental.read_events(spark, str(inbox), RECORD), f"{tmp_path}/check", caches.into_sinks(spark, f"{root}/ledger", counted))

    put = lambda name, rows: (inbox / name).write_text("\n".join('{"kind": "%s", "object_key": "%s", "source_model_id": "%s", "instruction_index": %d, "status": "%s", "line": %d}' % r for r in rows))  # noqa: E731, UP031
    put("1.json", [("object", "o1", "m1", 0, "s", 1), ("edit", "o1", "m1", 1, "pending", 2), ("edit", "o1", "m1", 2, "passed", 3)])
    run()
    put("2.json", [("edit", "o1", "m1", 1, "passed", 5), ("edit", "o1", "m1", 1, "failed", 4), ("object", "o2", "m2", 0, "s", 6)])
    with pytest.raises(Exception, match="lost the driver"):
        run()
    run()
    assert calls == [*[(n, 0) for n in sinks], *[(n, 1) for n in ("edit_records", "object_records", "summary")], ("summary", 1), ("manifest", 1)]
    edits = {(r["source_model_id"], r["instruction_index"]): r["status"] for r in spark.read.parquet(f"{root}/edit_records").collect()}
    assert edits == {("m1", 1): "passed", ("m1", 2): "passed"} and spark.read.parquet(f"{root}/object_records").count() == 2
    assert [tuple(r) for r in spark.read.json(f"{root}/summary").select("status", "n").collect()] == [("passed", 2)]
    assert spark.read.json(f"{root}/manifest").select("progress.*").first().asDict() == {"object_record_count": 2, "edit_record_count": 2}
