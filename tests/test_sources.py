import json

import pytest
from pyspark.sql import functions as F

from tesserine.sources import readers, schemas, writers
from tesserine.streaming import incremental


def test_strict_and_tolerant(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\n{"a": 2}\n')
    assert {r["a"] for r in readers.read_jsonl(spark, str(p), "a int").collect()} == {1, 2}
    p.write_text('{"a": 1}\n\nbroken\n{"a": 2, "b": 3}\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ|parse"):
        readers.read_jsonl(spark, str(p), "a int").collect()
    good, bad = readers.read_jsonl_tolerant(spark, str(p), "a int")
    assert {r["a"] for r in good.collect()} == {1, 2} and [r["line"] for r in bad.collect()] == ["broken"]
    gone = str(tmp_path / "gone.jsonl")
    assert readers.read_jsonl(spark, gone, "a int").count() == 0
    assert readers.read_jsonl_tolerant(spark, gone, "a int")[0].count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_jsonl(spark, gone, "a int", required=True)


def test_documents(spark, tmp_path):
    p = tmp_path / "d.json"
    for body, want in (('{"a": 5}', 5), ("", -1), ("{", -1)):
        p.write_text(body)
        assert readers.read_document_or(spark, str(p), "a int", {"a": -1}).collect()[0]["a"] == want
    assert readers.read_document_or(spark, str(tmp_path / "no"), "a int", {"a": -1}).first()["a"] == -1
    for i in (1, 2):
        (tmp_path / f"r{i}").mkdir()
        (tmp_path / f"r{i}" / "manifest.json").write_text(json.dumps({"experiment_id": f"e{i}", "plan_path": "p", "started_at": f"2024-0{i}"}, indent=1))
    rows = readers.catalog(spark, f"{tmp_path}/r*/manifest.json", schemas.MANIFEST, {"plan_path": "p", "name": None}).collect()
    assert [r["experiment_id"] for r in rows] == ["e2", "e1"]
    assert readers.read_plan(spark, '{"n": 2}', "n int").first()["n"] == 2


def test_logs(spark, tmp_path):
    p = tmp_path / "run.log"
    p.write_text("started id=e1\nstarted id=e2\nedit=a said=go on now score=0.5 ok\nedit=a score=0.7\nedit=b said=x\npassed edit=a k=1\npassed edit=a\n")
    lines = readers.numbered_lines(spark, str(p))
    assert [r["line_no"] for r in lines.orderBy("line_no").collect()] == list(range(1, 8))
    assert readers.log_experiment(lines, "^finished id=(\\S+)", "^started id=(\\S+)").first()["experiment_id"] == "e2"
    rows = readers.log_manifest(lines, "^passed", "edit", "said", "score").collect()
    assert [(r["edit_id"], r["instruction"], r["score"]) for r in rows] == [("a", "go on now", 0.7)]


def test_assets_and_lookups(spark, tmp_path):
    (tmp_path / "m1").mkdir()
    (tmp_path / "m1" / "model.glb").write_bytes(b"xx")
    files = readers.asset_files(spark, str(tmp_path), "*.glb")
    assert files.select("size").first()[0] == 2
    payloads = spark.createDataFrame([("a", '{"k": 1}'), ("b", "bad")], "id string, payload_json string")
    assert readers.point_lookup(payloads, "a", "k int").first()["payload"]["k"] == 1
    assert readers.point_lookup(payloads, "b", "k int").count() == 0
    pairs = spark.range(5).withColumnRenamed("id", "index")
    assert readers.indexed_slice(pairs, 2, 2).count() == 2
    with pytest.raises(ValueError):
        readers.indexed_slice(pairs, 9, 1)
    old = spark.createDataFrame([("e1", 1)], "experiment_id string, n int")
    rec = spark.createDataFrame([("e1", 9), ("e2", 2)], "experiment_id string, n int")
    assert {(r["n"], r["partial_recovered"]) for r in readers.records_or_recovered(old, rec, "experiment_id").collect()} == {(1, False), (2, True)}
    text = spark.createDataFrame([("# c",), (" a/b.PNG ",), ("x.txt",), ("",)], "value string")
    assert [r["path"] for r in readers.image_paths(text).collect()] == ["a/b.PNG"]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, {"a": 1}, [1, 2])], "i int, m map<string,int>, l array<int>")
    writers.write_jsonl(df, f"{tmp_path}/j")
    writers.write_jsonl(df, f"{tmp_path}/j", append=True)
    assert readers.read_jsonl(spark, f"{tmp_path}/j", "i int").count() == 2
    writers.write_csv(df, f"{tmp_path}/c")
    row = spark.read.option("header", True).csv(f"{tmp_path}/c").first()
    assert row["m"] == '{"a":1}' and row["l"] == "[1,2]"
    writers.write_csv(df.limit(0), f"{tmp_path}/e")
    assert [r[0] for r in spark.read.csv(f"{tmp_path}/e").collect()] == ["empty"]
    path = f"{tmp_path}/t"
    writers.replace_table(spark, spark.range(3), path)
    writers.replace_table(spark, spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    up = writers.updated(spark.range(2), F.col("id") == 1, {"id": F.lit(7)})
    assert sorted(r["id"] for r in up.collect()) == [0, 7]


def test_stream_upsert_and_resume(spark, tmp_path):
    src, table, mark = tmp_path / "in", f"{tmp_path}/table", f"{tmp_path}/mark"
    src.mkdir()
    (src / "1.json").write_text('{"k": "a", "n": 1, "v": 10}\n{"k": "a", "n": 2, "v": 11}\n{"k": "b", "n": 1, "v": 5}\n')
    go = lambda: incremental.run_once(incremental.read_events(spark, str(src), "k string, n int, v int"), mark, incremental.upsert_into(table, ["k"], "n"))
    go()
    assert {(r["k"], r["v"]) for r in spark.read.parquet(table).collect()} == {("a", 11), ("b", 5)}
    (src / "2.json").write_text('{"k": "b", "n": 3, "v": 6}\n{"k": "c", "n": 3, "v": 7}\n')
    go()
    go()
    assert {(r["k"], r["v"]) for r in spark.read.parquet(table).collect()} == {("a", 11), ("b", 6), ("c", 7)}


def test_reconcile(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")], "id string, v int, body string")
    snap = spark.createDataFrame([("a", 1), ("b", 2), ("d", 1)], "id string, v int")
    new, counts = incremental.reconcile(old, snap, "id", "v", lambda df: df.withColumn("body", F.lit("new")))
    assert {tuple(r) for r in new.select("id", "body").collect()} == {("a", "x"), ("b", "new"), ("d", "new")}
    assert {r["action"]: r["count"] for r in counts.collect()} == {"keep": 1, "update": 1, "delete": 1, "add": 1}
    gone = incremental.refresh_one(old, snap, "id", "c", lambda df: df.withColumn("body", F.lit("new")))
    assert {r["id"] for r in gone.collect()} == {"a", "b"}
    assert incremental.versioned(spark, old, 1, 2).count() == 0


def test_export_of_a_day(spark, tmp_path):
    head = spark.createDataFrame([("set", 2)], "name string, samples long")
    samples = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    out = writers.write_export(head, samples, str(tmp_path), "set", "2024-01-02")
    assert out.endswith("exports/set_2024-01-02")
    assert spark.read.json(f"{out}/manifest.json").first()["samples"] == 2 and spark.read.json(f"{out}/manifest.jsonl").count() == 2


def test_catalog_rejects(spark, tmp_path):
    whole = {"experiment_id": "e1", "source_provider": "s", "target_provider": "t", "plan_path": "p", "started_at": "2024-01"}
    for name, body in {"a": json.dumps(whole, indent=1), "b": "{broken", "c": json.dumps(whole | {"experiment_id": "e2", "finished_at": "2024-02"}), "d": json.dumps(whole | {"plan_path": " "}), "e": json.dumps(whole | {"totals": [1]}), "f": "[1]", "g": json.dumps(whole | {"experiment_id": "e3", "plan_path": "q"}), "h": ""}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "manifest.json").write_text(body)
    rows, rejects = readers.catalog_or_rejects(spark, f"{tmp_path}/*/manifest.json", schemas.MANIFEST, {"plan_path": "p", "source_provider": None})
    assert [r["experiment_id"] for r in rows.collect()] == ["e2", "e1"]
    got = {r["path"].split("/")[-2]: r["error"] for r in rejects.collect()}
    assert {k: v for k, v in got.items() if k != "h"} == {"b": "not a JSON object", "d": "missing plan_path", "e": "a field has another type", "f": "not a JSON object"}
    none = readers.catalog_or_rejects(spark, f"{tmp_path}/none/*.json", schemas.MANIFEST, {})
    assert [x.count() for x in none] == [0, 0]


def test_prompt_batches(spark, tmp_path):
    (tmp_path / "batch_1.jsonl").write_text("".join(json.dumps({"id": f"a{i}"}) + "\n\n" for i in range(40)))
    (tmp_path / "batch_2.jsonl").write_text(json.dumps({"id": "b0", "prompt": "x"}) + "\n" + json.dumps({"prompt_id": "b1"}))
    got = readers.prompt_batches(spark, f"{tmp_path}/*.jsonl", "id string, prompt string, prompt_id string").collect()
    assert [r["id"] or r["prompt_id"] for r in got] == ["b0", "b1", *[f"a{i}" for i in range(40)]]
    assert [(r["source_file"], r["position"], r["keys"]) for r in got[:3]] == [("batch_2.jsonl", 1, ["id", "prompt"]), ("batch_2.jsonl", 2, ["prompt_id"]), ("batch_1.jsonl", 1, ["id"])]
    assert readers.prompt_batches(spark, f"{tmp_path}/none*.jsonl", "id string").count() == 0
