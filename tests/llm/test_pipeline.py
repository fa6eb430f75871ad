import hashlib

import corpus_pipeline as P
from tesserine.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_crf


def test_each_stage_on_its_own_input(spark):
    sf = "/root/testdata/sf0.01"
    table = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    docs = table("documents")
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontaminate", "mix"]
    kept = P.quality(spark, docs, sf).cache()
    scores = {r["doc_id"]: r["_predicted"] for r in quality_crf.classify(docs, quality_crf.train(docs, table("labels"))).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, p in scores.items() if p} and kept.columns == docs.columns
    lined = P.lines(spark, kept, sf).cache()
    assert lined.count() == kept.count() and lined.columns == docs.columns
    gone = {r["doc_id"] for r in line_dedup.drop_boilerplate(kept).filter("_n_dropped > 0").collect()}
    before = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert {r["doc_id"] for r in lined.collect() if r["text"] != before[r["doc_id"]]} == gone
    single = P.near_duplicates(spark, lined, sf).cache()
    groups = jaccard_join.jaccard_components(lined).collect()
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in groups}
    clean = P.benchmark_free(spark, single, sf).cache()
    leaks = {r["doc_id"] for r in decontaminate.contaminated(single, table("benchmark")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - leaks and leaks
    mix = P.mix(spark, clean, sf)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).collect()}
    got = [(r["doc_id"], r["copy"]) for r in mix.select("doc_id", "copy").collect()]
    assert sorted(got) == sorted((i, c) for i, n in copies.items() for c in range(1, n + 1))


def test_run_equals_its_stages_and_reruns_agree(spark, sf_dir):
    digest = lambda df: sorted(hashlib.md5(repr(tuple(r)).encode()).hexdigest() for r in df.collect())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    first = digest(docs)
    assert first == digest(P.run(spark, sf_dir)) and first


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0 and docs.columns[-1] == "copy"


LONG = "long words follow each other here " * 12_000
ODD = [
    (None, None, None), (None, "", "x"), (None, LONG, "x"), (900_001, None, "x"), (900_001, None, "x"), (900_002, "", None), (900_003, " \n\t ", "x"), (900_004, LONG, "y"), (900_005, LONG, "z"), (900_006, "one", "x"), (900_006, "one", "x"),
    (900_007, "the same id has one text with enough words to count here", "x"), (900_007, "and another text that shares nothing with what the first one says", "y"),
    (900_008, "the same id has one text with enough words to count here", "x"), (900_009, "and another text that shares nothing with what the first one says", "y"),
]
CLASH = "doc_id long, text string, lang string, source string, n_chars long, copy int, host string, size int, id string, key int, rank int, component_id long, n int, words string, found int"


def odd(spark, sf_dir):
    """All small documents, and rows that are odd in every way, with columns of clashing names."""
    rows = [(i, t, s) for i, t, s in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()] + ODD
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "h", 2, "i", 3, 4, 5, 6, "w", 7) for i, t, s in rows], CLASH).repartition(5)


def bag(df):
    from collections import Counter

    return Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())


def test_quality_takes_odd_rows(spark, sf_dir):
    docs = odd(spark, sf_dir)
    out = P.quality(spark, docs, sf_dir)
    got, had = bag(out), bag(docs)
    assert out.columns == docs.columns and got and not got - had
    # rows of one text are judged alike, null and empty too
    fate = {}
    for row, n in had.items():
        fate.setdefault(row[1] or "", set()).add(got.get(row, 0) == n and n > 0)
    assert all(len(x) == 1 for x in fate.values())


def test_lines_take_odd_rows(spark, sf_dir):
    docs = odd(spark, sf_dir)
    out = P.lines(spark, docs, sf_dir)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = out.collect()
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(r["doc_id"]) for r in docs.collect())
    assert sum(r["text"] is None for r in got) == sum(t is None for _, t, _ in ODD)
    # a line on two pages of a host, and on over a tenth of them, goes; a null host is its own
    pages, held = {}, {}
    for r in docs.collect():
        pages[r["source"]] = pages.get(r["source"], 0) + 1
        for key in {x.strip(" \t\r\x0b\x0c") for x in (r["text"] or "").split("\n")} - {""}:
            held[r["source"], key] = held.get((r["source"], key), 0) + 1
    want = sorted(repr((r["doc_id"], None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if not (held.get((r["source"], k := x.strip(" \t\r\x0b\x0c")), 0) >= 2 and k and held[r["source"], k] > 0.1 * pages[r["source"]])))) for r in docs.collect())
    assert sorted(repr((r["doc_id"], r["text"])) for r in got) == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)


def test_near_duplicates_take_odd_rows(spark, sf_dir):
    docs = odd(spark, sf_dir)
    out = P.near_duplicates(spark, docs, sf_dir)
    gone = bag(docs) - bag(out)
    assert out.columns == docs.columns and not bag(out) - bag(docs)
    ids = {i for i, _, _ in gone}
    # copies of the least id go; rows without words or id stay, as do all rows of the least id
    assert {900_005, 900_008, 900_009} <= ids and not ids & {None, 900_001, 900_002, 900_003, 900_004, 900_006, 900_007}


def test_decontamination_takes_odd_rows(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    more = [(900_020, f"before {item} after", "x"), (900_020, "another row of that id", "x"), (None, item, "x"), (900_021, item, None)]
    docs = odd(spark, sf_dir).unionByName(spark.createDataFrame([(i, t, "en", s, len(t), 1, "h", 2, "i", 3, 4, 5, 6, "w", 7) for i, t, s in more], CLASH))
    out = P.benchmark_free(spark, docs, sf_dir)
    gone = bag(docs) - bag(out)
    assert out.columns == docs.columns and not bag(out) - bag(docs)
    ids = {i for i, _, _ in gone}
    assert {900_020, 900_021} <= ids and None not in ids and not ids & {i for i, _, _ in ODD}
    assert sum(n for (i, _, _), n in gone.items() if i == 900_020) == 2


def test_mix_takes_odd_rows(spark, sf_dir):
    docs = odd(spark, sf_dir)
    out = P.mix(spark, docs, sf_dir)
    assert out.columns == [*docs.columns, "_copy"]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    words = lambda t: len((t or "").split())
    size, taken = {}, {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + words(t)
    for r in out.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + words(r["text"])
        assert 1 <= r["_copy"] <= 2
    targets = {r["source"]: r["target"] for r in mixing.mix(docs).collect()}
    assert all(abs(taken.get(s, 0) - targets[s]) <= max(words(t) for _, t, x in rows if x == s) for s in size)
    # each copy of a row is numbered from 1
    assert all(n <= 2 * bag(docs)[row] for row, n in bag(out).items())
