import itertools
import zlib

import numpy as np

from tesserine.llm import quality_crf as Q


def test_marginals_equal_brute_force():
    r = np.random.default_rng(0)
    sizes = np.array([1, 5, 3, 7])
    pot, ties = r.normal(size=sizes.sum()), r.normal(size=(2, 2))
    f, b = Q.messages(pot, sizes, ties)
    got = 1 / (1 + np.exp(-(f + b)))
    at = 0
    for n in sizes:
        p, marg, z = pot[at : at + n], np.zeros(n), 0.0
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(p[i] for i in range(n) if y[i]) + sum(ties[y[i - 1], y[i]] for i in range(1, n)))
            z += w
            marg += w * np.array(y)
        assert np.allclose(got[at : at + n], marg / z)
        at += n


def test_held_out_accuracy_and_columns(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r["doc_id"]: r for r in Q.query(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.7) for i, r in rows.items())
    held = [(r["quality"], rows[r["doc_id"]]["predicted"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "word " * 60_000), (None, "a"), (4, "word " * 60_000)]
    docs = spark.createDataFrame([(i, t, 9, "z") for i, t in rows], "doc_id long, text string, score int, y string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.classify(docs, Q.train(docs, none))
    assert got.count() == 6 and got.filter("_predicted = 1").count() == 6 and got.columns[:4] == docs.columns
    one = spark.createDataFrame([(i, 0) for i in range(1, 5)] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert Q.classify(docs, Q.train(docs, one)).filter("_predicted = 1").count() == 0
    assert Q.classify(docs.limit(0), Q.train(docs.limit(0), one)).count() == 0


def test_score_depends_on_the_text_alone():
    texts = ["A good line of prose.\nAnother one here.", "X!! Y!! Z!!", "", None, "|a|b|"]
    codes, lengths = zip(*Q.line_codes(texts * 3), strict=True)
    model = Q.fit(list(codes), list(lengths), np.array([1, 0, 1, 1, 0] * 3))
    whole = model.score(texts)[0]
    assert np.allclose(whole, [model.score([t])[0][0] for t in texts]) and whole[0] > whole[1]
