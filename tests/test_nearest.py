import math

import numpy as np

from tesserine.operators import nearest


def test_nearest_equals_brute_force_and_prunes(spark, monkeypatch):
    r = np.random.default_rng(4)
    at = r.normal(size=(12, 3)) * 50
    points = lambda n, seed: [(int(i % 5 == 0), i, [float(x) for x in at[(i * 7 + seed) % 12] + r.normal(size=3)]) for i in range(n)]
    x, y = points(150, 1), points(400, 2) + [(1, 1000 + i, [1.0, 2.0, 3.0]) for i in range(50)]
    frame = lambda rows: spark.createDataFrame(rows, "k int, id int, p array<double>")
    monkeypatch.setattr(nearest, "BLOCK", 16)
    got = {(i["k"], i["id"]): i["distance"] for i in nearest.nearest(frame(x), frame(y), "k", "p", "id").collect()}
    assert got.keys() == {(k, i) for k, i, _ in x}
    assert all(abs(got[k, i] - min(math.dist(p, q) for j, _, q in y if j == k)) < 1e-9 for k, i, p in x)


def test_every_adjacent_pair_of_labels_is_compared(spark, sf_dir):
    from tesserine.plans import registry

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", "embedding").collect()
    sets = {}
    for label, e in rows:
        sets.setdefault(label, []).append(e)
    want = {}
    for i in sets:
        if i + 1 in sets:
            x, y = np.array(sets[i], float), np.array(sets[i + 1], float)
            d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
            want[i] = (d.min(axis=1).mean() + d.min(axis=0).mean(), max(d.min(axis=1).max(), d.min(axis=0).max()))
    got = {r["pair"]: (r["chamfer"], r["hausdorff"]) for r in registry.queries()["nn_chamfer_all"](spark, sf_dir).collect()}
    assert len(want) > 1 and got.keys() == want.keys()
    assert all(abs(a - b) < 2e-5 for i in want for a, b in zip(got[i], want[i], strict=True))


def test_points_that_nothing_prunes_are_sent_once_a_chunk(spark, monkeypatch):
    r = np.random.default_rng(8)
    x, y = r.normal(size=(300, 48)), r.normal(size=(400, 48))
    frame = lambda p: spark.createDataFrame([(0, i, [float(v) for v in q]) for i, q in enumerate(p)], "k int, id int, p array<double>")
    most, write = [], nearest.written

    def kept(df, tag):
        out = write(df, tag)
        most.append(out.count())
        return out

    monkeypatch.setattr(nearest, "written", kept)
    got = {i["id"]: i["distance"] for i in nearest.nearest(frame(x), frame(y), "k", "p", "id").collect()}
    want = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2)).min(axis=1)
    assert len(got) == 300 and all(abs(got[i] - want[i]) < 1e-12 for i in got)
    assert max(most) <= 400


def test_nearest_over_many_chunks_and_odd_points(spark, monkeypatch):
    monkeypatch.setattr(nearest, "VALUES", 3 * 16)
    r = np.random.default_rng(5)
    at = r.normal(size=(6, 3)) * 20
    points = lambda n: [(i % 3, i, [float(v) for v in at[i % 6] + r.normal(size=3)]) for i in range(n)]
    x, y = points(200), points(260) + [(0, 900 + i, [5.0, 5.0, 5.0]) for i in range(40)]
    odd = [(0, 990, None), (0, 991, [1.0, None, 2.0]), (7, 992, [0.0, 0.0, 0.0])]
    wild = [(0, 993, [float("nan"), 0.0, 0.0]), (0, 994, [float("inf"), 0.0, 0.0])]
    frame = lambda rows: spark.createDataFrame(rows, "k int, id int, p array<double>")
    got = {(i["k"], i["id"]): i["distance"] for i in nearest.nearest(frame(x + odd), frame(y + odd[:2] + wild), "k", "p", "id").collect()}
    assert got.keys() == {(k, i) for k, i, _ in x}  # no point of b has key 7
    assert all(abs(got[k, i] - min(math.dist(p, q) for j, _, q in y if j == k)) < 1e-12 for k, i, p in x)
