"""Operator 11 against Lloyd's rounds by plain loops, and its trees against their rules."""

import hashlib
import math
import random

import numpy as np
import pytest

from tesserine.llm import registry, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, vec string, code int, key string, n int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    whole = lambda v: [math.floor(4096 * x) for x in v] + [0] * (width * parts - len(v))
    kept = [(i, v, whole(v), g) for i, v, g in kept]
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, _, v, _ in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda x, book: min(range(len(book)), key=lambda e: (gap(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            mine = [(best(cut(v)[p], books[p]), cut(v)[p]) for _, _, v, _ in kept]
            for e in range(len(books[p])):
                if held := [x for k, x in mine if k == e]:
                    books[p][e] = tuple(sum(c) // len(held) for c in zip(*held, strict=True))
    out, by = [], {}
    for i, _, v, g in kept:
        code = [best(x, b) for x, b in zip(cut(v), books, strict=True)]
        error = sum(gap(x, books[p][code[p]]) for p, x in enumerate(cut(v)))
        by[g] = by.get(g, 0) + error
        out.append((i, "".join(f"{c:02x}" for c in code), error, g))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    top = (1 << 63) - 1
    return sorted(((i, c, min(e, top), min(by[g], top), sha) for i, c, e, g in out), key=repr)


def got(spark, rows, parts=7):
    df = spark.createDataFrame([(*r, "x", 1, "k", 2) for r in rows], SCHEMA).repartition(parts)
    cols = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in vector_codes.query(df).select(cols).collect()), key=repr)


def rows_of(n, dims, seed, spread=0.05):
    r = random.Random(seed)
    centers = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(9)]
    return [(i, [x + r.gauss(0, spread) for x in centers[r.randrange(9)]], r.choice([0, 1, 1, 1, None])) for i in range(n)]


@pytest.mark.parametrize("chunk", [4096, 50])
def test_equals_plain_rounds(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    rows = rows_of(300, 16, 1) + [(1000 + i, [0.25] * 16, 5) for i in range(150)]
    rows += [(None, [0.5] * 16, 1), (7, rows[7][1], 1), (7, [9.0] * 16, None), (2000, None, 1), (2001, [0.1, None] * 8, 1), (2002, [math.nan] * 16, 1), (2003, [math.inf] + [0.0] * 15, 1), (2004, [-math.inf] * 16, 1)]
    assert got(spark, rows) == brute(rows)


def test_ties_uneven_lengths_and_few_rows(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3)] * 8, i % 2) for i in range(60)]
    assert got(spark, grid) == brute(grid)
    uneven = rows_of(40, 16, 3) + [(100, [1.0], 1), (101, [], 1), (102, [0.5] * 19, None)]
    assert got(spark, uneven) == brute(uneven)
    few = rows_of(5, 8, 4)
    assert got(spark, few) == brute(few)
    assert got(spark, few[:1]) == brute(few[:1])
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []
    assert [r[1:3] for r in got(spark, [(1, [], 1), (2, [], 1)])] == [("00" * 8, 0)] * 2


def test_large_components(spark):
    rows = rows_of(60, 8, 5) + [(50 + i, [1e6 * i + 0.3 * j for j in range(8)], i % 3) for i in range(30)] + [(500, [1e30] * 8, 2), (501, [-1e30] * 8, 2)]
    held = [(i, [max(min(x, 2.0**50), -(2.0**50)) for x in v], g) for i, v, g in rows]
    assert got(spark, rows) == brute(held)


def test_trees_keep_their_rules():
    points = np.array([[math.floor(4096 * x) for x in v] for _, v, _ in rows_of(700, 8, 6)], np.int64)
    t = vector_codes.Tree.build(points)
    assert (points[t.order] == t.points).all() and sorted(t.order) == list(range(700))
    m, x = len(t.sizes), t.points.astype(float)
    for k in range(m):
        mine = x[t.starts[k] : t.starts[k + t.sizes[k]]]
        assert np.isclose(t.radius[k], np.sqrt(((mine - x[t.starts[k]]) ** 2).sum(1)).max())
        assert k == 0 or t.parent[k] < k < t.parent[k] + t.sizes[t.parent[k]]
    for seed in range(5):
        book = points[np.random.default_rng(seed).integers(0, 700, 16)]
        codes = vector_codes.nearest(t.points, book)
        assert (t.codes(book) == codes).all()
        sums, counts = t.totals(book)
        assert all((sums[e] == t.points[codes == e].sum(0)).all() and counts[e] == (codes == e).sum() for e in range(16))
        lo, hi, _, places, near = t.settle(book)
        assert near[np.arange(len(places)), codes[places]].all() and near.mean() < 0.6
        assert (hi - lo).sum() + len(places) == 700 and (hi - lo).sum() > 100


def test_query_over_the_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    out = registry.queries()["op11_vector_codes"](spark, sf_dir)
    assert sorted((tuple(r) for r in out.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr) == brute(rows)
