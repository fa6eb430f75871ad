"""M05 and M06 against plain loops over every pixel."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tesserine.operators import images


def score(im):
    h, w = len(im), len(im[0]) if im else 0
    n = h * w
    if not n:
        return (0.0, 0.0, 0.0)
    flat = [v for row in im for v in row]
    bits = -sum(flat.count(v) / n * math.log2(flat.count(v) / n) for v in set(flat))
    strong = 0
    for y in range(h):
        for x in range(w):
            v = im[y][x]
            if w >= 3 and h >= 3 and 0 < y < h - 1 and 0 < x < w - 1:
                around = sum(im[y + j][x + i] for j in (-1, 0, 1) for i in (-1, 0, 1))
                v = max(0, min(255, 9 * v - around))
            strong += v >= 32
    return (bits, strong / n, bits * 0.7 + strong / n * 100 * 0.3)


@pytest.mark.parametrize("band", [256, 3])
def test_entropy_edge_scores(spark, band):
    r = random.Random(5)
    pics = {i: [[r.choice([0, 10, 40, 200, r.randrange(256)]) for _ in range(w)] for _ in range(h)] for i, (h, w) in enumerate([(1, 1), (2, 9), (9, 2), (3, 3), (17, 11), (40, 5), (8, 8)])}
    pics[99] = [[]]
    rows = spark.createDataFrame([(i, y, row) for i, im in pics.items() for y, row in enumerate(im)], "id int, y int, values array<int>").repartition(5)
    got = {r["id"]: (r["entropy"], r["edge_density"], r["score"]) for r in images.entropy_edge_scores(rows, band=band).collect()}
    assert set(got) == set(pics)
    assert all(got[i] == pytest.approx(score(im)) for i, im in pics.items())


def opening(mask, size):
    h, w, k = len(mask), len(mask[0]), size // 2

    def of(m, pick):
        return [[pick(m[j][i] for j in range(max(0, y - k), min(h, y + k + 1)) for i in range(max(0, x - k), min(w, x + k + 1))) for x in range(w)] for y in range(h)]

    return of(of(mask, min), max) if size > 1 else mask


@pytest.mark.parametrize(("band", "size"), [(256, 3), (4, 3), (4, 5), (2, 7), (3, 1), (5, 0)])
def test_opening(spark, band, size):
    r = random.Random(size)
    masks = {i: [[int(r.random() < p) for _ in range(w)] for _ in range(h)] for i, (h, w, p) in enumerate([(1, 1, 1), (12, 9, 0.8), (30, 7, 0.9), (5, 20, 0.7), (9, 9, 1.0), (2, 2, 0.5)])}
    rows = spark.createDataFrame([(i, y, row) for i, m in masks.items() for y, row in enumerate(m)], "id int, y int, mask array<int>").repartition(4)
    got = {i: [[0] * len(m[0]) for _ in m] for i, m in masks.items()}
    for row in images.opened(rows, "mask", size, band=band).collect():
        got[row["id"]][row["y"]] = row["mask"]
    assert got == {i: opening(m, size) for i, m in masks.items()}


def test_change_stats(spark):
    a = [[[10, 20, 30], [10, 20, 30], [0, 0, 0]]] * 3
    b = [[[10, 20, 30], [10, 20, 61], [255, 0, 0]]] * 3
    rows = spark.createDataFrame([(1, y, a[y], b[y]) for y in range(3)], "id int, y int, before array<array<int>>, after array<array<int>>")
    one = lambda t, k: tuple(images.change_stats(rows, t, k).first())
    assert one(30, 1) == (1, 6, 9, 6 / 9) and one(31, 1) == (1, 3, 9, 3 / 9)
    assert one(30, 3)[1] == 6 and one(31, 3)[1] == 0
    with pytest.raises(Exception, match="differ in size"):
        images.change_stats(rows.withColumn("after", F.slice("after", 1, 2)), 1, 1).collect()
    with pytest.raises(ValueError, match="odd"):
        images.change_stats(rows, 1, 4)


def test_gray(spark):
    pixels = [[255, 255, 255], [255, 0, 0], [0, 255, 0], [0, 0, 255], [1, 2, 3]]
    got = spark.createDataFrame([(pixels,)], "p array<array<int>>").select(images.gray(F.col("p"))).first()[0]
    assert got == [(r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 for r, g, b in pixels]
