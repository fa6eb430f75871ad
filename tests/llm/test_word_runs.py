"""Operator 12 against plain loops over every start and period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tesserine.llm import registry, word_runs

SCHEMA = "doc_id long, text string, row int, words string, runs int, h int, start int"


def runs_of(words):
    """By comparing words q apart over the whole text for every q, and the least period by
    comparing the stretch with itself."""
    n, out = len(words), []
    a = np.unique(words, return_inverse=True)[1] if n else np.empty(0)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            length = e - s + q
            if length >= max(6, 4 * q) and not any((a[s : s + length - d] == a[s + d : s + length]).all() for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = runs_of(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *four, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def check(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, 1, "w", 2, 3, 4) for r in rows], SCHEMA).repartition(parts)
    got = sorted((tuple(r) for r in word_runs.query(df).select(COLUMNS).collect()), key=repr)
    want = sorted((brute(*r) for r in rows), key=repr)
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want, strict=True) if a != b][:2] == []


def some_text(r, n):
    """Random words of a small alphabet with repeats inside repeats."""
    out = []
    while len(out) < n:
        kind = r.randrange(4)
        if kind == 0:
            out += [r.choice("abcdef") for _ in range(r.randrange(1, 12))]
        elif kind == 1:
            unit = [r.choice("ab") for _ in range(r.randrange(1, 9))]
            out += (unit * 9)[: r.randrange(1, 9 * len(unit))]
        elif kind == 2 and out:
            unit = out[-r.randrange(1, 1 + len(out)) :][:60]
            out += unit * r.randrange(1, 6) + unit[: r.randrange(len(unit))]
        else:
            out += [f"w{r.randrange(50)}" for _ in range(r.randrange(1, 30))]
    return " ".join(out)


@pytest.mark.parametrize("piece", [1 << 21, 100])
def test_equals_plain_loops(spark, monkeypatch, piece):
    monkeypatch.setattr(word_runs, "PIECE_BYTES", piece)
    r = random.Random(12)
    rows = [(i, some_text(r, r.randrange(1, 260))) for i in range(400)]
    rows += [(1000 + i, " ".join(r.choice("ab") for _ in range(r.randrange(1, 120)))) for i in range(200)]
    rows += [(5, None), (None, "a a a a a a a"), (None, None), (7, ""), (7, " \t\r\n\x0b\x0c "), (7, ""), (8, "x " * 6), (8, "x " * 5), (9, "é é  é é " * 8), (10, "a\x00 a\x00 " * 4)]
    rows += [(11, "one " * 3000), (12, "p q r " * 1200 + "p q"), (13, ("a b " * 5 + "c ") * 9)]
    check(spark, rows)
    check(spark, rows[:1])


def test_empty_table(spark):
    assert word_runs.query(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tiles_overlap_and_stitch():
    """One long repeat crosses many tiles of its octave; fragments join to exactly it."""
    r = random.Random(3)
    for q, folds, pad in ((1, 900, 40), (3, 300, 100), (17, 60, 333), (64, 21, 5), (100, 4, 1000), (127, 9, 0)):
        unit = [f"u{i}" for i in range(q)]
        words = [f"x{r.randrange(10**9)}" for _ in range(pad)] + unit * folds + [f"y{r.randrange(10**9)}" for _ in range(pad)]
        a = np.unique(words, return_inverse=True)[1].astype(np.int64)
        doc, period, start, end = word_runs.fragments(a, np.array([0, len(a)]))
        assert set(period.tolist()) == {q} and start.min() == pad and end.max() == pad + q * folds
        spans = sorted(zip(start.tolist(), end.tolist(), strict=True))
        reach = spans[0][1]
        for s, e in spans:
            assert s + q <= reach or (s, e) == spans[0]
            reach = max(reach, e)


def test_very_long_text_is_quick(spark):
    import time

    r = random.Random(4)
    words = " ".join(["a b c"] * 200_000 + [f"w{r.randrange(1000)}" for _ in range(400_000)] + ["z"] * 300_000)
    begun = time.time()
    got = word_runs.query(spark.createDataFrame([(3, words)], "doc_id long, text string")).collect()[0]
    assert time.time() - begun < 60
    assert got["n_runs"] >= 2 and (got["start"], got["length"], got["period"]) == (0, 600_000, 3)


def test_collapse(spark):
    rows = [(1, "go  go go\tgo go go now"), (2, "once only"), (None, None), (2, "once only")]
    got = sorted((tuple(r) for r in word_runs.collapse(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(1, "go now"), (2, "once only"), (None, ""), (2, "once only")], key=repr)


def test_query_over_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.queries()["op12_word_runs"](spark, sf_dir).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(*r) for r in rows), key=repr)
