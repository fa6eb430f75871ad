import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserine.llm import passages, registry
from tesserine.llm import substring_dedup as D


def brute(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[a : a + length] for _, r in raws for a in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = np.zeros(len(r), bool)
        for a in range(len(r) - length + 1):
            if seen[r[a : a + length]] > 1:
                gone[a : a + length] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(r, np.uint8)[~gone]) if len(r) else b""
        out.append((i, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length, **kw):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    return sorted((tuple(r) for r in D.remove_repeats(df, length=length, **kw).collect()), key=repr)


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.randrange(1, 30)))
    passages = ["".join(word() for _ in range(r.randrange(2, 12))) for _ in range(8)]
    rows = []
    for i in range(150):
        t = "".join(r.choice([word, word, lambda: r.choice(passages)])() for _ in range(r.randrange(0, 14)))
        rows.append((i, t))
    rows += [(500, None), (501, ""), (502, "x" * 900), (503, "ab" * 300), (3, rows[3][1]), (None, rows[4][1]), (504, rows[5][1][:-1] + "z"), (505, "q" + rows[6][1])]
    return rows


@pytest.mark.parametrize(("seed", "length", "block"), [(1, 60, 20_000), (2, 100, 20_000), (3, 40, 20_000), (4, 80, 3), (5, 60, 1)])
def test_equals_brute_force(spark, seed, length, block):
    rows = texts(seed)
    assert run(spark, rows, length, block_contexts=block) == brute(rows, length)


@pytest.mark.parametrize("block", [2, 20_000])
def test_one_passage_in_many_surroundings(spark, block):
    r = random.Random(9)
    some = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    core, heads, tails = some(45), [some(30) for _ in range(3)], [some(30) for _ in range(3)]
    rows = [(i, some(r.randrange(20)) + r.choice(heads)[r.randrange(30) :] + core + r.choice(tails)[: r.randrange(30)] + some(r.randrange(20))) for i in range(80)]
    assert run(spark, rows, 60, block_contexts=block) == brute(rows, 60)


def test_large_blocks_equal_small_ones():
    r = np.random.default_rng(1)
    n, length = 60, 50
    gram = D.gram_of(length)
    left, right = r.integers(0, length - gram + 1, n), r.integers(gram, length + 1, n)
    before, after = r.integers(0, 2, (n, length - gram)).astype(np.int16), np.zeros((n, length), np.int16)
    after[:, gram :] = r.integers(0, 2, (n, length - gram))
    after[r.random(n) < 0.6] = after[0]
    for i in range(n):
        before[i, left[i] :] = -1
        after[i, right[i] :] = -1
    a = D.sort_block(before, after, left, right, length)
    small, D.SMALL = D.SMALL, 1000
    try:
        b = D.sort_block(before, after, left, right, length)
    finally:
        D.SMALL = small
    some = b[1] >= 0
    assert some.any() and (some == (a[1] >= 0)).all()
    assert (a[1][some] == b[1][some]).all() and (a[0][some] == b[0][some]).all()


def test_documents_and_empty(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert run(spark, rows, 400) == brute(rows, 400)
    assert run(spark, [], 400) == []


def test_query_says_which_documents_lose_bytes(spark, sf_dir):
    rows = registry.op3_suffix_dedup(spark, sf_dir).collect()
    want = brute([tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()], 400)
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == want
    assert {r["doc_id"] for r in rows if r["has_repeats"]} == {r[0] for r in want if r[2] > 0}
    assert {r["has_repeats"] for r in rows} == {True, False}


def sharing(rows, words):
    """Places in rows of the texts that hold `words` words in turn of another row."""
    held = [{tuple(w[a : a + words]) for a in range(len(w) - words + 1)} for w in (re.split("[ \t\n\x0b\f\r]+", (t or "").strip(" \t\n\x0b\f\r")) for _, t in rows)]
    seen = Counter(p for s in held for p in s)
    return [i for i, s in enumerate(held) if any(seen[p] > 1 for p in s)]


def shared_texts(seed, words):
    """Passages of about so many words, whole, cut short by a word or two, or with other spaces, in
    texts of their own words; copies, texts that only repeat themselves, and odd ones."""
    r = random.Random(seed)
    new = lambda n: [f"{r.choice('aéñx')}{r.randrange(10**9)}" for _ in range(n)]
    passages = [new(r.randrange(words - 2, words + 3)) for _ in range(12)] + [new(4 * words)]
    rows = []
    for i in range(160):
        w = new(r.randrange(2 * words))
        for p in r.sample(passages, r.choice([0, 0, 1, 1, 2])):
            cut = r.randrange(3)
            w += r.choice([p, p[cut:], p[: len(p) - cut], p[: len(p) // 2] + new(1) + p[len(p) // 2 :]]) + new(r.randrange(words))
        rows.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    own = new(words)
    rows += [(200, " ".join(own + new(3) + own)), (201, None), (202, ""), (203, " ".join(new(words))), (204, "x " * (3 * words)), (3, rows[3][1]), (None, rows[4][1]), (205, " ".join(new(words)).upper())]
    return [*rows, (206, rows[-1][1].lower()), (207, " ".join(["y"] * (2 * words))), (208, "\r".join(["y"] * words))]


@pytest.mark.parametrize(("seed", "words"), [(1, 51), (2, 20), (3, 12)])
def test_passages_equal_brute_force(spark, seed, words):
    rows = shared_texts(seed, words)
    df = spark.createDataFrame([(-1 if i is None else i, n, t or "") for n, (i, t) in enumerate(rows)], "id long, n long, text string").withColumn("print", F.xxhash64("n"))
    place = {r["print"]: r["n"] for r in df.select("n", "print").collect()}
    got = sorted(place[r["print"]] for r in passages.sharing(df.select("id", "print", "text"), words).distinct().collect())
    want = sharing(rows, words)
    assert 20 < len(want) < len(rows) - 20
    assert got == want


def test_query_finds_passages_of_fewer_bytes(spark, tmp_path):
    """A passage of 51 words and under 400 bytes in two documents: no byte goes, but both say so."""
    r = random.Random(4)
    new = lambda n: " ".join(f"w{r.randrange(10**4)}" for _ in range(n))
    passage = new(51)
    rows = [(1, f"{new(80)} {passage} {new(40)}"), (2, f"{new(9)}\n{passage}"), (3, new(200)), (4, f"{new(70)} {passage[: passage.rindex(' ')]}"), (5, None), (None, "a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op3_suffix_dedup(spark, str(tmp_path)).collect()
    assert sorted((tuple(x)[:5] for x in got), key=repr) == brute(rows, 400)
    assert {x["doc_id"] for x in got if x["shares_passage"]} == {1, 2}
    assert {(x["n_removed"], x["has_repeats"]) for x in got} == {(0, False)}
