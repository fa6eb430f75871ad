import random
import re

import pytest

from tesserine.llm import jaccard_join as J

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {(i, len(sets[i]), find(i)) for i in ids}


def texts(n, seed, group=40):
    r = random.Random(seed)
    vocab = [f"W{i}" for i in range(400)]
    base = [[r.choice(vocab) for _ in range(r.choice([0, 2, 3, 4, 5, 12, 60, 150]))] for _ in range(max(1, n // group))]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            if w:
                w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((i * 3 - 50, r.choice([" ", "\n", "\t "]).join(x.lower() if r.random() < 0.2 else x for x in w)))
    return rows + [(10_001, None), (10_002, "  "), (10_003, "É é"), (10_004, "é é")]


def result(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, n string, block string")
    return {tuple(r) for r in J.jaccard_components(df, **kw).collect()}


@pytest.mark.parametrize(("seed", "k", "percent", "chunk"), [(1, 4, 85, 10**6), (2, 5, 80, 10**6), (3, 4, 85, 300)])
def test_equals_brute_force(spark, seed, k, percent, chunk):
    rows = texts(240, seed)
    assert result(spark, rows, k=k, percent=percent, hot_docs=3, chunk_shingles=chunk) == brute(rows, k, percent)


def test_empty_table(spark):
    assert result(spark, []) == set()


def test_real_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {tuple(r) for r in J.jaccard_components(df, k=4, percent=85).collect()}
    assert got == brute([tuple(r) for r in df.select("doc_id", "text").collect()], 4, 85)


def test_no_sets_are_shuffled(spark, monkeypatch):
    # past the bound on broadcasts, too, only texts, heads and thin tables are sent
    monkeypatch.setattr(J, "if_small", lambda df: df)
    monkeypatch.setattr(J, "BITS", 10)
    rows = [(i, " ".join(f"w{(i // 3) * 50 + j}" for j in range(40 + i % 3))) for i in range(60)]
    assert not hasattr(J, "_whole_sets")
    assert result(spark, rows, k=4, percent=80) == brute(rows, 4, 80)


def test_a_task_holds_one_python_worker(spark, monkeypatch):
    """Two Python nodes of one stage take two workers a task, and so twice the memory."""
    plans, write = {}, J.written

    def kept(df, tag):
        plans.setdefault(tag, df._jdf.queryExecution().executedPlan().toString())
        return write(df, tag)

    monkeypatch.setattr(J, "written", kept)
    rows = texts(60, 5)
    assert result(spark, rows, k=3, percent=70) == brute(rows, 3, 70)
    for plan in plans.values():
        for stage in re.split(r"Exchange", plan):
            assert len(re.findall(r"MapInArrow|ArrowEvalPython", stage)) <= 1


def test_common_shingles_do_not_chain_pairs(spark, monkeypatch):
    # 60 pairs of near copies, all with one common phrase: the phrase must not make one block of them
    phrase = [f"common{j}" for j in range(40)]
    words = lambda p: [f"p{p}w{j}" for j in range(60)] + phrase + [f"p{p}v{j}" for j in range(60)]
    rows = [(2 * p + i, " ".join(words(p) + [f"end{i}"])) for p in range(60) for i in range(2)]
    sizes = []
    real = J.written

    def noted(df, tag):
        out = real(df, tag)
        if "chunk" in out.columns and tag == "blocks":
            sizes.extend(r["count"] for r in out.groupBy("block").count().collect())
        return out

    monkeypatch.setattr(J, "written", noted)
    got = result(spark, rows, k=4, percent=85)
    assert {i: c for i, _, c in got} == {i: i - i % 2 for i, _ in rows}
    assert sizes and max(sizes) == 2
