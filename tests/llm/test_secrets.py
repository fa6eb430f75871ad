import hashlib
import math
import random
import re
from collections import defaultdict

from tesserine.llm import secrets as S

ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


def base(text):
    out = []
    for m in re.finditer(ASSIGN, text, re.I | re.A):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, m.end(), m.group(2)))
    for k, p, n in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        out += [(m.start(), k, m.end(), m.group()) for m in re.finditer(p, text) if len(m.group()) >= n]
    return sorted(out)


def judge(held, max_owners, max_repos):
    owners = {o for o, _, _ in held}
    least = lambda of, t: min(r for o, u, r in held if u == t and o in of)
    repos = lambda of: len({least(of, t) for o, t, _ in held if o in of})
    return len(owners) <= max_owners and repos(owners) - max(repos({o}) for o in owners) <= max_repos


def brute(rows, max_owners=2, max_repos=5):
    """A document is a repository, its source the owner; equal texts of an owner, or of the
    corpus, count as their least repository. A value is live while few owners have it, and few
    repositories that aren't its main owner's."""
    found, texts = [], defaultdict(set)
    for i, t, o in rows:
        t = t or ""
        b = base(t)
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t):
            s = m.group()
            h = -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))
            if re.search("[a-z]", s) and re.search("[A-Z]", s) and re.search("[0-9]", s) and h >= S.MIN_ENTROPY and not any(x < m.end() and m.start() < y for x, _, y, _ in b):
                b.append((m.start(), 3, m.end(), s))
        for *_, v in b:
            texts[v].add((o, t, "" if i is None else f"r{i}"))
        found.append((i, sorted(b)))
    out = set()
    for i, spans in found:
        live = lambda v: judge(texts[v], max_owners, max_repos)
        kept = [x for x in spans if x[1] < 3 or live(x[3])]
        text = lambda xs: ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b, _ in xs)
        out.add((i, *(sum(x[1] == k for x in kept) for k in range(3)), hashlib.sha256(text([x for x in kept if x[1] < 3]).encode()).hexdigest(), text(kept)))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(i, t, o, 1) for i, t, o in rows], "doc_id long, text string, source string, found int")
    return {tuple(r)[:6] for r in S.find_secrets(df).collect()}


def test_equals_brute_force(spark):
    r = random.Random(5)
    bits = ["token = \"", "PassWord:", "api_key='", "APIKEY=", "ſecret=abcdefgh12 ", "AKIA", "ABCD1234EFGH5678", "deadbeef" * 4, "0123456789abcdef" * 3, " é€😀 ", "x", "=", ":", "short", "Zx9+aB3/qR7-tY2_uI5=pO8", "secret", " ", "\n", "12345678"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(25))), r.choice(["a", "b", "c", None])) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "", None), (1002, "x " * 20000 + "token=abcdefghij", "a")]
    assert run(spark, rows) == brute(rows)


def test_widely_copied_examples_are_told_from_live_ones(spark):
    rows = [(i, "key Zx9aB3qR7tY2uI5pO8sD1fG", f"s{i}") for i in range(5)] + [(9, "key Qw1Er2Ty3Ui4Op5As6Df7Gh", "s1")]
    got = {r[0]: r[5] for r in run(spark, rows)}
    assert got[9] == "token:4:27" and all(not got[i] for i in range(5))


def test_real_documents_and_empty(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {tuple(r)[:6] for r in S.find_secrets(df).collect()}
    assert got == brute([tuple(r) for r in df.select("doc_id", "text", "source").collect()])
    assert run(spark, []) == set()


def test_documents_of_one_owner_do_not_make_an_example(spark):
    one, copied, two, spread = "Zx9aB3qR7tY2uI5pO8sD1fG", "Qw1Er2Ty3Ui4Op5As6Df7Gh", "Lk8Jh7Gf6Ds5Ap4Oi3Uy2Tr", "Mn1Bv2Cx3Zl4Kj5Hg6Fd7Sa"
    rows = [(i, f"page {i} footer {one}", "a") for i in range(40)] + [(100 + i, f"copy {copied}", "ab"[i % 2]) for i in range(40)]
    rows += [(200 + i, f"page {i} {two}", "a" if i else "b") for i in range(20)] + [(300 + i, f"page {i} {spread}", "ab"[i % 2]) for i in range(40)]
    got = {r[0]: r[5] for r in run(spark, rows)}
    assert all(got[i] for i in got if i < 300) and not any(got[i] for i in got if i >= 300)


def test_live_rule_equals_brute_force(spark):
    """Values on few and many owners and repositories, in texts that repeat."""
    r = random.Random(9)
    values = ["".join(r.choice("abcdefghijkLMNOPQRST0123456789") for _ in range(24)) + "aZ7" for _ in range(30)]
    rows = [(i, f"page {r.randrange(9)} of {values[min(r.randrange(30), r.randrange(30))]}", r.choice("aaaaaabbbc" if i % 3 else "aab")) for i in range(500)]
    rows += [(None, rows[3][1], "a"), (3, rows[3][1], "b")]
    got, want = run(spark, rows), brute(rows)
    assert got == want and 50 < sum(bool(x[5]) for x in want) < 500


def test_ten_megabytes_in_one_pass():
    import time

    text = "token=abcdefghij0123 Zx9aB3qR7tY2uI5pO8sD1fG deadbeefdeadbeefdeadbeefdeadbeef12\n" * 130_000
    begun = time.time()
    base_ = S.base_spans(text)
    added = S.added_spans(text, base_)
    assert len(text) > 10_000_000 and len(base_) == 260_000 and len(added) == 130_000 and time.time() - begun < 30
