"""Personal data: candidates from high-recall generators, chosen by boosted trees
(operator 10).

On the main path there are only DataFrame functions. Base kinds (email, ip, card, phone)
are found by format and always stay. Further generators propose spans that may overlap
each other, such as a card number inside a longer run of digits; boosted trees score them
by features of format and context, and each kind has its own threshold.

The trees learn from candidates of all kinds, base formats included, in at most
`sample_docs` texts of the table itself that hold one (the least hashes of texts, a
documented bound), and in `LESSONS` invented sentences for contexts and kinds that the table
lacks. A candidate of the table is labelled by a check of its format: Luhn's digit, octets up
to 255, an IBAN's remainder, ranges of area codes and serials, a top-level domain of letters.
The check is also a feature: nothing else tells a good number from a bad one in running text.
In the lessons a candidate is good if it passes its check and what stands before it doesn't
speak against it, so the trees learn both; on candidates of the table their figures show only
that they keep to the check. Odd texts are held out: on them each kind's threshold is set
where precision is still at least `PRECISION`. The trees reach Spark as one SQL
expression.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: A match can only start where a run of its first class starts or the last match ended, so
#: other starts aren't tried. Repeated groups are possessive, as Java then needs no stack
#: for them; nothing follows that could want a part of them.
PATTERNS = {
    "email": f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
ADDED = ("ssn", "iban", "local", "mail", "number", "dial")
PATTERNS |= {
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": "\\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\\b",
    "local": "(?<![0-9+])\\(?[0-9]{3}\\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "mail": f"(?<!{_LOCAL}){_LOCAL}++ ?[\\[(]at[\\])] ?[A-Za-z0-9-]++(?: ?(?:\\.|[\\[(]dot[\\])]) ?[A-Za-z0-9-]++)++",
    "number": "(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "dial": "\\+[0-9]{1,3}[ .-]?\\(?[0-9]{2,4}\\)?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
#: What a text must hold for a match that passes. Most texts have no digit, which column
#: digit says.
TRIGGERS = {
    "email": "contains(text, '@')",
    "ip": "digit and regexp_like(text, r'[0-9][.][0-9]')",
    "card": "digit and regexp_like(text, r'[0-9](?:[\\x20-]?[0-9]){12}')",
    "phone": "digit and contains(text, '+')",
    "ssn": "digit and regexp_like(text, r'[0-9]{3}-[0-9]{2}-[0-9]{4}')",
    "iban": "digit and regexp_like(text, r'[A-Z]{2}[0-9]{2}')",
    "local": "digit and regexp_like(text, r'[0-9]{3}[ .-][0-9]{4}')",
    "mail": "(contains(text, '[at') or contains(text, '(at'))",
    "number": "digit and regexp_like(text, r'[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}')",
    "dial": "digit and contains(text, '+')",
}
DIGIT = "regexp_like(text, '[0-9]')"
CUES = "(?i)\\b(phone|tel|call|mobile|cell|fax|contact|ssn|social security|iban|account|card|visa|mastercard|credit|mail|email|e-mail|write|passport)\\b"
AGAINST = "(?i)\\b(isbn|order|invoice|version|ref|reference|ticket|serial|part|model|sku|build|issue|pages?|doi|id)\\b"
CONTEXT, CHUNK = 32, 256
FEATURES = ("family", "digits", "size", "cue", "against", "seps", "distinct", "glued_left", "glued_right", "longest", "secret", "valid")
FAMILY = {"email": 3, "ip": 1, "card": 0, "phone": 2, "ssn": 4, "iban": 5, "local": 2, "mail": 3, "number": 0, "dial": 2}
_SPAN = "array<struct<start:int,stop:int,value:string,before:string,after:string>>"


def _r(pattern: str) -> str:
    return f"r'{pattern}'"


def _spans(kind: str) -> str:
    """Leftmost non-overlapping matches, as start, stop (code points), value, before, after.
    What split() leaves between matches gives their places, which add up chunk by chunk, so
    that time grows with the text. Expressions are SQL texts, as they are long."""
    pattern = _r(PATTERNS[kind])
    none = f"cast(array() as {_SPAN})"
    item = f"named_struct('start', acc.at + length(x.g), 'stop', acc.at + length(x.g) + length(x.m), 'value', x.m, 'before', right(x.g, {CONTEXT}), 'after', left(x.h, 2))"
    step = f"named_struct('at', acc.at + length(x.g) + length(x.m), 'out', concat(acc.out, array({item})))"
    chunks = f"transform(sequence(1, size(xs), {CHUNK}), i -> slice(xs, i, {CHUNK}))"
    sums = "transform(cs, c -> aggregate(c, 0, (a, x) -> a + length(x.g) + length(x.m)))"
    starts = f"aggregate({sums}, array(0), (a, n) -> concat(a, array(element_at(a, -1) + n)))"
    inside = f"aggregate(c, named_struct('at', at, 'out', {none}), (acc, x) -> {step}).out"
    placed = f"flatten(flatten(transform(array({chunks}), cs -> zip_with(cs, slice({starts}, 1, size(cs)), (c, at) -> {inside}))))"
    # transform() names the matches and what is between them, so that they are made once.
    matches = f"transform(array(named_struct('f', regexp_extract_all(text, {pattern}, 0), 'g', split(text, {pattern}, -1))), y -> transform(sequence(0, size(y.g) - 1), i -> named_struct('m', get(y.f, i), 'g', y.g[i], 'h', get(y.g, i + 1))))"
    return f"if({TRIGGERS[kind]}, flatten(transform({matches}, ys -> flatten(transform(array(filter(ys, z -> z.m is not null)), xs -> if(size(xs) > 0, {placed}, {none}))))), {none})"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """Whether a string of digits, not empty, has a check digit by Luhn's rule."""
    return f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(c = '', 0, if(i % 2 = 0, int(c), int(c) * 2 - if(int(c) > 4, 9, 0)))), 0, (a, b) -> a + b) % 10 = 0"


def _octets(x: str) -> str:
    return f"forall(split({x}, '[.]'), p -> regexp_like(p, '^0*(?:[0-9]{{1,2}}|1[0-9]{{2}}|2[0-4][0-9]|25[0-5])$'))"


def _passes(kind: str) -> str:
    d = _digits("s.value")
    if kind == "ip":
        return _octets("s.value")
    if kind == "card":
        return f"length({d}) between 13 and 19 and {luhn(d)}"
    return f"length({d}) between 9 and 15" if kind == "phone" else "true"


def _iban(x: str) -> str:
    """Whether the remainder of an account number by 97 is 1."""
    flat = f"regexp_replace({x}, ' ', '')"
    value = "if(regexp_like(c, '[0-9]'), int(c), ascii(c) - 55)"
    return f"aggregate(filter(split(concat(substring({flat}, 5), left({flat}, 4)), ''), c -> c <> ''), 0, (a, c) -> if({value} > 9, a * 100 + {value}, a * 10 + {value}) % 97) = 1"


def _checks(kind: str) -> str:
    """Whether a candidate's value passes the check of its format."""
    d, v = _digits("s.value"), "s.value"
    if kind in ("card", "number"):
        return f"length({d}) between 13 and 19 and {luhn(d)}"
    if kind in ("phone", "dial", "local"):
        return f"length({d}) between 9 and 15 and not regexp_like({v}, {_r('^[+]0')})" + (f" and not regexp_like({v}, {_r('^[(]?[01]')})" if kind == "local" else "")
    if kind in ("email", "mail"):
        return f"regexp_like({v}, {_r('[.) ][A-Za-z]{2,24}$')})"
    if kind == "ip":
        return _octets(v)
    if kind == "ssn":
        return f"not regexp_like({v}, '^(?:000|666|9)|-00-|-0000$')"
    return _iban(v)


def _features(kind: str) -> str:
    d = _digits("s.value")
    flag = lambda c: f"if({c}, 1D, 0D)"
    values = {
        "family": f"{FAMILY[kind]}D",
        "digits": f"double(length({d}))",
        "size": "double(length(s.value))",
        "cue": flag(f"regexp_like(s.before, {_r(CUES)})"),
        "against": flag(f"regexp_like(s.before, {_r(AGAINST)})"),
        "seps": "double(length(regexp_replace(s.value, '[A-Za-z0-9]', '')))",
        "distinct": f"double(size(array_distinct(split({d}, ''))))",
        "glued_left": flag("regexp_like(right(s.before, 1), '[A-Za-z0-9_#/$.]')"),
        "glued_right": flag("regexp_like(left(s.after, 1), '[A-Za-z0-9_%/]')"),
        "longest": "double(array_max(transform(split(s.value, '[^0-9]+'), x -> length(x))))",
        "secret": flag("regexp_like(s.before, '(?i)(?:token|secret|key|passw)')"),
        "valid": flag(_checks(kind)),
    }
    return f"named_struct('kind', '{kind}', 'start', s.start, 'stop', s.stop, {', '.join(f'{chr(39)}{f}{chr(39)}, {values[f]}' for f in FEATURES)})"


# ---- the model ---------------------------------------------------------------------------

ROUNDS, RATE, PRECISION = 40, 0.3, 0.95

@dataclass
class Trees:
    """Trees of depth 2: (feature, cut, (feature, cut, low, high), (feature, cut, low, high))."""

    start: float
    trees: list[tuple]
    thresholds: dict[str, float] = field(default_factory=dict)
    #: On held-out texts, by kind: candidates, labelled good, chosen, both; of the table, and of
    #: the lessons.
    held_out: dict[str, tuple[int, int, int, int]] = field(default_factory=dict)
    held_out_lessons: dict[str, tuple[int, int, int, int]] = field(default_factory=dict)

    def sql(self, s: str) -> str:
        """The score of a struct of features."""
        side = lambda x: f"if({s}.{FEATURES[x[0]]} <= {float(x[1])!r}D, {x[2]!r}D, {x[3]!r}D)"
        terms = [f"{float(self.start)!r}D", *(f"if({s}.{FEATURES[f]} <= {float(c)!r}D, {side(low)}, {side(high)})" for f, c, low, high in self.trees)]
        return f"1D / (1D + exp(-({' + '.join(terms)})))"

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for f, c, low, high in self.trees:
            side = lambda s: np.where(x[:, s[0]] <= s[1], s[2], s[3])
            total += np.where(x[:, f] <= c, side(low), side(high))
        return 1 / (1 + np.exp(-total))


def _stump(x: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, float, float, float]:
    """Best cut of one feature: gain, feature, cut, and the value on either side."""
    value = lambda g, h: g / (h + 1.0)
    gain = lambda g, h: g * g / (h + 1.0)
    best = (-1.0, 0, 0.0, value(grad.sum(), hess.sum()), value(grad.sum(), hess.sum()))
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, g, h = x[order, f], np.cumsum(grad[order]), np.cumsum(hess[order])
        at = np.flatnonzero(v[1:] > v[:-1])
        if len(at):
            each = gain(g[at], h[at]) + gain(g[-1] - g[at], h[-1] - h[at]) - gain(g[-1], h[-1])
            i = at[each.argmax()]
            if each.max() > best[0]:
                best = (each.max(), f, float(v[i] + v[i + 1]) / 2, value(g[i], h[i]), value(g[-1] - g[i], h[-1] - h[i]))
    return best


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    total = np.full(len(y), np.log(max(y.mean(), 1e-3) / max(1 - y.mean(), 1e-3)))
    out = Trees(float(total[0]), [])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        _, f, c, *_ = _stump(x, grad, hess)
        left = x[:, f] <= c
        sides = []
        for part in (left, ~left):
            _, g, cut, low, high = _stump(x[part], grad[part], hess[part]) if part.any() else (0, 0, 0.0, 0.0, 0.0)
            sides.append((g, cut, float(RATE * low), float(RATE * high)))
            total[part] += np.where(x[part, g] <= cut, sides[-1][2], sides[-1][3])
        out.trees.append((f, c, *sides))
    return out


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Between the least score such that of those that reach it PRECISION are good, and the next
    one below."""
    order = np.argsort(-p, kind="stable")
    p, good = p[order], np.cumsum(y[order]) / np.arange(1, len(p) + 1)
    ends = np.append(p[1:] < p[:-1], True)  # equal scores stand or fall together
    ok = np.flatnonzero((good >= PRECISION) & ends)
    return float(p[ok[-1] : ok[-1] + 2].mean()) if len(ok) else 1.1


LESSONS = 1200


def lessons(n: int = LESSONS, seed: int = 7) -> list[tuple[str, int]]:
    """Invented sentences, each with one candidate, and whether that is personal data: its value
    passes its check, and what stands before it isn't the name of something else."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    first = lambda k: r.choice("23456789") + d(k - 1)

    def number(good: bool) -> str:
        head = first(15)
        total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(head)))
        return f"{head}{(-total + (0 if good else r.randint(1, 9))) % 10}"

    def iban(good: bool) -> str:
        body = d(18)
        check = 98 - int(f"{body}131400") % 97
        flat = f"DE{check if good else (check - 2 + r.randint(1, 96)) % 97 + 2:02d}{body}"
        return " ".join(flat[i : i + 4] for i in range(0, len(flat), 4))

    def ssn(good: bool) -> str:
        area = f"{r.choice('1234578')}{d(2)}" if good else r.choice(("000", "666", f"9{d(2)}"))
        return f"{area}-{r.randint(10, 99)}-{first(4)}"

    def mail(good: bool) -> str:
        return f"{r.choice(('ann', 'j.doe', 'kim_7'))} (at) {r.choice(('mail', 'example'))} (dot) {r.choice(('org', 'com')) if good else d(3)}"

    form = {
        "ssn": (ssn, ("SSN", "my social security number is", "passport or SSN"), ("part", "serial", "model")),
        "iban": (iban, ("IBAN", "my account", "account IBAN"), ("serial", "build", "ref")),
        "local": (lambda good: f"{first(3) if good else r.choice('01') + d(2)}-{first(3)}-{d(4)}", ("call", "phone", "tel", "fax"), ("order", "invoice", "ticket", "part")),
        "mail": (mail, ("write to", "mail", "contact", "reach"), ("version", "build", "issue", "doi")),
        "number": (number, ("card", "visa", "credit card"), ("order", "isbn", "invoice", "id")),
        "dial": (lambda good: f"+{r.randint(1, 99) if good else f'0{d(1)}'} ({first(3)}) {first(3)}-{d(4)}", ("call", "phone", "mobile"), ("order", "sku", "ref")),
    }
    plain = ("and", "with", "the", "of")
    out = []
    for i in range(n):
        make, for_it, against = form[ADDED[i % len(ADDED)]]
        good, valid = r.random() < 0.5, r.random() < 0.5
        before = r.choice((*for_it, *plain) if good else against if valid else (*for_it, *plain, *against))
        out.append((f"Please {before} {make(good or valid)} today", int(good)))
    return out


def candidates(texts: DataFrame, labelled: bool) -> DataFrame:
    """texts (key, text[, good, of]) -> key, s: a candidate with features, good: its label. A
    labelled text is about its candidate of kind `of`; others that it holds are left out."""
    every = []
    for k in (*BASE, *ADDED):
        wanted = f"filter({_spans(k)}, s -> length({_digits('s.value')}) between 13 and 19)" if k == "card" else _spans(k)
        good = "good = 1" if labelled else _checks(k)
        every.append(F.expr(f"transform({wanted}, s -> named_struct('s', {_features(k)}, 'good', if({good}, 1D, 0D)))"))
    found = texts.withColumn("digit", F.expr(DIGIT)).select("*", F.explode(F.concat(*every)).alias("c"))
    return (found.filter("c.s.kind = of") if labelled else found).select("key", "c.s", "c.good")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 4000, sample_rows: int = 20_000) -> Trees:
    """Trees from at most sample_rows candidates of at most sample_docs texts, and the lessons."""
    spark = docs.sparkSession
    rows = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).filter("text is not null").withColumn("digit", F.expr(DIGIT)).filter(" or ".join(TRIGGERS.values())).drop("digit")
    chosen = rows.select("key").distinct().orderBy("key").limit(sample_docs).withColumnRenamed("key", "_key")
    # Copies of a text give the same candidates, which are combined before they move.
    of_table = candidates(rows.join(F.broadcast(chosen), F.col("key") == F.col("_key")).drop("_key"), False).distinct()
    of_table = of_table.orderBy(F.xxhash64("key", "s.start"), "s.kind", "s.stop").limit(sample_rows)
    taught = spark.createDataFrame([(i // len(ADDED), t, g, ADDED[i % len(ADDED)]) for i, (t, g) in enumerate(lessons())], "key long, text string, good int, of string")
    got = sorted(of_table.withColumn("taught", F.lit(False)).unionByName(candidates(taught, True).withColumn("taught", F.lit(True))).collect(), key=lambda r: (r["key"], r["s"]["kind"], r["s"]["start"], r["s"]["stop"]))
    kind = np.array([r["s"]["kind"] for r in got])
    x = np.array([[r["s"][f] for f in FEATURES] for r in got], float)
    y = np.array([r["good"] for r in got])
    out = np.array([r["key"] % 2 != 0 for r in got])
    model = boost(x[~out], y[~out])
    p, invented = model.score(x), np.array([r["taught"] for r in got])
    for k in ADDED:
        mine = out & (kind == k)
        t = model.thresholds[k] = _threshold(p[mine], y[mine])
        for held, part in ((model.held_out, mine & ~invented), (model.held_out_lessons, mine & invented)):
            picked = part & (p >= t)
            held[k] = (int(part.sum()), int(y[part].sum()), int(picked.sum()), int(y[picked].sum()))
    return model


# ---- the operator ------------------------------------------------------------------------


def find_pii(docs: DataFrame, model: Trees | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, found: an array of kind, start, stop (code points, end exclusive), by
    kind, base kinds first, then start. One row for each row of docs.

    Null text counts as empty and has no spans. Base spans always stay, overlapping or not;
    of the added ones those stay whose score reaches their kind's threshold and that overlap
    no base span. Null ids and repeated rows are passed on; an empty table gives an empty
    result, and its trees know the lessons only; other columns are ignored. A text may be
    one run of a million digits, labels or separators.
    """
    model = model or train(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digit", F.expr(DIGIT))
    typed = lambda k: f"transform(filter({_spans(k)}, s -> {_passes(k)}), s -> named_struct('kind', '{k}', 'start', s.start, 'stop', s.stop))"
    # The features of a candidate are made once; the trees read them from the struct.
    featured = lambda k: f"transform({_spans(k)}, s -> {_features(k)})"
    rows = rows.select("*", F.expr(f"concat({', '.join(map(typed, BASE))})").alias("base"), F.expr(f"concat({', '.join(map(featured, ADDED))})").alias("_added"))
    least = "case " + " ".join(f"when s.kind = '{k}' then {float(model.thresholds[k])!r}D" for k in ADDED) + " end"
    free = "not exists(base, b -> b.start < s.stop and s.start < b.stop)"
    picked = f"transform(filter(_added, s -> {model.sql('s')} >= {least} and {free}), s -> named_struct('kind', s.kind, 'start', s.start, 'stop', s.stop))"
    return rows.select("doc_id", "text", "base", F.expr(f"if(size(_added) > 0, concat(base, {picked}), base)").alias("found"))


def redact(found: DataFrame) -> DataFrame:
    """Adds redacted: the text with each span, or run of overlapping spans, as [kind]."""
    order = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        part = F.concat(F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(fresh, F.concat(acc["out"], part)).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.col("text").substr(a["at"] + 1, F.length("text"))))
    return found.withColumn("redacted", F.when(F.size("found") > 0, whole).otherwise(F.col("text")))


def query(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    found = find_pii(docs, model)
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(text("base"), 256).alias("base_sha256"), text("found").alias("spans"), (F.size("found") > 0).alias("has_pii"))
