"""Secret scan with corpus-wide ownership frequency (operator 6).

Tasks scan whole texts and find candidates: assignments of secrets, access keys, long hex
strings (the base kinds), and any other token random enough to be a key. Candidates are
then counted over the corpus by a hash of their value: how many owners have it, and how far has
it spread from its main owner, in repositories? A value that many owners have is a copied
example; one that few have looks live, however often its main owner repeats it. Live tokens of the added kind become spans; base spans always stay,
and say whether they look live.

Values are counted once a text, a repository and an owner, each combined before the shuffle,
so a value found in a third of all rows costs a row a task.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, spread_join, written

KINDS = ("assign", "access", "hex", "token")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_EITHER = "|".join("".join("_?" if c == "_" else f"[{c}{c.upper()}]" for c in w) for w in WORDS if w != "apikey")
ASSIGN = re.compile(f"(?:{_EITHER})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: A run shorter than asked for can't hold a longer one, so the length may stand in the pattern.
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
TOKEN = re.compile("[A-Za-z0-9+/_=-]{20,}")
MIN_ASSIGN, MIN_ENTROPY = 8, 3.6


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds, by start, then kind."""
    out = []
    low = text.lower()
    if ("=" in low or ":" in low) and any(w in low for w in WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= MIN_ASSIGN:
                out.append((m.start(), 0, m.end(), m.group(1)))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking tokens that overlap no base span. Both lists are in order, so one pass
    takes in the base spans that begin before each token's end, and knows how far they reach."""
    out, at, reach = [], 0, 0
    for m in TOKEN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach, at = max(reach, base[at][2]), at + 1
        s = m.group()
        kinds = bool(re.search("[a-z]", s)) + bool(re.search("[A-Z]", s)) + bool(re.search("[0-9]", s))
        if kinds == 3 and reach <= m.start() and entropy(s) >= MIN_ENTROPY:
            out.append((m.start(), 3, m.end(), s))
    return out


def value_hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


_FOUND = "array<struct<kind:int,start:int,stop:int,value:long>>"


def scan(docs: DataFrame) -> DataFrame:
    """docs (row columns..., text last) -> the same without text, and found: the spans."""
    keep = docs.columns[:-1]
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                base = base_spans(text)
                spans = sorted(base + added_spans(text, base))
                found.append([{"kind": k, "start": a, "stop": b, "value": value_hash(v)} for a, k, b, v in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], [*keep, "found"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(run, f"{schema}, found {_FOUND}")


def ownership(candidates: DataFrame) -> DataFrame:
    """candidates (value, owner, repo, body: the text's hash) -> value, n (rows), owners,
    spread: its repositories less those of the owner that has most. Equal texts are one repository."""
    known = F.coalesce(F.concat(F.lit("r"), "repo"), F.lit(""))
    once = candidates.groupBy("value", "owner", "body").agg(F.min(known).alias("repo"), F.count("*").alias("rows"))  # a task drops repeats before the shuffle
    by_owner = once.groupBy("value", "owner").agg(F.count_distinct("repo").alias("repos"), F.sum("rows").alias("rows"))
    owners = by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.max("repos").alias("most"), F.sum("rows").alias("n"))
    by_text = once.groupBy("value", "body").agg(F.min("repo").alias("repo"))
    repos = by_text.groupBy("value").agg(F.count_distinct("repo").alias("repos"))
    return owners.join(repos, "value").select("value", "n", "owners", (F.col("repos") - F.col("most")).alias("spread"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", max_owners: int = 2, max_repos: int = 5) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples: one row for
    each row of docs. spans are kind:start:end, by start, then kind, in code points.

    A value is live when at most max_owners owners have it, and at most max_repos
    repositories besides those of its main owner. Repositories with equal texts count as one.
    Here a document is a repository and its source the owner; a null owner is one owner, a
    null repository one repository. Null text counts as empty; a text without spans has an
    empty list. A repeated row is found again but counts once. An empty table gives an empty
    result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", "owner", "repo", F.xxhash64("text").alias("body"), "text")
    found = written(scan(rows).withColumn("row", F.monotonically_increasing_id()), "found")
    each = found.filter(F.size("found") > 0).select("row", "owner", "repo", "body", F.explode("found").alias("s"))
    owned = written(ownership(each.select("s.value", "owner", "repo", "body")), "owned")
    judged = spread_join(each.select("row", "s.*"), owned, "value", "n").withColumn("live", (F.col("owners") <= max_owners) & (F.col("spread") <= max_repos))
    stays = F.col("live") | (F.col("kind") < len(KINDS) - 1)
    per_row = judged.filter(stays).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "live"))).alias("spans"))
    out = found.select("row", "id").join(per_row, "row", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,stop:int,live:boolean>>")))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS) - 1)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_examples"),
    )
