"""Removal of repeated byte strings by blockwise suffix sorting (operator 3).

A byte goes when a string of `length` bytes that covers it also starts elsewhere.

Cover sample. In every window of `length` bytes the k-byte gram with the least hash is a
sample position. Two equal windows have theirs at the same offset, so the samples cover all
pairs of equal windows, as a difference cover does for pairs of residues, at about
2 / (length - k) of the positions instead of 1 / sqrt(length).

Blocks. All suffixes that start up to length - k bytes before a sample gram of one value
form a block; blocks are dealt to tasks and sorted one at a time. In a block the contexts
of the samples are sorted once, to the right and to the left; that gives each sample a
precomputed rank for every number of bytes on either side. Suffixes of one offset, which
may agree over hundreds of bytes, are then sorted by two ranks only. Memory is bounded by
the block, never by the corpus.

What keeps blocks small: samples with the same whole context on both sides are counted
first (combined before the shuffle), and repeat as a whole; a block gets one of them. A
block with more contexts than `block_contexts` is split into blocks of suffixes that share
more bytes, again and again until each fits; then they are sorted like all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .hashing import POWERS, U, pieces, prefix_sums, scramble
from .jaccard_join import _bitmap, _cells, _has
from .passages import sharing

NONE_ID = -(1 << 63)
#: Blocks up to so many contexts compare all of them at once.
SMALL = 24
_MASK = U((1 << 24) - 1)
#: 2**BITS cells of each bitmap (16 MB). A cell set by chance only lets a row through.
BITS = 27
#: Contexts that a task remembers having sent.
REMEMBERED = 1_000_000


def gram_of(length: int) -> int:
    """Bytes of a sample gram. Long ones keep text that repeats by chance, or over fewer
    bytes, out of the blocks; short ones make fewer samples."""
    return max(8, 2 * length // 5)


def _samples(raws: list[bytes], length: int):
    """Sample positions in some texts laid end to end: data, sums, begin and end of the text
    of each sample, sample positions."""
    data = np.frombuffer(b"".join(raws), np.uint8)
    bounds = np.cumsum([0, *map(len, raws)])
    sums, (_, down) = prefix_sums(data), POWERS.get(len(data) + 1)
    gram = gram_of(length)
    n, width = len(data), length - gram + 1
    if n < length:
        return data, sums, *[np.empty(0, np.int64)] * 3
    grams = scramble((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    ends = np.repeat(bounds[1:], np.diff(bounds))
    grams[np.arange(n - gram + 1) + gram > ends[: n - gram + 1]] = ~U(0)
    chosen = np.zeros(n, bool)
    whole = np.arange(n - length + 1) + length <= ends[: n - length + 1]  # windows inside one text
    # Least gram of each window, the leftmost of equals: blocks of a window's width, with
    # minima from the left and from the right. 2**24 positions fit beside the hash.
    for at in range(0, n - length + 1, 1 << 23):
        part = grams[at : at + (1 << 23) + width]
        packed = (part & ~_MASK) | np.arange(len(part), dtype=U)
        rows = -(-len(packed) // width)
        padded = np.full(rows * width, ~U(0))
        padded[: len(packed)] = packed
        left = np.minimum.accumulate(padded.reshape(rows, width), axis=1).ravel()
        right = np.minimum.accumulate(padded.reshape(rows, width)[:, ::-1], axis=1)[:, ::-1].ravel()
        count = min(1 << 23, n - length + 1 - at)
        least = np.minimum(right[:count], left[width - 1 : width - 1 + count])
        chosen[at + (least[whole[at : at + count]] & _MASK).astype(np.int64)] = True
    pos = np.flatnonzero(chosen)
    text = np.searchsorted(bounds, pos, "right") - 1
    return data, sums, text, bounds, pos


def _contexts(texts: list[str], length: int):
    """For some texts in turn: first text, texts of the samples, positions in the text, bytes
    to the left and right, gram, context hash, data, positions in data."""
    with np.errstate(over="ignore"):
        for first, raws in pieces(texts):
            data, sums, text, bounds, pos = _samples(raws, length)
            if not len(pos):
                continue
            _, down = POWERS.get(len(data) + 1)
            left = np.minimum(pos - bounds[text], length - gram_of(length))
            right = np.minimum(bounds[text + 1] - pos, length)
            span = lambda a, b: scramble((sums[b] - sums[a]) * down[a])
            gram = span(pos, pos + gram_of(length))
            ctx = scramble(span(pos - left, pos) * U(3) + span(pos, pos + right) * U(5) + left.astype(U) * U(1 << 20) + right.astype(U))
            yield first, text, pos - bounds[text], left, right, gram, ctx, data, pos


def _scan(texts: DataFrame, length: int) -> DataFrame:
    """id, print, pos, left, right, gram, ctx: a row a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, text, pos, left, right, gram, ctx, _, _ in _contexts(batch.column(2).to_pylist(), length):
                at = first + text
                cols = [ids[at], prints[at], pos, left.astype(np.int32), right.astype(np.int32), gram.view(np.int64), ctx.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "print", "pos", "left", "right", "gram", "ctx"])

    return texts.mapInArrow(run, "id long, print long, pos long, left int, right int, gram long, ctx long")


def _cell(name: str):
    return F.shiftrightunsigned(name, 64 - BITS)


def _marked(bitmap):
    """Column -> Column: is the cell's bit set?"""

    @F.pandas_udf("boolean")
    def marked(cells):
        import pandas as pd

        return pd.Series(_has(bitmap.value, cells.to_numpy()))

    return marked


def _gather(texts: DataFrame, length: int, wanted, senders) -> DataFrame:
    """The samples whose gram's bit is set in wanted, with the bytes around them, from the text
    that senders names for their context: one of equal contexts is enough, as the others
    repeat as a whole. What a task has sent it doesn't send again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for batch in batches:
            ids, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, text, pos, left, right, gram, ctx, data, at in _contexts(batch.column(2).to_pylist(), length):
                named = _cells(ctx, BITS) ^ (ids[first + text] & ((1 << BITS) - 1))
                keep = []
                for i in np.flatnonzero(_has(wanted.value, _cells(gram, BITS)) & _has(senders.value, named)).tolist():
                    if (gram[i], ctx[i]) not in sent:
                        sent.add((gram[i], ctx[i]))
                        keep.append(i)
                if len(sent) > REMEMBERED:
                    sent = set()
                raw = data.tobytes()
                around = [raw[at[i] - left[i] : at[i] + right[i]] for i in keep]
                keep = np.array(keep, np.int64)
                doc = first + text[keep]
                cols = [ids[doc], prints[doc], pos[keep], left[keep].astype(np.int32), gram[keep].view(np.int64), ctx[keep].view(np.int64)]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols], pa.array(around, pa.binary())], ["id", "print", "pos", "left", "block", "ctx", "around"])

    return texts.mapInArrow(run, "id long, print long, pos long, left int, block long, ctx long, around binary")


def _ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a matrix of bytes, and how much each shares with the one before."""
    raw, width = (rows.astype(np.int32) + 1).astype(">u2").tobytes(), 2 * rows.shape[1]
    keys = [raw[i : i + width] for i in range(0, len(raw), width)]
    order = np.array(sorted(range(len(rows)), key=keys.__getitem__))
    same = rows[order[1:]] == rows[order[:-1]]
    shared = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return order, np.concatenate([[0], shared])


def sort_block(before: np.ndarray, after: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """before: bytes to the left of each sample, nearest first; after: from the sample on;
    -1 beyond the text. For each sample the least and greatest number of bytes before it at
    which a string of `length` bytes starts that also starts at another sample of the block
    (greatest -1 if none)."""
    n, most = len(left), before.shape[1]
    low, high = np.full(n, length), np.full(n, -1)
    if n <= SMALL:
        lce = lambda m: np.where((e := m[:, None] == m[None]).all(axis=2), m.shape[1], e.argmin(axis=2))
        a = np.minimum(lce(before), np.minimum(left[:, None], left[None]))
        b = np.minimum(lce(after), np.minimum(right[:, None], right[None]))
        ok = (a + b >= length) & ~np.eye(n, dtype=bool)
        high = np.where(ok, a, -1).max(axis=1)
        low = length - np.where(ok, b, 0).max(axis=1)
        return low, high
    by_left, share_left = _ranks(before)
    by_right, share_right = _ranks(after)
    rank = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(most + 1):  # one bucket of suffixes at a time: those that start o bytes before
        rank[0][by_left] = np.cumsum(share_left < o)
        rank[1][by_right] = np.cumsum(share_right < length - o)
        fit = np.flatnonzero((left >= o) & (right >= length - o))
        key = rank[0][fit] * (n + 1) + rank[1][fit]
        order = np.argsort(key, kind="stable")
        equal = key[order[1:]] == key[order[:-1]]
        twice = fit[order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])]] if len(fit) else fit
        low[twice] = np.minimum(low[twice], o)
        high[twice] = o
    return low, high


def _matrix(items: list[bytes], width: int) -> np.ndarray:
    out = np.full((len(items), width), -1, np.int16)
    for i, raw in enumerate(items):
        out[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    return out


def _sorted_blocks(contexts: DataFrame, length: int) -> DataFrame:
    """contexts (block, ctx, n, id, print, pos, left, around) -> repeated (id, print, start,
    stop), for the contexts that occur once."""

    def block(seen: dict[int, list]) -> list[tuple]:
        rows = [(n, *row) for n, row in seen.values()]
        if len(rows) < 2 or all(r[0] > 1 for r in rows):
            return []
        left = np.array([r[4] for r in rows])
        right = np.array([len(r[5]) for r in rows]) - left
        before = _matrix([r[5][: r[4]][::-1] for r in rows], length - gram_of(length))
        after = _matrix([r[5][r[4] :] for r in rows], length)
        low, high = sort_block(before, after, left, right, length)
        return [(r[1], r[2], r[3] - int(high[i]), r[3] + length - int(low[i])) for i, r in enumerate(rows) if r[0] == 1 and high[i] >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, seen, found = None, {}, []

        def out() -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "print", "start", "stop"])

        for batch in batches:
            for at, ctx, times, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != name:
                    found += block(seen)
                    name, seen = at, {}
                n, held = seen.get(ctx, (0, row))
                seen[ctx] = (n + times, held)
            yield out()
            found = []
        found += block(seen)
        yield out()

    rows = contexts.select("block", "ctx", "n", "id", "print", "pos", "left", "around").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(run, "id long, print long, start long, stop long")


def _halves(contexts: DataFrame, length: int) -> DataFrame:
    """The contexts of overfull blocks in two blocks each, one for either half of the numbers
    of bytes before the sample, low to high, at which the block's suffixes start. All strings
    of a half hold the bytes from low before the sample to length - high after it; these name
    the new block, so that it has fewer members. With one number left they are the whole
    string, and the block has one context."""

    def name(a: int, b: int, raw: bytes) -> bytes:
        return hashlib.blake2b(b"%d %d " % (a, b) + raw, digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, doc, pr, pos, left, raw, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mid = (low + high) // 2
                for a, b in (low, mid), (mid + 1, high):
                    if a <= b and left >= a and len(raw) - left >= length - b:
                        most = min(left, b)
                        part = raw[left - most : left + length - a]
                        out.append((name(a, b, raw[left - a : left + length - b]), name(most, a, part), n, doc, pr, pos, most, part, a, b))
            cols = list(zip(*out, strict=True)) or [[]] * len(_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES.values(), strict=True)], list(_TYPES))

    rows = contexts.select("n", "id", "print", "pos", "left", "around", "low", "high")
    return rows.mapInArrow(run, "block binary, ctx binary, n long, id long, print long, pos long, left int, around binary, low int, high int")


_TYPES = {"block": pa.binary(), "ctx": pa.binary(), "n": pa.int64(), "id": pa.int64(), "print": pa.int64(), "pos": pa.int64(), "left": pa.int32(), "around": pa.binary(), "low": pa.int32(), "high": pa.int32()}


def _combined(rows: DataFrame) -> DataFrame:
    """One row a block and context, n summed; combined before the shuffle."""
    firsts = [F.first(c).alias(c) for c in ("id", "print", "pos", "left", "around", "low", "high")]
    return rows.groupBy("block", "ctx").agg(F.sum("n").alias("n"), *firsts)


def _mixed(classes: DataFrame) -> DataFrame:
    """block, contexts: blocks of several contexts, of which one at least isn't known to repeat."""
    return classes.groupBy("block").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).filter("contexts > 1 and least = 1").drop("least")


def repeated_intervals(texts: DataFrame, length: int, block_contexts: int) -> DataFrame:
    """texts (id, print, text) -> id, print, start, stop: together they cover the bytes that
    go, and no others. Every block is sorted; one of more than block_contexts contexts is
    halved first, at most log2(length) times."""
    samples = written(_scan(texts, length), "samples")
    classes = written(samples.groupBy("gram", "ctx").agg(F.count("*").alias("n"), F.min("id").alias("id")), "contexts")
    again = classes.filter("n > 1").select("gram", "ctx")
    often = _marked(_bitmap(again.select(_cell("ctx").alias("cell")).distinct(), BITS))
    whole = samples.filter(often(_cell("ctx"))).join(again, ["gram", "ctx"], "left_semi")
    out = whole.select("id", "print", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("stop"))
    sizes = written(_mixed(classes.select(F.col("gram").alias("block"), "n")), "blocks")
    wanted = _bitmap(sizes.select(_cell("block").alias("cell")).distinct(), BITS)
    sender = _cell("ctx").bitwiseXOR(F.col("id").bitwiseAND(F.lit((1 << BITS) - 1)))
    senders = _bitmap(classes.filter(_marked(wanted)(_cell("gram"))).select(sender.alias("cell")).distinct(), BITS)
    rows = _gather(texts, length, wanted, senders)
    rows = rows.withColumns({"n": F.lit(1).cast("long"), "low": F.lit(0), "high": F.lit(length - gram_of(length))})
    while (large := sizes.filter(F.col("contexts") > block_contexts).select("block")).limit(1).count():
        rows = written(rows, "gathered")
        out = out.union(_sorted_blocks(rows.join(large, "block", "left_anti"), length))
        halves = written(_halves(_combined(rows.join(large, "block", "left_semi")), length), "halves")
        classes = written(halves.groupBy("block", "ctx").agg(F.sum("n").alias("n")), "contexts")
        twice = halves.filter((F.col("n") == 1) & (F.octet_length("around") >= length)).join(classes.filter("n > 1"), ["block", "ctx"], "left_semi")
        start = F.col("pos") - F.col("left")
        out = out.union(twice.select("id", "print", start.alias("start"), (start + F.octet_length("around")).alias("stop")))
        sizes = written(_mixed(classes), "blocks")
        rows = _combined(halves.join(sizes.select("block"), "block", "left_semi"))
    return out.union(_sorted_blocks(rows, length))


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes and maximal runs removed, and what is left."""
    kept, at, runs, gone = [], 0, 0, 0
    stop = -1
    for a, b in sorted(spans):
        if a > stop:
            runs += 1
            kept.append(raw[at:a])
            gone += b - a
            stop = at = b
        elif b > stop:
            gone += b - stop
            stop = at = b
    kept.append(raw[at:])
    return gone, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, block_contexts: int = 20_000, with_bytes: bool = False, passage_words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with
    with_bytes kept (binary), with passage_words shares_passage: one row for each row of docs.

    Texts are their UTF-8 bytes, null is empty. Strings never cross documents; what repeats
    is judged on the input. Repeated rows, whole or not, repeat each other's strings. Texts
    shorter than `length` stay whole. A null id is passed on. An empty table gives an empty
    result; other columns are ignored. shares_passage says whether so many words in turn also
    stand in another row, however few bytes they have; no byte goes for that.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NONE_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text")).select("id", "print", "text")
    found = repeated_intervals(rows.filter(F.octet_length("text") >= length), length, block_contexts)
    found = found.withColumn("shares", F.lit(False))
    if passage_words:
        held = sharing(rows.filter(F.octet_length("text") >= 2 * passage_words - 1), passage_words)
        found = found.unionByName(held.withColumn("shares", F.lit(True)), allowMissingColumns=True)
    span = F.when(F.col("start").isNotNull(), F.struct("start", "stop"))
    spans = written(found.groupBy("id", "print").agg(F.collect_set(span).alias("spans"), F.max("shares").alias("shares")), "spans")
    cell = F.shiftrightunsigned(F.xxhash64("id", "print"), 64 - BITS)
    # Only documents with something to remove or to say move; a bit set by chance just moves one more.
    marked = _marked(_bitmap(spans.select(cell.alias("cell")).distinct(), BITS))
    rows = rows.withColumn("moves", marked(cell))
    more = {"kept": ("binary", pa.binary())} if with_bytes else {}
    more |= {"shares_passage": ("boolean", pa.bool_())} if passage_words else {}
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + "".join(f", {name} {kind}" for name, (kind, _) in more.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, spans, shares in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                gone, runs, kept = _cut(raw, [(s["start"], s["stop"]) for s in spans or []])
                also = {"kept": kept, "shares_passage": bool(shares)}
                out.append((i, len(raw), gone, runs, hashlib.sha256(kept).hexdigest(), *(also[name] for name in more)))
            types = [pa.int64()] * 4 + [pa.string(), *(t for _, t in more.values())]
            cols = list(zip(*out, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in schema.split(", ")])

    changed = rows.filter("moves").join(spans, ["id", "print"], "left").select("id", "text", "spans", "shares").mapInArrow(run, schema)
    raw = F.col("text").cast("binary")
    none = {"kept": raw, "shares_passage": F.lit(False)}
    same = rows.filter("not moves").select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"), *(none[name].alias(name) for name in more))
    out = changed.union(same)
    return out.withColumn("id", F.when(F.col("id") != NONE_ID, F.col("id"))).withColumnRenamed("id", "doc_id")


def query(docs: DataFrame) -> DataFrame:
    """One row for each document: what remove_repeats says of it, shares_passage: does it hold over
    50 words in turn of another document, has_repeats: does it lose bytes?"""
    return remove_repeats(docs, passage_words=51).withColumn("has_repeats", F.col("n_removed") > 0)
