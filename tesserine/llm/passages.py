"""Documents that hold a passage of another document, word for word.

Repeats in bytes (substring_dedup) leave short passages alone: fifty words are often fewer than
400 bytes. Here a passage is `words` words in turn, whatever spaces stand between them.

In every passage the run of GRAM words with the least hash is its sample, so equal passages
have theirs at the same place. First the samples are counted with one passage around each; that
finds all documents whose common text is long. What is left are documents that share a sample
but no such passage: only for the samples of these all passages are compared. Samples and
passages are named by a hash of 64 bits each, and must agree in both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, written
from .hashing import IS_SPACE, POWERS, U, pieces, prefix_sums, scramble
from .jaccard_join import _bitmap, _cells, _has

#: Words of a sample.
GRAM = 16
#: At most 2**BITS cells a bitmap (16 MB). A cell set by chance only lets a row through.
BITS = 27


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of every `width` values in turn, the leftmost of equals."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        at = np.where(values[at[step:]] < values[at[:-step]], at[step:], at[:-step])
        have += step
    return at


def _passages(texts: list[str], words: int):
    """For some texts in turn: first text, bounds of the texts in words, grams by first word,
    passages by first word, first words of the passages inside one text, their samples."""
    gram = min(GRAM, words)
    with np.errstate(over="ignore"):
        for first, raws in pieces(texts):
            data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
            edge = np.flatnonzero(np.diff(np.concatenate([[True], IS_SPACE[data]]).astype(np.int8)))
            starts, ends = edge[0::2], edge[1::2]
            n = len(starts)
            if n < words:
                continue
            sums, (up, down) = prefix_sums(data), POWERS.get(len(data) + 1)
            each = scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
            bounds = np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raws)]))
            sums = np.concatenate([np.zeros(1, U), np.cumsum(each * up[:n])])
            of = lambda k: scramble((sums[k:] - sums[:-k]) * down[: n - k + 1])  # noqa: E731, B023
            grams, whole = of(gram), of(words)
            inside = np.flatnonzero(np.arange(words, n + 1) <= np.repeat(bounds[1:], np.diff(bounds))[: n - words + 1])
            yield first, bounds, grams, whole, inside, _least(grams, words - gram + 1)[inside]


def _rows(ids, prints, text, gram, passage) -> pa.RecordBatch:
    """id, print, gram, passage, once a text."""
    order = np.lexsort((passage, gram, text))
    text, gram, passage = text[order], gram[order], passage[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(text) != 0) | (gram[1:] != gram[:-1]) | (passage[1:] != passage[:-1])
    cols = [ids[text[new]], prints[text[new]], gram[new].view(np.int64), passage[new].view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "print", "gram", "passage"])


_SCHEMA = "id long, print long, gram long, passage long"


class Marks:
    """A broadcast bitmap of some 64-bit hashes, of 64 cells a row at least, up to 2**BITS."""

    def __init__(self, rows: DataFrame, name: str) -> None:
        self.bits = min(BITS, max(16, rows.count().bit_length() + 6))
        self.bitmap = _bitmap(rows.select(F.shiftrightunsigned(name, 64 - self.bits).alias("cell")).distinct(), self.bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return _has(self.bitmap.value, _cells(hashes.view(U), self.bits))

    def on(self, name: str) -> Column:
        @F.pandas_udf("boolean")
        def marked(hashes):
            import pandas as pd

            return pd.Series(self.has(hashes.to_numpy()))

        return marked(name)


def _sampled(texts: DataFrame, words: int) -> DataFrame:
    """Each sample with the passage around it: its middle there, or near the text's ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, bounds, grams, whole, _, least in _passages(batch.column(2).to_pylist(), words):
                at = np.unique(least)
                text = np.searchsorted(bounds, at, "right") - 1
                around = np.clip(at - (words - min(GRAM, words)) // 2, bounds[text], bounds[text + 1] - words)
                yield _rows(ids, prints, first + text, grams[at], whole[around])

    return texts.mapInArrow(run, _SCHEMA)


def _compared(texts: DataFrame, words: int, wanted: Marks, held: Marks) -> DataFrame:
    """All passages whose sample may be among wanted, of the texts whose print may be among held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(held.has(batch.column(1).to_numpy())))
            ids, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, bounds, grams, whole, inside, least in _passages(batch.column(2).to_pylist(), words):
                keep = wanted.has(grams[least])
                at = inside[keep]
                yield _rows(ids, prints, first + np.searchsorted(bounds, at, "right") - 1, grams[least[keep]], whole[at])

    return texts.mapInArrow(run, _SCHEMA)


def _twice(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """id, print of the rows whose passage stands in several texts."""
    again = counts.filter("n > 1")
    rows = rows.filter(Marks(again, "passage").on("passage"))
    return spread_join(rows, again, ["gram", "passage"], "n").select("id", "print").distinct()


def _among(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """The rows whose gram is one of grams, a written table (gram, n)."""
    return spread_join(rows.filter(Marks(grams, "gram").on("gram")), grams, "gram", "n")


def _counted(rows: DataFrame) -> DataFrame:
    return written(rows.groupBy("gram", "passage").agg(F.count("*").alias("n")), "counts")


def sharing(texts: DataFrame, words: int) -> DataFrame:
    """texts (id, print, text) -> id, print of those that hold `words` words in turn which also
    stand in another row. Words are runs of characters other than ASCII spaces and are compared
    as they are, letters' case included; rows with the same id are rows of their own."""
    samples = written(_sampled(texts, words), "samples")
    counts = _counted(samples)
    found = written(_twice(samples, counts), "sharing")
    mixed = counts.groupBy("gram").agg(F.count("*").alias("passages"), F.min("n").alias("least"), F.sum("n").alias("n")).filter("passages > 1 and least = 1")
    mixed = written(mixed.select("gram", "n"), "mixed")
    unsure = _among(samples, mixed).join(found, ["id", "print"], "left_anti").select("gram").distinct()
    wanted = written(unsure.join(mixed, "gram"), "wanted")
    held = written(_among(samples, wanted).select("print").distinct(), "held")
    rows = written(_compared(texts, words, Marks(wanted, "gram"), Marks(held, "print")), "passages")
    return found.union(_twice(rows, _counted(rows)))
