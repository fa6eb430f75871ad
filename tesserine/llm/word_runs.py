"""Periodic run detection over words (operator 12).

A run is a stretch of words with smallest period q, at least max(least, folds * q) words
long, that no neighbouring word extends.

1. Tiles. For each octave of periods, P to 2P - 1, a document's words are cut into tiles of
   `STRIDE` * P words that overlap by `OVERLAP` * P. Any 4P words lie within one tile, so
   every run of the octave shows in a tile, and what tiles see of one run overlaps by more
   than a period. An octave is asked only of documents that can hold a run of it. Tiles are
   cut and solved in the task that reads the document: they'd move each word once an octave.
2. Fragments. In a tile, words at block boundaries b, P apart, are compared with the words q
   further on: blocks of P words have names, made by doubling from those of P / 2, and each
   place in the next block is compared with its own boundary, so each word is looked at once
   an octave. Places whose block has a smaller period that divides q are no smallest period
   and go. Then the Z-function at each boundary, forward and backward, gives how far the
   words agree with those q further on; as neighbouring boundaries were asked too, it is
   read to the next boundary only. Names choose where to look; words decide.
3. Stitching. Fragments, a few numbers each, are shuffled by document and period. Those
   that overlap by a period are one run; joined ones that are too short go.
4. Documents without fragments are done. The words of others wait in a table until their
   runs arrive, then repeats are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import written
from .hashing import scramble

#: Shortest run in words, and in periods. STRIDE, OVERLAP: of a tile, in units of its octave;
#: any LEAST_FOLDS * 2P words of period under 2P need an overlap of 4P, and hold a block.
LEAST_WORDS, LEAST_FOLDS = 6, 4
STRIDE, OVERLAP = 12, 4
#: Documents are worked on together up to so many bytes, a longer one alone.
PIECE_BYTES = 1 << 21

NO_WORDS = np.empty(0, np.int64)


def words_of(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
    """The words of each text (null: none), all words in turn as numbers (equal words, equal
    numbers), and where each text's begin."""
    # texts may be so long that offsets pass 32 bits
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    there = pc.not_equal(flat, "")
    kept = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    begins = kept[offsets - offsets[0]]
    flat = flat.filter(there)
    numbers = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), flat), numbers, begins


def planted(n: int, h: int | None) -> np.ndarray | None:
    """The original word that stands at each place of a document of n words with checksum h,
    where h asks for a planted repeat; else None."""
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def primes_of(top: int) -> np.ndarray:
    """The least prime that divides each number up to top."""
    out = np.arange(top + 1)
    for r in range(2, int(top**0.5) + 1):
        if out[r] == r:
            some = out[r * r :: r]
            some[some == np.arange(r * r, top + 1, r)] = r
    return out


def tiles(lengths: np.ndarray, begins: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, from, to) of the tiles of an octave; from and to count all words in turn."""
    wide = np.flatnonzero(lengths >= least)
    count = np.maximum(1, -(-(lengths[wide] - OVERLAP * size) // (STRIDE * size)))
    doc = np.repeat(wide, count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    lo = begins[doc] + nth * STRIDE * size
    return doc, lo, np.minimum(lo + (STRIDE + OVERLAP) * size, begins[doc] + lengths[doc])


def solve(words: np.ndarray, names: list[np.ndarray], octave: int, lo: np.ndarray, hi: np.ndarray, least_prime: np.ndarray) -> tuple[np.ndarray, ...]:
    """(tile, period, from, to) of the fragments of tiles (lo, hi) whose smallest period is in
    the octave. names[k][i]: the 2**k words from i, for k = octave and, if any, octave - 1."""
    size = 1 << octave
    name = names[octave]
    # every place j of a tile from its second block on, whose block ends in the tile
    count = np.maximum(0, hi - lo - 2 * size + 1)
    tile = np.repeat(np.arange(len(lo)), count)
    inside = size + np.arange(len(tile)) - np.repeat(np.cumsum(count) - count, count)
    base = lo[tile]
    edge = base + (inside // size - 1) * size
    same = np.flatnonzero(name[base + inside] == name[edge])
    tile, edge, period = tile[same], edge[same], (base + inside - edge)[same]
    smallest, left = np.ones(len(tile), bool), period.copy()
    while (left > 1).any():
        r = np.where(left > 1, least_prime[left], 1)
        ask = np.flatnonzero((r > 1) & smallest)
        step = period[ask] // r[ask]
        # equal over q - step words: two blocks of 2**k, k = octave or octave - 1, cover them
        span, a = period[ask] - step, edge[ask]
        big = span >= size
        block = np.where(big, size, max(1, size >> 1))
        if octave:
            of = lambda at, big=big: np.where(big, names[octave][np.minimum(at, len(names[octave]) - 1)], names[octave - 1][at])
        else:
            of = names[0].__getitem__
        equal = (of(a) == of(a + step)) & (of(a + span - block) == of(a + step + span - block))
        smallest[ask[equal]] = False
        left = np.where(r > 1, left // r, left)
    tile, edge, period = tile[smallest], edge[smallest], period[smallest]
    if not len(tile):
        return NO_WORDS, NO_WORDS, NO_WORDS, NO_WORDS
    # boundaries in turn with one period are one stretch
    by = np.lexsort((edge, period, tile))
    tile, edge, period = tile[by], edge[by], period[by]
    new = np.concatenate([[True], (tile[1:] != tile[:-1]) | (period[1:] != period[:-1]) | (edge[1:] - edge[:-1] != size)])
    first, last = np.flatnonzero(new), np.concatenate([np.flatnonzero(new)[1:], [len(new)]]) - 1
    tile, period, start, end = tile[first], period[first], edge[first], edge[last] + size
    # Z at the first boundary backward and at the last one forward, up to the next boundary
    start = start - z_values(words, start, period, lo[tile], size, -1)
    end = end + z_values(words, end, period, hi[tile] - period, size, 1)
    return tile, period, start, end + period


def z_values(words: np.ndarray, at: np.ndarray, period: np.ndarray, bound: np.ndarray, most: int, way: int) -> np.ndarray:
    """How many words from `at` on (way 1: at, at + 1, ...; -1: at - 1, at - 2, ...) equal those
    a period further on; at most `most`, and not beyond bound."""
    out, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
    step = 1
    done = 0
    while len(open_) and done < most:
        width = min(step, most - done)
        k = done + np.arange(width)
        place = at[open_, None] + (k if way > 0 else -1 - k)
        within = place < bound[open_, None] if way > 0 else place >= bound[open_, None]
        place = np.where(within, place, 0)
        ok = within & (words[place] == words[np.where(within, place + period[open_, None], 0)])
        run = np.where(ok.all(1), width, ok.argmin(1))
        out[open_] += run
        open_ = open_[run == width]
        done, step = done + width, step * 2
    return out


def fragments(words: np.ndarray, begins: np.ndarray, least_words: int = LEAST_WORDS, folds: int = LEAST_FOLDS) -> tuple[np.ndarray, ...]:
    """(document, period, start, end), start and end counted in the document, of all that tiles
    show of runs. words: those of all documents in turn."""
    if folds < OVERLAP:
        raise ValueError("tiles show only runs of at least OVERLAP periods")
    lengths = np.diff(begins)
    out: list[tuple[np.ndarray, ...]] = []
    longest = int(lengths.max(initial=0))
    if longest < least_words:
        return NO_WORDS, NO_WORDS, NO_WORDS, NO_WORDS
    least_prime = primes_of(2 * (longest // folds) + 2)
    names, octave = [scramble(words.astype(np.uint64) + np.uint64(1))], 0
    while (1 << octave) * folds <= longest:
        size = 1 << octave
        if octave:
            half, old = size >> 1, names[octave - 1]
            with np.errstate(over="ignore"):
                names.append(scramble(old[:-half] + scramble(old[half:] ^ np.uint64(size))) if len(old) > half else old[:0])
            if octave > 1:
                names[octave - 2] = names[octave - 2][:0]
        doc, lo, hi = tiles(lengths, begins[:-1], size, max(least_words, folds * size))
        tile, period, start, end = solve(words, names, octave, lo, hi, least_prime)
        # what doesn't reach the edge of its tile is whole; what does, and is shorter than the
        # overlap, is an end of a run that the neighbouring tile holds
        cut = (start == lo[tile]) & (lo[tile] > begins[doc[tile]]) | (end == hi[tile]) & (hi[tile] < begins[doc[tile] + 1])
        long = end - start >= np.where(cut, OVERLAP * size, np.maximum(least_words, folds * period))
        tile, period, start, end = tile[long], period[long], start[long], end[long]
        true = agrees(words, start, end, period)
        tile, period, start, end = tile[true], period[true], start[true], end[true]
        out.append((doc[tile], period, start - begins[doc[tile]], end - begins[doc[tile]]))
        octave += 1
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def agrees(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether words a period apart are equal all over each stretch: names may lie, with a
    chance of 2**-64 a comparison, and words may not."""
    out = np.ones(len(start), bool)
    for i, (a, b, q) in enumerate(zip(start.tolist(), end.tolist(), period.tolist(), strict=True)):
        out[i] = (words[a : b - q] == words[a + q : b]).all()
    return out


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE_BYTES."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + PIECE_BYTES, "right")))
        yield lo, hi
        lo = hi


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def scanned(docs: DataFrame, kind: str, plant: bool) -> DataFrame:
    """docs (row, doc_id, text, h) -> row, doc_id, n_words, collapsed_sha256 of documents
    without fragments, words and fragments of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                lists, numbers, begins = words_of(batch.column("text").slice(lo, hi - lo))
                sums = batch.column("h").slice(lo, hi - lo).to_pylist()
                put = {i: at for i, n in enumerate(np.diff(begins).tolist()) if plant and (at := planted(n, sums[i])) is not None}
                if put:
                    numbers = numbers.copy()
                for i, at in put.items():
                    mine = numbers[begins[i] : begins[i + 1]]
                    mine[:] = mine[at]
                doc, period, start, end = fragments(numbers, begins)
                by = np.argsort(doc, kind="stable")
                held, at = np.unique(doc[by], return_index=True)
                found = dict(zip(held.tolist(), np.split(by, at[1:]), strict=True)) if len(held) else {}
                rows = []
                for i in range(hi - lo):
                    words = lists[i].values
                    words = words.take(pa.array(put[i])) if i in put else words
                    text = " ".join(words.to_pylist())
                    if (at := found.get(i)) is None:
                        rows.append((len(words), sha256(text), None, []))
                    else:
                        rows.append((len(words), None, text, [{"period": q, "start": s, "end": e} for q, s, e in zip(period[at].tolist(), start[at].tolist(), end[at].tolist(), strict=True)]))
                n, sha, text, frags = zip(*rows, strict=True)
                spans = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
                columns = [batch.column("row").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(text, pa.string()), pa.array(frags, spans)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "collapsed_sha256", "words", "fragments"])

    return docs.mapInArrow(run, f"row long, doc_id {kind}, n_words long, collapsed_sha256 string, words string, fragments array<struct<period: long, start: long, end: long>>")


def stitched(fragments: DataFrame, least_words: int = LEAST_WORDS, folds: int = LEAST_FOLDS) -> DataFrame:
    """fragments (row, period, start, end) -> one row a run: row, start, length, period."""
    by = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = fragments.withColumn("new", F.coalesce((F.col("start") + F.col("period") > before).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("row", "period", "run").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return runs.filter((F.col("length") >= least_words) & (F.col("length") >= folds * F.col("period"))).select("row", "start", "length", "period")


def collapsed(rows: DataFrame) -> DataFrame:
    """rows (words, runs, ...) -> the same with collapsed in place of words: the words less
    those that a run holds after its first period."""
    kept = [f for f in rows.schema.fields if f.name != "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("words"), batch.column("runs").to_pylist(), strict=True):
                words = text.as_py().split(" ")
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs or []:
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                out.append(" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(out, pa.string())], [*[f.name for f in kept], "collapsed"])

    return rows.mapInArrow(run, StructType([*kept, StructField("collapsed", StringType())]))


def run_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, runs). documents, a written table: row (unique), doc_id, n_words,
    fragments, and collapsed_sha256 (no fragments) or words. runs, written too: row, runs, a
    list of (start, length, period) by start, then period.

    Words are runs of characters other than ASCII spaces, so null, empty and blank texts
    have none, and no runs. Rows stand for themselves: equal ones, and rows with equal or no
    ids, are each answered. With `plant`, documents whose checksum asks for it (never a null
    id) are given a repeat first. An empty table gives empty ones; other columns are ignored."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"))
    seen = written(scanned(rows, kind, plant), "words")
    runs = stitched(seen.select("row", F.explode("fragments").alias("f")).select("row", "f.*"))
    runs = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    return seen, written(runs, "runs")


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: one row a document, its words joined by one space, each run cut down to
    its first period. The rules are run_table's."""
    raw = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    raw = written(raw, "texts")
    seen, runs = run_table(raw.select(F.struct("row", "doc_id").alias("id"), "text"), "id", "text")
    cut = collapsed(seen.join(runs, "row").select("doc_id", "words", "runs"))
    spaced = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return raw.join(cut.select("doc_id.row", "collapsed"), "row", "left").select("doc_id", F.coalesce("collapsed", spaced).alias("text"))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256:
    one row a document, of the words with planted repeats."""
    seen, runs = run_table(docs, plant=True)
    cut = collapsed(seen.filter("words is not null").select("row", "doc_id", "words").join(runs, "row", "left"))
    cut = cut.select("doc_id", "runs", F.sha2("collapsed", 256).alias("collapsed_sha256"))
    whole = seen.filter("words is null").select("doc_id", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"), "collapsed_sha256")
    rows = whole.unionByName(cut).withColumn("runs", F.coalesce("runs", F.array().cast(runs.schema["runs"].dataType)))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    top = rows.withColumn("top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        (-F.col("top.less")).alias("length"),
        "top.period",
        F.expr("1000 * -top.less div top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
