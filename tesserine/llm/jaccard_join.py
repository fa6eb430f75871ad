"""N-gram Jaccard join by T-occurrence search with DivideSkip (operator 5).

Two documents link when their sets of k-word shingles have a Jaccard similarity of at
least percent/100. The result has every document with the component that links give.

1. Sets. A document is the sorted set of its shingles' 64-bit hashes. Documents with
   equal sets are one class, of which one goes on: a large group of copies costs a row.
2. Blocks. Documents that link share at least one shingle among the first
   n - ceil(percent*n/100) + 1 of each, in any order common to all. Shingles are counted
   over the first part of the hashes; of these the rarest come first, by level of their
   count and then by hash, and the hashes that weren't counted come last. So common
   shingles don't chain documents that are unlike into one large block. Levels are known
   from bitmaps of fixed size; a false entry changes the order, never the result. Documents
   that share a shingle so chosen and have sizes in one of two neighbouring bands fall in
   one block; documents of different blocks can't link.
3. Search. A block's inverted lists are built in one task, from at most about
   `chunk_shingles` shingles. A query's short lists are merged to count occurrences, its
   long ones are probed by binary search (DivideSkip), and documents with the required
   overlap link. Some hubs are searched first; after that only documents outside the
   block's largest component are queries, since every missing link has one of them.
4. Blocks too large for one task are dealt to chunks by size, as only documents of like
   size can link. Each chunk is searched as above; then the largest component's hub, then
   all documents outside that component, are searched in the chunks of like size, streamed
   past the index. No link is lost, nothing is capped, and a hot group of near copies costs
   in proportion to its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, small_batches, written
from .graph import components
from .hashing import shingle_sets

#: 2**BITS cells of each bitmap (8 MB): a bound on what is broadcast.
BITS = 26
HUBS = 4
#: A shingle's level is the number of these counts that it passes: three bits.
LEVELS = (1, 2, 4, 8, 16, 64, 512)
#: What a probe costs against a step of a merge, as in the paper on DivideSkip.
MU = 0.01


def required(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def band(n, percent: int):
    """Documents that link are in the same band of sizes or in neighbouring ones."""
    return F.floor(F.log(n) / (np.log(100 / percent) * (1 + 1e-9) + 1e-9)).cast("long")


def prefix_length(n: int, percent: int) -> int:
    return n - required(n, percent) + 1


def counted_below(percent: int) -> np.uint64:
    """The hash up to which shingles are counted in long sets: twice the prefix's share."""
    return np.uint64(min((1 << 64) - 1, (1 << 64) * 2 * (100 - percent) // 100))


def _cells(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _has(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> 6] >> (cells & 63).astype(np.uint64)) & np.uint64(1) != 0


def _bitmap(cells: DataFrame, bits: int = BITS):
    """cells (cell) -> a broadcast of 2**bits bits. The words are made by Spark."""
    words = cells.groupBy(F.expr("shiftright(cell, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy().astype(np.int64)] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return cells.sparkSession.sparkContext.broadcast(out)


def _levels(counted: DataFrame, hot_docs: int, bits: int = BITS):
    """counted (h, count) -> a broadcast of three bitmaps, the digits of each cell's level.
    Counts below hot_docs have level 0. Cells that collide have the digits of both."""
    level = sum(((F.col("count") > c) & (F.col("count") >= hot_docs)).cast("int") for c in LEVELS)
    rows = counted.select(_h_cell().alias("cell"), level.alias("level")).filter("level > 0")
    digit = lambda i: F.expr(f"bit_or(if(level & {1 << i} = 0, 0L, shiftleft(1L, cast(cell & 63 as int))))").alias(f"d{i}")
    words = rows.groupBy(F.expr("shiftright(cell, 6)").alias("word")).agg(*map(digit, range(3))).toArrow()
    out = np.zeros((3, 1 << (bits - 6)), np.uint64)
    for i in range(3):
        out[i, words["word"].to_numpy().astype(np.int64)] = words[f"d{i}"].to_numpy().astype(np.int64).view(np.uint64)
    return counted.sparkSession.sparkContext.broadcast(out)


def _rarest_first(s: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """s, sorted, by level where its hashes are counted, the others last. The order of two
    shingles doesn't depend on the set."""
    counted = s[: np.searchsorted(s, counted_below(percent), "right")]
    cells = _cells(counted)
    level = sum((_has(levels[i], cells).astype(np.int64) << i for i in range(3)), np.zeros(len(cells), np.int64))
    return np.concatenate([counted[np.argsort(level, kind="stable")], s[len(counted) :]])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat, pa.int64()))


def _sets(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """id, n, fingerprint of the set, its first shingles by hash: twice the prefix, so
    that what moves up when common ones are put last has been counted too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, heads = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), k):
                n.append(len(s))
                prints.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                heads.append(s[: 2 * prefix_length(len(s), percent)] if len(s) else s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), _lists(heads)], ["id", "n", "print", "head"])

    return texts.mapInArrow(run, "id long, n long, print binary, head array<long>")


def _heads(texts: DataFrame, k: int, percent: int, levels, chosen) -> DataFrame:
    """id, n, head: the size and the first shingles in the order that has the rarest first,
    of the texts whose id's bit is set in chosen. The bit is looked up here and not by
    _marked, as a task would then hold two Python workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_has(chosen.value, batch.column(2).to_numpy())))
            n, heads = [], []
            for s in shingle_sets(batch.column(1).to_pylist(), k):
                n.append(len(s))
                if len(s):
                    s = _rarest_first(s, levels.value, percent)[: prefix_length(len(s), percent)]
                heads.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), _lists(heads)], ["id", "n", "head"])

    return texts.withColumn("cell", _id_cell()).mapInArrow(run, "id long, n long, head array<long>")


def _id_cell():
    return F.shiftrightunsigned(F.xxhash64("id"), 64 - BITS)


def _h_cell():
    return F.shiftrightunsigned("h", 64 - BITS)


def _marked(df: DataFrame, cell, bitmap) -> DataFrame:
    """The rows whose bit is set, and a few others. Only cells go to Python, and no row is
    shuffled, whatever the size of what the bitmap stands for."""

    @F.arrow_udf("boolean")
    def has(cells: pa.Array) -> pa.Array:
        return pa.array(_has(bitmap.value, cells.to_numpy()))

    return df.filter(has(cell))


class Index:
    """Inverted lists of some sets, each given sorted."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.shingles, self.docs = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def _merge(self, lo: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Occurrences of each document in the lists."""
        ends = np.cumsum(lens)
        if not len(ends) or not ends[-1]:
            return np.zeros(len(self.sets), np.int64)
        at = np.arange(ends[-1]) + np.repeat(lo - (ends - lens), lens)
        return np.bincount(self.docs[at], minlength=len(self.sets))

    def search(self, query: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Documents that link with query, of those allowed."""
        n, share = len(query), self.percent
        lo, hi = np.searchsorted(self.shingles, query), np.searchsorted(self.shingles, query, "right")
        lens = hi - lo
        least = required(n, share)
        longest = int(lens.max(initial=0))
        skip = min(int(least / (MU * np.log2(longest + 2) + 1)), least - 1, n)
        by_length = np.argsort(lens, kind="stable")
        short, long = by_length[: n - skip], by_length[n - skip :]
        counts = self._merge(lo[short], lens[short])
        sizes = self.sizes
        fits = (counts >= least - skip) & (100 * np.minimum(n, sizes) >= share * np.maximum(n, sizes))
        if allowed is not None:
            fits &= allowed
        found, probes = np.flatnonzero(fits), np.sort(query[long])
        if len(probes) and len(found):
            more = np.empty(len(found), np.int64)
            for j, d in enumerate(found):
                s = self.sets[d]
                where = np.searchsorted(s, probes)
                more[j] = np.count_nonzero(s[np.minimum(where, len(s) - 1)] == probes)
            both = counts[found] + more
        else:
            both = counts[found]
        return found[100 * both >= share * (n + sizes[found] - both)]


class Union:
    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, docs: np.ndarray) -> None:
        labels = np.unique(self.label[docs])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]


def link_block(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the first set of its component."""
    index, union = Index(sets, percent), Union(len(sets))
    asked = np.zeros(len(sets), bool)
    for _ in range(HUBS):  # the largest set without a link is the next hub
        left = np.flatnonzero(~asked & (union.label == np.arange(len(sets))) & (np.bincount(union.label, minlength=len(sets)) == 1))
        if len(left) <= 1 or len(sets) <= 2 * HUBS:
            break
        hub = left[np.argmax(index.sizes[left])]
        asked[hub] = True
        union.join(np.append(index.search(sets[hub]), hub))
    most = np.bincount(union.label).argmax()
    for q in np.flatnonzero((union.label != most) & ~asked):
        union.join(np.append(index.search(sets[q], union.label != union.label[q]), q))
    return union.label


def _rows(batch: pa.RecordBatch, k: int) -> Iterator[tuple]:
    """The rows of a batch with the set of the last column, a text, in its place. Texts are
    shuffled and not sets, as hashes take more bytes and don't compress."""
    *cols, texts = batch.columns
    rows = zip(*(c.to_pylist() for c in cols), strict=True)
    for row, s in zip(rows, shingle_sets(texts.to_pylist(), k), strict=True):
        yield (*row, s.view(np.int64)[np.argsort(s.view(np.int64))])


def _groups(batches: Iterator[pa.RecordBatch], keys: int, k: int) -> Iterator[tuple[tuple, list[tuple[int, ...]], list[np.ndarray]]]:
    """Rows sorted by the first `keys` columns: (key, other columns but the last, sets)."""
    key, rest, sets = None, [], []
    for batch in batches:
        for row in _rows(batch, k):
            if row[:keys] != key:
                if rest:
                    yield key, rest, sets
                key, rest, sets = row[:keys], [], []
            rest.append(row[keys:-1])
            sets.append(row[-1])
    if rest:
        yield key, rest, sets


def _link_chunks(members: DataFrame, k: int, percent: int) -> DataFrame:
    """members (block, chunk, id, text) -> block, chunk, id, root in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block, chunk), rest, sets in _groups(batches, 2, k):
            ids = np.array([r[0] for r in rest], np.int64)
            label = link_block(sets, percent)
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(np.full(n, chunk)), pa.array(ids), pa.array(ids[label])], ["block", "chunk", "id", "root"])

    rows = members.select("block", "chunk", "id", "text").repartition("block", "chunk").sortWithinPartitions("block", "chunk", "id")
    return rows.mapInArrow(run, "block long, chunk long, id long, root long")


def _probe_chunks(members: DataFrame, queries: DataFrame, k: int, percent: int) -> DataFrame:
    """members and queries (block, chunk, id, root, text): links (a, b) between the roots
    of queries and of the members of their chunk that they link with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index, sets, roots = None, None, [], []
        for batch in batches:
            a, b = [], []
            for block, chunk, asks, root, s in _rows(batch, k):
                if (block, chunk) != key:
                    key, index, sets, roots = (block, chunk), None, [], []
                if not asks:
                    sets.append(s)
                    roots.append(root)
                elif sets:
                    if index is None:  # queries come after all members of their chunk
                        index, roots = Index(sets, percent), np.array(roots, np.int64)
                    for other in np.unique(roots[index.search(s, roots != root)]):
                        a.append(root)
                        b.append(int(other))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    cols = ["block", "chunk", "asks", "root", "text"]
    rows = members.withColumn("asks", F.lit(False)).select(cols).union(queries.withColumn("asks", F.lit(True)).select(cols))
    return rows.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "asks").mapInArrow(run, "a long, b long")


def _large_blocks(members: DataFrame, linked: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between chunks of the blocks that have several: first from the hub of the block's
    largest component, then from all documents outside that component, each searched in the
    chunks of the three bands around its own."""
    small = lambda df, tag: if_small(written(df, tag))  # noqa: E731  thin tables; texts stay where they are
    rows = written(members.filter("parts > 0").join(small(linked.select("id", "root"), "roots"), "id"), "large")
    links = None
    for hubs in (True, False):
        size = rows.groupBy("block", "band", "chunk", "root").agg(F.count("*").alias("n"))
        by_root = size.groupBy("block", "root").agg(F.sum("n").alias("n"))
        largest = by_root.groupBy("block").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
        chunks = size.join(largest, "block").groupBy("block", "band", "chunk").agg(F.max(F.col("root") == F.col("largest")).alias("has_largest"))
        # Queries go to chunks of their own band and the one below; to the one above only for
        # members of the largest component, as all others are queries themselves. Their own
        # chunk has been searched.
        near = chunks.select("block", F.col("chunk").alias("to"), "band", "has_largest", F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("i"))
        near = near.filter(F.lit(hubs) | (F.col("i") >= 0) | F.col("has_largest")).select("block", "to", (F.col("band") + F.col("i")).alias("band"))
        chosen = rows.join(small(largest, "largest"), "block").filter("root = largest and id = root" if hubs else "root != largest")
        asks = chosen.join(small(near, "near"), ["block", "band"])
        asks = asks.filter("to != chunk").drop("chunk").withColumnRenamed("to", "chunk")
        found = written(_probe_chunks(rows, asks, k, percent), "links")
        links = found if links is None else links.union(found)
        if hubs:
            moved = components(found).select(F.col("node").alias("root"), F.col("root").alias("to"))
            rows = written(rows.join(small(moved, "moved"), "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to"), "large")
    return links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, hot_docs: int = 2, chunk_shingles: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable by links, itself included).

    Null and empty texts and texts without words have no shingles and link with nothing.
    Equal texts link. A repeated row (same id and text) gives equal rows. Rows without an
    id are left out, since a component is named by ids. Extra columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    sets = written(_sets(texts, k, percent), "sets")
    classes = sets.filter("n > 0").groupBy("print").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
    classes = written(classes, "classes")
    reps = if_small(written(classes.select(F.col("rep").alias("id"), "n").distinct(), "reps"))

    # Bitmaps stand for joins on ids here: a document more in counts or blocks than there are
    # classes changes the order or the work, and neither heads nor texts are shuffled for it.
    chosen = _bitmap(reps.select(_id_cell().alias("cell")).distinct())
    counted = _marked(sets.filter("n > 0"), _id_cell(), chosen).select(F.explode("head").alias("h")).groupBy("h").count()
    levels = _levels(counted, hot_docs)
    heads = _heads(texts, k, percent, levels, chosen).select("id", "n", F.explode("head").alias("h"))
    heads = written(heads, "heads")
    shared = heads.groupBy("h").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last").select("h")
    shared = written(shared, "shared")
    several_have = _bitmap(shared.select(_h_cell().alias("cell")).distinct())
    near = _marked(heads, _h_cell(), several_have).join(shared, "h").withColumn("band", band(F.col("n"), percent))
    near = written(near.select("id", "h", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band")), "near")
    hubs = near.groupBy("h", "band").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last").drop("last")
    edges = near.join(hubs, ["h", "band"]).filter("id != hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    blocks = written(components(edges).join(reps, F.col("node") == F.col("id")).select("id", F.col("root").alias("block"), "n"), "blocks")
    # A block of more than chunk_shingles is dealt by band, and a band by hash: parts is the
    # number of chunks of a band, 0 in small blocks.
    blocks = blocks.withColumn("band", band(F.col("n"), percent))
    large = blocks.groupBy("block").agg(F.sum("n").alias("all")).filter(F.col("all") > chunk_shingles).select("block")
    parts = blocks.join(large, "block", "left_semi").groupBy("block", "band").agg(F.ceil(F.sum("n") / chunk_shingles).cast("long").alias("parts"))
    blocks = blocks.join(parts, ["block", "band"], "left").withColumn("parts", F.coalesce("parts", F.lit(0)))
    chunk = F.when(F.col("parts") > 0, F.col("band") * (1 << 24) + F.pmod(F.xxhash64("id"), F.col("parts")) + 1).otherwise(F.lit(0)).cast("long")
    blocks = written(blocks.withColumn("chunk", chunk), "blocks")

    wanted = _bitmap(blocks.select(_id_cell().alias("cell")).distinct())
    members = _marked(texts, _id_cell(), wanted).join(if_small(blocks), "id")
    several = blocks.filter("parts > 0").limit(1).count() > 0
    if several:
        members = written(members, "members")
    linked = written(_link_chunks(members, k, percent), "linked")
    links = linked.select(F.col("id").alias("a"), F.col("root").alias("b"))
    if several:
        links = links.union(_large_blocks(members, linked, k, percent))
    roots = components(links)
    named = classes.join(roots, F.col("rep") == F.col("node"), "left").select("print", F.coalesce("root", "rep").alias("component_id"))
    return (
        sets.select("id", "n", "print")
        .join(named, "print", "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    )
