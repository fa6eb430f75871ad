"""Vector code compression: product codes whose codebooks are fitted over cover trees
(operator 11).

Vectors become integers and are cut into equal parts; each part position has a codebook of
a few entries, fitted by a fixed number of Lloyd rounds.

1. Trees. Each task builds, for every `CHUNK` vectors at most and each part position, a
   cover tree: centers in farthest-first order, which for every radius are a net of the
   chunk's points (each point within the radius of a center, centers further apart than
   it). A level's radius is 1/SHRINK of that of the level above, and a center's parent is
   the nearest one of the levels above. Points lie in depth-first order, so that a subtree
   is a range, whose sum is the difference of two cumulative sums. Trees are written once.
2. Rounds. A node whose nearest entry is nearer than the second nearest by more than twice
   its radius gives its whole subtree to it (triangle inequality); other nodes pass the
   question to their children and, at the end, to their own bucket, whose points are
   compared exactly with those entries that its radius leaves. Only sums and counts, entries x components for a task, are shuffled,
   and only the totals, as many numbers as the codebooks have, come to the driver.
3. Codes. A last pass over the trees gives each vector its entries and exact errors.

Distances that decide a subtree are floating with a margin; whatever lies within the margin
is compared in whole numbers, so results don't depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a tree, vectors for each of its centers, ratio of the radii of two levels.
CHUNK, BUCKET, SHRINK = 4096, 16, 1.3
#: Components are held within +-HELD. Squares of larger ones than SAFE may pass 64 bits: such
#: chunks are compared in whole numbers of any size.
HELD, SAFE = 1 << 62, 1 << 26
#: Relative margin of floating distances.
MARGIN = 1e-9
LONG_MAX = (1 << 63) - 1

Books = list[list[list[int]]]


class Tree:
    """A cover tree over the points (n, width) of one part position, in depth-first order."""

    def __init__(self, points: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, parent: np.ndarray, radius: np.ndarray, bucket_radius: np.ndarray) -> None:
        self.points, self.order, self.starts, self.sizes = points, order, starts, sizes
        self.parent, self.radius, self.bucket_radius = parent, radius, bucket_radius

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        n, x = len(points), points.astype(np.float64)
        away = lambda c, rows=slice(None): np.sqrt(np.square(x[rows] - x[c]).sum(1))
        centers, parent, owner, near = [0], [0], np.zeros(n, np.int64), away(0)
        above, edge = owner.copy(), near.max() / SHRINK
        while len(centers) < n // BUCKET and near[far := int(near.argmax())] > 0:
            if near[far] <= edge:
                above = owner.copy()
                edge = edge * SHRINK ** np.floor(np.log(near[far] / edge) / np.log(SHRINK))
            d = away(far)
            closer = d < near
            parent.append(int(above[far]))
            owner[closer], near[closer] = len(centers), d[closer]
            centers.append(far)
        m = len(centers)
        sizes, at, free = np.ones(m, np.int64), np.zeros(m, np.int64), np.ones(m, np.int64)
        for k in range(m - 1, 0, -1):
            sizes[parent[k]] += sizes[k]
        for k in range(1, m):
            at[k] = free[parent[k]]
            free[parent[k]] += sizes[k]
            free[k] = at[k] + 1
        by = np.argsort(at)  # nodes in depth-first order
        order = np.lexsort((near, at[owner]))
        starts = np.searchsorted(at[owner][order], np.arange(m + 1))
        x, near, sizes = x[order], near[order], sizes[by]
        radius = np.array([away(starts[k], slice(starts[k], starts[k + sizes[k]])).max() for k in range(m)])
        return cls(points[order], order, starts, sizes, at[np.array(parent)[by]], radius, np.maximum.reduceat(near, starts[:-1]))

    def settle(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, entry) of the ranges that are settled whole, the places of the points that
        must be compared, and for each of these the entries that may be its nearest."""
        if self.points.dtype == object or len(book) < 2 or not self.points.shape[1]:
            whole = np.array([[0, len(self.points), 0]] if len(book) < 2 or not self.points.shape[1] else np.empty((0, 3)), np.int64)
            places = np.arange(0 if len(whole) else len(self.points))
            return *whole.T, places, np.ones((len(places), len(book)), bool)
        entries, found, open_ranges, left = book.astype(np.float64), [], [], []
        nodes = np.zeros(1, np.int64)
        while len(nodes):
            lo, end = self.starts[nodes], self.starts[nodes + self.sizes[nodes]]
            c = self.points[lo].astype(np.float64)
            d = np.sqrt(np.square(c[:, None] - entries).sum(2))
            best = d.argmin(1)
            # an entry further off than the nearest by more than twice the radius is nobody's
            spare = d - d.min(1, keepdims=True) - MARGIN * (1 + d)
            whole = (spare > 2 * self.radius[nodes, None]).sum(1) == len(book) - 1
            near = spare <= 2 * self.bucket_radius[nodes, None]
            bucket = near.sum(1) == 1
            own = self.starts[nodes + 1]
            found.append(np.stack([lo[whole], end[whole], best[whole]], 1))
            found.append(np.stack([lo, own, best], 1)[bucket & ~whole])
            open_ranges.append(np.stack([lo, own], 1)[~bucket & ~whole])
            left.append(near[~bucket & ~whole])
            asked = np.zeros(len(self.sizes), bool)
            asked[nodes[~whole]] = True
            asked[0], root = False, asked[0]
            below = asked[self.parent] | (root & (self.parent == 0))
            below[0] = False
            nodes = np.flatnonzero(below)
        lo, end = np.concatenate(open_ranges).T
        places = np.repeat(lo - np.concatenate([[0], np.cumsum(end - lo)[:-1]]), end - lo) + np.arange((end - lo).sum())
        return *np.concatenate(found).T, places, np.repeat(np.concatenate(left), end - lo, axis=0)

    def codes(self, book: np.ndarray) -> np.ndarray:
        """The entry of every point, in depth-first order."""
        lo, end, entry, places, near = self.settle(book)
        out = np.zeros(len(self.points), np.int64)
        for a, b, e in zip(lo, end, entry, strict=True):
            out[a:b] = e
        out[places] = nearest(self.points[places], book, near)
        return out

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and count of the points of each entry."""
        lo, end, entry, places, near = self.settle(book)
        past = np.concatenate([np.zeros((1, self.points.shape[1]), self.points.dtype), np.cumsum(self.points, axis=0)])
        sums, counts = np.zeros(book.shape, self.points.dtype), np.zeros(len(book), np.int64)
        np.add.at(sums, entry, past[end] - past[lo])
        np.add.at(counts, entry, end - lo)
        rest = self.points[places]
        codes = nearest(rest, book, near)
        for e in np.unique(codes):
            mine = codes == e
            sums[e] += rest[mine].sum(0)
            counts[e] += mine.sum()
        return sums, counts


def squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    return np.square(points - entry).sum(1)


def nearest(points: np.ndarray, book: np.ndarray, near: np.ndarray | None = None) -> np.ndarray:
    """The nearest entry of each point, the least index of equals; exact. near tells which
    entries are asked for each point."""
    out = np.zeros(len(points), np.int64)
    if not len(points) or not points.shape[1]:
        return out
    # where most entries are left, asking all of them is quicker and gives the same
    if near is None or points.dtype == object or near.mean() > 0.5:
        return np.stack([squares(points, e) for e in book], 1).argmin(1).astype(np.int64)
    least = np.full(len(points), np.iinfo(np.int64).max)
    for e, entry in enumerate(book):
        at = np.flatnonzero(near[:, e])
        d = squares(points[at], entry)
        closer = d < least[at]
        out[at[closer]], least[at[closer]] = e, d[closer]
    return out


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of lists of numbers, each padded with zeros to `width`."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = np.clip(np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * float(SCALE)), -float(HELD), float(HELD))
    out = np.zeros((len(lengths), width), np.int64)
    begins = np.cumsum(lengths) - lengths
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(begins, lengths)] = values.astype(np.int64)
    return out


FIELDS = ("points", "order", "starts", "sizes", "parent", "radius", "bucket_radius")


def _packed(name: str, value: np.ndarray) -> bytes:
    kind = np.float64 if "radius" in name else np.int32 if name != "points" or not value.size or np.abs(value).max() < 1 << 31 else np.int64
    return value.astype(kind).tobytes()


def _unpacked(row: dict, part: int, width: int, safe: bool) -> Tree:
    """safe: the codebook's components, too, are small."""
    got = {f: np.frombuffer(row[f][part], np.float64 if "radius" in f else np.int32).astype(np.float64 if "radius" in f else np.int64) for f in FIELDS[1:]}
    n = len(got["order"])
    points = np.frombuffer(row["points"][part], np.int32 if len(row["points"][part]) == 4 * n * width else np.int64).astype(np.int64).reshape(n, width)
    if not safe or points.size and np.abs(points).max() > SAFE:
        points = points.astype(object)
    return Tree(points, **got)


def trees(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """vectors (vec_id, vec array<double>, label) -> one written row a chunk: vec_ids, labels
    and, for each part position, its tree."""
    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_ids array<{kind['vec_id']}>, labels array<{kind['label']}>, " + ", ".join(f"{f} array<binary>" for f in FIELDS)

    def lists(column: pa.Array, n: int) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = -(-batch.num_rows // CHUNK)
            for i in range(pieces):
                lo, hi = batch.num_rows * i // pieces, batch.num_rows * (i + 1) // pieces
                piece = batch.slice(lo, hi - lo)
                # a slice's lists start beyond 0; taking its rows moves them there
                points = whole_numbers(piece.column("vec").take(pa.array(range(hi - lo))), width * parts)
                built = [Tree.build(points[:, p * width : (p + 1) * width]) for p in range(parts)]
                columns = {"vec_ids": lists(piece.column("vec_id"), hi - lo), "labels": lists(piece.column("label"), hi - lo)}
                columns |= {f: pa.array([[_packed(f, getattr(t, f)) for t in built]], pa.list_(pa.binary())) for f in FIELDS}
                yield pa.RecordBatch.from_pydict(columns)

    return written(vectors.mapInArrow(run, schema), "trees")


def _arrays(books: Books, width: int) -> tuple[list[np.ndarray], bool]:
    safe = all(abs(x) <= SAFE for book in books for entry in book for x in entry)
    return [np.array(book, np.int64 if safe else object).reshape(len(book), width) for book in books], safe


def lloyd(forest: DataFrame, books: Books, width: int) -> Books:
    """The codebooks after one round over the trees."""
    held, safe = _arrays(books, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(book.shape, object) for book in held]
        counts = [np.zeros(len(book), np.int64) for book in held]
        for batch in batches:
            for row in batch.to_pylist():
                for p, book in enumerate(held):
                    tree = _unpacked(row, p, width, safe)
                    got, n = tree.totals(book.astype(tree.points.dtype))
                    sums[p] += got.astype(object)
                    counts[p] += n
        found = [(p, e, int(counts[p][e]), [Decimal(int(x)) for x in sums[p][e]]) for p, book in enumerate(held) for e in range(len(book)) if counts[p][e]]
        if found:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["part", "entry", "n", "sums"])

    told = forest.select(*FIELDS).mapInArrow(run, "part int, entry int, n long, sums array<decimal(38,0)>")
    sums = [F.sum(F.try_element_at("sums", F.lit(i + 1))).alias(f"s{i}") for i in range(width)]
    out = [[list(entry) for entry in book] for book in books]
    for r in told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        out[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def encoded(forest: DataFrame, books: Books, width: int) -> DataFrame:
    """vec_id, label, code (entries in part order), error (sum of squared distances)."""
    held, safe = _arrays(books, width)
    kind = {f.name: f.dataType.elementType for f in forest.schema if f.name in ("vec_ids", "labels")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(FIELDS).to_pylist()):
                codes, error = [], 0
                for p, book in enumerate(held):
                    tree = _unpacked(row, p, width, safe)
                    book = book.astype(tree.points.dtype)
                    mine = tree.codes(book)
                    back = np.argsort(tree.order)
                    codes.append(mine[back])
                    error = error + squares(tree.points, book[mine])[back].astype(object)
                codes = np.stack(codes, 1).astype(np.uint8)
                columns = [batch.column("vec_ids").slice(i, 1).flatten(), batch.column("labels").slice(i, 1).flatten(), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return forest.mapInArrow(run, f"vec_id {kind['vec_ids'].simpleString()}, label {kind['labels'].simpleString()}, code string, error long")


def codebooks_sha256(books: Books) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error; one row a kept vector), and the codebooks by part, entry
    and component. At most 256 entries.

    Rows whose vector is null or holds null or non-finite components are dropped; no other
    is. Equal rows are kept as often as they occur. The codebooks start as the parts of the
    vectors of least id; null ids come last and equal ids in order of their vectors. With
    fewer vectors than entries there are as many entries as vectors. Vectors of uneven
    length, or of a length that parts don't divide, are padded with zeros at the end; an
    empty vector is all zeros. Components are held within +-2**62 and errors within a long.
    An empty table gives no rows and empty codebooks. Other columns are ignored."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    rows = rows.filter(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    width = -(-(rows.agg(F.max(F.size("vec"))).first()[0] or 0) // parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    cut = whole_numbers(pa.array([r["vec"] for r in first], pa.list_(pa.float64())), width * parts).tolist()
    books = [[v[p * width : (p + 1) * width] for v in cut] for p in range(parts)]
    if not first:
        kind = {f.name: f.dataType.simpleString() for f in rows.schema}
        return spark.createDataFrame([], f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"), books
    forest = trees(rows, width, parts)
    for _ in range(rounds):
        books = lloyd(forest, books, width)
    return encoded(forest, books, width), books


def query(vectors: DataFrame) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256. Errors are summed over equal
    labels, nulls together; labels held by many rows are combined before the shuffle."""
    codes, books = compress(vectors)
    codes = written(codes.withColumn("key", F.coalesce(F.col("label").cast("string"), F.lit("\0null"))), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    groups = written(codes.groupBy("key").agg(total.alias("label_error"), F.count("*").alias("rows")), "labels")
    out = spread_join(codes, groups, "key", "rows")
    return out.select("vec_id", "label", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
