"""Nearest neighbours of point sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

#: Points in one block that meets the pivots of its key.
BLOCK = 512
#: Pivots of one key: about the root of its points in b, and about so many at most.
PIVOTS = 256
#: Numbers in one chunk of b's points, which a task holds, and in one group of a's points that
#: meets it: a point is sent once a chunk, and a chunk once a group.
VALUES = 1 << 21
#: Points compared at a time.
ROWS, TILE = 4096, 512


def _blocks(df: DataFrame, by: list[str], spread: Column, value: Column, name: str) -> DataFrame:
    """by, _block, name: values in lists of about BLOCK, dealt by a hash of spread."""
    rows = df.select(*by, value.alias("_v"), F.pmod(spread, F.lit(1 << 20)).alias("_h"))
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).alias("_n"))
    return rows.join(sizes, by).groupBy(*by, F.pmod("_h", "_n").alias("_block")).agg(F.collect_list("_v").alias(name))


def _matrix(lists: pa.Array) -> np.ndarray:
    """A row a list; all lists are of one length."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1)


def _squares(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows of p and q by one product of matrices, and by how much
    those of a row of p may be off."""
    pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
    off = 4e-16 * (p.shape[1] + 8) * (pp + qq.max(initial=0.0))
    return pp[:, None] + qq[None] - 2 * (p @ q.T), off


def _rounded(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances, and by how much those of a row may be off."""
    squares, off = _squares(p, q)
    return np.sqrt(np.maximum(squares, 0)), np.sqrt(off)


class Chunk:
    """Points in tiles of one cell each, with the centre and radius of each tile."""

    def __init__(self, cells: np.ndarray, points: np.ndarray) -> None:
        order = np.argsort(cells, kind="stable")
        cells, points = cells[order], points[order]
        starts = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1))
        bounds = [a for s, e in zip(starts, [*starts[1:], len(cells)], strict=True) for a in range(s, e, TILE)]
        self.tiles = [points[a:b] for a, b in zip(bounds, [*bounds[1:], len(cells)], strict=True)]
        self.centres = np.stack([t.mean(axis=0) for t in self.tiles])
        self.radii = np.array([np.sqrt(((t - c) ** 2).sum(axis=1).max()) for t, c in zip(self.tiles, self.centres, strict=True)])

    def nearest(self, points: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """For each point the distance to the nearest of the chunk if below its bound, else the
        bound. Products of matrices name the candidates; differences measure them."""
        best = bound.copy()
        far, off = _rounded(points, self.centres)
        least = far - self.radii - off[:, None] - 1e-9 * (1 + self.radii)
        for t in np.argsort(least.sum(axis=0)):
            rows = np.flatnonzero(~(least[:, t] > best))
            if len(rows):
                tile = self.tiles[t]
                squares, off = _squares(points[rows], tile)
                most = np.minimum(squares.min(axis=1), best[rows] ** 2 + off) + 2 * off
                i, j = np.nonzero(squares <= most[:, None])
                np.minimum.at(best, rows[i], np.sqrt(((tile[j] - points[rows[i]]) ** 2).sum(axis=1)))
        return best


def nearest(a: DataFrame, b: DataFrame, key: str, point: str, id_col: str) -> DataFrame:
    """key, id, distance: for each point of a the distance to the nearest point of b with the
    same key, exactly. b's points go to cells around pivots, each with its least and greatest
    distance to the pivot; cells in turn fill chunks. A point of a goes to the chunks with a
    cell which, by the triangle inequality, may hold a nearer point than the nearest pivot,
    and meets there only tiles that may. a's points are dealt in groups, so that a task holds
    one chunk, and one group streams past it. Where no bound prunes (points all about as far
    from each other), all pairs of a key are still compared, but a point is sent only once a
    chunk. Points with a null are left out, and points of b that aren't finite, as they are not
    nearer than any other."""
    value = "array<float>" if dict(a.dtypes)[point] == dict(b.dtypes)[point] == "array<float>" else "array<double>"
    kind, id_kind = dict(a.dtypes)[key], dict(a.dtypes)[id_col]
    whole = F.col("_q").isNotNull() & ~F.exists("_q", lambda x: x.isNull())
    finite = F.forall("_q", lambda x: F.abs(x) < float("inf"))
    qs = b.select(key, F.col(point).cast(value).alias("_q")).filter(whole & finite).distinct()  # repeats are no nearer
    ps = a.select(key, F.col(id_col).alias("_id"), F.col(point).cast(value).alias("_q")).filter(whole)
    hashed = F.pmod(F.xxhash64(F.lit(7), "_q"), F.lit(1 << 30))
    room = F.greatest(F.lit(1), F.floor(F.lit(VALUES) / F.greatest(F.lit(1), F.max(F.size("_q"))))).alias("_room")
    sizes = qs.groupBy(key).agg(F.count("*").alias("_n"), room, F.min_by("_q", F.xxhash64("_q")).alias("_first"))
    share = F.least(F.sqrt("_n"), F.lit(float(PIVOTS))) / F.col("_n") * F.lit(float(1 << 30))
    some = qs.join(sizes, key).filter((hashed < share) | (F.col("_q") == F.col("_first")))
    pivots = some.groupBy(key, "_room").agg(F.sort_array(F.collect_set("_q")).alias("_pivots"))
    pivots = written(pivots, "nearest")

    def batch(cols: list, schema: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in schema.split(", ")])

    celled_schema = f"{key} {kind}, _cell int, _r double, _q {value}"

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(x.num_rows):
                block, v = x.column("_points")[i].values, _matrix(x.column("_pivots")[i].values)
                q = _matrix(block)
                cell = _squares(q, v)[0].argmin(axis=1)
                r = np.sqrt(((q - v[cell]) ** 2).sum(axis=1))
                yield batch([x.column(key).take(pa.array([i] * len(q))), pa.array(cell.astype(np.int32)), pa.array(r), block], celled_schema)

    dealt = _blocks(qs, [key], F.xxhash64("_q"), F.col("_q"), "_points").join(pivots, key).select(key, "_points", "_pivots")
    celled = written(dealt.mapInArrow(to_cells, celled_schema), "nearest")
    in_turn = Window.partitionBy(key).orderBy("_cell")  # a row a cell
    rings = celled.groupBy(key, "_cell").agg(F.count("*").alias("_n"), F.min("_r").alias("lo"), F.max("_r").alias("hi")).join(pivots.select(key, "_room"), key)
    rings = rings.withColumn("_from", F.sum("_n").over(in_turn) - F.col("_n"))
    chunk = lambda at: F.floor(at / F.col("_room")).cast("int")
    rings = written(rings.withColumns({"first": chunk(F.col("_from")), "last": chunk(F.col("_from") + F.col("_n") - 1)}), "nearest")
    fields = ("_cell", "lo", "hi", "first", "last")
    maps = rings.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_rings")).join(pivots, key)
    groups = ps.groupBy(key).count().join(pivots.select(key, "_room"), key).select(key, F.ceil(F.col("count") / F.col("_room")).cast("int").alias("_groups"))
    groups = written(groups, "nearest")
    maps = written(maps.join(groups, key).select(key, "_pivots", "_groups", *[F.col(f"_rings.{f}").alias(f) for f in fields]), "nearest")

    met_schema = f"{key} {kind}, _group int, _chunk int, _cell int, _id {id_kind}, _bound double, _q {value}"

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The chunks with a cell that may be nearer than the nearest pivot."""
        for x in batches:
            for i in range(x.num_rows):
                block, group = x.column("_points")[i].values, x.column("_block")[i].as_py() % x.column("_groups")[i].as_py()
                p, v = _matrix(block.field("p")), _matrix(x.column("_pivots")[i].values)
                cells, lo, hi, first, last = (x.column(f)[i].values.to_numpy(zero_copy_only=False) for f in fields)
                d, off = _rounded(p, v)
                home = d.argmin(axis=1)
                bound = np.sqrt(((p - v[home]) ** 2).sum(axis=1))
                least = np.maximum(np.maximum(d[:, cells] - hi, lo - d[:, cells]), (d[:, cells] - bound[:, None]) / 2)
                near = ~(least > (bound + off)[:, None] + 1e-9 * (1 + d[:, cells] + hi))  # rounding never hides a cell
                at = []
                for c in range(last.max() + 1):
                    rows = np.flatnonzero(near[:, (first <= c) & (c <= last)].any(axis=1))
                    at.append((np.full(len(rows), c, np.int32), rows))
                to, rows = (np.concatenate(z) for z in zip(*at, strict=True))
                n, take = len(rows), pa.array(rows)
                yield batch([x.column(key).take(pa.array([i] * n)), pa.array(np.full(n, group, np.int32)), pa.array(to), pa.array(np.full(n, -1, np.int32)), block.field("id").take(take), pa.array(bound[rows]), block.field("p").take(take)], met_schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of key, group and chunk, b's points of each before a's."""
        name, held, chunk = None, [], None
        for x in batches:
            keys, parts, chunks = (x.column(c).to_pylist() for c in (key, "_group", "_chunk"))
            cells, bounds, points = x.column("_cell").to_numpy(), x.column("_bound").to_numpy(zero_copy_only=False), _matrix(x.column("_q"))
            names = list(zip(keys, parts, chunks, strict=True))
            edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s == e:
                    continue
                if names[s] != name:
                    name, held, chunk = names[s], [], None
                mid = s + int((cells[s:e] >= 0).sum())
                if mid > s:
                    held.append((cells[s:mid].copy(), points[s:mid].copy()))
                for i in range(mid, e, ROWS):
                    j = min(i + ROWS, e)
                    if held:
                        chunk, held = Chunk(*map(np.concatenate, zip(*held, strict=True))), []
                    found = chunk.nearest(points[i:j], bounds[i:j]) if chunk else bounds[i:j]  # a chunk may be empty
                    yield pa.RecordBatch.from_arrays([x.column(key).slice(i, j - i), x.column("_id").slice(i, j - i), pa.array(found)], [key, "_id", "_bound"])

    pair = F.struct(F.col("_id").alias("id"), F.col("_q").alias("p"))
    sent = _blocks(ps, [key], F.xxhash64("_id", "_q"), pair, "_points").join(maps, key)
    sent = sent.select(key, F.col("_block").cast("long").alias("_block"), "_points", "_pivots", "_groups", *fields).mapInArrow(visits, met_schema)
    held = celled.join(rings.select(key, "_cell", "_n", "_from", "_room"), [key, "_cell"]).join(groups, key)
    held = held.withColumn("_chunk", chunk(F.col("_from") + F.pmod(F.xxhash64("_q"), "_n"))).withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
    held = held.select(key, "_group", "_chunk", "_cell", F.lit(None).cast(id_kind).alias("_id"), F.lit(None).cast("double").alias("_bound"), "_q")
    order = [key, "_group", "_chunk"]
    rows = held.union(sent).repartition(*order).sortWithinPartitions(*order, F.col("_cell") < 0)
    got = written(rows.mapInArrow(compare, f"{key} {kind}, _id {id_kind}, _bound double"), "nearest")
    return got.groupBy(key, F.col("_id").alias(id_col)).agg(F.min("_bound").alias("distance"))


def one_sided(a: DataFrame, b: DataFrame, key: str, point: str, id_col: str) -> DataFrame:
    """Mean and greatest nearest distance."""
    return nearest(a, b, key, point, id_col).groupBy(key).agg(F.avg("distance").alias("mean"), F.max("distance").alias("worst"))


def chamfer(a: DataFrame, b: DataFrame, key: str, point: str, id_col: str) -> DataFrame:
    """Sum of both means, the greater of both maxima."""
    x = one_sided(a, b, key, point, id_col)
    y = one_sided(b, a, key, point, id_col).withColumnsRenamed({"mean": "_m", "worst": "_w"})
    return x.join(y, key).select(key, (F.col("mean") + F.col("_m")).alias("chamfer"), F.greatest("worst", "_w").alias("hausdorff"))
