"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes of some edges but the roots."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _thinned(edges: DataFrame, held: int = 500_000) -> DataFrame:
    """edges (u, v) with the same components, at most one for each node of some edges in
    turn of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for batch in batches:
            some.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
            if n >= held:
                u, v = _forest(*map(np.concatenate, zip(*some, strict=True)))
                if len(u) > held // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                    some, n = [], 0
                else:
                    some, n = [(u, v)], len(u)
        if some:
            u, v = _forest(*map(np.concatenate, zip(*some, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """edges -> node, root: the least node reachable, for nodes with an edge to another one.
    Large-star and small-star steps in turn, each over minima that are combined before the
    shuffle; the number of rounds grows with the logarithm of the longest path. No
    neighbourhood is ever gathered, so a node may have any number of edges. Tasks first
    reduce the edges they hold to a forest."""
    at = written(_thinned(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")).distinct(), "edges")
    state = _state(at)
    while True:
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(at)
        if now == state:
            return at.select(F.col("u").alias("node"), F.col("v").alias("root")).union(at.select(F.col("v"), F.col("v")).distinct())
        state = now
