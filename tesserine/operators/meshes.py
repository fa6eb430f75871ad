"""Figures of meshes that are rows of triangles (sources.meshes.read_glb)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _minus(p: Column, q: Column) -> list[Column]:
    return [p[i] - q[i] for i in range(3)]


def _cross(u: Sequence[Column], v: Sequence[Column]) -> list[Column]:
    return [u[(i + 1) % 3] * v[(i + 2) % 3] - u[(i + 2) % 3] * v[(i + 1) % 3] for i in range(3)]


def face_area(a: Column, b: Column, c: Column) -> Column:
    n = _cross(_minus(b, a), _minus(c, a))
    return F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]) / 2


def signed_volume(a: Column, b: Column, c: Column) -> Column:
    """Of the body between a triangle and the origin."""
    n = _cross([b[i] for i in range(3)], [c[i] for i in range(3)])
    return (a[0] * n[0] + a[1] * n[1] + a[2] * n[2]) / 6


def face_edges(faces: DataFrame, key: str) -> DataFrame:
    """key, face, u, v (u < v unless a face names a vertex twice): three rows a face."""
    pairs = [F.struct(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")) for x, y in (("a", "b"), ("b", "c"), ("c", "a"))]
    return faces.select(key, "face", F.inline(F.array(*pairs)))


def components(faces: DataFrame, key: str) -> DataFrame:
    """key, components: groups of a mesh's faces that hang together by whole edges. A mesh came
    from one file that one task has read; a task takes the edges of one mesh."""
    links = face_edges(faces, key).select(F.col(key).alias("mesh"), "face", "u", "v")

    def run(table: pa.Table) -> pa.Table:
        face = np.unique(table.column("face").to_numpy(), return_inverse=True)[1]
        edge = np.unique(np.stack([table.column("u").to_numpy(), table.column("v").to_numpy()], 1), axis=0, return_inverse=True)[1].ravel()
        label = np.arange(face.max() + 1)
        while True:
            least = np.full(edge.max() + 1, len(label))
            np.minimum.at(least, edge, label[face])
            new = label.copy()
            np.minimum.at(new, face, least[edge])
            # roots take on what their faces have found, so that labels jump
            np.minimum.at(new, label, new)
            new = new[new]
            if (new == label).all():
                break
            label = new
        return pa.table({"mesh": table.column("mesh").slice(0, 1), "components": pa.array([len(np.unique(label))], pa.int64())})

    kind = links.schema["mesh"].dataType.simpleString()
    return links.groupBy("mesh").applyInArrow(run, f"mesh {kind}, components long").withColumnRenamed("mesh", key)


def mesh_stats(rows: DataFrame, key: str = "path") -> DataFrame:
    """key, mesh_vertices, mesh_faces, mesh_bbox_dx, _dy, _dz, _diag, mesh_surface_area,
    mesh_is_watertight (every edge belongs to two faces), mesh_volume (signed; null unless
    watertight), mesh_components. Corners that no face uses count as vertices, but not in the
    box. A mesh without faces has counts only."""
    faces = rows.filter("face is not null")
    a, b, c = (F.col(x) for x in ("pa", "pb", "pc"))
    of = lambda pick, i: pick(a[i], b[i], c[i])
    box = [f(of(pick, i)).alias(f"_{n}{i}") for i in range(3) for f, pick, n in ((F.min, F.least, "lo"), (F.max, F.greatest, "hi"))]
    whole = faces.groupBy(key).agg(*box, F.count("*").alias("mesh_faces"), F.sum(face_area(a, b, c)).alias("mesh_surface_area"), F.sum(signed_volume(a, b, c)).alias("_volume"))
    shared = face_edges(faces, key).groupBy(key, "u", "v").agg(F.count("*").alias("n"))
    tight = shared.groupBy(key).agg((F.max(F.when(F.col("n") != 2, 1)).isNull()).alias("mesh_is_watertight"))
    out = rows.groupBy(key).agg(F.max("n_vertices").alias("mesh_vertices"), F.max("error").alias("error"))
    for part in (whole, tight, components(faces, key)):
        out = out.join(part, key, "left")
    d = [F.col(f"_hi{i}") - F.col(f"_lo{i}") for i in range(3)]
    return out.select(
        key,
        "error",
        "mesh_vertices",
        F.coalesce("mesh_faces", F.lit(0).cast("long")).alias("mesh_faces"),
        *[x.alias(f"mesh_bbox_d{n}") for x, n in zip(d, "xyz", strict=True)],
        F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]).alias("mesh_bbox_diag"),
        "mesh_surface_area",
        "mesh_is_watertight",
        F.when(F.col("mesh_is_watertight"), F.col("_volume")).alias("mesh_volume"),
        F.coalesce("components", F.lit(0).cast("long")).alias("mesh_components"),
    )
