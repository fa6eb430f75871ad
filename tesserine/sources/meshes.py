"""Binary glTF files as rows of triangles (M07). Spark reads the files, so they may lie in any
store; a task decodes one at a time."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fixed values of the format: its marks, the sizes of component types, the components of each
# kind of element, and the modes that are triangles.
MAGIC, JSON_CHUNK, BINARY_CHUNK = 0x46546C67, 0x4E4F534A, 0x004E4942
COMPONENTS = {5120: np.int8, 5121: np.uint8, 5122: np.int16, 5123: np.uint16, 5125: np.uint32, 5126: np.float32}
WIDTH = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4, "MAT4": 16}
LIST, STRIP, FAN = 4, 5, 6

FACES = "path string, error string, n_vertices long, face long, a long, b long, c long, pa array<double>, pb array<double>, pc array<double>"


def chunks(data: bytes) -> tuple[dict, bytes]:
    """The JSON and the binary chunk of a file."""
    if len(data) < 20:
        raise ValueError("the file ends within its header")
    magic, version, length = struct.unpack_from("<III", data)
    if magic != MAGIC or version != 2:
        raise ValueError("not binary glTF of version 2")
    if length > len(data):
        raise ValueError("the file is cut off")
    at, found = 12, {}
    while at + 8 <= length:
        size, kind = struct.unpack_from("<II", data, at)
        found.setdefault(kind, data[at + 8 : at + 8 + size])
        at += 8 + size
    if JSON_CHUNK not in found:
        raise ValueError("there is no JSON chunk")
    return json.loads(found[JSON_CHUNK]), found.get(BINARY_CHUNK, b"")


def accessor(doc: dict, binary: bytes, index: int) -> np.ndarray:
    """The elements of an accessor, one a row; without a view they are zeros."""
    a = doc["accessors"][index]
    if "sparse" in a:
        raise ValueError("sparse accessors aren't read")
    kind, width, n = np.dtype(COMPONENTS[a["componentType"]]).newbyteorder("<"), WIDTH[a["type"]], a["count"]
    if "bufferView" not in a:
        return np.zeros((n, width), kind)
    view = doc["bufferViews"][a["bufferView"]]
    if view.get("buffer", 0) or "uri" in doc["buffers"][0]:
        raise ValueError("buffers outside the file aren't read")
    start, step = view.get("byteOffset", 0) + a.get("byteOffset", 0), view.get("byteStride", kind.itemsize * width)
    if n and start + (n - 1) * step + kind.itemsize * width > len(binary):
        raise ValueError("an accessor passes the end of its buffer")
    return np.ndarray((n, width), kind, binary, start, (step, kind.itemsize)).copy()


def local_matrix(node: dict) -> np.ndarray:
    """The 4 x 4 matrix of a node, from its matrix or its translation, rotation and scale."""
    if "matrix" in node:
        return np.array(node["matrix"], float).reshape(4, 4).T
    x, y, z, w = node.get("rotation", (0, 0, 0, 1))
    turn = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    out = np.eye(4)
    out[:3, :3] = turn * np.array(node.get("scale", (1, 1, 1)))
    out[:3, 3] = node.get("translation", (0, 0, 0))
    return out


def placed_meshes(doc: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(mesh, matrix) of every node of the scene that holds one; all meshes as they are where
    there are no nodes."""
    nodes = doc.get("nodes", [])
    if not nodes:
        yield from ((i, np.eye(4)) for i in range(len(doc.get("meshes", []))))
        return
    below = {c for n in nodes for c in n.get("children", [])}
    scenes = doc.get("scenes")
    roots = scenes[doc.get("scene", 0)].get("nodes", []) if scenes else [i for i in range(len(nodes)) if i not in below]
    todo = [(i, np.eye(4), 0) for i in reversed(roots)]
    while todo:
        i, above, depth = todo.pop()
        if depth > len(nodes):
            raise ValueError("nodes form a circle")
        here = above @ local_matrix(nodes[i])
        if "mesh" in nodes[i]:
            yield nodes[i]["mesh"], here
        todo += [(c, here, depth + 1) for c in reversed(nodes[i].get("children", []))]


def triangles(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, faces) of all triangles of a file's scene, in its coordinates; vertices of
    several primitives are kept apart, and lines and points left out."""
    doc, binary = chunks(data)
    vertices, faces, n = [np.empty((0, 3))], [np.empty((0, 3), np.int64)], 0
    for mesh, matrix in placed_meshes(doc):
        for p in doc["meshes"][mesh]["primitives"]:
            mode = p.get("mode", LIST)
            if mode not in (LIST, STRIP, FAN) or "POSITION" not in p["attributes"]:
                continue
            points = accessor(doc, binary, p["attributes"]["POSITION"]).astype(float)
            at = accessor(doc, binary, p["indices"])[:, 0].astype(np.int64) if "indices" in p else np.arange(len(points))
            if len(at) and at.max() >= len(points):
                raise ValueError("an index passes the vertices")
            if mode == LIST:
                tri = at[: len(at) // 3 * 3].reshape(-1, 3)
            else:
                i = np.arange(max(0, len(at) - 2))
                tri = np.stack([at[i + i % 2], at[i + 1 - i % 2], at[i + 2]], 1) if mode == STRIP else np.stack([np.full(len(i), at[0] if len(at) else 0), at[i + 1], at[i + 2]], 1)
            vertices.append(points @ matrix[:3, :3].T + matrix[:3, 3])
            faces.append(tri + n)
            n += len(points)
    return np.concatenate(vertices), np.concatenate(faces)


def read_glb(spark: SparkSession, path: str) -> DataFrame:
    """path, error, n_vertices, face, a, b, c (numbers of its vertices), pa, pb, pc (where they
    are): a row a triangle. A file without triangles, or that can't be read, is one row without a
    face, with its error; files of no bytes have no row, as the reader leaves them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.float64())] * 3]
        names = [f.split()[0] for f in FACES.split(", ")]
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                try:
                    (vertices, faces), error = triangles(data.as_py()), None
                except (ValueError, KeyError, IndexError, TypeError, struct.error) as e:
                    vertices, faces, error = np.empty((0, 3)), np.empty((0, 3), np.int64), f"{type(e).__name__}: {e}"
                if not len(faces):
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([name, error, len(vertices), *[None] * 7], kinds, strict=True)], names)
                for lo in range(0, len(faces), 10_000):
                    some = faces[lo : lo + 10_000]
                    m = len(some)
                    at = [pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * m + 1, 3), pa.int32()), pa.array(vertices[some[:, i]].ravel())) for i in range(3)]
                    columns = [pa.array([name] * m), pa.nulls(m, pa.string()), pa.array([len(vertices)] * m), pa.array(np.arange(lo, lo + m)), *[pa.array(np.ascontiguousarray(some[:, i])) for i in range(3)], *at]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, FACES)
