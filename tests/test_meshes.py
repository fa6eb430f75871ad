"""M07 on bodies whose figures are known, as files."""

import json
import math
import struct

import numpy as np
import pytest

from tesserine.operators import meshes
from tesserine.sources.meshes import read_glb

CUBE = [(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]
CUBE_FACES = [(0, 1, 3), (0, 3, 2), (4, 6, 7), (4, 7, 5), (0, 4, 5), (0, 5, 1), (2, 3, 7), (2, 7, 6), (0, 2, 6), (0, 6, 4), (1, 5, 7), (1, 7, 3)]
TETRA, TETRA_FACES = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1)], [(0, 2, 1), (0, 1, 3), (0, 3, 2), (1, 2, 3)]


def glb(parts, nodes=None, mode=None, kind=np.uint16, stride=0):
    binary, views, accessors, prims = b"", [], [], []

    def put(array, type_, component, width=0):
        nonlocal binary
        raw = b"".join(bytes(row.tobytes()).ljust(width, b"\0") for row in array) if width else array.tobytes()
        views.append({"buffer": 0, "byteOffset": len(binary), "byteLength": len(raw), **({"byteStride": width} if width else {})})
        binary += raw + b"\0" * (-len(raw) % 4)
        accessors.append({"bufferView": len(views) - 1, "componentType": component, "count": len(array), "type": type_})
        return len(accessors) - 1

    code = {np.uint8: 5121, np.uint16: 5123, np.uint32: 5125}[kind]
    for points, faces in parts:
        p = {"attributes": {"POSITION": put(np.array(points, "<f4"), "VEC3", 5126, stride)}}
        if faces is not None:
            p["indices"] = put(np.array(faces, kind).ravel(), "SCALAR", code)
        if mode is not None:
            p["mode"] = mode
        prims.append(p)
    doc = {"asset": {"version": "2.0"}, "meshes": [{"primitives": prims}], "accessors": accessors, "bufferViews": views, "buffers": [{"byteLength": len(binary)}]}
    doc |= {"nodes": nodes, "scenes": [{"nodes": [0]}], "scene": 0} if nodes else {}
    text = json.dumps(doc).encode()
    text += b" " * (-len(text) % 4)
    body = struct.pack("<II", len(text), 0x4E4F534A) + text + struct.pack("<II", len(binary), 0x004E4942) + binary
    return struct.pack("<III", 0x46546C67, 2, 12 + len(body)) + body


@pytest.fixture(scope="module")
def stats(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("glb")
    half = math.sqrt(0.5)
    files = {
        "cube": glb([(CUBE, CUBE_FACES)]),
        "tetra8": glb([(TETRA, TETRA_FACES)], kind=np.uint8, stride=16),
        "two": glb([(CUBE, CUBE_FACES), (TETRA, TETRA_FACES)], kind=np.uint32),
        "open": glb([(CUBE, CUBE_FACES[:-1])]),
        "soup": glb([([CUBE[i] for f in CUBE_FACES for i in f], None)]),
        "strip": glb([([(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 1, 0)], None)], mode=5),
        "fan": glb([([(0, 0, 0), (1, 0, 0), (1, 1, 0), (0, 1, 0)], [0, 1, 2, 3])], mode=6),
        "lines": glb([(CUBE, None)], mode=1),
        "moved": glb([(CUBE, CUBE_FACES)], nodes=[{"translation": [5, 0, 0], "children": [1, 2]}, {"mesh": 0, "scale": [2, 3, 4], "rotation": [0, 0, half, half]}, {"mesh": 0, "matrix": [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 9, 1]}]),
        "cut": glb([(CUBE, CUBE_FACES)])[:200],
        "text": b"this is not a mesh at all, but long enough",
        "far": glb([(TETRA, [(0, 1, 9)])]),
    }
    for name, data in files.items():
        (at / f"{name}.glb").write_bytes(data)
    return {r["path"].rsplit("/", 1)[1][:-4]: r for r in meshes.mesh_stats(read_glb(spark, f"{at}/*.glb").repartition(3)).collect()}


def test_bodies(stats):
    cube = stats["cube"]
    assert (cube["mesh_vertices"], cube["mesh_faces"], cube["mesh_components"], cube["mesh_is_watertight"]) == (8, 12, 1, True)
    assert cube["mesh_surface_area"] == pytest.approx(6) and abs(cube["mesh_volume"]) == pytest.approx(1) and cube["mesh_bbox_diag"] == pytest.approx(math.sqrt(3))
    tetra = stats["tetra8"]
    assert tetra["mesh_volume"] == pytest.approx(1 / 6) and tetra["mesh_surface_area"] == pytest.approx(1.5 + math.sqrt(3) / 2) and tetra["mesh_is_watertight"]
    two = stats["two"]
    assert (two["mesh_vertices"], two["mesh_faces"], two["mesh_components"]) == (12, 16, 2) and two["mesh_surface_area"] == pytest.approx(7.5 + math.sqrt(3) / 2)
    assert stats["open"]["mesh_is_watertight"] is False and stats["open"]["mesh_volume"] is None and stats["open"]["mesh_components"] == 1
    # vertices that lie in one place stay apart
    assert (stats["soup"]["mesh_vertices"], stats["soup"]["mesh_components"], stats["soup"]["mesh_is_watertight"]) == (36, 12, False)


def test_modes_and_places(stats):
    for name in ("strip", "fan"):
        assert (stats[name]["mesh_faces"], stats[name]["mesh_components"]) == (2, 1) and stats[name]["mesh_surface_area"] == pytest.approx(1)
    assert (stats["lines"]["mesh_faces"], stats["lines"]["error"]) == (0, None)
    moved = stats["moved"]
    assert (moved["mesh_faces"], moved["mesh_components"], moved["mesh_is_watertight"]) == (24, 2, True)
    assert abs(moved["mesh_volume"]) == pytest.approx(25) and moved["mesh_surface_area"] == pytest.approx(52 + 6)
    assert [moved[f"mesh_bbox_d{x}"] for x in "xyz"] == pytest.approx([4, 2, 10])


def test_files_that_cannot_be_read(stats):
    assert all(stats[name]["error"] and stats[name]["mesh_faces"] == 0 and stats[name]["mesh_surface_area"] is None for name in ("cut", "text", "far"))


def test_long_strip_is_one_component(spark):
    n = 5000
    rows = [("m", None, n, i, i, i + 1, i + 2, [float(i), 0.0, 0.0], [i + 1.0, 0.0, 0.0], [0.0, i + 2.0, 0.0]) for i in range(n - 2)]
    from tesserine.sources.meshes import FACES

    assert meshes.mesh_stats(spark.createDataFrame(rows, FACES)).first()["mesh_components"] == 1
