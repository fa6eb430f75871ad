import pytest
import gzip
import hashlib
import json
import random
import zlib

from pyarrow import fs as pafs

from tesserine.llm import warc as W


def pages():
    r = random.Random(1)
    rows = [(i, f"http://x/{i}", "".join(r.choice("abcé😀\r\n ") for _ in range(r.choice([0, 5, 900, 1500, 4000])))) for i in range(60)]
    rows += [(100 + i, None, rows[3][2] if i % 2 else "é" * 600) for i in range(8)] + [(300, "http://a\r\nX: y", None), (301, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (None, "u", "é" * 600), (107, "u", "é" * 600), (302, "u", "x" * 3_000_000)]
    return rows


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, size int, kind string")
    got = W.round_trip(df, file_bytes=50_000).collect()
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, o in rows if (o or "") == (h or "") and j is not None]
        first = max(same, default=None)
        revisit = len(raw) >= 1000 and len(same) + (i is None) > 1 and i != first
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert W.round_trip(df.limit(0)).count() == 0
    # each member stands alone, and the sidecar index says where
    path = got[0]["path"]
    source, at = W._open(path)
    raw = source.open_input_file(at).read()
    places = [json.loads(x) for x in source.open_input_file(at + ".idx").read().splitlines()]
    assert sum(p["length"] for p in places) == len(raw)
    for p in places:
        box = zlib.decompressobj(31)
        assert box.decompress(raw[p["offset"] : p["offset"] + p["length"]]).startswith(b"WARC/1.1\r\n") and box.eof and not box.unused_data


def test_one_stream_becomes_many_members(spark, tmp_path):
    records = [W._record("response", str(i), "u", "d", 3, None, bytes([65 + i]) * i) for i in range(5)]
    mono = tmp_path / "m.warc.gz"
    mono.write_bytes(gzip.compress(b"".join(records)))
    assert list(W.records(W.inflated(pafs.LocalFileSystem().open_input_stream(str(mono), compression=None)))) == records
    df = spark.createDataFrame([(str(mono),)], "path string")
    row = W.normalise(df, f"file://{tmp_path}/out").collect()[0]
    data = open(row["path"].removeprefix("file://"), "rb").read()
    assert gzip.decompress(data) == b"".join(records)
    assert data.count(b"\x1f\x8b\x08") >= 5


def test_foreign_archives(spark, tmp_path):
    """An archive not written here: other kinds, no digest, a name of its own, LF in the text."""
    import gzip

    body = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n<p>a\r\n\r\nb</p>"
    rec = lambda kind, extra, block: b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:uuid:1-2>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n" + extra + b"Content-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    raw = rec(b"warcinfo", b"Content-Type: application/warc-fields\r\n", b"software: y\r\n") + rec(b"response", b"WARC-Target-URI: http://a/\r\ncontent-type: application/http; msgtype=response\r\n", body)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.warc.gz").write_bytes(gzip.compress(raw))
    made = W.normalise(spark.createDataFrame([(str(tmp_path / "in/x.warc.gz"),)], "path string"), str(tmp_path))
    rows = W.read(spark.createDataFrame(made.collect(), made.schema)).collect()
    assert [(r["record_type"], r["url"], r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in rows] == [("warcinfo", None, None, 13, None), ("response", "http://a/", None, 13, None)]
    assert rows[1]["stored_digest"] == hashlib.sha1(b"<p>a\r\n\r\nb</p>").hexdigest()


def test_cut_archives(tmp_path):
    import gzip
    import io

    whole = W._record("response", "1", "u", "d", 3, None, b"abc")
    assert [*W.records(W.inflated(io.BytesIO(gzip.compress(whole) + gzip.compress(whole))))] == [whole, whole]
    assert b"WARC-Date: " in whole and b"\r\n\r\nHTTP/1.1 200 OK\r\n" in whole
    for cut in (gzip.compress(whole)[:-8], gzip.compress(whole)[:-1], gzip.compress(whole)[:20]):
        with pytest.raises(ValueError):
            list(W.records(W.inflated(io.BytesIO(cut))))
