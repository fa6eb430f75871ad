"""WARC archives of raw pages, normalised to one gzip member a record (operator 9).

Writing: a page's record is a response, or a revisit of the response with the same payload.
Tasks write archives of about `file_bytes` each, compressed as one stream, as crawlers
without record compression leave them. Normalising: each such stream is inflated once, in
pieces; every record becomes a gzip member of its own, and a sidecar index has its offset,
length, type and id. Reading: members are read by the index, and each is inflated alone.

All files are in the shared folder. A task writes under a name of its own and renames the
whole file at the end, so one that is lost or runs twice leaves nothing half done.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, new_path, small_batches, written

#: Payloads below this size are never stored as a revisit.
REVISIT_BYTES = 1000
PIECE = 1 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


#: Pages tell neither when nor with what head they were fetched, so that all have these.
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _record(kind: str, page_id: str, url: str | None, digest: str, size: int, refers_to: str | None, payload: bytes) -> bytes:
    """A record whose block is an HTTP response; a revisit's has the head only."""
    block = HTTP_HEAD + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(raw: bytes) -> dict[str, str]:
    """Header lines of a record, names in lower case."""
    lines = raw.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records from the pieces of one inflated stream; holds one record at a time."""
    held, at = bytearray(), 0
    chunks = iter(chunks)

    def more() -> bool:
        nonlocal at
        piece = next(chunks, None)
        if piece is None:
            return False
        del held[:at]
        at = 0
        held.extend(piece)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if len(held) > at:
                    raise ValueError("the archive ends inside a record's head")
                return
        size = end + 4 - at + int(parse_head(bytes(held[at:end]))["content-length"]) + 4
        while len(held) - at < size:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield bytes(held[at : at + size])
        at += size


def inflated(stream) -> Iterator[bytes]:
    """Pieces of what a gzip file of one or more members holds; one that is cut off fails,
    wherever the cut is."""
    box, begun = zlib.decompressobj(31), False
    while raw := stream.read(PIECE):
        while raw:
            begun = True
            if out := box.decompress(raw, PIECE):
                yield out
            raw = box.unconsumed_tail
            if box.eof:
                raw, box, begun = box.unused_data, zlib.decompressobj(31), False
    if out := box.flush():
        yield out
    if begun:
        raise ValueError("the archive ends inside a gzip member")


class _Whole:
    """Writes to a name of its own; close() gives the file its name."""

    def __init__(self, path: str) -> None:
        self.fs, self.path = _open(path)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.at = self.fs.open_output_stream(self.own), 0

    def write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.own, self.path)


def planned(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, html, digest, size, kind, refers_to."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    # Copies are combined before the shuffle; only groups of two or more are joined to rows.
    first = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    first = written(first, "responses")
    rows = rows.join(if_small(first), ["digest", "size"], "left")
    kind = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), "revisit").otherwise("response")
    return rows.withColumn("kind", kind).withColumn("refers_to", F.when(F.col("kind") == "revisit", F.col("first"))).select("page_id", "url", "html", "digest", "size", "kind", "refers_to")


def write_monolithic(rows: DataFrame, folder: str, file_bytes: int) -> DataFrame:
    """Writes archives, each one gzip stream, and returns their paths (path)."""
    total = rows.agg(F.sum(F.when(F.col("kind") == "response", F.col("size")).otherwise(0) + 500)).first()[0] or 0
    files = int(max(1, -(-total // file_bytes)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = box = None
        path = f"{folder}/mono/{uuid.uuid4().hex}.warc.gz"
        for b in batches:
            for r in b.itertuples(index=False):
                if out is None:
                    out, box = _Whole(path), zlib.compressobj(6, zlib.DEFLATED, 31)
                body = r.html.encode() if r.kind == "response" else b""
                out.write(box.compress(_record(r.kind, r.page_id or "", r.url, r.digest, r.size, r.refers_to or None, body)))
        if out is not None:
            out.write(box.flush())
            out.close()
            yield pd.DataFrame({"path": [path]})

    texts = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})  # ids as text: pandas has no whole numbers with nulls
    return texts.repartition(files, "page_id").mapInPandas(run, "path string")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """archives (path) -> path, index: one member a record, and the sidecar index of JSON
    lines with offset, length, type and id of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                name = path.rpartition("/")[2]
                to, side = f"{folder}/members/{name}", f"{folder}/members/{name}.idx"
                source, at = _open(path)
                out, index = _Whole(to), _Whole(side)
                with source.open_input_stream(at, compression=None) as stream:
                    for raw in records(inflated(stream)):
                        head = parse_head(raw[: raw.index(b"\r\n\r\n")])
                        box = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = box.compress(raw) + box.flush()
                        index.write(json.dumps({"offset": out.at, "length": len(member), "type": head.get("warc-type", ""), "id": head.get("warc-record-id", "")}).encode() + b"\n")
                        out.write(member)
                out.close()
                index.close()
                yield pd.DataFrame({"path": [to], "index": [side]})

    return archives.repartition(max(1, archives.count()), "path").mapInPandas(run, "path string, index string")


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, stored_digest string, stored_bytes long, path string, offset long, length long"


def read(archives: DataFrame) -> DataFrame:
    """Each record of normalised archives, by its place in the index; a member is inflated
    alone. stored_digest and stored_bytes are of the payload that the record itself holds:
    of an HTTP block what follows its head, else the block. Records of other kinds (warcinfo,
    request, metadata) and from other writers are read alike; what their heads lack is null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, side in zip(b["path"], b["index"], strict=True):
                source, at = _open(path)
                places, side_at = _open(side)
                rows = []
                with places.open_input_stream(side_at, compression=None) as lines, source.open_input_file(at) as file:
                    for line in _lines(lines):
                        place = json.loads(line)
                        file.seek(place["offset"])
                        raw = zlib.decompress(file.read(place["length"]), 31)
                        cut = raw.index(b"\r\n\r\n")
                        head = parse_head(raw[:cut])
                        payload = raw[cut + 4 : cut + 4 + int(head["content-length"])]
                        if head.get("content-type", "").startswith("application/http"):
                            payload = payload[payload.find(b"\r\n\r\n") + 4 :] if b"\r\n\r\n" in payload else b""
                        size = int(head.get("warc-payload-length", len(payload)))
                        rows.append((_page(head.get("warc-record-id")), head.get("warc-target-uri"), head.get("warc-type"), _page(head.get("warc-refers-to")), size, head.get("warc-payload-digest", "").removeprefix("sha1:") or None, hashlib.sha1(payload).hexdigest(), len(payload), path, place["offset"], place["length"]))
                        if len(rows) >= 2000:
                            yield _frame(rows)
                            rows = []
                yield _frame(rows)

    return archives.repartition(max(1, archives.count()), "path").mapInPandas(run, READ)


def _page(name: str | None) -> int | None:
    """The page that a record's name tells; names given elsewhere tell none."""
    number = (name or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number.removeprefix("-").isdigit() else None


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while piece := stream.read(PIECE):
        *whole, held = (held + piece).split(b"\n")
        yield from whole
    if held:
        yield held


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = 32 << 20) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, path, offset,
    length: a row for each page, read back from the normalised archives. A response whose
    stored payload differs from its header's digest raises an error.

    Null html is an empty payload, null url an empty one. Of pages with equal payloads of
    REVISIT_BYTES or more the one with the largest id is the response. Rows that repeat that
    id are responses too; a row without an id revisits it. Extra columns are ignored; an
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = new_path(spark, "warc")
    mono = written(write_monolithic(planned(pages, id_col, url_col, html_col), folder, file_bytes), "mono")
    members = written(normalise(mono, folder), "members")
    rows = read(members)
    wrong = (F.col("record_type") == "response") & ((F.col("stored_digest") != F.col("payload_digest")) | (F.col("stored_bytes") != F.col("payload_bytes")))
    digest = F.when(wrong, F.raise_error(F.concat(F.lit("payload differs: "), F.col("path"))).cast("string")).otherwise(F.col("payload_digest"))
    return rows.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", "url", "path", "offset", "length")


QUERY_COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

ORACLE_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM f
"""
