"""WARC 1.1 writing, and reading with segment reassembly.

Writing: each page becomes a ``response`` record whose block is an HTTP message
with a chunked body, or a ``revisit`` record if another page with the same
payload is its response. Blocks longer than ``segment_bytes`` are split into a
first record and ``continuation`` records. The archives are files of Spark's
text writer, so they reach any store that Spark can write.

Reading: archives are unpacked and parsed as streams, once. Unsegmented blocks are
decoded in place; the segments of the others are grouped by the first record's id,
ordered by segment number, checked against the total length and then decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import body, scratch, stored

SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
#: records of an archive at most, and bytes of their blocks: long blocks are many records of SEGMENT_BYTES
RECORDS_PER_FILE, ARCHIVE_BYTES = 4_000, 1 << 27
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """Decodes chunked transfer framing; ValueError if it is broken or cut short."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is missing")
        n = int(data[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if data[at + n : at + n + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(data[at : at + n])
        at += n + 2


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


def record(kind: str, rid: str, block: bytes, **headers: str) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{rid}>", "WARC-Date": DATE} | {k.replace("_", "-"): v for k, v in headers.items()}
    lines = [f"{k}: {_clean(v)}" for k, v in head.items()] + [f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_records(page: int | None, url: str | None, payload: bytes, leader: int | None, role: str, segment_bytes: int, number: int | None = None) -> list[bytes]:
    """All records of one row; ``number`` tells apart rows of equal page and payload."""
    digest = payload_digest(payload)
    rid = f"urn:winnow:page:{'' if page is None else page}:{digest}" + ("" if number is None else f":row{number}")
    common = {"WARC_Target_URI": url or "urn:winnow:none", "WARC_Payload_Digest": f"sha1:{digest}", "Content_Type": "application/http;msgtype=response"}
    if role == "revisit":
        return [
            record(
                "revisit", rid, f"{HTTP}Content-Length: {len(payload)}\r\n\r\n".encode(), **common, WARC_Refers_To=f"<urn:winnow:page:{leader}:{digest}>",
                WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            )
        ]
    block = f"{HTTP}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [record("response", rid, block, **common)]
    out = [record("response", rid, parts[0], **common, WARC_Segment_Number="1")]
    for n, p in enumerate(parts[1:], 2):
        more = {"WARC_Segment_Total_Length": str(len(block))} if n == len(parts) else {}
        out.append(record("continuation", f"{rid}:part{n}", p, WARC_Segment_Origin_ID=f"<{rid}>", WARC_Segment_Number=str(n), **more))
    return out


#: groups of copies that are looked up by a broadcast: the largest ones, so no key of the shuffle beside it holds more than one row in so many
HOT_GROUPS = 10_000
#: bytes of records handed over at once
BATCH_BYTES = 4_000_000


def _with_leaders(d: DataFrame) -> DataFrame:
    """``d(page_id, sha, ..)`` with leader, copies and own (rows of the leader's id) where its payload occurs more than once.

    The ``HOT_GROUPS`` largest groups go out by broadcast, so a payload that a third of
    all pages carry moves no row. Only if there are more groups, the rest is joined by a
    shuffle, in which rows that are settled already are dealt by their ids.
    """
    groups = d.groupBy("sha", "page_id").agg(F.count("*").alias("n")).groupBy("sha")
    groups = groups.agg(F.max("page_id").alias("leader"), F.sum("n").alias("copies"), F.max_by("n", "page_id").alias("own"))
    # single pages need no leader, so this table holds groups of copies only
    groups = stored(groups.where("copies > 1").select(F.col("sha").alias("_sha"), "leader", "copies", "own"))
    hot = stored(groups.orderBy(F.desc("copies"), "_sha").limit(HOT_GROUPS))
    first = d.join(F.broadcast(hot), F.col("sha") == F.col("_sha"), "left")
    rest = groups.join(F.broadcast(hot.select("_sha")), "_sha", "left_anti")
    if rest.isEmpty():
        return first.drop("_sha")
    names = ["leader", "copies", "own"]
    more = rest.select(F.col("_sha").alias("_key"), *[F.col(c).alias(f"_{c}") for c in names])
    key = F.when(F.col("_sha").isNull(), F.col("sha")).otherwise(F.concat_ws(":", F.lit("-"), "page_id", F.xxhash64("url").cast("string")))
    both = first.withColumn("_at", key).join(more, F.col("_at") == F.col("_key"), "left")
    return both.withColumns({c: F.coalesce(c, f"_{c}") for c in names}).drop("_sha", "_at", "_key", *[f"_{c}" for c in names])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, min_revisit_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes ``pages(page_id, url, html)`` as gzip-compressed WARC files under ``path``.

    Of pages with equal payloads of at least ``min_revisit_bytes``, that with the
    largest page_id is the response and the others are revisits of it. Null html is
    an empty payload. Every row is a record of its own, repeated rows (equal
    page_id and payload) and rows with a null page_id as well; these are never a
    response if a page with an id has their payload. A record's id holds page_id,
    payload digest and, unless it is the only response of its payload, a row number.
    A very long page is as many records as it has segments, so an archive holds at most
    ``ARCHIVE_BYTES`` of blocks, or one record if ``segment_bytes`` is more. Other columns are not read.
    """
    records_per_file = max(1, min(records_per_file, ARCHIVE_BYTES // segment_bytes))
    d = pages.select("page_id", "url", F.encode(body("html"), "UTF-8").alias("payload")).withColumn("sha", F.sha2("payload", 256))
    d = _with_leaders(d)
    same = F.col("leader").isNull() | F.col("leader").eqNullSafe(F.col("page_id")) | (F.octet_length("payload") < min_revisit_bytes)
    alone = F.col("copies").isNull() | ((F.col("page_id") == F.col("leader")) & (F.col("own") == 1))
    rows = d.select(
        "page_id", "url", "payload", "leader", F.when(same, F.lit("response")).otherwise(F.lit("revisit")).alias("role"),
        F.when(~F.coalesce(alone, F.lit(False)), F.monotonically_increasing_id()).alias("number"),
    )
    schema = pa.schema([("record", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for b in batches:
            for row in zip(*b.columns, strict=True):
                page, url, payload, leader, role, number = (v.as_py() for v in row)
                for r in page_records(page, url, payload, leader, role, segment_bytes, number):
                    out.append({"record": r[:-2]})
                    size += len(r)
                if size > BATCH_BYTES:
                    yield _batch(out, schema)
                    out, size = [], 0
        if out:
            yield _batch(out, schema)

    # the writer ends each row with lineSep, which is the last CRLF of a record
    rows.mapInArrow(build, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n").option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", records_per_file).text(path)


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record, read one after the other; ValueError on broken framing."""
    n = 0
    while line := stream.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record after {n} records")
        head = {}
        while line := stream.readline():
            if not line.strip():
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head.get("content-length", "-1"))
        block = stream.read(max(size, 0))
        if size < 0 or len(block) < size:
            raise ValueError(f"record {n} is cut short")
        yield head, block
        stream.read(4)
        n += 1


def opened(content: pa.Buffer) -> BinaryIO:
    """A stream over an archive, unpacked as it is read."""
    source = pa.BufferReader(content)
    packed = content[:2].to_pybytes() == b"\x1f\x8b"
    return io.BufferedReader(gzip.GzipFile(fileobj=source) if packed else source, 1 << 16)


def http_body(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return fields, unchunked(rest) if fields.get("transfer-encoding") == "chunked" else rest


_READ = [
    ("page_id", "long", pa.int64()), ("url", "string", pa.string()), ("record_type", "string", pa.string()), ("payload", "binary", pa.binary()), ("payload_bytes", "long", pa.int64()),
    ("payload_digest", "string", pa.string()), ("refers_to", "long", pa.int64()), ("problem", "string", pa.string()),
]
_PARTS = [("part_of", "string", pa.string()), ("segment", "int", pa.int32()), ("total", "long", pa.int64()), ("block", "binary", pa.binary())]


def _ddl(fields: list[tuple]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind, _ in fields)


def _arrow(fields: list[tuple]) -> pa.Schema:
    return pa.schema([(name, kind) for name, _, kind in fields])


def _page(rid: str) -> int | None:
    m = re.fullmatch(r"<?urn:winnow:page:(-?\d+)(?::[^>]*)?>?", rid)
    return int(m[1]) if m else None


def _claimed(head: dict[str, str]) -> str:
    return head.get("warc-payload-digest", "").removeprefix("sha1:")


def _decoded(head: dict[str, str], block: bytes) -> dict:
    """The output row of one whole record; absent keys are null."""
    row = {"page_id": _page(head.get("warc-record-id", "")), "url": head.get("warc-target-uri"), "record_type": head.get("warc-type")}
    try:
        fields, payload = http_body(block)
    except ValueError as e:
        return row | {"problem": str(e)}
    if row["record_type"] == "revisit":
        return row | {"refers_to": _page(head.get("warc-refers-to", "")), "payload_bytes": int(fields["content-length"]), "payload_digest": _claimed(head)}
    digest = payload_digest(payload)
    return row | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "problem": None if _claimed(head) in ("", digest) else "payload digest differs"}


def _segment(head: dict[str, str], block: bytes) -> dict:
    """One segment, filed under its first record's id."""
    total = head.get("warc-segment-total-length")
    return {
        "url": head.get("warc-target-uri"), "payload_digest": _claimed(head), "part_of": head.get("warc-segment-origin-id", head["warc-record-id"]),
        "segment": int(head["warc-segment-number"]), "total": int(total) if total else None, "block": block,
    }


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_READ + _PARTS)
    rows, size = [], 0
    for b in batches:
        for content in b.column("content"):
            try:
                for head, block in parse(opened(content.as_buffer())):
                    rows.append(_segment(head, block) if "warc-segment-number" in head else _decoded(head, block))
                    size += len(block)
                    if size > BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
            except (ValueError, EOFError, OSError, zlib.error) as e:  # the rest of this archive cannot be read
                rows.append({"problem": f"archive: {e}"})
    if rows:
        yield _batch(rows, schema)


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_READ)
    for b in batches:
        for i in range(b.num_rows):  # a row is one record's segments
            r = b.slice(i, 1).to_pylist()[0]
            head = {"warc-record-id": r["part_of"], "warc-type": "response", "warc-payload-digest": r["first"]["payload_digest"] or ""}
            if r["first"]["url"] is not None:
                head["warc-target-uri"] = r["first"]["url"]
            block = b"".join(p["block"] for p in r["parts"])
            if [p["segment"] for p in r["parts"]] != list(range(1, len(r["parts"]) + 1)) or len(block) != r["total"]:
                row = {"page_id": _page(r["part_of"]), "url": head.get("warc-target-uri"), "record_type": "response", "problem": "segments are missing"}
            else:
                row = _decoded(head, block)
            yield _batch([row], schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each response or revisit under ``path``.

    The payload of a revisit is its response's and is not repeated; its size and
    digest come from its own headers. ``problem`` tells what a record breaks: a
    missing segment, a total length or digest that differs, cut framing. An archive
    that cannot be read on gives one row with a problem and no type. Every archive is
    read once; its records are a table in the shared folder.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = stored(files.mapInArrow(_records, _ddl(_READ + _PARTS)))
    names = [name for name, _, _ in _READ]
    # a group is one record's segments, so its size is that of one record
    grouped = (
        parsed.where("part_of is not null")
        .groupBy("part_of")
        .agg(
            F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
            F.max("total").alias("total"),
            F.max(F.struct(F.col("segment") == 1, "url", "payload_digest")).alias("first"),
        )
    )
    return parsed.where("part_of is null").select(*names).unionByName(grouped.mapInArrow(_reassembled, _ddl(_READ)))


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back.

    An empty table gives no rows; columns other than page_id, url and html are not read.
    """
    spark, path = pages.sparkSession, scratch(pages.sparkSession)
    write_warc(pages, path, segment_bytes)
    return read_warc(spark, path)
