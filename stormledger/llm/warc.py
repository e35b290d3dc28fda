"""WARC archives: write records with an index, then read selected records by byte range.

Writing: each task appends gzip members, one per record, to files of its own in a shared folder
and yields an index row per record (file, offset, length, URL, digest). The index is a written
table; a task that is run again writes files under new names, and only the rows of the attempt
that Spark committed reach the index, so files of lost attempts are never read.

Reading: index rows are dealt out by file and stretch of the file, sorted by offset, and
neighbouring ranges are fetched in one read.

Empty cases: a null payload is an empty payload; a null URL is an empty URL; an empty table gives an empty
index; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_folder, slices, stage

ROLL_BYTES = 256 << 20
STRETCH_BYTES = 8 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
LEAST_REVISIT_BYTES = 1000
WRITTEN_AT = "1970-01-01T00:00:00Z"
URN = "urn:page:"

INDEX_SCHEMA = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def mark_revisits(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, record_type, refers_to) of a pages table.

    Equal payloads of ``least_bytes`` or more: the largest page_id is the response. Rows that repeat
    that page_id with that payload are responses too. The groups are found from digests and
    lengths alone (partial sums before the shuffle); adaptive execution splits a group that many
    pages share.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    shared = (
        rows.where(F.col("size") >= least_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    shared = stage(shared, "shared-payloads")  # both sides of the join are scans, so that it can split a hot payload
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return rows.join(shared, ["digest", "size"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"),
    )


def record_bytes(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record as a gzip member. A revisit holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {WRITTEN_AT}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{URN}{refers_to}>",
        ]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return pack.compress(raw) + pack.flush()


def parse_record(member: bytes) -> dict:
    """The fields of ``RECORD_SCHEMA`` from one gzip member; raises if a payload differs from its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    number = lambda name: int(m[1]) if (m := re.search(r":(-?\d+)>$", fields.get(name, ""))) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "refers_to": number("WARC-Refers-To"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def write_archives(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write what ``mark_revisits`` returns as ``*.warc.gz`` below ``folder``; returns the index."""
    folder = folder or fresh_folder(records.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for part in slices(batches, "payload"):
                index = []
                for row in part.to_pylist():
                    if out is None or at >= ROLL_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    member = record_bytes(
                        row["page_id"], row["url"], row["payload"], row["digest"], row["record_type"], row["refers_to"]
                    )
                    out.write(member)
                    index.append(
                        {
                            "file": name,
                            "offset": at,
                            "length": len(member),
                            "page_id": row["page_id"],
                            "url": row["url"],
                            "digest": row["digest"],
                            "record_type": row["record_type"],
                        }
                    )
                    at += len(member)
                yield pa.RecordBatch.from_pylist(index, index_type)
        finally:
            if out is not None:
                out.close()

    index_type = pa.schema(
        [
            ("file", pa.string()),
            ("offset", pa.int64()),
            ("length", pa.int64()),
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("digest", pa.string()),
            ("record_type", pa.string()),
        ]
    )
    index = records.mapInArrow(write, INDEX_SCHEMA)
    return stage(index, "warc-index").withColumn("folder", F.lit(folder))


def coalesced(rows: list[dict]) -> Iterator[list[dict]]:
    """Runs of sorted index rows of one file that are near enough to fetch in one read."""
    run: list[dict] = []
    for row in rows:
        if run:
            end = run[-1]["offset"] + run[-1]["length"]
            near = row["file"] == run[0]["file"] and row["offset"] - end <= GAP_BYTES
            if not near or row["offset"] + row["length"] - run[0]["offset"] > READ_BYTES:
                yield run
                run = []
        run.append(row)
    if run:
        yield run


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the given index rows (any selection of an index), read by byte range."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, object] = {}
        for batch in batches:
            for run in coalesced(batch.to_pylist()):
                key = f"{run[0]['folder']}/{run[0]['file']}"
                if key not in files:
                    for f in files.values():
                        f.close()
                    files.clear()
                    store, root = fs.FileSystem.from_uri(run[0]["folder"])
                    files[key] = store.open_input_file(f"{root}/{run[0]['file']}")
                first, last = run[0]["offset"], run[-1]["offset"] + run[-1]["length"]
                data = files[key].read_at(last - first, first)
                found = [
                    parse_record(data[r["offset"] - first : r["offset"] - first + r["length"]]) for r in run
                ]
                if not payloads:
                    for r in found:
                        r["payload"] = None
                yield pa.RecordBatch.from_pylist(found, record_type)

    record_type = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )
    # The index is small next to what its rows stand for, so tasks are counted by the bytes to read.
    total = index.agg(F.sum("length")).first()[0] or 0
    ordered = (
        index.select("folder", "file", "offset", "length")
        .withColumn("stretch", F.floor(F.col("offset") / STRETCH_BYTES))
        .repartition(max(1, -(-2 * total // STRETCH_BYTES)), "file", "stretch")
        .sortWithinPartitions("file", "offset")
        .drop("stretch")
    )
    return ordered.mapInArrow(read, RECORD_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give each revisit the payload of the response it refers to."""
    responses = records.where("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), F.col("payload").alias("shared")
    )
    responses = responses.dropDuplicates(["refers_to"])
    whole = records.join(responses, "refers_to", "left")
    return whole.withColumn("payload", F.coalesce("payload", "shared")).drop("shared")
