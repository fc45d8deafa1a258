r"""A content-addressed web archive.

``payloads`` (digest, payload) holds every distinct payload once, under its SHA-256;
``records`` (page_id, header, block_head, tail, digest) holds the exact bytes around it. A join puts the
records together again: header, block head, payload unless it is a revisit, tail.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework import files
from cratework.llm.common import Scratch

LINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this many bytes are never written as revisits.
REVISIT_BYTES = 100
# A level of gzip: records are small and read once.
COMPRESSION = 2


class DigestClash(Exception):
    """Two payloads share a digest."""


def _uuid(page: Column) -> Column:
    """A record id that follows from the page's place and content, so that reruns agree."""
    hexed = F.md5(F.encode(page, "UTF-8"))
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(LINE))


def write_archive(pages: DataFrame, folder: str, date: str = "2026-01-01T00:00:00Z") -> None:
    """Write a record per row of pages (page_id, url, html), payload bytes stored once.

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads of at
    least REVISIT_BYTES the one with the smallest page_id is the response, the others revisit it; rows
    without page_id come last. Smaller payloads are all responses. Rows that repeat a
    page_id: those with the response's id and payload are all responses. White space and control
    characters in urls are percent-encoded, a null url is an empty one. Equal digests of
    unequal payloads (other length or other checksum) stop the job.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    # One row a task for each digest, however many copies there are.
    owners = rows.groupBy("digest").agg(
        F.min("page_id").alias("owner"),
        F.min_by("url", "page_id").alias("owner_url"),
        F.min("size").alias("least"),
        F.max("size").alias("most"),
        F.min(F.xxhash64("payload")).alias("low"),
        F.max(F.xxhash64("payload")).alias("high"),
    )
    owners = scratch.stage(owners, "owners")
    if not owners.where("least <> most or low <> high").isEmpty():
        raise DigestClash("two payloads share a SHA-256 digest")
    first = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    first.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    scratch.free_shuffles(3)
    heads = rows.select("page_id", "url", "digest", "size").join(owners.select("digest", "owner", "owner_url"), "digest")
    again = (F.col("size") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("owner"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    owner_url = F.regexp_replace(F.coalesce("owner_url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    page, owner = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "owner"))
    mime = F.lit("text/html; charset=utf-8")
    block_head = F.when(
        again, F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}"), _line("Content-Type", mime), F.lit(LINE))
    ).otherwise(
        F.concat(
            F.lit(f"HTTP/1.1 200 OK{LINE}"),
            _line("Content-Type", mime),
            _line("Content-Length", F.col("size").cast("string")),
            F.lit(LINE),
        )
    )
    heads = heads.select(
        "page_id",
        "digest",
        again.alias("again"),
        block_head.alias("block_head"),
        F.concat(
            F.lit(f"WARC/1.1{LINE}"),
            _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
            _line("WARC-Record-ID", _uuid(F.concat_ws(" ", page, url, "digest"))),
            _line("WARC-Date", F.lit(date)),
            _line("WARC-Target-URI", url),
            _line("WARC-Page-ID", page),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
            _line("WARC-Payload-Length", F.col("size").cast("string")),
            F.when(
                again,
                F.concat(
                    _line("WARC-Profile", F.lit(PROFILE)),
                    _line("WARC-Refers-To", _uuid(F.concat_ws(" ", owner, owner_url, "digest"))),
                    _line("WARC-Refers-To-Page-ID", owner),
                    _line("WARC-Refers-To-Target-URI", owner_url),
                ),
            ).otherwise(""),
            _line("Content-Type", F.lit("application/http; msgtype=response")),
            _line(
                "Content-Length",
                (F.octet_length(block_head) + F.when(again, 0).otherwise(F.col("size"))).cast("string"),
            ),
            F.lit(LINE),
        ).alias("header"),
    )
    as_bytes = [F.encode(c, "UTF-8").alias(c) for c in ("header", "block_head")]
    heads = heads.select("page_id", "digest", "again", *as_bytes, F.encode(F.lit(LINE * 2), "UTF-8").alias("tail"))
    heads.write.option("compression", "zstd").parquet(f"{folder}/records")
    scratch.drop("owners")
    scratch.free_shuffles(3)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, record, payload): the records byte for byte, and the full payload of each, revisits too.

    The payload is checked against its digest when it is read; a damaged one stops the job.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    payloads = payloads.withColumn(
        "payload",
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("payload does not have digest "), "digest"))
        ),
    )
    records = spark.read.parquet(f"{folder}/records")
    body = F.when(F.col("again"), F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return records.join(payloads, "digest").select(
        "page_id", F.concat("header", "block_head", body, "tail").alias("record"), "payload"
    )


def field(record_head: Column, name: str) -> Column:
    """A header field of a record's text, null where it is not there."""
    found = F.regexp_extract(record_head, rf"(?s)\r\n{name}: (.*?)\r\n", 1)
    return F.when(found != "", found)


def describe(archive: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), parsed from the records."""
    end = F.position(F.lit(LINE * 2), F.decode("record", "ISO-8859-1"))
    head = F.decode(F.substring("record", F.lit(1), end + 1), "ISO-8859-1")
    rows = archive.select("payload", head.alias("head"))
    return rows.select(
        field(F.col("head"), "WARC-Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        field(F.col("head"), "WARC-Type").alias("record_type"),
        field(F.col("head"), "WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        (field(F.col("head"), "WARC-Payload-Digest") == F.concat(F.lit("sha256:"), F.sha2("payload", 256))).alias("digest_ok"),
    )


def export_files(archive: DataFrame, folder: str) -> DataFrame:
    """(path, records, bytes) of gzip WARC files, one a task, a gzip member a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        path, count, size, out = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            for record in batch.column(0):
                out = out or files.open_output(path)
                member = gzip.compress(record.as_py(), COMPRESSION, mtime=0)
                out.write(member)
                count, size = count + 1, size + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"]
            )

    report = archive.select("record").mapInArrow(run, "path string, records long, bytes long")
    return Scratch(archive.sparkSession, "warc-files").stage(report, "report")


def _records(path: str) -> Iterator[tuple[bytes, bytes]]:
    """(header, rest) of each record of a file, the rest with the two lines that end it."""
    with files.open_input(path) as raw, gzip.open(raw) as text:
        while head := text.readline():
            lines = [head]
            while lines[-1] not in (b"\r\n", b""):
                lines.append(text.readline())
            length = next(int(x.split(b":")[1]) for x in lines if x.lower().startswith(b"content-length:"))
            yield b"".join(lines), text.read(length) + text.read(4)


def _one_a_task(exported: DataFrame) -> DataFrame:
    """The paths of the files, each in a task of its own: they are small, what they name is not."""
    return exported.select("path").repartition(max(exported.count(), 1))


def import_files(exported: DataFrame) -> DataFrame:
    """(record) of the exported files, read member by member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0):
                for head, rest in _records(path.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([head + rest], pa.binary())], ["record"])

    return _one_a_task(exported).mapInArrow(run, "record binary")


READ = "page_id long, record_type string, refers_to long, digest string, body_bytes long, body_digest string"


def read_records(exported: DataFrame) -> DataFrame:
    """What each record of the exported files says, and bytes and SHA-256 of the payload it holds (of a revisit: none).

    A record that does not end as it should, or a payload that is not its digest's, stops the job.
    """

    def parsed(head: bytes, rest: bytes) -> tuple:
        fields = dict(line.split(": ", 1) for line in head.decode().split(LINE)[1:] if ": " in line)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        number = lambda name: int(fields[name]) if fields.get(name) else None
        if not rest.endswith(b"\r\n\r\n"):
            raise ValueError(f"damaged record of page {fields.get('WARC-Page-ID')}")
        size = body = None
        if fields["WARC-Type"] == "response":
            payload = rest[rest.index(b"\r\n\r\n") + 4 : -4]
            size, body = len(payload), hashlib.sha256(payload).hexdigest()
            if body != digest:
                raise DigestClash(f"payload does not have digest {digest}")
        return number("WARC-Page-ID"), fields["WARC-Type"], number("WARC-Refers-To-Page-ID"), digest, size, body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = ["page_id", "record_type", "refers_to", "digest", "body_bytes", "body_digest"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        held: list[tuple] = []
        for batch in batches:
            for path in batch.column(0):
                for head, rest in _records(path.as_py()):
                    held.append(parsed(head, rest))
                    if len(held) >= 1024:
                        yield out(held)
                        held = []
        if held:
            yield out(held)

    return _one_a_task(exported).mapInArrow(run, READ)


def describe_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from parsed records.

    A revisit has no payload of its own; bytes and digest are those of the response it revisits, joined by
    digest. One that has no response in the files keeps nulls.
    """
    whole = records.where("record_type = 'response'").groupBy("digest").agg(
        F.max("body_bytes").alias("whole_bytes"), F.max("body_digest").alias("whole_digest")
    )
    joined = records.where("record_type = 'revisit'").join(whole, "digest", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = joined.withColumnsRenamed({"whole_bytes": "payload_bytes", "whole_digest": "payload_digest"})
    responses = records.where("record_type = 'response'")
    responses = responses.withColumnsRenamed({"body_bytes": "payload_bytes", "body_digest": "payload_digest"})
    return responses.select(*columns).unionByName(revisits.select(*columns))
