"""Write a DataFrame as ZIP deliveries, the way a partner's export job does.

Used to feed the loaders from tables: text lines are made by Spark, each archive is
streamed to its file by the one task that holds its sorted lines, or (``pack_in_pieces``) put
together from pieces that many tasks have sorted and deflated.
"""

from __future__ import annotations

import contextlib
import itertools
import uuid
import zipfile
import zlib
from collections.abc import Container, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cratework import files
from cratework.staging import free_shuffles


def csv_line(*columns: Column, plain: Container[int] = ()) -> Column:
    """One CSV line; every field quoted, null as an empty field.

    ``plain``: positions of columns whose text has no quotes, such as numbers.
    """
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    quoted = [t if i in plain else F.replace(t, F.lit('"'), F.lit('""')) for i, t in enumerate(texts)]
    return F.concat(F.lit('"'), F.concat_ws('","', *quoted), F.lit('"'))


# Deflate level of packed members.
FAST = 1
# Bytes of a packed piece that are copied at a time.
COPIED = 8 * 1024 * 1024


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """(start, stop) of neighbouring rows of one archive and member; rows without either stand alone."""
    n = batch.num_rows
    if not n:
        return
    changes = [pc.fill_null(pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)), True) for c in ("archive", "member")]
    starts = [0, *(i + 1 for i in pc.indices_nonzero(pc.or_(*changes)).to_pylist())]
    yield from zip(starts, [*starts[1:], n])


def _joined(texts: pa.Array, sep: str) -> bytes:
    """Texts as one, in UTF-8."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    return pc.binary_join(whole, sep)[0].as_buffer().to_pybytes()


def _member_info(member: str) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(member, (2000, 1, 1, 0, 0, 0))
    info.compress_type = zipfile.ZIP_DEFLATED
    return info


def pack_archives(lines: DataFrame, root: str) -> DataFrame:
    """Write archives and return (archive, members, lines) of each.

    ``lines`` has the columns archive (path below root), member, head, sep, tail and
    line; a member is head + lines joined by sep + tail, and a null line adds nothing.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        with contextlib.ExitStack() as archive_files:
            zipped = entry = None
            current: tuple = (None, None)
            tail, empty = b"", True
            for batch in batches:
                for start, stop in _runs(batch):
                    archive, member, head, sep, end = (batch.column(c)[start].as_py() for c in ("archive", "member", "head", "sep", "tail"))
                    if (archive, member) != current:
                        if entry is not None:
                            entry.write(tail)
                            entry.close()
                        if archive != current[0]:
                            archive_files.close()
                            out = archive_files.enter_context(files.open_output(f"{root}/{archive}"))
                            zipped = archive_files.enter_context(zipfile.ZipFile(out, "w"))
                            done.append({"archive": archive, "members": 0, "lines": 0})
                        info = _member_info(member)
                        info.compress_level = FAST  # one task packs an archive, however large
                        entry = zipped.open(info, "w", force_zip64=True)
                        entry.write(head.encode())
                        done[-1]["members"] += 1
                        current, tail, empty = (archive, member), end.encode(), True
                    texts = batch.column("line").slice(start, stop - start).drop_null()
                    if len(texts):
                        entry.write((b"" if empty else sep.encode()) + _joined(texts, sep))
                        done[-1]["lines"] += len(texts)
                        empty = False
            if entry is not None:
                entry.write(tail)
                entry.close()
        yield pa.RecordBatch.from_pylist(done, schema=report)

    report = to_arrow_schema(T.StructType.fromDDL(REPORT_SCHEMA))
    # By hash: sampling for ranges would compute all lines twice.
    placed = lines.repartition(_tasks(lines), "archive").sortWithinPartitions("archive", "member", "line")
    written = placed.select(*LINE_COLUMNS).mapInArrow(write, REPORT_SCHEMA)
    return _reported(written, root)


LINE_COLUMNS = ("archive", "member", "head", "sep", "tail", "line")
REPORT_SCHEMA = "archive string, members bigint, lines bigint"
PIECE_SCHEMA = (
    "archive string, member string, head string, sep string, tail string, task int, run int, "
    "file string, start bigint, packed bigint, size bigint, crc bigint, lines bigint"
)


def _tasks(lines: DataFrame) -> int:
    spark = lines.sparkSession
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _reported(written: DataFrame, root: str) -> DataFrame:
    folder = f"{root}-report"
    written.write.mode("overwrite").parquet(folder)
    return written.sparkSession.read.parquet(folder)


def _deflated(text: bytes, last: bool = False) -> bytes:
    """A piece of a DEFLATE stream that ends on a whole byte, so that another piece can follow."""
    packer = zlib.compressobj(FAST, zlib.DEFLATED, -zlib.MAX_WBITS)
    return packer.compress(text) + packer.flush(zlib.Z_FINISH if last else zlib.Z_SYNC_FLUSH)


def crc_of_both(first: int, second: int, length: int) -> int:
    """CRC-32 of two texts, one after the other, from that of each and the length of the second."""

    def times(matrix: list[int], vector: int) -> int:
        total, at = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[at]
            vector >>= 1
            at += 1
        return total

    step = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit more
    for _ in range(3):
        step = [times(step, row) for row in step]
    while length:  # step: 1, 2, 4 ... zero bytes more
        if length & 1:
            first = times(step, first)
        length >>= 1
        step = [times(step, row) for row in step]
    return first ^ second


def pack_in_pieces(lines: DataFrame, root: str) -> DataFrame:
    """``pack_archives`` for archives of any size: the same members, but many tasks work on one.

    Lines are dealt out by ranges, each task sorts and deflates its own into a file, and one task
    for each archive only puts these together. Lines are computed twice, as ranges are found by sampling.
    """
    spark = lines.sparkSession
    folder = f"{root}-pieces-{uuid.uuid4().hex[:12]}"
    listed, report = (to_arrow_schema(T.StructType.fromDDL(ddl)) for ddl in (PIECE_SCHEMA, REPORT_SCHEMA))

    def deflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, name = TaskContext.get().partitionId(), f"{folder}/data/{uuid.uuid4().hex}"
        done: list[dict] = []
        with contextlib.ExitStack() as opened:
            out = packer = None

            def put(data: bytes) -> None:
                out.write(data)
                done[-1]["packed"] += len(data)

            for batch in batches:
                for start, stop in _runs(batch):
                    row = {c: batch.column(c)[start].as_py() for c in LINE_COLUMNS[:-1]}
                    if not done or (row["archive"], row["member"]) != (done[-1]["archive"], done[-1]["member"]):
                        if out is None:
                            out = opened.enter_context(files.open_output(name))
                        else:
                            put(packer.flush(zlib.Z_SYNC_FLUSH))
                        at = done[-1]["start"] + done[-1]["packed"] if done else 0
                        own = {"task": task, "run": len(done), "file": name, "start": at}
                        done.append({**row, **own, "packed": 0, "size": 0, "crc": 0, "lines": 0})
                        packer = zlib.compressobj(FAST, zlib.DEFLATED, -zlib.MAX_WBITS)
                    texts = batch.column("line").slice(start, stop - start).drop_null()
                    if len(texts):
                        piece = done[-1]
                        text = (piece["sep"].encode() if piece["lines"] else b"") + _joined(texts, piece["sep"])
                        put(packer.compress(text))
                        piece["crc"] = zlib.crc32(text, piece["crc"])
                        piece["size"] += len(text)
                        piece["lines"] += len(texts)
            if done:
                put(packer.flush(zlib.Z_SYNC_FLUSH))
        yield pa.RecordBatch.from_pylist(done, schema=listed)

    def add_member(zipped: zipfile.ZipFile, pieces: list[dict]) -> int:
        first, full = pieces[0], [p for p in pieces if p["lines"]]
        sep = first["sep"].encode()
        parts: list[tuple] = [(_deflated(first["head"].encode()), len(first["head"].encode()), zlib.crc32(first["head"].encode()))]
        for i, piece in enumerate(full):
            if i:
                parts.append((_deflated(sep), len(sep), zlib.crc32(sep)))
            parts.append((piece, piece["size"], piece["crc"]))
        tail = first["tail"].encode()
        parts.append((_deflated(tail, last=True), len(tail), zlib.crc32(tail)))
        info, crc = _member_info(first["member"]), 0
        for _, size, own in parts:
            crc = crc_of_both(crc, own, size)
        info.CRC, info.file_size = crc, sum(size for _, size, _ in parts)
        info.compress_size = sum(p["packed"] if isinstance(p, dict) else len(p) for p, _, _ in parts)
        info.header_offset = zipped.fp.tell()
        zipped.fp.write(info.FileHeader(zip64=True))
        for part, _, _ in parts:
            if isinstance(part, bytes):
                zipped.fp.write(part)
                continue
            with files.open_input(part["file"]) as packed:
                packed.seek(part["start"])
                left = part["packed"]
                while left:
                    chunk = packed.read(min(left, COPIED))
                    if not chunk:
                        raise OSError(f"{part['file']} ended early")
                    zipped.fp.write(chunk)
                    left -= len(chunk)
        zipped.filelist.append(info)
        zipped.NameToInfo[info.filename] = info
        zipped.start_dir, zipped._didModify = zipped.fp.tell(), True
        return sum(p["lines"] for p in full)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for archive, pieces in itertools.groupby(rows, lambda row: row["archive"]):
            with files.open_output(f"{root}/{archive}") as out, zipfile.ZipFile(out, "w") as zipped:
                counts = [add_member(zipped, list(own)) for _, own in itertools.groupby(pieces, lambda row: row["member"])]
            done = {"archive": archive, "members": len(counts), "lines": sum(counts)}
            yield pa.RecordBatch.from_pylist([done], schema=report)

    placed = lines.repartitionByRange(_tasks(lines), "archive", "member", "line").sortWithinPartitions("archive", "member", "line")
    try:
        placed.select(*LINE_COLUMNS).mapInArrow(deflate, PIECE_SCHEMA).write.parquet(f"{folder}/list")
        free_shuffles(spark)
        pieces = spark.read.schema(PIECE_SCHEMA).parquet(f"{folder}/list")
        ordered = pieces.repartition(_tasks(lines), "archive").sortWithinPartitions("archive", "member", "task", "run")
        return _reported(ordered.mapInArrow(join, REPORT_SCHEMA), root)
    finally:
        files.delete_tree(folder)


def as_csv(
    df: DataFrame, archive: Column, member: Column, columns: list[str], names: list[str] | None = None
) -> DataFrame:
    """Lines of CSV members with a header."""
    head = ",".join(names or columns) + "\n"
    plain = {i for i, field in enumerate(df.select(*columns).schema) if isinstance(field.dataType, T.NumericType)}
    return df.select(
        archive.alias("archive"),
        member.alias("member"),
        F.lit(head).alias("head"),
        F.lit("\n").alias("sep"),
        F.lit("\n").alias("tail"),
        csv_line(*[F.col(c) for c in columns], plain=plain).alias("line"),
    )


def as_json(df: DataFrame, archive: Column, member: Column, record: Column) -> DataFrame:
    """Lines of members that hold one JSON array."""
    return df.select(
        archive.alias("archive"),
        member.alias("member"),
        F.lit("[").alias("head"),
        F.lit(",\n").alias("sep"),
        F.lit("]").alias("tail"),
        record.alias("line"),
    )
