"""Read one archive member as Arrow batches without losing a character.

Spark's own CSV and JSON readers turn empty fields into nulls, pad ragged rows and
rewrite numbers (1.10 becomes 1.1), so members are parsed here, inside the tasks.
"""

from __future__ import annotations

import codecs
import itertools
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.csv as pa_csv

HEADER_CHUNK = 64 * 1024
CSV_BLOCK = 4 * 1024 * 1024
# JSON text that is parsed at a time, in characters.
JSON_CHUNK = 4 * 1024 * 1024
# Bytes of a JSON member's rows that are kept, so that it is parsed once only.
JSON_HELD = 32 * 1024 * 1024
JSON_SPACE = " \t\n\r"


class Skipped(Exception):
    """The member holds nothing to load; the archive goes on."""


class Notes:
    """What a reader has to say about a member beside its rows; complete once all batches are read."""

    def __init__(self) -> None:
        self.dropped_keys = 0


def has_header(stream: BinaryIO) -> bool:
    """A line end after some text: without one there is no header with data after it."""
    return header_line(stream) is not None


def header_line(stream: BinaryIO) -> bytes | None:
    """What comes before the first line end after some text, None where there is no such line end.

    Of a line that is longer than a piece only its last piece.
    """
    started = False
    while chunk := stream.read(HEADER_CHUNK):
        if not started:
            chunk = chunk.lstrip(b"\r\n")
            started = bool(chunk)
        if b"\n" in chunk or b"\r" in chunk:
            return re.split(b"[\r\n]", chunk, maxsplit=1)[0]
    return None


def likely_names(line: bytes) -> list[str]:
    """Column names if the header is as plain as most are; a guess that the parser has to confirm."""
    plain = line.removeprefix(codecs.BOM_UTF8).decode("utf-8", "replace")
    return [name.strip('"') for name in plain.split(",")]


def _open_csv(stream: BinaryIO, types: dict | None = None):
    return pa_csv.open_csv(
        stream,
        read_options=pa_csv.ReadOptions(use_threads=False, block_size=CSV_BLOCK),
        parse_options=pa_csv.ParseOptions(newlines_in_values=True),
        convert_options=pa_csv.ConvertOptions(column_types=types),
    )


def read_csv(archive: zipfile.ZipFile, info: zipfile.ZipInfo, notes: Notes, json_limit: int | None = None):
    """All columns as text, block by block. The names come from the same parser that reads the rows.

    If they are the likely ones, all columns are text already; else the member is opened again with its names.
    """
    with archive.open(info) as stream:
        line = header_line(stream)
    if line is None:
        raise Skipped("no header line with data after it")
    likely = likely_names(line)
    reader = _open_csv(archive.open(info), dict.fromkeys(likely, pa.string()))
    names = reader.schema.names
    if not set(names).issubset(likely):
        reader.close()
        reader = _open_csv(archive.open(info), dict.fromkeys(names, pa.string()))
    return reader.schema, iter(reader)


def json_values(stream: BinaryIO) -> Iterator:
    """Records of a JSON document: the elements of an array, or the document itself, one after the other.

    The text is read and parsed piece by piece, so memory is bounded by the largest record
    and not by the member. Numbers keep their source text.
    """
    head = stream.read(4)
    decode = codecs.getincrementaldecoder(json.detect_encoding(head))("surrogatepass").decode
    decoder = json.JSONDecoder(parse_int=str, parse_float=str)
    scan = decoder.raw_decode
    text, at, ended, whole = decode(head), 0, False, True

    def more() -> bool:
        nonlocal text, at, ended, whole
        if ended:
            return False
        piece = stream.read(max(JSON_CHUNK, len(text) - at))  # a longer record is tried again at twice the size
        ended = not piece
        text, at, whole = text[at:] + decode(piece, ended), 0, True
        return True

    def run(between: str) -> list:
        """The elements of an array up to what looks like the last end of one in the text; none where that is none.

        ``between``: what was between the last two. What parses as an array is the same elements one by one:
        an end that is part of an element leaves it open, and that is no array.
        """
        nonlocal at, whole
        end = text.rfind("}" + between + "{", at) if whole and between else -1
        if end < 0:
            return []
        try:
            found = decoder.decode(f"[{text[at:end + 1]}]")
        except (json.JSONDecodeError, RecursionError):
            whole = False  # one by one, until there is more text
            return []
        at = end + 1 + len(between)
        return found

    def next_char() -> str:
        """The next character that is no white space; empty at the end."""
        nonlocal at
        while True:
            while at < len(text) and text[at] in JSON_SPACE:
                at += 1
            if at < len(text):
                return text[at]
            if not more():
                return ""

    def value():
        nonlocal at
        while True:
            try:
                found, end = scan(text, at)
            except json.JSONDecodeError as error:
                cut = error.pos > len(text) - 16 or error.msg.startswith("Unterminated string")
                if not (cut and more()):
                    raise
                continue
            if end == len(text) and more():  # a number or word may go on
                continue
            at = end
            return found

    if not next_char():
        return
    if next_char() != "[":
        found = value()
        if not isinstance(found, dict):
            raise TypeError("neither an object nor an array of objects")
        yield found
    else:
        at += 1
        if next_char() == "]":
            at += 1
        else:
            between = ""
            while True:
                yield from run(between)
                next_char()
                yield value()
                ended_at = at
                follows = next_char()
                if follows not in (",", "]"):
                    raise json.JSONDecodeError("Expecting ',' delimiter", text, at)
                at += 1
                if follows == "]":
                    break
                next_char()
                if text[ended_at:at].strip(JSON_SPACE) == ",":  # not where more text has come
                    between = text[ended_at:at]
    if next_char():
        raise json.JSONDecodeError("Extra data", text, at)


# Ends of records that are tried to end a piece of JSON text, and bytes from which on any of them is taken.
PIECE_ENDS = 64
PIECE_LIMIT = 4 * JSON_CHUNK


def json_pieces(archive: zipfile.ZipFile, info: zipfile.ZipInfo, json_limit: int | None = None) -> Iterator[bytes | None]:
    """The text of a large array of objects in pieces of whole records, None at the end where it has to be read as a whole.

    Nothing is parsed but the first record, so a piece may end within a record, where objects are nested in one.
    What shows it is that this piece is no array of objects with brackets around it; if all pieces are, they hold
    just the records of the member, as each begins where the one before ended.
    """
    if read_of(info.filename) is not read_json or (json_limit is not None and info.file_size > json_limit):
        yield None
        return
    try:
        with archive.open(info) as stream:
            yield from _pieces(stream)
    except OSError:
        raise
    except Exception:  # read as a whole, it says what is wrong with it
        yield None


def _pieces(stream: BinaryIO) -> Iterator[bytes | None]:
    space = JSON_SPACE.encode()
    text = stream.read(JSON_CHUNK)
    if json.detect_encoding(text[:4]) != "utf-8" or not (body := text.lstrip(space)).startswith(b"["):
        yield None
        return
    shown = body[1:].lstrip(space).decode("utf-8", "ignore")  # a character may be cut at its end
    first, end = json.JSONDecoder().raw_decode(shown)
    between = re.match(r"[ \t\n\r]*,[ \t\n\r]*(?={)", shown[end:])
    if not isinstance(first, dict) or not first or between is None:
        yield None
        return
    between = between[0].encode()
    mark, text = b"}" + between + b"{", body[1:]
    while chunk := stream.read(JSON_CHUNK):
        text += chunk
        end = _piece_end(text, mark)
        if not end and len(text) > PIECE_LIMIT:
            end = text.rfind(mark) + 1
            if not end:
                yield None
                return
        if end:
            yield text[:end]
            text = text[end + len(between):]
    text = text.rstrip(space)
    yield text[:-1] if text.endswith(b"]") else None


def _piece_end(text: bytes, mark: bytes) -> int:
    """Where the last record of a text seems to end, as many brackets were closed as opened; 0 if nowhere."""
    codes = np.frombuffer(text, np.uint8)
    open_at = lambda start, stop: int(np.count_nonzero(codes[start:stop] == 123)) - int(np.count_nonzero(codes[start:stop] == 125))
    end = text.rfind(mark)
    depth = open_at(0, end + 1)
    for _ in range(PIECE_ENDS):
        if end < 0 or depth == 0:
            return end + 1
        before = text.rfind(mark, 0, end)
        depth -= open_at(before + 1, end + 1)
        end = before
    return 0


def parse_piece(text: bytes, notes: Notes, names: list[str]) -> Iterator[pa.Array]:
    """Records of a piece in structs, with the named keys only."""
    rows = json.JSONDecoder(parse_int=str, parse_float=str).decode(f"[{text.decode('utf-8', 'surrogatepass')}]")
    if not rows:
        raise ValueError("a piece without records")
    for some in json_batches(rows, names, notes):
        yield pa.array(some)


def json_batches(values: Iterator, names: list[str], notes: Notes | None = None) -> Iterator[list[dict]]:
    """Records in lists of bounded size, with the named keys only; other keys are counted."""
    known, rows, cells = set(names), [], 0
    for row in values:
        if not isinstance(row, dict):
            raise TypeError("a record is not an object")
        if not known.issuperset(row):
            if notes is not None:
                notes.dropped_keys += len(set(row) - known)
            row = {name: row[name] for name in names if name in row}
        rows.append(row)
        cells += 1 + len(row)
        if cells >= JSON_CHUNK // 64:
            yield rows
            rows, cells = [], 0
    if rows:
        yield rows


def common_type(a: pa.DataType, b: pa.DataType) -> pa.DataType:
    """The type of values of both types, as if all were converted at once."""
    if a.equals(b) or pa.types.is_null(b):
        return a
    if pa.types.is_null(a):
        return b
    if pa.types.is_struct(a) and pa.types.is_struct(b):
        names = sorted({f.name for f in (*a, *b)})
        parts = [[t.field(n).type for t in (a, b) if t.get_field_index(n) >= 0] for n in names]
        return pa.struct([pa.field(n, common_type(p[0], p[-1])) for n, p in zip(names, parts)])
    if pa.types.is_list(a) and pa.types.is_list(b):
        return pa.list_(common_type(a.value_type, b.value_type))
    raise pa.ArrowInvalid(f"cannot mix {a} and {b} in one column")


def read_json(archive: zipfile.ZipFile, info: zipfile.ZipInfo, notes: Notes, json_limit: int | None = None):
    """One object or an array of objects of any size, in bounded memory; numbers keep their source text.

    Columns are those of the first record, in its order; a record that lacks one has null
    there, and keys that the first record lacks are dropped and counted. A first pass finds
    the types of all columns; a member that is small (``JSON_HELD``) is parsed once only. ``json_limit``
    (bytes, None: none) makes larger members fail.
    """
    if json_limit is not None and info.file_size > json_limit:
        raise ValueError(f"JSON member is larger than {json_limit} bytes")
    with archive.open(info) as stream:
        values = json_values(stream)
        first = next(values, None)
        if not first and not any(values):
            raise Skipped("no record with data")
        if not isinstance(first, dict):
            raise TypeError("a record is not an object")
        names = list(first)
        kind, held, size = {name: pa.null() for name in names}, [], 0
        rest = itertools.chain([first], values) if names else ()
        for rows in json_batches(rest, names, notes):
            batch = pa.array(rows)
            kind = {name: common_type(kind[name], _field(batch.type, name)) for name in names}
            size += batch.nbytes
            held = [*held, batch] if size <= JSON_HELD else []
    if not names:
        with archive.open(info) as stream:
            for _ in json_batches(json_values(stream), names, notes):
                pass
    schema = pa.schema(list(kind.items()))

    def converted() -> Iterator[pa.RecordBatch]:
        if size <= JSON_HELD and all(batch.type.get_field_index(f.name) >= 0 and batch.type.field(f.name).type.equals(f.type) for batch in held for f in schema):
            yield from (_record_batch(batch, schema) for batch in held)
            return
        with archive.open(info) as stream:
            for rows in json_batches(json_values(stream), names):
                yield _record_batch(pa.array(rows, pa.struct(list(schema))), schema)

    return schema, converted() if names else iter(())


def _field(records: pa.DataType, name: str) -> pa.DataType:
    return records.field(name).type if records.get_field_index(name) >= 0 else pa.null()


def _record_batch(records: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([records.field(name) for name in schema.names], schema=schema)


# Extension point: extension -> reader.
READERS: dict[str, Callable] = {"csv": read_csv, "json": read_json}


def read_of(file_name: str) -> Callable | None:
    """The reader of a member with this name, None where there is none."""
    name = file_name.rsplit("/", 1)[-1]
    stem, dot, suffix = name.rpartition(".")
    return READERS.get(suffix.lower()) if dot and stem.strip(".") else None


def read_member(
    archive: zipfile.ZipFile, info: zipfile.ZipInfo, notes: Notes | None = None, json_limit: int | None = None
) -> tuple[pa.Schema, Iterator[pa.RecordBatch]]:
    """Schema and batches of a member; raises Skipped where there is nothing to load."""
    read = read_of(info.filename)
    if read is None:
        raise Skipped(f"unsupported file extension: {info.filename}")
    return read(archive, info, notes or Notes(), json_limit)
