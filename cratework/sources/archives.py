"""Landed ZIP archives as DataFrames: listing, members, rows, profiles.

The unit of work is a *split*: a run of members of one archive of about
``SPLIT_BYTES`` unpacked, or one larger member. A task takes neighbouring splits of
about ``TASK_BYTES``, or single ones while there are tasks to spare. So an archive with
thousands of members is read by many tasks, and one that holds a third of the data
does not hold up the others. Only the central directory is read to plan the splits.

A compressed member can only be unpacked from its start, but unpacking and parsing is
the fast part: of a member above ``LARGE_MEMBER`` one task passes on parsed blocks,
and many tasks turn them into rows and write them. JSON takes long to parse, so of such
a member one task only unpacks and cuts the text, and many tasks parse it.
"""

from __future__ import annotations

import contextlib
import json
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from cratework import files
from cratework import fixed_values as fixed
from cratework.functions import paths
from cratework.sources.readers import (
    CSV_BLOCK, Notes, Skipped, _field, _record_batch, common_type, json_pieces, parse_piece, read_member,
)
from cratework.staging import Staging, free_shuffles

SPLIT_BYTES = 32 * 1024 * 1024
SPLIT_MEMBERS = 1024
TASK_BYTES = 128 * 1024 * 1024
LARGE_MEMBER = 64 * 1024 * 1024
MAX_TASKS = 200_000

# Status of a row that stands for a member the optimistic read could not finish.
UNRESOLVED = "unresolved"
# Status of a row that says that keys of a good JSON member were dropped.
NOTED = "noted"

# Member outcomes beside valid and invalid.
SKIPPED_UNSUPPORTED = "skipped_unsupported"
SKIPPED_EMPTY = "skipped_empty"
FAILED = "failed"

# Archive columns that a split carries along.
CARRIED = (
    "landing_key",
    "source_name",
    "dataset_name",
    "ingest_date",
    "zip_file_name",
    "zip_name",
    "bronze_key",
)
SPLIT_SCHEMA = (
    "path string, split int, problem string, "
    "members array<struct<ordinal: int, member: string, size: bigint, repeated: boolean>>, "
    + ", ".join(f"{name} string" for name in CARRIED)
)
PROFILE_SCHEMA = (
    "path string, ordinal int, member string, outcome string, reason string, "
    "n_rows bigint, observed_schema string, dropped_keys bigint"
)
# Columns that each read row carries after its data columns.
ROUTING = ("_zip_file_name", "_source_file_name", "_schema_status", "ingest_date", "zip_name", "schema_status")


ZIP_FILES = "*.[zZ][iI][pP]"


def list_archives(spark: SparkSession, landing: str, dates: list[str] | None = None) -> DataFrame:
    """Landed archives with their keys; file contents are not read.

    With ``dates`` only those days' folders are listed, not the whole history.
    """
    root = files.qualify(spark, landing).rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ZIP_FILES)
    if dates is None:
        listing = reader.load(landing)
    else:
        days = [files.glob_text(files.partition_dir("ingest_date", date)) for date in dates]
        folders = [folder for day in days for folder in files.glob(spark, f"{root}/*/*/{day}")]
        if not folders:
            return describe_archives(spark.createDataFrame([], LISTING_SCHEMA), root)
        listing = reader.load(folders)
    return describe_archives(listing.select("path", "length", "modificationTime"), root)


LISTING_SCHEMA = "path string, length bigint, modificationTime timestamp"


def of_events(archives: DataFrame, events: DataFrame) -> DataFrame:
    """The archives that landing events (with a ``landing_key``) announce."""
    return archives.join(events.select("landing_key"), "landing_key", "left_semi")


def describe_archives(listing: DataFrame, root: str) -> DataFrame:
    """Add key columns to a file listing (batch or stream) below a landing root."""
    key = F.col("landing_key")
    return listing.withColumn("landing_key", F.substr("path", F.lit(len(root) + 2))).select(
        "path",
        "length",
        "modificationTime",
        "landing_key",
        paths.landing_part(key, "source_name").alias("source_name"),
        paths.landing_part(key, "dataset_name").alias("dataset_name"),
        paths.landing_part(key, "ingest_date").alias("ingest_date"),
        paths.base_name(key).alias("zip_file_name"),
        paths.landing_part(key, "zip_name").alias("zip_name"),
        paths.bronze_key(key).alias("bronze_key"),
    )


def plan_splits(archives: DataFrame) -> DataFrame:
    """Archives cut into splits; an unreadable archive gives one row with its problem."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{**row, **split} for row in batch.to_pylist() for split in _splits_of(row["path"])]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    arrow_schema = to_arrow_schema(T.StructType.fromDDL(SPLIT_SCHEMA))
    return archives.select("path", *CARRIED).mapInArrow(plan, SPLIT_SCHEMA)


def _splits_of(path: str) -> Iterator[dict]:
    try:
        with files.open_input(path) as handle, zipfile.ZipFile(handle) as archive:
            entries = archive.infolist()
    except (zipfile.BadZipFile, ValueError) as error:  # Arrow reports a bad seek as ValueError
        yield {"split": 0, "problem": str(error), "members": []}
        return
    number, size, members, seen = 0, 0, [], set()
    for ordinal, entry in enumerate(entries):
        if members and (size + entry.file_size > SPLIT_BYTES or len(members) == SPLIT_MEMBERS):
            yield {"split": number, "problem": None, "members": members}
            number, size, members = number + 1, 0, []
        name = entry.filename
        members.append({"ordinal": ordinal, "member": name, "size": entry.file_size, "repeated": name in seen})
        size += entry.file_size
        seen.add(name)
    yield {"split": number, "problem": None, "members": members}


def list_members(splits: DataFrame) -> DataFrame:
    """One row per member in archive order."""
    return splits.select("*", F.inline("members")).drop("members")


def regroup(members: DataFrame) -> DataFrame:
    """Splits of some of the members; a group is never larger than its split."""
    member = F.struct("ordinal", "member", "size", "repeated")
    return members.groupBy("path", "split", "problem", *CARRIED).agg(
        F.array_sort(F.collect_list(member)).alias("members")
    )


def spread(splits: DataFrame, count: int) -> DataFrame:
    """One split per task, as far as that is possible."""
    return splits.repartitionByRange(max(count, 1), "path", "split")


@contextlib.contextmanager
def _opened(path: str):
    with files.open_input(path) as handle, zipfile.ZipFile(handle) as archive:
        yield archive, archive.infolist()


def over_members(batches: Iterator[pa.RecordBatch], visit: Callable) -> Iterator[pa.RecordBatch]:
    """Open each split's archive once and visit its members in order."""
    for batch in batches:
        for row in batch.to_pylist():
            with _opened(row["path"]) as (archive, entries):
                for member in row["members"]:
                    yield from visit(row, member, archive, entries[member["ordinal"]])


def observe(archive: zipfile.ZipFile, info: zipfile.ZipInfo, notes: Notes, json_limit: int | None) -> Iterator[tuple]:
    """(schema, batch, problem) of a member; a problem ends it.

    A storage error (OSError) is not the member's fault: it fails the task, which
    Spark runs again.
    """
    try:
        schema, batches = read_member(archive, info, notes, json_limit)
        yield schema, None, None
        for batch in batches:
            yield schema, batch, None
    except OSError:
        raise
    except Exception as error:  # any parser error means: this member is bad
        yield None, None, error


def split_size() -> Column:
    return F.aggregate("members", F.lit(0).cast("bigint"), lambda acc, m: acc + m["size"])


def size_of_work() -> list[Column]:
    """Aggregates over splits that tell how many tasks a read needs; see ``read_members``."""
    large = split_size() > LARGE_MEMBER
    return [
        F.count_if(~large).alias("n_small"),
        F.sum(F.when(~large, split_size()).otherwise(0)).alias("small_bytes"),
        F.count_if(large).alias("n_large"),
        F.sum(F.when(large, split_size()).otherwise(0)).alias("large_bytes"),
        F.sum(F.when(large, F.size(F.filter("members", _large_json))).otherwise(0)).alias("n_large_json"),
    ]


def _large_json(member: Column) -> Column:
    return (member["size"] > LARGE_MEMBER) & F.lower(member["member"]).endswith(".json")


def read_members(
    splits: DataFrame, work, data_schema: T.StructType, status: str = fixed.VALID, json_limit: int | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Rows of every member that has exactly ``data_schema``, with routing columns.

    One pass over each member. A member that has another schema, holds no rows or
    breaks gives one row with null data and status ``unresolved``; if it breaks
    late, its earlier rows come out too, and the caller has to drop that archive. A member
    of which keys were dropped gives one more row, with status ``noted``.
    ``work`` is a row of ``size_of_work`` over these splits. With ``staging``, large JSON members are parsed
    by many tasks and their blocks kept there, to be let go by the caller once the rows are written.
    """
    spare = 2 * splits.sparkSession.sparkContext.defaultParallelism

    def tasks(size: int, pieces: int) -> int:
        return min(max(size // TASK_BYTES, spare), pieces, MAX_TASKS)

    small = spread(splits.where(split_size() <= LARGE_MEMBER), tasks(work.small_bytes, work.n_small))
    rows = read_rows(small, data_schema, status, json_limit)
    if not work.n_large:
        return rows
    large = splits.where(split_size() > LARGE_MEMBER)
    if staging is not None and work.n_large_json:
        n = min(max(work.large_bytes // TASK_BYTES, spare), MAX_TASKS)
        parsed, left = read_in_pieces(large, work.n_large_json, n, data_schema, json_limit, staging)
        rows = rows.unionByName(rows_of_blocks(parsed, data_schema, status))
        if left is None:
            return rows
        large = left
    blocks = cut_blocks(spread(large, work.n_large), data_schema, json_limit)
    # Neighbouring blocks go to one task, so that a member gives files of about a task's size.
    run = F.floor(F.col("block") / (TASK_BYTES // CSV_BLOCK))
    n = tasks(work.large_bytes, work.large_bytes // TASK_BYTES + work.n_large)
    return rows.unionByName(rows_of_blocks(blocks.repartition(n, "path", "member", run), data_schema, status))


def _row_schemas(data_schema: T.StructType) -> tuple[pa.Schema, pa.Schema, T.StructType]:
    """(expected data, data and routing, the same for Spark)."""
    expected = to_arrow_schema(data_schema)
    out = pa.schema([*expected, *(pa.field(name, pa.string()) for name in ROUTING)])
    return expected, out, T.StructType([*data_schema, *(T.StructField(name, T.StringType()) for name in ROUTING)])


def _routed(row: dict, member: str, state: str, columns: list, n: int, out: pa.Schema) -> pa.RecordBatch:
    labels = (row["zip_file_name"], member, state, row["ingest_date"], row["zip_name"], state)
    return pa.RecordBatch.from_arrays(
        [*columns, *(pa.repeat(pa.scalar(label, pa.string()), n) for label in labels)], schema=out
    )


def _marked(row: dict, member: str, state: str, expected: pa.Schema, out: pa.Schema) -> pa.RecordBatch:
    return _routed(row, member, state, [pa.nulls(1, field.type) for field in expected], 1, out)


def _matching(archive, info, expected: pa.Schema, json_limit: int | None) -> Iterator[pa.RecordBatch | str]:
    """Batches of a member with the expected schema; at the end its mark, if it gets one."""
    total, notes = 0, Notes()
    for schema, batch, problem in observe(archive, info, notes, json_limit):
        if problem is not None or not schema.equals(expected):
            yield UNRESOLVED
            return
        if batch is not None and batch.num_rows:
            total += batch.num_rows
            yield batch
    if not total:
        yield UNRESOLVED
    elif notes.dropped_keys:
        yield NOTED


def read_rows(
    splits: DataFrame, data_schema: T.StructType, status: str = fixed.VALID, json_limit: int | None = None
) -> DataFrame:
    """``read_members`` with each member read and passed on by one task."""
    expected, out, schema = _row_schemas(data_schema)

    def rows(row: dict, member: dict, archive, info) -> Iterator[pa.RecordBatch]:
        for batch in _matching(archive, info, expected, json_limit):
            if isinstance(batch, str):
                yield _marked(row, member["member"], batch, expected, out)
            else:
                yield _routed(row, member["member"], status, batch.columns, batch.num_rows, out)

    wanted = splits.select("path", "members", "zip_file_name", "ingest_date", "zip_name")
    return wanted.mapInArrow(lambda batches: over_members(batches, rows), schema)


BLOCK_SCHEMA = (
    "path string, member string, zip_file_name string, ingest_date string, zip_name string, "
    "block int, mark string, payload binary"
)


def cut_blocks(splits: DataFrame, data_schema: T.StructType, json_limit: int | None = None) -> DataFrame:
    """Parsed blocks of large members, a few MiB each; a block without payload is the member's mark."""
    expected = to_arrow_schema(data_schema)
    out = to_arrow_schema(T.StructType.fromDDL(BLOCK_SCHEMA))

    def blocks(row: dict, member: dict, archive, info) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(_matching(archive, info, expected, json_limit)):
            mark = batch if isinstance(batch, str) else None
            payload = None if mark else batch.serialize().to_pybytes()
            labels = (row["path"], member["member"], row["zip_file_name"], row["ingest_date"], row["zip_name"])
            yield pa.RecordBatch.from_pylist(
                [dict(zip(out.names, (*labels, number, mark, payload)))], schema=out
            )

    wanted = splits.select("path", "members", "zip_file_name", "ingest_date", "zip_name")
    return wanted.mapInArrow(lambda batches: over_members(batches, blocks), BLOCK_SCHEMA)


# Marks of pieces: the member has to be read as a whole; it has another schema.
WHOLE = "whole"
OTHER = "other"
PARSED_SCHEMA = BLOCK_SCHEMA + ", exact boolean, shape binary, dropped bigint"


def read_in_pieces(
    splits: DataFrame, n_members: int, n_tasks: int, data_schema: T.StructType, json_limit: int | None, staging: Staging
) -> tuple[DataFrame, DataFrame | None]:
    """(blocks as ``cut_blocks`` gives them of large JSON members, splits with what is left to read or None).

    One task for each member unpacks it and cuts its text into pieces, which others parse. What all pieces
    say together decides as one reader would: the columns are those of the first record, their types hold
    for all. A member of which a piece cannot be parsed is left to be read as a whole.
    """
    cut = splits.withColumn("members", F.filter("members", _large_json)).where(F.size("members") > 0)
    pieces = cut_pieces(spread(cut, n_members), json_limit).repartition(n_tasks, "path", "member", "block")
    parsed = staging.write(parse_pieces(pieces, data_schema), f"parsed-{uuid.uuid4().hex[:12]}")
    said = staging.write(_say_of_members(parsed, data_schema), f"said-{uuid.uuid4().hex[:12]}")
    free_shuffles(splits.sparkSession)
    states = {r["said"] for r in said.select("said").distinct().collect()}
    names = [f.name for f in T.StructType.fromDDL(BLOCK_SCHEMA)]
    good = parsed.where("payload is not null").select(*names)
    if states != {fixed.VALID}:
        good = good.join(said.where(F.col("said").isin(fixed.VALID, NOTED)).select("path", "member"), ["path", "member"], "left_semi")
        marks = said.where(F.col("said").isin(UNRESOLVED, NOTED))
        good = good.select(*names).unionByName(
            marks.select(*names[:5], F.lit(0).alias("block"), F.col("said").alias("mark"), F.lit(None).cast("binary").alias("payload"))
        )
    if WHOLE in states:
        found = said.where(F.col("said") == WHOLE).groupBy("path").agg(F.collect_set("member").alias("whole"))
        whole = F.coalesce("whole", F.array().cast("array<string>"))
        again = F.filter("members", lambda m: ~_large_json(m) | F.array_contains(whole, m["member"]))
        left = splits.join(found, "path", "left").withColumn("members", again).drop("whole")
    else:
        left = splits.withColumn("members", F.filter("members", lambda m: ~_large_json(m)))
    left = left.where(F.size("members") > 0)
    return good, left if left.head(1) else None


def cut_pieces(splits: DataFrame, json_limit: int | None = None) -> DataFrame:
    """Texts of JSON members in pieces of a few MiB, in ``payload``; ``mark`` says that a member has to be read as a whole."""
    out = to_arrow_schema(T.StructType.fromDDL(BLOCK_SCHEMA))

    def pieces(row: dict, member: dict, archive, info) -> Iterator[pa.RecordBatch]:
        labels = (row["path"], member["member"], row["zip_file_name"], row["ingest_date"], row["zip_name"])
        for number, text in enumerate(json_pieces(archive, info, json_limit)):
            mark = WHOLE if text is None else None
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, (*labels, number, mark, text)))], schema=out)

    wanted = splits.select("path", "members", "zip_file_name", "ingest_date", "zip_name")
    return wanted.mapInArrow(lambda batches: over_members(batches, pieces), BLOCK_SCHEMA)


def parse_pieces(pieces: DataFrame, data_schema: T.StructType) -> DataFrame:
    """Blocks of pieces of text, and what each piece says of its member's schema.

    ``exact``: a block has just the expected types; ``shape``: its types, where they are others that
    the expected ones can hold.
    """
    expected = to_arrow_schema(data_schema)
    out = to_arrow_schema(T.StructType.fromDDL(PARSED_SCHEMA))
    n_labels = len(T.StructType.fromDDL(BLOCK_SCHEMA)) - 2

    def parsed(labels: list, block: int, text: bytes) -> list[dict]:
        def row(mark=None, payload=None, exact=None, shape=None, dropped=0):
            return dict(zip(out.names, (*labels, mark, payload, exact, shape, dropped)))

        notes, found = Notes(), []
        try:
            if not block:
                first, _ = json.JSONDecoder().raw_decode(text.decode("utf-8", "surrogatepass").lstrip())
                if list(first) != expected.names:
                    return [row(OTHER)]
            for records in parse_piece(text, notes, expected.names):
                own = pa.schema([pa.field(n, _field(records.type, n)) for n in expected.names])
                exact, shape = own.equals(expected), None
                if not exact:
                    if not all(_holds(e.type, f.type) for e, f in zip(expected, own)):
                        return [row(OTHER)]
                    shape = own.serialize().to_pybytes()
                    records = pa.array(records.to_pylist(), pa.struct(list(expected)))
                found.append(row(None, _record_batch(records, expected).serialize().to_pybytes(), exact, shape))
        except Exception:  # read as a whole, the member says what is wrong with it
            return [row(WHOLE)]
        found[-1]["dropped"] = notes.dropped_keys
        return found

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                labels = [batch.column(c)[i].as_py() for c in range(n_labels)]
                mark = batch.column("mark")[i].as_py()
                if mark is not None:
                    found = [dict(zip(out.names, (*labels, mark, None, None, None, 0)))]
                else:
                    found = parsed(labels, labels[-1], batch.column("payload")[i].as_py())
                yield pa.RecordBatch.from_pylist(found, schema=out)

    return pieces.mapInArrow(rows, PARSED_SCHEMA)


def _holds(expected: pa.DataType, own: pa.DataType) -> bool:
    """Whether values of a type become the expected one when they meet."""
    try:
        return common_type(expected, own).equals(expected)
    except pa.ArrowInvalid:
        return False


def _say_of_members(parsed: DataFrame, data_schema: T.StructType) -> DataFrame:
    """What all pieces of a member say together: valid, noted, unresolved or whole."""
    expected = to_arrow_schema(data_schema)
    labels = [f.name for f in T.StructType.fromDDL(BLOCK_SCHEMA)][:5]
    shaped = F.when(~F.col("exact"), F.col("shape"))
    per_member = parsed.groupBy(*labels).agg(
        F.coalesce(F.bool_or(F.col("mark") == OTHER), F.lit(False)).alias("other"),
        F.coalesce(F.bool_or(F.col("mark") == WHOLE), F.lit(False)).alias("whole"),
        F.coalesce(F.bool_or("exact"), F.lit(False)).alias("exact"),
        F.collect_set(shaped).alias("shapes"),
        F.sum("dropped").alias("dropped"),
    )
    schema = ", ".join(f"{name} string" for name in (*labels, "said"))
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def say(row: dict) -> str:
        if row["other"]:
            return UNRESOLVED
        if row["whole"]:
            return WHOLE
        kinds = [pa.null()] * len(expected)
        for shape in [] if row["exact"] else row["shapes"]:
            kinds = [common_type(a, f.type) for a, f in zip(kinds, pa.ipc.read_schema(pa.py_buffer(shape)))]
        if not row["exact"] and not all(k.equals(e.type) for k, e in zip(kinds, expected)):
            return UNRESOLVED
        return NOTED if row["dropped"] else fixed.VALID

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{**{n: row[n] for n in labels}, "said": say(row)} for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(found, schema=out)

    return per_member.mapInArrow(rows, schema)


def rows_of_blocks(blocks: DataFrame, data_schema: T.StructType, status: str = fixed.VALID) -> DataFrame:
    """Rows of parsed blocks, as ``read_rows`` gives them."""
    expected, out, schema = _row_schemas(data_schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed in batches:
            for i in range(packed.num_rows):
                row = {name: packed.column(name)[i].as_py() for name in out_of_block}
                payload = packed.column("payload")[i]
                if not payload.is_valid:
                    yield _marked(row, row["member"], packed.column("mark")[i].as_py(), expected, out)
                    continue
                batch = pa.ipc.read_record_batch(payload.as_buffer(), expected)
                yield _routed(row, row["member"], status, batch.columns, batch.num_rows, out)

    out_of_block = ("member", "zip_file_name", "ingest_date", "zip_name")
    return blocks.mapInArrow(rows, schema)


def profile_members(splits: DataFrame, schemas: dict[str, T.StructType], json_limit: int | None = None) -> DataFrame:
    """Outcome, row count, observed schema and dropped JSON keys of each member, by a full parse."""
    expected = {name: to_arrow_schema(schema) for name, schema in schemas.items()}
    out = to_arrow_schema(T.StructType.fromDDL(PROFILE_SCHEMA))

    def rows(row: dict, member: dict, archive, info) -> Iterator[pa.RecordBatch]:
        observed, n_rows, outcome, reason, notes = None, 0, None, None, Notes()
        for schema, batch, problem in observe(archive, info, notes, json_limit):
            if isinstance(problem, Skipped):
                reason = str(problem)
                unsupported = reason.startswith("unsupported")
                outcome = SKIPPED_UNSUPPORTED if unsupported else SKIPPED_EMPTY
            elif problem is not None:
                outcome, reason, n_rows = FAILED, f"{type(problem).__name__}: {problem}", 0
            else:
                observed = schema
                n_rows += batch.num_rows if batch is not None else 0
        if outcome is None:
            same = observed.equals(expected[row["dataset_name"]])
            outcome = fixed.VALID if same else fixed.INVALID
        shape = None if observed is None else schema_text(observed)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "path": row["path"],
                    "ordinal": member["ordinal"],
                    "member": member["member"],
                    "outcome": outcome,
                    "reason": reason,
                    "n_rows": n_rows,
                    "observed_schema": shape,
                    "dropped_keys": notes.dropped_keys,
                }
            ],
            schema=out,
        )

    wanted = splits.select("path", "members", "dataset_name")
    return wanted.mapInArrow(lambda batches: over_members(batches, rows), PROFILE_SCHEMA)


def schema_text(schema: pa.Schema) -> str:
    """A schema as JSON text; an Arrow schema may repeat names, so may the text."""
    return from_arrow_schema(schema).json()
