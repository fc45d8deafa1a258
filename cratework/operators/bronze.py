"""Bronze: archive rows as partitioned Parquet, one completion marker per archive.

Each member is unpacked once: ``load_archives`` reads every member under its
dataset's expected schema and writes the rows at once. Members that do not match,
hold no rows or break leave one ``unresolved`` row, and only those are read again
to find out why. Archives with a broken member lose all output and get no marker;
the others are marked when everything else is done. Readers trust the marker only,
so nobody sees an unfinished archive.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework import files
from cratework import fixed_values as fixed
from cratework.functions import paths
from cratework.operators import contract
from cratework.sources import archives as zips
from cratework.staging import Staging

# Archive outcomes in the ledger.
COMPLETE = "complete"
EMPTY = "empty"
FAILED = "failed"
FAILED_NO_SCHEMA = "failed_no_schema"
FAILED_BAD_KEY = "failed_bad_key"
FAILED_KEY_COLLISION = "failed_key_collision"

LEDGER = "run_ledger"
MANIFEST = "member_manifest"
QUARANTINE = "quarantine"
PARTITIONS = ("ingest_date", "zip_name", "schema_status")
SIDE_BY_SIDE = 4
# Up to so many archives without marker are named in a filter.
FEW_UNFINISHED = 64

MANIFEST_COLUMNS = (
    "path",
    *zips.CARRIED,
    "ordinal",
    "member",
    "outcome",
    "reason",
    "n_rows",
    "observed_schema",
    "dropped_keys",
)


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Append columns after the present ones, in the given order."""
    return df.withColumns(columns)


def processed_at(moment: dt.datetime) -> Column:
    """One instant per run, cut to milliseconds."""
    whole = moment.astimezone(dt.timezone.utc)
    return F.lit(whole.replace(microsecond=whole.microsecond // 1000 * 1000))


def with_lineage(
    rows: DataFrame, run_id: str, moment: dt.datetime, file_name: bool = True, schema_status: bool = True
) -> DataFrame:
    """Data columns, then the lineage columns in their fixed order, then the partition columns.

    The last two lineage columns can be left out.
    """
    data = [c for c in rows.columns if c not in zips.ROUTING]
    wanted = {"_source_file_name": file_name, "_schema_status": schema_status}
    lineage = [c for c in fixed.LINEAGE_COLUMNS if wanted.get(c, True)]
    run = {"_bronze_processed_at": processed_at(moment), "_dag_run_id": F.lit(run_id)}
    return add_columns(rows, run).select(*data, *lineage, *PARTITIONS)


def write_rows(rows: DataFrame, folder: str) -> None:
    (
        rows.write.mode("append")
        .partitionBy(*PARTITIONS)
        .option("maxRecordsPerFile", fixed.MAX_ROWS_PER_FILE)
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .parquet(folder)
    )


def archive_folder(bronze: str, row: dict) -> str:
    """Folder of one archive's output, as the Parquet writer names it."""
    return "/".join(
        [
            bronze.rstrip("/"),
            row["source_name"],
            row["dataset_name"],
            files.partition_dir("ingest_date", row["ingest_date"]),
            files.partition_dir("zip_name", row["zip_name"]),
        ]
    )


ARCHIVE_ID = ("source_name", "dataset_name", "ingest_date", "zip_name")


def clean_archives(archives: DataFrame, bronze: str) -> int:
    """Delete all output of the archives, each one's marker first; siblings stay."""

    def clean(row: dict) -> None:
        folder = archive_folder(bronze, row)
        marker = f"{folder}/{fixed.SUCCESS_MARKER}"
        if files.size_of(marker) is not None:
            files.delete_file(marker)
        files.delete_tree(folder)

    return files.each_row(archives.select(*ARCHIVE_ID), clean)


def mark_complete(archives: DataFrame, bronze: str) -> int:
    """Write the zero-byte marker of each archive."""

    def mark(row: dict) -> None:
        files.open_output(f"{archive_folder(bronze, row)}/{fixed.SUCCESS_MARKER}").close()

    return files.each_row(archives.select(*ARCHIVE_ID), mark)


def drop_marks(archives: DataFrame, bronze: str) -> int:
    """Delete the rows that stood for members still to be profiled."""

    def drop(row: dict) -> None:
        for state in (zips.UNRESOLVED, zips.NOTED):
            files.delete_tree(f"{archive_folder(bronze, row)}/schema_status={state}")

    return files.each_row(archives.select(*ARCHIVE_ID).distinct(), drop)


def last_attempts(ledger: DataFrame) -> DataFrame:
    """The ledger's last row of every archive path."""
    others = [c for c in ledger.columns if c != "path"]
    last = ledger.groupBy("path").agg(F.max_by(F.struct(*others), "attempt").alias("last"))
    return last.select("path", "last.*")


def gate_archives(archives: DataFrame, schemas: dict[str, T.StructType], ledger: DataFrame | None = None) -> DataFrame:
    """Archives with a refusal for those that must not be touched at all.

    Two archives with one bronze key would replace each other's output, in one batch or
    one after the other; the later ones are refused as long as the first is complete.
    """
    same_key = archives.groupBy("bronze_key").agg(F.count("*").alias("same_key"))
    gated = archives.join(same_key, "bronze_key", "left")
    taken = F.lit(None).cast("string")
    if ledger is not None:
        owners = last_attempts(ledger).where(F.col("status") == COMPLETE).groupBy("bronze_key")
        gated = gated.join(owners.agg(F.min("path").alias("owner")), "bronze_key", "left")
        taken = F.when(F.col("owner") != F.col("path"), F.col("owner"))
    else:
        gated = gated.withColumn("owner", taken)
    refusal = (
        F.when(F.col("bronze_key").isNull(), FAILED_BAD_KEY)
        .when(~F.col("dataset_name").isin(*schemas), FAILED_NO_SCHEMA)
        .when((F.col("same_key") > 1) | taken.isNotNull(), FAILED_KEY_COLLISION)
    )
    return gated.withColumn("refusal", refusal).drop("same_key", "owner")


def new_attempt() -> str:
    """A unique name for one load; names sort by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def load_archives(
    archives: DataFrame,
    bronze: str,
    schemas: dict[str, T.StructType],
    run_id: str,
    moment: dt.datetime | None = None,
    json_limit: int | None = None,
) -> DataFrame:
    """Load a batch of landed archives; returns this load's ledger, one row per archive.

    Every load adds its rows to ledger and manifest under an attempt of its own, whatever
    its run id. ``json_limit``: JSON members of more bytes make their archive fail (None: no limit).
    """
    spark = archives.sparkSession
    bronze = bronze.rstrip("/")
    run = f"{bronze}/{{}}/{files.partition_dir('run_id', run_id)}/attempt={new_attempt()}"
    lineage = functools.partial(
        with_lineage, run_id=run_id, moment=moment or dt.datetime.now(dt.timezone.utc)
    )

    gated = gate_archives(archives, schemas, current_ledger(spark, bronze)).persist()
    accepted = gated.where("refusal is null")
    splits = zips.plan_splits(accepted).persist()
    readable = splits.where("problem is null")
    staging = Staging(spark, "pieces")
    try:
        datasets = (
            splits.groupBy("source_name", "dataset_name")
            .agg(*zips.size_of_work(), F.collect_set("ingest_date").alias("dates"))
            .collect()
        )
        clean_archives(accepted, bronze)

        def load_dataset(dataset: Row) -> None:
            mine = _of_dataset(readable, dataset)
            rows = zips.read_members(mine, dataset, schemas[dataset.dataset_name], json_limit=json_limit, staging=staging)
            write_rows(lineage(rows), f"{bronze}/{dataset.source_name}/{dataset.dataset_name}")

        side_by_side(load_dataset, datasets)
        manifest, doubtful = _write_manifest(readable, bronze, schemas, datasets, run.format(MANIFEST), json_limit)
        if doubtful:
            _load_invalid(readable, manifest, bronze, run_id, lineage.keywords["moment"], run.format(QUARANTINE), json_limit)
        summary = archive_summary(gated, splits, manifest).persist()
        if doubtful or summary.where(F.col("status").isin(FAILED, EMPTY)).head(1):
            clean_archives(summary.where(F.col("status").isin(FAILED, EMPTY)), bronze)
        mark_complete(summary.where(F.col("status") == COMPLETE), bronze)
        summary.write.parquet(run.format(LEDGER))
        summary.unpersist()
    finally:
        staging.drop()
        splits.unpersist()
        gated.unpersist()
    return spark.read.parquet(run.format(LEDGER))


def side_by_side(job, items: list) -> None:
    """Run a Spark job per item, a few at once, so that a small one does not wait for a large one."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        list(pool.map(job, items))


def _of_dataset(df: DataFrame, key: Row) -> DataFrame:
    return df.where((F.col("source_name") == key.source_name) & (F.col("dataset_name") == key.dataset_name))


QUARANTINE_SCHEMA = (
    "path string, source_name string, dataset_name string, ingest_date string, zip_file_name string, "
    "member string, ordinal int, row_no bigint, row_json string, file string"
)


def _load_invalid(
    readable: DataFrame, manifest: DataFrame, bronze: str, run_id: str, moment: dt.datetime, folder: str,
    json_limit: int | None,
) -> None:
    """Put mismatching members into quarantine: one job, whatever shapes they have.

    Each member's rows go into Parquet files of its own shape, and as JSON text into one
    table for all, which also says what file each row is in. Every attempt of a task writes files
    of its own; those that the table does not name are deleted.
    """
    failed = manifest.where(F.col("outcome") == zips.FAILED).select("path").distinct()
    invalid = manifest.join(failed, "path", "left_anti").where(
        (F.col("outcome") == fixed.INVALID) & (F.col("n_rows") > 0)
    )
    members = zips.list_members(readable).join(invalid.select("path", "ordinal"), ["path", "ordinal"], "left_semi")
    splits = zips.regroup(members).persist()
    try:
        work = splits.agg(*zips.size_of_work()).first()
        spread = zips.spread(splits, min(work.n_small + work.n_large, zips.MAX_TASKS))
        quarantine_members(spread, bronze, run_id, moment, json_limit).write.parquet(folder)
    finally:
        splits.unpersist()
    _drop_uncounted(members.sparkSession, folder)


def _drop_uncounted(spark: SparkSession, folder: str) -> None:
    """Delete quarantine files of attempts that did not count, next to those that did."""
    place = F.regexp_extract("file", r"(?s)^(.*)/([^/]*)$", 1).alias("place")
    name = F.regexp_extract("file", r"(?s)^(.*)/([^/]*)$", 2).alias("name")
    counted = spark.read.parquet(folder).groupBy("file").agg(F.count("*").alias("n")).select(place, name)

    def drop(row: dict) -> None:
        for found, is_folder in files.list_names(row["place"]):
            if not is_folder and found not in row["names"]:
                files.delete_file(f"{row['place']}/{found}")

    # The files of one archive's invalid members: one for each member and MAX_ROWS_PER_FILE rows.
    files.each_row(counted.groupBy("place").agg(F.collect_set("name").alias("names")), drop)


def quarantine_members(
    splits: DataFrame, bronze: str, run_id: str, moment: dt.datetime, json_limit: int | None = None
) -> DataFrame:
    """Rows as JSON text, with the members' own files written on the way."""
    reserved = tuple(name.lower() for name in (*fixed.LINEAGE_COLUMNS, *PARTITIONS))
    when = moment.astimezone(dt.timezone.utc)
    when = when.replace(microsecond=when.microsecond // 1000 * 1000)
    names = [f.name for f in T.StructType.fromDDL(QUARANTINE_SCHEMA)]
    stamp = pa.timestamp("us", "UTC")
    labels = [("_bronze_processed_at", stamp), *((n, pa.string()) for n in fixed.LINEAGE_COLUMNS[1:])]

    def rows(row: dict, member: dict, archive, info) -> Iterator[pa.RecordBatch]:
        folder = f"{archive_folder(bronze, row)}/schema_status={fixed.INVALID}"
        lineage = (when, run_id, row["zip_file_name"], member["member"], fixed.INVALID)
        writer, shape, as_table, number, part, attempt, file = None, None, True, 0, 0, uuid.uuid4().hex[:12], None
        try:
            for schema, batch, _ in zips.observe(archive, info, zips.Notes(), json_limit):
                if batch is None or not batch.num_rows:
                    continue
                as_table = contract.fits_a_table(zips.schema_text(schema), reserved)
                texts = list(_json_rows(schema.names, batch, as_table))
                numbers = pa.array(range(number, number + len(texts)), pa.int64())
                data, fields = batch.columns, list(schema)
                if not as_table:  # clashing names cannot be columns
                    data, fields = [numbers, pa.array(texts)], [pa.field("row_no", pa.int64()), pa.field("row_json", pa.string())]
                if writer is None or number - part >= fixed.MAX_ROWS_PER_FILE:
                    if writer is not None:
                        writer.close()
                    shape, part = pa.schema([*fields, *labels]), number
                    file = f"{folder}/member-{member['ordinal']}-{part}-{attempt}.parquet"
                    writer = pq.ParquetWriter(files.open_output(file), shape)
                marks = [pa.repeat(pa.scalar(v, t), len(texts)) for v, (_, t) in zip(lineage, labels)]
                writer.write_batch(pa.RecordBatch.from_arrays([*data, *marks], schema=shape))
                own = (row["path"], row["source_name"], row["dataset_name"], row["ingest_date"], row["zip_file_name"], member["member"])
                columns = [pa.repeat(pa.scalar(v, pa.string()), len(texts)) for v in own]
                columns += [pa.repeat(pa.scalar(member["ordinal"], pa.int32()), len(texts)), numbers, pa.array(texts, pa.string())]
                columns.append(pa.repeat(pa.scalar(file, pa.string()), len(texts)))
                yield pa.RecordBatch.from_arrays(columns, names)
                number += len(texts)
        finally:
            if writer is not None:
                writer.close()

    return splits.mapInArrow(lambda batches: zips.over_members(batches, rows), QUARANTINE_SCHEMA)


def _json_rows(names: list[str], batch: pa.RecordBatch, as_table: bool) -> Iterator[str]:
    """Each row as JSON text: an object, or (names clash) a list of names and values."""
    for cells in zip(*(column.to_pylist() for column in batch.columns)):
        pairs = zip(names, cells)
        shown = dict(pairs) if as_table else [{"name": n, "value": v} for n, v in pairs]
        yield json.dumps(shown, ensure_ascii=False, separators=(",", ":") if as_table else None)


def _status_rows(
    spark: SparkSession, base: str, dates: list[str] | None, columns: str | T.StructType, status: list[str]
) -> DataFrame | None:
    """Rows with these schema statuses below a dataset's folder; None if no folder of the dates is there.

    Whole days are listed (in parallel, by Spark) and partition filters pick the files.
    """
    days = [f"{base}/{files.glob_text(files.partition_dir('ingest_date', d))}" for d in dates] if dates else [base]
    folders = [folder for day in days for folder in files.glob(spark, day)]
    if not folders:
        return None
    rows = spark.read.schema(columns).option("basePath", base).parquet(*folders)
    return rows.where(F.col("schema_status").isin(status))


def _written_members(spark: SparkSession, bronze: str, datasets: list[Row], status: list[str]) -> DataFrame | None:
    """Archive and member of every row written with these schema statuses, for the dates of a run."""
    columns = "_source_file_name string, ingest_date string, zip_name string, schema_status string"
    found = []
    for dataset in datasets:
        base = f"{bronze}/{dataset.source_name}/{dataset.dataset_name}"
        rows = _status_rows(spark, base, dataset.dates, columns, status)
        if rows is not None:
            found.append(
                rows.select(
                    F.lit(dataset.source_name).alias("source_name"),
                    F.lit(dataset.dataset_name).alias("dataset_name"),
                    "ingest_date",
                    "zip_name",
                    F.col("_source_file_name").alias("member"),
                )
            )
    return functools.reduce(DataFrame.unionByName, found) if found else None


def _write_manifest(readable, bronze, schemas, datasets, folder, json_limit) -> tuple[DataFrame, bool]:
    """One row per member: good ones are counted in the written rows, the others profiled."""
    spark = readable.sparkSession
    member_id = [*ARCHIVE_ID, "member"]
    manifest = zips.list_members(readable)

    # Earlier loads of the same days left rows too; only this load's archives are counted.
    own = readable.select(*ARCHIVE_ID).distinct()
    valid = _written_members(spark, bronze, datasets, [fixed.VALID])
    if valid is not None:
        valid = valid.join(own, [*ARCHIVE_ID], "left_semi")
        manifest = manifest.join(valid.groupBy(*member_id).agg(F.count("*").alias("n_written")), member_id, "left")
    else:
        manifest = manifest.withColumn("n_written", F.lit(None).cast("bigint"))

    unresolved = _written_members(spark, bronze, datasets, [zips.UNRESOLVED, zips.NOTED])
    n_unresolved = 0
    if unresolved is not None:
        unresolved = unresolved.distinct().persist()
        n_unresolved = unresolved.count()
    if n_unresolved:
        doubtful = zips.list_members(readable).join(unresolved, member_id, "left_semi")
        profiles = zips.profile_members(zips.spread(zips.regroup(doubtful), min(n_unresolved, zips.MAX_TASKS)), schemas, json_limit)
        manifest = manifest.join(profiles.drop("member"), ["path", "ordinal"], "left")
    else:
        nothing = {"outcome": "string", "reason": "string", "n_rows": "bigint"}
        nothing |= {"observed_schema": "string", "dropped_keys": "bigint"}
        manifest = manifest.withColumns({name: F.lit(None).cast(kind) for name, kind in nothing.items()})

    known = F.col("outcome").isNotNull()
    expected = F.create_map(*[F.lit(text) for key, s in schemas.items() for text in (key, s.json())])
    written = F.when(F.col("repeated"), F.lit(0)).otherwise(F.col("n_written"))
    filled = {
        "n_rows": F.when(known, F.col("n_rows")).otherwise(written),
        "observed_schema": F.when(known, F.col("observed_schema")).otherwise(
            F.element_at(expected, F.col("dataset_name"))
        ),
        "outcome": F.coalesce("outcome", F.lit(fixed.VALID)),
        "dropped_keys": F.coalesce("dropped_keys", F.lit(0)).cast("bigint"),
    }
    manifest.withColumns(filled).select(*MANIFEST_COLUMNS).write.parquet(folder)
    if n_unresolved:
        drop_marks(unresolved, bronze)
    if unresolved is not None:
        unresolved.unpersist()
    return spark.read.parquet(folder), n_unresolved > 0


def archive_summary(gated: DataFrame, splits: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per archive: member counts, rows, status and the first problem."""
    uploaded = F.col("outcome").isin(fixed.VALID, fixed.INVALID)
    per_archive = manifest.groupBy("path").agg(
        F.count("*").alias("members"),
        F.count_if(uploaded).alias("uploaded"),
        F.count_if(F.col("outcome") == fixed.INVALID).alias("invalid"),
        F.count_if(F.col("outcome") == zips.FAILED).alias("failed"),
        F.sum(F.when(uploaded, F.col("n_rows")).otherwise(0)).alias("n_rows"),
        F.min_by("reason", F.when(F.col("outcome") == zips.FAILED, F.col("ordinal"))).alias("problem"),
    )
    unreadable = splits.where("problem is not null").select("path", F.col("problem").alias("unreadable"))
    failed = F.col("unreadable").isNotNull() | (F.col("failed") > 0)
    status = (
        F.when(F.col("refusal").isNotNull(), F.col("refusal"))
        .when(failed, FAILED)
        .when(F.col("uploaded") > 0, COMPLETE)
        .otherwise(EMPTY)
    )
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("members", "uploaded", "invalid", "failed", "n_rows")}
    return (
        gated.join(per_archive, "path", "left")
        .join(unreadable, "path", "left")
        .withColumns({"status": status, "problem": F.coalesce("unreadable", "problem"), **counts})
        .drop("refusal", "unreadable")
    )


def invalid_schema_report(manifest: DataFrame, bronze: str) -> DataFrame:
    """Per archive with mismatching members: their names and where their rows are.

    The name list is one text per archive, as long as its central directory at most.
    """
    listed = manifest.where((F.col("outcome") == fixed.INVALID) & (F.col("n_rows") > 0))
    location = F.concat(
        F.lit(f"{bronze}/"),
        paths.schema_status_key(F.col("landing_key"), F.lit(fixed.INVALID)),
        F.lit("/"),
    )
    return (
        listed.groupBy("landing_key")
        .agg(F.array_sort(F.collect_set(paths.flat_member_name(F.col("member")))).alias("names"))
        .select(
            "landing_key",
            F.concat_ws(", ", "names").alias("file_names"),
            location.alias("location"),
            paths.fill(fixed.INVALID_FILES_SUBJECT, landing_key=F.col("landing_key")).alias("subject"),
            paths.fill(fixed.INVALID_FILES, names=F.concat_ws(", ", "names"), location=location).alias("body"),
        )
    )


def read_manifest(spark: SparkSession, bronze: str, run_id: str) -> DataFrame:
    """The members of a run's archives, of each archive as its last load left them."""
    rows = spark.read.parquet(f"{bronze}/{MANIFEST}/{files.partition_dir('run_id', run_id)}")
    last = rows.groupBy("path").agg(F.max("attempt").alias("attempt"))
    return rows.join(last, ["path", "attempt"]).select(*MANIFEST_COLUMNS)


HISTORY = "ledger_history"
STATE = "ledger_state"


def _loose_attempts(spark: SparkSession, bronze: str) -> DataFrame | None:
    if not files.glob(spark, f"{bronze}/{LEDGER}/run_id=*/attempt=*/_SUCCESS"):
        return None
    return spark.read.option("basePath", f"{bronze}/{LEDGER}").parquet(f"{bronze}/{LEDGER}/run_id=*/attempt=*")


def _compacted(spark: SparkSession, bronze: str, name: str) -> DataFrame | None:
    """The newest finished version of a compacted table."""
    done = files.glob(spark, f"{bronze}/{name}/version=*/_SUCCESS")
    return spark.read.parquet(done[-1].rsplit("/", 1)[0]) if done else None


def read_ledger(spark: SparkSession, bronze: str) -> DataFrame | None:
    """All loads' ledger rows with run_id and attempt, None before the first."""
    loose, history = _loose_attempts(spark, bronze), _compacted(spark, bronze, HISTORY)
    if loose is None or history is None:
        return history if loose is None else loose
    # A compaction that died may have left attempts in both places.
    return history.unionByName(loose.join(history.select("path", "attempt"), ["path", "attempt"], "left_anti"))


def current_ledger(spark: SparkSession, bronze: str) -> DataFrame | None:
    """The last ledger row of every archive: the compacted state and the attempts since, not all history."""
    loose, state = _loose_attempts(spark, bronze), _compacted(spark, bronze, STATE)
    if loose is None or state is None:
        return state if loose is None else last_attempts(loose)
    return last_attempts(state.unionByName(loose))


def compact_ledger(spark: SparkSession, bronze: str) -> int:
    """Fold the attempts so far into one history and one state table; returns how many were folded.

    To be run while no load is. Both tables are new versions, finished before any attempt's own
    folder goes, so a job that dies leaves rows twice, which readers see once.
    """
    loose = _loose_attempts(spark, bronze)
    if loose is None:
        return 0
    version = f"version={new_attempt()}"
    old = {name: files.glob(spark, f"{bronze}/{name}/version=*") for name in (HISTORY, STATE)}
    names = ["path", *[c for c in loose.columns if c != "path"]]
    read_ledger(spark, bronze).select(*names).write.parquet(f"{bronze}/{HISTORY}/{version}")
    current_ledger(spark, bronze).select(*names).write.parquet(f"{bronze}/{STATE}/{version}")
    folded = files.glob(spark, f"{bronze}/{LEDGER}/run_id=*/attempt=*")
    gone = spark.createDataFrame([(f,) for f in [*folded, *old[HISTORY], *old[STATE]]], "folder string")
    files.each_row(gone, lambda row: files.delete_tree(row["folder"]))
    return len(folded)


def pending_archives(archives: DataFrame, ledger: DataFrame | None, bronze: str | None = None) -> DataFrame:
    """Archives not loaded yet in this very version: path, length and time identify a delivery.

    The last load of a path decides. A re-landed file has another time and comes again;
    failed ones come again too, and, with ``bronze``, complete ones whose marker is gone
    (a later load died half-way).
    """
    if ledger is None:
        return archives
    version = ["path", "length", "modificationTime"]
    done = last_attempts(ledger).where(F.col("status").isin(COMPLETE, EMPTY)).select(*version, F.col("status").alias("done"))
    known = archives.join(done, version, "left")
    pending = known.where("done is null").select(*archives.columns)
    if bronze is None:
        return pending

    def without_marker(batches):
        for batch in batches:
            marks = [f"{archive_folder(bronze, row)}/{fixed.SUCCESS_MARKER}" for row in batch.to_dict("records")]
            yield batch[[files.size_of(m) is None for m in marks]]

    loaded = known.where(F.col("done") == COMPLETE).select("path", *ARCHIVE_ID)
    unmarked = loaded.mapInPandas(without_marker, loaded.schema).select("path")
    return pending.unionByName(archives.join(unmarked, "path", "left_semi"))


def unfinished_archives(spark: SparkSession, base: str, dates: list[str] | None = None) -> DataFrame:
    """(ingest_date, zip_name) of archives without a marker: failed or running loads.

    The driver knows the days only. Tasks list each day's archives and then, dealt out anew, look for
    the markers, so neither the number of archives nor that of one day is a list anywhere.
    """
    days = [files.glob_text(files.partition_dir("ingest_date", d)) for d in dates] if dates else ["ingest_date=*"]
    folders = [folder for day in days for folder in files.glob(spark, f"{base}/{day}")]

    def names(batches):
        for batch in batches:
            for folder in batch["folder"]:
                found = [n for n, is_folder in files.list_names(folder) if is_folder and n.startswith("zip_name=")]
                yield pd.DataFrame({"folder": [f"{folder}/{n}" for n in found]}, dtype=object)

    def without_marker(batches):
        for batch in batches:
            missing = [f for f in batch["folder"] if files.size_of(f"{f}/{fixed.SUCCESS_MARKER}") is None]
            parts = [[files.unescape(part.split("=", 1)[1]) for part in f.rsplit("/", 2)[1:]] for f in missing]
            yield pd.DataFrame(parts, columns=["ingest_date", "zip_name"], dtype=object)

    listed = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(max(len(folders), 1), "folder")
    spread = listed.mapInPandas(names, "folder string").repartition(spark.sparkContext.defaultParallelism, "folder")
    return spread.mapInPandas(without_marker, "ingest_date string, zip_name string")


def read_bronze(
    spark: SparkSession,
    bronze: str,
    source: str,
    dataset: str,
    schema: T.StructType,
    dates: list[str] | None = None,
    status: str = fixed.VALID,
) -> DataFrame:
    """Rows of complete archives, of the given dates.

    A partition filter leaves out quarantined files; other dates are not even listed. Archives without
    marker are left out by a filter too, so none of their files is read; where there are many, an anti join
    on the partition columns drops their rows.
    """
    base = f"{bronze}/{source}/{dataset}"
    full = T.StructType(
        [
            *schema,
            T.StructField("_bronze_processed_at", T.TimestampType()),
            *(T.StructField(name, T.StringType()) for name in (*fixed.LINEAGE_COLUMNS[1:], *PARTITIONS)),
        ]
    )
    rows = _status_rows(spark, base, dates, full, [status])
    if rows is None:
        return spark.createDataFrame([], full)
    # Written, so that its size is known when the join is planned.
    unfinished = Staging(spark, "unfinished").write(unfinished_archives(spark, base, dates), "archives")
    few = unfinished.limit(FEW_UNFINISHED + 1).collect()
    if not few:
        return rows
    if len(few) > FEW_UNFINISHED:
        return rows.join(unfinished, ["ingest_date", "zip_name"], "left_anti").select(*full.names)
    same = [(F.col("ingest_date") == r["ingest_date"]) & (F.col("zip_name") == r["zip_name"]) for r in few]
    return rows.where(F.coalesce(~functools.reduce(Column.__or__, same), F.lit(True)))


def quarantine_rows(spark: SparkSession, bronze: str, manifest: DataFrame) -> DataFrame:
    """Mismatching rows of any shape in one view: archive, member, row number, row as JSON text.

    Of each archive the rows of its last load; archives that failed have none.
    """
    if not files.glob(spark, f"{bronze}/{QUARANTINE}/run_id=*/attempt=*/_SUCCESS"):
        return spark.createDataFrame([], "zip_file_name string, member string, row_json string")
    rows = spark.read.option("basePath", f"{bronze}/{QUARANTINE}").parquet(f"{bronze}/{QUARANTINE}/run_id=*/attempt=*")
    last = current_ledger(spark, bronze).where(F.col("status") == COMPLETE).select("path", "attempt")
    wanted = manifest.where((F.col("outcome") == fixed.INVALID) & (F.col("n_rows") > 0)).select("path", "ordinal")
    rows = rows.join(last, ["path", "attempt"], "left_semi")
    return rows.join(wanted, ["path", "ordinal"], "left_semi").select("zip_file_name", "member", "row_json")


def reprocess_quarantine(
    archives: DataFrame, manifest: DataFrame, bronze: str, schemas: dict[str, T.StructType], run_id: str
) -> DataFrame:
    """After the registry changed: load again the archives whose invalid members now match."""
    status = contract.schema_status(F.col("observed_schema"), F.col("dataset_name"), schemas)
    cured = manifest.where((F.col("outcome") == fixed.INVALID) & (status == fixed.VALID))
    again = archives.join(cured.select("path").distinct(), "path", "left_semi")
    return load_archives(again, bronze, schemas, run_id)
