"""Land files: wait for them, copy them, check their size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework import files
from cratework import fixed_values as fixed
from cratework.functions import paths

ARRIVED, WAITING, TIMED_OUT = "arrived", "waiting", "timed_out"
OK, MISMATCH_DELETED, MISMATCH_KEPT, UNVERIFIABLE = "ok", "mismatch_deleted", "mismatch_delete_failed", "unverifiable"
COLLISION = "two source files have this landing key"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below a folder: key, path, length, modificationTime."""
    prefix = files.qualify(spark, root).rstrip("/")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(
            F.substr("path", F.lit(len(prefix) + 2)).alias("key"), "path", "length", "modificationTime"
        )
    )


def await_arrivals(
    expected: DataFrame, listing: DataFrame, run_start: Column, now: Column, on: str | list[str] = "key"
) -> DataFrame:
    """State of every expected file; asking again is the poll.

    ``on`` names the file: its key, or bucket and key where there are several buckets.

    Each file is on its own: one that does not come times out after 24 hours and
    holds up nothing else.
    """
    on = [on] if isinstance(on, str) else on
    here = listing.groupBy(*on).agg(
        F.max("length").alias("length"), F.max("modificationTime").alias("arrived_at")
    )
    late = now > run_start + F.expr(f"INTERVAL {fixed.ARRIVAL_TIMEOUT_HOURS} HOURS")
    state = F.when(F.col("arrived_at").isNotNull(), ARRIVED).when(late, TIMED_OUT).otherwise(WAITING)
    return expected.join(here, on, "left").withColumn("state", state)


def with_landing_key(work: DataFrame, date: str) -> DataFrame:
    """Work rows with the key each file will have in the landing zone."""
    key = paths.landing_key(F.col("source_name"), F.col("key"), F.col("dataset_name"), F.lit(date))
    return work.withColumn("landing_key", key)


def land_files(
    work: DataFrame, landing: str, date: str, report: str, source_uri: str = "s3a://{bucket}/{key}"
) -> DataFrame:
    """Copy each work row's file to its landing key; one task copies one file at a time.

    The result (written to ``report``, so that copies are not repeated) has the sizes
    of both ends and an error text. A file gets its landing key only when all of it has
    arrived and its size is right. Copying again overwrites the same key. Two source
    files with one landing key would overwrite each other in any order, so neither is
    copied.
    """
    spark = work.sparkSession
    keyed = with_landing_key(work, date)
    same = keyed.groupBy("landing_key").agg(F.count("*").alias("same_key"))
    planned = (
        keyed.join(same, "landing_key")
        .withColumn("source_uri", paths.fill(source_uri, bucket=F.col("bucket"), key=F.col("key")))
        .withColumn("landing_uri", F.concat(F.lit(f"{landing}/"), "landing_key"))
        .withColumn("refused", F.when(F.col("same_key") > 1, COLLISION))
        .select("source_name", "dataset_name", "source_uri", "landing_key", "landing_uri", "refused")
    )
    parallel = 4 * spark.sparkContext.defaultParallelism
    tasks = max(parallel, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = (
        "source_name string, dataset_name string, source_uri string, landing_key string, "
        "source_size bigint, landed_size bigint, error string"
    )
    copied = planned.repartition(tasks, "landing_key").mapInPandas(_copy_batches, columns)
    copied.write.mode("overwrite").parquet(report)
    return spark.read.parquet(report)


def _copy_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        results = [_copy(row) for row in batch.to_dict("records")]
        out = batch[["source_name", "dataset_name", "source_uri", "landing_key"]].copy()
        for name, kind in (("source_size", "Int64"), ("landed_size", "Int64"), ("error", "object")):
            out[name] = pd.array([r[name] for r in results], dtype=kind)
        yield out


def _copy(row: dict) -> dict:
    result = {"source_size": None, "landed_size": None, "error": row["refused"]}
    if row["refused"]:
        return result
    aside = f"{row['landing_uri']}.{uuid.uuid4().hex[:12]}.part"
    try:
        with files.open_input(row["source_uri"]) as source, files.open_output(aside) as target:
            result["source_size"] = source.size()
            while chunk := source.read(fixed.COPY_CHUNK_BYTES):
                target.write(chunk)
        result["landed_size"] = files.size_of(aside)
        if result["landed_size"] == result["source_size"]:
            files.move(aside, row["landing_uri"])
        else:
            result["error"] = fixed.MSG_SIZE_MISMATCH.format(key=row["landing_key"])
    except OSError as error:
        result["error"] = f"Failed to upload {row['landing_uri']}: {error}"
    if result["error"] and files.size_of(aside) is not None:
        files.delete_file(aside)
    return result


def compare_sizes(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected (key, size) against a listing (key, length)."""
    verdict = (
        F.when(F.col("length").isNull(), UNVERIFIABLE)
        .when(F.col("length") != F.col("expected_size"), "mismatch")
        .otherwise(OK)
    )
    listed = listing.select("key", "length").distinct()
    return expected.join(listed, "key", "left").withColumn("status", verdict)


def verify_landed(expected: DataFrame, landing: str, report: str) -> DataFrame:
    """Check sizes of landed files and delete those that do not match.

    ``expected`` has the columns key and expected_size. Every file gets a status and,
    if it is not ok, a message; a file that cannot be checked is kept. Only the expected
    files are looked at, in tasks, however many others the landing zone holds.
    """
    spark = expected.sparkSession

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [files.size_of(f"{landing}/{key}") for key in batch["key"]]
            yield pd.DataFrame({"key": batch["key"], "length": pd.array(sizes, dtype="Int64")})

    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = expected.select("key").distinct().repartition(tasks, "key")
    listing = keys.mapInPandas(look, "key string, length bigint").where("length is not null")
    compared = compare_sizes(expected, listing).select("key", "expected_size", "length", "status")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            verdicts = [_settle(landing, key, status) for key, status in zip(batch["key"], batch["status"])]
            batch["status"] = [v[0] for v in verdicts]
            batch["message"] = [v[1] for v in verdicts]
            yield batch

    columns = "key string, expected_size bigint, length bigint, status string, message string"
    compared.mapInPandas(settle, columns).write.mode("overwrite").parquet(report)
    return spark.read.parquet(report)


def _settle(landing: str, key: str, status: str) -> tuple[str, str | None]:
    uri = f"{landing}/{key}"
    if status == OK:
        return OK, None
    if status == UNVERIFIABLE:
        return UNVERIFIABLE, fixed.MSG_UNVERIFIABLE.format(uri=uri)
    message = fixed.MSG_SIZE_MISMATCH.format(key=key)
    try:
        files.delete_file(uri)
    except FileNotFoundError:  # a repeated task finds it gone already
        pass
    except OSError:
        return MISMATCH_KEPT, message + fixed.MSG_DELETE_FAILED
    return MISMATCH_DELETED, message + fixed.MSG_DELETED.format(bucket=landing)


def landed_events(landed: DataFrame, bucket: str) -> DataFrame:
    """One event per file that landed whole."""
    return landed.where("error is null and landed_size = source_size").select(
        F.lit(bucket).alias("landing_bucket"), "landing_key", "dataset_name"
    )


def batch_fan_out(events: DataFrame, destination_bucket: str, run_id: str) -> DataFrame:
    """One bronze work row per event, all with the same run id."""
    return events.select(
        "landing_bucket",
        "landing_key",
        "dataset_name",
        F.lit(destination_bucket).alias("destination_bucket"),
        F.lit(run_id).alias("dag_run_id"),
    )


