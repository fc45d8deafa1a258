"""Load archives as they arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cratework import files
from cratework.operators import bronze as bronze_ops
from cratework.sources import archives as zips


def load_pending(
    spark: SparkSession,
    landing: str,
    bronze: str,
    schemas: dict[str, T.StructType],
    run_id: str,
    moment: dt.datetime | None = None,
    dates: list[str] | None = None,
) -> DataFrame:
    """Load what the ledger does not know yet, re-landed files included; all days or some.

    This is the trigger to schedule: a file stream never looks again at a path it has
    seen, so a delivery that replaces an earlier one would be missed.
    """
    listing = zips.list_archives(spark, landing, dates)
    todo = bronze_ops.pending_archives(listing, bronze_ops.current_ledger(spark, bronze), bronze)
    return bronze_ops.load_archives(todo, bronze, schemas, run_id, moment)


def start_arrival_stream(
    spark: SparkSession,
    landing: str,
    bronze: str,
    schemas: dict[str, T.StructType],
    checkpoint: str,
    run_prefix: str = "stream",
    max_files: int | None = None,
    trigger: dict | None = None,
):
    """Start a stream that loads each batch of new archives under its own run id.

    The default trigger takes all that is there and stops. A batch that is repeated
    after a failure replaces its own output.
    """
    root = files.qualify(spark, landing).rstrip("/")
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    listing = (
        reader.schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", zips.ZIP_FILES)
        .load(landing)
        .select("path", "length", "modificationTime")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        archives = zips.describe_archives(batch, root)
        bronze_ops.load_archives(archives, bronze, schemas, f"{run_prefix}-{batch_id}")

    return (
        listing.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
