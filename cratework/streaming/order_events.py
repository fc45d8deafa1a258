"""Late and repeated order events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework import fixed_values as fixed

LATENESS = f"{fixed.ARRIVAL_TIMEOUT_HOURS} hours"


def dedupe_events(stream: DataFrame, keys: list[str], event_ts: str = "event_ts") -> DataFrame:
    """Each event once; repeats are recognised for as long as files may be late."""
    return stream.withWatermark(event_ts, LATENESS).dropDuplicatesWithinWatermark(keys)


def hourly_counts(events: DataFrame, by: list[str], event_ts: str = "event_ts") -> DataFrame:
    """Events per hour, to see which hourly files are complete (batch or stream)."""
    return (
        events.groupBy(F.window(event_ts, "1 hour").alias("hour"), *by)
        .agg(F.count("*").alias("n_events"))
        .select(F.col("hour.start").alias("hour_start"), *by, "n_events")
    )


def append_to(stream: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None):
    """Append a stream to a Parquet folder."""
    return (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
