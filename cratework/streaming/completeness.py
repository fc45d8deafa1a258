"""Expected against arrived, inside a stream: a missing hour comes out by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework import fixed_values as fixed

LATENESS = f"{fixed.ARRIVAL_TIMEOUT_HOURS} hours"


def hourly_completeness(slots: DataFrame, events: DataFrame, by: str) -> DataFrame:
    """A stream of (by, hour_start, n_events): every slot once, as soon as its hour can get no more events.

    ``slots``: by, slot_ts, the calendar's expected hours, any time within the hour. ``events``: by, event_ts.
    Both are streams. Hours are counted under the events' watermark and meet the slots in an outer
    join under both, so a slot without events comes out with null once either side's clock is
    24 hours past it; counts of hours that nobody expects do not. Repeated slots come out each.
    For append mode.
    """
    counted = events.withWatermark("event_ts", LATENESS).groupBy(F.window("event_ts", "1 hour").alias("hour"), by)
    counted = counted.agg(F.count("*").alias("n_events"))
    timed = slots.withWatermark("slot_ts", LATENESS).select(F.window("slot_ts", "1 hour").alias("hour"), by)
    return timed.join(counted, ["hour", by], "left_outer").select(by, F.col("hour.start").alias("hour_start"), "n_events")
