"""Where each order stands, kept up to date by a stream of its events.

State per order, in buckets with an event-time timer: an order without an event for the allowed lateness is
closed and forgotten. What has been said about it stays in the sink as an episode; should
events come later still, a new episode begins, and episodes are added up when the sink is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cratework import fixed_values as fixed
from cratework.operators import silver
from cratework.plans.marts import ORDER_EVENTS

LATENESS = f"{fixed.ARRIVAL_TIMEOUT_HOURS} hours"
LATENESS_MS = fixed.ARRIVAL_TIMEOUT_HOURS * 3_600_000
BATCH = "batch_id"
# Rows of state; a checkpoint keeps the number it began with.
STATE_BUCKETS = 1024
BUCKET = "__bucket"


def _summary_schema(key: str, kinds: tuple[str, ...]) -> T.StructType:
    fields = f"{key} long, hour timestamp, n_events long, min_us long, max_us long, last_id long, last_event string"
    return T.StructType.fromDDL(", ".join([fields, *(f"`first_{k}` long" for k in kinds)]))


def _summaries(key: str, kinds: tuple[str, ...]):
    """Within a task: one row for each order and hour of events, however many there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for events in batches:
            if not len(events):
                continue
            us = events["us"]
            events = events.assign(hour=us // 3_600_000_000 * 3_600_000_000).sort_values(["us", "event_id"], kind="stable")
            groups = events.groupby([key, "hour"], sort=False)
            out = groups.agg(
                n_events=("us", "size"), min_us=("us", "min"), max_us=("us", "max"), last_id=("event_id", "last"), last_event=("event_type", "last")
            )
            for kind in kinds:
                first = events[events["event_type"] == kind].groupby([key, "hour"], sort=False)["us"].min()
                out[f"first_{kind}"] = first.reindex(out.index).astype("Int64")
            out = out.reset_index()
            out["hour"] = pd.to_datetime(out["hour"], unit="us")
            yield out

    return run


def _tables(key: str, kinds: tuple[str, ...]) -> tuple[pa.Schema, pa.Schema]:
    """(sums of orders, open orders as the state holds them)."""
    firsts = [f"first_{k}" for k in kinds]
    longs = lambda names: [pa.field(n, pa.int64()) for n in names]
    sums = [*longs(["n_events", "min_us", "max_us", "last_id"]), pa.field("last_event", pa.string()), *longs(firsts)]
    return pa.schema([*longs([key]), *sums]), pa.schema([*longs([key, "episode", "until"]), *sums])


def _fold(rows: pa.Table, key: str, schema: pa.Schema) -> pa.Table:
    """One row for each order: rows of one order added up. Of equal last events that of the earlier row counts."""
    rows = rows.append_column("__row", pa.array(np.arange(len(rows), 0, -1)))
    order = pc.sort_indices(rows, [("max_us", "ascending"), ("last_id", "ascending"), ("__row", "ascending")], null_placement="at_start")
    how = {"n_events": "sum", "max_us": "max", "last_id": "last", "last_event": "last", "episode": "max", "until": "max"}
    wanted = {n: how.get(n, "min") for n in schema.names if n != key}
    nulls = pc.ScalarAggregateOptions(skip_nulls=False)
    aggregates = [(n, h, nulls if h == "last" else None) for n, h in wanted.items()]
    out = rows.take(order).group_by(key, use_threads=False).aggregate(aggregates)
    return pa.table({n: out[n if n == key else f"{n}_{wanted[n]}"] for n in schema.names}).cast(schema)


def _until(orders: pa.Table) -> np.ndarray:
    """Milliseconds at which the time of an order is up."""
    return orders["max_us"].to_numpy() // 1000 + LATENESS_MS


def lifecycle_stream(events: DataFrame, key: str, kinds: tuple[str, ...] = ORDER_EVENTS) -> DataFrame:
    """A stream of rows (key, episode, closed, n_events, ...): an order's episode as it stands after each batch.

    ``events``: key (long), event_id (long), event_type, event_ts, each event once. Rows without key
    or time take no part. Events whose whole hour lies more than the allowed lateness before the
    latest event seen are dropped. For update mode. Before the shuffle a task sums up its
    events by order and hour, so that an order with a third of all events moves few rows.

    Orders are dealt by hash to STATE_BUCKETS; Python is called once for a bucket and batch, not for
    each order, and merges its orders by Arrow. A bucket's state is a table of its open orders, each with the
    time at which it closes; the timer is set to the first of these. The table is written anew with
    each batch that brings the bucket an event, so a batch costs what is open, not only what it brings.
    """
    plain = _summary_schema(key, kinds)
    names = [f.name for f in plain if f.name not in (key, "hour")]
    out = T.StructType([plain[key], T.StructField("episode", T.LongType()), T.StructField("closed", T.BooleanType()), *(plain[n] for n in names)])
    sums, opened = _tables(key, kinds)

    def said(orders: pa.Table, closed: bool) -> pd.DataFrame:
        orders = orders.append_column("closed", pa.array(np.full(len(orders), closed))).select(out.names)
        return orders.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)

    def step(_: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.getCurrentWatermarkMs()
        known = pa.ipc.open_stream(bytes(held.get[0])).read_all() if held.exists else opened.empty_table()
        fresh = sums.empty_table()
        if not held.hasTimedOut:
            for part in parts:
                rows = pa.Table.from_pandas(part[sums.names], sums, preserve_index=False)
                fresh = _fold(pa.concat_tables([fresh, rows]), key, sums)
        told = pc.is_in(known[key], fresh[key].combine_chunks()).to_numpy()
        # An order can get events in the very batch in which its time is up.
        over = np.where(told, _until(known) <= now, known["until"].to_numpy() < now)
        if over.any():
            yield said(known.filter(pa.array(over)), True)
        none = pa.nulls(len(fresh), pa.int64())
        added = fresh.append_column("episode", none).append_column("until", none).select(opened.names)
        merged = _fold(pa.concat_tables([known.filter(pa.array(told & ~over)), added]), key, opened)
        merged = merged.set_column(1, opened.field("episode"), pc.coalesce(merged["episode"], merged["min_us"]))
        merged = merged.set_column(2, opened.field("until"), pa.array(np.maximum(_until(merged), now + 1)))
        if len(merged):
            yield said(merged, False)
        left = pa.concat_tables([known.filter(pa.array(~told & ~over)), merged])
        if len(left):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, opened) as writer:
                writer.write_table(left)
            held.update((sink.getvalue().to_pybytes(),))
            held.setTimeoutTimestamp(max(pc.min(left["until"]).as_py(), now + 1))
        elif held.exists:
            held.remove()

    whole = events.where(F.col(key).isNotNull() & F.col("event_ts").isNotNull())
    timed = whole.select(F.col(key).cast("long"), F.col("event_id").cast("long"), "event_type", F.unix_micros("event_ts").alias("us"))
    summed = timed.mapInPandas(_summaries(key, kinds), plain).withWatermark("hour", f"{fixed.ARRIVAL_TIMEOUT_HOURS + 1} hours")
    dealt = summed.withColumn(BUCKET, F.pmod(F.hash(key), F.lit(STATE_BUCKETS)))
    return dealt.groupBy(BUCKET).applyInPandasWithState(step, out, "orders binary", "update", GroupStateTimeout.EventTimeTimeout)


def keep_lifecycles(stream: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None):
    """Write each batch to a folder of its own; a batch that is repeated replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id:09d}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_lifecycles(spark: SparkSession, folder: str, key: str, kinds: tuple[str, ...] = ORDER_EVENTS) -> DataFrame:
    """Each order as ``marts.order_lifecycle`` gives it: of every episode the last word, episodes added up."""
    rows = spark.read.parquet(folder)
    episodes = silver.latest_per_key(rows, [key, "episode"], [BATCH])
    moment = lambda us: F.timestamp_micros(us)
    found = episodes.groupBy(key).agg(
        F.sum("n_events").alias("n_events"),
        F.max_by("last_event", F.struct("max_us", "last_id")).alias("last_event"),
        moment(F.max("max_us")).alias("last_ts"),
        (F.max("max_us") - F.min("min_us")).alias("span_micros"),
        *[moment(F.min(f"first_{k}")).alias(f"first_{k}") for k in kinds],
    )
    return found


