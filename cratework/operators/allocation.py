"""First-expiry allocation: which batch the packs of a sale came from.

Sales name no batch. Per product the packs of its batches, by expiry, and the packs sold,
by time, are laid out on one line each; where a batch's stretch and a sale's stretch
overlap, packs of that batch went into that sale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratework.staging import Staging

# Sales of mean size that share a stretch of the line, in the join.
SALES_PER_STRETCH = 64


def running_ranges(staging: Staging, name: str, df: DataFrame, keys: list[str], order: list[str], quantity: str) -> DataFrame:
    """The rows with ``low`` and ``high``: their quantity's place on the line of their key.

    ``order`` must tell the rows of a key apart. A prefix sum in two levels: rows are dealt by
    ranges of key and order, so that a key with a third of all rows covers many pieces; sums of
    whole pieces are added up per key (a row for each piece), rows within their piece only.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(tasks, *keys, *order).withColumn("piece", F.spark_partition_id())
    dealt = staging.write(dealt, name)  # so that pieces stay what they are
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = dealt.groupBy(*keys, "piece").agg(F.sum(quantity).alias("_total"))
    pieces = pieces.withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    within = Window.partitionBy(*keys, "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Every row of a piece meets the one row of its key and piece.
    pieces = pieces.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("piece").alias("_piece"), "_start")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("piece") == F.col("_piece")]
    placed = dealt.withColumn("_sum", F.sum(quantity).over(within)).join(pieces, same)
    high = (F.col("_start") + F.col("_sum")).cast("long")
    return placed.withColumns({"low": high - F.col(quantity), "high": high}).select(*df.columns, "low", "high")


def _stretches(df: DataFrame, width: int) -> DataFrame:
    """A row for each stretch of ``width`` packs that a range touches, with its part of it."""
    numbers = F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))
    cut = df.where("high > low").withColumn("stretch", F.explode(numbers))
    low, high = F.col("stretch") * width, (F.col("stretch") + 1) * width
    return cut.withColumns({"low": F.greatest("low", low), "high": F.least("high", high)})


def first_expiry(
    supply: DataFrame, demand: DataFrame, keys: list[str], batch: str, sale: str, expiry: str, time: str, quantity: str = "quantity"
) -> tuple[DataFrame, DataFrame]:
    """(allocations, what is left): packs of each sale by batch, and packs of each batch that no sale took.

    ``supply``: keys, batch, expiry, quantity. ``demand``: keys, sale, time, quantity. Allocations
    have a row for each sale and batch with common packs: keys, sale, time, batch, expiry,
    quantity; packs sold beyond all supply have a row without batch. The quantities of a sale's
    rows sum to its own, those of a batch's rows and what is left of it to the batch's. Batches go by
    expiry (unknown last), then batch; sales by time (unknown first), then sale. Rows of one batch
    (or one sale at one time) are one; quantities that are null, zero or negative take no part.

    The join is on key and stretch of the line, so a product with a third of all rows is as many
    tasks as it has stretches; a stretch holds about ``SALES_PER_STRETCH`` sales.
    """
    staging = Staging(supply.sparkSession, "allocation")
    have = supply.where(F.col(quantity) > 0).groupBy(*keys, batch, expiry).agg(F.sum(quantity).cast("long").alias("have"))
    want = demand.where(F.col(quantity) > 0).groupBy(*keys, sale, time).agg(F.sum(quantity).cast("long").alias("want"))
    unknown_last = have.withColumn("_unknown", F.col(expiry).isNull())
    have = running_ranges(staging, "supply", unknown_last, keys, ["_unknown", expiry, batch], "have").drop("_unknown")
    want = running_ranges(staging, "demand", want, keys, [time, sale], "want")
    have, want = staging.write(have, "supply-placed"), staging.write(want, "demand-placed")
    mean = want.agg(F.avg("want")).first()[0] or 1
    width = max(int(mean * SALES_PER_STRETCH), 1)

    sides = [_renamed(_stretches(df, width), name) for df, name in ((have, "have"), (want, "want"))]
    both = sides[0].join(sides[1], [*keys, "stretch"])
    common = F.least("have_high", "want_high") - F.greatest("have_low", "want_low")
    pieces = both.withColumn("common", common).where("common > 0")
    matched = pieces.groupBy(*keys, sale, time, batch, expiry).agg(F.sum("common").alias(quantity))

    short = _beyond(want, have, keys).where("beyond > 0")
    nothing: dict[str, Column] = {c: F.lit(None).cast(have.schema[c].dataType) for c in (batch, expiry)}
    unmet = short.select(*keys, sale, time, *[v.alias(c) for c, v in nothing.items()], F.col("beyond").alias(quantity))
    left = _beyond(have, want, keys).where("beyond > 0").select(*keys, batch, expiry, F.col("beyond").alias(quantity))
    return matched.unionByName(unmet), left


def _renamed(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name).withColumnsRenamed({"low": f"{name}_low", "high": f"{name}_high"})


def _beyond(ranges: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The part of each range that lies beyond the end of the other side's line."""
    ends = others.groupBy(*keys).agg(F.max("high").alias("end"))
    end = F.coalesce("end", F.lit(0))
    joined = ranges.join(ends, keys, "left")
    return joined.withColumn("beyond", F.greatest(F.col("high") - F.greatest("low", end), F.lit(0)))
