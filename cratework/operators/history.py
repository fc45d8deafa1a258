"""Versions over time: price intervals, as-of lookups, slowly changing dimensions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def price_intervals(prices: DataFrame, keys: list[str], valid_from: str = "valid_from") -> DataFrame:
    """``[valid_from, valid_to)`` of each price; the last one is open (null).

    A key has one row per day at most (the table's unique key), so a window partition
    cannot grow with the number of sales.
    """
    by_key = Window.partitionBy(*keys).orderBy(valid_from)
    return prices.withColumn("valid_to", F.lead(valid_from).over(by_key))


def price_as_of(facts: DataFrame, prices: DataFrame, keys: list[str], date: str, price: str) -> DataFrame:
    """Facts with the latest price whose ``valid_from`` is not after the fact's date.

    Only the distinct (key, date) pairs of the facts meet the prices. They are bounded
    by the days of the calendar per key, and are found with map-side aggregation, so a
    product that makes up a third of all sales is a window of a few thousand rows. The
    result joins back on (key, date), which spreads a hot key over its days; adaptive
    execution splits what is still too large.
    """
    asked = facts.select(*keys, F.col(date).alias("as_of")).distinct()
    answers = _carry_forward(asked, prices, keys, price)
    on = [facts[k] == answers[f"_{k}"] for k in keys] + [facts[date] == answers["as_of"]]
    return facts.join(answers, on, "left").drop("as_of", *[f"_{k}" for k in keys])


def _carry_forward(asked: DataFrame, prices: DataFrame, keys: list[str], price: str) -> DataFrame:
    events = prices.select(
        *keys, F.col("valid_from").alias("as_of"), F.lit(0).alias("kind"), F.col(price)
    ).unionByName(asked.select(*keys, "as_of", F.lit(1).alias("kind")), allowMissingColumns=True)
    until_now = (
        Window.partitionBy(*keys).orderBy("as_of", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = events.withColumn(price, F.last(price, ignorenulls=True).over(until_now))
    return carried.where("kind = 1").select(*[F.col(k).alias(f"_{k}") for k in keys], "as_of", price)


def price_at(prices: DataFrame, keys: list[str], date: Column, price: str, name: str) -> DataFrame:
    """The price of each key valid on one date."""
    return (
        prices.where(F.col("valid_from") <= date).groupBy(*keys).agg(F.max_by(price, "valid_from").alias(name))
    )


def prices_at(prices: DataFrame, keys: list[str], dates: dict[str, Column], price: str) -> DataFrame:
    """The prices of each key valid on several dates, in one pass; null where none was valid yet."""
    valid = {name: F.when(F.col("valid_from") <= date, F.col("valid_from")) for name, date in dates.items()}
    latest = prices.where(functools.reduce(Column.__or__, [F.col("valid_from") <= d for d in dates.values()]))
    return latest.groupBy(*keys).agg(*[F.max_by(price, when).alias(name) for name, when in valid.items()])


def scd2_history(extracts: DataFrame, keys: list[str], attributes: list[str], extracted: str) -> DataFrame:
    """Validity intervals of attribute versions, from successive full extracts.

    Rows that repeat the version before are folded into it. A window partition holds
    one row per extract of a key.
    """
    by_key = Window.partitionBy(*keys).orderBy(extracted)
    version = F.struct(*attributes)
    changes = (
        extracts.withColumn("_version", version)
        .withColumn("_before", F.lag("_version").over(by_key))
        .where(~F.col("_version").eqNullSafe(F.col("_before")))
    )
    return changes.select(
        *keys,
        *attributes,
        F.col(extracted).alias("valid_from"),
        F.lead(extracted).over(by_key).alias("valid_to"),
        F.lead(extracted).over(by_key).isNull().alias("is_current"),
    )
