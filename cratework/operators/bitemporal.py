"""Prices over two times: when they hold, and when we knew.

A correction may be recorded long after the day from which it holds. What was known at some moment
about some day is one rectangle of the plane of both times; rectangles do not overlap.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Days of valid time that share a bucket in the look-up of a key with many rectangles.
BUCKET_DAYS = 64
# A key with more rectangles than this is looked up by bucket too.
MANY_RECTANGLES = 512
NO_BUCKET = -(2**62)


def _split(valid: list, known: list) -> list[tuple]:
    """(row, valid_from, valid_to, known_from, known_to) of one key's rows, sorted by (known, valid); ends open as None.

    The rule one row after the other; ``price_rectangles`` finds the same by Spark, and tests compare the two.
    The rows known so far cut valid time into stretches. A new one ends the stretch it falls into, as far as
    knowledge goes, and starts two: what is left of that one, and its own. So there are at most
    two rectangles more for each row.
    """
    starts: list = []  # of the stretches now known, sorted
    owner: list = []  # (row, known since)
    out = []
    for row, (day, moment) in enumerate(zip(valid, known)):
        at = bisect.bisect_left(starts, day)
        same = at < len(starts) and starts[at] == day
        cut = at if same else at - 1
        if cut >= 0:
            held, since = owner[cut]
            end = starts[cut + 1] if cut + 1 < len(starts) else None
            if since < moment:
                out.append((held, starts[cut], end, since, moment))
            owner[cut] = (held, moment)
        if same:
            owner[at] = (row, moment)
        else:
            starts.insert(at, day)
            owner.insert(at, (row, moment))
    for at, (row, since) in enumerate(owner):
        out.append((row, starts[at], starts[at + 1] if at + 1 < len(starts) else None, since, None))
    return out


def price_rectangles(prices: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """(keys, valid_from, valid_to, known_from, known_to, price) from rows (keys, valid_from, known_from, price).

    Of what is known, the row with the latest valid_from not after a day holds on it; of rows with one
    valid_from the one known last. Of rows that became known at one time for one day the highest price
    counts. valid_from is a date, known_from a timestamp; rows that lack either hold nowhere. Ends are open where null.

    The days known so far cut valid time into stretches. A new day ends the stretch it falls into, that of the nearest
    earlier day known by then, and its own goes to the nearest later one. So there are at most two rectangles for each
    row. A task holds the price changes of one key at a time, however many sales that has; days are
    compared with the other days of their key.
    """
    whole = prices.where("valid_from is not null and known_from is not null")
    once = whole.groupBy(*keys, "valid_from", "known_from").agg(F.max(price).alias("_price"))
    # In a struct: a price that is null is known too.
    own = F.struct("known_from", F.struct("_price").alias("_held"))
    days = once.repartition(*keys).groupBy(*keys, "valid_from").agg(F.min("known_from").alias("first"), F.collect_list(own).alias("own"))
    per_key = days.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("valid_from", "first", "own"))).alias("_days"))

    def near(day, i):
        known = lambda others: F.filter(others, lambda d: d["first"] <= day["first"])
        before = F.get(F.reverse(known(F.slice("_days", F.lit(1), i))), F.lit(0))
        after = F.get(known(F.slice("_days", i + 2, F.size("_days"))), F.lit(0))
        return F.struct(day.alias("day"), before["valid_from"].alias("before"), after["valid_from"].alias("after"))

    placed = per_key.select(*keys, F.inline(F.transform("_days", near)))
    nothing = F.lit(None).cast(once.schema["valid_from"].dataType)

    def change(valid, known, held, end):
        return F.struct(valid.alias("valid_from"), known.alias("known_from"), held.alias("held"), end.alias("end"))

    day, unchanged = F.col("day"), F.lit(None).cast(days.schema["own"].dataType.elementType["_held"].dataType)
    told = F.transform(day["own"], lambda o: change(day["valid_from"], o["known_from"], o["_held"], nothing))
    starts = change(day["valid_from"], day["first"], unchanged, F.col("after"))
    ends = F.array(change(F.col("before"), day["first"], unchanged, day["valid_from"]))
    cut = F.when(F.col("before").isNotNull(), ends).otherwise(F.slice(ends, 1, 0))
    changes = placed.select(*keys, F.inline(F.concat(told, F.array(starts), cut))).groupBy(*keys, "valid_from", "known_from").agg(
        F.first("held", True).alias("held"), F.min("end").alias("end")
    )
    line = Window.partitionBy(*keys, "valid_from").orderBy("known_from")
    return changes.select(
        *keys, "valid_from", F.min("end").over(line).alias("valid_to"), "known_from", F.lead("known_from").over(line).alias("known_to"),
        F.last("held", True).over(line)["_price"].alias(price),
    )


def price_as_known(
    facts: DataFrame, rectangles: DataFrame, keys: list[str], day: str, known: str, price: str = "price", name: str = "price_as_known"
) -> DataFrame:
    """Facts with the price of their key on ``day`` as it was known at ``known``; null where none was.

    Facts meet the rectangles of their key, then by range. Of a key with many rectangles each of those is
    there once for every bucket of days it touches, and the key's facts are dealt out by bucket. So a fact is
    compared with a bounded number of rectangles, and neither side is written more often than that needs.
    The list of such keys goes to all tasks: it is a small part of the rectangles (``MANY_RECTANGLES``).
    """
    bucket = lambda c: F.floor(F.unix_date(c) / BUCKET_DAYS)
    mine = [F.col(k).alias(f"_{k}") for k in keys]
    many = rectangles.groupBy(*mine).agg(F.count("*").alias("_many")).where(F.col("_many") > MANY_RECTANGLES)
    last = facts.agg(F.max(day).cast("date")).scalar()
    # Days before valid_to; open ends go as far as anybody asks.
    end = F.coalesce(F.least(F.date_sub("valid_to", 1), last), last)
    whole = Window.partitionBy(*keys).orderBy("valid_from").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = F.count("*").over(whole) > MANY_RECTANGLES
    touched = F.when(F.col("_held"), F.sequence(bucket("valid_from"), bucket(end))).otherwise(F.array(F.lit(None).cast("bigint")))
    parts = rectangles.withColumn("_held", held).where(F.col("valid_from") <= last).withColumn("_bucket", F.explode(touched))
    parts = parts.select(
        *mine, F.coalesce("_bucket", F.lit(NO_BUCKET)).alias("_at"), "valid_from", "valid_to", "known_from", "known_to", F.col(price).alias(name)
    )
    dealt = facts.join(F.broadcast(many), [facts[k] == many[f"_{k}"] for k in keys], "left").select(
        *[facts[c] for c in facts.columns],
        F.coalesce(F.when(F.col("_many").isNotNull(), bucket(facts[day])), F.lit(NO_BUCKET)).alias("_bucket"),
    )
    inside = [
        parts["valid_from"] <= dealt[day],
        parts["valid_to"].isNull() | (dealt[day] < parts["valid_to"]),
        parts["known_from"] <= dealt[known],
        parts["known_to"].isNull() | (dealt[known] < parts["known_to"]),
    ]
    same = [dealt["_bucket"] == parts["_at"], *[dealt[k] == parts[f"_{k}"] for k in keys]]
    return dealt.join(parts, [*same, *inside], "left").select(*[dealt[c] for c in facts.columns], name)
