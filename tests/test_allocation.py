"""First-expiry allocation against a loop over sorted batches and sales."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cratework.operators import allocation
from cratework.staging import Staging

SUPPLY = "product string, batch string, expiry date, quantity int, note string"
DEMAND = "product string, sale string, time date, quantity int, low int"


def day(n):
    return None if n is None else dt.date(2026, 1, 1) + dt.timedelta(days=n)


def plain(supply, demand):
    have, want = defaultdict(int), defaultdict(int)
    for product, batch, expiry, quantity in supply:
        if quantity and quantity > 0:
            have[product, batch, expiry] += quantity
    for product, sale, time, quantity in demand:
        if quantity and quantity > 0:
            want[product, sale, time] += quantity
    stock = defaultdict(list)
    for (product, batch, expiry), quantity in sorted(have.items(), key=lambda r: (r[0][2] is None, r[0][2] or 0, r[0][1])):
        if product is not None:
            stock[product].append([batch, expiry, quantity])
    rows = []
    for (product, sale, time), quantity in sorted(want.items(), key=lambda r: (r[0][2] is not None, r[0][2] or 0, r[0][1])):
        for held in stock[product] if product is not None else []:
            taken = min(held[2], quantity)
            if taken:
                rows.append((product, sale, day(time), held[0], day(held[1]), taken))
                held[2] -= taken
                quantity -= taken
        if quantity:
            rows.append((product, sale, day(time), None, None, quantity))
    left = [(p, b, day(e), q) for p, held in stock.items() for b, e, q in held if q]
    left += [(None, b, day(e), q) for (p, b, e), q in have.items() if p is None]
    return sorted(rows, key=str), sorted(left, key=str)


def run(spark, supply, demand):
    have = spark.createDataFrame([(p, b, day(e), q, "x") for p, b, e, q in supply], SUPPLY)
    want = spark.createDataFrame([(p, s, day(t), q, 7) for p, s, t, q in demand], DEMAND)
    allocated, left = allocation.first_expiry(
        have.select("product", "batch", "expiry", "quantity"), want.select("product", "sale", "time", "quantity"),
        ["product"], "batch", "sale", "expiry", "time",
    )
    got = [tuple(r) for r in allocated.select("product", "sale", "time", "batch", "expiry", "quantity").collect()]
    return sorted(got, key=str), sorted((tuple(r) for r in left.select("product", "batch", "expiry", "quantity").collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_loop(spark, seed):
    rng = random.Random(seed)
    products = ["hot"] * 6 + ["a", "b", "c"]
    supply = [(rng.choice(products), f"b{rng.randrange(12)}", rng.randrange(40), rng.randrange(1, 400)) for _ in range(60)]
    demand = [(rng.choice(products), f"s{k:03d}", rng.randrange(30), rng.randrange(1, 60)) for k in range(300)]
    assert run(spark, supply, demand) == plain(supply, demand)


def test_odd_rows(spark):
    supply = [
        ("a", "b1", 3, 5), ("a", "b1", 3, 5), ("a", "b2", None, 4), ("a", "b0", 3, 1), ("a", "b9", 1, 0), ("a", "b8", 1, None),
        ("only stock", "b3", 1, 2), (None, "b4", 1, 3), ("big", "b5", 2, 2_000_000),
    ]
    demand = [
        ("a", "s2", 2, 6), ("a", "s1", None, 4), ("a", "s2", 2, 1), ("a", "s9", 9, 20), ("a", "s0", 1, -3), ("no stock", "s3", 1, 2),
        (None, "s4", 1, 3), ("big", "s5", 1, 1_500_000), ("big", "s6", 1, 3),
    ]
    assert run(spark, supply, demand) == plain(supply, demand)
    assert run(spark, [], demand) == plain([], demand)
    assert run(spark, supply, []) == plain(supply, [])


def test_a_hot_product_is_many_pieces_and_many_join_keys(spark):
    """Neither the running sum nor the join holds all rows of one product together."""
    rows = spark.range(4000).select(F.lit("p").alias("product"), F.col("id").cast("string").alias("sale"), F.lit(3).alias("n"))
    staging = Staging(spark, "test")
    placed = allocation.running_ranges(staging, "rows", rows, ["product"], ["sale"], "n")
    assert placed.agg(F.min("low"), F.max("high"), F.countDistinct("low")).first()[:] == (0, 12_000, 4000)
    dealt = spark.read.parquet(f"{staging.folder}/rows").groupBy("piece").count().collect()
    assert len(dealt) > 1 and max(r["count"] for r in dealt) < 2000
    per_key = allocation._stretches(placed, 3 * allocation.SALES_PER_STRETCH).groupBy("product", "stretch").count()
    assert per_key.agg(F.max("count")).first()[0] <= allocation.SALES_PER_STRETCH + 1
