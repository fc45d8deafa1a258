import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cratework.operators import history, silver


def collect(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_casting_and_rejects_split_all_rows(spark):
    df = spark.createDataFrame(
        [("1", "1.10", "2024-01-31"), ("x", "2", "2024-02-30"), (None, None, None), (" 7", "1e2", "")],
        "id string, price string, day string",
    )
    rules = {"id": silver.Cast("bigint"), "price": silver.Cast("decimal(10,2)"), "day": silver.Cast("date", "yyyy-MM-dd")}
    good, bad = silver.split_rejects(silver.clean_strings(df, ["id", "day"]), rules)
    assert collect(good, "id") == [
        (None, None, None),
        (1, Decimal("1.10"), dt.date(2024, 1, 31)),
        (7, Decimal("100.00"), None),
    ]
    assert [(r["id"], r["reject_reasons"]) for r in bad.collect()] == [("x", ["id: not bigint", "day: not date"])]
    assert silver.cast_columns(df, rules).count() == 4


def test_latest_per_key_against_brute_force(spark):
    random.seed(1)
    rows = [(random.choice([None, 1, 2, 3]), random.choice([None, 1, 2]), i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t int, n int, v string")
    want = {}
    for k, t, n, v in rows:
        rank = (t is not None, t or 0, n)
        if k not in want or rank > want[k][0]:
            want[k] = (rank, (k, t, n, v))
    got = silver.latest_per_key(df, ["k"], ["t", "n"])
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == {w[1] for w in want.values()}
    only_order = silver.latest_per_key(df.select("k", "t"), ["k"], ["t"])
    assert only_order.count() == 4


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)], "k int, v string, at int")
    assert collect(silver.upsert(target, changes, ["k"], ["at"]), "k") == [(1, "a"), (2, "new"), (3, "c")]


def test_incremental_and_changes(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "zip string, v int")
    loaded = spark.createDataFrame([("a",)], "zip string")
    assert collect(silver.incremental(rows, loaded, ["zip"]), "zip") == [("b", 2)]


def test_nested_rows_make_two_tables(spark):
    receipts = spark.createDataFrame(
        [("r1", [("p1", 1), ("p2", 2)], [("cash", 5)]), ("r2", [], [("card", 1), ("cash", 2)])],
        "id string, products array<struct<product: string, n: int>>, payments array<struct<kind: string, amount: int>>",
    )
    assert collect(silver.explode_struct(receipts, "products", ["id"]), "id", "product") == [
        ("r1", "p1", 1), ("r1", "p2", 2), ("r2", None, None),
    ]
    assert silver.explode_struct(receipts, "payments", ["id"]).count() == 3


def test_local_time_by_zone(spark):
    zones = spark.createDataFrame([("z1", "Asia/Tokyo"), ("z2", "-05:00")], "zone string, time_zone string")
    rows = spark.createDataFrame([("z1", "2026-01-01 00:30:00"), ("z2", "2026-01-01 00:30:00"), ("z3", "2026-01-01 00:30:00")], "zone string, t string")
    utc = silver.local_to_utc(rows.withColumn("t", F.col("t").cast("timestamp")), zones, "zone", "t", "utc")
    got = [(r[0], r[1]) for r in utc.select("zone", F.date_format("utc", "yyyy-MM-dd HH:mm")).orderBy("zone").collect()]
    assert got == [("z1", "2025-12-31 15:30"), ("z2", "2026-01-01 05:30"), ("z3", None)]


def test_written_partitions_are_replaced_and_others_kept(spark, tmp_path):
    target = str(tmp_path / "t")
    silver.write_silver(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), target, ["day"])
    silver.write_silver(spark.createDataFrame([(3, "b")], "v int, day string"), target, ["day"])
    assert collect(silver.read_silver(spark, target), "v") == [(1, "a"), (3, "b")]


def test_price_as_of_against_brute_force(spark):
    random.seed(2)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    prices = [(p, day(d), random.randint(1, 99)) for p in (1, 2) for d in random.sample(range(60), 9)]
    facts = [(i, random.choice([1, 2, 3, None]), day(random.randrange(-5, 70))) for i in range(300)]
    got = history.price_as_of(
        spark.createDataFrame(facts, "i int, p int, d date"),
        spark.createDataFrame(prices, "p int, valid_from date, price int"),
        ["p"], "d", "price",
    )
    want = []
    for i, p, d in facts:
        known = [(start, price) for q, start, price in prices if q == p and start <= d]
        want.append((i, p, d, max(known)[1] if known else None))
    assert collect(got, "i") == want


def test_price_intervals_and_versions(spark):
    prices = spark.createDataFrame([(1, "2024-01-01", 5), (1, "2024-02-01", 6), (2, "2024-01-05", 7)], "p int, valid_from string, price int")
    assert collect(history.price_intervals(prices, ["p"]), "p", "valid_from") == [
        (1, "2024-01-01", 5, "2024-02-01"), (1, "2024-02-01", 6, None), (2, "2024-01-05", 7, None),
    ]
    extracts = spark.createDataFrame(
        [(1, d, c) for d, c in enumerate(["x", "x", None, None, "x", "y"])] + [(2, 0, None)], "k int, day int, city string"
    )
    assert collect(history.scd2_history(extracts, ["k"], ["city"], "day"), "k", "valid_from") == [
        (1, "x", 0, 2, False), (1, None, 2, 4, False), (1, "x", 4, 5, False), (1, "y", 5, None, True), (2, None, 0, None, True),
    ]


def test_upserts_keep_the_newer_row(spark, tmp_path):
    stored = spark.createDataFrame([(1, "2026-02-02", "new"), (2, "2026-01-01", "x")], "k int, day string, v string")
    changes = spark.createDataFrame(
        [(1, "2026-01-01", "old"), (2, "2026-01-01", "y"), (3, "2026-01-05", "a"), (3, "2026-01-04", "b")], stored.schema
    )
    want = [(1, "2026-02-02", "new"), (2, "2026-01-01", "y"), (3, "2026-01-05", "a")]
    assert sorted(map(tuple, silver.upsert(stored, changes, ["k"], ["day"]).collect())) == want
    target = str(tmp_path / "t")
    silver.write_silver(stored, target, ["day"])
    silver.upsert_stored(changes, target, ["k"], ["day"], str(tmp_path / "s"), ["day"])
    assert sorted(map(tuple, silver.read_silver(spark, target, stored.schema).select("k", "day", "v").collect())) == want


def test_a_load_without_order_keeps_one_row_of_a_key(spark, tmp_path):
    changes = spark.createDataFrame([(1, "p", "a"), (1, "p", "b"), (1, "q", "a")], "k int, part string, v string")
    target = str(tmp_path / "t")
    silver.upsert_stored(changes, target, ["k"], ["part"], str(tmp_path / "s"))
    assert [tuple(r) for r in silver.read_silver(spark, target, changes.schema).select("k", "part", "v").collect()] == [(1, "q", "a")]
    assert [tuple(r) for r in silver.upsert(changes.limit(0), changes, ["k"]).collect()] == [(1, "q", "a")]


def test_a_stored_upsert_computes_its_changes_once(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    target = str(tmp_path / "t")
    for run, rows in enumerate(([(1, "p", "a"), (2, "p", "a"), (3, "q", "a")], [(1, "q", "b"), (1, "q", "a"), (3, "p", "c")])):
        given = spark.createDataFrame(rows, "k int, part string, v string")
        silver.upsert_stored(given.mapInPandas(count, given.schema), target, ["k"], ["part"], str(tmp_path / f"s{run}"))
    assert computed.value == 6
    got = silver.read_silver(spark, target, given.schema).select("k", "part", "v")
    assert sorted(map(tuple, got.collect())) == [(1, "q", "b"), (2, "p", "a"), (3, "p", "c")]
    with pytest.raises(Exception, match="a change has no k"):
        bad = spark.createDataFrame([(None, "p", "x")], given.schema)
        silver.upsert_stored(bad, target, ["k"], ["part"], str(tmp_path / "s2"))
    assert got.count() == 3
