"""What was known then, against a scan of all prices."""

import datetime as dt
import random

import pytest

from cratework.operators import bitemporal

PRICES = "product string, zone string, valid_from date, known_from timestamp, price int"
FACTS = "n int, product string, zone string, day date, known timestamp, price string"


def day(n):
    return None if n is None else dt.date(2025, 1, 1) + dt.timedelta(days=n)


def moment(n):
    return None if n is None else dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def plain(prices, product, zone, on, known):
    if None in (product, zone, on, known):
        return None
    held = [(v, k, p) for a, z, v, k, p in prices if (a, z) == (product, zone) and v is not None and k is not None and v <= on and k <= known]
    return max(held)[2] if held else None


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_scan(spark, seed):
    rng = random.Random(seed)
    prices = [(rng.choice("aab"), rng.choice("yz"), rng.randrange(0, 300, 7), rng.randrange(0, 400, 5), rng.randrange(99)) for _ in range(120)]
    prices += [("a", "y", 14, 3, 1), ("a", "y", 14, 3, 2), ("a", "y", None, 5, 3), ("a", "y", 5, None, 3), (None, "y", 1, 1, 4)]
    asked = [(rng.choice("aabc"), rng.choice("yz"), rng.randrange(-5, 330), rng.randrange(-5, 420)) for _ in range(300)]
    asked += [("a", "y", None, 3), ("a", "y", 3, None), (None, "y", 3, 3)] + asked[:5]
    rows = spark.createDataFrame([(p, z, day(v), moment(k), x) for p, z, v, k, x in prices], PRICES)
    facts = spark.createDataFrame([(n, p, z, day(d), moment(k), "own") for n, (p, z, d, k) in enumerate(asked)], FACTS)
    rectangles = bitemporal.price_rectangles(rows, ["product", "zone"])
    found = bitemporal.price_as_known(facts, rectangles, ["product", "zone"], "day", "known")
    assert found.columns == [*facts.columns, "price_as_known"]
    got = {r.n: r.price_as_known for r in found.collect()}
    assert got == {n: plain(prices, *q) for n, q in enumerate(asked)}


def test_rectangles_are_disjoint_and_few():
    rng = random.Random(9)
    rows = sorted({(rng.randrange(200), rng.randrange(40)) for _ in range(150)})
    parts = bitemporal._split([v for _, v in rows], [k for k, _ in rows])
    assert len(parts) <= 3 * len(rows)
    for v in range(40):
        for k in range(0, 200, 3):
            hit = [r for r, a, b, c, d in parts if a <= v and (b is None or v < b) and c <= k and (d is None or k < d)]
            known = [(y, x, n) for n, (x, y) in enumerate(rows) if y <= v and x <= k]
            assert hit == ([max(known)[2]] if known else [])


def test_rectangles_equal_those_made_row_by_row(spark):
    """No task but Spark's own works on a key; a price that is null is known too, and ends what was."""
    rng = random.Random(4)
    prices = {(p, rng.randrange(0, 60, 3), rng.randrange(0, 90, 5)): rng.choice([None, *range(9)]) for p in "abc" for _ in range(60)}
    rows = spark.createDataFrame([(p, "y", day(v), moment(k), x) for (p, v, k), x in prices.items()], PRICES)
    found = bitemporal.price_rectangles(rows, ["product", "zone"])
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    wanted = []
    for product in "abc":
        held = sorted(((k, v, x) for (p, v, k), x in prices.items() if p == product), key=lambda r: r[:2])
        for n, a, b, c, d in bitemporal._split([v for _, v, _ in held], [k for k, _, _ in held]):
            wanted.append((product, "y", day(a), day(b), moment(c), moment(d), held[n][2]))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


def test_keys_with_many_rectangles_are_looked_up_by_bucket(spark, monkeypatch):
    rng = random.Random(7)
    prices = [("a", "y", rng.randrange(0, 900, 7), rng.randrange(0, 400, 5), rng.randrange(99)) for _ in range(200)]
    prices += [("b", "y", 3, 4, 1), (None, "y", 3, 4, 1)]
    asked = [(rng.choice("aab"), "y", rng.randrange(-5, 950), rng.randrange(-5, 420)) for _ in range(300)]
    asked += [("a", "y", None, 3), ("a", "y", 3, None), (None, "y", 9, 9)]
    rows = spark.createDataFrame([(p, z, day(v), moment(k), x) for p, z, v, k, x in prices], PRICES)
    facts = spark.createDataFrame([(n, p, z, day(d), moment(k), "own") for n, (p, z, d, k) in enumerate(asked)], FACTS)
    rectangles = bitemporal.price_rectangles(rows, ["product", "zone"])
    monkeypatch.setattr(bitemporal, "MANY_RECTANGLES", 8)
    found = bitemporal.price_as_known(facts, rectangles, ["product", "zone"], "day", "known")
    assert {r.n: r.price_as_known for r in found.collect()} == {n: plain(prices, *q) for n, q in enumerate(asked)}


def test_empty(spark):
    rectangles = bitemporal.price_rectangles(spark.createDataFrame([], PRICES), ["product", "zone"])
    assert rectangles.count() == 0
    facts = spark.createDataFrame([(1, "a", "y", day(1), moment(1), "x")], FACTS)
    assert [r.price_as_known for r in bitemporal.price_as_known(facts, rectangles, ["product", "zone"], "day", "known").collect()] == [None]
    assert bitemporal.price_as_known(facts.limit(0), rectangles, ["product", "zone"], "day", "known").count() == 0
