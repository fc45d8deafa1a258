"""Versions from extracts in any order, against the batch operator over all of them."""

import datetime as dt
import random

import pytest

from cratework.operators import history
from cratework.operators.history_store import HistoryStore

EXTRACT = "k int, a string, b int"


def batch(spark, said):
    rows = [(*row, dt.date.fromisoformat(day)) for day, extract in said.items() for row in extract]
    extracts = spark.createDataFrame(rows, f"{EXTRACT}, day date")
    return sorted(map(tuple, history.scd2_history(extracts, ["k"], ["a", "b"], "day").collect()), key=str)


@pytest.mark.parametrize("seed", [1])
def test_any_order_of_extracts(spark, tmp_path, seed):
    rng = random.Random(seed)
    days = [f"{year}-{month:02d}-01" for year in (2023, 2024, 2025) for month in (2, 6, 10)]
    store = HistoryStore(spark, str(tmp_path / "h"), spark.createDataFrame([], EXTRACT).schema, ("k",))
    said = {}
    rng.shuffle(days)
    for turn, day in enumerate([*days[:7], days[2]]):  # the last one again, corrected
        said[day] = [(k, rng.choice(["x", "y", None]), rng.choice([1, 1, None])) for k in range(6) if rng.random() < 0.8]
        store.add(spark.createDataFrame(said[day], EXTRACT), day)
        if turn >= 4:
            assert sorted(map(tuple, store.history().collect()), key=str) == batch(spark, said)


def test_a_late_extract_touches_its_year_only(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), spark.createDataFrame([], EXTRACT).schema, ("k",))
    rows = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], EXTRACT)
    for day in ("2023-05-01", "2024-05-01", "2025-05-01"):
        store.add(rows, day)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "h").rglob("*.parquet")}
    store.add(spark.createDataFrame([(1, "z", 1)], EXTRACT), "2024-03-01")
    assert {p.parent.name for p, t in stamps.items() if not p.exists() or p.stat().st_mtime_ns != t} == {"seen_year=2024"}
    got = sorted((r.k, r.a, str(r.valid_from), str(r.valid_to)) for r in store.history().collect())
    assert got == [
        (1, "x", "2023-05-01", "2024-03-01"), (1, "x", "2024-05-01", "None"), (1, "z", "2024-03-01", "2024-05-01"), (2, "y", "2023-05-01", "None"),
    ]
    store.add(rows.limit(0), "2023-05-01")  # that day said nothing after all
    assert sorted(str(r.valid_from) for r in store.history().collect()) == ["2024-03-01", "2024-05-01", "2024-05-01"]
    assert not (tmp_path / "h" / "seen_year=2023").exists()


def test_nothing(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), spark.createDataFrame([], EXTRACT).schema, ("k",))
    assert store.history().count() == 0
