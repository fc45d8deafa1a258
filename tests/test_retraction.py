"""Silver under late, repeated and corrected deliveries, against a rebuild from all archives."""

import random

import pytest
from pyspark.sql import types as T

from cratework.operators import bronze, retraction
from cratework.operators.contract import text_schema
from cratework.sources import archives as zips

SCHEMA = T.StructType().add("k", "long").add("v", "string").add("part", "string")
DELIVERED = "k long, v string, part string, ingest_date string, zip_name string"


def rebuilt(archives):
    """The row of each key in the last delivery that has it."""
    out = {}
    for _, rows in sorted(archives.items()):
        best = {}
        for row in rows:
            best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:])
        out |= best
    return sorted(out.values())


def bring(spark, table, archives, names):
    rows = [(*row, *name) for name in names for row in archives[name]]
    return retraction.apply_deliveries(
        table, spark.createDataFrame(names, "ingest_date string, zip_name string"), spark.createDataFrame(rows, DELIVERED)
    )


@pytest.mark.parametrize("seed", [1])
def test_any_order_of_deliveries_and_corrections_equals_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    table = retraction.SilverTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), (), ("part",), buckets=2)
    names = [(f"2026-01-0{d}", z) for d in (1, 2, 3) for z in ("a", "b")]
    archives = {}
    for _ in range(4):
        chosen = rng.sample(names, rng.randint(1, 3))
        for name in chosen:
            archives[name] = [(rng.randrange(12), rng.choice("xyz"), rng.choice("pq")) for _ in range(rng.randint(0, 8))]
        bring(spark, table, archives, chosen)
        assert sorted(map(tuple, table.current.rows().collect())) == rebuilt(archives)
        versions = {(r.ingest_date, r.zip_name, r.k) for r in table.versions.rows().collect()}
        assert versions == {(*name, row[0]) for name, rows in archives.items() for row in rows}
    assert bring(spark, table, archives, names[:0] + [n for n in names if n in archives]).count() == 0  # nothing new


def test_signed_changes(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (5, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d"), (4, None), (5, None)], "k int, v string")
    rows = retraction.signed_changes(before, after, ["k"]).collect()
    assert sorted(map(tuple, rows)) == [(2, "c", "update"), (3, "d", "update"), (4, None, "insert")]
    assert [tuple(r) for r in retraction.signed_changes(before.where("k = 2"), after.limit(0), ["k"]).collect()] == [(2, "b", "delete")]


def test_a_row_order_goes_before_the_day(spark, tmp_path):
    table = retraction.SilverTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), ("v",), (), buckets=2)
    archives = {("2026-01-02", "a"): [(1, "5", "p")], ("2026-01-03", "a"): [(1, "4", "q")]}
    bring(spark, table, archives, list(archives))
    assert [tuple(r) for r in table.current.rows().collect()] == [(1, "5", "p")]


def test_loads_of_archives(spark, tmp_path, make_zip):
    """Through bronze: a corrected archive loses a row, one gets empty, one breaks, one comes late."""
    columns = ["k", "v", "part"]
    table = retraction.SilverTable(spark, str(tmp_path / "silver"), SCHEMA, ("k",), (), ("part",), buckets=2)
    root, target = tmp_path / "landing", str(tmp_path / "bronze")
    run = 0

    def land(day, name, text):
        make_zip(f"feed/d/ingest_date={day}/{name}.zip", {"rows.csv": text.encode()}, root)

    def load():
        nonlocal run
        run += 1
        found = zips.list_archives(spark, str(root))
        todo = bronze.pending_archives(found, bronze.read_ledger(spark, target), target)
        bronze.load_archives(todo, target, {"d": text_schema(columns)}, f"run-{run}")
        return retraction.load_deliveries(
            table, target, "feed", "d", text_schema(columns),
            lambda rows: rows.selectExpr("cast(k as long) as k", "v", "part", *retraction.DELIVERY),
        )

    def now():
        return sorted(map(tuple, table.current.rows().collect()))

    head = "k,v,part\n"
    land("2026-01-01", "a", head + "1,one,p\n2,two,p\n3,three,p\n")
    land("2026-01-02", "b", head + "2,TWO,q\n4,four,p\n")
    assert load() == {"insert": 5, "update": 0, "delete": 0}
    assert now() == [(1, "one", "p"), (2, "TWO", "q"), (3, "three", "p"), (4, "four", "p")]
    land("2026-01-02", "b", head + "4,FOUR,p\n5,five,p\n")
    assert load() == {"insert": 1, "update": 1, "delete": 1}
    assert now() == [(1, "one", "p"), (2, "two", "p"), (3, "three", "p"), (4, "FOUR", "p"), (5, "five", "p")]
    land("2025-12-31", "old", head + "1,older,p\n9,nine,p\n")
    assert load() == {"insert": 2, "update": 0, "delete": 0}
    assert now()[0] == (1, "one", "p") and now()[-1] == (9, "nine", "p")
    land("2026-01-02", "b", "")  # an empty member: the archive has nothing any more
    assert load()["delete"] == 2
    assert now() == [(1, "one", "p"), (2, "two", "p"), (3, "three", "p"), (9, "nine", "p")]
    make_zip("feed/d/ingest_date=2026-01-01/a.zip", {"rows.json": b'{"k": 1'}, root)  # breaks: the last good load stays
    assert load() == {"insert": 0, "update": 0, "delete": 0}
    assert now()[0] == (1, "one", "p")
    assert load() == {"insert": 0, "update": 0, "delete": 0}
