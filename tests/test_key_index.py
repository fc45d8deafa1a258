"""Stored tables with a key index: the same rows as a full scan, from few files."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework.operators import key_index
from cratework.operators.key_index import IndexedTable

SCHEMA = T.StructType().add("k", "long").add("name", "string").add("value", "string").add("day", "string").add("version", "integer")


def make(spark, tmp_path, **how):
    how = {"keys": ("k", "name"), "partition_by": ("day",), "buckets": 4} | how
    return IndexedTable(spark, str(tmp_path / "table"), SCHEMA, **how)


def content(table):
    return sorted((tuple(r) for r in table.rows().collect()), key=str)


def test_any_sequence_of_loads_equals_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    table = make(spark, tmp_path, slices=3, buckets=2)
    want = {}
    for turn in range(3):
        changes = [
            (rng.randrange(40), rng.choice(["a", "b"]), f"{turn}-{n}", rng.choice(["d1", "d 2/x", "d3"]), rng.randrange(6)) for n in range(50)
        ]
        last = {}
        for row in sorted(changes, key=lambda r: (r[4], r[2], r[3])):
            last[row[:2]] = row
        for key, row in last.items():
            if key not in want or row[4] >= want[key][4]:
                want[key] = row
        table.upsert(spark.createDataFrame(changes, SCHEMA), ["version"])
        assert content(table) == sorted(want.values(), key=str)
    gone = [k for k in want if k[0] % 3 == 0]
    new = [(0, "a", "again", "d9", 1)]
    table.replace(spark.createDataFrame(gone, "k long, name string"), spark.createDataFrame(new, SCHEMA))
    kept = {k: v for k, v in want.items() if k not in gone} | {(0, "a"): new[0]}
    assert content(table) == sorted(kept.values(), key=str)
    table.rebuild_index()
    assert sorted(map(tuple, table.lookup(table.rows()).collect()), key=str) == content(table)


def test_few_changes_open_few_files(spark, tmp_path):
    table = make(spark, tmp_path, buckets=16)
    rows = spark.range(8000).selectExpr("id as k", "'n' as name", "'v' as value", "concat('d', id % 8) as day", "1 as version")
    table.upsert(rows, ["version"])
    files = spark.read.parquet(f"{table.path}/rows").inputFiles()
    stamps = _stamps(tmp_path)
    changes = rows.where("k % 1000 = 7").withColumns({"version": F.lit(2), "value": F.lit("new")})  # 0.1 % of the keys
    opened = table.open_folders(table.may_hold(changes)).inputFiles()
    assert len(files) == 128 and 8 <= len(opened) <= 12
    table.upsert(changes, ["version"])
    assert table.rows().where("value = 'new'").count() == 8 and table.rows().count() == 8000
    untouched = [f for f, t in _stamps(tmp_path).items() if stamps.get(f) == t]
    assert len(untouched) >= 116  # nothing else was written again
    nobody = rows.selectExpr("k + 100000 as k", "name").where("k % 100 = 0")
    assert table.may_hold(nobody).count() == 0  # key ranges
    strangers = rows.selectExpr("k", "'m' as name")
    assert table.may_hold(strangers.where("k < 300")).count() < 20  # within the ranges, so filters


def _stamps(tmp_path):
    return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "table" / "rows").rglob("*.parquet")}


def test_an_old_change_comes_late(spark, tmp_path):
    table = make(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, "a", "new", "2026-02-02", 2)], SCHEMA), ["version"])
    table.upsert(spark.createDataFrame([(1, "a", "old", "2026-01-01", 1), (2, "a", "x", "2026-01-01", 1)], SCHEMA), ["version"])
    assert content(table) == [(1, "a", "new", "2026-02-02", 2), (2, "a", "x", "2026-01-01", 1)]


def test_a_job_that_died_after_the_index_can_be_repeated(spark, tmp_path, monkeypatch):
    from cratework.operators import silver

    table = make(spark, tmp_path)
    table.upsert(spark.createDataFrame([(k, "a", "x", f"d{k % 3}", 1) for k in range(30)], SCHEMA), ["version"])
    changes = spark.createDataFrame([(k, "a", "y", f"d{(k + 1) % 3}", 2) for k in range(0, 30, 4)], SCHEMA)
    real = silver.write_silver

    def dies(df, target, *rest):
        if target.endswith("/rows"):
            raise OSError("lost")
        real(df, target, *rest)

    monkeypatch.setattr(silver, "write_silver", dies)
    with pytest.raises(OSError):
        table.upsert(changes, ["version"])
    monkeypatch.setattr(silver, "write_silver", real)
    assert {r[2] for r in content(table)} == {"x"}
    table.upsert(changes, ["version"])
    want = [(k, "a", "y", f"d{(k + 1) % 3}", 2) if k % 4 == 0 else (k, "a", "x", f"d{k % 3}", 1) for k in range(30)]
    assert content(table) == sorted(want, key=str)


def test_refused_changes(spark, tmp_path):
    table = make(spark, tmp_path)
    with pytest.raises(ValueError, match="order"):
        table.upsert(spark.createDataFrame([], SCHEMA), [])
    with pytest.raises(Exception, match="has no k, name"):
        table.upsert(spark.createDataFrame([(None, "a", "x", "d", 1)], SCHEMA), ["version"])
    table.upsert(spark.createDataFrame([], SCHEMA), ["version"])
    assert table.rows().count() == 0 and table.lookup(table.rows()).count() == 0


def test_without_partition_columns(spark, tmp_path):
    table = make(spark, tmp_path, partition_by=())
    table.upsert(spark.createDataFrame([(k, "a", "x", None, 1) for k in range(20)], SCHEMA), ["version"])
    table.upsert(spark.createDataFrame([(3, "a", "y", None, 1)], SCHEMA), ["version"])
    assert [r[2] for r in content(table)].count("y") == 1 and table.rows().count() == 20


def test_bits_of_a_bitmap(spark):
    """Bytes become numbers once for each bitmap; every place is the bit that Spark set there."""
    places = {0, 1, 7, 8, 14, 4095, 32760, 32767}
    made = spark.createDataFrame([(p,) for p in places], "place long").agg(F.bitmap_construct_agg("place").alias("bits"))
    bits = made.select(key_index._bytes("bits").alias("bits")).crossJoin(spark.range(32768))
    found = bits.where(key_index._bit("bits", F.col("id")) == 1)
    assert {r.id for r in found.select("id").collect()} == places
