import datetime as dt

import pytest
from pyspark.sql import functions as F

from cratework.operators import quality
from cratework.sources import erp

D = dt.date
T0 = dt.datetime(2026, 1, 1)
# One sound row per table, in column order; timestamps are added.
SOUND = {
    "region": (1, "RU-MOW", "Moscow", "city", "Central"),
    "address": (1, 1, "Moscow", None, "Main", "1", None, None),
    "customer": (1, "C1", "Pharmacy", "1", "a@b", "retail", 1),
    "customer_warehouse": (1, 1, "W1", "West", 1, D(2020, 1, 1), None),
    "manufacturer_warehouse": (1, "M1", "Main", 1),
    "brand": (1, "Brand"),
    "dosage_form": (1, "tablet", "piece"),
    "product": (1, "0001", 1, 1, "Drug", "drug", "5 mg", 10, 24, D(2020, 1, 1), None, True),
    "batch": (1, "B1", 1, D(2025, 1, 1), D(2027, 1, 1)),
    "price_list": (1, 1, D(2025, 1, 1), 5),
    "customer_order": (1, "O1", 1, 1, T0, D(2026, 1, 5), "new"),
    "order_item": (1, 1, 1, 1, 5, None, "pending"),
    "shipment": (1, "S1", 1, 1, T0, None),
    "shipment_item": (1, 1, 1, 1, 5),
    "customer_return": (1, "R1", 1, 1, D(2026, 2, 1), None),
    "customer_return_item": (1, 1, 1, 1, "expired"),
}


@pytest.fixture(scope="module")
def tables(spark):
    def build(name):
        schema = erp.TABLES[name].schema
        row = (*SOUND[name], *[T0] * (len(schema) - len(SOUND[name])))
        texts = [None if v is None else str(v) for v in row]
        df = spark.createDataFrame([tuple(texts)], ", ".join(f"{f.name} string" for f in schema))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])

    return {name: build(name) for name in erp.TABLES}


def broken(report):
    return {(r["table_name"], r["rule_kind"], r["rule"]): r["violations"] for r in report.where("violations > 0").collect()}


def changed(tables, name, **values):
    df = tables[name]
    changes = {c: F.lit(v).cast(df.schema[c].dataType) for c, v in values.items()}
    return {**tables, name: df.unionByName(df.withColumns(changes))}


def test_sound_tables_break_nothing(tables):
    report = quality.constraint_report(tables, erp.TABLES)
    assert broken(report) == {}
    assert report.count() == 183


def test_every_check_and_domain_can_fail(tables):
    cases = [
        ("customer_warehouse", {"customer_warehouse_id": 2, "closed_date": "2019-01-01"}, "closed_date >= opened_date"),
        ("product", {"pack_quantity": 0}, "pack_quantity > 0"),
        ("product", {"discontinued_date": "2019-01-01"}, "discontinued_date >= launch_date"),
        ("batch", {"expiry_date": "2025-01-01"}, "expiry_date > manufacture_date"),
        ("price_list", {"list_price": 0}, "list_price > 0"),
        ("order_item", {"confirmed_quantity": 6}, "confirmed_quantity <= ordered_quantity"),
        ("order_item", {"confirmed_quantity": -1}, "confirmed_quantity >= 0"),
        ("customer_return", {"received_date": "2026-01-31"}, "received_date >= request_date"),
        ("customer_return_item", {"reason": "lost"}, "reason"),
        ("customer_order", {"status": "open"}, "status"),
    ]
    for name, values, rule in cases:
        bad = changed(tables, name, **values)[name]
        found = broken(quality.count_row_rules(bad, name, quality.row_rules(erp.TABLES[name])))
        assert [(k[2], v) for k, v in found.items()] == [(rule, 1)], (name, values)
        assert quality.failing_rows(bad, erp.TABLES[name]).count() == 1


def test_keys_and_parents(tables):
    bad = changed(tables, "order_item", order_item_id=2, product_id=9)
    report = broken(quality.constraint_report({n: bad[n] for n in ("order_item", "product", "price_list")}, erp.TABLES))
    assert report == {
        ("order_item", "foreign", "product_id -> product"): 1,
        ("order_item", "foreign", "price_list_id, product_id -> price_list"): 1,
    }
    twice = changed(tables, "order_item", order_item_id=2)
    report = broken(quality.constraint_report({"order_item": twice["order_item"]}, erp.TABLES))
    assert report == {("order_item", "unique", "customer_order_id, product_id"): 1}


def test_null_keys_pass(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (5, None), (5, 2)], "a int, b int")
    assert quality.duplicate_keys(df, ["a", "b"]).count() == 0
    parent = spark.createDataFrame([(5, 2)], "x int, y int")
    key = erp.ForeignKey(("a", "b"), "p", ("x", "y"))
    assert quality.missing_parents(df, parent, key).count() == 0
    other = erp.ForeignKey(("a",), "p", ("y",))
    assert [tuple(r) for r in quality.missing_parents(df, parent, other).collect()] == [(5, 2)]
    assert quality.orphans(df, parent, other).count() == 2


def test_changes_use_the_right_time_column(tables):
    assert erp.extract_changes(tables["batch"], "batch", "2025-12-31").count() == 1
    assert erp.extract_changes(tables["region"], "region", "2026-01-01").count() == 0
    assert [n for n, t in erp.TABLES.items() if t.append_only] == [
        "address", "batch", "price_list", "shipment_item", "customer_return_item",
    ]


def test_snapshot_and_options(spark, tables, tmp_path):
    tables["price_list"].write.parquet(str(tmp_path / "price_list"))
    assert erp.read_erp(spark, "price_list", str(tmp_path)).count() == 1
    assert erp.jdbc_options("jdbc:postgresql://h/db", "order_item", (1, 100), 8) == {
        "url": "jdbc:postgresql://h/db", "dbtable": "erp.order_item", "partitionColumn": "order_item_id",
        "lowerBound": "1", "upperBound": "100", "numPartitions": "8", "fetchsize": "10000",
    }
    assert erp.publish_options("jdbc:x", "mart")["truncate"] == "true"
    erp.publish_mart(tables["brand"], "brands", folder=str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "brands")).count() == 1


def test_keys_are_counted_in_passes_and_buckets(spark, monkeypatch):
    """As few as fit at a time; the counts are those of plain groups and anti joins."""
    monkeypatch.setattr(quality, "PASS_USES", 900)
    monkeypatch.setattr(quality, "TASK_USES", 64)
    passes = []
    monkeypatch.setattr(quality, "pack_uses", lambda df, uses, bits, pack=quality.pack_uses: passes.append((uses, bits)) or pack(df, uses, bits))
    one = [(i % 90 if i % 7 else None, f"t{i % 50}", i % 3) for i in range(400)] + [(7, "hot", 1)] * 200
    two = [(i, None if i % 9 == 0 else f"t{i % 60}", i % 4) for i in range(0, 120, 2)]
    two += two[:5]
    tables = {"one": spark.createDataFrame(one, "a bigint, b string, c int"), "two": spark.createDataFrame(two, "x bigint, y string, z int")}
    rules = {
        "one": erp.Table("a bigint, b string, c int", ("a", "b", "c"), (("a", "b"), ("b",)), (
            erp.ForeignKey(("a",), "two", ("x",)), erp.ForeignKey(("b", "c"), "two", ("y", "z")), erp.ForeignKey(("b",), "one", ("b",)),
        )),
        "two": erp.Table("x bigint, y string, z int", ("x", "y", "z"), (("x",), ("y", "z"), ("z",)), (erp.ForeignKey(("x",), "one", ("a",)),)),
    }
    report = quality.constraint_report(tables, rules)
    got = {(r["table_name"], r["rule_kind"], r["rule"]): r["violations"] for r in report.collect()}
    want = {}
    for name, table in rules.items():
        for keys in table.unique:
            want[name, "unique", ", ".join(keys)] = quality.duplicate_keys(tables[name], list(keys)).count()
        for key in table.foreign:
            rule = f"{', '.join(key.columns)} -> {key.parent}"
            want[name, "foreign", rule] = quality.orphans(tables[name], tables[key.parent], key).count()
    assert got == want
    assert all(want[k] for k in want if k != ("one", "foreign", "b -> one"))
    assert len(passes) > 2 and max(bits for _, bits in passes) > 2
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r["violations"] for r in quality.constraint_report(empty, rules).collect()} == {0}
