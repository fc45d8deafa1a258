"""The plans are the ones meant: pruned scans, partial aggregates, no cross joins."""

import re

import pytest
import __spark_entry__ as entry
from cratework.operators import bronze, contract, silver
from cratework.plans import table_queries
from cratework.sources import archives as zips

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_listing_reads_no_content(spark, make_zip, tmp_path):
    make_zip("s/d/ingest_date=1/a.zip", {"a.csv": b"id\n1\n"})
    plan = plan_of(zips.list_archives(spark, str(tmp_path / "landing")))
    assert "content" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_bronze_reads_only_marked_folders_of_the_asked_dates(spark, make_zip, tmp_path):
    schema = contract.text_schema(["id", "b"])
    for day, name in (("2026-01-01", "a"), ("2026-01-02", "b")):
        make_zip(f"s/d/ingest_date={day}/{name}.zip", {"a.csv": b"id,b\n1,2\n", "x.csv": b"z\n1\n"})
    target = str(tmp_path / "bronze")
    bronze.load_archives(zips.list_archives(spark, str(tmp_path / "landing")), target, {"d": schema}, "r")
    df = bronze.read_bronze(spark, target, "s", "d", schema, ["2026-01-02"])
    assert {f.split("/bronze/")[1].split("/")[2] for f in df.inputFiles()} == {"ingest_date=2026-01-02"}
    plan = plan_of(df.select("b"))
    assert "ReadSchema: struct<b:string>" in plan
    assert re.search(r"PartitionFilters: \[.*schema_status#\d+ = valid", plan)
    (tmp_path / "bronze/s/d/ingest_date=2026-01-02/zip_name=b/_SUCCESS").unlink()
    open_load = bronze.read_bronze(spark, target, "s", "d", schema)
    assert [r["zip_name"] for r in open_load.select("zip_name").collect()] == ["a"]
    assert re.search(r"PartitionFilters: \[.*zip_name#\d+ = b", plan_of(open_load))


def test_change_extract_is_pushed_down(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(silver.changed_since(orders, "o_orderdate", "2000-01-01").select("o_orderkey"))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_orderdate", plan)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


RELATIONAL = [n for n in table_queries.QUERIES if n not in ("constraint_report", "silver_table_roundtrip", "stream_dedupe_window")]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_joins_and_no_python_in_relational_queries(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInArrow", "MapInPandas"):
        assert banned not in plan, banned


@pytest.mark.parametrize("name", ["silver_dedupe_latest", "order_lifecycle", "stock_balance", "dq_unique", "patient_demand"])
def test_groups_are_reduced_before_the_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert re.search(r"partial_(max|count|sum|min)", plan)
    assert "Window" not in plan


def test_only_bounded_windows(spark):
    """Every window partition is a key and the rows under it are one per day or extract."""
    for name in RELATIONAL:
        plan = plan_of(entry.queries()[name](spark, SF))
        for arguments in re.findall(r"\) Window\nInput.*\nArguments: (.*)", plan):
            keys = re.findall(r"\], \[([^\]]*)\], \[", arguments)
            assert keys and all(keys), name


def test_orders_without_lines_are_found_without_a_sort(spark, tmp_path):
    lines = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double"
    spark.createDataFrame([(1, 5, 1, 2.0), (1, 6, 2, 3.0), (9, 7, 1, 1.0), (None, 8, 1, 1.0)], lines).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    df = entry.queries()["flatten_order_lines"](spark, str(tmp_path))
    got = sorted(map(str, map(tuple, df.collect())))
    want = [(1, 1, 5, 2), (1, 2, 6, 3), (2, None, None, None), (2, None, None, None), (3, None, None, None), (None, None, None, None)]
    assert got == sorted(map(str, want))
    assert "LeftAnti" not in plan_of(df)


def test_orders_meet_their_places_before_the_shipped_lines_do(spark):
    plan = entry.queries()["sell_in_mart"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join LeftOuter, \((\w+)#", plan)
    assert joins.index("customer_order_id") < joins.index("customer_warehouse_id")  # the outer one comes first


def test_shipped_lines_are_written_half_way(spark):
    """The shuffles of shipments and order items are over, and can go, before orders and goods are shuffled."""
    from cratework.plans import marts

    df = entry.queries()["sell_in_mart"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not {"shipment_id", "order_item_id"} & set(re.findall(r"Join LeftOuter, \((\w+)#", plan))
    assert "shipment_number" not in plan and "price_list_id" not in plan
    views = {
        "shipment_item": "shipment_item_id int, shipment_id int, order_item_id int, batch_id int, shipped_quantity int",
        "shipment": "shipment_id int, shipment_number string, ship_timestamp timestamp",
        "order_item": "order_item_id int, customer_order_id int, price_list_id int",
        "customer_order": "customer_order_id int, order_number string, customer_id int, customer_warehouse_id int",
        "customer_warehouse": "customer_warehouse_id int, customer_warehouse_code string, address_id int",
        "address": "address_id int, region_id int",
        "region": "region_id int, region_name string, sales_territory string",
        "batch": "batch_id int, batch_number string, expiry_date date, product_id int",
        "product": "product_id int, gtin string, product_name string, brand_id int, dosage_form_id int",
        "brand": "brand_id int, brand_name string",
        "dosage_form": "dosage_form_id int, dosage_form_name string",
    }
    rows = {
        "shipment_item": [(1, 1, 1, 1, 5), (2, None, 9, None, 6), (None, 1, 1, 2, None)],
        "shipment": [(1, "S1", None)],
        "order_item": [(1, 1, 7)],
        "customer_order": [(1, "O1", 3, 4)],
        "batch": [(1, "B1", None, None)],
    }
    tables = {name: spark.createDataFrame(rows.get(name, []), ddl) for name, ddl in views.items()}
    every = marts.sell_in(**tables)
    some = marts.sell_in(**tables, columns=["batch_number", "shipped_quantity", "order_number"])
    assert some.columns == ["batch_number", "shipped_quantity", "order_number"]
    assert every.columns[:3] == ["batch_id", "customer_warehouse_id", "customer_order_id"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, some.collect()), key=key) == sorted([("B1", 5, "O1"), (None, 6, None), (None, None, "O1")], key=key)
    assert sorted(map(tuple, every.select(*some.columns).collect()), key=key) == sorted(map(tuple, some.collect()), key=key)
    assert {r["shipment_number"] for r in every.collect()} == {"S1", None}
