"""A partner day from ZIP archives to marts."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cratework.operators import bronze, silver
from cratework.plans import marts
from cratework.sources import archives as zips
from cratework.sources import partner

DAY = "2026-10-09"


def receipt(n, pharmacy, products, order=None):
    return {
        "receipt_id": f"R{n}", "pharmacy_code": pharmacy, "zone_code": "Z1", "receipt_ts": f"{DAY} 23:30:00",
        "order_id": order, "products": products, "payments": [{"method": "card", "amount": 9.90}, {"method": "cash", "amount": 1}],
    }


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    import zipfile

    root = tmp_path_factory.mktemp("partner")
    pack = {"gtin": "g1", "quantity": 2, "price": 5.45}
    members = {name: {f"{name}-{DAY}.csv": (",".join(columns) + "\n").encode()} for name, columns in partner.CSV_COLUMNS.items()}
    members["commercial_zones"][f"commercial_zones-{DAY}.csv"] += b"Z1,East,RU-PRI,Asia/Vladivostok\n"
    members["inventory"][f"inventory-{DAY}.csv"] += f"{DAY},W1,g1,B1,30\n{DAY},W1,g2,B2,5\n".encode()
    members["products"] = {f"products-{DAY}.csv": b"gtin,name\ng1,Drug\n"}
    members["pos_receipts"] = {
        f"pos_receipts-{DAY}-PH-0001.json": [receipt(1, "PH-0001", [pack, {**pack, "gtin": "g2"}], "O1"), receipt(2, "PH-0001", [pack], "O2")],
        f"pos_receipts-{DAY}-PH-0002.json": [receipt(3, "PH-0002", [pack], "O3")],
    }
    events = {
        f"online_order_events-{DAY}-{hour:02d}.json": [
            {"event_id": f"E{hour}", "order_id": f"O{hour}", "zone_code": "Z1", "event_type": "items_cancelled" if hour < 3 else "confirmed",
             "event_ts": f"{DAY} {hour:02d}:10:00", "cancelled_items": [{"gtin": "g1", "quantity": hour + 1}]}
        ]
        for hour in range(24)
    }
    members["online_order_events"] = events
    for dataset, entries in members.items():
        path = root / f"landing/pharmacy/{dataset}/ingest_date={DAY}/{dataset}-{DAY}.zip"
        path.parent.mkdir(parents=True)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, data in entries.items():
                archive.writestr(name, data if isinstance(data, bytes) else json.dumps(data))
    target = str(root / "bronze")
    bronze.load_archives(zips.list_archives(spark, str(root / "landing"), [DAY]), target, partner.SCHEMAS, "run-1")
    return target


def read(spark, target, dataset):
    return bronze.read_bronze(spark, target, "pharmacy", dataset, partner.SCHEMAS[dataset], [DAY])


def test_all_ten_archives_are_loaded(spark, day):
    ledger = {r["dataset_name"]: r for r in bronze.read_ledger(spark, day).collect()}
    assert sorted(ledger) == sorted(marts.DATASETS)
    assert {r["status"] for r in ledger.values()} == {"complete"}
    assert {n for n, r in ledger.items() if r["invalid"]} == {"products"}
    assert ledger["online_order_events"]["uploaded"] == 24


def test_demand_from_nested_members(spark, day):
    receipts = read(spark, day, "pos_receipts")
    sold = partner.with_day(partner.receipt_lines(receipts), "receipt_ts").withColumnRenamed("gtin", "product_id")
    lost = partner.with_day(partner.cancelled_lines(read(spark, day, "online_order_events")), "event_ts").withColumnRenamed("gtin", "product_id")
    demand = marts.patient_demand(sold, lost).orderBy("product_id").collect()
    assert [tuple(r) for r in demand] == [("g1", dt.date(2026, 10, 9), 6, 6, 12), ("g2", dt.date(2026, 10, 9), 2, 0, 2)]
    paid = partner.receipt_payments(receipts).groupBy("method").agg(F.sum("amount").alias("amount"))
    assert {r["method"]: str(r["amount"]) for r in paid.collect()} == {"card": "29.70", "cash": "3.00"}


def test_local_times_become_utc(spark, day):
    zones = read(spark, day, "commercial_zones")
    lines = read(spark, day, "pos_receipts").withColumn("t", F.to_timestamp("receipt_ts", partner.LOCAL_TIME))
    utc = silver.local_to_utc(lines, zones, "zone_code", "t", "utc")
    assert {r[0] for r in utc.select(F.date_format("utc", "yyyy-MM-dd HH:mm")).collect()} == {"2026-10-09 13:30"}


def test_scorecard_from_the_ledger(spark, day):
    expected = marts.expected_deliveries(
        spark.createDataFrame(
            [(n, 24 if n == marts.HOURLY_DATASET else 400 if n == marts.PER_PHARMACY_DATASET else 1) for n in marts.DATASETS],
            "dataset_name string, expected_members int",
        ),
        F.lit(DAY).cast("date"),
        F.lit("2026-10-10").cast("date"),
    )
    ledger = bronze.read_ledger(spark, day).withColumn("modificationTime", F.lit("2026-10-10 05:00:00").cast("timestamp"))
    card = marts.delivery_scorecard(expected, marts.delivered_from_ledger(ledger))
    rows = {(r["dataset_name"], str(r["day"])): r for r in card.collect()}
    assert len(rows) == 20
    today = {n: (rows[n, DAY]["on_time"], rows[n, DAY]["complete"], rows[n, DAY]["agreed_format"], rows[n, DAY]["payable"]) for n in marts.DATASETS}
    assert today["products"] == (True, True, False, False)
    assert today["pos_receipts"] == (True, False, True, False)
    assert {v for n, v in today.items() if n not in ("products", "pos_receipts")} == {(True, True, True, True)}
    assert not any(rows[n, "2026-10-10"]["payable"] for n in marts.DATASETS)


def test_events_pick_their_archives(spark, day):
    landing = day.removesuffix("/bronze") + "/landing"
    events = spark.createDataFrame([(f"pharmacy/products/ingest_date={DAY}/products-{DAY}.zip",)], "landing_key string")
    archives = zips.list_archives(spark, landing)
    assert [r["zip_file_name"] for r in zips.of_events(archives, events).collect()] == [f"products-{DAY}.zip"]
    assert zips.list_archives(spark, landing, ["2020-01-01"]).count() == 0
