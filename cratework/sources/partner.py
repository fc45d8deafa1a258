"""The pharmacy partner's ten daily files: bronze schemas and first typed tables.

Stated by the agreement: the file names and formats, ``fulfillment_center_code``,
``channel``, ``event_type``, ``cancelled_items``, ``event_ts``, ``order_id`` and
``receipt_ts``. ALL OTHER COLUMNS ARE OUR ASSUMPTION and have to be agreed with the
partner before use; a file with other columns goes to quarantine, never to a mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework.operators import silver
from cratework.operators.contract import text_schema

# Assumed columns, in file order.
CSV_COLUMNS = {
    "commercial_zones": ["zone_code", "zone_name", "region_iso_code", "time_zone"],
    "pharmacies": ["pharmacy_code", "pharmacy_name", "zone_code"],
    "fulfillment_centers": ["fulfillment_center_code", "center_name", "zone_code"],
    "products": ["gtin", "product_name"],
    "retail_prices": ["gtin", "zone_code", "channel", "valid_from_ts", "price"],
    "inventory": ["inventory_date", "fulfillment_center_code", "gtin", "batch_number", "on_hand"],
    "online_orders": ["order_id", "order_ts", "pharmacy_code", "fulfillment_center_code"],
    "online_order_items": ["order_id", "gtin", "quantity"],
}
# Fields of nested objects are listed by name: that is the order in which Arrow infers them.
ITEMS = T.ArrayType(text_schema(["gtin", "quantity"]))
JSON_SCHEMAS = {
    "online_order_events": text_schema(["event_id", "order_id", "zone_code", "event_type", "event_ts"]).add(
        "cancelled_items", ITEMS
    ),
    "pos_receipts": text_schema(["receipt_id", "pharmacy_code", "zone_code", "receipt_ts", "order_id"])
    .add("products", T.ArrayType(text_schema(["gtin", "price", "quantity"])))
    .add("payments", T.ArrayType(text_schema(["amount", "method"]))),
}
SCHEMAS: dict[str, T.StructType] = {
    **{name: text_schema(columns) for name, columns in CSV_COLUMNS.items()},
    **JSON_SCHEMAS,
}

LOCAL_TIME = "yyyy-MM-dd HH:mm:ss"
QUANTITY = silver.Cast("bigint")
MONEY = silver.Cast("decimal(18,2)")


def receipt_lines(receipts: DataFrame) -> DataFrame:
    """Products sold, one row per receipt line, with the local time as text."""
    lines = silver.explode_struct(receipts, "products", ["receipt_id", "pharmacy_code", "zone_code", "receipt_ts", "order_id"])
    return silver.cast_columns(lines, {"quantity": QUANTITY, "price": MONEY})


def receipt_payments(receipts: DataFrame) -> DataFrame:
    """Payments, one row each. Products and payments are two tables, never one product."""
    paid = silver.explode_struct(receipts, "payments", ["receipt_id", "pharmacy_code"])
    return silver.cast_columns(paid, {"amount": MONEY})


def cancelled_lines(events: DataFrame) -> DataFrame:
    """Packs of online orders cancelled, one row per product and event."""
    cancelled = events.where("event_type = 'items_cancelled'")
    lines = silver.explode_struct(cancelled, "cancelled_items", ["event_id", "order_id", "zone_code", "event_ts"])
    return silver.cast_columns(lines, {"quantity": QUANTITY})


def with_day(df: DataFrame, local: str) -> DataFrame:
    """The local calendar day of a local time, which is the day the partner sells and reports by."""
    return df.withColumn("day", F.try_to_timestamp(F.col(local), F.lit(LOCAL_TIME)).cast("date"))
