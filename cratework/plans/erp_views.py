"""ERP tables derived from the star schema the driver provides.

The star schema's parts are the products, its line items the shipments, its nations
the regions. Identifiers are structs of keys, so nothing has to be numbered globally and
no two keys can meet; a snapshot holds them as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework.operators.bronze import side_by_side
from cratework.session import fresh_folder
from cratework.sources.erp import TABLES
from cratework.staging import free_shuffles

# Identifiers that are made of several keys; text in a snapshot.
KEY_TEXTS = (
    "batch_id", "order_item_id", "shipment_id", "shipment_item_id", "customer_return_id", "customer_return_item_id",
    "price_list_id", "dosage_form_id",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(name: str):
    return F.col(name).cast("decimal(18,2)")


def region(spark, sf):
    names = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf, "nation").join(names, "n_regionkey").select(
        F.col("n_nationkey").cast("bigint").alias("region_id"),
        F.concat(F.lit("XX-"), "n_nationkey").alias("iso_code"),
        F.col("n_name").alias("region_name"),
        F.lit("nation").alias("region_type"),
        F.col("r_name").alias("sales_territory"),
    )


def address(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("address_id"), F.col("c_nationkey").cast("bigint").alias("region_id")
    )


def customer(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_code"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_custkey").alias("billing_address_id"),
    )


def customer_warehouse(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_warehouse_id"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_warehouse_code"),
        F.col("c_custkey").alias("address_id"),
    )


def brand(spark, sf):
    return table(spark, sf, "part").select(
        F.substring_index("p_brand", "#", -1).cast("bigint").alias("brand_id"), F.col("p_brand").alias("brand_name")
    ).distinct()


def dosage_form(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_type").alias("dosage_form_id"), F.col("p_type").alias("dosage_form_name")
    ).distinct()


def product(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.lpad(F.col("p_partkey").cast("string"), 14, "0").alias("gtin"),
        F.substring_index("p_brand", "#", -1).cast("bigint").alias("brand_id"),
        F.col("p_type").alias("dosage_form_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").alias("pack_quantity"),
    )


def batch(spark, sf):
    """One batch per product and supplier, made a month before it first ships, good for two years."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.to_date(F.min("l_shipdate")).alias("first_day"))
        .select(
            F.struct("l_partkey", "l_suppkey").alias("batch_id"),
            F.concat_ws("-", "l_partkey", "l_suppkey").alias("batch_number"),
            F.col("l_partkey").alias("product_id"),
            F.date_sub("first_day", 30).alias("manufacture_date"),
            F.date_add("first_day", 700).alias("expiry_date"),
        )
    )


def price_list(spark, sf):
    """One price per product and day: the highest unit price, cut to whole cents."""
    cents = F.expr("cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) div cast(l_quantity as bigint)")
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("valid_from"))
        .agg(F.max(cents).alias("cents"))
        .select(
            F.struct("product_id", "valid_from").alias("price_list_id"),
            "product_id",
            "valid_from",
            F.expr("cast(cents * 0.01BD as decimal(12,2))").alias("list_price"),
        )
    )


def customer_order(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("customer_order_id"),
        F.concat(F.lit("ORD-"), "o_orderkey").alias("order_number"),
        F.col("o_custkey").alias("customer_warehouse_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.element_at(
            F.create_map(*[F.lit(v) for v in ("F", "shipped", "O", "confirmed", "P", "partially_shipped")]),
            F.col("o_orderstatus"),
        ).alias("status"),
    )


def order_item(spark, sf):
    """One item per order and product; lines still open count as not confirmed."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_partkey")
        .agg(
            F.sum(F.col("l_quantity").cast("int")).cast("int").alias("ordered_quantity"),
            F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int"))).cast("int").alias(
                "confirmed_quantity"
            ),
        )
        .select(
            F.struct("l_orderkey", "l_partkey").alias("order_item_id"),
            F.col("l_orderkey").alias("customer_order_id"),
            F.col("l_partkey").alias("product_id"),
            "ordered_quantity",
            "confirmed_quantity",
        )
    )


def shipment(spark, sf):
    """One shipment per order and day."""
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_shipdate")
        .distinct()
        .select(
            F.struct("l_orderkey", F.to_date("l_shipdate").alias("ship_day")).alias("shipment_id"),
            F.concat_ws("-", F.lit("SHP"), "l_orderkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("shipment_number"),
            F.col("l_orderkey").alias("customer_order_id"),
            F.col("l_shipdate").alias("ship_timestamp"),
        )
    )


def shipment_item(spark, sf):
    """One item per shipment, order item and batch."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("shipped_quantity"))
        .select(
            F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate").alias("shipment_item_id"),
            F.struct("l_orderkey", F.to_date("l_shipdate").alias("ship_day")).alias("shipment_id"),
            F.struct("l_orderkey", "l_partkey").alias("order_item_id"),
            F.struct("l_partkey", "l_suppkey").alias("batch_id"),
            "shipped_quantity",
        )
    )


def manufacturer_warehouse(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("manufacturer_warehouse_id"),
        F.col("s_name").alias("manufacturer_warehouse_code"),
        F.col("s_name").alias("manufacturer_warehouse_name"),
        F.col("s_suppkey").alias("address_id"),
    )


def customer_return(spark, sf):
    """One return per order and supplier with lines that came back."""
    back = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    days = back.groupBy("l_orderkey", "l_suppkey").agg(
        F.to_date(F.min("l_shipdate")).alias("request_date"), F.to_date(F.max("l_shipdate")).alias("received_date")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return days.join(orders, "l_orderkey").select(
        F.struct("l_orderkey", "l_suppkey").alias("customer_return_id"),
        F.concat_ws("-", F.lit("RET"), "l_orderkey", "l_suppkey").alias("return_number"),
        F.col("o_custkey").alias("customer_warehouse_id"),
        F.col("l_suppkey").alias("manufacturer_warehouse_id"),
        "request_date",
        "received_date",
    )


def customer_return_item(spark, sf):
    """Returned packs per shipment item."""
    return (
        table(spark, sf, "lineitem")
        .where("l_returnflag = 'R'")
        .groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus")
        .agg(F.sum(F.col("l_quantity").cast("int")).cast("int").alias("returned_quantity"))
        .select(
            F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus").alias(
                "customer_return_item_id"
            ),
            F.struct("l_orderkey", "l_suppkey").alias("customer_return_id"),
            F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate").alias("shipment_item_id"),
            "returned_quantity",
            F.when(F.col("l_linestatus") == "F", "expired").otherwise("lost").alias("reason"),
        )
    )


def snapshot_schema(name: str) -> T.StructType:
    """A table's columns in a snapshot of these views."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in KEY_TEXTS else f.dataType) for f in TABLES[name].schema]
    )


def erp_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A derived table with all columns of the ERP's; those we cannot derive are null."""
    df = globals()[name](spark, sf)

    def column(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None)
        kind = df.schema[f.name].dataType
        if isinstance(kind, T.StructType):
            return F.concat_ws("-", *[F.col(f.name)[part].cast("string") for part in kind.names])
        return F.col(f.name)

    return df.select(*[column(f).cast(f.dataType).alias(f.name) for f in snapshot_schema(name)])


def write_snapshot(spark: SparkSession, sf: str) -> str:
    """All ERP tables as a Parquet snapshot; returns its folder."""
    folder = fresh_folder(spark, "erp")

    def write(name: str) -> None:
        erp_table(spark, sf, name).write.option("compression", "zstd").parquet(f"{folder}/{name}")
        free_shuffles(spark)

    side_by_side(write, list(TABLES))
    return folder


def receipts(spark, sf):
    """Sales to patients: product_id, day, quantity, revenue."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        money("l_extendedprice").alias("revenue"),
        "l_suppkey",
        "l_orderkey",
        "l_returnflag",
        "l_linestatus",
    )


# The same views in SQL: columns that are derived, and where they come from.
_ITEM = """(SELECT l_orderkey, l_partkey, SUM(CAST(l_quantity AS INT)) AS ordered,
  SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INT) END) AS confirmed FROM lineitem GROUP BY ALL)"""
_CENTS = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) // CAST(l_quantity AS BIGINT)"
SQL_VIEWS = {
    "region": (
        {"region_id": "n_nationkey", "iso_code": "'XX-' || n_nationkey", "region_name": "n_name", "region_type": "'nation'",
         "sales_territory": "r_name"},
        "nation JOIN main.region ON n_regionkey = r_regionkey",
    ),
    "address": ({"address_id": "c_custkey", "region_id": "c_nationkey"}, "main.customer"),
    "customer": (
        {"customer_id": "c_custkey", "customer_code": "c_name", "industry": "c_mktsegment", "billing_address_id": "c_custkey"},
        "main.customer",
    ),
    "customer_warehouse": (
        {"customer_warehouse_id": "c_custkey", "customer_id": "c_custkey", "customer_warehouse_code": "c_name",
         "address_id": "c_custkey"},
        "main.customer",
    ),
    "manufacturer_warehouse": (
        {"manufacturer_warehouse_id": "s_suppkey", "manufacturer_warehouse_code": "s_name",
         "manufacturer_warehouse_name": "s_name", "address_id": "s_suppkey"},
        "supplier",
    ),
    "brand": (
        {"brand_id": "b", "brand_name": "p_brand"},
        "(SELECT DISTINCT p_brand, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS b FROM part)",
    ),
    "dosage_form": ({"dosage_form_id": "p_type", "dosage_form_name": "p_type"}, "(SELECT DISTINCT p_type FROM part)"),
    "product": (
        {"product_id": "p_partkey", "gtin": "lpad(CAST(p_partkey AS VARCHAR), 14, '0')",
         "brand_id": "CAST(split_part(p_brand, '#', 2) AS BIGINT)", "dosage_form_id": "p_type", "product_name": "p_name",
         "pack_quantity": "p_size"},
        "part",
    ),
    "batch": (
        {"batch_id": "l_partkey || '-' || l_suppkey", "batch_number": "l_partkey || '-' || l_suppkey",
         "product_id": "l_partkey", "manufacture_date": "first_day - 30", "expiry_date": "first_day + 700"},
        "(SELECT l_partkey, l_suppkey, CAST(MIN(l_shipdate) AS DATE) AS first_day FROM lineitem GROUP BY ALL)",
    ),
    "price_list": (
        {"price_list_id": "product_id || '-' || day", "product_id": "product_id",
         "valid_from": "day", "list_price": "CAST(cents * 0.01::DECIMAL(3,2) AS DECIMAL(12,2))"},
        f"(SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS day, MAX({_CENTS}) AS cents FROM lineitem GROUP BY ALL)",
    ),
    "customer_order": (
        {"customer_order_id": "o_orderkey", "order_number": "'ORD-' || o_orderkey", "customer_warehouse_id": "o_custkey",
         "customer_id": "o_custkey", "order_timestamp": "o_orderdate",
         "status": "CASE o_orderstatus WHEN 'F' THEN 'shipped' WHEN 'O' THEN 'confirmed' WHEN 'P' THEN 'partially_shipped' END"},
        "orders",
    ),
    "order_item": (
        {"order_item_id": "l_orderkey || '-' || l_partkey", "customer_order_id": "l_orderkey", "product_id": "l_partkey",
         "ordered_quantity": "ordered", "confirmed_quantity": "confirmed"},
        _ITEM,
    ),
    "shipment": (
        {"shipment_id": "l_orderkey || '-' || CAST(l_shipdate AS DATE)",
         "shipment_number": "'SHP-' || l_orderkey || '-' || strftime(l_shipdate, '%Y%m%d')", "customer_order_id": "l_orderkey",
         "ship_timestamp": "l_shipdate"},
        "(SELECT DISTINCT l_orderkey, l_shipdate FROM lineitem)",
    ),
    "shipment_item": (
        {"shipment_item_id": "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_shipdate)",
         "shipment_id": "l_orderkey || '-' || CAST(l_shipdate AS DATE)",
         "order_item_id": "l_orderkey || '-' || l_partkey", "batch_id": "l_partkey || '-' || l_suppkey",
         "shipped_quantity": "quantity"},
        "(SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, SUM(l_quantity) AS quantity FROM lineitem GROUP BY ALL)",
    ),
    "customer_return": (
        {"customer_return_id": "l_orderkey || '-' || l_suppkey", "return_number": "'RET-' || l_orderkey || '-' || l_suppkey",
         "customer_warehouse_id": "o_custkey", "manufacturer_warehouse_id": "l_suppkey", "request_date": "lo", "received_date": "hi"},
        """(SELECT l_orderkey, l_suppkey, MIN(l_shipdate) AS lo, MAX(l_shipdate) AS hi FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
          JOIN orders ON o_orderkey = l_orderkey""",
    ),
    "customer_return_item": (
        {"customer_return_item_id": "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_shipdate, l_linestatus)",
         "customer_return_id": "l_orderkey || '-' || l_suppkey",
         "shipment_item_id": "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_shipdate)", "returned_quantity": "quantity",
         "reason": "CASE WHEN l_linestatus = 'F' THEN 'expired' ELSE 'lost' END"},
        """(SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_linestatus, SUM(l_quantity) AS quantity FROM lineitem
          WHERE l_returnflag = 'R' GROUP BY ALL)""",
    ),
}


def constraint_sql() -> str:
    """The rule report over the SQL views: every rule of every table."""
    views, parts = [], []
    for name, (columns, source) in SQL_VIEWS.items():
        missing = {c: "NULL::VARCHAR" if c in KEY_TEXTS else "NULL" for c in TABLES[name].names}
        every = ", ".join(f"{columns.get(c, null)} AS {c}" for c, null in missing.items())
        views.append(f"erp_{name} AS MATERIALIZED (SELECT {every} FROM {source})")

    def add(table: str, kind: str, rule: str, count: str) -> None:
        text = rule.replace("'", "''")
        parts.append(
            f"SELECT '{table}' AS table_name, '{kind}' AS rule_kind, '{text}' AS rule, ({count})::BIGINT AS violations"
        )

    for name, rules in TABLES.items():
        view = f"erp_{name}"
        for column in rules.not_null:
            add(name, "not_null", column, f"SELECT COUNT(*) FROM {view} WHERE {column} IS NULL")
        for check in rules.checks:
            add(name, "check", check, f"SELECT COUNT(*) FROM {view} WHERE ({check}) = FALSE")
        for column, allowed in rules.domains.items():
            listed = ", ".join(f"'{value}'" for value in allowed)
            add(name, "domain", column, f"SELECT COUNT(*) FROM {view} WHERE {column} NOT IN ({listed})")
        for keys in rules.unique:
            present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            twice = f"SELECT 1 FROM {view} WHERE {present} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1"
            add(name, "unique", ", ".join(keys), f"SELECT COUNT(*) FROM ({twice})")
        for key in rules.foreign:
            present = " AND ".join(f"c.{k} IS NOT NULL" for k in key.columns)
            same = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(key.columns, key.parent_columns))
            lost = f"NOT EXISTS (SELECT 1 FROM erp_{key.parent} p WHERE {same})"
            rule = f"{', '.join(key.columns)} -> {key.parent}"
            add(name, "foreign", rule, f"SELECT COUNT(*) FROM {view} c WHERE {present} AND {lost}")
    return f"WITH {', '.join(views)} " + " UNION ALL ".join(parts)
