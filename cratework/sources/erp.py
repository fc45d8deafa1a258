"""The ERP's sales tables: columns, rules, and how to read them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    """Columns (DDL text; a column may be null only if listed) and declared rules."""

    columns: str
    nullable: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[ForeignKey, ...] = ()
    checks: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    append_only: bool = False

    @property
    def names(self) -> list[str]:
        return [column.split(" ")[0] for column in self.columns.split(", ")]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def key(self) -> str:
        return self.names[0]

    @property
    def not_null(self) -> list[str]:
        return [name for name in self.names if name not in self.nullable]

    @property
    def touched(self) -> str:
        """Column that tells when a row was last written."""
        return "created_at" if self.append_only else "updated_at"


def _fk(column: str, parent: str, parent_column: str | None = None) -> ForeignKey:
    return ForeignKey((column,), parent, (parent_column or column,))


STAMPS = ", created_at timestamp, updated_at timestamp"
CREATED = ", created_at timestamp"

# The ERP's declared tables and constraints.
TABLES: dict[str, Table] = {
    "region": Table(
        "region_id bigint, iso_code string, region_name string, region_type string, sales_territory string" + STAMPS,
        unique=(("region_id",), ("iso_code",)),
    ),
    "address": Table(
        "address_id bigint, region_id bigint, city string, district string, street string, house_number string, "
        "block_number string, premise string" + CREATED,
        nullable=("district", "block_number", "premise"),
        unique=(("address_id",),),
        foreign=(_fk("region_id", "region"),),
        append_only=True,
    ),
    "customer": Table(
        "customer_id bigint, customer_code string, legal_name string, contact_phone string, contact_email string, "
        "industry string, billing_address_id bigint" + STAMPS,
        unique=(("customer_id",), ("customer_code",)),
        foreign=(_fk("billing_address_id", "address", "address_id"),),
    ),
    "customer_warehouse": Table(
        "customer_warehouse_id bigint, customer_id bigint, customer_warehouse_code string, "
        "customer_warehouse_name string, address_id bigint, opened_date date, closed_date date" + STAMPS,
        nullable=("closed_date",),
        unique=(
            ("customer_warehouse_id",),
            ("customer_id", "customer_warehouse_code"),
            ("customer_warehouse_id", "customer_id"),
        ),
        foreign=(_fk("customer_id", "customer"), _fk("address_id", "address")),
        checks=("closed_date >= opened_date",),
    ),
    "manufacturer_warehouse": Table(
        "manufacturer_warehouse_id bigint, manufacturer_warehouse_code string, manufacturer_warehouse_name string, "
        "address_id bigint" + STAMPS,
        unique=(("manufacturer_warehouse_id",), ("manufacturer_warehouse_code",)),
        foreign=(_fk("address_id", "address"),),
    ),
    "brand": Table("brand_id bigint, brand_name string" + STAMPS, unique=(("brand_id",), ("brand_name",))),
    "dosage_form": Table(
        "dosage_form_id bigint, dosage_form_name string, unit_of_measure string" + STAMPS,
        unique=(("dosage_form_id",), ("dosage_form_name",)),
    ),
    "product": Table(
        "product_id bigint, gtin string, brand_id bigint, dosage_form_id bigint, product_name string, "
        "active_ingredient_name string, strength string, pack_quantity int, shelf_life_months int, "
        "launch_date date, discontinued_date date, is_prescription boolean" + STAMPS,
        nullable=("discontinued_date",),
        unique=(("product_id",), ("gtin",)),
        foreign=(_fk("brand_id", "brand"), _fk("dosage_form_id", "dosage_form")),
        checks=("pack_quantity > 0", "shelf_life_months > 0", "discontinued_date >= launch_date"),
    ),
    "batch": Table(
        "batch_id bigint, batch_number string, product_id bigint, manufacture_date date, expiry_date date" + CREATED,
        unique=(("batch_id",), ("batch_number",)),
        foreign=(_fk("product_id", "product"),),
        checks=("expiry_date > manufacture_date",),
        append_only=True,
    ),
    "price_list": Table(
        "price_list_id bigint, product_id bigint, valid_from date, list_price decimal(12,2)" + CREATED,
        unique=(("price_list_id",), ("product_id", "valid_from"), ("price_list_id", "product_id")),
        foreign=(_fk("product_id", "product"),),
        checks=("list_price > 0",),
        append_only=True,
    ),
    "customer_order": Table(
        "customer_order_id bigint, order_number string, customer_warehouse_id bigint, customer_id bigint, "
        "order_timestamp timestamp, requested_delivery_date date, status string" + STAMPS,
        unique=(("customer_order_id",), ("order_number",)),
        foreign=(
            _fk("customer_id", "customer"),
            ForeignKey(
                ("customer_warehouse_id", "customer_id"),
                "customer_warehouse",
                ("customer_warehouse_id", "customer_id"),
            ),
        ),
        domains={"status": ("new", "confirmed", "partially_shipped", "shipped", "cancelled")},
    ),
    "order_item": Table(
        "order_item_id bigint, customer_order_id bigint, product_id bigint, price_list_id bigint, "
        "ordered_quantity int, confirmed_quantity int, status string" + STAMPS,
        nullable=("confirmed_quantity",),
        unique=(("order_item_id",), ("customer_order_id", "product_id")),
        foreign=(
            _fk("customer_order_id", "customer_order"),
            _fk("product_id", "product"),
            ForeignKey(("price_list_id", "product_id"), "price_list", ("price_list_id", "product_id")),
        ),
        checks=("ordered_quantity > 0", "confirmed_quantity >= 0", "confirmed_quantity <= ordered_quantity"),
        domains={"status": ("pending", "confirmed", "shipped", "cancelled")},
    ),
    "shipment": Table(
        "shipment_id bigint, shipment_number string, customer_order_id bigint, manufacturer_warehouse_id bigint, "
        "ship_timestamp timestamp, delivery_date date" + STAMPS,
        nullable=("delivery_date",),
        unique=(("shipment_id",), ("shipment_number",)),
        foreign=(
            _fk("customer_order_id", "customer_order"),
            _fk("manufacturer_warehouse_id", "manufacturer_warehouse"),
        ),
    ),
    "shipment_item": Table(
        "shipment_item_id bigint, shipment_id bigint, order_item_id bigint, batch_id bigint, shipped_quantity int"
        + CREATED,
        unique=(("shipment_item_id",), ("shipment_id", "order_item_id", "batch_id")),
        foreign=(_fk("shipment_id", "shipment"), _fk("order_item_id", "order_item"), _fk("batch_id", "batch")),
        checks=("shipped_quantity > 0",),
        append_only=True,
    ),
    "customer_return": Table(
        "customer_return_id bigint, return_number string, customer_warehouse_id bigint, "
        "manufacturer_warehouse_id bigint, request_date date, received_date date" + STAMPS,
        nullable=("received_date",),
        unique=(("customer_return_id",), ("return_number",)),
        foreign=(
            _fk("customer_warehouse_id", "customer_warehouse"),
            _fk("manufacturer_warehouse_id", "manufacturer_warehouse"),
        ),
        checks=("received_date >= request_date",),
    ),
    "customer_return_item": Table(
        "customer_return_item_id bigint, customer_return_id bigint, shipment_item_id bigint, "
        "returned_quantity int, reason string" + CREATED,
        unique=(("customer_return_item_id",), ("customer_return_id", "shipment_item_id")),
        foreign=(_fk("customer_return_id", "customer_return"), _fk("shipment_item_id", "shipment_item")),
        checks=("returned_quantity > 0",),
        domains={"reason": ("expired", "short_expiry", "damaged")},
        append_only=True,
    ),
}


def jdbc_options(url: str, table: str, bounds: tuple[int, int], partitions: int, schema: str = "erp") -> dict[str, str]:
    """Options of a parallel JDBC read: ranges of the identity key, one per task."""
    return {
        "url": url,
        "dbtable": f"{schema}.{table}",
        "partitionColumn": TABLES[table].key,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def read_erp(
    spark: SparkSession,
    table: str,
    snapshot: str | None = None,
    url: str | None = None,
    bounds: tuple[int, int] = (0, 1),
    partitions: int = 1,
    properties: dict[str, str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """An ERP table from a Parquet snapshot folder or from the database.

    ``schema``: the snapshot's columns, where it is not the database's (such as key texts).
    """
    if snapshot is not None:
        return spark.read.schema(schema or TABLES[table].schema).parquet(f"{snapshot}/{table}")
    options = {**jdbc_options(url, table, bounds, partitions), **(properties or {})}
    return spark.read.format("jdbc").options(**options).load()


def extract_changes(df: DataFrame, table: str, since: str) -> DataFrame:
    """Rows written after a high-water mark. Deleted rows cannot be seen this way.

    Tables that are only appended to have no update time; their creation time serves.
    """
    return df.where(F.col(TABLES[table].touched) > F.lit(since).cast("timestamp"))


def publish_options(url: str, table: str, batch_size: int = 50_000) -> dict[str, str]:
    """Options to load a mart into a warehouse table that already exists."""
    return {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(batch_size), "isolationLevel": "NONE"}


def publish_mart(df: DataFrame, table: str, url: str | None = None, folder: str | None = None, **properties: str) -> None:
    """Replace a mart: over JDBC, or as Parquet where no warehouse is configured."""
    if url is None:
        df.write.mode("overwrite").parquet(f"{folder}/{table}")
        return
    options = {**publish_options(url, table), **properties}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
