"""Gold marts. Inputs are ERP tables and partner datasets as DataFrames.

Partner columns that the agreement does not name are our assumption and are listed
in each docstring. Facts are reduced to the grain of the mart before they are joined
to anything; joins give no broadcast hint, Spark's own size check decides.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratework.operators import history
from cratework.staging import Staging, free_shuffles

# Fixed values of the business case.
STOCK_CAP_DAYS = 21
ORDER_EVENTS = (
    "confirmed",
    "items_cancelled",
    "shipped_to_pharmacy",
    "ready_for_pickup",
    "picked_up",
    "not_picked_up",
)
DATASETS = (
    "commercial_zones",
    "pharmacies",
    "fulfillment_centers",
    "products",
    "retail_prices",
    "inventory",
    "online_orders",
    "online_order_items",
    "online_order_events",
    "pos_receipts",
)
HOURLY_DATASET = "online_order_events"
PER_PHARMACY_DATASET = "pos_receipts"


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null where the whole is null or zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def sell_in(
    shipment_item: DataFrame,
    shipment: DataFrame,
    order_item: DataFrame,
    customer_order: DataFrame,
    customer_warehouse: DataFrame,
    address: DataFrame,
    region: DataFrame,
    batch: DataFrame,
    product: DataFrame,
    brand: DataFrame,
    dosage_form: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Denormalised shipment lines: what was shipped, when, where, of which batch and product.

    Master tables are folded into one place table and one goods table first, so the
    facts meet few joins. No line is lost: what a line's keys do not lead to is null.

    Lines with their shipments and order items are written before they meet the rest, and the shuffle
    files of these joins let go: the disk holds those of one half of the joins at a time. ``columns``
    (None: all) are the ones wanted; others are not written.
    """
    staging = Staging(shipment_item.sparkSession, "sell-in")
    place = (
        customer_warehouse.join(address, "address_id", "left")
        .join(region, "region_id", "left")
        .select("customer_warehouse_id", "customer_warehouse_code", "region_name", "sales_territory")
    )
    goods = (
        batch.join(product, "product_id", "left")
        .join(brand, "brand_id", "left")
        .join(dosage_form, "dosage_form_id", "left")
        .select(
            "batch_id", "batch_number", "expiry_date", "product_id", "gtin", "product_name", "brand_name", "dosage_form_name"
        )
    )
    # Orders, not the many more facts, meet their places.
    ordered = customer_order.select("customer_order_id", "order_number", "customer_id", "customer_warehouse_id").join(
        place, "customer_warehouse_id", "left"
    )
    shipped = (
        shipment_item.select("shipment_item_id", "shipment_id", "order_item_id", "batch_id", "shipped_quantity")
        .join(shipment.select("shipment_id", "shipment_number", "ship_timestamp"), "shipment_id", "left")
        .join(order_item.select("order_item_id", "customer_order_id", "price_list_id"), "order_item_id", "left")
    )
    wanted = set(columns or shipped.columns) | {"customer_order_id", "batch_id"}
    lines = staging.write(shipped.select(*[c for c in shipped.columns if c in wanted]), "lines", compression="zstd")
    free_shuffles(staging.spark)
    facts = lines.join(ordered, "customer_order_id", "left").join(goods, "batch_id", "left")
    if columns is not None:
        return facts.select(*columns)
    first = ["batch_id", "customer_warehouse_id", "customer_order_id"]
    return facts.select(*first, *[c for c in facts.columns if c not in first])


def territory_rollup(sales: DataFrame, amount: str = "amount", lines: str | None = None) -> DataFrame:
    """Totals by territory and region, with subtotals and the grand total.

    ``lines`` names a count column where the input is summed already. Rows are reduced
    to regions before the roll-up multiplies them. ``level`` is 0 for a region, 1 for a
    territory, 3 for all.
    """
    by_region = sales.groupBy("sales_territory", "region_name").agg(
        F.sum(amount).alias("amount"), F.sum(F.col(lines) if lines else F.lit(1)).alias("n_lines")
    )
    return by_region.rollup("sales_territory", "region_name").agg(
        F.sum("amount").alias("amount"),
        F.sum("n_lines").alias("n_lines"),
        F.grouping_id().cast("int").alias("level"),
    )


def patient_demand(receipt_lines: DataFrame, cancelled_lines: DataFrame) -> DataFrame:
    """Packs sold plus online packs cancelled, per product and day.

    Both inputs: product_id, day, quantity. The cause of a cancellation is not in the
    agreed columns, so every cancelled pack counts as unmet demand (our assumption).
    """
    sold = receipt_lines.select("product_id", "day", F.col("quantity").alias("sold"), F.lit(0).alias("unmet"))
    lost = cancelled_lines.select("product_id", "day", F.lit(0).alias("sold"), F.col("quantity").alias("unmet"))
    return (
        sold.unionByName(lost)
        .groupBy("product_id", "day")
        .agg(
            F.sum("sold").alias("packs_sold"),
            F.sum("unmet").alias("packs_unmet"),
            F.sum(F.col("sold") + F.col("unmet")).alias("packs_demanded"),
        )
    )


def days_of_stock(stock: DataFrame, sales: DataFrame, window_days: int = 28) -> DataFrame:
    """Stock over mean daily sales of the trailing window, and breaches of the agreed cap.

    ``stock``: product_id, day, on_hand (end of day). ``sales``: product_id, day,
    quantity, any number of rows. Sales are summed per day before the window, so a
    window partition has one row per calendar day at most; days without rows count in
    the mean but need no row. The length of the window is our choice.
    """
    rows = stock.select("product_id", "day", "on_hand").unionByName(
        sales.select("product_id", "day", F.col("quantity").alias("sold")), allowMissingColumns=True
    )
    both = rows.groupBy("product_id", "day").agg(F.sum("on_hand").alias("on_hand"), F.sum("sold").alias("sold"))
    product = Window.partitionBy("product_id").orderBy(F.unix_date("day"))
    trailing = product.rangeBetween(-(window_days - 1), Window.currentRow)
    since_first = F.datediff("day", F.first("day").over(product)) + 1
    trailed = both.withColumns(
        {
            "window_sold": F.sum(F.coalesce("sold", F.lit(0))).over(trailing),
            "window_days": F.least(F.lit(window_days), since_first).cast("bigint"),
        }
    )
    days = ratio(F.col("on_hand") * F.col("window_days"), F.col("window_sold"))
    return (
        trailed.where("on_hand is not null")
        .withColumn("days_of_stock", days)
        .withColumn("over_cap", F.col("days_of_stock") > STOCK_CAP_DAYS)
        .select("product_id", "day", "on_hand", "window_sold", "window_days", "days_of_stock", "over_cap")
    )


def near_expiry_stock(stock: DataFrame, batch: DataFrame, today: Column) -> DataFrame:
    """Stock by time left until expiry. ``stock``: batch_id, on_hand."""
    left = F.datediff("expiry_date", today)
    bucket = (
        F.when(left < 0, "expired")
        .when(left < 30, "under 30 days")
        .when(left < 90, "30 to 89 days")
        .when(left < 180, "90 to 179 days")
        .otherwise("180 days and more")
    )
    held = stock.groupBy("batch_id").agg(F.sum("on_hand").alias("on_hand"))
    return (
        held.join(batch.select("batch_id", "product_id", "expiry_date"), "batch_id")
        .groupBy("product_id", bucket.alias("expiry_bucket"))
        .agg(F.sum("on_hand").alias("on_hand"), F.count("*").alias("n_batches"))
    )


def return_rate(shipped: DataFrame, returned: DataFrame, by: list[str], reasons: tuple[str, ...]) -> DataFrame:
    """Returned over shipped packs, with one column per return reason.

    ``shipped``: by..., shipped_quantity. ``returned``: by..., reason, returned_quantity.
    One aggregate over both; groups of which nothing was shipped are left out.
    """
    rows = shipped.select(*by, "shipped_quantity").unionByName(
        returned.select(*by, "reason", "returned_quantity"), allowMissingColumns=True
    )

    def back(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("returned_quantity"))), F.lit(0))

    return (
        rows.groupBy(*by)
        .agg(
            F.sum("shipped_quantity").alias("shipped"),
            back(F.lit(True)).alias("returned"),
            *[back(F.col("reason") == reason).alias(f"returned_{reason}") for reason in reasons],
        )
        .where("shipped is not null")
        .withColumn("return_rate", ratio(F.col("returned"), F.col("shipped")))
    )


def partner_margin(receipts: DataFrame, prices: DataFrame, by: list[str]) -> DataFrame:
    """What the partner earns: retail revenue less list cost, by region.

    ``receipts``: by..., product_id, day, quantity, revenue. ``prices``: product_id,
    valid_from, list_price. Receipts are summed per product and day before a price is
    looked up.
    """
    daily = receipts.groupBy(*by, "product_id", "day").agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")
    )
    priced = history.price_as_of(daily, prices, ["product_id"], "day", "list_price")
    cost = (F.col("quantity") * F.col("list_price")).cast("decimal(38,2)")
    return priced.groupBy(*by).agg(
        F.sum("revenue").alias("revenue"),
        F.sum(cost).alias("list_cost"),
        (F.sum("revenue") - F.sum(cost)).cast("decimal(38,2)").alias("margin"),
    )


def price_pass_through(retail: DataFrame, listed: DataFrame, before: Column, after: Column) -> DataFrame:
    """Relative retail change over relative list change between two dates.

    Both inputs: product_id, valid_from, price.
    """
    key = ["product_id"]
    both = {"before": before, "after": after}
    listed = history.prices_at(listed, key, {f"list_{name}": date for name, date in both.items()}, "price")
    retail = history.prices_at(retail, key, {f"retail_{name}": date for name, date in both.items()}, "price")
    table = listed.join(retail, key).where("list_before is not null and retail_before is not null")
    list_change = ratio(F.col("list_after") - F.col("list_before"), F.col("list_before"))
    retail_change = ratio(F.col("retail_after") - F.col("retail_before"), F.col("retail_before"))
    return table.withColumns(
        {
            "list_change": list_change,
            "retail_change": retail_change,
            "pass_through": retail_change / F.nullif(list_change, F.lit(0.0)),
        }
    )


def forward_buying(orders: DataFrame, by: list[str], months_before: int = 3) -> DataFrame:
    """Monthly sell-in against the mean of the months before, and the drop after.

    ``orders``: by..., day, amount. Rows are summed per month before the window.
    """
    monthly = orders.groupBy(*by, F.trunc("day", "MM").alias("month")).agg(F.sum("amount").alias("amount"))
    by_month = Window.partitionBy(*by).orderBy("month")
    before = by_month.rowsBetween(-months_before, -1)
    table = monthly.withColumns(
        {
            "baseline_total": F.sum("amount").over(before),
            "baseline_months": F.count("*").over(before),
            "next_amount": F.lead("amount").over(by_month),
        }
    )
    baseline = ratio(F.col("baseline_total"), F.col("baseline_months"))
    return table.withColumns(
        {
            "uplift": F.col("amount").cast("double") / F.nullif(baseline, F.lit(0.0)),
            "next_drop": ratio(F.col("next_amount"), F.col("amount")),
        }
    )


def order_fill(order_items: DataFrame, shipment_items: DataFrame) -> DataFrame:
    """Ordered, confirmed and shipped packs per order item and the status they imply.

    ``shipment_items`` may hold many rows per order item; they are summed first. The
    mapping of quantities to a status is our reading of the status lists.
    """
    sent = shipment_items.groupBy("order_item_id").agg(F.sum("shipped_quantity").alias("shipped_quantity"))
    shipped = F.coalesce("shipped_quantity", F.lit(0))
    goal = F.coalesce("confirmed_quantity", "ordered_quantity")
    status = (
        F.when(F.col("confirmed_quantity") == 0, "cancelled")
        .when(shipped >= goal, "shipped")
        .when(F.col("confirmed_quantity").isNotNull() | (shipped > 0), "confirmed")
        .otherwise("pending")
    )
    return (
        order_items.join(sent, "order_item_id", "left")
        .withColumn("expected_status", status)
        .withColumn("shipped_quantity", shipped)
        .withColumn("fill_rate", ratio(F.col("shipped_quantity"), F.col("ordered_quantity")))
    )


def order_status(filled_items: DataFrame) -> DataFrame:
    """Status each order should have, from its items' expected status."""
    n = F.count("*")
    shipped = F.count_if(F.col("expected_status") == "shipped")
    cancelled = F.count_if(F.col("expected_status") == "cancelled")
    pending = F.count_if(F.col("expected_status") == "pending")
    some = F.count_if(F.col("shipped_quantity") > 0)
    return filled_items.groupBy("customer_order_id").agg(
        F.when(cancelled == n, "cancelled")
        .when(shipped + cancelled == n, "shipped")
        .when(some > 0, "partially_shipped")
        .when(pending == n, "new")
        .otherwise("confirmed")
        .alias("expected_order_status")
    )


def share_of_volume(sales: DataFrame, by: list[str], amount: str) -> DataFrame:
    """Each group's share of the total; the total is one number, not a window over all rows."""
    grouped = sales.groupBy(*by).agg(F.sum(amount).alias("volume"))
    total = grouped.agg(F.sum("volume").alias("total")).scalar()
    return grouped.withColumn("share", ratio(F.col("volume"), total))


def order_lifecycle(events: DataFrame, key: str, kinds: tuple[str, ...] = ORDER_EVENTS) -> DataFrame:
    """Latest event per order, first time of each kind of event, and the time between ends.

    ``events``: key, event_id, event_type, event_ts. An aggregate: partial results per
    task, whatever the number of events of one order.
    """
    first = [
        F.min(F.when(F.col("event_type") == kind, F.col("event_ts"))).alias(f"first_{kind}") for kind in kinds
    ]
    return events.groupBy(key).agg(
        F.count("*").alias("n_events"),
        F.max_by("event_type", F.struct("event_ts", "event_id")).alias("last_event"),
        F.max("event_ts").alias("last_ts"),
        (F.unix_micros(F.max("event_ts")) - F.unix_micros(F.min("event_ts"))).alias("span_micros"),
        *first,
    )


def expected_deliveries(datasets: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """Calendar of deliveries: every dataset on every day.

    ``datasets``: dataset_name, expected_members.
    """
    return datasets.select(
        "dataset_name", "expected_members", F.explode(F.sequence(first_day, last_day)).alias("day")
    )


def delivered_from_ledger(ledger: DataFrame) -> DataFrame:
    """What was delivered per dataset and day, from the bronze run ledger.

    The last run of an archive counts. An archive that failed has no members that count,
    so its delivery is not complete.
    """
    last = ledger.groupBy("path").agg(
        F.max_by(
            F.struct("dataset_name", "ingest_date", "status", "uploaded", "invalid", "modificationTime"),
            "attempt",
        ).alias("last")
    )
    loaded = F.col("status") == "complete"
    return (
        last.select("last.*")
        .groupBy("dataset_name", F.col("ingest_date").try_cast("date").alias("day"))
        .agg(
            F.sum(F.when(loaded, F.col("uploaded")).otherwise(0)).alias("members"),
            F.sum("invalid").alias("invalid_members"),
            F.max("modificationTime").alias("arrived_at"),
        )
    )


def delivery_scorecard(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """On time, complete and in the agreed format, per dataset and day.

    ``expected``: dataset_name, day, expected_members. ``delivered``: dataset_name, day,
    members, invalid_members, arrived_at. On time means within 24 hours after the day.
    """
    table = expected.join(delivered, ["dataset_name", "day"], "left")
    arrived = F.col("arrived_at").isNotNull()
    deadline = F.col("day").cast("timestamp") + F.expr("INTERVAL 48 HOURS")
    return table.withColumns(
        {
            "on_time": arrived & (F.col("arrived_at") <= deadline),
            "complete": arrived & (F.col("members") >= F.col("expected_members")),
            "agreed_format": arrived & (F.col("invalid_members") == 0),
        }
    ).withColumn("payable", F.col("on_time") & F.col("complete") & F.col("agreed_format"))


def channel_stock_balance(shipped: DataFrame, returned: DataFrame, sold: DataFrame, counted: DataFrame, by: list[str]) -> DataFrame:
    """Stock that should be there (shipped - returned - sold) against the counted stock.

    Each input: by..., quantity.
    """
    parts = {"shipped": shipped, "returned": returned, "sold": sold, "counted": counted}
    rows = functools.reduce(
        DataFrame.unionByName, [df.select(*by, F.lit(name).alias("kind"), "quantity") for name, df in parts.items()]
    )
    return stock_balance(rows, by)


STOCK_MOVES = ("shipped", "returned", "sold", "counted")


def stock_balance(moves: DataFrame, by: list[str]) -> DataFrame:
    """``channel_stock_balance`` of rows (by..., kind, quantity), kinds as in STOCK_MOVES.

    A group with some kinds only is kept: one aggregate does the work of three full joins.
    """
    table = moves.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == name, F.col("quantity"))), F.lit(0)).alias(name)
            for name in STOCK_MOVES
        ]
    )
    book = F.col("shipped") - F.col("returned") - F.col("sold")
    return table.withColumn("book_stock", book).withColumn("difference", F.col("counted") - F.col("book_stock"))


def code_reconciliation(ours: DataFrame, theirs: DataFrame, code: str) -> DataFrame:
    """Codes on both sides, only ours, or only theirs."""
    left = ours.select(F.col(code)).distinct().withColumn("ours", F.lit(True))
    right = theirs.select(F.col(code)).distinct().withColumn("theirs", F.lit(True))
    state = (
        F.when(F.col("theirs").isNull(), "only_ours").when(F.col("ours").isNull(), "only_theirs").otherwise("both")
    )
    return left.join(right, code, "full_outer").select(code, state.alias("state"))
