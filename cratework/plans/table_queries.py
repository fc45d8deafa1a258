"""Registered queries over typed tables: silver, quality rules, history, marts, events.

``QUERIES`` maps a name to the function and the SQL that gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.operators import allocation, bitemporal, history, quality, silver
from cratework.operators.history_store import HistoryStore
from cratework.operators.key_index import IndexedTable
from cratework.plans import erp_views as erp
from cratework.plans import marts
from cratework.plans.erp_views import money, table
from cratework.session import configure, fresh_folder
from cratework.sources.erp import TABLES, ForeignKey, read_erp
from cratework.streaming import completeness, lifecycle, order_events

TS = "yyyy-MM-dd HH:mm:ss"
QUERIES: dict[str, tuple] = {}


def query(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return function(configure(spark), sf)

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = (run, sql)
        return function

    return register


def day_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


# Silver


def customer_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a partner would send them: padded names, some balances that are no numbers."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.when(F.col("c_acctbal") < 0, "n/a").otherwise(money("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_nationkey") == 7, "2024-02-30").otherwise("2024-02-28").alias("since"),
    )


CUSTOMER_RULES = {
    "c_custkey": silver.Cast("bigint"),
    "c_acctbal": silver.Cast("decimal(18,2)"),
    "since": silver.Cast("date", "yyyy-MM-dd"),
}


@query("""SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS c_acctbal,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_nationkey = 7 THEN NULL ELSE DATE '2024-02-28' END AS since FROM customer""")
def silver_cast(spark, sf):
    text = silver.clean_strings(customer_as_text(spark, sf), ["c_name", "c_mktsegment"])
    return silver.cast_columns(text, CUSTOMER_RULES)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
  concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'c_acctbal: not decimal(18,2)' END,
    CASE WHEN c_nationkey = 7 THEN 'since: not date' END) AS reasons
FROM customer WHERE c_acctbal < 0 OR c_nationkey = 7""")
def silver_rejects(spark, sf):
    _, rejects = silver.split_rejects(customer_as_text(spark, sf), CUSTOMER_RULES)
    return rejects.select("c_custkey", F.array_join("reject_reasons", "; ").alias("reasons"))


LINE_ORDER = [
    "l_shipdate", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  strftime(l_shipdate, '%Y-%m-%d') AS ship_day FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) = 1""")
def silver_dedupe_latest(spark, sf):
    last = silver.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return last.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", money("l_extendedprice").alias("price"),
        day_text("l_shipdate").alias("ship_day"),
    )


@query("""SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total, strftime(o_orderdate, '%Y') AS order_year,
  o_orderstatus FROM orders""")
def silver_table_roundtrip(spark, sf):
    """Orders written twice to a partitioned table; the second write replaces one year's rows with themselves."""
    target = fresh_folder(spark, "silver")
    df = table(spark, sf, "orders").select(
        "o_orderkey", money("o_totalprice").alias("total"), day_text("o_orderdate").substr(1, 4).alias("order_year"),
        "o_orderstatus",
    )
    silver.write_silver(df, target, ["order_year"])
    silver.write_silver(df.where("order_year = '1997'"), target, ["order_year"])
    return silver.read_silver(spark, target)


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS delivery FROM orders
WHERE strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders
  WHERE o_orderdate <= TIMESTAMP '1998-06-30 00:00:00')""")
def incremental_load(spark, sf):
    """Orders of monthly deliveries that the ledger does not hold yet."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", day_text("o_orderdate").substr(1, 7).alias("delivery"))
    loaded = orders.where(F.col("o_orderdate") <= F.lit("1998-06-30").cast("timestamp_ntz")).select("delivery")
    return silver.incremental(orders, loaded, ["delivery"]).select("o_orderkey", "delivery")


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'""")
def extract_changes(spark, sf):
    return silver.changed_since(table(spark, sf, "orders"), "o_orderdate", "2000-01-01").select("o_orderkey", "o_orderstatus")


@query("""SELECT event_id, 'k' AS name, json_extract_string(props, '$.k')::BIGINT AS value FROM events""")
def flatten_props(spark, sf):
    events = table(spark, sf, "events").withColumn("props", F.from_json("props", "map<string, bigint>"))
    return silver.explode_map(events, "props", ["event_id"])


@query("""SELECT o_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT AS l_quantity FROM orders
LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def flatten_order_lines(spark, sf):
    """Nested lines of an order as rows; an order without lines keeps one row."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("l_quantity")
    )
    orders = table(spark, sf, "orders").select("o_orderkey")
    # Not one left join: a hot order on its right side could not be split. Lines are nested after they met their order, and
    # orders without any are found by one sum instead of sorts: both take less of a task's memory.
    both = orders.withColumn("n", F.lit(1)).unionByName(lines.where("o_orderkey is not null").select("o_orderkey", F.lit(None).cast("int").alias("n")))
    counted = both.groupBy("o_orderkey").agg(F.count("n").alias("n"), F.count("*").alias("n_rows")).where("n = n_rows")
    childless = counted.select("o_orderkey", F.explode(F.sequence(F.lit(1), "n"))).select("o_orderkey")
    known = lines.join(orders, "o_orderkey")
    nested = known.select("o_orderkey", F.array(F.struct("l_linenumber", "l_partkey", "l_quantity")).alias("lines"))
    nested = nested.unionByName(childless, allowMissingColumns=True)
    return silver.explode_struct(nested, "lines", ["o_orderkey"])


@query("""SELECT event_id, strftime(ts - CASE event_type WHEN 'purchase' THEN INTERVAL 3 HOURS WHEN 'error' THEN INTERVAL 5 HOURS
  WHEN 'view' THEN INTERVAL 0 HOURS ELSE INTERVAL 330 MINUTES END, '%Y-%m-%d %H:%M:%S') AS ts_utc FROM events""")
def local_to_utc(spark, sf):
    """Local event times to UTC, by the zone of the row."""
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    zone = (
        F.when(F.col("event_type") == "purchase", "+03:00").when(F.col("event_type") == "error", "+05:00")
        .when(F.col("event_type") == "view", "+00:00").otherwise("+05:30")
    )
    zones = events.select("event_type").distinct().withColumn("time_zone", zone)
    utc = silver.local_to_utc(events, zones, "event_type", "ts", "ts_utc")
    return utc.select("event_id", F.date_format("ts_utc", TS).alias("ts_utc"))


@query("""WITH ch AS (SELECT o_custkey AS c_custkey, CAST(MAX_BY(CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey) AS DECIMAL(18,2)) AS balance
  FROM orders GROUP BY o_custkey)
SELECT COALESCE(c.c_custkey, ch.c_custkey) AS c_custkey,
  COALESCE(ch.balance, CAST(c_acctbal AS DECIMAL(18,2))) AS balance FROM customer c FULL JOIN ch ON ch.c_custkey = c.c_custkey""")
def upsert_merge(spark, sf):
    """Customers updated with their last order's total; unknown customers are added."""
    target = table(spark, sf, "customer").select("c_custkey", money("c_acctbal").alias("balance"))
    changes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), money("o_totalprice").alias("balance"), "o_orderkey"
    )
    return silver.upsert(target, changes, ["c_custkey"], ["o_orderkey"])


@query("""SELECT c_custkey, CAST(COALESCE(total, c_acctbal) AS DECIMAL(18,2)) AS balance, COALESCE(priority, c_mktsegment) AS segment
FROM customer LEFT JOIN (SELECT o_custkey, MAX_BY(o_totalprice, o_orderkey) AS total, MAX_BY(o_orderpriority, o_orderkey) AS priority
  FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def upsert_stored(spark, sf):
    """A stored table takes each customer's last order: rows change and move to other partitions."""
    folder = fresh_folder(spark, "upsert")
    target = table(spark, sf, "customer").select("c_custkey", money("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    silver.write_silver(target, f"{folder}/customers", ["segment"])
    changes = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by(money("o_totalprice"), "o_orderkey").alias("balance"), F.max_by("o_orderpriority", "o_orderkey").alias("segment")
    )
    silver.upsert_stored(changes, f"{folder}/customers", ["c_custkey"], ["segment"], f"{folder}/staging")
    return silver.read_silver(spark, f"{folder}/customers", target.schema)


@query("""WITH shipped AS (SELECT l_orderkey AS k, MAX(l_shipdate) AS version,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM lineitem GROUP BY 1),
  early AS (SELECT l_orderkey AS k, MIN(l_shipdate) - INTERVAL 4000 DAYS AS version FROM lineitem GROUP BY 1)
SELECT coalesce(o_orderkey, shipped.k) AS o_orderkey,
  CASE WHEN o_orderkey IS NULL OR shipped.version >= o_orderdate THEN shipped.total ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total,
  CASE WHEN o_orderkey IS NULL OR shipped.version >= o_orderdate THEN 'shipped' ELSE o_orderstatus END AS state,
  strftime(CASE WHEN o_orderkey IS NULL OR shipped.version >= o_orderdate THEN shipped.version ELSE o_orderdate END, '%Y') AS year
FROM orders FULL JOIN shipped ON o_orderkey = shipped.k""")
def upsert_indexed(spark, sf):
    """Stored orders take their last shipment, found by key index; some move to another year.

    A second load brings changes that are older than what is stored and so changes nothing.
    """
    def version(column: str) -> Column:
        return F.date_format(column, TS)

    stored = table(spark, sf, "orders").select(
        "o_orderkey", money("o_totalprice").alias("total"), F.col("o_orderstatus").alias("state"),
        version("o_orderdate").alias("version"), F.substring(version("o_orderdate"), 1, 4).alias("year"),
    )
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    shipped = lines.agg(
        F.sum(money("l_extendedprice")).cast("decimal(18,2)").alias("total"), F.lit("shipped").alias("state"),
        version(F.max("l_shipdate")).alias("version"),
    ).withColumn("year", F.substring("version", 1, 4))
    late = lines.agg(
        F.lit(0).cast("decimal(18,2)").alias("total"), F.lit("late").alias("state"),
        version(F.min("l_shipdate") - F.expr("INTERVAL 4000 DAYS")).alias("version"),
    ).withColumn("year", F.substring("version", 1, 4))
    indexed = IndexedTable(spark, fresh_folder(spark, "indexed"), stored.schema, ("o_orderkey",), ("year",), buckets=2)
    for changes in (stored, shipped, late):
        indexed.upsert(changes, ["version"])
    return indexed.rows().drop("version")


# Quality rules


@query("""SELECT l_orderkey, l_linenumber, COUNT(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""")
def dq_unique(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT 'l_orderkey' AS child_column, k AS key_value, COUNT(*)::BIGINT AS n
  FROM (SELECT CASE WHEN l_quantity > 45 THEN -l_orderkey ELSE l_orderkey END AS k FROM lineitem)
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = k) GROUP BY ALL
UNION ALL SELECT 'o_custkey', k, COUNT(*)::BIGINT
  FROM (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -o_custkey ELSE o_custkey END AS k FROM orders)
  WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = k) GROUP BY ALL""")
def dq_foreign_key(spark, sf):
    """Keys without a parent; those of large lines and urgent orders are changed, so that some are lost."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") > 45, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("l_orderkey")
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    buyers = orders.select(F.when(urgent, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("o_custkey"))
    lost_lines = quality.missing_parents(lines, orders, ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)))
    lost_orders = quality.missing_parents(buyers, customers, ForeignKey(("o_custkey",), "customer", ("c_custkey",)))
    return lost_lines.select(F.lit("l_orderkey").alias("child_column"), F.col("l_orderkey").alias("key_value"), "n").unionByName(
        lost_orders.select(F.lit("o_custkey").alias("child_column"), F.col("o_custkey").alias("key_value"), "n")
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_day
FROM (SELECT * REPLACE (CASE WHEN l_quantity > 45 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey) FROM lineitem)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)""")
def dq_orphan_rows(spark, sf):
    """Lines without an order; the keys of large ones are changed, so that some are lost."""
    key = F.when(F.col("l_quantity") > 45, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    lines = table(spark, sf, "lineitem").withColumn("l_orderkey", key)
    lost = quality.orphans(lines, table(spark, sf, "orders"), ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)))
    return lost.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day_text("l_shipdate").alias("ship_day"))


@query("""SELECT o_orderkey, 'shipped before ordered' AS rule, COUNT(*)::BIGINT AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE (l_shipdate >= o_orderdate) = FALSE GROUP BY o_orderkey
UNION ALL SELECT l_orderkey, 'quantity', COUNT(*)::BIGINT FROM lineitem WHERE (l_quantity <= 45) = FALSE GROUP BY l_orderkey""")
def dq_check(spark, sf):
    lines = table(spark, sf, "lineitem")
    dated = lines.join(table(spark, sf, "orders"), lines["l_orderkey"] == F.col("o_orderkey"))
    early = dated.where(quality.violates("l_shipdate >= o_orderdate")).groupBy("o_orderkey").agg(F.count("*").alias("n"))
    large = lines.where(quality.violates("l_quantity <= 45")).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n")
    )
    return early.withColumn("rule", F.lit("shipped before ordered")).unionByName(large.withColumn("rule", F.lit("quantity")))


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def dq_domain(spark, sf):
    return table(spark, sf, "orders").where(quality.outside("o_orderstatus", ("F", "O"))).select("o_orderkey", "o_orderstatus")


@query(erp.constraint_sql())
def constraint_report(spark, sf):
    """Every declared rule over a snapshot of all ERP tables, derived from the star schema."""
    snapshot = erp.write_snapshot(spark, sf)
    return quality.constraint_report({name: read_erp(spark, name, snapshot, schema=erp.snapshot_schema(name)) for name in TABLES}, TABLES)


# History

SQL_PRICES = """(SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS valid_from,
  CAST(MAX(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) // CAST(l_quantity AS BIGINT)) * 0.01::DECIMAL(3,2) AS DECIMAL(12,2))
    AS list_price FROM lineitem GROUP BY ALL)"""


@query(f"""SELECT product_id, valid_from, LEAD(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS valid_to, list_price
FROM {SQL_PRICES}""")
def price_intervals(spark, sf):
    prices = erp.price_list(spark, sf).select("product_id", "valid_from", "list_price")
    return history.price_intervals(prices, ["product_id"])


@query(f"""SELECT o.o_orderkey, o.l_partkey, o.day, p.list_price FROM (SELECT o_orderkey, l_partkey, CAST(o_orderdate AS DATE) AS day
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey) o
ASOF LEFT JOIN {SQL_PRICES} p ON p.product_id = o.l_partkey AND p.valid_from <= o.day""")
def price_as_of(spark, sf):
    """The list price of each ordered product on the day of the order."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    facts = lines.join(orders, "o_orderkey").select("o_orderkey", F.col("l_partkey").alias("product_id"), "day")
    prices = erp.price_list(spark, sf).select("product_id", "valid_from", "list_price")
    priced = history.price_as_of(facts, prices, ["product_id"], "day", "list_price")
    return priced.withColumnRenamed("product_id", "l_partkey")


@query("""WITH x AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month,
    MAX_BY(o_orderpriority, (o_orderdate, o_orderkey)) AS priority FROM orders GROUP BY ALL),
  v AS (SELECT * FROM x QUALIFY priority IS DISTINCT FROM LAG(priority) OVER (PARTITION BY o_custkey ORDER BY month))
SELECT o_custkey, priority, month AS valid_from, LEAD(month) OVER (PARTITION BY o_custkey ORDER BY month) AS valid_to,
  LEAD(month) OVER (PARTITION BY o_custkey ORDER BY month) IS NULL AS is_current FROM v""")
def scd2_history(spark, sf):
    """Monthly extracts of each customer's usual priority, folded to versions."""
    extracts = table(spark, sf, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("month")).agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority")
    )
    return history.scd2_history(extracts, ["o_custkey"], ["priority"], "month")


@query("""WITH x AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month,
    MAX_BY(o_orderpriority, (o_orderdate, o_orderkey)) AS priority FROM orders GROUP BY ALL),
  v AS (SELECT * FROM x QUALIFY priority IS DISTINCT FROM LAG(priority) OVER (PARTITION BY o_custkey ORDER BY month))
SELECT o_custkey, priority, month AS valid_from, LEAD(month) OVER (PARTITION BY o_custkey ORDER BY month) AS valid_to,
  LEAD(month) OVER (PARTITION BY o_custkey ORDER BY month) IS NULL AS is_current FROM v""")
def scd2_incremental(spark, sf):
    """The same versions from extracts that come in four loads, the months of a quarter's end first and the others late."""
    extracts = table(spark, sf, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("_day")).agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority")
    )
    months = sorted(str(r["_day"]) for r in extracts.select("_day").distinct().collect())  # a row for each month
    store = HistoryStore(spark, fresh_folder(spark, "history"), extracts.drop("_day").schema, ("o_custkey",))
    loads = [[m for m in months if int(m[5:7]) % 3 == k] for k in (0, 2, 1)]
    for days in (*loads, loads[0]):  # the last one is a repeated delivery
        if days:
            store.add_all(extracts.where(F.col("_day").isin([dt.date.fromisoformat(d) for d in days])), days)
    return store.history()


SQL_KNOWN = f"""(SELECT l_partkey AS product_id, l_linestatus AS zone, l_returnflag AS channel, date_trunc('month', l_shipdate)::DATE AS valid_from,
  date_trunc('month', l_shipdate) + INTERVAL 1 DAY * ((l_suppkey % 5) * 40) AS known_from,
  CAST(MAX(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY ALL)"""


@query(f"""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey AS product_id, l_linestatus AS zone, l_returnflag AS channel,
    l_shipdate::DATE AS day, l_shipdate + INTERVAL 1 DAY * w AS known, w AS days_later FROM lineitem, (VALUES (0), (90), (400)) t(w)),
  q AS (SELECT DISTINCT product_id, zone, channel, day, known FROM a),
  k AS (SELECT q.*, MAX_BY(cents, (p.valid_from, p.known_from)) AS cents FROM q JOIN {SQL_KNOWN} p
    ON p.product_id = q.product_id AND p.zone = q.zone AND p.channel = q.channel AND p.valid_from <= q.day AND p.known_from <= q.known GROUP BY ALL)
SELECT l_orderkey, l_linenumber, days_later, cents FROM a LEFT JOIN k USING (product_id, zone, channel, day, known)""")
def price_as_known(spark, sf):
    """What a pack's price on its shipping day was thought to be that day, a quarter and a year later; corrections come up to 160 days late."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_id"), F.col("l_linestatus").alias("zone"),
        F.col("l_returnflag").alias("channel"), F.col("l_shipdate").cast("timestamp").alias("shipped"), "l_suppkey",
        (money("l_extendedprice") * 100).cast("long").alias("cents"),
    )
    keys = ["product_id", "zone", "channel"]
    month = F.date_trunc("month", "shipped")
    prices = lines.groupBy(*keys, F.to_date(month).alias("valid_from"), (month + F.make_dt_interval(F.col("l_suppkey").cast("int") % 5 * 40)).alias("known_from"))
    rectangles = bitemporal.price_rectangles(prices.agg(F.max("cents").alias("cents")), keys, "cents")
    later = F.explode(F.array(*map(F.lit, (0, 90, 400)))).alias("days_later")
    asked = lines.select("l_orderkey", "l_linenumber", *keys, F.to_date("shipped").alias("day"), "shipped", later)
    asked = asked.withColumn("known", F.col("shipped") + F.make_dt_interval(F.col("days_later"))).drop("shipped")
    found = bitemporal.price_as_known(asked, rectangles, keys, "day", "known", "cents", "cents")
    return found.select("l_orderkey", "l_linenumber", "days_later", "cents")


# Marts


@query("""SELECT 'ORD-' || l_orderkey AS order_number, r_name AS sales_territory, n_name AS region_name, p_brand AS brand_name,
  p_type AS dosage_form_name, l_partkey || '-' || l_suppkey AS batch_number, lpad(CAST(l_partkey AS VARCHAR), 14, '0') AS gtin,
  c_name AS customer_warehouse_code, strftime(l_shipdate, '%Y-%m-%d') AS ship_day, CAST(SUM(l_quantity) AS BIGINT) AS shipped_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
GROUP BY l_orderkey, r_name, n_name, p_brand, p_type, l_partkey, l_suppkey, c_name, l_shipdate""")
def sell_in_mart(spark, sf):
    views = (
        "shipment_item", "shipment", "order_item", "customer_order", "customer_warehouse", "address", "region", "batch",
        "product", "brand", "dosage_form",
    )
    tables = {name: getattr(erp, name)(spark, sf) for name in views}
    tables["order_item"] = tables["order_item"].withColumn("price_list_id", F.lit(None).cast("bigint"))
    names = (
        "order_number", "sales_territory", "region_name", "brand_name", "dosage_form_name", "batch_number", "gtin",
        "customer_warehouse_code",
    )
    return marts.sell_in(**tables, columns=(*names, "ship_timestamp", "shipped_quantity")).select(
        *names, day_text("ship_timestamp").alias("ship_day"), "shipped_quantity",
    )


@query("""SELECT r_name AS sales_territory, n_name AS region_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount,
  COUNT(*)::BIGINT AS n_lines, GROUPING(r_name, n_name)::INT AS level
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)""")
def territory_rollup(spark, sf):
    """Orders are summed per customer before they meet the places."""
    per_customer = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("address_id")).agg(
        F.sum(money("o_totalprice")).alias("amount"), F.count("*").alias("n")
    )
    place = erp.address(spark, sf).join(erp.region(spark, sf), "region_id")
    placed = per_customer.join(place, "address_id")
    return marts.territory_rollup(placed, "amount", "n").withColumn("amount", F.col("amount").cast("decimal(38,2)"))


SQL_RECEIPTS = """(SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue, l_returnflag, l_linestatus, l_orderkey, l_suppkey FROM lineitem)"""


@query(f"""SELECT product_id, day, CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN quantity ELSE 0 END) AS BIGINT) AS packs_sold,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN quantity ELSE 0 END) AS BIGINT) AS packs_unmet,
  CAST(SUM(quantity) AS BIGINT) AS packs_demanded FROM {SQL_RECEIPTS} GROUP BY ALL""")
def patient_demand(spark, sf):
    lines = erp.receipts(spark, sf)
    return marts.patient_demand(lines.where("l_returnflag <> 'R'"), lines.where("l_returnflag = 'R'"))


@query(f"""WITH held AS (SELECT product_id, day, CAST(SUM(quantity) AS BIGINT) AS on_hand FROM {SQL_RECEIPTS} WHERE l_returnflag = 'N' GROUP BY ALL),
  sold AS (SELECT product_id, day, SUM(quantity) AS sold FROM {SQL_RECEIPTS} WHERE l_returnflag <> 'N' GROUP BY ALL),
  b AS (SELECT COALESCE(h.product_id, s.product_id) AS product_id, COALESCE(h.day, s.day) AS day, on_hand, sold
    FROM held h FULL JOIN sold s ON h.product_id = s.product_id AND h.day = s.day),
  w AS (SELECT product_id, day, on_hand,
    CAST(SUM(COALESCE(sold, 0)) OVER (PARTITION BY product_id ORDER BY day RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS window_sold,
    LEAST(28, date_diff('day', MIN(day) OVER (PARTITION BY product_id), day) + 1)::BIGINT AS window_days FROM b)
SELECT *, CAST(on_hand * window_days AS DOUBLE) / NULLIF(CAST(window_sold AS DOUBLE), 0) AS days_of_stock,
  CAST(on_hand * window_days AS DOUBLE) / NULLIF(CAST(window_sold AS DOUBLE), 0) > 21 AS over_cap
FROM w WHERE on_hand IS NOT NULL""")
def days_of_stock(spark, sf):
    """Lines not returned play the stock counts, the others the sales."""
    lines = erp.receipts(spark, sf)
    stock = lines.where("l_returnflag = 'N'").withColumnRenamed("quantity", "on_hand")
    return marts.days_of_stock(stock, lines.where("l_returnflag <> 'N'"))


@query("""WITH h AS (SELECT l_partkey, l_suppkey, CAST(MIN(l_shipdate) AS DATE) + 700 AS expiry,
    CAST(SUM(l_quantity) AS BIGINT) AS on_hand FROM lineitem GROUP BY ALL)
SELECT l_partkey AS product_id, CASE WHEN expiry - DATE '1998-01-01' < 0 THEN 'expired' WHEN expiry - DATE '1998-01-01' < 30 THEN 'under 30 days'
    WHEN expiry - DATE '1998-01-01' < 90 THEN '30 to 89 days' WHEN expiry - DATE '1998-01-01' < 180 THEN '90 to 179 days'
    ELSE '180 days and more' END AS expiry_bucket,
  CAST(SUM(on_hand) AS BIGINT) AS on_hand, COUNT(*)::BIGINT AS n_batches FROM h GROUP BY ALL""")
def near_expiry_stock(spark, sf):
    stock = table(spark, sf, "lineitem").select(
        F.struct("l_partkey", "l_suppkey").alias("batch_id"),
        F.col("l_quantity").cast("bigint").alias("on_hand"),
    )
    return marts.near_expiry_stock(stock, erp.batch(spark, sf), F.lit("1998-01-01").cast("date"))


@query("""WITH s AS (SELECT p_brand, SUM(l_quantity) AS shipped,
    SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned,
    SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS expired,
    SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS damaged
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
SELECT p_brand, CAST(shipped AS BIGINT) AS shipped, CAST(returned AS BIGINT) AS returned, CAST(expired AS BIGINT) AS returned_expired,
  0::BIGINT AS returned_short_expiry, CAST(damaged AS BIGINT) AS returned_damaged, returned::DOUBLE / shipped::DOUBLE AS return_rate FROM s""")
def return_rate(spark, sf):
    """Line items are summed per product and kind before they meet the brand."""
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"), "l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    lines = sums.join(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey")
    returned = lines.where("l_returnflag = 'R'").select(
        "p_brand",
        F.when(F.col("l_linestatus") == "F", "expired").otherwise("damaged").alias("reason"),
        F.col("quantity").alias("returned_quantity"),
    )
    return marts.return_rate(
        lines.withColumnRenamed("quantity", "shipped_quantity"), returned, ["p_brand"], TABLES["customer_return_item"].domains["reason"]
    )


@query(f"""WITH d AS (SELECT n_name AS region_name, product_id, day, SUM(quantity) AS quantity, SUM(revenue) AS revenue
    FROM {SQL_RECEIPTS} r JOIN supplier ON r.l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
  p AS (SELECT product_id, valid_from + 40 AS valid_from, list_price FROM {SQL_PRICES}),
  x AS (SELECT d.*, p.list_price FROM d ASOF LEFT JOIN p ON p.product_id = d.product_id AND p.valid_from <= d.day)
SELECT region_name, CAST(SUM(revenue) AS DECIMAL(38,2)) AS revenue, CAST(SUM(CAST(quantity AS BIGINT) * list_price) AS DECIMAL(38,2)) AS list_cost,
  CAST(SUM(revenue) - SUM(CAST(quantity AS BIGINT) * list_price) AS DECIMAL(38,2)) AS margin FROM x GROUP BY region_name""")
def partner_margin(spark, sf):
    """Receipts by the supplier's nation, against list prices that take effect 40 days later."""
    place = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("region_name")
    )
    receipts = erp.receipts(spark, sf).join(place, "l_suppkey")
    prices = erp.price_list(spark, sf).select("product_id", F.date_add("valid_from", 40).alias("valid_from"), "list_price")
    return marts.partner_margin(receipts, prices, ["region_name"]).withColumn("revenue", F.col("revenue").cast("decimal(38,2)"))


@query(f"""WITH l AS (SELECT product_id, valid_from, list_price AS price FROM {SQL_PRICES}),
  r AS (SELECT product_id, valid_from, CAST(list_price * 1.10 + MONTH(valid_from) AS DECIMAL(14,4)) AS price FROM {SQL_PRICES}),
  a AS (SELECT product_id, MAX_BY(price, valid_from) FILTER (valid_from <= DATE '1997-12-31') AS list_before,
    MAX_BY(price, valid_from) FILTER (valid_from <= DATE '1998-01-31') AS list_after FROM l GROUP BY 1),
  b AS (SELECT product_id, MAX_BY(price, valid_from) FILTER (valid_from <= DATE '1997-12-31') AS retail_before,
    MAX_BY(price, valid_from) FILTER (valid_from <= DATE '1998-01-31') AS retail_after FROM r GROUP BY 1),
  c AS (SELECT *, CAST(list_after - list_before AS DOUBLE) / NULLIF(CAST(list_before AS DOUBLE), 0) AS list_change,
    CAST(retail_after - retail_before AS DOUBLE) / NULLIF(CAST(retail_before AS DOUBLE), 0) AS retail_change FROM a JOIN b USING (product_id))
SELECT *, retail_change / NULLIF(list_change, 0) AS pass_through FROM c WHERE list_before IS NOT NULL""")
def price_pass_through(spark, sf):
    prices = erp.price_list(spark, sf)
    listed = prices.select("product_id", "valid_from", F.col("list_price").alias("price"))
    retail = prices.select(
        "product_id", "valid_from", F.expr("cast(list_price * 1.10BD + month(valid_from) as decimal(14,4))").alias("price")
    )
    return marts.price_pass_through(retail, listed, F.lit("1997-12-31").cast("date"), F.lit("1998-01-31").cast("date"))


@query("""WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS month,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM orders GROUP BY ALL),
  w AS (SELECT *, CAST(SUM(amount) OVER b AS DECIMAL(38,2)) AS baseline_total, COUNT(*) OVER b AS baseline_months,
    LEAD(amount) OVER (PARTITION BY o_orderpriority ORDER BY month) AS next_amount FROM m
    WINDOW b AS (PARTITION BY o_orderpriority ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT *, amount::DOUBLE / NULLIF(baseline_total::DOUBLE / NULLIF(baseline_months::DOUBLE, 0), 0) AS uplift,
  next_amount::DOUBLE / NULLIF(amount::DOUBLE, 0) AS next_drop FROM w""")
def forward_buying(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("amount"))
    table_ = marts.forward_buying(orders, ["o_orderpriority"])
    return table_.withColumns({c: F.col(c).cast("decimal(38,2)") for c in ("amount", "baseline_total", "next_amount")})


SQL_ITEMS = """(SELECT l_orderkey, l_partkey, CAST(SUM(CAST(l_quantity AS INT)) AS INT) AS ordered_quantity,
  CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INT) END) AS INT) AS confirmed_quantity,
  CAST(COALESCE(SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS shipped_quantity
  FROM lineitem GROUP BY ALL)"""
SQL_FILL = f"""(SELECT *, CASE WHEN confirmed_quantity = 0 THEN 'cancelled' WHEN shipped_quantity >= COALESCE(confirmed_quantity, ordered_quantity) THEN 'shipped'
    WHEN confirmed_quantity IS NOT NULL OR shipped_quantity > 0 THEN 'confirmed' ELSE 'pending' END AS expected_status,
  shipped_quantity::DOUBLE / NULLIF(ordered_quantity::DOUBLE, 0) AS fill_rate FROM {SQL_ITEMS})"""


def filled_items(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that came back do not count as shipped."""
    sent = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").select(
        F.struct("l_orderkey", "l_partkey").alias("order_item_id"),
        F.col("l_quantity").cast("bigint").alias("shipped_quantity"),
    )
    return marts.order_fill(erp.order_item(spark, sf), sent)


@query(f"""SELECT l_orderkey AS customer_order_id, l_partkey AS product_id, ordered_quantity, confirmed_quantity, shipped_quantity,
  expected_status, fill_rate FROM {SQL_FILL}""")
def order_fill(spark, sf):
    return filled_items(spark, sf).drop("order_item_id")


@query(f"""SELECT l_orderkey AS customer_order_id, CASE WHEN COUNT(*) FILTER (expected_status = 'cancelled') = COUNT(*) THEN 'cancelled'
  WHEN COUNT(*) FILTER (expected_status IN ('shipped', 'cancelled')) = COUNT(*) THEN 'shipped'
  WHEN COUNT(*) FILTER (shipped_quantity > 0) > 0 THEN 'partially_shipped'
  WHEN COUNT(*) FILTER (expected_status = 'pending') = COUNT(*) THEN 'new' ELSE 'confirmed' END AS expected_order_status
FROM {SQL_FILL} GROUP BY l_orderkey""")
def order_status(spark, sf):
    return marts.order_status(filled_items(spark, sf))


@query("""WITH v AS (SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS volume FROM orders GROUP BY 1)
SELECT o_custkey, volume, volume::DOUBLE / (SELECT CAST(SUM(volume) AS DECIMAL(38,2)) FROM v)::DOUBLE AS share FROM v""")
def share_of_volume(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", money("o_totalprice").alias("amount"))
    return marts.share_of_volume(orders, ["o_custkey"], "amount").withColumn("volume", F.col("volume").cast("decimal(38,2)"))


EVENT_KINDS = ("view", "click", "signup", "purchase", "error")


@query(f"""SELECT user_id, COUNT(*)::BIGINT AS n_events, MAX_BY(event_type, (ts, event_id)) AS last_event,
  strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_ts, (epoch_us(MAX(ts)) - epoch_us(MIN(ts)))::BIGINT AS span_micros,
  {", ".join(f"strftime(MIN(ts) FILTER (event_type = '{k}'), '%Y-%m-%d %H:%M:%S') AS first_{k}" for k in EVENT_KINDS)}
FROM events GROUP BY user_id""")
def order_lifecycle(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("event_ts"))
    cycle = marts.order_lifecycle(events, "user_id", EVENT_KINDS)
    times = ["last_ts", *[f"first_{k}" for k in EVENT_KINDS]]
    return cycle.withColumns({c: F.date_format(c, TS) for c in times})


@query("""WITH d AS (SELECT event_type AS dataset_name, CAST(ts AS DATE) AS day, COUNT(DISTINCT date_trunc('hour', ts)) AS members,
    COUNT(*) FILTER (value > 300) AS invalid_members, MAX(ts) AS arrived_at FROM events GROUP BY ALL),
  x AS (SELECT k.event_type AS dataset_name, CAST(t.day AS DATE) AS day FROM (SELECT DISTINCT event_type FROM events) k,
    (SELECT unnest(generate_series(MIN(ts)::DATE, MAX(ts)::DATE, INTERVAL 1 DAY)) AS day FROM events) t)
SELECT x.dataset_name, x.day, COALESCE(members, 0)::BIGINT AS members, (arrived_at IS NOT NULL) AS on_time,
  COALESCE(members >= 24, FALSE) AS complete, COALESCE(invalid_members = 0, FALSE) AS agreed_format,
  COALESCE(members >= 24 AND invalid_members = 0, FALSE) AS payable
FROM x LEFT JOIN d ON d.dataset_name = x.dataset_name AND d.day = x.day""")
def delivery_scorecard(spark, sf):
    """Kinds of events play the datasets, their hours the members of the day's archive."""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("dataset_name"), F.to_date("ts").alias("day"), F.date_trunc("hour", "ts").alias("hour"), "ts", "value"
    )
    span = events.groupBy("dataset_name").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    datasets = span.select("dataset_name", F.lit(24).alias("expected_members"))
    expected = marts.expected_deliveries(datasets, span.agg(F.min("lo")).scalar(), span.agg(F.max("hi")).scalar())
    # One row per file first, so that counting files needs no distinct.
    hourly = events.groupBy("dataset_name", "day", "hour").agg(F.count_if(F.col("value") > 300).alias("bad"), F.max("ts").alias("ts"))
    delivered = hourly.groupBy("dataset_name", "day").agg(
        F.count("*").alias("members"), F.sum("bad").alias("invalid_members"), F.max(F.col("ts").cast("timestamp")).alias("arrived_at")
    )
    card = marts.delivery_scorecard(expected, delivered)
    return card.select(
        "dataset_name", "day", F.coalesce("members", F.lit(0)).alias("members"), "on_time", "complete", "agreed_format", "payable"
    )


@query("""WITH t AS (SELECT l_partkey, l_suppkey, CAST(COALESCE(SUM(l_quantity::BIGINT) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS shipped,
    CAST(COALESCE(SUM(l_quantity::BIGINT) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS returned,
    CAST(COALESCE(SUM(l_quantity::BIGINT) FILTER (l_returnflag = 'A' AND l_linestatus = 'F'), 0) AS BIGINT) AS sold,
    CAST(COALESCE(SUM(l_quantity::BIGINT) FILTER (l_returnflag = 'A' AND l_linestatus = 'O'), 0) AS BIGINT) AS counted
  FROM lineitem GROUP BY 1, 2)
SELECT *, shipped - returned - sold AS book_stock, counted - (shipped - returned - sold) AS difference FROM t""")
def stock_balance(spark, sf):
    """Kinds of line items play the moves of a batch (product and supplier)."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "N", "shipped").when(flag == "R", "returned").when(F.col("l_linestatus") == "F", "sold")
    moves = table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", kind.otherwise("counted").alias("kind"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return marts.stock_balance(moves, ["l_partkey", "l_suppkey"])


@query("""SELECT COALESCE(a.code, b.code) AS code, CASE WHEN b.code IS NULL THEN 'only_ours' WHEN a.code IS NULL THEN 'only_theirs' ELSE 'both' END AS state
FROM (SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS code FROM orders) a
FULL JOIN (SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -c_custkey ELSE c_custkey END AS code FROM customer) b ON a.code = b.code""")
def code_reconciliation(spark, sf):
    """Some codes of either side are changed, so that both have codes of their own."""
    odd = lambda key, when: F.when(F.expr(when), -F.col(key)).otherwise(F.col(key)).alias("code")
    ours = table(spark, sf, "orders").select(odd("o_custkey", "o_orderstatus = 'P'"))
    theirs = table(spark, sf, "customer").select(odd("c_custkey", "c_mktsegment = 'MACHINERY'"))
    return marts.code_reconciliation(ours, theirs, "code")


# Event time


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, event_type, COUNT(*)::BIGINT AS n_events
FROM events GROUP BY ALL""")
def stream_dedupe_window(spark, sf):
    """Every event twice in one stream; each counts once in its hour."""
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("event_ts")
    )
    folder = fresh_folder(spark, "events")
    once = order_events.dedupe_events(events.unionByName(events), ["event_id"])
    order_events.append_to(once, folder, f"{folder}-checkpoint").awaitTermination()
    counts = order_events.hourly_counts(spark.read.parquet(folder), ["event_type"])
    return counts.select(F.date_format("hour_start", TS).alias("hour_start"), "event_type", "n_events")


ARRIVALS = 5


def _arrivals(spark: SparkSession, sf: str) -> Iterator[DataFrame]:
    """The events in spans of arrival, one after the other: some up to 20 hours late, some twice."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("event_ts"))
    late = F.when(F.col("event_id") % 10 == 0, F.expr("INTERVAL 20 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    once = events.withColumn("arrival", F.col("event_ts") + late)
    twice = events.where("event_id % 7 = 0").withColumn("arrival", F.col("event_ts") + F.expr("INTERVAL 10 HOURS"))
    every = once.unionByName(twice)
    span = every.agg(F.min(F.unix_micros("arrival")).alias("lo"), F.max(F.unix_micros("arrival")).alias("hi")).first()
    part = F.floor((F.unix_micros("arrival") - span["lo"]) * ARRIVALS / (span["hi"] - span["lo"] + 1))
    for k in range(ARRIVALS):
        yield every.where(part == k).drop("arrival")


@query(f"""SELECT user_id, COUNT(*)::BIGINT AS n_events, MAX_BY(event_type, (ts, event_id)) AS last_event,
  strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_ts, (epoch_us(MAX(ts)) - epoch_us(MIN(ts)))::BIGINT AS span_micros,
  {", ".join(f"strftime(MIN(ts) FILTER (event_type = '{k}'), '%Y-%m-%d %H:%M:%S') AS first_{k}" for k in EVENT_KINDS)}
FROM events GROUP BY user_id""")
def stream_lifecycle(spark, sf):
    """order_lifecycle from a stream of several batches with late and repeated events."""
    folder = fresh_folder(spark, "lifecycle")
    for arrived in _arrivals(spark, sf):
        # Both streams take up where they stopped: all files of an arrival are one batch, however many they are. A batch that
        # took some of them only would let the clock pass the others.
        arrived.write.mode("append").parquet(f"{folder}/arrived")
        events = spark.readStream.schema(arrived.schema).parquet(f"{folder}/arrived")
        once = order_events.dedupe_events(events, ["event_id"])
        order_events.append_to(once, f"{folder}/once", f"{folder}/once-checkpoint").awaitTermination()
        each = spark.readStream.schema(arrived.schema).parquet(f"{folder}/once")
        stream = lifecycle.lifecycle_stream(each, "user_id", EVENT_KINDS)
        lifecycle.keep_lifecycles(stream, f"{folder}/cycles", f"{folder}/cycles-checkpoint").awaitTermination()
    cycle = lifecycle.read_lifecycles(spark, f"{folder}/cycles", "user_id", EVENT_KINDS)
    times = ["last_ts", *[f"first_{k}" for k in EVENT_KINDS]]
    return cycle.withColumns({c: F.date_format(c, TS) for c in times})


@query("""WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
  e AS (SELECT k.event_type, t.hour FROM (SELECT DISTINCT event_type FROM events) k,
    (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b) t),
  c AS (SELECT event_type, date_trunc('hour', ts) AS hour, COUNT(*) AS n FROM events GROUP BY ALL)
SELECT e.event_type, strftime(e.hour, '%Y-%m-%d %H:%M:%S') AS hour_start, coalesce(n, 0)::BIGINT AS n_events,
  CASE WHEN n IS NULL THEN 'missing' ELSE 'arrived' END AS state
FROM e LEFT JOIN c ON c.event_type = e.event_type AND c.hour = e.hour""")
def stream_completeness(spark, sf):
    """The hours that the calendar expects, with their counts or as missing, from two streams.

    The last rows on either side are three days ahead: they let the clock pass all real hours.
    """
    folder = fresh_folder(spark, "completeness")
    events = table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("event_ts"))
    span = events.groupBy("event_type").agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"))
    lo, hi = span.agg(F.date_trunc("hour", F.min("lo")), F.date_trunc("hour", F.max("hi"))).first()
    step = F.expr("INTERVAL 1 HOUR")
    slots = span.select("event_type", F.explode(F.sequence(F.lit(lo), F.lit(hi), step)).alias("slot_ts"))
    ahead = F.lit(hi) + F.expr("INTERVAL 72 HOURS")
    for name, rows, ts in (("slots", slots, "slot_ts"), ("events", events, "event_ts")):
        width = (hi - lo).total_seconds() / (ARRIVALS - 1) + 3600
        part = F.floor((F.unix_timestamp(ts) - F.unix_timestamp(F.lit(lo))) / width)
        for k in range(ARRIVALS - 1):
            rows.where(part == k).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        spark.range(1).select(F.lit("ahead").alias("event_type"), ahead.alias(ts)).write.mode("append").parquet(f"{folder}/{name}")

    def stream(name: str, ts: str) -> DataFrame:
        reader = spark.readStream.schema(f"event_type string, {ts} timestamp").option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{folder}/{name}")

    complete = completeness.hourly_completeness(stream("slots", "slot_ts"), stream("events", "event_ts"), "event_type")
    order_events.append_to(complete, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    out = spark.read.schema("event_type string, hour_start timestamp, n_events long").parquet(f"{folder}/out").where("event_type <> 'ahead'")
    return out.select(
        "event_type", F.date_format("hour_start", TS).alias("hour_start"), F.coalesce("n_events", F.lit(0)).alias("n_events"),
        F.when(F.col("n_events").isNull(), "missing").otherwise("arrived").alias("state"),
    )


# Allocation

SQL_SUPPLY = """(SELECT l_partkey AS product_id, l_partkey || '-' || l_suppkey AS batch_id, CAST(MIN(l_shipdate) AS DATE) + 700 AS expiry_date,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL)"""
SQL_SOLD = """(SELECT l_partkey AS product_id, l_orderkey || '-' || l_linenumber AS receipt_id, CAST(l_shipdate AS DATE) AS day,
  CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)"""
SQL_LINES = f"""s AS (SELECT *, SUM(quantity) OVER (PARTITION BY product_id ORDER BY expiry_date, batch_id) AS high FROM {SQL_SUPPLY} WHERE quantity > 0),
  d AS (SELECT *, SUM(quantity) OVER (PARTITION BY product_id ORDER BY day, receipt_id) AS high FROM {SQL_SOLD} WHERE quantity > 0),
  st AS (SELECT product_id, MAX(high) AS held FROM s GROUP BY 1), dt AS (SELECT product_id, MAX(high) AS sold FROM d GROUP BY 1)"""


def _allocated(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Batches as shipped less what came back, against the receipts of closed lines."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("batch_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("receipt_id"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("long").alias("quantity"),
        "l_returnflag",
        "l_linestatus",
    )
    kept = F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("quantity"))
    supply = lines.groupBy("product_id", "batch_id").agg(F.date_add(F.min("day"), 700).alias("expiry_date"), F.sum(kept).alias("quantity"))
    sold = lines.where("l_linestatus = 'F'").select("product_id", "receipt_id", "day", "quantity")
    return allocation.first_expiry(supply, sold, ["product_id"], "batch_id", "receipt_id", "expiry_date", "day")


@query(f"""WITH {SQL_LINES}
SELECT d.product_id, receipt_id, CAST(day AS VARCHAR) AS day, batch_id, CAST(expiry_date AS VARCHAR) AS expiry_date,
  CAST(least(s.high, d.high) - greatest(s.high - s.quantity, d.high - d.quantity) AS BIGINT) AS quantity
FROM d JOIN s ON s.product_id = d.product_id AND s.high - s.quantity < d.high AND d.high - d.quantity < s.high
UNION ALL SELECT d.product_id, receipt_id, CAST(day AS VARCHAR), NULL, NULL, CAST(high - greatest(high - quantity, coalesce(held, 0)) AS BIGINT)
FROM d LEFT JOIN st ON st.product_id = d.product_id WHERE high > coalesce(held, 0)""")
def fefo_allocation(spark, sf):
    """The batches that each receipt's packs came from, first expiry first; packs beyond all batches have none."""
    allocated, _ = _allocated(spark, sf)
    return allocated.withColumns({c: F.col(c).cast("string") for c in ("day", "expiry_date")})


@query(f"""WITH {SQL_LINES}
SELECT s.product_id, batch_id, CAST(expiry_date AS VARCHAR) AS expiry_date, CAST(high - greatest(high - quantity, coalesce(sold, 0)) AS BIGINT) AS quantity
FROM s LEFT JOIN dt ON dt.product_id = s.product_id WHERE high > coalesce(sold, 0)""")
def fefo_stock(spark, sf):
    """What the same allocation leaves of each batch."""
    _, left = _allocated(spark, sf)
    return left.withColumn("expiry_date", F.col("expiry_date").cast("string"))
