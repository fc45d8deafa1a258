"""Registered queries over archives, landing and the source registry.

Each one packs a whole driver table into ZIP deliveries below the shared folder, runs
the loaders on them and returns what they produced. ``QUERIES`` maps a name to the
function and the SQL that gives the same rows from the tables.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.functions import paths
from cratework.operators import bronze as bronze_ops
from cratework.operators import retraction, silver
from cratework.operators.contract import text_schema
from cratework.plans import marts
from cratework.plans.erp_views import money, table
from cratework.session import configure, fresh_folder
from cratework.sources import archives as zips
from cratework.sources import deliveries, landing, partner, registry
from cratework.streaming import arrivals

DAY = "ingest_date=2026-01-01"
MOMENT = dt.datetime(2026, 1, 2, tzinfo=dt.timezone.utc)
TS = "yyyy-MM-dd HH:mm:ss"
QUERIES: dict[str, tuple] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = (function, sql)
        return function

    return register


def key_of(dataset: str, name: Column) -> Column:
    return F.concat(F.lit(f"feed/{dataset}/{DAY}/"), name, F.lit(".zip"))


def chunk(key: str, size: int) -> Column:
    """Number of a key range: archives stay of one size, and more data gives more of them."""
    return F.concat(F.lit("-"), F.expr(f"cast({key} div {size} as string)"))


def sql_chunk(key: str, size: int) -> str:
    return f"'-' || ({key} // {size})"


ROWS = 100_000
DOCUMENTS = 10_000


def orders_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        F.date_format("o_orderdate", TS).alias("o_orderdate"),
        "o_orderpriority",
    )


def customer_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", money("c_acctbal").alias("c_acctbal"), "c_mktsegment"
    )


def orders_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV: one archive per year, one member per month."""
    df = orders_text(spark, sf)
    year, month = F.substring("o_orderdate", 1, 4), F.substring("o_orderdate", 1, 7)
    member = F.concat(F.lit("orders-"), month, F.lit(".csv"))
    archive = key_of("orders", F.concat(F.lit("orders-"), year, chunk("o_orderkey", ROWS)))
    return deliveries.as_csv(df, archive, member, df.columns)


def load(
    spark: SparkSession, lines: DataFrame, schemas: dict, run_id: str = "run-1", pack=deliveries.pack_archives
) -> tuple[str, str, DataFrame]:
    """Pack, load and return (landing folder, bronze folder, ledger)."""
    configure(spark)
    root, target = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    pack(lines, root)
    ledger = bronze_ops.load_archives(zips.list_archives(spark, root), target, schemas, run_id, MOMENT)
    return root, target, ledger


ORDER_SCHEMA = text_schema(
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
)
CUSTOMER_SCHEMA = text_schema(["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])

SQL_MONEY = "CAST(CAST({0} AS DECIMAL(18,2)) AS VARCHAR)"
SQL_ORDER_TEXT = f"""
  CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  {SQL_MONEY.format("o_totalprice")} AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"""
SQL_CUSTOMER_TEXT = f"""
  CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  {SQL_MONEY.format("c_acctbal")} AS c_acctbal, c_mktsegment"""


@query(f"""SELECT {SQL_ORDER_TEXT},
  'orders-' || strftime(o_orderdate, '%Y') || {sql_chunk("o_orderkey", ROWS)} || '.zip' AS _zip_file_name,
  'orders-' || strftime(o_orderdate, '%Y-%m') || '.csv' AS _source_file_name,
  'valid' AS _schema_status, 'run-1' AS _dag_run_id,
  '2026-01-02 00:00:00' AS _bronze_processed_at
FROM orders""")
def archive_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    _, target, _ = load(spark, orders_lines(spark, sf), {"orders": ORDER_SCHEMA})
    rows = bronze_ops.read_bronze(spark, target, "feed", "orders", ORDER_SCHEMA, ["2026-01-01"])
    return rows.withColumn("_bronze_processed_at", F.date_format("_bronze_processed_at", TS)).drop(
        *bronze_ops.PARTITIONS
    )


@query("""SELECT o_orderstatus, COUNT(*)::BIGINT AS n_orders,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
  strftime(MAX(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_order
FROM orders GROUP BY o_orderstatus""")
def order_status_from_archives(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: archives to bronze to typed rows to a small report."""
    _, target, _ = load(spark, orders_lines(spark, sf), {"orders": ORDER_SCHEMA})
    rows = bronze_ops.read_bronze(spark, target, "feed", "orders", ORDER_SCHEMA, ["2026-01-01"])
    rules = {"o_totalprice": silver.Cast("decimal(18,2)"), "o_orderdate": silver.Cast("timestamp", TS)}
    typed = silver.cast_columns(rows.select("o_orderstatus", "o_totalprice", "o_orderdate"), rules)
    return typed.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders"),
        F.sum("o_totalprice").cast("decimal(38,2)").alias("total"),
        F.date_format(F.max("o_orderdate"), TS).alias("last_order"),
    )


@query(f"""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
  {SQL_MONEY.format("p_retailprice")} AS p_retailprice, p_brand AS spec_brand, p_type AS spec_type,
  'part-' || replace(p_brand, '#', '-') || {sql_chunk("p_partkey", ROWS)} || '.zip' AS _zip_file_name
FROM part""")
def archive_json_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers come back as the text they were written as; nested objects stay nested."""
    df = table(spark, sf, "part")
    spec = F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    record = F.to_json(
        F.struct("p_partkey", "p_name", "p_size", money("p_retailprice").alias("p_retailprice"), spec.alias("spec"))
    )
    brand = F.replace("p_brand", F.lit("#"), F.lit("-"))
    member = F.concat(F.lit("part-"), "p_type", F.lit("-"), F.pmod("p_size", F.lit(4)), F.lit(".JSON"))
    archive = key_of("part", F.concat(F.lit("part-"), brand, chunk("p_partkey", ROWS)))
    lines = deliveries.as_json(df, archive, member, record)
    schema = text_schema(["p_partkey", "p_name", "p_size", "p_retailprice"]).add(
        "spec", text_schema(["brand", "type"])
    )
    _, target, _ = load(spark, lines, {"part": schema})
    rows = bronze_ops.read_bronze(spark, target, "feed", "part", schema)
    return rows.select(
        "p_partkey",
        "p_name",
        "p_size",
        "p_retailprice",
        F.col("spec.brand").alias("spec_brand"),
        F.col("spec.type").alias("spec_type"),
        "_zip_file_name",
    )


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5, length(text)::BIGINT AS text_length,
  'docs-' || lang || {sql_chunk("doc_id", DOCUMENTS)} || '.zip' AS _zip_file_name FROM documents""")
def archive_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Long texts with quotes and line ends, as quoted CSV, character by character."""
    df = table(spark, sf, "documents")
    member = F.concat(F.lit("docs-"), F.regexp_replace("source", "[^A-Za-z0-9]", "_"), F.lit(".csv"))
    archive = key_of("docs", F.concat(F.lit("docs-"), "lang", chunk("doc_id", DOCUMENTS)))
    lines = deliveries.as_csv(df, archive, member, ["doc_id", "text"])
    schema = text_schema(["doc_id", "text"])
    _, target, _ = load(spark, lines, {"docs": schema})
    rows = bronze_ops.read_bronze(spark, target, "feed", "docs", schema)
    return rows.select(
        "doc_id",
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        F.length("text").cast("bigint").alias("text_length"),
        "_zip_file_name",
    )


@query(f"""SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))},
  {", ".join(SQL_MONEY.format(c) + f" AS {c}" for c in ("l_quantity", "l_extendedprice"))}, l_returnflag,
  'all.json' AS _source_file_name FROM lineitem""")
def archive_json_large(spark: SparkSession, sf: str) -> DataFrame:
    """A whole table as one JSON member of one archive, numbers as the text they were written as."""
    df = table(spark, sf, "lineitem")
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
    record = F.to_json(F.struct(*[money(c).alias(c) if c in ("l_quantity", "l_extendedprice") else F.col(c) for c in names]))
    lines = deliveries.as_json(df, key_of("lines", F.lit("all")), F.lit("all.json"), record)
    _, target, _ = load(spark, lines, {"lines": text_schema(names)}, pack=deliveries.pack_in_pieces)
    rows = bronze_ops.read_bronze(spark, target, "feed", "lines", text_schema(names))
    return rows.select(*names, "_source_file_name")


JSON_LIMIT = 4096


@query(f"""WITH r AS (SELECT c_nationkey || {sql_chunk("c_custkey", ROWS)} AS part, c_mktsegment AS segment,
    octet_length(encode('{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}}')) AS bytes FROM customer),
  m AS (SELECT part, segment, COUNT(*) AS n, 2 + SUM(bytes) + 2 * (COUNT(*) - 1) AS size FROM r GROUP BY ALL)
SELECT 'nation-' || part || '.zip' AS zip_file_name, CASE WHEN MAX(size) > {JSON_LIMIT} THEN 'failed' ELSE 'complete' END AS status,
  (COUNT(*) FILTER (size > {JSON_LIMIT}))::BIGINT AS failed,
  CAST(CASE WHEN MAX(size) > {JSON_LIMIT} THEN 0 ELSE SUM(n) END AS BIGINT) AS n_read FROM m GROUP BY part""")
def archive_json_limit(spark: SparkSession, sf: str) -> DataFrame:
    """An archive with a JSON member above the limit fails as a whole; one just at it is read."""
    configure(spark)
    df = table(spark, sf, "customer")
    archive = key_of("names", F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"), chunk("c_custkey", ROWS)))
    record = F.to_json(F.struct("c_custkey", "c_name"))
    root, target = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    deliveries.pack_archives(deliveries.as_json(df, archive, F.concat("c_mktsegment", F.lit(".json")), record), root)
    schema = text_schema(["c_custkey", "c_name"])
    ledger = bronze_ops.load_archives(zips.list_archives(spark, root), target, {"names": schema}, "run-1", MOMENT, JSON_LIMIT)
    rows = bronze_ops.read_bronze(spark, target, "feed", "names", schema)
    read = rows.groupBy(F.col("_zip_file_name").alias("zip_file_name")).agg(F.count("*").alias("n_read"))
    return ledger.select("zip_file_name", "status", F.col("failed").cast("long").alias("failed")).join(read, "zip_file_name", "left").withColumn(
        "n_read", F.coalesce("n_read", F.lit(0))
    )


def mixed_customer_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One archive per market segment: CSV members by nation, and members with nothing to load."""
    df = customer_text(spark, sf)
    df = df.withColumn("part", chunk("c_custkey", ROWS))
    archive = key_of("customer", F.concat(F.lit("seg-"), "c_mktsegment", "part"))
    nation = F.col("c_nationkey").cast("string")
    names = CUSTOMER_SCHEMA.names
    good = deliveries.as_csv(df, archive, F.concat(F.lit("by_nation/"), nation, F.lit(".csv")), names)
    per_nation = df.select("c_mktsegment", "c_nationkey", "part").distinct()
    others = []
    for name, head, line in (
        ("notes-{}.txt", "", F.lit("see the other files")),
        ("empty-{}.csv", "", F.lit(None).cast("string")),
        ("none-{}.json", "", F.lit("[{}]")),
        ("header-{}.csv", ",".join(names) + "\n", F.lit(None).cast("string")),
    ):
        before, after = name.split("{}")
        others.append(
            per_nation.select(
                archive.alias("archive"),
                F.concat(F.lit(before), nation, F.lit(after)).alias("member"),
                F.lit(head).alias("head"),
                F.lit("\n").alias("sep"),
                F.lit("").alias("tail"),
                line.alias("line"),
            )
        )
    for part in others:
        good = good.unionByName(part)
    return good


@query(f"""WITH n AS (SELECT c_mktsegment || {sql_chunk("c_custkey", ROWS)} AS seg, CAST(c_nationkey AS VARCHAR) AS nat, COUNT(*)::BIGINT AS rows
  FROM customer GROUP BY ALL)
SELECT 'seg-' || seg || '.zip' AS zip_file_name, 'by_nation/' || nat || '.csv' AS member, 'valid' AS outcome, rows AS n_rows FROM n
UNION ALL SELECT 'seg-' || seg || '.zip', 'notes-' || nat || '.txt', 'skipped_unsupported', 0::BIGINT FROM n
UNION ALL SELECT 'seg-' || seg || '.zip', 'empty-' || nat || '.csv', 'skipped_empty', 0::BIGINT FROM n
UNION ALL SELECT 'seg-' || seg || '.zip', 'none-' || nat || '.json', 'skipped_empty', 0::BIGINT FROM n
UNION ALL SELECT 'seg-' || seg || '.zip', 'header-' || nat || '.csv', 'valid', 0::BIGINT FROM n""")
def archive_manifest(spark: SparkSession, sf: str) -> DataFrame:
    _, target, _ = load(spark, mixed_customer_lines(spark, sf), {"customer": CUSTOMER_SCHEMA})
    return bronze_ops.read_manifest(spark, target, "run-1").select("zip_file_name", "member", "outcome", "n_rows")


@query(f"""SELECT 'seg-' || c_mktsegment || {sql_chunk("c_custkey", ROWS)} || '.zip' AS zip_file_name, 'complete' AS status,
  (COUNT(DISTINCT c_nationkey) * 5)::BIGINT AS members, (COUNT(DISTINCT c_nationkey) * 2)::BIGINT AS uploaded,
  0::BIGINT AS invalid, COUNT(*)::BIGINT AS n_rows
FROM customer GROUP BY c_mktsegment, c_custkey // {ROWS}""")
def archive_ledger(spark: SparkSession, sf: str) -> DataFrame:
    _, _, ledger = load(spark, mixed_customer_lines(spark, sf), {"customer": CUSTOMER_SCHEMA})
    return ledger.select("zip_file_name", "status", "members", "uploaded", "invalid", "n_rows")


def mismatching_customer_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One archive per nation, one member per segment; the BUILDING members lack two columns."""
    df = customer_text(spark, sf)
    nation = F.concat(F.col("c_nationkey").cast("string"), chunk("c_custkey", ROWS))
    archive = key_of("customer", F.concat(F.lit("nation-"), nation))
    member = F.concat(F.lit("part/"), "c_mktsegment", F.lit(".csv"))
    short = df.columns[:3]
    building = F.col("c_mktsegment") == "BUILDING"
    return deliveries.as_csv(df.where(~building), archive, member, df.columns).unionByName(
        deliveries.as_csv(df.where(building), archive, member, short)
    )


@query(f"""SELECT 'feed/customer/ingest_date=2026-01-01/nation-' || nation || '.zip' AS landing_key,
  'part__BUILDING.csv' AS file_names,
  'Files with invalid schema: part__BUILDING.csv<br>Location: s3://bronze/feed/customer/ingest_date=2026-01-01/zip_name=nation-'
    || nation || '/schema_status=invalid/' AS body,
  '[Airflow Warning] Files with invalid schema in ZIP: feed/customer/ingest_date=2026-01-01/nation-'
    || nation || '.zip' AS subject
FROM (SELECT DISTINCT c_nationkey || {sql_chunk("c_custkey", ROWS)} AS nation FROM customer WHERE c_mktsegment = 'BUILDING')""")
def schema_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, target, _ = load(spark, mismatching_customer_lines(spark, sf), {"customer": CUSTOMER_SCHEMA})
    report = bronze_ops.invalid_schema_report(bronze_ops.read_manifest(spark, target, "run-1"), "s3://bronze")
    return report.select("landing_key", "file_names", "body", "subject")


@query(f"""SELECT 'nation-' || c_nationkey || {sql_chunk("c_custkey", ROWS)} || '.zip' AS zip_file_name, 'part/BUILDING.csv' AS member,
  '{{"c_custkey":"' || c_custkey || '","c_name":"' || c_name || '","c_nationkey":"' || c_nationkey || '"}}' AS row_json
FROM customer WHERE c_mktsegment = 'BUILDING'""")
def quarantine_view(spark: SparkSession, sf: str) -> DataFrame:
    _, target, _ = load(spark, mismatching_customer_lines(spark, sf), {"customer": CUSTOMER_SCHEMA})
    return bronze_ops.quarantine_rows(spark, target, bronze_ops.read_manifest(spark, target, "run-1"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, 'run-2' AS _dag_run_id FROM part""")
def quarantine_reprocess(spark: SparkSession, sf: str) -> DataFrame:
    """Members lack a column at first; then the registry accepts them as they are."""
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    names = ["p_partkey", "p_name", "p_brand"]
    archive = key_of("part", F.concat(F.lit("part-"), "p_type", chunk("p_partkey", ROWS)))
    lines = deliveries.as_csv(df, archive, F.lit("part.csv"), names)
    root, target, _ = load(spark, lines, {"part": text_schema([*names, "p_type"])})
    manifest = bronze_ops.read_manifest(spark, target, "run-1")
    schema = text_schema(names)
    bronze_ops.reprocess_quarantine(zips.list_archives(spark, root), manifest, target, {"part": schema}, "run-2")
    rows = bronze_ops.read_bronze(spark, target, "feed", "part", schema)
    return rows.select(*names, "_dag_run_id")


@query(f"SELECT {SQL_CUSTOMER_TEXT}, 'run-2' AS _dag_run_id FROM customer")
def archive_rerun_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    root, target, _ = load(spark, mixed_customer_lines(spark, sf), {"customer": CUSTOMER_SCHEMA})
    archives = zips.list_archives(spark, root)
    bronze_ops.load_archives(archives, target, {"customer": CUSTOMER_SCHEMA}, "run-2", MOMENT)
    rows = bronze_ops.read_bronze(spark, target, "feed", "customer", CUSTOMER_SCHEMA)
    return rows.select(*CUSTOMER_SCHEMA.names, "_dag_run_id")


@query(f"SELECT {SQL_ORDER_TEXT} FROM orders WHERE o_orderpriority <> '5-LOW'")
def archive_failure_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """The archive of one priority holds a broken member, so all of it stays out."""
    df = orders_text(spark, sf)
    archive = key_of("orders", F.concat(F.lit("prio-"), F.substring("o_orderpriority", 1, 1), chunk("o_orderkey", ROWS)))
    member = F.concat(F.lit("orders-"), F.substring("o_orderdate", 1, 4), F.lit(".csv"))
    good = deliveries.as_csv(df, archive, member, df.columns)
    low = df.where("o_orderpriority = '5-LOW'")
    broken = deliveries.as_json(low, archive, F.lit("orders.json"), F.lit('{"o_orderkey": 1'))
    _, target, _ = load(spark, good.unionByName(broken), {"orders": ORDER_SCHEMA})
    return bronze_ops.read_bronze(spark, target, "feed", "orders", ORDER_SCHEMA).select(*ORDER_SCHEMA.names)


LINEITEM_NAMES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def lineitem_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as CSV: one archive per year, one member per month."""
    df = table(spark, sf, "lineitem")
    df = df.select(
        *[money(c).alias(c) if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") else F.col(c) for c in LINEITEM_NAMES[:-1]],
        F.date_format("l_shipdate", TS).alias("l_shipdate"),
    )
    year, month = F.substring("l_shipdate", 1, 4), F.substring("l_shipdate", 1, 7)
    archive = key_of("lineitem", F.concat(F.lit("lineitem-"), year, chunk("l_orderkey", ROWS)))
    return deliveries.as_csv(df, archive, F.concat(F.lit("lineitem-"), month, F.lit(".csv")), LINEITEM_NAMES)


@query(f"""SELECT 'lineitem-' || strftime(l_shipdate, '%Y') || {sql_chunk("l_orderkey", ROWS)} || '.zip' AS _zip_file_name,
  'lineitem-' || strftime(l_shipdate, '%Y-%m') || '.csv' AS _source_file_name, 'run-1' AS _dag_run_id,
  'valid' AS _schema_status, '2026-01-01' AS ingest_date, 'lineitem-' || strftime(l_shipdate, '%Y') || {sql_chunk("l_orderkey", ROWS)} AS zip_name,
  COUNT(*)::BIGINT AS n_rows, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS extended
FROM lineitem GROUP BY ALL""")
def lineage_counts(spark: SparkSession, sf: str) -> DataFrame:
    schema = text_schema(LINEITEM_NAMES)
    _, target, _ = load(spark, lineitem_lines(spark, sf), {"lineitem": schema})
    rows = bronze_ops.read_bronze(spark, target, "feed", "lineitem", schema)
    return rows.groupBy(
        "_zip_file_name", "_source_file_name", "_dag_run_id", "_schema_status", "ingest_date", "zip_name"
    ).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("extended"),
    )


@query("""SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2)) AS exact_price, NULL::BIGINT AS whole_price,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS float_price FROM part""")
def recast_from_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Three sets of casting rules over the same bronze rows; nothing is unpacked again.

    A price with cents is no whole number, so that rule gives nulls.
    """
    df = table(spark, sf, "part").select("p_partkey", money("p_retailprice").alias("p_retailprice"), "p_type")
    archive = key_of("part", F.concat(F.lit("part-"), "p_type", chunk("p_partkey", ROWS)))
    schema = text_schema(["p_partkey", "p_retailprice"])
    _, target, _ = load(spark, deliveries.as_csv(df, archive, F.lit("part.csv"), schema.names), {"part": schema})
    rows = bronze_ops.read_bronze(spark, target, "feed", "part", schema).select(*schema.names)
    key = {"p_partkey": silver.Cast("bigint")}
    kinds = {"exact_price": "decimal(18,2)", "whole_price": "bigint", "float_price": "double"}
    tables = [
        silver.cast_columns(rows, {**key, "p_retailprice": silver.Cast(kind)}).withColumnRenamed("p_retailprice", name)
        for name, kind in kinds.items()
    ]
    return functools.reduce(lambda a, b: a.join(b, "p_partkey"), tables)


def registry_from_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """One source per supplier; its keywords are the nations of its region and the kinds of events."""
    nations = table(spark, sf, "nation")
    by_region = nations.groupBy("n_regionkey").agg(F.array_sort(F.collect_set("n_name")).alias("nations"))
    kinds = table(spark, sf, "events").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    place = nations.join(by_region, "n_regionkey").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey", "nations")
    host = F.concat(F.lit("bucket-"), F.col("n_regionkey").cast("string"), F.lit("/exports/"))
    url = (
        F.when(F.col("s_acctbal") < 0, F.concat(F.lit("ftp://"), host))
        .when(F.col("s_acctbal") < 1000, F.lit(None))
        .when(F.col("s_acctbal") < 2000, F.lit("s3:///"))
        .otherwise(F.concat(F.lit("s3://"), host))
    )
    path = F.when(F.col("s_acctbal") >= 9000, "data/{kind}/{region}.zip").otherwise("data/{kind}/{nation}-{date}.zip")

    def endpoint(path: Column, dataset: Column) -> Column:
        return F.struct(path.alias("path"), dataset.alias("dataset_name"), F.lit("").alias("declared"))

    def keyword(name: str, choices: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), choices.alias("choices"))

    return table(spark, sf, "supplier").join(place, "s_nationkey").select(
        F.col("s_name").alias("source_name"),
        F.col("s_suppkey").cast("int").alias("ordinal"),
        F.lit(True).alias("enabled"),
        url.alias("base_url"),
        F.when(F.col("n_regionkey") == 0, "conn_0").alias("airflow_conn"),
        F.col("n_regionkey").isin(0, 1).alias("has_airflow_conn"),
        F.array(F.lit("ingest")).alias("dag_ids"),
        F.array(
            endpoint(path, F.lit("daily_{kind}")), endpoint(F.lit("static/{date}.zip"), F.lit("fixed"))
        ).alias("endpoints"),
        F.array(
            keyword("nation", F.col("nations")), keyword("kind", kinds.scalar()), keyword("date", F.array(F.lit("1999-01-01")))
        ).alias("keywords"),
    )


def resolved(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    configure(spark)
    sources = registry_from_suppliers(spark, sf)
    return registry.resolve(sources, "ingest", ["s3", "https"], {"date": "2026-01-01"})


@query("""WITH s AS (SELECT s_name, n.n_regionkey FROM supplier JOIN nation n ON s_nationkey = n_nationkey
    WHERE s_acctbal >= 2000 AND s_acctbal < 9000),
  w AS (
  SELECT s_name AS source_name, 'daily_' || k.event_type AS dataset_name, s.n_regionkey,
    'data/' || k.event_type || '/' || m.n_name || '-2026-01-01.zip' AS key
  FROM s JOIN nation m ON m.n_regionkey = s.n_regionkey CROSS JOIN (SELECT DISTINCT event_type FROM events) k
  UNION ALL SELECT s_name, 'fixed', n_regionkey, 'static/2026-01-01.zip' FROM s)
SELECT source_name, dataset_name, 'bucket-' || n_regionkey || '/exports' AS bucket, key,
  CASE WHEN n_regionkey = 0 THEN 'conn_0' WHEN n_regionkey = 1 THEN NULL ELSE 'aws_conn' END AS aws_conn_id FROM w""")
def source_worklist(spark: SparkSession, sf: str) -> DataFrame:
    endpoints, _ = resolved(spark, sf)
    return registry.work_list(endpoints, "aws_conn").drop("ordinal", "position")


@query("""SELECT s_name AS source_name FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 4 IN (0, 1)""")
def source_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Of sources that are disabled, of other jobs, of several or of none, those that a job takes."""
    jobs = F.array(F.array(F.lit("ingest")), F.array(F.lit("other"), F.lit("ingest")), F.array(F.lit("other")), F.lit(None))
    changed = registry_from_suppliers(configure(spark), sf).withColumns(
        {"enabled": F.col("ordinal") % 5 != 0, "dag_ids": F.element_at(jobs, F.col("ordinal") % 4 + 1)}
    )
    return registry.select_sources(changed, "ingest").select("source_name")


SQL_SOURCE_ERRORS = """SELECT s_suppkey, s_name AS source_name, CASE
  WHEN s_acctbal < 0 THEN 'Source ''' || s_name || ''' has base_url ''ftp://bucket-' || n_regionkey
    || '/exports/''; expected one of [''s3'', ''https''] as the scheme.'
  WHEN s_acctbal < 1000 THEN 'Source ''' || s_name || ''' must have a ''base_url''.'
  WHEN s_acctbal < 2000 THEN 'Source ''' || s_name || ''' has nothing after the scheme in base_url ''s3:///''.'
  ELSE 'Endpoint ''data/{kind}/{region}.zip'' or dataset name ''daily_{kind}'' in source ''' || s_name
    || ''' is invalid or references an undefined parameter: ''region''' END AS errors
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 2000 OR s_acctbal >= 9000"""


@query(f"SELECT source_name, errors FROM ({SQL_SOURCE_ERRORS})")
def source_errors(spark: SparkSession, sf: str) -> DataFrame:
    _, errors = resolved(spark, sf)
    return errors.select("source_name", F.array_join("errors", "; ").alias("errors"))


@query(f"""SELECT 'Malformed sources:<ul>' || coalesce(string_agg('<li><b>' || source_name || '</b>: ' || errors || '</li>', ''
  ORDER BY s_suppkey), '') || '</ul>' AS message FROM ({SQL_SOURCE_ERRORS})""")
def source_error_report(spark: SparkSession, sf: str) -> DataFrame:
    _, errors = resolved(spark, sf)
    return registry.error_report(errors)


@query("""WITH k AS (SELECT p_partkey, 'src-' || replace(p_brand, '#', '') AS s, lower(p_type) AS d,
    'exports/' || p_size || '/' || replace(p_name, ' ', '.') || '.' || p_partkey || '.ZIP' AS key FROM part),
  l AS (SELECT *, s || '/' || d || '/ingest_date=2026-01-01/' || split_part(key, '/', 3) AS landing_key FROM k)
SELECT p_partkey, landing_key,
  s || '/' || d || '/ingest_date=2026-01-01/zip_name=' || regexp_replace(split_part(key, '/', 3), '\\.[^.]*$', '') AS bronze_key,
  s || '/' || d || '/ingest_date=2026-01-01/zip_name=' || regexp_replace(split_part(key, '/', 3), '\\.[^.]*$', '')
    || '/schema_status=valid' AS status_key,
  replace(key, '/', '__') AS flat_member, 'zip' AS extension, split_part(key, '/', 3) AS zip_file_name,
  replace(key, '/', '__') AS from_part
FROM l""")
def key_builders(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    df = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("src-"), F.replace("p_brand", F.lit("#"), F.lit(""))).alias("s"),
        F.lower("p_type").alias("d"),
        F.concat(
            F.lit("exports/"), F.col("p_size").cast("string"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit(".")),
            F.lit("."), F.col("p_partkey").cast("string"), F.lit(".ZIP"),
        ).alias("key"),
    )
    landed = df.withColumn(
        "landing_key", paths.landing_key(F.col("s"), F.col("key"), F.col("d"), F.lit("2026-01-01"))
    )
    flat = paths.flat_member_name(F.col("key"))
    part_key = F.concat(paths.schema_status_key(F.col("landing_key"), F.lit("valid")), F.lit("/"), flat, F.lit("_part-0.parquet"))
    return landed.select(
        "p_partkey",
        "landing_key",
        paths.bronze_key(F.col("landing_key")).alias("bronze_key"),
        paths.schema_status_key(F.col("landing_key"), F.lit("valid")).alias("status_key"),
        flat.alias("flat_member"),
        paths.extension(F.col("key")).alias("extension"),
        paths.base_name(F.col("landing_key")).alias("zip_file_name"),
        paths.member_from_part(part_key).alias("from_part"),
    )


def landed_customers(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Pack customers by segment and nation at a source, then copy the archives to a landing zone."""
    configure(spark)
    df = customer_text(spark, sf)
    nation = F.concat(F.col("c_nationkey").cast("string"), chunk("c_custkey", ROWS))
    name = F.concat(F.col("c_mktsegment"), F.lit("-"), nation, F.lit(".zip"))
    source, target = fresh_folder(spark, "source"), fresh_folder(spark, "landing")
    packed = deliveries.pack_archives(
        deliveries.as_csv(df, F.concat(F.lit("daily/"), name), F.lit("customers.csv"), df.columns), source
    )
    work = packed.select(
        F.lit("partner").alias("source_name"),
        F.lit("customer").alias("dataset_name"),
        F.lit(source).alias("bucket"),
        F.col("archive").alias("key"),
    )
    landed = landing.land_files(work, target, "2026-01-01", f"{target}-report", "{bucket}/{key}")
    return target, landed


SQL_LANDED = f"""(SELECT DISTINCT c_mktsegment, 'partner/customer/ingest_date=2026-01-01/' || c_mktsegment || '-'
  || c_nationkey || {sql_chunk("c_custkey", ROWS)} || '.zip' AS landing_key FROM customer)"""


@query(f"""SELECT 'landing' AS landing_bucket, landing_key, 'customer' AS dataset_name, 'bronze' AS destination_bucket,
  'run-1' AS dag_run_id FROM {SQL_LANDED}""")
def land_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Copied files, equal in size on both ends, as bronze work rows."""
    _, landed = landed_customers(spark, sf)
    equal = landed.where(F.col("source_size") == F.col("landed_size"))
    return landing.batch_fan_out(landing.landed_events(equal, "landing"), "bronze", "run-1")


@query(f"""SELECT landing_key AS key, CASE c_mktsegment WHEN 'BUILDING' THEN 'mismatch_deleted'
    WHEN 'MACHINERY' THEN 'unverifiable' ELSE 'ok' END AS status,
  (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS still_there
FROM (SELECT c_mktsegment, CASE WHEN c_mktsegment = 'MACHINERY' THEN landing_key || '.part' ELSE landing_key END AS landing_key
  FROM {SQL_LANDED})""")
def landing_size_check(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes are expected wrongly for one segment, and another one's files under other names."""
    target, landed = landed_customers(spark, sf)
    building = F.col("landing_key").contains("/BUILDING-")
    machinery = F.col("landing_key").contains("/MACHINERY-")
    expected = landed.select(
        F.when(machinery, F.concat("landing_key", F.lit(".part"))).otherwise(F.col("landing_key")).alias("key"),
        (F.col("source_size") + F.when(building, 5).otherwise(0)).alias("expected_size"),
    )
    checked = landing.verify_landed(expected, target, f"{target}-check")
    left = landing.list_files(spark, target).select("key", F.lit(True).alias("still_there"))
    return checked.join(left, "key", "left").select(
        "key", "status", F.coalesce("still_there", F.lit(False)).alias("still_there")
    )


@query("""WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, max(ts) AS seen FROM events GROUP BY ALL),
  b AS (SELECT min(date_trunc('hour', ts)) AS lo, max(date_trunc('hour', ts)) AS hi FROM events),
  e AS (SELECT k.event_type, t.hour FROM (SELECT DISTINCT event_type FROM events) k,
    (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b) t)
SELECT e.event_type || '/' || strftime(e.hour, '%Y-%m-%d-%H') || '.json' AS key,
  CASE WHEN seen IS NOT NULL THEN 'arrived' WHEN b.hi > e.hour + INTERVAL 24 HOURS THEN 'timed_out' ELSE 'waiting' END AS state
FROM e CROSS JOIN b LEFT JOIN h ON h.event_type = e.event_type AND h.hour = e.hour""")
def await_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly files that the calendar expects, against the hours in which events were seen."""
    configure(spark)
    events = table(spark, sf, "events").select("event_type", "ts", F.date_trunc("hour", "ts").alias("hour"))

    def file_key() -> Column:
        return F.concat("event_type", F.lit("/"), F.date_format("hour", "yyyy-MM-dd-HH"), F.lit(".json"))

    span = events.groupBy("event_type").agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    lo, hi = span.agg(F.min("lo")).scalar(), span.agg(F.max("hi")).scalar()
    hours = F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR")))
    expected = span.select("event_type", hours.alias("hour")).select(file_key().alias("key"), "hour")
    listing = events.groupBy("event_type", "hour").agg(
        F.count("*").alias("length"), F.max("ts").alias("modificationTime")
    ).select(file_key().alias("key"), "length", "modificationTime")
    now = span.agg(F.max("hi")).scalar()
    return landing.await_arrivals(expected, listing, F.col("hour"), now).select("key", "state")


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON: archives by day and range of events, one member per hour."""
    df = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type",
        money("value").alias("value"),
    )
    archive = key_of("events", F.concat(F.lit("events-"), F.substring("ts", 1, 10), chunk("event_id", ROWS)))
    hour = F.replace(F.substring("ts", 1, 13), F.lit(" "), F.lit("-"))
    member = F.concat(F.lit("events-"), hour, F.lit(".json"))
    return deliveries.as_json(df, archive, member, F.to_json(F.struct(*df.columns)))


EVENT_SCHEMA = text_schema(["event_id", "ts", "user_id", "event_type", "value"])


@query(f"""SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  CAST(user_id AS VARCHAR) AS user_id, event_type, {SQL_MONEY.format("value")} AS value,
  'events-' || strftime(ts, '%Y-%m-%d-%H') || '.json' AS _source_file_name FROM events""")
def stream_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Archives loaded as a stream, then landed again and loaded by the ledger: no row twice."""
    configure(spark)
    root, target = fresh_folder(spark, "landing"), fresh_folder(spark, "bronze")
    lines = event_lines(spark, sf)
    deliveries.pack_archives(lines, root)
    schemas = {"events": EVENT_SCHEMA}
    arrivals.start_arrival_stream(spark, root, target, schemas, f"{target}-checkpoint").awaitTermination()
    first_day = table(spark, sf, "events").agg(F.date_format(F.min("ts"), "yyyy-MM-dd")).scalar()
    deliveries.pack_archives(lines.where(F.col("archive").contains(first_day)), root)
    arrivals.load_pending(spark, root, target, schemas, "relanded", MOMENT)
    rows = bronze_ops.read_bronze(spark, target, "feed", "events", EVENT_SCHEMA)
    return rows.select(*EVENT_SCHEMA.names, "_source_file_name")


def receipt_archive_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as point-of-sale receipts: one JSON member per pharmacy, with nested products and payments."""
    price = money("l_extendedprice")
    df = table(spark, sf, "lineitem").withColumn("pharmacy", F.lpad(F.pmod("l_suppkey", F.lit(25)).cast("string"), 4, "0"))
    product = F.struct(
        F.col("l_partkey").cast("string").alias("gtin"), price.alias("price"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    payments = F.array(
        F.struct(price.alias("amount"), F.col("l_linestatus").alias("method")),
        F.struct(F.lit(0).cast("decimal(18,2)").alias("amount"), F.lit("bonus").alias("method")),
    )
    receipt = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("receipt_id"),
        F.concat(F.lit("PH-"), "pharmacy").alias("pharmacy_code"),
        F.lit("Z1").alias("zone_code"),
        F.date_format("l_shipdate", TS).alias("receipt_ts"),
        F.col("l_returnflag").alias("order_id"),
        F.array(product).alias("products"),
        payments.alias("payments"),
    )
    archive = key_of("pos_receipts", F.concat(F.lit("pos_receipts"), chunk("l_orderkey", ROWS)))
    member = F.concat(F.lit("pos_receipts-PH-"), "pharmacy", F.lit(".json"))
    return deliveries.as_json(df, archive, member, F.to_json(receipt))


@query("""SELECT CAST(l_partkey AS VARCHAR) AS gtin, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS packs,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue, COUNT(*)::BIGINT AS n_lines,
  CAST(MIN(l_shipdate) AS DATE) AS first_day, CAST(MAX(l_shipdate) AS DATE) AS last_day
FROM lineitem GROUP BY l_partkey""")
def receipts_to_demand(spark: SparkSession, sf: str) -> DataFrame:
    """Nested receipts of all pharmacies, from JSON members to packs sold per product."""
    _, target, _ = load(spark, receipt_archive_lines(spark, sf), partner.SCHEMAS)
    receipts = bronze_ops.read_bronze(spark, target, "feed", "pos_receipts", partner.SCHEMAS["pos_receipts"])
    sold = partner.with_day(partner.receipt_lines(receipts), "receipt_ts")
    return sold.groupBy("gtin").agg(
        F.sum("quantity").alias("packs"),
        F.sum("price").cast("decimal(38,2)").alias("revenue"),
        F.count("*").alias("n_lines"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


@query("""SELECT 'PH-' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 4, '0') AS pharmacy_code, method, COUNT(*)::BIGINT AS n_payments,
  CAST(SUM(amount) AS DECIMAL(38,2)) AS amount FROM (
  SELECT l_suppkey, l_linestatus AS method, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem
  UNION ALL SELECT l_suppkey, 'bonus', CAST(0 AS DECIMAL(18,2)) FROM lineitem) GROUP BY ALL""")
def receipt_payments(spark: SparkSession, sf: str) -> DataFrame:
    """The other child table of the same receipts: payments, which never multiply the products."""
    _, target, _ = load(spark, receipt_archive_lines(spark, sf), partner.SCHEMAS)
    receipts = bronze_ops.read_bronze(spark, target, "feed", "pos_receipts", partner.SCHEMAS["pos_receipts"])
    paid = partner.receipt_payments(receipts)
    return paid.groupBy("pharmacy_code", "method").agg(
        F.count("*").alias("n_payments"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )


@query(f"""WITH m AS (SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT strftime(ts, '%H') || {sql_chunk("event_id", ROWS)})::BIGINT AS members
  FROM events GROUP BY 1),
  c AS (SELECT CAST(unnest(generate_series(MIN(day), MAX(day) + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM m)
SELECT 'events' AS dataset_name, c.day, COALESCE(members, 0)::BIGINT AS members, COALESCE(members >= 24, FALSE) AS complete,
  (members IS NOT NULL) AS agreed_format, FALSE AS on_time
FROM c LEFT JOIN m ON m.day = c.day""")
def scorecard_from_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Daily archives of hourly members against the calendar, one day beyond the last delivery.

    The archives of 2024 land now, so no delivery is on time.
    """
    lines = event_lines(spark, sf)
    day = F.regexp_extract("archive", r"events-(\d{4}-\d{2}-\d{2})(-\d+\.zip)$", 1)
    name = F.regexp_extract("archive", r"events-(\d{4}-\d{2}-\d{2})(-\d+\.zip)$", 2)
    dated = lines.withColumn("archive", F.concat(F.lit("feed/events/ingest_date="), day, F.lit("/events"), name))
    _, target, _ = load(spark, dated, {"events": EVENT_SCHEMA})
    delivered = marts.delivered_from_ledger(bronze_ops.read_ledger(spark, target))
    events = table(spark, sf, "events").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    calendar = events.select(F.lit("events").alias("dataset_name"), F.lit(24).alias("expected_members"), "lo", "hi")
    expected = marts.expected_deliveries(calendar, F.col("lo"), F.date_add("hi", 1))
    card = marts.delivery_scorecard(expected, delivered)
    return card.select(
        "dataset_name", "day", F.coalesce("members", F.lit(0)).alias("members"), "complete", "agreed_format", "on_time"
    )


# Loads that follow each other


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, year(o_orderdate)::INT AS order_year FROM orders""")
def silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Orders land, are loaded and reach silver; updates of the dear ones land later and are merged in."""
    root, target, _ = load(spark, orders_lines(spark, sf), {"orders": ORDER_SCHEMA})
    silver_table = fresh_folder(spark, "silver") + "/orders"

    def typed(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            F.substring("o_orderdate", 1, 4).cast("int").alias("order_year"),
        )

    def advance() -> int:
        staging = fresh_folder(spark, "staging")
        return silver.load_silver(
            spark, target, "feed", "orders", ORDER_SCHEMA, typed, silver_table, ["o_orderkey"], ["order_year"], staging
        )

    advance()
    dear = orders_text(spark, sf).where("o_totalprice > 200000").withColumn("o_orderstatus", F.lower("o_orderstatus"))
    later = key_of("orders", F.concat(F.lit("updates"), chunk("o_orderkey", ROWS)))
    deliveries.pack_archives(deliveries.as_csv(dear, later, F.lit("updates.csv"), dear.columns), root)
    arrivals.load_pending(spark, root, target, {"orders": ORDER_SCHEMA}, "run-2", MOMENT)
    advance()
    if advance():
        raise ValueError("an archive came to silver twice")
    kept = "o_orderkey bigint, o_orderstatus string, o_totalprice decimal(18,2), order_year int"
    return silver.read_silver(spark, silver_table, kept)


@query("""SELECT 'run-' || CASE WHEN c_mktsegment = 'BUILDING' THEN '10' ELSE '9' END AS run_id, 'complete' AS status, COUNT(*)::BIGINT AS n_rows
FROM customer GROUP BY 1""")
def ledger_last_run(spark: SparkSession, sf: str) -> DataFrame:
    """The last load of an archive counts, whatever its run is called: run-9 loads all, run-10 some of them again."""
    df = customer_text(spark, sf)
    part = F.when(F.col("c_mktsegment") == "BUILDING", "building").otherwise("other")
    lines = deliveries.as_csv(df, key_of("customer", part), F.lit("customers.csv"), df.columns)
    schemas = {"customer": CUSTOMER_SCHEMA}
    root, target, _ = load(spark, lines, schemas, "run-9")
    again = zips.list_archives(spark, root).where("zip_name = 'building'")
    bronze_ops.load_archives(again, target, schemas, "run-10", MOMENT)
    last = bronze_ops.last_attempts(bronze_ops.read_ledger(spark, target))
    return last.groupBy("run_id", "status").agg(F.sum("n_rows").alias("n_rows"))


@query("""SELECT CASE c_nationkey % 3 WHEN 0 THEN 'flags.json' WHEN 1 THEN 'deep.json' ELSE 'wide.csv' END AS member,
  COUNT(*)::BIGINT AS n_rows FROM customer GROUP BY 1""")
def quarantine_mixed_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """One column name, three types: members of any shape are kept, rows counted in one view."""
    df = customer_text(spark, sf)
    kind = F.pmod("c_nationkey", F.lit(3))
    flags = df.where(kind == 0).select(F.struct((F.col("c_acctbal") > 0).alias("c_custkey")).alias("r"))
    deep = df.where(kind == 1).select(F.struct(F.struct("c_custkey", "c_name").alias("c_custkey")).alias("r"))
    wide = df.where(kind == 2)
    archive = key_of("customer", F.lit("mixed"))
    lines = (
        deliveries.as_json(flags, archive, F.lit("flags.json"), F.to_json("r"))
        .unionByName(deliveries.as_json(deep, archive, F.lit("deep.json"), F.to_json("r")))
        .unionByName(deliveries.as_csv(wide, archive, F.lit("wide.csv"), ["c_custkey", "c_name"]))
    )
    _, target, _ = load(spark, lines, {"customer": CUSTOMER_SCHEMA})
    view = bronze_ops.quarantine_rows(spark, target, bronze_ops.read_manifest(spark, target, "run-1"))
    return view.groupBy("member").agg(F.count("*").alias("n_rows"))


SQL_RELAND = """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 AND o_orderkey % 7 <> 0
    THEN CASE WHEN o_orderkey % 5 = 0 THEN 'again-' ELSE '' END || lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, year(o_orderdate)::INT AS order_year FROM orders
UNION ALL SELECT -1 - o_orderkey, 'late', CAST(o_totalprice AS DECIMAL(18,2)), year(o_orderdate)::INT FROM orders WHERE o_orderpriority = '5-LOW'"""


@query(SQL_RELAND)
def silver_reland(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, then updates of the dear ones for the next day; these land again with rows gone and
    changed, and an archive of the day before comes last: it adds what nobody knows and overwrites nothing.
    """
    df = orders_text(spark, sf)
    root, target, _ = load(spark, orders_lines(spark, sf), {"orders": ORDER_SCHEMA})

    def typed(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            F.substring("o_orderdate", 1, 4).cast("int").alias("order_year"),
            *retraction.DELIVERY,
        )

    kept = typed(spark.createDataFrame([], ORDER_SCHEMA).withColumns({c: F.lit("") for c in retraction.DELIVERY}))
    table_ = retraction.SilverTable(
        spark, fresh_folder(spark, "reland"), kept.drop(*retraction.DELIVERY).schema, ("o_orderkey",), (), ("order_year",), buckets=2
    )

    def deliver(rows: DataFrame, day: str, run: str) -> dict[str, int]:
        name = F.concat(F.lit(f"feed/orders/ingest_date={day}/part"), chunk("o_orderkey", ROWS), F.lit(".zip"))
        deliveries.pack_archives(deliveries.as_csv(rows, name, F.lit("orders.csv"), df.columns), root)
        arrivals.load_pending(spark, root, target, {"orders": ORDER_SCHEMA}, run, MOMENT)
        return retraction.load_deliveries(table_, target, "feed", "orders", ORDER_SCHEMA, typed)

    retraction.load_deliveries(table_, target, "feed", "orders", ORDER_SCHEMA, typed)
    dear = df.where("o_totalprice > 200000").withColumn("o_orderstatus", F.lower("o_orderstatus"))
    deliver(dear, "2026-01-02", "run-2")
    again = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("again-"), "o_orderstatus")).otherwise(F.col("o_orderstatus"))
    deliver(dear.where("o_orderkey % 7 <> 0").withColumn("o_orderstatus", again), "2026-01-02", "run-3")
    low = df.where("o_orderpriority = '5-LOW'")
    stale = low.withColumn("o_orderstatus", F.lit("stale"))
    late = low.withColumns({"o_orderkey": -1 - F.col("o_orderkey"), "o_orderstatus": F.lit("late")})
    deliver(stale.unionByName(late), "2025-12-31", "run-4")
    return table_.current.rows()
