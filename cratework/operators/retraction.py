"""Silver under late, repeated and corrected deliveries.

Every row of an archive is kept as a version: its key, the archive and the day it was delivered
for. When archives are loaded, or loaded again, their rows are compared with the versions they
left earlier, which gives inserts, updates and deletes. For the keys among them the current row is
found anew: the last version by the row's own order and then by delivery. So a delivery that comes
late cannot win over a newer one, and a key that a corrected archive no longer has falls back to
the delivery before, or goes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework import files
from cratework.operators import bronze, silver
from cratework.operators.key_index import IndexedTable
from cratework.staging import Staging

DELIVERY = ["ingest_date", "zip_name"]
INSERT, UPDATE, DELETE = "insert", "update", "delete"


@dataclass(frozen=True)
class SilverTable:
    """A current table, the versions behind it and a ledger of what they hold, below one folder.

    ``schema`` are the typed columns; ``order`` those that say which of a key's rows is newer (may be
    empty: the later delivery day, then the archive's name, decides alone).
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    buckets: int = 64

    @property
    def current(self) -> IndexedTable:
        return IndexedTable(self.spark, f"{self.path}/current", self.schema, self.keys, self.partition_by, self.buckets)

    @property
    def versions(self) -> IndexedTable:
        schema = T.StructType([*self.schema, *(T.StructField(c, T.StringType()) for c in DELIVERY)])
        return IndexedTable(self.spark, f"{self.path}/versions", schema, self.keys, ("ingest_date",), self.buckets)

    @property
    def ledger_path(self) -> str:
        return f"{self.path}/ledger"

    def ledger(self) -> DataFrame | None:
        return self.spark.read.parquet(self.ledger_path) if files.glob(self.spark, f"{self.ledger_path}/*") else None

    def last_versions(self, versions: DataFrame) -> DataFrame:
        """The current rows that these versions give: one for each key."""
        order = [*self.order, *DELIVERY]
        rest = [c for c in self.schema.names if c not in self.keys and c not in order]
        return silver.latest_per_key(versions, list(self.keys), [*order, *rest]).select(*self.schema.names)


def signed_changes(before: DataFrame, after: DataFrame, identity: list[str]) -> DataFrame:
    """(columns, ``op``): what turns ``before`` into ``after``; rows that are equal on both sides are left out.

    Each side has one row per identity. An update carries the new row, a delete the old one. One
    aggregate over both sides, so rows that are alike cost no join.
    """
    rest = [c for c in before.columns if c not in identity]
    row = F.struct(F.lit(True).alias("_there"), *rest)
    sides = before.withColumn("_side", F.lit("old")).unionByName(after.withColumn("_side", F.lit("new")))
    both = sides.groupBy(*identity).agg(
        F.max(F.when(F.col("_side") == "old", row)).alias("old"), F.max(F.when(F.col("_side") == "new", row)).alias("new")
    )
    op = F.when(F.col("old").isNull(), INSERT).when(F.col("new").isNull(), DELETE).otherwise(UPDATE)
    changed = both.where(~F.col("old").eqNullSafe(F.col("new"))).withColumn("op", op)
    return changed.withColumn("row", F.coalesce("new", "old")).select(*identity, "row.*", "op").select(*before.columns, "op")


def apply_deliveries(table: SilverTable, archives: DataFrame, rows: DataFrame) -> DataFrame:
    """Bring archives' present content into the table; returns their signed changes, as written.

    ``archives``: ingest_date, zip_name of all that were loaded, without rows too. ``rows``: their typed
    rows with these two columns; a key that an archive has several times counts once. The current table
    is written first, then the versions: a run that dies in between is repeated with the same changes.
    """
    spark, versions, keys = table.spark, table.versions, list(table.keys)
    staging = Staging(spark, "retraction")
    archives = staging.write(archives.select(*DELIVERY).distinct(), "archives")
    identity = [*keys, *DELIVERY]
    order = [*table.order, *[c for c in table.schema.names if c not in keys and c not in table.order]]
    after = rows.select(*versions.schema.names)
    after = silver.latest_per_key(after, identity, order) if order else after.distinct()
    # The days of a load, as a list: partitions of other days are not listed.
    days = [r["ingest_date"] for r in archives.select("ingest_date").distinct().collect()]
    before = versions.rows().where(F.col("ingest_date").isin(days)).join(archives, DELIVERY, "left_semi")
    changes = staging.write(signed_changes(before.select(*after.columns), after, identity), "changes")
    if changes.isEmpty():
        return changes
    touched = changes.select(*keys).distinct()
    others = versions.lookup(touched).join(changes.select(*identity), identity, "left_anti")
    put = changes.where(F.col("op") != DELETE).drop("op")
    resolved = table.last_versions(others.unionByName(put.select(*others.columns)))
    table.current.replace(touched, resolved)
    versions.replace(changes.select(*identity), put)
    return changes


def pending(table: SilverTable, ledger: DataFrame) -> DataFrame:
    """Archives whose last load the table does not hold: complete ones, and those that turned out empty."""
    loaded = bronze.last_attempts(ledger).where(F.col("status").isin(bronze.COMPLETE, bronze.EMPTY))
    held = table.ledger()
    return loaded if held is None else loaded.join(held.select("path", "attempt"), ["path", "attempt"], "left_anti")


def load_deliveries(table: SilverTable, bronze_folder: str, source: str, dataset: str, schema: T.StructType, transform) -> dict[str, int]:
    """Bring all loads of a dataset that the table does not hold yet; returns the number of changes by kind.

    ``transform`` makes typed rows of bronze rows and keeps ingest_date and zip_name. An archive
    whose last load failed keeps the versions of its last good one. The ledger is written last.
    """
    spark = table.spark
    ledger = bronze.current_ledger(spark, bronze_folder)
    counts = dict.fromkeys((INSERT, UPDATE, DELETE), 0)
    if ledger is None:
        return counts
    staging = Staging(spark, "pending")
    mine = ledger.where((F.col("source_name") == source) & (F.col("dataset_name") == dataset))
    todo = staging.write(pending(table, mine).select("path", "attempt", *DELIVERY, "n_rows"), "todo")
    if todo.isEmpty():
        return counts
    days = [r["ingest_date"] for r in todo.select("ingest_date").distinct().collect()]
    rows = bronze.read_bronze(spark, bronze_folder, source, dataset, schema, days)
    rows = transform(rows.join(todo.select(*DELIVERY), DELIVERY, "left_semi"))
    changes = apply_deliveries(table, todo, rows)
    counts |= {r["op"]: r["count"] for r in changes.groupBy("op").count().collect()}
    todo.write.mode("append").parquet(table.ledger_path)
    return counts
