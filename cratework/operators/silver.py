"""Silver: text to types, rejects, latest rows, nested rows, local times, upserts."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework import files
from cratework.operators import bronze


@dataclass(frozen=True)
class Cast:
    """How one text column becomes typed; ``fmt`` is a date/time pattern."""

    kind: str
    fmt: str | None = None

    def apply(self, column: Column) -> Column:
        if self.fmt and self.kind == "date":
            return F.try_to_timestamp(column, F.lit(self.fmt)).cast("date")
        if self.fmt:
            return F.try_to_timestamp(column, F.lit(self.fmt)).cast(self.kind)
        return column.try_cast(self.kind)


def clean_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trim; empty becomes null."""
    return df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in columns})


def cast_columns(df: DataFrame, rules: dict[str, Cast]) -> DataFrame:
    """Typed columns; text that does not fit becomes null (bronze keeps the text)."""
    return df.withColumns({name: rule.apply(F.col(name)) for name, rule in rules.items()})


def _reasons(rules: dict[str, Cast]) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(F.col(name).isNotNull() & rule.apply(F.col(name)).isNull(), F.lit(f"{name}: not {rule.kind}"))
                for name, rule in rules.items()
            ]
        )
    )


def split_rejects(df: DataFrame, rules: dict[str, Cast]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected text rows with their reasons); together they are all rows."""
    checked = df.withColumn("reject_reasons", _reasons(rules))
    good = cast_columns(checked.where(F.size("reject_reasons") == 0).drop("reject_reasons"), rules)
    return good, checked.where(F.size("reject_reasons") > 0)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (which should tell all rows apart).

    An aggregate, not a ranking: each task reduces its own rows of a key before the
    shuffle, so a key with a third of all rows moves as few rows as any other.
    """
    others = [c for c in df.columns if c not in keys]
    rest = [c for c in others if c not in order]
    last = F.max_by(F.struct(*others), F.struct(*order)) if rest else F.max(F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.*").select(*df.columns)


def incremental(incoming: DataFrame, loaded: DataFrame, on: list[str]) -> DataFrame:
    """Rows of deliveries not in the ledger yet. Both sides' keys name deliveries."""
    return incoming.join(loaded.select(*on).distinct(), on, "left_anti")


def changed_since(df: DataFrame, column: str, since: str) -> DataFrame:
    """Rows touched after a high-water mark; the filter reaches the source scan."""
    return df.where(F.col(column) > F.lit(since).cast("timestamp"))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The target with the changes applied: new keys added, known keys replaced.

    Of several changes of a key the last by ``order`` counts (without one, the greatest by all its
    columns). If the target has the columns of ``order`` too, a stored row stays against an
    older change; of equals the change counts. Each side is reduced to one row per key in every
    task first, so no key can be hot. A change whose key has a null part stops the job: it could
    never be found again.
    """
    last = last_changes(changes, keys, order)
    return _with_changes(target, last, keys, order)


def last_changes(changes: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The change of each key that counts, see ``upsert``; a key with a null part stops the job."""
    null_key = functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    checked = F.when(null_key, F.raise_error(F.lit(f"upsert: a change has no {', '.join(keys)}").cast("string")))
    changes = changes.where(F.coalesce(checked.cast("boolean"), F.lit(True)))
    order = order or []
    rest = [c for c in changes.columns if c not in keys and c not in order]
    return latest_per_key(changes, keys, [*order, *rest]) if order or rest else changes.distinct()


def _with_changes(target: DataFrame, last: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    """``upsert`` with one change of a key at most."""
    if order and set(order) <= set(target.columns):
        both = target.withColumn("_new", F.lit(0)).unionByName(last.select(*target.columns).withColumn("_new", F.lit(1)))
        return latest_per_key(both, keys, [*order, "_new"]).drop("_new")
    kept = target.join(last.select(*keys), keys, "left_anti")
    return kept.unionByName(last.select(*target.columns))


def explode_struct(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """One row per element of an array of structs, fields as columns; empty arrays give one null row."""
    return df.select(*keep, F.inline_outer(column))


def explode_map(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """One row per entry of a map."""
    return df.select(*keep, F.explode_outer(column).alias("name", "value"))


def local_to_utc(df: DataFrame, zones: DataFrame, on: str, local: str, utc: str) -> DataFrame:
    """UTC time of a local time, by the time zone of the row's commercial zone.

    ``zones`` has one row per zone with a ``time_zone`` column (our assumption: a
    zone covers one region and so has one time zone).
    """
    return df.join(zones.select(on, "time_zone"), on, "left").withColumn(
        utc, F.to_utc_timestamp(F.col(local), F.col("time_zone"))
    )


def write_silver(
    df: DataFrame, target: str, partition_by: list[str] | None = None, catalog_table: bool = False
) -> None:
    """Replace the partitions present in ``df``.

    With a catalog (such as Iceberg) configured the target is a table name, else a
    Parquet folder. ``df`` must not be read from the folder itself.
    """
    if catalog_table:
        writer = df.writeTo(target)
        if df.sparkSession.catalog.tableExists(target):
            writer.overwritePartitions()
        else:
            (writer.partitionedBy(*partition_by) if partition_by else writer).create()
        return
    if partition_by:
        # Rows of one partition value meet in few tasks; Spark splits values that are too large for one.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def upsert_stored(
    changes: DataFrame, target: str, keys: list[str], partition_by: list[str], staging: str, order: list[str] | None = None
) -> None:
    """Apply changes to a stored Parquet table; only partitions that they touch are written again.

    Touched are the partitions of the changes and those that hold their keys now (a key may move). The
    new content of these goes to ``staging`` (a fresh folder) first, after the changes, and then replaces them; a
    partition that loses its last row is deleted. Partition values must not be null.
    """
    spark = changes.sparkSession
    last = last_changes(changes, keys, order)
    if not files.glob(spark, f"{target}/*"):
        write_silver(last, target, partition_by)
        return
    # Written once, since it is read several times.
    last.write.parquet(f"{staging}/changes")
    last = spark.read.schema(changes.schema).parquet(f"{staging}/changes")
    stored = spark.read.schema(changes.schema).parquet(target)
    touched = last.select(*partition_by).union(stored.join(last.select(*keys), keys, "left_semi").select(*partition_by))
    touched = touched.distinct().persist()
    try:
        part = stored.join(touched, partition_by, "left_semi")
        _with_changes(part, last, keys, order).write.parquet(f"{staging}/rows")
        new = spark.read.schema(changes.schema).parquet(f"{staging}/rows")
        emptied = touched.join(new.select(*partition_by).distinct(), partition_by, "left_anti").persist()
        emptied.count()
        write_silver(new, target, partition_by)

        def delete(row: dict) -> None:
            files.delete_tree("/".join([target, *(files.partition_dir(c, str(row[c])) for c in partition_by)]))

        files.each_row(emptied, delete)
        emptied.unpersist()
    finally:
        touched.unpersist()
    files.delete_tree(staging)


def pending_for_silver(ledger: DataFrame, silver_ledger: DataFrame | None) -> DataFrame:
    """Complete archives of the bronze ledger whose last load silver does not hold yet."""
    complete = bronze.last_attempts(ledger).where(F.col("status") == bronze.COMPLETE)
    if silver_ledger is None:
        return complete
    return complete.join(silver_ledger.select("path", "attempt").distinct(), ["path", "attempt"], "left_anti")


def load_silver(
    spark: SparkSession, bronze_folder: str, source: str, dataset: str, schema: T.StructType, transform,
    target: str, keys: list[str], partition_by: list[str], staging: str, order: list[str] | None = None,
) -> int:
    """Bring the rows of new complete archives into a stored table; returns how many archives.

    The silver ledger beside the table (``<target>_ledger``) says which load of which archive it
    holds; it is written last, so a run that dies is repeated and applies the same rows again.
    ``transform`` makes typed rows of bronze rows.
    """
    ledger = bronze.current_ledger(spark, bronze_folder)
    if ledger is None:
        return 0
    known = f"{target}_ledger"
    held = spark.read.parquet(known) if files.glob(spark, f"{known}/*") else None
    mine = ledger.where((F.col("source_name") == source) & (F.col("dataset_name") == dataset))
    todo = pending_for_silver(mine, held).persist()
    try:
        count = todo.count()
        if count:
            dates = [r["ingest_date"] for r in todo.select("ingest_date").distinct().collect()]
            rows = bronze.read_bronze(spark, bronze_folder, source, dataset, schema, dates)
            rows = rows.join(todo.select("ingest_date", "zip_name"), ["ingest_date", "zip_name"], "left_semi")
            upsert_stored(transform(rows), target, keys, partition_by, staging, order)
            todo.select("path", "attempt", "ingest_date", "zip_name", "n_rows").write.mode("append").parquet(known)
        return count
    finally:
        todo.unpersist()


def read_silver(spark: SparkSession, target: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(target)
