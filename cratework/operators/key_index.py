"""Stored tables that find the rows of a key without opening every file.

A table is a Parquet folder, partitioned by its own columns and by ``key_bucket``, a hash of
the key. Beside it stands an index: for every such folder the range of its keys and Bloom
filters, as Spark's bitmap functions build them. A load reads the index rows of its buckets,
opens only the folders that may hold one of its keys, and verifies every row exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework import files
from cratework.operators import silver
from cratework.staging import Staging

BUCKET = "key_bucket"
# Bits of one of Spark's bitmaps, and of them how many stand for a key.
BITS = 32768
PROBES = 4


@dataclass(frozen=True)
class IndexedTable:
    """Where a table is and how it is laid out.

    ``keys`` name one row, or several if ``unique`` is false. ``buckets`` and ``slices`` are fixed for the
    life of the table: a folder should hold at most some 3,000 keys a slice, so that a filter errs
    on less than one key in a hundred. Key parts and partition values must not be null. One
    writer at a time.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    buckets: int = 64
    slices: int = 1

    @property
    def folder_columns(self) -> list[str]:
        return [*self.partition_by, BUCKET]

    @property
    def _rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def _index_path(self) -> str:
        return f"{self.path}/index"

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])

    def exists(self) -> bool:
        return bool(files.glob(self.spark, f"{self._rows_path}/*"))

    def rows(self) -> DataFrame:
        """All rows."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self._stored_schema()).parquet(self._rows_path).select(*self.schema.names)

    def _hash(self, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *self.keys)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(self._hash(0), F.lit(self.buckets)).cast("int"))

    def _probed(self, df: DataFrame) -> DataFrame:
        """A row for each bit of each key: its slice and its place there."""
        places = F.array(*[F.pmod(self._hash(2 + k), F.lit(BITS)) for k in range(PROBES)])
        sliced = df.withColumn("slice", F.pmod(self._hash(1), F.lit(self.slices)).cast("int"))
        return sliced.withColumn("place", F.explode(places))

    def _index_of(self, rows: DataFrame) -> DataFrame:
        """Index rows of the folders in ``rows``: one for each slice, with the folder's key range."""
        ranges = rows.groupBy(*self.folder_columns).agg(
            F.min(F.struct(*self.keys)).alias("low"), F.max(F.struct(*self.keys)).alias("high"), F.count("*").alias("n_rows")
        )
        bitmaps = self._probed(rows).groupBy(*self.folder_columns, "slice").agg(F.bitmap_construct_agg("place").alias("bits"))
        return bitmaps.join(ranges, self.folder_columns)

    def index(self) -> DataFrame | None:
        if not files.glob(self.spark, f"{self._index_path}/*"):
            return None
        key = T.StructType([self.schema[k] for k in self.keys])
        parts = [self.schema[c] for c in self.partition_by]
        more = [T.StructField("slice", T.IntegerType()), T.StructField("bits", T.BinaryType())]
        more += [T.StructField("low", key), T.StructField("high", key), T.StructField("n_rows", T.LongType())]
        schema = T.StructType([*parts, *more, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self._index_path)

    def may_hold(self, wanted: DataFrame) -> DataFrame:
        """The folders (partition columns, key_bucket) that may hold one of the keys in ``wanted``.

        Keys meet the index rows of their own bucket and slice only.
        """
        index = self.index()
        if index is None:
            return self.spark.createDataFrame([], T.StructType([f for f in self._stored_schema() if f.name in self.folder_columns]))
        wanted = self.with_bucket(wanted.select(*self.keys).distinct())
        wanted = wanted.withColumn("slice", F.pmod(self._hash(1), F.lit(self.slices)).cast("int"))
        places = F.array(*[F.pmod(self._hash(2 + k), F.lit(BITS)) for k in range(PROBES)])
        # As columns, so that the hashes are not computed once for each folder.
        wanted = wanted.select(BUCKET, "slice", F.struct(*self.keys).alias("key"), places.alias("places"))
        # Bytes as numbers once for each index row, not for each key that meets it.
        index = index.withColumn("bits", _bytes("bits"))
        both = index.join(wanted, [BUCKET, "slice"]).where((F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high")))
        return both.where(F.forall("places", lambda p: _bit("bits", p) == 1)).select(*self.folder_columns).distinct()

    def open_folders(self, folders: DataFrame) -> DataFrame:
        """The rows of these folders, key_bucket included; no file of another folder is listed or opened.

        The driver gets the folders' names, as it does with every table that Spark lists.
        """
        names = [
            "/".join([self._rows_path, *(files.partition_dir(c, str(row[c])) for c in self.folder_columns)])
            for row in folders.collect()
        ]
        there = [n for n in names if files.glob(self.spark, files.glob_text(n))]
        if not there:
            return self.spark.createDataFrame([], self._stored_schema())
        return self.spark.read.schema(self._stored_schema()).option("basePath", self._rows_path).parquet(*there)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows whose key is in ``wanted``."""
        wanted = wanted.select(*self.keys).distinct()
        found = self.open_folders(self.may_hold(wanted)).join(wanted, list(self.keys), "left_semi")
        return found.select(*self.schema.names)

    def upsert(self, changes: DataFrame, order: list[str]) -> None:
        """Apply changes: of a key's stored row and its changes the last by ``order`` stays.

        ``order`` names columns of the table, so a change that arrives late but is older than what is
        stored changes nothing. Of equals in all of ``order`` the change wins over the stored row, and
        among changes the one with the greatest remaining columns. A change without a key part stops the job.
        """
        if not order:
            raise ValueError("an upsert needs an order, or late changes would win")
        fields = self.schema.names
        rest = [c for c in fields if c not in self.keys and c not in order]

        def merge(stored: DataFrame, last: DataFrame) -> DataFrame:
            every = stored.withColumn("_new", F.lit(0)).unionByName(last.withColumn("_new", F.lit(1)))
            return silver.latest_per_key(every, list(self.keys), [*order, "_new"]).drop("_new")

        checked = _with_keys(changes.select(*fields), self.keys)
        self._apply(silver.latest_per_key(checked, list(self.keys), [*order, *rest]), merge)

    def replace(self, gone: DataFrame, rows: DataFrame) -> None:
        """Remove the stored rows that ``gone`` names and put ``rows`` in.

        ``gone`` has the keys and any other columns of the table that tell which of a key's rows go;
        folders of partitions that it does not name are left alone.
        """
        names = [c for c in self.schema.names if c in gone.columns]

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            return stored.join(removed, names, "left_anti").unionByName(new)

        removed = gone.select(*names).distinct()
        self._apply(_with_keys(rows.select(*self.schema.names), self.keys), merge, removed)

    def _apply(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], removed: DataFrame | None = None) -> None:
        """Merge changes into the folders they touch; all others stay as they are.

        The new content is staged first. The index is written before the rows, for old and new
        content together: if the job dies in between, a filter says too often that a folder may hold a
        key, never too seldom, and the load can be repeated.
        """
        staging = Staging(self.spark, "indexed")
        changes = staging.write(changes, "changes")
        held = self.may_hold(changes if removed is None else removed)
        if removed is not None and set(self.partition_by) <= set(removed.columns) and self.partition_by:
            held = held.join(removed.select(*self.partition_by).distinct(), list(self.partition_by), "left_semi")
        targets = self.with_bucket(changes).select(*self.folder_columns)
        touched = staging.write(held.unionByName(targets).distinct(), "touched")
        old = self.open_folders(touched).drop(BUCKET)
        new = self.with_bucket(merge(old, changes)).repartition(*self.folder_columns)
        new = staging.write(new.sortWithinPartitions(*self.folder_columns, *self.keys), "rows")
        self._write_index(staging, new, touched)
        emptied = staging.write(touched.join(new.select(*self.folder_columns).distinct(), self.folder_columns, "left_anti"), "emptied")
        silver.write_silver(new, self._rows_path, self.folder_columns)
        names, base = self.folder_columns, self._rows_path

        def delete(row: dict) -> None:
            files.delete_tree("/".join([base, *(files.partition_dir(c, str(row[c])) for c in names)]))

        if not emptied.isEmpty():
            files.each_row(emptied, delete)
        staging.drop()

    def _write_index(self, staging: Staging, rows: DataFrame, touched: DataFrame) -> None:
        """Index rows of the touched folders, old and new filters laid over each other; the index is partitioned by bucket."""
        fresh = self._index_of(rows)
        index = self.index()
        if index is not None:
            # All rows of the touched buckets are written again: a few kB for each folder.
            mine = index.join(touched.select(BUCKET).distinct(), BUCKET, "left_semi")
            fresh = mine.unionByName(fresh).groupBy(*self.folder_columns, "slice").agg(
                F.bitmap_or_agg("bits").alias("bits"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("n_rows").alias("n_rows")
            )
        columns = [*self.partition_by, "slice", "bits", "low", "high", "n_rows", BUCKET]
        silver.write_silver(staging.write(fresh.select(*columns), "index"), self._index_path, [BUCKET])

    def rebuild_index(self) -> None:
        """The index anew from the rows: keys that have left a folder are forgotten."""
        staging = Staging(self.spark, "index")
        rows = self.spark.read.schema(self._stored_schema()).parquet(self._rows_path)
        columns = [*self.partition_by, "slice", "bits", "low", "high", "n_rows", BUCKET]
        fresh = staging.write(self._index_of(rows).select(*columns), "index")
        silver.write_silver(fresh, self._index_path, [BUCKET])
        staging.drop()


def _bytes(bitmap: str) -> Column:
    """A bitmap's bytes as an array of numbers."""
    return F.transform(
        F.sequence(F.lit(1), F.length(bitmap)), lambda i: F.conv(F.hex(F.substring(F.col(bitmap), i, F.lit(1))), 16, 10).cast("short")
    )


def _bit(numbers: str, place: Column) -> Column:
    """One bit of a bitmap's bytes as Spark lays it out: lowest bit of the first byte first."""
    return F.getbit(F.get(F.col(numbers), F.shiftright(place, 3).cast("int")), F.pmod(place, F.lit(8)).cast("int"))


def _with_keys(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    null_key = functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    checked = F.when(null_key, F.raise_error(F.lit(f"a change has no {', '.join(keys)}").cast("string")))
    return changes.where(F.coalesce(checked.cast("boolean"), F.lit(True)))
