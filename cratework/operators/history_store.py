"""Validity intervals that grow by one extract at a time, in any order.

What extracts said is kept by year: of each key the runs of days on which it was seen with the same
attributes. An extract, late or not, rewrites the year it belongs to and no other; runs that
go on from year to year are joined when the history is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework import files
from cratework.operators import silver
from cratework.staging import Staging

YEAR = "seen_year"


@dataclass(frozen=True)
class HistoryStore:
    """Runs below a folder: keys, attributes, the sorted days of each run, partitioned by year."""

    spark: SparkSession
    path: str
    schema: T.StructType  # of an extract: keys and attributes
    keys: tuple[str, ...]

    @property
    def attributes(self) -> list[str]:
        return [n for n in self.schema.names if n not in self.keys]

    def _run_schema(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField("days", T.ArrayType(T.DateType()))])

    def runs(self, years: list[int] | None = None) -> DataFrame:
        """Runs of some years (None: all); other years are not listed."""
        days = [f"{self.path}/{files.partition_dir(YEAR, str(y))}" for y in years] if years is not None else [self.path]
        there = [d for d in days if files.glob(self.spark, f"{d}/*")]
        if not there:
            return self.spark.createDataFrame([], self._run_schema())
        return self.spark.read.schema(self._run_schema()).option("basePath", self.path).parquet(*there).select(*self._run_schema().names)

    def add(self, extract: DataFrame, day: str) -> None:
        """Bring in what an extract of ``day`` (a date) says.

        A key that it has several times counts with its greatest attributes. An extract of a day that the
        store holds already replaces what that day said, keys that it no longer has included.
        """
        self.add_all(extract.withColumn("_day", F.lit(day).cast("date")), [day])

    def add_all(self, extracts: DataFrame, days: list[str]) -> None:
        """Several extracts at once: rows with ``_day``, one of ``days``."""
        staging = Staging(self.spark, "history")
        new = extracts.groupBy(*self.keys, "_day").agg(F.max(F.struct(*self.attributes)).alias("_said"))
        years = sorted({int(d[:4]) for d in days})
        listed = F.array(*[F.lit(d).cast("date") for d in days])
        old = self.runs(years).select(*self.keys, F.explode("days").alias("_day"), F.struct(*self.attributes).alias("_said"))
        old = old.where(~F.array_contains(listed, F.col("_day")))
        said = old.unionByName(new)
        # A window holds the days of one key in one year.
        order = Window.partitionBy(*self.keys, F.year("_day")).orderBy("_day")
        changed = ~F.col("_said").eqNullSafe(F.lag("_said").over(order)) | (F.row_number().over(order) == 1)
        numbered = said.withColumn("_run", F.sum(F.when(changed, 1).otherwise(0)).over(order))
        runs = numbered.groupBy(*self.keys, F.year("_day").alias(YEAR), "_run", "_said").agg(F.array_sort(F.collect_list("_day")).alias("days"))
        runs = staging.write(runs.select(*self.keys, "_said.*", "days", YEAR).select(*self._run_schema().names, YEAR), "runs")
        silver.write_silver(runs, self.path, [YEAR])
        kept = {r[YEAR] for r in runs.select(YEAR).distinct().collect()}  # at most the years of the extracts
        for year in set(years) - kept:
            files.delete_tree(f"{self.path}/{files.partition_dir(YEAR, str(year))}")
        staging.drop()

    def history(self, extracted: str = "valid_from") -> DataFrame:
        """The versions as ``history.scd2_history`` gives them of all extracts: neighbouring runs that are alike are one."""
        runs = self.runs().withColumn("_from", F.col("days")[0])
        by_key = Window.partitionBy(*self.keys).orderBy("_from")
        said = F.struct(*self.attributes)
        first = runs.withColumn("_said", said).withColumn("_before", F.lag("_said").over(by_key)).where(~F.col("_said").eqNullSafe(F.col("_before")))
        until = F.lead("_from").over(by_key)
        return first.select(*self.keys, *self.attributes, F.col("_from").alias(extracted), until.alias("valid_to"), until.isNull().alias("is_current"))
