"""Tables of one job in the shared folder, deleted when the driver ends."""

from __future__ import annotations

import atexit
import contextlib
import gc

from pyspark.sql import DataFrame, SparkSession

from cratework import files
from cratework.session import fresh_folder

_folders: set[str] = set()


@atexit.register
def _clear() -> None:
    """Without a session: it may have ended before the driver does."""
    for folder in sorted(_folders):
        with contextlib.suppress(Exception):  # another process may have cleared up
            files.delete_tree(folder)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of plans that nobody holds go when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Staging:
    """Written tables cut the lineage and outlive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = fresh_folder(spark, name)
        _folders.add(self.folder)

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        files.delete_tree(self.folder)
        _folders.discard(self.folder)
