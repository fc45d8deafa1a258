"""What the corpus operators share: session settings, staged tables, words, runs of sorted rows."""

from __future__ import annotations

import atexit
import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cratework.session import configure, fresh_folder

# Rows a Python worker holds at a time; texts can be long, so a batch is kept short.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

_folders: dict[str, SparkSession] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """The session with the settings that these operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; an operator reads no others."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clear() -> None:
    for folder, spark in list(_folders.items()):
        try:
            _delete(spark, folder)
        except Exception:  # noqa: BLE001  the session has ended already
            return


class Scratch:
    """Tables of one operator call in the shared folder.

    A written table cuts the lineage and outlives lost executors. The operator drops
    what it needs no more; the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = fresh_folder(spark, name)
        _folders[self.folder] = spark

    def stage(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self.folder}/{name}"
        schema = df.schema
        df.write.option("compression", compression).parquet(path)
        del df
        self.free_shuffles()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        _delete(self.spark, f"{self.folder}/{name}")

    def free_shuffles(self, turns: int = 1) -> None:
        """Shuffle files go when the driver collects the plans that wrote them.

        On a cluster the files of the job before are let go only by the turn after next.
        """
        for turn in range(turns):
            if turn:
                time.sleep(0.5)
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()


def words(text: str | None) -> list[bytes]:
    r"""The runs of ``[^\x20\x09-\x0D]`` as UTF-8; null has none."""
    return (text or "").encode().split()


def texts(column: pa.Array) -> Iterator[str]:
    """Strings of an Arrow column, one at a time; null as the empty text."""
    for value in column:
        yield value.as_py() or ""


def mix(values: np.ndarray, odd: int) -> np.ndarray:
    """Multiply and fold 64-bit values, so that all bits depend on all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(odd)
    return values ^ (values >> np.uint64(29))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
