"""File access from inside tasks, for any path Spark itself can name."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters Spark escapes in partition directory names.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path within it (``file:``, plain and object-store paths)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def open_input(path: str):
    """A seekable binary handle."""
    filesystem, inner = locate(path)
    return filesystem.open_input_file(inner)


def open_output(path: str):
    """A binary output stream; missing parent folders are made."""
    filesystem, inner = locate(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(inner, compression=None)  # a name like x.gz changes nothing


def size_of(path: str) -> int | None:
    """Size in bytes, or None where there is no such file."""
    filesystem, inner = locate(path)
    info = filesystem.get_file_info(inner)
    return info.size if info.type == pafs.FileType.File else None


def move(path: str, target: str) -> None:
    """Give a file its final name; a file that has the name already is replaced."""
    filesystem, inner = locate(path)
    filesystem.move(inner, locate(target)[1])


def list_names(path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what lies directly in a folder; nothing where there is none."""
    filesystem, inner = locate(path)
    found = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return [(info.base_name, info.type == pafs.FileType.Directory) for info in found]


def delete_file(path: str) -> None:
    filesystem, inner = locate(path)
    filesystem.delete_file(inner)


def delete_tree(path: str) -> bool:
    """Delete a folder with its content; False if it was not there."""
    filesystem, inner = locate(path)
    if filesystem.get_file_info(inner).type != pafs.FileType.Directory:
        return False
    filesystem.delete_dir(inner)
    return True


def partition_dir(column: str, value: str) -> str:
    """``column=value`` as Spark names the directory."""
    escaped = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)
    return f"{column}={escaped}"


def unescape(text: str) -> str:
    """A partition value from its directory name."""
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m.group(1), 16)), text)


def glob_text(text: str) -> str:
    """Text that a Hadoop glob pattern matches literally."""
    return re.sub(r"([*?\[\]{}\\,])", r"\\\1", text)


def qualify(spark: SparkSession, path: str) -> str:
    """The path as Spark's own listings print it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).makeQualified(hadoop_path).toString()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop glob pattern, on the driver like any file listing."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = hadoop_path.getFileSystem(conf).globStatus(hadoop_path)
    return sorted(status.getPath().toString() for status in found) if found is not None else []


def each_row(df: DataFrame, action) -> int:
    """Run an idempotent file action on every row (as a dict), in parallel tasks."""

    def act(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                action(row)
            yield pd.DataFrame({"n": [len(batch)]})

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    done = df.repartition(tasks, *df.columns).mapInPandas(act, "n long").agg(F.sum("n")).first()
    return int(done[0] or 0)
