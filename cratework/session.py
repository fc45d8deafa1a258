"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the jobs rely on; all can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # zip_name=007 must stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A few open files per task instead of a sort of every row by partition.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that the caller created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    # The driver serves the file to the executors itself, so no shared folder is needed here.
    target = os.path.join(tempfile.mkdtemp(prefix="cratework-"), "cratework.zip")
    Path(target).write_bytes(content.getvalue())
    context.addPyFile(target)
    atexit.register(shutil.rmtree, os.path.dirname(target), ignore_errors=True)
    _shipped.add(context.applicationId)


def build_session(app_name: str = "cratework", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the runtime settings applied."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="cratework-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only where the setting is absent (a local session, as in tests) a temporary
    folder is made, once per process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = _local_folder()
    if "://" not in folder and not folder.startswith("file:"):
        folder = os.path.abspath(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, never reused folder name below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
