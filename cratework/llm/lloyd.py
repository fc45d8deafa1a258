"""Centroid clustering in whole numbers, its columns dealt out in shards.

A table of units holds, for a block of rows and a shard of neighbouring columns, one small
matrix. It is bucketed by (shard, block), so a round moves distances and labels, never
vectors. In a round, tasks of a column block give exact partial distances to the slices of
the centroids; the partials of a block are added up over the shards and the nearest centroid
is chosen; every shard sums its own columns by label and floors them to its new slice.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import Scratch

BLOCK_ROWS = 2048
SHARD_COLUMNS = 16
UNITS = "block long, shard int, n int, x binary, ids array<long>, most long"
#: shard -> the centroids' components in its columns, a row for each centroid.
Slices = dict[int, np.ndarray]


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(vec_id, x): floor(scale * entry) of the vectors with exactly ``size`` entries, none null or non-finite."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == size) & finite)
    return kept.select(F.col("vec_id").cast("long"), x.alias("x"))


def _cut(size: int, width: int, rows: int):
    """Rows to units; block numbers are unique over the tasks of the stage."""

    def units(block: int, ids: list, x: np.ndarray) -> pa.RecordBatch:
        most = int(np.abs(x).max())
        kind = "<i4" if most < 1 << 31 else "<i8"
        parts = [x[:, a : a + width].astype(kind).tobytes() for a in range(0, size, width)]
        count = len(parts)
        columns = [
            pa.array([block] * count, pa.int64()),
            pa.array(range(count), pa.int32()),
            pa.array([len(ids)] * count, pa.int32()),
            pa.array(parts, pa.binary()),
            pa.array([ids] + [None] * (count - 1), pa.list_(pa.int64())),
            pa.array([most] * count, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "shard", "n", "x", "ids", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, held = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            held.append(batch.column(1).flatten().to_numpy().reshape(-1, size))
            if len(ids) < rows:
                continue
            every = np.concatenate(held)
            whole = len(ids) - len(ids) % rows
            for a in range(0, whole, rows):
                yield units(block, ids[a : a + rows], every[a : a + rows])
                block += 1
            ids, held = ids[whole:], [every[whole:]]
        if ids:
            yield units(block, ids, np.concatenate(held))

    return run


def _columns(raw: bytes, rows: int, columns: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{len(raw) // (rows * columns)}").reshape(rows, columns).astype(np.int64)


def _partial_distances(slices: Slices):
    """(block, part): squared distances within one shard, for each row and centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for shard, n, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                centre = slices[shard]
                x = _columns(raw, n, centre.shape[1])
                part = np.empty((n, len(centre)), "<i8")
                for c, own in enumerate(centre):
                    part[:, c] = ((x - own) ** 2).sum(axis=1)
                parts.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], ["block", "part"])

    return run


def _add_and_choose(centroids: int):
    """Rows sorted by block: adds the shards' partials one at a time, then takes the nearest centroid."""

    def chosen(block: int, total: np.ndarray) -> pa.RecordBatch:
        total = total.reshape(-1, centroids)
        label = total.argmin(axis=1)  # of equal ones the first, that is the smaller number
        distance = total[np.arange(len(total)), label]
        columns = [
            pa.array([block], pa.int64()),
            pa.array([label.astype("<i4").tobytes()], pa.binary()),
            pa.array([distance.astype("<i8").tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "label", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None
        for batch in batches:
            for own, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_py(), "<i8")
                if own == block:
                    total += part
                    continue
                if block is not None:
                    yield chosen(block, total)
                block, total = own, part.copy()
        if block is not None:
            yield chosen(block, total)

    return run


LABELS = "block long, label binary, distance binary"
SUMS = "shard int, label int, n long, total array<long>"


def _sums(slices: Slices):
    """(shard, label, n, total): a task's columns summed by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for shard, n, raw, label in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = slices[shard]
                count, total = found.setdefault(shard, (np.zeros(len(own), np.int64), np.zeros(own.shape, np.int64)))
                label = np.frombuffer(label, "<i4")
                order = np.argsort(label, kind="stable")
                seen, first = np.unique(label[order], return_index=True)
                total[seen] += np.add.reduceat(_columns(raw, n, own.shape[1])[order], first, axis=0)
                count += np.bincount(label, minlength=len(own))
        for shard, (count, total) in found.items():
            seen = np.flatnonzero(count)
            columns = [
                pa.array([shard] * len(seen), pa.int32()),
                pa.array(seen, pa.int32()),
                pa.array(count[seen]),
                pa.array(list(total[seen]), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "label", "n", "total"])

    return run


def _new_slices(slices: Slices):
    """Rows sorted by (shard, label): the floored mean of a shard's columns; labels without rows keep theirs."""

    def floored(key: tuple[int, int], count: int, total: np.ndarray) -> pa.RecordBatch:
        mean = [int(t) // count for t in total]
        columns = [pa.array([k], pa.int32()) for k in key] + [pa.array([mean], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["shard", "label", "slice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, total = None, 0, None
        for batch in batches:
            for shard, label, n, part in zip(*(batch.column(i).to_pylist() for i in range(4))):
                part = np.array(part, object)  # whole numbers of any size
                if (shard, label) == key:
                    count, total = count + n, total + part
                    continue
                if key is not None:
                    yield floored(key, count, total)
                key, count, total = (shard, label), n, part
        if key is not None:
            yield floored(key, count, total)

    return run


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, label, distance in zip(*(batch.column(i) for i in range(3))):
            columns = [
                ids.values,
                pa.array(np.frombuffer(label.as_py(), "<i4")),
                pa.array(np.frombuffer(distance.as_py(), "<i8")),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])


def first_centroids(whole: DataFrame, count: int, prefix: str) -> list[list[int]]:
    """The ``count`` vectors with the smallest SHA-256 of prefix and vec_id; equal ids go by their vectors, null ids last."""
    order = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    return [row["x"] for row in whole.orderBy(order.asc_nulls_last(), "x").select("x").limit(count).collect()]


def cluster(
    vectors: DataFrame,
    size: int,
    count: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    prefix: str = "3:",
    shard_columns: int = SHARD_COLUMNS,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after Lloyd's rounds over (vec_id, embedding).

    Null vectors, other lengths, and vectors with a null or non-finite entry are left out. All
    arithmetic is on whole numbers; of equally near centroids the smaller number wins; a centroid
    without vectors stays. Repeated rows are clustered each, null vec_ids too. With fewer vectors
    than centroids there are as many centroids as vectors; an empty table gives no rows. Entries so
    large that a squared distance could exceed a long raise OverflowError.

    The driver and every task hold the centroids, count x size numbers; nothing else is sent.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "lloyd")
    whole = scratch.stage(whole_vectors(vectors, size, scale), "whole")
    centroids = np.array(first_centroids(whole, count, prefix), np.int64).reshape(-1, size)
    result = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], result), centroids
    # Hashed by the join key before it is written, so the buckets need no shuffle afterwards.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = whole.select("vec_id", "x").mapInArrow(_cut(size, shard_columns, block_rows), UNITS)
    name = f"lloyd_{uuid.uuid4().hex}"
    writer = cut.repartition(buckets, "shard", "block").write.bucketBy(buckets, "shard", "block")
    writer.sortBy("shard", "block").option("path", f"{scratch.folder}/units").saveAsTable(name, format="parquet")
    try:
        units = spark.table(name)
        most = max(units.agg(F.max("most")).first()[0], 1)
        if size * (2 * most) ** 2 >= 1 << 63:
            raise OverflowError("squared distances exceed a long")
        shards = range(-(-size // shard_columns))
        turn = 0
        while True:
            slices = {s: centroids[:, s * shard_columns : (s + 1) * shard_columns] for s in shards}
            parts = units.select("block", "shard", "n", "x").mapInArrow(_partial_distances(slices), "block long, part binary")
            parts = parts.repartition("block").sortWithinPartitions("block")
            labels = scratch.stage(parts.mapInArrow(_add_and_choose(len(centroids)), LABELS), f"labels-{turn}")
            if turn == rounds:
                break
            dealt = labels.select(F.explode(F.array(*map(F.lit, shards))).alias("shard"), "block", "label")
            own = units.join(dealt, ["shard", "block"]).select("shard", "n", "x", "label")
            sums = own.mapInArrow(_sums(slices), SUMS).repartition("shard", "label").sortWithinPartitions("shard", "label")
            new = centroids.copy()
            # count x size numbers, a row for each shard and centroid
            for row in sums.mapInArrow(_new_slices(slices), "shard int, label int, slice array<long>").collect():
                at = row["shard"] * shard_columns
                new[row["label"], at : at + shard_columns] = row["slice"]
            turn += 1
            if (new == centroids).all():  # further rounds give the same labels
                break
            centroids = new
            scratch.drop(f"labels-{turn - 1}")
        ids = units.where("ids is not null").select("block", "ids").join(labels, "block").select("ids", "label", "distance")
        found = scratch.stage(ids.mapInArrow(_expand, result), "found")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    scratch.drop("units")
    scratch.drop("whole")
    return found, centroids


def describe(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of a clustering."""
    # A row for each centroid.
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()]
    about = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
