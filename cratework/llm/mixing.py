"""Mixing sources to target weights by the cube method of balanced sampling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratework.llm.common import Scratch, free_name, words

# Documents whose fractions one task moves at a time; at most two of them stay fractional.
BLOCK = 1024
# Fractions that the landing settles: all 2 ** LANDING outcomes are tried.
LANDING = 12
CERTAIN = 1e-9


def sizes(docs: DataFrame, row: Column) -> DataFrame:
    r"""(doc_id, source, size, row): size is the number of ``[^\x20\x09-\x0D]+`` in the text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text", row.alias("row"))
    names = ["doc_id", "source", "size", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = pa.array([len(words(t.as_py())) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), count, batch.column(3)], names)

    return source.mapInArrow(run, "doc_id long, source string, size long, row long")


def targets(by_source: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, n, source_size, target) from (source, n, source_size).

    Sources in code point order, null last, take the weights in turn and share the total
    of all sizes. A target ends at ``most`` times its source's size; the excess goes to the others by weight
    until none is above. That is one level for all: target = min(cap, level * weight), and the
    level follows from the sources in order of cap / weight. The table has one row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    rows = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    rows = rows.withColumn("cap", F.col("source_size") * float(most))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = rows.withColumn(
        "level",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(rest),
    )
    # It rises while the next source ends at its cap, and falls from the first that does not.
    rows = rows.withColumn("level", F.max("level").over(whole))
    target = F.least("cap", F.col("level") * F.col("weight"))
    return rows.select("source", "n", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def flight(p: np.ndarray, balance: np.ndarray, chance: np.ndarray, leave: int = 0) -> np.ndarray:
    """Move inclusion probabilities until at most as many as there are constraints are fractional.

    ``balance`` has a row of values for each constraint; the sums of p * values stay as
    they are. It ends once no more than ``leave`` are fractional. A few open units at a time move along a direction in the null space of
    their constraints, to one of the two points where a unit becomes 0 or 1, chosen
    so that each unit keeps its expected value. ``chance`` holds uniform numbers.
    """
    p = p.copy()
    width = len(balance) + 1
    open_: list[int] = []
    fractional = np.flatnonzero((p > CERTAIN) & (p < 1 - CERTAIN))
    waiting, left = iter(fractional), len(fractional)
    used = 0
    while left > leave:
        while len(open_) < width and (unit := next(waiting, None)) is not None:
            open_.append(int(unit))
        if not open_:
            break
        part = balance[:, open_]
        scale = np.abs(part).max(axis=1, keepdims=True)
        part = part / np.where(scale > 0, scale, 1)
        if len(open_) < width:
            _, s, v = np.linalg.svd(part)
            if int((s > 1e-9).sum()) >= len(open_):
                break
            u = v[-1]
        elif width == 3:
            u = np.cross(part[0], part[1])
            if np.abs(u).max() < 1e-12:
                u = np.linalg.svd(part)[2][-1]
        else:
            u = np.linalg.svd(part)[2][-1]
        u = np.where(np.abs(u) < 1e-12 * np.abs(u).max(), 0, u)
        here = p[open_]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.min(np.where(u > 0, (1 - here) / u, np.where(u < 0, -here / u, np.inf)))
            down = np.min(np.where(u > 0, here / u, np.where(u < 0, (here - 1) / u, np.inf)))
        here = here + up * u if chance[used % len(chance)] * (up + down) < down else here - down * u
        used += 1
        here = np.where(here < CERTAIN, 0, np.where(here > 1 - CERTAIN, 1, here))
        p[open_] = here
        left += -len(open_) + (still := int(((here > 0) & (here < 1)).sum()))
        open_ = open_ if still == len(open_) else [k for k, x in zip(open_, here) if 0 < x < 1]
    return p


def land(p: np.ndarray, size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """The last few fractions: every whole outcome is tried for the nearest total size, then number."""
    p = p.copy()
    rest = np.flatnonzero((p > CERTAIN) & (p < 1 - CERTAIN))
    p[p <= CERTAIN], p[p >= 1 - CERTAIN] = 0, 1
    if len(rest):
        outcomes = (np.arange(1 << len(rest))[:, None] >> np.arange(len(rest))) & 1
        off = np.abs(outcomes @ size[rest] - p[rest] @ size[rest])
        count = np.abs(outcomes.sum(axis=1) - p[rest].sum())
        p[rest] = outcomes[np.lexsort((count, off))[0]]
    return p


def _uniform(seed: int, ids: np.ndarray, turn: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the documents only, so that reruns agree."""
    values = pd.util.hash_array(ids.astype(np.int64) + np.int64(seed)) ^ np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) % (1 << 64))
    return (pd.util.hash_array(values.view(np.int64)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): how often the mix takes each document.

    A source's documents are wanted target / source_size times each. The whole part is
    taken from every one; of the fraction, the cube method takes a balanced sample, whose
    number of documents and words is that of the fractions up to the landing of a dozen
    documents a source. Blocks of a source's documents move apart; the few fractions that
    each leaves meet in blocks again until one block lands. copies <= most.

    Null and empty texts have size 0 and are sampled like others; a source of size 0 has target 0 and
    none of its documents is taken. Null is a source (last in order). Repeated rows are units of
    their own; null ids are too. An empty table gives an empty mix.
    """
    return _decide(docs, F.monotonically_increasing_id(), weights, most, seed).drop("row")


def _decide(docs: DataFrame, row: Column, weights: tuple[int, ...], most: int, seed: int) -> DataFrame:
    """The mix with each row's own key."""
    scratch = Scratch(docs.sparkSession, "mixing")
    units = sizes(docs, row).withColumn("unit", F.coalesce("doc_id", "row"))
    units = scratch.stage(units, "sizes")
    by_source = units.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_source = scratch.stage(targets(by_source, weights, most), "targets")
    largest = by_source.agg(F.max("n")).first()[0] or 0
    rows = units.join(by_source, units["source"].eqNullSafe(by_source["source"])).select(
        "doc_id", units["source"], "size", "source_size", "target", "n", "unit", "row"
    )
    wanted = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    rows = rows.withColumn("wanted", wanted)
    rows = rows.withColumn("base", F.floor(F.col("wanted") + CERTAIN).cast("int"))
    rows = rows.withColumn("p", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0))).drop("wanted")
    fields = "doc_id long, source string, size long, source_size long, target double, n long, unit long, row long, base int, p double"
    settled: list[DataFrame] = []
    turn, left = 0, largest
    while True:
        blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("unit", "size", F.lit(turn)), blocks))
        moved = scratch.stage(rows.groupBy("source", "block").applyInPandas(_move(seed, turn), fields), f"flight-{turn}")
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(moved.where(~is_open))
        if left <= BLOCK:
            break
        rows = moved.where(is_open).withColumn("n", F.ceil(F.col("n") / BLOCK) * 2)
        turn, left = turn + 1, math.ceil(left / BLOCK) * 2
    every = settled[0]
    for more in settled[1:]:
        every = every.union(more)
    return every.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("base") + F.col("p").cast("int")).alias("copies"), "row"
    )


def _move(seed: int, turn: int):
    def move(rows: pd.DataFrame) -> pd.DataFrame:
        final = rows["n"].iloc[0] <= BLOCK  # all that is left of the source
        rows = rows.drop(columns="block").sort_values(["unit", "size"], kind="stable")
        # In an order of their own, so that documents of many sizes are left for the landing.
        chance = _uniform(seed, rows["unit"].to_numpy(np.int64), turn)
        rows = rows.iloc[np.argsort(chance, kind="stable")]
        p, size = rows["p"].to_numpy(float), rows["size"].to_numpy(float)
        chance = _uniform(seed, rows["unit"].to_numpy(np.int64), turn + 1000)
        p = flight(p, np.vstack([np.ones_like(size), size]), chance, LANDING if final else 0)
        if final:
            p = land(p, size, chance)
        p[p <= CERTAIN], p[p >= 1 - CERTAIN] = 0, 1
        return rows.assign(p=p)

    return move


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0) -> DataFrame:
    """The documents, each row as often as the mix takes it.

    Rows are told apart by a key that is written with them, so those without doc_id, or with one
    that others have too, are each taken as decided.
    """
    copies, key = free_name(docs, "copies"), free_name(docs, "key")
    rows = Scratch(docs.sparkSession, "mixing-rows").stage(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    taken = _decide(rows, F.col(key), weights, most, seed).select(F.col("row").alias(key), F.col("copies").alias(copies))
    # A sort-merge join at every size: decisions grow with the documents.
    joined = rows.join(taken.where(F.col(copies) > 0).hint("merge"), key)
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies)).drop(copies)
