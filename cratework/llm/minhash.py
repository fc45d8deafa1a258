"""Near-duplicate documents by minima of many universal hashes, confirmed on full sets.

Equal sets are one node from the start. Nodes whose signatures agree in a whole band share a
bucket; signatures decide which of a bucket's nodes may be alike, and stars join these to
candidate groups. Inside a group all pairs that could change the outcome are counted exactly,
in units of a bounded number of shingles, and stars over the confirmed links give the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import Scratch, mix, texts
from cratework.llm.components import stars

# With 26 bands of 5 minima, two sets that are 85 % alike share no bucket once in 4 million pairs.
BANDS, BAND_ROWS = 26, 5
# Nodes of a bucket whose signatures are compared; those of a larger one are candidates of each other unseen.
BUCKET_ROWS = 4096
# Shingles of one side of a unit of exact counting.
UNIT_SHINGLES = 1 << 20
# How far below the threshold a signature may fall by chance, in standard deviations.
DEVIATIONS = 6
_GOLD = 0x9E3779B97F4A7C15


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes of their words.

    Letters A-Z are lowered, words are runs without ASCII white space, and fewer words than
    a shingle has are one shingle. No words: empty.
    """
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    words = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    size = min(size, len(parts))
    count = len(parts) - size + 1
    found = np.full(count, size, np.uint64)
    for k in range(size):
        found = mix(found * np.uint64(0xD6E8FEB86659FD93) + words[k : k + count], _GOLD)
    return np.unique(found)


class Minima:
    """bands x rows universal hashes (multiply, add, shift) of the upper halves of shingle hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = random.integers(0, 1 << 64, bands * rows, np.uint64)
        self.b = random.integers(0, 1 << 64, bands * rows, np.uint64)

    def of(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of minima for each set; none of them may be empty."""
        out = np.empty((len(sets), len(self.a)), np.uint32)
        first = 0
        while first < len(sets):  # some 64,000 shingles at a time
            stop, held = first, 0
            while stop < len(sets) and (held < 1 << 16 or stop == first):
                held += len(sets[stop])
                stop += 1
            keys = np.concatenate(sets[first:stop]) >> np.uint64(32)
            sizes = np.fromiter(map(len, sets[first:stop]), np.int64, stop - first)
            starts = np.cumsum(sizes) - sizes
            work = np.empty_like(keys)
            for k, (a, b) in enumerate(zip(self.a, self.b)):
                np.multiply(keys, a, out=work)
                np.add(work, b, out=work)
                out[first:stop, k] = np.minimum.reduceat(work, starts) >> np.uint64(32)
            first = stop
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band of each row."""
        parts = minima.reshape(len(minima), self.bands, self.rows).astype(np.uint64)
        key = np.full(parts.shape[:2], self.rows, np.uint64)
        for k in range(self.rows):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k], _GOLD)
        return key.view(np.int64)


SIGNED = "doc_id long, text_hash long, n long, d1 long, d2 long, keys array<long>, marks binary"


def signatures(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, text_hash, n, d1, d2, keys, marks): size and digest of the set, keys of its bands, a byte of each minimum.

    A null text counts as empty; empty sets have neither keys nor marks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = Minima(bands, rows)
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in texts(batch.column(1))]
            some = np.array([len(s) > 0 for s in sets], bool)
            least = minima.of([s for s in sets if len(s)])
            digests = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]).reshape(-1, 2)
            keys, marks = [None] * len(sets), [None] * len(sets)
            for k, own, low in zip(np.flatnonzero(some), minima.band_keys(least), least.astype(np.uint8)):
                keys[k], marks[k] = own, low.tobytes()
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(marks, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "d1", "d2", "keys", "marks"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(run, SIGNED)


def least_agreement(hashes: int, percent: int) -> int:
    """Equal bytes that two signatures show at least, if their sets reach the threshold."""
    share = percent / 100
    return int(hashes * share - DEVIATIONS * (hashes * share * (1 - share)) ** 0.5)


def alike_in_bucket(marks: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Links that join a bucket's rows as all pairs with at least ``least`` equal bytes do."""
    links = []
    root = np.arange(len(marks))
    for i in range(1, len(marks)):
        others = np.flatnonzero(root[:i] != root[i])
        near = others[(marks[others] == marks[i]).sum(axis=1) >= least]
        for r in np.unique(root[near]):
            j = int(near[root[near] == r][0])
            links.append((i, j))
        if len(near):
            joined = np.unique(np.r_[root[near], root[i]])
            root[np.isin(root, joined)] = joined[0]
    return links


def _candidates(least: int):
    """(u, v): streams rows (band, key, node, marks) sorted by bucket, a bounded number of whole buckets at a time."""

    def links(band: np.ndarray, key: np.ndarray, node: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (key[1:] != key[:-1])])
        sizes = np.diff(np.r_[edge, len(node)])
        first = np.repeat(edge, sizes)
        near = (marks == marks[first]).sum(axis=1) >= least
        near[edge] = False
        u, v = [node[near]], [node[first[near]]]
        # Buckets in which every row is like the first are done; the others need their other pairs.
        for b in np.flatnonzero(np.add.reduceat(near, edge) < sizes - 1):
            at = edge[b]
            found = alike_in_bucket(marks[at : at + sizes[b]], least)
            u.append(node[[at + i for i, _ in found]])
            v.append(node[[at + j for _, j in found]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            if not len(batch):
                continue
            marks = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(batch), -1)
            held.append((*(batch.column(i).to_numpy() for i in range(3)), marks))
            count += len(batch)
            if count < 2 * BUCKET_ROWS:
                continue
            band, key, node, marks = (np.concatenate(x) for x in zip(*held))
            last = int(np.argmax((band == band[-1]) & (key == key[-1])))
            if last:
                yield links(band[:last], key[:last], node[:last], marks[:last])
            held, count = [(band[last:], key[last:], node[last:], marks[last:])], count - last
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held)))

    return run


def alike_in_unit(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the sets as all pairs do whose shared part is ``percent`` of their union, counted exactly.

    ``side`` is 0 or 1; with both present only pairs across count.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(number, kind="stable")
    by_value, lists = owner[order], np.cumsum(np.bincount(number, minlength=len(values)))
    root = np.arange(len(sets))
    across = side.any() and not side.all()
    marked = np.zeros(len(values), bool)
    links = []
    for i in range(1, len(sets)):
        open_ = root[:i] != root[i]
        if across:
            open_ &= side[:i] != side[i]
        open_ &= (100 * np.minimum(sizes[:i], sizes[i]) >= percent * np.maximum(sizes[:i], sizes[i]))
        if not open_.any():
            continue
        own = number[starts[i] : starts[i] + sizes[i]]
        stops, firsts = lists[own], np.where(own > 0, lists[own - 1], 0)
        if int((stops - firsts).sum()) * 4 < starts[i]:  # lists of the sets that hold each shingle
            counts = stops - firsts
            every = np.repeat(firsts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
            shared = np.bincount(by_value[every], minlength=len(sets))[:i]
        else:  # or all shingles before
            marked[own] = True
            shared = np.add.reduceat(marked[number[: starts[i]]], starts[:i], dtype=np.int64)
            marked[own] = False
        near = np.flatnonzero(open_ & (100 * shared >= percent * (sizes[:i] + sizes[i] - shared)))
        for r in np.unique(root[near]):
            links.append((i, int(near[root[near] == r][0])))
        if len(near):
            joined = np.unique(np.r_[root[near], root[i]])
            root[np.isin(root, joined)] = joined[0]
    return links


def _confirm(percent: int):
    """(u, v): streams rows (root, a, b, part, node, set) sorted by unit (root, a, b), one unit in memory."""

    def links(part: list[int], a: int, node: list[int], sets: list[np.ndarray]) -> pa.RecordBatch | None:
        side = np.array([p != a for p in part])
        found = alike_in_unit(sets, side, percent)
        u, v = ([node[x[k]] for x in found] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, part, node, sets = None, [], [], []
        for batch in batches:
            for *own, p, n, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5)):
                if own != unit:
                    if len(node) > 1:
                        yield links(part, unit[1], node, sets)
                    unit, part, node, sets = own, [], [], []
                part.append(p)
                node.append(n)
                sets.append(np.frombuffer(raw.as_py(), np.uint64))
        if len(node) > 1:
            yield links(part, unit[1], node, sets)

    return run


def _member_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle).tobytes() for t in texts(batch.column(3))]
            columns = [batch.column(i) for i in range(3)] + [pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "root", "parts", "set"])

    return run


def candidate_links(scratch: Scratch, nodes: DataFrame, hashes: int, percent: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) that join all nodes that share a bucket and may be alike.

    A bucket above ``bucket_rows`` has one link a node, to its smallest one, whatever the
    signatures say: the exact count decides then.
    """
    rows = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1")
    rows = scratch.stage(rows.join(buckets, ["band", "key"]), "buckets")
    few = rows.where(F.col("size") <= bucket_rows).select("node", "band", "key").join(nodes.select("node", "marks"), "node")
    few = few.select("band", "key", "node", "marks").repartition("band", "key").sortWithinPartitions("band", "key", "node")
    near = few.mapInArrow(_candidates(least_agreement(hashes, percent)), "u long, v long")
    many = rows.where((F.col("size") > bucket_rows) & (F.col("node") != F.col("least")))
    return near.union(many.select(F.col("node").alias("u"), F.col("least").alias("v"))).distinct()


def groups_of(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, roots too."""
    found = stars(scratch, links)
    return found.union(found.select(F.col("root").alias("node"), "root").distinct())


def confirmed_links(
    scratch: Scratch, docs: DataFrame, nodes: DataFrame, groups: DataFrame, shingle: int, percent: int, unit_shingles: int = UNIT_SHINGLES
) -> DataFrame:
    """Links (u, v) that join the nodes of each group as all pairs at or above the threshold do.

    A group with more than ``unit_shingles`` is dealt by node into parts, and every pair of
    parts is a unit of its own.
    """
    members = groups.join(nodes.select("node", "n", "doc_id", "text_hash"), "node")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n") / unit_shingles).cast("int").alias("parts"))
    members = members.join(sizes, "root").select("node", "root", "parts", "doc_id", "text_hash")
    # The text of one row of each node is cut again: fewer bytes than sets of all documents.
    whole = docs.select(F.col("doc_id").cast("long").alias("own_id"), "text", F.xxhash64("text").alias("own_hash"))
    same: Column = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
    cut = whole.join(members, same).select("node", "root", "parts", "text").dropDuplicates(["node"])
    sets = cut.mapInArrow(_member_sets(shingle), "node long, root long, parts int, set binary")
    sets = scratch.stage(sets, "sets", "lz4").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    units = sets.select("root", "part", "node", "set", other).select(
        "root", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "node", "set"
    )
    units = units.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "node")
    return units.mapInArrow(_confirm(percent), "u long, v long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 85,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    unit_shingles: int = UNIT_SHINGLES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text).

    Two documents are linked if 100 * shared >= percent * union of their sets of distinct
    shingles. component_id is the smallest doc_id that can be reached over links, itself
    included. Null and empty texts have the empty set and are linked with nothing. Rows with
    null doc_id take part but name no component unless all its rows are such (then null);
    rows that share a doc_id are documents of their own. kept: doc_id equals component_id,
    nulls as equals. An empty table gives no rows.

    Bands and rows are to be chosen for the threshold: sets just at it share no bucket with
    a chance of (1 - (percent / 100) ** rows) ** bands. Words are compared by 64-bit hashes.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    signed = scratch.stage(signatures(docs, shingle, bands, rows), "signed")
    one = F.min(F.struct("doc_id", "text_hash", "keys", "marks")).alias("one")
    nodes = signed.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first_id"), one)
    # Written with its numbers, so they stay what they are.
    nodes = scratch.stage(nodes.select("*", "one.*").drop("one").withColumn("node", F.monotonically_increasing_id()), "nodes")
    likely = groups_of(scratch, candidate_links(scratch, nodes, bands * rows, percent, bucket_rows))
    links = confirmed_links(scratch, docs, nodes, likely, shingle, percent, unit_shingles)
    roots = stars(Scratch(docs.sparkSession, "minhash-links"), scratch.stage(links, "confirmed"))
    named = nodes.select("node", "d1", "d2", "first_id").join(roots, "node", "left")
    named = named.select("d1", "d2", "first_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = named.join(least, "root").select("d1", "d2", "component_id", F.lit(True).alias("known"))
    found = signed.select("doc_id", "n", "d1", "d2").join(ids, ["d1", "d2"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
