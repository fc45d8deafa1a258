"""Near-duplicate documents by SimHash and bit-sliced comparison."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import Scratch, free_name, texts
from cratework.llm.components import stars

BITS = 64
# Fingerprints compared with each other in one task; larger buckets are cut by further bits.
BUCKET_ROWS = 4096
# (fingerprint, word of 64 lanes) pairs that are counted at a time.
PAIRS = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text; of no words, 0.

    Letters A-Z are lowered, words are runs without ASCII white space, and a text of
    fewer words than a shingle is one shingle. Repeated shingles count each time.
    """
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    starts = itertools.chain([0], ends)
    pieces = (joined[a : b - 1] for a, b in zip(starts, ends[shingle - 1 :]))
    count = len(parts) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, itertools.repeat(seed)), np.uint64, count)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, carried long columns): the 64 bits as a signed long. Null texts count as empty."""
    names = ["doc_id", "fp", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch.column(1))], np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col("doc_id").cast("long"), "text", *carried)
    return source.mapInArrow(run, ", ".join(f"`{n}` long" for n in names))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def first_masks(radius: int) -> list[int]:
    """Bits two fingerprints within the radius share, in at least one of these masks.

    radius + 2 bands: at most ``radius`` of them differ, so two agree.
    """
    bands = _bands(list(range(BITS)), radius + 2)
    return [a | b for a, b in itertools.combinations(bands, 2)]


def _bands(bits: list[int], count: int) -> list[int]:
    return [sum(1 << int(b) for b in part) for part in np.array_split(bits, min(count, len(bits)))]


def finer_masks(mask: int, radius: int) -> list[int]:
    """The mask with one of radius + 1 bands of the other bits: one of them must agree."""
    rest = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | int(band) for band in _bands(rest, radius + 1)]


def close_pairs(fp: np.ndarray, sizes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), j < i, of one bucket whose fingerprints differ in at most radius bits.

    fp holds the buckets one after the other, ``sizes`` their lengths. Every bucket is
    stored as bit planes: word w of plane b holds bit b of 64 neighbouring fingerprints.
    A fingerprint is XORed with a word plane by plane, and carry-save counters add up
    the differences of all 64 lanes at once. A word is abandoned once all its lanes
    exceed the radius.
    """
    per_bucket = -(-sizes // 64)
    first_word = np.cumsum(per_bucket) - per_bucket
    rank = np.arange(len(fp)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row_word = np.repeat(first_word, sizes)
    lane = row_word * 64 + rank
    lanes = int(per_bucket.sum()) * 64
    row_of = np.zeros(lanes, np.int64)
    row_of[lane] = np.arange(len(fp))
    planes = np.empty((BITS, lanes // 64), np.uint64)
    for b in range(BITS):
        bits = np.zeros(lanes, np.uint8)
        bits[lane] = (fp >> np.uint64(b)) & np.uint64(1)
        planes[b] = np.packbits(bits, bitorder="little").view(np.uint64)
    counts = rank // 64 + 1
    done = np.cumsum(counts)
    counters = max(1, (radius + 1).bit_length())
    start = 0
    while start < len(fp):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + PAIRS, "right")))
        some = counts[start:stop]
        query = np.repeat(np.arange(start, stop), some)
        nth = np.arange(len(query)) - np.repeat(np.cumsum(some) - some, some)
        word = row_word[query] + nth
        own = nth == rank[query] // 64
        below = (np.uint64(1) << (rank[query] % 64).astype(np.uint64)) - np.uint64(1)
        near = np.where(own, below, ~np.uint64(0))
        value = fp[query]
        count = [np.zeros(len(query), np.uint64) for _ in range(counters)]
        for b in range(BITS):
            carry = planes[b][word] ^ (np.uint64(0) - ((value >> np.uint64(b)) & np.uint64(1)))
            for c in range(counters):
                count[c], carry = count[c] ^ carry, count[c] & carry
            near &= ~carry
            if b % 8 == 7:
                near &= ~_above(count, radius)
                keep = np.flatnonzero(near)
                query, word, value, near = query[keep], word[keep], value[keep], near[keep]
                count = [c[keep] for c in count]
                if not len(keep):
                    break
        if len(query):
            hit, bit = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield query[hit], row_of[word[hit] * 64 + bit]
        start = stop


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds the radius."""
    above, equal = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for c in reversed(range(len(count))):
        if radius >> c & 1:
            equal = equal & count[c]
        else:
            above |= equal & count[c]
            equal = equal & ~count[c]
    return above


def forest(fp: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its group) that join the same fingerprints as all close pairs."""
    root = np.arange(len(fp))
    for i, j in close_pairs(fp, sizes, radius):
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, root[root]):
                root = root[root]
    other = np.flatnonzero(root != np.arange(len(fp)))
    return fp[other], fp[root[other]]


def _compare(radius: int):
    """Streams rows sorted by (mask, key); a bucket may span Arrow batches."""

    def pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
        mask, key, fp = (np.concatenate(x) for x in zip(*rows))
        edge = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
        u, v = forest(fp.view(np.uint64), np.diff(np.r_[edge, len(fp)]), radius)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            mask, key, fp = (np.asarray(batch.column(i)) for i in range(3))
            if not len(fp):
                continue
            held.append((mask, key, fp))
            count += len(fp)
            if count < 8 * BUCKET_ROWS:
                continue
            mask, key, fp = (np.concatenate(x) for x in zip(*held))
            last = int(np.argmax((mask == mask[-1]) & (key == key[-1])))  # sorted: the last bucket's first row
            if last:
                yield pairs([(mask[:last], key[:last], fp[:last])])
            held, count = [(mask[last:], key[last:], fp[last:])], len(fp) - last
        if held:
            yield pairs(held)

    return run


def links(scratch: Scratch, distinct: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints ``fp`` as all pairs within the radius do.

    Fingerprints that agree in one of the masks share a bucket. A bucket above
    BUCKET_ROWS, however hot, is not compared but cut again by finer masks; once so few
    bits are open that no bucket can be larger, all have been compared.
    """
    masks = first_masks(radius)
    rows = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    found: list[DataFrame] = []
    turn = 0
    while True:
        rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        rows = scratch.stage(rows.join(sizes, ["mask", "key"]), f"buckets-{turn}")
        few = rows.where(F.col("n") <= BUCKET_ROWS).select("mask", "key", "fp")
        few = few.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        found.append(scratch.stage(few.mapInArrow(_compare(radius), "u long, v long").distinct(), f"pairs-{turn}"))
        rows = rows.where(F.col("n") > BUCKET_ROWS)
        if rows.isEmpty():
            break
        finer = {m: finer_masks(m, radius) for m in masks if m != (1 << BITS) - 1}  # of a whole mask no bucket has two
        masks = sorted({x for part in finer.values() for x in part})
        lookup = F.create_map(
            *[x for m, part in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(p)) for p in part]))]
        )
        # Two masks can grow into one, so a fingerprint may come twice.
        rows = rows.select("fp", F.explode(F.element_at(lookup, F.col("mask"))).alias("mask")).distinct()
        turn += 1
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every


def _groups(docs: DataFrame, shingle: int, radius: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, carried columns, root, component_id); root tells groups apart whose smallest ids are equal."""
    scratch = Scratch(docs.sparkSession, "simhash")
    found = scratch.stage(fingerprints(docs, shingle, carried), "fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = scratch.stage(nodes, "nodes")
    roots = stars(scratch, links(scratch, nodes.select("fp"), radius))
    linked = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = linked.join(smallest, "root").select("fp", "root", "component_id")
    return found.join(names, "fp").select("doc_id", "fp", *carried, "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): documents linked by fingerprints at most ``radius`` bits apart.

    component_id is the smallest doc_id that can be reached over links. Rows with null
    doc_id take part but name no component unless all its rows are such (then null).
    Equal fingerprints, those of empty texts (0) too, are one node. Repeated rows stay.
    """
    return _groups(docs, shingle, radius).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents with one of each near-duplicate group: a row with its smallest doc_id.

    Rows are told apart by a key that is written with them, so of two different texts under one
    doc_id both stay if they are in groups of their own. Documents without doc_id stay.
    """
    key = free_name(docs, "row")
    columns = docs.columns
    rows = Scratch(docs.sparkSession, "simhash-rows").stage(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    groups = _groups(rows, shingle, radius, (key,))
    first = groups.where("doc_id = component_id").groupBy("root").agg(F.min(key).alias(key)).select(key)
    kept = first.union(groups.where("doc_id is null").select(key))
    return rows.join(kept, key, "left_semi").select(*columns)
