"""Benchmark passages in documents: q-gram lemma filtering and banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters of a gram, and edits an item may have had for each of its characters.
GRAM = 10
EDIT_SHARE = 0.08
# Characters of benchmark items that a task holds at a time; larger benchmarks go in blocks.
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
NOTHING = np.uint32(0xFFFFFFFF)


def normal(text: str | None) -> str:
    """Lower case, and one blank for each run of white space."""
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash for every q characters in a row, by doubling."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, at, size, part, rest = None, 0, 1, codes.astype(np.uint64), q
    step = np.uint64(0x9E3779B97F4A7C15)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                here = part[at : at + n] * power
                out = here if out is None else out + here
                power, at = power * step, at + size
            rest >>= 1
            if rest:
                part = part[: len(part) - size] + part[size:] * step
                size, step = size * 2, step * step
        out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def budget(length: int, q: int, share: float) -> int:
    """Edits an item may have had, so few that the q-gram lemma still asks for a shared gram."""
    return max(0, min(int(length * share), (length - q) // q))


class Index:
    """The grams of benchmark items; bounded by BLOCK_CHARS."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = GRAM, share: float = EDIT_SHARE):
        self.q = q
        self.items = [(item, normal(text)) for item, text in items]
        self.codes = [code_points(text) for _, text in self.items]
        self.edits = np.array([budget(len(c), q, share) for c in self.codes], np.int64)
        size = np.array([len(c) for c in self.codes], np.int64)
        self.least = size - q + 1 - q * self.edits
        # Items shorter than a gram are looked up as they are.
        self.short = [k for k, c in enumerate(self.codes) if 0 < len(c) < q]
        each = [grams(c, q) for c in self.codes]
        hashes = np.concatenate([*each, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(each)), [len(g) for g in each])
        pos = np.concatenate([*(np.arange(len(g)) for g in each), np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        self.keys, first, count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.first, self.count = first, count
        self.item, self.pos = item[order], pos[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) for each gram that a text shares with an item."""
        found = grams(codes, self.q)
        at = np.flatnonzero(self.filter[found >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        key = np.searchsorted(self.keys, found[at])
        key[key == len(self.keys)] = 0
        real = self.keys[key] == found[at]
        at, key = at[real], key[real]
        count = self.count[key]
        total = np.cumsum(count)
        if not len(total):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        row = np.arange(total[-1]) + np.repeat(self.first[key] - (total - count), count)
        return self.item[row], np.repeat(at, count) - self.pos[row]

    def regions(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(item, first diagonal) of the double bands that hold as many shared grams as the lemma asks for.

        An occurrence with e edits keeps within e + 1 neighbouring diagonals, so two
        neighbouring bands of that width hold all its grams; every band is counted with the one after.
        """
        item, diagonal = self.hits(codes)
        if not len(item):
            return []
        width = self.edits[item] + 1
        low = np.floor_divide(diagonal, width)
        items = np.r_[item, item]
        bands = np.r_[low, low - 1]
        order = np.lexsort((bands, items))
        items, bands = items[order], bands[order]
        edge = np.flatnonzero(np.r_[True, (items[1:] != items[:-1]) | (bands[1:] != bands[:-1])])
        count = np.diff(np.r_[edge, len(items)])
        keep = edge[count >= self.least[items[edge]]]
        return [(int(k), int(b) * int(self.edits[k] + 1)) for k, b in zip(items[keep], bands[keep])]

    def align(self, item: int, regions: list[tuple[np.ndarray, int]]) -> list[tuple[int, int]]:
        """(edits, end) of the item's best place in each region: alignment within its band, all regions at once."""
        pattern, e = self.codes[item], int(self.edits[item])
        m, width = len(pattern), 4 * e + 2
        text = np.full((len(regions), width + m), NOTHING, np.uint32)
        base = []
        for row, (codes, diagonal) in enumerate(regions):
            start = diagonal - e
            base.append(start)
            a, b = max(0, start), min(len(codes), start + width + m)
            if a < b:
                text[row, a - start : b - start] = codes[a:b]
        step = np.arange(width, dtype=np.int32)
        cost = np.zeros((len(regions), width), np.int32)
        for i in range(m):
            through = cost + (text[:, i : i + width] != pattern[i])
            through[:, :-1] = np.minimum(through[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(through - step, axis=1) + step
        best = cost.argmin(axis=1)
        return [(int(cost[r, d]), base[r] + int(d) + m) for r, d in enumerate(best)]

    def search(self, documents: list[str]) -> list[tuple[int, int, int, int]]:
        """(document, item, edits, end): the best place of each item within its budget, in normal texts."""
        codes = [code_points(t) for t in documents]
        by_item: dict[int, list[tuple[int, int]]] = {}
        for doc, c in enumerate(codes):
            for item, diagonal in self.regions(c):
                by_item.setdefault(item, []).append((doc, diagonal))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for item, places in by_item.items():
            for at in range(0, len(places), 64):
                some = places[at : at + 64]
                found = self.align(item, [(codes[d], diagonal) for d, diagonal in some])
                for (doc, _), (edits, end) in zip(some, found):
                    if edits <= self.edits[item] and (doc, item) not in best or (edits, end) < best.get((doc, item), (-1, -1)):
                        best[doc, item] = (edits, end)
        for item in self.short:
            text = f" {self.items[item][1]} "
            for doc, t in enumerate(documents):
                at = f" {t} ".find(text)
                if at >= 0:
                    best[doc, item] = (0, at + len(text) - 2)
        return [(doc, item, edits, end) for (doc, item), (edits, end) in sorted(best.items())]


def blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """Items (item_id, text) in blocks of about ``chars`` characters; null and empty ones are left out."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("trim(text) <> ''")
    total = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / chars))
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


MATCHES = "doc_id long, item_id long, edits int, item_chars int, end int"


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = GRAM, share: float = EDIT_SHARE) -> DataFrame:
    """(doc_id, item_id, edits, item_chars, end) for each benchmark item found in a document.

    Texts are compared in lower case with single blanks; ``end`` is where the occurrence
    ends in that text. An item is found if it occurs with at most ``share`` edits a
    character (never so many that the lemma would ask for no shared gram). Items shorter than a gram must
    occur as they are, between blanks. Null and empty texts and items match nothing;
    repeated rows are reported each. A benchmark above BLOCK_CHARS goes in blocks over all documents.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], MATCHES)
    for items in blocks(benchmark):
        sent = spark.sparkContext.broadcast(Index(items, q, share))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [
                    {"doc_id": ids[doc], "item_id": sent.value.items[k][0], "edits": edits,
                     "item_chars": len(sent.value.codes[k]), "end": end}
                    for doc, k, edits, end in sent.value.search([normal(t.as_py()) for t in batch.column(1)])
                ]
                names = [("doc_id", pa.int64()), ("item_id", pa.int64())]
                names += [(n, pa.int32()) for n in ("edits", "item_chars", "end")]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(names))

        found = found.union(source.mapInArrow(run, MATCHES))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, q: int = GRAM, share: float = EDIT_SHARE) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, all columns as they are."""
    at = docs.columns.index("text")
    kept = docs
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(Index(items, q, share))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[m[0] for m in sent.value.search([normal(t.as_py()) for t in batch.column(at)])]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
