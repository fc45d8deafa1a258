"""Repeated word sequences over the whole corpus, by level-wise doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import Scratch, mix, words

FIRST = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))


def windows(hashes: np.ndarray, length: int, base: np.uint64 = FIRST) -> np.ndarray:
    """A hash for every window of ``length`` words, built by doubling from its halves."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, power, size, at = np.zeros(n, np.uint64), np.uint64(1), 1, 0
    part, step, rest = hashes, base, length
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                out += part[at : at + n] * power
                power, at = power * step, at + size
            rest >>= 1
            if rest:
                part = part[: len(part) - size] + part[size:] * step
                size, step = size * 2, step * step
        return mix(out, int(SECOND))


def anchors(grams: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For every ``span`` neighbouring grams, the position of the smallest (leftmost); all, and distinct ones.

    Equal word windows choose equal grams at equal offsets, so a window can repeat only
    if its chosen gram does.
    """
    if len(grams) < span:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    chosen = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(grams) - span + 1)
    return chosen, chosen[np.r_[True, chosen[1:] != chosen[:-1]]]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the row before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def _first_of_each(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order given: is each the first with its key, and is its key repeated."""
    order = np.lexsort(keys[::-1])  # stable
    edge = _changes(*(key[order] for key in keys))
    group = np.cumsum(edge) - 1
    first, several = np.empty(len(order), bool), np.empty(len(order), bool)
    first[order], several[order] = edge, (np.bincount(group) > 1)[group] if len(order) else []
    return first, several


CANDIDATES = "h1 long, h2 long, doc long, pos int, sure boolean, settled boolean"


def _candidates(length: int, window: int, columns: int):
    """Rows of one level, each Arrow batch reduced to the first of equal ones.

    Of equal candidates in a batch only the first has to meet others, so no key has
    more such rows than there are batches. ``sure``: its batch holds another. The others
    are ``settled``: they need no check and are dealt out by document.
    """
    last = length >= window
    span = max(window - length, 0) + 1

    def of(doc: int, parts: list[bytes], open_) -> tuple[np.ndarray, ...] | None:
        hashes = word_hashes(parts)
        if last:
            if open_ is None:
                at = np.arange(max(len(hashes) - length + 1, 0))
            else:
                at = _windows_of(hashes, open_, length, window)
            if not len(at):
                return None
            return windows(hashes, length)[at], windows(hashes, length, SECOND)[at], at
        grams = windows(hashes, length)
        chosen, at = anchors(grams, span)
        if open_ is not None and len(at):
            at = np.unique(chosen[_windows_of(hashes, open_, 0, window)])
        return (grams[at], np.zeros(len(at), np.uint64), at) if len(at) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, docs = [], []
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                doc = batch.column(0)[row].as_py()
                if doc is None or not text:
                    continue
                open_ = None if columns == 2 else (batch.column(2)[row].as_py(), batch.column(3)[row].as_py())
                got = of(doc, words(text), open_)
                if got:
                    found.append(got)
                    docs.append(np.full(len(got[0]), doc, np.int64))
            if not found:
                continue
            h1, h2, at = (np.concatenate(x) for x in zip(*found))
            doc = np.concatenate(docs)
            order = np.lexsort((h2, h1, at, doc))
            h1, h2, at, doc = h1[order], h2[order], at[order], doc[order]
            new = _changes(h1, h2, at, doc)  # rows repeated under one doc_id count once
            h1, h2, at, doc = h1[new], h2[new], at[new], doc[new]
            first, several = _first_of_each(h1, h2)
            h1 = np.where(first, h1.view(np.int64), doc)
            h2 = np.where(first, h2.view(np.int64), 0)
            out = [h1, h2, doc, at.astype(np.int32), several, ~first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in out], ["h1", "h2", "doc", "pos", "sure", "settled"]
            )

    return run


def _windows_of(hashes: np.ndarray, open_: tuple[list[int], int], length: int, window: int) -> np.ndarray:
    """Starts of the windows that the previous level left open."""
    repeated, before = open_
    if before >= window:  # past the window's own length: both halves must repeat
        starts = np.zeros(max(len(hashes) - before + 1, 0) + before, bool)
        starts[repeated] = True
        both = starts[: len(starts) - before] & starts[before:]
        return np.flatnonzero(both[: max(len(hashes) - length + 1, 0)])
    chosen, _ = anchors(windows(hashes, before), window - before + 1)
    is_open = np.zeros(len(hashes) + 1, bool)
    is_open[repeated] = True
    return np.flatnonzero(is_open[chosen]) if len(chosen) else chosen


def _runs(keep_first: bool):
    """Streams rows sorted by (settled, h1, h2, doc, pos, sure first): settled ones, and those whose key repeats.

    Of a key that repeats the first row comes too, or not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen, if its fate is open
        previous = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            settled = rows.pop()
            if settled.any():
                yield _rows(rows[2][settled], rows[3][settled])
                rows = [x[~settled] for x in rows]
                if not len(rows[0]):
                    continue
            new = _changes(*rows[:4])
            new[0] = previous is None or tuple(x[0] for x in rows[:4]) != previous
            previous, before = tuple(x[-1] for x in rows[:4]), previous
            if not new.any():
                continue
            h1, h2, doc, pos, sure = (x[new] for x in rows)
            same = np.zeros(len(h1), bool)
            same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
            same[0] = before is not None and (h1[0], h2[0]) == before[:2]
            out = same.copy()
            if keep_first:
                out |= sure
                out[:-1] |= same[1:]
                if held is not None and same[0]:
                    yield _rows(*held)
                held = None if out[-1] else (doc[-1:], pos[-1:])
            if out.any():
                yield _rows(doc[out], pos[out])

    return run


def _rows(doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(pos)], ["doc", "pos"])


def _settle(candidates: DataFrame, keep_first: bool) -> DataFrame:
    """(doc, pos) of candidates that repeat: all of them, or all but the first of each; one shuffle."""
    dealt = candidates.repartition("h1", "h2").sortWithinPartitions(
        "settled", "h1", "h2", "doc", "pos", F.desc("sure")
    )
    return dealt.mapInArrow(_runs(keep_first), "doc long, pos int")


def repeated_windows(
    scratch: Scratch, docs: DataFrame, window: int, start: int, limit: int | None = None
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """(doc, [pos]) of windows that start earlier too, and of longer repeated ones by length.

    Level-wise doubling. At the first level (``start`` words) each window of ``window``
    words stands for one gram in it, its anchor; windows whose anchor repeats nowhere are
    done. The others alone are extended to twice the length, and so on. From ``window``
    words on whole windows are compared, under 128-bit keys, up to ``limit`` words
    (None: until no candidate survives).
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    length, levels, columns, level_docs = start, {}, 2, source
    while True:
        rows = level_docs.mapInArrow(_candidates(length, window, columns), CANDIDATES)
        if length >= window:
            later = _settle(rows, keep_first=False).groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("starts"))
            levels[length] = later = scratch.stage(later, f"later-{length}")
            scratch.free_shuffles(3)
            if limit is not None and length * 2 > limit:
                break
        survivors = _settle(rows, keep_first=True).groupBy("doc").agg(F.collect_list("pos").alias("starts"))
        survivors = scratch.stage(survivors, f"open-{length}")
        scratch.free_shuffles(3)
        if survivors.isEmpty():
            if length < window:
                levels[window] = survivors
            break
        before, length, columns = length, min(length * 2, window) if length < window else length * 2, 4
        level_docs = source.join(survivors, source["doc_id"] == survivors["doc"]).select(
            "doc_id", "text", "starts", F.lit(before).alias("before")
        )
    return levels[window], levels


def covered(count: int, starts, window: int) -> np.ndarray:
    """Which of ``count`` words a window at one of the starts covers."""
    change = np.zeros(count + window + 1, np.int64)
    at = np.asarray(starts, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.cumsum(change)[:count] > 0


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                parts = words(text.as_py())
                lost = covered(len(parts), starts.as_py() or [], window)
                left = parts if not lost.any() else [p for p, x in zip(parts, lost.tolist()) if not x]
                n.append(len(parts))
                gone.append(len(parts) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = 20, start: int = 10) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without words that an earlier window repeats.

    Words are runs without ASCII white space. A word goes if a window of ``window``
    consecutive words that covers it also starts earlier: in a smaller doc_id, or before
    it in the same document. Windows are judged on the input. Null and empty texts have
    no words. Rows without doc_id have no place in the order and are kept whole. Of
    several rows with one doc_id, the windows of their texts count at equal places, so a
    text does not repeat its own copy under the same id; all such rows lose the same places.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    later, _ = repeated_windows(scratch, docs, window, start, limit=window)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = source.join(later, source["doc_id"] == later["doc"], "left").select("doc_id", "text", "starts")
    return joined.mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept string")


def digest_columns(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def text_digest(parts: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(parts)).hexdigest()
