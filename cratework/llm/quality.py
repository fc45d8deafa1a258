"""A quality classifier: nearest labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import texts

# Terms: hashed character trigrams, then rates of shapes, repeats and sizes.
TRIGRAMS = 1024
SHAPES = 24
TERMS = TRIGRAMS + SHAPES
# Weight of all shapes beside all trigrams.
SHAPE_WEIGHT = 3.0
# Characters whose trigrams are made at a time.
PIECE = 1 << 20
# Documents compared with the labelled vectors at a time.
BLOCK = 256


def _classes() -> np.ndarray:
    """Class of a code point: 0 letter, 1 capital, 2 digit, 3 space, 4 line end, 5 full stop or comma, 6 other."""
    out = np.zeros(0x250, np.uint8)
    for c in range(0x250):
        char = chr(c)
        out[c] = (
            4 if char == "\n" else 3 if char.isspace() else 2 if char.isdigit() else 1 if char.isupper()
            else 0 if char.isalpha() else 5 if char in ".," else 6
        )
    return out


CLASSES = _classes()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def trigram_counts(codes: np.ndarray) -> np.ndarray:
    """How often each hashed trigram occurs in a text."""
    counts = np.zeros(TRIGRAMS, np.int64)
    for at in range(0, len(codes) - 2, PIECE):
        part = codes[at : at + PIECE + 2]
        grams = part[:-2] * np.uint32(0x9E3779B1)
        grams += part[1:-1] * np.uint32(0x85EBCA77)
        grams += part[2:] * np.uint32(0xC2B2AE3D)
        counts += np.bincount(grams >> np.uint32(32 - 10), minlength=TRIGRAMS)
    return counts


def term_counts(text: str) -> np.ndarray:
    """The terms of a whole text, per hundred characters, trigrams or words."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    codes = code_points(text)
    counts = trigram_counts(codes)
    total = counts.sum()
    if total:
        out[:TRIGRAMS] = counts * (100.0 / total)
    follows = np.zeros(64, np.int64)
    for at in range(0, len(codes), PIECE):
        kind = CLASSES[np.minimum(codes[at : at + PIECE + 1], np.uint32(0x24F))]
        follows += np.bincount(kind[:-1] * np.uint8(8) + kind[1:], minlength=64)
    follows = follows.reshape(8, 8)
    shapes = out[TRIGRAMS:]
    shapes[:7] = follows.sum(axis=1)[:7]
    shapes[7:11] = follows[1, 1], follows[6, 6], follows[0, 6] + follows[1, 6], follows[3, 6]
    shapes[:11] *= 100.0 / len(codes)
    words = text.split()
    n = len(words)
    if n:
        hashes = np.fromiter(map(hash, words), np.int64, n)  # compared within the text only
        for k, step in enumerate((1, 2, 4, 20)):
            if n > step:
                shapes[11 + k] = 100.0 * np.count_nonzero(hashes[step:] == hashes[:-step]) / (n - step)
        shapes[15] = 100.0 * (1 - len(set(words)) / n)
        if n > 3:
            grams = hashes[:-2] * np.int64(31) + hashes[1:-1] * np.int64(1009) + hashes[2:]
            grams.sort()
            shapes[16] = 100.0 * np.count_nonzero(grams[1:] == grams[:-1]) / len(grams)
        sizes = np.fromiter(map(len, words), np.int64, n)
        shapes[17] = 100.0 * np.count_nonzero(sizes > 20) / n
        shapes[18] = 100.0 * np.count_nonzero(sizes <= 1) / n
        shapes[19 + min(4, int(np.log10(n)))] = 100.0
    return out


class Space:
    """Latent-semantic space of a bounded sample of labelled documents, and the sample's vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, frequency: np.ndarray, documents: int, dimensions: int):
        """counts: a row for each labelled document; frequency: documents of the corpus with each trigram."""
        self.idf = np.ones(TERMS, np.float32)  # shapes are rates, not rare or common terms
        self.idf[:TRIGRAMS] = np.log((1.0 + documents) / (1.0 + frequency)) + 0.1
        rows = self.weigh(counts)
        gram = rows.T @ rows if len(rows) else np.zeros((TERMS, TERMS), np.float32)
        values, vectors = np.linalg.eigh(gram.astype(np.float64))
        self.axes = vectors[:, np.argsort(values)[::-1][:dimensions]].astype(np.float32)
        self.vectors = self._unit(rows @ self.axes)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        rows = np.sqrt(counts) * self.idf
        for part, weight in ((slice(0, TRIGRAMS), 1.0), (slice(TRIGRAMS, TERMS), SHAPE_WEIGHT)):
            size = np.linalg.norm(rows[:, part], axis=1, keepdims=True)
            rows[:, part] *= weight / np.where(size > 0, size, 1)
        return rows.astype(np.float32)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        size = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(size > 1e-9, size, np.inf)

    def scores(self, counts: np.ndarray, neighbours: int, sharpness: float) -> np.ndarray:
        """Labels of the nearest neighbours, weighted by a power of their cosine; without any, the share of label 1."""
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        near = self._unit(self.weigh(counts) @ self.axes) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        best = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.clip(np.take_along_axis(near, best, 1), 0, 1).astype(np.float64) ** sharpness
        total = weight.sum(axis=1)
        voted = (weight * self.labels[best]).sum(axis=1)
        return np.clip(np.where(total > 1e-6, voted / np.where(total > 1e-6, total, 1), self.prior), 0, 1)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: documents, and documents with each trigram."""
    documents, frequency = 0, np.zeros(TRIGRAMS, np.int64)
    for batch in batches:
        for text in texts(batch.column(0)):
            documents += 1
            frequency += trigram_counts(code_points(text)) > 0
    yield pa.RecordBatch.from_arrays(
        [pa.array([documents], pa.int64()), pa.array([frequency.tolist()], pa.list_(pa.int64()))], ["n", "f"]
    )


def corpus_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and documents with each trigram, over the whole table."""
    counts = docs.select("text").mapInArrow(_count_terms, "n long, f array<long>")
    sums = counts.select("n", F.posexplode("f").alias("term", "f")).groupBy("term").agg(F.sum("n").alias("n"), F.sum("f").alias("f"))
    rows = sums.collect()  # one row for each of TRIGRAMS
    frequency = np.zeros(TRIGRAMS, np.int64)
    for row in rows:
        frequency[row["term"]] = row["f"]
    return (int(rows[0]["n"]) if rows else 0), frequency


def sample_labels(labels: DataFrame, label: str, learn, most: int):
    """At most ``most`` labelled rows (doc_id, label), by hash of doc_id; repeated ids count once, null labels not."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(most)


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the sampled rows; the sample has a bounded number of rows.

    Of several texts under one doc_id the smallest counts, null only if there is no other.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", learn=lambda doc_id: F.lit(True),
    sample: int = 4000, dimensions: int = 48,
) -> Space:
    """The space of at most ``sample`` labelled documents; term statistics come from all of ``docs``.

    Labels that are null, other than 0 and 1 or without document count nothing; of contradicting labels of
    one doc_id 1 counts, of several texts the smallest.
    """
    documents, frequency = corpus_frequencies(docs)
    chosen = docs.sparkSession.createDataFrame(
        [(r["doc_id"], r["label"]) for r in sample_labels(labels, label, learn, sample).collect()],
        "doc_id long, label int",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t).tobytes() for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.binary()), batch.column(2)], ["doc_id", "counts", "label"]
            )

    found = labelled_texts(docs, chosen).select("doc_id", "text", "label")
    rows = sorted(found.mapInArrow(run, "doc_id long, counts binary, label int").collect(), key=lambda r: r["doc_id"])
    counts = np.array([np.frombuffer(r["counts"], np.float32) for r in rows]).reshape(-1, TERMS)
    return Space(counts, np.array([r["label"] for r in rows], np.float32), frequency, documents, dimensions)


def score(docs: DataFrame, space: Space, neighbours: int = 15, sharpness: float = 4.0) -> DataFrame:
    """(doc_id, score) of every document: 0 to 1, higher where label 1 is likelier.

    The labelled vectors (their number is bounded by the sample) go to every task, which
    computes exact cosines for blocks of documents. Null, empty and other texts without any
    neighbour get the share of label 1 in the sample. Repeated rows stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = np.array([term_counts(t) for t in texts(part.column(1))])
                scores = sent.value.scores(counts, neighbours, sharpness)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, space: Space, least: float, neighbours: int = 15, sharpness: float = 4.0) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(space)
    if "text" not in docs.columns:
        raise ValueError("no column text")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                counts = np.array([term_counts(t) for t in texts(part.column(at))])
                yield part.filter(pa.array(sent.value.scores(counts, neighbours, sharpness) >= least))

    return docs.mapInArrow(run, docs.schema)
