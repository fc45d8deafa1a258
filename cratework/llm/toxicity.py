"""Toxicity: obfuscated words are restored as a noisy channel would have it, then scored.

A character trigram model of the whole corpus says which letters are likely; the channel
says how leetspeak, spacing and repetition change them. Viterbi decoding finds the
likeliest letters of each odd place, and a word model scores the restored text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm import minhash
from cratework.llm.common import Scratch, texts
from cratework.llm.quality import labelled_texts, sample_labels

# Letters that a sign can stand for.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
# Channel: natural logarithms of how likely a writer changes what the letters say.
SIGN_FOR_LETTER = -2.0
SIGN_AS_IT_IS = -14.0
MARK_AT_END = -1.0
LETTER_REPEATED = -1.5
GAP_PUT_IN = -0.2
GAP_AS_IT_IS = -3.0
GAPS = " .-_*"
# What may end a word as punctuation or junk: no letters, digits or @ $ €, or one of these three times.
TAIL = re.compile(r"(?:([0-9@$€])\1{2,}[^\w@$€]*|[^\w@$€]+)$")
# Letter classes of the language model: 0 the edge of a word, a to z, 37 for other letters.
CLASSES = 64
# Code points above share classes by remainder.
KNOWN = 0x250
# Longer runs without white space are no words.
WORD = 64
# Characters whose trigrams are counted at a time.
PIECE = 1 << 20
# Decoded places and words that a worker remembers.
REMEMBERED = 200_000
# Hashed word features, and the log odds a feature must have to count.
FEATURES = 1 << 22
LEAST_WEIGHT = 2.0
# Labelled documents a feature must be in to speak for a word; else its beginning does.
ENOUGH = 5


def _class_table() -> np.ndarray:
    out = np.zeros(KNOWN, np.uint8)
    for c in range(KNOWN):
        low = chr(c).lower()
        if low.isalpha():
            first = ord(low[0])
            out[c] = first - 96 if 97 <= first <= 122 else 27 + first % 37
    return out


CLASS = _class_table()
LETTER, SIGN, GAP, SPACE = 1, 2, 4, 8


def _kind_table() -> np.ndarray:
    out = np.where(CLASS > 0, LETTER, 0).astype(np.uint8)
    for c in range(KNOWN):
        out[c] |= SIGN * (chr(c) in LEET) | GAP * (chr(c) in GAPS) | SPACE * chr(c).isspace()
    return out


KIND = _kind_table()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def letter_classes(codes: np.ndarray) -> np.ndarray:
    high = codes >= KNOWN
    if not high.any():
        return CLASS[codes]
    return np.where(high, 27 + codes % 37, CLASS[np.where(high, 0, codes)]).astype(np.uint8)


def odd_places(low: str) -> list[int]:
    """Positions to decode around: a sign beside a letter, a letter three times, single letters or signs with gaps."""
    codes = code_points(low)
    if len(codes) < 3:
        return []
    kind = np.where(codes < KNOWN, KIND[np.minimum(codes, np.uint32(KNOWN - 1))], LETTER)
    letter, sign, gap = ((kind & k).astype(bool) for k in (LETTER, SIGN, GAP))
    odd = np.zeros(len(codes), bool)
    odd[:-1] = sign[:-1] & letter[1:]
    odd[1:] |= sign[1:] & letter[:-1]
    same = codes[1:] == codes[:-1]
    odd[2:] |= same[1:] & same[:-1] & letter[2:]
    if len(codes) >= 5:  # x.x.x
        unit = letter | sign
        single = gap[1:-1] & unit[:-2] & unit[2:]
        odd[1:-3] |= single[:-2] & single[2:]
    return np.flatnonzero(odd).tolist()


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES**3, np.int64)
    for batch in batches:
        text = "  " + "  ".join(texts(batch.column(0))) + " "  # the edges of texts are edges of words
        for at in range(0, len(text) - 2, PIECE):
            found = letter_classes(code_points(text[at : at + PIECE + 2])).astype(np.int32)
            total += np.bincount((found[:-2] << 12) + (found[1:-1] << 6) + found[2:], minlength=CLASSES**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """log P(letter class | two before), from the trigrams of every text of the corpus."""
    counts = docs.select("text").mapInArrow(_count_letters, "gram long, n long")
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()  # at most CLASSES ** 3 rows
    table = np.zeros(CLASSES**3)
    table[counts["gram"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    table = table.reshape(CLASSES, CLASSES, CLASSES)
    pairs = table.sum(axis=0) + 0.01
    lower = pairs / pairs.sum(axis=1, keepdims=True)
    smooth = 5.0
    return np.log((table + smooth * lower) / (table.sum(axis=2, keepdims=True) + smooth)).astype(np.float32)


def _letter(char: str) -> int:
    code = ord(char)
    return int(CLASS[code]) if code < KNOWN else (27 + code % 37 if char.isalpha() else 0)


def lattice(place: str) -> list[list[tuple[str, float]]]:
    """For each piece of a place, what it may stand for and how likely the channel makes it so."""
    steps: list[list[tuple[str, float]]] = []
    spaced = len(place) > 2 and all((c in GAPS) == bool(k % 2) for k, c in enumerate(place))
    at = 0
    while at < len(place):
        char, end = place[at], at + 1
        while end < len(place) and place[end] == char:
            end += 1
        run, at = end - at, end
        if spaced and char in GAPS:
            steps.append([("", GAP_PUT_IN), (" ", GAP_AS_IT_IS)])
        elif char.isalpha():
            ways = [(char * run, 0.0 if run < 3 else LETTER_REPEATED * (run - 2))]
            ways += [(char * n, LETTER_REPEATED) for n in (1, 2) if n < run]
            steps.append(ways)
        elif char in LEET:
            ways = [(letter * run, SIGN_FOR_LETTER * run) for letter in LEET[char]]
            if run > 1:
                ways += [(letter, SIGN_FOR_LETTER * run + LETTER_REPEATED) for letter in LEET[char]]
            steps.append([*ways, (char * run, SIGN_AS_IT_IS)])
        else:
            steps.append([(char * run, 0.0)])
    return steps


def _unit(char: str) -> bool:
    """Whether a character may be a letter between gaps."""
    return char.isalpha() or char in LEET


def decode(place: str, model: np.ndarray) -> str:
    """The likeliest reading of a place (lower case): Viterbi over its lattice, a state for the last two letters."""
    return _likeliest(place, model)[1]


def decode_ended(place: str, model: np.ndarray) -> str:
    """As decode, but what ends the place may also be no part of the word, which is then read alone."""
    cost, read = _likeliest(place, model)
    tail = TAIL.search(place)
    if tail and tail.start():
        alone, body = _likeliest(place[: tail.start()], model)
        if alone + MARK_AT_END >= cost:
            return body + tail[0]
    return read


def _likeliest(place: str, model: np.ndarray) -> tuple[float, str]:
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for ways in lattice(place):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, read) in best.items():
            for text, channel in ways:
                total, x, y = cost + channel, a, b
                for char in text:
                    z = _letter(char)
                    total += float(model[x, y, z])
                    x, y = y, z
                found = after.get((x, y))
                if found is None or (total, read + text) > found:
                    after[x, y] = (total, read + text)
        best = after
    closed = [(cost + float(model[a, b, 0]), read) for (a, b), (cost, read) in best.items()]
    return max(closed)


class Restorer:
    """Restores texts under a letter model; remembers the places it has decoded."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def restore(self, text: str) -> str:
        """The text in lower case with its odd places decoded."""
        low = text.lower()
        places = odd_places(low)
        if not places:
            return low
        parts, done, size = [], 0, len(low)
        for at in places:
            if at < done:
                continue
            start, end = at, at + 1
            if low[at] in GAPS and _unit(low[at - 1]):  # single letters or signs with gaps
                start = at - 1
                while end + 1 < size and _unit(low[end]) and low[end + 1] in GAPS:
                    end += 2
                last = end < size and _unit(low[end]) and (end + 1 == size or not low[end + 1].isalnum())
                end = end + 1 if last else end - 1
                if start < done or (start and low[start - 1].isalnum()):
                    start += 2
                if end - start < 5 or sum(map(str.isalpha, low[start:end])) < 2:  # numbers stay
                    continue
            else:
                while start > done and not low[start - 1].isspace():
                    start -= 1
                while end < size and not low[end].isspace():
                    end += 1
                if end - start > WORD:  # no word: only what is around the place
                    start, end = max(start, at - WORD // 2), min(end, at + WORD // 2)
                if not any(map(str.isalpha, low[start:end])):  # signs after a decoded place
                    continue
            place = low[start:end]
            read = self.known.get(place)
            if read is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                read = self.known[place] = decode_ended(place, self.model)
            parts += [low[done:start], read]
            done = end
        return "".join([*parts, low[done:]])


_TO_SPACE = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalpha()), b" " * (128 - 52))


def word_set(restored: str) -> set[bytes]:
    return set(restored.encode().translate(_TO_SPACE).split())


def word_features(word: bytes) -> tuple[int, int, int]:
    """Hashed features: the word, its first four and its first five letters."""
    last = FEATURES - 1
    return zlib.crc32(word) & last, zlib.crc32(word[:5], 1) & last, zlib.crc32(word[:4], 2) & last


def text_features(restored: str) -> np.ndarray:
    return np.unique(np.array([f for word in word_set(restored) for f in word_features(word)], np.int64))


class Model:
    """Word weights: log odds of toxic documents, where chance does not explain them.

    A feature counts if so many of its documents would be toxic by chance with a
    probability (Chernoff bound) below one in the number of features seen, and if its log
    odds are LEAST_WEIGHT or more. ``toxic`` and ``clean`` are the counts of ``features``, those of at least
    ENOUGH documents; ``seen`` is the number of all.
    """

    def __init__(
        self, letters: np.ndarray, features: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float, seen: int
    ):
        self.letters = letters
        self.prior = float(np.log((n_toxic + 0.5) / (n_clean + 0.5)))
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1.0)
        both = toxic + clean
        rate = np.clip(toxic / np.maximum(both, 1), 1e-12, 1 - 1e-12)
        surprise = both * (rate * np.log(rate / share) + (1 - rate) * np.log((1 - rate) / (1 - share)))
        real = (rate > share) & (surprise > np.log(max(1, seen)))
        weight = np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((clean + 1.0) / (n_clean + 2.0))
        weight = np.where(real & (weight >= LEAST_WEIGHT), weight, 0).astype(np.float32)
        self.features, self.weights = features.astype(np.int32), weight

    def scorer(self):
        """Restored text to a probability: of each word its closest known feature, of a text its three strongest words."""
        weight = dict(zip(self.features.tolist(), self.weights.tolist()))
        known: dict[bytes, float] = {}

        def of(word: bytes) -> float:
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = next((weight[f] for f in word_features(word) if f in weight), 0.0)
                known[word] = found
            return found

        def score(restored: str) -> float:
            strong = sorted((x for x in map(of, word_set(restored)) if x), reverse=True)
            return float(1.0 / (1.0 + np.exp(-np.clip(self.prior + sum(strong[:3]), -30, 30))))

        return score


def _restored(letters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters.value)
        for batch in batches:
            read = [restorer.restore(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(read, pa.string()), batch.column(2)], ["doc_id", "text", "label"])

    return run


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of the documents of either label with each feature, and (feature -1) of all of them."""
    counts = np.zeros((2, FEATURES))
    documents = [0.0, 0.0]
    for batch in batches:
        for text, label, weight in zip(texts(batch.column(0)), *(batch.column(i).to_pylist() for i in (1, 2))):
            counts[label][text_features(text)] += weight
            documents[label] += weight
    seen = np.flatnonzero(counts.any(axis=0))
    values = [np.r_[documents[k], counts[k][seen]] for k in (1, 0)]
    columns = [pa.array(np.r_[-1, seen].astype(np.int64)), *map(pa.array, values)]
    yield pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "clean"])


def with_weights(labelled: DataFrame) -> DataFrame:
    """(text, label, weight) of (doc_id, text, label): the members of a group of near copies share the weight of one.

    Groups as ``minhash`` links them, by five-word shingles that are 80 % alike, counted on full
    sets; copies with another label are in the same group. No row is left out.
    """
    groups = minhash.near_duplicates(labelled, shingle=5, percent=80).select("doc_id", "component_id")
    sizes = groups.groupBy("component_id").agg(F.count("*").alias("size"))
    named = groups.join(sizes, "component_id").select("doc_id", (1 / F.col("size")).alias("weight"))
    return labelled.join(named, "doc_id").select("text", "label", "weight")


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", learn=lambda doc_id: F.lit(True), sample: int = 20000
) -> Model:
    """The letter model of all documents, and word weights from at most ``sample`` labelled ones.

    Near copies among the labelled documents share the weight of one; all are learned from. Labels that are
    null, other than 0 and 1 or without document count nothing; of contradicting labels of one doc_id 1
    counts, of several texts the smallest.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    letters = letter_model(docs)
    sent = spark.sparkContext.broadcast(letters)
    # Bounded by the sample: its ids and labels are all that the driver sees.
    chosen = spark.createDataFrame(
        [(r["doc_id"], r["label"]) for r in sample_labels(labels, label, learn, sample).collect()],
        "doc_id long, label int",
    )
    found = labelled_texts(docs, chosen).select("doc_id", "text", "label")
    found = found.mapInArrow(_restored(sent), "doc_id long, text string, label int")
    found = scratch.stage(found, "restored")
    counts = with_weights(found).mapInArrow(_count_features, "feature long, toxic double, clean double")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = scratch.stage(counts, "counts")
    seen = counts.where("feature >= 0").count()
    # At most FEATURES + 1 rows; features too rare for a weight are most of them.
    rows = counts.where((F.col("feature") < 0) | (F.round(F.col("toxic") + F.col("clean"), 6) >= ENOUGH)).toPandas()
    scratch.drop("restored")
    scratch.drop("counts")
    # Sums of shares differ in their last bits from run to run, weights must not.
    index, *sums = (rows[c].to_numpy(np.int64 if c == "feature" else float).round(6) for c in ("feature", "toxic", "clean"))
    known, number = index >= 0, [round(float(x[index < 0].sum()), 6) for x in sums]
    return Model(letters, index[known], *(x[known] for x in sums), *number, seen)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document: 0 to 1, higher where it is likelier toxic.

    Null and empty texts have no words and get the share of toxic documents among the labelled ones.
    Without labelled documents every score is 0.5. Repeated rows stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, of = Restorer(sent.value.letters), sent.value.scorer()
        for batch in batches:
            scores = [of(restorer.restore(t)) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
