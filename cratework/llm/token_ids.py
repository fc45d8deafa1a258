r"""Token ids of a corpus in byte-aligned files.

A file holds blocks of documents. Ids are replaced by their frequency rank over the
whole corpus, so that common ones take one byte: a rank takes 1 to 4 data bytes, and its
length stands apart, two bits to an id, in the control bytes. Lengths and starts follow from a
table of 256 control bytes, and numpy gathers all ids of a block at once.

File: ``RNKV`` | blocks | footer | u32 block count, u64 offset of the footer. Block: u32
documents, u64 control bytes, u64 data bytes | i64 doc_id each | u64 ids of each | control
bytes | data bytes; a document starts a control byte of its own. Footer: u64 offset of each
block, u64 ids before each block in this file.
Beside the files, ``ranks`` (rank, id) and ``index`` (path, ids before the file) are Parquet.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratework import files
from cratework.llm.common import Scratch

MAGIC = b"RNKV"
BLOCK_IDS = 1 << 20
BLOCKS_PER_TASK = 16
NO_ID = -(1 << 63)
# Distinct words whose ids a worker remembers.
REMEMBERED = 800_000
# ASCII marks but the apostrophe; letters before them, the last byte of Latin ones with accents apart.
_IS_MARK, _IS_LETTER, _IS_ACCENTED = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_IS_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True
_IS_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_IS_ACCENTED[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True  # after 0xC3; no signs for times and division

#: For each control byte: where its four ids start in the data, and how long all are.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(ranks: np.ndarray, sizes: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of the unsigned 32-bit numbers of several documents, of these sizes.

    A document's numbers start a control byte of their own.
    """
    ranks = ranks.astype(np.uint32)
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    slots = -(-sizes // 4) * 4
    four = np.zeros(int(slots.sum()), np.uint8)
    moved = (np.cumsum(slots) - slots) - (np.cumsum(sizes) - sizes)
    four[np.arange(len(ranks)) + np.repeat(moved, sizes)] = code
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    every = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    most = int(code.max()) + 1 if len(code) else 1
    return control.tobytes(), every[:, :most][np.arange(most) <= code[:, None]].tobytes()


def unpack(control: bytes, data: bytes, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several documents again: lengths by table lookup, bytes by gathering."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    slots = -(-sizes // 4) * 4
    if (slots != sizes).any():  # the last control byte of a document may have lengths to spare
        ends = np.cumsum(slots)
        change = np.zeros(len(lengths) + 1, np.int8)
        np.add.at(change, ends - slots + sizes, 1)
        np.add.at(change, ends, -1)
        lengths = lengths[np.cumsum(change[:-1]) == 0]
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in range(1, 4):
        at = np.flatnonzero(lengths > k)
        if not len(at):
            break
        out[at] |= raw[starts[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class _Words(dict):
    """Ids of words already encoded, by number; new words wait until ``learn``."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.single = Tokenizer.from_file(path)
        self.single.normalizer = normalizers.Sequence([])
        self.single.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, number in self.whole.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.flat = np.empty(0, np.int32)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def learn(self) -> None:
        """Encode the new words: single letter groups many at a time, others one by one."""
        if not self.new:
            return
        texts = [w.decode() for w in self.new]
        self.new = []
        starts, sizes = np.full(len(texts), -1, np.int64), np.zeros(len(texts), np.int64)
        pieces, at = [self.flat], len(self.flat)
        letters = [k for k, w in enumerate(texts) if w.isalpha()]
        normal = self.whole.normalizer.normalize_str(" ".join(texts[k] for k in letters)).split(" ")
        plain = [(k, w) for k, w in zip(letters, normal) if w.isalpha()]
        for first in range(0, len(plain), 4096):
            some = plain[first : first + 4096]
            joined = " ".join(w for _, w in some)
            ids = np.array(self.single.encode(joined, add_special_tokens=False).ids, np.int32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(some):
                rows = np.array([k for k, _ in some])
                starts[rows] = at + np.r_[0, cut[:-1]]
                sizes[rows] = np.diff(np.r_[0, cut])
                pieces.append(ids)
                at += len(ids)
        rest = np.flatnonzero(starts < 0).tolist()
        for k, one in zip(rest, self.whole.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            pieces.append(np.array(one.ids, np.int32))
            starts[k], sizes[k] = at, len(one.ids)
            at += len(one.ids)
        self.flat = np.concatenate(pieces)
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])


@lru_cache(maxsize=1)
def _remembered(path: str) -> _Words:
    return _Words(path)


def _part_marks(texts: list[bytes]) -> list[bytes]:
    """Each text with a blank before marks that stand between a letter and a blank or line end.

    Such marks are a token group of their own (apostrophes may not be), so words need not be
    remembered with every mark that can follow them.
    """
    codes = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    stops = np.cumsum([len(t) + 1 for t in texts])
    at = np.flatnonzero(_IS_MARK[codes])
    if not len(at):
        return texts
    edge = np.flatnonzero(np.diff(at) != 1)
    first, after = at[np.r_[0, edge + 1]], at[np.r_[edge, len(at) - 1]] + 1
    before, ends = codes[first - 1], codes[after]  # at -1 and between texts: zero bytes
    letter = _IS_LETTER[before] | (_IS_ACCENTED[before] & (codes[first - 2] == 0xC3))
    first = first[letter & ((ends == 0x20) | (ends == 0x0A))]
    out = np.insert(codes, first, 0x20).tobytes()
    stops = (stops + np.searchsorted(first, stops)).tolist()
    return [out[a : b - 1] for a, b in zip([0, *stops], stops)]


def encode(path: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text, as the tokenizer gives them for the whole text without special tokens.

    The tokenizer drops white space and never joins what it parts, so the ids of a text
    are those of its words one after the other. Texts with an added token's opening
    are encoded whole.
    """
    known = _remembered(path)
    if len(known) > REMEMBERED:
        known.reset()
    out: list = [None] * len(texts)
    plain, numbers, rows = [], [], []
    for k, text in enumerate(texts):
        if "<|" in text:
            out[k] = np.array(known.whole.encode(text, add_special_tokens=False).ids, np.int32)
            continue
        data = text.encode()
        if b"\xcc" not in data and b"\xcd" not in data:  # no accents that could join a capital
            data = data.lower()
        plain.append(data)
        rows.append(k)
    for data in _part_marks(plain) if plain else []:
        parts = data.split()
        numbers.append(np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)))
    known.learn()
    for k, number in zip(rows, numbers):
        if not len(number):
            out[k] = np.empty(0, np.int32)
            continue
        n, first = known.sizes[number], known.starts[number]
        total = np.cumsum(n)
        out[k] = known.flat[np.arange(total[-1]) + np.repeat(first - (total - n), n)]
    return out


def token_table(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """(doc_id, ids): ids as numbers of ``kind`` (a numpy type), the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], kind)
        for batch in batches:
            found = encode(tokenizer, [t or "" for t in batch.column(1).to_pylist()])
            ids = [np.concatenate([x.astype(kind), end]).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def _counts(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            every = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            found = np.bincount(every, minlength=len(total))
            found[: len(total)] += total
            total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return run


REPORT = "path string, first long, docs long, tokens long"


def _write(folder: str, kind: str, ranks):
    def block(docs: list[tuple]) -> bytes:
        names = np.array([NO_ID if d is None else d for d, _ in docs], "<i8").tobytes()
        sizes = np.array([len(ids) for _, ids in docs], np.int64)
        control, data = pack(ranks.value[np.concatenate([ids for _, ids in docs])], sizes)
        head = struct.pack("<IQQ", len(docs), len(control), len(data))
        return head + names + sizes.astype("<u8").tobytes() + control + data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}.rnkv"  # of a repeated task only the files it reports count
        starts, before, written, total, count, first = [], [], 0, 0, 0, None
        out, docs, held = None, [], 0

        def flush() -> None:
            nonlocal written, total, count, docs, held
            content = block(docs)
            starts.append(written)
            before.append(total)
            out.write(content)
            written, total, count = written + len(content), total + held, count + len(docs)
            docs, held = [], 0

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None:
                    out = files.open_output(path)
                    out.write(MAGIC)
                    written, first = len(MAGIC), doc
                ids = np.frombuffer(raw.as_py(), kind)  # a copy: the batch need not stay
                docs.append((doc, ids))
                held += len(ids)
                if held >= BLOCK_IDS:
                    flush()
        if out is None:
            return
        if docs:
            flush()
        out.write(np.array(starts + before, "<u8").tobytes() + struct.pack("<IQ", len(starts), written))
        out.close()
        columns = [pa.array([path]), *(pa.array([x], pa.int64()) for x in (first, count, total))]
        yield pa.RecordBatch.from_arrays(columns, ["path", "first", "docs", "tokens"])

    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode every text and write the files, their index and the ranks into ``folder``.

    Documents are in ascending doc_id order over the files (rows without id first; rows that
    share an id in any order); a file holds one range. Null and empty texts have the end id only.
    An empty table gives no files.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    size = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    tokens = scratch.stage(token_table(docs, tokenizer, end_id, kind), "tokens", "zstd")
    counts = tokens.select("ids").mapInArrow(_counts(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id that occurs, so at most as many as the vocabulary has.
    seen = counts.orderBy(F.desc("n"), "id").toPandas()["id"].to_numpy(np.int64)
    ranks = np.zeros(size, np.uint32)
    ranks[seen] = np.arange(len(seen), dtype=np.uint32)
    spark.createDataFrame(
        pa.table({"rank": pa.array(np.arange(len(seen)), pa.int64()), "id": pa.array(seen, pa.int64())})
    ).coalesce(1).write.parquet(f"{folder}/ranks")
    sent = spark.sparkContext.broadcast(ranks)
    by_id = F.col("doc_id").asc_nulls_first()
    # Ranges are found from the written table, which needs no Python a second time.
    ordered = tokens.repartitionByRange(by_id).sortWithinPartitions(by_id)
    report = scratch.stage(ordered.mapInArrow(_write(f"{folder}/files", kind, sent), REPORT), "report")
    order = Window.orderBy(F.col("first").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    index = report.withColumn("start", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    index.write.parquet(f"{folder}/index")
    scratch.drop("tokens")
    scratch.free_shuffles()


BLOCKS = "path string, offset long, size long, start long"


def _list_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with files.open_input(row["path"]) as handle:
                end = handle.size()
                count, stop = struct.unpack("<IQ", handle.read_at(12, end - 12))
                table = np.frombuffer(handle.read_at(end - 12 - stop, stop), "<u8").astype(np.int64)
            starts, before = table[:count], table[count:]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["path"]] * count),
                    pa.array(starts),
                    pa.array(np.diff(np.r_[starts, stop])),
                    pa.array(before + row["start"]),
                ],
                ["path", "offset", "size", "start"],
            )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; a task reads whole blocks."""
    # One row for each id that occurs, so at most as many as the vocabulary has.
    rank_ids = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)
    sent = spark.sparkContext.broadcast(rank_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input(row["path"]) as handle:
                    content = handle.read_at(row["size"], row["offset"])
                n, controls, size = struct.unpack_from("<IQQ", content)
                at = 20
                names = np.frombuffer(content, "<i8", n, at)
                sizes = np.frombuffer(content, "<u8", n, at + 8 * n).astype(np.int64)
                at += 16 * n
                ranks = unpack(content[at : at + controls], content[at + controls : at + controls + size], sizes)
                ids = sent.value[ranks].astype("<u4")
                ends = np.cumsum(sizes)
                first = 0
                while first < n:  # bounded batches
                    stop = min(n, first + 256)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[first:stop], mask=names[first:stop] == NO_ID),
                            pa.array(row["start"] + (ends - sizes)[first:stop]),
                            pa.array(sizes[first:stop]),
                            pa.array([ids[a:b].tobytes() for a, b in zip((ends - sizes)[first:stop], ends[first:stop])], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    first = stop

    index = spark.read.parquet(f"{folder}/index")
    count, tokens = index.agg(F.count("*"), F.sum("tokens")).first()
    tasks = max(2 * spark.sparkContext.defaultParallelism, (count + (tokens or 0) // BLOCK_IDS) // BLOCKS_PER_TASK)
    blocks = index.select("path", "start").mapInArrow(_list_blocks, BLOCKS).repartition(tasks, "path", "offset")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def id_digests(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

