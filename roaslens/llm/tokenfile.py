"""Token files: ids packed at a fixed width of bits, in blocks, with an index of the documents.

Layout of a file: ``MAGIC``; blocks of ``BLOCK`` ids (the last may be shorter, padded to 64 ids), where
64 ids of ``width`` bits fill ``width`` little-endian 64-bit words; the footer (document ids, null
flags, running ends of the documents in ids, byte offsets of the blocks, as little-endian 64-bit
integers); its head (width, number of documents, ids, blocks, footer offset); ``MAGIC``.  Any range of
ids is read from the blocks that hold it alone.

Files are written through pyarrow file systems, so a folder may be local-and-shared or a store.
Each task writes files under names of its own, a new one after ``TOKENS`` ids, and reports them in its rows; a manifest
is written from the rows of tasks that were committed, so files of lost or repeated tasks are never read.

Documents go by id (null first), equal ids by a hash of the text, which also splits an id that very many rows
have over tasks; a null text is empty; equal rows are documents each; other columns are not carried.  An empty table gives
no files."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roaslens.llm.bpe import encoder, runs
from roaslens.llm.common import cut, shuffle_parts, text_or_empty
from roaslens.session import scratch_path

MAGIC = b"BITIDS01"
BLOCK = 1 << 16
TOKENS = 1 << 28  # ids in a file, after which the task begins another
_PLAIN = {8: "<u1", 16: "<u2", 32: "<u4"}  # widths whose packed words are plain arrays
_HEAD = struct.Struct("<5q")
_U = np.uint64


def width_of(vocabulary: int) -> int:
    """Least number of bits that holds ids 0 to ``vocabulary - 1``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids (padded to a multiple of 64 with zeros) as ``width`` 64-bit words per 64 ids."""
    if width in _PLAIN:
        return ids.astype(_PLAIN[width]).tobytes() + bytes(-len(ids) % 64 * width // 8)
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((len(lanes), width), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= lanes[:, lane] << _U(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, lane] >> _U(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_bits(data: bytes, width: int, n: int) -> np.ndarray:
    if width in _PLAIN:
        return np.frombuffer(data, _PLAIN[width], n).astype(np.uint32)
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    lanes = np.empty((len(words), 64), np.uint32)
    mask = _U((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        x = words[:, word] >> _U(shift)
        if shift + width > 64:
            x = x | (words[:, word + 1] << _U(64 - shift))
        lanes[:, lane] = x & mask
    return lanes.reshape(-1)[:n]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class Writer:
    """Writes one file; holds at most a block and the index."""

    def __init__(self, uri: str, width: int):
        where, path = file_system(uri)
        where.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.width = where.open_output_stream(path), width
        self.out.write(MAGIC)
        self.at, self.n, self.waiting, self.held, self.blocks, self.ids, self.ends = len(MAGIC), 0, 0, [], [], [], []

    def _flush(self, ids: np.ndarray) -> None:
        if int(ids.max()) >> self.width:
            raise ValueError("an id is outside the vocabulary")
        data = pack_bits(ids, self.width)
        self.blocks.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, *ids: bytes) -> None:
        """A document from its ids, little-endian unsigned 32-bit integers, in one or several pieces."""
        self.held += ids
        n = sum(map(len, ids)) // 4
        self.n += n
        self.waiting += n
        self.ids.append(doc_id)
        self.ends.append(self.n)
        if self.waiting >= BLOCK:
            held = np.frombuffer(b"".join(self.held), "<u4")
            whole = len(held) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self._flush(held[k : k + BLOCK])
            self.held, self.waiting = [held[whole:].tobytes()], len(held) - whole

    def close(self) -> None:
        if self.waiting:
            self._flush(np.frombuffer(b"".join(self.held), "<u4"))
        null = np.array([x is None for x in self.ids], "<i8")
        ids = np.array([x or 0 for x in self.ids], "<i8")
        for part in (ids, null, np.array(self.ends, "<i8"), np.array(self.blocks, "<i8")):
            self.out.write(part.tobytes())
        self.out.write(_HEAD.pack(self.width, len(self.ids), self.n, len(self.blocks), self.at) + MAGIC)
        self.out.close()


class Reader:
    """Random access to the documents and ids of one file."""

    def __init__(self, uri: str):
        where, path = file_system(uri)
        self.file = where.open_input_file(path)
        size, tail = self.file.size(), _HEAD.size + len(MAGIC)
        self.file.seek(size - tail)
        head = self.file.read(tail)
        if head[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.width, docs, self.n, blocks, at = _HEAD.unpack(head[: _HEAD.size])
        self.file.seek(at)
        index = np.frombuffer(self.file.read(size - tail - at), "<i8")
        self.doc_ids, self.null, self.ends, self.blocks = np.split(index, [docs, 2 * docs, 3 * docs])
        self.blocks = np.append(self.blocks, at)
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def block(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            self.file.seek(int(self.blocks[k]))
            data = self.file.read(int(self.blocks[k + 1] - self.blocks[k]))
            self._last = (k, unpack_bits(data, self.width, min(BLOCK, self.n - k * BLOCK)))
        return self._last[1]

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end - 1`` of the file."""
        if start >= end:
            return np.zeros(0, np.uint32)
        return np.concatenate([self.block(k)[max(0, start - k * BLOCK) : end - k * BLOCK] for k in range(start // BLOCK, (end - 1) // BLOCK + 1)])

    def document(self, row: int) -> np.ndarray:
        return self.read(int(self.ends[row - 1]) if row else 0, int(self.ends[row]))


def write(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, folder: str | None = None) -> DataFrame:
    """Write all documents in ascending id (nulls first) and return the manifest: (part, file, docs,
    tokens, start), ``start`` being the ids in all files before.  A null text counts as empty."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    width = width_of(vocabulary)

    def to_file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end, writer, first, done = encoder(tokenizer), np.array([end_id], "<u4").tobytes(), None, None, 0

        def close() -> pd.DataFrame:
            writer.close()
            return pd.DataFrame([(first * 2**20 + done, name, len(writer.ids), writer.n)], columns=["part", "file", "docs", "tokens"])

        for pdf in batches:
            at = 0
            for some in runs(pdf["text"].tolist()):
                rows = pdf.iloc[at : at + len(some)]
                at += len(some)
                for doc_id, null, part, ids in zip(rows["doc_id"].tolist(), rows["null"].tolist(), rows["part"].tolist(), enc.encode(some), strict=True):
                    if writer is None:
                        first, name = part, f"{folder}/part-{part:06d}-{done:06d}-{uuid.uuid4().hex}.ids"
                        writer = Writer(name, width)
                    writer.add(None if null else doc_id, ids, end)
                    if writer.n >= TOKENS:
                        yield close()
                        writer, done = None, done + 1
        if writer is not None:
            yield close()

    key = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(key, F.lit(-(2**63))).alias("doc_id"), key.isNull().alias("null"), text_or_empty("text").alias("text")).withColumn("mark", F.xxhash64("text"))
    order = ["doc_id", F.col("null").desc(), "mark"]
    ranged = rows.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order).drop("mark")
    files = cut(ranged.withColumn("part", F.spark_partition_id()).mapInPandas(to_file, "part long, file string, docs long, tokens long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""

    def from_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, start in zip(pdf["file"], pdf["start"], strict=True):
                r, begin, crc = Reader(name), 0, []
                for end in r.ends.tolist():
                    crc.append(zlib.crc32(r.read(begin, end).astype("<u4").tobytes()))
                    begin = end
                begins = np.concatenate(([0], r.ends[:-1])) if len(r.ends) else r.ends
                out = pd.DataFrame({"doc_id": pd.array(r.doc_ids, "Int64"), "start": start + begins, "n_tokens": r.ends - begins, "ids_crc32": np.array(crc, np.int64)})
                out.loc[r.null == 1, "doc_id"] = pd.NA
                yield out

    parts = shuffle_parts(manifest.sparkSession)
    return manifest.select("file", "start").repartition(parts, "file").mapInPandas(from_files, "doc_id long, start long, n_tokens long, ids_crc32 long")
