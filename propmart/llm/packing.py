"""Token ids in fixed-width bit-packed files with block offsets.

File layout, little-endian:

- ``PMPACK01``, then as 32-bit numbers the bit width and the ids per block;
- blocks of ``ids per block`` ids (the last one shorter, filled with zeros to
  64 ids): 64 ids take exactly ``width`` 64-bit words;
- the row index: per document its id, 1 where that id is null, its number of
  ids (three arrays of 64-bit numbers);
- the byte offset of every block (64-bit numbers);
- trailer: offset of the row index, documents, blocks, ids, ``PMPACK01``.

Any run of ids is read with one range read of the blocks that hold it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propmart.llm.common import OwnFile, open_input, pieces, scratch, written
from propmart.llm.tokens import encoder

MAGIC = b"PMPACK01"
HEAD, TAIL = struct.Struct("<8sII"), struct.Struct("<qqqq8s")
BLOCK_IDS = 1 << 16


def bit_width(vocab_size: int) -> int:
    """The fewest bits that hold every id below ``vocab_size``."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """64-bit words of the ids, filled up with zeros to a multiple of 64 ids."""
    table = np.zeros(-(-len(ids) // 64) * 64, np.uint64)
    table[: len(ids)] = ids
    table = table.reshape(-1, 64)
    words = np.zeros((len(table), width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= table[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= table[:, j] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed words."""
    words = words.reshape(-1, width)
    table = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        table[:, j] = value & mask
    return table.reshape(-1)[:count]


class PackedWriter:
    """Writes one file; holds one block of ids and the row index."""

    def __init__(self, out: OwnFile, width: int, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.block_ids = out, width, block_ids
        self.out.write(HEAD.pack(MAGIC, width, block_ids))
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.keys: list[int] = []
        self.nulls: list[int] = []
        self.lengths: list[int] = []
        self.blocks: list[int] = []

    def ids(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block_ids:
            self._flush(self.n_held // self.block_ids * self.block_ids)

    def _flush(self, count: int) -> None:
        if count:
            run = np.concatenate(self.held)
            for at in range(0, count, self.block_ids):
                block = run[at : min(at + self.block_ids, count)]
                self.blocks.append(self.out.write(pack(block, self.width).astype("<u8").tobytes()))
            self.held, self.n_held = [run[count:]], self.n_held - count

    def document(self, key: int | None, n_ids: int) -> None:
        self.keys.append(key or 0)
        self.nulls.append(int(key is None))
        self.lengths.append(n_ids)

    def close(self) -> None:
        self._flush(self.n_held)
        at = self.out.offset
        for column in (self.keys, self.nulls, self.lengths, self.blocks):
            self.out.write(np.array(column, "<i8").tobytes())
        self.out.write(TAIL.pack(at, len(self.keys), len(self.blocks), self.n_ids, MAGIC))
        self.out.close()


class PackedFile:
    """Reads one file; ``run`` gives random access to ids."""

    def __init__(self, folder: str, name: str):
        self.file = open_input(folder, name)
        size = self.file.size()
        magic, self.width, self.block_ids = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        at, n_docs, n_blocks, self.n_ids, tail = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"{name} is not a complete packed file")
        index = np.frombuffer(self.file.read_at(8 * (3 * n_docs + n_blocks), at), "<i8")
        self.keys, nulls, self.lengths, self.blocks = np.split(index, [n_docs, 2 * n_docs, 3 * n_docs])
        self.nulls = nulls.astype(bool)
        self.ends_at = at

    def run(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the file, by one range read."""
        if not count:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        begin = int(self.blocks[first])
        end = int(self.blocks[last + 1]) if last + 1 < len(self.blocks) else self.ends_at
        words = np.frombuffer(self.file.read_at(end - begin, begin), "<u8")
        have = min(self.n_ids, (last + 1) * self.block_ids) - first * self.block_ids
        skip = start - first * self.block_ids
        return unpack(words, self.width, have)[skip : skip + count]

    def close(self) -> None:
        self.file.close()


MANIFEST = "part int, file string, n_docs long, n_ids long"


def write_packed(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Encode ``text`` and write the ids in ascending order of ``doc_id``.

    One range shuffle of (doc_id, text); every task writes one file into the
    shared ``folder``.  Null texts are empty, null ids come first, rows of one
    id are ordered by text, other columns are not read.  Returns the manifest,
    already written.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, end = encoder(tokenizer), np.array([end_id], np.uint32)
        out = writer = None
        for batch in pieces(batches, "text"):
            if writer is None:
                out = OwnFile(folder, "ids", ".pack")
                writer = PackedWriter(out, bit_width(max(made.vocab_size, end_id + 1)))
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            if len(texts) == 1:  # perhaps a very long one
                n = 0
                for part in made.parts(texts[0]):
                    ids, _ = made.encode([part])
                    writer.ids(ids)
                    n += len(ids)
                writer.ids(end)
                writer.document(keys[0], n + 1)
                continue
            ids, counts = made.encode(texts)
            writer.ids(np.insert(ids, np.cumsum(counts), end_id))
            for key, n in zip(keys, counts.tolist(), strict=True):
                writer.document(key, n + 1)
        if writer is not None:
            writer.close()
            row = {"part": [TaskContext.get().partitionId()], "file": [out.name], "n_docs": [len(writer.keys)], "n_ids": [writer.n_ids]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return written(rows.mapInArrow(write, MANIFEST), "packed-manifest")


def read_packed(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document doc_id, start, n_tokens and crc32 of its ids, from the files.

    ``start`` counts the ids of all documents before it, over all files.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packed = PackedFile(folder, name)
                ends = np.cumsum(packed.lengths)
                crc = np.zeros(len(packed.lengths), np.int64)
                doc, done = 0, 0
                for at in range(0, packed.n_ids, packed.block_ids):
                    raw = packed.run(at, min(packed.block_ids, packed.n_ids - at)).astype("<u4").tobytes()
                    while doc < len(ends) and done < at + len(raw) // 4:
                        stop = min(int(ends[doc]), at + len(raw) // 4)
                        crc[doc] = zlib.crc32(raw[4 * (done - at) : 4 * (stop - at)], int(crc[doc]))
                        done = stop
                        doc += int(stop == ends[doc])
                packed.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(packed.keys, pa.int64(), mask=packed.nulls), pa.array(base + ends - packed.lengths), pa.array(packed.lengths), pa.array(crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    spread = files.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def pack_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the packed files of ``docs`` into the shared folder and read them back."""
    folder = scratch(docs.sparkSession, "packed")
    return read_packed(write_packed(docs, folder, tokenizer, end_id), folder)
