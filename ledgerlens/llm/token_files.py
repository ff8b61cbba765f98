"""Token-id files with fixed-width bit packing (operator 4).

Ids are stored in the fewest bits that hold the vocabulary, least significant
bit first.  A file is a run of blocks, written through Spark's own text sink (so
a lost task leaves no half file, on any file system):

    block   "BPK1" | width u8 | pad u8 x 3 | n_ids u32 | n_docs u32
            | n_docs x (doc_id i64, first id in block u32, null u32)
            | packed ids | "\\n"
    footer  "BPKX" | n_blocks u32 | n_blocks x u64 byte offsets | u32 size of the footer | "\\n"

All numbers are little-endian.  All blocks but a file's last hold ``BLOCK`` ids,
so id k is in block k // BLOCK at bit (k % BLOCK) * width: ``PackedFile.ids`` reads
any slice without the rest.  A document's entry stands in the block where its
first id is; it ends where the next begins.

Documents lie in ascending id order over the files (range partitioned, part
numbers in order).  Defined cases: a null text is empty; a null id orders first
and reads back as null; rows of one id order by their text's hash; no rows give
no rows; an empty text holds the end id alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .storage import new_path
from .text import whole
from .tokens import encoder
from .words import batches_of

BLOCK = 1 << 16
_HEAD = struct.Struct("<4sB3xII")
_DOC = np.dtype([("id", "<i8"), ("at", "<u4"), ("null", "<u4")])


def width_for(vocabulary: int) -> int:
    """The fewest bits that hold ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width == 16:
        return ids.astype("<u2").tobytes()
    bits = (ids[:, None] >> np.arange(width, dtype=np.uint32)).astype(np.uint8) & 1
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(raw: bytes | memoryview, width: int, start: int, stop: int) -> np.ndarray:
    """Ids start .. stop - 1 of a packed run: eight bytes from each id's first byte, shifted and masked."""
    first, last = start * width // 8, -(-stop * width // 8)
    buf = bytes(raw[first:last]) + bytes(8)
    bit = np.arange(start, stop, dtype=np.int64) * width - first * 8
    word = np.ndarray((max(0, len(buf) - 7),), "<u8", buf, strides=(1,))[bit >> 3]
    return ((word >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype("<u4")


class PackedFile:
    """A file's bytes, read by slices."""

    def __init__(self, raw: bytes) -> None:
        self.raw = memoryview(raw)
        if not raw:  # a partition without documents
            self.offsets = np.empty(0, "<u8")
            self.n_ids = 0
            return
        size, = struct.unpack_from("<I", raw, len(raw) - 5)
        at = len(raw) - size
        magic, n = struct.unpack_from("<4sI", raw, at)
        if magic != b"BPKX":
            raise ValueError("not a packed token file")
        self.offsets = np.frombuffer(raw, "<u8", n, at + 8)
        self.n_ids = (n - 1) * BLOCK + self._head(n - 1)[2] if n else 0

    def _head(self, block: int) -> tuple:
        magic, width, n_ids, n_docs = _HEAD.unpack_from(self.raw, int(self.offsets[block]))
        if magic != b"BPK1":
            raise ValueError("damaged block")
        return int(self.offsets[block]) + _HEAD.size, width, n_ids, n_docs

    def docs(self, block: int) -> np.ndarray:
        at, _, _, n_docs = self._head(block)
        return np.frombuffer(self.raw, _DOC, n_docs, at)

    def block_ids(self, block: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        at, width, n_ids, n_docs = self._head(block)
        stop = n_ids if stop is None else min(stop, n_ids)
        return unpack(self.raw[at + n_docs * _DOC.itemsize:], width, start, stop)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Any slice of the file's ids."""
        blocks = range(start // BLOCK, -(-min(stop, self.n_ids) // BLOCK))
        parts = [self.block_ids(b, max(0, start - b * BLOCK), min(BLOCK, stop - b * BLOCK)) for b in blocks]
        return np.concatenate(parts) if parts else np.empty(0, "<u4")


def _blocks(docs: Iterator[tuple[int | None, bytes]], width: int) -> Iterator[bytes]:
    """The rows of one file (without the sink's line end) from documents and their ids."""
    held, have, table, offsets, at = [], 0, [], [], 0

    def block(ids: np.ndarray, entries: list) -> bytes:
        nonlocal at
        head = _HEAD.pack(b"BPK1", width, len(ids), len(entries))
        row = head + np.array(entries, _DOC).tobytes() + pack(ids, width)
        offsets.append(at)
        at += len(row) + 1
        return row

    for doc, raw in docs:
        table.append((doc or 0, have, doc is None))
        held.append(raw)
        have += len(raw) // 4
        if have >= BLOCK:
            ids = np.frombuffer(b"".join(held), "<u4")
            done = len(ids) // BLOCK * BLOCK
            for b in range(0, done, BLOCK):
                yield block(ids[b:b + BLOCK], [(d, a - b, n) for d, a, n in table if b <= a < b + BLOCK])
            table = [(d, a - done, n) for d, a, n in table if a >= done]
            held, have = [ids[done:].tobytes()], len(ids) - done
    if have:
        yield block(np.frombuffer(b"".join(held), "<u4"), table)
    if offsets:
        foot = struct.pack("<4sI", b"BPKX", len(offsets)) + np.array(offsets, "<u8").tobytes()
        yield foot + struct.pack("<I", len(foot) + 5)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 0, vocabulary: int | None = None) -> None:
    """Encode, end each document with ``end_id``, and write the files in ascending id order."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = width_for(max(vocabulary or enc.tok.get_vocab_size(), end_id + 1))
        end = np.array([end_id], "<u4").tobytes()

        def pairs():
            for b in batches_of(batches, 1):
                ids, cut = enc.encode(b.column(1))
                for doc, a, z in zip(b.column(0).to_pylist(), cut[:-1].tolist(), cut[1:].tolist()):
                    yield doc, ids[a:z].tobytes() + end

        for row in _blocks(pairs(), width):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["block"])

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), whole(F.col(text_col)).alias("text"))
               .repartitionByRange("id")
               .sortWithinPartitions("id", F.xxhash64("text")))
    (ordered.mapInArrow(rows, "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, raw in zip(b.column(0).to_pylist(), b.column(1)):
                file, out = PackedFile(raw.as_py()), []
                for block in range(len(file.offsets)):
                    ids = memoryview(file.block_ids(block)).cast("B")
                    table = file.docs(block)
                    edges = [0, *(table["at"].astype(int) * 4).tolist(), len(ids)]
                    if out:  # the first ids may belong to the document before
                        out[-1][3] += edges[1] // 4
                        out[-1][4] = zlib.crc32(ids[:edges[1]], out[-1][4])
                    for (doc, at, null), a, z in zip(table.tolist(), edges[1:], edges[2:]):
                        out.append([None if null else doc, number, block * BLOCK + at, (z - a) // 4,
                                    zlib.crc32(ids[a:z])])
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 ["doc_id", "file", "at", "n_tokens", "ids_crc32"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content"))
    docs = files.mapInArrow(rows, "doc_id long, file long, at long, n_tokens long, ids_crc32 long")
    # one row per file: how many ids lie in the files before it
    sums = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    base = sums.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    return docs.join(base, "file").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_file_round_trip(docs: DataFrame, tokenizer: str, path: str | None = None, **kwargs) -> DataFrame:
    """Write the files (to ``path``, else into the shared folder) and read them back."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, **kwargs)
    return read_token_files(spark, path)
