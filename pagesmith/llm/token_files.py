"""Token-id files by bit planes.

Ids are written in blocks of ``CHUNK``. A block is transposed into byte planes (or bit planes), so that
what changes seldom lies together; each plane is compressed with zstandard, planes of zeros take no
space. A file ends with its index: documents, and of every block its place, ids, width and planes.

Documents are dealt by ranges of their id, so files and the documents in them are in ascending order.
Files lie in the shared folder. A task's files have names of their own and count only when the task's
row in the table of files is committed, so a repeated task leaves no double. Null ids come first, a
null text is an empty one, repeated rows are written one after the other (dealt over tasks if there are
very many), extra columns are ignored, no documents give no rows."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagesmith.cluster import cut_lineage, shared_folder
from pagesmith.llm.common import Rows, clean, dealt_by_file, rows_of
from pagesmith.llm.encode import encoder, groups

CHUNK, FILE_IDS = 1 << 16, 1 << 24
MAGIC = b"IDPLANE1"


def to_planes(ids: np.ndarray, bits: bool = True) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, from the lowest on; those above the highest used are left out."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    width = -(-int(ids.max()).bit_length() // 8) if len(ids) else 0
    used = raw[:, :width]
    if bits:
        planes = np.packbits(np.unpackbits(used, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(used.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool = True) -> np.ndarray:
    size = -(-n // 8) if bits else n
    rows = np.zeros((len(planes), size), np.uint8)
    for row, plane in zip(rows, planes, strict=True):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    out = np.zeros((n, 4), np.uint8)
    if bits and len(planes):
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
        out[:, : rows.shape[1]] = rows
    elif len(planes):
        out[:, : len(planes)] = rows.T
    return out.view("<u4").reshape(-1).astype(np.uint32)


class PlaneWriter:
    """Writes one file to an open stream."""

    def __init__(self, sink, bits: bool = True, chunk: int = CHUNK, level: int = 3):
        self.sink, self.bits, self.chunk = sink, bits, chunk
        self.pack = zstandard.ZstdCompressor(level=level)
        self.waiting, self.held, self.at, self.n_ids = [], 0, 0, 0
        self.index, self.keys, self.sizes = [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.pack.compress(p) if p else b"" for p in to_planes(ids, self.bits)]
        self.index.append((self.at, len(ids), *map(len, planes)))
        for plane in planes:
            self._put(plane)

    def add(self, key: int, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.chunk:
            whole = np.concatenate(self.waiting)
            full = len(whole) - len(whole) % self.chunk
            for i in range(0, full, self.chunk):
                self._block(whole[i : i + self.chunk])
            self.waiting, self.held = [whole[full:]], len(whole) - full

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        tables = [self.pack.compress(np.array(x, "<i8").tobytes()) for x in (self.keys, self.sizes)]
        start = self.at
        for table in tables:
            self._put(table)
        head = {"bits": self.bits, "blocks": self.index, "tables": [start, *map(len, tables)]}
        data = self.pack.compress(json.dumps(head).encode())
        self._put(data)
        self._put(struct.pack("<Q", len(data)) + MAGIC)
        self.sink.close()


class PlaneReader:
    """Reads a file's index, then any of its blocks or all documents in order."""

    def __init__(self, source):
        self.source, self.unpack = source, zstandard.ZstdDecompressor()
        size = source.size()
        tail = self._bytes(size - 16, 16)
        if tail[8:] != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of id planes, or a broken one")
        (length,) = struct.unpack("<Q", tail[:8])
        head = json.loads(self.unpack.decompress(self._bytes(size - 16 - length, length)))
        self.bits, self.blocks = head["bits"], head["blocks"]
        start, keys, sizes = head["tables"]
        self.keys = np.frombuffer(self.unpack.decompress(self._bytes(start, keys)), "<i8")
        self.sizes = np.frombuffer(self.unpack.decompress(self._bytes(start + keys, sizes)), "<i8")

    def _bytes(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, i: int) -> np.ndarray:
        at, n, *sizes = self.blocks[i]
        data, planes = self._bytes(at, sum(sizes)), []
        for size in sizes:
            planes.append(self.unpack.decompress(data[:size]) if size else b"")
            data = data[size:]
        return from_planes(planes, n, self.bits)

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        i, held = 0, np.zeros(0, np.uint32)
        for key, size in zip(self.keys.tolist(), self.sizes.tolist(), strict=True):
            parts, have = [held], len(held)
            while have < size:
                parts.append(self.block(i))
                have, i = have + len(parts[-1]), i + 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield key, held[:size]
            held = held[size:]


def _write(folder: str, path: str, end_id: int, bits: bool, file_ids: int):
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = fs.FileSystem.from_uri(folder)
        encode, end = encoder(path), np.array([end_id], np.uint32)
        part, attempt, out, writer, number = TaskContext.get().partitionId(), uuid.uuid4().hex, Rows(schema), None, 0

        def name():
            return f"{part:06d}-{number:05d}-{attempt}.ids"

        def finish():
            writer.close()
            out.add(part, number, name(), len(writer.keys), writer.n_ids)

        for batch in batches:
            keys, texts = batch.column("_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in groups(texts):
                for key, ids in zip(keys[a:b], encode.encode(texts[a:b]), strict=True):
                    if writer is None:
                        place.create_dir(base, recursive=True)
                        writer = PlaneWriter(place.open_output_stream(f"{base}/{name()}"), bits)
                    writer.add(key, np.concatenate([ids, end]))
                    if writer.n_ids >= file_ids:
                        finish()
                        writer, number = None, number + 1
        if writer is not None:
            finish()
        yield from out.rest()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, bits: bool = False,
                      file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents; returns the table of files in order: ``part, number, file, n_docs, n_ids, start``."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"), F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange("_id", "_hash", "_row").sortWithinPartitions("_id", "_hash", "_row")
    files = cut_lineage(dealt.select("_id", "text").mapInArrow(
        _write(folder, tokenizer_path, end_id, bits, file_ids),
        "part int, number int, file string, n_docs long, n_ids long"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(folder: str):
    schema = pa.schema([("_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = fs.FileSystem.from_uri(folder)
        out = Rows(schema)
        for name, start in rows_of(batches, "file", "start"):
            with place.open_input_file(f"{base}/{name}") as source:
                for key, ids in PlaneReader(source).documents():
                    if out.add(key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())):
                        yield out.take()
                    start += len(ids)
        yield from out.rest()

    return run


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    dealt = dealt_by_file(files.select("file", "start"), files.count())
    rows = dealt.mapInArrow(_read(folder), "_id long, start long, n_tokens long, ids_crc32 long")
    return rows.select(clean(F.col("_id")).alias("doc_id"), "start", "n_tokens", "ids_crc32")


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the documents' ids below the shared folder and give back what the files hold."""
    folder = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id), folder)
