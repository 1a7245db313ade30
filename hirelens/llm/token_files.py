"""Token ids in binary files that can be read in parts.

A file is a row of independent zstandard frames, each the ids (little-endian unsigned 32-bit) of
some consecutive documents, and behind them one skippable frame, which any zstandard reader passes
over, with the seek table: an entry per frame (offset, compressed size, ids, documents, checksum),
the key and the number of ids of every document, a checksum of the table and its size. A reader
takes the table from the end of the file and decompresses the frames of the documents it is asked for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.llm.common import blocks, checkpoints, stored
from hirelens.llm.token_ids import BLOCK_BYTES, encoder
from hirelens.session import new_path

SKIPPABLE = 0x184D2A5E  # fixed value: zstandard's magic number of a skippable frame
MAGIC = b"HLTOKEN1"
TAIL = struct.Struct("<QII8s")  # table bytes, frames, crc32 of the table, magic
FRAME = np.dtype(
    [("offset", "<u8"), ("size", "<u8"), ("ids", "<u8"), ("docs", "<u8"), ("checksum", "<u8")]
)
DOC = np.dtype([("key", "<i8"), ("known", "u1"), ("ids", "<u8")])
FRAME_BYTES = 1 << 20  # ids of a frame before compression; a longer document makes one frame


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


class Writer:
    """Writes one file under a name of its own and moves it into place when it is whole."""

    def __init__(self, folder: str, name: str):
        self.system, base = file_system(folder)
        self.final, self.temporary = f"{base}/{name}", f"{base}/.{name}-{uuid4().hex}"
        self.out = self.system.open_output_stream(self.temporary)
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.frames, self.docs, self.held, self.size, self.offset = [], [], [], 0, 0
        self.pending = 0

    def add(self, key: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > FRAME_BYTES:
            self.flush()
        self.held.append(ids)
        self.size += len(ids)
        self.pending += 1
        self.docs.append((key or 0, key is not None, len(ids) // 4))

    def flush(self) -> None:
        raw = b"".join(self.held)
        frame = self.compressor.compress(raw)
        self.out.write(frame)
        self.frames.append(
            (self.offset, len(frame), len(raw) // 4, self.pending, xxhash.xxh64_intdigest(raw))
        )
        self.offset += len(frame)
        self.held, self.size, self.pending = [], 0, 0

    def close(self) -> None:
        if self.pending:
            self.flush()
        table = np.array(self.frames, FRAME).tobytes() + np.array(self.docs, DOC).tobytes()
        tail = TAIL.pack(len(table), len(self.frames), zlib.crc32(table), MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(tail)) + table + tail)
        self.out.close()
        self.system.move(self.temporary, self.final)


class Reader:
    """Documents of one file; only the frames that hold them are read."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        end = self.file.size()
        size, frames, crc, magic = TAIL.unpack(self.file.read_at(TAIL.size, end - TAIL.size))
        table = self.file.read_at(size, end - TAIL.size - size)
        if magic != MAGIC or zlib.crc32(table) != crc:
            raise ValueError(f"{uri}: seek table is damaged")
        self.frames = np.frombuffer(table, FRAME, frames)
        self.docs = np.frombuffer(table, DOC, offset=frames * FRAME.itemsize)

    def frame(self, n: int) -> bytes:
        entry = self.frames[n]
        packed = self.file.read_at(int(entry["size"]), int(entry["offset"]))
        raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=4 * int(entry["ids"]))
        if xxhash.xxh64_intdigest(raw) != int(entry["checksum"]):
            raise ValueError(f"frame {n} is damaged")
        return raw

    def read(self, places: Iterable[int] | None = None) -> Iterator[tuple[int, int | None, int, bytes]]:
        """``place, key, ids before it in the file, ids``; of all documents or those asked for."""
        starts = np.concatenate(([0], np.cumsum(self.docs["ids"], dtype=np.int64)))
        firsts = np.concatenate(([0], np.cumsum(self.frames["docs"], dtype=np.int64)))
        asked = range(len(self.docs)) if places is None else sorted(set(places))
        current, raw = -1, b""
        for at in asked:
            n = int(np.searchsorted(firsts, at, "right")) - 1
            if n != current:
                current, raw = n, self.frame(n)
            low, high = (4 * int(x - starts[firsts[n]]) for x in (starts[at], starts[at + 1]))
            key = int(self.docs["key"][at]) if self.docs["known"][at] else None
            yield at, key, int(starts[at]), raw[low:high]


def write_files(
    df: DataFrame, key: str, text: str, content: str, folder: str, end: int = 1
) -> DataFrame:
    """Write all documents of ``df`` in ascending order of ``key``; returns ``part, file, docs, n_ids, start``.

    ``folder`` is a URI that all executors reach. Rows without a key come first; rows that share a
    key follow each other by the hash of their text. A null text is the end id alone. A repeated
    task writes the same file again and moves it over the first. ``start`` counts the ids in the
    files before. An empty table writes no file.
    """
    spark = df.sparkSession
    checkpoints(spark)
    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    last = end.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(content).encode, TaskContext.get().partitionId()
        name, writer, docs, ids = f"part-{part:06d}.tok", None, 0, 0
        for block in blocks(batches, "text", BLOCK_BYTES):
            writer = writer or Writer(folder, name)
            keys = block.column("key").to_pylist()
            for k, found in zip(keys, encode(block.column("text"))):
                writer.add(k, found + last)
                docs, ids = docs + 1, ids + len(found) // 4 + 1
        if writer:
            writer.close()
            columns = [pa.array([x]) for x in (part, f"{folder}/{name}", docs, ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "file", "docs", "n_ids"])

    rows = df.select(
        F.col(key).cast("bigint").alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("tie"),
    )
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")
    written = stored(
        ordered.mapInArrow(run, "part bigint, file string, docs bigint, n_ids bigint"), "files"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``key, start, ids`` of every document, from the files that ``write_files`` told of."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(*(batch.column(c).to_pylist() for c in ("file", "start"))):
                held, size = [], 0
                for _, key, before, ids in Reader(file).read():
                    held.append((key, start + before, ids))
                    size += len(ids)
                    if size > 4_000_000:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        key, start, ids = zip(*rows)
        columns = [pa.array(key, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "start", "ids"])

    many = max(1, files.count())
    one_each = files.select("file", "start", "part").repartitionByRange(many, "part")
    return one_each.select("file", "start").mapInArrow(run, "key bigint, start bigint, ids binary")


def new_folder(spark: SparkSession) -> str:
    """A URI for a new folder below the shared one."""
    path = new_path(spark, "tokens")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
