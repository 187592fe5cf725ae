"""Token-id files: fixed-size blocks, transposed into bit or byte planes, each zstd-compressed.

A file is the magic word, the compressed planes of all blocks, the chunk index and a trailer. The
index has for each block the place of its first plane, the number of ids and the compressed size
of each plane; the trailer has the place of the index and the magic word. All numbers are
little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, open_folder, read, scratch_path, write_through
from vintara.llm.tokens import word_encoder

MAGIC = b"BPLANE01"
BLOCK_IDS = 65_536
LEVEL = 3
MANIFEST = "doc_id long, part int, file string, first long, n_tokens long"


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of 32-bit ids, least significant first: 32 bit planes or 4 byte planes."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [octets[:, k].tobytes() for k in range(4)]
    cells = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(cells[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        cells = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        octets = np.packbits(np.stack(cells, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes ids to one file, a block at a time."""

    def __init__(self, stream, bits: bool = False, block_ids: int = BLOCK_IDS):
        self._stream, self._bits, self._block_ids = stream, bits, block_ids
        self._compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self._index: list[tuple[int, int, list[int]]] = []
        self._at = stream.write(MAGIC) or len(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids)
        self._n_held += len(ids)
        if self._n_held >= self._block_ids:
            ready = np.concatenate(self._held)
            whole = len(ready) // self._block_ids * self._block_ids
            for first in range(0, whole, self._block_ids):
                self._block(ready[first : first + self._block_ids])
            self._held, self._n_held = [ready[whole:]], len(ready) - whole

    def close(self) -> None:
        if self._n_held:
            self._block(np.concatenate(self._held))
        planes = 32 if self._bits else 4
        rows = b"".join(struct.pack(f"<QI{planes}I", at, n, *sizes) for at, n, sizes in self._index)
        self._stream.write(rows)
        self._stream.write(struct.pack("<QIII", self._at, len(self._index), planes, self._block_ids) + MAGIC)
        self._stream.close()

    def _block(self, ids: np.ndarray) -> None:
        parts = [self._compress(p) for p in to_planes(ids, self._bits)]
        self._index.append((self._at, len(ids), [len(p) for p in parts]))
        self._stream.write(b"".join(parts))
        self._at += sum(map(len, parts))


class PlaneReader:
    """Reads any run of ids of a file; the block read last is kept."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self._file = files.open_input_file(path)
        size = self._file.size()
        trailer = self._file.read_at(28, size - 28)
        index_at, n_blocks, planes, self._block_ids = struct.unpack("<QIII", trailer[:20])
        if trailer[20:] != MAGIC:
            raise ValueError(f"{path} is no id file")
        row = struct.Struct(f"<QI{planes}I")
        index = self._file.read_at(row.size * n_blocks, index_at)
        self._index = [row.unpack_from(index, k * row.size) for k in range(n_blocks)]
        self._decompress = zstandard.ZstdDecompressor().decompress
        self._kept: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def ids(self, first: int, n: int) -> np.ndarray:
        parts = []
        while n:
            k, skip = divmod(first, self._block_ids)
            part = self._block(k)[skip : skip + n]
            parts.append(part)
            first, n = first + len(part), n - len(part)
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def _block(self, k: int) -> np.ndarray:
        if self._kept[0] != k:
            at, n, *sizes = self._index[k]
            raw, planes = self._file.read_at(sum(sizes), at), []
            for size in sizes:
                planes.append(self._decompress(raw[:size]))
                raw = raw[size:]
            self._kept = (k, from_planes(planes, n))
        return self._kept[1]

    def close(self) -> None:
        self._file.close()


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int, bits: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the ids in ascending doc_id order, a file per task.

    Returns the manifest: for each document the file, the place of its first id in that file and
    its number of ids, ``end_id`` included. A repeated task writes a file of its own name, and the
    manifest names files of finished tasks only. Texts are dealt to tasks by range of doc_id, so a
    text is shuffled once and ids never. Order of equal doc_ids: by hash of the text; null doc_ids come first;
    a null or empty text has the end id only.
    """

    def write(batches: Iterator[Columns]) -> Iterator[Columns]:
        encoder, part = word_encoder(vocabulary), TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.bpl"
        writer, first = None, 0
        for batch in batches:
            if writer is None:
                files, path = open_folder(folder)
                files.create_dir(path, recursive=True)
                writer = PlaneWriter(files.open_output_stream(f"{path}/{name}", compression=None), bits)
            counts = []
            for found in encoder.encode(batch["text"]):
                ids = np.append(np.frombuffer(found, "<u4"), np.uint32(end_id))
                writer.add(ids)
                counts.append(len(ids))
            ends = first + np.cumsum(counts)
            yield {
                "doc_id": batch["doc_id"], "part": [part] * len(counts), "file": [name] * len(counts),
                "first": (ends - counts).tolist(), "n_tokens": counts,
            }
            first = int(ends[-1])
        if writer is not None:
            writer.close()

    # The hash parts equal doc_ids, without texts among the sampled range keys.
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return map_batches(ordered, write, MANIFEST)


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Manifest rows with the ids of each document as read from the files (``ids`` binary)."""

    def fetch(batches: Iterator[Columns]) -> Iterator[Columns]:
        files, path = open_folder(folder)
        reader, name = None, None
        for batch in batches:
            found = []
            for file, first, n in zip(batch["file"], batch["first"], batch["n_tokens"], strict=True):
                if file != name:
                    if reader is not None:
                        reader.close()
                    reader, name = PlaneReader(files, f"{path}/{file}"), file
                found.append(reader.ids(first, n).tobytes())
            yield {**batch, "ids": found}

    # As many tasks as files: rows of the manifest are too small for Spark to tell.
    n_files = manifest.agg(F.count_distinct("file")).first()[0]
    by_file = manifest.repartitionByRange(max(1, n_files), "part", "first").sortWithinPartitions("part", "first")
    return map_batches(by_file, fetch, MANIFEST + ", ids binary")


def with_start(df: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before, from the ids of each file (a row for each)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = df.groupBy("part").agg(F.sum("n_tokens").alias("in_file")).select(
        "part", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("file_start")
    )
    return df.join(files, "part").withColumn("start", F.col("file_start") + F.col("first"))


def op4_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    folder = scratch_path(spark, "ids")
    write_ids(docs, f"{folder}/files", "byte_bpe_50k.json", end_id=2).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def digest(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            ids = batch.pop("ids")
            yield {**batch, "n_tokens": [len(x) // 4 for x in ids], "ids_crc32": [zlib.crc32(x) for x in ids]}

    # Stored, as the rows are used twice: the files are read back once.
    back = write_through(map_batches(read_ids(manifest, f"{folder}/files"), digest, MANIFEST + ", ids_crc32 long"), "ids-back")
    return with_start(back).select("doc_id", "start", "n_tokens", "ids_crc32")
