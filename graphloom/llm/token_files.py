"""Token ids in independent zstandard frames with a trailing seek table.

File format (the public seekable-zstandard layout):

* one frame per document, holding its ids as little-endian unsigned 32-bit integers;
* one last frame, the directory: a byte per document (1: null id), then int64 doc ids;
* a skippable frame, the seek table: for each frame its compressed size, decompressed
  size and the low 32 bits of the XXH64 of its decompressed bytes, then the footer.

A reader takes the table from the file's tail and decompresses only requested frames.

Rows: null texts are empty documents (the end id alone); repeated doc ids are separate
documents, in the order of their texts; null doc ids come first; other columns of the
input are ignored, so their names cannot clash; an empty table gives no file.
Recovery: a task writes a file of its own attempt's name and the manifest names only
the files of tasks that succeeded, so retries and speculation leave readers unharmed.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from graphloom.llm.common import shared_dir, small_batches, whole_text, written
from graphloom.llm.tokens import DEFAULT_VOCABULARY, encoder

#: Fixed values of the seekable format: skippable magic, footer magic, checksum flag.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
_FOOTER = struct.Struct("<IBI")
_ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])


class FrameWriter:
    """Appends frames to an open binary stream and ends with the seek table."""

    def __init__(self, out, level: int = 1):
        import zstandard

        self.out, self.entries = out, []
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=True)

    def add(self, plain: bytes) -> None:
        import xxhash

        packed = self.packer.compress(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def close(self) -> None:
        body = np.array(self.entries, _ENTRY).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body) + _FOOTER.size))
        self.out.write(body)
        self.out.write(_FOOTER.pack(len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC))


class FrameReader:
    """Random access to the frames of a seekable file (``seek``/``read`` and its size)."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        if size < _FOOTER.size + 8:
            raise ValueError("too short for a seek table")
        source.seek(size - _FOOTER.size)
        n, flags, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end")
        length = n * _ENTRY.itemsize
        source.seek(size - _FOOTER.size - length - 8)
        head = struct.unpack("<II", source.read(8))
        if head != (SKIPPABLE_MAGIC, length + _FOOTER.size):
            raise ValueError("damaged seek table")
        self.entries = np.frombuffer(source.read(length), _ENTRY)
        self.starts = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))

    def frame(self, k: int) -> bytes:
        """The checked bytes of frame ``k``; nothing else is decompressed."""
        import xxhash

        entry = self.entries[k]
        self.source.seek(int(self.starts[k]))
        plain = self.unpacker.decompress(self.source.read(int(entry["packed"])), max_output_size=int(entry["plain"]) or 1)
        if len(plain) != entry["plain"] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"frame {k} fails its checksum")
        return plain

    def doc_ids(self) -> list[int | None]:
        n = len(self.entries) - 1
        raw = self.frame(n)
        return [None if null else int(v) for null, v in zip(raw[:n], np.frombuffer(raw, "<i8", n, n))]


MANIFEST = "part int, file string, bytes long, docs long, ids long"
READ = "part int, row int, doc_id long, n_tokens long, ids_crc32 long"


def write_files(docs: DataFrame, folder: str, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = 2, level: int = 1) -> DataFrame:
    """Write every document's ids in ascending doc_id order; returns the manifest (one row a file).

    Ranges are cut on (doc_id, a hash of the text), so a run of null or repeated ids
    is spread over partitions like any other.
    """
    small_batches(docs.sparkSession, 2048)
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
        enc, end = encoder(vocabulary), struct.pack("<I", end_id)
        ids, nulls, total, writer, out = [], [], 0, None, None
        for batch in batches:
            if writer is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
                writer = FrameWriter(out, level)
            for doc_id, body in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                writer.add(body + end)
                total += len(body) // 4 + 1
                ids.append(doc_id or 0)
                nulls.append(doc_id is None)
        if writer is None:
            return
        writer.add(bytes(nulls) + np.array(ids, "<i8").tobytes())
        writer.close()
        size = out.tell()
        out.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "bytes": size, "docs": len(ids), "ids": total}], pa.schema([("part", pa.int32()), ("file", pa.string()), ("bytes", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())]))

    return written(ranged.mapInArrow(write, MANIFEST), "token-manifest")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files alone: their order, length and checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for part, name, size in zip(*(batch.column(k).to_pylist() for k in range(3))):
                with fs.open_input_file(f"{root}/{name}") as source:
                    reader = FrameReader(source, size)
                    doc_ids = reader.doc_ids()
                    for at in range(0, len(doc_ids), 4096):
                        frames = [reader.frame(k) for k in range(at, min(at + 4096, len(doc_ids)))]
                        n = len(frames)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([part] * n, pa.int32()),
                                pa.array(range(at, at + n), pa.int32()),
                                pa.array(doc_ids[at : at + n], pa.int64()),
                                pa.array([len(x) // 4 for x in frames], pa.int64()),
                                pa.array([zlib.crc32(x) for x in frames], pa.int64()),
                            ],
                            ["part", "row", "doc_id", "n_tokens", "ids_crc32"],
                        )

    files = manifest.select("part", "file", "bytes")
    # One task per few files: the manifest is tiny, the work behind a row is not.
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "file").mapInArrow(read, READ)


def token_files(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = 2) -> DataFrame:
    """Write, read back, and number: doc_id, start, n_tokens, ids_crc32, file part and row.

    ``start`` is a two-level prefix sum: over the files by the manifest (a row a file),
    over the documents of one file by a window whose groups are single files.
    """
    folder = shared_dir(docs.sparkSession, "token-files")
    manifest = write_files(docs, folder, vocabulary, end_id)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = read_files(manifest, folder).withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "part", "row")
