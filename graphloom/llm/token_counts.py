"""Token counts of flat, unindexed token files by a scan for end-of-document ids.

A flat file is nothing but ids of two or four bytes.  It is cut into blocks of equal
size regardless of documents; each block is one ranged read in which the end ids are
found by one vectorised comparison.  A document's start is the last end id of any
earlier block of its file, so a prefix scan over the (small) block rows stitches what
the cuts tore apart: the running count of end ids numbers the documents, the running
maximum of their positions gives each block's first document its start.

Ids after a file's last end id form a document with ``terminated`` false; a file of no
ids gives no row.  ``write_flat`` encodes the end marker's string within a text as text,
since its id there would end a document that goes on.  An empty table gives no row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from graphloom.llm.common import shared_dir, small_batches, whole_text, written
from graphloom.llm.tokens import DEFAULT_VOCABULARY, encoder

END_ID = 50256
BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, folder: str, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = END_ID, dtype: str = "<u2") -> DataFrame:
    """Append every document's ids and the end id to one flat file a task.

    Returns (file, bytes, ordinals -> doc ids): ``file string, bytes long, at long,
    doc_id long`` with a row per document, ``at`` its place in the file, and written.
    Null texts count as empty; repeated rows are documents of their own; columns other
    than doc_id and text are not read.
    """
    small_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"flat-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        fs, root = pafs.FileSystem.from_uri(folder)
        enc, end, out, at = encoder(vocabulary, dtype, markers_as_text=True), np.array([end_id], dtype).tobytes(), None, 0
        for batch in batches:
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            out.write(b"".join([x + end for x in enc.encode(batch.column(1))]))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(at, at + n), pa.int64()), batch.column(0)], ["file", "at", "doc_id"])
            at += n
        if out is not None:
            out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return written(rows.mapInArrow(write, "file string, at long, doc_id long"), "flat-index")


def scan_flat(files: DataFrame, folder: str, end_id: int = END_ID, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents of flat files (column ``file``): file, at, start, n_tokens, terminated.

    ``n_tokens`` leaves the end id out; ``start`` counts ids from the file's beginning.
    """
    width = np.dtype(dtype).itemsize

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [fs.get_file_info(f"{root}/{name}").size for name in names]
            if any(x % width for x in found):
                raise ValueError("a flat file ends within an id")
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([x // width for x in found], pa.int64())], ["file", "ids"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as source:
                    ids = np.frombuffer(source.read_at(block_ids * width, start * width), dtype)
                ends = np.flatnonzero(ids == end_id) + start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]),
                        pa.array([start], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                        pa.array([len(ends)], pa.int64()),
                        pa.array([int(ends[-1]) + 1 if len(ends) else None], pa.int64()),
                    ],
                    ["file", "start", "n", "ends", "n_ends", "last_end"],
                )

    spread = files.sparkSession.sparkContext.defaultParallelism * 4
    blocks = (
        files.select("file")
        .repartition(spread, "file")
        .mapInArrow(sizes, "file string, ids long")
        .where("ids > 0")
        .select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ids") - 1, F.lit(block_ids).cast("long"))).alias("start"))
        .repartition(spread, "file", "start")
        .mapInArrow(scan, "file string, start long, n long, ends array<long>, n_ends long, last_end long")
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stitched = blocks.select(
        "file",
        F.col("start").alias("block"),
        "n",
        "ends",
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last_end").over(earlier), F.lit(0)).alias("carry"),
        F.lead("start").over(Window.partitionBy("file").orderBy("start")).isNull().alias("final"),
    )
    docs = stitched.select("file", "before", "carry", "ends", F.posexplode("ends").alias("k", "end")).select(
        "file",
        (F.col("before") + F.col("k")).alias("at"),
        F.when(F.col("k") == 0, F.col("carry")).otherwise(F.try_element_at("ends", F.greatest(F.col("k"), F.lit(1))) + 1).alias("start"),
        F.col("end"),
        F.lit(True).alias("terminated"),
    )
    last = F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("carry"))
    tail = stitched.where("final").select(
        "file",
        (F.col("before") + F.size("ends")).alias("at"),
        F.when(F.size("ends") > 0, last).otherwise(F.col("carry")).alias("start"),
        (F.col("block") + F.col("n")).alias("end"),
        F.lit(False).alias("terminated"),
    )
    tail = tail.where("end > start")
    return docs.unionByName(tail).select("file", "at", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "terminated")


def token_counts(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Counts of every document of a table by way of flat files: doc_id, n_tokens, file, at, start."""
    folder = shared_dir(docs.sparkSession, "flat")
    index = write_flat(docs, folder, vocabulary, end_id)
    counts = scan_flat(index.where("at = 0").select("file"), folder, end_id)
    # Sizes are guessed from the list of files, so the join is told to shuffle both sides.
    return index.join(counts.hint("merge"), ["file", "at"]).select("doc_id", "n_tokens", "file", "at", "start")
