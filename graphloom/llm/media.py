"""PNG media columns: encode, checked decode with numpy unfiltering, low-frequency hashes.

``png_encode`` writes 8-bit greyscale images of fixed width; ``png_decode`` accepts any
non-interlaced 8-bit greyscale PNG, tests every chunk's CRC and undoes the five row
filters.  ``cosine_hash`` is a 64-bit perceptual hash: the image's 32x32 block means, a
two-dimensional cosine transform, the signs of the lowest 8x8 coefficients about their
median (a tie with the median counts as below).  Empty and null texts become one zero row;
equal texts give equal bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from graphloom.llm.common import small_batches, whole_text, written

#: Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def filtered(samples: np.ndarray) -> np.ndarray:
    """Each row led by its filter: of none, sub and up the one that leaves fewest distinct values, the first on ties.

    Few values are what deflate codes shortly; the usual least sum of residuals suits
    gradients and makes text a half longer.  Runs of one sign, repeats of the row above
    and padding are filtered so, other text is mostly left.
    """
    height, width = samples.shape
    tried = np.empty((3, height, width), np.uint8)
    tried[:] = samples
    tried[1, :, 1:] -= samples[:, :-1]
    tried[2, 1:] -= samples[:-1]
    distinct = (np.diff(np.sort(tried, axis=2), axis=2) != 0).sum(axis=2)
    kinds = distinct.argmin(axis=0).astype(np.uint8)
    return np.concatenate([kinds[:, None], tried[kinds, np.arange(height)]], axis=1)


def png_encode(samples: np.ndarray, level: int = 6) -> bytes:
    """A height x width uint8 array as a greyscale PNG."""
    height, width = samples.shape
    rows = filtered(samples)
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows, level)) + _chunk(b"IEND", b"")


def png_decode(data: bytes) -> np.ndarray:
    """The samples of a PNG; raises ValueError on a bad signature, checksum or layout."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, header, packed, ended = 8, None, [], False
    while at < len(data) and not ended:
        (length,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + length]
        check = data[at + 8 + length : at + 12 + length]
        if len(check) != 4 or struct.unpack(">I", check)[0] != zlib.crc32(kind + body):
            raise ValueError(f"chunk {kind!r} fails its checksum")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + length
    if header is None or not ended or header[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only whole, non-interlaced 8-bit greyscale images are read")
    width, height = header[:2]
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    if raw.size != height * (width + 1):
        raise ValueError("the image data has another size than the header says")
    rows = raw.reshape(height, width + 1)
    return unfilter(rows[:, 0], rows[:, 1:])


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo the row filters (0 none, 1 sub, 2 up, 3 average, 4 Paeth) of 1-byte samples.

    Runs of rows of one kind are undone together where the filter is a sum: none is a
    copy, sub a running sum along the row, up a running sum down the run.
    """
    out = np.empty(rows.shape, np.uint8)
    cuts = np.flatnonzero(np.diff(kinds)) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)]):
        kind, block = int(kinds[first]), rows[first:last]
        above = out[first - 1] if first else np.zeros(rows.shape[1], np.uint8)
        if kind == 0:
            out[first:last] = block
        elif kind == 1:
            out[first:last] = np.cumsum(block, axis=1, dtype=np.uint8)
        elif kind == 2:
            out[first:last] = np.cumsum(np.vstack([above[None], block]), axis=0, dtype=np.uint8)[1:]
        elif kind in (3, 4):
            for k in range(first, last):
                out[k] = _by_neighbours(kind, rows[k].tolist(), above.tolist())
                above = out[k]
        else:
            raise ValueError(f"unknown row filter {kind}")
    return out


def _by_neighbours(kind: int, row: list[int], above: list[int]) -> list[int]:
    done, left, corner = [], 0, 0
    for value, up in zip(row, above):
        if kind == 3:
            guess = (left + up) >> 1
        else:
            to_left, to_up, to_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
            guess = left if to_left <= to_up and to_left <= to_corner else up if to_up <= to_corner else corner
        left = (value + guess) & 255
        corner = up
        done.append(left)
    return done


def _basis(n: int, low: int) -> np.ndarray:
    return np.cos(np.pi * np.outer(np.arange(low), 2 * np.arange(n) + 1) / (2 * n))


_BASIS = _basis(32, 8)


def _block_means(x: np.ndarray, n: int = 32) -> np.ndarray:
    """n x n means; sides shorter than n repeat rows or columns."""
    for axis in (0, 1):
        size = x.shape[axis]
        edges = np.arange(n + 1) * size // n
        if size < n:
            x = x.take(edges[:-1], axis=axis).astype(np.float64)
        else:
            widths = np.expand_dims(np.diff(edges), 1 - axis)
            x = np.add.reduceat(x, edges[:-1], axis=axis, dtype=np.float64) / widths
    return x


def cosine_hash(samples: np.ndarray) -> bytes:
    """Eight bytes: signs of the low-frequency cosine coefficients about their median."""
    low = (_BASIS @ _block_means(samples) @ _BASIS.T).ravel()
    low[0] = np.median(low[1:])  # the mean brightness says nothing of the content
    return np.packbits(np.round(low, 6) > round(float(np.median(low[1:])), 6)).tobytes()


def samples_of(payload: bytes, width: int = WIDTH) -> np.ndarray:
    """Bytes padded with zeros to a positive multiple of ``width``, as rows of that width."""
    height = max(1, -(-len(payload) // width))
    out = np.zeros(height * width, np.uint8)
    out[: len(payload)] = np.frombuffer(payload, np.uint8)
    return out.reshape(height, width)


MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, phash binary"


def media_table(docs: DataFrame, level: int = 6) -> DataFrame:
    """Each whole text stored as a PNG in a binary column (doc_id, n_bytes, media).

    Null texts are empty; repeated rows stay; columns other than doc_id and text are
    not read; an empty table stays empty.  The result is a written table.
    """
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.encode("utf-8") for x in batch.column(1).to_pylist()]
            images = [png_encode(samples_of(x), level) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(images, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return written(rows.mapInArrow(encode, MEDIA), "media")


def media_features(media: DataFrame) -> DataFrame:
    """Decode each stored image with its checks and digest what came back."""
    small_batches(media.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column(2).to_pylist()
            images = [png_decode(x) for x in stored]
            payloads = [x.tobytes() for x in images]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(map(len, payloads), pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in payloads]),
                    pa.array([zlib.crc32(x[-64:]) for x in payloads], pa.int64()),
                    pa.array(map(len, stored), pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in stored]),
                    pa.array(map(cosine_hash, images), pa.binary()),
                ],
                [x.split()[0] for x in FEATURES.split(", ")],
            )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(decode, FEATURES)
