"""Removal of long repeated byte strings by run-compressed suffix indexes.

A byte goes if a string of ``LENGTH`` bytes over it also starts anywhere else.

1. Every window of ``LENGTH`` bytes is owned by its least-hashed ``KMER`` bytes (the
   seed, leftmost on ties), so equal windows have equal seeds at equal offsets.  The
   windows of one seed occurrence are consecutive: a segment.
2. Segments are counted by (seed, content).  Content met twice repeats whole; a seed met
   once repeats nowhere.  Only one example of each content of a seed with several
   contents is looked at: where copies begin to differ.
3. Examples are dealt to shards by seed.  A shard is indexed: suffix order, its
   Burrows-Wheeler transform cut to runs, samples at the runs' ends.  The match length
   of a sampled suffix with its neighbour in suffix order is measured; all others
   follow in one stream, as within a run each is the one before, less one.  A start
   whose match reaches ``LENGTH`` repeats.
4. A seed with more contents than ``HOT`` (a passage before many continuations) would
   outgrow a shard; its windows are counted by digest instead, fully spread.
5. Starts are put back to every occurrence, merged, and cut from the texts.

Null texts are empty; a text shorter than ``LENGTH`` loses nothing; copies of a text
lose all of it if it is long enough.  Repeated rows are copies.  Null doc ids stay
null.  Columns beside doc_id and text are not read; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from graphloom.llm.common import release, small_batches, whole_text, written
from graphloom.llm.near_dup import mix

LENGTH, KMER = 200, 32
SHARD_BYTES, HOT = 1 << 20, 4_000
#: Bytes of a text that are hashed at a time; a place within them takes 23 bits.
BLOCK = 1 << 22


def segments_of(text: bytes, length: int = LENGTH, kmer: int = KMER) -> list[tuple[int, int, int]]:
    """(first start, last start, seed) for each run of windows of one seed, in order."""
    out: list[tuple[int, int, int]] = []
    windows = len(text) - length + 1
    for base in range(0, max(0, windows), BLOCK):
        part = np.frombuffer(text[base : base + BLOCK + length - 1], np.uint8).astype(np.uint64)
        h, factor, size = part + np.uint64(1), np.array([0x9E3779B97F4A7C15], np.uint64), 1
        while size < kmer:  # the hash of twice the bytes from two of half
            h = h[: len(h) - size] * factor + h[size:]
            factor, size = factor * factor, size * 2
        h = mix(h)
        order = (h & np.uint64(0xFFFFFFFFFF800000)) | np.arange(len(h), dtype=np.uint64)
        reach, size = length - kmer + 1, 1
        while size * 2 <= reach:
            order = np.minimum(order[: len(order) - size], order[size:])
            size *= 2
        count = len(part) - length + 1
        order = np.minimum(order[:count], order[reach - size : reach - size + count])
        place = (order & np.uint64(0x7FFFFF)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate(([0], cuts))
        last = np.append(cuts - 1, count - 1)
        seeds = h[place[first]].view(np.int64)
        out += zip((first + base).tolist(), (last + base).tolist(), seeds.tolist())
    return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes; 0 ends a string, earlier ends sort first, so ranks are distinct.

    Prefix doubling from seven symbols on; only suffixes that are still tied are sorted.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, np.int64)])
    key, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(7):
        symbol = np.where(ended, 0, padded[k : k + n])
        key = (key << 9) | symbol
        ended |= symbol == 0
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = (key[order[1:]] != key[order[:-1]]) | ended[order[1:]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    reach = 7
    while True:
        single = fresh & np.append(fresh[1:], True)
        tied = np.flatnonzero(~single)
        if not len(tied):
            return rank
        which = order[tied]
        pair = (rank[which] << 32) | rank[np.minimum(which + reach, n - 1)]
        again = np.argsort(pair, kind="stable")
        order[tied] = which[again]
        pair = pair[again]
        fresh[tied[1:]] = fresh[tied[1:]] | (pair[1:] != pair[:-1])
        fresh[tied[0]] = True
        heads = np.where(fresh[tied], tied, 0)
        rank[order[tied]] = np.maximum.accumulate(heads)
        reach *= 2


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the strings from a and from b share before an end."""
    n = len(symbols)
    length = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    while len(active):
        x, y = a[active] + length[active], b[active] + length[active]
        ok = (np.maximum(x, y) < n) & (symbols[np.minimum(x, n - 1)] == symbols[np.minimum(y, n - 1)]) & (symbols[np.minimum(x, n - 1)] != 0)
        active = active[ok]
        length[active] += 1
    return length


def longest_matches(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the joined strings, its longest match elsewhere; and where each begins.

    The run-length index: neighbours in suffix order are compared only at the ends of
    the transform's runs, the rest is streamed in text order.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[begins + sizes] = 0
    rank = suffix_order(symbols)
    n = len(symbols)
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    before = symbols[suffixes - 1]
    before[np.isin(suffixes, begins)] = 0  # nothing precedes a string: always a run of its own
    cut = (before[1:] != before[:-1]) | (before[1:] == 0)
    best = np.zeros(n, np.int64)
    for edge, neighbour in ((np.flatnonzero(np.concatenate(([True], cut))), -1), (np.flatnonzero(np.append(cut, True)), 1)):
        inner = edge[(edge + neighbour >= 0) & (edge + neighbour < n)]
        sample = np.full(n, -1, np.int64)
        sample[suffixes[edge]] = 0
        sample[suffixes[inner]] = _common(symbols, suffixes[inner], suffixes[inner + neighbour])
        last = np.maximum.accumulate(np.where(sample >= 0, np.arange(n), 0))
        best = np.maximum(best, sample[last] - (np.arange(n) - last))
    return best, begins


def _keyed(docs: DataFrame) -> DataFrame:
    """n, tag, doc_id, text: a doc id (or a hash for null), and what tells texts of one id apart."""
    text = whole_text()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("n"),
        F.pmod(F.hash(text), F.lit(1 << 23)).alias("tag"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
    )


def _packed(docs: DataFrame) -> DataFrame:
    """n, tag, doc_id and the compressed bytes of the text: what a shuffle of whole texts carries."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["n", "tag", "doc_id", "packed"])

    return _keyed(docs).mapInArrow(run, "n long, tag int, doc_id long, packed binary")


def _place(row: str = "place") -> tuple:
    """Tag, span and start out of a segment's packed place."""
    place = F.col(row)
    return F.shiftright(place, 40).cast("int"), F.shiftright(place, 32).bitwiseAND(255).cast("int"), place.bitwiseAND(0xFFFFFFFF)


def segments(docs: DataFrame) -> DataFrame:
    """n, place (tag, span and start in one number), seed, content of every segment, as a written table."""
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows: list[tuple] = []
            for n, tag, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                data = text.encode("utf-8", "surrogatepass")
                for first, last, seed in segments_of(data):
                    rows.append((n, tag << 40 | last - first << 32 | first, seed, digest(data[first : last + LENGTH])))
            columns = list(zip(*rows)) if rows else [[]] * 4
            content = np.array(columns[3], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(content)], ["n", "place", "seed", "content"])

    rows = _keyed(docs).select("n", "tag", "text").mapInArrow(run, "n long, place long, seed long, content long")
    return written(rows, "segments")


def _examples(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``kept`` (n, place, seed, content, contents, many) with span and the bytes of its segments."""
    tag, span, start = _place()
    part = F.struct("seed", "content", "contents", "many", span.alias("span"), start.alias("start"))
    wanted = kept.select("n", tag.alias("tag"), part.alias("part")).groupBy("n", "tag").agg(F.collect_list("part").alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for packed, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = unpacker.decompress(packed)
                out = [{**p, "part": data[p["start"] : p["start"] + p["span"] + LENGTH]} for p in parts]
                yield pa.RecordBatch.from_pylist(out, pa.schema([("seed", pa.int64()), ("content", pa.int64()), ("contents", pa.int64()), ("many", pa.bool_()), ("span", pa.int32()), ("part", pa.binary())]))

    rows = _packed(docs).join(wanted, ["n", "tag"]).select("packed", "parts")
    return rows.mapInArrow(run, "seed long, content long, contents long, many boolean, span int, part binary")


def _by_index(examples: DataFrame, shards: int) -> DataFrame:
    """seed, content and the offsets of repeating starts, for contents met once."""

    def mark(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_pylist()
        best, begins = longest_matches(parts)
        out = []
        for seed, content, many, span, begin in zip(*(group.column(c).to_pylist() for c in ("seed", "content", "many", "span")), begins.tolist()):
            if not many:
                hits = np.flatnonzero(best[begin : begin + span + 1] >= LENGTH)
                if len(hits):
                    out.append((seed, content, hits.tolist()))
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int32()))], names=["seed", "content", "offsets"])

    # Repeated rows may give an example twice; their contents are met twice, so no mark depends on it.
    dealt = examples.withColumn("shard", F.pmod(F.xxhash64("seed"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(mark, "seed long, content long, offsets array<int>")


def _by_digest(examples: DataFrame) -> DataFrame:
    """The same for seeds of very many contents: every window counted by its digest."""
    at = F.posexplode(F.transform(F.sequence(F.lit(0), F.col("span").cast("int")), lambda k: F.md5(F.substring("part", k + 1, F.lit(LENGTH)))))
    windows = examples.select("seed", "content", "many", at.alias("offset", "digest"))
    counts = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    return windows.where("not many").join(counts, "digest").groupBy("seed", "content").agg(F.collect_list("offset").alias("offsets"))


def repeated_starts(docs: DataFrame) -> DataFrame:
    """n, tag and the ranges (first, last) of window starts that repeat, as a written table."""
    found = segments(docs)
    # Written, so that both sides of the join are plain shuffles and a seed of very many rows can be split.
    seeds = written(found.groupBy("seed").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("seed"), "seeds")
    rows = written(found.join(seeds, "seed"), "repeated-seeds")
    release(found, seeds)
    contents = rows.groupBy("seed", "content").agg(F.count(F.lit(1)).alias("met"), F.min_by("place", "n").alias("place"), F.min("n").alias("n"))
    kinds = contents.groupBy("seed").agg(F.count(F.lit(1)).alias("contents"))
    known = written(contents.join(kinds, "seed").select("seed", "content", "n", "place", "contents", (F.col("met") > 1).alias("many")), "contents")
    varied = known.where("contents > 1")
    cool, hot = varied.where(F.col("contents") <= HOT), varied.where(F.col("contents") > HOT)
    whole = F.array(F.struct(F.lit(0).alias("a"), _place()[1].alias("b"))).alias("ranges")
    marks = known.where("many").select("seed", "content", whole)
    each = F.transform("offsets", lambda k: F.struct(k.alias("a"), k.alias("b"))).alias("ranges")
    size = cool.agg(F.sum(_place()[1] + LENGTH)).first()[0]
    # Where every content of a seed is met again, all of it is marked already.
    single = varied.where("not many").select("seed").distinct()
    examples = written(_examples(docs, varied.join(single, "seed", "left_semi")), "examples")
    marks = marks.unionByName(_by_index(examples.where(F.col("contents") <= HOT), 1 + (size or 0) // SHARD_BYTES).select("seed", "content", each))
    if not hot.isEmpty():
        marks = marks.unionByName(_by_digest(examples.where(F.col("contents") > HOT)).select("seed", "content", each))
    marks = written(marks, "marks")
    release(known, examples)
    tag, _, start = _place()
    moved = F.transform("ranges", lambda r: F.struct((start + r["a"]).alias("a"), (start + r["b"]).alias("b")))
    hits = rows.join(marks, ["seed", "content"]).select("n", tag.alias("tag"), moved.alias("ranges"))
    out = written(hits.groupBy("n", "tag").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "repeats")
    release(rows, marks)
    return out


def cut_ranges(data: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """``data`` without the windows that start in the ranges (ends included), and the runs cut."""
    kept, at, runs, end = [], 0, 0, -1
    for first, last in sorted(ranges):
        if first > end:
            if end >= 0:
                at = end
            kept.append(data[at:first])
            runs += 1
        end = max(end, last + LENGTH)
    kept.append(data[max(end, 0) :])
    return b"".join(kept), runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, the kept bytes, n_bytes, n_removed and n_spans of every document."""
    marked = repeated_starts(docs)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, sizes, runs = [], [], []
            for packed, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = unpacker.decompress(packed)
                left, n = cut_ranges(data, [(r["a"], r["b"]) for r in ranges or ()])
                kept.append(left)
                sizes.append(len(data))
                runs.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64()), pa.array(runs, pa.int64())],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    rows = _packed(docs).join(marked, ["n", "tag"], "left").select("doc_id", "packed", "ranges")
    return rows.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def brute_force(texts: list[str], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) by counting every window: the test's measure."""
    data = [t.encode("utf-8") for t in texts]
    counts: dict[bytes, int] = {}
    for d in data:
        for s in range(len(d) - length + 1):
            counts[d[s : s + length]] = counts.get(d[s : s + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - length + 1):
            if counts[d[s : s + length]] > 1:
                gone[s : s + length] = True
        left = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        out.append((len(d), int(gone.sum()), int((gone[:-1] & ~np.concatenate(([False], gone[:-1]))[: len(d)]).sum()), hashlib.sha256(left).hexdigest()))
    return out
