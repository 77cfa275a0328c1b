"""Packing token sequences as a cutting-stock problem solved by column generation.

A document's ids (its end id last) are cut at multiples of the sequence length; what is
left of it is one more piece.  Piece lengths are rounded up to classes of ``unit`` ids
and counted.  The linear program over cutting patterns (how many pieces of each class
share one sequence) is solved on that histogram, whose size is bounded: a revised
simplex keeps one pattern a class, an unbounded-knapsack dynamic program over the duals
prices new patterns.  Pattern counts are rounded down; the pieces of a class are ranked
and dealt to the patterns' slots in order; the pieces beyond them, at most one
sequence's worth for each of the bounded number of patterns, are placed best-fit.

Null texts are empty: the end id alone.  Repeated rows are packed each.  Null doc ids
stay null.  Other columns are not read.  An empty table packs to no rows.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from graphloom.llm.common import give_back, small_batches, whole_text, written
from graphloom.llm.tokens import DEFAULT_VOCABULARY, encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, cls int, nth long"


def pieces(docs: DataFrame, capacity: int, unit: int, vocabulary: str, end_id: int) -> DataFrame:
    """Every document cut to pieces of at most ``capacity`` ids, as a written table.

    ``part`` and ``nth`` say which task made a piece and how many pieces of its class
    that task had made before: with the class counts of each task, ranks follow
    without sorting or gathering a class.
    """
    small_batches(docs.sparkSession, 2048)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, end = TaskContext.get().partitionId(), encoder(vocabulary), struct.pack("<I", end_id)
        made: dict[int, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    cls = -(-(len(piece) // 4) // unit)
                    nth = made.get(cls, 0)
                    made[cls] = nth + 1
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total, part, cls, nth))
            columns = zip(*rows) if rows else [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in PIECES.split(", ")])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return written(rows.mapInArrow(cut, PIECES), "pieces")


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: most total value of items of ``sizes`` within ``capacity``."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    values, sorted_sizes = values[order], sizes[order]
    for room in range(1, capacity + 1):
        fit = np.searchsorted(sorted_sizes, room, side="right")
        best[room] = best[room - 1]
        if fit:
            got = values[:fit] + best[room - sorted_sizes[:fit]]
            k = int(np.argmax(got))
            if got[k] > best[room] + 1e-12:
                best[room], take[room] = got[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            counts[order[take[room]]] += 1
            room -= int(sorted_sizes[take[room]])
    return float(best[capacity]), counts


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each) and their fractional counts: the linear optimum by column generation.

    Starts from patterns of a single class; each round prices with the knapsack and
    exchanges one basic pattern.  ``rounds`` bounds the driver's work; any basis met on
    the way is a feasible packing.
    """
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(np.float64)  # column j: pattern j
    inverse = np.diag(1.0 / np.diag(patterns))
    x = inverse @ demand
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        worth, pattern = best_pattern(np.maximum(duals, 0), sizes, capacity)
        if worth <= 1 + 1e-7:
            break
        column = inverse @ pattern
        positive = column > 1e-9
        ratios = np.full(m, np.inf)
        ratios[positive] = x[positive] / column[positive]
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        step = max(0.0, ratios[out])
        x -= step * column
        x[out] = step
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
        patterns[:, out] = pattern
    return patterns.T.astype(np.int64), np.maximum(x, 0)


def plan_slots(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(class, first rank, first sequence, pieces a sequence, first slot) of each dealt run; sequences used.

    A run of a class begins at its first rank and deals that many pieces to one
    sequence after another.  A final entry of each class, with -1 for the sequence,
    marks the rank from which pieces are left over.
    """
    classes = np.array(sorted(histogram), np.int64)
    if not len(classes):
        return [], 0
    patterns, counts = cutting_stock(classes, np.array([histogram[int(c)] for c in classes], np.float64), capacity)
    counts = np.floor(counts + 1e-6).astype(np.int64)
    runs, ranks, sequence = [], dict.fromkeys(map(int, classes), 0), 0
    for pattern, count in zip(patterns, counts):
        slot = 0
        for cls, n in zip(map(int, classes), map(int, pattern)):
            dealt = min(n * int(count), histogram[cls] - ranks[cls])
            if dealt > 0:
                runs.append((cls, ranks[cls], sequence, n, slot))
                ranks[cls] += dealt
            slot += n
        sequence += int(count)
    runs += [(cls, rank, -1, 1, 0) for cls, rank in ranks.items()]
    return sorted(runs), sequence


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, slot) for each length, given longest first: the fullest bin with room, else a new one."""
    rooms: list[tuple[int, int]] = []
    filled: list[int] = []
    out = []
    for length in lengths:
        k = bisect_left(rooms, (length, -1))
        room, b = rooms.pop(k) if k < len(rooms) else (capacity, len(filled))
        if b == len(filled):
            filled.append(0)
        out.append((b, filled[b]))
        filled[b] += 1
        insort(rooms, (room - length, b))
    return out


def pack(docs: DataFrame, capacity: int = 2048, unit: int = 8, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = 1) -> DataFrame:
    """Pieces with their sequence and offset: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if capacity % unit:
        raise ValueError("the capacity is a multiple of the unit")
    spark = docs.sparkSession
    cut = pieces(docs, capacity, unit, vocabulary, end_id)
    # Counts by task and class; their running sums place each task's pieces in the class.
    counts = cut.groupBy("cls", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("cls", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    # At most capacity / unit rows come to the driver, whatever the input.
    histogram = {r.cls: r.n for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}
    runs, sequences = plan_slots(histogram, capacity // unit)
    slots = spark.createDataFrame(runs, "cls int, rank long, sequence long, each long, slot long")
    following = Window.partitionBy("cls").orderBy("rank")
    slots = slots.withColumn("until", F.coalesce(F.lead("rank").over(following), F.lit(2**62)))
    ranked = cut.join(offsets, ["part", "cls"]).withColumn("at", F.col("ahead") + F.col("nth")).drop("ahead", "nth")
    # The slot table has at most 2 * (capacity / unit) ** 2 rows: patterns times classes.
    dealt = ranked.join(F.broadcast(slots), "cls").where("at >= rank and at < until")
    placed = dealt.where("sequence >= 0").select(
        *cut.columns[:5],
        (F.col("sequence") + F.floor((F.col("at") - F.col("rank")) / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("slot") + (F.col("at") - F.col("rank")) % F.col("each")).alias("slot"),
    )
    # Fewer than capacity / unit patterns each leave fewer than one sequence of pieces:
    # the bound on what is gathered here does not depend on the input.
    left = dealt.where("sequence < 0").select("cls", "at", "length").collect()
    left.sort(key=lambda r: (-r.length, r.cls, r.at))
    bins = best_fit([r.length for r in left], capacity)
    rest = spark.createDataFrame([(r.cls, r.at, sequences + b, s) for r, (b, s) in zip(left, bins)], "cls int, at long, sequence_id long, slot long")
    over = dealt.where("sequence < 0").select(*cut.columns[:5], "cls", "at").join(F.broadcast(rest), ["cls", "at"]).select(*cut.columns[:5], "sequence_id", "slot")
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.unionByName(over).select(*cut.columns[:5], "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"))
