"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

Shingles are five consecutive lower-case words (all words of a shorter text), each of
weight 1 however often it occurs.  ProbMinHash gives each text ``BANDS * ROWS``
registers: every shingle is a Poisson process whose rate is its weight; arrivals fall
into random registers, the earliest arrival of a register names its shingle, and a
process ends once it is later than every register.  Registers of two texts agree with
the probability Jaccard of their weights, which for equal weights is the plain Jaccard
similarity of the shingle sets.  Texts that agree on a whole band are candidates; a
candidate pair is a link if that same similarity is ``THRESHOLD`` or more.

Copies are first reduced to one representative of each text.  A bucket of candidates is
not expanded into its pairs: all members are verified against its least member, links
are contracted to classes, and only members that fell into another class than their
bucket's least are compared further, with the members that the size ratio and the
triangle inequality of the Jaccard distance (through the least member) leave possible.
Within one class no comparison can add anything, so no link between classes is lost.

Null texts are empty; a text without words is a duplicate of its copies only.  A null
doc id stands for a hash of its text.  Rows that share doc id and text are one document;
of the texts that share a doc id, one has the id as its number and the others a hash of
id and text, so each is judged by itself.  An empty table gives an empty result; columns
beside doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from graphloom.llm.common import give_back, release, small_batches, unused, whole_text, within, written

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 36, 7
BROADCAST_ROWS = 1_000_000
#: Numbers of a sketch.
SKETCH = 16
#: Shingles that are hashed at a time, or one text's.
TOGETHER = 1 << 17
#: The bands of each round of comparison.
ROUNDS = ((0, 2), (2, 8), (8, BANDS))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Texts to the 64-bit hashes of their shingles, with a bounded memo of words."""

    def __init__(self, memo_entries: int = 200_000):
        self.memo: dict[str, int] = {}
        self.memo_entries = memo_entries

    def of(self, text: str) -> np.ndarray:
        import xxhash

        words, memo = text.lower().split(), self.memo
        if not words:
            return np.empty(0, np.uint64)
        if len(memo) > self.memo_entries:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        hashes = np.array([memo[w] for w in words], np.uint64)
        n = min(SHINGLE, len(hashes))
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            out = mix(out * _STEP + hashes[k : len(hashes) - n + 1 + k])
        return out


def prob_min_hash(sets: list[np.ndarray], weights: list[np.ndarray], registers: int) -> np.ndarray:
    """A row of register contents for each weighted set (none may be empty)."""
    d = len(sets)
    element = np.concatenate(sets)
    rate = np.concatenate(weights)
    owner = np.repeat(np.arange(d), [len(s) for s in sets])
    earliest = np.full(d * registers, np.inf)
    content = np.zeros(d * registers, np.uint64)
    clock = np.zeros(len(element))
    alive, arrival = np.arange(len(element)), 0
    while len(alive):
        ahead = max(1, min(64, 16_384 // len(alive)))
        number = np.arange(arrival, arrival + ahead, dtype=np.uint64)
        drawn = mix(element[alive][:, None] + (number + np.uint64(1))[None, :] * _STEP)
        waits = -np.log1p(-(drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate[alive][:, None]
        times = np.cumsum(np.hstack([clock[alive][:, None], waits]), axis=1)[:, 1:]
        clock[alive] = times[:, -1]
        place = (owner[alive][:, None] * registers + (mix(drawn + _STEP) % np.uint64(registers)).astype(np.int64)).ravel()
        when = times.ravel()
        np.minimum.at(earliest, place, when)
        first = earliest[place] == when
        content[place[first]] = np.repeat(element[alive], ahead)[first]
        latest = earliest.reshape(d, registers).max(axis=1)
        alive = alive[clock[alive] < latest[owner[alive]]]
        arrival += ahead
    return content.reshape(d, registers)


def band_keys(content: np.ndarray) -> np.ndarray:
    """One int64 for each band of each row of registers."""
    d = len(content)
    parts = content.reshape(d, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (d, BANDS)).copy()
    for k in range(ROWS):
        keys = mix(keys * _STEP + parts[:, :, k])
    return keys.view(np.int64)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Whether an odd number of a set's hashes falls into each of 64 * SKETCH bins, as bits: rows of SKETCH numbers."""
    bins = SKETCH * 64
    odd = np.array([np.bincount((s % np.uint64(bins)).astype(np.int64), minlength=bins) & 1 for s in sets], np.uint8)
    return np.packbits(odd, axis=1, bitorder="little").view(np.int64)


def unlike(a: str, b: str) -> Column:
    """How many bits of two sketches differ: never more than the hashes that are in one set only."""
    out = F.lit(0)
    for k in range(SKETCH):
        out = out + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    return out


def shared_ids(docs: DataFrame) -> DataFrame | None:
    """Numbers (n) that several texts share, with the text hash that keeps them (first); None if there are none."""
    texts = docs.select(_number().alias("n"), F.xxhash64(whole_text()).alias("t"))
    several = texts.groupBy("n").agg(F.min("t").alias("first"), F.max("t").alias("last")).where("first <> last")
    found = written(several.select("n", "first"), "shared-ids")
    count = found.count()
    return (F.broadcast(found) if count <= BROADCAST_ROWS else found) if count else None


def _number() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(whole_text()))


def _with_number(docs: DataFrame, shared: DataFrame | None, name: str) -> DataFrame:
    """``docs`` with the number of each document in a new column ``name``."""
    rows = docs.withColumn(name, _number())
    if shared is None:
        return rows
    first, hashed = unused(rows, "_first"), F.xxhash64(whole_text())
    keeps = F.col(first).isNull() | (F.col(first) == hashed)
    both = rows.join(shared.select(F.col("n").alias(name), F.col("first").alias(first)), name, "left")
    return both.withColumn(name, F.when(keeps, F.col(name)).otherwise(F.xxhash64(name, hashed))).drop(first)


def _numbered(docs: DataFrame, shared: DataFrame | None) -> DataFrame:
    rows = _with_number(docs.select("doc_id", "text"), shared, "n")
    return rows.select("n", F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def signatures(docs: DataFrame, shared: DataFrame | None) -> DataFrame:
    """n, doc_id, digest of the text, band keys and sketch of every document, as a written table."""
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler = Shingler()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [np.unique(shingler.of(t)) for t in texts]
            some = [k for k, s in enumerate(found) if len(s)]
            keys: list = [[]] * len(texts)
            brief: list = [[]] * len(texts)
            for part in within([len(found[k]) for k in some], TOGETHER):
                sets = [found[k] for k in some[part]]
                content = prob_min_hash(sets, [np.ones(len(s)) for s in sets], BANDS * ROWS)
                for k, row, short in zip(some[part], band_keys(content), sketches(sets)):
                    keys[k], brief[k] = row, short
            digests = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(brief, pa.list_(pa.int64()))], ["n", "doc_id", "digest", "bands", "sketch"])
        del shingler
        give_back()

    return written(_numbered(docs, shared).mapInArrow(run, "n long, doc_id long, digest binary, bands array<long>, sketch array<long>"), "signatures")


def shingle_sets(docs: DataFrame, shared: DataFrame | None, wanted: DataFrame) -> DataFrame:
    """n and the distinct 64-bit shingle hashes of the wanted documents, as a written table."""
    small_batches(docs.sparkSession, 256)
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = [np.unique(shingler.of(t)).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["n", "grams"])
        del shingler
        give_back()

    rows = _numbered(docs, shared).select("n", "text").join(wanted, "n", "left_semi")
    return written(rows.mapInArrow(run, "n long, grams array<long>"), "shingles")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the Jaccard similarity of their shingle sets, as a written table."""
    left = sets.select(F.col("n").alias("a"), F.col("grams").alias("_ga"))
    right = sets.select(F.col("n").alias("b"), F.col("grams").alias("_gb"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("_ga", "_gb"))
    return written(both.select(*pairs.columns, (common / (F.size("_ga") + F.size("_gb") - common)).alias("similarity")), "similarities")


def components(edges: DataFrame) -> DataFrame:
    """n and the least node of its connected component, of every node of the edges (a, b).

    Large-star and small-star steps alternate until nothing changes: each hangs a node's
    neighbours on the least of them.  Every round is a written table.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        last, edges = edges, written(hung.where("a <> b").distinct(), "edges")
        release(last)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("n"), F.col("b").alias("class"))
        before = now


def _joined(linked: DataFrame | None, compared: DataFrame) -> DataFrame:
    """Classes (n, class) with the compared pairs that are links added, by links between classes.

    A node that is the least of its class has no row.
    """
    links = compared.where(F.col("similarity") >= THRESHOLD).select("a", "b")
    if linked is None:
        return components(links)
    if links.isEmpty():
        return linked
    for end in ("a", "b"):
        links = links.join(linked.select(F.col("n").alias(end), F.col("class").alias("_c")), end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    merged = components(links)
    moved = linked.join(merged.select(F.col("n").alias("class"), F.col("class").alias("_to")), "class", "left").select("n", F.coalesce("_to", "class").alias("class"))
    return written(moved.unionByName(merged), "classes")


def _open_members(firsts: DataFrame, linked: DataFrame | None) -> DataFrame:
    """Members (key, n, class) of buckets that hold several classes, with the least member and its class."""
    rows = firsts.withColumn("class", F.col("n")) if linked is None else firsts.join(linked, "n", "left").withColumn("class", F.coalesce("class", "n"))
    rows = written(rows.select("key", "n", "class"), "members")
    buckets = rows.groupBy("key").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi"), F.min("n").alias("least"), F.min_by("class", "n").alias("least_class"))
    return rows.join(buckets.where("_lo < _hi").select("key", "least", "least_class"), "key").where("n <> least")


def classes(docs: DataFrame, shared: DataFrame | None) -> DataFrame:
    """n, doc_id and class (the least n of its near-duplicates) of every document."""
    signed = signatures(docs, shared)
    copies = written(signed.groupBy("digest").agg(F.min("n").alias("rep")), "copies")
    single = signed.join(copies, (signed["n"] == copies["rep"]) & (signed["digest"] == copies["digest"]))
    firsts = single.select("n", F.posexplode("bands").alias("band", "key"))
    firsts = written(firsts.distinct(), "bands")
    keys = firsts.groupBy("key").agg(F.min("n").alias("_lo"), F.max("n").alias("_hi")).where("_lo < _hi").select("key")
    every, firsts = firsts, written(firsts.join(keys, "key", "left_semi"), "buckets")
    release(every)
    sets = shingle_sets(docs, shared, written(firsts.select("n").distinct(), "involved"))
    # A few bands find most links; each further round sees only buckets of several classes.
    linked, compared = None, None
    for first, last in ROUNDS:
        members = _open_members(firsts.where(F.col("band").between(first, last - 1)), linked)
        pairs = members.where("class <> least_class").groupBy("n").agg(F.min("least").alias("a")).select("a", F.col("n").alias("b"))
        found = similarities(written(pairs, "pairs"), sets).withColumn("round", F.lit(first))
        linked = _joined(linked, found)
        compared = found if compared is None else compared.unionByName(found)
    # What is still apart: every member against the least of its bucket, then against the other classes there.
    members = written(_open_members(firsts, linked), "open")
    pairs = members.where("class <> least_class").select(F.col("least").alias("a"), F.col("n").alias("b")).distinct()
    linked = _joined(linked, similarities(written(pairs.join(compared, ["a", "b"], "left_anti"), "pairs"), sets))
    known = compared.groupBy(F.col("b").alias("n")).agg(F.min_by(F.struct(F.col("a").alias("reference"), "similarity"), "round").alias("k")).select("n", "k.*")
    sizes = sets.groupBy("n").agg(F.max(F.size("grams")).alias("size"))
    placed = written(_open_members(members.select("key", "n").unionByName(members.select("key", F.col("least").alias("n"))).distinct(), linked).join(sizes, "n").join(known, "n", "left").join(single.select("n", "sketch", "bands"), "n"), "placed")
    apart = placed.where("class <> least_class").select("key", "n", "reference", "similarity", "class", "size", "sketch", "bands")
    # A bucket with one such member beside its least member alone has no further pair.
    several = placed.groupBy("key").agg(F.min("n").alias("_lo"), F.max("n").alias("_hi")).where("_lo < _hi").select("key")
    other = placed.join(several, "key").select("key", *[F.col(c).alias(f"{c}2") for c in ("n", "reference", "similarity", "class", "size", "sketch", "bands")])
    slack = 1 - THRESHOLD + 1e-9
    near = F.when(F.col("reference") == F.col("reference2"), F.abs(F.col("similarity") - F.col("similarity2")) <= slack)
    possible = (F.col("class") != F.col("class2")) & F.coalesce(near, F.lit(True)) & (F.least("size", "size2") >= F.greatest("size", "size2") * THRESHOLD - 1e-9)
    # Of sizes a + b, a link has at most (a + b) (1 - t) / (1 + t) shingles in one set only.
    possible = possible & (unlike("sketch", "sketch2") <= (F.col("size") + F.col("size2")) * ((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-6)
    possible = possible & (F.array_intersect("bands", "bands2")[0] == F.col("key"))  # once, in the first bucket of both
    more = apart.join(other, "key").where(possible).select(F.least("n", "n2").alias("a"), F.greatest("n", "n2").alias("b")).distinct()
    final = _joined(linked, similarities(written(more, "further"), sets))
    of_digest = copies.join(final.withColumnRenamed("n", "rep"), "rep", "left").select("digest", F.coalesce("class", "rep").alias("class"))
    rows = signed.select("n", "doc_id", "digest").join(of_digest, "digest")
    return rows.select("n", "doc_id", "class")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and whether the document represents its class."""
    return classes(docs, shared_ids(docs)).select("doc_id", F.col("class").alias("class_id"), (F.col("n") == F.col("class")).alias("representative"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class; columns as they were."""
    shared, number = shared_ids(docs), unused(docs, "_n")
    kept = classes(docs, shared).where("n = class").select(F.col("n").alias(number)).distinct()
    return _with_number(docs, shared, number).join(kept, number, "left_semi").dropDuplicates([number]).select(*docs.columns)


def brute_force(texts: list[str]) -> list[int]:
    """The least index of each text's class by all pairs: the test's measure."""
    sets = []
    for text in texts:
        w = text.lower().split()
        n = min(SHINGLE, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    label = list(range(len(texts)))

    def top(k: int) -> int:
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if texts[a] == texts[b] or (union and len(sets[a] & sets[b]) >= THRESHOLD * union):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return [top(k) for k in range(len(texts))]
