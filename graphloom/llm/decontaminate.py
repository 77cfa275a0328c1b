"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts and benchmark items become lower-case words (runs of letters and digits).  Each
fixed mask ignores some positions of a short stretch of words and hashes the rest, so a
replaced word spoils only the stretches whose mask looks at it.  Equal hashes of a text
and an item give a candidate alignment; the alignment is verified on all words: some
``WINDOW`` consecutive words of the item (the whole item if it is shorter) must agree
with the text's in at least ``SHARE`` of their places.  The masks hit every such window
with as many replaced words as that leaves: two, or one in items of five to nine words.
Items shorter than a window offer fewer places, and have masks of their own
(``MASKS_BELOW``), which texts meet only where there are such items.

Items of any length are searched; one of at most four words must be met whole and as it
is, since a share of ``SHARE`` leaves no word to replace.  ``least_words`` raises that
bound for benchmarks whose short items are common phrases.  Null texts are empty and hold
nothing; repeated rows and repeated items are judged alike, equally good alignments give
one row; null ids stay null; an empty table on either side gives no row; columns beside
id and text are not read, and those of documents come back as they were.  The item table
is broadcast while its hashes are within ``BROADCAST_KEYS`` and joined by shuffle beyond,
and so are the candidates, within ``BROADCAST_ROWS``.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.llm.common import unused, whole_text, written

#: Positions that count; together they hit any 13 places of which two differ.
MASKS = ("11101001", "1100010111", "11010011")
#: Fixed values: (words of an item at most, masks that hit it wherever its replaced words are); beyond, ``MASKS`` do.
MASKS_BELOW = ((1, ("1",)), (2, ("11",)), (3, ("111",)), (4, ("1111",)), (7, ("111", "1101")), (11, MASKS + ("111111", "110011101")))
WINDOW, SHARE, LEAST_WORDS = 13, 0.8, 1
BROADCAST_KEYS, BROADCAST_ROWS = 2_000_000, 1_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def masks_of(size: int) -> tuple[str, ...]:
    """The masks of an item of so many words."""
    return next((masks for most, masks in MASKS_BELOW if size <= most), MASKS)


def _key(hashes: str, place: str, mask: str) -> Column:
    """The hash of a mask laid at a place; null where it runs over the end.  Equal masks give equal hashes."""
    looks = [F.try_element_at(hashes, F.col(place) + k + 1) for k, c in enumerate(mask) if c == "1"]
    fits = F.col(place) + len(mask) <= F.size(hashes)
    return F.when(fits, F.xxhash64(F.lit(int(mask, 2)), *looks))


def seeds(rows: DataFrame, id_column: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """A row (id, place, key) for every mask at every place of ``_words``."""
    hashed = rows.select(id_column, F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    placed = hashed.select(id_column, "_hashes", F.posexplode("_hashes").alias("place", "_x"))
    keys = F.array(*[_key("_hashes", "place", mask) for mask in masks])
    return placed.select(id_column, "place", F.explode(keys).alias("key")).where("key is not null")


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (text hash, item, shift) whose words agree under some mask, as a written table."""
    # Of the items' lengths only which kinds of masks they need comes to the driver: a few values, whatever the table.
    kind = F.lit(len(MASKS_BELOW))
    for k, (most, _) in reversed(list(enumerate(MASKS_BELOW))):
        kind = F.when(F.size("_words") <= most, k).otherwise(kind)
    kinds = sorted(r[0] for r in items.select(kind.alias("k")).distinct().collect())
    chosen = [*[masks for _, masks in MASKS_BELOW], MASKS]
    item_keys = None
    for k in kinds or [len(MASKS_BELOW)]:
        of = seeds(items.where(kind == k), "item_key", chosen[k])
        item_keys = of if item_keys is None else item_keys.unionByName(of)
    item_keys = written(item_keys.withColumnRenamed("place", "item_place"), "item-seeds")
    if item_keys.count() <= BROADCAST_KEYS:
        item_keys = F.broadcast(item_keys)
    masks = tuple(dict.fromkeys(m for k in kinds for m in chosen[k])) or MASKS
    texts = docs.select(F.xxhash64("_text").alias("_h"), words(F.col("_text")).alias("_words"))
    hits = seeds(texts, "_h", masks).join(item_keys, "key")
    return written(hits.select("_h", "item_key", (F.col("place") - F.col("item_place")).alias("shift")).distinct(), "alignments")


def _agreement(text_words: str, item_words: str, shift: str) -> Column:
    """0 or 1 for each word of the item that the shifted text covers."""
    first = F.greatest(F.lit(0), -F.col(shift))
    last = F.least(F.size(item_words), F.size(text_words) - F.col(shift)) - 1
    same = F.transform(
        F.sequence(first, F.greatest(first, last)),
        lambda t: (F.try_element_at(text_words, F.col(shift) + t + 1) == F.try_element_at(item_words, t + 1)).cast("int"),
    )
    return F.when(first <= last, same).otherwise(F.array().cast("array<int>"))


def overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Verified (text hash ``_h``, item_id, matched, window, agreeing).

    ``matched`` is the most agreeing words in one window of ``window`` words and
    ``agreeing`` those on the whole alignment, of the best alignment of text and item.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(whole_text()).alias("_words")).distinct()
    items = items.where(F.size("_words") >= least_words).withColumn("item_key", F.xxhash64("item_id", "_words"))
    texts = docs.select(whole_text().alias("_text"))
    found = alignments(texts, items)
    small = found.count() <= BROADCAST_ROWS
    candidates = F.broadcast(found) if small else found
    rows = texts.select(F.xxhash64("_text").alias("_h"), "_text").join(candidates, "_h").dropDuplicates(["_h", "item_key", "shift"])
    looked = rows.select("_h", "item_key", "shift", words(F.col("_text")).alias("_text_words")).join(items.select("item_key", "item_id", F.col("_words").alias("_item_words")), "item_key")
    same = looked.select("_h", "item_id", _agreement("_text_words", "_item_words", "shift").alias("_same"), F.least(F.lit(WINDOW), F.size("_item_words")).alias("window"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_same") - F.col("window")))
    best = F.array_max(F.transform(starts, lambda s: F.aggregate(F.slice("_same", s + 1, F.col("window")), F.lit(0), lambda a, x: a + x)))
    judged = same.withColumn("matched", best.cast("long")).where(F.col("matched") >= F.ceil(F.col("window") * SHARE))
    agreeing = F.aggregate("_same", F.lit(0), lambda a, x: a + x).cast("long")
    best_of = F.max(F.struct("matched", agreeing.alias("agreeing"), F.col("window").cast("long").alias("window"))).alias("b")
    return judged.groupBy("_h", "item_id").agg(best_of).select("_h", "item_id", "b.matched", "b.window", "b.agreeing")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched, window, agreeing of every document that holds part of an item."""
    leaks = written(overlaps(docs.select("doc_id", "text"), benchmark), "leaks")
    if leaks.count() <= BROADCAST_ROWS:
        leaks = F.broadcast(leaks)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("_h"))
    return keyed.join(leaks, "_h").select("doc_id", "item_id", "matched", "window", "agreeing")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold part of an item; columns as they were."""
    leaks = written(overlaps(docs, benchmark).select("_h").distinct(), "leaks")
    if leaks.count() <= BROADCAST_ROWS:
        leaks = F.broadcast(leaks)
    hashed = unused(docs, "_h")
    return docs.withColumn(hashed, F.xxhash64(whole_text())).join(leaks.withColumnRenamed("_h", hashed), hashed, "left_anti").select(*docs.columns)


def brute_force(texts: list[str], items: list[str]) -> list[tuple[int, int, int]]:
    """(text, item, matched) by laying every item at every place: the test's measure."""
    import regex

    cut = regex.compile(r"[\p{L}\p{N}]+").findall
    found = []
    for a, text in enumerate(texts):
        t = cut(text.lower())
        for b, item in enumerate(items):
            w = cut(item.lower())
            if len(w) < LEAST_WORDS:
                continue
            window, best = min(WINDOW, len(w)), 0
            for shift in range(-len(w) + 1, len(t)):
                same = [t[shift + k] == w[k] for k in range(max(0, -shift), min(len(w), len(t) - shift))]
                for s in range(max(1, len(same) - window + 1)):
                    best = max(best, sum(same[s : s + window]))
            if best >= ceil(window * SHARE):
                found.append((a, b, best))
    return found
