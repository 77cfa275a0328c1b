"""Quality scores: random-indexing word vectors, pooled, into a small calibrated network.

Words (runs of letters and digits, runs of marks) fall into hash buckets.  A bucket has
a sparse random index vector, drawn from a fixed seed, and a context vector: the sum of
the index vectors of the words around it in the training texts.  A document is the mean
of both over its words, with how far its words repeat and its length.  A network of
two layers in numpy gives a logit; a temperature fitted on rows kept from its training
makes probabilities of it.

Fitting uses a sample of labelled rows of at most ``max_train_rows`` (the rows of least
hash of doc_id; of an id's texts the least), so the model's cost does not grow with the
corpus; scoring reads every whole text once.  Context sums are whole numbers added up by
parts of the table, so neither the order of rows nor the number of tasks changes them.

Null and empty texts get the score of a document without words.  Repeated rows are
scored alike; null doc ids stay; of a text only its characters count.  A doc id with
several labels counts as the majority, ties as 1.  Without labelled rows, or with one
class only, the score is the smoothed share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from graphloom.llm.common import give_back, small_batches, whole_text, written

BUCKETS, DIM, NONZERO, WINDOW, SEED = 1 << 14, 64, 6, 2, 20_240_917
WIDTH = 2 * DIM + 4
MAX_TRAIN_ROWS = 8_000
#: Words of a text whose neighbours are added up at a time; rows of buckets that travel together.
BLOCK, PART = 1 << 15, 1 << 10
_WORDS = re.compile(r"\w+|[^\w\s]+").findall


def index_vectors() -> np.ndarray:
    """Each bucket's sparse vector of -1, 0 and 1, the same wherever it is drawn."""
    draw = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIM), np.int32)
    places = draw.random((BUCKETS, DIM)).argpartition(NONZERO, axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, draw.choice(np.array([-1, 1], np.int32), (BUCKETS, NONZERO)), axis=1)
    return out


class Buckets:
    """Texts to bucket numbers, with a bounded memo of words."""

    def __init__(self, memo_entries: int = 200_000):
        self.memo: dict[str, int] = {}
        self.memo_entries = memo_entries

    def of(self, text: str) -> np.ndarray:
        words, memo = _WORDS(text), self.memo
        if len(memo) > self.memo_entries:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
        return np.array([memo[w] for w in words], np.int64)


def add_contexts(total: np.ndarray, buckets: np.ndarray, index: np.ndarray) -> None:
    """Add to each word's row the index vectors of the words within the window: whole numbers, so order is nothing."""
    for first in range(0, len(buckets), BLOCK):
        before = max(0, first - WINDOW)
        near = buckets[before : first + BLOCK + WINDOW]
        vectors, around = index[near], np.zeros((len(near), DIM), np.int32)
        for k in range(1, min(WINDOW, len(near) - 1) + 1):
            around[k:] += vectors[:-k]
            around[:-k] += vectors[k:]
        own = slice(first - before, first - before + min(BLOCK, len(buckets) - first))
        order = np.argsort(near[own], kind="stable")
        which, start = np.unique(near[own][order], return_index=True)
        total[which] += np.add.reduceat(around[own][order], start, axis=0)


def pooled(buckets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document's features; ``vectors`` holds index and context parts side by side."""
    out = np.zeros(WIDTH, np.float32)
    n = len(buckets)
    if n:
        which, times = np.unique(buckets, return_counts=True)
        mean = (times / n).astype(np.float32) @ vectors[which]
        distinct = len(which)
        out[: 2 * DIM] = mean
        # The mean index vector's squared length estimates how often two words agree.
        out[2 * DIM :] = np.log(float(mean[:DIM] @ mean[:DIM]) + 1e-4), np.log1p(n), distinct / n, np.log1p(n) - np.log1p(distinct)
    return out


@dataclass
class Model:
    """Word vectors, feature scaling, two layers, temperature; ``prior`` alone if untrained."""

    vectors: np.ndarray
    prior: float
    scaling: tuple[np.ndarray, np.ndarray] | None = None
    layers: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        mean, spread = self.scaling
        w1, b1, w2, b2 = self.layers
        return np.tanh(((features - mean) / spread) @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), self.prior)
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray, hidden: int = 32, epochs: int = 60, decay: float = 3e-3) -> Model:
    """Fit the network by Adam on four fifths of the rows and its temperature on the fifth."""
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    model = Model(vectors, prior)
    draw = np.random.default_rng(SEED)
    if len(labels) < 10 or labels.min() == labels.max():
        return model
    order = draw.permutation(len(labels))
    kept, fitted = order[: len(order) // 5], order[len(order) // 5 :]
    x, y = features[fitted].astype(np.float64), labels[fitted].astype(np.float64)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / spread
    params = [draw.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, hidden)), np.zeros(hidden), draw.normal(0, 1 / np.sqrt(hidden), hidden), np.array(np.log(prior / (1 - prior)))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, batch = 0, 64
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        shuffled = draw.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = shuffled[at : at + batch]
            w1, b1, w2, b2 = params
            inner = np.tanh(x[rows] @ w1 + b1)
            error = (_sigmoid(inner @ w2 + b2) - y[rows]) / len(rows)
            back = np.outer(error, w2) * (1 - inner**2)
            slopes = [x[rows].T @ back + decay * w1, back.sum(axis=0), inner.T @ error + decay * w2, np.array(error.sum())]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model.scaling, model.layers = (mean, spread), tuple(params)
    held, truth = model.logits(features[kept]), labels[kept]

    def loss(temperature: float) -> float:
        p = np.clip(_sigmoid(held / temperature), 1e-6, 1 - 1e-6)
        return float(-(truth * np.log(p) + (1 - truth) * np.log(1 - p)).mean())

    model.temperature = min(np.geomspace(0.25, 8, 121).tolist(), key=loss)
    return model


def word_vectors(contexts: np.ndarray) -> np.ndarray:
    """Index vectors beside context vectors of unit length."""
    length = np.linalg.norm(contexts, axis=1, keepdims=True)
    return np.hstack([index_vectors() / np.sqrt(NONZERO), contexts / np.maximum(length, 1e-6)]).astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, learn) -> DataFrame:
    """At most ``max_rows`` documents with a label that may be learnt from, as a written table."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn(F.col("doc_id")))
    ids = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # The ids are bounded by max_rows, so one side of the join is broadcast; of an id's texts the least teaches.
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id")
    sample = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")
    return written(sample, "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, learn=lambda doc_id: F.lit(True), tasks: int = 12) -> Model:
    """Learn word vectors and network from a bounded sample; ``learn`` says which doc ids may teach."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, max_train_rows, learn).repartition(tasks)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, index, words = np.zeros((BUCKETS, DIM), np.int64), index_vectors(), Buckets()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                add_contexts(total, words.of(text), index)
        parts = [total[k : k + PART].tobytes() for k in range(0, BUCKETS, PART)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "sums"])

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros(PART * DIM, np.int64)
        for sums in group.column("sums"):
            total += np.frombuffer(sums.as_buffer(), np.int64)
        return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    # Each part is added up where it lies; the driver gets one table of sums, whatever the tasks.
    total = np.zeros((BUCKETS, DIM), np.int64)
    for row in sample.mapInArrow(contexts, "part int, sums binary").groupBy("part").applyInArrow(added, "part int, sums binary").toLocalIterator():
        total[row.part * PART : (row.part + 1) * PART] = np.frombuffer(row.sums, np.int64).reshape(PART, DIM)
    vectors = word_vectors(total)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Buckets()
        for batch in batches:
            rows = [pooled(words.of(text), shared.value).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["label", "features"])

    rows = sorted((bytes(r.features), r.label) for r in sample.mapInArrow(features, "label int, features binary").collect())
    x = np.frombuffer(b"".join(f for f, _ in rows), np.float32).reshape(-1, WIDTH)
    return train(x, np.array([label for _, label in rows], np.int64), vectors)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value, Buckets()
        for batch in batches:
            rows = [pooled(words.of(text), model.vectors) for text in batch.column(1).to_pylist()]
            found = model.scores(np.array(rows, np.float32).reshape(-1, WIDTH))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])
        del words
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; columns as they were."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value, Buckets()
        for batch in batches:
            rows = [pooled(words.of(x or ""), model.vectors) for x in batch.column(text).to_pylist()]
            found = model.scores(np.array(rows, np.float32).reshape(-1, WIDTH))
            yield batch.filter(pa.array(found >= threshold))
        del words
        give_back()

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2: such rows never teach."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
