"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Word vectors come from the whole corpus. Each word, and each shape of a word (`Xx.`, `X!`), falls into one of `BUCKETS`
buckets; a bucket's index vector has a few random +1 and -1, and its word vector is the sum of the index vectors seen next
to it. Tasks add up their part in a table of fixed size, the parts are added bucket by bucket, and the sum, some
megabytes whatever the corpus, goes to the executors. A document is the mean vector of its words, the mean vector of its
shapes, how far both spread, and how much each is like the one before it.

The network is fitted on the driver on at most `SAMPLE_ROWS` labelled documents, chosen by a hash of their id; one in five
of them sets the temperature that calibrates the probabilities. Only vectors leave the executors.

Null and empty texts are pooled to zeros and get the score of that vector. Documents without a label or with a null label
teach nothing. With labels of one class, the score is that class's everywhere; without labels it is 0.5. Repeated rows are scored
alike; a label counts as often as it is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.frames import utf8
from tabloom.llm.words import Words, byte_values, slices
from tabloom.session import checkpointed

BUCKETS, WIDTH, NONZERO = 1 << 14, 32, 2
FEATURES = 2 * WIDTH + 4
SAMPLE_ROWS, HIDDEN, EPOCHS, LEAST_STEPS = 20_000, 32, 60, 2_000
#: Buckets that are added up together, and words that are pooled together.
BLOCK, SLICE = 256, 4_096

_CLASS = bytes(ord("X") if 65 <= c <= 90 else ord("x") if 97 <= c <= 122 or c > 127 else ord("0") if 48 <= c <= 57 else c for c in range(256))
_SHAPE = np.frombuffer(_CLASS, np.uint8)
#: Words are told apart by their letters and digits in lower case; other characters count by their place alone.
_WORD = byte_values(1, bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 0 for c in range(256)))
_KIND = byte_values(2)


def index_vectors(seed: int = 11) -> np.ndarray:
    """The entries of each bucket's index vector: twice the place, one more where the sign is minus."""
    return np.random.default_rng(seed).integers(0, 2 * WIDTH, (BUCKETS, NONZERO))


def _buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of their shapes, and how many words each text has."""
    words = Words(texts)
    word, shape = words.hashes(_WORD), words.shapes(_SHAPE, _KIND)
    return (word % np.uint64(BUCKETS)).astype(np.int64), (shape % np.uint64(BUCKETS)).astype(np.int64), words.count


def _gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around each bucket over a task's texts."""
    slot = index_vectors()
    total = np.zeros(BUCKETS * 2 * WIDTH, np.int64)
    for batch in rows:
        for texts in slices(utf8(batch)):
            *both, n = _buckets(texts)
            text = np.repeat(np.arange(len(n)), n)
            inside = text[1:] == text[:-1]
            for line in both:
                a, b = line[:-1][inside], line[1:][inside]
                for own, other in ((a, b), (b, a)):
                    for j in range(NONZERO):
                        total += np.bincount(own * (2 * WIDTH) + slot[other, j], minlength=total.size)
    total = total.reshape(-1, 2)
    total = total[:, 0] - total[:, 1]
    if total.any():
        cut = total.reshape(-1, BLOCK * WIDTH)
        full = np.flatnonzero(cut.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(list(cut[full]), pa.list_(pa.int64()))], ["block", "sums"])


def _add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in rows:
        for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = sums.values.to_numpy()
            total[block] = total[block] + own if block in total else own.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(list(total.values()), pa.list_(pa.int64()))], ["block", "sums"])


def word_vectors(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """A vector of length 1 for each bucket, from all texts; zeros for buckets without words."""
    blocks = BUCKETS // BLOCK
    parts = df.select(F.col(text_col).alias("text")).mapInArrow(_gather, "block int, sums array<long>")
    out = np.zeros((BUCKETS, WIDTH))
    for r in parts.repartition(blocks, "block").mapInArrow(_add, "block int, sums array<long>").toArrow().to_pylist():
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.reshape(r["sums"], (BLOCK, WIDTH))
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(size > 0, size, 1)).astype(np.float32)


def _pool(table: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, tuple[float, float]]:
    """The mean vector, how far the vectors spread, and how much each is like the one before."""
    total, like, last = np.zeros(WIDTH), 0.0, None
    for at in range(0, len(buckets), SLICE):
        own = table[buckets[at : at + SLICE]]
        total += own.sum(axis=0)
        like += float(np.vdot(own[1:], own[:-1])) + (float(last @ own[0]) if last is not None else 0.0)
        last = own[-1]
    mean = total / len(buckets)
    return mean, (1 - mean @ mean, like / max(1, len(buckets) - 1))


def pooled(df: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, pooled array<float>: means, spreads and likenesses of a document's word and shape vectors."""
    sent = df.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS x WIDTH floats

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in rows:
            at = 0
            for texts in slices(utf8(batch)):
                *both, n = _buckets(texts)
                out = np.zeros((len(texts), FEATURES), np.float32)
                end = np.cumsum(n)
                for k, buckets in enumerate(both):
                    for i, (a, b) in enumerate(zip((end - n).tolist(), end.tolist())):
                        if b > a:
                            out[i, k * WIDTH : (k + 1) * WIDTH], out[i, 2 * WIDTH + 2 * k : 2 * WIDTH + 2 * k + 2] = _pool(table, buckets[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(list(out), pa.list_(pa.float32()))], ["id", "pooled"])
                at += len(texts)

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, pooled array<float>").withColumnRenamed("id", id_col)


class Network:
    """Two layers and a temperature, or a constant where there is nothing to learn."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        self.constant = None
        if len(y) < 2 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        held = order[: len(y) // 5] if len(y) >= 50 else order[:0]
        train = order[len(held) :]
        self.mean, self.scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
        weights = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        z, target, steps = (x[train] - self.mean) / self.scale, y[train].astype(float), 0
        parts = max(1, len(train) // 128)
        for _ in range(max(EPOCHS, -(-LEAST_STEPS // parts))):
            for part in np.array_split(rng.permutation(len(train)), parts):
                a = np.maximum(z[part] @ weights[0] + weights[1], 0)
                p = 1 / (1 + np.exp(-np.clip(a @ weights[2] + weights[3], -30, 30)))
                d = (p - target[part]) / len(part)
                back = np.outer(d, weights[2]) * (a > 0)
                slopes = [z[part].T @ back + 1e-3 * weights[0], back.sum(axis=0), a.T @ d, d.sum(keepdims=True)]
                steps += 1
                for i, g in enumerate(slopes):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    weights[i] = weights[i] - 0.003 * first[i] / (1 - 0.9**steps) / (np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8)
        self.weights, self.temperature = weights, 1.0
        if len(held):
            logit, truth = self._logit(x[held]), y[held]
            loss = lambda t: np.logaddexp(0, np.where(truth == 1, -logit, logit) / t).mean()
            self.temperature = float(min(np.geomspace(0.5, 8, 200), key=loss))

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum((x - self.mean) / self.scale @ w[0] + w[1], 0) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logit(x) / self.temperature, -30, 30)))


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            rows: int = SAMPLE_ROWS) -> DataFrame:
    """id_col, score for every row of `df`, learned from `labels` (id_col, label_col) of those of its rows that have one."""
    vectors = checkpointed(pooled(df, word_vectors(df, text_col), id_col, text_col))
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col), (F.col(label_col) > 0).cast("int").alias("y"))
    order = F.xxhash64(F.col(id_col).cast("string"))
    joined = vectors.join(known, id_col).select(order.alias("key"), "y", "pooled")
    # the smallest keys are wanted; so far below the limit that enough of them are left, other rows needn't be sorted
    share = min(1.0, 1.2 * rows / max(1, joined.count()) + 1e-9)
    low = F.col("key").cast("double") / 2.0**64 + 0.5 <= share
    taken = joined.where(low).orderBy("key", "y").limit(rows).toArrow()
    x = np.array(taken.column("pooled").to_pylist(), np.float64).reshape(taken.num_rows, FEATURES)
    network = Network(x, np.array(taken.column("y").to_pylist(), int))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.score(own.astype(np.float64)))], ["id", "score"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(id_col).alias("id"), "pooled").mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
