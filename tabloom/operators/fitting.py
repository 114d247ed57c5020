"""Many fits over one table at once: every grid point and fold of a search.

A fit is a generator. It yields what it wants summed over all rows (a state), and gets the sum back. Its `sums(rows, state)` gives
the sum over some rows, as one packed array, so sums of parts add up. There are two ways to run fits, with the same results
but for the order in which numbers are added:

- A table of at most `SMALL_BYTES`, counted first, is broadcast, and each fit runs in one task.
- A larger table stays where it is. In every round one job takes the sums of all fits over each partition, and packed sums are
  added; those of more than `ADDED` partitions in two steps, so no task adds more than about the square root of all partitions' sums of a fit.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

#: Bytes up to which a table is broadcast, and rounds after which a large table's rows are written anew with what fits know of them.
SMALL_BYTES, KEPT_ROUNDS = 64 << 20, 10
#: Tasks that short fits are dealt to, if they are more; four times the cores, if these are more.
TASKS = 32
#: Partitions whose sums of a fit one task adds.
ADDED = 64
_MASK = (1 << 64) - 1


@dataclass
class Rows:
    """Rows that a task holds: their numbers, cells, labels and folds, what a fit keeps about them meanwhile, and what all fits share."""

    id: np.ndarray
    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    kept: dict = field(default_factory=dict)
    shared: dict = field(default_factory=dict)


class Fit:
    """One fit. `key` tells it from the others that are run with it; rows of the fold `fold` are held out."""

    key: object
    fold: int

    @property
    def cost(self) -> float:
        """About how long it takes, by the measure of the fits that are run with it."""
        return 1.0

    def run(self) -> Generator[object, np.ndarray, object]:
        raise NotImplementedError

    def sums(self, rows: Rows, state: object) -> np.ndarray:
        raise NotImplementedError

    @staticmethod
    def all_sums(rows: Rows, asked: Sequence[tuple["Fit", object]]) -> list[np.ndarray]:
        """The sums of many fits over the same rows."""
        return [fit.sums(rows, state) for fit, state in asked]

    def trimmed(self, state: object, done: int) -> object:
        """The state without what rows already know after `done` rounds."""
        return state

    def rounds(self, state: object) -> int:
        """Rounds whose outcome rows can keep; 0 for fits that keep nothing."""
        return 0

    def margins(self, rows: Rows, state: object) -> np.ndarray:
        """A number for each row, which fits with rounds keep."""
        raise NotImplementedError


def uniform(ids: np.ndarray, *numbers: int | np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each row that follows from its id and the given numbers alone; arrays of numbers are dealt like arrays of ids."""
    salt = np.array([0x9E3779B97F4A7C15], np.uint64)  # an array, which wraps around without a warning
    for n in numbers:
        salt = (salt ^ (n.astype(np.uint64) if isinstance(n, np.ndarray) else np.uint64(n & _MASK))) * np.uint64(0xBF58476D1CE4E5B9)
        salt = salt + np.uint64(0x94D049BB133111EB)
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))).astype(np.float64) / 2.0**64


def rows_of(batch: pa.RecordBatch, kind: str) -> Rows:
    """The rows of a batch of a packed table."""
    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), kind).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0), kind)
    return Rows(batch.column("id").to_numpy(), x, batch.column("label").to_numpy(), batch.column("fold").to_numpy())


def packed_table(data: DataFrame, pack: Callable[[np.ndarray], np.ndarray], features: str = "features") -> DataFrame:
    """id, x, label, fold: rows with their packed cells, numbered and written once, so that a number stays with its row."""
    fold = F.col("fold").cast("int") if "fold" in data.columns else F.lit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = pack(batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("label"), batch.column("fold")], ["x", "label", "fold"])

    rows = data.select(vector_to_array(features).alias("f"), F.col("label").cast("double").alias("label"), fold.alias("fold"))
    rows = rows.mapInArrow(run, "x binary, label double, fold int")
    return checkpointed(rows.select(F.monotonically_increasing_id().alias("id"), "x", "label", "fold"))


def alone(fit: Fit, rows: Rows) -> object:
    """The fit over rows that are all here."""
    steps = fit.run()
    try:
        state = next(steps)
        while True:
            state = steps.send(fit.sums(rows, state))
    except StopIteration as end:
        return end.value


def fit_together(table: DataFrame, fits: Sequence[Fit], kind: str, width: int = 0) -> list:
    """The results of all fits over `table`: id long, x binary (cells of the numpy type `kind`), label double, fold int.

    The table is read in every round and should be cached or checkpointed. `width` is the bytes of a row as fits see it, if they are more.
    """
    return _beside(table, fits, kind) if table_bytes(table, width) <= SMALL_BYTES else _across(table, fits, kind)


def table_bytes(table: DataFrame, width: int = 0) -> int:
    """Bytes of all rows as fits see them."""
    return table.agg(F.sum(F.greatest(F.length("x"), F.lit(width)) + 20)).first()[0] or 0


def dealt(costs: Sequence[float], most: int) -> list[list[int]]:
    """Places of all costs in at most `most` groups of about the same sums, the largest sums first."""
    groups = [(0.0, i, []) for i in range(min(most, len(costs)))]
    for place in sorted(range(len(costs)), key=lambda p: -costs[p]):
        total, i, own = heapq.heappop(groups)
        heapq.heappush(groups, (total + costs[place], i, [*own, place]))
    return [own for _, _, own in sorted(groups, key=lambda g: (-g[0], g[1]))]


def _beside(table: DataFrame, fits: Sequence[Fit], kind: str) -> list:
    """Each fit in one task, short ones several to a task, over a broadcast table of a checked size."""
    spark = table.sparkSession
    held = table.select("id", "x", "label", "fold").toArrow().sort_by("id").combine_chunks()
    batch = pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in held.columns], held.column_names)
    groups = dealt([f.cost for f in fits], max(TASKS, 4 * spark.sparkContext.defaultParallelism))
    shared = spark.sparkContext.broadcast((rows_of(batch, kind), cloudpickle.dumps([[(i, fits[i]) for i in g] for g in groups])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, packed = shared.value
        own = cloudpickle.loads(packed)
        for batch in batches:
            for i, fit in [f for g in batch.column(0).to_pylist() for f in own[g]]:
                rows.kept = {}
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([cloudpickle.dumps(alone(fit, rows))])], ["fit", "result"])
                rows.kept = {}

    jobs = spark.range(0, len(groups), 1, len(groups)).mapInArrow(run, "fit long, result binary").collect()
    found = {r["fit"]: cloudpickle.loads(r["result"]) for r in jobs}
    shared.unpersist()
    return [found[i] for i in range(len(fits))]


_PACKED = pa.schema([("fit", pa.int64()), ("part", pa.int64()), ("sums", pa.binary())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict = {}
    for batch in batches:
        for fit, part, packed in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(packed)
            total[fit, part] = own if (fit, part) not in total else total[fit, part] + own
    for (fit, part), own in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([fit]), pa.array([part]), pa.array([own.tobytes()])], schema=_PACKED)


def _across(table: DataFrame, fits: Sequence[Fit], kind: str) -> list:
    """All fits side by side over rows that stay where they are, a job a round."""
    spark, types = table.sparkSession, "fit long, part long, sums binary"
    count = table.rdd.getNumPartitions()
    parts = 1 if count <= ADDED else math.isqrt(count)
    table, done = table.withColumn("kept", F.lit(None).cast("binary")), {}
    steps, results, asked = {}, {}, {}

    def advanced(i: int, sums: np.ndarray | None) -> None:
        try:
            asked[i] = next(steps[i]) if sums is None else steps[i].send(sums)
        except StopIteration as end:
            results[i] = end.value
            asked.pop(i, None)

    for i, fit in enumerate(fits):
        steps[i] = fit.run()
        advanced(i, None)
    while asked:
        kept = sorted(done)
        shared = spark.sparkContext.broadcast(cloudpickle.dumps([(i, fits[i], fits[i].trimmed(s, done.get(i, 0))) for i, s in asked.items()]))
        known = dict(done)

        def of(batch: pa.RecordBatch, kept=kept, known=known) -> Rows:
            rows = rows_of(batch, kind)
            if kept:
                held = np.frombuffer(b"".join(batch.column("kept").to_pylist())).reshape(-1, len(kept))
                rows.kept = {(i, "margin"): (known[i], held[:, k].copy()) for k, i in enumerate(kept)}
            return rows

        behind = [i for i, s in asked.items() if fits[i].rounds(s) - done.get(i, 0) >= KEPT_ROUNDS]
        if behind:
            keeping = sorted(i for i, s in asked.items() if fits[i].rounds(s))

            def update(batches: Iterator[pa.RecordBatch], of=of, shared=shared, keeping=keeping) -> Iterator[pa.RecordBatch]:
                own = {i: (fit, state) for i, fit, state in cloudpickle.loads(shared.value)}
                for batch in batches:
                    rows = of(batch)
                    held = np.stack([own[i][0].margins(rows, own[i][1]) for i in keeping], 1) if batch.num_rows else np.zeros((0, len(keeping)))
                    columns = [batch.column(n) for n in ("id", "x", "label", "fold")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([r.tobytes() for r in held], pa.binary())], ["id", "x", "label", "fold", "kept"])

            table = checkpointed(table.select("id", "x", "label", "fold", "kept").mapInArrow(update, "id long, x binary, label double, fold int, kept binary"))
            done = {i: fits[i].rounds(asked[i]) for i in keeping}
            shared.unpersist()
            continue

        def take(batches: Iterator[pa.RecordBatch], of=of, shared=shared) -> Iterator[pa.RecordBatch]:
            own, total = cloudpickle.loads(shared.value), {}
            for batch in batches:
                rows = of(batch)
                if batch.num_rows:
                    for members in grouped_by(own, lambda o: type(o[1])).values():
                        for (i, *_), sums in zip(members, type(members[0][1]).all_sums(rows, [m[1:] for m in members])):
                            sums = sums.astype(np.float64).ravel()
                            total[i] = sums if i not in total else total[i] + sums
            part = TaskContext.get().partitionId() % parts
            for i, sums in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part]), pa.array([sums.tobytes()])], schema=_PACKED)

        taken = table.select("id", "x", "label", "fold", "kept").mapInArrow(take, types)
        if parts > 1:
            taken = taken.repartition("fit", "part").mapInArrow(_added, types).withColumn("part", F.lit(0).cast("long"))
        found = taken.repartition("fit").mapInArrow(_added, types).collect()
        shared.unpersist()
        for r in found:
            advanced(r["fit"], np.frombuffer(r["sums"]))
    return [results[i] for i in range(len(fits))]


def binary_score(tn: float, fp: float, fn: float, tp: float, scoring: str) -> float:
    """A score of decisions about two classes from their counts; quotients with a zero denominator are 0."""
    div = lambda a, b: a / b if b else 0.0
    n, support = tn + fp + fn + tp, (tn + fp, fn + tp)
    precision, recall = (div(tn, tn + fn), div(tp, tp + fp)), (div(tn, tn + fp), div(tp, tp + fn))
    f1 = (div(2 * tn, 2 * tn + fp + fn), div(2 * tp, 2 * tp + fp + fn))
    if scoring == "accuracy":
        return div(tn + tp, n)
    if scoring == "balanced_accuracy":
        present = [r for r, s in zip(recall, support) if s]
        return div(sum(present), len(present))
    name, _, kind = scoring.partition("_")
    values = {"f1": f1, "precision": precision, "recall": recall}.get(name)
    if values is None or kind not in ("", "weighted", "macro", "micro"):
        raise ValueError(f"unknown scoring {scoring!r}")
    if kind == "micro":
        return div(tn + tp, n)
    if kind == "weighted":
        return div(values[0] * support[0] + values[1] * support[1], n)
    return (values[0] + values[1]) / 2 if kind == "macro" else values[1]


#: Steps of probability in which held-out rows are counted.
STEPS = 1 << 12


def held_out_counts(y: np.ndarray, p: np.ndarray) -> np.ndarray:
    """tn, fp, fn, tp of decisions above one half, then rows of class 0 and of class 1 by step of probability."""
    said, step = p > 0.5, np.minimum((p * STEPS).astype(np.int64), STEPS - 1)
    real = y == 1
    counts = [np.sum(~real & ~said), np.sum(~real & said), np.sum(real & ~said), np.sum(real & said)]
    return np.concatenate([counts, np.bincount(step[~real], minlength=STEPS), np.bincount(step[real], minlength=STEPS)]).astype(float)


def held_out_score(counts: np.ndarray, scoring: str) -> float:
    """The score of held_out_counts(); the area under the curve takes rows of one step as equal."""
    if scoring == "roc_auc":
        none, one = counts[4 : 4 + STEPS], counts[4 + STEPS :]
        below = np.cumsum(none) - none
        pairs = none.sum() * one.sum()
        return float((one * (below + none / 2)).sum() / pairs) if pairs else 0.0
    return binary_score(*counts[:4].tolist(), scoring)


def best_point(scores: dict[object, list[float]]) -> tuple[object, float]:
    """The first point of the highest mean score."""
    means = {p: sum(s) / len(s) for p, s in scores.items()}
    best = max(means, key=lambda p: means[p])
    return best, means[best]


def grouped_by(items, key: Callable) -> dict:
    """Items by their keys, in their order."""
    out = defaultdict(list)
    for item in items:
        out[key(item)].append(item)
    return out


def grouped(points: Sequence[dict], *names: str) -> dict[tuple, list[dict]]:
    """Points by the values that they have of some parameters."""
    return grouped_by(points, lambda p: tuple(p.get(n) for n in names))
