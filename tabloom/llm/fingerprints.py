"""Document fingerprints by Order MinHash: sensitive to edit distance, not only to which pieces occur.

Each k-mer of a text (k code points) is numbered by its occurrence, so that repeats are elements of their own. For each
of `SLOTS` hash functions the `TUPLE` elements of smallest hash are selected, put back in the order in which they stand in
the text, and hashed together. Two fingerprints are as alike as the share of their slots that agree: a slot agrees when
the same elements were selected in the same order.

Texts shorter than k + TUPLE - 1 code points have too few k-mers; their slots all hash the text itself, so that equal short texts
agree everywhere and others nowhere. Null is empty. Equal texts have equal fingerprints. Memory is bounded by the
longest text: its elements are hashed a block at a time, and a block keeps `TUPLE` of them per slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.frames import strings
from tabloom.llm.words import mixed
from tabloom.session import checkpointed

K, TUPLE, SLOTS = 8, 2, 32
#: Elements that are hashed for all slots together.
BLOCK = 1 << 12

_ODD = (np.random.default_rng(17).integers(0, 1 << 31, SLOTS, np.uint64) * 2 + 1).astype(np.uint32)
_SALT = np.random.default_rng(18).integers(0, 1 << 32, SLOTS, np.uint64).astype(np.uint32)
_SLOT = np.random.default_rng(19).integers(0, 1 << 63, SLOTS, np.uint64)
_ROOM = np.empty(SLOTS * BLOCK, np.uint32)
_GROW = np.uint64(0x9E3779B97F4A7C15)
_SQUARES = {w: np.uint64(pow(0x9E3779B97F4A7C15, 2 * w, 1 << 64)) for w in (1, 2, 4)}


def _elements(code: np.ndarray) -> np.ndarray:
    """A hash of each k-mer together with its occurrence number, by place."""
    n = len(code) - K + 1
    h, grow = code, _GROW
    for width in (1, 2, 4):  # doubled until K wide
        h = h[:-width] * grow + h[width:]
        grow = _SQUARES[width]
    h = mixed(h)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    place = np.arange(n, dtype=np.uint64)
    ordered = np.sort(h >> bits << bits | place)  # by k-mer, then by place
    key = ordered >> bits
    again = np.flatnonzero(key[1:] == key[:-1]) + 1
    if again.size:
        run = np.flatnonzero(np.r_[True, np.diff(again) != 1])
        number = np.arange(1, again.size + 1) - np.repeat(run, np.diff(np.r_[run, again.size]))
        at = (ordered[again] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        h[at] = mixed(h[at] + number.astype(np.uint64) * _GROW)
    return h


def fingerprint(text: str) -> np.ndarray:
    """A 32-bit number for each slot."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(code) < K + TUPLE - 1:
        own = np.frombuffer(hashlib.blake2b(text.encode(), digest_size=8).digest(), np.uint64)[0]
        return mixed(_SLOT ^ own).astype(np.uint32)
    element = _elements(code)
    short = (element >> np.uint64(32)).astype(np.uint32)
    rows = np.arange(SLOTS)
    best = np.full((SLOTS, TUPLE), -1)
    worst = np.full((SLOTS, TUPLE), np.iinfo(np.uint64).max, np.uint64)  # hash and place of what is selected
    for begin in range(0, len(short), BLOCK):
        part = short[begin : begin + BLOCK]
        h = _ROOM[: SLOTS * len(part)].reshape(SLOTS, -1)
        np.bitwise_xor(part, _SALT[:, None], out=h)
        np.multiply(h, _ODD[:, None], out=h)
        for _ in range(min(TUPLE, h.shape[1])):
            at = h.argmin(axis=1)
            rank = h[rows, at].astype(np.uint64) << np.uint64(31) | (begin + at).astype(np.uint64)
            h[rows, at] = np.iinfo(np.uint32).max
            last = worst.argmax(axis=1)
            better = rank < worst[rows, last]
            worst[rows[better], last[better]] = rank[better]
            best[rows[better], last[better]] = (begin + at)[better]
    best.sort(axis=1)
    out = _SLOT
    for j in range(TUPLE):
        out = mixed(out * _GROW ^ element[best[:, j]])
    return out.astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def written(slots: np.ndarray) -> str:
    return slots.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following text, or all of it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, fingerprint (hex of 32 bits a slot) of every whole text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = [written(fingerprint(t)) for t in strings(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["id", "fingerprint"])

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


_COLUMNS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _compared(text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    changed = edited(text, following)
    slots = own if changed == text else fingerprint(changed)
    return (len(text), hashlib.sha256(changed.encode()).hexdigest(), written(own), written(slots), likeness(own, slots), likeness(own, other))


def _neighbours(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted task against the next one. The last row waits for the next task's first, so both leave as they are."""
    task = TaskContext.get().partitionId()
    kind, before, first = None, None, None
    for batch in rows:
        kind = batch.schema.field(0).type
        ids, texts = batch.column(0).to_pylist(), strings(batch)
        for at in range(0, len(texts), 512):
            own, out = [], []
            for key, text in zip(ids[at : at + 512], texts[at : at + 512]):
                slots = fingerprint(text)
                if before is None:
                    first = (key, text)
                else:
                    own.append(before[0])
                    out.append((*_compared(before[1], before[2], text, slots), None, None, None))
                before = (key, text, slots)
            if own:
                yield _batch(own, out, kind)
    if before is not None:
        nothing = (None,) * 6
        yield _batch([first[0], before[0]], [(*nothing, task, 0, first[1]), (*nothing, task, 1, before[1])], kind)


def _batch(ids: list, out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string())
    names = ("id", *(c.split()[0] for c in _COLUMNS.split(", ")), "task", "side", "text")
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array(x, t) for x, t in zip(zip(*out), types))], names)


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with the next row's text, by descending id; the first follows the last.

    Ids that are equal follow each other by text, descending; null ids come last. Texts are sorted once, by range of the
    id, and compared inside their task; only two rows of each task are joined across tasks. A single row is its own next.
    """
    spark = df.sparkSession
    picked = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text").desc()]
    dealt = picked.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.desc("text"))
    kind = picked.schema["id"].dataType.simpleString()
    seen = checkpointed(dealt.mapInArrow(_neighbours, f"id {kind}, {_COLUMNS}, task int, side int, text string"))
    edge = seen.where("task is not null")
    # tasks with rows, in order: a number for each, and the one that follows it
    tasks = [r["task"] for r in edge.where("side = 0").select("task").orderBy("task").collect()]
    after = dict(zip(tasks, tasks[1:] + tasks[:1]))
    follow = spark.createDataFrame(list(after.items()), "task int, next_task int")
    last = edge.where("side = 1").select("task", "id", F.col("text").alias("own"))
    head = edge.where("side = 0").select(F.col("task").alias("next_task"), F.col("text").alias("following"))
    pairs = last.join(follow, "task").join(head, "next_task").select("id", "own", "following")

    def across(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for own, following in zip(strings(batch, "own"), strings(batch, "following")):
                out.append((*_compared(own, fingerprint(own), following, fingerprint(following)), None, None, None))
            if out:
                yield _batch(batch.column(0).to_pylist(), out, batch.schema.field(0).type).select(range(7))

    inner = seen.where("task is null").drop("task", "side", "text")
    return inner.unionByName(pairs.mapInArrow(across, f"id {kind}, {_COLUMNS}")).withColumnRenamed("id", id_col)
