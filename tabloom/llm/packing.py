"""Best-fit packing of tokenised documents into sequences of a fixed capacity, by large-item matching.

Lengths are whole numbers up to the capacity, so which lengths share a sequence follows from the count of pieces per
length, a table of at most `capacity` rows whatever the corpus holds. The driver plans on these counts alone:

1. Pieces above one third of the capacity are large; at most two fit a sequence. From the longest down, each is matched
   with the longest other large piece that fits beside it. Equal lengths are matched in bulk.
2. Smaller pieces, longest first, go where the remaining gap is smallest. Pieces that fit nowhere open sequences.

The plan is a list of runs: pieces of one length, by rank, go to consecutive sequences at one offset. Executors rank the
pieces within their length (a count per task and length, then a running sum over tasks; no length is gathered in one
task) and look their run up.

Null and empty texts are one piece that holds the end id alone. Every row is packed, repeated rows as well. Ties in
length are ranked by task and place in it, so which of two equally long pieces goes where may differ between runs; the
number and the fill of the sequences do not. Without rows there are no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm.frames import small, utf8
from tabloom.session import checkpointed

CAPACITY, END_ID = 4096, 1
#: Words whose ids a task keeps at a time, and the bytes up to which a word is kept.
KNOWN_WORDS, KEPT_BYTES = 600_000, 64


#: The tokenizer's split of lower-case ASCII text, and the characters for which its byte-level step writes bytes. Fixed values.
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b if b in _PRINTED else 256 + b - sum(p < b for p in _PRINTED) for b in range(256)}
_TAIL = b".,!?;:|*#%&$"
#: Below it, letters are lower-cased alike by the tokenizer and by Python.
_LATIN = "\u0250"


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class _Aged(dict):
    """A dictionary of bounded size that computes what it lacks. When half of it is new, the older half goes, but for what was asked for since."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.half, self.old = make, size // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Known:
    """Ids of words between ASCII white space, which this kind of tokenizer drops and never crosses.

    Plain words go to the tokenizer's merges directly, lower-cased, without its normaliser and splitter, which leave them as
    they are; any other word takes the whole way.
    """

    def __init__(self, path: str, size: int = KNOWN_WORDS):
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.words, self.parts = _Aged(self._word, size), _Aged(self._part, size)

    def _part(self, part: bytes) -> bytes:
        text = part.decode() if part.isascii() else part.decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(_TAIL)
        if core.isalpha():  # ASCII letters
            begin = self.parts[core.lower()]
            return begin + self.parts[word[len(core):]] if len(core) < len(word) else begin
        text = word.decode()
        if "<|" in text or len(text) > KEPT_BYTES:
            return self._whole(text)
        if text.isascii():
            if not text.isprintable():
                return self._whole(text)
            return b"".join([self.parts[p.encode()] for p in _ASCII_PARTS.findall(text.lower())])
        core = core.decode()
        lower = core.lower()
        if core and lower.isalpha() and max(core) < _LATIN and core.isalpha() and unicodedata.is_normalized("NFC", core):
            begin = self.parts[lower.encode()]
            return begin + self.parts[text[len(core):].encode()] if len(core) < len(text) else begin
        return self._whole(text)

    def ids(self, words: list[bytes]) -> bytes:
        """Ids of a text's words, as little-endian 32-bit numbers."""
        if max(map(len, words), default=0) > KEPT_BYTES:
            return b"".join([self.words[w] if len(w) <= KEPT_BYTES else self._word(w) for w in words])
        return b"".join(map(self.words.__getitem__, words))


_PIECES = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("place", pa.int64())])


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids of every whole text: id_col, piece, start, length, ids_crc32, task, place, and ids if asked.

    `place` counts the pieces of that length in the task that made them.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, count = _Known(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in small(rows):
            for at in range(0, batch.num_rows, 256):
                out, source, own = [], [], []
                for i, text in enumerate(utf8(batch.slice(at, 256))):
                    coded = known.ids(text.split()) + end
                    for k, begin in enumerate(range(0, len(coded), 4 * capacity)):
                        part = coded[begin : begin + 4 * capacity]
                        length = len(part) // 4
                        out.append((k, begin // 4, length, zlib.crc32(part), task, count[length]))
                        source.append(at + i)
                        count[length] += 1
                        if with_ids:
                            own.append(np.frombuffer(part, "<u4").astype(np.int32))
                arrays = [batch.column(0).take(pa.array(source))] + [pa.array(x, f.type) for x, f in zip(zip(*out), _PIECES)]
                names = ["id", *_PIECES.names]
                if with_ids:
                    arrays.append(pa.array(own, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = f"id {picked.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, task int, place long"
    return picked.mapInArrow(run, columns + ", ids array<int>" * with_ids).withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset) for so many pieces of each length.

    Pieces first rank .. first rank + pieces - 1 of the length go to consecutive sequences at the offset; a step of 0
    sequences doesn't occur.
    """
    left = {length: n for length, n in counts.items() if n}
    used: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> ranges of sequences (first, number)
    sizes: list[int] = []  # the gaps that have sequences, ascending

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n

    def leave(gap: int, first: int, n: int) -> None:
        if gap:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, n))

    large = sorted(x for x in left if 3 * x > capacity)
    while large:
        a = large[-1]
        b = bisect_left(large, capacity - a + 1) - 1
        partner = large[b] if b >= 0 else None
        if partner == a and left[a] == 1:
            partner = large[b - 1] if b else None
        if partner is None:
            n = left[a]
            put(a, n, sequences, 0)
        elif partner == a:
            n = left[a] // 2
            put(a, n, sequences, 0)
            put(a, n, sequences, a)
            left[a] -= n
        else:
            n = min(left[a], left[partner])
            put(a, n, sequences, 0)
            put(partner, n, sequences, a)
            left[partner] -= n
        left[a] -= n
        leave(capacity - a - (partner or 0), sequences, n)
        sequences += n
        large = [x for x in large if left[x]]

    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[s]
        while n:
            at = bisect_left(sizes, s)
            if at == len(sizes):
                whole, rest = divmod(n, capacity // s)
                for k in range(capacity // s if whole else 0):
                    put(s, whole, sequences, k * s)
                leave(capacity - capacity // s * s, sequences, whole) if whole else None
                sequences += whole
                for k in range(rest):
                    put(s, 1, sequences, k * s)
                if rest:
                    leave(capacity - rest * s, sequences, 1)
                    sequences += 1
                break
            gap = sizes[at]
            first, m = gaps[gap].pop()
            if m > n:
                gaps[gap].append((first + n, m - n))
                m = n
            if not gaps[gap]:
                sizes.pop(at)
            put(s, m, first, capacity - gap)
            leave(gap - s, first, m)
            n -= m
    return runs


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. `cut` is what pieces() gives; it is checkpointed."""
    cut = checkpointed(cut)
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    ranked = cut.join(offsets, ["length", "task"]).withColumn("rank", F.col("place") + F.col("before")).drop("place", "before", "task")
    step = int(max(counts.values(), default=0)) + 1  # (length, rank) as one sorted number
    key = runs[:, 0] * step + runs[:, 1]

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = np.searchsorted(key, length * step + rank, "right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            sequence, offset = runs[run, 3] + rank - runs[run, 1], runs[run, 4]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(place, ", ".join([*kept, "sequence_id long", "offset long"]))
