"""Collocations: phrases whose words stand together more often than their parts explain, counted over FM-indexes.

Texts fall into pieces at punctuation and line ends, pieces into words. Counts are taken one length at a time:

1. Words are counted per task and summed. Words below `least` can't be part of a phrase that reaches it, so they part pieces.
2. For each longer length, a task cuts its texts into shards of words of one language and indexes each over dense word
   ids: a Burrows-Wheeler transform ordered by as many words as phrases have (a longer order changes no interval of a
   phrase), of the shard and of its reverse. Intervals of all phrases are extended at once, to the right in one index and
   to the left in the other; the extension's interval in the second index follows from the counts of smaller symbols.
   The phrases of the wanted length and their counts are summed across shards.
3. Only where all shorter phrases may reach `least` is a shard indexed: a bit table of fixed size holds hashes of the
   phrases of the length before. A bit that two phrases share lets more through, never less, so counts are exact.

Null texts are empty, a null language is `und`; every row counts, repeated rows as well; only the two columns are read. Phrases are
ordered by their UTF-8 bytes. Without rows or frequent phrases there are no rows. Products are decimals of 38 digits: exact
while the count of a phrase is below 10^16.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.frames import small
from tabloom.llm.words import mixed
from tabloom.session import checkpointed

#: Words of a shard, distinct words a task counts before it sends them on, bits of a table of hashes, and bits of it that a row packs.
SHARD_WORDS, COUNTED_WORDS, TABLE_BITS, ROW_BITS = 500_000, 400_000, 26, 15

_BREAK = b"."
_BREAKS = bytes(_BREAK[0] if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of texts in order, a full stop where a piece or a text ends."""
    return _BREAK.join(texts).lower().translate(_BREAKS).replace(_BREAK, b" . ").split()


class BidirectionalIndex:
    """FM-indexes of a sequence of ids and of its reverse, for patterns of up to `depth` ids. Id 0 ends pieces; no pattern crosses it."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.depth = np.r_[0, ids, 0].astype(np.int64), depth
        self.size, self.sigma = len(self.ids), int(self.ids.max()) + 1
        self.first = np.r_[0, np.cumsum(np.bincount(self.ids, minlength=self.sigma))]

    @cached_property
    def forward(self) -> np.ndarray:
        return self._transform(self.ids)

    @cached_property
    def backward(self) -> np.ndarray:
        return self._transform(self.ids[::-1])

    def _transform(self, ids: np.ndarray) -> np.ndarray:
        """The id before each suffix, suffixes in the order of their first `depth` ids."""
        rank, top = ids, self.sigma
        for k in range(1, self.depth):
            after = np.r_[ids[k:], np.zeros(min(k, len(ids)), np.int64)]
            if top * self.sigma >= 2**62:
                rank = np.unique(rank, return_inverse=True)[1]
                top = int(rank.max()) + 1
            rank, top = rank * self.sigma + after, top * self.sigma
        return np.roll(ids, 1)[np.argsort(rank)]

    def _before(self, transform: np.ndarray, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each row."""
        where = np.sort(transform * (self.size + 1) + np.arange(self.size))
        return np.searchsorted(where, symbol * (self.size + 1) + row) - self.first[symbol]

    def words(self) -> tuple[np.ndarray, ...]:
        """All patterns of one id: (ids, first row, first row in the reverse, count)."""
        symbol = np.arange(1, self.sigma)
        count = self.first[2:] - self.first[1:-1]
        symbol, count = symbol[count > 0], count[count > 0]
        return symbol[:, None], self.first[symbol], self.first[symbol], count

    def extended(self, patterns: tuple[np.ndarray, ...], right: bool, more: int = 2) -> tuple[np.ndarray, ...]:
        """All patterns that are one id longer at one side.

        `more` extensions are to come, the next at the other side: if it is 1, rows at this side aren't needed, if 0, none are.
        """
        ids, low, back, count = patterns
        transform, own, other = (self.backward, back, low) if right else (self.forward, low, back)
        owner = np.repeat(np.arange(len(ids)), count)
        row = np.arange(len(owner)) + np.repeat(own - (np.cumsum(count) - count), count)
        pair, many = np.unique(owner * self.sigma + transform[row], return_counts=True)
        owner, symbol = np.divmod(pair, self.sigma)
        before = np.cumsum(many) - many
        smaller = before - (np.cumsum(count) - count)[owner]  # of the rows of a pattern, those with a smaller id
        inside = symbol > 0
        owner, symbol, many, smaller = owner[inside], symbol[inside], many[inside], smaller[inside]
        longer = np.c_[ids[owner], symbol] if right else np.c_[symbol, ids[owner]]
        other = other[owner] + smaller if more else None
        own = self.first[symbol] + self._before(transform, symbol, own[owner]) if more > 1 else None
        return (longer, other, own, many) if right else (longer, own, other, many)

    def phrases(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """All patterns of `depth` ids, a row each, and their counts."""
        found = self.words()
        for k in range(1, depth):
            found = self.extended(found, right=k % 2 == 1, more=depth - 1 - k)
        return found[0], found[3]


class BitTable:
    """Hashes of phrases as bits of a table of fixed size."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)

    def holds(self, place: np.ndarray) -> np.ndarray:
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def phrase_places(hashes: np.ndarray, n: int) -> np.ndarray:
    """The bit of each stretch of n words, from the words' hashes."""
    total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        total = total * _SPREAD + hashes[k : len(total) + k]
    return (mixed(total) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def _by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    texts = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        texts[lang].append(text)
    return texts


_COUNTS = "lang string, phrase string, a long"


def _rows(lang: str, phrases: pa.Array, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(counts, pa.int64())], ["lang", "phrase", "a"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, a): every word's count, and in the row of a null phrase the count of all words. `docs` holds lang and text, no nulls."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Counter] = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, counts in known.items():
                counts.pop(_BREAK, None)
                yield _rows(lang, pa.array([None], pa.string()), [counts.total()])
                words, numbers = list(counts), list(counts.values())
                for at in range(0, len(words), 50_000):
                    yield _rows(lang, pa.array(words[at : at + 50_000], pa.binary()).cast(pa.string()), numbers[at : at + 50_000])
            known.clear()

        for batch in small(rows):
            for lang, texts in _by_language(batch).items():
                known[lang].update(words_of(texts))
            if sum(map(len, known.values())) > COUNTED_WORDS:
                yield from sent()
        yield from sent()

    return docs.mapInArrow(run, _COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def bit_table(phrases: DataFrame) -> bytes:
    """A table of fixed size with a bit for every (lang, phrase); built by executors, 2^TABLE_BITS / 8 bytes on the driver."""

    def places(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = _seed(lang)
                words = np.array([xxhash.xxh64_intdigest(w, seed) for w in phrase.encode().split(b" ")], np.uint64)
                found.append(phrase_places(words, len(words)))
            place = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> ROW_BITS), pa.array(place & (1 << ROW_BITS) - 1)], ["row", "bit"])

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in rows:
            row, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for r in np.unique(row).tolist():
                if r not in known:
                    known[r] = np.zeros(1 << ROW_BITS, bool)
                known[r][bit[row == r]] = True
        for r, bits in known.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])], ["row", "bits"])

    rows = phrases.select("lang", "phrase").mapInArrow(places, "row long, bit long").distinct().repartition("row").mapInArrow(packed, "row long, bits binary")
    table = bytearray(1 << TABLE_BITS - 3)
    step = 1 << ROW_BITS - 3
    for r in rows.toLocalIterator():
        table[r["row"] * step : (r["row"] + 1) * step] = r["bits"]
    return bytes(table)


class _Vocabulary(dict):
    """Numbers of a language's words in a task, from 1 in the order of their coming; a piece's end is 0."""

    def __init__(self, lang: str):
        super().__init__({_BREAK: 0})
        self.seed, self.words, self.hashes, self.often = _seed(lang), [_BREAK], [np.zeros(1, np.uint64)], np.zeros(1, bool)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def numbers(self, words: list[bytes], table: BitTable) -> np.ndarray:
        """The words' numbers, 0 for those that the table doesn't hold."""
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if len(self.words) > len(self.often):
            self.hashes.append(np.array([xxhash.xxh64_intdigest(w, self.seed) for w in self.words[len(self.often):]], np.uint64))
            self.often = np.r_[self.often, table.holds(phrase_places(self.hashes[-1], 1))]
        return np.where(self.often[numbers], numbers, 0)


class _Shards:
    """A task's words by language, as numbers; rare words and piece ends are 0."""

    def __init__(self, words: BitTable, shorter: BitTable | None, depth: int):
        self.words, self.shorter, self.depth, self.size = words, shorter, depth, 0
        self.known: dict[str, _Vocabulary] = {}
        self.ids: dict[str, list[np.ndarray]] = defaultdict(list)

    def add(self, lang: str, texts: list[bytes]) -> None:
        if lang not in self.known:
            self.known[lang] = _Vocabulary(lang)
        ids = self.known[lang].numbers(words_of(texts), self.words)
        ids = ids[np.r_[True, (ids[1:] > 0) | (ids[:-1] > 0)]] if len(ids) else ids
        self.ids[lang].append(np.r_[ids, 0])
        self.size += len(ids)

    def _runs(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The stretches in which each phrase one word shorter may be frequent, parted by 0."""
        n = self.depth - 1
        whole = np.ones(max(0, len(ids) - n + 1), bool)
        for k in range(n):
            whole &= ids[k : len(whole) + k] > 0
        whole[whole] &= self.shorter.holds(phrase_places(hashes[ids], n)[whole])
        edge = np.diff(np.r_[0, whole.astype(np.int8), 0])
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begin, end = begin[end - begin > 1], end[end - begin > 1] + n - 1
        length = end - begin + 1  # with a 0 behind
        at = np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)
        out = ids[np.minimum(at, len(ids) - 1)] if len(at) else ids[:0]
        out[np.cumsum(length) - 1] = 0
        return out

    def counted(self) -> Iterator[pa.RecordBatch]:
        """The phrases of all shards, which are let go; so are the vocabularies, once they are large."""
        for lang, parts in self.ids.items():
            known = self.known[lang]
            ids = np.concatenate(parts)
            if self.shorter is not None:
                known.hashes = [np.concatenate(known.hashes)]
                ids = self._runs(ids, known.hashes[0])
            used = np.unique(ids[ids > 0])
            if not used.size:
                continue
            dense = np.zeros(len(known.words), np.int64)
            dense[used] = np.arange(1, used.size + 1)
            text = pa.array([known.words[i] for i in used.tolist()], pa.binary())
            found, count = BidirectionalIndex(dense[ids], self.depth).phrases(self.depth)
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                columns = [text.take(pa.array(part[:, k] - 1)) for k in range(self.depth)]
                yield _rows(lang, pc.binary_join_element_wise(*columns, b" ").cast(pa.string()), count[at : at + 50_000])
        self.ids.clear()
        self.size = 0
        if sum(map(len, self.known.values())) > COUNTED_WORDS:
            self.known.clear()


def phrase_counts(docs: DataFrame, depth: int, words: bytes, shorter: bytes | None) -> DataFrame:
    """(lang, phrase, a): every phrase of `depth` words that may be frequent after the tables of words and of phrases one word shorter."""
    sc = docs.sparkSession.sparkContext
    tables = sc.broadcast((words, shorter))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before = tables.value
        shards = _Shards(BitTable(own), BitTable(before) if before is not None else None, depth)
        for batch in small(rows):
            for lang, texts in _by_language(batch).items():
                shards.add(lang, texts)
            if shards.size > SHARD_WORDS:
                yield from shards.counted()
        yield from shards.counted()

    # shards have counted already: a second count before the rows move would find few equal ones
    return docs.mapInArrow(run, _COUNTS).repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def counts(df: DataFrame, longest: int = 3, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> list[DataFrame]:
    """For each length from 1 the (lang, phrase, a) that occur `least` times or more; the first also has the row of a null phrase."""
    docs = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = [checkpointed(word_counts(docs).where((F.col("a") >= least) | F.col("phrase").isNull()))]
    words = shorter = None
    for depth in range(2, longest + 1):
        table = bit_table(found[-1].where(F.col("phrase").isNotNull()))
        words, shorter = (table, None) if depth == 2 else (words, table)
        found.append(checkpointed(phrase_counts(docs, depth, words, shorter).where(F.col("a") >= least)))
    return found


def _part(begin: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", begin, length), " ")


def collocations(df: DataFrame, longest: int = 3, least: int = 10, top: int = 2_000, covered: int = 50, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `longest` words.

    `a` is the phrase's count, `l` and `r` those of its parts at the cut that scores lowest, `n` the language's words. A phrase
    goes if a longer one of at least `covered` percent of its count holds it.
    """
    found = counts(df, longest, least, text_col, lang_col)
    total = found[0].where(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    known = found[0].where(F.col("phrase").isNotNull())
    phrases = None
    for n, more in enumerate(found[1:], 2):
        more = more.withColumn("size", F.lit(n))
        phrases = more if phrases is None else phrases.unionByName(more)
    known = known.unionByName(phrases.drop("size"))
    phrases = phrases.withColumn("words", F.split("phrase", " "))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice("words", i, k), " ")))))
    held = phrases.where("size > 2").select("lang", "a", inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = phrases.join(held, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < covered * F.col("a"))).drop("most")

    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    value = F.expr("(1000000 * cast(a as decimal(16,0)) * cast(a as decimal(16,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each of 64 parts of a language may hold its first ones, so a task orders 64 times `top` rows of it at most
    dealt = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return dealt.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
