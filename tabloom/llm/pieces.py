"""SentencePiece encoding and decoding of BPE models with byte fallback, in vectorised merge rounds.

A text falls into words that no piece crosses. The distinct words of a batch that aren't known yet lie in flat numpy
arrays of symbols. In each round every word finds the smallest rank among its neighbouring pairs (a segmented minimum),
merges all pairs of that rank at once, leftmost first, and the arrays are compacted; words without a pair leave. A
piece of which a longer piece of smaller or equal rank is made must merge one occurrence at a time, since the longer
piece comes before the next occurrence. A long word is cut wherever its two neighbouring characters stand together in no
piece, since no merge reaches over such a place; only what is still longer than `ROUND_SYMBOLS` is merged through a
queue, to the same result: its rounds would be too many. Ids are those of the library for the same model, without begin
or end ids or sampling.

Null and empty texts have no ids and decode to the empty text. Every row gives one row, repeated rows as well, and only
`id_col` and `text_col` are read, whatever other columns hold.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.frames import strings

#: Characters of the words that a task knows at a time, those beyond which a word is cut, and symbols that are merged in rounds at most.
KNOWN_CHARS, CUT_CHARS, ROUND_SYMBOLS = 6_000_000, 256, 4_096
#: Longer runs of spaces aren't kept.
KEPT_CHARS = 64

_SPACE = "▁"
_WORD = re.compile(r"\n| *[^ \n]+| +")
_NO_PAIR = np.int64(2**62)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("piece-bytes", _each_byte)


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of `flat` from each start on, one after another."""
    end = np.cumsum(length)
    return flat[np.repeat(start - (end - length), length) + np.arange(end[-1] if len(end) else 0)]


class PieceModel:
    """The pieces of a model, the pairs they are made of, and the merging and decoding of ids."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        own = [i for i in range(self.size) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.id_of = {pieces[i]: i for i in own}
        self.byte_id = {int(pieces[i][1:-1], 16): i for i in range(self.size) if model.is_byte(i)}
        rank = {pieces[i]: -model.get_score(i) for i in own}
        if "\n" in "".join(self.id_of) or any(_SPACE in p[1:] and p.strip(_SPACE) for p in self.id_of):
            raise ValueError("a piece crosses words")

        order = {score: i for i, score in enumerate(sorted(set(rank.values())))}
        table, restless = {}, np.zeros(self.size, bool)
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                left, right = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if left is not None and right is not None:
                    table[left * self.size + right] = (order[rank[piece]], i)
                    for part in (left, right):
                        restless[part] |= rank[pieces[part]] >= rank[piece]
        self.table, self.restless = table, restless
        self.pair = np.array(sorted(table), np.int64)
        self.pair_rank = np.array([table[p][0] for p in self.pair.tolist()], np.int64)
        self.pair_into = np.array([table[p][1] for p in self.pair.tolist()], np.int64)
        self.char_id = np.full(0x110000, -1, np.int64)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i

        inside = {(ord(a), ord(b)) for p in self.id_of for a, b in zip(p, p[1:])}
        self.inside = np.array(sorted((a << 21) + b for a, b in inside), np.int64)

        text = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else bytes([int(pieces[i][1:-1], 16)])
                if model.is_byte(i) else pieces[i].replace(_SPACE, " ").encode() for i in range(self.size)]
        self.spaced = np.array([p.startswith(_SPACE) for p in pieces], bool)
        self.control = np.array([model.is_control(i) for i in range(self.size)], bool)
        self.text_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.text_length = np.array([len(t) for t in text], np.int64)
        self.text_start = np.cumsum(self.text_length) - self.text_length
        self.runs: dict[int, list[int]] = {}
        digits = [f"{i},".encode() for i in range(self.size)]
        self.digit_bytes = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_length = np.array([len(d) for d in digits], np.int64)
        self.digit_start = np.cumsum(self.digit_length) - self.digit_length

    def _symbols(self, word: str) -> np.ndarray:
        """Ids of the characters; those without a piece count from the size on."""
        code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        found = self.char_id[code]
        return np.where(found < 0, self.size + code, found)

    def _ids(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and how many each has: the bytes of those without a piece."""
        many = np.ones(len(symbols), np.int64)
        at = np.flatnonzero(symbols >= self.size)
        if not at.size:
            return symbols, many
        code, which = np.unique(symbols[at] - self.size, return_inverse=True)
        coded = [[self.byte_id[b] for b in chr(c).encode()] for c in code.tolist()]
        many[at] = np.array([len(c) for c in coded])[which]
        out, begin = np.repeat(symbols, many), np.cumsum(many) - many
        table = np.array([c + [0] * (4 - len(c)) for c in coded])
        for k in range(4):
            held = many[at] > k
            out[begin[at[held]] + k] = table[which[held], k]
        return out, many

    def _queue(self, symbols: list[int]) -> np.ndarray:
        """One word through a queue of pairs: smallest rank first, then leftmost."""
        symbols = list(symbols)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and symbols[i] < self.size and symbols[j] < self.size:
                if pair := self.table.get(symbols[i] * self.size + symbols[j]):
                    heapq.heappush(waiting, (pair[0], i, j, symbols[i], symbols[j], pair[1]))

        for i in range(n - 1):
            offer(i)
        while waiting:
            _, i, j, left, right, into = heapq.heappop(waiting)
            if symbols[i] != left or symbols[j] != right or after[i] != j:
                continue
            symbols[i], symbols[j] = into, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([s for s in symbols if s >= 0], np.int64)

    def _pairs(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray, rank: np.ndarray, into: np.ndarray) -> None:
        """Sets rank and result of the pairs that begin at the places `at`."""
        rank[at] = _NO_PAIR
        at = at[at + 1 < symbol.size]
        at = at[(word[at] == word[at + 1]) & (symbol[at] < self.size) & (symbol[at + 1] < self.size)]
        key = symbol[at] * self.size + symbol[at + 1]
        place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        real = self.pair[place] == key
        rank[at[real]], into[at[real]] = self.pair_rank[place[real]], self.pair_into[place[real]]

    def _rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words at once, in rounds: (symbols, their words' numbers)."""
        symbol, word = self._symbols("".join(words)), np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, into = np.full(symbol.size, _NO_PAIR), np.zeros(symbol.size, np.int64)
        if symbol.size:
            self._pairs(symbol, word, np.arange(symbol.size), rank, into)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while symbol.size:
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            spread = np.repeat(least, np.diff(np.r_[first, symbol.size]))
            live = spread < _NO_PAIR
            if not live.all():
                done.append((symbol[~live], word[~live]))
                symbol, word, rank, into, spread = symbol[live], word[live], rank[live], into[live], spread[live]
                if not symbol.size:
                    break
            hit = np.flatnonzero(rank == spread)
            # of hits that overlap, every second one from the left
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            offset = np.arange(hit.size) - np.repeat(run, np.diff(np.r_[run, hit.size]))
            hit = hit[offset % 2 == 0]
            lead = np.r_[True, word[hit][1:] != word[hit][:-1]]
            hit = hit[lead | ~self.restless[into[hit]]]
            symbol[hit] = into[hit]
            keep = np.ones(symbol.size, bool)
            keep[hit + 1] = False
            symbol, word, rank, into = symbol[keep], word[keep], rank[keep], into[keep]
            fresh = hit - np.arange(hit.size)  # where the merged symbols lie now
            self._pairs(symbol, word, np.union1d(fresh, np.maximum(fresh - 1, 0)), rank, into)
        symbol, word = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _run(self, spaces: int) -> list[int]:
        if spaces not in self.runs:
            ids = self._ids(self._queue(self._symbols(_SPACE * spaces).tolist()))[0].tolist()
            if spaces > KEPT_CHARS:
                return ids
            self.runs[spaces] = ids
        return self.runs[spaces]

    def _cut(self, word: str) -> list[str]:
        """A word's parts between characters that no piece holds side by side."""
        code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        pair = (code[:-1] << 21) + code[1:]
        apart = self.inside[np.minimum(np.searchsorted(self.inside, pair), len(self.inside) - 1)] != pair
        edges = [0, *(np.flatnonzero(apart) + 1).tolist(), len(word)]
        return [word[b:e] for b, e in zip(edges, edges[1:])]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (spaces, then other characters), one after another, and how many each word has.

        Runs of spaces merge last, since their rank is the largest.
        """
        bare = [w.lstrip(" ") for w in words]
        spaces = [len(w) - len(b) for w, b in zip(words, bare)]
        core = [_SPACE + b if s and b else b for s, b in zip(spaces, bare)]
        parts, owner = core, np.arange(len(core))
        if max(map(len, core), default=0) > CUT_CHARS:
            cut = [self._cut(c) if len(c) > CUT_CHARS else [c] for c in core]
            parts, owner = [p for c in cut for p in c], np.repeat(owner, [len(c) for c in cut])
        symbol, part = self._rounds([p if len(p) <= ROUND_SYMBOLS else "" for p in parts])
        queued = [(i, self._queue(self._symbols(p).tolist())) for i, p in enumerate(parts) if len(p) > ROUND_SYMBOLS]
        if queued:
            symbol = np.concatenate([symbol, *(x for _, x in queued)])
            part = np.concatenate([part, *(np.full(len(x), i) for i, x in queued)])
            order = np.argsort(part, kind="stable")
            symbol, part = symbol[order], part[order]
        ids, many = self._ids(symbol)
        word = np.repeat(owner[part], many)

        blank = [i for i, s in enumerate(spaces) if s > 1 or s and not bare[i]]
        if blank:
            begin, end = np.searchsorted(word, blank, "left"), np.searchsorted(word, blank, "right")
            lone, runs = self.char_id[ord(_SPACE)], []
            gone = np.zeros(len(ids), bool)
            for i, b, e in zip(blank, begin.tolist(), end.tolist()):
                alone = b < e and ids[b] == lone
                if alone:
                    gone[b] = True
                runs.append(self._run(spaces[i] - (b < e and not alone)))
            ids = np.concatenate([np.array([x for r in runs for x in r], np.int64), ids[~gone]])
            word = np.concatenate([np.repeat(blank, [len(r) for r in runs]), word[~gone]])
            order = np.argsort(word, kind="stable")
            ids, word = ids[order], word[order]
        return ids, np.bincount(word, minlength=len(words))

    @staticmethod
    def words(text: str) -> list[str]:
        return _WORD.findall(" " + text.replace(_SPACE, " ")) if text else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library's decode gives it."""
        text = _gathered(self.text_bytes, self.text_start[ids], self.text_length[ids]).tobytes().decode("utf-8", "piece-bytes")
        lead = np.flatnonzero(~self.control[ids])
        return text[1:] if lead.size and self.spaced[ids[lead[0]]] else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


class _Known(dict):
    """Numbers of the words that a task knows, and their ids in one flat array. When it is full, the words of the last texts stay."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.words, self.chars = model, [], 0
        self.ids, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.last = np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def _forget(self) -> None:
        kept = [i for i in np.unique(self.last).tolist() if len(self.words[i]) <= KEPT_CHARS]
        words, at = [self.words[i] for i in kept], np.array(kept, np.int64)
        self.ids, self.count = _gathered(self.ids, self.start[at], self.count[at]), self.count[at]
        self.start, self.words = np.cumsum(self.count) - self.count, words
        self.chars = sum(map(len, words))
        self.clear()
        self.update(zip(words, range(len(words))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and how many each text has."""
        if self.chars > KNOWN_CHARS:
            self._forget()
        words = [self.model.words(t) for t in texts]
        size = np.array([len(w) for w in words], np.int64)
        number = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, int(size.sum()))
        for begin in range(len(self.count), len(self.words), 50_000):
            fresh = self.words[begin : begin + 50_000]
            ids, count = self.model.encode_words(fresh)
            self.start = np.r_[self.start, len(self.ids) + np.cumsum(count) - count]
            self.ids, self.count = np.r_[self.ids, ids.astype(np.int32)], np.r_[self.count, count]
            self.chars += sum(map(len, fresh))
        self.last = number
        upto = np.r_[0, np.cumsum(self.count[number])]
        edge = np.cumsum(size)
        return _gathered(self.ids, self.start[number], self.count[number]), np.diff(np.r_[0, upto[edge]])


def _groups(texts: list[str], chars: int = 1_500_000) -> Iterator[list[str]]:
    """Texts in order, some million characters at a time."""
    part, total = [], 0
    for text in texts:
        if part and total + len(text) > chars:
            yield part
            part, total = [], 0
        part.append(text)
        total += len(text)
    if part:
        yield part


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int>: the ids of every whole text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(piece_model(path))
        for batch in rows:
            at = 0
            for texts in _groups(strings(batch, "text")):
                ids, count = known.encode(texts)
                out = np.split(ids, np.cumsum(count)[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(out, pa.list_(pa.int32()))], ["id", "ids"])
                at += len(texts)

    return _renamed(df, id_col, text_col, run, "ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, text: the text of every row's ids; null ids give the empty text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in rows:
            out = [model.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["id", "text"])

    picked = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: digests of the ids of every whole text and of their decoded text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(piece_model(path))
        for batch in rows:
            at = 0
            for texts in _groups(strings(batch, "text")):
                ids, count = known.encode(texts)
                model, end = known.model, np.cumsum(count)
                length = model.digit_length[ids]
                digits = _gathered(model.digit_bytes, model.digit_start[ids], length).tobytes()
                stop = np.r_[0, np.cumsum(length)][np.r_[0, end]].tolist()
                coded = [hashlib.sha256(digits[b : max(b, e - 1)]).hexdigest() for b, e in zip(stop, stop[1:])]
                decoded = [hashlib.sha256(model.decode(own).encode()).hexdigest() for own in np.split(ids, end[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(count, pa.int64()), pa.array(coded), pa.array(decoded)],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)

    return _renamed(df, id_col, text_col, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _renamed(df: DataFrame, id_col: str, text_col: str, run, columns: str) -> DataFrame:
    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, {columns}").withColumnRenamed("id", id_col)
