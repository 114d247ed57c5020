"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text. A text is parsed against it: each phrase is the longest
match that starts where the last one ended. The fewer phrases a letter takes, weighted by the bits that name a place in the
training text, the closer the language; the language with the lowest cost wins.

Fitting reads a bounded sample of the labelled rows of every language: up to `SAMPLE_ROWS` documents, chosen by a hash of their id and text,
and up to `SAMPLE_CHARS` letters of them, in windows of `WINDOW` letters that are spread over each whole text. The automata have at
most 3 x SAMPLE_CHARS arcs a language and are stored by arcs, so their size depends neither on the corpus nor on the alphabets.
Languages are sent and scored `GROUP` at a time; a task holds the automata of one group. Scoring reads every whole text. Texts are lower-cased; what isn't a letter ends a word,
and runs of such characters count as one. Stretches of `STRETCH` characters are parsed in lockstep; then the phrase that is open at the
end of a stretch is followed into the next one until a phrase begins where one begins there too. From that place on both
parses are the same, so the phrases are the longest matches of the whole text, wherever it was cut.

A text that is null or has no letter is `und`, with score 0. Ties go to the language that comes first in order. The score is
the lead of the winner: 1 - its cost / the next one's (1 if there is one language only). Without labelled rows every text
is `und`. Rows with a null label teach nothing; repeated rows teach once, those of a null id like any others; every row gives one
row, repeated rows as well.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.frames import small, strings
from tabloom.session import checkpointed

SAMPLE_ROWS, SAMPLE_CHARS, WINDOW, GROUP, STRETCH = 200, 20_000, 40, 64, 512
UNKNOWN = "und"
MAX_SENT_KEYS = 200_000  # some 10 MB: a thousand labels

#: Anything but letters and the few numerals that aren't digits.
_OTHER = re.compile(r"[\W\d_]+")
_GAP = 1  # the code of what is between words; 0 is a letter that no automaton knows


def letters(text: str) -> str:
    """Lower case, with one space for each run of other characters."""
    bare = _OTHER.sub(" ", text.lower()).strip()
    return bare if any(c.isalpha() for c in bare) else ""


class SuffixAutomaton:
    """The automaton of all substrings of some text, built letter by letter."""

    def __init__(self, codes: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in codes:
            own = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = own
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[own] = q
                else:
                    twin = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = link[p]
                    link[q] = link[own] = twin
            last = own


class Arcs:
    """The arcs of an automaton in one array: that of a state and a symbol is at base[state] + symbol, if `own` there is the state."""

    def __init__(self, arcs: list[dict[int, int]], width: int):
        size = sum(map(len, arcs)) * 3 // 2 + 2 * width
        base, own, target = [0] * len(arcs), [-1] * size, [0] * size
        place, free = random.Random(0), 0
        for state in sorted(range(len(arcs)), key=lambda i: -len(arcs[i])):
            symbols = list(arcs[state])
            if len(symbols) == 1:  # the last ones fill what is left
                while own[free] >= 0 or free < symbols[0]:
                    free += 1
                base[state] = free - symbols[0]
            elif symbols:
                at, tries = place.randrange(size - width), 0
                while any(own[at + c] >= 0 for c in symbols):
                    tries += 1
                    if tries % 500 == 0:
                        own, target, size = own + [-1] * size, target + [0] * size, 2 * size
                    at = place.randrange(size - width)
                base[state] = at
            for c, to in arcs[state].items():
                own[base[state] + c], target[base[state] + c] = state, to
        self.base, self.own, self.target = (np.array(x, np.int32) for x in (base, own, target))

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is no arc."""
        at = self.base[state] + symbol
        return self.target[at] * (self.own[at] == state)


class Parser:
    """The automata of languages; state 0 is the start, and as a target it means no step."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        known = sorted(set().union(*samples.values()) - {" "})
        self.width = len(known) + 2
        self.code = np.zeros(0x110000, np.int32)
        self.code[32] = _GAP
        for i, c in enumerate(known):
            self.code[ord(c)] = i + 2
        self.arcs, self.bits = [], []
        for language in self.languages:
            codes = self._codes(samples[language]).tolist()
            self.arcs.append(Arcs(SuffixAutomaton(codes).next, self.width))
            self.bits.append(np.log2(max(len(codes), 2)))

    def groups(self, size: int = GROUP) -> list[Parser]:
        """Parsers of at most `size` of the languages each."""
        out = []
        for at in range(0, max(len(self.languages), 1), size):
            part = copy(self)
            part.languages, part.arcs, part.bits = (x[at : at + size] for x in (self.languages, self.arcs, self.bits))
            out.append(part)
        return out

    def _codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def costs(self, texts: list[str], stretch: int = STRETCH) -> np.ndarray:
        """Bits a character of each text (rows) in each language (columns); nan without letters."""
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = self._codes("".join(texts))
        pieces = -(-sizes // stretch)
        owner = np.repeat(np.arange(len(texts)), pieces)
        ends = np.cumsum(sizes)
        nth = np.arange(owner.size) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (ends - sizes)[owner] + nth * stretch
        length = np.minimum(stretch, sizes[owner] - nth * stretch)
        order = np.argsort(-length, kind="stable")
        alive = np.searchsorted(-length[order], -np.arange(stretch), "left")  # stretches longer than each position
        places = [begin[order[:n]] + t for t, n in enumerate(alive.tolist()) if n]
        symbols = [flat[at] for at in places]
        later = np.flatnonzero(nth)
        out = np.full((len(texts), len(self.languages)), np.nan)
        for k, (arcs, bits) in enumerate(zip(self.arcs, self.bits)):
            state, starts = np.zeros(owner.size, np.int32), np.zeros(flat.size, bool)
            for at, symbol in zip(places, symbols):
                n = symbol.size
                to = arcs.step(state[:n], symbol)
                miss = to == 0
                starts[at] = miss | (state[:n] == 0)
                again = symbol[miss]
                to[miss] = arcs.step(np.zeros_like(again), again)
                state[:n] = to
            left = np.empty_like(state)
            left[order] = state
            open_ = later[arcs.step(left[later - 1], flat[begin[later]]) > 0]
            counts = np.concatenate([[0], np.cumsum(starts)])
            total = counts[ends] - counts[ends - sizes]
            extra = _joined(arcs, flat, starts, begin[open_], left[open_ - 1], ends[owner[open_]])
            np.add.at(total, owner[open_], extra)
            with np.errstate(invalid="ignore", divide="ignore"):
                out[:, k] = np.where(sizes > 0, total * bits / sizes, np.nan)
        return out


def _joined(arcs: Arcs, flat: np.ndarray, starts: np.ndarray, begin: np.ndarray, states: np.ndarray, end: np.ndarray) -> list[int]:
    """By how many phrases each phrase that goes on over the border at `begin` changes the count of its text.

    The walk from a border ends where a phrase starts in both parses; borders that an earlier walk has passed change nothing more.
    """
    base, own, target = memoryview(arcs.base), memoryview(arcs.own), memoryview(arcs.target)
    symbols, marks = memoryview(flat), memoryview(starts)
    out, p = [], 0
    for first, state, stop in zip(begin.tolist(), states.tolist(), end.tolist()):
        change = 0
        if first >= p:
            p = first
            while p < stop:
                c = symbols[p]
                at = base[state] + c
                to = target[at] if own[at] == state else 0
                if not (state and to):  # a phrase starts here
                    if marks[p]:
                        p += 1  # a border here is settled
                        break
                    change += 1
                    to = target[base[0] + c] if own[base[0] + c] == 0 else 0
                elif marks[p]:
                    change -= 1
                state = to
                p += 1
        out.append(change)
    return out


def decide(languages: list[str], costs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language and score of each row of costs."""
    if not languages:
        return [UNKNOWN] * len(costs), np.zeros(len(costs))
    empty = np.isnan(costs[:, 0])
    costs[empty] = 1.0
    best = costs.argmin(axis=1)
    low = costs[np.arange(len(costs)), best]
    if len(languages) > 1:
        lead = 1 - low / np.partition(costs, 1, axis=1)[:, 1]
    else:
        lead = np.ones(len(costs))
    return [UNKNOWN if e else languages[b] for e, b in zip(empty, best)], np.where(empty, 0.0, np.clip(lead, 0, 1))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS,
        chars: int = SAMPLE_CHARS) -> Parser:
    """Automata of the bounded sample of every label, which is all that the driver gets to hold.

    The letters are taken evenly: as many from each document, and what short documents leave goes to the others.
    """

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = pa.array([spread(letters(t), chars) for t in strings(batch)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["lang", "text"])

    def sampled(own: pa.Table) -> pa.Table:
        texts = sorted(own.column("text").to_pylist())
        return pa.table({"lang": own.column("lang")[:1], "text": pa.array([sample(texts, chars)], pa.string())})

    named = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    keys = named.select("lang", "h", F.pmod("h", F.lit(16)).alias("part")).distinct()
    for within in (["lang", "part"], ["lang"]):  # few rows are left to the one task of a label
        nth = F.row_number().over(Window.partitionBy(*within).orderBy("h"))
        keys = keys.withColumn("nth", nth).where(F.col("nth") <= rows).drop("nth")
    keys = checkpointed(keys.select("lang", "h"))
    if keys.count() <= MAX_SENT_KEYS:
        keys = F.broadcast(keys)
    taken = named.join(keys, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])
    short = taken.select("lang", "text").mapInArrow(bare, "lang string, text string")
    held = short.groupBy("lang").applyInArrow(sampled, "lang string, text string").collect()
    return Parser({r["lang"]: r["text"] for r in held})


def spread(text: str, chars: int) -> str:
    """At most `chars` characters, in windows from the first to the last part of the text."""
    if len(text) <= chars:
        return text
    n = max((chars + 1) // (WINDOW + 1), 1)
    if n == 1:
        return text[(len(text) - chars) // 2 :][:chars]
    return " ".join(text[i : i + WINDOW] for i in ((len(text) - WINDOW) * k // (n - 1) for k in range(n)))


def sample(texts: list[str], chars: int) -> str:
    """At most `chars` characters, evenly from all texts."""
    out, left = [], chars
    for i, text in enumerate(sorted(texts, key=len)):
        part = spread(text, max(left, 0) // (len(texts) - i))
        out.append(part)
        left -= len(part) + 1
    return " ".join(out)


def _sent(df: DataFrame, parser: Parser) -> Callable[[list[str]], tuple[list[str], np.ndarray]]:
    """What predicts the languages and scores of texts of any number in a task, a few million characters at a time."""
    groups = [df.sparkSession.sparkContext.broadcast(g) for g in parser.groups()]  # at most GROUP x 3 x SAMPLE_CHARS arcs each
    languages = parser.languages

    def costs(group, texts: list[str]) -> np.ndarray:
        out = group.value.costs(texts)
        if len(groups) > 1:
            vars(group).pop("_value", None)  # read again from the executor's file for the next texts
        return out

    def predicted(texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, scores, at = [], [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= 2_000_000):
                size += len(texts[end])
                end += 1
            bare = [letters(t) for t in texts[at:end]]
            own, lead = decide(languages, np.hstack([costs(g, bare) for g in groups]))
            langs += own
            scores.append(lead)
            at = end
        return langs, np.concatenate(scores) if scores else np.zeros(0)

    return predicted


def identify(df: DataFrame, parser: Parser, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score for every whole text."""
    predicted = _sent(df, parser)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(rows):
            langs, scores = predicted(strings(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def in_known_language(df: DataFrame, parser: Parser, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows with a language, all columns as they are but for a null `lang_col`, which gets the predicted one."""
    predicted = _sent(df, parser)
    where, named = df.columns.index(text_col), df.columns.index(lang_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(rows):
            langs = pa.array(predicted([t or "" for t in batch.column(where).to_pylist()])[0], pa.string())
            columns = list(batch.columns)
            columns[named] = pc.coalesce(columns[named], langs.cast(columns[named].type))
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pc.not_equal(langs, UNKNOWN))

    return df.mapInArrow(run, df.schema)
