"""Secret scans with a trigram inverted index.

Each rule is a regular expression. A Boolean query over trigrams is derived from its syntax: what every match must hold.
The texts of a task are indexed a segment at a time: for each trigram that some rule asks for, the sorted list of the
documents that have it (in lower-case ASCII). Intersecting and uniting these lists gives each rule's candidates, which
are verified with the expression on the whole text. Rules without a mandatory trigram scan every document. Segments are
bounded in bytes, so neither the index nor a task's memory grows with the table, and no text leaves its task.

Null and empty texts have no spans. Every row gives one row, repeated rows as well; only `id_col` and `text_col` are
read. Spans are in code points, end exclusive; a kind's spans don't overlap, those of different kinds may.

A private key runs from its BEGIN line to the END line. If another BEGIN or the end of the text comes before END, it runs over
its headers and the base64 that follows. Token lengths have a least, but no greatest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.frames import strings

#: Bytes of text that are indexed together.
SEGMENT_BYTES = 4_000_000


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern`; `group` and `least` say which part must have so many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


_KEY = r"(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"
#: The lines around the body of a private key, in PEM or PGP armour.
KEY_LINE = rf"-----(?:BEGIN|END) {_KEY}"
# what may stand around a line in quotes, comments and mails; what ends a line, in source code as well
_DECO, _EOL = r"""[ \t\r"'`>#*|,;]""", r"(?:\n|\\n|\\r)"
_BARE_KEY = (
    rf"(?:{_DECO}*+{_EOL}(?:{_DECO}|{_EOL})*+(?:Proc-Type|DEK-Info|Version|Comment|MessageID|Hash|Charset):(?:(?!{_EOL}).)*+)*+"
    rf"(?:(?:{_DECO}|{_EOL})*+[A-Za-z0-9+/=]{{16,}}+|{_DECO}*+{_EOL}(?:{_DECO}|{_EOL})*+[A-Za-z0-9+/=]++(?={_DECO}*+(?:{_EOL}|\Z)))*+"
)

#: Kinds in the order in which spans with the same start are listed. The first three are the base.
RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("private_key", rf"-----BEGIN {_KEY}(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END {_KEY}|{_BARE_KEY})"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9_]{36,}", 0, 40),
    Rule("github_pat", r"\bgithub_pat_[A-Za-z0-9_]{36,}", 0, 47),
    Rule("gitlab", r"\bglpat-[A-Za-z0-9_-]{20,}(?:\.[0-9a-z]{2}\.?[0-9a-z]{7,})?", 0, 26),
    Rule("slack", r"\bxox[abeprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35,}", 0, 39),
    Rule("stripe", r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", 0, 24),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("bearer", r"(?ai:bearer) [A-Za-z0-9._~+/-]{20,}=*", 0, 27),
    Rule("login_url", r"[a-z][a-z0-9+.-]{0,19}://[^\s/:@]+:[^\s/:@]{3,}@"),
)

BASE_KINDS = ("assign", "access", "hex")

Query = tuple | None  # None: no condition; ("tri", t), ("and", ...), ("or", ...)


def _both(kind: str, parts: list[Query]) -> Query:
    if kind == "or" and (not parts or any(p is None for p in parts)):
        return None
    flat = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not flat else flat[0] if len(flat) == 1 else (kind, *flat)


def _of_words(words: list[str]) -> Query:
    """One of these words occurs."""
    return _both("or", [_both("and", [("tri", w[i : i + 3]) for i in range(len(w) - 2)]) for w in words])


#: Alternatives that are written out as words; beyond, only what they have in common as a query counts.
_MOST_WORDS, _MOST_CHARS = 32, 8


def _derive(tree) -> tuple[list[str] | None, Query]:
    """The words that the whole expression may be (or None if there are too many), and what every match must hold.

    Words are lower-case; a part that isn't ASCII makes no condition, since the index is over ASCII-lowered bytes.
    """
    words: list[str] | None = [""]
    query: list[Query] = []

    def end() -> None:
        nonlocal words
        if words is not None:
            query.append(_of_words(words))
        words = [""]

    for kind, arg in tree:
        own: list[str] | None = None
        also: Query = None
        if kind is op.LITERAL and arg < 128:
            own = [chr(arg).lower()]
        elif kind is op.IN and all(k in (op.LITERAL, op.RANGE) for k, _ in arg):
            found = {chr(c).lower() for k, v in arg for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1)) if c < 128}
            wide = any((v if k is op.LITERAL else v[1]) > 127 for k, v in arg)
            own = sorted(found) if len(found) <= _MOST_CHARS and not wide else None
        elif kind is op.SUBPATTERN:
            own, also = _derive(arg[-1])
        elif kind is op.BRANCH:
            sides = [_derive(b) for b in arg[1]]
            own = sorted({w for s, _ in sides for w in s}) if all(s is not None for s, _ in sides) else None
            also = None if own is not None else _both("or", [q if s is None else _of_words(s) for s, q in sides])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, inner = arg
            s, q = _derive(inner)
            if most == 1 and least == 0 and s is not None:
                own = ["", *s]
            elif least == most == 1:
                own, also = s, q
            else:
                also = q if least else None
                if least and s is not None:
                    also = _of_words(s)
        elif kind is op.AT:
            continue
        joined = None if own is None or words is None else [a + b for a in words for b in own]
        if joined is not None and len(joined) <= _MOST_WORDS:
            words = sorted(set(joined))
        else:
            end()
            words = own if own is not None and len(own) <= _MOST_WORDS else [""]
        query.append(also)
    rest = _both("and", query)
    if words is not None and rest is None and not any(query):
        return (words, None) if _whole(tree) else (None, _of_words(words))
    return None, _both("and", [rest, _of_words(words) if words is not None else None])


def _whole(tree) -> bool:
    """True if the expression has a bounded number of plain words, so that the words say it all."""
    for kind, arg in tree:
        if kind is op.LITERAL:
            if arg > 127:
                return False
        elif kind is op.IN:
            if not all(k in (op.LITERAL, op.RANGE) for k, _ in arg) or sum(1 if k is op.LITERAL else v[1] - v[0] + 1 for k, v in arg) > _MOST_CHARS:
                return False
        elif kind is op.SUBPATTERN:
            if not _whole(arg[-1]):
                return False
        elif kind is op.BRANCH:
            if not all(_whole(b) for b in arg[1]):
                return False
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            if arg[1] != 1 or not _whole(arg[2]):
                return False
        elif kind is not op.AT:
            return False
    return True


def trigram_query(pattern: str) -> Query:
    """What every match must hold, as ("tri", t), ("and", ...) or ("or", ...); None if nothing is mandatory."""
    words, query = _derive(_parser.parse(pattern))
    return query if words is None else _of_words(words)


def _needed(query: Query) -> set[str]:
    return set() if query is None else {query[1]} if query[0] == "tri" else set().union(*map(_needed, query[1:]))


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class TrigramIndex:
    """Sorted lists of the documents of a segment that hold a trigram, for the trigrams that are asked for."""

    def __init__(self, trigrams: set[str]):
        self.number = {t: i for i, t in enumerate(sorted(trigrams))}
        self.slot = np.full(1 << 24, -1, np.int16)
        for t, i in self.number.items():
            a, b, c = t.encode()
            self.slot[a << 16 | b << 8 | c] = i

    def build(self, texts: list[bytes]) -> list[np.ndarray]:
        size = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(texts).translate(_LOWER), np.uint8).astype(np.int32)
        if flat.size < 3:
            return [np.zeros(0, np.int64) for _ in self.number]
        found = self.slot[flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]]
        at = np.flatnonzero(found >= 0)
        end = np.cumsum(size)
        document = np.searchsorted(end, at, "right")
        inside = at + 2 < end[document]
        pair = np.unique(found[at[inside]].astype(np.int64) * len(texts) + document[inside])
        cuts = np.searchsorted(pair, np.arange(len(self.number) + 1) * len(texts))
        return [pair[a:b] - i * len(texts) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    def candidates(self, query: Query, postings: list[np.ndarray], documents: int) -> np.ndarray:
        if query is None:
            return np.arange(documents)
        if query[0] == "tri":
            return postings[self.number[query[1]]]
        sides = [self.candidates(q, postings, documents) for q in query[1:]]
        if query[0] == "and":
            return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(sides, key=len))
        return np.unique(np.concatenate(sides))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.index = TrigramIndex(set().union(*map(_needed, self.queries)))
        # a run of one class that is too short never counts, so the expression may ask for the length at once
        self.matchers = [re.compile(re.sub(r"^(\[[^\]]+\])\+$", rf"\1{{{r.least},}}", r.pattern)) for r in rules]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, rule, end) of every text, in order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.index.build([t.encode() for t in texts])
        for number, (rule, query, matcher) in enumerate(zip(self.rules, self.queries, self.matchers)):
            for i in self.index.candidates(query, postings, len(texts)).tolist():
                for m in matcher.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), number, m.end()))
        for found in out:
            found.sort()
        return out


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _segments(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SEGMENT_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _mapped(df: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...], columns: str,
            rows_of: Callable[[str, list[tuple[int, int, int]]], tuple]) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in rows:
            at = 0
            for texts in _segments(strings(batch)):
                out = [rows_of(t, s) for t, s in zip(texts, scan.spans(texts))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *map(pa.array, zip(*out))],
                                                 ["id", *(c.split()[0] for c in columns.split(", "))])
                at += len(texts)

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, {columns}").withColumnRenamed("id", id_col)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id_col, n_assign, n_access, n_hex, base_sha256, spans: the secrets of every whole text, as kind:start:end."""

    def row(_: str, found: list[tuple[int, int, int]]) -> tuple:
        named = [(rules[k].kind, f"{rules[k].kind}:{a}:{b}") for a, k, b in found]
        base = [s for kind, s in named if kind in BASE_KINDS]
        count = [sum(kind == k for kind, _ in named) for k in BASE_KINDS]
        return *count, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(s for _, s in named)

    return _mapped(df, id_col, text_col, rules, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", row)


def redact(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with every found secret replaced by [kind]; overlapping spans are replaced together, named by the first.

    All columns stay; null texts stay null.
    """
    names = df.columns
    where = names.index(text_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in rows:
            values = batch.column(where).to_pylist()
            at = 0
            for texts in _segments([v or "" for v in values]):
                for i, (text, found) in enumerate(zip(texts, scan.spans(texts)), at):
                    parts, end = [], 0
                    for a, k, b in found:
                        if a >= end:
                            parts += [text[end:a], f"[{rules[k].kind}]"]
                        end = max(end, b)
                    if found:
                        values[i] = "".join(parts) + text[end:]
                at += len(texts)
            arrays = [pa.array(values, batch.column(i).type) if i == where else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return df.mapInArrow(run, df.schema)
