"""Chat formatting with a loss mask that follows token offsets.

A conversation is rendered whole: each turn becomes `<s>[INST] role [/INST]text</s>`. Control strings inside roles and texts get
a backslash after their first character, and one more where there are some already, so reading back takes exactly one
away again. The rendered text is encoded once, with offsets. The spans of the turns under the loss and the spans of the
tokens are both sorted; two binary searches give the tokens that each turn touches, and what a token shares with the turn
is clipped to it. So a token that reaches from a mark into a text counts with its part of the text only.

Turns go by `turn`, null first, then by role and text. Null roles and texts are empty; a null id is a conversation as any
other; repeated rows are turns of their own. Without rows there are no conversations. Only the four columns are read,
whatever other columns hold. A conversation is held whole in a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm.frames import small

#: Turns of this role are trained on.
TRAINED_ROLE = "assistant"

_CONTROL = re.compile(r"<(?=\\*/?s>)|\[(?=\\*/?INST\])")
_ESCAPED = re.compile(r"(<)\\(?=\\*/?s>)|(\[)\\(?=\\*/?INST\])")
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0], text)


def render(turns: Sequence[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns, and where each turn's escaped text begins and ends in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST] {escape(role)} [/INST]", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at = spans[-1][1] + 4
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered text."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def loss_spans(offsets: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each token has under the loss, as begin and end characters; 0, 0 for tokens outside.

    `offsets` are the (begin, end) of tokens, both ascending, `spans` those of turns: sorted, disjoint, with marks between, so
    that no token reaches into two of them.
    """
    begin, end = np.zeros(len(offsets), np.int32), np.zeros(len(offsets), np.int32)
    first = np.searchsorted(offsets[:, 1], spans[:, 0], "right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], "left")
    count = np.maximum(last - first, 0)
    token = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    begin[token] = np.maximum(offsets[token, 0], np.repeat(spans[:, 0], count))
    end[token] = np.minimum(offsets[token, 1], np.repeat(spans[:, 1], count))
    return begin, end


def under_loss(text: str, begin: Sequence[int], end: Sequence[int]) -> list[str]:
    """The stretches of a rendered text under its loss spans, unescaped, in order. Tokens of parts of one character overlap."""
    out, start, stop = [], 0, -1
    for b, e in zip(begin, end):
        if b >= e:
            continue
        if b > stop:
            if stop > start:
                out.append(unescape(text[start:stop]))
            start = b
        stop = max(stop, e)
    if stop > start:
        out.append(unescape(text[start:stop]))
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def format_chats(df: DataFrame, path: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 trained: str = TRAINED_ROLE) -> DataFrame:
    """id_col, formatted, ids, loss_begin, loss_end: every conversation's text, its token ids and what of each token is trained on."""
    empty = F.lit("")
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
                    F.coalesce(F.col(text_col), empty).alias("text"))
    whole = df.select(F.col(id_col).alias("id"), turn.alias("turn")).groupBy("id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in small(rows, 200):
            texts, ids, begins, ends = [], [], [], []
            for turns in batch.column(1).to_pylist():
                turns = [(t["role"], t["text"]) for t in turns]
                text, spans = render(turns)
                coded = tokenizer.encode(text, add_special_tokens=False)
                wanted = np.array([s for s, (role, _) in zip(spans, turns) if role == trained and s[0] < s[1]], np.int64).reshape(-1, 2)
                begin, end = loss_spans(np.array(coded.offsets, np.int64).reshape(-1, 2), wanted)
                texts.append(text)
                ids.append(np.array(coded.ids, np.int32))
                begins.append(begin)
                ends.append(end)
            numbers = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *(pa.array(x, numbers) for x in (ids, begins, ends))],
                ["id", "formatted", "ids", "loss_begin", "loss_end"])

    kind = whole.schema["id"].dataType.simpleString()
    out = whole.mapInArrow(run, f"id {kind}, formatted string, ids array<int>, loss_begin array<int>, loss_end array<int>")
    return out.withColumnRenamed("id", id_col)


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what format_chats() wrote: id_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, loss_tokens."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(rows, 200):
            out = []
            begins, ends = batch.column(2), batch.column(3)
            for i, text in enumerate(batch.column(1).to_pylist()):
                begin, end = begins[i].values.to_numpy(), ends[i].values.to_numpy()
                turns = parse(text)
                known = "".join(f"{role}\n{said}\n" for role, said in turns)
                held = np.flatnonzero(begin < end)
                loss = "".join(under_loss(text, begin[held].tolist(), end[held].tolist()))
                out.append((len(turns), hashlib.sha256(known.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                            len(text), len(begin), held.size))
            arrays = [pa.array(list(x), f.type) for x, f in zip(zip(*out), _DIGESTS)] if out else [pa.array([], f.type) for f in _DIGESTS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", *_DIGESTS.names])

    picked = formatted.select(F.col(id_col).alias("id"), "formatted", "loss_begin", "loss_end")
    columns = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _DIGESTS)
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, {columns}").withColumnRenamed("id", id_col)


_DIGESTS = pa.schema([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                      ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()), ("loss_tokens", pa.int64())])
