"""Conversations and phrases: the prefix trie, chat formatting and collocations, each against a plain version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import chat, phrases, trie

TURNS = "conv_id long, turn long, role string, text string"
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    (1, None, None, None), (1, None, None, None), (1, 0, "user", "é漢😀 \x00 <s>"), (1, 1, "assistant", ""), (1, 1, "assistant", None),
    (2, 5, "assistant", "[INST] [\\INST] <\\\\/s> [/INST"), (2, 5, "assistant", "[INST] [\\INST] <\\\\/s> [/INST"), (2, None, "system", "\n\n"),
    (3, 0, "assistant", "x " * 30_000), (3, 1, " [/INST] ", "»»«"), (3, 2, "assistant", "»»«"), (3, 3, "assistant", "[/INST"), (3, 4, "assistant", "INST]<"),
    (None, 0, "user", "no conversation"), (None, 1, "assistant", "none"), (100, 0, "user", "é漢😀 \x00 <s>"), (-5, 0, "user", "minus"),
]


@pytest.fixture
def conversations(spark):
    def make(rows):
        df = spark.createDataFrame(rows, TURNS)
        for name in ("id", "conv", "depth", "n", "turns", "ids", "shard", "members", "formatted", "z1", "last"):
            df = df.withColumn(name, F.lit(name))
        return df

    return make


def ordered(rows):
    """Turns of each conversation by number, nulls first, then by what `tie` gives."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return found


# prefix trie

def plain_trie(rows):
    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]

    turns = {c: [x[2:] for x in sorted(own, key=lambda x: (*x[:2], digest(*x[2:])))] for c, own in ordered(rows).items() if c is not None}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        made = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(made) + 1):
            members[made[:d]].append(c)
        ends[made].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(own) - 1) * (len(k[-1][1]) if k else 0)
    return sorted((min(own), len(k), str(min(members[k[:-1]]) if k else None), len(own), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, own in members.items())


def trie_rows(df):
    return sorted((r[0], r[1], str(r[2]), *r[3:]) for r in trie.prefix_trie(df).collect())


def random_turns(seed):
    """Few different turns, so prefixes are shared; copies of whole conversations; some long ones."""
    rng, rows = random.Random(seed), []
    for c in range(-3, 240):
        if c % 7 == 3:
            continue
        common = c % 3 == 0
        for t in range(rng.choice([1, 2, 3, 6, 9] + [40] * (c % 50 == 0))):
            rows.append((c, t, "user" if t % 2 else "assistant", "start" if common and t < 5 else f"t{rng.randrange(4)}" * (t + 1)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [2_000, 20, 1])
def test_trie_equals_plain_prefixes(spark, conversations, monkeypatch, most):
    monkeypatch.setattr(trie, "SHARD_TURNS", most)
    monkeypatch.setattr(trie, "ID_BLOCK", 3)
    rows = random_turns(most) + AWKWARD
    assert trie_rows(conversations(rows)) == plain_trie(rows)


def test_trie_of_nothing(spark, conversations):
    assert trie.prefix_trie(conversations([])).count() == 0
    assert trie.prefix_trie(conversations([(None, 0, "user", "a")])).count() == 0
    assert trie_rows(conversations([(7, None, None, None)])) == plain_trie([(7, None, None, None)])


def test_double_array_keeps_every_path_apart():
    rng = random.Random(3)
    for turns in (3, 40, 500):
        paths = sorted({tuple(rng.randrange(turns) for _ in range(rng.randrange(7))) for _ in range(400)})
        depth = np.concatenate([np.arange(len(p) + 1) for p in paths])
        turn = np.concatenate([np.array([0, *p]) for p in paths])
        built = trie.DoubleArray(depth, turn)
        cell, known, at = built.walk(), {}, 0
        for p in paths:
            for d in range(len(p) + 1):
                assert known.setdefault(p[:d], cell[at]) == cell[at]
                at += 1
        assert len(set(known.values())) == len(known) == (built.check >= 0).sum() + 1
        assert len(built.check) < 3 * len(known) + turns + 10


# chat formatting

def plain_chats(rows):
    out = []
    for c, own in ordered(rows).items():
        turns = [x[2:] for x in sorted(own)]
        known = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((str(c), len(turns), hashlib.sha256(known.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out)


def test_chats_read_back_equal_the_turns(spark, conversations):
    rng = random.Random(5)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "s>", "/s>", "INST]", " ", "\n", "é", "漢字", "😀", "word", "assistant", "<|endoftext|>", "]"]
    rows = AWKWARD + [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    for c in range(200, 320):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["assistant", "user", "".join(rng.choices(bits, k=2))]), "".join(rng.choices(bits, k=rng.randrange(12)))))
    made = chat.format_chats(conversations(rows), BYTE_MODEL).cache()
    got = sorted((str(r[0]), *r[1:5]) for r in chat.read_back(made).collect())
    assert got == plain_chats(rows)
    tokenizer = Tokenizer.from_file(BYTE_MODEL)
    tokenizer.encode_special_tokens = True
    for r in made.collect():
        assert r["ids"] == tokenizer.encode(r["formatted"]).ids and len(r["ids"]) == len(r["loss_begin"]) == len(r["loss_end"])
    made.unpersist()
    assert chat.read_back(chat.format_chats(conversations([]), BYTE_MODEL)).count() == 0


def test_escapes_can_be_taken_back():
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choices(["<", "[", "\\", "s>", "/", "INST]", "x"], k=rng.randrange(10)))
        held = chat.escape(text)
        assert chat.unescape(held) == text
        assert not any(mark in held for mark in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_loss_spans_equal_a_scan():
    rng = random.Random(7)
    for _ in range(300):
        edges = sorted(rng.sample(range(200), 2 * rng.randrange(1, 8)))
        spans = np.array(edges).reshape(-1, 2)
        cuts = [0, *sorted(rng.sample(range(1, 200), rng.randrange(1, 60))), 200]
        offsets = np.array(list(zip(cuts, cuts[1:])))
        # marks lie between turns, so no token reaches two
        if any(sum(b < e2 and b2 < e for b2, e2 in spans.tolist()) > 1 for b, e in offsets.tolist()):
            continue
        begin, end = chat.loss_spans(offsets, spans)
        for (b, e), lo, hi in zip(offsets.tolist(), begin.tolist(), end.tolist()):
            hit = [(max(b, b2), min(e, e2)) for b2, e2 in spans.tolist() if b < e2 and b2 < e]
            assert (lo, hi) == (hit[0] if hit else (0, 0))


# collocations

def plain_collocations(rows, longest, least, top, covered):
    import re

    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    good = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    most = Counter()
    for (lang, ws), a in good.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                most[lang, ws[i : i + k]] = max(most[lang, ws[i : i + k]], a)
    found = defaultdict(list)
    for (lang, ws), a in good.items():
        if 100 * most[lang, ws] >= covered * a and (lang, ws) in most:
            continue
        score, k = min((1_000_000 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        found[lang].append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, own in found.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


def phrase_texts(seed, documents=400):
    rng, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(30)] + ["É", "漢", "\x00", "A-b", "x" * 3_000]
    for i in range(documents):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ""]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "en", "de", None, ""]), None if i % 50 == 0 else text + "same THREE words here!" * rng.randrange(3)))
    return rows + [("fr", "a b " * 2_000), ("fr", "a b " * 2_000), ("rare", "only once")]


@pytest.mark.parametrize("longest,least,top,covered", [(3, 10, 2_000, 50), (4, 3, 40, 50), (2, 10, 7, 50), (5, 4, 500, 90)])
def test_collocations_equal_plain_counts(spark, documents, monkeypatch, longest, least, top, covered):
    rows = phrase_texts(longest)
    df = documents([(i, t, lang) for i, (lang, t) in enumerate(rows)]).repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(df, longest, least, top, covered).collect())
    assert got == plain_collocations(rows, longest, least, top, covered)


def test_collocations_of_nothing(spark, documents):
    assert phrases.collocations(documents([])).count() == 0
    assert phrases.collocations(documents([(1, None, None), (2, "", "en"), (3, "few words", "en")])).count() == 0


def test_shards_and_full_tables_change_no_count(spark, documents, monkeypatch):
    """Small shards, and tables in which every bit is set."""
    import pyarrow as pa

    words = bytes([255]) * (1 << phrases.TABLE_BITS - 3)
    rows = [r for r in phrase_texts(9, 60) if r[1]]
    texts = [t.encode() for lang, t in rows if lang == "en"]
    want = Counter()
    for t in texts:
        piece = phrases.words_of([t])
        want.update(b" ".join(piece[i : i + 3]) for i in range(len(piece) - 2) if b"." not in piece[i : i + 3])
    got = Counter()
    for part in (texts[:7], texts[7:]):
        shards = phrases._Shards(phrases.BitTable(words), phrases.BitTable(words), 3)
        shards.add("en", part)
        for batch in shards.counted():
            for phrase, a in zip(batch.column("phrase").cast(pa.binary()).to_pylist(), batch.column("a").to_pylist()):
                got[phrase] += a
    assert got == want


def test_index_rows_are_those_of_a_sorted_list():
    """Intervals in both directions, from extensions in any order, against the sorted suffixes themselves."""
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 5, 300)
    index = phrases.BidirectionalIndex(ids, 4)
    text = [0, *ids.tolist(), 0]

    def ranges(seq):
        return sorted(tuple((seq + [0] * 4)[i : i + 4]) for i in range(len(seq)))

    forward, backward = ranges(text), ranges(text[::-1])
    for order in ((True, True, True), (False, False, False), (True, False, True), (False, True, True)):
        found = index.words()
        for right in order:
            found = index.extended(found, right)
            for p, low, back, count in zip(found[0].tolist(), *(x.tolist() for x in found[1:])):
                n = len(p)
                assert [s[:n] for s in forward[low : low + count]] == [tuple(p)] * count
                assert [s[:n] for s in backward[back : back + count]] == [tuple(p[::-1])] * count
                assert count == sum(text[i : i + n] == p for i in range(len(text)))
