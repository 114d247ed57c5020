"""Operators across rows: joins, packing, search, learned ones and the pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tabloom.llm import graph, langid, line_dedup, ngram_join, packing, quality, topk
from tabloom.llm.words import Words, byte_values

WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


# words and components

def test_word_hashes_know_words_apart():
    values, rng = byte_values(9), random.Random(1)
    texts = [b"", b"a b  a", b"  ", b"\tword\x0bword \x0c", "é漢 é漢".encode(), b"x" * 5000 + b" y"]
    texts += [b" ".join(bytes(rng.choices(b"ab", k=rng.randint(1, 12))) for _ in range(200)) for _ in range(20)]
    words = Words(texts)
    assert words.count.tolist() == [len(t.split()) for t in texts]
    found = defaultdict(set)
    for word, h in zip((w for t in texts for w in t.split()), words.hashes(values).tolist()):
        found[word].add(h)
    assert all(len(h) == 1 for h in found.values()) and len({min(h) for h in found.values()}) == len(found)


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = of(a), of(b)
        root[max(a, b)] = min(a, b)
    return {n: of(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = plain_components({x for e in links for x in e}, links)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in links)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


# n-gram join

def plain_near(rows, n, percent):
    def ngrams(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}

    sets = [ngrams(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    component = plain_components(range(len(rows)), links)
    known = defaultdict(list)
    for i, c in component.items():
        known[c].append(rows[i][0])
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    return sorted((str(r[0]), len(s), str(least(known[component[i]]) if s else r[0])) for i, (r, s) in enumerate(zip(rows, sets)))


def near_texts(seed):
    """Bases with copies that differ more and more, so that many pairs lie close to the threshold."""
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        words = [f"{base}w{rng.randrange(400)}" for _ in range(rng.choice([8, 12, 40, 90, 300]))]
        for copy in range(rng.choice([1, 3, 8, 25])):
            changed = list(words)
            for _ in range(rng.randrange(1 + len(words) // 25) if copy else 0):
                changed[rng.randrange(len(changed))] = f"new{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                changed = changed[: len(changed) - rng.randrange(1 + len(changed) // 15)]
            rows.append((len(rows) + 100, " ".join(changed), "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, percent, block", [(3, 90, 4096), (5, 80, 4), (3, 60, 3)])
def test_near_duplicates_equal_all_pairs(spark, documents, awkward, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    rows = near_texts(percent) + awkward
    got = sorted((str(r[0]), r[1], str(r[2])) for r in ngram_join.near_duplicates(documents(rows), n, percent).collect())
    assert got == plain_near(rows, n, percent)


def test_one_of_each_and_empty(spark, documents, awkward):
    kept = ngram_join.one_of_each(documents(awkward))
    assert kept.columns == documents(awkward).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, None, None, 5, 7, 8, 9, 10]))
    assert ngram_join.near_duplicates(documents([])).count() == 0


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = np.unique(rng.integers(0, 300, 120, np.uint64))
        b = np.unique(rng.integers(0, 300, 120, np.uint64))
        bits = ngram_join._bits([a, b], 128)
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


# line dedup

def test_line_dedup_of_awkward_rows(spark, documents, awkward):
    line = "this line stands at many sites of the web"
    rows = [*awkward, *[(50 + i, f"own line number {i} of this text\n{line}\nend", "en", f"site{i}") for i in range(6)],
            *[(70 + i, "a line at four sites only, too few", "en", f"site{i}") for i in range(4)], (90, f"  {line} \n{line}", "en", None), (50, f"{line}", "en", "site9")]
    out = line_dedup.dedup_lines(documents(rows), min_chars=20)
    assert out.columns == [c for c in documents(rows).columns if c != "n_lines"] + ["n_lines", "n_removed"]
    got = defaultdict(list)
    for r in out.collect():
        got[str(r["doc_id"])].append((r["text"], r["n_lines"], r["n_removed"]))
    assert sum(map(len, got.values())) == len(rows)
    assert sorted(got["50"]) == [("own line number 0 of this text\nend", 3, 1), (line, 1, 0)]
    assert got["53"] == [("own line number 3 of this text\nend", 3, 1)] and got["90"] == [("", 2, 2)]
    assert got["71"] == [("a line at four sites only, too few", 1, 0)]
    assert got["1"] == [(None, 0, 0)] and got["2"] == [("", 1, 0)] and got["5"][0][2] == 0
    none = line_dedup.dedup_lines(documents(rows), min_chars=20, keep_first=False).where("doc_id = 50").collect()
    assert sorted(r["text"] for r in none) == ["", "own line number 0 of this text\nend"]
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_short_lines_count_and_ends_are_trimmed_of_any_ascii_space(spark, documents):
    ends = ["", " ", "\t", "\r", "\x0b \x0c", "\u00a0"]
    rows = [(i, f"own {i}\n{e}Go{e}\n \t\r\n\n.", "en", f"site{i % 5}") for i, e in enumerate(ends)]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(documents(rows)).collect()}
    # five sites share the two short lines; the blank lines stay, and a no-break space makes another line
    assert got[0] == ("own 0\nGo\n \t\r\n\n.", 0)
    assert all(got[i] == (f"own {i}\n \t\r\n", 2) for i in range(1, 5))
    assert got[5] == ("own 5\n\u00a0Go\u00a0\n \t\r\n", 1)
    kept = line_dedup.dedup_lines(documents(rows), min_chars=2).where("doc_id = 3").first()
    assert kept["text"] == "own 3\n \t\r\n\n."


@pytest.mark.parametrize("sites", [1, 5, 60, 400])
def test_spread_near_the_threshold_is_exact(spark, documents, sites):
    rows = [(s * 10 + k, f"a line of its own for threshold number {t}", "en", f"site{s}") for t in (sites, sites + 1) for s in range(t) for k in range(2)]
    found = line_dedup.spread_lines(documents(rows), min_sites=sites + 1)
    assert found.count() == 1


# packing

def test_tokens_of_words_equal_the_library():
    rng = random.Random(5)
    library, known = Tokenizer.from_file(WORD_MODEL), packing._Known(WORD_MODEL)
    parts = [" ", "  ", "\n", "a", "B", "É", "é", "́", " ́", "Σ", "ΑΣ ", "'s", "don't", "12", "\x1c", "\x85", " ", "　", "\x0b", "\t", "<|endoftext|>", "<|ENDOFTEXT|>",
             "<|start", "漢", "😀", "...", "!!", "İ", "K", "\x00", "가", "it's", "ﬁ", "ß", "ǅ", "É,", "été.", "x|", "²", "été²"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 20, 60])))
        got = np.frombuffer(known.ids(text.encode().split()), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text


def laid_out(counts, capacity):
    sequences, used = defaultdict(list), defaultdict(int)
    for length, rank, n, first, offset in packing.plan(counts, capacity):
        assert used[length] == rank
        used[length] += n
        for j in range(n):
            sequences[first + j].append((offset, length))
    assert used == {k: v for k, v in counts.items() if v}
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in parts) <= 2
    return len(sequences)


def best_fit_decreasing(counts, capacity):
    gaps = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fit = [g for g in gaps if g >= length]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - length)
    return len(gaps)


def test_plans_are_whole_and_tight():
    rng = random.Random(6)
    assert laid_out({}, 10) == 0 and laid_out({10: 3}, 10) == 3 and laid_out({6: 1, 4: 1}, 10) == 1 and laid_out({4: 3}, 10) == 2
    for _ in range(120):
        capacity = rng.choice([7, 10, 64, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 12) for _ in range(rng.randint(0, 25))}
        n, least = laid_out(counts, capacity), -(-sum(k * v for k, v in counts.items()) // capacity)
        assert least <= n <= max(best_fit_decreasing(counts, capacity) * 1.05 + 1, least)


def test_packed_frames(spark, documents, awkward):
    rows = awkward + [(200 + i, "some words to fill " * (i % 9), "en", "a") for i in range(80)]
    cut = packing.pieces(documents(rows).repartition(5), WORD_MODEL, capacity=64, with_ids=True)
    got = packing.pack(cut, 64).collect()
    library = Tokenizer.from_file(WORD_MODEL)
    want = defaultdict(int)
    for i, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, tuple(ids[k : k + 64])] += 1
    have, sequences = defaultdict(int), defaultdict(list)
    for r in got:
        have[r["doc_id"], r["piece"], r["start"], tuple(r["ids"])] += 1
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(packing.pieces(documents([]), WORD_MODEL)).count() == 0


# language

LANGUAGES = {"en": "the of and that this with from have which when thing there".split(), "de": "der die und das nicht mit von werden welche wenn ding dort".split(),
             "es": "el los que esto con desde tener cual cuando cosa para".split()}


def language_rows(n, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LANGUAGES))
        rows.append((i, " ".join(rng.choice(LANGUAGES[lang]) for _ in range(rng.randint(3, 60))), lang, "a"))
    return rows


def test_language_of_held_out_rows(spark, documents):
    rows = language_rows(300)
    df = documents(rows)
    parser = langid.fit(df.where("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r for r in langid.identify(df, parser).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _ in rows if i % 5 == 0]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.mark.parametrize("stretch", [1, 2, 7, 64, langid.STRETCH])
def test_phrases_are_longest_matches_wherever_a_text_is_cut(stretch):
    rng = random.Random(8)
    samples = {lang: " ".join(rng.choice(w) for _ in range(150)) for lang, w in LANGUAGES.items()}
    samples["runs"] = "aaaaa b " * 3
    parser = langid.Parser(samples)
    texts = [langid.letters(r[1]) for r in language_rows(30)] + ["", "qqq zzz", "a", "w" * 300, "a" * 2_000, samples["de"] * 3, ""]
    for row, text in zip(parser.costs(texts, stretch), texts):
        if not text:
            assert np.isnan(row).all()
            continue
        for cost, lang in zip(row, parser.languages):
            phrases = i = 0
            while i < len(text):
                j = i
                while j < len(text) and text[i : j + 1] in samples[lang]:
                    j += 1
                i, phrases = max(j, i + 1), phrases + 1
            assert cost == pytest.approx(phrases * np.log2(len(samples[lang])) / len(text))


def test_one_id_of_many_texts_teaches_once_a_text(spark, documents):
    rows = language_rows(60)
    one_id = documents([(None if i % 2 else 7, text, lang, source) for i, text, lang, source in rows])
    parser = langid.fit(one_id.unionByName(one_id), rows=30)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(documents(rows), parser).collect()}
    assert parser.languages == sorted(LANGUAGES) and np.mean([got[i] == lang for i, _, lang, _ in rows]) > 0.95


def test_language_of_awkward_rows(spark, documents, awkward):
    rows = [*awkward, (30, "12 34 !!", "en", "a"), (31, "½²", "en", "a")]
    df = documents(rows)
    parser = langid.fit(documents(language_rows(50)))
    got = [(str(r["doc_id"]), r["lang_pred"], r["score"]) for r in langid.identify(df, parser).collect()]
    assert len(got) == len(rows)
    assert {k for k, lang, score in got if lang == "und" and score == 0} == {"1", "2", "3", "30", "31", "None"}
    kept = langid.in_known_language(df, parser)
    assert kept.columns == df.columns and {str(r["doc_id"]) for r in kept.collect()} == {"None", "5", "6", "7", "8", "9", "10"}
    assert kept.where("doc_id is null").first()["lang"] in LANGUAGES and kept.where("doc_id = 7").first()["lang"] == "de"
    nothing = langid.fit(documents([]))
    assert {r["lang_pred"] for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(documents([]), parser).count() == 0


def test_every_label_is_learnt_from_whole_texts(spark, documents):
    rows = []
    for k in range(70):
        rng = random.Random(k)
        words = ["".join(chr(0x4E00 + 40 * k + rng.randrange(40)) for _ in range(3)) for _ in range(30)]
        rows += [(100 * k + i, " ".join(rng.choice(words) for _ in range(30)), f"lang{k:02d}", "a") for i in range(3 if k == 69 else 4)]
    rows.append((10_000, "same words " * 400 + "wholly other ending " * 400, "tail", "a"))
    parser = langid.fit(documents(rows))
    assert len(parser.languages) == 71 and sum(a.own.nbytes + a.target.nbytes + a.base.nbytes for a in parser.arcs) < 40_000_000
    asked = documents([*rows, (10_001, "wholly other ending", None, "a")])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(asked, parser).collect()}
    assert all(got[i] == lang for i, _, lang, _ in rows) and got[10_001] == "tail"


# quality

def quality_rows(n):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(LANGUAGES["en"]) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words), "en", "a"))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_of_held_out_rows(spark, documents):
    rows, labels = quality_rows(400)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.quality(documents(rows), known.where("doc_id % 4 <> 2")).collect()}
    assert len(got) == 400 and np.mean([(got[i] >= 0.5) == bool(y) for i, y in labels if i % 4 == 2]) > 0.95


def test_quality_of_awkward_rows(spark, documents, awkward):
    df = documents(awkward)
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    scores = [r["score"] for r in quality.quality(df, labels([])).collect()]
    assert scores == [0.5] * len(awkward)
    assert {r["score"] for r in quality.quality(df, labels([(5, 1), (6, None), (None, 0)])).collect()} == {1.0}
    mixed = quality.quality(df, labels([(5, 1), (8, 0), (9, 1)])).collect()
    assert len(mixed) == len(awkward) and all(0 <= r["score"] <= 1 for r in mixed)
    assert quality.quality(documents([]), labels([])).count() == 0


# top k

def plain_top(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("lists, k", [(1, 1), (4, 5), (7, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, lists, k):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(10)
    vectors = [(i, rng.integers(-6, 7, 8).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(9)]
    df = spark.createDataFrame(vectors, "id long, v array<long>")
    got = topk.top_k(df.where("id % 10 = 0"), df, k, lists)
    assert sorted(map(tuple, got.collect())) == plain_top(vectors, [x for x in vectors if x[0] % 10 == 0], k)


def test_top_k_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [1.0, 1.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, []), (7, [2.0]), (7, [2.0]), (8, [-1.0, 0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    scaled = topk.scaled(df, "vec_id", "embedding", 256)
    assert sorted((r["id"], r["v"]) for r in scaled.collect()) == [(0, [128, -64]), (1, [256, 256]), (6, []), (7, [512]), (7, [512]), (8, [-256, 0])]
    got = sorted(map(tuple, topk.top_k(scaled.where("id in (0, 7)"), scaled, 5).collect()))
    assert got == [(0, 1, 7, 65536), (0, 2, 7, 65536), (0, 3, 1, 16384), (0, 4, 6, 0), (0, 5, 8, -32768), (7, 1, 1, 131072), (7, 2, 0, 65536), (7, 3, 6, 0), (7, 4, 8, -131072)]
    big = spark.createDataFrame([(1, [2**40, 1]), (2, [2**20, 3]), (3, [2**20, 5])], "id long, v array<long>")
    assert [tuple(r)[2:] for r in topk.top_k(big.where("id = 1"), big, 2).orderBy("rank").collect()] == [(3, 2**60 + 5), (2, 2**60 + 3)]
    assert topk.top_k(scaled.where("false"), scaled, 5).count() == 0 == topk.top_k(scaled, scaled.where("false"), 5).count()


# pipeline

def pipeline_rows(awkward):
    line = "a line that stands at every site there is"
    rows = [(100 + i, f"{text}\n{line} \nmore {i} words here to tell", lang, f"site{i % 8}") for i, (_, text, lang, _) in enumerate(language_rows(40))]
    copy = " ".join(LANGUAGES["en"] * 9)
    rows += [(300 + i, f"{copy}\nand a last line {'that differs ' * (i % 2)}", "en", "one") for i in range(6)]
    rows.append((400, 'the key of this is password = "hunter2hunter2" and that', None, "two"))
    return rows + awkward


def test_pipeline_stage_by_stage(spark, documents, awkward):
    docs = documents(pipeline_rows(awkward))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, "").collect(), before.select(*columns).schema)
        assert after.columns == columns, name
        assert after.count() <= before.count()
        ids = {str(r["doc_id"]) for r in after.collect()}
        if name == "language ID":
            assert not ids & {"1", "2", "3"} and {"5", "100", "400"} <= ids
        if name == "line dedup":
            with_line = after.where(F.col("text").contains("every site")).collect()
            assert [r["doc_id"] for r in with_line] == [100] and all(r["n_chars"] == len(r["text"]) for r in after.collect())
        if name == "n-gram Jaccard join":
            assert {x for x in ids if x.startswith("3")} == {"300"} and "6" not in ids and "5" in ids
            assert after.where("doc_id = 8").count() == 1
        if name == "secret scans":
            row = after.where("doc_id = 400").first()
            assert row["text"] == 'the key of this is [assign]" and that' and row["n_chars"] == len(row["text"]) and row["lang"] is not None
            assert ids == {str(r["doc_id"]) for r in before.collect()}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, "").collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in before.collect()}


def test_no_key_body_passes_line_dedup_and_redaction(spark, documents):
    key = "-----BEGIN RSA PRIVATE KEY-----\n{}\n-----END RSA PRIVATE KEY-----"
    docs = documents([(i, f"words of {i}\n" + key.format(f"MIIE{i}abcdefghijklmnop+/" * 3), "en", f"site{i}") for i in range(8)])
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["secret scans"](spark, stages["line dedup"](spark, docs, ""), "").collect()
    assert {r["text"] for r in clean} == {f"words of {i}\n[private_key]" for i in range(8)}


def test_pipeline_of_an_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_over_a_table(spark, documents, awkward, tmp_path):
    documents(pipeline_rows(awkward)).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.select("doc_id").distinct().count() > 30
