"""Phrase mining against counting every phrase in plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from stratamart.llm import phrases
from stratamart.llm.queries import op13_phrases
from tests.llm.helpers import DOCUMENTS, SMALL, clashing, empty, odd_rows

LOWER = {i: i + 32 for i in range(65, 91)}


def expected(rows, least=10, longest=3, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows, by definition."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        within = Counter()
        for phrase, n in counts.items():
            if len(phrase) > 2 and n >= least:
                for size in range(2, len(phrase)):
                    for i in range(len(phrase) - size + 1):
                        part = phrase[i : i + size]
                        within[part] = max(within[part], n)
        scored = []
        for phrase, a in counts.items():
            if len(phrase) < 2 or a < least or (within[phrase] and 100 * within[phrase] >= 50 * a):
                continue
            cuts = [(counts[phrase[:k]], counts[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            scored.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return out


def rows_of(docs):
    return [(r.lang, r.text) for r in docs.select("lang", "text").collect()]


@pytest.mark.parametrize("shard, chunk", [(1 << 18, 8 << 20), (300, 50_000)])
def test_query_against_counting(spark, monkeypatch, shard, chunk):
    """Many small shards, passes and chunks give the same."""
    monkeypatch.setattr(phrases, "SHARD", shard)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = op13_phrases(spark, SMALL).collect()
    assert len(found) > 100
    assert sorted(map(tuple, found)) == sorted(expected(rows_of(docs)))


def test_awkward_rows(spark):
    long_word = "w" * 500
    rows = [
        (1, None, None, None, None),
        *[(i, "New  York\tcity. new york! NEW york city", lang, None, None) for i in range(12) for lang in ("en", None, "und", "")],
        *[(i, f"{long_word} é日 {long_word} é日\x0b{long_word}", "zz", None, None) for i in range(6)],
        *[(i, "a a a a a", "rep", None, None) for i in range(5)],
        *[(i, t, None, None, None) for i, t in odd_rows()],
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    found = phrases.mine(clashing(docs)).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows_of(docs)))
    few = phrases.mine(docs, least=3, longest=4, top=3).collect()
    assert sorted(map(tuple, few)) == sorted(expected(rows_of(docs), 3, 4, 3))
    assert phrases.mine(empty(spark)).count() == 0


def test_full_bitmaps_only_let_more_through(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITMAP_BITS", 6)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    found = phrases.mine(docs, least=4).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows_of(docs), 4))


@pytest.mark.parametrize("seed", range(5))
def test_double_array_accepts_exactly_its_phrases(seed):
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range([3, 60, 400, 5000, 70_000][seed])]
    made = {" ".join(draw.choice(vocabulary, draw.integers(1, 4))) for _ in range(3000)}
    frame = pd.DataFrame({"lang": "x", "phrase": sorted(made)})
    trie, states = phrases.trie_of(frame, 3)
    trie = phrases.DoubleArray.from_bytes(trie.to_bytes())
    assert len(set(states)) == len(made) and trie.accepts[states].all() and trie.accepts.sum() == len(made)
    for phrase, state in zip(frame["phrase"][:500], states):
        at = np.zeros(1, np.int32)
        words = phrase.split()
        for key in phrases.word_keys(["x"] * len(words), words):
            at, _ = trie.advance(at, trie.code(np.array([key], np.uint64)))
        assert at.tolist() == [state]
    used = (trie.check >= 0).sum()
    assert used >= 0.4 * len(trie.check) or len(trie.check) <= 256


def test_words_and_hashes_of_long_and_short_words():
    chunk = phrases.Chunk(["Ab ab\tAB. ab " + "x" * 100, "x" * 100 + " ab"], ["en", "en"])
    assert chunk.texts(np.arange(7), 1).to_pylist() == ["ab"] * 4 + ["x" * 100] * 2 + ["ab"]
    assert chunk.texts(np.array([0, 5]), 2).to_pylist() == ["ab ab", "x" * 100 + " ab"]
    assert chunk.texts(np.array([], np.int64), 3).to_pylist() == []
    assert len(set(chunk.words.tolist())) == 2
    assert chunk.joined.tolist() == [True, True, False, True, False, True, False]
    assert (phrases.word_keys(["en", "en"], ["ab", "x" * 100]) == chunk.words[[0, 4]]).all()


def test_texts_are_read_as_often_however_many_candidates(spark, monkeypatch):
    """More shards are more tasks, not more passes over the texts."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    passes, kind = [], type(docs)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: passes.append(self.columns) or plain(self, *a, **b))
    found = {}
    for shard in (1 << 18, 20):
        monkeypatch.setattr(phrases, "SHARD", shard)
        passes.clear()
        found[shard] = sorted(map(tuple, phrases.mine(docs, least=4).collect()))
        assert passes == [["lang", "text"]] * 4
    assert found[20] == found[1 << 18] == sorted(expected(rows_of(docs), 4))


def test_phrases_with_equal_keys_are_told_apart():
    chunk = phrases.Chunk(["a b. c d. a b. e"], ["en"])
    at, keys = chunk.keys(2)
    first, n = phrases.distinct(chunk, at, np.zeros(3, np.uint64), 2)
    assert sorted(zip(chunk.texts(at[first], 2).to_pylist(), n.tolist())) == [("a b", 2), ("c d", 1)]
    part = {"lang": ["en"] * 2, "phrase": ["a b", "c d"]}
    same = pa.table({"key": pa.array([7, 7], pa.uint64()), "n": [2, 1]} | part)
    assert phrases.merged([same]).equals(same)
    other = pa.table({"key": pa.array([7, 8], pa.uint64()), "n": [2, 1]} | part)
    assert phrases.merged([other, other])["n"].to_pylist() == [4, 2]


def test_shard_counts_its_phrases_with_support(monkeypatch):
    lines, langs, counts = ["a b\nc\na b c", "a b\na"], ["en", "de"], np.array([3, 1, 2, 5, 4])
    keys = {(lang, p): phrases.Chunk([p], [lang]).keys(len(p.split()))[1][0] for lang in ("en", "de") for p in ("a", "c", "a b", "a b c")}
    heavy = np.array([k for (lang, p), k in keys.items() if p != "c"], np.uint64)
    twice = phrases.frequencies(lines + lines, langs + langs, np.append(counts, counts), heavy, 3)
    assert sorted(map(tuple, twice.to_pandas().values.tolist())) == [("de", "a", 8), ("de", "a b", 10), ("en", "a b", 6), ("en", "a b c", 4)]
    none = phrases.frequencies([], [], np.zeros(0, np.int64), heavy, 3)
    assert none.num_rows == 0 and none.column_names == ["lang", "phrase", "f"]
    # every key is the same: the words tell
    monkeypatch.setattr(phrases, "followed", lambda keys, words: np.zeros_like(keys))
    found = phrases.frequencies(["a b\nc d\na b\nc d e"], ["en"], np.array([1, 2, 4, 8]), np.zeros(1, np.uint64), 3)
    assert sorted(zip(found["phrase"].to_pylist(), found["f"].to_pylist())) == [("a b", 5), ("c d", 2), ("c d e", 8)]


def test_tasks_deal_phrases_by_key():
    chunk = phrases.Chunk(["x y x y. z", "x y"], ["en", "de"])
    full = [np.full(8, 255, np.uint8)] * 2
    batch = phrases.dealt(phrases.merged([phrases.found_in(chunk, full)] * 2), 3)
    found = {}
    for row in batch.to_pylist():
        for phrase, n in zip(row["phrases"].split("\n"), np.frombuffer(row["counts"], np.uint32)):
            key = phrases.Chunk([phrase], [row["lang"]]).keys(len(phrase.split()))[1].view(np.int64)[0]
            assert row["shard"] == key % 3 and (row["lang"], phrase) not in found
            found[row["lang"], phrase] = int(n)
    en = {"x": 4, "y": 4, "z": 2, "x y": 4, "y x": 2}
    assert found == {("en", p): n for p, n in en.items()} | {("de", p): 2 for p in ("x", "y", "x y")}


def test_first_phrases_come_from_parts_of_a_language(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    best = phrases.mine(docs, least=3, top=7)
    assert re.search(r"windowspecdefinition\(lang#\d+, part#", best._jdf.queryExecution().toString())
    assert sorted(map(tuple, best.collect())) == sorted(expected(rows_of(docs), 3, 3, 7))
