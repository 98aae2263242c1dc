"""Counts, scores and paths of phrases against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from marketmill.llm import collocations
from tests.llm import brute, fixtures
from tools.compare import connect, differences

SF01 = "/root/testdata/sf0.01"


def brute_counts(rows, least):
    """({(lang, phrase): f}, {lang: n}); rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, " ".join(words[i : i + m])) for i in range(len(words) - m + 1))
    return {k: c for k, c in f.items() if c >= least}, n


def brute_ranked(rows, least=30, top=2000):
    f, n = brute_counts(rows, least)
    longer = {}
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = (lang, " ".join(w[i : i + k]))
                longer[key] = max(longer.get(key, 0), a)
    out = {}
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        if len(w) < 2 or 100 * longer.get((lang, phrase), 0) >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def rows_of(df):
    return [(r["lang"], r["text"]) for r in df.select("lang", "text").collect()]


def random_texts(seed):
    r = random.Random(seed)
    stock = [" ".join(r.choice("abcdefghijkl") * r.randint(1, 2) for _ in range(r.randint(2, 12))) for _ in range(9)]
    texts = []
    for _ in range(150):
        parts = [r.choice([*stock, r.choice("ABCxyzé") * 2, "é ß", "\t", "a\x0bb", "x\x00y"]) for _ in range(r.randint(0, 15))]
        texts.append(r.choice([" ", ". ", ",", "\n", "  "]).join(parts))
    return texts


@pytest.mark.parametrize("least, flush", [(30, 10**6), (3, 40), (2, 1)])
def test_ranked_phrases(spark, monkeypatch, least, flush):
    monkeypatch.setattr(collocations, "FLUSH_WORDS", flush)
    langs = ["en", None, "de"]
    rows = [(langs[i % 3], t) for i, t in enumerate(random_texts(least) + [None, "", " "])]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    phrases = collocations.counted(df, least=least)
    f, n = brute_counts(rows, least)
    got = {(r["lang"], r["phrase"]): r["f"] for r in phrases.where("m > 0").collect()}
    assert got == f
    assert {r["lang"]: r["f"] for r in phrases.where("m = 0").collect()} == {k: c for k, c in n.items() if c}
    for top in (2000, 3):
        want = brute_ranked(rows, least, top)
        assert sorted(map(tuple, collocations.ranked(phrases, top).collect())) == want and want


@pytest.mark.parametrize("least", [2, 30])
def test_small_tables(spark, least):
    for df in (fixtures.docs(spark), fixtures.small(spark)):
        phrases = collocations.counted(df, least=least)
        assert sorted(map(tuple, collocations.ranked(phrases).collect())) == brute_ranked(rows_of(df), least)


def test_equal_to_sql(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    problems, n = differences(collocations.ranked(collocations.counted(df)), connect(SF01).sql(collocations.ORACLE_SQL))
    assert problems == [] and n


def test_parts_by_broadcast_or_exchange(spark, monkeypatch):
    df = spark.createDataFrame([("en", t) for t in random_texts(7)], "lang string, text string")
    phrases = collocations.counted(df, least=3)
    found = []
    for heavy in (1, 50, 10**9):
        monkeypatch.setattr(collocations, "HEAVY", heavy)
        found.append(sorted(map(tuple, collocations.ranked(phrases).collect())))
    assert found[0] == found[1] == found[2]


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**14
    rows = [("en", 2, "a b", big), ("en", 1, "a", big + 1), ("en", 1, "b", big + 5), ("en", 0, "", 3 * big)]
    df = spark.createDataFrame(rows, "lang string, m int, phrase string, f long")
    (row,) = collocations.ranked(df).collect()
    assert row["score"] == 2000000 * big // (2 * big + 6)


def test_paths_are_whole_passages(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} x{i}" for i in range(20)] + [f"y{i} {passage}" for i in range(20)]
    texts += [" ".join(f"q{i}" for i in range(5))] * 31 + ["one two three"] * 40
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    got = collocations.paths(collocations.counted(df)).collect()
    assert sorted((r["passage"], r["n_words"], r["f"]) for r in got) == [
        (passage, 40, 40),
        ("q0 q1 q2 q3 q4", 5, 31),
    ]
    ring = spark.createDataFrame([("en", "a b c " * 200)], "lang string, text string")
    assert collocations.paths(collocations.counted(ring)).count() <= 3


def test_inner_nodes(spark):
    texts = ["a b c d e"] * 40 + ["z b c d e"] * 2 + ["c d e"] * 5
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    got = collocations.inner_nodes(collocations.counted(df, least=2)).collect()
    assert sorted(r["node"] for r in got) == []
    df = spark.createDataFrame([("en", t) for t in texts[:42]], "lang string, text string")
    got = collocations.inner_nodes(collocations.counted(df, least=2)).collect()
    assert got == []  # two edges lead to "b c d"
    df = spark.createDataFrame([("en", t) for t in texts[:40]], "lang string, text string")
    got = collocations.inner_nodes(collocations.counted(df, least=2)).collect()
    assert [r["node"] for r in got] == ["b c d"]


@pytest.mark.parametrize("collide", [False, True])
def test_sums_are_exact_whatever_the_hashes(collide):
    r = np.random.default_rng(1)
    grams = r.integers(0, 4, (4, 900)).astype(np.int32)
    counts = r.integers(1, 5, 900)
    hashes = collocations._hashes(7, r.integers(0, 1 << 60, 4).astype(np.uint64), grams)
    if collide:
        hashes = hashes % np.uint64(5)
    want = Counter()
    for g, c in zip(grams.T.tolist(), counts.tolist(), strict=True):
        want[tuple(g)] += c
    rows, sums, order = collocations._summed(grams, counts, hashes)
    assert dict(zip(map(tuple, rows.T.tolist()), sums.tolist(), strict=True)) == want
    assert rows.shape[1] == len(want) and (order[1:] >= order[:-1]).all()


def test_blocks_are_read_as_written():
    r = np.random.default_rng(2)
    words = [f"w{i}é".encode() for i in range(70_000)]
    grams = np.concatenate([np.stack([np.arange(1, 70_001)] * 3), r.integers(0, 70_001, (3, 999))], axis=1)
    grams = grams.astype(np.int32)
    counts = r.integers(1, 1 << 40, grams.shape[1])
    of_word = collocations._word_hashes(words)
    grams, counts, hashes = collocations._summed(grams, counts, collocations._hashes(1, of_word, grams))
    for parts in (1, 7):
        rows = list(collocations._blocks("en", words, grams, counts, hashes, parts))
        assert len(rows) == parts and len({row[0] for row in rows}) == parts
        known, back, sums = collocations._read(collocations._frame(rows))
        spell = lambda names, g: [[names[k - 1] if k else None for k in c] for c in g.T.tolist()]
        assert spell(known, back) == spell(words, grams) and (sums == counts).all()


def test_empty_table(spark):
    for df in (fixtures.empty(spark), spark.createDataFrame([(None, None), ("en", " ")], "lang string, text string")):
        phrases = collocations.counted(df)
        assert collocations.ranked(phrases).collect() == []
        assert collocations.paths(phrases).collect() == []
