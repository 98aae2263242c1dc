"""Runs of words against every stretch tried, and what is kept of a text."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from marketmill.llm import periodic_runs
from marketmill.llm.queries import op13_periodic_runs
from tests.llm import fixtures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, times=3):
    """Every period from 1 on: stretches in which words that far apart are the same; a span that
    a smaller period has already is not a run of this one."""
    found = {}
    n = len(words)
    for q in range(1, n // times + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - start >= max(least, times * q):
                found.setdefault((start, k + q - start), q)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text, edit=True):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if edit and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def texts_with_runs(seed):
    r = random.Random(seed)
    out = []
    for _ in range(60):
        words = []
        for _ in range(r.randint(1, 6)):
            unit = [r.choice("abcd") for _ in range(r.randint(1, 30))]
            part = (unit * 40)[: len(unit) * r.randint(1, 7) + r.randint(0, len(unit))]
            words += part[r.randint(0, 3) :]
        out.append(r.choice([" ", "\n", "\t \x0b"]).join(words))
    return out


@pytest.mark.parametrize("least, times", [(24, 3), (8, 2), (5, 4), (30, 2)])
def test_runs_of_random_words(least, times):
    r = random.Random(least)
    for k in range(400):
        words = texts_with_runs(k)[0].split() if k % 4 == 0 else [
            r.choice("ab" if k % 2 else "abc") for _ in range(r.randint(0, 120))
        ]
        ids = np.array([ord(w) for w in words], np.int64)
        assert periodic_runs.runs(ids, least, times) == brute_runs(words, least, times)


def test_strings_of_many_runs():
    a, b = "a", "ab"
    for _ in range(9):  # Fibonacci words hold as many runs as words can
        a, b = b, b + a
    for text in (b, "a" * 200, "ab" * 90 + "a", ("a" * 30 + "b") * 5, "abc" * 8, "abc" * 8 + "a"):
        ids = np.array([ord(c) for c in text], np.int64)
        assert periodic_runs.runs(ids) == brute_runs(text)
        assert periodic_runs.runs(ids, 2, 2) == brute_runs(text, 2, 2)


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_runs_of_tables(spark, table):
    df = table(spark)
    got = periodic_runs.digest(periodic_runs.found(df, edit=periodic_runs.looped))
    want = [brute_digest(i, t) for i, t in fixtures.pairs(df) if len(t or "") < 60_000]
    long = {i for i, t in fixtures.pairs(df) if len(t or "") >= 60_000}
    key = lambda r: (r[0], str(r))
    assert sorted((tuple(r) for r in got.collect() if r["doc_id"] not in long), key=key) == sorted(want, key=key)


def test_runs_across_texts(spark):
    texts = texts_with_runs(1) + texts_with_runs(1)[:5]
    df = fixtures.docs(spark, texts).repartition(2)
    got = periodic_runs.digest(periodic_runs.found(df)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_digest(i, t, False) for i, t in fixtures.pairs(df)), key=str)


def test_registered_query(spark):
    got = op13_periodic_runs(spark, fixtures.SMALL)
    kinds = dict(got.dtypes)
    assert [kinds.pop(c) for c in ("runs_sha256", "collapsed_sha256")] == ["string"] * 2
    assert set(kinds.values()) == {"bigint"}
    assert got.where("n_runs > 0").count() >= 0.05 * got.count()


def test_one_word_over_and_over(spark):
    df = fixtures.docs(spark, ["word " * 50_000, "x"], repeat=())
    one = periodic_runs.found(df).where("doc_id = 3").first()
    assert (one["n_words"], one["start"], one["length"], one["period"]) == (50_000, [0], [50_000], [1])
    assert one["collapsed"] == "word"


def test_empty_table_null_ids_and_extra_columns(spark):
    assert periodic_runs.digest(periodic_runs.found(fixtures.empty(spark))).count() == 0
    rows = [(None, "z " * 60, "c"), (None, None, "c"), (7, "z\n" * 24, "c"), (7, "\x1cz " * 24, "c"), (8, "z " * 23, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = periodic_runs.digest(periodic_runs.found(df, edit=periodic_runs.looped)).collect()
    assert sorted((tuple(r)[1:6] for r in got), key=str) == sorted(
        [(1, 0, 60, 1, 60_000), (0, *[None] * 4), (1, 0, 24, 1, 24_000), (1, 0, 24, 1, 24_000), (0, *[None] * 4)],
        key=str,
    )
