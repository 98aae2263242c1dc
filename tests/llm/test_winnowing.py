"""Fingerprints against plain winnowing, and what is beside each text."""

import hashlib
import random
import re

import pytest
import xxhash

from marketmill.llm import winnowing
from marketmill.llm.queries import op11_winnowing
from tests.llm import fixtures

UNIT = re.compile(winnowing.UNIT.replace(r"\x{20000}-\x{3FFFF}", "\U00020000-\U0003ffff"))
P, B = winnowing.PRIME, winnowing.BASE


def brute_marks(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    """[(place, hash)] by one window after another."""
    units = []
    for w in UNIT.findall(text or ""):
        h = xxhash.xxh64(w.encode(), seed=42).intdigest()
        units.append((h - (1 << 64) if h >> 63 else h) % P)
    if not units:
        return []
    grams = []
    for i in range(max(1, len(units) - gram + 1)):
        h = 0
        for u in units[i : i + gram]:
            h = (h * B + u) % P
        grams.append(h)
    marks = set()
    for i in range(max(1, len(grams) - window + 1)):
        part = grams[i : i + window]
        least = min(part)
        place = max(j for j, g in enumerate(part) if g == least)
        marks.add((i + place, least))
    return sorted(marks)


def brute_likeness(one, other):
    a, b = ({h for _, h in m} for m in (one, other))
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_rows(pairs):
    """By doc_id descending, nulls last, equal ids by the hash of the text and the text."""
    signed = lambda t: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64(t.encode(), seed=42).intdigest())
    rows = [(i, t or "") for i, t in pairs]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1]), r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks, new = brute_marks(text), brute_marks(edited)
        show = lambda m: " ".join(f"{p}:{h}" for p, h in m)
        out.append(
            (
                i,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                show(marks),
                show(new),
                brute_likeness(marks, new),
                brute_likeness(marks, brute_marks(after)),
            )
        )
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, winnowing.digest(winnowing.compared(df)).collect()), key=str)


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_fingerprints(spark, table):
    df = table(spark)
    assert found(df) == brute_rows(fixtures.pairs(df))


@pytest.mark.parametrize("gram, window", [(1, 1), (2, 3), (3, 5), (7, 4), (8, 16)])
def test_any_gram_and_window(spark, gram, window):
    r = random.Random(gram)
    texts = [" ".join(r.choice("abc") for _ in range(n)) for n in range(40)]
    texts += ["日本語の文章" * 5, "日本語 の文章 and words" * 3, "สวัสดีครับ", "a" * 9, "\U00020001x\U00020002"]
    df = fixtures.docs(spark, texts, repeat=())
    got = {r["doc_id"]: r["f"] for r in winnowing.fingerprints(df, gram=gram, window=window)
           .select("doc_id", winnowing.listed("marks").alias("f")).collect()}
    for i, text in fixtures.pairs(df):
        assert got[i] == " ".join(f"{p}:{h}" for p, h in brute_marks(text, gram, window)), text


def test_shared_stretches_are_always_found():
    r = random.Random(5)
    long = winnowing.GRAM + winnowing.WINDOW - 1
    for _ in range(200):
        word = lambda: f"w{r.randint(0, 10**6)}"
        stretch = [word() for _ in range(long)]
        one = [word() for _ in range(r.randint(0, 30))] + stretch + [word() for _ in range(r.randint(0, 30))]
        other = [word() for _ in range(r.randint(0, 30))] + stretch + [word() for _ in range(r.randint(0, 30))]
        assert brute_likeness(brute_marks(" ".join(one)), brute_marks(" ".join(other))) > 0


def test_next_rows_in_any_number_of_ranges(spark, monkeypatch):
    for rows_in_range in (1, 3, 10**9):
        monkeypatch.setattr(winnowing, "BUCKET_ROWS", rows_in_range)
        ids = [*range(-20, 20, 3), 1 << 62, (1 << 62) + 1, (1 << 62) + 2, 5, 5, 5, None, None]
        rows = [(i, f"text {k} of {i}") for k, i in enumerate(ids)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert found(df) == brute_rows(rows)


def test_few_rows(spark):
    for rows in ([], [(1, "only one here")], [(None, "a b"), (None, None)], [(3, "x y"), (3, "x y")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(df) == brute_rows(rows)


def test_clashing_columns(spark):
    df = fixtures.docs(spark)
    for c in ("marks", "range_key", "next_text", "edited"):
        df = df.withColumnRenamed(df.columns[-1], c).select("doc_id", "text", "kept", c)
        assert len(found(df)) == df.count()


def test_registered_query_and_its_plan(spark):
    df = op11_winnowing(spark, fixtures.SMALL)
    near = df.selectExpr("avg(near_edited) e", "avg(near_next) n").first()
    assert 0.2 < near["e"] < 0.5 and near["n"] < 0.1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
