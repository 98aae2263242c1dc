"""Results that must not depend on a bound, on a neighbour in the text or on a short cut."""

import numpy as np
import pytest

from marketmill.llm import packing, pii, toxicity
from tests.llm import fixtures


def test_a_capped_sample_keeps_the_labels_ratio(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.where("doc_id % 2 = 1").collect()}
    held = [(r["text"], toxic[r["doc_id"]]) for r in df.collect() if r["doc_id"] in toxic]
    chance, called = {}, {}
    for rows in (toxicity.SAMPLE_ROWS, 150):  # 1 toxic to 8 clean, and as many of either
        grades = toxicity.fit(df, labels.where("doc_id % 2 = 0"), rows).grades(t for t, _ in held)
        chance[rows] = 1 - grades[:, 0].mean()
        called[rows] = sum(g < 0.5 for g, (_, t) in zip(grades[:, 0], held, strict=True) if not t)
    assert chance[150] == pytest.approx(chance[toxicity.SAMPLE_ROWS], abs=0.03)
    assert chance[150] == pytest.approx(np.mean([t for _, t in held]), abs=0.03)
    assert abs(called[150] - called[toxicity.SAMPLE_ROWS]) <= 0.002 * len(held)


def test_a_row_that_stands_for_several_counts_as_several():
    lists, grades = [[0], [0, 1], [1], [1], []], np.array([2, 1, 0, 1, 0])
    counts = np.array([1, 3, 8, 1, 2])

    def fitted(rows, **counted):
        words = [np.array(lists[r], dtype=np.int64) for r in rows]
        bounds = np.cumsum([0, *map(len, words)])
        return toxicity.fit_ordinal(np.concatenate(words), bounds, grades[rows], 2, 3, **counted)

    one, many = fitted(np.arange(5), counts=counts), fitted(np.repeat(np.arange(5), counts))
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(one, many, strict=True))


def redacted(spark, texts):
    out = pii.redact(fixtures.docs(spark, texts, repeat=())).orderBy("doc_id").collect()
    return [r["text"] for r in out]


def test_ibans_whatever_stands_beside_them(spark):
    one, two = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    cases = [
        (f"{one} Bank", "[IBAN] Bank"),
        (f"{one} BIC COBADEFFXXX", "[IBAN] BIC COBADEFFXXX"),
        ("DE89370400440532013000 Please pay", "[IBAN] Please pay"),
        ("DE89370400440532013000 12 May", "[IBAN] 12 May"),
        (f"{one} 7 A {two} X", "[IBAN] 7 A [IBAN] X"),
        (f"{one} {two} {one}", "[IBAN] [IBAN] [IBAN]"),
        (f"BE12 {one} 1", "BE12 [IBAN] 1"),
        (f"ZZ99 {one} 1", "ZZ99 [IBAN] 1"),
        ("NO93 8601 1117 947 MT84 MALT 0110 0001 2345 MTLC AST0 01S", "[IBAN] [IBAN]"),
        (f"{one}7 x", f"{one}7 x"),
        (f"A{one}", f"A{one}"),
        (f"{one[:-1]}1 Bank", f"{one[:-1]}1 Bank"),
        (f"({one}), é😀 {two}.", "([IBAN]), é😀 [IBAN]."),
    ]
    assert redacted(spark, [t for t, _ in cases]) == [want for _, want in cases]


def test_context_reaches_across_spans_and_after_them(spark):
    a, b, c = "123-45-6789", "219-09-9999", "457-55-5462"
    far = "x" * 40
    cases = [
        (f"SSN: {a}, {b}, {c}.", "SSN: [SSN], [SSN], [SSN]."),
        (f"SSN\n{a}\n{b}", "SSN\n[SSN]\n[SSN]"),
        (f"ssn {a} for Ann, {b} for Bob", "ssn [SSN] for Ann, [SSN] for Bob"),
        (f"{a} (SSN)", "[SSN] (SSN)"),
        (f"ssn {a} but also {b} for the spouse", "ssn [SSN] but also [SSN] for the spouse"),
        (f"SSN is {a}, but hers is {c}", "SSN is [SSN], but hers is [SSN]"),
        (f"{a}, {b} (SSN)", "[SSN], [SSN] (SSN)"),
        (f"{a}, {b}", f"{a}, {b}"),
        (f"SSN {far} {a}, {b}", f"SSN {far} {a}, {b}"),
        (f"{a} {far} SSN", f"{a} {far} SSN"),
        (f"é😀 {a} é😀 social", "é😀 [SSN] é😀 social"),
        ("SSN:\n" + "\n".join([a, b] * 9), "SSN:\n" + "\n".join(["[SSN]"] * 18)),
        (f"ssn {a}, {b} or {c} " + "in " * 15 + a, "ssn [SSN], [SSN] or [SSN] " + "in " * 15 + a),
    ]
    assert redacted(spark, [t for t, _ in cases]) == [want for _, want in cases]


def test_ids_are_those_of_a_plain_encode(spark):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    library, words = Tokenizer.from_file(path), packing.WordTokens(path)
    encode = lambda t: library.encode(t, add_special_tokens=False).ids
    assert encode("hello <|endoftext|> world") == [31373, 220, 50256, 995]
    every = [chr(c) for c in range(0x2200)]
    unlike = [c for c in every if not words._cut_alike(c)]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|",
             *fixtures.TEXTS[1:], *[f"a{c}b 1{c}2 .{c}. {c} x  {c}" for c in unlike]]
    for text in texts:
        assert np.frombuffer(words.encoded(text), "<u4").tolist() == encode(text), text[:80]
    alike = [c for c in every if c not in set(unlike)]
    for k in range(0, len(alike), 5000):
        text = "".join(f"a{c}b1{c}2.{c}. {c}  {c}" for c in alike[k : k + 5000])
        assert words._cut(text) == [text[i:j] for _, (i, j) in words._split(text)]
    df = fixtures.docs(spark, texts[:4], repeat=())
    for r in packing.packed(df).collect():
        ids = np.array([*encode(texts[r["doc_id"] - 3]), 0], "<u4")
        assert (r["length"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
