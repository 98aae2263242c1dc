"""A small corpus with every awkward case, and rows of the test tables."""

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 5

# Columns whose names clash with what operators make; text may be null, empty or very long.
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("size", T.StringType()),
        T.StructField("number", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("h", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("sequence_id", T.StringType()),
    ]
)
TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "Mail a.b@c.de, x@y.zz@q.rr or ..@..; ip 1.2.3.4.5 and 300.1.1.1, 010.001.0.255",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 12 34, call +1 (555) 123-4567 now +12-",
    "my IBAN is DE89 3704 0044 0532 0130 00 and ssn 123-45-6789 but 123-45-6788 alone; é😀 a@b.co",
    "\u0001a@b.co\u0001 x@y.z",
    BASE,
    BASE,
    BASE.upper(),
    BASE + "tail one two",
    BASE.replace("nine", "NINE!"),
    "a b a b a b a b a b a b",
    "line\nline\n \nline\nother # $ | <x>",
    "word " * 30_000,
    "x" * 40_000,
    " ".join(f"w{i}" for i in range(400)),
    " ".join(f"w{i}" for i in range(390)) + " more here",
    "Licensed under CC BY-NC 4.0. All rights reserved. GNU General Public License, version 3",
    "all rights all rights reserved cc\nby cc, by",
    "\n".join(["This work is licensed under the GNU General Public License, version 3."] * 3),
    "ünïcödé wörds ünïcödé wörds ünïcödé wörds " * 6,
    "1.1.1.1" * 300 + " a@b" + ".c" * 3000,
]


def docs(spark, texts=TEXTS, source=lambda i: [None, "b", "a", "é", "b"][i % 5], repeat=(8,)):
    rows = [
        (i + 3, t, "en", source(i), len(t or ""), "s", "n", "k", "sc", "h", "sp", "q")
        for i, t in enumerate(texts)
    ]
    rows += [rows[k] for k in repeat if k < len(rows)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def small(spark, table="documents"):
    return spark.read.parquet(f"{SMALL}/{table}.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
