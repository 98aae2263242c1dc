"""Quality rules: counts over whole texts and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed words and word pairs: what trusted documents
hold against what the whole corpus holds. A document's score is the mean over its n-grams of
log(trusted / corpus), so length does not count, and every document is judged by one threshold.

The corpus counts cover all documents, the trusted counts all trusted ones. The threshold lies as
far below the ``LOW_SHARE`` quantile of all trusted documents of ``MIN_WORDS`` words or more as
the quantile lies below their median, so that trusted-looking documents are left alone. Both
quantiles are exact; they are read from the written scores, so every text is scored once.

Defined results: a null or empty text, or one of white space, has no words, fails the base
rules and is not kept; without trusted documents every score is 0 and the base rules decide.
A window is known by 64 bits of hash; a text may hold any number of words.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.llm.shared import computed_once, settle

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 16_384
ID_BLOCKS = 8_192  # of 2^15 ids and 4 kB each, that are broadcast
LOW_SHARE = 0.005
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _hashes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text, the hashes of its words in order."""
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    return docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("words", words).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _windows(hashes: Column, n: int) -> Column:
    """Hashes of the runs of n words."""
    joined = F.transform(
        hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, n)])
    )
    return F.slice(joined, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0)))


def _repeated(ordered: Column) -> Column:
    """Words in repeated windows. ``ordered`` holds hash and place of all windows, by hash and
    then place, so that equal windows are neighbours."""
    same = lambda x, j: F.coalesce(x["h"] == F.get(ordered, j)["h"], F.lit(False))
    places = F.filter(
        F.transform(ordered, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["place"])),
        lambda p: p.isNotNull(),
    )
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    counted = F.aggregate(
        F.sort_array(places),
        start,
        lambda a, p: F.struct(
            (p + 3).alias("upto"), (a["n"] + F.least(F.lit(3), p + 3 - a["upto"])).alias("n")
        ),
    )
    return counted["n"]


def base_counts(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """doc_id, hashes, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    rows = _hashes(docs, key, text)
    rows = rows.withColumn("three", _windows(F.col("hashes"), 3))
    repeats = F.size(F.array_distinct("three")) < F.size("three")
    each = F.transform("three", lambda h, i: F.struct(h.alias("h"), i.alias("place")))
    rows = rows.withColumn("ordered", F.when(repeats, F.sort_array(each)))
    rows = rows.withColumn(
        "lines",
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    )
    return computed_once(
        rows,
        "doc_id",
        "hashes",
        F.size("hashes").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("ordered").isNotNull(), _repeated(F.col("ordered")))
        .otherwise(0)
        .cast("long")
        .alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )


def _features(hashes: Column, buckets: int) -> Column:
    """Buckets of the words and of the word pairs."""
    grams = F.concat(hashes, _windows(hashes, 2))
    return F.transform(grams, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.where("quality = 1 AND doc_id IS NOT NULL")
    return good.select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()


def _marked(docs: DataFrame, trusted: DataFrame, blocks: int = ID_BLOCKS) -> DataFrame:
    """doc_id, text, t: 1 for a trusted document. Ids lie close together as a rule: then they are
    one bit each of a few bitmaps, and no text is exchanged. Ids in more than ``blocks`` blocks
    are joined by exchange."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bitmaps = trusted.groupBy(F.bitmap_bucket_number("trusted_id").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("trusted_id")).alias("bits")
    )
    if bitmaps.select("block").count() > blocks:
        marked = docs.join(trusted, F.col("doc_id") == F.col("trusted_id"), "left")
        t = F.col("trusted_id").isNotNull()
    else:
        of_block = F.bitmap_bucket_number("doc_id") == F.col("block")
        marked = docs.join(F.broadcast(bitmaps), of_block, "left")  # counted above
        bit = F.bitmap_bit_position("doc_id")
        byte = F.conv(F.hex(F.substr("bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10)
        t = F.coalesce(F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1, F.lit(False))
    return computed_once(marked, "doc_id", "text", t.cast("long").alias("t"))


def fit(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, blocks: int = ID_BLOCKS
) -> list[float] | None:
    """Weights of the buckets, from one pass over all documents; none without trusted ones. The
    driver gets one row per bucket."""
    marked = _marked(docs, trusted_ids(labels), blocks)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    counted = (
        marked.select("t", hashes.alias("hashes"))
        .select("t", F.explode(_features(F.col("hashes"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("t").alias("good"))
        .collect()
    )
    raw_total = sum(r["raw"] for r in counted) + buckets
    good_total = sum(r["good"] for r in counted) + buckets
    if good_total == buckets:
        return None
    shift = math.log(raw_total / good_total)
    weights = [shift] * buckets
    for r in counted:
        weights[r["bucket"]] = math.log((r["good"] + 1) / (r["raw"] + 1)) + shift
    return weights


def quantiles(rows: DataFrame, name: str, shares: Sequence[float]) -> list[float] | None:
    """Exact interpolated quantiles of a column, none without rows. The built-in percentile ships
    every distinct value to one task. Here the values are cut into ranges, one per shuffle
    partition, and only those that hold a wanted rank are looked into."""
    counts = rows.groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))
    ranges = (
        counts.repartitionByRange("v")
        .groupBy(F.spark_partition_id())
        .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    last = sum(r["n"] for r in ranges) - 1
    if last < 0:
        return None
    ends = [(math.floor(s * last), math.ceil(s * last)) for s in shares]
    wanted = {rank for pair in ends for rank in pair}
    before, part = 0, F.lit(None).cast("long")
    for r in sorted(ranges, key=lambda r: r["lo"]):
        if any(before <= rank < before + r["n"] for rank in wanted):
            inside = F.col("v").between(r["lo"], r["hi"])
            part = F.when(inside, F.lit(before).cast("long")).otherwise(part)
        before += r["n"]
    so_far = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.col("part")
    held = F.array([F.lit(rank).cast("long") for rank in sorted(wanted)])
    found = (
        counts.withColumn("part", part)
        .where(F.col("part").isNotNull())
        .withColumn("upto", so_far)
        .select("v", F.explode(F.filter(held, lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))).alias("rank"))
    )
    at = {r["rank"]: r["v"] for r in found.collect()}  # a row per wanted rank
    return [
        at[lo] if at[lo] == at[hi] else (hi - s * last) * at[lo] + (s * last - lo) * at[hi]
        for s, (lo, hi) in zip(shares, ends)
    ]


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """From doc_id, n_words and score of all documents."""
    own = scored.where(F.col("n_words") >= MIN_WORDS).select("doc_id", "score")
    good = own.join(trusted_ids(labels), F.col("doc_id") == F.col("trusted_id"))
    at = quantiles(good, "score", (LOW_SHARE, 0.5))
    return 2 * at[0] - at[1] if at else 0.0


def score(hashes: Column, weights: list[float]) -> Column:
    """Mean log ratio of a text's n-grams. The weights are one folded literal of fixed length."""
    table = F.split(F.lit(",".join(f"{w:.9f}" for w in weights)), ",").cast("array<double>")
    features = _features(hashes, len(weights))
    total = F.aggregate(features, F.lit(0.0), lambda a, b: a + F.get(table, b))
    return F.when(F.size(hashes) > 0, total / (2 * F.size(hashes) - 1)).otherwise(0.0)


def judged(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, the counts, base_failed, score and kept for every document."""
    weights = fit(docs, labels, buckets)
    rows = base_counts(docs).withColumn("score", score(F.col("hashes"), weights or [0.0] * buckets))
    scored = settle(
        computed_once(
            rows,
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            base_failed().alias("base_failed"),
            "score",
        )
    )
    least = threshold(scored, labels) if weights else 0.0
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))
