"""Toxicity by cumulative-link ordinal regression over the words of a text.

Severity grades 0 (clean) to 2 are ordered, and one weight per word serves every step between
them: P(grade <= k) = logistic(threshold_k - sum of weights of the text's words). The operator
gives the expected grade, the likeliest grade, and whether grade 1 or more is likelier than not.

The labels tell toxic from clean only; a toxic sample text is graded 2 where it holds at least
as many toxic-leaning words as the median toxic one, else 1. The model is fitted on a sample of
at most about ``SAMPLE_ROWS`` labelled documents of either class, picked by the hash of their
id, with at most ``FEATURES`` words, those that tell the classes apart best. A sample text counts
for as many labelled ones as it was drawn from, so that the thresholds carry the labels' own ratio
of classes, however many there are. All documents are scored, over their whole texts.

Defined results: null, empty and wordless texts score like a text without known words; without
labels of both classes every text has grade 0. A document labelled twice counts as toxic if any
label says so; null labels and ids do not count. Repeated rows are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import settle

SAMPLE_ROWS = 6_000
FEATURES = 4_000
MIN_TEXTS = 5
MIN_INFORMATION = 15.0
ROUNDS = 300
RIDGE = 0.002

# ASCII letters lower-cased, other ASCII but digits as blanks; bytes of other characters stay.
_WORDS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def distinct_words(text: str | None) -> set[bytes]:
    return set((text or "").encode().translate(_WORDS).split())


@dataclass
class Model:
    words: dict[bytes, float]
    thresholds: np.ndarray  # ascending, one per step between grades

    def grades(self, texts) -> np.ndarray:
        """Probability of each grade, a row per text."""
        known = self.words.keys()
        sums = np.array([sum(map(self.words.get, known & distinct_words(t))) for t in texts])
        return probabilities(sums, self.thresholds)


def probabilities(sums: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    below = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - sums[:, None], -500, 500)))
    n = len(sums)
    return np.diff(np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))]), axis=1)


def fit_ordinal(
    indices, bounds, grades, n_words, n_grades, rounds=ROUNDS, ridge=RIDGE, counts=None
):
    """Weights and thresholds by full-batch Adam. Row r's words are indices[bounds[r]:bounds[r+1]].
    Thresholds are a first one and positive steps, so that they stay in order. A row counts as
    ``counts[r]`` rows, without counts as one."""
    rows = len(grades)
    share = np.full(rows, 1 / rows) if counts is None else counts / np.sum(counts)
    row_of = np.repeat(np.arange(rows), np.diff(bounds))
    steps = n_grades - 1
    theta = np.zeros(n_words + steps)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        weights, raw = theta[:n_words], theta[n_words:]
        gaps = np.exp(raw[1:])
        thresholds = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        sums = np.bincount(row_of, weights[indices], rows)
        inner = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - sums[:, None], -500, 500)))
        below = np.hstack([np.zeros((rows, 1)), inner, np.ones((rows, 1))])
        slope = below * (1 - below)
        r = np.arange(rows)
        chance = np.maximum(below[r, grades + 1] - below[r, grades], 1e-12)
        up, down = slope[r, grades + 1] / chance, slope[r, grades] / chance
        by_sum = (up - down) * share  # of the negative log-likelihood
        by_threshold = np.zeros(n_grades + 1)
        np.add.at(by_threshold, grades + 1, -up * share)
        np.add.at(by_threshold, grades, down * share)
        inside = by_threshold[1:-1]
        gradient = np.empty_like(theta)
        gradient[:n_words] = np.bincount(indices, by_sum[row_of], n_words) + ridge * weights / 10
        gradient[n_words] = inside.sum()
        later = np.cumsum(inside[::-1])[::-1]
        gradient[n_words + 1 :] = later[1:] * gaps
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= 0.1 * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
    raw = theta[n_words:]
    return theta[:n_words], raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(labelled_id, toxic, stands_for): about ``rows`` ids of each class at most, by their hash,
    and how many labelled ids of its class each one stands for."""
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share, stands_for = F.lit(0.0), F.lit(1.0)
    for r in marked.groupBy("toxic").count().collect():  # one row per class
        own = F.col("toxic") == r["toxic"]
        share = F.when(own, min(1.0, rows / r["count"])).otherwise(share)
        stands_for = F.when(own, max(1.0, r["count"] / rows)).otherwise(stands_for)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) < share * (1 << 30)
    drawn = marked.where(draw).withColumn("stands_for", stands_for)
    return drawn.withColumnRenamed("doc_id", "labelled_id")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """None where the labels do not hold both classes."""
    ids = F.broadcast(labelled_sample(labels, rows))  # at most about 2 * rows

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame(
                {
                    "toxic": b["toxic"],
                    "stands_for": b["stands_for"],
                    "words": [
                        [w.decode(errors="replace") for w in sorted(distinct_words(t))]
                        for t in b["text"]
                    ],
                }
            )

    sample = settle(
        docs.select("doc_id", "text")
        .join(ids, F.col("doc_id") == F.col("labelled_id"))
        .select("toxic", "stands_for", "text")
        .mapInPandas(words_of, "toxic int, stands_for double, words array<string>")
    )
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not size.get(0) or not size.get(1):
        return None
    counted = (
        sample.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
        .where(F.col("n") >= MIN_TEXTS)
    )
    information = _information(F.col("t"), F.col("n") - F.col("t"), size[1], size[0])
    features = (
        counted.withColumn("information", information)
        .where(F.col("information") >= MIN_INFORMATION)
        .orderBy(F.desc("information"), "word")
        .limit(FEATURES)
        .collect()
    )
    if not features:
        return None
    place = {r["word"]: k for k, r in enumerate(features)}
    leaning = np.array([r["t"] / size[1] > (r["n"] - r["t"]) / size[0] for r in features])

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[place[w] for w in words if w in place] for words in b["words"]]
            yield pd.DataFrame(
                {"toxic": b["toxic"], "stands_for": b["stands_for"], "words": found}
            )

    # The sample's rows, each with at most FEATURES numbers.
    data = sample.mapInPandas(
        indexed, "toxic int, stands_for double, words array<int>"
    ).toPandas()
    toxic = data["toxic"].to_numpy()
    lists = [np.asarray(w, dtype=np.int64) for w in data["words"]]
    hits = np.array([leaning[w].sum() for w in lists])
    grades = np.where(toxic == 1, np.where(hits >= np.median(hits[toxic == 1]), 2, 1), 0)
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in lists])])
    weights, thresholds = fit_ordinal(
        np.concatenate(lists),
        bounds,
        grades.astype(np.int64),
        len(features),
        3,
        counts=data["stands_for"].to_numpy(),
    )
    words = {r["word"].encode(): float(w) for r, w in zip(features, weights, strict=True)}
    return Model(words, thresholds)


def _information(a, b, n_a: int, n_b: int):
    """Likelihood-ratio statistic of a word's counts a of n_a texts and b of n_b."""
    share = (a + b) / F.lit(float(n_a + n_b))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    yes = part(a, share * n_a) + part(b, share * n_b)
    no = part(n_a - a, (1 - share) * n_a) + part(n_b - b, (1 - share) * n_b)
    return 2 * (yes + no)


def scored(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents' own columns with ``__severity``: grade, expected and toxic."""
    out = "grade int, expected double, toxic boolean"

    @F.pandas_udf(out)
    def severity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            if model is None:
                chances = np.tile([1.0, 0.0, 0.0], (len(texts), 1))
            else:
                chances = model.grades(texts)
            yield pd.DataFrame(
                {
                    "grade": chances.argmax(axis=1).astype(np.int32),
                    "expected": chances @ np.arange(chances.shape[1]),
                    "toxic": chances[:, 0] < 0.5,
                }
            )

    return docs.withColumn("__severity", severity(F.col(text)))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, severity (grade), expected_severity, toxic."""
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select(
        "doc_id",
        F.col("__severity.grade").alias("severity"),
        F.col("__severity.expected").alias("expected_severity"),
        F.col("__severity.toxic").alias("toxic"),
    )


def clean_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with their own columns."""
    rows = scored(docs, fit(docs, labels)).where(~F.col("__severity.toxic"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
