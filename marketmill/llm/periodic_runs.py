"""Runs (maximal repetitions) of words in each text, by maximal pairs of its suffixes.

A run is a stretch of at least ``MIN_WORDS`` words and ``EXPONENT`` times its smallest period
that no neighbouring word extends. Texts are independent of one another: one pass, no exchange.

* A run of period q and length L is the pair of suffixes (s, s + q) that agree in exactly L - q
  words and have different words before them: a maximal pair. Such a pair agrees in at least
  ``MIN_MATCH`` words, so texts without a repeated stretch of that many words have no run, and
  only suffixes that start with one take part. A hash finds those texts; it can only find too many.
* Suffixes are sorted by doubling ranks, whose levels also give the words that neighbours share.
  The tree of LCP intervals is built bottom up; each interval holds its suffixes in text order,
  each in the class of its left word. Where children meet, a suffix pairs with its neighbours of
  another class in the other child's list. Pairs are kept if their distance is at most half of
  the interval's depth. No smaller period hides: had a third suffix of the interval stood between
  s and s + q, the run would have a period shorter than q.
* A pair at a multiple of the period spans the same words; the smallest distance of a span is
  its period. Nothing is extended: a maximal pair ends where its run does.

Defined results: a null or empty text, or one of white space, has no words and no runs. Rows are
judged one by one, so repeated rows give repeated results; a null id stays null. Other columns
are not read. A text is one task's work, in memory that is linear in its words times the
logarithm of the longest repeat.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import ship

MIN_WORDS = 24
EXPONENT = 3
GROUP_WORDS = 200_000  # words that are looked at together

# Which word stands at each place of an edited text, by its id and number of words; None: as is.
Edit = Callable[[int | None, int], np.ndarray | None]


def min_match(min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> int:
    """Words that the two suffixes of any run share, at least."""
    return min(max(min_words - q, (exponent - 1) * q) for q in range(1, min_words + 1))


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """The edit of the registered query: a tenth of the texts, chosen by id, repeat a stretch
    of theirs to the end. A null id has no digits and is left alone."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def with_repeats(hashes: np.ndarray, sizes: np.ndarray, match: int) -> np.ndarray:
    """Which texts may hold a stretch of ``match`` words twice; ``hashes`` are those of the words
    of all texts one after another."""
    if len(hashes) < match:
        return np.zeros(len(sizes), bool)
    grams, width = hashes, 1
    while width < match:  # hashes of ever longer stretches
        step = min(width, match - width)
        grams = _mixed(grams[:-step] * np.uint64(0xD6E8FEB86659FD93) + grams[step:])
        width += step
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    inside = text_of[: len(grams)] == text_of[match - 1 :]
    grams, text_of = grams[inside], text_of[: len(inside)][inside]
    grams = _mixed(grams ^ (text_of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    ordered = np.sort(grams)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    found = np.zeros(len(sizes), bool)
    if len(twice):
        found[text_of[np.isin(grams, twice)]] = True
    return found


def _levels(words: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... words from each place on, until all differ. A
    stretch that the text's end cuts short equals no other."""
    levels = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    n, width = len(words), 1
    while width < n and levels[-1].max() < n - 1:
        rank = levels[-1]
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:] + 1
        levels.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1])
        width *= 2
    return levels


def _shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at a and b have in common, pair by pair; a differs from b."""
    n = len(levels[0])
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < n) & (y < n)
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        common[same] += 1 << k
    return common


def maximal_pairs(words: np.ndarray, match: int, divisor: int) -> Iterator[tuple[int, int, int]]:
    """(place, distance, words shared) of pairs of suffixes that share at least ``match`` words
    and ``divisor`` times their distance, and that differ on both sides."""
    levels = _levels(words)
    order = np.argsort(levels[-1], kind="stable")
    depth = _shared(levels, order[:-1], order[1:])
    deep = depth >= match
    taking_part = np.r_[deep, False] | np.r_[False, deep]
    # Between the suffixes that take part, neighbours that share less start a new tree.
    depth = np.r_[np.where(deep, depth, 0), 0][taking_part].tolist()
    places = order[taking_part].tolist()
    left = [-1, *levels[0][:-1].tolist()]  # the class of a suffix: its left word

    def joined(one: list[int], other: list[int], shared: int):
        """Both lists as one, in text order, and the pairs between them."""
        if len(one) < len(other):
            one, other = other, one
        far = shared // divisor
        pairs = []
        for x in other:
            k = bisect_left(one, x)
            if k and x - one[k - 1] <= far and left[x] != left[one[k - 1]]:
                pairs.append((one[k - 1], x - one[k - 1], shared))
            if k < len(one) and one[k] - x <= far and left[x] != left[one[k]]:
                pairs.append((x, one[k] - x, shared))
        for x in other:
            insort(one, x)
        return one, pairs

    open_: list[tuple[int, list[int]]] = []  # intervals on the path to the last suffix
    for place, below in zip(places, depth, strict=True):
        last = [place]  # a finished child; ``below``: words shared with the next suffix
        while open_ and open_[-1][0] >= below:
            shared, members = open_.pop()
            last, pairs = joined(members, last, shared)
            yield from pairs
        if below:
            open_.append((below, last))


def runs(
    words: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text's word numbers, by start, then period."""
    match = min_match(min_words, exponent)
    spans: dict[tuple[int, int], int] = {}
    if len(words) >= min_words:
        for place, distance, shared in maximal_pairs(words, match, exponent - 1):
            length = shared + distance
            if length >= min_words:
                known = spans.get((place, length), distance)
                spans[place, length] = min(known, distance)
    return sorted(((s, n, q) for (s, n), q in spans.items()), key=lambda r: (r[0], r[2]))


def _kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Places that no run covers after its first period."""
    mark = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        mark[start + period] += 1
        mark[start + length] -= 1
    return np.flatnonzero(np.cumsum(mark[:-1]) == 0)


def _group(rows: list[tuple], min_words: int, exponent: int):
    """(found, collapsed) of a few texts; rows: (words, places or None)."""
    sizes = np.array([len(words) for words, _ in rows])
    hashes = [
        np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64) for words, _ in rows
    ]
    hashes = [h if at is None else h[at] for h, (_, at) in zip(hashes, rows, strict=True)]
    match = min_match(min_words, exponent)
    likely = with_repeats(np.concatenate(hashes), sizes, match)
    for (words, at), look in zip(rows, likely.tolist(), strict=True):
        if at is not None:
            words = [words[k] for k in at.tolist()]
        found = []
        if look:
            number = {w: k for k, w in enumerate(dict.fromkeys(words))}
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            found = runs(ids, min_words, exponent)
        if found:
            words = [words[k] for k in _kept(len(words), found).tolist()]
        yield found, b" ".join(words).decode()


FOUND = "doc_id long, n_words long, start array<long>, length array<long>, period array<long>, collapsed string"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("start", "length", "period")]
    + [("collapsed", pa.string())]
)


def found(
    docs: DataFrame,
    key="doc_id",
    text="text",
    min_words: int = MIN_WORDS,
    exponent: int = EXPONENT,
    edit: Edit | None = None,
) -> DataFrame:
    """Per row: doc_id, n_words, the runs as three lists in step (by start, then period), and the
    text's words without those that a run repeats, joined by blanks. With ``edit``, of the edited
    text. Works on any ``exponent`` from 2 on."""
    if exponent < 2 or min_words < 2:
        raise ValueError("a run is at least two periods and two words long")

    def finished(ids, groups):
        rows = []
        for doc_id, n, (runs_, collapsed) in zip(ids[0], ids[1], groups, strict=True):
            start, length, period = map(list, zip(*runs_, strict=True)) if runs_ else ([], [], [])
            rows.append((doc_id, n, start, length, period, collapsed))
        columns = zip(*rows, strict=True)
        return pa.record_batch(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
        )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, rows, held = [], [], [], 0
            for doc_id, data in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = data.as_buffer().to_pybytes().split()  # exactly the six white bytes
                at = edit(doc_id, len(words)) if edit else None
                ids.append(doc_id)
                counts.append(len(words))
                rows.append((words, at))
                held += len(words)
                if held >= GROUP_WORDS:
                    yield finished((ids, counts), _group(rows, min_words, exponent))
                    ids, counts, rows, held = [], [], [], 0
            if rows:
                yield finished((ids, counts), _group(rows, min_words, exponent))

    ship(docs.sparkSession)
    texts = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(look, FOUND)


def digest(rows: DataFrame) -> DataFrame:
    """The registered query's columns. The strongest run is the one of the greatest exact ratio
    of length to period; ratios are compared by their products, which fit 64 bits."""
    each = F.arrays_zip("start", "length", "period")
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    stronger = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate(each, none, lambda a, b: F.when(a.isNull() | stronger(a, b), b).otherwise(a))
    numbers = lambda r: [r[c].cast("string") for c in ("start", "length", "period")]
    lines = F.transform(each, lambda r: F.concat(F.concat_ws(",", *numbers(r)), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("start").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
