"""Phrases of up to four words that keep together, from a weighted de Bruijn graph of words.

Nodes are three words in a row, edges four: an edge leads from its first three words to its last
three. Counts are needed of phrases of one to four words, and only edges are counted in the text:

* Edges. Every word of a piece starts one edge; near the piece's end the edge is cut short, and
  such a stub is the piece-end correction. A task numbers the words it meets, sorts its edges by
  hash and adds up equal ones. What is exchanged is one block per task, language and range of
  edge hashes: the words used and the edges' numbers, compressed.
* Node flow. What leaves a node, plus the stubs that end there, is how often its three words
  occur. The same step leads from three words to two and from two to one. Each step adds up
  before it exchanges, and is dealt by the hash of what it counts, so that a node that a third
  of all edges leave is spread over the tasks that hold these edges and arrives as one number
  from each of them. Phrases of ``MIN_COUNT`` occurrences travel along; all others end here.
* Unary paths. A node with one edge in and one out, both as frequent as the node itself, is inner
  to a path: it occurs within that longer phrase and nowhere else. It is compacted into its
  edges and is no candidate. ``paths`` joins such edges to whole passages.
* Scores. The parts of a frequent phrase are at least as frequent, so all counts that a score
  needs are among the phrases kept.

Words that are hot as parts of candidates are few: at most 1,000 of each length have a thousandth
of all occurrences. They are joined by broadcast, the others by exchange.

Defined results: null and empty texts have no words; a null language is ``und``; rows count as
often as they are given; without candidates the result is empty. Ids and other columns are not
read. Text is taken as UTF-8 bytes; only A-Z are lower-cased.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.llm.shared import settle, ship

LONGEST = 4
MIN_COUNT = 30
KEEP_PERCENT = 80  # a longer phrase with this share of the count takes a phrase's place
TOP = 2000
SCALE = 2_000_000
HEAVY = 1000  # a part with one in this many of all words is joined by broadcast
FLUSH_WORDS = 2_000_000  # words a task holds, as numbers, before it writes blocks
RANGE_BYTES = 8 << 20  # text whose edges are counted together, on average
LEAST_PARTS = 16

# One byte table: A-Z to lower case, the marks that end a piece to a byte that UTF-8 never has.
_END = b"\xff"
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 10
)
BLOCK = "part int, lang string, words binary, grams binary, m int, phrase string, f long"


def tokens(text: str) -> list[bytes]:
    """Words in order; ``_END`` stands between pieces."""
    return text.encode().translate(_BYTES).replace(_END, b" \xff ").split()


def _numbering() -> defaultdict[bytes, int]:
    """Gives every new word the next number, from 0 on."""
    return defaultdict(count().__next__)


def _numbers(known: defaultdict[bytes, int], words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


class _Numbered:
    """Texts of one language as word numbers, which start at 1; 0 stands between pieces."""

    def __init__(self):
        self.known = _numbering()
        self.known[_END]  # 0
        self.texts: list[np.ndarray] = []

    def add(self, text: str) -> int:
        words = tokens(text)
        words.append(_END)
        self.texts.append(_numbers(self.known, words))
        return len(words)

    def words(self) -> list[bytes]:
        return list(self.known)[1:]

    def edges(self) -> np.ndarray:
        """Four rows of word numbers, a column for every word; 0 is beyond its piece."""
        number = np.concatenate([*self.texts, np.zeros(LONGEST, np.int32)])
        starts = np.flatnonzero(number)
        edges = np.empty((LONGEST, len(starts)), np.int32)
        edges[0] = number[starts]
        for k in range(1, LONGEST):
            np.multiply(number[starts + k], edges[k - 1] > 0, out=edges[k])
        return edges


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(seed: int, of_word: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """One hash per column of word numbers, the same wherever the words have other numbers."""
    h = np.full(grams.shape[1], seed, np.uint64)
    for row in grams:
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + of_word[row])
    return h


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([1, *map(xxhash.xxh3_64_intdigest, words)], np.uint64)


def _summed(grams: np.ndarray, counts: np.ndarray, hashes: np.ndarray):
    """(grams, counts, hashes) of different grams, in order of their hashes, counts added up."""
    if not len(counts):
        return grams, counts, hashes
    order = np.argsort(hashes)
    in_order = hashes[order]
    again = np.flatnonzero(in_order[1:] == in_order[:-1])
    one, other = order[again], order[again + 1]
    new = np.ones(len(order), bool)
    if all((row[one] == row[other]).all() for row in grams):
        new[again + 1] = False
    else:  # two grams of one hash: put equal ones beside each other exactly
        order = np.lexsort([*grams, hashes])
        ordered = grams[:, order]
        new[1:] = (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    chosen = order[first]
    return grams[:, chosen], np.add.reduceat(counts[order], first), hashes[chosen]


def _blocks(lang: str, words: list[bytes], grams, counts, hashes, parts: int):
    """Rows of ``BLOCK``: grams in order of their hashes, cut into ranges of hashes, each with the
    words that it uses."""
    if not len(counts):
        return
    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    press = zstandard.ZstdCompressor(level=1).compress
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    place = np.zeros(len(words) + 1, np.int32)
    spelled = np.empty(len(words) + 1, object)
    spelled[1:] = words
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own = grams[:, a:b]
        if 8 * own.size > len(place):  # cheaper to mark the words than to sort them
            mark = np.zeros(len(place), bool)
            mark[own] = True
            used = np.flatnonzero(mark)
        else:
            used = np.unique(own)
        used = used[used > 0]
        place[used] = np.arange(1, len(used) + 1)
        width = np.dtype(np.uint16 if len(used) < 1 << 16 else np.uint32)
        many = counts[a:b]
        size = np.dtype(np.uint8 if many.max() < 256 else np.int64)
        data = bytes([size.itemsize]) + many.astype(size).tobytes() + place[own].astype(width).tobytes()
        yield (
            int(part[a]),
            lang,
            press(b" ".join(spelled[used].tolist())),
            press(data),
            len(own),
            None,
            None,
        )


def _read(rows: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, grams, counts) of blocks, with one numbering for all."""
    open_ = zstandard.ZstdDecompressor().decompress
    known = _numbering()
    known[b""]  # 0: beyond a piece; no word is empty
    grams, counts = [], []
    for packed_words, packed, m in zip(rows["words"], rows["grams"], rows["m"], strict=True):
        own, m = open_(packed_words).split(b" "), int(m)
        width = np.dtype(np.uint16 if len(own) < 1 << 16 else np.uint32)
        data = open_(packed)
        size = np.dtype(np.uint8 if data[0] == 1 else np.int64)
        n = (len(data) - 1) // (size.itemsize + m * width.itemsize)
        shared = np.zeros(len(own) + 1, np.int32)
        shared[1:] = _numbers(known, own)
        columns = np.frombuffer(data, width, m * n, 1 + size.itemsize * n)
        grams.append(shared[columns].reshape(m, n))
        counts.append(np.frombuffer(data, size, n, 1).astype(np.int64))
    return list(known)[1:], np.concatenate(grams, axis=1), np.concatenate(counts)


def _frame(rows) -> pd.DataFrame:
    return pd.DataFrame(list(rows), columns=[c.split()[0] for c in BLOCK.split(", ")])


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _counted_edges(texts: DataFrame, parts: int) -> DataFrame:
    def count_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, _Numbered] = {}
        size = 0

        def flush():
            rows = []
            for lang, numbered in held.items():
                words, grams = numbered.words(), numbered.edges()
                found = _hashes(_seed(lang), _word_hashes(words), grams)
                ones = np.ones(len(found), np.int64)
                rows += _blocks(lang, words, *_summed(grams, ones, found), parts)
            held.clear()
            return _frame(rows)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if lang not in held:
                    held[lang] = _Numbered()
                size += held[lang].add(text)
                if size >= FLUSH_WORDS:
                    yield flush()
                    size = 0
        yield flush()

    return texts.mapInPandas(count_edges, BLOCK)


def _flow(rows: DataFrame, m: int, parts: int, least: int) -> DataFrame:
    """One step of the flow: sums the grams of m words, keeps the frequent ones and hands on what
    leaves the first m - 1 words of each. The last step hands on the number of all words."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        part = group["part"].iat[0]
        blocks = group[group["phrase"].isna()]
        known_rows = group[group["phrase"].notna()]
        out = list(known_rows.itertuples(index=False, name=None))
        for lang, own in blocks.groupby("lang", sort=False):
            words, grams, counts = _read(own)
            of_word = _word_hashes(words)
            grams, counts, _ = _summed(grams, counts, _hashes(_seed(lang), of_word, grams))
            often = np.flatnonzero((grams[m - 1] > 0) & (counts >= least))
            for gram, f in zip(grams[:, often].T.tolist(), counts[often].tolist(), strict=True):
                phrase = b" ".join(words[k - 1] for k in gram).decode()
                out.append((int(part), lang, None, None, m, phrase, f))
            if m > 1:
                shorter = grams[: m - 1]
                found = _hashes(_seed(lang), of_word, shorter)
                out += _blocks(lang, words, *_summed(shorter, counts, found), parts)
            else:
                out.append((0, lang, None, None, 0, "", int(counts.sum())))
        return _frame(out)

    return rows.groupBy("part").applyInPandas(merge, BLOCK)


def counted(docs: DataFrame, text="text", lang="lang", least: int = MIN_COUNT) -> DataFrame:
    """lang, m, phrase, f: every phrase of one to four words (m) with f occurrences, at least
    ``least``; and for each language a row of m = 0 with the number of all words. Written to
    the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    parts = max(LEAST_PARTS, size // RANGE_BYTES)
    rows = _counted_edges(texts, parts)
    for m in range(LONGEST, 0, -1):
        rows = _flow(rows, m, parts, least)
    found = rows.groupBy("lang", "m", "phrase").agg(F.sum("f").alias("f"))
    return settle(found)


def _first(phrase: str, k: int) -> Column:
    """The first k words, or the last -k."""
    return F.substring_index(F.col(phrase), " ", k)


def _edge_rows(phrases: DataFrame) -> DataFrame:
    """lang, edge, f and the nodes it leads from and to."""
    return phrases.where(f"m = {LONGEST}").select(
        "lang",
        F.col("phrase").alias("edge"),
        "f",
        _first("phrase", LONGEST - 1).alias("tail"),
        _first("phrase", 1 - LONGEST).alias("head"),
    )


def inner_nodes(phrases: DataFrame) -> DataFrame:
    """(lang, node) that a unary path runs through: one edge brings all that comes in, and one
    takes all that goes out, each as often as the node occurs."""
    out = F.col("place") == 0
    flow = (
        _edge_rows(phrases)
        .select("lang", "f", F.posexplode(F.array("tail", "head")).alias("place", "phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max(F.when(out, F.col("f"))).alias("out"), F.max(F.when(~out, F.col("f"))).alias("in"))
    )
    nodes = phrases.where(f"m = {LONGEST - 1}").join(flow, ["lang", "phrase"])
    return nodes.where("`in` = f AND out = f").select("lang", F.col("phrase").alias("node"))


def paths(phrases: DataFrame) -> DataFrame:
    """lang, passage, n_words, f: edges joined over inner nodes to whole passages. Each edge points
    to one before it on its path, and pointers double their reach in each round, so there are as
    many rounds as the longest path has binary digits; each is written to the shared folder. A
    closed ring of inner nodes has no first edge and is no passage."""
    edges = _edge_rows(phrases)
    inner = inner_nodes(phrases)
    before = edges.select("lang", F.col("head").alias("tail"), F.col("edge").alias("before"))
    before = before.join(inner.withColumnRenamed("node", "tail"), ["lang", "tail"])
    state = settle(
        edges.join(before, ["lang", "tail"], "left").select(
            "lang",
            "edge",
            "f",
            F.coalesce("before", "edge").alias("at"),
            F.col("before").isNotNull().cast("long").alias("steps"),
        )
    )
    firsts = state.where("steps = 0").select("lang", F.col("edge").alias("at"))
    far, rounds = state.agg(F.sum("steps").alias("n"), F.count("*").alias("rows")).first(), 0
    n = far["n"]
    while n and rounds <= far["rows"].bit_length():
        further = state.select(
            "lang", F.col("edge").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more")
        )
        state = settle(
            state.join(further, ["lang", "at"]).select(
                "lang", "edge", "f", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps")
            )
        )
        now, rounds = state.agg(F.sum("steps").alias("n")).first()["n"], rounds + 1
        if now == n:
            break
        n = now
    words = F.sort_array(F.collect_list(F.struct("steps", _first("edge", -1).alias("word"))))
    rest = F.transform(F.slice(words, 2, F.size(words)), lambda w: w["word"])
    return (
        state.join(firsts, ["lang", "at"])
        .groupBy("lang", "at")
        .agg(F.concat_ws(" ", "at", rest).alias("passage"), F.count("*").alias("n"), F.min("f").alias("f"))
        .select("lang", "passage", (F.col("n") + LONGEST - 1).alias("n_words"), "f")
    )


def _with_count(cuts: DataFrame, part: str, count: str, phrases: DataFrame, heavy: DataFrame) -> DataFrame:
    """The cuts with the number of occurrences of one part. A part that many candidates share is
    looked up by broadcast; its rows then go anywhere, under a key that no phrase has."""
    few = heavy.select("lang", F.col("phrase").alias(part), F.col("f").alias("heavy_f"))
    rows = cuts.join(F.broadcast(few), ["lang", part], "left")
    key = F.when(F.col("heavy_f").isNull(), F.col(part)).otherwise(F.concat(F.lit(" "), "phrase"))
    others = phrases.select("lang", F.col("phrase").alias("key"), F.col("f").alias("other_f"))
    return (
        rows.withColumn("key", key)
        .join(others, ["lang", "key"], "left")
        .withColumn(count, F.coalesce("heavy_f", "other_f"))
        .drop("heavy_f", "other_f", "key")
    )


def scored(phrases: DataFrame) -> DataFrame:
    """Every candidate that no longer one takes the place of: lang, phrase, a, l, r, score."""
    counts = phrases.where(f"m BETWEEN 1 AND {LONGEST - 1}").select("lang", "phrase", "m", "f")
    words = phrases.where("m = 0").agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n")).first()["n"]
    # No more than HEAVY phrases of each length have that share of all words.
    heavy = counts.where(F.col("f") * HEAVY >= words)
    inner = inner_nodes(phrases).withColumnRenamed("node", "phrase")
    candidates = phrases.where("m >= 2").join(inner, ["lang", "phrase"], "left_anti")

    # All shorter phrases inside a candidate, with the greatest count of a longer one. Inner nodes
    # lie in edges of the same count, so nothing within them is missed.
    w = F.split("phrase", " ")
    inside = F.array_distinct(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("m") - 1),
                lambda k: F.transform(
                    F.sequence(F.lit(1), F.col("m") - k + 1), lambda i: F.array_join(F.slice(w, i, k), " ")
                ),
            )
        )
    )
    longer = (
        candidates.where("m > 2")
        .select("lang", "f", F.explode(inside).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    rest = (
        candidates.join(longer, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * KEEP_PERCENT))
        .select("lang", "phrase", "m", F.col("f").alias("a"))
    )
    cuts = rest.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(w, 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice(w, F.col("k") + 1, F.col("m")), " ").alias("right"),
    )
    cuts = _with_count(cuts, "left", "l", counts, heavy)
    cuts = _with_count(cuts, "right", "r", counts, heavy)
    score = F.expr(f"CAST(CAST(a AS DECIMAL(20, 0)) * {SCALE} DIV (l + r) AS BIGINT)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language by score and count descending, then phrase. Ranks are
    cut in every task before the exchange, so a language's rows never meet in one."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    n = phrases.where("m = 0").select("lang", F.col("f").alias("n"))
    return (
        scored(phrases)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .join(n, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


# Phrases of all four lengths from every place of every piece.
ORACLE_SQL = """
WITH docs AS (
  SELECT COALESCE(lang, 'und') AS lang,
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, SUM(len(w)) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (
  SELECT lang, w, i, unnest(range(1, 5)) AS m FROM places),
f AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, COUNT(*) AS f
  FROM grams WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING COUNT(*) >= 30),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
subs AS (
  SELECT lang, m, a, w, i, unnest(range(2, m)) AS k
  FROM (SELECT lang, m, a, w, unnest(range(1, m)) AS i FROM cand WHERE m > 2) AS starts),
longer AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, MAX(a) AS longer
  FROM subs WHERE i + k - 1 <= m GROUP BY ALL),
rest AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.w
  FROM cand c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase
  WHERE g.longer IS NULL OR 100 * g.longer < 80 * c.a),
cuts AS (
  SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM rest),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    (2000000 * CAST(c.a AS HUGEINT)) // (x.f + y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.m], ' ')),
lowest AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scores),
ranks AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE cut = 1)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranks r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
"""
