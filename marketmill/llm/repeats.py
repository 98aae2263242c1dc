"""Repeated passages by prefix-free parsing into phrases around rolling-hash triggers.

A passage is removed where 50 bytes in a row also start in a document with a smaller id. Such
strings are never listed one by one:

* Parse. A rolling hash over ``GRAM`` bytes; in every 50-byte string, the place of its smallest
  hash is a trigger. Equal strings have equal triggers, wherever they stand. A trigger's phrase
  is the trigger with all bytes that a 50-byte string around it can reach, so that every string
  lies whole in the phrase of its trigger. No phrase of full length is a prefix of another.
* Texts are dealt to groups, each a range of ids, so that a smaller group has smaller ids. What a
  group's own texts share is settled in it; the groups exchange hashes alone, each once per group,
  in order and as compressed differences. The answer is a bit per hash, in the same order.
* Triggers that only one document has are dropped.
* Dictionary. Equal phrases are one entry, with the smallest group and, in it, the smallest id that
  has it. Every string of a phrase repeats where the phrase does: documents with a larger id need
  no look inside.
* Order within the dictionary. Only a trigger with several phrases can have strings that repeat
  across different phrases, and only phrases that agree on one side of it. Their suffixes, cut at
  50 bytes, are brought together by hash. Equal suffixes need only be told apart from others, not
  sorted, so the exchange by hash takes the place of the suffix array's order.
* The spans that the two steps find are laid over the text, and the rest is what is kept.

Texts are exchanged once, compressed and by group, and read four times from that exchange. An id
with more text than a group takes has a range of its own, its rows dealt to several groups.

Defined results: null text is empty. Texts under 50 bytes lose nothing. Rows with equal id are
each judged against smaller ids only, never against one another. A null id counts as larger than
every other. Hashes of strings have 64 bits. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import settle

WIDTH = 50
GRAM = 24
REACH = WIDTH - GRAM  # bytes a string can hold before or after its trigger
SIDE = REACH // 2  # every string holds as many on one side of its trigger, at least
TRIGGER_BYTES = 14  # from a trigger to the next, on average
GROUP_BYTES = 1 << 23  # of the texts that a task reads as one
PART_ROWS = 1 << 22  # triggers that a task brings together
_NO_ID = (1 << 63) - 1

_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TRIGGER_SHIFT = np.uint64(24)  # triggers keep 40 bits: a chance meeting only costs a look


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Polynomial hashes, modulo 2^64, of any substring of a text."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: bytes):
        n = len(data)
        if len(Hashes._powers) <= n:
            size = max(1 << 16, 1 << (n + 1).bit_length())
            steps = lambda base: np.cumprod(np.r_[np.uint64(1), np.full(size, base)])
            Hashes._powers, Hashes._inverses = steps(_BASE), steps(_INVERSE)
        values = _TABLE[np.frombuffer(data, np.uint8)] * Hashes._powers[:n]
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[ends] - self._sums[starts]) * Hashes._inverses[starts])

    def runs(self, width: int) -> np.ndarray:
        """Of every substring of this length."""
        n = len(self._sums) - width
        return _mixed((self._sums[width:] - self._sums[:n]) * Hashes._inverses[:n])


def triggers(hashes: Hashes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, 40-bit hashes) of the triggers of a text of n bytes, n at least ``WIDTH``."""
    grams = hashes.runs(GRAM)
    span = REACH + 1  # grams in a string
    least, covered = grams, 1
    while covered < span:  # smallest of ever longer runs of grams
        step = min(covered, span - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    # A gram is a trigger if it is the smallest of some string that holds it.
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    most, covered = padded, 1
    while covered < span:
        step = min(covered, span - covered)
        most = np.maximum(most[:-step], most[step:])
        covered += step
    places = np.flatnonzero(grams == most)
    return places, (grams[places] >> _TRIGGER_SHIFT).view(np.int64)


def phrases(hashes: Hashes, places: np.ndarray, n: int):
    """(starts, ends, 64-bit hashes) of the triggers' phrases. A text's ends cut some short; how
    much is part of the hash, so that the strings of equal phrases are the same."""
    starts, ends = np.maximum(places - REACH, 0), np.minimum(places + WIDTH, n)
    cut = (starts - places).astype(np.uint64) * np.uint64(1 << 20) + (ends - places).astype(np.uint64)
    return starts, ends, _mixed(hashes.of(starts, ends) ^ _mixed(cut)).view(np.int64)


def sides(hashes: Hashes, places: np.ndarray, phrase: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the bytes just before and just after each trigger, 32 bits each in one number.
    Where a text's end cuts a side short, no string holds that side: it gets the phrase's own."""
    own = phrase.view(np.uint64)

    def side(starts, ends, whole):
        found = own.copy()
        found[whole] = hashes.of(starts[whole], ends[whole])
        return found >> np.uint64(32)

    before = side(places - SIDE, places, places >= SIDE)
    after = side(places + GRAM, places + GRAM + SIDE, places + GRAM + SIDE <= n)
    return ((before << np.uint64(32)) | after).view(np.int64)


def _parsed(frame: pd.DataFrame, beside: bool = False) -> list[tuple]:
    """(doc_id, bytes, places, triggers, phrases, and sides if asked for) of each text of a group."""
    open_, none, found = zstandard.ZstdDecompressor().decompress, np.empty(0, np.int64), []
    for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
        data = open_(text)
        if len(data) < WIDTH:
            found.append((doc_id, data, none, none, none, none))
            continue
        hashes = Hashes(data)
        places, own = triggers(hashes, len(data))
        _, _, phrase = phrases(hashes, places, len(data))
        side = sides(hashes, places, phrase, len(data)) if beside else none
        found.append((doc_id, data, places, own, phrase, side))
    return found


def _each(rows: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *rows])


def _with_ids(ids: list[int], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return _each(rows), np.repeat(np.asarray(ids, np.int64), [len(r) for r in rows])


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Of rows in order, which differ from the one before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _parts(values: np.ndarray, parts: int) -> np.ndarray:
    return (values.view(np.uint64) % np.uint64(parts)).astype(np.int16 if parts < 1 << 15 else np.int64)


def _coded(values: np.ndarray) -> bytes:
    """Numbers in order, as differences, byte by byte, compressed."""
    steps = np.diff(values.view(np.uint64), prepend=np.uint64(0))
    return _plain(steps)


def _plain(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _opened(block: bytes, kind=np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _decoded(block: bytes) -> np.ndarray:
    return np.cumsum(_opened(block), dtype=np.uint64)


def _said(replies: pd.DataFrame, step: str, n: int) -> np.ndarray:
    """The bits that came back for the n rows a group sent: they were sent by part, in order."""
    own = replies[replies["step"] == step].sort_values("part")
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=k) for b, k in zip(own["bits"], own["n"], strict=True)]
    return np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool)[:n]


class _Distinct:
    """Distinct values of a group's rows, in order: the smallest and largest id of each, one of its
    rows, and of each row which value it has."""

    def __init__(self, values: np.ndarray, ids: np.ndarray):
        order = np.argsort(values)
        values, ids = values[order], ids[order]
        new = _firsts(values)
        at = np.flatnonzero(new)
        self.values, self.row = values[at], order[at]
        self.least = np.minimum.reduceat(ids, at) if len(at) else ids
        self.most = np.maximum.reduceat(ids, at) if len(at) else ids
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1

    def send(self, keys: np.ndarray, parts: int) -> np.ndarray:
        """Sets the order in which the values are sent: by part of their keys, then by key."""
        if keys is not self.values:
            by_key = np.argsort(keys, kind="stable")
        else:
            by_key = np.arange(len(keys))
        self.order = by_key[np.argsort(_parts(keys[by_key], parts), kind="stable")]
        return keys[self.order]

    def told(self, bits: np.ndarray) -> np.ndarray:
        """The bits in the order of the values."""
        found = np.empty(len(bits), bool)
        found[self.order] = bits
        return found


class _Group:
    """The texts of a group with what its replies say so far. Whatever a step sends is in an order
    that the next step finds again: by part, then by hash."""

    def __init__(self, frame: pd.DataFrame, parts: int, beside: bool = False):
        self.parts, self.docs = parts, _parsed(frame, beside)
        self._ids = [d[0] for d in self.docs]
        own, ids = _with_ids(self._ids, [d[3] for d in self.docs])
        self._own, self._row_ids = own, ids
        self._found = _Distinct(own, ids)
        self.triggers = self._found.send(self._found.values, parts)

    def see_triggers(self, replies: pd.DataFrame) -> None:
        """Finds the dictionary entries: phrases of triggers of two documents or more."""
        found = self._found
        several = found.told(_said(replies, "triggers", len(found.values)))
        shared = (several | (found.least < found.most))[found.of]
        self._ends = np.cumsum([0] + [len(d[3]) for d in self.docs])
        self._ends = np.r_[0, np.cumsum(shared)][self._ends]
        self._own, self._row_ids = self._own[shared], self._row_ids[shared]
        self._places = np.concatenate([np.empty(0, np.int64), *[d[2] for d in self.docs]])[shared]
        self._phrase = _Distinct(_each([d[4] for d in self.docs])[shared], self._row_ids)
        self.own = self._phrase.send(self._own[self._phrase.row], self.parts)
        self.phrase = self._phrase.values[self._phrase.order]
        if any(len(d[5]) for d in self.docs):
            self.sides = _each([d[5] for d in self.docs])[shared][self._phrase.row][self._phrase.order]

    def see_phrases(self, replies: pd.DataFrame) -> None:
        """Finds the strings to look into, of each text: those of phrases it is the first to have,
        and which are like another phrase of their trigger on one side."""
        found, n = self._phrase, len(self._phrase.values)
        earlier = found.told(_said(replies, "earlier", n))[found.of]
        alike = found.told(_said(replies, "alike", n))[found.of]
        whole = earlier | (found.least[found.of] < self._row_ids)
        inside = alike & ~whole
        self.whole, self.at, strings = [], [], []
        for (_, data, *_), a, b in zip(self.docs, self._ends, self._ends[1:]):
            self.whole.append(self._places[a:b][whole[a:b]])
            places = self._places[a:b][inside[a:b]]
            starts = own = np.empty(0, np.int64)
            if len(places):
                starts = _inside(places, len(data))
                own = _strings(Hashes(data), starts)
            self.at.append(starts)
            strings.append(own)
        values, self._string_ids = _with_ids(self._ids, strings)
        self._string = _Distinct(values, self._string_ids)
        self.string = self._string.send(self._string.values, self.parts)

    def cut(self, replies: pd.DataFrame) -> pd.DataFrame:
        """(doc_id, n_bytes, starts, ends, kept) by the spans to remove."""
        found = self._string
        earlier = found.told(_said(replies, "strings", len(found.values)))[found.of]
        again = earlier | (found.least[found.of] < self._string_ids)
        rows, a = [], 0
        for (doc_id, data, *_), whole, at in zip(self.docs, self.whole, self.at):
            n, starts, ends, kept = len(data), [], [], data
            at, a = at[again[a : a + len(at)]], a + len(at)
            if len(whole) or len(at):
                mark = np.bincount(np.r_[np.maximum(whole - REACH, 0), at], minlength=n + 1)
                mark -= np.bincount(np.r_[np.minimum(whole + WIDTH, n), at + WIDTH], minlength=n + 1)
                gone = np.cumsum(mark)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                starts, ends = edges[::2].tolist(), edges[1::2].tolist()
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((doc_id, n, starts, ends, kept))
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "starts", "ends", "kept"])


def _inside(places: np.ndarray, n: int) -> np.ndarray:
    """Starts of the strings that lie in the phrases of triggers at these places."""
    mark = np.bincount(np.maximum(places - REACH, 0), minlength=n + 1)
    mark -= np.bincount(np.minimum(places + WIDTH, n) - WIDTH + 1, minlength=n + 1)
    return np.flatnonzero(np.cumsum(mark)[:-1] > 0)


def _strings(hashes: Hashes, starts: np.ndarray) -> np.ndarray:
    return hashes.of(starts, starts + WIDTH).view(np.int64)


def _blocks(group: int, parts: int, keys: np.ndarray, *more: np.ndarray) -> pd.DataFrame:
    """A row per part of a group's rows, which are in order by part and key."""
    part = _parts(keys, parts)
    at = np.flatnonzero(_firsts(part))
    rows = []
    for a, b in zip(at, [*at[1:], len(keys)]):
        codes = [_coded(keys[a:b]), *[_plain(np.ascontiguousarray(m[a:b])) for m in more]]
        rows.append((group, int(part[a]), b - a, *codes))
    return pd.DataFrame(rows, columns=["group", "part", "n", "keys", "phrases", "sides"][: 4 + len(more)])


_KEYS = "group long, part long, n long, keys binary"
_REPLY = "group long, part long, step string, n long, bits binary"


def _replied(blocks: pd.DataFrame, **steps: np.ndarray) -> pd.DataFrame:
    rows, at = [], 0
    for group, part, n in zip(blocks["group"], blocks["part"], blocks["n"], strict=True):
        for step, said in steps.items():
            rows.append((group, part, step, n, np.packbits(said[at : at + n]).tobytes()))
        at += n
    return pd.DataFrame(rows, columns=["group", "part", "step", "n", "bits"])


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs, and each row's run."""
    return np.flatnonzero(new), np.cumsum(new) - 1


def _in_two(blocks: pd.DataFrame) -> pd.DataFrame:
    """Which triggers are in more than one group."""
    keys = np.concatenate([_decoded(b) for b in blocks["keys"]])
    order = np.argsort(keys, kind="stable")
    at, run = _runs(_firsts(keys[order]))
    said = np.empty(len(keys), bool)
    said[order] = (np.diff(np.r_[at, len(keys)]) > 1)[run]
    return _replied(blocks, triggers=said)


def _earlier(ranks: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order by keys and rank, which begin a new key, and which (unordered) have a key that
    a smaller rank has."""
    order = np.lexsort((ranks, *reversed(keys)))
    new = _firsts(*[k[order] for k in keys])
    at, run = _runs(new)
    said = np.empty(len(ranks), bool)
    said[order] = ranks[order] > ranks[order][at][run]
    return order, new, said


def _dictionary(blocks: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Of each phrase, whether an earlier group has it, and whether another phrase of the trigger
    has the same bytes on one side of it. Without that they share no string."""
    own = np.concatenate([_decoded(b) for b in blocks["keys"]])
    phrase = np.concatenate([_opened(b, np.int64) for b in blocks["phrases"]])
    beside = np.concatenate([_opened(b, np.uint32) for b in blocks["sides"]])
    ranks = np.repeat(blocks["group"].to_numpy(np.int64) % ranges, blocks["n"])
    order, new, said = _earlier(ranks, [own, phrase])
    _, run = _runs(new)
    own, beside = own[order][new], beside[order][new]
    alike = np.zeros(len(own), bool)
    for side in (beside >> np.uint32(16), beside & np.uint32(0xFFFF)):
        again = np.lexsort((side, own))
        at, of = _runs(_firsts(own[again], side[again]))
        alike[again] |= (np.diff(np.r_[at, len(own)]) > 1)[of]
    of_row = np.empty(len(said), bool)
    of_row[order] = alike[run]
    return _replied(blocks, earlier=said, alike=of_row)


def _first_strings(blocks: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Which strings an earlier group has."""
    keys = np.concatenate([_decoded(b) for b in blocks["keys"]])
    ranks = np.repeat(blocks["group"].to_numpy(np.int64) % ranges, blocks["n"])
    return _replied(blocks, strings=_earlier(ranks, [keys])[2])


def _group_of(doc_ids: np.ndarray, texts: list[bytes], cuts: np.ndarray, heavy: dict[int, int]):
    """Group of each row: its rank among the ranges of ids, and rows of a heavy id, which has a
    range of its own, dealt by their text."""
    ranks = np.searchsorted(cuts, doc_ids, side="right")
    deal = [zlib.crc32(t) % heavy[i] if i in heavy else 0 for i, t in zip(doc_ids.tolist(), texts)]
    return ranks + np.asarray(deal, np.int64) * (len(cuts) + 1)


def _ranges(texts: DataFrame, group_bytes: int) -> tuple[np.ndarray, dict[int, int], int]:
    """Starts of ranges of ids with about ``group_bytes`` of text each; the ids that have half of
    that or more, with the number of groups their rows are dealt to; bytes of all texts. The
    driver gets a row per range and heavy id."""
    sizes = settle(texts.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes")))
    total = sizes.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    starts = (
        sizes.repartitionByRange(1 + total // group_bytes, "doc_id")
        .groupBy(F.spark_partition_id())
        .agg(F.min("doc_id").alias("least"))
        .collect()
    )
    heavy = {r["doc_id"]: 1 + r["bytes"] // group_bytes for r in sizes.where(F.col("bytes") * 2 > group_bytes).collect()}
    cuts = {r["least"] for r in starts} | set(heavy) | {i + 1 for i in heavy if i < _NO_ID}
    return np.array(sorted(cuts), np.int64), heavy, total


def cut(
    docs: DataFrame, key="doc_id", text="text", group_bytes=GROUP_BYTES, part_rows=PART_ROWS
) -> DataFrame:
    """Per document: doc_id, n_bytes, starts and ends of the removed spans, and the kept bytes."""
    texts = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    cuts, heavy, total = _ranges(texts, group_bytes)
    ranges = len(cuts) + 1
    parts = max(16, total // (TRIGGER_BYTES * part_rows))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=4).compress
        for batch in batches:
            plain = [t.encode() for t in batch["text"]]
            group = _group_of(batch["doc_id"].to_numpy(np.int64), plain, cuts, heavy)
            yield pd.DataFrame({"group": group, "doc_id": batch["doc_id"], "text": list(map(press, plain))})

    packed = texts.mapInPandas(pack, "group long, doc_id long, text binary").repartition("group")

    def send_triggers(key, frame):
        return _blocks(key[0], parts, _Group(frame, parts).triggers)

    def send_phrases(key, frame, replies):
        group = _Group(frame, parts, beside=True)
        group.see_triggers(replies)
        if not len(group.own):
            return pd.DataFrame(columns=["group", "part", "n", "keys", "phrases", "sides"])
        sides = group.sides.view(np.uint64)
        halves = ((sides >> np.uint64(48)) << np.uint64(16)) | ((sides >> np.uint64(16)) & np.uint64(0xFFFF))
        return _blocks(key[0], parts, group.own, group.phrase, halves.astype(np.uint32))

    def send_strings(key, frame, replies):
        group = _Group(frame, parts)
        group.see_triggers(replies)
        group.see_phrases(replies)
        return _blocks(key[0], parts, group.string)

    def cut_texts(frame, replies):
        group = _Group(frame, parts)
        group.see_triggers(replies)
        group.see_phrases(replies)
        return group.cut(replies)

    def replied(sent: DataFrame, answer) -> DataFrame:
        return sent.groupBy("part").applyInPandas(answer, _REPLY).repartition("group")

    def told(replies: DataFrame, function, columns: str) -> DataFrame:
        both = packed.groupBy("group").cogroup(replies.groupBy("group"))
        return both.applyInPandas(function, columns)

    sent = packed.groupBy("group").applyInPandas(send_triggers, _KEYS)
    replies = replied(sent, _in_two)
    sent = told(replies, send_phrases, f"{_KEYS}, phrases binary, sides binary")
    replies = replies.union(replied(sent, lambda blocks: _dictionary(blocks, ranges)))
    sent = told(replies, send_strings, _KEYS)
    replies = replies.union(replied(sent, lambda blocks: _first_strings(blocks, ranges)))
    rows = told(
        replies, cut_texts, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    )
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


def digest(rows: DataFrame) -> DataFrame:
    removed = F.aggregate(
        F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, n: a + n
    )
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# Every 50-byte string of every text by its hexadecimal form, with the smallest id that has it.
ORACLE_SQL = """
WITH texts AS (
  SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h, octet_length(encode(COALESCE(text, ''))) AS n_bytes
  FROM documents),
strings AS (
  SELECT doc_id, k, md5(substr(h, CAST(2 * k + 1 AS BIGINT), 100)) AS s
  FROM texts, LATERAL (SELECT unnest(range(0, n_bytes - 49)) AS k) WHERE n_bytes >= 50),
earliest AS (SELECT s, MIN(doc_id) AS first FROM strings GROUP BY s),
hit AS (SELECT doc_id, k FROM strings JOIN earliest USING (s) WHERE first < doc_id),
ordered AS (
  SELECT doc_id, k, LAG(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM hit),
runs AS (
  SELECT doc_id, k, SUM(CASE WHEN before IS NULL OR k > before + 50 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY k) AS run FROM ordered),
spans AS (
  SELECT doc_id, run, MIN(k) AS a, MAX(k) + 50 AS b,
    LEAD(MIN(k)) OVER (PARTITION BY doc_id ORDER BY run) AS next_a FROM runs GROUP BY doc_id, run),
kept AS (
  SELECT t.doc_id, t.n_bytes, COALESCE(SUM(b - a), 0) AS n_removed, COUNT(a) AS n_spans,
    CASE WHEN COUNT(a) = 0 THEN any_value(h) ELSE
      substr(any_value(h), 1, CAST(2 * MIN(a) AS BIGINT)) || string_agg(
        substr(h, CAST(2 * b + 1 AS BIGINT), CAST(2 * (COALESCE(next_a, n_bytes) - b) AS BIGINT)), '' ORDER BY a) END AS rest
  FROM texts t LEFT JOIN spans s ON t.doc_id = s.doc_id GROUP BY t.doc_id, t.n_bytes)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed,
  CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept
"""
