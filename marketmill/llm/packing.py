"""Best-fit decreasing packing of token sequences, with a segment tree over open capacities.

Documents are tokenised in place, ended by token 0, and cut into pieces if they are longer than
a sequence. There are no more different lengths than a sequence has tokens, so the packing is
planned on the count of each length alone: the plan treats the pieces of one length as a run,
and every open sequence with the same room left as a run too. A segment tree over the possible
rooms (0 to the capacity) finds the tightest one that fits in logarithmic time. The plan is the
one that best-fit decreasing makes piece by piece, and its size depends on the capacity, not on
the documents. The pieces then look up their sequence and place by length and rank.

Ranks need no sort: a task counts each length as it goes, and one row per task and length tells
where the task's ranks start.

Defined results: null and empty texts are one token, the final 0. Rows that repeat an id are
packed each for itself. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketmill.llm.shared import settle

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
CACHE_WORDS = 400_000

_PIECES = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"
)


_STOPS = tuple(".,;:!?")


class _Uneven(Exception):
    """White space beside a space, or at an end: there the plain cut at spaces does not hold."""


class WordTokens(dict):
    """Token ids of texts as packed bytes, by the byte-level BPE of a ``tokenizers`` file, equal to
    those of its ``encode`` without special tokens added. A text with one of the file's own tokens
    in it, or with a character that the rule's classes here and there differ on, is encoded by the
    library as a whole. ``ids`` gives those of plain text, in which such a token is like any word.

    The vocabulary's rule cuts a text before a space that stands between two other characters,
    whatever is around, so such a space and the word after it have their ids to themselves.
    This maps words to the ids of space and word. Two generations of at most ``limit`` words are
    remembered; the older one is forgotten when the younger is full."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        self._split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        added = self.tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added]
        self._alike: set[str] = set()  # characters that both cut alike, of those seen
        self._unlike: set[str] = set()
        self._cut = regex.compile(public_tokenizers.PATTERN).findall
        self._limit = limit
        self._old: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        # The printable stand-ins of bytes in byte-level vocabularies: a byte that is no
        # printable Latin-1 character is a character from 256 on, in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self._stand_ins = {b: 256 + k for k, b in enumerate(hidden)}
        self._space = " ".translate(self._stand_ins)
        self._stops = {stop: self._bpe(stop) for stop in _STOPS}

    def __missing__(self, word: str) -> bytes:
        stop = self._stops.get(word[-1:])
        if stop is not None and (plain := word[:-1]).isalpha():
            return self[plain] + stop
        ids = self._old.get(word)
        if ids is None:
            if word.isalpha():
                ids = self._ascii(word) if word.isascii() else self._bpe(" " + word)
            elif not word or word[0].isspace() or word[-1].isspace():
                raise _Uneven
            else:
                ids = self._cut_ids(" " + word)
                if "\n" in word:  # two words and the line's end, hardly met again
                    return ids
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _ascii(self, word: str) -> bytes:
        """Of a space and ASCII letters, which stand for themselves."""
        return array("I", [t.id for t in self._model.tokenize(self._space + word)]).tobytes()

    def _bpe(self, piece: str) -> bytes:
        plain = piece.encode().decode("latin-1").translate(self._stand_ins)
        return array("I", [t.id for t in self._model.tokenize(plain)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Of a piece as the rule cuts them: a space and a word, or anything else."""
        if piece[0] == " " and piece[1:].isalpha():
            return self[piece[1:]]
        ids = self._pieces.get(piece)
        if ids is None:
            if len(self._pieces) >= self._limit // 4:
                self._pieces.clear()
            ids = self._pieces[piece] = self._bpe(piece)
        return ids

    def _cut_ids(self, text: str) -> bytes:
        return b"".join(map(self._piece, self._cut(text)))

    def _cut_alike(self, character: str) -> bool:
        """Whether rule and library put a character in the same class: letters, numbers, white
        space and the rest stick to different neighbours."""
        for probe in (f"a{character}a", f"1{character}1", f".{character}.", f"a {character} a"):
            # The library's pieces have places, the rule's ones are the whole text.
            if self._cut(probe) != [probe[i:j] for _, (i, j) in self._split(probe)]:
                return False
        return True

    def _by_library(self, text: str) -> bool:
        if any(token in text for token in self._added):
            return True
        if text.isascii():
            return False
        seen = set(text)
        for character in seen - self._alike - self._unlike:
            (self._alike if self._cut_alike(character) else self._unlike).add(character)
        return not self._unlike.isdisjoint(seen)

    def encoded(self, text: str) -> bytes:
        """The ids that the library's ``encode`` gives without adding special tokens."""
        if self._by_library(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return self.ids(text)

    def ids(self, text: str) -> bytes:
        """The ids as unsigned 32-bit numbers, little-endian on the machines in use."""
        words = text.split(" ")
        if not words[0] or words[0][0].isspace() or words[0][-1].isspace():
            return self._cut_ids(text)
        try:
            rest = b"".join(map(self.__getitem__, words[1:]))
        except _Uneven:
            return self._cut_ids(text)
        return self._cut_ids(words[0]) + rest


_tokens: dict[tuple[str, int], WordTokens] = {}


def _word_tokens(path: str, limit: int) -> WordTokens:
    """One per worker and vocabulary: a worker serves many tasks."""
    if (path, limit) not in _tokens:
        _tokens[path, limit] = WordTokens(path, limit)
    return _tokens[path, limit]


def pieces(
    docs: DataFrame,
    key="doc_id",
    text="text",
    capacity=CAPACITY,
    tokenizer=TOKENIZER,
    remembered: int = CACHE_WORDS,
):
    """A row per piece: doc_id, piece, start, length, ids_crc32, and its task and rank among the
    task's pieces of this length. A worker keeps the ids of two generations of ``remembered``
    words, about 200 bytes each; fewer cost time, never a result."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        words = _word_tokens(public_tokenizers.path(tokenizer), remembered)
        end = np.zeros(1, dtype="<u4").tobytes()
        part = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = words.encoded(text or "") + end
                total = len(ids) // 4
                first = (total - 1) % capacity + 1  # the first piece takes the remainder
                start = 0
                for piece, stop in enumerate(range(first, total + 1, capacity)):
                    n = stop - start
                    crc = zlib.crc32(ids[4 * start : 4 * stop])
                    rows.append((doc_id, piece, start, n, crc, part, ranks[n]))
                    ranks[n] += 1
                    start = stop
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, _PIECES)


class Rooms:
    """Segment tree over rooms 0 to capacity: how many open runs have each, and the smallest
    room of at least n that some run has."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._any = [False] * (2 * self._leaves)
        self._runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        self._runs[room].append((first, count))
        k = room + self._leaves
        while k and not self._any[k]:
            self._any[k] = True
            k //= 2

    def take(self, room: int) -> tuple[int, int]:
        run = self._runs[room].pop()
        k = room + self._leaves
        self._any[k] = bool(self._runs[room])
        while k > 1 and not self._any[k]:
            k //= 2
            self._any[k] = self._any[2 * k] or self._any[2 * k + 1]
        return run

    def tightest(self, n: int) -> int | None:
        k = n + self._leaves
        if self._any[k]:
            return n
        while k > 1:
            if k % 2 == 0 and self._any[k + 1]:
                k += 1
                while k < self._leaves:
                    k = 2 * k if self._any[2 * k] else 2 * k + 1
                return k - self._leaves
            k //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over {length: pieces}: runs (length, first rank, pieces in each
    sequence, first sequence, offset). Equal pieces go on filling a sequence they have begun, as
    no other open one is tighter."""
    rooms, runs, opened = Rooms(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                each = capacity // length
                first, have, room = opened, -(-left // each), capacity
                opened += have
            else:
                first, have = rooms.take(room)
                each = room // length
            used = min(have, -(-left // each))
            runs.append((length, rank, each, first, capacity - room))
            placed = min(left, used * each)
            full, rest = divmod(placed, each)
            rooms.add(room - each * length, first, full)
            if rest:
                rooms.add(room - rest * length, first + full, 1)
            rooms.add(room if room < capacity else 0, first + used, have - used)
            rank += placed
            left -= placed
    return runs


def packed(
    docs: DataFrame,
    key="doc_id",
    text="text",
    capacity=CAPACITY,
    tokenizer=TOKENIZER,
    remembered: int = CACHE_WORDS,
):
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = settle(pieces(docs, key, text, capacity, tokenizer, remembered))
    counted = settle(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    before = (
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counted.select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
    )
    # At most ``capacity`` rows.
    totals = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = np.array(plan({r["length"]: r["n"] for r in totals}, capacity), dtype=np.int64)
    runs = runs.reshape(-1, 5)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]
    most = int(max((r["n"] for r in totals), default=0)) + 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = runs[:, 0] * most + runs[:, 1]
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            rank = batch.pop("rank").to_numpy(np.int64)
            at = runs[np.searchsorted(keys, length * most + rank, side="right") - 1]
            slot = rank - at[:, 1]
            batch["sequence_id"] = at[:, 3] + slot // at[:, 2]
            batch["offset"] = at[:, 4] + slot % at[:, 2] * length
            yield batch

    joined = cut.join(
        starts, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part"))
    )
    ranked = joined.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("rank") + F.col("first")).alias("rank"),
    )
    return ranked.mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
