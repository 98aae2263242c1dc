"""Near-duplicates by MinHash bands and sequential Bayesian verification.

A text's set is its distinct runs of five words. Two texts are linked if the Jaccard similarity
of their sets is at least ``SIMILARITY``; classes are what links connect. Texts of equal words
are one node from the start, so copies are never compared.

1. ``HASHES`` minima per text. The first are cut into ``BANDS`` bands of ``ROWS``; texts that
   agree in a band share a bucket. A pair at the threshold shares none of them with a chance of
   5e-6. The signature is one byte of each minimum.
2. In every bucket, each text is compared with the one of the smallest id: as many pairs as
   rows. Signatures are compared in batches; after each batch, a pair is given up if the
   posterior chance that its similarity reaches the threshold (uniform prior, binomial
   agreement) is below ``MISS``. What survives is verified on the full sets.
3. Only texts of a bucket that are still in different classes can add a link that matters. They
   meet in blocks of bounded size, each pair in the bucket of its first common band, again by
   batches of signatures; survivors are verified on their full sets in the block, which hands on
   what joins its members and nothing more. No link is lost.

Defined results: null and empty texts and texts without words have an empty set and are linked
with nothing. Rows that repeat an id are one document, linked with whatever either is. A row
with a null id is linked with nothing, has no class and is kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketmill.llm.components import components
from marketmill.llm.shared import settle, ship

WORDS = 5
SIMILARITY = 0.75
PERCENT = 75
HASHES = 512
BANDS = 32
ROWS = 4
BATCH = 32
MISS = 1e-5
MEMBER_BYTES = 1024  # of a member of a block, besides its set
BLOCK_BYTES = 2 << 20
CHUNK_BYTES = 8 << 20
BROADCAST_IDS = 200_000

_RANDOM = np.random.default_rng(5)
_FACTORS = _RANDOM.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_PLACES = _RANDOM.integers(1, 1 << 62, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased: just what bytes do by themselves."""
    return (text or "").encode().lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; of all words if there are fewer."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, WORDS)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += _mixed(hashes[k : n - width + 1 + k] * _PLACES[k])
    return np.unique(_mixed(total))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(short), 512):
        part = short[None, k : k + 512] * _FACTORS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def signature(least: np.ndarray) -> bytes:
    """One byte of each minimum; bytes of different minima agree once in 256 times."""
    return (least >> np.uint32(8)).astype(np.uint8).tobytes()


def bands(least: np.ndarray) -> np.ndarray:
    """A number for each band of minima."""
    cut = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        total = _mixed(total * _PLACES[k] + cut[:, k])
    return total.view(np.int64)


def least_agreement(similarity: float, miss: float, total: int, batch: int) -> dict[int, int]:
    """After n values, the smallest agreement m that is not given up: with a uniform prior, the
    posterior of the similarity is Beta(m + 1, n - m + 1), and the chance that it reaches s is
    that of at most m successes in n + 1 trials of s."""
    limits = {}
    for n in range(batch, total + 1, batch):
        chance, m = 0.0, -1
        while chance < miss and m <= n:
            m += 1
            chance += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        limits[n] = m
    return limits


def surviving(left, x: np.ndarray, right, y: np.ndarray, limits: dict[int, int]) -> np.ndarray:
    """Pairs (row x of left, row y of right), by place, that are not given up after any batch of
    their signatures; each batch sees the pairs that are left."""
    alive = np.arange(len(x))
    agree = np.zeros(len(x), np.int32)
    at = 0
    for n, least in limits.items():
        agree[alive] += (left[x[alive], at:n] == right[y[alive], at:n]).sum(axis=1)
        alive = alive[agree[alive] >= least]
        at = n
    return alive


def _limits() -> dict[int, int]:
    return least_agreement(SIMILARITY + (1 - SIMILARITY) / 256, MISS, HASHES, BATCH)


def _matrix(signatures) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, HASHES)


def signed(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, n_shingles, and, null without words, the digest of the words, the
    signature and the numbers of the bands."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, digests, signatures, numbers = [], [], [], []
            for text in batch["text"]:
                words = words_of(text)
                hashes = shingles(words)
                least = minima(hashes)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                signatures.append(signature(least) if words else None)
                numbers.append(bands(least) if words else None)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_shingles": sizes,
                    "digest": digests,
                    "signature": signatures,
                    "bands": numbers,
                }
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(
        sign,
        "doc_id long, n_shingles long, digest binary, signature binary, bands array<long>",
    )


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, id, center) of all nodes in a bucket with others; the center has the least id."""
    rows = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("id").alias("center"), F.max("id").alias("last"))
    return rows.join(shared.where("center < last").drop("last"), "bucket")


def _not_given_up(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that outlast all batches of their signatures."""
    limits = _limits()
    of = lambda end: nodes.select(
        F.col("id").alias(end), F.col("signature").alias(f"of_{end}"), F.col("n_shingles").alias(f"n_{end}")
    )
    joined = pairs.join(of("b"), "b").join(of("a"), "a")
    # Sets of too different size cannot be similar enough.
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    joined = joined.where(least * 100 >= most * PERCENT)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = np.arange(len(batch))
            alive = surviving(_matrix(batch["of_a"]), each, _matrix(batch["of_b"]), each, limits)
            yield batch[["a", "b"]].iloc[alive]

    return joined.select("a", "b", "of_a", "of_b").mapInPandas(verify, "a long, b long")


def _sets(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, hashes): the full sets of some nodes, hashed again from their texts."""

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(words_of(t)).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "hashes": sets})

    wanted = settle(ids.distinct())
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)  # eight bytes each; beyond that, texts are exchanged by id
    rows = texts.join(wanted, "id").select("id", "text")
    return settle(rows.mapInPandas(sets_of, "id long, hashes array<long>"))


def _links(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough on their full sets."""
    pairs = settle(pairs)
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs)
    of = lambda end: sets.toDF(end, f"of_{end}")
    joined = pairs.join(of("b"), "b").join(of("a"), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - common
    return joined.where(common.cast("long") * 100 >= either.cast("long") * PERCENT).select("a", "b")


class _Groups:
    """Which members of a block are connected already."""

    def __init__(self, labels: np.ndarray):
        self._above: dict[int, int] = {}
        self._labels = labels.tolist()

    def top(self, member: int) -> int:
        k = self._labels[member]
        while k in self._above:
            k = self._above[k]
        return k

    def join(self, one: int, other: int) -> bool:
        """Whether the two were apart."""
        x, y = self.top(one), self.top(other)
        if x != y:
            self._above[max(x, y)] = min(x, y)
        return x != y


def _similar(one: np.ndarray, other: np.ndarray) -> bool:
    """By the full sets, which are sorted and distinct."""
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common * 100 >= (len(one) + len(other) - common) * PERCENT


def _across(members: DataFrame, nodes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between texts of one bucket that are in different classes. Pairs with the
    bucket's center are done already. The members outside the bucket's first class, in blocks,
    meet all of its members, in chunks; both have a bounded expected size in bytes, sets included,
    so that long texts meet in smaller numbers.

    A pair that shares several buckets is looked at in the one of its first common band only.
    Pairs that outlast the batches of their signatures are verified on their full sets at once,
    and a block hands on a link only if it joins what was apart: no more rows than members, however
    many pairs are alike, or nearly so."""
    size = F.lit(MEMBER_BYTES) + F.col("n_shingles") * 8
    labelled = (
        members.where("id <> center")
        .join(nodes.select("id", size.alias("bytes")), "id")
        .join(classes, "id", "left")
        .select("bucket", "id", "bytes", F.coalesce("component", "id").alias("class"))
    )
    open_ = (
        labelled.groupBy("bucket", "class")
        .agg(F.sum("bytes").alias("n"))
        .groupBy("bucket")
        .agg(
            F.min("class").alias("first"),
            F.sum("n").alias("n"),
            F.min_by("n", "class").alias("n_first"),
            F.count("*").alias("classes"),
        )
        .where("classes > 1")
        .select(
            "bucket",
            "first",
            F.ceil(F.col("n") / CHUNK_BYTES).cast("int").alias("chunks"),
            F.ceil((F.col("n") - F.col("n_first")) / BLOCK_BYTES).cast("int").alias("blocks"),
        )
    )
    rows = settle(labelled.drop("bytes").join(open_, "bucket"))
    sets = _sets(rows.select("id"), texts).join(nodes.select("id", "signature", "bands"), "id")
    slot = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outside = rows.where(F.col("class") != F.col("first"))
    left = outside.select(
        "bucket", "id", "class", slot("blocks", 1).alias("block"), each("chunks").alias("chunk"), F.lit(True).alias("left")
    )
    right = rows.select(
        "bucket", "id", "class", slot("chunks", 2).alias("chunk"), each("blocks").alias("block"), F.lit(False).alias("left")
    )
    placed = (
        left.unionByName(right)
        .join(sets, "id")
        .withColumn("group", F.xxhash64("bucket", "block", "chunk"))
        .drop("block", "chunk")
        .repartition("group")
        .sortWithinPartitions("group")
    )
    limits = _limits()

    def meet(part: pd.DataFrame) -> list[tuple[int, int]]:
        is_left = part["left"].to_numpy()
        ids, labels = part["id"].to_numpy(np.int64), part["class"].to_numpy(np.int64)
        signatures, hashes = _matrix(part["signature"]), part["hashes"].to_list()
        numbers, bucket = np.stack(part["bands"].to_list()), part["bucket"].to_numpy(np.int64)
        groups, links = _Groups(labels), []
        a, b = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        for k in range(0, len(a), 64):
            x, y = np.repeat(a[k : k + 64], len(b)), np.tile(b, len(a[k : k + 64]))
            apart = (labels[x] != labels[y]) & (bucket[x] == bucket[y])
            x, y = x[apart], y[apart]
            alive = surviving(signatures, x, signatures, y, limits)
            x, y = x[alive], y[alive]
            first = (numbers[x] == numbers[y]).argmax(axis=1)
            here = numbers[x, first] == bucket[x]
            for i, j in zip(x[here].tolist(), y[here].tolist(), strict=True):
                if groups.top(i) != groups.top(j) and _similar(hashes[i], hashes[j]):
                    groups.join(i, j)
                    links.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
        return links

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            part = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = part["group"].to_numpy()
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            found = [p for s, e in zip(starts[:-1], starts[1:]) for p in meet(part.iloc[s:e])]
            rest = part.iloc[starts[-1] :] if len(part) else part
            yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)
        if rest is not None and len(rest):
            yield pd.DataFrame(meet(rest), columns=["a", "b"], dtype=np.int64)

    return settle(placed.mapInPandas(compare, "a long, b long").distinct())


def _of_one_id(known: DataFrame, first: DataFrame) -> DataFrame:
    """Links (a, b) between the texts of ids that are given with different texts: such an id is
    one document, and links them."""
    nodes = known.select("doc_id", "digest").join(first, "digest").select("doc_id", "id")
    several = nodes.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("last"))
    pairs = nodes.join(several.where("b < last"), "doc_id").where("id > b")
    return settle(pairs.select(F.col("id").alias("a"), "b").distinct())


def classes(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Per row of the documents: doc_id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    rows = settle(signed(docs, key, text))
    known = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    first = settle(known.groupBy("digest").agg(F.min("doc_id").alias("id")))
    # Equal words, equal sets: the row of the smallest id stands for all.
    nodes = settle(
        known.withColumn("id", F.col("doc_id"))
        .join(first, ["digest", "id"])
        .select("id", "digest", "n_shingles", "signature", "bands")
        .dropDuplicates(["digest", "id"])
        .drop("digest")
    )
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    members = settle(_buckets(nodes))
    stars = members.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b"))
    links = _links(_not_given_up(stars.distinct(), nodes), texts)
    by_star = components(links)
    more = _across(members, nodes, by_star, texts).union(_of_one_id(known, first))
    found = components(by_star.toDF("a", "b").union(more)) if not more.isEmpty() else by_star
    of_digest = first.join(found, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    # A row without words, of an id that has words in another row, is that document.
    wordless = rows.where("digest IS NULL AND doc_id IS NOT NULL").select("doc_id").distinct()
    elsewhere = settle(
        known.select("doc_id", "digest")
        .join(wordless, "doc_id")
        .join(of_digest, "digest")
        .groupBy("doc_id")
        .agg(F.min("component").alias("elsewhere"))
    )
    of_row = rows.join(of_digest, "digest", "left")
    if not elsewhere.isEmpty():
        of_row = of_row.join(elsewhere, "doc_id", "left").withColumn(
            "component", F.coalesce("component", "elsewhere")
        )
    component = F.coalesce("component", "doc_id")
    return of_row.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns: one of each class, in one row. An id that
    is given in several rows stays in the row of the smallest text, null first, and of equal ones
    in any. Rows without an id are in no class, and all stay."""
    counted = classes(docs).groupBy(F.col("doc_id").alias("__id"))
    kept = settle(
        counted.agg(F.bool_and("kept").alias("kept"), F.count("*").alias("__rows"))
        .where("kept OR __id IS NULL")
        .select("__id", "__rows")
    )
    here = lambda rows: docs.join(rows, docs["doc_id"].eqNullSafe(F.col("__id")), "left_semi")
    once = here(kept.where("__rows = 1 OR __id IS NULL"))
    several = kept.where("__rows > 1 AND __id IS NOT NULL")
    if several.isEmpty():
        return once
    # Ranks are cut in every task before the exchange.
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    rest = here(several).withColumn("__rank", first).where("__rank = 1").drop("__rank")
    return once.unionByName(rest)
