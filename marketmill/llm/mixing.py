"""Mix sources to target weights by hash thresholds, without sorting a document.

Every document gets a fixed 48-bit number from its id. A source that is to give a part of its
words gives the documents below a threshold, found by nested histograms: words by source and
the top 12 bits, the bucket in which the budget ends, the same again within that bucket only,
and once more. A target above the source's size adds whole copies of every document first.

Defined results: a null text has size 0; a null source is a source of its own, last in order;
rows that repeat an id are taken or left together; an empty table gives an empty mix; a null
id hashes like the empty text. Other columns are neither read nor harmed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.llm.shared import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
LEVEL_BITS = 12
LEVELS = 3
HASH_BITS = 48
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_number(key: Column) -> Column:
    """48 bits of the id's MD5 as a number from 0."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: (source, source_size) to (source, source_size, target).

    Sources by code point, null last, weigh ``weights`` in turn. A source's share is its weight
    times a common level; filling the sources in the order in which they reach their caps gives
    the level at which the rest shares what the capped ones leave. The windows run over one row
    per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    rows = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * max_repeats
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    sharing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = (
        rows.withColumn("level", left.cast("double") / sharing)
        .withColumn("place", F.row_number().over(order))
        .withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    )
    first_open = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(everything)["level"]
    rows = rows.withColumn("common", first_open)
    share = F.when(
        F.col("open"), F.least(F.col("common") * F.col("weight"), F.col("cap").cast("double"))
    ).otherwise(F.col("cap").cast("double"))
    return rows.select("source", "source_size", share.alias("target"))


def _boundary(histogram: DataFrame) -> DataFrame:
    """From (source, wanted, bucket, words): per source the bucket in which the budget ends,
    with what the buckets below it hold. A source has at most 4,096 buckets here. A source whose
    budget holds all its words has no row."""
    running = (
        Window.partitionBy("source")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        histogram.withColumn("upto", F.sum("words").over(running))
        .where(F.col("upto") > F.col("wanted"))
        .groupBy("source")
        .agg(F.min(F.struct("bucket", "words", "upto", "wanted")).alias("at"))
        .select(
            "source",
            F.col("at.bucket").alias("bucket"),
            F.col("at.words").alias("words"),
            (F.col("at.wanted") - (F.col("at.upto") - F.col("at.words"))).alias("wanted"),
        )
    )


def thresholds(rows: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, size, number) rows to one row per source: source_size, target, ``repeats`` whole
    copies of every document and ``below``: documents with a smaller number give one more."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, max_repeats).withColumn(
        "repeats",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
    )
    goals = settle(
        goals.withColumn("wanted", F.col("target") - F.col("repeats") * F.col("source_size"))
    )
    inside = rows.select(F.col("source").alias("of"), "size", "number")
    part = goals.select("source", "wanted").withColumn("prefix", F.lit(0).cast("long"))
    shift = HASH_BITS
    for _ in range(LEVELS):
        same_prefix = F.col("of").eqNullSafe(F.col("source")) & (
            F.shiftright("number", shift) == F.col("prefix")
        )
        shift -= LEVEL_BITS
        histogram = (
            inside.join(part, same_prefix)
            .groupBy("source", "wanted", F.shiftright("number", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        part = settle(_boundary(histogram)).withColumnRenamed("bucket", "prefix")
    # The last bucket is taken if that ends nearer to the budget than leaving it.
    edge = part.select(
        F.col("source").alias("of"),
        F.shiftleft(
            F.when(F.col("words") - F.col("wanted") < F.col("wanted"), F.col("prefix") + 1).otherwise(
                F.col("prefix")
            ),
            shift,
        ).alias("edge"),
    )
    # No boundary: the budget holds every word, and all documents are below the threshold, or
    # the source has no words at all.
    return goals.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source",
        "source_size",
        "target",
        F.col("repeats").cast("int").alias("repeats"),
        F.coalesce("edge", F.lit(1 << HASH_BITS)).alias("below"),
    )


def beside(edges: DataFrame) -> DataFrame:
    """The thresholds ready to be joined with documents: broadcast while there are few sources,
    so that a source with a third of the documents stays where it is."""
    edges = settle(edges)
    return F.broadcast(edges) if edges.count() <= BROADCAST_SOURCES else edges


def copies(number: Column, edge: str = "", max_repeats: int = MAX_REPEATS) -> Column:
    """How often a document of a row joined with its source's threshold is taken."""
    more = (number < F.col(f"{edge}below")).cast("int")
    return F.least(F.col(f"{edge}repeats") + more, F.lit(max_repeats))


def measured(docs: DataFrame, key="doc_id", source="source", text="text") -> DataFrame:
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        hash_number(F.col(key)).alias("number"),
    )


def mixed(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows = settle(measured(docs))
    edges = beside(thresholds(rows, weights, max_repeats).withColumnRenamed("source", "of"))
    return rows.join(edges, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies(F.col("number"), max_repeats=max_repeats)).cast("long").alias("taken"),
    )


def apply_mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The documents as the mix takes them, a row for each time, with their own columns."""
    rows = settle(measured(docs))
    edges = beside(
        thresholds(rows, weights, max_repeats).select(
            F.col("source").alias("__mix_source"),
            F.struct("repeats", "below").alias("__mix"),
        )
    )
    taken = copies(hash_number(F.col("doc_id")), "__mix.", max_repeats)
    return (
        docs.join(edges, docs["source"].eqNullSafe(F.col("__mix_source")))
        .withColumn("__mix_copies", taken)
        .where("__mix_copies > 0")
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
        .select(*[docs[c] for c in docs.columns])
    )


ORACLE_SQL = r"""
WITH rows_ AS (
  SELECT doc_id, source,
    CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS number
  FROM documents),
sizes AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM rows_ GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
    3 * source_size AS cap FROM sizes),
levels AS (
  SELECT *, row_number() OVER fill AS place,
    CAST(SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(SUM(weight) OVER () - COALESCE(SUM(weight) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM weighed WINDOW fill AS (ORDER BY cap / weight, source NULLS LAST)),
common AS (SELECT arg_min(level, place) AS level FROM levels WHERE cap > level * weight),
goals AS (
  SELECT source, source_size,
    CASE WHEN cap > l.level * weight THEN LEAST((SELECT level FROM common) * weight, CAST(cap AS DOUBLE))
         ELSE CAST(cap AS DOUBLE) END AS target
  FROM levels l),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS repeats FROM goals),
cells AS (
  SELECT source, number >> 12 AS cell, SUM(size) AS words FROM rows_ GROUP BY ALL),
running AS (
  SELECT *, SUM(words) OVER (PARTITION BY source ORDER BY cell) AS upto FROM cells),
edges AS (
  SELECT r.source, min_by(CASE WHEN upto - w.wanted < w.wanted - (upto - words) THEN cell + 1 ELSE cell END, cell) AS edge
  FROM running r JOIN (SELECT source, target - repeats * source_size AS wanted FROM budgets) w
    ON r.source IS NOT DISTINCT FROM w.source
  WHERE upto > w.wanted GROUP BY r.source)
SELECT r.doc_id, r.size, b.source_size, b.target,
  CAST(r.size * LEAST(b.repeats + CASE WHEN (r.number >> 12) < COALESCE(e.edge, 68719476736) THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM rows_ r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON r.source IS NOT DISTINCT FROM e.source
"""
