"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import settle

TASK_EDGES = 100_000  # two numbers each


def _mark(edges: DataFrame) -> tuple:
    """Number and digest of the edges, to see whether a round changed any."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest"),
    ).first()
    return row["n"], row["digest"]


def _to_least(edges: DataFrame, tasks: int) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (or to itself)."""
    there, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select(F.inline(F.array(there, back)).alias("u", "v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.where("v > u").join(F.broadcast(least) if tasks == 1 else least, "u")
    return larger.select(F.col("v").alias("a"), F.col("m").alias("b"))


def _down(edges: DataFrame, tasks: int) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(F.broadcast(least) if tasks == 1 else least, "a").where("b <> m")
    return smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.toDF("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of numbers to (id, component): the smallest node that can be reached,
    for every node but those that are their component's smallest. Rounds grow with the logarithm
    of the longest path; each round's edges are written to the shared folder, so no lineage is
    carried on. Hot nodes meet only in partial aggregates and in joins that Spark can split.

    A round has as many tasks as its edges need, however many partitions they came in: files of a
    few rows each would take more disk than the rows. Edges that fit one task meet there without
    an exchange, the least neighbours of their nodes (at most two of an edge) broadcast."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(edges.distinct())
    seen = _mark(edges)
    while seen[0]:
        tasks = seen[0] // TASK_EDGES + 1
        moved = _to_least(edges.coalesce(tasks), tasks).distinct().coalesce(tasks)
        edges = settle(_down(moved, tasks).coalesce(tasks).distinct())
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges.toDF("id", "component")
