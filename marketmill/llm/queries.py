"""The registered queries of this folder: thin, over whole tables, by their operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketmill.llm import (
    collocations,
    licence_scan,
    mixing,
    near_dup,
    nearest,
    packing,
    periodic_runs,
    pii,
    quality,
    repeats,
    toxicity,
    url_rules,
    winnowing,
)
from marketmill.llm.shared import ship


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.classes(_table(spark, folder, "documents"))


def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judged(_table(spark, folder, "pages"))


def op3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.searched(_table(spark, folder, "embeddings"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan.digest(licence_scan.scanned(_table(spark, folder, "documents")))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, folder, "documents")))


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(repeats.cut(_table(spark, folder, "documents")))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(_table(spark, folder, "documents"))


def op11_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.digest(winnowing.compared(_table(spark, folder, "documents")))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.ranked(collocations.counted(_table(spark, folder, "documents")))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return periodic_runs.digest(periodic_runs.found(docs, edit=periodic_runs.looped))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dup,
        op2_url_rules,
        op3_nearest,
        op4_toxicity,
        op5_licences,
        op6_pii,
        op7_repeats,
        op8_packing,
        op9_quality,
        op10_mixing,
        op11_winnowing,
        op12_collocations,
        op13_periodic_runs,
    )
}
# What SQL cannot express (fitted models, vocabularies, approximate search, 64-bit hashes of
# words) is tested against brute force in tests/llm.
ORACLES = {
    "op7_repeats": repeats.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}
