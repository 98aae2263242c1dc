"""A corpus pipeline of operators: each stage reads what the one before it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketmill.llm import mixing, near_dup, packing, pii, toxicity
from marketmill.llm.shared import ship, use_shared_folder

REMEMBERED_WORDS = 50_000


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that are more likely toxic than not; fitted on the ``labels`` table. A null
    or empty text is not toxic; repeated rows are judged alike."""
    return toxicity.clean_only(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, the one of the smallest id, in one row
    if it is given in several. Rows without an id all stay, and texts without words are alike to
    none."""
    return near_dup.without_copies(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces confirmed personal data in the texts; keeps every row. A null text stays null."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes documents, some more than once, so that the sources come near their targets. Rows
    without words have no size; a null source is one of its own."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Packs the tokens of every document taken into sequences; a row per piece. The workers have
    served the stages before, so they remember fewer words than in a run of its own."""
    return packing.packed(docs, remembered=REMEMBERED_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Classes are fitted and tokens counted by a vocabulary file: SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next. The
    results lie below the checkpoint folder, in one of the run's own, which holds what the returned
    DataFrame reads: whoever runs the pipeline removes it. An empty table goes through all stages."""
    use_shared_folder(spark)
    ship(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, folder).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
