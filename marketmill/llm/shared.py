"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

import marketmill
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def settle(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read from there from now on, so that
    a lost executor costs a task and not the lineage. The folder is the session's; one is set
    here only where the session names none, which only a local session may leave out. Spark
    removes the files with the frame where ``cleanCheckpoints`` is on."""
    use_shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def use_shared_folder(spark: SparkSession) -> None:
    named = spark.conf.get(CHECKPOINT_DIR, None)
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marketmill-llm-"))
    else:
        raise ValueError(f"a cluster needs a shared folder in {CHECKPOINT_DIR}")


def computed_once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """These columns behind a generator of one row. The optimiser moves later filters below a
    projection by copying its expressions into them, which evaluates nested ones many times
    over; it does not move them below a generator."""
    return df.select(F.inline(F.array(F.struct(*columns))))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for those that do not have it
    installed: functions that run there are found by their module's name."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = os.path.dirname(os.path.abspath(marketmill.__file__))
    folder = tempfile.mkdtemp(prefix="marketmill-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/marketmill-{context.applicationId}"
    context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), "marketmill"))
