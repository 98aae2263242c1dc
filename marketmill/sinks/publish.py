"""Write-audit-publish: a build becomes current only when its checks allow it, and only if nothing
else has been published since it began.

A build is written below ``versions/<id>``. The ``published`` log holds one numbered entry per
publication, which names the version before it; readers take the highest number. An entry is
written aside and then given its number by a rename that fails where the number is taken, so of two
builds that began from the same version one is published and the other is told so. Nothing else is
copied or renamed, and a build that fails or comes too late leaves the current one untouched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "number bigint, version string, previous string, published_at timestamp"


class PublicationConflict(RuntimeError):
    """Another build has been published since this one began."""


@dataclass(frozen=True)
class Entry:
    """The newest publication; number 0 stands for none."""

    number: int = 0
    version: str | None = None


def version_root(lake: str, version: str) -> str:
    return f"{lake}/versions/{version}"


def log(spark: SparkSession, lake: str) -> DataFrame:
    """All entries; none before the first publication."""
    try:
        return spark.read.schema(LOG).json(f"{lake}/published")
    except AnalysisException as reason:
        if reason.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def newest(spark: SparkSession, lake: str) -> Entry:
    last = log(spark, lake).agg(F.max(F.struct("number", "version")).alias("last")).first()["last"]
    return Entry(last["number"], last["version"]) if last else Entry()


def publish(spark: SparkSession, lake: str, version: str, began_from: Entry | None = None) -> Entry:
    """Make a version the current one. ``began_from`` is the newest entry when the build began;
    without it, whatever is newest now. Raises ``PublicationConflict`` if that is not the newest
    one any more."""
    before = newest(spark, lake) if began_from is None else began_from
    entry = Entry(before.number + 1, version)
    aside = f"{lake}/publishing/{uuid.uuid4().hex}"
    spark.range(1, numPartitions=1).select(
        F.lit(entry.number).cast("bigint").alias("number"),
        F.lit(version).alias("version"),
        F.lit(before.version).cast("string").alias("previous"),
        F.current_timestamp().alias("published_at"),
    ).write.json(aside)
    if not _renamed_if_absent(spark, aside, f"{lake}/published/entry={entry.number:012d}"):
        raise PublicationConflict(
            f"{version} began from {before.version}, but {newest(spark, lake).version} is current"
        )
    return entry


def _renamed_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Rename without replacing: the file system itself lets one of several renames win."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    context.mkdir(place.getParent(), hadoop.permission.FsPermission.getDirDefault(), True)
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(hadoop.Path(source), place, options)
    except Exception as reason:
        if context.util().exists(place):
            context.delete(hadoop.Path(source), True)
            return False
        raise reason
    return True


def current_version(spark: SparkSession, lake: str) -> str | None:
    """The newest published version, or None before the first publication."""
    return newest(spark, lake).version


def history(spark: SparkSession, lake: str) -> list[str]:
    """All published versions, oldest first: one short row per publication."""
    return [r.version for r in log(spark, lake).orderBy("number").select("version").collect()]
