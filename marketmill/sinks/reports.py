"""Report sinks: each section a folder of JSON lines, written by Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_section(df: DataFrame, out: str, section: str) -> None:
    """Sections are aggregates of bounded size; one file keeps their row order."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{out}/{section}"
    )


def write_report(sections: Mapping[str, DataFrame], out: str) -> list[str]:
    for section, df in sections.items():
        write_section(df, out, section)
    return list(sections)


def stamped(df: DataFrame, column: str = "checked_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())
