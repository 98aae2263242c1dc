"""First-pass table profile: shape, types, non-null counts, preview."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_table(name: str, df: DataFrame) -> DataFrame:
    """One row per column, from a single aggregate pass over the table."""
    fields = df.schema.fields
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("column_no"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("n_non_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counted.select("n_rows", F.explode(per_column).alias("p")).select(
        F.lit(name).alias("table_name"),
        "p.column_no",
        "p.column_name",
        "p.data_type",
        "n_rows",
        "p.n_non_null",
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [profile_table(name, df) for name, df in tables.items()]
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, df in tables.items()
        ],
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def previews(tables: Mapping[str, DataFrame], rows: int = 5) -> DataFrame:
    """A few rows of every table as JSON text, nulls included, for a look at the data."""
    shown = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return reduce(
        DataFrame.unionByName,
        [
            preview(df, rows).select(F.lit(name).alias("table_name"), shown.alias("row"))
            for name, df in tables.items()
        ],
    )
