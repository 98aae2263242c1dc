"""Star tables on storage: write, read back against the contract, register, bucket.

Every root is a Hadoop path (local, hdfs, s3a, ...): tasks write to it directly, so there is
no separate upload step.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.contracts import STAR_COLUMNS
from marketmill.operators.profile import row_counts
from marketmill.plans import star
from marketmill.plans.lineage import source_freshness
from marketmill.sources import footers


def write_table(df: DataFrame, root: str, name: str, csv: bool = False) -> DataFrame:
    """Write one table (Parquet, optionally CSV as well) and read the Parquet back."""
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if csv:
        written.write.mode("overwrite").option("header", True).csv(f"{root}/csv/{name}")
    return written


def write_star(
    raw: Mapping[str, DataFrame], root: str, csv: bool = False
) -> dict[str, DataFrame]:
    """Build every star table from raw tables and write it below the root.

    The order rollup reads the written lines back, so raw lines are parsed and cast once. The
    other tables do not depend on each other and are written side by side.
    """
    built = star.build_star(raw)
    first = [name for name in STAR_COLUMNS if name != "fact_orders"]
    with ThreadPoolExecutor(len(first)) as pool:
        tables = dict(
            zip(first, pool.map(lambda name: write_table(built[name], root, name, csv), first))
        )
    orders = star.build_star(raw, tables["fact_order_items"])["fact_orders"]
    tables["fact_orders"] = write_table(orders, root, "fact_orders", csv)
    return tables


def _check_contract(name: str, df: DataFrame) -> None:
    wanted, found = STAR_COLUMNS[name], dict(df.dtypes)
    wrong = [
        f"{c} {found.get(c, 'missing')} instead of {kind}"
        for c, kind in wanted.items()
        if found.get(c) != kind
    ]
    if wrong:
        raise ValueError(f"{name} breaks the schema contract: {'; '.join(wrong)}")


def read_star(spark: SparkSession, root: str, strict: bool = True) -> dict[str, DataFrame]:
    """The star tables below a root; raises if one is missing or off contract."""
    tables, missing = {}, []
    for name, columns in STAR_COLUMNS.items():
        try:
            df = spark.read.parquet(f"{root}/{name}")
        except AnalysisException:
            missing.append(name)
            continue
        if strict:
            _check_contract(name, df)
        tables[name] = df.select(*columns)
    if missing:
        raise FileNotFoundError(f"missing star tables in {root}: {', '.join(missing)}")
    return tables


def star_schema(name: str) -> T.StructType:
    """The contract of one star table as a Spark schema."""
    ddl = ", ".join(f"{c} {kind}" for c, kind in STAR_COLUMNS[name].items())
    return T.StructType.fromDDL(ddl)


def pipeline_metadata(tables: Mapping[str, DataFrame], root: str | None = None) -> DataFrame:
    """One row per star table: rows, build time, and the freshness stamp of the orders. With the
    root that the tables were written to, from the footers there."""
    spark = tables["fact_orders"].sparkSession
    counts = footers.written_counts(spark, root, tables) if root else row_counts(tables)
    fresh = footers.written_freshness(spark, root) if root else source_freshness(tables["fact_orders"])
    fresh = fresh.withColumn("table_name", F.lit("fact_orders"))
    return (
        counts
        .withColumnRenamed("n", "rows")
        .join(fresh, "table_name", "left")
        .withColumn("built_at", F.current_timestamp())
    )


def register_views(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name each table as a temporary view for SQL users; returns rows per view."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return row_counts(tables)


def register_found(spark: SparkSession, root: str, raw_root: str | None = None) -> list[str]:
    """Views over whatever star tables exist below a root, and over three raw samples.

    Missing tables are skipped. Returns the names of the views.
    """
    places = [(root, name) for name in STAR_COLUMNS]
    if raw_root is not None:
        places += [(raw_root, n) for n in ("raw_orders", "raw_order_items", "raw_customers")]
    names = []
    for place, name in places:
        try:
            spark.read.parquet(f"{place}/{name}").createOrReplaceTempView(name)
            names.append(name)
        except AnalysisException:
            continue
    return names


# Keys by which the big tables are joined; tables bucketed alike join without a shuffle.
BUCKET_KEYS = {
    "fact_orders": "order_id",
    "fact_order_items": "order_id",
    "dim_customers": "customer_sk",
}


def save_bucketed(
    tables: Mapping[str, DataFrame], root: str, buckets: int, prefix: str = ""
) -> dict[str, DataFrame]:
    """Save the star as catalog tables, the big ones bucketed and sorted on their join key.

    Line-to-order joins, the order key checks and per-person steps then need no exchange of
    their big side. Pick the number of buckets so that one holds a few hundred megabytes.
    """
    saved = {}
    for name, df in tables.items():
        spark = df.sparkSession
        writer = df
        key = BUCKET_KEYS.get(name)
        if key is not None:
            # One file per bucket: rows meet their bucket before the write, not in it.
            writer = df.repartition(buckets, key)
        save = writer.write.mode("overwrite").format("parquet").option("path", f"{root}/{name}")
        if key is not None:
            save = save.bucketBy(buckets, key).sortBy(key)
        save.saveAsTable(f"{prefix}{name}")
        saved[name] = spark.table(f"{prefix}{name}")
    return saved
