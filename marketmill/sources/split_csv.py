"""CSV files with line breaks inside quoted values, read by many tasks.

Spark's ``multiLine`` reader takes a whole file as one task's work, since only the file's beginning
says whether a line break ends a record. Here the file is read as lines, which can be split:

* A line starts inside a quoted value if an odd number of quotes stand before it; a doubled quote
  in a value counts twice and changes nothing. Quotes are added up per split, summed over the
  splits of each file in order (one row per split), and carried on line by line within a split.
* A line that starts outside opens a record. Lines that start inside belong to the last record
  opened before them, in an earlier split if theirs opened none before. Only the lines of
  records of several lines are grouped; all others are records as they are.
* Records go through ``from_csv`` with the options of the plain reader.

A quote within an unquoted value is no valid CSV and not understood here. A file whose quotes do
not pair is taken line by line, so that its damage is counted and no record swallows the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE = "_file"
OPTIONS = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, its split of the file and its place there."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("at"),
            "value",
            (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        )
    )


def _opened(lines: DataFrame) -> DataFrame:
    """Per split: the quotes before it, whether the file's quotes pair, and whether its first line
    ends in CR LF; then that is its line break, also within values."""
    in_order = Window.partitionBy(FILE).orderBy("split")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.sum("quotes")
    return (
        lines.groupBy(FILE, "split")
        .agg(quotes.alias("quotes"), F.min_by(F.col("value").endswith("\r"), "at").alias("crlf"))
        .select(
            FILE,
            "split",
            F.coalesce(quotes.over(before), F.lit(0)).alias("quotes_before"),
            (quotes.over(Window.partitionBy(FILE)) % 2 == 0).alias("paired"),
            F.first("crlf").over(in_order).alias("crlf"),
        )
    )


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with ``inside`` (they start within a value) and ``record``: how many records their
    split has opened up to them, 0 before its first one."""
    in_order = Window.partitionBy(FILE, "split").orderBy("at")
    before = F.coalesce(
        F.sum("quotes").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    opened = F.sum((~F.col("inside")).cast("int"))
    return (
        lines.join(_opened(lines), [FILE, "split"])
        .withColumn("inside", F.col("paired") & ((F.col("quotes_before") + before) % 2 == 1))
        .withColumn("open_after", F.col("paired") & (F.col("inside") != (F.col("quotes") % 2 == 1)))
        .withColumn("record", opened.over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``_file``, ``first`` and ``value``: the text of every record, line breaks and all, and
    whether it is the first of its file."""
    bare = F.when(F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    lines = _numbered(_lines(spark, path)).withColumn("value", bare)
    single = lines.where("NOT inside AND NOT open_after")
    # The record that is open where a split starts.
    last = F.when(F.max("record") > 0, F.struct("split", F.max("record").alias("record")))
    earlier = Window.partitionBy(FILE).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    open_at = (
        lines.groupBy(FILE, "split")
        .agg(last.alias("last"))
        .select(FILE, "split", F.last("last", ignorenulls=True).over(earlier).alias("home"))
    )
    own = F.struct("split", "record")
    several = (
        lines.where("inside OR open_after")
        .join(open_at, [FILE, "split"])
        .withColumn("home", F.when(F.col("record") > 0, own).otherwise(F.col("home")))
        .groupBy(FILE, "home")
        .agg(F.sort_array(F.collect_list(F.struct("split", "at", "value"))).alias("parts"))
        .select(
            FILE,
            _first(F.col("home.split"), F.col("home.record")),
            F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
        )
    )
    whole = single.select(FILE, _first(F.col("split"), F.col("record")), "value")
    return whole.unionByName(several)


def _first(split: Column, record: Column) -> Column:
    return ((split == 0) & (record == 1)).alias("first")


def read_split_csv(
    spark: SparkSession, path: str, columns: list[str], damaged: str, origin: str
) -> DataFrame:
    """All columns as strings; ``damaged`` holds the text of records with too few or too many
    fields, and of a file's header that names other columns; ``origin`` names the file."""
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*columns, damaged))
    bare = F.regexp_replace("value", "\r$", "")  # a stray one; the reader takes it for a break
    options = OPTIONS | {"columnNameOfCorruptRecord": damaged}
    parsed = (
        records(spark, path)
        .withColumn("value", bare)
        .where("value <> ''")
        .select(FILE, "first", "value", F.from_csv("value", schema, options).alias("row"))
    )
    named = F.array(*[F.col("row").getField(c) for c in columns])
    header = F.array(*map(F.lit, columns))
    broken = F.when(F.col("first"), F.col("value")).otherwise(F.col("row").getField(damaged))
    return parsed.where(~F.col("first") | ~named.eqNullSafe(header)).select(
        *[F.col("row").getField(c).alias(c) for c in columns],
        broken.alias(damaged),
        F.col(FILE).alias(origin),
    )

