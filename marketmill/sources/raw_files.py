"""Raw CSV extracts: manifest, reading, landing. Any Hadoop path works as a folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.contracts import DAMAGED, RAW_COLUMNS, RAW_FILE_BY_TABLE, RAW_FILES, RawFile
from marketmill.sources.split_csv import read_split_csv

LANDED_AT = "_landed_at"
LANDED_FROM = "_landed_from"


def data_sets(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(name, files, bytes) of the CSV data sets in a folder: ``name.csv``, either one file or a
    folder of part files. Only the folder itself is listed, never the part files one by one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    entries = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().endswith(".csv")]
    found = []
    for entry in entries:
        summary = fs.getContentSummary(entry)
        found.append((entry.getName(), summary.getFileCount(), summary.getLength()))
    return sorted(found)


def file_manifest(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Every expected file, whether it is required and whether it was found where it is read.
    An empty file does not count as found."""
    there = {name: (files, size) for name, files, size in data_sets(spark, folder) if size}
    rows = []
    for f in RAW_FILES:
        name = f.file_name(prefix)
        files, size = there.get(name, (0, 0))
        rows.append((f.table, name, f.required, name in there, files, size))
    return spark.createDataFrame(
        rows,
        "table_name string, file_name string, required boolean, found boolean, n_files bigint, "
        "bytes bigint",
    )


def table_manifest(spark: SparkSession, tables) -> DataFrame:
    """The same check over tables already at hand; no row of them is read."""
    rows = [(f.table, f.required, f.table in tables) for f in RAW_FILES]
    return spark.createDataFrame(rows, "table_name string, required boolean, found boolean")


def require_files(spark: SparkSession, folder: str, prefix: str) -> None:
    missing = (
        file_manifest(spark, folder, prefix)
        .where(F.col("required") & ~F.col("found"))
        .select("file_name")
    )
    names = sorted(r.file_name for r in missing.collect())  # at most the manifest's length
    if names:
        raise FileNotFoundError(f"missing raw files in {folder}: {', '.join(names)}")


def read_csv(
    spark: SparkSession, path: str, multi_line: bool = False, damaged: str | None = None
) -> DataFrame:
    """All columns as strings, by header. Types are cast by name in the star build: a schema
    given to the CSV reader is matched by position, and inference drops leading zeros.

    With a name for it, a last column holds the text of each row that has too few or too many
    fields, and null for the others."""

    def reader():
        return (
            spark.read.option("header", True)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .option("enforceSchema", False)
            .option("encoding", "UTF-8")
        )

    plain = reader().csv(path)
    if damaged is None:
        return plain
    fields = [T.StructField(c, T.StringType()) for c in (*plain.columns, damaged)]
    return (
        reader()
        .schema(T.StructType(fields))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", damaged)
        .csv(path)
    )


def _checked(df: DataFrame, file: RawFile) -> DataFrame:
    lacking = [c for c in RAW_COLUMNS[file.table] if c not in df.columns]
    if lacking:
        raise ValueError(f"{file.table} lacks columns: {', '.join(lacking)}")
    return df


def read_raw(spark: SparkSession, folder: str, prefix: str) -> dict[str, DataFrame]:
    """The raw tables the star needs, lazily, straight from CSV."""
    return {t: df.drop(LANDED_FROM) for t, df in _raw_files(spark, folder, prefix).items()}


def _raw_files(spark: SparkSession, folder: str, prefix: str) -> dict[str, DataFrame]:
    require_files(spark, folder, prefix)
    return {
        table: _checked(_read_file(spark, f"{folder}/{file.file_name(prefix)}", file), file)
        for table, file in RAW_FILE_BY_TABLE.items()
        if table in RAW_COLUMNS
    }


def _read_file(spark: SparkSession, path: str, file: RawFile) -> DataFrame:
    """Either way the file is split between tasks; a record of several lines takes two passes."""
    if not file.multi_line:
        return read_csv(spark, path, damaged=DAMAGED)
    columns = read_csv(spark, path).columns  # of the header, which is one line
    return read_split_csv(spark, path, columns, DAMAGED, LANDED_FROM)


def land_raw(
    spark: SparkSession, folder: str, prefix: str, target: str
) -> dict[str, DataFrame]:
    """Write each raw table once as strings-only Parquet with its origin, and read it back.

    CSV is then parsed once only, and later steps read pruned columns of splittable files.
    """
    landed = {}
    for table, df in _raw_files(spark, folder, prefix).items():
        path = f"{target}/{table}"
        origin = [] if LANDED_FROM in df.columns else [F.col("_metadata.file_path").alias(LANDED_FROM)]
        stamped = df.select("*", *origin, F.current_timestamp().alias(LANDED_AT))
        stamped.write.mode("overwrite").parquet(path)
        landed[table] = spark.read.parquet(path)
    return landed


def _landed(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The raw tables that are there."""
    found = {}
    for table in RAW_COLUMNS:
        try:
            found[table] = spark.read.parquet(f"{target}/{table}")
        except AnalysisException as reason:
            if reason.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def read_landed(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The landed raw tables. Reviews may be lacking, which their reports then say; any other
    missing table is an error."""
    found = _landed(spark, target)
    missing = set(RAW_COLUMNS) - set(found) - {"raw_order_reviews"}
    if missing:
        raise FileNotFoundError(f"not landed in {target}: {', '.join(sorted(missing))}")
    return found


def load_raw_or_source(
    spark: SparkSession, landed: str, folder: str, prefix: str
) -> dict[str, DataFrame]:
    """The landed tables if landing has run, the source files where nothing is landed at all."""
    if not _landed(spark, landed):
        return read_raw(spark, folder, prefix)
    return read_landed(spark, landed)


def load_all(
    spark: SparkSession, folder: str
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Every CSV data set of a folder by stem, and the reason for each that could not be read.

    Files that are known to hold no line breaks in their values are split between tasks."""
    names = [name for name, _, _ in data_sets(spark, folder)]
    if not names:
        raise FileNotFoundError(f"no CSV files in {folder}")
    plain = [f.pattern.replace("{prefix}", "") for f in RAW_FILES if not f.multi_line]
    tables, failed = {}, {}
    for name in names:
        stem = name.removesuffix(".csv")
        try:
            df = read_csv(spark, f"{folder}/{name}", not name.endswith(tuple(plain)))
            if not df.columns:
                raise ValueError("no header row")
            tables[stem] = df
        except Exception as reason:  # report and go on with the others
            failed[stem] = str(reason).splitlines()[0]
    return tables, failed
