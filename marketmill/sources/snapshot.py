"""Cut lineage by writing a table to the cluster's shared folder and reading it back.

A written table survives the loss of any executor, and reading it back gives column pruning
and filter pushdown to every query that uses it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session. Only a session on one machine may leave it out; it gets
    a temporary one that goes with the process. A cluster without one is an error, as every query
    would build the whole star again."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError(f"a cluster needs a shared folder in {CHECKPOINT_DIR}")
    folder = tempfile.mkdtemp(prefix="marketmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


class Snapshot:
    """A folder of its own below the shared folder, one sub-folder per table."""

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self.root = f"{shared_folder(spark)}/marketmill-{label}-{uuid.uuid4().hex}"

    def settle(self, name: str, df: DataFrame) -> DataFrame:
        """The table read back from storage."""
        path = f"{self.root}/{name}"
        # The root is this snapshot's own, so this only ever replaces a write that failed.
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Removes the folder; tables read from it are gone then."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
