"""Shared-folder tables that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL: list[str] = []
BATCH_BYTES, BATCH_ROWS = 1 << 20, 4096  #: of an Arrow batch between Spark and its Python workers
WIDE = 4 << 20  #: bytes where CPU time is scarcer than memory


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and the driver is the whole cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="textloom-"))
    return _LOCAL[0]


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Holds Arrow batches to `size` bytes and BATCH_ROWS, so that a worker's memory does not follow the rows' size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(BATCH_ROWS, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{size}b")


def nothing(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows. One made from a Python list is a task of Python's: it starts workers of another kind on every executor, which stay there."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


class Scratch:
    """Tables written below the shared folder; drop() removes those no longer read, with shuffle files, and the end of the application the rest."""

    def __init__(self, spark: SparkSession, name: str, batch: int = BATCH_BYTES):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        bounded_batches(spark, batch)
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def write(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """Writes and reads again; `by` names columns that get a folder for each value."""
        self.n += 1
        path = f"{self.root}/{self.n}-{name}"
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        jvm.System.gc()  # the driver then tells executors which shuffle files nobody can read any more

    def clear(self) -> None:
        """Removes all tables."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.drop()
