"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1024  #: of an Arrow batch between Spark and its Python workers


def bounded_batches(spark: SparkSession) -> None:
    """Holds Arrow batches to BATCH_BYTES and BATCH_ROWS, so that a worker's memory does not follow the texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(BATCH_ROWS, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and driver and executors are one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="textloom-"))
    return _LOCAL[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table, read again; removed when the application ends."""
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(where)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(where)
