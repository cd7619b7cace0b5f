"""Resume markers kept as the state of a stream, written in batches that several tables share or none has.

A batch's tables are written below a folder of its own attempt; the commit, one small file named after the batch, is
written last and by renaming, which either happens or does not. A batch that died before its commit is written again by the
stream's replay under a new attempt, and its remains are removed; one that died after it is not written twice. Readers follow the
commits only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_dir

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
MARKER = "key long, events long, section long, status string, last_id long"


def _advance(key, frames, state):
    """The marker of one key after more of its events, in their order; events at or before the last one seen are replays."""
    events, section, status, last = state.get if state.exists else (0, None, None, -1)
    frames = [f for f in frames if len(f)]
    if frames:
        rows = pd.concat(frames).drop_duplicates("event_id").sort_values("event_id")
        rows = rows[rows.event_id > last]
        if len(rows):
            events, last, status = events + len(rows), int(rows.event_id.iloc[-1]), str(rows.event_type.iloc[-1])
            top = int(rows.section.max())
            section = top if section is None else max(section, top)
    state.update((events, section, status, last))
    yield pd.DataFrame([(key[0], events, section, status, last)], columns=["key", "events", "section", "status", "last_id"])


def markers(events: DataFrame) -> DataFrame:
    """The changed markers (MARKER) of each micro-batch of events (EVENTS); a section is an hour. State is held for each key."""
    rows = events.select(F.col("user_id").alias("key"), "event_id", "event_type", F.floor(F.unix_seconds("ts") / 3600).cast("long").alias("section"))
    return rows.groupBy("key").applyInPandasWithState(_advance, MARKER, "events long, section long, status string, last_id long", "update", "NoTimeout")


class BatchLog:
    """An append-only log of batches, each of several tables, that commits all of them or none."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.path(f"{root}/commits"))

    def committed(self) -> dict[int, str]:
        """The folder of each committed batch."""
        out = {}
        for status in self.files.listStatus(self.path(f"{self.root}/commits")):
            name = status.getPath().getName()
            if not name.startswith("."):
                batch, attempt = name.split("-", 1)
                out[int(batch)] = f"{self.root}/batches/{batch}/{attempt}"
        return out

    def write(self, batch: int, tables: dict[str, DataFrame], after: Callable[[str], None] | None = None) -> bool:
        """Writes a batch's tables and commits them; False where the batch is committed already. `after` is called with each table's name once it is written.

        Whatever is raised in between rolls the attempt back and is raised again.
        """
        if batch in self.committed():
            return False
        self.files.delete(self.path(f"{self.root}/batches/{batch}"), True)  # what attempts before this one left
        attempt = uuid.uuid4().hex
        where = f"{self.root}/batches/{batch}/{attempt}"
        try:
            for name, rows in tables.items():
                rows.write.parquet(f"{where}/{name}")
                if after is not None:
                    after(name)
        except Exception:
            self.files.delete(self.path(where), True)
            raise
        mark = self.path(f"{self.root}/commits/.{attempt}")
        self.files.create(mark, True).close()
        if not self.files.rename(mark, self.path(f"{self.root}/commits/{batch}-{attempt}")):
            raise RuntimeError(f"batch {batch} could not be committed")
        return True

    def read(self, name: str, schema: str) -> DataFrame:
        """A table's rows of all committed batches, with `batch`."""
        found = self.committed()
        if not found:
            return self.spark.createDataFrame([], f"{schema}, batch long")
        rows = self.spark.read.schema(schema).parquet(*[f"{where}/{name}" for where in found.values()])
        at = F.regexp_extract(F.col("_metadata.file_path"), r"/batches/(\d+)/", 1).cast("long")
        return rows.withColumn("batch", at)


def start(spark: SparkSession, events: DataFrame, log: BatchLog, checkpoint: str, after: Callable[[str], None] | None = None):
    """The stream that keeps markers and writes each batch's markers and its audit row (T09) as one."""

    def each(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        audit = rows.agg(F.count("*").alias("markers"), F.max("last_id").alias("last_id"))
        log.write(batch, {"markers": rows, "audit": audit}, after)
        rows.unpersist()

    return markers(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def latest(log: BatchLog) -> DataFrame:
    """The marker of each key in the last committed batch that has one."""
    rows = log.read("markers", MARKER)
    return rows.groupBy("key").agg(F.max_by(F.struct("events", "section", "status"), "batch").alias("m")).select("key", "m.*")


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The markers of all users after the events table has come as a stream."""
    root = f"{shared_dir(spark)}/progress-{uuid.uuid4().hex}"
    events = spark.readStream.schema(EVENTS.replace("ts timestamp", "ts timestamp_ntz")).parquet(f"{sf_dir}/events.parquet*")
    log = BatchLog(spark, f"{root}/log")
    log.files.deleteOnExit(log.path(root))
    start(spark, events.withColumn("ts", F.col("ts").cast("timestamp")), log, f"{root}/checkpoint").awaitTermination()
    return latest(log)
