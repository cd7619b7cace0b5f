"""Stage state as an append-only event log, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ledger import stage_ordinals

EVENTS = "prefix string, source_md5 string, stage string, status string, version string, ord long"


def current(events: DataFrame, sources: DataFrame) -> DataFrame:
    """The last status of each stage of each prefix; events of another source text are void.

    sources: (prefix, source_md5). A field-wise last value keeps what a later event leaves null.
    """
    live = events.join(sources, ["prefix", "source_md5"], "left_semi")
    last = lambda c: F.max_by(c, "ord")
    return live.groupBy("prefix", "stage").agg(last("status").alias("status"), F.max_by("version", F.when(F.col("version").isNotNull(), F.col("ord"))).alias("version"), F.max("ord").alias("ord"))


def remaining(spark: SparkSession, events: DataFrame, sources: DataFrame) -> DataFrame:
    """(prefix, stage, pos) still to run, in the fixed order."""
    done = current(events, sources).where("status = 'COMPLETED'").select("prefix", "stage")
    # stages are a short fixed list, one set of them a prefix
    every = sources.select("prefix").distinct().withColumn("s", F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(p).alias("pos")) for s, p in ((r[0], r[1]) for r in stage_ordinals(spark).collect())])))
    return every.select("prefix", "s.stage", "s.pos").join(done, ["prefix", "stage"], "left_anti")


def next_stage(spark: SparkSession, events: DataFrame, sources: DataFrame) -> DataFrame:
    """(prefix, next_stage), null when all is done."""
    left = remaining(spark, events, sources).groupBy("prefix").agg(F.min_by("stage", "pos").alias("next_stage"))
    return sources.select("prefix").distinct().join(left, "prefix", "left")


def successors(spark: SparkSession) -> DataFrame:
    """(stage, successor)."""
    return stage_ordinals(spark).select("stage", F.lead("stage").over(W.orderBy("pos")).alias("successor"))


def rewind_plan(spark: SparkSession, state: DataFrame, inserted: str) -> DataFrame:
    """Where a stage was inserted: prefixes whose next stage lies behind it must go back to it."""
    pos = stage_ordinals(spark)
    at = {r[0]: r[1] for r in pos.collect()}[inserted]
    rows = state.join(pos.withColumnRenamed("stage", "next_stage"), "next_stage", "left")
    return rows.select("prefix", "next_stage", F.when(F.coalesce(F.col("pos"), F.lit(999)) > at, inserted).otherwise(F.col("next_stage")).alias("planned"))


def evolve(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Missing columns are added and nulls become UNKNOWN, never guessed; running it again changes nothing."""
    for name, kind in columns.items():
        old = F.col(name) if name in rows.columns else F.lit(None)
        rows = rows.withColumn(name, F.coalesce(old.cast(kind), F.lit("UNKNOWN").cast(kind) if kind == "string" else F.lit(None).cast(kind)))
    return rows


def drift(state: DataFrame, version: str) -> DataFrame:
    """Stages recorded under another engine version."""
    return state.where(F.coalesce("version", F.lit("UNKNOWN")) != version).select("prefix", "stage", F.coalesce("version", F.lit("UNKNOWN")).alias("recorded"))


def stream_log(spark: SparkSession, folder: str, table: str, checkpoint: str):
    """Events that arrive as JSON files, appended once each to a Parquet log; the query resumes from its checkpoint."""
    rows = spark.readStream.schema(EVENTS).json(folder)
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def event_counts(spark: SparkSession, folder: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Extension, no counterpart in the reference: windowed counts of an event stream with a watermark."""
    rows = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, value double, props string").parquet(folder)
    got = rows.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return got.select(F.col("window.start").alias("start"), "event_type", "n", "total")
