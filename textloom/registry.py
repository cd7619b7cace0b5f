"""Registration of queries with their inventory ids and DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .sources.shared import bounded_batches


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ALL: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame; without SQL its rows are held by tests."""

    def add(f):
        if name in ALL:
            raise ValueError(f"{name} is registered twice")
        ALL[name] = Query(name, tuple(ids.split()), f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
