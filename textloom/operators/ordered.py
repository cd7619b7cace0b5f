"""Places and carried values in one order over a whole table, without a window that gathers it in one task.

Rows are dealt out by ranges of the order and numbered within each range. What the ranges before
hold comes from one row for each range: a count, or the last value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import written

_WITHIN = (1 << 33) - 1  #: monotonically_increasing_id keeps a row's place in its partition here


def in_ranges(rows: DataFrame, order: list, name: str = "ordered", then=None) -> DataFrame:
    """`rows` written range by range, with __part and __at. `order` should be total: rows that tie in it stay in one range.

    `then` makes a table of the ordered rows, row by row, before they are written: the ranges' sample does not pay for it.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = then(dealt) if then else dealt
    # written first: a range is cut by a sample, which another run may draw differently
    return written(dealt.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias("__at")), name)


def _before(table: DataFrame, kind: str, of_each: dict, folded) -> DataFrame:
    """(__part, __before): what the ranges before each one add up to."""
    running, out = None, []
    for part in sorted(of_each):
        out.append((part, running))
        running = folded(running, of_each[part])
    return F.broadcast(table.sparkSession.createDataFrame(out, f"__part int, __before {kind}"))  # a row for each range


def positions(rows: DataFrame, order: list, name: str = "position", then=None) -> DataFrame:
    """`rows` with `name`: their place from 0 in the order of the whole table."""
    table = in_ranges(rows, order, then=then)
    counts = {r["__part"]: r.n for r in table.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    before = _before(table, "long", counts, lambda a, n: (a or 0) + n)
    return table.join(before, "__part").withColumn(name, F.coalesce("__before", F.lit(0)) + F.col("__at")).drop("__part", "__at", "__before")


def carried(rows: DataFrame, order: list, value: Column, name: str) -> DataFrame:
    """`rows` with `name`: the last non-null `value` at or before each row in the order of the whole table."""
    table = in_ranges(rows.withColumn("__value", value), order)
    kind = table.schema["__value"].dataType.simpleString()
    last = table.where("__value is not null").groupBy("__part").agg(F.max_by("__value", "__at").alias("v"))
    found = {r["__part"]: None for r in table.select("__part").distinct().collect()} | {r["__part"]: r.v for r in last.collect()}
    before = _before(table, kind, found, lambda a, v: a if v is None else v)
    within = F.last("__value", ignorenulls=True).over(W.partitionBy("__part").orderBy("__at").rowsBetween(W.unboundedPreceding, 0))
    return table.withColumn("__here", within).join(before, "__part").withColumn(name, F.coalesce("__here", "__before")).drop("__part", "__at", "__before", "__value", "__here")


def following(rows: DataFrame, order: list, column: str, name: str, step: int = 1, around: bool = False) -> DataFrame:
    """`rows` with `name`: `column` of the row `step` places on, null beyond the end or, with `around`, counted on from the start."""
    table = written(positions(rows, order, "__place"), "placed")
    target = F.col("__place") + step
    if around:
        target = F.pmod(target, F.lit(max(table.count(), 1)))
    other = table.select(F.col("__place").alias("__target"), F.col(column).alias(name))
    return table.withColumn("__target", target).join(other, "__target", "left").drop("__target", "__place")
