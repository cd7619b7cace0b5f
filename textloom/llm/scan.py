"""Running values along ordered rows of a key, however many rows a key has.

Rows are dealt out by ranges of key and order, so that a key with a third of all rows spreads
over many tasks. Each task folds what it holds; what its first key has gathered before
reaches it as one carried value, worked out from one row for each partition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


@dataclass(frozen=True)
class Fold:
    """A monoid without a neutral element: what one row is worth, and how two neighbours' values join."""

    fields: str  #: DDL of a value
    unit: Callable  #: a row's input values -> value (a tuple)
    join: Callable  #: (earlier value, later value) -> value


def _local(inputs: list[str], fold: Fold, schema: pa.Schema):
    """Running values within a partition; `__last` is null at its final row."""

    def run(batches):
        part, key, value, at, held = TaskContext.get().partitionId(), None, None, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            keys, out = b.column("key").to_pylist(), []
            if held is not None:
                yield _with_last(*held, keys[0])
            for own, row in zip(keys, zip(*[b.column(c).to_pylist() for c in inputs])):
                one = fold.unit(*row)
                value = one if value is None or own != key else fold.join(value, one)
                key = own
                out.append(value)
            columns = list(b.columns) + [pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)]
            columns += [pa.array([part] * len(out), pa.int32()), pa.array(range(at, at + len(out)), pa.int64())]
            at += len(out)
            held = pa.record_batch(columns, names=[*b.schema.names, *schema.names, "__part", "__at"]), keys
        if held is not None:
            yield _with_last(*held, None)

    return run


def _with_last(b: pa.RecordBatch, keys: list, following) -> pa.RecordBatch:
    last = [x != y for x, y in zip(keys, keys[1:])] + [None if following is None else keys[-1] != following]
    return pa.record_batch([*b.columns, pa.array(last, pa.bool_())], names=[*b.schema.names, "__last"])


def _carried(names: list[str], fold: Fold, schema: pa.Schema, carry: dict, ends: dict):
    """Joins what was carried to the rows of a partition's first key; `last` marks the last row of a key."""

    def run(batches):
        for b in batches:
            parts, last = b.column("__part").to_pylist(), b.column("__last").to_pylist()
            last = [ends[p] if x is None else x for p, x in zip(parts, last)]
            values = [b.column(c) for c in schema.names]
            if any(p in carry for p in set(parts)):
                rows = list(zip(*[v.to_pylist() for v in values]))
                for i, (p, key) in enumerate(zip(parts, b.column("key").to_pylist())):
                    if p in carry and carry[p][0] == key:
                        rows[i] = fold.join(carry[p][1], rows[i])
                values = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
            yield pa.record_batch([b.column(c) for c in names] + values + [pa.array(last, pa.bool_())], names=[*names, *schema.names, "last"])

    return run


def scan(rows: DataFrame, order: list, inputs: list[str], fold: Fold, scratch: Scratch, name: str) -> DataFrame:
    """`rows` with the running value of `fold` along each key's rows, and `last` (whether a row ends its key).

    rows: a non-null column `key` and any others; `order`: the columns that order a key's rows, rows that tie in
    them in any order; `inputs`: the columns that a row's value is made of.
    """
    spark = rows.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(fold.fields)
    arrow = to_arrow_schema(kind)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "key", *order).sortWithinPartitions("key", *order)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*rows.schema.fields, *kind.fields]) + ", __part int, __at long, __last boolean"
    table = scratch.write(dealt.mapInArrow(_local(inputs, fold, arrow), ddl), name)
    value = F.struct(*kind.names)
    # a row for each partition
    edges = table.groupBy("__part").agg(F.min_by("key", "__at").alias("first"), F.max_by("key", "__at").alias("final"), F.max_by(value, "__at").alias("value")).orderBy("__part").collect()
    carry, ends, before, running = {}, {}, None, None
    for i, e in enumerate(edges):
        own = tuple(e.value)
        if before is not None and e["first"] == before:
            carry[e["__part"]] = (before, running)
            running = fold.join(running, own) if e.final == e["first"] else own
        else:
            running = own
        before = e.final
        ends[e["__part"]] = i + 1 == len(edges) or edges[i + 1]["first"] != e.final
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*rows.schema.fields, *kind.fields]) + ", last boolean"
    return table.mapInArrow(_carried(rows.columns, fold, arrow, carry, ends), out)
