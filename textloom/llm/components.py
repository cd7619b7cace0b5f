"""Connected components of an edge table by alternating large-star and small-star rounds.

Edges are first thinned to spanning forests, slice by slice. Once a counted
number of at most LOCAL edges is left, one executor task ends the work; above
that, every round is a join and aggregations with map-side combine. Edges never
leave the executors, and each round's table is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


LOCAL = 1_000_000  #: edges that one task joins up
SLICE = 200_000  #: edges that are thinned at a time


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        p, q = self.root(x), self.root(y)
        if p != q:
            self.parent[max(p, q)] = min(p, q)
        return p != q


def _stars(forest: Forest) -> pa.RecordBatch:
    found = [(x, forest.root(x)) for x in list(forest.parent)]
    return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["u", "v"])


def _thinned(batches):
    forest = Forest()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(x, y)
        if len(forest.parent) > SLICE:
            stars = _stars(forest)
            yield stars.filter(pa.array(np.not_equal(stars.column(0), stars.column(1))))
            forest = Forest()
    stars = _stars(forest)
    yield stars.filter(pa.array(np.not_equal(stars.column(0), stars.column(1))))


def _joined(batches):
    forest = Forest()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(x, y)
    yield _stars(forest)


def connected_components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60, local: int = LOCAL) -> DataFrame:
    """(vertex, component) for every vertex of `edges` (a, b longs); component is the smallest vertex reached.

    Loops, repeated edges and nulls in either end are ignored. No edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.write(edges.mapInArrow(_thinned, "u long, v long"), "edges")
    if edges.count() <= local:
        return edges.coalesce(1).mapInArrow(_joined, "vertex long, component long")
    edges = scratch.write(edges.distinct(), "edges")

    def digest(t: DataFrame):
        return t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    seen = digest(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        after = scratch.write(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        scratch.drop(edges)
        edges, last, seen = after, seen, digest(after)
        if seen == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
