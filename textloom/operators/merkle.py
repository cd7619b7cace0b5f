"""A hash tree over the rows of a table, equal for equal multisets of rows, which names the ranges where two tables differ.

Row hashes are spread evenly, so leaves are ranges of hashes that share their leading hex digits. As many
digits are taken as leave about LEAF rows in a leaf, whatever rows a table holds; leaf
digests are joined upwards sixteen at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 4096  #: rows in a leaf, about


def row_hash(cols: list[str]) -> Column:
    """the sha-256 of fields joined by |, nulls written None."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols]), 256)


def digits_for(rows: int, leaf: int = LEAF) -> int:
    """Leading hex digits that leave about `leaf` of so many rows in a leaf."""
    return max(0, math.ceil(math.log(max(rows, 1) / leaf, 16))) if rows > leaf else 0


def _leaves(rows: DataFrame, cols: list[str], digits: int) -> DataFrame:
    """(prefix, n, digest): of the leaf's sorted hashes, a repeated one written once with its count. Equal rows are counted before they meet."""
    each = rows.select(row_hash(cols).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    own = F.transform(F.sort_array(F.collect_list(F.struct("h", "n"))), lambda s: F.when(s["n"] == 1, s["h"]).otherwise(F.concat(s["h"], F.lit("x"), s["n"].cast("string"))))
    return each.groupBy(F.substring("h", 1, digits).alias("prefix")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(own, ""), 256).alias("digest"))


def tree(rows: DataFrame, cols: list[str], digits: int) -> DataFrame:
    """(level, prefix, n, digest): nodes of all levels, level 0 being the root, `digits` the leaves. An empty table has no node."""
    level = _leaves(rows, cols, digits)
    out = level.withColumn("level", F.lit(digits))
    for k in range(digits - 1, -1, -1):
        below = F.transform(F.sort_array(F.collect_list(F.struct("prefix", "digest"))), lambda s: F.concat(s["prefix"], s["digest"]))  # sixteen at most
        level = level.groupBy(F.substring("prefix", 1, k).alias("prefix")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(below, ""), 256).alias("digest"))
        out = out.unionByName(level.withColumn("level", F.lit(k)))
    return out.select("level", "prefix", "n", "digest")


def set_hash(rows: DataFrame, cols: list[str], digits: int | None = None) -> DataFrame:
    """one row, set_hash: the root's digest, which does not depend on the order of rows; that of no rows is the hash of nothing."""
    top = tree(rows, cols, digits_for(rows.count()) if digits is None else digits).where("level = 0")
    return top.agg(F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("set_hash"))


def differing(before: DataFrame, after: DataFrame, cols: list[str], digits: int | None = None) -> DataFrame:
    """(prefix, before, after): the leaves whose rows differ and how many rows each side has there.

    Both trees are read from the root; below a node whose digests agree nothing is compared.
    """
    if digits is None:
        digits = digits_for(max(before.count(), after.count()))
    a, b = tree(before, cols, digits), tree(after, cols, digits)
    seen = None
    for k in range(digits + 1):
        own = [t.where(F.col("level") == k).select("prefix", F.col("n").alias(f"n{i}"), F.col("digest").alias(f"d{i}")) for i, t in enumerate((a, b))]
        if seen is not None:
            up = F.substring("prefix", 1, k - 1)
            own = [t.join(seen, up == F.col("above"), "left_semi") for t in own]
        both = own[0].join(own[1], "prefix", "full").where(~F.col("d0").eqNullSafe(F.col("d1")))
        seen = both.select(F.col("prefix").alias("above"))
    return both.select("prefix", F.coalesce("n0", F.lit(0)).alias("before"), F.coalesce("n1", F.lit(0)).alias("after"))


def changed_rows(before: DataFrame, after: DataFrame, cols: list[str], digits: int | None = None) -> DataFrame:
    """(side, hash, n): the row hashes that one side has more often, looked for in the differing leaves only."""
    if digits is None:
        digits = digits_for(max(before.count(), after.count()))
    where = differing(before, after, cols, digits).select("prefix")
    own = [t.select(row_hash(cols).alias("h")).withColumn("prefix", F.substring("h", 1, digits)).join(where, "prefix", "left_semi").groupBy("h").agg(F.count("*").alias(c)) for t, c in ((before, "a"), (after, "b"))]
    both = own[0].join(own[1], "h", "full").fillna(0, ["a", "b"]).where("a <> b")
    return both.select(F.when(F.col("a") > F.col("b"), "before").otherwise("after").alias("side"), F.col("h").alias("hash"), F.abs(F.col("a") - F.col("b")).alias("n"))
