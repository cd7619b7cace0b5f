"""Exact integer k-means with Elkan's bounds.

Between rounds every vector keeps its centroid, an upper bound of its distance to it and a
lower bound of its distance to each centroid. A centroid is looked at only where neither its lower
bound nor half its distance to the vector's own centroid exceeds the upper bound. Both
comparisons are strict and bounds are rounded outwards, so whatever could tie is calculated. All
distances are integers; a vector keeps the smaller number among equals.

A round reads the vectors once and writes them with their new bounds. Sums of centroids
follow the vectors that moved, one partial sum for each task and centroid; only
the centroids (k rows) pass the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

SCALE = 64
LARGEST = 1 << 27  #: components up to here keep squared distances of 64 components below 2^63
MOST_DIM = 64
OUTWARD = 2.0**-48  #: relative; more than what a root, a sum and a conversion can lose


def _up(x: np.ndarray) -> np.ndarray:
    return x * (1 + OUTWARD) + 1e-300


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(x * (1 - OUTWARD) - 1e-300, 0)


def _single_down(x: np.ndarray) -> np.ndarray:
    """Single precision, never above x: bounds of k centroids are what a vector carries most of."""
    out = x.astype(np.float32)
    return np.where(out > x, np.nextafter(out, np.float32(0)), out).astype(np.float32)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of int64 matrices, or of rows to one vector."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


@dataclass
class Round:
    """What a round knows of its centroids: their values, half their distances from each other, and how far each has moved."""

    centroids: np.ndarray
    moved: np.ndarray

    def __post_init__(self):
        k = len(self.centroids)
        apart = np.stack([squared(self.centroids, c) for c in self.centroids]) if k else np.zeros((0, 0))
        self.half = _down(np.sqrt(apart.astype(np.float64))) / 2
        other = self.half.copy()
        np.fill_diagonal(other, np.inf)
        self.nearest_half = other.min(1) if k else np.zeros(0)

    def assign(self, x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """New centroid, upper bound, lower bounds and the number of distances calculated, for each row."""
        at, calculated = at.copy(), np.zeros(len(x), np.int64)
        upper = _up(upper + self.moved[at])
        lower = _down(lower.astype(np.float64) - self.moved[None, :])
        rows = np.flatnonzero(~(upper < self.nearest_half[at]))
        rows = rows[_open(upper[rows], lower[rows], self.half[at[rows]], at[rows]).any(1)]
        if len(rows):
            own, a = x[rows], at[rows]
            best = squared(own, self.centroids[a])
            u, lo = _up(np.sqrt(best.astype(np.float64))), lower[rows]
            lo[np.arange(len(rows)), a] = _down(np.sqrt(best.astype(np.float64)))
            n = np.ones(len(rows), np.int64)
            for j in range(len(self.centroids)):
                look = np.flatnonzero((a != j) & ~(lo[:, j] > u) & ~(self.half[a, j] > u))
                if not len(look):
                    continue
                d = squared(own[look], self.centroids[j])
                n[look] += 1
                lo[look, j] = _down(np.sqrt(d.astype(np.float64)))
                wins = (d < best[look]) | ((d == best[look]) & (j < a[look]))
                won = look[wins]
                best[won], a[won], u[won] = d[wins], j, _up(np.sqrt(d[wins].astype(np.float64)))
            at[rows], upper[rows], lower[rows], calculated[rows] = a, u, lo, n
        return at, upper, _single_down(lower), calculated


def _open(upper: np.ndarray, lower: np.ndarray, half: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which centroids a row still has to be compared with."""
    out = ~(lower > upper[:, None]) & ~(half > upper[:, None])
    out[np.arange(len(at)), at] = False
    return out


def _values(column: pa.Array, dim: int, kind=np.int64) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim).astype(kind)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, max(x.shape[1], 1), dtype=np.int32)), pa.array(x.ravel(), kind))


STATE = "id {id}, v array<int>, cluster int, was int, upper double, lower array<float>, calculated long"


def _first(k: int, dim: int, now: Round):
    """Every vector starts at centroid 0 without bounds."""

    def run(batches):
        for b in batches:
            x = _values(b.column("v"), dim)
            at = np.zeros(len(x), np.int64)
            new, upper, lower, n = now.assign(x, at, np.full(len(x), np.inf), np.zeros((len(x), k), np.float32))
            yield _state(b, new, np.full(len(x), -1), upper, lower, n)

    return run


def _next(k: int, dim: int, now: Round):
    def run(batches):
        for b in batches:
            at = np.asarray(b.column("cluster")).astype(np.int64)
            lower = _values(b.column("lower"), k, np.float32)
            new, upper, lower, n = now.assign(_values(b.column("v"), dim), at, np.asarray(b.column("upper")), lower)
            yield _state(b, new, at, upper, lower, n + np.asarray(b.column("calculated")))

    return run


def _state(b: pa.RecordBatch, at, was, upper, lower, n) -> pa.RecordBatch:
    columns = [b.column("id"), b.column("v"), pa.array(at, pa.int32()), pa.array(was, pa.int32()), pa.array(upper, pa.float64()), _lists(lower, pa.float32()), pa.array(n, pa.int64())]
    return pa.record_batch(columns, names=["id", "v", "cluster", "was", "upper", "lower", "calculated"])


def _changes(k: int, dim: int):
    """What the vectors that moved add to and take from each centroid: a row for each centroid of a task."""

    def run(batches):
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            x, to, old = _values(b.column("v"), dim), np.asarray(b.column("cluster")), np.asarray(b.column("was"))
            np.add.at(sums, to, x)
            np.add.at(counts, to, 1)
            left = old >= 0
            np.subtract.at(sums, old[left], x[left])
            np.subtract.at(counts, old[left], 1)
        touched = np.flatnonzero(counts.astype(bool) | sums.any(1))
        yield pa.record_batch([pa.array(touched, pa.int32()), pa.array(counts[touched], pa.int64()), _lists(sums[touched], pa.int64())], names=["cluster", "n", "sums"])

    return run


def _final(k: int, dim: int, now: Round):
    """The last assignment, with exact distances to the centroid chosen."""

    def run(batches):
        step = _next(k, dim, now)
        for b in step(batches):
            at, x = np.asarray(b.column("cluster")), _values(b.column("v"), dim)
            d = squared(x, now.centroids[at]) if len(x) else np.zeros(0, np.int64)
            yield pa.record_batch([b.column("id"), b.column("cluster"), pa.array(d, pa.int64()), b.column("calculated")], names=["id", "cluster", "distance", "calculated"])

    return run


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = MOST_DIM, scale: int = SCALE) -> DataFrame:
    """(id, v): the vectors of exactly `dim` components, none null or not finite, as floor(scale * x).

    Components beyond LARGEST after scaling leave no room for a squared distance in a long; such vectors are left out too.
    """
    x = F.col(vector_col)
    whole = (F.size(x) == dim) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) >= LARGEST))
    rows = vectors.where(x.isNotNull()).where(F.coalesce(whole, F.lit(False)))
    return rows.select(F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v"))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = MOST_DIM, scale: int = SCALE, seed: str = "1:") -> DataFrame:
    """A row for each kept vector: id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256, calculated (distances worked out for it in all rounds).

    Centroids start as the k vectors whose SHA-256 of seed and id is smallest (equal hashes by their components,
    a null id last); fewer vectors make fewer centroids. `rounds` times vectors are assigned and non-empty
    centroids replaced by floored means, then vectors are assigned once more. Vectors that are null, of
    another length, or hold null, non-finite or too large components (see `integers`) give no row; repeated rows each
    give one, equal vectors fall to the same centroid. Other columns are not read. An empty table gives no rows.
    Inertias beyond a long are null.
    """
    if not 1 <= dim <= MOST_DIM:
        raise ValueError(f"between 1 and {MOST_DIM} components")
    scratch = Scratch(vectors.sparkSession, "elkan")
    kept = scratch.write(integers(vectors, id_col, vector_col, dim, scale), "vectors")
    state = STATE.format(id=kept.schema["id"].dataType.simpleString())
    hashed = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    drawn = kept.select("v", hashed.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    centroids = np.array([r.v for r in drawn], np.int64).reshape(-1, dim)
    k = len(centroids)
    names = {"id": id_col}
    if not k:
        return kept.select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"), ("calculated", "long"))])
    now = Round(centroids, np.zeros(k))
    sums, counts = [[0] * dim for _ in range(k)], [0] * k
    table = kept
    for r in range(rounds):
        after = scratch.write(table.mapInArrow((_next if r else _first)(k, dim, now), state), f"round{r}")
        scratch.drop(table)
        table = after
        moved = table.where("cluster <> was").select("v", "cluster", "was").mapInArrow(_changes(k, dim), "cluster int, n long, sums array<long>")
        each = moved.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        for row in each.collect():  # k times dim rows at most
            sums[row.cluster][row.d] += int(row.s)
            if row.d == 0:
                counts[row.cluster] += row.n
        means = np.array([[s // n for s in own] if n else old for own, n, old in zip(sums, counts, now.centroids.tolist())], np.int64).reshape(-1, dim)
        now = Round(means, _up(np.sqrt(squared(means, now.centroids).astype(np.float64))))
    if not rounds:
        table = scratch.write(table.mapInArrow(_first(k, dim, now), state), "start")
    last = scratch.write(table.mapInArrow(_final(k, dim, now), f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance long, calculated long"), "assigned")
    scratch.drop(table)
    digest = {j: ",".join(map(str, c)) for j, c in enumerate(now.centroids.tolist())}
    each = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # k rows
    total = sum(int(r.own) for r in each)
    fits = lambda n: n if n < 1 << 63 else None
    sizes = vectors.sparkSession.createDataFrame([(r.cluster, fits(int(r.own)), fits(total), digest[r.cluster]) for r in each], "cluster int, cluster_inertia long, inertia long, centroid string")
    out = last.join(F.broadcast(sizes), "cluster")
    return out.select(F.col("id").alias(names["id"]), "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"), "calculated")


def oracle(k: int = 16, rounds: int = 3) -> str:
    """DuckDB SQL of `cluster` on embeddings, without the count of calculations."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} as (select vec_id, v.rid, c.k, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from v, c{r} c),
a{r} as (select rid, any_value(vec_id) as vec_id, arg_min(k, d * 1000 + k) as k, min(d) as d from d{r} group by rid)""")
        if r < rounds:
            steps.append(f"""
m{r} as (select k, i, ((s - ((s % n) + n) % n) // n)::bigint as x from (select a.k, i, sum(v.v[i])::bigint as s, count(*) as n from a{r} a join v on v.rid = a.rid, range(1, 65) g(i) group by a.k, i)),
c{r + 1} as (select c.k, coalesce(m.v, c.v) as v from c{r} c left join (select k, list(x order by i) as v from m{r} group by k) m on m.k = c.k)""")
    return f"""
with v as materialized (select vec_id, row_number() over () as rid, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
      from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by sha256('1:' || vec_id)) - 1 as k, v from v qualify k < {k}),{",".join(steps)}
select vec_id, a.k::integer as cluster, d as distance, sum(d) over (partition by a.k)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on c.k = a.k"""
