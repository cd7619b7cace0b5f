"""Near-duplicate vectors by product quantisation over inverted lists.

A coarse quantiser and subspace codebooks are fitted on a bounded sample. Every
vector is put into the list of its nearest centroid, with a residual code and
the code's own error. Lists grow in number with the vectors of a label, so that a
list's length and with it the work of a probe stays the same.

A vector within the radius of a query can only lie in a list whose bisecting plane
is within the radius of the query. In many dimensions it comes near that bound
only if the two differ along one line; PROBED standard deviations of a difference of
random direction are probed, which is the whole radius for up to PROBED ** 2
dimensions. A table-lookup distance can exceed the radius by no more than the
code's error. What passes is compared by exact cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, connected_components
from .ngram_join import _groups
from .scratch import Scratch

COSINE = 0.98
SAMPLE = 131_072  #: vectors that the quantisers are fitted on, at most
LIST, MOST_LISTS = 128, 4096  #: vectors of a label in a list, about; lists at most
PER_LIST = 32  #: fitted vectors for each list
SUBSAMPLE = 16_384  #: of them, those that the codebooks are fitted on
SUBSPACES, CODES = 8, 64
PROBED = 4.0  #: standard deviations
PART = 2048  #: vectors of one list that are compared in one go
SMALL = 100_000  #: blocks larger than PART at most, for their table to be broadcast
SLACK = 1e-6


@dataclass
class Quantiser:
    dim: int
    coarse: np.ndarray  #: lists x dim
    books: list[np.ndarray]  #: for each subspace, codes x its dimensions
    cuts: np.ndarray  #: subspace borders

    def __post_init__(self):
        self.apart = np.sqrt(np.maximum(_squares(self.coarse, self.coarse), 0))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and code error of each unit vector."""
        at = _nearest(x, self.coarse)
        rest = x - self.coarse[at]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for m, book in enumerate(self.books):
            part = rest[:, self.cuts[m] : self.cuts[m + 1]]
            codes[:, m] = _nearest(part, book)
            error += ((part - book[codes[:, m]]) ** 2).sum(1)
        return at, codes, np.sqrt(error)

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for every list whose bisecting plane is within `radius` of a row's vector."""
        far, apart = _squares(x, self.coarse), self.apart
        gap = far - far[np.arange(len(x)), own][:, None]
        near = gap <= 2 * apart[own] * (radius + SLACK) + SLACK
        near[np.arange(len(x)), own] = True
        return np.nonzero(near)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    k = max(1, min(k, len(x)))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, centres)
        n = np.bincount(at, minlength=k)
        for d in range(x.shape[1]):
            sums = np.bincount(at, weights=x[:, d], minlength=k)
            centres[n > 0, d] = sums[n > 0] / n[n > 0]
    return centres


def fit(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> Quantiser:
    rng = np.random.default_rng(11)
    dim = sample.shape[1]
    coarse = _kmeans(sample, min(lists, max(1, len(sample) // PER_LIST)), rng)
    sample = sample[:SUBSAMPLE]
    rest = sample - coarse[_nearest(sample, coarse)]
    cuts = np.linspace(0, dim, min(subspaces, dim) + 1).astype(int)
    books = [_kmeans(rest[:, a:b], codes, rng) for a, b in zip(cuts[:-1], cuts[1:])]
    return Quantiser(dim, coarse, books, cuts)


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are whole, finite, not zero and of `dim` components, and their values."""
    column = column.cast(pa.list_(pa.float64()))
    ok = np.zeros(len(column), dtype=bool)
    offsets = np.asarray(column.offsets)
    flat = column.values
    hole = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.asarray(flat.is_valid()), out=hole[1:])
    values = np.asarray(flat.fill_null(0.0))
    valid = np.asarray(column.is_valid())
    ok = valid & (np.diff(offsets) == dim) & (hole[offsets[1:]] == hole[offsets[:-1]])
    at = offsets[:-1][ok]
    x = values[at[:, None] + np.arange(dim)] if len(at) else np.zeros((0, dim))
    fine = np.isfinite(x).all(1) & (x != 0).any(1)
    rows, x = np.flatnonzero(ok)[fine], x[fine]
    # a power of two changes no cosine, and keeps squares within range
    most = np.abs(x).max(1, initial=0)
    scale = np.where((most > 1e100) | (most < 1e-100), -np.frexp(most)[1], 0)
    return rows, np.ldexp(x, scale[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _packed(x: np.ndarray, single: bool) -> list[bytes]:
    """Values without negative zeros; in single precision where the table's are."""
    return [v.tobytes() for v in (x + 0.0).astype(np.float32 if single else np.float64)]


def _unpacked(blobs, dim: int, single: bool) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float32 if single else np.float64).reshape(-1, dim).astype(np.float64)


def _valid(dim: int, single: bool):
    """(row, label, class bytes) of the vectors that may link."""

    def run(batches):
        for batch in batches:
            rows, x = _matrix(batch.column(2), dim)
            blob = _packed(x, single)
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(blob, pa.binary())], names=["row", "label", "v"])

    return run


def _dealt(quantiser, radius: float, single: bool):
    """A row for each vector in its own list (resident) and in each list it must probe."""

    def run(batches):
        q: Quantiser = quantiser.value
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                x = _unit(_unpacked(part.column(2).to_pylist(), q.dim, single))
                own, codes, error = q.assign(x)
                row, lists = q.probes(x, own, radius)
                pick = pa.array(np.concatenate([np.arange(len(x)), row]))
                resident = np.arange(len(x) + len(row)) < len(x)
                blob = [c.tobytes() for c in codes] + [None] * len(row)
                yield pa.record_batch(
                    [part.column(0).take(pick), part.column(1).take(pick), pa.array(np.concatenate([own, lists]).astype(np.int32)), pa.array(resident),
                     part.column(2).take(pick), pa.array(blob, pa.binary()), pa.array(np.concatenate([error, np.zeros(len(row))])), part.column(3).take(pick)],
                    names=["cls", "label", "list", "resident", "v", "codes", "error", "copies"],
                )

    return run


def _linked(quantiser, cosine: float, single: bool):
    """For each probe, how many vectors link with it; and spanning edges of the links of a block."""

    def run(batches):
        q: Quantiser = quantiser.value
        radius = np.sqrt(2 - 2 * cosine) + SLACK
        for cols, starts in _groups(batches, 4):
            for s, e in zip(starts[:-1], starts[1:]):
                _, at, _, _, resident, cls, blob, codes, error, copies = (c[s:e] for c in cols)
                home, probe = np.flatnonzero(resident), np.flatnonzero(~resident)
                if not len(home) or not len(probe):
                    continue
                x = _unpacked(blob, q.dim, single)
                norm = np.sqrt((x * x).sum(1))
                code = np.frombuffer(b"".join(codes[home]), np.uint8).reshape(-1, len(q.books))
                bound = (radius + error[home]) ** 2 + SLACK
                n, left, right = np.zeros(len(probe), np.int64), [], []
                for k in range(0, len(probe), 256):
                    some = probe[k : k + 256]
                    rest = x[some] / norm[some][:, None] - q.coarse[at[0]]
                    far = np.zeros((len(some), len(home)))
                    for m, book in enumerate(q.books):
                        far += _squares(rest[:, q.cuts[m] : q.cuts[m + 1]], book)[:, code[:, m]]
                    p, h = np.nonzero(far <= bound[None])
                    p, h = some[p], home[h]
                    keep = cls[p] != cls[h]
                    p, h = p[keep], h[keep]
                    for c in range(0, len(p), 1 << 16):
                        a, b = p[c : c + (1 << 16)], h[c : c + (1 << 16)]
                        same = (x[a] * x[b]).sum(1) / (norm[a] * norm[b]) >= cosine
                        a, b = a[same], b[same]
                        np.add.at(n, np.searchsorted(probe, a), copies[b])
                        left.append(cls[a])
                        right.append(cls[b])
                forest = Forest()
                ends = zip(np.concatenate(left).tolist(), np.concatenate(right).tolist()) if left else ()
                edges = [(a, b) for a, b in ends if forest.join(a, b)]
                some = n > 0
                a = np.concatenate([cls[probe][some], np.array([x for x, _ in edges], np.int64)])
                b = pa.array([None] * int(some.sum()) + [y for _, y in edges], pa.int64())
                yield pa.record_batch([pa.array(a), b, pa.array(np.concatenate([n[some], np.zeros(len(edges), np.int64)]))], names=["a", "b", "n"])

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, sample: int = SAMPLE
) -> DataFrame:
    """id_col, n_links, component_id (smallest id reached by links, itself included), kept; a row for each input row.

    Rows link when their vectors are of one length, their labels are equal and not null and their cosine, in double
    precision, is `cosine` or more. Null, empty, zero, non-finite and holed vectors link with nothing. Equal vectors
    of a label are compared once, as a class. Repeated ids are rows of their own; a null id has a null component.
    Clashing columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding-dedup")
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    rows = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    ids = rows.select("row", "id")
    whole = None
    lengths = rows.where("id is not null and label is not null and size(v) > 0").groupBy(F.size("v").alias("dim")).agg(F.countDistinct("label").alias("labels"))
    for dim, labels in lengths.orderBy("dim").collect():  # lengths of vectors, few
        own = _linked_rows(rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") == dim)), dim, labels, single, cosine, sample, scratch)
        whole = own if whole is None else whole.union(own)
    if whole is None:
        return ids.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    out = ids.join(whole, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _linked_rows(rows: DataFrame, dim: int, labels: int, single: bool, cosine: float, sample: int, scratch: Scratch) -> DataFrame:
    """(row, n_links, component_id) of the vectors of one length that may link."""
    spark = rows.sparkSession
    label = rows.schema["label"].dataType.simpleString()
    valid = rows.select("row", "label", "v").mapInArrow(_valid(dim, single), f"row long, label {label}, v binary")
    named = scratch.write(valid.join(rows.select("row", "id"), "row").withColumn("sum", F.sha2("v", 256)), "valid")
    classes = named.groupBy("label", "sum").agg(F.min("row").alias("cls"), F.count("*").alias("copies"))
    members = scratch.write(named.select("row", "id", "label", "sum").join(classes, ["label", "sum"]).select("row", "id", "cls", "copies"), "members")
    reps = scratch.write(named.join(members.where("row = cls").select("row", "copies"), "row").select(F.col("row").alias("cls"), "label", "v", "copies"), "classes")
    scratch.drop(named)
    total = reps.count()
    lists = max(1, min(MOST_LISTS, total // (LIST * max(1, labels))))
    picked = reps.orderBy(F.xxhash64("cls"), "cls").limit(max(CODES * PER_LIST, min(sample, lists * PER_LIST))).select("v").toArrow().column(0).to_pylist()  # `sample` rows at most
    nothing = members.select("row", (F.col("copies") - 1).alias("n_links"), F.col("id").alias("component_id"))
    if not picked:
        return nothing
    quantiser = spark.sparkContext.broadcast(fit(_unit(_unpacked(picked, dim, single)), lists))
    radius = float(np.sqrt(2 - 2 * cosine))
    probed = radius * min(1.0, PROBED / np.sqrt(dim))
    dealt = reps.mapInArrow(_dealt(quantiser, probed, single), f"cls long, label {label}, list int, resident boolean, v binary, codes binary, error double, copies long")
    dealt = scratch.write(dealt, "dealt")
    count = dealt.groupBy("label", "list").agg(F.count(F.when(F.col("resident"), 1)).alias("homes"), F.count(F.when(~F.col("resident"), 1)).alias("asks"))
    large = count.where(f"homes > {PART} or asks > {PART}").select("label", "list", F.ceil(F.col("homes") / PART).cast("int").alias("hp"), F.ceil(F.col("asks") / PART).cast("int").alias("ap"))
    large = scratch.write(large, "large")
    parts = dealt.join(F.broadcast(large) if large.count() <= SMALL else large, ["label", "list"], "left").fillna(1, ["hp", "ap"])
    own = F.pmod(F.xxhash64("cls"), F.when(F.col("resident"), F.col("hp")).otherwise(F.col("ap"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.when(F.col("resident"), F.col("ap")).otherwise(F.col("hp")) - 1, F.lit(0))))
    parts = parts.withColumn("own", own).withColumn("other", other)
    parts = parts.select(
        F.xxhash64("label").alias("key"), "list", F.when(F.col("resident"), F.col("own")).otherwise(F.col("other")).alias("hp"),
        F.when(F.col("resident"), F.col("other")).otherwise(F.col("own")).alias("ap"), "resident", "cls", "v", "codes", "error", "copies",
    ).repartition("key", "list", "hp", "ap").sortWithinPartitions("key", "list", "hp", "ap")
    found = scratch.write(parts.mapInArrow(_linked(quantiser, cosine, single), "a long, b long, n long"), "found")
    scratch.drop(dealt)
    links = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("b is not null").select("a", "b"), scratch).withColumnRenamed("vertex", "cls")
    whole = members.join(links, "cls", "left").join(comps, "cls", "left").withColumn("comp", F.coalesce("component", "cls"))
    lowest = whole.groupBy("comp").agg(F.min("id").alias("component_id"))
    return whole.join(lowest, "comp").select("row", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
