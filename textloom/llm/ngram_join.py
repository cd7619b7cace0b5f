"""Exact Jaccard self-join on word shingles by a grouped prefix filter.

Documents with the same shingle set form one class, and classes of the same size
whose prefixes are identical form one group. A prefix is the head of a set under a
global order in which frequent shingles come last, longer than the usual one: two
similar sets then share several shingles of their prefixes. Groups, not
documents, post their prefixes. That allows a second cut. Among its posted
shingles each group keeps those that the fewest groups posted, as many as a
similar pair cannot both miss; a group that shares too little with any other
keeps none.

Links are wanted only as components, so blocks (the postings of one shingle, or
the classes of one group) are first tied together through leaders, one for each
block and size band, each link verified exactly. Then all pairs of groups that lie
in different components and that sizes and ranks allow are expanded to pairs of
their classes, and verified, so no link is lost. A block larger than BLOCK is
dealt out in pairs of parts. Before sets travel to be verified, parity marks rule
out the pairs that differ in too many bits, as each such bit takes a shingle.

Sets are compared as 64-bit hashes of shingles; classes and groups are named by a
64-bit hash of the set or prefix with the set's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import text as tx
from .components import connected_components
from .scratch import Scratch, nothing

WIDTH, NUM, DEN = 5, 75, 100
BLOCK = 512  #: postings of one shingle that are paired in one go
LOCAL_COUNT, LOCAL = 4, 1_000_000  #: copies of a shingle among so many at once that mark it as frequent
FREQUENT = 1 << 19  #: frequent shingles at most in the order's table; a shorter one costs time, not links
FILTER_BITS = 1 << 23  #: of the filter of documents whose sets are made again; a fuller one costs time
MARK_BITS = 1024  #: of the parities that bound from below in how many shingles two sets differ
ROW, FILE, PLACE = "__joined_row", "__joined_file", "__joined_place"
FILE_ROWS = 1 << 40  #: row numbers set apart for each file
FEW = 1_000_000  #: row numbers, class names or labelled groups that are broadcast; more are shuffled
MEMBER = -1  #: the salt of rows that name a class' group


def _sets(batch: pa.RecordBatch, width: int):
    """(row numbers, flat sets, begins, class hashes) for slices of a batch (id, text)."""
    for i, j in tx.slices(batch.column(1)):
        h, first = tx.words(batch.column(1).slice(i, j - i))
        flat, begin = tx.distinct_per_row(*tx.shingles(h, first, width))
        del h
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix(flat), dtype=np.uint64)])
        n = np.diff(begin)
        cls = tx.mix((sums[begin[1:]] - sums[begin[:-1]]) ^ (n.astype(np.uint64) << np.uint64(40)))
        yield np.arange(i, j), flat, begin, cls


def _first_rows(cls: np.ndarray, n: np.ndarray) -> np.ndarray:
    at = np.sort(np.unique(cls, return_index=True)[1])
    return at[n[at] > 0]


def _take(flat: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.concatenate([flat[begin[r] : begin[r + 1]] for r in rows]) if len(rows) else flat[:0]


def _signatures(width: int):
    """(id, size, class) of every row with kind 0; (null, copies, shingle) of locally frequent shingles with kind 1."""

    def often(held):
        own = np.sort(np.concatenate(held))
        edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        count = np.diff(edge)
        at = np.flatnonzero(count >= LOCAL_COUNT)
        return pa.record_batch(
            [pa.nulls(len(at), pa.int64()), pa.array(count[at], pa.int64()), pa.array(own[edge[at]].view(np.int64)), pa.array(np.ones(len(at), np.int32))], names=["id", "n", "cls", "kind"]
        )

    def run(batches):
        held, n_held = [], 0
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for rows, flat, begin, cls in _sets(batch, width):
                n = np.diff(begin)
                yield pa.record_batch(
                    [ids.slice(rows[0], len(rows)), pa.array(n, pa.int64()), pa.array(cls.view(np.int64)), pa.array(np.zeros(len(n), np.int32))], names=["id", "n", "cls", "kind"]
                )
                held.append(_take(flat, begin, _first_rows(cls, n)))
                n_held += len(held[-1])
                if n_held > LOCAL:
                    yield often(held)
                    held, n_held = [], 0
        if n_held:
            yield often(held)

    return run


def spare(n):
    """Shingles that the prefixes of two similar sets, the smaller of size n, share at least."""
    return 1 + n // 12


def need(n, num: int, den: int):
    """Shingles that a set of n shares with any similar one at least; also the least size of one."""
    return (n * num + den - 1) // den


def prefix_length(n, num: int, den: int):
    return np.minimum(n, n - need(n, num, den) + spare(n))


def _sql(num: int, den: int, n: str = "n") -> tuple[str, str]:
    """SQL of a size's prefix length, and of the shingles that prefixes share whatever the other's size."""
    least = f"(({n} * {num} + {den - 1}) div {den})"
    return f"least({n}, {n} - {least} + 1 + {n} div 12)", f"(1 + {least} div 12)"


def _name(items: np.ndarray, size: int) -> int:
    """A hash of a set of shingles, in any order, and a size."""
    with np.errstate(over="ignore"):
        return int(tx.mix(np.atleast_1d(tx.mix(items ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) ^ (np.uint64(size) << np.uint64(40))))[0].view(np.int64))


def _postings(width: int, num: int, den: int, frequent):
    """(s, salt, n, grp) for each shingle of a class' prefix, and the class' group as (class, MEMBER, n, grp)."""

    def run(batches):
        keys, counts = frequent.value
        for batch in batches:
            for _, flat, begin, cls in _sets(batch, width):
                size = np.diff(begin)
                out, who, grp = [], [], []
                for r in _first_rows(cls, size):
                    s = flat[begin[r] : begin[r + 1]]
                    p = int(prefix_length(len(s), num, den))
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        hot = keys[at] == s
                        if hot.any():
                            rare = s[~hot]
                            if len(rare) < p:
                                late = np.lexsort((s[hot], counts[at[hot]]))
                                rare = np.concatenate([rare, s[hot][late]])
                            s = rare
                    out.append(s[:p])
                    who.append(r)
                    grp.append(_name(s[:p], int(size[r])))
                if not out:
                    continue
                n, who, grp, flat = np.array([len(x) for x in out]), np.array(who), np.array(grp, np.int64), np.concatenate(out)
                edge = np.unique(grp, return_index=True)[1]  # groups of several classes post once in a slice
                once = np.zeros(len(who), dtype=bool)
                once[edge] = True
                flat = flat[np.repeat(once, n)]
                of, sizes = np.repeat(grp[once], n[once]), np.repeat(size[who][once], n[once])
                salt = np.zeros(len(flat), np.int32)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
                    parts = np.where(keys[at] == flat, counts[at] // BLOCK + 1, 1).astype(np.uint64)
                    salt = np.where(parts > 1, 1 + of.view(np.uint64) % parts, 0).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(np.concatenate([flat.view(np.int64), cls[who].view(np.int64)])), pa.array(np.concatenate([salt, np.full(len(who), MEMBER, np.int32)])),
                     pa.array(np.concatenate([sizes, size[who]]).astype(np.int32)), pa.array(np.concatenate([of, grp]))],
                    names=["s", "salt", "n", "grp"],
                )

    return run


def _groups(batches, keys: int):
    """Columns of batches sorted by their first `keys` columns, each time with whole groups, and the group starts."""
    kept = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if kept is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(kept, cols)]
        if not len(cols[0]):
            continue
        change = np.zeros(len(cols[0]) - 1, dtype=bool)
        for c in cols[:keys]:
            change |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        last = int(starts[-1])
        kept = [c[last:] for c in cols]
        if last:
            yield [c[:last] for c in cols], starts
    if kept is not None and len(kept[0]):
        yield kept, np.array([0, len(kept[0])])
    tx.give_back()


def _shared(batches):
    """Postings that are not alone in their block, with its size, and each class' group once; dealt blocks have salts above 0."""
    for (s, salt, n, grp), starts in _groups(batches, 2):
        same = np.zeros(len(s), dtype=bool)
        same[1:] = (grp[1:] == grp[:-1]) & (n[1:] == n[:-1])
        same[starts[:-1]] = False
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[~same]
        count = np.bincount(group, minlength=len(starts) - 1)
        keep = np.flatnonzero(~same)[(count[group] > 1) | (salt[~same] != 0)]
        if len(keep):
            yield pa.record_batch([pa.array(s[keep]), pa.array(n[keep].astype(np.int64)), pa.array(grp[keep]), pa.array(salt[keep]), pa.array(count[np.searchsorted(starts, keep, "right") - 1])], names=["s", "n", "grp", "salt", "df"])


def _cross(num: int, den: int):
    """Distinct pairs of groups of a task's blocks that are not all in one component and that sizes and ranks allow to link.

    Two similar sets share so many shingles of their prefixes; the first of them in the order has the
    others behind it, so its rank in either prefix is bounded.
    """

    def allowed(n, m, r, q):
        n, m, r, q = n[:, None], m[None, :], r[:, None], q[None, :]
        p, t = prefix_length(n, num, den), prefix_length(m, num, den)
        alpha = ((n + m) * num + num + den - 1) // (num + den)
        both = np.maximum(spare(np.minimum(n, m)), alpha - np.maximum(n - p, m - t))
        return (np.minimum(n, m) * den >= np.maximum(n, m) * num) & (r <= p - both) & (q <= t - both)

    def run(batches):
        found, held = [], 0

        def flush():
            pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found)], 1), axis=0)
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(pairs[:, 2] > 0)], names=["a", "b", "several"])

        for cols, starts in _groups(batches, 3):
            for x, y in zip(starts[:-1], starts[1:]):
                _, i, j, grp, n, lo, hi, many, part, rank = (c[x:y] for c in cols)
                one = i[0] == j[0]
                left = np.arange(len(grp)) if one else np.flatnonzero(part == i[0])
                right = left if one else np.flatnonzero(part == j[0])
                for k in range(0, len(left), BLOCK):
                    some = left[k : k + BLOCK]
                    apart = (lo[some][:, None] != hi[right][None, :]) | (hi[some][:, None] != lo[right][None, :])
                    p, q = np.nonzero(apart & allowed(n[some], n[right], rank[some], rank[right]))
                    p, q = some[p], right[q]
                    if one:
                        p, q = p[grp[p] < grp[q]], q[grp[p] < grp[q]]
                    if not len(p):
                        continue
                    swap = grp[p] > grp[q]
                    found.append((grp[np.where(swap, q, p)], grp[np.where(swap, p, q)], (many[p] | many[q]).astype(np.int64)))
                    held += len(p)
                    if held > 1_000_000:
                        yield flush()
                        found, held = [], 0
        if found:
            yield flush()

    return run


def _mark(items: np.ndarray) -> bytes:
    """For each of MARK_BITS buckets, whether a set has an odd number of shingles there."""
    return np.packbits(np.bincount((items & np.uint64(MARK_BITS - 1)).astype(np.int64), minlength=MARK_BITS) & 1).tobytes()


def _near(num: int, den: int):
    """The pairs (a, b) of (a, b, n, m, x, y) that sizes n, m and marks x, y do not rule out."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(len(n), MARK_BITS // 64) for k in (4, 5))
            both = (n + m - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)) // 2
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(both * den >= num * (n + m - both)))

    return run


def _wanted_sets(width: int, wanted):
    def run(batches):
        bits = wanted.value
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            batch = batch.filter(pa.array(bits[_bucket(ids.fill_null(0).to_numpy(zero_copy_only=False))]))
            ids_of = batch.column(0).cast(pa.int64())
            for at, flat, begin, cls in _sets(batch, width):
                rows = np.flatnonzero(np.diff(begin) > 0)  # a copy may stand before the document that is meant
                own = [flat[begin[r] : begin[r + 1]] for r in rows]
                yield pa.record_batch(
                    [ids_of.take(pa.array(at[rows])), pa.array(cls[rows].view(np.int64)), pa.array([len(s) for s in own], pa.int64()), pa.array([_mark(s) for s in own], pa.binary()), pa.array([s.tobytes() for s in own], pa.binary())],
                    names=["id", "cls", "n", "mark", "items"],
                )

    return run


def _bucket(ids: np.ndarray) -> np.ndarray:
    return (tx.mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _buckets(batches):
    for batch in batches:
        yield pa.record_batch([pa.array(np.unique(_bucket(batch.column(0).to_numpy(zero_copy_only=False))))], names=["bucket"])


def _similar(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(k) for k in range(4))
            keep = np.zeros(len(a), dtype=bool)
            for k in range(len(a)):
                p, q = np.frombuffer(x[k].as_buffer(), np.uint64), np.frombuffer(y[k].as_buffer(), np.uint64)
                small, large = (p, q) if len(p) < len(q) else (q, p)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep[k] = both * den >= num * (len(p) + len(q) - both)
            yield pa.record_batch([a, b], names=["a", "b"]).filter(pa.array(keep))

    return run


def _class_sets(wanted: DataFrame, docs: DataFrame, classes: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """A row (cls, n, mark, items) for each class wanted, made anew from the text of one document.

    More than one row of a class would multiply every pair that names it. Other copies in a bucket are told
    by their ids; only where ids repeat are the sets themselves shuffled.
    """
    wanted = scratch.write(wanted.join(classes, "cls").groupBy("cls").agg(F.min("id").alias("id")), "wanted")
    ids = wanted.select("id")
    buckets = ids.mapInArrow(_buckets, "bucket long").distinct().toArrow().column(0).to_numpy()  # at most FILTER_BITS
    bits = np.zeros(FILTER_BITS, dtype=bool)
    bits[buckets] = True
    sets = docs.mapInArrow(_wanted_sets(width, docs.sparkSession.sparkContext.broadcast(bits)), "id long, cls long, n long, mark binary, items binary")
    sets = scratch.write(sets.join(_small(wanted), ["cls", "id"], "left_semi").drop("id"), "sets")
    if sets.count() == wanted.count():
        return sets
    once = scratch.write(sets.dropDuplicates(["cls"]), "sets")
    scratch.drop(sets)
    return once


def _small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if its rows, of a few longs each, are counted as FEW at most."""
    return F.broadcast(table) if table.count() <= FEW else table


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of classes that link; `pairs` is a written table. Only marks of the sets that it names travel, and sets that marks leave in question."""

    def beside(pairs: DataFrame, *columns: str) -> DataFrame:
        ends = {end: _small(pairs.select(end).distinct()) for end in ("a", "b")}
        for end, named in ends.items():
            own = sets.select(F.col("cls").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
            pairs = pairs.join(own.join(named, end, "left_semi"), end)
        return pairs.select("a", "b", *[f"{c}_{end}" for c in columns for end in ("a", "b")])

    near = scratch.write(beside(pairs.select("a", "b"), "n", "mark").mapInArrow(_near(num, den), "a long, b long"), "near")
    return beside(near, "items").mapInArrow(_similar(num, den), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, num: int = NUM, den: int = DEN, scratch: Scratch | None = None
) -> DataFrame:
    """Components of documents whose shingle sets have Jaccard similarity num/den or more.

    Returns a row for each input row: id_col, n_shingles long, component_id long
    (the smallest id reached by links, itself included), kept boolean (it is the
    smallest). Null or wordless texts have n_shingles 0 and link with nothing. Each row
    is a document of its own, repeated ids too; rows with a null id take part in no link
    and have a null component. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "ngram-join")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with_id = docs.where("id is not null")
    seen = scratch.write(with_id.mapInArrow(_signatures(width), "id long, n long, cls long, kind int"), "signatures")
    rows = seen.where("kind = 0").select("id", "n", "cls")
    classes = scratch.write(rows.where("n > 0").groupBy("cls", "n").agg(F.min("id").alias("id")), "classes")
    often = seen.where("kind = 1").groupBy("cls").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "cls").limit(FREQUENT).toArrow()
    keys, counts = (often.column(k).to_numpy() for k in (0, 1))
    order = np.argsort(keys.view(np.uint64))
    frequent = spark.sparkContext.broadcast((keys.view(np.uint64)[order], counts[order]))

    prefix, common = _sql(num, den)
    posts = with_id.mapInArrow(_postings(width, num, den, frequent), "s long, salt int, n int, grp long")
    posts = posts.repartition("s", "salt").sortWithinPartitions("s", "salt", "n", "grp")
    posts = scratch.write(posts.mapInArrow(_shared, "s long, n long, grp long, salt int, df long"), "shared")
    members = posts.where(f"salt = {MEMBER}").select(F.col("s").alias("cls"), "grp")
    # a shingle whose block is whole has its count by now; those of dealt blocks are added up
    dealt = posts.where("salt > 0").drop("salt", "df")
    dealt = dealt.join(dealt.groupBy("s").agg(F.count("*").alias("df")), "s").where("df > 1")
    shared = posts.where("salt = 0").select("s", "n", "grp", "df").union(dealt.select("s", "n", "grp", "df"))
    rank = F.row_number().over(W.partitionBy("grp").orderBy("df", "s"))
    own = F.count("*").over(W.partitionBy("grp"))  # all other shingles of the prefix are the group's alone
    kept = shared.withColumn("rank", rank).withColumn("own", own)
    kept = kept.where(F.expr(f"rank <= own - {common} + 1")).select("s", "grp", "n", F.expr(f"{prefix} - own + rank - 1").alias("rank"), F.expr(f"own / {prefix}").alias("common"))
    kept = scratch.write(kept, "kept")
    several = members.groupBy("grp").agg(F.count("*").alias("k")).where("k > 1").select("grp")
    wanted = members.join(kept.select("grp").union(several).distinct(), "grp", "left_semi")
    members = scratch.write(wanted, "members")
    scratch.drop(posts)
    sets = _class_sets(members.select("cls"), with_id, classes, width, scratch)

    links = nothing(spark, "a long, b long")
    comps = nothing(spark, "vertex long, component long")

    tested = []

    def untested(pairs: DataFrame) -> DataFrame:
        """The pairs that lie in different components and were not compared before."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for t in tested:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        for end in ("a", "b") if tested else ():
            pairs = pairs.join(comps.select(F.col("vertex").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
        if tested:
            pairs = pairs.where("coalesce(of_a, a) <> coalesce(of_b, b)")
        tested.append(scratch.write(pairs.select("a", "b"), "pairs"))
        return tested[-1]

    def named() -> DataFrame:
        """Members with their components."""
        return members.join(comps.withColumnRenamed("vertex", "cls"), "cls", "left").select("grp", "cls", F.coalesce("component", "cls").alias("comp"))

    band = F.floor(F.log(F.col("n")) / F.lit(float(np.log(den / num)))).cast("int")
    for leaders in (2, 4):
        own = scratch.write(named(), "named")
        # groups by a class of theirs, and by the components that they lie in
        groups = own.groupBy("grp").agg(F.min("cls").alias("rep"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), *[F.min_by("cls", F.xxhash64("cls", F.lit(100 * leaders + r))).alias(f"head{r}") for r in range(leaders)])
        groups = scratch.write(groups, "groups")
        mixed = groups.where("lo <> hi").select("grp", F.explode(F.array_distinct(F.array(*[f"head{r}" for r in range(leaders)]))).alias("b"))
        inner = own.select("grp", F.col("cls").alias("a")).join(mixed, "grp").where("a <> b").select("a", "b")
        labelled = kept.join(_small(groups.select("grp", "rep", "lo", "hi")), "grp").withColumn("band", band).select("s", "rep", "n", "lo", "hi", "band", "common")
        # the group with most in common with others leads, then some at random
        heads = [F.max_by("rep", F.expr("shiftleft(cast(common * 1000 as long), 53) + shiftrightunsigned(rep, 11)")).alias("lead0")]
        for r in range(1, leaders):
            salt = F.xxhash64(F.lit(10 * leaders + r))  # names are hashes, so any bits flipped make an order at random
            heads.append(F.min(F.col("rep").bitwiseXOR(salt)).bitwiseXOR(salt).alias(f"lead{r}"))
        blocks = labelled.groupBy("s", "band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *heads).where("lo <> hi").drop("lo", "hi")
        tied = labelled.join(blocks, ["s", "band"]).select("rep", "n", F.explode(F.array(*[f"lead{r}" for r in range(leaders)])).alias("lead"))
        stars = tied.where("rep <> lead").groupBy("rep", "lead", "n").agg(F.count("*").alias("c")).where(F.expr(f"c * 8 >= {prefix}"))
        pairs = stars.select(F.col("rep").alias("a"), F.col("lead").alias("b")).union(inner)
        more = scratch.write(_verified(untested(pairs), sets, num, den, scratch), "links")
        links = links.union(more)
        comps = scratch.write(connected_components(links, scratch), "components")
        del labelled, blocks, tied, stars, pairs, inner, mixed
        scratch.drop(own, groups)
        if more.isEmpty():
            break

    own = scratch.write(named(), "named")
    groups = own.groupBy("grp").agg(F.min("cls").alias("rep"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), (F.count("*") > 1).alias("many"))
    groups = scratch.write(groups, "groups")
    labelled = kept.join(_small(groups), "grp").select("s", "rep", "n", "lo", "hi", "many", "rank")
    blocks = labelled.groupBy("s").agg(F.count("*").alias("df"), F.min("lo").alias("l"), F.max("hi").alias("h")).where("l <> h")
    parts = F.ceil(F.col("df") / BLOCK).cast("int")
    dealt = (
        labelled.join(blocks.select("s", parts.alias("parts")), "s")
        .withColumn("part", F.pmod("rep", "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("s", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "rep", "n", "lo", "hi", "many", "part", "rank")
    )
    dealt = dealt.repartition("s", "i", "j").sortWithinPartitions("s", "i", "j")
    cross = dealt.mapInArrow(_cross(num, den), "a long, b long, several boolean")
    cross = cross.union(groups.where("lo <> hi").select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(True)))
    cross = scratch.write(cross.distinct(), "cross")
    del labelled, blocks, dealt
    scratch.drop(kept)
    # pairs of groups are expanded to pairs of their classes; a group of one class goes by its name
    inside = own.join(groups.select("grp", "rep"), "grp")
    left, right = (inside.select(F.col("rep").alias(g), F.col("cls").alias(f"cls_{g}"), F.col("comp").alias(f"comp_{g}")) for g in ("a", "b"))
    pairs = cross.where("several").join(left, "a").join(right, "b").where("comp_a <> comp_b and (a <> b or cls_a < cls_b)")
    pairs = pairs.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).union(cross.where("not several").select("a", "b"))
    links = links.union(scratch.write(_verified(untested(pairs), sets, num, den, scratch), "links"))
    comps = scratch.write(connected_components(links, scratch), "components")
    del pairs
    del inside, left, right
    scratch.drop(sets, own, groups, cross)

    found = classes.join(comps.withColumnRenamed("vertex", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls"))
    lowest = found.groupBy("comp").agg(F.min("id").alias("component_id"))
    found = found.join(lowest, "comp").select("cls", F.col("n").alias("class_n"), "component_id")
    out = rows.join(found, (rows.cls == found.cls) & (rows.n == found.class_n), "left").select(
        rows.id.alias(id_col), rows.n.alias("n_shingles"), F.coalesce("component_id", rows.id).alias("component_id")
    )
    lost = docs.where("id is null").mapInArrow(_signatures(width), "id long, n long, cls long, kind int").where("kind = 0")
    out = out.union(lost.select("id", "n", F.lit(None).cast("long")))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """`docs` with ROW, a number that stays with its row whenever the table is computed anew.

    Rows of Parquet files are told by file and place, of other tables by a written copy.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or not plan.simpleString(1).endswith(" parquet"):
        return scratch.write(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    place = docs.metadataColumn("_metadata")
    found = docs.select("*", place.getField("file_path").alias(FILE), place.getField("row_index").alias(PLACE))
    files = found.select(FILE).distinct().withColumn(ROW, F.row_number().over(W.orderBy(FILE)) * F.lit(FILE_ROWS))
    files = _small(scratch.write(files, "files"))
    return found.join(files, FILE).withColumn(ROW, F.col(ROW) + F.col(PLACE)).select(*docs.columns, ROW)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, unchanged, that are alone or the first of their group of near copies.

    The first has the smallest id, null ids last; rows of equal ids are told apart. Wordless rows all stay.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    rows = _numbered(docs, scratch)
    work = Scratch(docs.sparkSession, "ngram-join")
    found = near_duplicates(rows, ROW, text_col, scratch=work).select(ROW, "component_id").join(rows.select(ROW, F.col(id_col).alias("__id")), ROW)
    found = scratch.write(found, "components")
    work.clear()
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("__id").isNull(), "__id", ROW)).alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    copies = scratch.write(found.select(ROW).join(first, ROW, "left_anti"), "copies")
    return rows.join(_small(copies), ROW, "left_anti").select(*docs.columns)  # texts need not be shuffled for few
