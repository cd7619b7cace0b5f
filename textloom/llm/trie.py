"""The prefix trie of conversations, with subtree sums by heavy-path decomposition.

A node is named by its prefix: a polynomial of turn digests modulo 2**127 - 1, folded along a
conversation by `scan`. The largest child of a node (most members, then the smallest
conversation) continues its path; every other child heads a path of its own. A light child has at
most half of its parent's members, so a node has at most log2(conversations) light
nodes above it. Paths are taken by that number, deepest first: their values are
summed from the end along arrays of BLOCK nodes, and what a path's head has gathered
is added to the head's parent, which lies on a path of the next round.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scan import Fold, scan
from .scratch import Scratch

PRIME = (1 << 127) - 1
POINT = int.from_bytes(hashlib.sha256(b"prefix").digest(), "big") % PRIME
ROOT = (1).to_bytes(16, "big")
BLOCK = 1024  #: nodes of a path in one array
IDS = 4096  #: ids joined to one string
SHARED, SHIFT = 20, 4  #: conversations whose heads are shared, and the modulus of how many turns
MOST_HOT = 50_000  #: names broadcast at most: nodes with more than 1 / MOST_HOT of all rows as members
EMPTY = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def _digest(role: Column, text: Column) -> Column:
    """128 bits of a turn; the length keeps role and text apart."""
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def ordered_turns(turns: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(key, i, digest, words): each conversation's turns numbered from 1, their texts as digests."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("key"), F.col(turn_col).alias("turn"), role.alias("role"), _digest(role, text).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    number = Fold("i long", lambda _: (1,), lambda a, b: (a[0] + b[0],))
    return scratch.write(scan(rows, ["turn", "role", "digest"], ["words"], number, scratch, "turns").select("key", "i", "digest", "words", "last"), "ordered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (key, part, i, digest, words), and all conversations (key, turns of their own).

    Conversation c gets the first h turns of conversation c - c % 20, h being crc32(c) % 4, and then its own after the first h.
    """
    group, head = F.col("key") - F.col("key") % SHARED, F.crc32(F.col("key").cast("string").cast("binary")) % SHIFT
    every = turns.where("last").select("key", F.col("i").alias("own"))
    heads = turns.where((F.col("i") < SHIFT) & (F.col("key") % SHARED == 0)).select(F.col("key").alias("from"), "i", "digest", "words")
    taken = every.select("key", group.alias("from"), head.alias("h")).join(heads, "from").where("i <= h").select("key", F.lit(0).alias("part"), "i", "digest", "words")
    own = turns.where(F.col("i") > head).select("key", F.lit(1).alias("part"), "i", "digest", "words")
    return taken.unionByName(own), every


def _chain() -> Fold:
    def unit(digest):
        return 1, POINT.to_bytes(16, "big"), (int.from_bytes(digest, "big") % PRIME).to_bytes(16, "big"), digest

    def join(a, b):
        x, y = int.from_bytes(a[1], "big"), int.from_bytes(b[1], "big")
        return a[0] + b[0], (x * y % PRIME).to_bytes(16, "big"), ((int.from_bytes(a[2], "big") * y + int.from_bytes(b[2], "big")) % PRIME).to_bytes(16, "big"), b[3]

    return Fold("depth long, power binary, value binary, latest binary", unit, join)


def _named(batches):
    """Names of a prefix and of the one before it, from the folded value."""
    back = pow(POINT, -1, PRIME)
    for b in batches:
        node, parent = [], []
        for power, value, latest in zip(b.column("power").to_pylist(), b.column("value").to_pylist(), b.column("latest").to_pylist()):
            name = (int.from_bytes(power, "big") + int.from_bytes(value, "big")) % PRIME  # the root is 1
            node.append(name.to_bytes(16, "big"))
            parent.append(((name - int.from_bytes(latest, "big")) * back % PRIME).to_bytes(16, "big"))
        columns = [b.column("key"), b.column("depth"), pa.array(node, pa.binary()), pa.array(parent, pa.binary()), b.column("words"), b.column("last")]
        yield pa.record_batch(columns, names=["key", "depth", "node", "parent", "words", "last"])


def _joined_ids(batches):
    """Strings of up to IDS ids of a node, in order; rows come sorted by node and id."""
    node, ids = None, []

    def flush():
        return pa.record_batch([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

    for b in batches:
        for own, key in zip(b.column("node").to_pylist(), b.column("key").to_pylist()):
            if ids and (own != node or len(ids) >= IDS):
                yield flush()
                ids = []
            node = own
            ids.append(key)
    if ids:
        yield flush()


def _hashed_ids(batches):
    """The digest of each node's strings, which come sorted; only the running digest is kept."""
    node, running = None, None
    for b in batches:
        out = []
        for own, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
            if running is not None and own == node:
                running.update(b",")
            else:
                if running is not None:
                    out.append((node, running.hexdigest()))
                node, running = own, hashlib.sha256()
            running.update(ids.encode())
        yield pa.record_batch([pa.array([n for n, _ in out], pa.binary()), pa.array([h for _, h in out], pa.string())], names=["node", "ends_sha256"])
    if running is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends_sha256"])


def ends_digests(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, ends_sha256) of ends (node, key): ids are sorted and joined in ranges, so that a node with many is worked out by many tasks."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strings = ends.repartitionByRange(n, "node", "key").sortWithinPartitions("node", "key").mapInArrow(_joined_ids, "node binary, first long, ids string")
    return strings.repartition(n, "node").sortWithinPartitions("node", "first").mapInArrow(_hashed_ids, "node binary, ends_sha256 string")


def _suffix_sums(batches):
    """Sums from each place to the end of an array, plus what lies behind it."""
    for b in batches:
        out = [b.column("conv"), b.column("depth")]
        flat = lambda c: np.asarray(b.column(c).flatten()).astype(np.int64)
        sizes = np.asarray(b.column("leaves").value_lengths()).astype(np.int64)
        ends = np.cumsum(sizes)
        for c in ("leaves", "saved"):
            sums = np.concatenate([[0], np.cumsum(flat(c))])
            behind = np.asarray(b.column(f"{c}_behind")).astype(np.int64)
            out.append(pa.array(np.repeat(sums[ends] + behind, sizes) - sums[:-1], pa.int64()))
        yield pa.record_batch([out[0].flatten(), out[1].flatten(), *out[2:]], names=["conv", "depth", "leaves", "saved"])


def _along_paths(nodes: DataFrame) -> DataFrame:
    """(conv, depth, leaves, saved) summed from each node to the end of its path; nodes: head_conv, head_depth, conv, depth, leaves, saved."""
    block = F.floor(F.col("depth") / BLOCK).alias("block")
    own = F.sort_array(F.collect_list(F.struct("depth", "conv", "leaves", "saved"))).alias("own")  # BLOCK structs at most
    arrays = nodes.groupBy("head_conv", "head_depth", block).agg(own, F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    behind = W.partitionBy("head_conv", "head_depth").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    arrays = arrays.select(
        *[F.col(f"own.{c}").alias(c) for c in ("conv", "depth", "leaves", "saved")],
        *[F.coalesce(F.sum(f"all_{c}").over(behind), F.lit(0)).cast("long").alias(f"{c}_behind") for c in ("leaves", "saved")],
    )
    return arrays.mapInArrow(_suffix_sums, "conv long, depth long, leaves long, saved long")


def subtree_sums(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, depth, n_leaves, saved_tokens) of every node's subtree, its top included.

    nodes: conv and depth (a node's key), parent_conv, head_conv and head_depth (its path's head), level (light nodes from the root
    to it), leaf and saved (its own values).
    """
    table = scratch.write(nodes, "paths", "level")
    levels = sorted((r.level for r in table.select("level").distinct().collect()), reverse=True)  # log2 of the conversations
    gathered, done = None, []
    for level in levels:
        own = table.where(F.col("level") == level).select("conv", "depth", "parent_conv", "head_conv", "head_depth", F.col("leaf").alias("leaves"), "saved")
        if gathered is not None:
            own = own.join(gathered, ["conv", "depth"], "left").withColumns({c: F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0)) for c in ("leaves", "saved")})
        sums = scratch.write(_along_paths(own), f"level{level}")
        done.append(sums)
        heads = table.where((F.col("level") == level) & (F.col("depth") == F.col("head_depth")) & (F.col("depth") > 0)).select("conv", "depth", "parent_conv")
        up = sums.join(heads, ["conv", "depth"]).groupBy(F.col("parent_conv").alias("conv"), (F.col("depth") - 1).alias("depth"))
        gathered = up.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    out = done[0]
    for sums in done[1:]:
        out = out.unionByName(sums)
    return out.select("conv", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def _places() -> Fold:
    """Along a conversation: light nodes so far, the last of them (its smallest member and depth), and the smallest member of the node before."""

    def unit(light, low, depth):
        return (1, low, depth, None, low) if light else (0, None, None, None, low)

    def join(a, b):
        head = (b[1], b[2]) if b[1] is not None else (a[1], a[2])
        # b of one row has no row before it yet: a's last one is
        return a[0] + b[0], *head, b[3] if b[3] is not None else a[4], b[4]

    return Fold("level int, head_conv long, head_depth long, parent_conv long, low_here long", unit, join)


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each node of the rebuilt conversations' trie: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by turn (null first), then role, then digest; null roles and texts read as empty, repeated rows are
    turns of their own. Rows without a conversation are left out. A conversation left without turns belongs to
    the root alone. Other columns are not read. An empty table has no nodes, not even the root.
    """
    spark = turns.sparkSession
    scratch = Scratch(spark, "trie")
    ordered = ordered_turns(turns, scratch, conv_col, turn_col, role_col, text_col)
    rows, every = rebuilt(ordered)
    chain = scan(rows, ["part", "i"], ["digest"], _chain(), scratch, "chain")
    rows = scratch.write(chain.mapInArrow(_named, "key long, depth long, node binary, parent binary, words long, last boolean"), "rows")
    top = every.agg(F.count("*"), F.min("key")).first()
    if not top[0]:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    root = spark.createDataFrame([(bytearray(ROOT), 0, top[0], top[1], 0, None)], "node binary, depth long, n_convs long, low long, words long, parent binary")
    nodes = rows.groupBy("node").agg(F.first("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("key").alias("low"), F.first("words").alias("words"), F.first("parent").alias("parent"))
    nodes = scratch.write(nodes.select(*root.columns).union(root), "nodes")

    children = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"), F.max(F.struct("n_convs", (-F.col("low")).alias("least"))).alias("largest"))
    children = scratch.write(children, "children")
    # the largest child is known by its smallest member and its depth; so is every node
    heavy = children.join(nodes.select(F.col("node").alias("parent"), F.col("depth").alias("above")), "parent").select((-F.col("largest.least")).alias("low"), (F.col("above") + 1).alias("depth"), F.lit(True).alias("heavy"))
    flagged = nodes.join(heavy, ["low", "depth"], "left").join(children.select(F.col("parent").alias("node"), "n_children"), "node", "left")
    flagged = scratch.write(flagged.select("node", "depth", "n_convs", "low", "words", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.coalesce(~F.col("heavy"), F.lit(True)).alias("light")), "flagged")

    # members of much-shared nodes are most of the rows: their names are few, as members add up to the rows
    total = rows.count()
    hot = max(1000, total // MOST_HOT)
    names = flagged.where("depth > 0").select("node", "low", "light", (F.col("n_convs") > hot).alias("hot"))
    often = F.broadcast(names.where("hot").select("node", F.struct("low", "light").alias("often")))
    placed = rows.select("key", "depth", "node").join(often, "node", "left")
    seldom = placed.where("often is null").drop("often").join(names.where("not hot").select("node", "low", "light"), "node")
    placed = placed.where("often is not null").select("node", "key", "depth", "often.low", "often.light").unionByName(seldom)
    placed = scan(placed.select("key", "depth", "low", "light"), ["depth"], ["light", "low", "depth"], _places(), scratch, "placed").where("key = low")
    head = F.col("head_conv").isNotNull()
    paths = placed.select(
        F.col("key").alias("conv"), "depth", F.coalesce("parent_conv", F.lit(top[1])).alias("parent_conv"), F.coalesce("head_conv", F.lit(top[1])).alias("head_conv"),
        F.when(head, F.col("head_depth")).otherwise(0).cast("long").alias("head_depth"), "level",
    )
    start = spark.createDataFrame([(top[1], 0, None, top[1], 0, 0)], "conv long, depth long, parent_conv long, head_conv long, head_depth long, level int")
    own = flagged.select(F.col("low").alias("conv"), "depth", "node", "n_convs", "n_children", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    paths = scratch.write(paths.unionByName(start).join(own, ["conv", "depth"]), "joined")
    sums = subtree_sums(paths.select("conv", "depth", "parent_conv", "head_conv", "head_depth", "level", "leaf", "saved"), scratch)
    turnless = every.select("key").join(rows.where("last").select("key"), "key", "left_anti").select(F.lit(bytearray(ROOT)).alias("node"), "key")
    ends = ends_digests(rows.where("last").select("node", "key").unionByName(turnless), scratch)
    out = paths.select("conv", "depth", "node", "parent_conv", "n_convs", "n_children").join(sums, ["conv", "depth"]).join(ends, "node", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


ORACLE = rf"""
with o as materialized (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i
      from conversations where conv_id is not null),
crc as (select range as b, list_reduce([range::ubigint] || range(8)::ubigint[], lambda x, k: case when x % 2 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end) as v from range(256)),
table_ as (select list(v order by b) as t from crc),
e as (select c, xor(list_reduce([4294967295::ubigint] || list_transform(string_split(c::varchar, ''), lambda s: ascii(s)::ubigint), lambda x, b: xor(x >> 8, t[(xor(x, b) % 256)::bigint + 1])), 4294967295::ubigint) % {SHIFT} as h
      from (select distinct c from o), table_),
r as (select e.c, 0 as part, o.i, role, text from e join o on o.c = e.c - e.c % {SHARED} and o.i <= e.h
      union all select o.c, 1, o.i, role, text from o join e on e.c = o.c where o.i > e.h),
d as (select c, text, role, row_number() over (partition by c order by part, i) as depth,
        sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '' order by part, i) over (partition by c order by part, i rows unbounded preceding)) as node from r),
p as (select c, depth, node, text from d union all select c, 0, 'root', '' from e),
n as materialized (select node, any_value(depth) as depth, min(c) as low, count(*) as n, any_value(text) as text from p group by node),
x as materialized (select n.*, q.low as above from n left join p on p.c = n.low and p.depth = n.depth - 1 left join n q on q.node = p.node),
k as (select q.node, count(*) as n_children from x join p on p.c = x.low and p.depth = x.depth - 1 join n q on q.node = p.node group by q.node),
z as (select p.node, sum((x.n - 1) * len(regexp_extract_all(x.text, '{WORD}')))::bigint as saved, count(*) filter (k.node is null) as leaves
      from x left join k on k.node = x.node join p on p.c = x.low and p.depth <= x.depth group by p.node),
f as (select c, max(depth) as depth from p group by c),
s as (select node, sha256(string_agg(p.c::varchar, ',' order by p.c)) as ends from f join p on p.c = f.c and p.depth = f.depth group by node)
select x.low as conv_id, x.depth, x.above as parent_conv_id, x.n as n_convs, coalesce(k.n_children, 0) as n_children, z.leaves as n_leaves, z.saved as saved_tokens,
       coalesce(s.ends, sha256('')) as ends_sha256
from x left join k on k.node = x.node join z on z.node = x.node left join s on s.node = x.node"""
