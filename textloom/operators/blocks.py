"""A blocked inverted index, and exact top-k search that leaves out blocks which cannot reach the top.

Documents are numbered by their order. The postings of a term are cut where numbers pass a multiple of BLOCK, so a term in
every document has many rows of at most BLOCK postings. Places are kept as differences. A row also holds the highest
weight that any of its postings gives: the sum of a query's terms' highest weights bounds
every score in a block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import search_tokens
from ..sources.shared import written
from .names import first_of_each
from .ordered import positions

BLOCK = 4096  #: documents
LEAD = 4  #: blocks of a query that are scored first, to learn what a document has to reach
FEW = 100_000  #: terms of queries that are broadcast; more are shuffled
SLACK = 1e-4  #: scores are compared with this much to spare, as they are rounded for ranking


@dataclass(frozen=True)
class Index:
    blocks: DataFrame  #: term, block, n, base, gaps, tfs, lengths, highest
    places: DataFrame  #: doc, place
    documents: int
    mean_length: float


def weight(tf: Column, length: Column, mean: float, k1: float = P.K1, b: float = P.B) -> Column:
    """A posting's BM25 weight without the term's own part."""
    return (tf * (k1 + 1)) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * length / F.lit(mean)))


def gaps_of(places: Column) -> Column:
    """Differences of neighbouring places; the first is 0."""
    return F.transform(places, lambda x, i: (x - F.when(i == 0, x).otherwise(F.get(places, i - 1))).cast("int"))


def places_of(base: Column, gaps: Column) -> Column:
    """The places that `gaps_of` has packed; base is the first of them."""
    return F.aggregate(gaps, F.struct(base.alias("at"), F.array().cast("array<bigint>").alias("out")), lambda a, g: F.struct((a["at"] + g).alias("at"), F.array_append(a["out"], a["at"] + g).alias("out")), lambda a: a["out"])


def _counted(tokens: Column) -> Column:
    """(term, tf) of each distinct token, from runs of equal ones in their order."""
    return F.transform(F.filter(F.transform(tokens, lambda x, i: F.struct(x.alias("term"), i.alias("at"), (F.get(tokens, i - 1) != x).alias("new"))), lambda x: (x["at"] == 0) | x["new"]), lambda x: F.struct(x["term"].alias("term"), x["at"].alias("at")))


def build(docs: DataFrame, id_col: str, text_col: str, tokens=search_tokens, block: int = BLOCK) -> Index:
    """The index of a corpus; a text is cut into words once, and counted where it stands.

    Texts are put in order first, so that postings know their places and are shuffled once, to their term's block.
    Each row is a document of its own.
    """
    cut = lambda rows: rows.select("doc", F.sort_array(tokens(F.col("text"))).alias("tokens")).withColumn("length", F.size("tokens"))
    once = positions(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), ["doc"], "place", then=cut)
    total = once.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    mean = float(total["mean"] or 1.0)
    runs = once.where("length > 0").select("place", "length", _counted(F.col("tokens")).alias("runs"))
    each = runs.select("place", "length", F.explode(F.transform("runs", lambda x, k: F.struct(x["term"].alias("term"), (F.coalesce(F.get("runs", k + 1)["at"], F.col("length")) - x["at"]).cast("int").alias("tf")))).alias("t"))
    each = each.select(F.col("t.term").alias("term"), F.floor(F.col("place") / block).alias("block"), "place", "t.tf", "length")
    own = F.sort_array(F.collect_list(F.struct("place", "tf", "length"))).alias("own")  # at most `block`
    # dealt out as rows: lists of single postings would be larger and would not add up before the shuffle
    rows = each.repartition("term", "block").groupBy("term", "block").agg(F.count("*").alias("n"), own, F.max(weight(F.col("tf"), F.col("length"), mean)).alias("highest"))
    rows = rows.select("term", "block", "n", F.get("own.place", F.lit(0)).alias("base"), gaps_of(F.col("own.place")).alias("gaps"), F.col("own.tf").alias("tfs"), F.col("own.length").alias("lengths"), "highest")
    return Index(written(rows, "blocks"), once.select("doc", "place"), total["n"], mean)


def _few(rows: DataFrame) -> DataFrame:
    """A table of queries' terms, to be broadcast if it is counted as FEW at most."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _scores(index: Index, asked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query, doc, score) of all postings of a query's terms (query, term, idf) in its wanted blocks (query, block).

    Blocks travel packed; their postings are added up in the task that unpacks them.
    """
    rows = index.blocks.select("term", "block", "base", "gaps", "tfs", "lengths").join(_few(asked), "term").join(wanted, ["query", "block"], "left_semi")
    rows = rows.select("query", "block", "idf", F.explode(F.arrays_zip(places_of(F.col("base"), F.col("gaps")).alias("place"), "tfs", "lengths")).alias("p"))
    part = F.col("idf") * weight(F.col("p.tfs"), F.col("p.lengths"), index.mean_length)
    return rows.groupBy("query", "block", F.col("p.place").alias("place")).agg(F.sum(part).alias("score")).drop("block")


def bounds(index: Index, asked: DataFrame) -> DataFrame:
    """(query, block, bound): no document of the block scores higher for the query."""
    return index.blocks.select("term", "block", "highest").join(_few(asked), "term").groupBy("query", "block").agg(F.sum(F.col("idf") * F.col("highest")).alias("bound"))


def with_idf(index: Index, queries: DataFrame) -> DataFrame:
    """(query, term, idf) of queries (query, terms) and the index's counts."""
    asked = queries.select("query", F.explode("terms").alias("term")).distinct()
    df = index.blocks.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log((F.lit(float(index.documents)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
    return asked.join(df, "term").select("query", "term", idf.alias("idf"))


def search(index: Index, queries: DataFrame, k: int, lead: int = LEAD, digits: int = 5) -> tuple[DataFrame, DataFrame]:
    """The first k documents of each query (query, doc, rank, score), scores rounded and ties by document, and how many blocks were scored (query, blocks, scored).

    The blocks of highest bound are scored first; their k-th score is what any other block's bound has to reach.
    """
    asked = written(with_idf(index, queries), "asked")
    found = written(bounds(index, asked), "bounds")
    first = first_of_each(found, ["query"], [F.desc("bound"), "block"], lead).select("query", "block")
    first = written(first, "first")
    led = written(_scores(index, asked, first), "led")
    reached = led.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score")))).where(F.col("n") == k).select("query", F.col("score").alias("least"))
    rest = found.join(first, ["query", "block"], "left_anti").join(reached, "query", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK)).select("query", "block")
    rest = written(rest, "rest")
    every = led.unionByName(_scores(index, asked, rest)).join(index.places, "place").select("query", "doc", F.round("score", digits).alias("score"))
    top = every.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "doc"))).where(F.col("rank") <= k)
    counts = found.groupBy("query").agg(F.count("*").alias("blocks")).join(first.unionByName(rest).groupBy("query").agg(F.count("*").alias("scored")), "query")
    return top, counts
