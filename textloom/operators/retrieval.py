"""Ranked retrieval: BM25, term-count search, federated top-k and their evaluation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_word, first_words, search_tokens, words_of
from ..sources.shared import written
from .ordered import positions


def corpus_stats(counts: DataFrame, n: int) -> DataFrame:
    """(term, df, idf)."""
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    return df.withColumn("idf", F.log((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0))


def query_terms(queries: DataFrame, id_col: str, text_col: str, most: int = P.QUERY_TERMS) -> DataFrame:
    """(query, terms), the first distinct terms of a text."""
    return queries.select(F.col(id_col).alias("query"), F.slice(F.array_distinct(search_tokens(F.col(text_col))), 1, most).alias("terms"))


def bm25(docs: DataFrame, queries: DataFrame, id_col: str, text_col: str, k1: float = P.K1, b: float = P.B) -> DataFrame:
    """(query, doc, score) of documents that share a term with a query (query, terms).

    A text is cut into words once. The queries' distinct terms prune the postings first, by a join that broadcasts
    them when small. `blocks.search` gives the top of such scores without working out all of them.
    """
    once = written(docs.select(F.col(id_col).alias("doc"), search_tokens(F.col(text_col)).alias("tokens")), "tokens")
    sizes = once.agg(F.count("*").alias("n"), F.avg(F.size("tokens")).alias("avgdl")).first()
    asked = queries.select("query", F.explode("terms").alias("term"))
    counts = once.select("doc", F.size("tokens").alias("dl"), F.explode("tokens").alias("term")).join(asked.select("term").distinct(), "term", "left_semi")
    counts = counts.groupBy("doc", "dl", "term").agg(F.count("*").alias("tf"))
    stats = corpus_stats(counts, sizes["n"])
    length = F.lit(1 - b) + F.lit(b) * F.col("dl") / F.lit(float(sizes["avgdl"] or 1.0))
    weight = F.col("idf") * (F.col("tf") * (k1 + 1)) / (F.col("tf") + F.lit(k1) * length)
    hits = counts.join(stats, "term").select("term", "doc", weight.alias("w"))
    return hits.join(asked, "term").groupBy("query", "doc").agg(F.sum("w").alias("score"))


def top_k(scores: DataFrame, by: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; groups are never merged."""
    return scores.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def target_ranks(scores: DataFrame, docs: DataFrame, targets: DataFrame, id_col: str) -> DataFrame:
    """(query, doc, rank) of each query's target among all documents, zero scores included, ties by id.

    Documents without a shared term score zero; they are counted, not listed: those before a target are as many as
    its place in the order of ids, less the scored ones before it.
    """
    own = targets.join(scores, ["query", "doc"], "left").select("query", "doc", F.coalesce("score", F.lit(0.0)).alias("own"))
    places = positions(docs.select(F.col(id_col).alias("doc")), ["doc"], "place")
    lower = F.col("other") < F.col("doc")
    ahead = (F.col("score") > F.col("own")) | ((F.col("score") == F.col("own")) & lower)
    seen = scores.select("query", F.col("doc").alias("other"), "score").join(own, "query").groupBy("query", "doc").agg(F.count_if(ahead).alias("ahead"), F.count_if(lower).alias("before"))
    zero = F.when(F.col("own") == 0, F.col("place") - F.coalesce("before", F.lit(0))).otherwise(0)
    return own.join(seen, ["query", "doc"], "left").join(places, "doc").select("query", "doc", (F.coalesce("ahead", F.lit(0)) + zero + 1).alias("rank"))


def hit_rates(ranks: DataFrame, group: str) -> DataFrame:
    """Hit rates and mean reciprocal rank of each group and, in one row with a null group, of all."""
    hits = [F.avg((F.col("rank") <= k).cast("double")).alias(f"hit_{k}") for k in P.HIT_RANKS]
    return ranks.rollup(group).agg(F.count("*").alias("n"), *hits, F.avg(1 / F.col("rank")).alias("mrr"))


def term_search(records: DataFrame, query: str, text_col: str, weight: int, k: int, order: str) -> DataFrame:
    """Records by the number of query words (over two letters) they contain, stable in `order`."""
    terms = [t.lower() for t in re.findall(r"\w+", query) if len(t) > 2] or [query.lower()]
    text = F.lower(F.col(text_col))
    score = sum((F.contains(text, F.lit(t)).cast("int") * weight for t in terms), F.lit(0))
    return records.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), order).limit(k)


def first_or_all(rows: DataFrame, test, order: str) -> DataFrame:
    """Rows that pass, or all rows where none does; the first that passes settles which."""
    kept = rows.where(test)
    return (kept if kept.limit(1).count() else rows).orderBy(order)


def lookup(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The exact key, else the first row whose key contains the value or is contained in it."""
    k, v = F.lower(F.col(key)), value.lower()
    near = F.contains(k, F.lit(v)) | F.contains(F.lit(v), k)
    return rows.where(near).orderBy(F.when(k == v, 0).otherwise(1), order).limit(1)


def contains_any(rows: DataFrame, cols: list[str], query: str, k: int, order: str) -> DataFrame:
    """Rows one of whose columns contains the query, the first k."""
    hay = F.lower(F.concat_ws(" ", *cols))
    return rows.where(any_word(hay, [query.lower()])).orderBy(order).limit(k)


def budget(c, n: int):
    """A text held to n words, with whether it was cut."""
    return F.struct(first_words(c, n).alias("text"), (F.size(words_of(c)) > n).alias("cut"))


def first_or_random(rows: DataFrame, test, order: str, seed: int = 7) -> DataFrame:
    """The first row that passes, else one drawn by a seeded hash of its order, the same in every run."""
    kept = rows.withColumn("__rank", F.when(test, F.struct(F.lit(0).alias("k"), F.lit(0).cast("bigint").alias("h"))).otherwise(F.struct(F.lit(1).alias("k"), F.xxhash64(F.lit(seed), F.col(order)).alias("h"))))
    return kept.orderBy("__rank", order).limit(1).drop("__rank")


def first_bridge(rows: DataFrame, terms: list[str], cols: list[str], order: str) -> DataFrame:
    """The first row one of whose columns contains any term, else the first row of all."""
    hit = any_word(F.lower(F.concat_ws(" ", *cols)), [t.lower() for t in terms])
    return rows.orderBy(F.when(hit, 0).otherwise(1), order).limit(1)


def fan_out(sources: dict[str, DataFrame]) -> DataFrame:
    """The results of several sources under their names, never merged; a source without rows gives none."""
    out = None
    for name, rows in sources.items():
        part = rows.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
