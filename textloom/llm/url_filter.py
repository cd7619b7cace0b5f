"""URL verdicts: host and path rules first, then trust and distrust over the host graph. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

MOST_ROUNDS, CUT_EVERY, DAMPING = 100, 4, 0.85
CLOSE = 1e-6  #: the ranks are settled when the sum of their changes is no more
DISTRUST_RATIO = 1.0  #: a host is blocked when its distrust exceeds its trust so many times


@dataclass(frozen=True)
class Rule:
    verdict: str  #: allow or block
    host: str
    path: str  #: starts with /

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """The name or verdict of the longest fitting rule; of equal ones, block wins."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name if field == "name" else r.verdict)).otherwise(out)
    return out


def host_edges(pages: DataFrame, html_col: str = "html", domains: bool = False) -> DataFrame:
    """(src, dst, w): links between hosts, counted before the shuffle; with `domains` also steps between a host and its parent domains."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(r"""(?i)href\s*=\s*["']((?:https?:)?//[^"'>\s]+)"""), 1)
    to = F.transform(hrefs, lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)))
    links = pages.select(F.col("host").alias("src"), F.explode(to).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    if not domains:
        return links
    nodes = pages.select("host").where("host <> ''").distinct().union(links.select("dst")).distinct()
    label = F.split("host", r"\.", -1)
    chain = nodes.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(label)), lambda k: F.array_join(F.slice(label, k, F.size(label)), "."))).alias("src")).distinct()
    up = chain.where(F.instr("src", ".") > 0).select("src", F.expr("substr(src, instr(src, '.') + 1)").alias("dst"), F.lit(1.0).alias("w")).where("dst <> ''")
    return links.union(up).union(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, scratch: Scratch, most_rounds: int = MOST_ROUNDS, damping: float = DAMPING, close: float = CLOSE) -> DataFrame:
    """(host, trust, distrust): personalised PageRank along links from trusted, against them from blocked seeds.

    seeds: (host, good, bad) shares of the two start vectors. Rounds go on until the ranks change by no more than
    `close` in all; a round leaves at most `damping` of the change of the one before. What a host without links
    holds is not handed on. A round adds up a host's shares before they are shuffled.
    """
    out_w = edges.groupBy("src").agg(F.sum("w").alias("out_w"))
    in_w = edges.groupBy("dst").agg(F.sum("w").alias("in_w"))
    edges = edges.join(out_w, "src").join(in_w, "dst").select("src", "dst", (F.col("w") / F.col("out_w")).alias("fwd"), (F.col("w") / F.col("in_w")).alias("back"))
    edges = scratch.write(edges, "edges")
    start = seeds.select("host", (F.col("good") * (1 - damping)).alias("trust"), (F.col("bad") * (1 - damping)).alias("distrust"))
    now = seeds.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    if edges.isEmpty():
        return start
    last = scratch.write(now, "ranks")
    for k in range(1, most_rounds + 1):
        fwd = edges.join(now, edges.src == now.host).select(F.col("dst").alias("host"), (F.col("trust") * F.col("fwd") * damping).alias("trust"), F.lit(0.0).alias("distrust"))
        back = edges.join(now, edges.dst == now.host).select(F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("back") * damping).alias("distrust"))
        now = fwd.union(back).union(start).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if k % CUT_EVERY and k < most_rounds:
            continue
        now = scratch.write(now, "ranks")
        before = last.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d"))
        change = F.abs(F.coalesce("trust", F.lit(0.0)) - F.coalesce("t", F.lit(0.0))) + F.abs(F.coalesce("distrust", F.lit(0.0)) - F.coalesce("d", F.lit(0.0)))
        moved = now.join(before, "host", "full").agg(F.sum(change)).first()[0]
        scratch.drop(last)
        last = now
        if moved is None or moved <= close:
            break
    return now


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", html_col: str = "html", ratio: float = DISTRUST_RATIO, domains: bool = False) -> DataFrame:
    """`pages` with host, path, rule, verdict, trust and distrust (replaced where they exist).

    A null url, or one without ://, has empty host and path, fits no rule and is allowed, as is a host
    that neither trust nor distrust reaches. Seeds are the hosts of pages that rules allow or block: a host seeds
    trust with the share of its own judged pages that are allowed, and distrust with the rest, both divided by the number of
    such hosts. So a host's seeds do not depend on how many pages others have, and without links a
    host's other pages go as most of its judged ones do. Null html has no links. Repeated rows count again. An empty table stays empty.
    With `domains` trust also steps between a host and its parent domains, so that hosts of one domain speak for
    each other where pages hold no links.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    new = ("host", "path", "rule", "verdict", "trust", "distrust")
    rows = pages.drop(*new).withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    rows = rows.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules, "name")).withColumn("verdict", matched_rule(F.col("host"), F.col("path"), rules, "verdict"))
    edges = scratch.write(host_edges(rows, html_col, domains), "links")
    count = rows.where("host <> ''").groupBy("host").agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("good"), F.count(F.when(F.col("verdict") == "block", 1)).alias("bad"))
    count = scratch.write(count.where("good + bad > 0"), "seeds")
    hosts = float(max(count.count(), 1))
    seeds = count.select("host", *[(F.col(c) / (F.col("good") + F.col("bad")) / F.lit(hosts)).alias(c) for c in ("good", "bad")])
    ranks = propagate(edges, scratch.write(seeds, "shares"), scratch)
    ranks = ranks.select(F.col("host").alias("__host"), F.round("trust", 12).alias("trust"), F.round("distrust", 12).alias("distrust"))
    out = rows.join(ranks, F.col("host") == F.col("__host"), "left").drop("__host").fillna(0.0, ["trust", "distrust"])
    own = F.when(F.col("distrust") > F.col("trust") * ratio, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("verdict", own))
