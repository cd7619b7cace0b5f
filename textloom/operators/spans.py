"""Line spans: parsing, merging, resolving, containment, location and precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import anchor_units, normalise_anchor
from .lines import islands
from .substrings import contains_join


def parse(raw: Column) -> Column:
    """struct of segments (lo, hi), unmerged, and errors; a blank token is no error, a reversed range is one."""
    tokens = F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda t: F.trim(t) != "")
    one, span = r"^\s*(\d+)\s*$", r"^\s*(\d+)\s*-\s*(\d+)\s*$"

    def segment(t: Column) -> Column:
        lo = F.when(t.rlike(one), F.regexp_extract(t, one, 1)).when(t.rlike(span), F.regexp_extract(t, span, 1)).cast("int")
        hi = F.when(t.rlike(one), F.regexp_extract(t, one, 1)).when(t.rlike(span), F.regexp_extract(t, span, 2)).cast("int")
        return F.when(lo <= hi, F.struct(lo.alias("lo"), hi.alias("hi")))

    good = F.filter(F.transform(tokens, segment), lambda s: s.isNotNull())
    bad = F.filter(tokens, lambda t: segment(t).isNull())
    reason = lambda t: F.concat(F.when(t.rlike(span), F.lit("reversed range ")).otherwise(F.lit("unparseable token ")), F.trim(t))
    return F.struct(good.alias("segments"), F.transform(bad, reason).alias("errors"))


def merge(segments: Column) -> Column:
    """Sorted segments, those that overlap or touch joined."""
    start = F.lit(None).cast("array<struct<lo:int,hi:int>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], s["hi"]).alias("hi"))))
        return F.when(acc.isNull(), F.array(s)).when(s["lo"] <= last["hi"] + 1, grown).otherwise(F.concat(acc, F.array(s)))

    return F.coalesce(F.aggregate(F.array_sort(segments), start, step), F.array().cast("array<struct<lo:int,hi:int>>"))


def serialise(segments: Column) -> Column:
    """canonical text of merged segments."""
    one = lambda s: F.when(s["lo"] == s["hi"], s["lo"].cast("string")).otherwise(F.concat_ws("-", s["lo"], s["hi"]))
    return F.array_join(F.transform(merge(segments), one), ",")


def envelope(segments: Column) -> Column:
    """least start and greatest end, null without segments."""
    lo, hi = F.array_min(F.transform(segments, lambda s: s["lo"])), F.array_max(F.transform(segments, lambda s: s["hi"]))
    return F.when(F.size(segments) > 0, F.struct(lo.alias("lo"), hi.alias("hi")))


def resolve(spans: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc, chunk, text) of spans (doc, chunk, segments) over lines (doc, ln, line), in segment order.

    Each segment becomes its line numbers, clamped by the inner join, so the join is an equi-join on (doc, ln).
    """
    rows = spans.select("doc", "chunk", F.posexplode("segments").alias("k", "s"))
    last = lines.groupBy("doc").agg(F.max("ln").alias("eof"))
    rows = rows.join(last, "doc").where(F.col("s.lo") <= F.col("eof"))
    rows = rows.select("doc", "chunk", "k", F.explode(F.sequence(F.greatest(F.col("s.lo"), F.lit(1)), F.least(F.col("s.hi"), F.col("eof")))).alias("ln"))
    found = rows.join(lines, ["doc", "ln"]).groupBy("doc", "chunk").agg(F.sort_array(F.collect_list(F.struct("k", "ln", "line"))).alias("parts"))
    return found.select("doc", "chunk", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("text"))


def contained(outer: DataFrame, inner: DataFrame, width: int = 256) -> DataFrame:
    """Pairs (doc, outer, inner) whose spans (lo, hi) nest; binned on the inner start, so it is an equi-join."""
    a = outer.select("doc", F.col("chunk").alias("outer"), F.col("lo").alias("a"), F.col("hi").alias("b"))
    a = a.withColumn("bin", F.explode(F.sequence(F.floor(F.col("a") / width), F.floor(F.col("b") / width))))
    b = inner.select("doc", F.col("chunk").alias("inner"), "lo", "hi", F.floor(F.col("lo") / width).alias("bin"))
    return a.join(b, ["doc", "bin"]).where("a <= lo and hi <= b").select("doc", "outer", "inner")


def headings_between(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs (doc, end_first, start_second) with `split`: a heading lies strictly between."""
    heads = lines.where(F.col("line").rlike(r"^#{1,6}\s")).groupBy("doc").agg(F.sort_array(F.collect_set("ln")).alias("heads"))
    inside = F.exists("heads", lambda h: (h > F.col("end_first")) & (h < F.col("start_second")))
    return pairs.join(heads, "doc", "left").withColumn("split", F.coalesce(inside, F.lit(False))).drop("heads")


def locate(chunks: DataFrame, lines: DataFrame, reach: int = 250, sample: int = 70) -> DataFrame:
    """(doc, chunk, unit, ln): where each anchor of a chunk (doc, chunk, body, hint) stands in its text.

    Of several places the nearest to the hint within `reach` lines counts, else the nearest of all. Anchors and
    lines meet on winnowed fingerprints (`substrings.contains_join`); the nearest place is kept by an aggregate.
    """
    units = chunks.select("doc", "chunk", "hint", F.posexplode(anchor_units(F.col("body"))).alias("unit", "raw"))
    units = units.select("doc", "chunk", "hint", "unit", F.substring(normalise_anchor(F.col("raw")), 1, sample).alias("anchor"))
    source = lines.select("doc", "ln", normalise_anchor(F.col("line")).alias("text"))
    hits = contains_join(units.where(F.length("anchor") >= 8), source, "anchor", "text", ["doc"], ["ln"])
    away = F.abs(F.col("ln") - F.col("hint"))
    near = F.struct(F.when(away <= reach, 0).otherwise(1).alias("far"), F.coalesce(away, F.col("ln")).alias("away"), F.col("ln").alias("ln"))
    best = hits.groupBy("doc", "chunk", "unit").agg(F.min(near)["ln"].alias("ln"))
    return units.select("doc", "chunk", "unit").join(best, ["doc", "chunk", "unit"], "left")


def precision(declared: DataFrame, located: DataFrame, tolerance: int = 1, floor: float = 0.5) -> DataFrame:
    """The verdict on each chunk's declared segments (doc, chunk, segments) against where its units were found."""
    seen = located.groupBy("doc", "chunk").agg(F.count("*").alias("units"), F.count("ln").alias("found"), F.sort_array(F.collect_set("ln")).alias("at"))
    rows = declared.join(seen, ["doc", "chunk"], "left")
    rate = F.coalesce(F.try_divide("found", "units"), F.lit(0.0))
    at = F.coalesce("at", F.array().cast("array<int>"))
    inside = lambda n: F.exists("segments", lambda s: (s["lo"] <= n) & (n <= s["hi"]))
    outside = F.filter(at, lambda n: ~inside(n))

    def gap(s: Column) -> Column:
        own = F.filter(at, lambda n: (n >= s["lo"] - tolerance - 1) & (n <= s["hi"] + tolerance + 1))
        return F.exists(F.zip_with(F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0))), F.slice(own, 2, F.greatest(F.size(own), F.lit(1))), lambda a, b: b - a), lambda d: d - 1 > tolerance)

    rows = rows.withColumn("rate", rate).withColumn("outside", outside).withColumn("holes", F.exists("segments", gap))
    under = F.size("outside") > 0
    over = (F.size("segments") > 0) & ~under & F.col("holes")
    verdict = F.when((F.size(at) == 0) | (F.col("rate") < floor), "UNRESOLVED").when(under, "UNDER_INCLUSIVE").when(over, "OVER_INCLUSIVE").otherwise("PRECISE")
    return rows.select("doc", "chunk", F.coalesce("found", F.lit(0)).alias("found"), F.bround("rate", 2).alias("match_rate"), verdict.alias("verdict"))


def suggested(located: DataFrame, tolerance: int = 1) -> DataFrame:
    """W06 over located lines: (chunk, lo, hi, n) segments that would fit."""
    return islands(located.where("ln is not null"), "chunk", "ln", tolerance)


def precision_summary(verdicts: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """One row of counts by verdict and of findings that are neither precise nor adjudicated false positives (doc, chunk, decision)."""
    rows = verdicts.join(adjudicated, ["doc", "chunk"], "left")
    open_ = (F.col("verdict") != "PRECISE") & ~F.coalesce(F.col("decision") == "CHECKER_FALSE_POSITIVE", F.lit(False))
    names = ("PRECISE", "UNDER_INCLUSIVE", "OVER_INCLUSIVE", "UNRESOLVED")
    return rows.agg(*[F.count_if(F.col("verdict") == v).alias(v.lower()) for v in names], F.count_if(open_).alias("open"))


def bullet_gaps(gaps: DataFrame, lines: DataFrame) -> DataFrame:
    """Gaps (doc, lo, hi), bounds exclusive, with whether all their lines are blank or short bullets."""
    s = F.trim("line")
    fine = (s == "") | s.rlike(r"^[-*]\s+\S.{0,38}$")
    own = gaps.withColumn("ln", F.explode(F.sequence(F.col("lo"), F.col("hi")))).where("ln > lo and ln < hi")
    got = own.join(lines.withColumn("fine", fine), ["doc", "ln"]).groupBy("doc", "lo", "hi").agg(F.every("fine").alias("bullets_only"))
    return gaps.join(got, ["doc", "lo", "hi"], "left").withColumn("bullets_only", F.coalesce("bullets_only", F.lit(True)))
