"""Line-addressed text: explosion, carry-forward, islands, frames, nearby pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_match, lines_of
from ..functions.unicode import similarity


def explode_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, ln, line), ln from 1."""
    return docs.select(F.col(id_col).alias("doc"), F.posexplode(lines_of(F.col(text_col))).alias("pos", "line")).select("doc", (F.col("pos") + 1).alias("ln"), "line")


def _by(order: str = "ln"):
    return W.partitionBy("doc").orderBy(order)


def carry_forward(lines: DataFrame, value: Column, name: str) -> DataFrame:
    """The last non-null value at or before each line."""
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(_by().rowsBetween(W.unboundedPreceding, 0)))


def carry_back(lines: DataFrame, value: Column, name: str, rows: int) -> DataFrame:
    """The first non-null value after each line within so many rows."""
    return lines.withColumn(name, F.first(value, ignorenulls=True).over(_by().rowsBetween(1, rows)))


def page_of(lines: DataFrame) -> DataFrame:
    """The page of each line, from the last marker before it."""
    marker = F.regexp_extract("line", r"^<!--\s*(?:page|pdf_page):\s*(\d+)", 1)
    return carry_forward(lines, F.when(marker != "", marker.cast("int")), "page")


def sections(lines: DataFrame, level: int = 2) -> DataFrame:
    """(doc, section, title, lo, hi): headings of a level with the line before the next one."""
    heads = lines.where(F.col("line").rlike(rf"^#{{{level}}}\s")).select("doc", "ln", F.trim(F.regexp_replace("line", r"^#+\s+", "")).alias("title"))
    last = lines.groupBy("doc").agg(F.max("ln").alias("eof"))
    heads = heads.withColumn("next", F.lead("ln").over(_by())).withColumn("n", F.row_number().over(_by())).join(last, "doc")
    return heads.select("doc", F.format_string("L1-%03d", "n").alias("section"), "title", F.col("ln").alias("lo"), (F.coalesce("next", F.col("eof") + 1) - 1).alias("hi"))


def orphans(lines: DataFrame) -> DataFrame:
    """Third-level headings before any second-level one."""
    before = F.max(F.col("line").rlike(r"^##\s").cast("int")).over(_by().rowsBetween(W.unboundedPreceding, 0))
    return lines.withColumn("seen", before).where(F.col("line").rlike(r"^###\s") & (F.col("seen") == 0)).select("doc", "ln", "line")


def islands(points: DataFrame, key: str, at: str, tolerance: int) -> DataFrame:
    """Runs of points at most tolerance + 1 apart: (key, lo, hi, n)."""
    by = W.partitionBy(key).orderBy(at)
    rows = points.select(key, at).distinct()
    rows = rows.withColumn("opens", F.coalesce((F.col(at) - F.lag(at).over(by) > tolerance + 1).cast("int"), F.lit(1)))
    rows = rows.withColumn("island", F.sum("opens").over(by.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(key, "island").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count("*").alias("n")).drop("island")


def is_protected(line: Column) -> Column:
    """Lines that a sweep never removes."""
    s = F.trim(line)
    return (s != "") & (any_match(s, P.PROTECTED_SHAPES) | (F.length(s) > 200) | any_match(s, [P.CLINICAL_KEYWORDS]))


def protected_paragraphs(lines: DataFrame) -> DataFrame:
    """Adds `protected`: a line of a paragraph that has a protected line."""
    blank = F.trim("line") == ""
    rows = lines.withColumn("para", F.sum(blank.cast("int")).over(_by().rowsBetween(W.unboundedPreceding, 0)))
    kept = F.max((~blank & is_protected(F.col("line"))).cast("int")).over(W.partitionBy("doc", "para"))
    return rows.withColumn("protected", (kept == 1) & ~blank).drop("para")


def sweep(lines: DataFrame, before: int = 10, after: int = 14) -> DataFrame:
    """Adds `swept`: an unprotected line with a trigger within [-after, +before] rows of it."""
    rows = protected_paragraphs(lines).withColumn("trigger", any_match(F.col("line"), P.PIRACY_TRIGGERS).cast("int"))
    near = F.max("trigger").over(_by().rowsBetween(-after, before))
    return rows.withColumn("swept", (near == 1) & ~F.col("protected")).drop("trigger")


def near_pairs(lines: DataFrame, least: int = 80, reach: int = 9, jaccard: float = 0.65, word_break: str = r"(?U)\W+") -> DataFrame:
    """W12, first part: (doc, i, j, jaccard) of long lines within reach whose sizes and words are alike.

    Texts are dealt out by document once; each line then meets the `reach` lines after it in one window, without a join.
    """
    rows = lines.where(F.length("line") > least).withColumn("i", F.row_number().over(_by()))
    rows = rows.select("doc", "ln", "i", "line", F.array_distinct(F.filter(F.split(F.lower("line"), word_break), lambda w: w != "")).alias("words"))
    after = F.collect_list(F.struct(F.col("i").alias("j"), "line", "words")).over(_by().rowsBetween(1, reach))  # `reach` at most
    alike = lambda x: F.abs(F.length("line") - F.length(x["line"])) / F.greatest(F.length("line"), F.length(x["line"])) <= 0.25
    pairs = rows.withColumn("after", after).select("doc", "i", "line", "words", F.explode(F.filter("after", alike)).alias("b"))
    both = F.size(F.array_intersect("words", "b.words"))
    ratio = both / (F.size("words") + F.size("b.words") - both)
    return pairs.withColumn("jaccard", ratio).where(F.col("jaccard") >= jaccard).select("doc", "i", F.col("b.j").alias("j"), "jaccard", "line", F.col("b.line").alias("line_j"))


def near_duplicates(lines: DataFrame, least: float = 0.85) -> DataFrame:
    """W12, whole: near pairs confirmed by the similarity ratio."""
    return near_pairs(lines).withColumn("ratio", similarity("line", "line_j")).where(F.col("ratio") > least).select("doc", "i", "j", F.round("ratio", 2).alias("ratio"))


def heading_kinds(lines: DataFrame, kind: Column) -> DataFrame:
    """Each heading with its own kind, or that of the nearest enclosing heading that has one.

    A heading's parent is the last one before it of a smaller level: a self-join within the text, whose
    levels are at most six; six carries, one a level, replace a stack.
    """
    heads = lines.where(F.col("line").rlike(r"^#{1,6}\s")).withColumn("level", F.length(F.regexp_extract("line", r"^(#+)", 1))).withColumn("own", kind)
    up = W.partitionBy("doc").orderBy("ln").rowsBetween(W.unboundedPreceding, -1)
    for k in range(1, 7):
        heads = heads.withColumn(f"at{k}", F.max(F.when(F.col("level") == k, F.struct("ln", F.coalesce("own", F.lit("")).alias("own")))).over(up))
    got = F.col("own")
    for k in range(6, 0, -1):
        # a heading of level k encloses this one unless a smaller level came in between
        shut = F.lit(0)
        for m in range(1, k + 1):
            if m < k:
                shut = F.greatest(shut, F.coalesce(F.col(f"at{m}")["ln"], F.lit(0)))
        inside = (F.col("level") > k) & F.col(f"at{k}").isNotNull() & (F.col(f"at{k}")["ln"] > shut) & (F.col(f"at{k}")["own"] != "")
        got = F.coalesce(got, F.when(inside, F.col(f"at{k}")["own"]))
    return heads.select("doc", "ln", "line", "level", F.coalesce(got, F.lit("exempt")).alias("kind"))


def number_rows(rows: DataFrame, by: list[str], order: list[str], name: str, pattern: str = "%d") -> DataFrame:
    """Formatted ordinals within groups."""
    return rows.withColumn(name, F.format_string(pattern, F.row_number().over(W.partitionBy(*by).orderBy(*order))))


def pages(rows: DataFrame, order: list[str], size: int, by: list[str] | None = None) -> DataFrame:
    """Adds `batch`, from 0, of `size` rows each within a group."""
    return rows.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(*(by or [])).orderBy(*order)) - 1) / size).cast("int"))
