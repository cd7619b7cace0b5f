"""Drops lines that too large a share of a site's pages contain. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

RATIO, LEAST_PAGES = 0.02, 5


def boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, once: bool = False) -> DataFrame:
    """(host, lines): the 64-bit hashes of each host's boilerplate lines.

    A line's pages are counted once each and before the shuffle; at most lines-per-page / ratio
    lines of a host can pass, so the array of a host is bounded. With `once` a host's pages of
    the same text (by its 64-bit hash) count as one page.
    """
    rows = pages.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text")).where("host is not null")
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    found = rows.select("host", lines.alias("lines"), F.xxhash64("text").alias("h"))
    if once:
        found = Scratch(pages.sparkSession, "line-dedup").write(found.groupBy("host", "h").agg(F.first("lines").alias("lines")), "texts")
    total = found.groupBy("host").agg(F.count("*").alias("total"))
    seen = found.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    often = seen.join(total, "host").where(F.col("n") > F.lit(ratio) * F.col("total"))
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, once: bool = False
) -> DataFrame:
    """`pages` with boilerplate lines cut from the text; adds n_lines and n_dropped (replaced where they exist).

    A line is boilerplate on its host when least_pages or more of the host's pages, and more than
    `ratio` of them, contain it. Rows of a null host and null texts stay as they are (n_lines of a null
    text is 0); blank lines always stay; repeated rows count as pages of their own, or with
    `once` as one page, so that a large group of copies does not lose its own lines. An empty table stays empty.
    """
    scratch = Scratch(pages.sparkSession, "line-dedup")
    found = scratch.write(boilerplate(pages, host_col, text_col, ratio, least_pages, once), "boilerplate")
    found = found.select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    kept = pages.drop("n_lines", "n_dropped").join(found, F.col(host_col).cast("string") == F.col("__host"), "left")
    kept = kept.withColumn("__all", F.split(F.col(text_col), "\n", -1))
    own = F.filter("__all", lambda x: ~F.array_contains("__lines", F.xxhash64(x)))
    # most pages have none: their text passes through untouched
    kept = kept.withColumn("__own", F.when(F.col("__lines").isNull(), F.col("__all")).otherwise(own))
    n_all, n_own = F.coalesce(F.size("__all").cast("long"), F.lit(0)), F.coalesce(F.size("__own").cast("long"), F.lit(0))
    present = F.col(text_col).isNotNull()
    return (
        kept.withColumn("n_lines", F.when(present, n_all).otherwise(0).cast("long"))
        .withColumn("n_dropped", F.when(present, n_all - n_own).otherwise(0).cast("long"))
        .withColumn(text_col, F.when(F.col("n_dropped") == 0, F.col(text_col)).otherwise(F.array_join("__own", "\n")))
        .select(*[c for c in pages.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
    )


def oracle(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    """DuckDB SQL of drop_boilerplate on documents, as op7 returns it."""
    return f"""
with l as (select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as k
           from documents where text is not null),
t as (select source, count(*) as total from documents group by source),
b as (select l.source, l.line from (select distinct doc_id, source, line from l where trim(line, ' ') <> '') l
      join t on t.source = l.source group by l.source, l.line, t.total
      having count(*) >= {least_pages} and count(*) > {ratio!r}::double * t.total),
k as (select l.doc_id, string_agg(l.line, chr(10) order by l.k) filter (where b.line is null) as text, count(*) as n_lines, count(b.line) as n_dropped
      from l left join b on b.source = l.source and b.line = l.line group by l.doc_id)
select d.doc_id, d.source, case when d.text is null then null else coalesce(k.text, '') end as text,
       coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_dropped, 0) as n_dropped
from documents d left join k on k.doc_id = d.doc_id"""
