"""Index compilation: postings, index lines, graphs and maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import index_tokens
from ..sources.shared import written
from .names import first_of_each, occurrences
from .ordered import carried, following


def postings(chunks: DataFrame, ord_col: str, text_col: str) -> DataFrame:
    """(token, df, postings): sorted ordinals of the chunks that hold each token."""
    rows = chunks.select(F.col(ord_col).alias("ord"), F.explode(F.array_distinct(index_tokens(F.col(text_col)))).alias("token"))
    return rows.groupBy("token").agg(F.count("*").alias("df"), F.sort_array(F.collect_list("ord")).alias("postings"))


def posting_counts(chunks: DataFrame, ord_col: str, text_col: str) -> DataFrame:
    """The same without lists, for tokens of any frequency: (token, df, first, last)."""
    rows = chunks.select(F.col(ord_col).alias("ord"), F.explode(F.array_distinct(index_tokens(F.col(text_col)))).alias("token"))
    return rows.groupBy("token").agg(F.count("*").alias("df"), F.min("ord").alias("first"), F.max("ord").alias("last"))


def index_lines(lines: DataFrame) -> DataFrame:
    """Index lines (ord, line) with `term`, the primary entry in force, and `is_sub`; notes and headings are dropped."""
    rows = lines.withColumn("line", F.trim("line")).where("line <> ''").where(~F.col("line").startswith("#") & ~F.col("line").startswith("Note:"))
    word = F.regexp_replace(F.get(F.split("line", r"\s+", 2), F.lit(0)), "[,;]+$", "")
    starts = F.lit(False)
    for s in P.SUB_STARTS:
        starts = starts | F.col("line").startswith(s)
    sub = (F.col("line").rlike(r"^[a-z]") & ~word.rlike("[A-Z]")) | starts
    rows = carried(rows.withColumn("__sub", sub), ["ord"], F.when(~F.col("__sub"), F.struct("ord", "line")), "__entry")
    # before the first entry every line is one of its own
    rows = rows.withColumn("is_sub", F.col("__sub") & F.col("__entry").isNotNull()).withColumn("term_ord", F.coalesce("__entry.ord", "ord")).withColumn("term", F.coalesce("__entry.line", "line"))
    return rows.drop("__sub", "__entry")


def terms(indexed: DataFrame) -> DataFrame:
    """(term_ord, term, subs): primary entries with their sub-entries in order."""
    got = indexed.groupBy("term_ord", "term").agg(F.sort_array(F.collect_list(F.when(F.col("is_sub"), F.struct("ord", "line")))).alias("s"))
    return got.select("term_ord", "term", F.transform("s", lambda x: x["line"]).alias("subs"))


def trials(indexed: DataFrame) -> DataFrame:
    """(acronym, title, line): the first trial of each line."""
    return indexed.where(F.col("line").rlike(P.TRIAL)).select("ord", F.regexp_extract("line", P.TRIAL, 1).alias("acronym"), F.regexp_extract("line", P.TRIAL, 2).alias("title"))


def acronyms(indexed: DataFrame) -> DataFrame:
    """(acronym, expansions): distinct expansions in order of first use."""
    rows = indexed.select("ord", F.trim(F.regexp_extract("line", P.ACRONYM, 2)).alias("acronym"), F.trim(F.regexp_extract("line", P.ACRONYM, 1)).alias("expansion"))
    rows = rows.where((F.length("acronym") >= 2) & F.col("acronym").rlike("[A-Z]")).groupBy("acronym", "expansion").agg(F.min("ord").alias("ord"))
    return rows.groupBy("acronym").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "expansion"))), lambda x: x["expansion"]), "; ").alias("expansions"))


def anchors(indexed: DataFrame) -> DataFrame:
    """(concept, page_start, page_end, anchor_type) of page ranges and t, f, c suffixes; bare pages give none."""
    get = lambda k: F.regexp_extract_all("line", F.lit(P.PAGE_JAVA), F.lit(k))
    rows = indexed.select(F.col("term").alias("concept"), F.explode(F.arrays_zip(get(1).alias("a"), get(2).alias("b"), get(3).alias("p"), get(4).alias("s"))).alias("m"))
    kind = F.when(F.col("m.a") != "", "page_interval").when(F.col("m.s") == "t", "table_anchor").when(F.col("m.s") == "f", "figure_anchor").when(F.col("m.s") == "c", "plate_anchor")
    start = F.when(F.col("m.a") != "", F.col("m.a")).otherwise(F.col("m.p"))
    return rows.select("concept", start.alias("page_start"), F.when(F.col("m.a") != "", F.col("m.b")).alias("page_end"), kind.alias("anchor_type")).where("anchor_type is not null")


def cross_references(term_rows: DataFrame) -> DataFrame:
    """(source, target) of See and See also."""
    return term_rows.where(F.col("term").rlike(P.SEE)).select(F.col("term").alias("source"), F.trim(F.regexp_extract("term", P.SEE, 1)).alias("target"))


def subtrees(term_rows: DataFrame, least: int = 3) -> DataFrame:
    """Entries with at least three sub-entries."""
    return term_rows.where(F.size("subs") >= least).select(F.lower("term").alias("concept"), F.size("subs").alias("n"), F.array_join("subs", "; ").alias("subfacets"))


def polysemy(term_rows: DataFrame, least: int = 4, most: int = 10) -> DataFrame:
    """First words of four letters or more that open at least four entries, with the first ten."""
    word = F.lower(F.get(F.split("term", r"\s+", 2), F.lit(0)))
    got = term_rows.withColumn("keyword", word).where(F.length("keyword") >= 4).groupBy("keyword").agg(F.count("*").alias("branches"), F.sort_array(F.collect_list(F.struct("term_ord", "term"))).alias("t"))
    return got.where(F.col("branches") >= least).select("keyword", "branches", F.array_join(F.transform(F.slice("t", 1, most), lambda x: x["term"]), "; ").alias("entries"))


def adjacency(term_rows: DataFrame) -> DataFrame:
    """Edges between neighbouring entries, weight 1."""
    return following(term_rows.select("term_ord", "term"), ["term_ord"], "term", "next").select("term", "next", F.lit(1.0).alias("weight")).where("next is not null")


def salience(term_rows: DataFrame) -> DataFrame:
    """Weight 3 for each distinct word of an entry."""
    return term_rows.select(F.explode(index_tokens(F.col("term"))).alias("word")).distinct().withColumn("weight", F.lit(3.0))


def early_exit(chunks: DataFrame) -> DataFrame:
    """(word, section): of each chunk's first three topic words the first section in order wins."""
    words = F.slice(F.regexp_extract_all(F.lower("topic"), F.lit(r"\b[a-z]{4,15}\b"), F.lit(0)), 1, 3)
    return chunks.select("ord", "section", F.explode(words).alias("word")).groupBy("word").agg(F.min_by("section", "ord").alias("section")).withColumn("confidence", F.lit(0.85))


def term_to_chunks(names: DataFrame, chunks: DataFrame, chars: int | None, fold: bool, most: int) -> DataFrame:
    """(acronym, matches, chunks): whole-word occurrences in a topic or the first `chars` of a body; chunks are the first `most`.

    Names and texts meet word by word (`names.occurrences`); a text never stands beside its words.
    """
    body = F.substring("body", 1, chars) if chars else F.col("body")
    low = F.lower if fold else (lambda c: c)
    rows = chunks.select(F.struct("ord", "chunk_id").alias("at"), low(F.concat_ws("\n", "topic", body)).alias("text"))
    asked = names.select("acronym").distinct().withColumn("name", low(F.col("acronym")))
    found = written(occurrences(asked, rows, "at", "text").select("name", "at.ord", "at.chunk_id"), "occurrences")  # read twice
    counted = found.groupBy("name").agg(F.count("*").alias("matches"))
    first = first_of_each(found, ["name"], ["ord", "chunk_id"], most).groupBy("name").agg(F.sort_array(F.collect_list(F.struct("ord", "chunk_id"))).alias("c"))  # `most` at most
    got = asked.join(counted, "name").join(first, "name")
    return got.select("acronym", "matches", F.array_join(F.transform("c", lambda x: x["chunk_id"]), ",").alias("chunks"))


def comparators(term_rows: DataFrame) -> DataFrame:
    """Sub-entries that set a concept against another."""
    return term_rows.select(F.col("term").alias("concept"), F.explode("subs").alias("entry")).where(F.col("entry").rlike(r"(?i)\bvs\b\.?|distinguished from"))


def grammar(names: DataFrame, most: int = 50) -> DataFrame:
    """One row: an alternation and an enumeration of the first acronyms."""
    first = names.select("acronym").distinct().orderBy("acronym").limit(most)
    quoted = F.transform(F.sort_array(F.collect_list("acronym")), lambda a: F.concat(F.lit('"'), a, F.lit('"')))
    one = first.agg(quoted.alias("q"))
    return one.select(F.concat(F.lit("acronym ::= "), F.array_join("q", " | ")).alias("gbnf"), F.concat(F.lit('{"enum": ['), F.array_join("q", ", "), F.lit("]}")).alias("schema"))


def eval_triplets(chunks: DataFrame, step: int = 50) -> DataFrame:
    """(query, positive, negative): the negative is the chunk `step` places on, around the end."""
    return following(chunks, ["ord"], "chunk_id", "negative", step, around=True).select(F.col("topic").alias("query"), F.col("chunk_id").alias("positive"), "negative")


def canonical_copies(files: DataFrame, folder: str) -> DataFrame:
    """One path a file name: canonical folder first, then the shallowest, then the least; copies in backup folders are dropped."""
    parts = F.split(F.lower("path"), "/")
    dirs = F.slice(parts, 1, F.size(parts) - 1)
    tokens = F.flatten(F.transform(dirs, lambda d: F.split(d, "[^a-z0-9]+")))
    skip = F.arrays_overlap(tokens, F.array(*[F.lit(x) for x in ("backup", "backups", "audit", "audits", "bundle", "bundles")]))
    rows = files.where(~skip).withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("home", F.coalesce(F.try_element_at(dirs, F.lit(-1)), F.lit("")))
    order = [F.when(F.col("home") == folder, 0).otherwise(1), F.size(parts), "path"]
    return rows.withColumn("n", F.row_number().over(W.partitionBy("name").orderBy(*order))).where("n = 1").select("name", "path")
