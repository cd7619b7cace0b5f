"""Document audit and repair, coverage, completeness, linking, validation and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_match, ladder, lines_of, prose_units
from .chunks import field, split_blocks
from .lines import explode_lines, orphans, sweep
from .substrings import contains_join


def document_audit(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Line and markup counts of each document with a verdict."""
    text = F.col(text_col)
    lines = lines_of(text)
    many = lambda p: F.regexp_count(text, F.lit(p))
    some = lambda p: F.size(F.filter(lines, lambda x: x.rlike(p)))
    lead = F.when(text.rlike(r"(?m)^##\s"), F.get(F.split(text, r"(?m)^##\s", 2), F.lit(0))).otherwise("")
    rows = docs.select(
        F.col(id_col).alias("doc"), F.size(lines).alias("total_lines"), F.length(text).alias("total_chars"), some(r"^\s*\|").alias("table_rows"),
        many(r"!\[.*?\]\(.*?\.jpeg\)").alias("image_refs"), many(r"(?m)^\{[0-9]+\}-+").alias("page_breaks"), some(r"^\s*\d{1,3}\s*$").alias("bare_pages"),
        many(r"(?m)^[0-9]+ [·•] [A-Z\s\-]+$").alias("running_headers"), F.regexp_count(lead, F.lit(r"(?m)^.+\d{1,3}\s*$")).alias("toc_lines"),
        many(r"\[tbl-\d+\.md\]\(tbl-\d+\.md\)").alias("dead_links"), sum((any_match(text, [p]).cast("int") for p in P.PIRACY_TRIGGERS), F.lit(0)).alias("piracy_kinds"),
        some(r"^# [^#]").alias("h1s"), sum((many(f"(?m){p}") for p in P.ICON_LINES), F.lit(0)).alias("icons"),
    )
    alone = orphans(explode_lines(docs, id_col, text_col)).groupBy("doc").agg(F.count("*").alias("orphan_h3"))
    rows = rows.join(alone, "doc", "left").fillna(0, ["orphan_h3"])
    critical = F.col("dead_links") + F.col("piracy_kinds")
    major = (F.col("h1s") > 1).cast("int") + (F.col("orphan_h3") > 0).cast("int") + (F.col("icons") > 0).cast("int")
    verdict = ladder([("unsafe", critical > 0), ("partially_safe", major > 2), ("safe_with_conditions", major > 0)], "production_safe")
    return rows.withColumn("verdict", verdict)


def repeated_headers(lines: DataFrame) -> DataFrame:
    """Headings of more than eight characters that occur again in a document."""
    heads = lines.where(F.col("line").rlike(r"^#+\s") & (F.length("line") > 8))
    return heads.groupBy("doc", "line").agg(F.count("*").alias("n")).where("n > 1")


def repair_text(text: Column) -> Column:
    """F18, first part: page marks, image tags, bare pages, running heads and icon lines, on the whole text."""
    for pattern, to in (
        (r"(?m)^\{([0-9]+)\}-+\n?", "<!-- page: $1 -->\n"),
        (r"!\[img-\d+\.jpeg\]\(img-\d+\.jpeg\)\n?", ""),
        (r"(?m)^(\d{1,3})\s*\n", "<!-- page: $1 -->\n"),
        (r"(?m)^([0-9]+)\s+[·•]\s+[A-Z\s\-]+\n?", "<!-- page: $1 -->\n"),
        *[(f"(?m){p}\\n?", "") for p in P.ICON_LINES],
    ):
        text = F.regexp_replace(text, pattern, to)
    return text


def normalise_headings(lines: DataFrame) -> DataFrame:
    """the first top heading stays, later ones sink a level; Box, Table and N.N lines become third-level headings."""
    top = F.col("line").rlike(r"^# [^#]")
    nth = F.sum(top.cast("int")).over(W.partitionBy("doc").orderBy("ln").rowsBetween(W.unboundedPreceding, 0))
    named = F.col("line").rlike(r"^(?:Box|Table)\s+\d+\.\d+|^\d+\.\d+\s+[A-Z]")
    line = F.when(top & (nth > 1), F.concat(F.lit("#"), F.col("line"))).when(named, F.concat(F.lit("### "), F.col("line"))).otherwise(F.col("line"))
    return lines.withColumn("line", line)


def repair(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """F18 whole: (doc, text, lines_before, lines_after, swept): rewrites, sweep around triggers, heading levels, blank runs."""
    first = docs.select(F.col(id_col), F.size(lines_of(F.col(text_col))).alias("lines_before"), repair_text(F.col(text_col)).alias(text_col))
    rows = sweep(explode_lines(first, id_col, text_col))
    # dropped lines stay as rows until the texts are put together, so that empty texts remain
    rows = normalise_headings(rows).groupBy("doc").agg(
        F.sort_array(F.collect_list(F.when(~F.col("swept"), F.struct("ln", "line")))).alias("kept"), F.count_if("swept").alias("swept")
    )
    text = F.regexp_replace(F.array_join(F.transform("kept", lambda p: p["line"]), "\n"), r"\n{3,}", "\n\n")
    whole = first.select(F.col(id_col).alias("doc"), "lines_before").join(rows, "doc", "left")
    return whole.select("doc", F.coalesce(text, F.lit("")).alias("text"), "lines_before", F.size(lines_of(F.coalesce(text, F.lit("")))).alias("lines_after"), F.coalesce("swept", F.lit(0)).alias("swept"))


def table_delimiters(table: Column) -> Column:
    """a delimiter row after the head of a pipe table that lacks one."""
    rows = lines_of(table)
    cells = F.size(F.split(F.trim(F.get(rows, F.lit(0))), r"\|", -1)) - 2
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), cells))
    lacks = (F.size(rows) > 0) & F.get(rows, F.lit(0)).startswith("|") & ~F.coalesce(F.get(rows, F.lit(1)).rlike(r"^\|[\s:|-]+\|?$"), F.lit(False))
    return F.when(lacks, F.array_join(F.concat(F.slice(rows, 1, 1), F.array(rule), F.slice(rows, 2, F.size(rows))), "\n")).otherwise(table)


# ------------------------------------------------------------------ coverage and completeness


def coverage(chunks: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(chapter, chunk_id, covered, total, pct) of L1 chunks whose sentences the chapter's L2 bodies lack too often.

    A sentence lies within one line; sentences and L2 lines meet on winnowed fingerprints (`substrings.contains_join`).
    """
    want = chunks.where("level = 1").select("chapter", "chunk_id", F.posexplode(prose_units(F.col("body"))).alias("k", "sentence"))
    lines = chunks.where("level = 2").select("chapter", F.col("chunk_id").alias("in_chunk"), F.posexplode(lines_of(F.col("body"))).alias("in_line", "line"))
    hits = contains_join(want, lines, "sentence", "line", ["chapter"], ["in_chunk", "in_line"])
    hits = hits.select("chapter", "chunk_id", "k").distinct().withColumn("hit", F.lit(1))
    seen = want.join(hits, ["chapter", "chunk_id", "k"], "left").groupBy("chapter", "chunk_id").agg(F.count("hit").alias("covered"), F.count("*").alias("total"))
    return seen.withColumn("pct", F.bround(F.col("covered") / F.col("total") * 100, 1)).where(F.col("covered") / F.col("total") < threshold)


def spot_check(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """(chapter, chunk_id, result): one of four 100-character pieces of a body must stand in its chapter's source."""
    rows = chunks.where("level = 2").join(sources.select("chapter", F.col("text").alias("source")), "chapter")
    body, n = F.trim("body"), F.length(F.trim("body"))
    piece = lambda at: F.trim(F.substr(body, at.cast("int") + 1, F.lit(100)))
    plain = lambda s: F.trim(F.regexp_replace(s, r"(?m)\*+|_+|`+|^#+\s", ""))
    tries = F.array(*[piece(at) for at in (F.floor(n / 2), F.lit(0), F.floor(n / 4), F.floor(n * 3 / 4))])
    ok = F.exists(tries, lambda s: (F.length(plain(s)) >= 30) & (F.contains("source", plain(s)) | F.contains("source", s)))
    return rows.select("chapter", "chunk_id", F.when(n < 40, "skipped").when(ok, "passed").otherwise("failed").alias("result"))


def figure_differences(sources: DataFrame, files: DataFrame) -> DataFrame:
    """Captions that only one side has: (chapter, caption, side)."""
    get = lambda t: t.select("chapter", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\*\*Fig\.?\s*[\d.]+\*\*[^\n]+"), F.lit(0)))).alias("caption"))
    a, b = get(sources).distinct(), get(files).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("missing")).union(b.exceptAll(a).withColumn("side", F.lit("extra")))


def flag_coverage(pairs: DataFrame) -> DataFrame:
    """(chapter, ds, dc, ts, tc, verdict) from (chapter, source, chunks); the second warning follows CLEARED without a bar."""
    hits = lambda c, pats: sum((F.regexp_count(F.col(c), F.lit(f"(?i){p}")) for p in pats), F.lit(0))
    rows = pairs.select("chapter", hits("source", P.DOSING).alias("ds"), hits("chunks", P.DOSING).alias("dc"), hits("source", P.THRESHOLDS).alias("ts"), hits("chunks", P.THRESHOLDS).alias("tc"))
    first = F.when((F.col("ds") > 0) & (F.col("dc") < F.col("ds") * 0.9), "WARN - dosing dropped").otherwise("CLEARED")
    low = (F.col("ts") > 0) & (F.col("tc") < F.col("ts") * 0.9)
    return rows.withColumn("verdict", F.when(low, F.concat(first, F.when(first.startswith("WARN"), " | ").otherwise(""), F.lit("WARN - thresholds dropped"))).otherwise(first))


def completeness(chunks: DataFrame) -> DataFrame:
    """(disease, chunks, categories, verdict) of L2 chunks; keywords are sought in the type, the topic and the block's first 200 characters."""
    head = F.trim(F.regexp_extract("raw", r"(?s)---\n\n?(.*)", 1))
    text = F.lower(F.concat_ws(" ", "semantic_type", F.coalesce("topic", F.lit("")), F.substring(head, 1, 200)))
    has = F.filter(F.array(*[F.when(any_match(text, ["|".join(words)]), name) for name, words in P.COMPLETENESS.items()]), lambda x: x.isNotNull())
    rows = chunks.where("level = 2").withColumn("disease", F.coalesce("disease", F.lit("general"))).where(~F.col("disease").isin(*P.GENERIC_DISEASES) & (F.length("disease") >= 3))
    agg = rows.withColumn("cats", has).groupBy("disease").agg(F.count("*").alias("chunks"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("cats")))).alias("cats"))
    lacks = lambda c: ~F.array_contains("cats", c)
    verdict = ladder([("complete", F.col("chunks") < 3), ("suspected_gap", lacks("management") & lacks("investigations")), ("complete", F.size("cats") >= 3)], "scattered")
    return agg.select("disease", "chunks", F.array_join("cats", ",").alias("categories"), verdict.alias("verdict"))


def autolink(chunks: DataFrame, most: int = 10) -> DataFrame:
    """(chapter, chunk_id, related): chunks of the same disease, then of diseases one of whose names holds the other.

    Diseases, not chunks, are paired, on a shared piece of four characters; a related list is the feature's own top `most`,
    and no task lets more than that of a chunk's through.
    """
    rows = chunks.where("level = 2").where(F.col("disease").isNotNull() & (F.col("disease") != "") & ~F.col("disease").isin(*P.GENERIC_DISEASES))
    names = rows.select("chapter", "disease").distinct()
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("disease") - 3, F.lit(1))), lambda k: F.substring("disease", k, 4)))
    short = names.where(F.length("disease") >= 4).select("chapter", F.col("disease").alias("held"), F.substring("disease", 1, 4).alias("piece"))
    held = short.join(names.select("chapter", F.col("disease").alias("holder"), F.explode(pieces).alias("piece")), ["chapter", "piece"]).where(F.contains("holder", F.col("held")) & (F.col("held") != F.col("holder"))).select("chapter", "held", "holder")
    pairs = names.select("chapter", "disease", F.col("disease").alias("other")).union(held.select("chapter", F.col("held"), "holder")).union(held.select("chapter", F.col("holder"), "held"))
    theirs = rows.select("chapter", F.col("disease").alias("other"), F.col("chunk_id").alias("to"), F.col("ord").alias("to_ord"))
    linked = rows.select("chapter", "chunk_id", "disease").join(pairs, ["chapter", "disease"]).join(theirs, ["chapter", "other"]).where("chunk_id <> to")
    rank = F.row_number().over(W.partitionBy("chapter", "chunk_id").orderBy(F.when(F.col("disease") == F.col("other"), 0).otherwise(1), "to_ord"))
    linked = linked.withColumn("rank", rank).where(F.col("rank") <= most)  # cut before the shuffle as well
    return linked.groupBy("chapter", "chunk_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "to"))), lambda p: p["to"]), ",").alias("related"))


# ------------------------------------------------------------------ validation


def validate(files: DataFrame) -> DataFrame:
    """(chapter, chunk_id, failure) of chunk files: unclosed frontmatter and broken field rules."""
    rows = split_blocks(files)
    raw = F.col("raw")
    get = lambda n: F.trim(field(raw, n))
    status, note = get("coverage_status"), get("gap_note")
    full = lambda n: F.coalesce(get(n).rlike(r"^\[.+\]$"), F.lit(False))
    yes = lambda n: F.coalesce(F.lower(get(n)) == "true", F.lit(False))
    rules = [
        ("malformed", ~F.col("closed")),
        ("missing disease_focus", F.col("closed") & (F.coalesce(get("disease_focus"), F.lit("")) == "")),
        ("invalid coverage_status", F.col("closed") & ~F.coalesce(status.isin("complete", "partial", "gap"), F.lit(False))),
        ("empty gap_note", F.col("closed") & F.coalesce(status.isin("partial", "gap"), F.lit(False)) & (F.coalesce(note, F.lit("")) == "")),
        ("invalid algorithm_type", F.col("closed") & yes("is_clinical_algorithm") & ~F.coalesce(F.lower(get("algorithm_type")).isin(*P.ALGORITHM_TYPES), F.lit(False))),
        ("no figures listed", F.col("closed") & yes("contains_figures") & ~full("figure_assets") & ~full("figure_captions")),
        ("page_numbers empty", F.col("closed") & F.coalesce(get("page_numbers") == "[]", F.lit(False))),
    ]
    found = F.filter(F.array(*[F.when(test, name) for name, test in rules]), lambda x: x.isNotNull())
    return rows.select("chapter", F.coalesce(get("chunk_id"), F.lit("?")).alias("chunk_id"), F.explode(found).alias("failure"))


def validation_verdict(files: DataFrame, failures: DataFrame) -> DataFrame:
    """(chapter, chunks, failures, verdict); a chapter without chunks passes its rules with none checked."""
    counted = split_blocks(files).groupBy("chapter").agg(F.count_if("closed").alias("chunks"))
    bad = failures.groupBy("chapter").agg(F.count("*").alias("failures"))
    rows = files.select("chapter").distinct().join(counted, "chapter", "left").join(bad, "chapter", "left").fillna(0)
    return rows.withColumn("verdict", F.when(F.col("failures") == 0, "PASS").otherwise("HARD-FAIL"))


def scorecard(rows: DataFrame) -> DataFrame:
    """(chapter, four ratios, overall) from counts (ds, dc, ts, tc, passed, failed, checked, gaps); absent dimensions are null."""
    kept = lambda a, b: F.when(F.col(a) > 0, F.least(F.try_divide(F.col(b).cast("double"), F.col(a)), F.lit(1.0)))
    dims = {
        "dosing": kept("ds", "dc"), "threshold": kept("ts", "tc"), "verbatim": F.try_divide(F.col("passed").cast("double"), F.col("passed") + F.col("failed")),
        "coverage": F.lit(1.0) - F.try_divide(F.col("gaps").cast("double"), F.col("checked")),
    }
    known = F.filter(F.array(*dims.values()), lambda x: x.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(known), F.lit(0))
    return rows.select("chapter", *[c.alias(n) for n, c in dims.items()], F.bround(mean, 3).alias("overall"))


def distribution(rows: DataFrame, col: str) -> DataFrame:
    """Counts of a column's values, the most frequent first, ties by value."""
    return rows.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def reported_count(report: Column, label: str) -> Column:
    """The number after a label in a report, null where it is missing or malformed."""
    return F.regexp_extract(report, rf"(?m)^{label}:\s*(\S+)\s*$", 1).try_cast("int")


def census(rows: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Counts of a document's block kinds (doc, kind) and the kinds whose count is not the expected one."""
    counts = rows.groupBy("doc").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in expected])
    wrong = F.array(*[F.when(F.col(k) != n, F.lit(k)) for k, n in expected.items()])
    return counts.withColumn("wrong", F.array_join(F.filter(wrong, lambda x: x.isNotNull()), ","))
