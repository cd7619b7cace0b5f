"""Text guard and grounding of notes in a chunk index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_word, ladder, words_of


def corruption_audit(files: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(file, hits, doses, status): encoding damage blocks, dose forms are advice."""
    hits = sum((F.regexp_count(F.col(text_col), F.lit(p)) for p in P.CORRUPTION), F.lit(0))
    doses = F.regexp_count(F.col(text_col), F.lit(r"\b(?:Q\.D\.|QD|Q\.O\.D\.|QOD)\b")) + F.regexp_count(F.col(text_col), F.lit(r"\b\d+\s*(?:IU|I\.U\.)"))
    rows = files.select(F.col(id_col).alias("file"), F.coalesce(hits, F.lit(0)).alias("hits"), F.coalesce(doses, F.lit(0)).alias("doses"))
    return rows.withColumn("status", F.when(F.col("hits") > 0, "FAIL").when(F.col("doses") > 0, "ADVISORY").otherwise("PASS"))


def is_claim_line(line: Column) -> Column:
    """List items, table rows with a cell of two words or more that are no header, and prose of six words or more."""
    s = F.trim(line)
    void = (s == "") | s.rlike(r"^(?:<!--|```|\|---|\| ---|:--)") | s.rlike(r"^[|\-:\s]+$")
    cells = F.transform(F.split(F.regexp_replace(s, r"^\|+|\|+$", ""), r"\|"), F.trim)
    row = F.exists(cells, lambda c: F.size(words_of(c)) >= 2) & ~F.forall(F.filter(cells, lambda c: c != ""), lambda c: (F.upper(c) == c) & c.rlike("[A-Za-z]"))
    prose = F.size(words_of(F.regexp_replace(s, r"[>*_`]", ""))) >= 6
    return ~void & F.when(s.rlike(r"^(?:[-*+]|\d+[.)])\s+\S"), True).when(s.startswith("|"), row).otherwise(prose)


def section_kind(heading: Column) -> Column:
    """P25: exempt, layer2, anchored, or null for headings that inherit."""
    h = F.upper(heading)
    return ladder([("exempt", any_word(h, P.EXEMPT_HEADINGS)), ("layer2", any_word(h, ["LAYER 2"])), ("anchored", any_word(h, P.ANCHORED_HEADINGS))])


def normalise_book(token: Column, aliases: dict[str, str]) -> Column:
    """A book by its alias, exact first, then by a longer alias inside the text; aliases is a bounded table."""
    t = F.regexp_replace(F.lower(token), "[^a-z&]", "")
    exact = [(v, t == k) for k, v in aliases.items()]
    near = [(v, F.contains(t, F.lit(k))) for k, v in aliases.items() if len(k) > 3]
    return ladder([*exact, *near])


def parse_anchor(body: Column, aliases: dict[str, str]) -> Column:
    """struct of book, chapter and chunk of `Book-16-L2-045`, `Book-L2-045` or a bare id."""
    parts = F.split(body, "-", 3)
    book = normalise_book(F.get(parts, F.lit(0)), aliases)
    numbered = book.isNotNull() & (F.size(parts) == 3) & F.trim(F.get(parts, F.lit(1))).rlike(r"^\d+$")
    chapter = F.when(numbered, F.trim(F.get(parts, F.lit(1))).try_cast("int"))
    rest = F.when(book.isNotNull() & (F.size(parts) >= 2), F.trim(F.get(F.split(body, "-", 2), F.lit(1)))).otherwise(F.trim(body))
    return F.struct(book.alias("book"), chapter.alias("chapter"), F.when(numbered, F.trim(F.get(parts, F.lit(2)))).otherwise(rest).alias("chunk_id"))


def citations(lines: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """(doc, ln, kind, book, chapter, value) of bracketed anchors, chunk marks and Box, Table and Figure numbers.

    A reference belongs to the last book named before it on the line: the line is cut before each book's name.
    """
    names = "|".join(sorted((k for k in aliases if len(k) > 3), key=len, reverse=True))
    anchor = r"(?i)\[Anchor:\s*([A-Za-z&]+-\d+-[A-Za-z0-9_.\-]+)\s*\]"
    chunk = r"(?i)\[chunk:\s*([A-Za-z0-9_.\-]+)\s*\]"
    found = lines.select("doc", "ln", F.explode(F.regexp_extract_all("line", F.lit(anchor), F.lit(1))).alias("body")).withColumn("a", parse_anchor(F.col("body"), aliases))
    out = found.select("doc", "ln", F.lit("chunk").alias("kind"), "a.book", "a.chapter", F.col("a.chunk_id").alias("value"))
    bare = lines.withColumn("rest", F.regexp_replace("line", anchor, " "))
    marks = bare.select("doc", "ln", F.explode(F.regexp_extract_all("rest", F.lit(chunk), F.lit(1))).alias("value"))
    out = out.unionByName(marks.select("doc", "ln", F.lit("chunk").alias("kind"), F.lit(None).cast("string").alias("book"), F.lit(None).cast("int").alias("chapter"), "value"))
    pieces = bare.select("doc", "ln", F.explode(F.split(F.regexp_replace("rest", chunk, " "), rf"(?i)(?=\b(?:{names})\b)")).alias("seg"))
    book = normalise_book(F.regexp_extract("seg", rf"(?i)^({names})\b", 1), aliases)
    ref = F.lit(r"(?i)\b(Box|Table|Fig(?:ure)?)\.?\s+(\d{1,2}\.\d{1,3})\b")
    refs = F.arrays_zip(F.regexp_extract_all("seg", ref, F.lit(1)).alias("k"), F.regexp_extract_all("seg", ref, F.lit(2)).alias("n"))
    refs = pieces.select("doc", "ln", book.alias("book"), F.explode(refs).alias("r"))
    return out.unionByName(refs.select("doc", "ln", F.lit("ref").alias("kind"), "book", F.lit(None).cast("int").alias("chapter"), F.concat_ws(" ", F.lower(F.substring("r.k", 1, 3)), "r.n").alias("value")))


def resolve_citations(cites: DataFrame, index: DataFrame) -> DataFrame:
    """Adds `reason`, null where a chunk citation resolves against index (book, chapter, chunk_id).

    An id that a book has once resolves whatever the chapter named.
    """
    have = index.groupBy("book", "chunk_id").agg(F.collect_set("chapter").alias("chapters"))
    books = index.select("book").distinct().withColumn("indexed", F.lit(True))
    anywhere = index.select("chunk_id").distinct().withColumn("somewhere", F.lit(True))
    rows = cites.where("kind = 'chunk'").join(have.withColumnRenamed("chunk_id", "value"), ["book", "value"], "left").join(books, "book", "left")
    rows = rows.join(anywhere.withColumnRenamed("chunk_id", "value"), "value", "left")
    ok = F.when(F.col("book").isNull(), F.col("somewhere")).otherwise(F.col("chapters").isNotNull() & (F.col("chapter").isNull() | F.array_contains("chapters", F.col("chapter")) | (F.size("chapters") <= 1)))
    reason = F.when(F.col("book").isNotNull() & F.col("indexed").isNull(), "book not indexed").when(F.coalesce(ok, F.lit(False)), None).when(F.col("chapters").isNotNull(), "not in chapter").otherwise("not found")
    return rows.select("doc", "ln", "book", "chapter", "value", reason.alias("reason"))


def grounding(lines: DataFrame, kinds: DataFrame, cites: DataFrame, resolved: DataFrame) -> DataFrame:
    """(doc, claims, uncited, unresolved, status): claim lines under anchored headings need a citation that resolves.

    kinds: headings (doc, ln, kind) as heading_kinds() gives them; a line belongs to the last heading before it.
    """
    from .lines import carry_forward

    rows = lines.join(kinds.select("doc", "ln", F.col("kind").alias("own")), ["doc", "ln"], "left")
    rows = carry_forward(rows, F.col("own"), "kind")
    claims = rows.where(F.col("kind").isin("anchored", "layer2") & F.col("own").isNull() & is_claim_line(F.col("line")))
    cited = cites.select("doc", "ln").distinct().withColumn("cited", F.lit(True))
    bad = resolved.where("reason is not null").groupBy("doc").agg(F.count("*").alias("unresolved"))
    got = claims.join(cited, ["doc", "ln"], "left").groupBy("doc").agg(F.count("*").alias("claims"), F.count_if(F.col("cited").isNull()).alias("uncited"))
    out = lines.select("doc").distinct().join(got, "doc", "left").join(bad, "doc", "left").fillna(0)
    return out.withColumn("status", F.when((F.col("uncited") > 0) | (F.col("unresolved") > 0), "FAIL").otherwise("PASS"))
