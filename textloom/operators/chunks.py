"""Chunk files: splitting, fields, catalogues, slicing markdown, metadata and serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_match, any_word, ladder, slugify, words_of
from .lines import explode_lines, page_of

OPENER = r"(?m)(?=^---[ \t]*\r?\nchunk_id:)"


def split_blocks(files: DataFrame, id_col: str = "chapter", text_col: str = "text") -> DataFrame:
    """(chapter, ord, raw, closed): every chunk of a file, unclosed ones too; the preamble is no chunk."""
    parts = F.filter(F.split(F.col(text_col), OPENER, -1), lambda p: p.rlike(r"^---[ \t]*\r?\nchunk_id:"))
    rows = files.select(F.col(id_col).alias("chapter"), F.posexplode(parts).alias("pos", "raw"))
    return rows.select("chapter", (F.col("pos") + 1).alias("ord"), "raw", F.col("raw").rlike(r"(?s)\A---[ \t]*\r?\nchunk_id:.*?\n---(?:\n|\z)").alias("closed"))


def field(raw: Column, name: str) -> Column:
    """F16: a frontmatter value, wrapping quotes dropped; null where absent."""
    found = F.regexp_extract(raw, rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    bare = F.regexp_replace(found, r'^"(.*)"$', "$1")
    return F.when(raw.rlike(rf"(?m)^{name}:"), bare)


def body_of(raw: Column) -> Column:
    """The text after the frontmatter."""
    return F.trim(F.regexp_replace(F.regexp_extract(raw, r"(?s)\A---[ \t]*\r?\nchunk_id:.*?\n---(?:\n|\z)(.*)\z", 1), r"^\s+|\s+$", ""))


def list_field(raw: Column, name: str) -> Column:
    """`[a, b]` as an array, null where malformed or absent."""
    value = field(raw, name)
    inner = F.regexp_extract(value, r"^\[(.*)\]$", 1)
    return F.when(value.rlike(r"^\[.*\]$"), F.filter(F.transform(F.split(inner, ","), F.trim), lambda x: x != ""))


def parse_chunks(files: DataFrame, id_col: str = "chapter", text_col: str = "text") -> DataFrame:
    """Closed chunks as columns."""
    rows = split_blocks(files, id_col, text_col).where("closed")
    get = lambda n: field(F.col("raw"), n)
    return rows.select(
        "chapter", "ord", get("chunk_id").alias("chunk_id"), get("chunk_level").cast("int").alias("level"), get("semantic_type").alias("semantic_type"),
        get("disease_focus").alias("disease"), get("topic").alias("topic"), get("source_lines").alias("source_lines"), get("coverage_status").alias("coverage_status"),
        get("gap_note").alias("gap_note"), list_field(F.col("raw"), "related_chunks").alias("related"), body_of(F.col("raw")).alias("body"), "raw",
    )


def catalogue(files: DataFrame, id_col: str = "chapter", text_col: str = "text", most: int = 8000) -> DataFrame:
    """(section, chunk_id, local_id, topic, type, word_count, body); a trailing chunk label belongs to the next divider."""
    rows = parse_chunks(files, id_col, text_col)
    body = F.regexp_replace("body", r"(?:\r?\n)+#{1,6}[ \t]+Chunk\b[^\n]*\s*$", "")
    return rows.select(
        F.col("chapter").alias("section"), "chunk_id", F.format_string("L2-%03d", "ord").alias("local_id"), F.coalesce("topic", F.lit("General Medical Topic")).alias("topic"),
        F.coalesce("semantic_type", F.lit("concept_overview")).alias("type"), F.size(words_of(body)).alias("word_count"), F.substring(body, 1, most).alias("body"),
    )


# ------------------------------------------------------------------ metadata ladders


def initial_type(title: Column) -> Column:
    """The first type whose words occur in the title."""
    t = F.lower(title)
    return ladder([(label, any_word(t, words)) for label, words in P.TITLE_TYPES], "clinical_feature")


def algorithm_type(body: Column, topic: Column) -> Column:
    """scoring_system, stepwise_escalation or decision_tree, null for none."""
    t, b = F.lower(topic), F.lower(body)
    scoring = (any_word(t, P.SCORING_WORDS) | any_word(b, P.SCORING_WORDS)) & any_match(b, [P.SCORING_SHAPE])
    steps = any_word(t, P.ESCALATION_WORDS) | any_match(b, P.ESCALATION_SHAPES)
    tree = any_word(t, P.TREE_WORDS) | (any_match(b, [P.TREE_SHAPE]) & any_word(b, P.TREE_CUES))
    return ladder([("scoring_system", scoring), ("stepwise_escalation", steps), ("decision_tree", tree)])


def urgency(body: Column, topic: Column) -> Column:
    """P05, first part: by the title and the first 300 characters."""
    t, b = F.lower(topic), F.lower(F.substring(body, 1, 300))
    emergency = any_word(t, P.EMERGENCY_WORDS) | any_word(b, [*P.EMERGENCY_WORDS, "▲ emergency", "emergency:"])
    return ladder([("emergency", emergency), ("urgent", any_word(t, P.URGENT_WORDS) | any_word(b, P.URGENT_WORDS))], "routine")


def box_type(body: Column, topic: Column, algorithm: Column) -> Column:
    """P05, second part: the visual archetype."""
    t, b, head = F.lower(topic), F.lower(F.substring(body, 1, 300)), F.lower(F.substring(body, 1, 150))
    emergency = any_word(t, ["emergency", "resuscitation", "cardiac arrest"]) | any_word(head, ["emergency", "resuscitation"]) | any_word(b, ["▲ emergency"])
    return ladder([
        ("emergency_management", emergency),
        ("prescribing_point", any_word(t, ["prescribing point", "drug safety"]) | any_word(head, ["prescribing point"])),
        ("practice_point", any_word(t, ["practice point"]) | any_word(head, ["good practice point"])),
        ("summary_table", body.rlike(r"(?m)^\s*\|") & any_word(t, ["summary", "investigation", "overview"])),
        ("clinical_algorithm", algorithm.isNotNull()),
    ], "none")


def drug_synonyms(text: Column) -> Column:
    """Sorted distinct synonyms of the drugs named, from a bounded literal table."""
    t = F.lower(text)
    found = [F.when(t.rlike(rf"\b{drug}\b"), F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>")) for drug, names in P.DRUG_SYNONYMS.items()]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


def figures(body: Column) -> Column:
    """Struct of assets and captions, each distinct in order: image tags first, then citations with their derived file."""
    tag = F.lit(r"!\[(.*?)\]\((.*?)\)")
    urls, alts = F.transform(F.regexp_extract_all(body, tag, F.lit(2)), F.trim), F.transform(F.regexp_extract_all(body, tag, F.lit(1)), F.trim)
    cite = r"(?i)\bFig(?:ure)?\.?\s*\d+\.\d+(?:\s*[:—–-]\s*[^\n\)\;\.]+)?\b"
    cites = F.transform(F.regexp_extract_all(body, F.lit(cite), F.lit(0)), F.trim)
    number = r"(?i)Fig(?:ure)?\.?\s*(\d+)\.(\d+)"
    derived = F.transform(cites, lambda c: F.format_string("assets/figures/ch%02d_fig_%02d.jpeg", F.regexp_extract(c, number, 1).cast("int"), F.regexp_extract(c, number, 2).cast("int")))
    some = lambda a: F.filter(a, lambda x: x != "")
    return F.struct(F.array_distinct(some(F.concat(urls, derived))).alias("assets"), F.array_distinct(some(F.concat(alts, cites))).alias("captions"))


def with_metadata(chunks: DataFrame) -> DataFrame:
    """The derived columns of chunks (chunk_id, level, topic, disease, body)."""
    body, topic = F.col("body"), F.col("topic")
    rows = chunks.withColumn("semantic_type", initial_type(topic)).withColumn("algorithm_type", algorithm_type(body, topic)).withColumn("urgency", urgency(body, topic))
    rows = rows.withColumn("box_type", box_type(body, topic, F.col("algorithm_type"))).withColumn("synonyms", drug_synonyms(F.concat_ws(" ", body, topic)))
    rows = rows.withColumn("has_table", body.rlike(r"(?m)^\s*\|")).withColumn("has_box", body.rlike(r"###\s*\d+\.\d+|Box\s*\d+\.\d+|▲"))
    return rows.withColumn("figures", figures(body))


def serialise(chunks: DataFrame) -> DataFrame:
    """Each chunk as text with frontmatter; absent optional fields are left out."""
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c.cast("string")))
    head = F.concat_ws(
        "\n", F.lit("---"), line("chunk_id", F.col("chunk_id")), line("chunk_level", F.col("level")), line("semantic_type", F.col("semantic_type")), line("disease_focus", F.col("disease")),
        line("algorithm_type", F.col("algorithm_type")), line("clinical_urgency", F.col("urgency")), line("topic", F.col("topic")),
        F.concat(F.lit('source_lines: "'), F.col("source_lines"), F.lit('"')), F.lit("---"),
    )
    return chunks.withColumn("block", F.concat(head, F.lit("\n\n"), F.trim("body")))


def join_file(chunks: DataFrame, header: str) -> DataFrame:
    """(chapter, file): a chapter's blocks in order under a header."""
    one = chunks.groupBy("chapter").agg(F.sort_array(F.collect_list(F.struct("ord", "block"))).alias("blocks"))
    return one.select("chapter", F.concat(F.lit(header), F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n---\n\n")).alias("file"))


# ------------------------------------------------------------------ slicing markdown


def slice_markdown(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """L1 chunks (one a second-level heading) and L2 chunks (one a third-level heading in it; the section itself where it has none).

    (chapter, chunk_id, level, topic, disease, lo, hi, source_lines, pages, breadcrumb, body), numbered in order of place.
    """
    lines = page_of(explode_lines(docs, id_col, text_col))
    by = W.partitionBy("doc").orderBy("ln")
    upto = by.rowsBetween(W.unboundedPreceding, 0)
    title = F.trim(F.regexp_replace("line", r"^#+\s+", ""))
    rows = lines.withColumn("h2", F.col("line").rlike(r"^##\s")).withColumn("h3", F.col("line").rlike(r"^###\s"))
    rows = rows.withColumn("sec", F.sum(F.col("h2").cast("int")).over(upto)).where("sec > 0")
    within = W.partitionBy("doc", "sec").orderBy("ln").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("sub", F.sum(F.col("h3").cast("int")).over(within)).withColumn("parent", F.first(title).over(W.partitionBy("doc", "sec").orderBy("ln")))

    def pieces(keys: list[str], level: int) -> DataFrame:
        got = rows.groupBy("doc", "parent", *keys).agg(
            F.min("ln").alias("lo"), F.max("ln").alias("hi"), F.array_sort(F.collect_set("page")).alias("pages"), F.sort_array(F.collect_list(F.struct("ln", "line"))).alias("own"),
            F.max("sub").alias("subs"),
        )
        return got.withColumn("level", F.lit(level))

    l1 = pieces(["sec"], 1).withColumn("sub", F.lit(0))
    # the part before the first third-level heading is an L2 chunk only where there is no such heading
    l2 = pieces(["sec", "sub"], 2).join(l1.select("doc", "sec", F.col("subs").alias("most")), ["doc", "sec"]).where("sub > 0 or most = 0").drop("most")
    both = l1.unionByName(l2)
    both = both.withColumn("n", F.row_number().over(W.partitionBy("doc", "level").orderBy("lo")))
    head = F.get(F.col("own"), F.lit(0))["line"]
    return both.select(
        F.col("doc").alias("chapter"), F.concat(F.lit("L"), F.col("level"), F.lit("-"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("chunk_id"), "level",
        F.trim(F.regexp_replace(head, r"^#+\s+", "")).alias("topic"), slugify(F.col("parent")).alias("disease"), "lo", "hi", F.concat_ws("-", "lo", "hi").alias("source_lines"), "pages",
        F.concat_ws(" > ", "parent", F.when(F.col("level") == 2, F.trim(F.regexp_replace(head, r"^#+\s+", "")))).alias("breadcrumb"),
        F.array_join(F.transform(F.slice("own", 2, F.size("own")), lambda p: p["line"]), "\n").alias("body"),
    )


def strategies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per second-level section its slicing strategy: h3, h4, mcq, bold (over 40 lines, two bold heads or more) or flat."""
    lines = explode_lines(docs, id_col, text_col)
    by = W.partitionBy("doc").orderBy("ln").rowsBetween(W.unboundedPreceding, 0)
    rows = lines.withColumn("sec", F.sum(F.col("line").rlike(r"^##\s").cast("int")).over(by)).where("sec > 0")
    count = lambda p: F.count_if(F.col("line").rlike(p))
    agg = rows.groupBy("doc", "sec").agg(
        F.min_by("line", "ln").alias("head"), F.count("*").alias("lines"), count(r"^###\s").alias("h3"), count(r"^####\s").alias("h4"),
        count(r"^\*\*[^*]{3,60}\*\*\s*$").alias("bold"), count(r"^\d+\.\d+\.\s").alias("stems"),
    )
    how = ladder([("h3", F.col("h3") > 0), ("h4", F.col("h4") > 0), ("mcq", F.col("stems") > 0), ("bold", (F.col("lines") > 40) & (F.col("bold") >= 2))], "flat")
    return agg.select("doc", "sec", F.trim(F.regexp_replace("head", r"^#+\s+", "")).alias("title"), "lines", how.alias("strategy"))


def questions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, number, stem, answer): numbered stems paired with the first answer of their number."""
    lines = explode_lines(docs, id_col, text_col)
    number = F.regexp_extract("line", r"^(\d+(?:\.\d+)+)\.\s", 1)
    stems = lines.where(number != "").select("doc", "ln", number.alias("number"), F.trim(F.regexp_replace("line", r"^\d+(?:\.\d+)+\.\s*", "")).alias("stem"))
    answer = r"^Answer\s+(\d+(?:\.\d+)+)\s*[:.]\s*([A-E]|True|False)\b"
    answers = lines.where(F.col("line").rlike(answer)).select("doc", "ln", F.regexp_extract("line", answer, 1).alias("number"), F.regexp_extract("line", answer, 2).alias("answer"))
    answers = answers.groupBy("doc", "number").agg(F.min_by("answer", "ln").alias("answer"))
    return stems.join(answers, ["doc", "number"], "left").select("doc", "number", "stem", "answer")


# ------------------------------------------------------------------ type remapping


def title_type(topic: Column) -> Column:
    """The first title rule that fits, null for none."""
    return ladder([(label, any_match(topic, [f"(?i){p}" for p in pats])) for label, pats in P.TITLE_RULES])


def pure_epidemiology(body: Column) -> Column:
    """P10: two statistics or more and no clinical cue."""
    return (F.regexp_count(body, F.lit(P.EPI_STATISTIC)) >= 2) & ~any_match(body, [P.CLINICAL_CUE])


def body_type(body: Column) -> Column:
    return ladder([(label, any_match(body, [f"(?i){p}" for p in pats])) for label, pats in P.BODY_RULES])


def rule_type(topic: Column, body: Column) -> Column:
    """Title rules, then pure epidemiology, then body rules."""
    return F.coalesce(title_type(topic), F.when(pure_epidemiology(body), "epidemiology_concept"), body_type(body))


def review_type(body: Column, current: Column) -> Column:
    """The first type other than the current one that the body suggests; advice only."""
    rest = ladder([(label, (current != label) & any_match(body, [f"(?i){p}" for p in pats])) for label, pats in P.BODY_RULES])
    return F.coalesce(F.when(pure_epidemiology(body) & (current != "epidemiology_concept"), "epidemiology_concept"), rest)


def remap(chunks: DataFrame, levels: tuple[int, ...] = (2,)) -> DataFrame:
    """Adds `new_type` (title rules only; back matter and other levels keep theirs) and `review`."""
    open_ = F.col("level").isin(*levels) & ~F.coalesce(F.col("topic").rlike(P.BACKMATTER_TOPIC), F.lit(False))
    new = F.when(open_, F.coalesce(title_type(F.col("topic")), F.col("semantic_type"))).otherwise(F.col("semantic_type"))
    return chunks.withColumn("new_type", new).withColumn("review", F.when(open_ & title_type(F.col("topic")).isNull(), review_type(F.col("body"), F.col("semantic_type"))))


def adjudicate(chunks: DataFrame) -> DataFrame:
    """Corrections (chunk_id, old, new): title, recommendation cue, epidemiology or body, current."""
    cue = F.when(F.col("body").rlike(r"(?i)\bwe recommend\b|\bis recommended\b|\bshould be (?:offered|considered|given)\b"), "management_step")
    new = F.coalesce(title_type(F.col("topic")), cue, F.when(pure_epidemiology(F.col("body")), "epidemiology_concept"), body_type(F.col("body")), F.col("semantic_type"))
    return chunks.select("chapter", "chunk_id", F.col("semantic_type").alias("old"), new.alias("new")).where("old <> new")
