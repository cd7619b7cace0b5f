"""Trust classification, invariants and version declarations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import ladder
from .spans import parse


def bad_count(c: Column) -> Column:
    """A count given as text that is missing or no natural number."""
    return ~F.coalesce(c.rlike(r"^\d+$"), F.lit(False))


def classify_trust(evidence: DataFrame) -> DataFrame:
    """Adds classification, trusted and three tri-state flags to rows of evidence, by the first rung that applies.

    evidence: has_checkpoint, has_stage6, has_gaps, has_45c, has_45d, completed (booleans), gate, review_status, and the
    counts reviewed, flagged, clusters, unresolved as text, tested (boolean). Missing or malformed evidence never passes.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    number = lambda c: F.try_cast(F.col(c), "bigint") if hasattr(F, "try_cast") else F.col(c).try_cast("bigint")
    gate = F.coalesce(F.col("gate") == "PASS", F.lit(False))
    ready = yes("completed") & gate
    pending = (
        ~F.coalesce(F.col("review_status") == "COMPLETED", F.lit(False)) | bad_count(F.col("reviewed")) | bad_count(F.col("flagged"))
        | F.coalesce(number("reviewed") < number("flagged"), F.lit(True)) | bad_count(F.col("clusters")) | F.coalesce(number("clusters") != 0, F.lit(True))
        | ~yes("tested") | bad_count(F.col("unresolved")) | F.coalesce(number("unresolved") != 0, F.lit(True))
    )
    label = ladder([
        ("LEGACY_UNCHECKPOINTED", ~yes("has_checkpoint") & yes("has_stage6") & yes("has_gaps")),
        ("LEGACY_UNGATED", ~yes("has_checkpoint")),
        ("LEGACY_STALE_CHECKPOINT", ~yes("has_45c")),
        ("LEGACY_UNGATED", ~yes("has_45d")),
        ("CORPUS_REVIEW_PENDING", ready & pending),
        ("CORPUS_TESTING_READY", ready),
    ], "IN_PROGRESS")
    rows = evidence.withColumn("classification", label)
    return rows.select(
        "chapter", "classification", (F.col("classification") == "CORPUS_TESTING_READY").alias("trusted"), (F.col("review_status") == "COMPLETED").alias("semantic_review_complete"),
        F.when(~bad_count(F.col("clusters")), number("clusters") == 0).alias("completeness_review_complete"), F.lit(False).alias("retrieval_ready"),
    ).orderBy("chapter")


def exclusion_reason(chapters: DataFrame, trust: DataFrame) -> DataFrame:
    """(chapter, reason): empty for trusted chapters; no evidence excludes."""
    rows = chapters.join(trust.select("chapter", "classification", "trusted"), "chapter", "left")
    return rows.select("chapter", F.when(F.col("classification").isNull(), "no evidence").when(~F.col("trusted"), F.concat(F.lit("not trusted "), "classification")).otherwise("").alias("reason"))


def trust_label(classification: Column, trusted: Column) -> Column:
    """A52."""
    return ladder([("UNKNOWN", classification.isNull()), ("READY", trusted), ("INCOMPLETE", classification == "IN_PROGRESS")], "UNTRUSTED")


def declared_mismatches(declared: DataFrame, trust: DataFrame) -> DataFrame:
    """Chapters whose declared classification differs from the recomputed one, or that one side lacks."""
    both = declared.select("chapter", F.col("classification").alias("declared")).join(trust.select("chapter", F.col("classification").alias("recomputed")), "chapter", "full")
    return both.where(~F.col("declared").eqNullSafe(F.col("recomputed")))


def link_violations(links: DataFrame, chunks: DataFrame) -> DataFrame:
    """(chapter, chunk_id, to, problem) of related-chunk edges: dangling, self, cross_disease, asymmetric."""
    edges = links.select("chapter", "chunk_id", F.explode(F.split("related", ",")).alias("to")).where("to <> ''")
    own = chunks.select("chapter", "chunk_id", "disease")
    rows = edges.join(own, ["chapter", "chunk_id"], "left").join(own.select("chapter", F.col("chunk_id").alias("to"), F.col("disease").alias("to_disease")), ["chapter", "to"], "left")
    back = edges.select("chapter", F.col("to").alias("chunk_id"), F.col("chunk_id").alias("to"), F.lit(True).alias("back"))
    rows = rows.join(back, ["chapter", "chunk_id", "to"], "left")
    found = F.array(
        F.when(F.col("to_disease").isNull(), "dangling"), F.when(F.col("chunk_id") == F.col("to"), "self"), F.when(F.col("disease") != F.col("to_disease"), "cross_disease"),
        F.when(F.col("to_disease").isNotNull() & (F.col("chunk_id") != F.col("to")) & F.col("back").isNull(), "asymmetric"),
    )
    return rows.select("chapter", "chunk_id", "to", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("problem"))


def count_mismatches(*counts: DataFrame) -> DataFrame:
    """Chapters whose counts (chapter, n) from several sources differ or are missing in one."""
    rows = counts[0].select("chapter", "n")
    for c in counts[1:]:
        rows = rows.unionAll(c.select("chapter", "n"))
    got = rows.groupBy("chapter").agg(F.count("*").alias("sources"), F.countDistinct("n").alias("values"), F.min("n").alias("least"), F.max("n").alias("most"))
    return got.where((F.col("values") > 1) | (F.col("sources") < len(counts)))


def metadata_failures(chunks: DataFrame) -> DataFrame:
    """chunks whose source_lines do not parse, with the first error."""
    return chunks.withColumn("p", parse(F.col("source_lines"))).where(F.size("p.errors") > 0).select("chapter", "chunk_id", F.get(F.col("p.errors"), F.lit(0)).alias("error"))


def version_drift(declarations: DataFrame) -> DataFrame:
    """(package, versions, consistent) of declarations (package, place, version)."""
    got = declarations.dropDuplicates(["package", "place", "version"]).groupBy("package").agg(F.countDistinct("version").alias("versions"), F.count("*").alias("places"))
    return got.withColumn("consistent", F.col("versions") == 1)


def stage_ordinals(spark) -> DataFrame:
    """(stage, pos) of the fixed stage order."""
    return spark.createDataFrame([(s, k) for k, s in enumerate(P.STAGE_ORDER)], "stage string, pos int")
