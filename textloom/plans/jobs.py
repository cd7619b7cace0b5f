"""Composed jobs over all chapters at once: corpus checks, index compilation, finalisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import patterns as P
from ..operators import audit, chunks, fidelity, index, ledger, lines, packaging, spans
from ..sources import files


@dataclass
class Chapters:
    """Artefacts of a corpus; every table is keyed by chapter and lazily evaluated."""

    repaired: DataFrame
    chunks: DataFrame
    findings: DataFrame
    coverage: DataFrame
    precision: DataFrame
    failures: DataFrame
    verdicts: DataFrame


def run_chapters(sources: DataFrame, chunk_files: DataFrame) -> Chapters:
    """U12, U19 and the stage order X20: repair, fidelity, coverage, precision and validation of (chapter, text) sources and chunk files.

    A blocked chapter stays a row of `verdicts`; it stops nothing else.
    """
    fixed = audit.repair(sources, "chapter", "text").select(F.col("doc").alias("chapter"), "text")
    rows = chunks.parse_chunks(chunk_files)
    segments = spans.merge(spans.parse(F.col("source_lines"))["segments"])
    placed = rows.where("level = 2").select(F.col("chapter").alias("doc"), F.concat_ws("/", "chapter", "chunk_id").alias("chunk"), "body", segments.alias("segments"))
    placed = placed.withColumn("hint", spans.envelope(F.col("segments"))["lo"])
    source_lines = lines.explode_lines(fixed, "chapter", "text")
    text = spans.resolve(placed.select("doc", "chunk", "segments"), source_lines)
    pairs = placed.join(text, ["doc", "chunk"], "left").select(F.col("chunk").alias("chunk_id"), F.coalesce("text", F.array_join(F.slice(F.split("body", r"\s+"), 1, 5), " ")).alias("source"), "body")
    findings = fidelity.all_detectors(pairs).withColumn("chapter", F.substring_index("chunk_id", "/", 1))
    precise = spans.precision(placed, spans.locate(placed, source_lines))
    failures = audit.validate(chunk_files)
    return Chapters(fixed, rows, findings, audit.coverage(rows), precise, failures, audit.validation_verdict(chunk_files, failures))


def chapter_states(c: Chapters) -> DataFrame:
    """(chapter, findings, gaps, imprecise, verdict, state): the first thing that holds a chapter back."""
    count = lambda t, key, name: t.groupBy(F.col(key).alias("chapter")).agg(F.count("*").alias(name))
    rows = c.verdicts.select("chapter", "verdict").join(count(c.findings, "chapter", "findings"), "chapter", "left").join(count(c.coverage, "chapter", "gaps"), "chapter", "left")
    rows = rows.join(count(c.precision.where("verdict <> 'PRECISE'"), "doc", "imprecise"), "chapter", "left").fillna(0)
    state = F.when(F.col("gaps") > 0, "blocked").when(F.col("findings") > 0, "pending_manual").when(F.col("verdict") != "PASS", "failed").when(F.col("imprecise") > 0, "review").otherwise("complete")
    return rows.withColumn("state", state)


@dataclass
class Index:
    catalogue: DataFrame
    postings: DataFrame
    terms: DataFrame
    anchors: DataFrame
    graph: DataFrame
    subtrees: DataFrame
    polysemy: DataFrame
    trial_map: DataFrame
    acronym_map: DataFrame
    early_exit: DataFrame
    cache: DataFrame


def compile_index(chunk_files: DataFrame, index_rows: DataFrame, trusted: DataFrame | None = None) -> Index:
    """The six phases as one set of plans; chapters that `trusted` (chapter, reason) excludes are left out before their files are read."""
    if trusted is not None:
        chunk_files = chunk_files.join(trusted.where("reason = ''").select("chapter"), "chapter", "left_semi")
    cat = chunks.catalogue(chunk_files).withColumn("ord", F.xxhash64("section", "local_id"))
    entries = index.index_lines(index_rows)
    terms = index.terms(entries)
    return Index(
        cat, index.postings(cat.withColumn("all", F.concat_ws(" ", "topic", "body")), "chunk_id", "all"), terms, index.anchors(entries), index.cross_references(terms), index.subtrees(terms), index.polysemy(terms),
        index.term_to_chunks(index.trials(entries), cat, None, True, 15), index.term_to_chunks(index.acronyms(entries), cat, 1000, False, 10), index.early_exit(cat), packaging.semantic_cache(terms),
    )


def finalise(spark: SparkSession, evidence: DataFrame, root: str, write: bool = False, in_place: bool = False) -> dict[str, str]:
    """The trust ledger and its markers published together, refused where a chapter asked for is not ready."""
    trust = ledger.classify_trust(evidence)
    if trust.where(~F.col("trusted")).limit(1).count():
        raise files.Refused("not every chapter is ready")
    marker = trust.select("chapter", packaging.provenance(F.col("chapter"), P.STAGE_ORDER[-1], "1").alias("provenance"))
    return files.publish(spark, {"ledger": trust, "markers": marker}, root, write, in_place, verify=lambda t: t["ledger"].count() == t["markers"].count())
