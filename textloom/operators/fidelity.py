"""Fidelity of chunks to their source: multiset differences, flips, sequences, boundaries, gates, decisions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import ladder, short_hash
from ..functions.unicode import markers
from . import merkle


def tokens_by_check(pairs: DataFrame, text: str, checks: dict[str, list[str]] | None = None) -> DataFrame:
    """(chunk_id, check, token, n): hits of every pattern of a check, added up over patterns; matched without case, kept as written."""
    rows = []
    for check, pats in (checks or P.DETECTORS).items():
        hits = F.flatten(F.array(*[F.regexp_extract_all(F.col(text), F.lit(f"(?i){p}"), F.lit(0)) for p in pats]))
        rows.append(F.struct(F.lit(check).alias("check"), hits.alias("tokens")))
    flat = pairs.select("chunk_id", F.explode(F.array(*rows)).alias("c")).select("chunk_id", "c.check", F.explode("c.tokens").alias("token"))
    return flat.groupBy("chunk_id", "check", "token").agg(F.count("*").alias("n"))


def multiset_diff(pairs: DataFrame, checks: dict[str, list[str]] | None = None) -> DataFrame:
    """Findings of (chunk_id, source, body).

    missing: a token that the chunk has less often, one row each; added: a token that the source lacks altogether.
    """
    a, b = tokens_by_check(pairs, "source", checks).withColumnRenamed("n", "src"), tokens_by_check(pairs, "body", checks).withColumnRenamed("n", "got")
    both = a.join(b, ["chunk_id", "check", "token"], "full").fillna(0, ["src", "got"])
    kind = F.when(F.col("got") < F.col("src"), "missing").when(F.col("src") == 0, "added")
    return both.withColumn("kind", kind).where("kind is not null").select(
        "chunk_id", "check", "kind", F.when(F.col("kind") == "missing", F.col("token")).alias("source_value"), F.when(F.col("kind") == "added", F.col("token")).alias("chunk_value")
    )


def scanned(pairs: DataFrame) -> DataFrame:
    """(check, scanned): hits in the sources."""
    return tokens_by_check(pairs, "source").groupBy("check").agg(F.sum("n").alias("scanned"))


def needle(pattern: str) -> str:
    """The longest run of lower-case letters, digits and spaces that a pattern begins with and every match holds; empty where it has none."""
    return "" if "|" in pattern else re.match(r"(?:[a-z0-9 ](?![*?{]))*", pattern).group()


def paired_flips(pairs: DataFrame, terms: list[tuple[str, str]], check: str) -> DataFrame:
    """A term for its opposite is flipped, a term without either is missing.

    A longer term's occurrences are blanked before the shorter one is looked for. Texts are lowered once; a pattern is
    tried only where its plain words (`needle`) stand in the text.
    """
    found = []
    pairs = pairs.select("chunk_id", F.lower("source").alias("source"), F.lower("body").alias("body"))
    for a, b in terms:
        has_a = lambda c: F.contains(F.col(c), F.lit(needle(a))) & F.col(c).rlike(rf"\b{a}\b")  # noqa: B023, E731
        has_b = lambda c: F.contains(F.col(c), F.lit(needle(b))) & F.regexp_replace(F.col(c), rf"\b{a}\b", " ").rlike(rf"\b{b}\b")  # noqa: B023, E731
        sa, sb, ca, cb = has_a("source"), has_b("source"), has_a("body"), has_b("body")
        row = lambda k, s, c: F.struct(F.lit(k).alias("kind"), F.lit(s).alias("source_value"), F.lit(c).cast("string").alias("chunk_value"))
        found.append(
            F.when(sa & ~sb & cb & ~ca, row("flipped", a, b)).when(sb & ~sa & ca & ~cb, row("flipped", b, a))
            .when(sa & ~ca & ~cb, row("missing", a, None)).when(sb & ~ca & ~cb, row("missing", b, None))
        )
    rows = pairs.select("chunk_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f"))
    return rows.select("chunk_id", F.lit(check).alias("check"), "f.kind", "f.source_value", "f.chunk_value")


def sequence_changes(pairs: DataFrame) -> DataFrame:
    """Markers that the chunk has less often, and a change of order where the multisets agree."""
    find = markers(P.SEQUENCE_MARKERS)
    rows = pairs.select("chunk_id", find("source").alias("a"), find("body").alias("b"))
    lost = F.filter(F.array_distinct("a"), lambda m: F.size(F.filter("b", lambda x: x == m)) < F.size(F.filter("a", lambda x: x == m)))
    missing = F.transform(lost, lambda m: F.struct(F.lit("missing").alias("kind"), m.alias("source_value"), F.lit(None).cast("string").alias("chunk_value")))
    moved = (F.array_sort("a") == F.array_sort("b")) & (F.size("a") > 0) & (F.col("a") != F.col("b"))
    order = F.when(moved, F.array(F.struct(F.lit("reordered").alias("kind"), F.array_join("a", " -> ").alias("source_value"), F.array_join("b", " -> ").alias("chunk_value"))))
    rows = rows.select("chunk_id", F.explode(F.concat(missing, F.coalesce(order, F.slice(missing, 1, 0)))).alias("f"))
    return rows.select("chunk_id", F.lit("sequence").alias("check"), "f.kind", "f.source_value", "f.chunk_value")


def all_detectors(pairs: DataFrame) -> DataFrame:
    """The ten single-chunk detectors, with ids."""
    found = multiset_diff(pairs).unionByName(paired_flips(pairs, P.NEGATION_PAIRS, "negation")).unionByName(paired_flips(pairs, P.POLARITY_PAIRS, "polarity")).unionByName(sequence_changes(pairs))
    return with_ids(found)


def with_ids(findings: DataFrame) -> DataFrame:
    """candidate_id from the finding's fields and its ordinal among equal (check, chunk_id)."""
    by = W.partitionBy("check", "chunk_id").orderBy("kind", "source_value", "chunk_value")
    rows = findings.withColumn("ordinal", F.row_number().over(by))
    return rows.withColumn("candidate_id", short_hash(*map(F.col, ("check", "chunk_id", "kind", "source_value", "chunk_value", "ordinal"))))


def classify_boundary(same_chunk: Column, same_disease: Column, adjacent: Column, at_heading: Column) -> Column:
    """F43."""
    return ladder([
        ("INTACT", same_chunk), ("INTENTIONAL_SECTION_SPLIT", at_heading), ("SAFE_LINKED_SPLIT", same_disease & adjacent), ("CRITICAL_SEPARATION", ~same_disease),
    ], "AMBIGUOUS")


def boundary_loss(sections: DataFrame, parts: DataFrame) -> DataFrame:
    """Drug and dose pairs of sections (section, body) that no part (section, chunk_id, ord, disease, body, lo, hi) holds together.

    Adds `between_lo`, `between_hi`: the gap that headings_between() looks into; a half found nowhere is AMBIGUOUS.
    """
    pair = F.arrays_zip(F.regexp_extract_all("body", F.lit(P.DRUG_DOSE), F.lit(1)).alias("drug"), F.regexp_extract_all("body", F.lit(P.DRUG_DOSE), F.lit(2)).alias("dose"))
    pairs = sections.select("section", F.posexplode(pair).alias("k", "p")).select("section", "k", "p.drug", "p.dose")
    own = parts.groupBy("section").agg(F.sort_array(F.collect_list(F.struct("ord", "chunk_id", "disease", "body", "lo", "hi"))).alias("parts"))
    rows = pairs.join(own, "section", "left")
    holds = lambda c: F.filter("parts", lambda p: F.contains(p["body"], F.col(c)))
    rows = rows.withColumn("whole", F.exists("parts", lambda p: F.contains(p["body"], F.col("drug")) & F.contains(p["body"], F.col("dose"))))
    rows = rows.where(~F.coalesce("whole", F.lit(False))).withColumn("a", F.get(holds("drug"), F.lit(0))).withColumn("b", F.get(holds("dose"), F.lit(0)))
    same = F.coalesce((F.col("a.disease") == F.col("b.disease")) & (F.col("a.disease") != ""), F.lit(False))
    near = F.abs(F.col("a.ord") - F.col("b.ord")) == 1
    found = F.col("a").isNotNull() & F.col("b").isNotNull()
    first, second = F.when(F.col("a.hi") <= F.col("b.lo"), F.col("a")).otherwise(F.col("b")), F.when(F.col("a.hi") <= F.col("b.lo"), F.col("b")).otherwise(F.col("a"))
    label = F.when(~found, "AMBIGUOUS").otherwise(classify_boundary(F.lit(False), same, near, F.lit(False)))
    return rows.select(
        "section", F.when(found, F.concat_ws("/", "a.chunk_id", "b.chunk_id")).otherwise("?").alias("chunk_id"), F.concat_ws(" ", "drug", "dose").alias("source_value"),
        F.when(found, "split").otherwise("incomplete").alias("kind"), label.alias("boundary"), first["hi"].alias("between_lo"), second["lo"].alias("between_hi"),
    )


def gate(candidates: DataFrame, run: list[str], required: list[str] = P.REQUIRED_DETECTORS) -> DataFrame:
    """One row: verdict, unresolved counts and detectors not tested. Candidates: status, severity, re_verified."""
    not_tested = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.array(*map(F.lit, run)) if run else F.array().cast("array<string>")))
    counts = candidates.agg(
        F.count_if(F.col("status") != "VERIFIED").alias("unresolved_candidates"),
        F.count_if((F.col("severity") == "CONFIRMED_CORRUPTION") & ~F.coalesce("re_verified", F.lit(False))).alias("unresolved_corruptions"), F.count("*").alias("candidate_count"),
    )
    verdict = F.when(F.size(not_tested) > 0, "NOT_TESTED").when((F.col("unresolved_candidates") > 0) | (F.col("unresolved_corruptions") > 0), "BLOCKED").otherwise("PASS")
    return counts.select(verdict.alias("verdict"), "unresolved_candidates", "unresolved_corruptions", "candidate_count", F.array_join(not_tested, ",").alias("not_tested"))


def gate_action(verdict: Column, unresolved: Column) -> Column:
    """What a stage does with its gate."""
    return ladder([("complete", verdict == "PASS"), ("failed", verdict == "NOT_TESTED"), ("pending_manual", unresolved > 0)], "blocked")


def apply_decisions(candidates: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates with decisions (candidate_id, decision) applied, and the decisions that match none."""
    known = decisions.where(F.col("decision").isin(*P.DECISIONS))
    rows = candidates.join(known, "candidate_id", "left")
    severity = F.when(F.col("decision") == "confirmed_corruption", "CONFIRMED_CORRUPTION").when(F.col("decision").isNotNull(), "RESOLVED_NOT_A_CORRUPTION").otherwise(F.col("severity"))
    rows = rows.withColumn("severity", severity).withColumn("status", F.when(F.col("decision").isNotNull(), "VERIFIED").otherwise(F.col("status")))
    bad = decisions.join(known.join(candidates, "candidate_id", "left_semi").select("candidate_id"), "candidate_id", "left_anti")
    return rows, bad


def reconcile(manifest: DataFrame, current: DataFrame, key: str = "candidate_id") -> DataFrame:
    """(key, problem): unknown, missing and duplicate rows of a manifest against the current set."""
    listed = manifest.groupBy(key).agg(F.count("*").alias("listed"))
    both = listed.join(current.select(key).distinct().withColumn("known", F.lit(True)), key, "full")
    problem = F.array(F.when(F.col("known").isNull(), "unknown"), F.when(F.col("listed").isNull(), "missing"), F.when(F.col("listed") > 1, "duplicate"))
    return both.select(key, F.explode(F.filter(problem, lambda p: p.isNotNull())).alias("problem"))


def apply_whole(rows: DataFrame, updates: DataFrame, key: str, column: str, stale: str | None = None) -> DataFrame:
    """An update join that applies all of `updates` or, where one is unknown or stale, none.

    updates: key, new value in `column`, and in `stale` the hash that the row must still have.
    """
    change = updates.select(F.col(key), F.col(column).alias("__new"), *([F.col(stale).alias("__seen")] if stale else []))
    joined = rows.withColumn("__is", F.lit(True)).join(change, key, "full")
    bad = F.col("__is").isNull()
    if stale:
        bad = bad | (F.col("__new").isNotNull() & ~F.col("__seen").eqNullSafe(F.sha2(F.col(column), 256)))
    refused = bool(joined.where(bad).limit(1).count())
    value = F.col(column) if refused else F.coalesce("__new", F.col(column))
    return joined.where("__is").withColumn(column, value).select(*rows.columns)


def set_hash(rows: DataFrame, cols: list[str]) -> DataFrame:
    """one order-independent sha-256 of a set of rows.

    Up to merkle.LEAF rows it is that of the sorted row hashes; larger sets are hashed by a tree of such leaves.
    """
    return merkle.set_hash(rows, cols)
