"""Tables of shapes that the given tables lack, derived from all their rows.

Each has a base table and one expression a column, in the SQL that Spark and DuckDB share. Columns f_* are those of a
literal table of the same shape (`fixtures`), dealt to the base's rows by a key, so that its phrases stand
among the base's own texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import patterns as P
from .fixtures import TABLES, _literal
from .registry import table


@dataclass(frozen=True)
class Derived:
    base: str
    key: str
    columns: dict[str, str]
    phrases: str | None = None  #: the literal table
    where: str = "true"
    kinds: dict[str, str] = field(default_factory=dict)


def _group(key: str, n: int) -> str:
    return f"cast(floor({key} / {n}) as bigint)"


def _choice(key: str, values: list[str]) -> str:
    return f"case {key} % {len(values)} " + " ".join(f"when {k} then {_literal(v)}" for k, v in enumerate(values)) + " end"


_STAGES = P.STAGE_ORDER
DERIVED: dict[str, Derived] = {
    "titles": Derived("documents", "doc_id", {"id": "cast(doc_id as int)", "title": "f_title", "body": "f_body || ' ' || text"}, "titles"),
    "pairs": Derived("documents", "doc_id", {"chunk_id": "'p' || cast(doc_id as string)", "source": "f_source || ' ' || text", "body": "f_body || ' ' || text"}, "pairs"),
    "chapters": Derived("documents", "doc_id", {"chapter": "'d' || cast(doc_id as string)", "text": "f_text || text"}, "chapters"),
    "chunk_files": Derived("documents", "doc_id", {"chapter": "'d' || cast(doc_id as string)", "text": "f_text || ' ' || text"}, "chunk_files"),
    "notes": Derived("documents", "doc_id", {"doc": "'d' || cast(doc_id as string)", "text": "f_text || text"}, "notes"),
    "score_counts": Derived("part", "p_partkey", {
        "chapter": "'p' || cast(p_partkey as string)", "ds": "cast(p_partkey % 8 as int)", "dc": "cast(p_partkey % 7 as int)", "ts": "cast(p_size % 5 as int)", "tc": "cast(p_size % 4 as int)",
        "passed": "cast(p_partkey % 4 as int)", "failed": "cast(p_size % 2 as int)", "checked": "cast(p_partkey % 5 as int)", "gaps": "cast(p_size % 2 as int)",
    }),
    "candidates": Derived("orders", "o_orderkey", {"candidate_id": f"f_candidate_id || '-' || cast({_group('o_orderkey', 4)} as string)", "status": "f_status", "severity": "f_severity", "re_verified": "f_re_verified"}, "candidates"),
    "decisions": Derived("orders", "o_orderkey", {"candidate_id": f"f_candidate_id || '-' || cast({_group('o_orderkey', 5)} as string)", "decision": "f_decision"}, "decisions"),
    "manifest": Derived("orders", "o_orderkey", {"candidate_id": f"f_candidate_id || '-' || cast({_group('o_orderkey', 4)} as string)"}, "manifest"),
    "evidence": Derived("orders", "o_orderkey", {
        "chapter": "'c' || cast(o_orderkey as string)", "has_checkpoint": "o_orderkey % 7 <> 0", "has_stage6": "o_orderkey % 2 = 0", "has_gaps": "o_orderkey % 3 <> 0", "has_45c": "case when o_custkey % 11 <> 0 then o_custkey % 9 <> 0 end",
        "has_45d": "o_custkey % 8 <> 0", "completed": "o_orderkey % 12 <> 5", "gate": "case when o_orderkey % 13 = 0 then 'BLOCKED' else 'PASS' end", "review_status": "case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'IN_PROGRESS' end",
        "reviewed": "cast(o_custkey % 50 as string)", "flagged": "cast(o_custkey % 47 as string)", "clusters": "case o_orderkey % 17 when 0 then '2' when 1 then 'x' when 2 then null else '0' end", "tested": "o_orderkey % 19 <> 0",
        "unresolved": "case when o_orderkey % 23 = 0 then '-1' else '0' end",
    }),
    "declared": Derived("orders", "o_orderkey", {"chapter": "'c' || cast(o_orderkey + 5 as string)", "classification": _choice("o_orderkey", ["CORPUS_TESTING_READY", "IN_PROGRESS", "LEGACY_UNGATED"])}),
    "links": Derived("orders", "o_orderkey", {"chapter": f"'c' || cast({_group('o_orderkey', 3)} as string)", "chunk_id": "f_chunk_id", "related": "f_related"}, "links"),
    "link_chunks": Derived("orders", "o_orderkey", {"chapter": f"'c' || cast({_group('o_orderkey', 3)} as string)", "chunk_id": "f_chunk_id", "disease": "case when o_custkey % 4 = 0 then o_orderpriority else f_disease end"}, "link_chunks"),
    "declarations": Derived("part", "p_partkey", {
        "package": "p_brand", "place": "p_type",
        "version": "case p_partkey % 23 when 0 then 'latest' when 1 then 'v2.0.' || cast(p_size % 3 as string) || '-rc.' || cast(p_size % 12 as string) || '+7' when 2 then '2.0.1-alpha' else cast(p_size % 3 as string) || '.' || cast(p_size % 12 as string) || '.0' end",
    }),
    "index_lines": Derived("part", "p_partkey", {"ord": "cast(p_partkey as int)", "line": "case when p_partkey % 17 = 0 then 'in ' || p_name when p_partkey % 19 = 0 then p_type else f_line end"}, "index_lines"),
    "copies": Derived("part", "p_partkey", {"path": f"replace(f_path, '_RAG', '_' || cast({_group('p_partkey', 7)} as string) || '_RAG')"}, "copies"),
    "section_files": Derived("part", "p_partkey", {"section": f"f_section || '-' || cast({_group('p_partkey', 6)} as string)", "name": "f_name"}, "section_files"),
    "records": Derived("part", "p_partkey", {"record_id": "'r' || cast(p_partkey as string)", "title": "f_title || ' ' || p_name", "domain": "f_domain", "condition": "f_condition"}, "records"),
    "bridge": Derived("part", "p_partkey", {"record_id": f"'r' || cast({_group('p_partkey', 2)} as string)", "chapter": "f_chapter", "chapter_title": "p_type", "ord": "cast(p_partkey as int)"}, "bridge"),
    "claims": Derived("customer", "c_custkey", {"claim_id": "'q' || cast(c_custkey as string)", "disease": "case when c_custkey % 6 = 0 then c_mktsegment else f_disease end", "claim_type": "f_claim_type", "claim_text": "f_claim_text || c_name || ' '"}, "claims"),
    "orders": Derived("customer", "c_custkey", {"id": "cast(c_custkey as int)", "text": "f_text || ' ' || c_name"}, "orders"),
    "slides": Derived("orders", "o_orderkey", {"slide": "cast(o_orderkey as int)", "seconds": "cast(o_orderkey % 100 as int)"}, where="o_orderkey % 5 <> 3"),
    "scripts": Derived("orders", "o_orderkey", {"slide": "cast(case when o_orderkey % 9 = 4 then o_orderkey - 1 else o_orderkey end as int)", "seconds": "cast(o_custkey % 100 as int)"}, where="o_orderkey % 7 <> 2"),
    "headings": Derived("part", "p_partkey", {"heading": "f_heading || ' ' || p_name || ' ' || cast(p_partkey as string)"}, "headings"),
    "events_log": Derived("events", "event_id", {
        "prefix": "'u' || cast(user_id as string)", "source_md5": "'m' || cast(case when event_id % 5 = 0 then 9 else user_id % 3 end as string)", "stage": _choice("(event_id + user_id)", list(_STAGES)),
        "status": "case event_type when 'error' then 'FAILED' when 'view' then 'IN_PROGRESS' else 'COMPLETED' end", "version": "case when event_id % 4 <> 0 then '2.' || cast(event_id % 3 + 5 as string) end", "ord": "event_id",
    }),
    "log_sources": Derived("customer", "c_custkey", {"prefix": "'u' || cast(c_custkey as string)", "source_md5": "'m' || cast(c_custkey % 3 as string)"}),
    "stage_now": Derived("customer", "c_custkey", {"prefix": "'u' || cast(c_custkey as string)", "next_stage": _choice("c_custkey", [*_STAGES, "none"])}),
}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    d = DERIVED[name]
    rows = table(spark, sf_dir, d.base).where(d.where)
    if d.phrases:
        schema, literal = TABLES[d.phrases]
        phrases = spark.createDataFrame([(k, *r) for k, r in enumerate(literal)], "f_idx int, " + ", ".join(f"f_{c}" for c in schema.split(", ")))
        rows = rows.join(F.broadcast(phrases), F.expr(f"({d.key}) % {len(literal)}") == F.col("f_idx"))  # a few constant rows
    return rows.select(*[F.expr(e).alias(c) for c, e in d.columns.items()])


def derived_sql(*names: str) -> str:
    """The same tables as common table expressions, to be followed by a query or by more expressions."""
    out = []
    for name in names:
        d = DERIVED[name]
        source = d.base if d.base != name else f"main.{d.base}"
        if d.phrases:
            schema, literal = TABLES[d.phrases]
            cols = [c.split()[0] for c in schema.split(", ")]
            values = ",\n".join("(" + ", ".join(map(_literal, (k, *r))) + ")" for k, r in enumerate(literal))
            source += f" join (values {values}) f(f_idx, {', '.join('f_' + c for c in cols)}) on ({d.key}) % {len(literal)} = f_idx"
        out.append(f"{name} as (select {', '.join(f'{e} as {c}' for c, e in d.columns.items())} from {source} where {d.where})")
    return "with " + ",\n".join(out)
