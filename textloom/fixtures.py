"""Small literal tables for operators whose shapes the Parquet tables lack; one constant serves Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHAPTER = """{3}------
# Chapter 1
Preamble line 12
## Asthma
<!-- page: 4 -->
Asthma is a disease of the airways. It presents with wheeze and cough.
### Management
Give Salbutamol 5 mg every 4 hours. Oxygen is started at once.
- Short item
### Investigations
| Test | Result |
|---|---|
| Peak flow | Reduced by half |

Join our Telegram for more
promo line one

## Gout
Gout is caused by crystals. Acute attacks are treated with colchicine 0.5 mg twice daily for 3 days.
# Chapter 2
Box 1.2 Summary
1.1. What is gout?
1.2. What is asthma?
Answer 1.1: A
Answer 1.2: True
"""

CHUNKS = """Preamble
---
chunk_id: L1-001
chunk_level: 1
semantic_type: pathophysiology
disease_focus: asthma
topic: Asthma
source_lines: "4-16"
coverage_status: complete
---

Asthma is a disease of the airways. It presents with wheeze and cough.
Give Salbutamol 5 mg every 4 hours. A sentence that no child holds at all.
---
chunk_id: L2-001
chunk_level: 2
semantic_type: management_step
disease_focus: asthma
topic: Management
source_lines: "7-9"
coverage_status: partial
gap_note: ""
is_clinical_algorithm: true
algorithm_type: tree
---

Give Salbutamol 5 mg every 4 hours. Oxygen is started at once.
---
chunk_id: L2-002
chunk_level: 2
semantic_type: laboratory_investigation
disease_focus: acute_severe_asthma
topic: Investigations
source_lines: "10-13,20-18"
coverage_status: complete
contains_figures: true
---

Asthma is a disease of the airways. It presents with wheeze and cough.
---
chunk_id: L2-003
chunk_level: 2
disease_focus:
topic: Gout
page_numbers: []
---

Gout is caused by crystals.
---
chunk_id: L2-004
chunk_level: 2
topic: Lost"""

INDEX = ["# Index", "Note: see the front", "ACE inhibitors, 12-18, 44t", "in heart failure, 20f", "in hypertension, vs. beta-blockers", "distinguished from ARBs", "Angiotensin receptor blockers (ARB), 31", "Angiotensin converting enzyme. See ACE inhibitors",
         "Angiotensin II", "Angiotensin storm", "PARADIGM (Prospective Comparison) trial, 45-47", "eGFR (EGFR), 9c", "Beta-blockers. See also Heart failure"]

TABLES: dict[str, tuple[str, list[tuple]]] = {
    "chapters": ("chapter string, text string", [("c1", CHAPTER), ("c2", "## Only\n\nplain text\n"), ("c3", ""), ("c4", None)]),
    "chunk_files": ("chapter string, text string", [("c1", CHUNKS), ("c2", "no chunk here")]),
    "index_lines": ("ord int, line string", [(k, s) for k, s in enumerate(INDEX)]),
    "titles": ("id int, title string, body string", [
        (1, "Adverse effects of statins", "Muscle pain in 5 % of users"), (2, "Investigations", "The ECG shows ST elevation."), (3, "CURB-65 score", "Score: 1 point each; 3 points is severe"),
        (4, "Stepwise therapy", "step 1 then step 2"), (5, "Emergency care", "Cardiac arrest: adrenaline 1 mg"), (6, "Epidemiology", "Prevalence is 2%  of adults. Incidence rises."), (7, "Overview summary", "| a | b |\n| c | d |"),
        (8, "Other", "If suspected, perform CT when high risk."), (9, "Websites", "links"), (10, "Management", "Paracetamol and frusemide are given."),
    ]),
    "pairs": ("chunk_id string, source string, body string", [
        ("a", "Give 5 mg twice daily for 7 days.", "Give 5 mg twice daily for 7 days."), ("b", "Give 5 mg, then 10 mg. BP < 90 mmHg.", "Give 5 mg, then 100 mg. BP > 90 mmHg."),
        ("c", "Aspirin is not indicated here.", "Aspirin is indicated here."), ("d", "Symptoms increase before meals.", "Symptoms change."), ("e", "first-line x then confirmatory y", "confirmatory y then first-line x"),
        ("f", "every 4 hours or at least 3-5 times", "every 6 hours"), ("g", "", "new 3 mg"),
    ]),
    "candidates": ("candidate_id string, status string, severity string, re_verified boolean", [
        ("k1", "VERIFIED", "CONFIRMED_CORRUPTION", False), ("k2", "CANDIDATE", "CANDIDATE", None), ("k3", "VERIFIED", "RESOLVED_NOT_A_CORRUPTION", None), ("k4", "VERIFIED", "CONFIRMED_CORRUPTION", True),
    ]),
    "decisions": ("candidate_id string, decision string", [("k2", "confirmed_corruption"), ("k9", "false_positive"), ("k4", "false_positive"), ("k1", "not_a_corruption"), ("k3", "legitimate_paraphrase")]),
    "manifest": ("candidate_id string", [("k1",), ("k1",), ("k3",), ("zz",)]),
    "evidence": ("chapter string, has_checkpoint boolean, has_stage6 boolean, has_gaps boolean, has_45c boolean, has_45d boolean, completed boolean, gate string, review_status string, reviewed string, flagged string, clusters string, tested boolean, unresolved string", [
        ("01", False, True, True, None, None, None, None, None, None, None, None, None, None), ("02", False, True, False, None, None, None, None, None, None, None, None, None, None),
        ("03", True, True, True, False, False, True, "PASS", "COMPLETED", "1", "1", "0", True, "0"), ("04", True, True, True, True, False, True, "PASS", "COMPLETED", "1", "1", "0", True, "0"),
        ("05", True, True, True, True, True, True, "PASS", "COMPLETED", "5", "5", "0", True, "0"), ("06", True, True, True, True, True, True, "PASS", "IN_PROGRESS", "5", "5", "0", True, "0"),
        ("07", True, True, True, True, True, True, "PASS", "COMPLETED", "4", "5", "0", True, "0"), ("08", True, True, True, True, True, True, "PASS", "COMPLETED", "True", "5", "0", True, "0"),
        ("09", True, True, True, True, True, True, "PASS", "COMPLETED", "5", "5", None, True, "0"), ("10", True, True, True, True, True, True, "PASS", "COMPLETED", "5", "5", "2", True, "0"),
        ("11", True, True, True, True, True, True, "PASS", "COMPLETED", "5", "5", "0", False, "0"), ("12", True, True, True, True, True, True, "PASS", "COMPLETED", "5", "5", "0", True, "-1"),
        ("13", True, True, True, True, True, False, "PASS", "COMPLETED", "5", "5", "0", True, "0"), ("14", True, True, True, True, True, True, "BLOCKED", None, None, None, None, None, None),
    ]),
    "declared": ("chapter string, classification string", [("05", "CORPUS_TESTING_READY"), ("06", "CORPUS_TESTING_READY"), ("99", "IN_PROGRESS")]),
    "links": ("chapter string, chunk_id string, related string", [("c1", "L2-001", "L2-002,L2-001,L2-009"), ("c1", "L2-002", "L2-001"), ("c1", "L2-003", "L2-001")]),
    "link_chunks": ("chapter string, chunk_id string, disease string", [("c1", "L2-001", "asthma"), ("c1", "L2-002", "asthma"), ("c1", "L2-003", "gout")]),
    "declarations": ("package string, place string, version string", [("a", "x", "1.2.3"), ("a", "y", "1.2.3"), ("a", "y", "1.2.3"), ("b", "x", "v2.0.0-rc.1+7"), ("b", "y", "2.0.0"), ("c", "x", "latest"), ("d", "x", "1.10.0"), ("e", "x", "2.0.0-alpha")]),
    "paths": ("path string", [("skills/x/SKILL.md",), ("AGENTS.md",), ("config/approval_rules.json",), ("hooks/run.py",), (".env",), ("a/b/c/d/e.md",), ("memory/notes.md",), ("doc/file.pdf",), ("settings.toml",), ("z.md",), ("keys/id.pem",)]),
    "copies": ("path string", [("/r/ch1/rag_pipeline_output/a_RAG.md",), ("/r/ch1/a_RAG.md",), ("/r/backup/a_RAG.md",), ("/r/x/y/b_RAG.md",), ("/r/z/b_RAG.md",), ("/r/audit_2/c_RAG.md",), ("/r/c/c_RAG.md",)]),
    "section_files": ("section string, name string", [("s1", "a_RAG_Optimised.md"), ("s1", "x.pdf"), ("s2", "a_chunks.md"), ("s3", "markdown.md"), ("s4", "X.PDF"), ("s5", "readme")]),
    "folders": ("folder string", [("Cardiovascular_Disease",), ("01 Respiratory Medicine final",), ("Unknown thing",), ("Heart",)]),
    "sections": ("section string", [("Cardiovascular Disease.pdf",), ("Respiratory Medicine.pdf",), ("Medicine.pdf",)]),
    "events_log": ("prefix string, source_md5 string, stage string, status string, version string, ord long", [
        ("p", "m1", "1", "COMPLETED", "2.6", 1), ("p", "m1", "2", "IN_PROGRESS", "2.6", 2), ("p", "m1", "2", "COMPLETED", None, 3), ("p", "m0", "3", "COMPLETED", "2.5", 4), ("q", "m2", "1", "FAILED", "2.7", 5), ("r", "m9", "1", "COMPLETED", "2.7", 6),
    ]),
    "log_sources": ("prefix string, source_md5 string", [("p", "m1"), ("q", "m2"), ("r", "m3")]),
    "records": ("record_id string, title string, domain string, condition string", [("r1", "Dengue fluid", "Tropical", "dengue"), ("r2", "TTP and HUS", "Haematology", "ttp"), ("r3", "Gout", "Rheumatology", "gout"), ("r4", "Anemia in CKD", "Renal", "iron lack")]),
    "bridge": ("record_id string, chapter string, chapter_title string, ord int", [("r1", "6", "Infection", 1), ("r1", "13", "Tropics", 2), ("r3", "24", "Bones", 3)]),
    "claims": ("claim_id string, disease string, claim_type string, claim_text string", [("q1", "Gout", "CONTRAINDICATION", " thiazides "), ("q2", "", "DIAGNOSIS", "urate"), ("q3", "Gout", "TREATMENT", "colchicine"), ("q4", "Gout", "PEARL", "x")]),
    "orders": ("id int, text string", [(1, "Start warfarin with aspirin"), (2, "metformin 500 mg, eGFR 20"), (3, "Paracetamol 1 g"), (4, "aspirin and WARFARIN, metformin egfr")]),
    "slides": ("slide int, seconds int", [(1, 60), (2, 90), (3, 30), (4, 10)]),
    "scripts": ("slide int, seconds int", [(1, 50), (2, 20), (3, 20), (3, 20), (7, 5)]),
    "score_counts": ("chapter string, ds int, dc int, ts int, tc int, passed int, failed int, checked int, gaps int", [("a", 10, 9, 0, 0, 8, 2, 4, 1), ("b", 0, 0, 0, 0, 0, 0, 0, 0), ("c", 4, 6, 3, 1, 5, 0, 2, 0)]),
    "headings": ("heading string", [("Layer 0 foundation",), ("Layer 2: core",), ("Exam trap list",), ("Notes",), ("Coverage Declaration",)]),
    "notes": ("doc string, text string", [("n1", "# LAYER 1\nA claim about gout with six words here [chunk: L2-001]\n## Details\n- uncited item text\n# Visual asset\nno claim is checked in this part\n"), ("n2", "# Layer 2\n- cited [Anchor: Alpha-16-L2-045] and Beta Fig. 3.4\n")]),
}


def load(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = TABLES[name]
    return spark.createDataFrame(rows, schema)


def _literal(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + v.replace("'", "''") + "'"


def with_sql(*names: str) -> str:
    """The fixtures as common table expressions, to be followed by a query or by more expressions."""
    kinds = {"string": "varchar", "int": "integer", "long": "bigint", "boolean": "boolean"}
    out = []
    for name in names:
        schema, rows = TABLES[name]
        cols = [c.split() for c in schema.split(", ")]
        first = ", ".join(f"cast(column{k} as {kinds[t]}) as {c}" for k, (c, t) in enumerate(cols))
        labels = ", ".join(f"column{k}" for k in range(len(cols)))
        values = ",\n".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
        out.append(f"{name} as (select {first} from (values {values}) as t({labels}))")
    return "with " + ",\n".join(out)
