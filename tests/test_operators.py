"""Cases that the literal fixtures and SQL do not reach."""

import pytest
from pyspark.sql import functions as F

from textloom import patterns as P
from textloom.fixtures import load
from textloom.functions import columns as C
from textloom.functions import unicode as U
from textloom.operators import audit, chunks, fidelity, guard, index, ledger, lines, lint, retrieval, spans


def one(spark, expression, **values):
    row = spark.range(1)
    for name, v in values.items():
        row = row.withColumn(name, F.lit(v))
    return row.select(expression.alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, C.lines_of(F.col("t")), t="a\r\nb c\n") == ["a", "b", "c"] and one(spark, C.lines_of(F.col("t")), t="") == []
    assert one(spark, C.words_of(F.col("t")), t="") == []
    assert one(spark, C.search_tokens(F.col("t")), t="The BP is 5 mg/kg of ECG2") == ["bp", "mg", "kg", "ecg2"]
    assert one(spark, C.slugify(F.col("t")), t="1.2 Naïve  T-cells!") == "naïve_t_cells"
    assert one(spark, C.normalise_anchor(F.col("t")), t=" **a** – “b” ") == "a - “b”"
    assert one(spark, C.anchor_units(F.col("t")), t="# H\n| aaa bbb | c |\n|---|---|\n- Finger clubbing\nshort\nFirst one here. Second one.") == ["aaa bbb | c", "Finger clubbing", "First one here.", "Second one."]
    assert one(spark, C.hamming_hex(F.col("a"), F.col("b")), a="ffffffffffffffff", b="fffffffffffffffe") == 1
    assert round(one(spark, C.contrast(C.luminance(F.lit(255), F.lit(255), F.lit(255)), C.luminance(F.lit(0), F.lit(0), F.lit(0)))), 2) == 21.0


@pytest.mark.parametrize("raw, plain", [
    (r"platelets 10^{9}/L and 10^{12}/L, 10^-3 and 10^{-3}", "platelets 10⁹/L and 10¹²/L, 10⁻³ and 10⁻³"),
    (r"$V_{max}$ rises, $x > 5$, \( \geq 65 \)", "Vmax rises, x > 5, >= 65"),
    ("pay $5 to $10 for $y$", "pay $5 to $10 for y"),
    (r"\(\frac{a}{b}\) stays, \(a\) goes", r"\(\frac{a}{b}\) stays, a goes"),
    (r"$\beta 2$ and $\alpha$ and 3 \cdot 4 and \rho and \( \mu \)mol and 5 \mu g", "beta2 and alpha and 3  *  4 and rho and µmol and 5 mcg"),
    (r"$S_1$, $S_2$ gallops, drug_dosing ~5%, $^{18}$ and $^{1,119-121}$", "S1, S2 gallops, drug_dosing ~5%, [18] and [1,119-121]"),
    (r"\( \Delta P = 4V_{max}^2 \) is ~ 4 m/s", "Delta P = 4Vmax^2 is ~ 4 m/s"),
])
def test_math_markup(spark, raw, plain):
    assert one(spark, U.clean_latex(F.col("t")), t=raw) == plain


def test_sanitised_text(spark):
    assert one(spark, U.sanitise(F.col("t")), t="10 µg and 25µg ≥ 50\u00a0kPa \u200bat 5.0 mg QD, “a”–b 37°C $S_2$") == "10 mcg and 25mcg >= 50 kPa at 5 mg once daily, \"a\" - b 37 deg C S2"


def test_slide_rules_by_place_and_citation(spark):
    slides = [(1, "Give 10U IU QD MSO4 5 µg 1.0 mg .5 mg 3 cc @ 4 OD 10mg", ""), (2, "Drug of choice, recommended", ""), (3, "Drug of choice", "Smith et al"), (4, "a significant 20% reduction", ""), (5, "significant, p < 0.05", ""),
              (6, "aged 95, MRN: 12345, 12/31/2020, patient A.B. FDA-approved off-label Brand®", ""), (7, None, None)]
    rows = spark.createDataFrame([("d", *s) for s in slides], "deck string, slide int, text string, note string")
    rules = lambda *a: {k: {r.rule for r in lint.slide_findings(rows, *a).where(F.col("slide") == k).collect()} for k in range(1, 8)}
    us, none, cme = rules("us"), rules("none"), rules("us", True)
    assert us[1] == {"MED-U", "MED-IU", "MED-QD", "MED-MS", "MED-MCG", "MED-TRAILZERO", "MED-NAKEDDEC", "MED-CC", "MED-AT", "MED-EYEEAR", "MED-NOSPACE"}
    assert (us[2], us[3], us[4], us[7]) == ({"EV-RECNOSRC"}, set(), set(), set())
    assert (none[2], none[4], none[5]) == (set(), {"EV-RRONLY", "EV-SIGNIF"}, set())
    assert us[6] == {"PHI-AGE90", "PHI-MRN", "PHI-DATE", "PHI-INITIALS", "JUR-FDA", "JUR-OFFLABEL"} and cme[6] == us[6] | {"CME-TRADENAME"}


def seconds_by_rounds(weights, total):
    """Half-even rounding, a floor of four, then one second a slide in turn."""
    out = [max(4, round(total * w / sum(weights))) for w in weights]
    change, k = total - sum(out), 0
    while change and k < 10_000:
        at = k % len(out)
        if change > 0 or out[at] > 4:
            out[at] += 1 if change > 0 else -1
            change += -1 if change > 0 else 1
        k += 1
    return out


@pytest.mark.parametrize("total", [20, 33, 47, 90, 301, 1234])
def test_slide_seconds_equal_rounds_of_single_seconds(spark, total):
    slides = [("divider", "low", False), ("safety", "high", False), ("general", "medium", True), ("odd role", "low", False), ("case", "high", False), ("title", None, False), ("reference", "low", True)]
    weights = [P.ROLE_WEIGHTS.get(r, 1.0) * P.DENSITY_WEIGHTS.get(d, 1.0) * (0.35 if twice else 1.0) for r, d, twice in slides]
    rows = spark.createDataFrame([("d", k, *s) for k, s in enumerate(slides)], "deck string, slide int, role string, density string, duplicate boolean")
    assert [r.seconds for r in lint.allocate(rows, total).orderBy("slide").collect()] == seconds_by_rounds(weights, total)


def test_unicode_functions(spark):
    rows = spark.createDataFrame([(bytearray(b"\xef\xbb\xbfna\xc3\xafve \x93q\x94 \x81"),), (None,)], "b binary")
    assert [r[0] for r in rows.select(U.decode_bytes("b")).collect()] == ["naïve “q” �", None]
    assert one(spark, U.clean_latex(F.col("t")), t=r"10^{9} \geq5 \mu g $^{18}$ S_1") == "10⁹ >= 5 mcg [18] S1"
    assert one(spark, U.excerpt(F.col("t"), F.lit(10)), t="One two. Three four five.") == "One two. [...]"
    assert one(spark, U.nfkc(F.col("t")), t="10⁹") == "109" and one(spark, U.nfc(F.col("t")), t="10⁹") == "10⁹"
    assert one(spark, U.similarity(F.col("a"), F.col("b")), a="abcd", b="abxd") == 0.75


@pytest.mark.parametrize("raw, text, errors", [("1-3,2-4", "1-4", 0), ("5,5", "5", 0), ("1-3,10-12", "1-3,10-12", 0), ("1049- 1053-1060", "", 1), (None, "", 0), (" 7 - 9 ", "7-9", 0)])
def test_span_grammar(spark, raw, text, errors):
    p = spans.parse(F.lit(raw).cast("string"))
    got = spark.range(1).select(spans.serialise(p["segments"]).alias("t"), F.size(p["errors"]).alias("e")).first()
    assert (got.t, got.e) == (text, errors)
    again = spans.parse(F.lit(got.t))
    assert spark.range(1).select(spans.serialise(again["segments"])).first()[0] == got.t


@pytest.mark.parametrize("found, declared, verdict", [([1, 2, 3], [(1, 3)], "PRECISE"), ([1, 2, 9], [(1, 3)], "UNDER_INCLUSIVE"), ([1, 2, 8, 9], [(1, 9)], "OVER_INCLUSIVE"), ([None, None, 1], [(1, 1)], "UNRESOLVED"), ([1, 2, 8, 9], [(1, 2), (8, 9)], "PRECISE")])
def test_precision_verdicts(spark, found, declared, verdict):
    located = spark.createDataFrame([("d", "c", k, n) for k, n in enumerate(found)], "doc string, chunk string, unit int, ln int")
    rows = spark.createDataFrame([("d", "c", declared)], "doc string, chunk string, segments array<struct<lo:int,hi:int>>")
    assert spans.precision(rows, located).first()["verdict"] == verdict


def test_detectors_on_clean_and_corrupt_pairs(spark):
    found = {(r.chunk_id, r["check"], r.kind) for r in fidelity.all_detectors(load(spark, "pairs")).collect()}
    assert not [f for f in found if f[0] == "a"]
    assert {("b", "numeric", "missing"), ("b", "inequality", "added"), ("c", "negation", "flipped"), ("d", "polarity", "missing"), ("e", "sequence", "reordered"), ("g", "dose", "added")} <= found
    ids = [r.candidate_id for r in fidelity.all_detectors(load(spark, "pairs")).collect()]
    assert len(ids) == len(set(ids)) and all(len(i) == 8 for i in ids)


def test_percent_and_compound_units_follow_the_patterns(spark):
    rows = spark.createDataFrame([("a", "5% of users, 5 mg/kg daily", "")], "chunk_id string, source string, body string")
    units = [r.source_value for r in fidelity.multiset_diff(rows, {"unit": P.DETECTORS["unit"]}).collect()]
    assert units == ["5 mg"]


def test_headings_inherit_from_the_nearest_enclosing_one(spark):
    text = "# LAYER 1\n## a\n### b\n# Notes\n## LAYER 2\n### c\n## d\n# VISUAL ASSET\n## LAYER 3\n"
    rows = lines.explode_lines(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t")
    got = [r.kind for r in lines.heading_kinds(rows, guard.section_kind(F.col("line"))).orderBy("ln").collect()]
    assert got == ["anchored", "anchored", "anchored", "exempt", "layer2", "layer2", "exempt", "exempt", "anchored"]


def test_chunk_splitting_keeps_odd_chunks(spark):
    files = spark.createDataFrame([("a", "---\nchunk_id: A\n---"), ("b", "---\nchunk_id: A\ntopic: x"), ("c", "pre\n---\nchunk_id: A\n---\n\nbody\n---\nchunk_id: B\n---\n")], "chapter string, text string")
    got = [(r.chapter, r.closed) for r in chunks.split_blocks(files).orderBy("chapter", "ord").collect()]
    assert got == [("a", True), ("b", False), ("c", True), ("c", True)]


def test_slicing_round_trip(spark):
    rows = chunks.slice_markdown(load(spark, "chapters"), "chapter", "text")
    got = {(r.chapter, r.chunk_id): (r.topic, r.lo, r.hi) for r in rows.collect()}
    assert got["c1", "L1-001"] == ("Asthma", 4, 17) and got["c1", "L2-002"][0] == "Investigations" and ("c2", "L2-001") in got
    blocks = chunks.join_file(chunks.serialise(chunks.with_metadata(rows.withColumn("ord", F.col("lo")))), "head\n\n---\n\n")
    back = chunks.parse_chunks(blocks.withColumnRenamed("file", "text"))
    assert {(r.chapter, r.chunk_id) for r in back.collect()} == set(got)


def test_repair_sweeps_unprotected_lines(spark):
    got = {r.doc: r for r in audit.repair(load(spark, "chapters"), "chapter", "text").collect()}
    assert "Telegram" not in got["c1"].text and "1.1. What is gout?" in got["c1"].text and "<!-- page: 3 -->" in got["c1"].text
    assert "## Chapter 2" in got["c1"].text and "### Box 1.2 Summary" in got["c1"].text and got["c3"].text == ""
    assert one(spark, audit.table_delimiters(F.col("t")), t="| a | b |\n| 1 | 2 |") == "| a | b |\n|---|---|\n| 1 | 2 |"


def test_coverage_and_spot_check(spark):
    rows = chunks.parse_chunks(load(spark, "chunk_files"))
    assert [(r.chunk_id, r.covered, r.total) for r in audit.coverage(rows).collect()] == [("L1-001", 3, 4)]
    got = {r.chunk_id: r.result for r in audit.spot_check(rows, load(spark, "chapters")).collect()}
    assert got == {"L2-001": "passed", "L2-002": "passed", "L2-003": "skipped"}


def test_invalid_counts_never_pass(spark):
    bad = spark.createDataFrame([(None,), ("True",), ("-1",), ("1.5",), ("0",), ("12",)], "c string")
    assert [r[0] for r in bad.select(ledger.bad_count(F.col("c"))).collect()] == [True, True, True, True, False, False]


def test_zero_scores_rank_by_document(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "alpha alpha"), (4, "")], "id int, t string")
    asked = spark.createDataFrame([(9, ["alpha"])], "query int, terms array<string>")
    scores = retrieval.bm25(docs, asked, "id", "t")
    rank = lambda d: retrieval.target_ranks(scores, docs, spark.createDataFrame([(9, d)], "query int, doc int"), "id").first()["rank"]
    assert [rank(d) for d in (3, 1, 2, 4)] == [1, 2, 3, 4]


def test_timing_adds_up(spark):
    rows = spark.createDataFrame([("d", k, "general", "medium", k > 7) for k in range(10)], "deck string, slide int, role string, density string, duplicate boolean")
    assert lint.allocate(rows, 301).agg(F.sum("seconds")).first()[0] == 301


def test_index_terms_keep_mixed_case_openers(spark):
    rows = index.index_lines(load(spark, "index_lines"))
    assert [r.line for r in rows.where("is_sub").orderBy("ord").collect()] == ["in heart failure, 20f", "in hypertension, vs. beta-blockers", "distinguished from ARBs"]


def test_citations_and_their_books(spark):
    rows = spark.createDataFrame([("n", 1, "x [Anchor: Alpha-16-L2-045] Beta Fig. 3.4 and Table 2.1; Alpha Box 9.9 [chunk: L2-7]")], "doc string, ln int, line string")
    got = {(r.kind, r.book, r.chapter, r.value) for r in guard.citations(rows, {"alpha": "alpha", "beta": "beta"}).collect()}
    assert got == {("chunk", "alpha", 16, "L2-045"), ("chunk", None, None, "L2-7"), ("ref", "beta", None, "fig 3.4"), ("ref", "beta", None, "tab 2.1"), ("ref", "alpha", None, "box 9.9")}
