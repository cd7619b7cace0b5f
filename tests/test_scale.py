"""Operators that replace single-task windows, gram joins and unbounded lists, against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom import patterns as P
from textloom.operators import blocks, index, lint, merkle, names, ordered, packaging, retrieval, substrings
from textloom.sources import walk
from textloom.streaming import progress


def plan(df):
    return df._jdf.queryExecution().toString()


# --- order --------------------------------------------------------------------------------------------------


def test_positions_carried_values_and_neighbours(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 40), i, rng.choice([None, i])) for i in range(700)] + [(7, 1000 + i, None) for i in range(500)]
    table = spark.createDataFrame(rows, "g int, id int, v int").repartition(6)
    want = sorted(rows, key=lambda r: (r[0], r[1]))
    got = {r.id: r.at for r in ordered.positions(table, ["g", "id"], "at").collect()}
    assert got == {r[1]: k for k, r in enumerate(want)}
    seen, last = {}, None
    for r in want:
        last = r[2] if r[2] is not None else last
        seen[r[1]] = last
    carried = ordered.carried(table, ["g", "id"], F.col("v"), "c")
    assert {r.id: r.c for r in carried.collect()} == seen and "SinglePartition" not in plan(carried)
    after = {r.id: r.n for r in ordered.following(table, ["g", "id"], "id", "n", 50, around=True).collect()}
    assert after == {r[1]: want[(k + 50) % len(want)][1] for k, r in enumerate(want)}
    nexts = {r.id: r.n for r in ordered.following(table, ["g", "id"], "id", "n").collect()}
    assert nexts[want[-1][1]] is None and nexts[want[0][1]] == want[1][1]
    empty = table.limit(0)
    assert ordered.positions(empty, ["id"], "at").count() == 0 and ordered.carried(empty, ["id"], F.col("v"), "c").count() == 0 and ordered.following(empty, ["id"], "id", "n", around=True).count() == 0


def test_target_ranks_without_theta_join(spark):
    docs = spark.range(100).withColumnRenamed("id", "doc")
    rng = random.Random(3)
    scores = [(q, d, float(rng.randint(0, 3))) for q in range(12) for d in rng.sample(range(100), 30)]
    targets = [(q, rng.randrange(100)) for q in range(12)]
    got = retrieval.target_ranks(spark.createDataFrame(scores, "query int, doc long, score double"), docs, spark.createDataFrame(targets, "query int, doc long"), "doc")
    full = {(q, d): s for q, d, s in scores}
    want = {(q, t): 1 + sum((full.get((q, d), 0.0), -d) > (full.get((q, t), 0.0), -t) for d in range(100)) for q, t in targets}
    assert {(r["query"], r.doc): r["rank"] for r in got.collect()} == want
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(got))


# --- substrings ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("sifted", [1_000_000, 0])
def test_pieces_meet_the_texts_that_hold_them(spark, sifted):
    rng = random.Random(1)
    texts = [("a" if i % 2 else "b", i, "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 300)))) for i in range(160)] + [("a", 1000, "x" * 100), ("a", 1001, None), ("a", 1002, ""), ("a", 1003, "x" * 100)]
    pieces = []
    for k in range(260):
        by, _, t = rng.choice(texts[:160])
        n = rng.choice([5, 8, 9, 11, 12, 15, 19, 20, 21, 40])
        if len(t) > n:
            at = rng.randrange(len(t) - n)
            pieces.append((by, k, t[at : at + n] if rng.random() < 0.8 else t[at : at + n - 1] + "z"))
    pieces += [("a", 900, "x" * 9), ("a", 901, "x" * 30), ("a", 902, None), ("a", 903, "x" * 101), ("a", 904, "x" * 30)]
    table = spark.createDataFrame(texts, "by string, id long, text string").repartition(3)
    got = substrings.contains_join(spark.createDataFrame(pieces, "by string, k long, piece string"), table, "piece", "text", ["by"], ["id"], sifted)
    want = sorted((b, k, i) for b, k, p in pieces if p and len(p.encode()) >= 8 for c, i, t in texts if b == c and t and p in t)
    assert sorted((r.by, r.k, r.id) for r in got.collect()) == want and len(want) > 100


def test_fingerprints_are_few_and_shared():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 50_000).astype(np.uint8)
    at, h = substrings.selected(data, np.array([0, 20_000, 50_000]), 13)
    assert len(at) < 0.2 * len(data) and not ((at > 20_000 - 8) & (at < 20_000)).any()
    for start in rng.integers(0, 19_000, 200):  # any 20 bytes share their own window's fingerprint with the text
        own = substrings.selected(data[start : start + 20], np.array([0, 20]), 13)[1]
        assert set(own) & set(h[(at >= start) & (at <= start + 12)])


# --- names --------------------------------------------------------------------------------------------------


def test_names_of_several_words(spark):
    asked = ["ACE", "ACE inhibitor", "ST-elevation MI", "a  b", "(RAS)", "C++", "ß", "x", "ACE inhibitor of a long kind", "MI", "--", "", None]
    texts = ["The ACE inhibitor works", "ACE  inhibitor", "PACE ACEs", "st ST-elevation MI.", "ST-elevation  MI", "a  b a b", "see (RAS)!", "see ((RAS))", "(RAS)", "C++", "C+++ x", "C++x", "éACEé", "ACE inhibitor of a long kind", "ACE inhibitor of a long mind", "x", "", None, "MI MI MI", "-- ß"]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    got = sorted((r.name, r.id) for r in names.occurrences(spark.createDataFrame([(a,) for a in asked], "name string"), table, "id", "text").collect())
    want = sorted({(a, i) for a in asked if a and re.search("[A-Za-z0-9_]", a) for i, t in enumerate(texts) if t and re.search(rf"(?:^|[^A-Za-z0-9_]){re.escape(a)}(?:$|[^A-Za-z0-9_])", t)})
    assert got == want and len(want) > 15


def test_first_chunks_of_a_name_are_kept_by_a_bounded_aggregate(spark):
    chunks = spark.range(300).select(F.col("id").alias("ord"), F.concat(F.lit("c"), "id").alias("chunk_id"), F.lit("Topic").alias("topic"), F.lit("the MI of").alias("body"))
    got = index.term_to_chunks(spark.createDataFrame([("MI",), ("mi",), ("none",)], "acronym string"), chunks, 1000, False, 10)
    assert [(r.acronym, r.matches, r.chunks) for r in got.collect()] == [("MI", 300, ",".join(f"c{i}" for i in range(10)))]
    assert "WindowGroupLimit" in plan(got)


# --- hash trees ---------------------------------------------------------------------------------------------


def test_hash_trees_name_the_ranges_that_differ(spark):
    rows = [(i, f"v{i}") for i in range(3000)] + [(5, "v5")] * 40
    before = spark.createDataFrame(rows, "id int, v string")
    after = spark.createDataFrame([r for r in rows if r[0] != 17] + [(5, "v5"), (4000, "new")], "id int, v string")
    digest = lambda r: hashlib.sha256(f"{r[0]}|{r[1]}".encode()).hexdigest()
    prefixes = {digest(r)[:2] for r in ((17, "v17"), (5, "v5"), (4000, "new"))}
    assert {r.prefix for r in merkle.differing(before, after, ["id", "v"], 2).collect()} == prefixes
    changed = {(r.side, r.hash, r.n) for r in merkle.changed_rows(before, after, ["id", "v"], 2).collect()}
    assert changed == {("before", digest((17, "v17")), 1), ("after", digest((5, "v5")), 1), ("after", digest((4000, "new")), 1)}
    root = lambda t, d=None: merkle.set_hash(t, ["id", "v"], d).first()[0]
    assert root(before, 2) == root(before.repartition(7), 2) != root(after, 2)
    distinct = before.distinct()
    assert root(distinct) == hashlib.sha256("".join(sorted(digest(r) for r in set(rows))).encode()).hexdigest()
    assert root(before.limit(0)) == hashlib.sha256(b"").hexdigest() and merkle.differing(before, before, ["id", "v"]).count() == 0
    assert merkle.digits_for(4096) == 0 and merkle.digits_for(4097) == 1 and merkle.digits_for(4096 * 16 + 1) == 2


# --- blocked index ------------------------------------------------------------------------------------------


def test_blocked_search_equals_full_scores_and_skips_blocks(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice(["common", "usual", *(f"w{k}" for k in range(60))]) for _ in range(rng.randint(1, 40)))) for i in range(1500)]
    for i in (3, 700, 1499):
        texts[i] = (i, "rare " * 6 + "gem")
    docs = spark.createDataFrame(texts + [(2000, None), (2001, "")], "id int, text string").repartition(4)
    asked = spark.createDataFrame([("one", ["rare", "common"]), ("two", ["common", "usual", "w3"]), ("none", ["absent"])], "query string, terms array<string>")
    built = blocks.build(docs, "id", "text", block=64)
    top, counts = blocks.search(built, asked, 3, lead=2)
    scores = retrieval.bm25(docs, asked, "id", "text").withColumn("score", F.round("score", 5))
    want = retrieval.top_k(scores, ["query"], [F.desc("score"), "doc"], 3)
    key = lambda t: sorted((r["query"], r.doc, r["rank"], r.score) for r in t.collect())
    assert key(top) == key(want) and len(key(want)) == 6
    seen = {r["query"]: (r.blocks, r.scored) for r in counts.collect()}
    assert seen["one"][0] == 24 and seen["one"][1] < 12
    assert max(r.n for r in built.blocks.collect()) <= 64 and built.documents == 1502


# --- rules put back -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("path,kind,secret,candidate,station", [
    ("id_ed25519", "instruction-or-reference", True, False, "joins-job"), ("a/Login Data", "instruction-or-reference", True, False, "joins-job"), ("x/.netrc", "instruction-or-reference", False, False, "joins-job"),
    ("credentials", "instruction-or-reference", False, False, "joins-job"), ("credentials.yml", "configuration", True, False, "chooses-help"), (".key", "instruction-or-reference", False, False, "joins-job"), ("a.key", "instruction-or-reference", True, False, "joins-job"),
    ("docs/AGENTS.md", "project-instructions", False, True, "already-there"), ("instructions.md", "instruction-or-reference", False, False, "joins-job"), ("skills/x/notes.txt", "skill-or-reference", False, True, "joins-job"),
    ("skills/x/SKILL.md", "skill-or-reference", False, True, "chooses-help"), ("approval.json", "authority-config", False, True, "can-do"), ("hooks/run.py", "deterministic-control", False, True, "proves-done"), ("src/run.py", "instruction-or-reference", False, False, "joins-job"),
    ("agent-rule.yaml", "configuration", False, True, "chooses-help"), ("agents.yaml", "configuration", False, False, "chooses-help"), ("memory/x.md", "memory-or-standing-context", False, True, "already-there"), ("a/tool_list.md", "instruction-or-reference", False, True, "can-do"),
    ("x/deck.xlsx", "supplied-document", False, False, "already-there"), ("config.toml", "configuration", False, True, "chooses-help"),
])
def test_setup_paths(spark, path, kind, secret, candidate, station):
    p = F.col("path")
    row = spark.createDataFrame([(path,)], "path string").select(lint.control_kind(p).alias("kind"), lint.is_secret(F.element_at(F.split(p, "/"), -1)).alias("s"), lint.is_candidate(p).alias("c"), p)
    got = row.withColumn("at", lint.station(F.col("kind"), p)).first()
    assert (got.kind, got.s, got.c, got["at"]) == (kind, secret, candidate, station)


def test_run_traces(spark):
    stage = '{"stage": "Shown", "status": "VERIFIED", "count": 2, "detail": "d"}'
    trace = lambda funnel, note='"n"', status='"PARTIAL"': f'{{"trace_status": {status}, "trace_note": {note}, "funnel": {funnel}}}'
    cases = [
        (trace(f"[{stage}]", status='"COMPLETE"'), []), ("not json", ["top level must be an object"]), ("[1]", ["top level must be an object"]), (None, ["top level must be an object"]),
        (trace("[]", status='"COMPLETE"'), ["a COMPLETE trace must have at least one funnel stage"]), (trace("[]", note="7"), ["trace_note must be a non-empty string"]), (trace("[]", note='" \\t"'), ["trace_note must be a non-empty string"]),
        (trace("{}"), ["funnel must be a list"]), ("{}", ["trace_status must be COMPLETE, PARTIAL, or NOT_EXPOSED", "trace_note must be a non-empty string", "funnel must be a list"]),
        (trace(f"[{stage}, {stage}, 3]"), ["funnel[1].stage is duplicated", "funnel[2] must be an object"]),
        (trace('[{"stage": "Dreamt", "status": "PASS", "count": true}]'), ["funnel[0].stage is invalid", "funnel[0].status is invalid", "funnel[0].count must be null or a non-negative integer", "funnel[0].detail must be a non-empty string"]),
        (trace('[{"stage": "Checked", "status": "UNKNOWN", "count": -1, "detail": "d"}, {"stage": "Accepted", "status": "UNKNOWN", "count": 1.5, "detail": "d"}, {"stage": "Eligible", "status": "UNKNOWN", "count": null, "detail": "d"}]'),
         ["funnel[0].count must be null or a non-negative integer", "funnel[1].count must be null or a non-negative integer"]),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", packaging.trace_problems(F.col("t")).alias("p")).collect()
    assert {r.i: list(r.p) for r in rows} == {i: want for i, (_, want) in enumerate(cases)}


def test_reviews_divide_the_controls(spark):
    texts = {c: "told" for c in P.DECISION_TEXTS}
    said = lambda i, d="KEEP", e="VERIFIED", **t: (i, d, e, *{**texts, **t}.values())
    schema = "control_id string, decision string, evidence_state string, " + ", ".join(f"{c} string" for c in P.DECISION_TEXTS)
    controls = spark.createDataFrame([(c, f"hash {c}") for c in "abcdef"], "control_id string, sha256 string")
    decisions = spark.createDataFrame([said("a"), said("b", "RETIRE"), said("b"), said("c", "MERGE", "GUESSED"), said("d", reason=" \n", rollback="x" * 501, reader_name="bad\x07"), said("z")], schema)
    left = spark.createDataFrame([("d",), ("e",), ("e",), ("y",)], "control_id string")
    got = {(r.control_id, r.problem) for r in packaging.review_problems(controls, decisions, left).collect()}
    assert got == {("b", "decided twice"), ("c", "decision"), ("c", "evidence_state"), ("d", "reason"), ("d", "rollback"), ("d", "reader_name"), ("d", "reviewed and unreviewed"), ("e", "unreviewed twice"), ("f", "omitted control"), ("y", "unknown control"), ("z", "unknown control")}
    merged, problems = packaging.merge_review(controls, decisions.where("control_id in ('a', 'c') "), "m" * 64, "s" * 64)
    rows = {r.control_id: r for r in merged.collect()}
    assert problems.collect() == [] and len(rows) == 6 and rows["a"].change_id is None and re.fullmatch("CHANGE-[0-9A-F]{32}", rows["c"].change_id) and rows["e"].decision == "UNDECIDED"
    _, problems = packaging.merge_review(controls, decisions, "m" * 64, "s" * 64)  # b twice would double a control
    assert [r.problem for r in problems.collect()] == ["altered control"]
    header = lambda *h: spark.createDataFrame([h], "review_mode string, scope_sha256 string, map_sha256 string, surface string, model string, profile_date string, semantic_files_reviewed int")
    scope, none = spark.createDataFrame([("s", "m", "desk", "x")], "scope_sha256 string, map_sha256 string, surface string, model string"), controls.limit(0)
    check = lambda h, d, u, g: {r.problem for r in packaging.review_header_problems(h, scope, d, u, controls, g).collect()}
    assert check(header("QUICK_CHECK", "s", "m", "desk", "x", "2025-02-28", 6), decisions, none, none) == set()
    assert check(header("SLOW", "t", "n", "desk", "y", "2025-02-30", 1), none, left, none) == {"review_mode", "scope_sha256", "map_sha256", "runtime", "profile_date", "semantic_files_reviewed", "no decision", "no coverage gap"}
    many = spark.range(51).select(F.col("id").cast("string").alias("control_id"))
    assert check(header("QUICK_CHECK", "s", "m", "desk", "x", "2025-2-28", 51), many, none, none) == {"too many decisions", "profile_date"}


def test_dated_guidance_and_missing_statements(spark):
    slides = spark.createDataFrame([
        ("d", 1, "The guideline of 1999 and a Consensus from 2010. Guidance. 1998"), ("d", 2, "recommendation (2019); position statement, 2001"), ("e", 1, None), ("e", 2, "Disclosures none. This deck is accredited by the accreditation council"),
        ("d", 3, "No financial relationship here"),
    ], "deck string, slide int, text string")
    got = [(r.deck, r.slide, r.match, r.year) for r in lint.stale_guidance(slides, 2012).orderBy("slide", "k").collect()]
    assert got == [("d", 1, "guideline of 1999", 1999), ("d", 1, "Consensus from 2010", 2010), ("d", 2, "position statement, 2001", 2001)]
    missing = {(r.deck, r.rule.removeprefix("CME-MISSING-"), r.severity) for r in lint.missing_statements(slides).collect()}
    assert missing == {("d", "ACCREDITATION-STATEMENT", "ERROR"), ("d", "CREDIT-DESIGNATION", "ERROR"), ("d", "MITIGATION-STATEMENT", "WARN"), ("e", "CREDIT-DESIGNATION", "ERROR"), ("e", "DISCLOSURE", "ERROR"), ("e", "MITIGATION-STATEMENT", "WARN")}
    one = spark.createDataFrame([("d", 1, "x 5.0 mg daily")], "deck string, slide int, text string")
    assert [(r.group, r.rule, r.match) for r in lint.slide_findings(one).collect()] == [("medication-safety", "MED-TRAILZERO", "5.0")]


# --- walks and streams --------------------------------------------------------------------------------------


def test_walk_prunes_before_it_descends(spark, tmp_path):
    for f in ("AGENTS.md", "a/b/c/deep.md", "a/notes.md", "node_modules/x/skill.md", "a/.ssh/id_rsa", "a/.env", "Hooks/check.py", "a/b/image.png", ".git/config", "a/key.pem", "hooks/run.sh"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("x")
    (tmp_path / "a/link").symlink_to(tmp_path / "node_modules")
    (tmp_path / "a/file-link.md").symlink_to(tmp_path / "AGENTS.md")
    got = {r.path: r.excluded for r in walk.walk(spark, str(tmp_path), most_depth=2, include_documents=True).collect()}
    assert got == {
        "AGENTS.md": None, "a": None, "a/b": None, "a/b/c": "depth-limit", "a/notes.md": None, "node_modules": "excluded-directory", "a/.ssh": "secret-path", "a/.env": "secret-path", "Hooks": None, "Hooks/check.py": None,
        "a/b/image.png": "no-candidate", ".git": "excluded-directory", "a/key.pem": "secret-path", "hooks": None, "hooks/run.sh": None, "a/link": "symlink", "a/file-link.md": "symlink",
    }
    few = walk.walk(spark, f"file://{tmp_path}", most_files=2)
    assert {r.path for r in few.where("kind = 'file' and excluded is null").collect()} == {"AGENTS.md", "Hooks/check.py"}
    assert {r.excluded: r.n for r in walk.exclusions(few).collect()}["file-limit"] == 3
    missing = walk.walk(spark, str(tmp_path / "nowhere")).collect()
    assert [(r.excluded, r.problem) for r in missing] == [("unreadable", "FileNotFoundError")]


def test_killed_batches_are_rolled_back_and_written_once(spark, tmp_path):
    source = tmp_path / "in"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "cast(ts as timestamp) ts", "user_id", "event_type", "value", "props").orderBy("event_id")
    rows = events.collect()
    cuts = [0, len(rows) // 3, len(rows) // 2, len(rows)]
    log = progress.BatchLog(spark, f"file://{tmp_path}/log")

    def put(k, extra=()):
        spark.createDataFrame(rows[cuts[k] : cuts[k + 1]] + list(extra), events.schema).coalesce(1).write.mode("append").parquet(str(source))

    def run(after=None):
        stream = spark.readStream.schema(events.schema).parquet(str(source))
        progress.start(spark, stream, log, f"file://{tmp_path}/mark", after).awaitTermination(180)

    put(0)
    run()
    assert sorted(log.committed()) == [0]
    put(1)

    def die(table):
        if table == "markers":  # the first of two tables is written, the second is not
            raise OSError("killed")

    with pytest.raises(Exception):
        run(die)
    assert sorted(log.committed()) == [0] and not list((tmp_path / "log/batches").glob("1/*"))
    # a process that dies outright leaves its attempt behind; readers do not see it and the replay removes it
    (tmp_path / "log/batches/1/dead/markers").mkdir(parents=True)
    (tmp_path / "log/batches/1/dead/markers/part-0.parquet").write_text("torn")
    run()
    put(2, rows[:5])  # events that come again
    run()
    run()
    assert sorted(log.committed()) == [0, 1, 2] and len(list((tmp_path / "log/batches").glob("1/*"))) == 1
    assert not log.write(2, {"markers": spark.range(1)})
    got = {r.key: (r.events, r.section, r.status) for r in progress.latest(log).collect()}
    counts, hours, last = Counter(), {}, {}
    for r in rows:
        counts[r.user_id] += 1
        hours[r.user_id] = max(hours.get(r.user_id, 0), int(r.ts.timestamp()) // 3600)
        last[r.user_id] = r.event_type
    assert got == {k: (counts[k], hours[k], last[k]) for k in counts}
    assert log.read("audit", "markers long, last_id long").count() == 3


# --- duplicate slides ---------------------------------------------------------------------------------------


def test_duplicate_slides_equal_all_pairs(spark):
    import difflib

    rng = random.Random(5)
    long = " ".join(f"word{k}" for k in range(60))
    texts = [long, long + "!", long.replace("word9 ", "word9, "), "short", "", None]
    images = ["00000000000000f0", "00000000000000f1", "00000000000010f0", "ffff000000000000", None]
    rows = [(rng.choice(["a", "b", None]), k // 2, rng.choice(texts), rng.choice(images)) for k in range(160)]  # a slide number may stand twice

    def dup(one, two):
        if one[0] is None or one[0] != two[0] or one[2] is None or two[2] is None or not two[1] < one[1]:
            return False
        if one[2] == two[2]:
            return True
        near = one[3] is not None and two[3] is not None and (int(one[3], 16) ^ int(two[3], 16)).bit_count() <= 1
        return near and difflib.SequenceMatcher(None, one[2], two[2]).ratio() >= 0.96

    expected = {}
    for one in rows:
        for two in rows:
            if dup(one, two):
                key = one[0], one[1]
                expected[key] = min(expected.get(key, 1 << 30), two[1])
    got = lint.duplicate_slides(spark.createDataFrame(rows, "deck string, slide int, text string, image string"))
    assert {(r.deck, r.slide): r["first"] for r in got.collect()} == expected and len(expected) > 60
    assert lint.duplicate_slides(spark.createDataFrame([], "deck string, slide int, text string, image string")).count() == 0


def test_copies_of_a_slide_meet_once(spark):
    """A thousand equal slides are one class: no join makes their pairs."""
    rows = [("a", k, "text", "0" * 16) for k in range(1000)]
    got = lint.duplicate_slides(spark.createDataFrame(rows, "deck string, slide int, text string, image string")).collect()
    assert len(got) == 999 and {r["first"] for r in got} == {0}


def test_posting_blocks_count_each_row(spark):
    """Rows of equal ids and lengths are documents of their own; a text is counted where it stands."""
    from textloom.operators import blocks

    docs = spark.createDataFrame([(1, "alpha beta beta"), (1, "alpha gamma gamma"), (2, None), (3, ""), (4, "gamma")], "doc_id long, text string")
    index = blocks.build(docs, "doc_id", "text", block=4)
    got = {(r.term, r.block): (r.n, sorted(zip(r.tfs, r.lengths))) for r in index.blocks.collect()}
    assert got == {("alpha", 0): (2, [(1, 3), (1, 3)]), ("beta", 0): (1, [(2, 3)]), ("gamma", 0): (1, [(2, 3)]), ("gamma", 1): (1, [(1, 1)])}
    assert index.documents == 5 and sorted(r.place for r in index.places.collect()) == list(range(5))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_near_lines_need_no_join(spark):
    """Lines of a text meet in a window over one deal of the texts."""
    from textloom.operators import lines

    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"{words}\n{words} x\nshort\n{words} y"), (2, words)], "doc_id long, text string")
    found = lines.near_pairs(lines.explode_lines(docs, "doc_id", "text"))
    assert sorted((r.doc, r.i, r.j) for r in found.collect()) == [(1, 1, 2), (1, 1, 3), (1, 2, 3)]
    assert "Join" not in optimized(found)


def test_paired_terms_are_looked_for_plainly_first(spark):
    """Texts are lowered once, and a pattern is tried only where its words stand; findings stay."""
    from textloom.operators import fidelity

    rows = spark.createDataFrame([("a", "Levels INCREASE here", "levels decrease"), ("b", "it increased", "nothing"), ("c", "not indicated", "it is indicated"), ("d", "an increase", "none"), ("e", None, "increase")], "chunk_id string, source string, body string")
    found = fidelity.paired_flips(rows, [("increase", "decrease"), ("not indicated", "indicated")], "check")
    assert sorted((r.chunk_id, r.kind, r.source_value, r.chunk_value or "") for r in found.collect()) == [("a", "flipped", "increase", "decrease"), ("c", "flipped", "not indicated", "indicated"), ("d", "missing", "increase", "")]
    assert optimized(found).count("lower(") == 2
    assert [fidelity.needle(p) for p in ("not indicated", "a|b", "mgs?", r"\d x")] == ["not indicated", "", "mg", ""]


def test_slide_texts_stay_behind_their_hashes(spark):
    """Classes of slides are made and paired without their texts; near ones are still found by text."""
    from textloom.operators import lint

    text = "a slide of some length that says the same thing " * 4
    rows = [("d", 1, text, "0" * 16), ("d", 2, text + "!", "0" * 15 + "1"), ("d", 3, "other", "0" * 15 + "2"), ("d", 4, text, None), ("e", 5, text, "0" * 16)]
    found = lint.duplicate_slides(spark.createDataFrame(rows, "deck string, slide long, text string, image string"))
    assert sorted((r.deck, r.slide, r.first) for r in found.collect()) == [("d", 2, 1), ("d", 4, 1)]
    assert not [x for x in optimized(found).splitlines() if "Aggregate [deck" in x and "first(text" in x]


def test_tables_are_read_in_bounded_batches(spark, tmp_path):
    """Rows and bytes of an Arrow batch are bounded for whatever reads a table, a smaller setting is kept."""
    from textloom.registry import table

    spark.range(3).write.parquet(str(tmp_path / "x.parquet"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, held in (("10000", 1024), ("7", 7)):
            spark.conf.set(name, given)
            assert table(spark, str(tmp_path), "x").count() == 3 and int(spark.conf.get(name)) == held
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == f"{4 << 20}b"
    finally:
        spark.conf.set(name, before)


def test_names_of_one_word_need_no_places(spark):
    """Whole words are met by the distinct words of a text; names with gaps or edges still by places."""
    texts = spark.createDataFrame([(1, "beta a-beta x_beta"), (2, "alpha  beta, alpha beta!"), (3, None), (4, "")], "id long, text string")
    asked = spark.createDataFrame([("beta",), ("alpha beta",), ("(beta",), (None,), ("",)], "name string")
    assert sorted((r.name, r.id) for r in names.occurrences(asked, texts, "id", "text").collect()) == [("alpha beta", 2), ("beta", 1), ("beta", 2)]
    one = names.occurrences(asked.where("name = 'beta'"), texts, "id", "text")
    assert [(r.name, r.id) for r in one.orderBy("id").collect()] == [("beta", 1), ("beta", 2)] and "posexplode" not in optimized(one)


def test_span_faults_hold_one_entry_at_a_time(spark):
    """No table of a task's entries is hashed; faults stay those of each entry."""
    spans = [(1, 1, 0, 2, "g", "ab"), (1, 2, 2, 4, "h", "cd"), (2, 1, 0, 2, "g", "ab"), (2, 2, 3, 4, "h", "?"), (2, 3, 4, 5, "g", "e"), (3, 1, 0, 1, None, "a")]
    sources = [(1, "abcd"), (2, "abcdef"), (3, "a")]
    found = packaging.span_faults(spark.createDataFrame(spans, "entry int, idx int, start int, end int, grp string, text string"), spark.createDataFrame(sources, "entry int, source string"))
    assert sorted((r.entry, r.fault) for r in found.collect()) == [(2, "cover"), (2, "gap"), (2, "group"), (2, "text"), (3, "group")]
    assert "Aggregate" not in optimized(found)
