"""Rules over slides, decks, setup files and folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_word, hamming_hex, ladder, lines_of, words_of
from ..functions.unicode import similarity
from ..sources.shared import written
from .ordered import positions

FEW = 100_000  #: hashes of texts that are broadcast; more are shuffled

def rule_applies(jurisdiction: str, target: str) -> bool:
    """Whether a rule of a jurisdiction holds for a deck's."""
    if target == "none":
        return jurisdiction in ("all", "none", "us-origin/global-practice")
    return jurisdiction in ("all", "us-origin/global-practice") or target in jurisdiction


RULE_GROUPS = {"MED": "medication-safety", "EV": "evidence-discipline", "JUR": "jurisdiction", "PHI": "phi", "CME": "cme-compliance", "CUR": "currency"}


def slide_matches(slides: DataFrame, rules: list[tuple[str, str, str, str]] = P.SLIDE_RULES_JAVA) -> DataFrame:
    """(deck, slide, rule, severity, match, jurisdiction): the first match, 60 characters of it, of every rule in every slide; each rule is tried once a slide.

    A recommendation is found only on slides without a citation, and significance only without a measure of
    precision, both looked for in the notes (column note, if there is one) too.
    """
    both = F.concat_ws("\n", "text", "note") if "note" in slides.columns else F.col("text")
    unless = {"EV-RECNOSRC": P.CITATION_MARKER, "EV-SIGNIF": P.PRECISION_MARKER}
    found = []
    for name, severity, pattern, own in rules:
        hit = F.col("text").rlike(pattern) & (~both.rlike(unless[name]) if name in unless else F.lit(True))
        first = F.substring(F.trim(F.regexp_extract("text", pattern, 0)), 1, 60)
        found.append(F.when(hit, F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), first.alias("match"), F.lit(own).alias("jurisdiction"))))
    return slides.select("deck", "slide", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f")).select("deck", "slide", "f.*")


def slide_findings(slides: DataFrame, jurisdiction: str = "us", accredited: bool = False, rules: list[tuple[str, str, str, str]] = P.SLIDE_RULES_JAVA) -> DataFrame:
    """(deck, slide, group, rule, severity, match) of the rules that hold for a jurisdiction; trade names count in accredited decks."""
    own = [r for r in rules if rule_applies(r[3], jurisdiction) and (accredited or not r[0].startswith("CME-"))]
    return slide_matches(slides, own).select("deck", "slide", rule_group(F.col("rule")).alias("group"), "rule", "severity", "match")


def rule_group(rule: Column) -> Column:
    """The group of a rule, by what its name begins with."""
    return ladder([(group, F.startswith(rule, F.lit(f"{start}-"))) for start, group in RULE_GROUPS.items()], "other")


def findings_by_target(slides: DataFrame, targets: tuple[str, ...] = ("us", "eu", "none"), accredited: bool = True) -> DataFrame:
    """(target, deck, slide, rule, severity, match) for decks of several jurisdictions, from one reading of the slides."""
    holds = [(t, r[0]) for t in targets for r in P.SLIDE_RULES_JAVA if rule_applies(r[3], t) and (accredited or not r[0].startswith("CME-"))]
    table = slides.sparkSession.createDataFrame(holds, "target string, rule string")  # a row for each rule and target
    return slide_matches(slides).drop("jurisdiction").join(F.broadcast(table), "rule")


def stale_guidance(slides: DataFrame, year: int) -> DataFrame:
    """(deck, slide, k, rule, severity, match, year): every mention of guidance with a year before `year`, in a slide's order; matches do not overlap."""
    get = lambda k: F.regexp_extract_all("text", F.lit(P.DATED_GUIDANCE), F.lit(k))
    rows = slides.select("deck", "slide", F.posexplode(F.arrays_zip(get(0).alias("match"), get(2).alias("century"), get(3).alias("year"))).alias("k", "m"))
    rows = rows.select("deck", "slide", "k", F.lit("CUR-STALE").alias("rule"), F.lit("WARN").alias("severity"), F.substring("m.match", 1, 60).alias("match"), F.concat("m.century", "m.year").cast("int").alias("year"))
    return rows.where(F.col("year") < year)


def missing_statements(slides: DataFrame) -> DataFrame:
    """(deck, rule, severity): statements that no slide of an accredited deck holds. Slides are counted before decks meet."""
    held = slides.groupBy("deck").agg(*[F.max(F.coalesce(F.col("text"), F.lit("")).rlike(p)).alias(name) for name, _, p in P.DECK_STATEMENTS])
    lacks = F.array(*[F.when(~F.col(f"`{name}`"), F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"))) for name, severity, _ in P.DECK_STATEMENTS])
    return held.select("deck", F.explode(F.filter(lacks, lambda x: x.isNotNull())).alias("f")).select("deck", "f.rule", "f.severity")


def deck_verdict(findings: DataFrame, decks: DataFrame) -> DataFrame:
    """Counts by severity and the worst status of each deck, decks without findings included."""
    got = findings.groupBy("deck").agg(*[F.count_if(F.col("severity") == s).alias(s.lower()) for s in ("ERROR", "WARN", "ADVISORY")])
    rows = decks.select("deck").distinct().join(got, "deck", "left").fillna(0)
    return rows.withColumn("status", F.when(F.col("error") > 0, "FAIL").when(F.col("warn") > 0, "WARN").otherwise("PASS"))


def slide_role(title: Column, text: Column) -> Column:
    """The first rule that holds on title, text and number of words."""
    t, both, n = F.lower(F.trim(title)), F.lower(F.concat_ws(" ", title, text)), F.size(words_of(text))
    some = lambda c, *w: any_word(c, list(w))
    long = n >= 14
    return ladder([
        ("reference", some(t, "reference", "bibliography")), ("case", some(t, "case 1", "case 2", "clinical case", "case study")),
        ("mechanism", some(t, "mechanism") & long), ("divider", some(t, "mechanism")), ("dosing", some(t, "dosing", "titration", "dose limit") & long), ("divider", some(t, "dosing", "titration", "dose limit")),
        ("safety", some(t, "safety") & long), ("divider", some(t, "safety", "clinical application", "regulatory status", "efficacy", "why it matters")), ("general", some(t, "roadmap", "learning objectives")),
        ("safety", some(both, "contraindication", "boxed warning", "monitoring", "hypogly")), ("dosing", some(both, "missed dose", "maintenance dose", "titration", "maximum dose")),
        ("counselling", some(both, "counselling", "counseling", "contraception", "pregnan")), ("mechanism", some(both, "mechanism", "receptor", "agonism", "glp-1", "gip")),
        ("evidence", some(both, "surpass", "surmount", "hba1c", "trial", "placebo", "semaglutide")), ("takeaway", some(both, "takeaway", "remember", "checklist", "summary", "conclusion")), ("divider", ~long),
    ], "general")


def density(words: Column) -> Column:
    """P17."""
    return ladder([("low", words < 25), ("medium", words < 75)], "high")


def slide_title(text: Column) -> Column:
    """The first of six non-blank lines that is short and no number, else the first line."""
    lines = F.filter(F.transform(lines_of(text), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    fit = F.filter(F.slice(lines, 1, 6), lambda x: (F.length(x) <= 120) & ~x.rlike(r"^\d+$"))
    return F.coalesce(F.get(fit, F.lit(0)), F.get(lines, F.lit(0)), F.lit("Untitled slide"))


def duplicate_slides(slides: DataFrame) -> DataFrame:
    """(deck, slide, first): the first earlier slide of a deck that is equal, or near by image hash and by text.

    Slides of one deck, text and image are a class; classes, not slides, are compared, as the first slide of a near class
    stands for all of it. Near classes meet by the four quarters of the image hash, one of which two hashes a bit apart share.
    Slides without deck or text are no duplicates; without an image only equal texts are. Only texts of classes whose images
    are near are shuffled.
    """
    texts = slides.select("deck", "slide", "text", "image", F.sha2("text", 256).alias("h")).where("deck is not null and h is not null")
    rows = texts.drop("text")
    classes = rows.groupBy("deck", "h", "image").agg(F.min("slide").alias("first"), F.max("slide").alias("last"))
    quarters = F.explode(F.array(*[F.concat(F.lit(str(k)), F.substring("image", 4 * k + 1, 4)) for k in range(4)]))
    left = classes.select("deck", "h", "image", "last", quarters.alias("q"))
    right = classes.select("deck", F.col("h").alias("h_b"), F.col("image").alias("image_b"), F.col("first").alias("first_b"), quarters.alias("q"))
    pairs = left.join(right, ["deck", "q"]).where("h <> h_b and first_b < last").where(hamming_hex(F.col("image"), F.col("image_b")) <= 1)
    pairs = written(pairs.select("deck", "h", "image", "h_b", "image_b", "first_b").distinct(), "near-images")
    asked = pairs.select("h").union(pairs.select("h_b")).distinct()
    own = texts.select("h", "text").join(F.broadcast(asked) if asked.count() <= FEW else asked, "h", "left_semi").groupBy("h").agg(F.first("text").alias("text"))
    near = pairs.select("h", "h_b").distinct().join(own, "h").join(own.select(F.col("h").alias("h_b"), F.col("text").alias("text_b")), "h_b")
    pairs = pairs.join(near.where(similarity("text", "text_b") >= 0.96).select("h", "h_b"), ["h", "h_b"])
    found = pairs.groupBy("deck", "h", "image").agg(F.min("first_b").alias("near"))
    equal = classes.groupBy("deck", "h").agg(F.min("first").alias("equal"))
    c, f = rows.alias("c"), found.alias("f")
    same = (F.col("c.deck") == F.col("f.deck")) & (F.col("c.h") == F.col("f.h")) & (F.col("c.image") == F.col("f.image"))
    every = c.join(f, same, "left").select("c.deck", "c.h", "c.slide", "f.near").join(equal, ["deck", "h"])
    return every.groupBy("deck", "slide").agg(F.min(F.least("equal", "near")).alias("first")).where("first < slide")


def allocate(slides: DataFrame, total: int, floor: int = 4) -> DataFrame:
    """Seconds a slide in proportion to role and density (repeats count 0.35), rounded half to even, at least `floor`.

    What is left or too much goes one second a slide in the slides' order, round after round; no slide is taken below
    the floor, so a total under the floors of all slides cannot be met. In closed form: with d seconds to give, each of n
    slides gets d / n and the first d mod n one more; to take, the slides' rooms above the floor are emptied level by level.
    """
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    weight = F.coalesce(table(P.ROLE_WEIGHTS)[F.col("role")], F.lit(1.0)) * F.coalesce(table(P.DENSITY_WEIGHTS)[F.col("density")], F.lit(1.0)) * F.when(F.col("duplicate"), 0.35).otherwise(1.0)
    by = W.partitionBy("deck")
    rows = slides.withColumn("share", weight).withColumn("base", F.greatest(F.lit(floor), F.bround(F.lit(total) * F.col("share") / F.sum("share").over(by)).cast("long")))
    rows = rows.withColumn("change", F.lit(total) - F.sum("base").over(by)).withColumn("n", F.count("*").over(by)).withColumn("place", F.row_number().over(by.orderBy("slide")))
    give = F.floor(F.col("change") / F.col("n")) + (F.col("place") <= F.pmod("change", "n")).cast("int")
    # seconds to take: slides by room; those of less room than the common level are emptied, the rest share what is over
    rows = rows.withColumn("room", F.col("base") - floor).withColumn("rank", F.row_number().over(by.orderBy("room", "slide")))
    below = F.coalesce(F.sum("room").over(by.orderBy("room", "slide").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("reach", below + F.col("room") * (F.col("n") - F.col("rank") + 1)).withColumn("emptied", F.col("reach") <= -F.col("change"))
    left = -F.col("change") - F.sum(F.when(F.col("emptied"), F.col("room")).otherwise(0)).over(by)
    rows = rows.withColumn("left", left).withColumn("open", F.sum((~F.col("emptied")).cast("int")).over(by))
    nth = F.sum((~F.col("emptied")).cast("int")).over(by.orderBy("slide"))
    take = F.when(F.col("emptied"), F.col("room")).otherwise(F.floor(F.col("left") / F.col("open")) + (nth <= F.pmod("left", "open")).cast("int"))
    return rows.select("deck", "slide", (F.col("base") + F.when(F.col("change") >= 0, give).otherwise(-take)).cast("long").alias("seconds"))


def project_issues(manifest: DataFrame, scripts: DataFrame) -> DataFrame:
    """(slide, problem): slides without a script, scripts without a slide, doubled scripts, timing over 30 seconds off."""
    s = scripts.groupBy("slide").agg(F.count("*").alias("n"), F.sum("seconds").alias("spoken"))
    both = manifest.select("slide", F.col("seconds").alias("planned")).withColumn("listed", F.lit(True)).join(s, "slide", "full")
    found = F.array(
        F.when(F.col("n").isNull(), "no script"), F.when(F.col("listed").isNull(), "no slide"), F.when(F.col("n") > 1, "doubled script"), F.when(F.abs(F.col("planned") - F.col("spoken")) > 30, "timing")
    )
    return both.select("slide", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("problem"))


# ------------------------------------------------------------------ setup files and folders


def file_name(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1))


def suffix(name: Column) -> Column:
    """The last suffix with its dot; a name that only begins with a dot has none."""
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def stem(name: Column) -> Column:
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix(name)))


def _in(c: Column, values: list[str]) -> Column:
    return c.isin(*values)


def _parts_in(path: Column, values: list[str], own: bool) -> Column:
    """Whether a part of a path, its file name included or not, is one of the values."""
    parts = F.split(F.lower(path), "/")
    return F.arrays_overlap(parts if own else F.slice(parts, 1, F.size(parts) - 1), F.array(*map(F.lit, values)))


def is_secret(name: Column) -> Column:
    """P23."""
    n = F.lower(name)
    out = _in(n, P.SECRET_FILES) | _in(suffix(n), P.SECRET_SUFFIXES)
    for start in P.SECRET_STARTS:
        out = out | n.startswith(start)
    return out


def control_kind(path: Column) -> Column:
    """P20: the kind of a setup file by its path."""
    name = file_name(path)
    own = stem(name)
    holds = lambda *w: any_word(own, list(w))
    return ladder([
        ("skill-or-reference", (name == "skill.md") | _parts_in(path, ["skills"], True)), ("project-instructions", _in(name, P.INSTRUCTION_FILES)), ("authority-config", holds("permission", "approval")),
        ("deterministic-control", holds("hook", "validator", "guardrail") | _parts_in(path, ["hooks", "validators", "guardrails"], True)), ("memory-or-standing-context", holds("memory") | _parts_in(path, ["memory"], True)),
        ("prompt", holds("prompt") | _parts_in(path, ["prompts"], True)), ("configuration", name.rlike(r"\.(?:json|toml|ya?ml)$")), ("supplied-document", _in(suffix(name), P.DOCUMENT_SUFFIXES)),
    ], "instruction-or-reference")


def enforcement(kind: Column) -> Column:
    """P21."""
    return ladder([("HARD_CONTROL", kind.isin("authority-config", "deterministic-control")), ("SYSTEM_CONFIGURATION", kind == "configuration"), ("CONTEXT_ONLY", kind == "supplied-document")], "WRITTEN_GUIDANCE")


def inventory(files: DataFrame, most_files: int, most_depth: int) -> DataFrame:
    """(path, kind, enforcement, excluded): the first files in path order; secrets, deep files and the rest are disclosed with a reason."""
    depth = F.size(F.split("path", "/"))
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.withColumn("why", F.when(is_secret(name), "secret").when(depth > most_depth, "depth"))
    # places are counted among the files that may be listed
    listed = positions(rows.where("why is null"), ["path"], "n").withColumn("why", F.when(F.col("n") >= most_files, "limit")).drop("n")
    rows = listed.unionByName(rows.where("why is not null"))
    kind = F.when(F.col("why").isNull(), control_kind(F.col("path")))
    return rows.select("path", kind.alias("kind"), F.when(F.col("why").isNull(), enforcement(kind)).alias("enforcement"), F.col("why").alias("excluded"))


def normalise_name(c: Column) -> Column:
    """F50."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?i)\.pdf$", ""), r"[_\-]+", " "), r"\s+", " ")))


def match_sections(folders: DataFrame, sections: DataFrame) -> DataFrame:
    """(folder, section): the exact name, else the one longest section that holds or is held by it; a tie is no match.

    Names meet on their words, so only names that share one are compared.
    """
    a = folders.select("folder", normalise_name(F.col("folder")).alias("name")).withColumn("word", F.explode(F.array_distinct(F.split("name", " "))))
    b = sections.select("section", normalise_name(F.col("section")).alias("title")).withColumn("word", F.explode(F.array_distinct(F.split("title", " "))))
    near = (F.col("name") == F.col("title")) | ((F.length("name") > 10) & (F.contains("name", F.col("title")) | F.contains("title", F.col("name"))))
    hits = a.join(b, "word").where(near).select("folder", "section", "name", "title").distinct()
    hits = hits.withColumn("score", F.when(F.col("name") == F.col("title"), 1_000_000).otherwise(F.length("title")))
    top = hits.withColumn("r", F.rank().over(W.partitionBy("folder").orderBy(F.desc("score")))).where("r = 1")
    one = top.groupBy("folder").agg(F.count("*").alias("n"), F.first("section").alias("section")).where("n = 1").select("folder", "section")
    return folders.join(one, "folder", "left").select("folder", "section")


def section_status(files: DataFrame) -> DataFrame:
    """The state of each section from the files (section, name) it has."""
    has = lambda p: F.max(F.col("name").rlike(p))
    got = files.groupBy("section").agg(has(r"_RAG_Optimised\.md$").alias("rag"), has(r"_chunks\.md$").alias("chunks"), has(r"^markdown\.md$").alias("ocr"), has(r"(?i)\.pdf$").alias("pdf"))
    return got.select("section", ladder([("indexed", F.col("rag")), ("chunked", F.col("chunks")), ("ocr", F.col("ocr")), ("split", F.col("pdf"))], "empty").alias("status"))


def chapter_info(path: Column) -> Column:
    """Struct of chapter number (digits, not years, or a roman numeral), slug and archetype from a path."""
    name = F.element_at(F.split(path, "/"), -1)
    digits = F.regexp_extract(name, r"(?i)(?:ch|chapter|part|section)[ _-]?0*(\d{1,3})(?!\d)", 1)
    lead = F.regexp_extract(name, r"^0*(\d{1,3})(?!\d)", 1)
    roman = F.upper(F.regexp_extract(name, r"(?i)(?:chapter|part)[ _-](x{0,3}(?:ix|iv|v?i{0,3}))(?![a-z])", 1))
    value = {"I": 1, "V": 5, "X": 10}
    letters = F.split(roman, "")
    number = F.aggregate(
        F.transform(letters, lambda c, k: F.when((c == "I") & F.get(letters, k + 1).isin("V", "X"), -1).otherwise(F.coalesce(F.create_map(*[F.lit(x) for kv in value.items() for x in kv])[c], F.lit(0)))), F.lit(0), lambda a, x: a + x
    )
    chapter = F.when(digits != "", digits.try_cast("int")).when(lead != "", lead.try_cast("int")).when(roman != "", number)
    slug = F.lower(F.regexp_replace(F.regexp_replace(name, r"^[0-9]+[ _-]*|\.[A-Za-z0-9]+$", ""), r"[^A-Za-z0-9]+", "_"))
    kind = F.when(F.lower(path).rlike("guideline|consensus|standards of care"), "GUIDELINE").otherwise("TEXTBOOK")
    return F.struct(chapter.alias("chapter"), slug.alias("slug"), kind.alias("archetype"))


def is_candidate(path: Column, include_documents: bool = False) -> Column:
    """Paths that a setup scan reads: known names, texts and scripts whose folders or words hint at a control, and documents if asked for."""
    name = file_name(path)
    end = suffix(name)
    words = F.regexp_extract_all(stem(name), F.lit("[a-z]+"), F.lit(0))
    hinted = F.arrays_overlap(words, F.array(*map(F.lit, P.CONTROL_WORDS)))
    documents = _in(end, [*P.TEXT_SUFFIXES, *P.DOCUMENT_SUFFIXES, ".csv"]) if include_documents else F.lit(False)
    texts = _in(end, P.TEXT_SUFFIXES) & (_parts_in(path, P.CONTROL_FOLDERS, False) | hinted)
    return _in(name, P.CONTROL_FILES) | documents | texts | (_in(end, P.SCRIPT_SUFFIXES) & (_parts_in(path, P.CHECK_FOLDERS, False) | hinted))


def station(kind: Column, path: Column) -> Column:
    """Where in a run a control acts, by its kind and its path."""
    k, p = F.lower(F.coalesce(kind, F.lit("instruction-or-reference"))), F.lower(F.coalesce(path, F.lit("")))
    route = p.endswith("skill.md") | any_word(p, P.ROUTE_MARKS)
    return ladder([
        ("proves-done", (k == "deterministic-control") | any_word(p, P.PROOF_MARKS)), ("can-do", k.isin("authority-config", "tool-or-action-config") | any_word(p, P.POWER_MARKS)),
        ("chooses-help", (k == "configuration") | ((k == "skill-or-reference") & route)), ("joins-job", k.isin("skill-or-reference", "prompt", "instruction-or-reference")),
    ], "already-there")


JOBS = {
    "project-instructions": "Standing project rules and context", "memory-or-standing-context": "Saved context or preferences", "skill-or-reference": "Specialist procedure, route, or reference",
    "authority-config": "Permission or approval boundary", "deterministic-control": "Machine-checkable guardrail or finish check", "prompt": "Task or reusable prompt context",
    "configuration": "Product or runtime configuration", "supplied-document": "Supplied project or task context", "instruction-or-reference": "Instruction or supporting reference",
}


def job(kind: Column) -> Column:
    """The job of a control kind."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in JOBS.items() for x in kv])[kind], F.lit("Visible setup material"))


def book_of_path(path: Column, aliases: dict[str, str]) -> Column:
    """The book of the first part of a path that names one."""
    from .guard import normalise_book

    return F.get(F.filter(F.transform(F.split(path, "/"), lambda p: normalise_book(p, aliases)), lambda b: b.isNotNull()), F.lit(0))


def unique_slugs(rows: DataFrame, text_col: str, order: str) -> DataFrame:
    """adds `slug`, equal ones numbered -2, -3 in order."""
    from ..functions.columns import slugify

    rows = rows.withColumn("__base", slugify(F.col(text_col)))
    n = F.row_number().over(W.partitionBy("__base").orderBy(order))
    return rows.withColumn("slug", F.when(n > 1, F.concat("__base", F.lit("-"), n)).otherwise(F.col("__base"))).drop("__base")


def renderings(ledgers: DataFrame) -> DataFrame:
    """(id, version, text): four renderings of a ledger (id, title, one_sentence, ward_limit, claims); each must keep the ward limit."""
    join = lambda sep: F.array_join("claims", sep)
    forms = {
        1: F.concat_ws("\n", "title", "one_sentence", "ward_limit", join("\n")), 2: F.concat_ws("\n", "one_sentence", join("; "), "ward_limit"),
        3: F.concat_ws("\n", "title", "ward_limit", F.array_join(F.transform("claims", lambda c: F.concat(F.lit("- "), c)), "\n")), 4: F.concat_ws(" / ", "title", "one_sentence", "ward_limit"),
    }
    rows = ledgers.select("id", "ward_limit", F.explode(F.array(*[F.struct(F.lit(k).alias("version"), t.alias("text")) for k, t in forms.items()])).alias("f"))
    return rows.select("id", "f.version", "f.text", F.contains("f.text", F.col("ward_limit")).alias("kept"))
