"""Packages, ledgers and records around the corpus: inlining, pruning, provenance, JSON checks, small renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_match, ladder, words_of
from . import merkle
from .lines import carry_back, explode_lines
from .lint import station
from .ordered import positions

# ------------------------------------------------------------------ inlining


def inline_tables(docs: DataFrame, tables: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their `[tbl-N.md](tbl-N.md)` lines replaced by the tables (doc, name, body), and an audit row a placeholder: INLINED or MISSING."""
    rows = explode_lines(docs, id_col, text_col).withColumn("name", F.nullif(F.regexp_extract("line", r"\[(tbl-\d+\.md)\]\(tbl-\d+\.md\)", 1), F.lit("")))
    joined = rows.join(tables.select("doc", "name", "body"), ["doc", "name"], "left")
    audit = joined.where("name is not null").select("doc", "ln", "name", F.when(F.col("body").isNull(), "MISSING").otherwise("INLINED").alias("status"))
    line = F.when(F.col("body").isNotNull(), F.col("body")).otherwise(F.col("line"))
    text = joined.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("ln", line.alias("line")))).alias("p"))
    return text.select("doc", F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("text")), audit


def normalise_images(lines: DataFrame, files: DataFrame, reach: int = 30) -> DataFrame:
    """(doc, ln, file, figure, asset, status) of image lines: the next caption's number within reach, else the smallest free one in order.

    A figure number used again gets a _subNN suffix; images that no file (doc, file) stands for are MISSING.
    """
    caption = F.nullif(F.regexp_extract("line", r"(?i)^\W*Fig(?:ure)?\.?\s*\d+\.(\d+)", 1), F.lit("")).cast("int")
    rows = carry_back(lines, caption, "near", reach).withColumn("file", F.nullif(F.regexp_extract("line", r"!\[.*?\]\((img-[^)]+)\)", 1), F.lit("")))
    rows = rows.where("file is not null").join(files.withColumn("have", F.lit(True)), ["doc", "file"], "left")
    most = F.coalesce(F.max("near").over(W.partitionBy("doc")), F.lit(0))
    free = F.sum(F.col("near").isNull().cast("int")).over(W.partitionBy("doc").orderBy("ln").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("figure", F.coalesce(F.col("near"), (most + free).cast("int")))
    again = F.row_number().over(W.partitionBy("doc", "figure").orderBy("ln"))
    rows = rows.withColumn("again", again)
    asset = F.concat(F.format_string("fig_%02d", "figure"), F.when(F.col("again") > 1, F.format_string("_sub%02d", F.col("again") - 1)).otherwise(""), F.lit(".jpeg"))
    return rows.select("doc", "ln", "file", "figure", asset.alias("asset"), F.when(F.col("have"), "OK").otherwise("MISSING").alias("status"))


def insert_image_tags(c: Column, tag_of: str = "assets/figures/fig_$2.jpeg") -> Column:
    """an image tag after each figure citation."""
    return F.regexp_replace(c, r"(\bFig\.\s*\d+\.(\d+))", f"$1 ![]({tag_of})")


# ------------------------------------------------------------------ pruning and packages


def wildcard(name: Column, patterns: list[str]) -> Column:
    """An anchored wildcard match without case."""
    regexes = ["(?i)^" + "".join(".*" if c == "*" else "." if c == "?" else "\\Q" + c + "\\E" for c in p) + "$" for p in patterns]
    return any_match(name, regexes)


def prune(files: DataFrame, drop: list[str], protect: list[str], keep_evidence: list[str] = ()) -> DataFrame:
    """(path, action): files that a drop pattern fits are pruned unless protected or kept as evidence."""
    name = F.element_at(F.split("path", "/"), -1)
    action = ladder([("kept_evidence", wildcard(name, list(keep_evidence))), ("protected", wildcard(name, protect)), ("pruned", wildcard(name, drop))], "kept")
    return files.select("path", action.alias("action"))


IGNORED_FOLDERS = ["audit", "package", "__pycache__", "pytest_cache", "ocr markdown", "global_index", "verification_bundle", "bundle_build"]


def ignorable(name: Column) -> Column:
    """Hidden, cache and report folders."""
    return F.lower(name).startswith(".") | any_match(F.lower(name), IGNORED_FOLDERS)


def by_level(rows: DataFrame, levels: list[str]) -> DataFrame:
    """Rows without a level or with one of those asked for."""
    return rows.where(F.col("level").isNull() | F.col("level").isin(*levels))


def book_table(files: DataFrame) -> DataFrame:
    """(book, chunks, figures, databases, other) file counts of each book by suffix."""
    count = lambda p: F.count_if(F.lower("path").rlike(p))
    known = r"\.(?:md|jpe?g|png|webp|db|sqlite3?)$"
    return files.groupBy("book").agg(count(r"\.md$").alias("chunks"), count(r"\.(?:jpe?g|png|webp)$").alias("figures"), count(r"\.(?:db|sqlite3?)$").alias("databases"), F.count_if(~F.lower("path").rlike(known)).alias("other"))


def missing_figures(texts: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct figure links of texts (doc, text) that no file (path) stands for."""
    links = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"!\[[^\]]*\]\(([^)\s]+)\)"), F.lit(1))).alias("path")).distinct()
    return links.join(files.select("path"), "path", "left_anti")


def source_status(results: DataFrame, sources: DataFrame) -> DataFrame:
    """PASS, FAIL or SKIPPED of each source (source, available) by its smoke results (source, error), and whether the run as a whole succeeds."""
    got = results.groupBy("source").agg(F.count_if(F.col("error").isNull()).alias("good"))
    rows = sources.join(got, "source", "left").withColumn("status", F.when(~F.col("available"), "SKIPPED").when(F.coalesce("good", F.lit(0)) > 0, "PASS").otherwise("FAIL"))
    some, bad = F.max(F.col("available").cast("int")).over(W.partitionBy()), F.max((F.col("status") == "FAIL").cast("int")).over(W.partitionBy())
    return rows.select("source", "status", F.when(some == 0, 1).otherwise(bad).alias("exit_code"))


# ------------------------------------------------------------------ ledgers, reviews and grouped findings


BLOCK = 1000  #: chapters in one table


def status_table(ledger: DataFrame) -> DataFrame:
    """(block, text): the trust ledger as markdown tables of BLOCK chapters each, in order, bars escaped."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    row = F.concat(F.lit("| "), cell("chapter"), F.lit(" | "), cell("classification"), F.lit(" | "), cell("trusted"), F.lit(" |"))
    rows = positions(ledger.select("chapter", row.alias("row")), ["chapter"], "n")
    rows = rows.groupBy(F.floor(F.col("n") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(F.struct("n", "row"))).alias("r"))  # BLOCK at most
    return rows.select("block", F.concat(F.lit("| Chapter | Classification | Trusted |\n|---|---|---|\n"), F.array_join(F.transform("r", lambda x: x["row"]), "\n")).alias("text"))


def parse_status_table(tables: DataFrame, text_col: str = "text") -> DataFrame:
    """(chapter, classification) of a markdown table's rows."""
    row = F.explode(F.regexp_extract_all(text_col, F.lit(r"(?m)^\|[^\n]+\|$"), F.lit(0)))
    cells = F.transform(F.split("row", r"(?<!\\)\|"), lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|")))
    rows = tables.select(row.alias("row")).select(F.get(cells, F.lit(1)).alias("chapter"), F.get(cells, F.lit(2)).alias("classification"))
    return rows.where(~F.col("chapter").rlike("^-+$") & (F.col("chapter") != "Chapter"))


def review_problems(controls: DataFrame, decisions: DataFrame, unreviewed: DataFrame) -> DataFrame:
    """(control_id, problem): what breaks that decided and undecided ids divide the controls between them, and what is wrong with a decision.

    controls: control_id; decisions: control_id, decision, evidence_state and the texts of P.DECISION_TEXTS; unreviewed:
    control_id. All three meet in one aggregation by id.
    """
    one, none = F.lit(1), F.lit(0)
    flags = lambda t, k, d, u: t.select("control_id", k.alias("k"), d.alias("d"), u.alias("u"))
    every = flags(controls, one, none, none).unionAll(flags(decisions, none, one, none)).unionAll(flags(unreviewed, none, none, one))
    each = every.groupBy("control_id").agg(*[F.sum(c).alias(c) for c in "kdu"])
    sides = F.array(
        F.when(F.col("d") > 1, "decided twice"), F.when(F.col("u") > 1, "unreviewed twice"), F.when((F.col("d") > 0) & (F.col("u") > 0), "reviewed and unreviewed"),
        F.when(F.col("k") == 0, "unknown control"), F.when((F.col("k") > 0) & (F.col("d") + F.col("u") == 0), "omitted control"),
    )
    wrong = [F.when(~F.coalesce(F.col("decision").isin(*P.REVIEW_DECISIONS), F.lit(False)), "decision"), F.when(~F.coalesce(F.col("evidence_state").isin(*P.EVIDENCE_STATES), F.lit(False)), "evidence_state")]
    for name, most in P.DECISION_TEXTS.items():
        text = F.coalesce(F.col(name), F.lit(""))
        wrong.append(F.when((F.trim(F.translate(text, "\t\r\n", "   ")) == "") | (F.length(text) > most) | text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"), name))
    some = lambda t, found: t.select("control_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("problem"))
    return some(each, sides).unionByName(some(decisions, F.array(*wrong)))


def review_header_problems(header: DataFrame, scope: DataFrame, decisions: DataFrame, unreviewed: DataFrame, controls: DataFrame, gaps: DataFrame) -> DataFrame:
    """(problem) of a review as a whole: header (review_mode, scope_sha256, map_sha256, surface, model, profile_date, semantic_files_reviewed, one row) against scope (scope_sha256, map_sha256, surface, model, one row) and the numbers of rows."""
    n, left, known, told = (t.count() for t in (decisions, unreviewed, controls, gaps))
    h = header.first()
    s = scope.first()
    dated = F.lit(h.profile_date).try_cast("date").isNotNull() & F.lit(h.profile_date or "").rlike(r"^\d{4}-\d{2}-\d{2}$")
    found = [
        ("review_mode", h.review_mode not in P.REVIEW_LIMITS), ("scope_sha256", h.scope_sha256 != s.scope_sha256), ("map_sha256", h.map_sha256 != s.map_sha256), ("runtime", (h.surface, h.model) != (s.surface, s.model)),
        ("too many decisions", n > P.REVIEW_LIMITS.get(h.review_mode, n)), ("too many unreviewed", left > P.MOST_UNREVIEWED), ("semantic_files_reviewed", h.semantic_files_reviewed != n), ("no decision", known > 0 and n == 0), ("no coverage gap", left > 0 and told == 0),
    ]
    rows = header.select(F.explode(F.filter(F.array(F.when(~dated, "profile_date"), *[F.lit(name if bad else None) for name, bad in found]), lambda x: x.isNotNull())).alias("problem"))
    return rows.withColumn("problem", F.col("problem").cast("string"))


def merge_review(controls: DataFrame, decisions: DataFrame, map_sha256: str, scope_sha256: str) -> tuple[DataFrame, DataFrame]:
    """The controls (control_id, sha256 and others) with their decisions, and (control_id, problem) where merging changed the controls or made one change id twice.

    What is not decided stays UNDECIDED. A decision other than KEEP gets a change id bound to both baselines and to the whole proposal.
    """
    review = f"HARNESS-{map_sha256[:10].upper()}-{scope_sha256[:10].upper()}"
    fields = sorted(["control_id", "decision", "evidence_state", *P.DECISION_TEXTS])
    proposal = F.to_json(F.struct(*[F.col(f) for f in fields]))
    change = F.concat(F.lit("CHANGE-"), F.upper(F.substring(F.sha2(F.concat(F.lit(f"{review}\u0000{map_sha256}\u0000"), proposal), 256), 1, 32)))
    said = decisions.select(*fields, F.when(F.col("decision") != "KEEP", change).alias("change_id"))
    merged = controls.join(said, "control_id", "left").withColumn("decision", F.coalesce("decision", F.lit("UNDECIDED")))
    altered = merkle.changed_rows(controls, merged, ["control_id", "sha256"]).select(F.col("hash").alias("control_id"), F.lit("altered control").alias("problem"))
    doubled = merged.where("change_id is not null").groupBy("change_id").agg(F.min("control_id").cast("string").alias("control_id"), F.count("*").alias("n")).where("n > 1").select("control_id", F.lit("change id used twice").alias("problem"))
    return merged, altered.unionByName(doubled)


def stations(controls: DataFrame) -> DataFrame:
    """(station, place, n): how many controls (kind, path) stand at each of the five stations, in their order, empty ones included."""
    every = controls.sparkSession.createDataFrame(list(zip(P.STATIONS, range(5))), "station string, place int")
    got = controls.groupBy(station(F.col("kind"), F.col("path")).alias("station")).agg(F.count("*").alias("n"))
    return every.join(got, "station", "left").select("station", "place", F.coalesce("n", F.lit(0)).alias("n"))


def partition_claims(claims: DataFrame) -> DataFrame:
    """Claims (id, status, locator) as books, guides or refused: only supported claims with a locator are kept."""
    kind = F.when((F.col("status") != "supported") | F.coalesce(F.col("locator"), F.lit("")).isin(""), "refused").when(F.col("locator").rlike("(?i)guideline"), "guide").otherwise("book")
    return claims.select("id", kind.alias("part"))


def unify(rows: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Columns under either of two names as one, the first non-null wins."""
    out = rows
    for old, new in pairs.items():
        have = [F.col(c) for c in (new, old) if c in rows.columns]
        out = out.withColumn(new, F.coalesce(*have)) if have else out
    return out.drop(*[o for o in pairs if o in rows.columns])


def disclosures(findings: DataFrame) -> DataFrame:
    """One row of advisory counts by kind."""
    return findings.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("missing", "added", "flipped", "reordered", "split", "incomplete")])


def review_text(findings: DataFrame, verdicts) -> DataFrame:
    """Findings judged by an outside callable (a batch of texts to a list of verdicts), partition by partition.

    The callable is given by the caller; where it raises, the batch keeps its rule-based value and is marked for manual review.
    """

    def run(batches):
        for batch in batches:
            try:
                batch["verdict"], batch["manual"] = verdicts(list(batch["text"])), False
            except Exception:
                batch["verdict"], batch["manual"] = batch["rule"], True
            yield batch[["id", "verdict", "manual"]]

    return findings.select("id", "text", "rule").mapInPandas(run, f"id {findings.schema['id'].dataType.simpleString()}, verdict string, manual boolean")


# ------------------------------------------------------------------ entries and spans of an artefact


def span_faults(spans_: DataFrame, sources: DataFrame) -> DataFrame:
    """(entry, fault) of rendered spans (entry, idx, start, end, grp, text) against their sources (entry, source): gap, cover, text, group."""
    by, whole = W.partitionBy("entry").orderBy("idx"), W.partitionBy("entry").orderBy("idx").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = spans_.join(sources, "entry").withColumn("before", F.coalesce(F.lag("end").over(by), F.lit(0))).withColumn("change", F.coalesce((F.lag("grp").over(by) != F.col("grp")).cast("int"), F.lit(1)))
    rows = rows.withColumn("wrong", F.col("text") != F.substr("source", F.col("start") + 1, F.col("end") - F.col("start")))
    # windows over the order that is there already hold one entry at a time; a hash table would hold all of a task
    got = rows.select(
        "entry", F.row_number().over(by).alias("n"), F.max(F.col("before") != F.col("start")).over(whole).alias("gap"), (F.max("end").over(whole) != F.max(F.length("source")).over(whole)).alias("cover"),
        F.max("wrong").over(whole).alias("text"), (F.sum("change").over(whole) != F.size(F.collect_set("grp").over(whole))).alias("group"),
    ).where("n = 1")
    faults = F.array(*[F.when(F.col(c), F.lit(c)) for c in ("gap", "cover", "text", "group")])
    return got.select("entry", F.explode(F.filter(faults, lambda x: x.isNotNull())).alias("fault"))


def semantic_cache(terms: DataFrame, most: int = 300, facets: int = 5) -> DataFrame:
    """The first subtrees with their first facets."""
    first = terms.where(F.size("subs") >= 3).orderBy("term_ord").limit(most)
    return first.select(F.lower("term").alias("concept"), F.array_join(F.slice("subs", 1, facets), "; ").alias("facets"))


def safety_matrix(spark) -> DataFrame:
    """The constant safety rows; nothing in them is derived from data."""
    rows = [(d, P.SAFETY_INDICATION, P.SAFETY_PRECAUTIONS) for d in P.SAFETY_DRUGS]
    return spark.createDataFrame(rows, "drug string, indication string, precautions string")


# ------------------------------------------------------------------ JSON, provenance, rendering


def canonical_json(*cols: Column) -> Column:
    """columns as JSON with sorted keys; text is not escaped to ASCII."""
    return F.to_json(F.struct(*cols))


def parse_verdicts(response: Column, kinds: list[str]) -> Column:
    """an array of (id, type) from a response that may wrap its JSON array in prose; unknown types are dropped, no array gives none."""
    raw = F.regexp_extract(response, r"(?s)(\[.*\])", 1)
    rows = F.from_json(raw, "array<struct<chunk_id:string,semantic_type:string>>")
    return F.coalesce(F.filter(rows, lambda r: r["semantic_type"].isin(*kinds)), F.array().cast("array<struct<chunk_id:string,semantic_type:string>>"))


def trace_problems(c: Column) -> Column:
    """what a run trace (JSON) breaks, as an array; types count, so that a number is no note and true no count."""
    v = F.try_parse_json(c)
    at = lambda x, path, kind="variant": F.try_variant_get(x, path, kind)
    kind = lambda x: F.coalesce(F.schema_of_variant(x), F.lit(""))
    text = lambda x, path: F.when(kind(at(x, path)) == "STRING", at(x, path, "string"))
    said = lambda x, path: F.coalesce(F.trim(F.translate(text(x, path), "\t\r\n", "   ")) != "", F.lit(False))
    among = lambda x, path, values: F.coalesce(text(x, path).isin(*values), F.lit(False))
    listed = kind(at(v, "$.funnel")).startswith("ARRAY")
    funnel = F.coalesce(at(v, "$.funnel", "array<variant>"), F.array().cast("array<variant>"))
    stages = F.transform(funnel, lambda e: F.coalesce(text(e, "$.stage"), F.lit("")))
    keep = lambda a: F.filter(a, lambda x: x.isNotNull())

    def of_stage(e: Column, i: Column) -> Column:
        where = F.concat(F.lit("funnel["), i.cast("string"), F.lit("]"))
        known, earlier = among(e, "$.stage", P.RUN_STAGES), F.array_contains(F.slice(stages, 1, i), F.coalesce(text(e, "$.stage"), F.lit("")))
        count = at(e, "$.count")
        whole = count.isNull() | (kind(count) == "VOID") | ((kind(count) == "BIGINT") & F.coalesce(at(e, "$.count", "bigint") >= 0, F.lit(False)))
        own = keep(F.array(
            F.when(~known, F.concat(where, F.lit(".stage is invalid"))), F.when(known & earlier, F.concat(where, F.lit(".stage is duplicated"))), F.when(~among(e, "$.status", P.STAGE_STATUSES), F.concat(where, F.lit(".status is invalid"))),
            F.when(~whole, F.concat(where, F.lit(".count must be null or a non-negative integer"))), F.when(~said(e, "$.detail"), F.concat(where, F.lit(".detail must be a non-empty string"))),
        ))
        return F.when(kind(e).startswith("OBJECT"), own).otherwise(F.array(F.concat(where, F.lit(" must be an object"))))

    head = keep(F.array(
        F.when(~among(v, "$.trace_status", P.TRACE_STATUSES), "trace_status must be COMPLETE, PARTIAL, or NOT_EXPOSED"), F.when(~said(v, "$.trace_note"), "trace_note must be a non-empty string"), F.when(~listed, "funnel must be a list"),
        F.when(listed & among(v, "$.trace_status", ["COMPLETE"]) & (F.size(funnel) == 0), "a COMPLETE trace must have at least one funnel stage"),
    ))
    found = F.concat(head, F.when(listed, F.flatten(F.transform(funnel, of_stage))).otherwise(F.array().cast("array<string>")))
    return F.when(kind(v).startswith("OBJECT"), found).otherwise(F.array(F.lit("top level must be an object")))


def provenance(source: Column, stage: str, version: str) -> Column:
    """a struct with the source's hash, the stage and the engine version."""
    return F.struct(F.sha2(source, 256).alias("source_sha256"), F.lit(stage).alias("stage"), F.lit(version).alias("engine_version"))


def provenance_comment(source: Column, stage: str, version: str) -> Column:
    """the same as a comment line."""
    return F.format_string(f"<!-- provenance: stage={stage} engine={version} sha256=%s -->", F.sha2(source, 256))


def private_path(c: Column) -> Column:
    """the first home-folder or drive path in a text or JSON, null for none."""
    return F.nullif(F.regexp_extract(c, r"((?:/home/|/Users/|[A-Z]:\\\\?)[^\"\s,}]+)", 1), F.lit(""))


def rewrite_version(c: Column, new: str) -> Column:
    """the version of a `version:` line or field."""
    return F.regexp_replace(c, r"(?m)^(\s*\"?version\"?\s*[:=]\s*\"?)v?\d+\.\d+\.\d+[^\s\",]*", "$1" + new)


def safe_link(c: Column) -> Column:
    """only web addresses pass."""
    return F.when(c.rlike(r"(?i)^https?://"), c)


def package_header(c: Column) -> Column:
    """struct of name, version and description from frontmatter."""
    get = lambda n: F.nullif(F.regexp_replace(F.regexp_extract(c, rf"(?m)^{n}:[ \t]*(.*?)[ \t]*$", 1), "^[\"']|[\"']$", ""), F.lit(""))
    return F.struct(get("name").alias("name"), F.coalesce(get("version"), F.lit("UNKNOWN")).alias("version"), get("description").alias("description"))


def inline_html(c: Column) -> Column:
    """escaped text with bold, emphasis, code and web links as HTML."""
    out = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    for pattern, to in ((r"`([^`]+)`", "<code>$1</code>"), (r"\*\*([^*]+)\*\*", "<strong>$1</strong>"), (r"\*([^*]+)\*", "<em>$1</em>"), (r"\[([^\]]+)\]\((https?://[^)\s]+)\)", '<a href="$2">$1</a>')):
        out = F.regexp_replace(out, pattern, to)
    return out


def crowded(c: Column) -> Column:
    """texts over 320 characters, or over 180 with two labels or more."""
    return (F.length(c) > 320) | ((F.length(c) > 180) & (F.regexp_count(c, F.lit(r"\b[A-Z][a-z]+:")) >= 2))


def rewrite_sources(c: Column, old: str, new: str) -> Column:
    """Source paths of a script rewritten, with whether any old one is left."""
    done = F.replace(c, F.lit(old), F.lit(new))
    return F.struct(done.alias("text"), F.contains(done, F.lit(old)).alias("residue"), F.size(words_of(done)).alias("words"))
