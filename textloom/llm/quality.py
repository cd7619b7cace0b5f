"""Quality rules whose thresholds come from the data: quantile sketches of each language and source.

A sketch counts values in buckets of a fixed rule: exact below 2 ** BITS, beyond it 2 ** BITS
buckets for each power of two. Sketches merge by adding counts, so a group's thresholds do not
depend on how rows lie in partitions or in which order they are merged, and a language's sketch is the
sum of its sources'. A group has at most (64 - BITS) * 2 ** BITS buckets for each measure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import _SPACE, buffers, mix, shingles, slices, span_hashes, word_spans

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
LEAST_WORDS, MOST_REPEATED = 10, 20  #: the base rule: words at least, and per cent of words in repeated windows
BITS = 7
FENCE = 3  #: spreads from the quartile to a threshold
LEAST_GROUP = 50  #: documents of a group whose own sketch is used; smaller ones take their language's, or all
BROADCAST = 200_000  #: groups whose thresholds are broadcast; beyond it they are joined by a shuffle
_LINE = np.zeros(256, dtype=bool)
_LINE[10] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _repeats(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value occurs twice or more in its row, and whether it occurred there before."""
    if not len(rows):
        return np.zeros(0, bool), np.zeros(0, bool)
    _, first, inverse, counts = np.unique(mix(hashes + mix(rows.astype(np.uint64))), return_index=True, return_inverse=True, return_counts=True)
    return counts[inverse] > 1, np.arange(len(rows)) != first[inverse]


def _measured(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts of BASE for each row of a slice."""
    n = len(offsets) - 1
    per_row = lambda at: np.bincount(np.searchsorted(offsets, at, "right") - 1, minlength=n)
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)
    letters = np.flatnonzero(~_SPACE[data] & ((data & 0xC0) != 0x80))
    hashes, begin = shingles(span_hashes(data, starts, ends), first, WINDOW)
    rows = np.repeat(np.arange(n), np.diff(begin))
    twice, _ = _repeats(rows, hashes)
    twice &= n_words[rows] >= WINDOW
    at = first[:-1][rows] + np.arange(len(hashes)) - begin[:-1][rows]
    covered = np.zeros(len(starts) + WINDOW, np.int64)
    np.add.at(covered, at[twice], 1)
    np.subtract.at(covered, at[twice] + WINDOW, 1)
    covered = np.cumsum(covered)[: len(starts)] > 0
    own = np.concatenate([[0], np.cumsum(covered)])
    # a line has a word where a word starts in it; empty lines are no spans
    line_starts, line_ends, _ = word_spans(data, offsets, _LINE)
    holds = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[holds], line_ends[holds]
    line_rows = np.searchsorted(offsets, line_starts, "right") - 1
    _, again = _repeats(line_rows, span_hashes(data, line_starts, line_ends))
    return [n_words, per_row(letters), per_row(np.flatnonzero(_SYMBOL[data])), np.bincount(line_rows[again], minlength=n), own[first[1:]] - own[first[:-1]], np.bincount(line_rows, minlength=n)]


def _measure(names: list[str]):
    def run(batches):
        for b in batches:
            text = b.column("__text")
            parts: list[list[np.ndarray]] = [[] for _ in BASE]
            for i, j in slices(text):
                for part, x in zip(parts, _measured(*buffers(text.slice(i, j - i)))):
                    part.append(x)
            columns = [pa.array(np.concatenate(p) if p else np.zeros(0), pa.int64()) for p in parts]
            yield pa.record_batch([b.column(c) for c in names] + columns, names=[*names, *BASE])

    return run


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` and the counts of BASE for every row; a null text counts as empty. BASE wins over clashing names."""
    keep = [c for c in keep if c not in BASE]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    ddl = ", ".join([*filter(None, [fields]), *[f"{c} long" for c in BASE]])
    return docs.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(_measure(keep), ddl)


@dataclass(frozen=True)
class Rule:
    """A ratio in whole numbers, floor(scale * part / whole), held against quartiles of its group.

    The threshold is FENCE spreads above the upper quartile, the spread being the distance of the quartiles or
    `spread` where they lie closer; noise / sqrt(whole) is allowed on top, as short texts vary more.
    """

    name: str
    part: str
    whole: str
    scale: int
    spread: int
    noise: int
    low: bool = False  #: too small fails as well

    def value(self) -> Column:
        return F.when(F.col(self.whole) > 0, F.floor(self.scale * F.col(self.part) / F.greatest(F.col(self.whole), F.lit(1)))).cast("long")

    def fails(self) -> Column:
        v, slack, q1, q3 = F.col(f"__{self.name}"), self.noise / F.sqrt(F.greatest(F.col(self.whole), F.lit(1)).cast("double")), F.col(f"{self.name}_q1"), F.col(f"{self.name}_q3")
        wide = FENCE * F.greatest(q3 - q1, F.lit(self.spread))
        out = v > q3 + wide + slack
        return F.coalesce(out | (v < q1 - wide - slack) if self.low else out, F.lit(False))


RULES = (
    Rule("length", "word_chars", "n_words", 100, 10, 1000, low=True),
    Rule("symbols", "n_symbols", "n_words", 1000, 20, 800),
    Rule("lines", "n_dup_lines", "n_lines", 1000, 100, 2000),
    Rule("repeats", "n_repeat_words", "n_words", 1000, 60, 1000),
)


def bucket(v: Column, bits: int = BITS) -> Column:
    """The lower edge of a value's bucket: the value with all but its `bits` + 1 leading binary digits cleared."""
    cut = F.greatest(F.length(F.bin(v)) - (bits + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, cut), cut)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def sketches(measured: DataFrame, by: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(by, rule, edge, n): the bucket counts of each group's documents that pass the base rule. Sketches of parts merge by adding n."""
    rows = measured.where(~base_failed())
    pairs = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), bucket(r.value()).alias("edge")) for r in rules])).alias("p")
    return rows.select(*by, pairs).where("p.edge is not null").groupBy(*by, F.col("p.rule").alias("rule"), F.col("p.edge").alias("edge")).agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(by, <rule>_q1, <rule>_q3, <rule>_n) of each group: the edges where a quarter and three quarters of its counts are reached."""
    along = W.partitionBy(*by, "rule").orderBy("edge")
    rows = sketch.groupBy(*by, "rule", "edge").agg(F.sum("n").alias("n"))
    rows = rows.withColumn("upto", F.sum("n").over(along)).withColumn("all", F.sum("n").over(W.partitionBy(*by, "rule")))
    took = [F.min(F.when((F.col("rule") == r.name) & (4 * F.col("upto") >= q * F.col("all")), F.col("edge"))).alias(f"{r.name}_q{q}") for r in rules for q in (1, 3)]
    return rows.groupBy(*by).agg(*took, *[F.max(F.when(F.col("rule") == r.name, F.col("all"))).alias(f"{r.name}_n") for r in rules])


def thresholds(measured: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(lang, source, <rule>_q1, <rule>_q3) for every group of `measured`: of its own sketch, its language's or all of them, whichever is the first with LEAST_GROUP documents.

    The sketch of a language is merged from its sources', and the whole from the languages'. Nulls are a group of their own.
    """
    groups = scratch.write(sketches(measured, ("lang", "source"), rules), "sketches")
    langs = scratch.write(groups.groupBy("lang", "rule", "edge").agg(F.sum("n").alias("n")), "languages")
    every = quartiles(langs.groupBy("rule", "edge").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1)), ["one"], rules).first()  # one row
    own, lang = quartiles(groups, ["lang", "source"], rules), quartiles(langs, ["lang"], rules)
    names = measured.select("lang", "source").distinct()
    mark = lambda df, p: df.select(*[F.col(c).alias(f"{p}{c}") for c in df.columns])
    own, lang = mark(own, "g_"), mark(lang, "l_")
    found = names.join(own, names.lang.eqNullSafe(own.g_lang) & names.source.eqNullSafe(own.g_source), "left")
    found = found.join(lang, found.lang.eqNullSafe(lang.l_lang), "left")
    out = []
    for r in rules:
        for q in ("q1", "q3"):
            c = f"{r.name}_{q}"
            first = F.when(F.col(f"g_{r.name}_n") >= LEAST_GROUP, F.col(f"g_{c}")).when(F.col(f"l_{r.name}_n") >= LEAST_GROUP, F.col(f"l_{c}"))
            out.append(first.otherwise(F.lit(every[c] if every else None).cast("long")).alias(c))
    return scratch.write(found.select("lang", "source", *out), "thresholds")


def _joined(measured: DataFrame, limits: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    limits = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *limits.columns[2:])
    if limits.count() <= BROADCAST:
        limits = F.broadcast(limits)
    rows = measured.join(limits, measured.lang.eqNullSafe(limits["__lang"]) & measured.source.eqNullSafe(limits["__source"]), "left")
    rows = rows.withColumns({f"__{r.name}": r.value() for r in rules})
    rows = rows.withColumn("base_failed", base_failed())
    rows = rows.withColumn("reasons", F.concat_ws(",", *[F.when(r.fails(), F.lit(r.name)) for r in rules]))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("reasons") == ""))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row for each row of docs: id_col, the counts of BASE, base_failed, kept, reasons (the rules it fails, joined by commas).

    A null text is judged as an empty one and fails the base rule, as every text of fewer than LEAST_WORDS words
    does. Null languages and sources form groups of their own; ids play no part, so that null and repeated ones stay.
    Equal texts of a group get equal verdicts. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    named = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    measured = scratch.write(measure(named, "text", ("__id", "lang", "source")), "measured")
    rows = _joined(measured, thresholds(measured, scratch, rules), rules)
    return rows.select(F.col("__id").alias(id_col), *BASE, "base_failed", "kept", "reasons")


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that `judge` keeps, all columns as they are."""
    scratch = Scratch(docs.sparkSession, "quality")
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    limits = thresholds(measure(whole, "text", ("lang", "source")), scratch, rules)
    return _joined(measure(whole, "text", ("__row", "lang", "source")), limits, rules).where("kept").select("__row.*")


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of `judge` on documents."""
    edge = lambda v: f"case when {v} < {1 << (BITS + 1)} then {v} else ({v} >> (length(bin({v})) - {BITS + 1})) << (length(bin({v})) - {BITS + 1}) end"
    values = ", ".join(f"case when {r.whole} > 0 then {r.scale} * {r.part} // {r.whole} end as v_{r.name}" for r in rules)
    long = " union all ".join(f"select lang, source, '{r.name}' as rule, {edge('v_' + r.name)} as edge from b where not base_failed and v_{r.name} is not null" for r in rules)

    def picked(r: Rule, q: str) -> str:
        return f"case when g.{r.name}_n >= {LEAST_GROUP} then g.{r.name}_{q} when l.{r.name}_n >= {LEAST_GROUP} then l.{r.name}_{q} else e.{r.name}_{q} end as {r.name}_{q}"

    def quarter(by: str) -> str:
        took = ", ".join(f"min(edge) filter (rule = '{r.name}' and 4 * upto >= {q} * al) as {r.name}_q{q}" for r in rules for q in (1, 3)) + ", " + ", ".join(f"max(al) filter (rule = '{r.name}') as {r.name}_n" for r in rules)
        inner = f"select {by}, rule, edge, sum(count(*)) over (partition by {by}, rule order by edge) as upto, sum(count(*)) over (partition by {by}, rule) as al from h group by {by}, rule, edge"
        return f"select {by}, {took} from ({inner}) group by {by}"

    def fails(r: Rule) -> str:
        wide, slack = f"{FENCE} * greatest({r.name}_q3 - {r.name}_q1, {r.spread})", f"{r.noise} / sqrt({r.whole}::double)"
        low = f" or v_{r.name} < {r.name}_q1 - {wide} - {slack}" if r.low else ""
        return f"case when v_{r.name} > {r.name}_q3 + {wide} + {slack}{low} then '{r.name}' end"

    return rf"""
with w as materialized (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') as t from documents),
s as (select rid, unnest(range(1, len(t) - 3)) as i, t from w where len(t) >= 5),
g as (select rid, i, count(*) over (partition by rid, t[i:i + 4]) as n from s),
p as (select rid, count(distinct j)::bigint as n_repeat_words from (select rid, unnest(range(i, i + 5)) as j from g where n > 1) group by rid),
ln as (select rid, unnest(string_split(text, chr(10))) as line from w),
ld as (select rid, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from ln where regexp_matches(line, '[^ 	-
]') group by rid),
a as (select w.rid, doc_id, lang, source, len(t)::bigint as n_words, coalesce(list_sum(list_transform(t, lambda x: length(x))), 0)::bigint as word_chars,
      (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::bigint as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines
      from w left join p on p.rid = w.rid left join ld on ld.rid = w.rid),
b as materialized (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed, {values} from a),
h as ({long}),
qg as ({quarter("lang, source")}), ql as ({quarter("lang")}), qe as ({quarter("1")}),
f as (select b.*, {", ".join(picked(r, q) for r in rules for q in ("q1", "q3"))} from b left join qg g on g.lang is not distinct from b.lang and g.source is not distinct from b.source
      left join ql l on l.lang is not distinct from b.lang left join qe e on true),
o as (select *, concat_ws(',', {", ".join(fails(r) for r in rules)}) as reasons from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, not base_failed and reasons = '' as kept, reasons from o"""
