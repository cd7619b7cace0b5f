"""Queries over the Parquet tables: retrieval, lines, spans, fidelity, index and hashes."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions import columns as C
from ..operators import audit, blocks, fidelity, guard, index, lint, lines, merkle, modalities, ordered, retrieval, spans
from ..registry import query, table

_STOP = "[" + ", ".join(f"'{w}'" for w in sorted(P.STOPWORDS)) + "]"
_TOKENS = "list_filter(regexp_extract_all(lower({t}), '[a-z0-9]+'), lambda x: length(x) > 1 and not list_contains(" + _STOP + ", x))"


def _bm25_sql(docs: str, key: str, text: str, queries: str, qkey: str, qtext: str) -> str:
    return f"""
with d as (select {key} as doc, {_TOKENS.format(t=text)} as toks from {docs}),
s as (select count(*)::double as n, avg(len(toks)) as avgdl from d),
p as (select doc, len(toks) as dl, unnest(toks) as term from d),
c as (select doc, dl, term, count(*) as tf from p group by all),
f as (select term, ln((s.n - count(*) + 0.5) / (count(*) + 0.5) + 1.0) as idf from c, s group by term, s.n),
qt as (select {qkey} as query, unnest({_TOKENS.format(t=qtext)}) as term, generate_subscripts({_TOKENS.format(t=qtext)}, 1) as k from {queries}),
qf as (select query, term, min(k) as k from qt group by all),
q as (select query, term from qf qualify row_number() over (partition by query order by k) <= {P.QUERY_TERMS}),
h as (select q.query, c.doc, sum(f.idf * (c.tf * ({P.K1} + 1)) / (c.tf + {P.K1} * (1 - {P.B} + {P.B} * c.dl / s.avgdl))) as score
      from q join c on c.term = q.term join f on f.term = q.term, s group by q.query, c.doc)"""


@query("bm25_topk", "F23 F24 A23 O08 O02 Q25 S06", _bm25_sql("documents", "doc_id", "text", "benchmark", "item_id", "text") + """
select query, doc, rank, round(score, 5) as score from
  (select *, row_number() over (partition by query order by round(score, 5) desc, doc) as rank from h) where rank <= 3""")
def bm25_topk(spark, sf_dir):
    docs, asked = table(spark, sf_dir, "documents"), retrieval.query_terms(table(spark, sf_dir, "benchmark"), "item_id", "text")
    scores = retrieval.bm25(docs, asked, "doc_id", "text").withColumn("score", F.round("score", 5))
    top = retrieval.top_k(scores, ["query"], [F.desc("score"), "doc"], 3)
    return top.select("query", "doc", F.col("rank").cast("bigint").alias("rank"), "score")


@query("bm25_hit_rates", "W14 A24 U19", _bm25_sql("benchmark", "item_id", "text", "benchmark", "item_id", "text") + """
, o as (select query, score from h where query = doc),
r as (select o.query, 1 + count(*) filter (where round(h.score, 6) > round(o.score, 6) or (round(h.score, 6) = round(o.score, 6) and h.doc < h.query)) as rank
      from o join h on h.query = o.query group by o.query)
select query % 4 as part, count(*) as n, avg((rank <= 1)::int) as hit_1, avg((rank <= 3)::int) as hit_3, avg((rank <= 5)::int) as hit_5, avg((rank <= 10)::int) as hit_10, round(avg(1.0 / rank), 6) as mrr
from r group by rollup (query % 4)""")
def bm25_hit_rates(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    scores = retrieval.bm25(items, retrieval.query_terms(items, "item_id", "text"), "item_id", "text").withColumn("score", F.round("score", 6))
    ranks = retrieval.target_ranks(scores, items, items.select(F.col("item_id").alias("query"), F.col("item_id").alias("doc")), "item_id")
    return retrieval.hit_rates(ranks.withColumn("part", F.col("query") % 4), "part").withColumn("mrr", F.round("mrr", 6))


@query("blocked_topk", "A19 F24 O02", _bm25_sql("documents", "doc_id", "text", "benchmark", "item_id", "text") + """
select query, doc, rank, round(score, 5) as score from
  (select *, row_number() over (partition by query order by round(score, 5) desc, doc) as rank from h) where rank <= 10""")
def blocked_topk(spark, sf_dir):
    """The ten best documents of each benchmark item from a blocked index, blocks of too low a bound left out."""
    top, _ = blocks.search(blocks.build(table(spark, sf_dir, "documents"), "doc_id", "text", block=256), retrieval.query_terms(table(spark, sf_dir, "benchmark"), "item_id", "text"), 10)
    return top.select("query", "doc", F.col("rank").cast("bigint").alias("rank"), "score")


@query("posting_blocks", "A19", "with d as (select doc_id as doc, " + _TOKENS.format(t="text") + """ as toks, row_number() over (order by doc_id) - 1 as place from documents),
c as (select term, place, count(*) as tf, any_value(n) as n from (select unnest(toks) as term, place, len(toks) as n from d) group by term, place)
select term, (place // 256)::bigint as block, count(*) as n, md5(string_agg(place || ':' || tf || ':' || n, ',' order by place)) as postings from c group by all""")
def posting_blocks(spark, sf_dir):
    """The blocks of the same index, their postings unpacked."""
    rows = blocks.build(table(spark, sf_dir, "documents"), "doc_id", "text", block=256).blocks
    own = F.arrays_zip(blocks.places_of(F.col("base"), F.col("gaps")).alias("place"), "tfs", "lengths")
    text = F.array_join(F.transform(own, lambda p: F.concat_ws(":", p["place"].cast("string"), p["tfs"].cast("string"), p["lengths"].cast("string"))), ",")
    return rows.select("term", "block", "n", F.md5(text).alias("postings"))


_WORDS = ["disgusting", "licensed", "version", "the"]


@query("federated_search", "O01 O02 O23 O24 O30 O31 E02 E03 Q26", "with s as (select lang, doc_id, " + " + ".join(f"contains(lower(text), '{w}')::int" for w in _WORDS) + """ as score from documents)
select lang, doc_id, 2 * score as score, rank, excerpt from (select s.*, substr(d.text, 1, 150) as excerpt, row_number() over (partition by s.lang order by score desc, s.doc_id) as rank
  from s join documents d on d.doc_id = s.doc_id where score > 0) where rank <= 3""")
def federated_search(spark, sf_dir):
    text = F.lower("text")
    score = sum((F.contains(text, F.lit(w)).cast("bigint") * 2 for w in _WORDS), F.lit(0))
    rows = table(spark, sf_dir, "documents").withColumn("score", score).where("score > 0").select("lang", "doc_id", "score", F.substring("text", 1, 150).alias("excerpt"))
    return retrieval.top_k(rows, ["lang"], [F.desc("score"), "doc_id"], 3).withColumn("rank", F.col("rank").cast("bigint"))


@query("outline_lookup", "O03 O05 O25 O27 O29 O32 O34", """
(select 'contains' as kind, p_partkey, p_name from part where contains(lower(concat_ws(' ', p_name, p_type)), 'a') order by p_partkey limit 5)
union all (select 'exact', p_partkey, p_name from part where contains(lower(p_brand), 'brand') or contains('brand', lower(p_brand)) order by case when lower(p_brand) = 'brand' then 0 else 1 end, p_partkey limit 1)""")
def outline_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    a = retrieval.contains_any(parts, ["p_name", "p_type"], "a", 5, "p_partkey").select(F.lit("contains").alias("kind"), "p_partkey", "p_name")
    return a.unionByName(retrieval.lookup(parts, "p_brand", "brand", "p_partkey").select(F.lit("exact").alias("kind"), "p_partkey", "p_name"))


@query("fallback_filter", "O04 O16 O17 O28 O33 E05 E06", """
select 'hit' as kind, n_nationkey from nation where n_regionkey = 1 union all select 'all', n_nationkey from nation""")
def fallback_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "nation")
    a = retrieval.first_or_all(rows, F.col("n_regionkey") == 1, "n_nationkey").select(F.lit("hit").alias("kind"), "n_nationkey")
    return a.union(retrieval.first_or_all(rows, F.col("n_regionkey") == 99, "n_nationkey").select(F.lit("all"), "n_nationkey"))


@query("word_budget", "O06 O07 Q23", """
select doc_id, len(w)::bigint as words, md5(array_to_string(w[1:1500], ' ')) as head from
  (select doc_id, list_filter(regexp_split_to_array(trim(text, ' '), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') as w from documents)""")
def word_budget(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.size(C.words_of(F.col("text"))).cast("bigint").alias("words"), F.md5(C.first_words(F.col("text"), 1500)).alias("head"))


# ------------------------------------------------------------------ lines

_LINES = """l as (select doc_id as doc, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as ln, len(string_split(text, chr(10))) as n
      from documents where text <> ''), lines as (select doc, ln, line from l where not (ln = n and line = ''))"""


@query("line_model", "Q16 S35", "with " + _LINES + """
select doc, count(*) as lines, sum((trim(line, ' ') = '')::int)::bigint as blank, max(length(line))::bigint as longest from lines group by doc""")
def line_model(spark, sf_dir):
    rows = lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.groupBy("doc").agg(F.count("*").alias("lines"), F.count_if(F.trim("line") == "").alias("blank"), F.max(F.length("line")).cast("bigint").alias("longest"))


@query("audit_counts", "A01 A44", "with " + _LINES + """
, t as (select doc, count(*) as total_lines, sum(regexp_matches(line, '^\\s*\\|')::int)::bigint as table_rows, sum(regexp_matches(line, '^\\s*\\d{1,3}\\s*$')::int)::bigint as bare_pages, sum(regexp_matches(line, '^# [^#]')::int)::bigint as h1s from lines group by doc)
select d.doc_id as doc, coalesce(total_lines, 0) as total_lines, length(text)::bigint as total_chars, coalesce(table_rows, 0) as table_rows, coalesce(bare_pages, 0) as bare_pages, coalesce(h1s, 0) as h1s,
  case when regexp_matches(text, 'Medical Higher Study|apps?\\.apple\\.com|play\\.google\\.com|t\\.me/|bit\\.ly/') or regexp_matches(text, '[\\x{0980}-\\x{09ff}]{5,}') then 'unsafe' when coalesce(h1s, 0) > 1 then 'safe_with_conditions' else 'production_safe' end as verdict
from documents d left join t on t.doc = d.doc_id""")
def audit_counts(spark, sf_dir):
    got = audit.document_audit(table(spark, sf_dir, "documents"), "doc_id", "text")
    big = [F.col(c).cast("bigint").alias(c) for c in ("total_lines", "total_chars", "table_rows", "bare_pages", "h1s")]
    return got.select("doc", *big, "verdict")


@query("near_line_pairs", "W12", "with " + _LINES + """
, k as (select doc, line, row_number() over (partition by doc order by ln) as i, list_distinct(list_filter(regexp_split_to_array(lower(line), '[^a-z0-9]+'), lambda x: x <> '')) as w from lines where length(line) > 80)
select a.doc, a.i::bigint as i, b.i::bigint as j, round(len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 6) as jaccard
from k a join k b on b.doc = a.doc and b.i > a.i and b.i - a.i <= 9
where abs(length(a.line) - length(b.line)) / greatest(length(a.line), length(b.line)) <= 0.25 and len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= 0.65""")
def near_line_pairs(spark, sf_dir):
    rows = lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    got = lines.near_pairs(rows, word_break="[^a-z0-9]+")
    return got.select("doc", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), F.round("jaccard", 6).alias("jaccard"))


@query("near_line_ratios", "W12 F17 Q18")
def near_line_ratios(spark, sf_dir):
    return lines.near_duplicates(lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text"))


@query("event_islands", "W06 W08", """
with p as (select distinct user_id, (epoch_us(ts) // 3600000000) as hour from events),
o as (select *, coalesce((hour - lag(hour) over (partition by user_id order by hour) > 25)::int, 1) as opens from p),
g as (select *, sum(opens) over (partition by user_id order by hour) as island from o)
select user_id, min(hour) as lo, max(hour) as hi, count(*) as n from g group by user_id, island""")
def event_islands(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("bigint").alias("hour"))
    return lines.islands(rows, "user_id", "hour", 24)


@query("carry_marks", "J03 J04 W05", """
select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as asked,
  first_value(case when role = 'assistant' then turn end ignore nulls) over (partition by conv_id order by turn rows between 1 following and 3 following) as answer from conversations""")
def carry_marks(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("ln"), "role")
    rows = lines.carry_forward(rows, F.when(F.col("role") == "user", F.col("ln")), "asked")
    rows = lines.carry_back(rows, F.when(F.col("role") == "assistant", F.col("ln")), "answer", 3)
    return rows.select(F.col("doc").alias("conv_id"), F.col("ln").alias("turn"), "asked", "answer")


@query("resolved_spans", "J06 U01 F38", "with " + _LINES + """
, s as (select doc, line, case when ln <= 2 then 0 else 1 end as k, ln from lines where ln <= 2 or ln between 2 and 4),
u as (select doc, 0 as k, ln, line from lines where ln <= 2 union all select doc, 1, ln, line from lines where ln between 2 and 4)
select doc, md5(string_agg(line, chr(10) order by k, ln)) as text from u group by doc""")
def resolved_spans(spark, sf_dir):
    rows = lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    two = F.array(F.struct(F.lit(1).alias("lo"), F.lit(2).alias("hi")), F.struct(F.lit(2).alias("lo"), F.lit(4).alias("hi")))
    wanted = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.lit("all").alias("chunk"), two.alias("segments"))
    return spans.resolve(wanted, rows).select("doc", F.md5("text").alias("text"))


@query("contained_spans", "J05", """
with o as (select conv_id, role, min(turn) as lo, max(turn) as hi from conversations group by all)
select c.conv_id as doc, o.role as "outer", c.turn as "inner" from conversations c join o on o.conv_id = c.conv_id and o.lo <= c.turn and c.turn <= o.hi""")
def contained_spans(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "doc")
    whole = turns.groupBy("doc", F.col("role").alias("chunk")).agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    return spans.contained(whole, turns.select("doc", F.col("turn").alias("chunk"), F.col("turn").alias("lo"), F.col("turn").alias("hi")), width=4)


_NORM = "trim(translate(regexp_replace({0}, '\\*+|_+|`+', '', 'g'), '–—', '--'), ' ')"


@query("located_anchors", "J07 J08 F11 F12", "with " + _LINES + """
, x as materialized (select distinct """ + _NORM.format("line") + """ as line from lines),
u as (select item_id, trim(unnest(string_split(text, chr(10))), ' ') as s from benchmark),
v as (select item_id, s, starts_with(s, '|') as cells, regexp_replace(s, '^[-*]\\s+', '') as t, trim(regexp_replace(s, '^\\|+|\\|+$', '', 'g'), ' ') as c from u
      where s <> '' and not regexp_matches(s, '^#{1,6}\\s') and not regexp_matches(s, '^\\|?\\s*-+\\s*\\|')),
p as (select item_id, cells, c, t, list_filter(list_transform(string_split(regexp_replace(t, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda y: trim(y, ' ')), lambda y: length(y) >= 8) as parts from v),
a as (select item_id, unnest(case when cells then case when length(c) >= 8 then [c[1:100]] else [] end when len(parts) > 0 then parts when length(t) >= 8 then [t] else [] end) as raw from p),
n as (select item_id, """ + _NORM.format("raw") + """[1:70] as anchor from a)
select item_id as chunk, count(*) as units, count(*) filter (length(anchor) >= 8 and exists (select 1 from x where contains(x.line, anchor))) as found from n group by item_id""")
def located_anchors(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select(F.lit("all").alias("doc"), F.col("item_id").alias("chunk"), F.col("text").alias("body"), F.lit(1).alias("hint"))
    rows = lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text").select(F.lit("all").alias("doc"), (F.col("doc") * 100000 + F.col("ln")).alias("ln"), "line")
    return spans.locate(items, rows).groupBy("chunk").agg(F.count("*").alias("units"), F.count("ln").alias("found"))


@query("numbered_batches", "W01 W04 O20 O21", """
select source, doc_id, format('D-{:04d}', row_number() over w) as label, ((row_number() over w) - 1) // 35 as batch from documents window w as (partition by source order by doc_id)""")
def numbered_batches(spark, sf_dir):
    rows = lines.number_rows(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], ["doc_id"], "label", "D-%04d")
    return lines.pages(rows, ["doc_id"], 35, ["source"]).withColumn("batch", F.col("batch").cast("bigint"))


# ------------------------------------------------------------------ fidelity and audits

_CHECKS = {k: P.DETECTORS[k] for k in ("numeric", "range", "duration", "inequality")}


def _tokens_sql(name: str, text: str) -> str:
    parts = [f"select page_id as chunk_id, '{c}' as \"check\", unnest(regexp_extract_all({text}, '(?i){p}')) as token from pages" for c, pats in _CHECKS.items() for p in pats]
    return f"{name} as (select chunk_id, \"check\", token, count(*) as n from ({' union all '.join(parts)}) group by all)"


@query("fidelity_diff", "A03 U02 U04 U05 U07 U11 Q01 Q03", "with " + _tokens_sql("a", "html") + ", " + _tokens_sql("b", "replace(html, '1', '7')") + """
, j as (select coalesce(a.chunk_id, b.chunk_id) as chunk_id, coalesce(a."check", b."check") as "check", coalesce(a.token, b.token) as token, coalesce(a.n, 0) as src, coalesce(b.n, 0) as got
  from a full join b on a.chunk_id = b.chunk_id and a."check" = b."check" and a.token = b.token)
select chunk_id, "check", case when got < src then 'missing' else 'added' end as kind, case when got < src then token end as source_value, case when got >= src then token end as chunk_value
from j where got < src or src = 0""")
def fidelity_diff(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("chunk_id"), F.col("html").alias("source"), F.replace("html", F.lit("1"), F.lit("7")).alias("body"))
    return fidelity.multiset_diff(rows, _CHECKS)


@query("coverage_gaps", "J09 F13 A48", "with " + _LINES + """
, x as (select distinct line from lines),
u as (select item_id, unnest(string_split(text, chr(10))) as line from benchmark),
v as (select item_id, trim(line, ' ') as line from u where trim(line, ' ') <> '' and not starts_with(trim(line, ' '), '|') and not regexp_matches(line, '^#{1,6}\\s')),
p as (select item_id, line, list_filter(list_transform(string_split(regexp_replace(line, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda y: trim(y, ' ')), lambda y: length(y) >= 20) as parts from v),
s as (select item_id, unnest(case when len(parts) > 0 then parts when length(line) >= 20 then [line] else [] end) as sentence from p),
h as (select item_id, sentence, exists (select 1 from x where contains(x.line, s.sentence)) as hit from s)
select cast(item_id as varchar) as chunk_id, sum(hit::int)::bigint as covered, count(*) as total from h group by item_id having sum(hit::int) / count(*) < 0.9""")
def coverage_gaps(spark, sf_dir):
    a = table(spark, sf_dir, "benchmark").select(F.lit("all").alias("chapter"), F.col("item_id").cast("string").alias("chunk_id"), F.lit(1).alias("level"), F.col("text").alias("body"))
    b = table(spark, sf_dir, "documents").select(F.lit("all").alias("chapter"), F.col("doc_id").cast("string").alias("chunk_id"), F.lit(2).alias("level"), F.col("text").alias("body"))
    return audit.coverage(a.unionByName(b)).select("chunk_id", "covered", "total")


@query("claim_lines", "P24", "with " + _LINES + """
, t as (select doc, trim(line, ' ') as s from lines),
c as (select doc, s, list_transform(string_split(regexp_replace(regexp_replace(s, '^\\|+', ''), '\\|+$', ''), '|'), lambda x: trim(x, ' ')) as cells,
  len(list_filter(regexp_split_to_array(trim(regexp_replace(s, '[>*_`]', '', 'g'), ' '), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')) as words from t)
select doc, count(*) as claims from c where s <> '' and not regexp_matches(s, '^(?:<!--|```|\\|---|\\| ---|:--)') and not regexp_matches(s, '^[|\\-:\\s]+$')
 and case when regexp_matches(s, '^(?:[-*+]|\\d+[.)])\\s+\\S') then true
          when starts_with(s, '|') then len(list_filter(cells, lambda x: len(list_filter(regexp_split_to_array(x, '[ \\t\\n\\v\\f\\r]+'), lambda y: y <> '')) >= 2)) >= 1
               and not len(list_filter(list_filter(cells, lambda x: x <> ''), lambda x: not (upper(x) = x and regexp_matches(x, '[A-Za-z]')))) = 0
          else words >= 6 end group by doc""")
def claim_lines(spark, sf_dir):
    rows = lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.where(guard.is_claim_line(F.col("line"))).groupBy("doc").agg(F.count("*").alias("claims"))


@query("corruption_audit", "A37 F08", """
with h as (select page_id, """ + " + ".join(f"len(regexp_extract_all(html, '{p}'))" for p in P.CORRUPTION) + """ as hits,
  len(regexp_extract_all(html, '\\b(?:Q\\.D\\.|QD|Q\\.O\\.D\\.|QOD)\\b')) + len(regexp_extract_all(html, '\\b\\d+\\s*(?:IU|I\\.U\\.)')) as doses from pages)
select page_id as file, hits::bigint as hits, doses::bigint as doses, case when hits > 0 then 'FAIL' when doses > 0 then 'ADVISORY' else 'PASS' end as status from h""")
def corruption_audit(spark, sf_dir):
    got = guard.corruption_audit(table(spark, sf_dir, "pages"), "page_id", "html")
    return got.select("file", F.col("hits").cast("bigint").alias("hits"), F.col("doses").cast("bigint").alias("doses"), "status")


def _re2(pattern: str) -> str:
    """A pattern whose matches are only asked for, without the look-around that DuckDB lacks."""
    for a, b in (("(?<![A-Za-z])", "(?:^|[^A-Za-z])"), (r"(?<![\d.])", r"(?:^|[^\d.])"), ("(?![A-Za-z])", "(?:$|[^A-Za-z])"), ("(?![A-Za-z0-9])", "(?:$|[^A-Za-z0-9])"), ("(?=(", "(?:(")):
        pattern = pattern.replace(a, b)
    return pattern


_UNLESS = {"EV-RECNOSRC": P.CITATION_MARKER, "EV-SIGNIF": P.PRECISION_MARKER}


@query("slide_rules", "A31 A32 A33 A34 P31", "with f as (" + " union all ".join(
    f"select doc_id, '{target}' as target, '{n}' as rule, '{s}' as severity from documents where regexp_matches(text, '{_re2(p)}')" + (f" and not regexp_matches(text, '{_UNLESS[n]}')" if n in _UNLESS else "")
    for target in ("us", "eu", "none") for n, s, p, j in P.SLIDE_RULES_JAVA if lint.rule_applies(j, target)) + """)
select target, rule, severity, count(*) as slides from f group by all""")
def slide_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.lit("all").alias("deck"), F.col("doc_id").alias("slide"), "text")
    return lint.findings_by_target(rows).groupBy("target", "rule", "severity").agg(F.count("*").alias("slides"))


@query("text_density", "P17 A10 A43", """
with w as (select doc_id, len(list_filter(regexp_split_to_array(trim(text, ' '), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')) as n from documents)
select case when n < 25 then 'low' when n < 75 then 'medium' else 'high' end as density, count(*) as n from w group by 1""")
def text_density(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(lint.density(F.size(C.words_of(F.col("text")))).alias("density"))
    return audit.distribution(rows, "density")


# ------------------------------------------------------------------ index


@query("token_postings", "A19 F22 Q22", """
with t as (select doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9\\-]{1,24}'), lambda x: lower(x)))) as token from documents)
select token, count(*) as df, min(doc_id) as first, max(doc_id) as last from t group by token""")
def token_postings(spark, sf_dir):
    return index.posting_counts(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("inverted_index", "A19", """
with t as (select item_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9\\-]{1,24}'), lambda x: lower(x)))) as token from benchmark)
select token, count(*) as df, string_agg(item_id::varchar, ',' order by item_id) as postings from t group by token""")
def inverted_index(spark, sf_dir):
    return index.postings(table(spark, sf_dir, "benchmark"), "item_id", "text").withColumn("postings", F.array_join("postings", ","))


@query("early_exit_words", "A21", """
with w as (select p_partkey, p_brand, unnest(regexp_extract_all(lower(p_name), '\\b[a-z]{4,15}\\b')[1:3]) as word from part)
select word, arg_min(p_brand, p_partkey) as section, 0.85::double as confidence from w group by word""")
def early_exit_words(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("section"), F.col("p_name").alias("topic"))
    return index.early_exit(rows)


@query("term_chunk_map", "J12 J14", """
with n as (select distinct regexp_extract(text, '[A-Za-z]+', 0) as acronym from benchmark),
m as (select acronym, doc_id from n, documents where regexp_matches(lower(concat_ws(chr(10), lang, text)), '(?:^|\\W)' || lower(acronym) || '(?:$|\\W)'))
select acronym, count(*) as matches, array_to_string(list(doc_id order by doc_id)[1:15], ',') as chunks from m group by acronym""")
def term_chunk_map(spark, sf_dir):
    names = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", "[A-Za-z]+", 0).alias("acronym"))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("chunk_id"), F.col("lang").alias("topic"), F.col("text").alias("body"))
    return index.term_to_chunks(names, rows, None, True, 15)


@query("eval_triplets", "W17", """
with r as (select item_id, text, row_number() over (order by item_id) - 1 as i, count(*) over () as n from benchmark)
select a.text as query, a.item_id as positive, b.item_id as negative from r a join r b on b.i = (a.i + 50) % a.n""")
def eval_triplets(spark, sf_dir):
    return index.eval_triplets(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ord"), F.col("item_id").alias("chunk_id"), F.col("text").alias("topic")))


# ------------------------------------------------------------------ hashes, copies, numbers


@query("row_hashes", "F25 F28 F29 F62 Q12", """
select doc_id, substr(sha256(concat_ws('|', doc_id::varchar, coalesce(lang, 'None'), coalesce(source, 'None'))), 1, 8) as id, 'CHANGE-' || upper(substr(sha256(text), 1, 32)) as change from documents""")
def row_hashes(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", C.short_hash(F.col("doc_id"), F.col("lang"), F.col("source")).alias("id"), C.prefixed_hash("CHANGE", 32, F.col("text")).alias("change"))


@query("set_hash", "F26 F27", """
select sha256(string_agg(h, '' order by h)) as set_hash from (select sha256(concat_ws('|', item_id::varchar, text)) as h from benchmark)""")
def set_hash(spark, sf_dir):
    return fidelity.set_hash(table(spark, sf_dir, "benchmark"), ["item_id", "text"])


_LEAF = "select substr(h, 1, 2) as prefix, sum(n) as n, sha256(string_agg(case when n = 1 then h else h || 'x' || n end, '' order by h)) as digest from (select h, count(*) as n from ({rows}) group by h) group by 1"
_EDITED = "case when o_orderkey % 997 = 0 then o_orderpriority || '!' else o_orderpriority end"
_ORDER_HASH = "select sha256(concat_ws('|', o_orderkey::varchar, o_custkey::varchar, {p})) as h from orders"


@query("tree_hash", "F26 F27", "with l as (" + _LEAF.format(rows=_ORDER_HASH.format(p="o_orderpriority")) + """),
m as (select substr(prefix, 1, 1) as prefix, sha256(string_agg(prefix || digest, '' order by prefix)) as digest from l group by 1)
select sha256(string_agg(prefix || digest, '' order by prefix)) as set_hash from m""")
def tree_hash(spark, sf_dir):
    """The root over 256 leaves of all orders."""
    return merkle.set_hash(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"], 2)


@query("tree_differences", "F26 F27", "with a as (" + _LEAF.format(rows=_ORDER_HASH.format(p="o_orderpriority")) + "), b as (" + _LEAF.format(rows=_ORDER_HASH.format(p=_EDITED)) + """)
select coalesce(a.prefix, b.prefix) as prefix, coalesce(a.n, 0)::bigint as before, coalesce(b.n, 0)::bigint as after from a full join b on a.prefix = b.prefix where a.digest is distinct from b.digest""")
def tree_differences(spark, sf_dir):
    """The ranges of row hashes in which orders and an edited copy differ, found from the root down."""
    orders = table(spark, sf_dir, "orders")
    edited = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 997 == 0, F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")))
    return merkle.differing(orders, edited, ["o_orderkey", "o_custkey", "o_orderpriority"], 2)


@query("carried_values", "W15 W17 W18", """
select doc_id, row_number() over (order by source, doc_id) - 1 as place, lead(doc_id) over (order by source, doc_id) as next,
  last_value(case when n_chars > 3000 then doc_id end ignore nulls) over (order by source, doc_id rows between unbounded preceding and current row) as long_one from documents""")
def carried_values(spark, sf_dir):
    """Place, next row and last long document in one order over the whole table."""
    rows = ordered.positions(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source", "doc_id"], "place")
    rows = ordered.carried(rows, ["source", "doc_id"], F.when(F.col("n_chars") > 3000, F.col("doc_id")), "long_one")
    return ordered.following(rows, ["source", "doc_id"], "doc_id", "next").select("doc_id", "place", "next", "long_one")


@query("first_copies", "J33 Q20", """
select doc_id, first from (select doc_id, min(doc_id) over (partition by sha256(text)) as first from documents) where first < doc_id""")
def first_copies(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return rows.join(first, "h").where("first < doc_id").select("doc_id", "first")


@query("slugs", "P02 F46", """
select p_partkey, trim(substr(regexp_replace(regexp_replace(regexp_replace(lower(p_name), '^\\d+\\.\\d+\\s*', ''), '[^\\w\\s]', ' ', 'g'), '\\s+', '_', 'g'), 1, 40), '') as slug from part""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.slugify(F.col("p_name")).alias("slug"))


@query("fluid_plans", "F36 Q21", """
with w as (select distinct p_size::double as weight from part), d as (select weight, case when weight > 20 then 1500 + (weight - 20) * 20 else weight * 100 end as daily from w)
select weight, daily, weight * 50 as deficit, daily * 2 + weight * 50 as total, round((daily * 2 + weight * 50) / 48, 4) as hourly, round((daily * 2 + weight * 50) / 144, 4) as drops from d""")
def fluid_plans(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("weight")).distinct()
    return rows.withColumn("f", modalities.fluids(F.col("weight"))).select("weight", "f.*")


@query("colour_contrast", "F33 F34", """
with c as (select distinct p_size as r, (p_size * 3) % 256 as g, (p_size * 5) % 256 as b from part),
l as (select r, 0.2126 * (case when r / 255.0 <= 0.03928 then r / 255.0 / 12.92 else pow((r / 255.0 + 0.055) / 1.055, 2.4) end) + 0.7152 * (case when g / 255.0 <= 0.03928 then g / 255.0 / 12.92 else pow((g / 255.0 + 0.055) / 1.055, 2.4) end)
  + 0.0722 * (case when b / 255.0 <= 0.03928 then b / 255.0 / 12.92 else pow((b / 255.0 + 0.055) / 1.055, 2.4) end) as l from c)
select r::bigint as r, round(1.05 / (l + 0.05), 6) as contrast from l""")
def colour_contrast(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_size").alias("r"), ((F.col("p_size") * 3) % 256).alias("g"), ((F.col("p_size") * 5) % 256).alias("b")).distinct()
    own = C.luminance(F.col("r"), F.col("g"), F.col("b"))
    return rows.select(F.col("r").cast("bigint").alias("r"), F.round(C.contrast(F.lit(1.0), own), 6).alias("contrast"))


@query("anion_gaps", "F36", """
select c_custkey, round(140.0 - (c_acctbal / 100 + 20.0), 4) as gap, case when 140.0 - (c_acctbal / 100 + 20.0) > 12 then 'HAGMA' else 'NAGMA' end as result from customer""")
def anion_gaps(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("g", modalities.anion_gap(F.lit(140.0), F.col("c_acctbal") / 100, F.lit(20.0)))
    return rows.select("c_custkey", F.round("g.gap", 4).alias("gap"), "g.result")


# ------------------------------------------------------------------ extensions without a counterpart in the reference


@query("ext_pricing_summary", "M9", """
select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem
where l_shipdate < timestamp '1998-09-02' group by all""")
def ext_pricing_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_shipdate < timestamp '1998-09-02'").groupBy("l_returnflag", "l_linestatus")
    return rows.agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"), F.count("*").alias("n"))


@query("ext_nation_revenue", "M9", """
select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey join supplier on s_suppkey = l_suppkey and s_nationkey = c_nationkey
join nation on n_nationkey = s_nationkey group by n_name""")
def ext_nation_revenue(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    rows = t("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t("supplier").select("s_suppkey", "s_nationkey"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey")))
    rows = rows.join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


@query("ext_top_orders", "M9", """
select c_custkey, o_orderkey, rank from (select o_custkey as c_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders) where rank <= 2""")
def ext_top_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    got = rows.withColumn("rank", F.row_number().over(W.partitionBy("c_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("rank <= 2")
    return got.select("c_custkey", "o_orderkey", F.col("rank").cast("bigint").alias("rank"))
