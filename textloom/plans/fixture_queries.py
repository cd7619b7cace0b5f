"""Queries over tables derived from the given ones: chunks, ladders, gates, trust, index lines, files, state."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import patterns as P
from ..derived import derive, derived_sql
from ..functions import columns as C
from ..functions import unicode as U
from ..operators import audit, chunks, fidelity, guard, index, ledger, lines, lint, modalities, packaging, retrieval, spans
from ..operators.ordered import positions
from ..registry import query, table
from ..streaming import state
from . import jobs

_CASE = lambda rows, default: "case " + " ".join(f"when {t} then '{n}'" for n, t in rows) + f" else {default} end"
_ANY = lambda c, words: "(" + " or ".join(f"contains({c}, '{w}')" for w in words) + ")"
_RX = lambda c, pats, flag="(?i)": "(" + " or ".join(f"regexp_matches({c}, '{flag}{p}')" for p in pats) + ")"

_DOC_LINES = """, l as (select chapter as doc, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as ln, len(string_split(text, chr(10))) as n from chapters where text <> ''),
lines as (select doc, ln, line from l where not (ln = n and line = ''))"""


# ------------------------------------------------------------------ chunk metadata


@query("title_types", "P03 P12 P40", derived_sql("titles") + f"""
select id, {_CASE([(n, _ANY('lower(title)', w)) for n, w in P.TITLE_TYPES], "'clinical_feature'")} as initial, {_CASE([(n, _RX('title', p)) for n, p in P.TITLE_RULES], 'null')} as ruled from titles""")
def title_types(spark, sf_dir):
    return derive(spark, sf_dir, "titles").select("id", chunks.initial_type(F.col("title")).alias("initial"), chunks.title_type(F.col("title")).alias("ruled"))


@query("rule_types", "P09 P10 P13 P15", derived_sql("titles") + f"""
, e as (select *, len(regexp_extract_all(body, '{P.EPI_STATISTIC}')) >= 2 and not regexp_matches(body, '{P.CLINICAL_CUE}') as epi, regexp_matches(title, '{P.BACKMATTER_TOPIC}') as back from titles)
select id, coalesce({_CASE([(n, _RX('title', p)) for n, p in P.TITLE_RULES], 'null')}, case when epi then 'epidemiology_concept' end, {_CASE([(n, _RX('body', p)) for n, p in P.BODY_RULES], 'null')}) as type, epi, back from e""")
def rule_types(spark, sf_dir):
    return derive(spark, sf_dir, "titles").select("id", chunks.rule_type(F.col("title"), F.col("body")).alias("type"), chunks.pure_epidemiology(F.col("body")).alias("epi"), F.col("title").rlike(P.BACKMATTER_TOPIC).alias("back"))


@query("review_types", "P11", derived_sql("titles") + f"""
select id, coalesce(case when len(regexp_extract_all(body, '{P.EPI_STATISTIC}')) >= 2 and not regexp_matches(body, '{P.CLINICAL_CUE}') then 'epidemiology_concept' end,
 {_CASE([(n, "'" + n + "' <> 'drug_info' and " + _RX('body', p)) for n, p in P.BODY_RULES], 'null')}) as review from titles""")
def review_types(spark, sf_dir):
    return derive(spark, sf_dir, "titles").select("id", chunks.review_type(F.col("body"), F.lit("drug_info")).alias("review"))


@query("urgency_boxes", "P04 P05", derived_sql("titles") + f"""
, t as (select id, lower(title) as t, lower(body) as b, lower(substr(body, 1, 300)) as b3, lower(substr(body, 1, 150)) as b1, body from titles),
a as (select *, case when ({_ANY('t', P.SCORING_WORDS)} or {_ANY('b', P.SCORING_WORDS)}) and regexp_matches(b, '{P.SCORING_SHAPE}') then 'scoring_system'
  when {_ANY('t', P.ESCALATION_WORDS)} or {_RX('b', P.ESCALATION_SHAPES, '')} then 'stepwise_escalation'
  when {_ANY('t', P.TREE_WORDS)} or (regexp_matches(b, '{P.TREE_SHAPE}') and {_ANY('b', P.TREE_CUES)}) then 'decision_tree' end as algorithm from t)
select id, algorithm, case when {_ANY('t', P.EMERGENCY_WORDS)} or {_ANY('b3', [*P.EMERGENCY_WORDS, '▲ emergency', 'emergency:'])} then 'emergency' when {_ANY('t', P.URGENT_WORDS)} or {_ANY('b3', P.URGENT_WORDS)} then 'urgent' else 'routine' end as urgency,
 case when {_ANY('t', ['emergency', 'resuscitation', 'cardiac arrest'])} or {_ANY('b1', ['emergency', 'resuscitation'])} or contains(b3, '▲ emergency') then 'emergency_management'
  when {_ANY('t', ['prescribing point', 'drug safety'])} or contains(b1, 'prescribing point') then 'prescribing_point' when contains(t, 'practice point') or contains(b1, 'good practice point') then 'practice_point'
  when regexp_matches(body, '(?m)^\\s*\\|') and {_ANY('t', ['summary', 'investigation', 'overview'])} then 'summary_table' when algorithm is not null then 'clinical_algorithm' else 'none' end as box from a""")
def urgency_boxes(spark, sf_dir):
    rows = derive(spark, sf_dir, "titles").withColumn("algorithm", chunks.algorithm_type(F.col("body"), F.col("title")))
    return rows.select("id", "algorithm", chunks.urgency(F.col("body"), F.col("title")).alias("urgency"), chunks.box_type(F.col("body"), F.col("title"), F.col("algorithm")).alias("box"))


@query("drug_synonyms", "P06", derived_sql("titles") + """
, s(drug, name) as (values """ + ", ".join(f"('{d}', '{n}')" for d, ns in P.DRUG_SYNONYMS.items() for n in ns) + """)
select id, coalesce((select string_agg(distinct name, ',' order by name) from s where regexp_matches(lower(body), '\\b' || drug || '\\b')), '') as synonyms from titles""")
def drug_synonyms(spark, sf_dir):
    return derive(spark, sf_dir, "titles").select("id", F.array_join(chunks.drug_synonyms(F.col("body")), ",").alias("synonyms"))


@query("chunk_catalogue", "X01 X06 X07 X08 X09 F16 S13", derived_sql("chunk_files") + """
, p as (select chapter, string_split(text, '---' || chr(10) || 'chunk_id:') as parts from chunk_files),
r as (select chapter, unnest(parts[2:]) as raw, generate_subscripts(parts[2:], 1) as ord from p),
c as (select * from r where contains(raw, chr(10) || '---' || chr(10)))
select chapter as section, trim(split_part(raw, chr(10), 1), ' ') as chunk_id, format('L2-{:03d}', ord) as local_id, trim(regexp_extract(raw, '(?m)^topic:[ \\t]*(.*?)[ \\t]*$', 1)) as topic,
 case when contains(raw, 'semantic_type:') then regexp_extract(raw, 'semantic_type: (\\S+)', 1) else 'concept_overview' end as type,
 len(list_filter(regexp_split_to_array(trim(split_part(raw, chr(10) || '---' || chr(10), 2), ' ' || chr(10)), '\\s+'), lambda x: x <> ''))::bigint as word_count from c""")
def chunk_catalogue(spark, sf_dir):
    return chunks.catalogue(derive(spark, sf_dir, "chunk_files")).select("section", "chunk_id", "local_id", "topic", "type", F.col("word_count").cast("bigint").alias("word_count"))


_CHUNKS = """, p as (select chapter, string_split(text, '---' || chr(10) || 'chunk_id:') as parts from chunk_files),
r as (select chapter, unnest(parts[2:]) as raw, generate_subscripts(parts[2:], 1) as ord from p),
c as (select chapter, ord, trim(split_part(raw, chr(10), 1), ' ') as chunk_id, regexp_extract(raw, '(?m)^chunk_level:[ \\t]*(\\d+)', 1) as level, regexp_extract(raw, '(?m)^disease_focus:[ \\t]*(.*?)[ \\t]*$', 1) as disease from r where contains(raw, chr(10) || '---' || chr(10)))"""
_FIELD = lambda n: f"""trim(regexp_replace(regexp_extract(raw, '(?m)^{n}:[ \\t]*(.*?)[ \\t]*$', 1), '^"(.*)"$', '\\1'), ' ')"""
_FAULTS = derived_sql("chunk_files") + _CHUNKS + f""", b as (select chapter, ord, trim(split_part(raw, chr(10), 1), ' ') as chunk_id, contains(raw || chr(10), chr(10) || '---' || chr(10)) as closed,
 {_FIELD('disease_focus')} as disease, {_FIELD('coverage_status')} as status, {_FIELD('gap_note')} as note, lower({_FIELD('is_clinical_algorithm')}) = 'true' as algorithm, lower({_FIELD('algorithm_type')}) as kind,
 lower({_FIELD('contains_figures')}) = 'true' as figures, {_FIELD('figure_assets')} as assets, {_FIELD('figure_captions')} as captions, {_FIELD('page_numbers')} as pages from r),
v as (select chapter, chunk_id, unnest(list_filter([case when not closed then 'malformed' end, case when closed and disease = '' then 'missing disease_focus' end,
 case when closed and status not in ('complete', 'partial', 'gap') then 'invalid coverage_status' end, case when closed and status in ('partial', 'gap') and note = '' then 'empty gap_note' end,
 case when closed and algorithm and kind not in ('decision_tree', 'scoring_system', 'stepwise_escalation') then 'invalid algorithm_type' end,
 case when closed and figures and not regexp_matches(assets, '^\\[.+\\]$') and not regexp_matches(captions, '^\\[.+\\]$') then 'no figures listed' end,
 case when closed and pages = '[]' then 'page_numbers empty' end], lambda x: x is not null)) as failure from b)"""


@query("chunk_validation", "A13 A14 A16 A17 A18 F54 Q28", _FAULTS + " select chapter, chunk_id, failure from v")
def chunk_validation(spark, sf_dir):
    return audit.validate(derive(spark, sf_dir, "chunk_files"))


@query("validation_verdicts", "A15 A18 A47", _FAULTS + """ select chapter, coalesce(chunks, 0) as chunks, coalesce(failures, 0) as failures, case when failures > 0 then 'HARD-FAIL' else 'PASS' end as verdict
from (select distinct chapter from chunk_files) left join (select chapter, count(*) filter (where closed) as chunks from b group by chapter) using (chapter)
left join (select chapter, count(*) as failures from v group by chapter) using (chapter)""")
def validation_verdicts(spark, sf_dir):
    files = derive(spark, sf_dir, "chunk_files")
    return audit.validation_verdict(files, audit.validate(files))


@query("chunk_links", "J11 J37 Q09", derived_sql("chunk_files") + _CHUNKS + """,
d as (select * from c where level = '2' and disease not in ('', 'general', 'self_assessment', 'overview'))
select a.chapter, a.chunk_id, string_agg(b.chunk_id, ',' order by a.disease <> b.disease, b.ord) as related from d a join d b on a.chapter = b.chapter and a.chunk_id <> b.chunk_id
  and (a.disease = b.disease or (length(a.disease) >= 4 and contains(b.disease, a.disease)) or (length(b.disease) >= 4 and contains(a.disease, b.disease))) group by all""")
def chunk_links(spark, sf_dir):
    return audit.autolink(chunks.parse_chunks(derive(spark, sf_dir, "chunk_files")))


_NUMBER = "cast(substr(chapter, 2) as bigint)"
_DISEASES = f"""replace(replace(text, 'disease_focus: asthma', 'disease_focus: asthma_' || cast({_NUMBER} % 97 as string)), case when {_NUMBER} % 97 < 30 then 'management_step' else '(none)' end, 'prognosis')"""


@query("chunk_completeness", "A08 Q05", derived_sql("chunk_files") + f", files as (select chapter, {_DISEASES} as text from chunk_files)" + _CHUNKS.replace("from chunk_files", "from files") + f""",
k as (select coalesce(nullif({_FIELD('disease_focus')}, ''), 'general') as disease, lower(concat_ws(' ', {_FIELD('semantic_type')}, {_FIELD('topic')}, substring(trim('chunk_id:' || raw, ' '), 1, 200))) as t
 from r where contains(raw || chr(10), chr(10) || '---' || chr(10)) and {_FIELD('chunk_level')} = '2'),
f as (select disease, regexp_matches(t, 'clinical_feature|symptom|sign|presentation|examination|history') as c, regexp_matches(t, 'laboratory_investigation|diagnostic_criteria|investigation|biomarker|ecg|imaging') as i,
 regexp_matches(t, 'management_step|drug_info|treatment|therapy|surgery|dosing') as m, regexp_matches(t, 'pathophysiology|aetiology|cause|mechanism|pathogenesis|genetics') as p,
 regexp_matches(t, 'complication|prognosis|safety|monitoring|adverse|risk') as s from k where disease not in ('general', 'self_assessment', 'overview') and length(disease) >= 3),
g as (select disease, count(*) as chunks, bool_or(m) as m, bool_or(i) as i, concat_ws(',', case when bool_or(c) then 'clinical_features' end, case when bool_or(i) then 'investigations' end, case when bool_or(m) then 'management' end,
 case when bool_or(p) then 'pathophysiology' end, case when bool_or(s) then 'safety_prognosis' end) as categories, bool_or(c)::int + bool_or(i)::int + bool_or(m)::int + bool_or(p)::int + bool_or(s)::int as n from f group by disease)
select disease, chunks, categories, case when chunks < 3 then 'complete' when not m and not i then 'suspected_gap' when n >= 3 then 'complete' else 'scattered' end as verdict from g""")
def chunk_completeness(spark, sf_dir):
    files = derive(spark, sf_dir, "chunk_files").select("chapter", F.expr(_DISEASES).alias("text"))
    return audit.completeness(chunks.parse_chunks(files))


@query("chunk_coverage", "J09 A07 J10")
def chunk_coverage(spark, sf_dir):
    rows = chunks.parse_chunks(derive(spark, sf_dir, "chunk_files"))
    gaps = audit.coverage(rows).select("chapter", "chunk_id", F.lit("gap").alias("result"))
    return gaps.unionByName(audit.spot_check(rows, derive(spark, sf_dir, "chapters")))


@query("flag_coverage", "A07 Q02 Q17", derived_sql("pairs") + """
, h as (select chunk_id as chapter, """ + " + ".join(f"len(regexp_extract_all(source, '(?i){p}'))" for p in P.DOSING) + " as ds, " + " + ".join(f"len(regexp_extract_all(body, '(?i){p}'))" for p in P.DOSING) + " as dc, "
 + " + ".join(f"len(regexp_extract_all(source, '(?i){p}'))" for p in P.THRESHOLDS) + " as ts, " + " + ".join(f"len(regexp_extract_all(body, '(?i){p}'))" for p in P.THRESHOLDS) + """ as tc from pairs)
select chapter, ds, dc, ts, tc, case when ds > 0 and dc < ds * 0.9 then 'WARN - dosing dropped' else 'CLEARED' end || case when ts > 0 and tc < ts * 0.9 then case when ds > 0 and dc < ds * 0.9 then ' | ' else '' end || 'WARN - thresholds dropped' else '' end as verdict from h""")
def flag_coverage(spark, sf_dir):
    got = audit.flag_coverage(derive(spark, sf_dir, "pairs").select(F.col("chunk_id").alias("chapter"), "source", F.col("body").alias("chunks")))
    return got.select("chapter", *[F.col(c).cast("bigint").alias(c) for c in ("ds", "dc", "ts", "tc")], "verdict")


@query("quality_scores", "A09 Q13 Q14", derived_sql("score_counts") + """
, d as (select chapter, case when ds > 0 then least(dc / ds, 1.0) end as dosing, case when ts > 0 then least(tc / ts, 1.0) end as threshold, case when passed + failed > 0 then passed / (passed + failed) end as verbatim, case when checked > 0 then 1 - gaps / checked end as coverage from score_counts)
select *, round_even(list_avg(list_filter([dosing, threshold, verbatim, coverage], lambda x: x is not null)), 3) as overall from d""")
def quality_scores(spark, sf_dir):
    return audit.scorecard(derive(spark, sf_dir, "score_counts"))


# ------------------------------------------------------------------ slicing and lines


@query("sliced_chunks", "X02 X03 P01 P07 S23 W02 W03 W04 W05")
def sliced_chunks(spark, sf_dir):
    rows = chunks.slice_markdown(derive(spark, sf_dir, "chapters"), "chapter", "text")
    return rows.select("chapter", "chunk_id", "topic", "disease", "source_lines", F.array_join("pages", ",").alias("pages"), "breadcrumb")


@query("section_ends", "W02 X02", derived_sql("chapters") + _DOC_LINES + """
, h as (select doc, ln, trim(regexp_replace(line, '^#+\\s+', '')) as title, lead(ln) over w as next, row_number() over w as n from lines where regexp_matches(line, '^##\\s') window w as (partition by doc order by ln)),
e as (select doc, max(ln) as eof from lines group by doc)
select h.doc, format('L1-{:03d}', n) as section, title, ln::bigint as lo, (coalesce(next, eof + 1) - 1)::bigint as hi from h join e on e.doc = h.doc""")
def section_ends(spark, sf_dir):
    rows = lines.sections(lines.explode_lines(derive(spark, sf_dir, "chapters"), "chapter", "text"))
    return rows.select("doc", "section", "title", F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi"))


@query("slice_strategies", "X02 X05", derived_sql("chapters") + _DOC_LINES + r""", n as (select *, count(*) filter (where regexp_matches(line, '^##\s')) over (partition by doc order by ln) as sec from lines),
g as (select doc, sec, arg_min(line, ln) as head, count(*) as lines, bool_or(regexp_matches(line, '^###\s')) as h3, bool_or(regexp_matches(line, '^####\s')) as h4, bool_or(regexp_matches(line, '^\d+\.\d+\.\s')) as stems,
 count(*) filter (where regexp_matches(line, '^\*\*[^*]{3,60}\*\*\s*$')) as bold from n where sec > 0 group by doc, sec)
select doc, sec, trim(regexp_replace(head, '^#+\s+', ''), ' ') as title, lines, case when h3 then 'h3' when h4 then 'h4' when stems then 'mcq' when lines > 40 and bold >= 2 then 'bold' else 'flat' end as strategy from g""")
def slice_strategies(spark, sf_dir):
    return chunks.strategies(derive(spark, sf_dir, "chapters"), "chapter", "text")


@query("paired_questions", "X04", derived_sql("chapters") + _DOC_LINES + """
, s as (select doc, regexp_extract(line, '^(\\d+(?:\\.\\d+)+)\\.\\s', 1) as number, trim(regexp_replace(line, '^\\d+(?:\\.\\d+)+\\.\\s*', '')) as stem from lines where regexp_matches(line, '^(\\d+(?:\\.\\d+)+)\\.\\s')),
a as (select doc, ln, regexp_extract(line, '^Answer\\s+(\\d+(?:\\.\\d+)+)\\s*[:.]\\s*([A-E]|True|False)\\b', 1) as number, regexp_extract(line, '^Answer\\s+(\\d+(?:\\.\\d+)+)\\s*[:.]\\s*([A-E]|True|False)\\b', 2) as answer from lines where starts_with(line, 'Answer'))
select s.doc, s.number, s.stem, (select arg_min(answer, ln) from a where a.doc = s.doc and a.number = s.number) as answer from s""")
def paired_questions(spark, sf_dir):
    return chunks.questions(derive(spark, sf_dir, "chapters"), "chapter", "text")


@query("swept_lines", "W10 W11 P08 Q24", derived_sql("chapters") + _DOC_LINES + f"""
, p as (select *, sum((trim(line, ' ') = '')::int) over (partition by doc order by ln) as para, trim(line, ' ') <> '' and (regexp_matches(trim(line, ' '), '{"|".join(f"(?:{p})" for p in P.PROTECTED_SHAPES)}') or length(trim(line, ' ')) > 200 or regexp_matches(line, '{P.CLINICAL_KEYWORDS}')) as keep,
   regexp_matches(line, 'Medical Higher Study|apps?\\.apple\\.com|play\\.google\\.com|Join.*[Tt]elegram|t\\.me/|bit\\.ly/')::int as hit from lines),
q as (select *, max(keep::int) over (partition by doc, para) = 1 and trim(line, ' ') <> '' as protected, max(hit) over (partition by doc order by ln rows between 14 preceding and 10 following) = 1 as near from p)
select doc, ln::bigint as ln, protected, near and not protected as swept from q""")
def swept_lines(spark, sf_dir):
    return lines.sweep(lines.explode_lines(derive(spark, sf_dir, "chapters"), "chapter", "text")).select("doc", F.col("ln").cast("bigint").alias("ln"), "protected", "swept")


@query("repaired_texts", "F18 F19 F20 S38 Q19")
def repaired_texts(spark, sf_dir):
    return audit.repair(derive(spark, sf_dir, "chapters"), "chapter", "text")


_REPEATED = "case cast(substr(chapter, 2) as bigint) % 3 when 0 then '### Early section' || chr(10) || text when 1 then text || chr(10) || text else text end"


@query("repeated_headings", "A02 W13", derived_sql("chapters") + f", again as (select chapter, {_REPEATED} as text from chapters)" + _DOC_LINES.replace("from chapters", "from again") + r"""
select doc, line from lines where regexp_matches(line, '^#+\s') and length(line) > 8 group by doc, line having count(*) > 1
union all select doc, line from lines o where regexp_matches(line, '^###\s')
 and not exists (select 1 from lines e where e.doc = o.doc and e.ln < o.ln and regexp_matches(e.line, '^##\s'))""")
def repeated_headings(spark, sf_dir):
    chapters = derive(spark, sf_dir, "chapters").select("chapter", F.expr(_REPEATED).alias("text"))
    rows = lines.explode_lines(chapters, "chapter", "text")
    return audit.repeated_headers(rows).select("doc", "line").union(lines.orphans(rows).select("doc", "line"))


_RAW_SPANS = """case l_orderkey % 9 when 0 then 'x' || cast(l_linenumber as string) || ',7' when 1 then ' ' || cast(l_partkey % 40 as string) || ' ,' || cast(l_suppkey % 50 as string) || '-' || cast(l_suppkey % 50 + 4 as string)
 when 2 then cast(l_partkey % 40 + 5 as string) || '-' || cast(l_partkey % 40 as string) when 3 then '' when 4 then ',,' || cast(l_partkey % 60 as string) || ' - ' || cast(l_partkey % 60 as string)
 else cast(l_partkey % 40 as string) || '-' || cast(l_partkey % 40 + l_suppkey % 7 as string) || ',' || cast(l_partkey % 40 + l_suppkey % 7 + l_linenumber % 4 as string) || '-' || cast(l_partkey % 40 + l_suppkey % 7 + 9 as string) || ',' || cast(l_partkey % 70 as string) end"""


@query("parsed_spans", "F14 F15 F57 F58 F59 F60 W07", f"with s as (select distinct {_RAW_SPANS} as raw from lineitem)," + """
t as (select raw, trim(unnest(string_split(raw, ',')), ' ') as t from s),
g as (select raw, regexp_extract(t, '^(\\d+)(?:\\s*-\\s*(\\d+))?$', 1) as a, regexp_extract(t, '^(\\d+)(?:\\s*-\\s*(\\d+))?$', 2) as b, regexp_matches(t, '^\\d+(\\s*-\\s*\\d+)?$') as fits from t where t <> ''),
n as (select raw, try_cast(a as int) as lo, try_cast(coalesce(nullif(b, ''), a) as int) as hi, fits from g),
o as (select *, max(hi) over (partition by raw order by lo, hi rows between unbounded preceding and 1 preceding) as before from n where fits and lo <= hi),
i as (select *, sum((before is null or lo > before + 1)::int) over (partition by raw order by lo, hi rows unbounded preceding) as island from o),
m as (select raw, min(lo) as lo, max(hi) as hi from i group by raw, island),
x as (select raw, string_agg(case when lo = hi then lo::varchar else lo || '-' || hi end, ',' order by lo) as text, min(lo) as lo, max(hi) as hi from m group by all),
e as (select raw, count(*) as errors from n where not fits or lo > hi group by all)
select s.raw, coalesce(x.text, '') as text, coalesce(errors, 0)::int as errors, x.lo, x.hi from s left join x using (raw) left join e using (raw)""")
def parsed_spans(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.expr(_RAW_SPANS).alias("raw")).distinct().withColumn("p", spans.parse(F.col("raw")))
    ends = spans.envelope(F.col("p.segments"))
    return rows.select("raw", spans.serialise(F.col("p.segments")).alias("text"), F.size("p.errors").alias("errors"), ends["lo"].alias("lo"), ends["hi"].alias("hi"))


@query("span_precision", "W08 U18 A11 A12 J08")
def span_precision(spark, sf_dir):
    source = lines.explode_lines(derive(spark, sf_dir, "chapters"), "chapter", "text")
    rows = chunks.parse_chunks(derive(spark, sf_dir, "chunk_files")).where("level = 2").withColumn("segments", spans.merge(spans.parse(F.col("source_lines"))["segments"]))
    rows = rows.select(F.col("chapter").alias("doc"), F.col("chunk_id").alias("chunk"), "body", "segments", spans.envelope(F.col("segments"))["lo"].alias("hint"))
    return spans.precision(rows, spans.locate(rows, source))


# ------------------------------------------------------------------ fidelity, gates, decisions


@query("paired_flips", "F42 U09 U10", derived_sql("pairs") + ", f as (" + " union all ".join(
    f"""select chunk_id, '{check}' as "check", regexp_matches(lower(source), '\\b{a}\\b') as sa, regexp_matches(regexp_replace(lower(source), '\\b{a}\\b', ' ', 'g'), '\\b{b}\\b') as sb,
 regexp_matches(lower(body), '\\b{a}\\b') as ca, regexp_matches(regexp_replace(lower(body), '\\b{a}\\b', ' ', 'g'), '\\b{b}\\b') as cb, '{a}' as a, '{b}' as b from pairs"""
    for check, terms in (("negation", P.NEGATION_PAIRS), ("polarity", P.POLARITY_PAIRS)) for a, b in terms) + """),
k as (select *, case when sa and not sb and cb and not ca then 1 when sb and not sa and ca and not cb then 2 when sa and not ca and not cb then 3 when sb and not ca and not cb then 4 end as k from f)
select chunk_id, "check", case when k <= 2 then 'flipped' else 'missing' end as kind, case when k in (1, 3) then a else b end as source_value, case k when 1 then b when 2 then a end as chunk_value from k where k is not null""")
def paired_flips(spark, sf_dir):
    rows = derive(spark, sf_dir, "pairs")
    return fidelity.paired_flips(rows, P.NEGATION_PAIRS, "negation").unionByName(fidelity.paired_flips(rows, P.POLARITY_PAIRS, "polarity"))


@query("all_detectors", "U02 U03 U04 U05 U06 U07 U08 U11 U12 E08 W19 W01 F25 A03")
def all_detectors(spark, sf_dir):
    return fidelity.all_detectors(derive(spark, sf_dir, "pairs")).select("chunk_id", "check", "kind", "source_value", "chunk_value", "candidate_id")


@query("boundary_splits", "J15 J16 F43")
def boundary_splits(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.concat(F.lit("d"), "doc_id").alias("section"), "text")
    sections = docs.select("section", F.concat(F.lit("give Salbutamol at 5 mg now. take Aspirin with 75 mg. later Digoxin dose 2 mg.\n"), "text").alias("body"))
    parts = [("L2-1", 1, "asthma", "Salbutamol and 5 mg", 1, 4), ("L2-2", 2, "acs", "Aspirin helps", 6, 9), ("L2-3", 3, "acs", "give 5 mg", 12, 14)]
    part = F.array(*[F.struct(F.lit(c).alias("chunk_id"), F.lit(o).alias("ord"), F.lit(d).alias("disease"), F.lit(b).alias("body"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for c, o, d, b, lo, hi in parts])
    found = fidelity.boundary_loss(sections, docs.select("section", F.explode(part).alias("p")).select("section", "p.*"))
    heads = docs.select(F.col("section").alias("doc"), F.lit(10).alias("ln"), F.lit("## Head").alias("line"))
    return spans.headings_between(found.select(F.col("section").alias("doc"), "chunk_id", "source_value", "kind", "boundary", F.col("between_lo").alias("end_first"), F.col("between_hi").alias("start_second")), heads)


@query("fidelity_gate", "A04 A05 A06 E12", derived_sql("candidates") + """
, n as (select count(*) filter (where status <> 'VERIFIED') as unresolved_candidates, count(*) filter (where severity = 'CONFIRMED_CORRUPTION' and not coalesce(re_verified, false)) as unresolved_corruptions, count(*) as candidate_count from candidates)
select case when unresolved_candidates > 0 or unresolved_corruptions > 0 then 'BLOCKED' else 'PASS' end as verdict, *, '' as not_tested from n
union all select 'NOT_TESTED', *, 'boundary_loss,dose,duration,frequency,inequality,negation,polarity,range,sequence,unit' from n""")
def fidelity_gate(spark, sf_dir):
    rows = derive(spark, sf_dir, "candidates")
    return fidelity.gate(rows, P.REQUIRED_DETECTORS).union(fidelity.gate(rows, ["numeric"]))


_VERDICT = "case o_orderkey % 4 when 0 then 'PASS' when 1 then 'NOT_TESTED' else 'BLOCKED' end"


@query("gate_actions", "A47 A49 A50 A42", f"with g as (select o_orderkey, {_VERDICT} as verdict, o_custkey % 3 as unresolved from orders)" + """
select o_orderkey, verdict, case verdict when 'PASS' then 'complete' when 'NOT_TESTED' then 'failed' else case when unresolved > 0 then 'pending_manual' else 'blocked' end end as action from g""")
def gate_actions(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_VERDICT).alias("verdict"), (F.col("o_custkey") % 3).alias("unresolved"))
    return rows.select("o_orderkey", "verdict", fidelity.gate_action(F.col("verdict"), F.col("unresolved")).alias("action"))


@query("applied_decisions", "J23 J24", derived_sql("candidates", "decisions") + """
, k as (select * from decisions where decision in ('confirmed_corruption', 'false_positive', 'legitimate_paraphrase'))
select c.candidate_id, case when k.decision is not null then 'VERIFIED' else status end as status, case when k.decision = 'confirmed_corruption' then 'CONFIRMED_CORRUPTION' when k.decision is not null then 'RESOLVED_NOT_A_CORRUPTION' else severity end as severity
from candidates c left join k on k.candidate_id = c.candidate_id""")
def applied_decisions(spark, sf_dir):
    return fidelity.apply_decisions(derive(spark, sf_dir, "candidates"), derive(spark, sf_dir, "decisions"))[0].select("candidate_id", "status", "severity")


@query("unmatched_decisions", "J23 J26", derived_sql("candidates", "decisions") + """
select * from decisions d where decision not in ('confirmed_corruption', 'false_positive', 'legitimate_paraphrase') or not exists (select 1 from candidates c where c.candidate_id = d.candidate_id)""")
def unmatched_decisions(spark, sf_dir):
    return fidelity.apply_decisions(derive(spark, sf_dir, "candidates"), derive(spark, sf_dir, "decisions"))[1]


@query("manifest_problems", "J21 E10 E11 F55", derived_sql("candidates", "manifest") + """
, m as (select candidate_id, count(*) as n from manifest group by 1), j as (select coalesce(m.candidate_id, c.candidate_id) as candidate_id, n, c.candidate_id as known from m full join candidates c on c.candidate_id = m.candidate_id)
select candidate_id, 'unknown' as problem from j where known is null union all select candidate_id, 'missing' from j where n is null union all select candidate_id, 'duplicate' from j where n > 1""")
def manifest_problems(spark, sf_dir):
    return fidelity.reconcile(derive(spark, sf_dir, "manifest"), derive(spark, sf_dir, "candidates"))


@query("whole_updates", "J22 J25 J36", derived_sql("candidates") + """
select 'good' as run, candidate_id, case when candidate_id = 'k1' then 'NEW' else status end as status from candidates union all select 'bad', candidate_id, status from candidates""")
def whole_updates(spark, sf_dir):
    rows = derive(spark, sf_dir, "candidates")
    one = spark.createDataFrame([("k1", "NEW")], "candidate_id string, status string")
    two = one.union(spark.createDataFrame([("zz", "NEW")], one.schema))
    run = lambda name, u: fidelity.apply_whole(rows, u, "candidate_id", "status").select(F.lit(name).alias("run"), "candidate_id", "status")
    return run("good", one).union(run("bad", two))


# ------------------------------------------------------------------ trust and invariants

_TRUST = """, b as (select *, not coalesce(regexp_full_match(reviewed, '\\d+'), false) as b1, not coalesce(regexp_full_match(flagged, '\\d+'), false) as b2, not coalesce(regexp_full_match(clusters, '\\d+'), false) as b3, not coalesce(regexp_full_match(unresolved, '\\d+'), false) as b4 from evidence),
trust as (select chapter, review_status, clusters, b3, case when not coalesce(has_checkpoint, false) and coalesce(has_stage6, false) and coalesce(has_gaps, false) then 'LEGACY_UNCHECKPOINTED' when not coalesce(has_checkpoint, false) then 'LEGACY_UNGATED' when not coalesce(has_45c, false) then 'LEGACY_STALE_CHECKPOINT'
 when not coalesce(has_45d, false) then 'LEGACY_UNGATED' when not (coalesce(completed, false) and coalesce(gate = 'PASS', false)) then 'IN_PROGRESS'
 when coalesce(review_status <> 'COMPLETED', true) or b1 or b2 or b3 or b4 or not coalesce(tested, false) then 'CORPUS_REVIEW_PENDING' when try_cast(reviewed as bigint) < try_cast(flagged as bigint) or try_cast(clusters as bigint) <> 0 or try_cast(unresolved as bigint) <> 0 then 'CORPUS_REVIEW_PENDING' else 'CORPUS_TESTING_READY' end as classification from b)"""


@query("trust_ladder", "A25 A26 A27 A28 A29 J38 Q08", derived_sql("evidence") + _TRUST + """
select chapter, classification, classification = 'CORPUS_TESTING_READY' as trusted, review_status = 'COMPLETED' as semantic_review_complete, case when not b3 then clusters::bigint = 0 end as completeness_review_complete, false as retrieval_ready from trust""")
def trust_ladder(spark, sf_dir):
    return ledger.classify_trust(derive(spark, sf_dir, "evidence"))


@query("trust_mismatches", "J32 A51 A52 A54", derived_sql("evidence", "declared") + _TRUST + """
select coalesce(d.chapter, t.chapter) as chapter, d.classification as declared, t.classification as recomputed from declared d full join trust t on t.chapter = d.chapter where d.classification is distinct from t.classification""")
def trust_mismatches(spark, sf_dir):
    return ledger.declared_mismatches(derive(spark, sf_dir, "declared"), ledger.classify_trust(derive(spark, sf_dir, "evidence")))


@query("excluded_chapters", "A54 A52", derived_sql("evidence", "declared") + _TRUST + """
select d.chapter, case when t.classification is null then 'no evidence' when t.classification <> 'CORPUS_TESTING_READY' then 'not trusted ' || t.classification else '' end as reason from declared d left join trust t on t.chapter = d.chapter""")
def excluded_chapters(spark, sf_dir):
    return ledger.exclusion_reason(derive(spark, sf_dir, "declared").select("chapter"), ledger.classify_trust(derive(spark, sf_dir, "evidence")))


@query("link_violations", "J30 Q09", derived_sql("links", "link_chunks") + """
, e as (select chapter, chunk_id, unnest(string_split(related, ',')) as "to" from links),
j as (select e.*, a.disease, b.disease as td, exists (select 1 from e x where x.chapter = e.chapter and x.chunk_id = e."to" and x."to" = e.chunk_id) as back from e left join link_chunks a on a.chapter = e.chapter and a.chunk_id = e.chunk_id left join link_chunks b on b.chapter = e.chapter and b.chunk_id = e."to")
select chapter, chunk_id, "to", 'dangling' as problem from j where td is null union all select chapter, chunk_id, "to", 'self' from j where chunk_id = "to" union all select chapter, chunk_id, "to", 'cross_disease' from j where disease <> td
union all select chapter, chunk_id, "to", 'asymmetric' from j where td is not null and chunk_id <> "to" and not back""")
def link_violations(spark, sf_dir):
    return ledger.link_violations(derive(spark, sf_dir, "links"), derive(spark, sf_dir, "link_chunks"))


@query("count_mismatches", "J31", """
with a as (select o_custkey as chapter, count(*) as n from orders group by 1), b as (select c_custkey as chapter, c_custkey % 20 as n from customer where c_custkey % 7 <> 0), u as (select * from a union all select * from b)
select chapter::varchar as chapter, count(*) as sources, count(distinct n) as "values", min(n) as least, max(n) as most from u group by chapter having count(distinct n) > 1 or count(*) < 2""")
def count_mismatches(spark, sf_dir):
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("chapter")).agg(F.count("*").alias("n"))
    key = F.col("c_custkey")
    b = table(spark, sf_dir, "customer").where(key % 7 != 0).select(key.cast("string").alias("chapter"), (key % 20).alias("n"))
    return ledger.count_mismatches(a, b)


@query("version_drift", "A40 J34 S32", derived_sql("declarations") + """
, d as (select distinct package, place, version from declarations) select package, count(distinct version) as versions, count(*) as places, count(distinct version) = 1 as consistent from d group by package""")
def version_drift(spark, sf_dir):
    return ledger.version_drift(derive(spark, sf_dir, "declarations"))


@query("version_order", "F44 F45 F64 O22", derived_sql("declarations") + """
, v as (select distinct version from declarations), x as (select version, regexp_extract(version, '^v?(\\d+)\\.(\\d+)\\.(\\d+)(?:-([0-9A-Za-z.-]+))?(?:\\+[0-9A-Za-z.-]+)?$', ['major', 'minor', 'patch', 'pre']) as m from v),
n as (select version, try_cast(m.major as int) as a, try_cast(m.minor as int) as b, try_cast(m.patch as int) as c, m.pre as pre from x)
select version, a || '.' || (b + 1) || '.0' as next, case when a is not null then row_number() over (order by a nulls last, b, c, pre = '', split_part(pre, '.', 1), try_cast(split_part(pre, '.', 2) as int)) end as rank from n""")
def version_order(spark, sf_dir):
    rows = derive(spark, sf_dir, "declarations").select("version").distinct().withColumn("key", C.semver_key(F.col("version")))
    rank = positions(rows.where("key is not null"), ["key"], "rank").select("version", (F.col("rank") + 1).alias("rank"))
    return rows.join(rank, "version", "left").select("version", C.bump(F.col("version"), "minor").alias("next"), "rank")


# ------------------------------------------------------------------ index lines


def _indexed(spark, sf_dir):
    return index.index_lines(derive(spark, sf_dir, "index_lines"))


_INDEXED = """, r as (select ord, trim(line, ' ') as line, regexp_replace(split_part(trim(line, ' '), ' ', 1), '[,;]+$', '') as word from index_lines where trim(line, ' ') <> '' and not starts_with(trim(line, ' '), '#') and not starts_with(trim(line, ' '), 'Note:')),
s as (select ord, line, (regexp_matches(line, '^[a-z]') and not regexp_matches(word, '[A-Z]')) or regexp_matches(line, '^(in |of |for |with |as |and |vs[.])') as sub from r),
e as (select *, last_value(case when not sub then ord end ignore nulls) over (order by ord rows unbounded preceding) as entry from s),
i as (select e.ord, e.line, e.sub and e.entry is not null as is_sub, coalesce(e.entry, e.ord) as term_ord, coalesce(t.line, e.line) as term from e left join s t on t.ord = e.entry),
t as (select term_ord, term, count(*) filter (is_sub) as subs, string_agg(line, '; ' order by ord) filter (is_sub) as entries from i group by all)"""


@query("index_terms", "W18 S01", derived_sql("index_lines") + _INDEXED + " select term_ord, term, subs::int as subs, md5(coalesce(entries, '')) as entries from t")
def index_terms(spark, sf_dir):
    return index.terms(_indexed(spark, sf_dir)).select("term_ord", "term", F.size("subs").alias("subs"), F.md5(F.array_join("subs", "; ")).alias("entries"))


@query("index_anchors", "X13", derived_sql("index_lines") + _INDEXED + """
, d as (select term, ' ' || regexp_replace(line, '([^A-Za-z0-9–\\-])', '\\1\\1', 'g') || ' ' as line from i),
m as (select term, unnest(regexp_extract_all(line, '[^A-Za-z0-9](?:\\d+[–\\-]\\d+|\\d+[tfc]?)[^A-Za-z0-9]')) as m from d),
x as (select term, regexp_extract(m, '(\\d+)[–\\-](\\d+)', 1) as lo, regexp_extract(m, '(\\d+)[–\\-](\\d+)', 2) as hi, regexp_extract(m, '(\\d+)([tfc])', 1) as page, regexp_extract(m, '(\\d+)([tfc])', 2) as kind from m)
select term as concept, case when lo <> '' then lo else page end as page_start, case when lo <> '' then hi end as page_end,
 case when lo <> '' then 'page_interval' when kind = 't' then 'table_anchor' when kind = 'f' then 'figure_anchor' else 'plate_anchor' end as anchor_type from x where lo <> '' or kind <> ''""")
def index_anchors(spark, sf_dir):
    return index.anchors(_indexed(spark, sf_dir))


@query("index_names", "X12 E09", derived_sql("index_lines") + _INDEXED + """
, a as (select ord, trim(regexp_extract(line, '([A-Za-z0-9\\s\\-]+)\\s*\\(([A-Z0-9\\-]{2,10})\\)', 2), ' ') as name, trim(regexp_extract(line, '([A-Za-z0-9\\s\\-]+)\\s*\\(([A-Z0-9\\-]{2,10})\\)', 1), ' ') as meaning from i),
f as (select name, meaning, min(ord) as ord from a where length(name) >= 2 and regexp_matches(name, '[A-Z]') group by all)
select 'trial' as kind, regexp_extract(line, '(?i)\\b([A-Z0-9\\-]{2,15})\\s*\\(([^)]+)\\)\\s*(?:trial|study|investigation|registry)', 1) as name, regexp_extract(line, '(?i)\\b([A-Z0-9\\-]{2,15})\\s*\\(([^)]+)\\)\\s*(?:trial|study|investigation|registry)', 2) as meaning
from i where regexp_matches(line, '(?i)\\b([A-Z0-9\\-]{2,15})\\s*\\(([^)]+)\\)\\s*(?:trial|study|investigation|registry)') union all select 'acronym', name, string_agg(meaning, '; ' order by ord) from f group by name""")
def index_names(spark, sf_dir):
    rows = _indexed(spark, sf_dir)
    a = index.trials(rows).select(F.lit("trial").alias("kind"), F.col("acronym").alias("name"), F.col("title").alias("meaning"))
    return a.union(index.acronyms(rows).select(F.lit("acronym"), "acronym", "expansions"))


@query("index_graphs", "X14 X17 A20 W15", derived_sql("index_lines") + _INDEXED + """
, w as (select lower(split_part(term, ' ', 1)) as word from t)
select 'see' as kind, term as a, trim(regexp_extract(term, '\\bSee (?:also )?([A-Za-z0-9\\s,\\-]+)', 1), ' ') as b from t where regexp_matches(term, '\\bSee (?:also )?([A-Za-z0-9\\s,\\-]+)')
union all select 'subtree', lower(term), subs::varchar from t where subs >= 3 union all select 'polysemy', word, count(*)::varchar from w where length(word) >= 4 group by word having count(*) >= 4
union all select 'comparator', term, line from i where is_sub and regexp_matches(line, '(?i)\\bvs\\b\\.?|distinguished from') union all select 'edges', (count(*) - 1)::varchar, '1.0' from t""")
def index_graphs(spark, sf_dir):
    rows = index.terms(_indexed(spark, sf_dir))
    out = index.cross_references(rows).select(F.lit("see").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"))
    out = out.union(index.subtrees(rows).select(F.lit("subtree"), "concept", F.col("n").cast("string"))).union(index.polysemy(rows).select(F.lit("polysemy"), "keyword", F.col("branches").cast("string")))
    out = out.union(index.comparators(rows).select(F.lit("comparator"), "concept", "entry"))
    return out.union(index.adjacency(rows).agg(F.count("*").cast("string").alias("a"), F.max("weight").cast("string").alias("b")).select(F.lit("edges"), "a", "b"))


@query("index_salience", "A22 X18")
def index_salience(spark, sf_dir):
    rows = index.salience(index.terms(_indexed(spark, sf_dir))).select(F.col("word").alias("name"), F.col("weight").cast("string").alias("value"))
    return rows.union(index.grammar(index.acronyms(_indexed(spark, sf_dir))).select(F.lit("gbnf"), "gbnf"))


@query("canonical_copies", "W16 S05 S06 P41", derived_sql("copies") + """
, c as (select path, string_split(path, '/')[-1] as name, string_split(lower(path), '/') as parts from copies),
k as (select *, list_reduce([[]::varchar[]] || list_transform(parts[:-2], lambda d: regexp_split_to_array(d, '[^a-z0-9]+')), lambda a, b: list_concat(a, b)) as tokens from c)
select name, path from (select *, row_number() over (partition by name order by parts[-2] <> 'rag_pipeline_output', len(parts), path) as n from k where not list_has_any(tokens, ['backup', 'backups', 'audit', 'audits', 'bundle', 'bundles'])) where n = 1""")
def canonical_copies(spark, sf_dir):
    return index.canonical_copies(derive(spark, sf_dir, "copies"), "rag_pipeline_output")


# ------------------------------------------------------------------ guard, grounding, setup files


_DOSE = "case l_linenumber % 5 when 0 then {n} || '.0 mg QD' when 1 then 'Hb ' || {n} || '.0 g/dL' when 2 then '.' || {n} || ' mg QOD' when 3 then {n} || ' IU and 4 U' else {n} || ' U/kg' end".replace("{n}", "cast(l_partkey % 90 + 1 as string)")


@query("dose_rewrites", "F05", f"select distinct {_DOSE} as raw, " + "case l_linenumber % 5 when 0 then {n} || ' mg once daily' when 1 then 'Hb ' || {n} || '.0 g/dL' when 2 then '0.' || {n} || ' mg every other day' when 3 then {n} || ' units and 4 units' else {n} || ' U/kg' end as text from lineitem".replace("{n}", "(l_partkey % 90 + 1)"))
def dose_rewrites(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.expr(_DOSE).alias("raw")).distinct().withColumn("text", C.rewrite(F.col("raw"), P.DOSE_REWRITES_JAVA))


@query("text_guard", "F01 F02 F03 F04 F06 F07 F10")
def text_guard(spark, sf_dir):
    damage = F.element_at(F.array(*map(F.lit, ("â‰¥ 5 Âµg ﬁne​ ", "10^{9} \\geq \\(x\\) \\mu g ", "First part. Second part is longer than that. ", ""))), (F.col("doc_id") % 4).cast("int") + 1)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(damage, "text").alias("raw"))
    got = rows.select("doc_id", U.repair_source(F.col("raw")).alias("source"), U.sanitise(F.col("raw")).alias("output"), U.clean_latex(F.col("raw")).alias("latex"), U.excerpt("raw", F.lit(15)).alias("excerpt"))
    return got.select("doc_id", F.md5("source").alias("source"), F.md5("output").alias("output"), F.md5("latex").alias("latex"), "excerpt")


@query("heading_kinds", "P25 W20", derived_sql("headings") + f"""
select heading, case when {_ANY('upper(heading)', P.EXEMPT_HEADINGS)} then 'exempt' when contains(upper(heading), 'LAYER 2') then 'layer2' when {_ANY('upper(heading)', P.ANCHORED_HEADINGS)} then 'anchored' end as kind from headings""")
def heading_kinds(spark, sf_dir):
    return derive(spark, sf_dir, "headings").withColumn("kind", guard.section_kind(F.col("heading")))


ALIASES = {"alpha": "alpha", "al": "alpha", "beta": "beta"}


@query("grounded_notes", "A36 F40 F41 J17 P26 X10 X11 W20")
def grounded_notes(spark, sf_dir):
    rows = lines.explode_lines(derive(spark, sf_dir, "notes"), "doc", "text")
    kinds = lines.heading_kinds(rows, guard.section_kind(F.col("line")))
    cites = guard.citations(rows, ALIASES)
    have = spark.createDataFrame([("alpha", 16, "L2-045"), ("beta", 1, "L2-001")], "book string, chapter int, chunk_id string")
    return guard.grounding(rows, kinds, cites, guard.resolve_citations(cites, have))


@query("section_matches", "J13 S31 F50", """
with f as (select distinct case when p_partkey % 3 = 0 then replace(p_type, ' ', '_') when p_partkey % 3 = 1 then '0' || p_size || '-' || p_type || '  final' else p_brand || ' notes' end as folder from part),
s as (select distinct p_type || '.PDF' as section from part union select distinct p_type || ' ' || p_brand || '.pdf' from part where p_partkey % 5 = 0),
n as (select folder, lower(trim(regexp_replace(regexp_replace(regexp_replace(folder, '(?i)\\.pdf$', ''), '[_\\-]+', ' ', 'g'), '\\s+', ' ', 'g'), ' ')) as name from f),
t as (select section, lower(trim(regexp_replace(regexp_replace(regexp_replace(section, '(?i)\\.pdf$', ''), '[_\\-]+', ' ', 'g'), '\\s+', ' ', 'g'), ' ')) as title from s),
h as (select folder, section, case when name = title then 1000000 else length(title) end as score from n join t on name = title or (length(name) > 10 and (contains(name, title) or contains(title, name)))),
b as (select folder, section, score, max(score) over (partition by folder) as top from h), o as (select folder, min(section) as section from b where score = top group by folder having count(*) = 1)
select f.folder, o.section from f left join o on o.folder = f.folder""")
def section_matches(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    folder = F.expr("case when p_partkey % 3 = 0 then replace(p_type, ' ', '_') when p_partkey % 3 = 1 then '0' || p_size || '-' || p_type || '  final' else p_brand || ' notes' end")
    sections = part.select(F.expr("p_type || '.PDF'").alias("section")).union(part.where("p_partkey % 5 = 0").select(F.expr("p_type || ' ' || p_brand || '.pdf'"))).distinct()
    return lint.match_sections(part.select(folder.alias("folder")).distinct(), sections)


@query("section_states", "A39 A53", derived_sql("section_files") + """
select section, case when bool_or(regexp_matches(name, '_RAG_Optimised\\.md$')) then 'indexed' when bool_or(regexp_matches(name, '_chunks\\.md$')) then 'chunked' when bool_or(name = 'markdown.md') then 'ocr' when bool_or(regexp_matches(name, '(?i)\\.pdf$')) then 'split' else 'empty' end as status from section_files group by section""")
def section_states(spark, sf_dir):
    return lint.section_status(derive(spark, sf_dir, "section_files"))


_CHAPTER_PATH = """case p_partkey % 6 when 0 then '/b/Chapter 0' || cast(p_size as string) || ' - ' || p_name || '.md' when 1 then '/b/' || cast(p_size as string) || '_Heart.md'
 when 2 then '/b/Part ' || case p_size % 4 when 0 then 'IV' when 1 then 'IX' when 2 then 'XIV' else 'XXVI' end || ' Lungs.md' when 3 then '/guidelines/Care 2024.md' when 4 then '/b/ch_' || cast(p_size as string) || '.md' else '/b/' || p_name || '.md' end"""


@query("chapter_names", "P34 P35 P36 P37 S37", f"select p_partkey, {_CHAPTER_PATH} as path," + """ case when p_partkey % 6 in (0, 1, 4) then p_size::int when p_partkey % 6 = 2 then case p_size % 4 when 0 then 4 when 1 then 9 when 2 then 14 else 26 end end as chapter,
 case when p_partkey % 6 = 3 then 'GUIDELINE' else 'TEXTBOOK' end as archetype from part""")
def chapter_names(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_CHAPTER_PATH).alias("path")).withColumn("i", lint.chapter_info(F.col("path")))
    return rows.select("p_partkey", "path", "i.chapter", "i.archetype")


# ------------------------------------------------------------------ modalities and projects


@query("curriculum_tiers", "P27 J19 S11 O09", derived_sql("records", "bridge") + f"""
, b as (select record_id, arg_max(chapter || ' (' || chapter_title || ')', ord) as reference from bridge group by 1)
select r.record_id, title, case when {_ANY("lower(concat_ws(' ', title, domain, condition))", P.TIER3_WORDS)} then 'Tier 3' when {_ANY("lower(concat_ws(' ', title, domain, condition))", P.TIER1_WORDS)} then 'Tier 1' else 'Tier 2' end as tier, coalesce(reference, 'General Internal Medicine') as reference from records r left join b on b.record_id = r.record_id""")
def curriculum_tiers(spark, sf_dir):
    return modalities.curriculum(derive(spark, sf_dir, "records"), derive(spark, sf_dir, "bridge"))


@query("claim_triplets", "E07 O10", derived_sql("claims") + """
select claim_id as source_id, case when trim(disease) = '' then 'General Condition' else disease end as subject, case claim_type when 'CONTRAINDICATION' then 'CONTRAINDICATES' when 'TREATMENT' then 'TREATED_BY' else 'DIAGNOSTIC_PATHWAY' end as predicate, trim(claim_text) as object from claims where claim_type <> 'PEARL'
union all select 'fixed', 'A', 'CAUSES', 'B'""")
def claim_triplets(spark, sf_dir):
    fixed = spark.createDataFrame([("fixed", "A", "CAUSES", "B")], "source_id string, subject string, predicate string, object string")
    return modalities.triplets(derive(spark, sf_dir, "claims"), fixed)


@query("claim_cards", "P28 O11 S22", derived_sql("claims") + """
select format('CARD-{:04d}', row_number() over (order by claim_id)) as card_id, case when claim_type = 'CONTRAINDICATION' then 'Contraindicated in ' || disease || ': {{c1::...}}' else disease || ': {{c1::...}}' end as front, claim_text as back from claims""")
def claim_cards(spark, sf_dir):
    return modalities.cards(derive(spark, sf_dir, "claims"))


ORDER_RULES = [("WARFARIN_ASPIRIN", ["warfarin", "aspirin"]), ("METFORMIN_RENAL", ["metformin", "egfr"])]


@query("order_rules", "O19", derived_sql("orders") + """
select id, text, case when contains(lower(text), 'warfarin') and contains(lower(text), 'aspirin') then 'WARFARIN_ASPIRIN' when contains(lower(text), 'metformin') and contains(lower(text), 'egfr') then 'METFORMIN_RENAL' else 'PERMITTED' end as rule from orders""")
def order_rules(spark, sf_dir):
    return modalities.first_rule(derive(spark, sf_dir, "orders"), ORDER_RULES, "text")


@query("slide_roles", "P16 P18", derived_sql("titles") + """, s as (select id, lower(trim(title, ' ')) as t, lower(concat_ws(' ', title, body)) as b,
 len(list_filter(regexp_split_to_array(trim(body, ' '), '\\s+'), lambda x: x <> '')) >= 14 as long,
 list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'), ' ')), lambda x: x <> '') as rows from titles)
select id, case when regexp_matches(t, 'reference|bibliography') then 'reference' when regexp_matches(t, 'case 1|case 2|clinical case|case study') then 'case'
 when contains(t, 'mechanism') and long then 'mechanism' when contains(t, 'mechanism') then 'divider' when regexp_matches(t, 'dosing|titration|dose limit') and long then 'dosing'
 when regexp_matches(t, 'dosing|titration|dose limit') then 'divider' when contains(t, 'safety') and long then 'safety'
 when regexp_matches(t, 'safety|clinical application|regulatory status|efficacy|why it matters') then 'divider' when regexp_matches(t, 'roadmap|learning objectives') then 'general'
 when regexp_matches(b, 'contraindication|boxed warning|monitoring|hypogly') then 'safety' when regexp_matches(b, 'missed dose|maintenance dose|titration|maximum dose') then 'dosing'
 when regexp_matches(b, 'counselling|counseling|contraception|pregnan') then 'counselling' when regexp_matches(b, 'mechanism|receptor|agonism|glp-1|gip') then 'mechanism'
 when regexp_matches(b, 'surpass|surmount|hba1c|trial|placebo|semaglutide') then 'evidence' when regexp_matches(b, 'takeaway|remember|checklist|summary|conclusion') then 'takeaway'
 when not long then 'divider' else 'general' end as role,
 coalesce(list_filter(rows[1:6], lambda x: length(x) <= 120 and not regexp_matches(x, '^\\d+$'))[1], rows[1], 'Untitled slide') as first from s""")
def slide_roles(spark, sf_dir):
    return derive(spark, sf_dir, "titles").select("id", lint.slide_role(F.col("title"), F.col("body")).alias("role"), lint.slide_title(F.col("body")).alias("first"))


_IMAGE = "substring(md5(text), 1, 15) || cast(doc_id % 2 as string)"  # a bit apart for equal texts of odd and even ids


@query("duplicate_slides", "J33 F32", f"""with s as (select source as deck, doc_id as slide, text, {_IMAGE} as image from documents where text is not null and source is not null),
c as (select deck, slide, min(slide) over (partition by deck, text) as first from s)
select deck, slide, first from c where first < slide""")
def duplicate_slides(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return lint.duplicate_slides(docs.select(F.col("source").alias("deck"), F.col("doc_id").alias("slide"), "text", F.expr(_IMAGE).alias("image")))


@query("slide_timing", "A35", """with s as (select p_brand as deck, p_partkey as slide,
 (case p_partkey % 4 when 0 then 0.35 when 1 then 1.3 when 2 then 1.0 else 1.45 end)::double * (case p_size % 3 when 0 then 0.8 when 1 then 1.0 else 1.25 end)::double * (case when p_partkey % 10 = 0 then 0.35 else 1 end)::double as share from part),
b as (select deck, slide, greatest(4, round_even(6000 * share / sum(share) over (partition by deck), 0)::bigint) as base from s),
c as (select *, 6000 - sum(base) over (partition by deck) as change, count(*) over (partition by deck) as n, row_number() over (partition by deck order by slide) as place from b),
u as (select *, unnest(range(1, (case when change >= 0 then change // n + 2 else base - 3 end)::bigint)) as round from c),
r as (select *, row_number() over (partition by deck order by round, place) as unit from u),
g as (select deck, slide, count(*) as moved from r where unit <= abs(change) group by deck, slide)
select deck, slide, (base + sign(change) * coalesce(moved, 0))::bigint as seconds from c left join g using (deck, slide)""")
def slide_timing(spark, sf_dir):
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at.cast("int") + 1)
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("deck"), key.alias("slide"), pick(["divider", "safety", "general", "case"], key % 4).alias("role"), pick(["low", "medium", "high"], F.col("p_size") % 3).alias("density"), (key % 10 == 0).alias("duplicate"))
    return lint.allocate(rows, 6000)


@query("project_issues", "J28 J29", derived_sql("slides", "scripts") + """
, s as (select slide, count(*) as n, sum(seconds) as spoken from scripts group by 1), j as (select coalesce(m.slide, s.slide) as slide, m.slide as listed, m.seconds, n, spoken from slides m full join s on s.slide = m.slide)
select slide, 'no script' as problem from j where n is null union all select slide, 'no slide' from j where listed is null union all select slide, 'doubled script' from j where n > 1 union all select slide, 'timing' from j where abs(seconds - spoken) > 30""")
def project_issues(spark, sf_dir):
    return lint.project_issues(derive(spark, sf_dir, "slides"), derive(spark, sf_dir, "scripts"))


@query("record_search", "O01 O12 O14 O15", derived_sql("records") + """
select record_id, 2 * (contains(lower(title), 'dengue')::int + contains(lower(title), 'gout')::int) as score from records where contains(lower(title), 'dengue') or contains(lower(title), 'gout') order by score desc, record_id limit 3""")
def record_search(spark, sf_dir):
    return retrieval.term_search(derive(spark, sf_dir, "records"), "Dengue or gout", "title", 2, 3, "record_id").select("record_id", "score")


# ------------------------------------------------------------------ state


@query("stage_state", "T01 T03 T04 T05 T06 T17", derived_sql("events_log", "log_sources") + """
, e as (select * from events_log e where exists (select 1 from log_sources s where s.prefix = e.prefix and s.source_md5 = e.source_md5))
select prefix, stage, arg_max(status, ord) as status, arg_max(version, ord) filter (where version is not null) as version, max(ord) as ord from e group by all""")
def stage_state(spark, sf_dir):
    return state.current(derive(spark, sf_dir, "events_log"), derive(spark, sf_dir, "log_sources"))


_ORDER = "st as (select * from (values " + ", ".join(f"('{stage}', {k})" for k, stage in enumerate(P.STAGE_ORDER)) + ") t(stage, pos))"
_CURRENT = """, e as (select * from events_log e where exists (select 1 from log_sources s where s.prefix = e.prefix and s.source_md5 = e.source_md5)),
cur as (select prefix, stage, arg_max(status, ord) as status, arg_max(version, ord) filter (where version is not null) as version from e group by all), """


@query("next_stages", "T02 T08 T13 T14 T15 X20", derived_sql("events_log", "log_sources") + _CURRENT + _ORDER + """,
l as (select s.prefix, st.stage, st.pos from (select distinct prefix from log_sources) s, st where not exists (select 1 from cur where cur.prefix = s.prefix and cur.stage = st.stage and cur.status = 'COMPLETED'))
select s.prefix, (select arg_min(stage, pos) from l where l.prefix = s.prefix) as next_stage, (select count(*) from l where l.prefix = s.prefix) as remaining from (select distinct prefix from log_sources) s""")
def next_stages(spark, sf_dir):
    log, sources = derive(spark, sf_dir, "events_log"), derive(spark, sf_dir, "log_sources")
    left = state.remaining(spark, log, sources).groupBy("prefix").agg(F.count("*").alias("remaining"))
    return state.next_stage(spark, log, sources).join(left, "prefix", "left").select("prefix", "next_stage", F.coalesce("remaining", F.lit(0)).alias("remaining"))


@query("rewind_plan", "T12 T18 T19", derived_sql("stage_now") + ", " + _ORDER + """
select prefix, next_stage, case when coalesce(pos, 999) > (select pos from st where stage = '4.5d') then '4.5d' else next_stage end as planned from stage_now left join st on st.stage = next_stage""")
def rewind_plan(spark, sf_dir):
    return state.rewind_plan(spark, derive(spark, sf_dir, "stage_now"), "4.5d")


@query("state_drift", "T10 T11 T16", derived_sql("events_log", "log_sources") + _CURRENT + _ORDER + """
select prefix, stage, coalesce(version, 'UNKNOWN') as recorded from cur where coalesce(version, 'UNKNOWN') <> '2.7'""")
def state_drift(spark, sf_dir):
    return state.drift(state.evolve(state.current(derive(spark, sf_dir, "events_log"), derive(spark, sf_dir, "log_sources")), {"version": "string"}), "2.7")


# ------------------------------------------------------------------ packages and composed jobs


_PACKED = "case p_partkey % 7 when 0 then '/r/' || p_name || '.bak' when 1 then '/r/x/SKILL.md' when 2 then '/r/Audit_' || p_brand || '.json' when 3 then '/r/' || p_name || '.JSON' when 4 then '/r/skill.txt' when 5 then '/r/x.json.md' else '/r/.cache/' || p_name end"


@query("pruned_files", "P29 P30 P32 U23", f"with f as (select p_partkey, {_PACKED} as path from part), n as (select *, lower(string_split(path, '/')[-1]) as name, lower(string_split(path, '/')[3]) as top from f)" + """
select p_partkey, case when starts_with(name, 'audit') then 'kept_evidence' when name = 'skill.md' then 'protected' when regexp_matches(name, '[.]bak$|[.]json$|^skill[.]') then 'pruned' else 'kept' end as action,
 starts_with(top, '.') or regexp_matches(top, 'audit|package|__pycache__|pytest_cache|ocr markdown|global_index|verification_bundle|bundle_build') as ignorable from n""")
def pruned_files(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_PACKED).alias("path"))
    got = packaging.prune(rows.select("path").distinct(), ["*.bak", "*.json", "skill.*"], ["SKILL.md"], ["audit*"])
    return rows.join(got, "path").select("p_partkey", "action", packaging.ignorable(F.get(F.split("path", "/"), F.lit(2))).alias("ignorable"))


@query("status_table", "A30 S42", derived_sql("evidence") + _TRUST + " select chapter, classification from trust")
def status_table(spark, sf_dir):
    return packaging.parse_status_table(packaging.status_table(ledger.classify_trust(derive(spark, sf_dir, "evidence"))))


@query("span_faults", "W21 W23", """
with e as (select o_orderkey as entry, o_orderpriority as source from orders),
s as (select entry, source, 1 as idx, 0 as start, 2 + entry % 2 as stop, 'g' as grp, source[1:2 + entry % 2] as text from e
      union all select entry, source, 2, 2 + entry % 2 + (entry % 5 = 0)::int, 5, case when entry % 3 = 0 then 'h' else 'g' end, case when entry % 7 = 0 then '?' else source[3 + entry % 2 + (entry % 5 = 0)::int:5] end from e
      union all select entry, source, 3, 5, length(source) - (entry % 11 = 0)::int, 'g', source[6:length(source) - (entry % 11 = 0)::int] from e),
b as (select *, coalesce(lag(stop) over w, 0) as before, coalesce((lag(grp) over w <> grp)::int, 1) as change from s window w as (partition by entry order by idx)),
f as (select entry, bool_or(before <> start) as gap, max(stop) <> max(length(source)) as cover, bool_or(text <> source[start + 1:stop]) as wrong, sum(change) <> count(distinct grp) as split from b group by entry)
select entry, 'gap' as fault from f where gap union all select entry, 'cover' from f where cover union all select entry, 'text' from f where wrong union all select entry, 'group' from f where split""")
def span_faults(spark, sf_dir):
    entry, source = F.col("o_orderkey"), F.col("o_orderpriority")
    first, hole = (F.lit(2) + entry % 2), F.when(entry % 5 == 0, 1).otherwise(0)
    end = F.length(source) - F.when(entry % 11 == 0, 1).otherwise(0)
    cut = lambda a, b: F.substr(source, (a + 1).cast("int"), (b - a).cast("int"))
    span = lambda k, a, b, g, t: F.struct(F.lit(k).alias("idx"), a.cast("int").alias("start"), b.cast("int").alias("end"), g.alias("grp"), t.alias("text"))
    five, none = F.lit(5), F.lit(0)
    three = [span(1, none, first, F.lit("g"), cut(none, first)), span(2, first + hole, five, F.when(entry % 3 == 0, "h").otherwise("g"), F.when(entry % 7 == 0, "?").otherwise(cut(first + hole, five))), span(3, five, end, F.lit("g"), cut(five, end))]
    orders = table(spark, sf_dir, "orders")
    return packaging.span_faults(orders.select(entry.alias("entry"), F.explode(F.array(*three)).alias("s")).select("entry", "s.*"), orders.select(entry.alias("entry"), source.alias("source")))


_RESPONSE = """case p_partkey % 3 when 0 then 'Here: [{"chunk_id": "' || cast(p_partkey as string) || '", "semantic_type": "drug_info"}, {"chunk_id": "b", "semantic_type": "odd"}] /home/me/' || p_brand
 when 1 then 'no array of ' || p_name else '[{"chunk_id": "' || p_name || '", "semantic_type": "drug_info"}, {"chunk_id": "c", "semantic_type": "drug_info"}]' end"""


@query("json_checks", "F09 F37 F63", """
select p_partkey, case p_partkey % 3 when 0 then 1 when 1 then 0 else 2 end as verdicts, case when p_partkey % 3 = 0 then '/home/me/' || p_brand end as private,
 '{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_size":' || p_size || '}' as canonical from part""")
def json_checks(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("response", F.expr(_RESPONSE))
    return rows.select("p_partkey", F.size(packaging.parse_verdicts(F.col("response"), ["drug_info"])).alias("verdicts"), packaging.private_path(F.col("response")).alias("private"), packaging.canonical_json(F.col("p_brand"), F.col("p_name"), F.col("p_size")).alias("canonical"))


@query("safe_links", "F66", "select page_id, case when regexp_matches(url, '(?i)^https?://') then url end as link from pages")
def safe_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", packaging.safe_link(F.col("url")).alias("link"))


_HEADER = """case when p_partkey % 3 = 0 then 'name: "' || p_name || '"' || chr(10) || 'version: ' || cast(p_size as string) || '.2.3' || chr(10) || 'description: ' || p_type when p_partkey % 3 = 1 then 'name: ' || p_name || '  ' else 'description:  x ' || p_brand || chr(10) || '"version" = v1.0.0' end"""


@query("header_fields", "F51 F52 F61 F65 F67", f"with h as (select *, {_HEADER} as t from part)" + """
select p_partkey, case when p_partkey % 3 <> 2 then p_name end as name, case when p_partkey % 3 = 0 then p_size || '.2.3' else 'UNKNOWN' end as version, case p_partkey % 3 when 0 then p_type when 2 then 'x ' || p_brand end as description,
 md5(regexp_replace(t, '(?m)^(\\s*"?version"?\\s*[:=]\\s*"?)v?\\d+\\.\\d+\\.\\d+[^\\s",]*', '\\12.0.0', 'g')) as rewritten, '<!-- provenance: stage=pack engine=2.0 sha256=' || sha256(t) || ' -->' as provenance from h""")
def header_fields(spark, sf_dir):
    t = F.col("t")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_HEADER).alias("t"))
    return rows.select("p_partkey", packaging.package_header(t).alias("h"), F.md5(packaging.rewrite_version(t, "2.0.0")).alias("rewritten"), packaging.provenance_comment(t, "pack", "2.0").alias("provenance")).select("p_partkey", "h.*", "rewritten", "provenance")


_LAYOUT = "text || chr(10) || '[tbl-' || cast(doc_id % 4 as string) || '.md](tbl-' || cast(doc_id % 4 as string) || '.md)' || chr(10) || '![x](img-1.jpeg)' || chr(10) || 'Fig. 2.' || cast(doc_id % 3 + 1 as string) || ' first' || chr(10) || '![y](img-2.jpeg)' || chr(10) || 'Fig. 2.1 again' || chr(10) || chr(10) || '![z](img-3.jpeg)'"


@query("inlined_tables", "J01 J02 J18 S03 S04", f"with d as (select doc_id as doc, {_LAYOUT} as text from documents where text is not null)," + """
l as (select doc, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as ln from d),
t as (select doc, ln, regexp_extract(line, '\\[(tbl-\\d+\\.md)\\]\\(tbl-\\d+\\.md\\)', 1) as name from l),
n as (select *, first_value(try_cast(nullif(regexp_extract(line, '(?i)^\\W*Fig(?:ure)?\\.?\\s*\\d+\\.(\\d+)', 1), '') as int) ignore nulls) over (partition by doc order by ln rows between 1 following and 30 following) as near, nullif(regexp_extract(line, '!\\[.*?\\]\\((img-[^)]+)\\)', 1), '') as file from l),
f as (select *, coalesce(near, coalesce(max(near) over (partition by doc), 0) + sum((near is null)::int) over (partition by doc order by ln rows unbounded preceding)) as figure from n where file is not null),
a as (select *, row_number() over (partition by doc, figure order by ln) as again from f)
select doc, 'table' as what, ln::bigint as ln, case when doc % 4 in (1, 2) then 'INLINED' else 'MISSING' end as status from t where name <> ''
union all select doc, format('fig_{:02d}', figure::int) || case when again > 1 then format('_sub{:02d}', again - 1) else '' end || '.jpeg', ln::bigint, case when file = 'img-1.jpeg' or (file = 'img-3.jpeg' and doc % 5 = 0) then 'OK' else 'MISSING' end from a""")
def inlined_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("doc"), F.expr(_LAYOUT).alias("text"))
    own = docs.where("doc % 4 in (1, 2)").select("doc", F.expr("'tbl-' || cast(doc % 4 as string) || '.md'").alias("name"), F.lit("| a |").alias("body"))
    _, found = packaging.inline_tables(docs, own, "doc", "text")
    files = docs.select("doc", F.explode(F.when(F.col("doc") % 5 == 0, F.array(F.lit("img-1.jpeg"), F.lit("img-3.jpeg"))).otherwise(F.array(F.lit("img-1.jpeg")))).alias("file"))
    images = packaging.normalise_images(lines.explode_lines(docs, "doc", "text"), files)
    out = found.select("doc", F.lit("table").alias("what"), F.col("ln").cast("bigint").alias("ln"), "status")
    return out.union(images.select("doc", "asset", F.col("ln").cast("bigint"), "status"))


@query("constant_rows", "X15 P42 P43 P44 Q07")
def constant_rows(spark, sf_dir):
    return packaging.safety_matrix(spark)


@query("chapter_states", "U12 U19 A27 A42 T20 T21")
def chapter_states(spark, sf_dir):
    return jobs.chapter_states(jobs.run_chapters(derive(spark, sf_dir, "chapters"), derive(spark, sf_dir, "chunk_files")))


@query("compiled_index", "U21 X16 X19 Q06")
def compiled_index(spark, sf_dir):
    got = jobs.compile_index(derive(spark, sf_dir, "chunk_files"), derive(spark, sf_dir, "index_lines"))
    sizes = [getattr(got, n).agg(F.lit(n).alias("asset"), F.count("*").alias("rows")) for n in ("catalogue", "postings", "terms", "anchors", "graph", "subtrees", "polysemy", "trial_map", "acronym_map", "early_exit", "cache")]
    out = sizes[0]
    for s in sizes[1:]:
        out = out.union(s)
    return out


@query("unique_slugs", "F46", """
with b as (select p_partkey, trim(substr(regexp_replace(regexp_replace(regexp_replace(lower(p_type), '^\\d+\\.\\d+\\s*', ''), '[^\\w\\s]', ' ', 'g'), '\\s+', '_', 'g'), 1, 40), '') as slug from part),
n as (select *, row_number() over (partition by slug order by p_partkey) as n from b) select p_partkey, case when n > 1 then slug || '-' || n else slug end as slug from n""")
def unique_slugs(spark, sf_dir):
    return lint.unique_slugs(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", "p_partkey").select("p_partkey", "slug")


_SHELF = "case p_partkey % 4 when 0 then '/x/Alpha 25th/' || p_name when 1 then '/books/AL/' || p_name when 2 then '/Beta/y' else '/none/' || p_name end"


@query("small_lookups", "J20 P33 P38 A59", derived_sql("bridge") + """
, b as (select chapter, ord, contains(lower(chapter_title), 'steel') as hit from bridge)
select 'bridge' as what, chapter as value from (select chapter from b order by hit desc, ord limit 1) union all select 'first', chapter from (select chapter from bridge order by ord limit 1)
union all select 'book ' || case when p_partkey % 4 < 2 then 'alpha' when p_partkey % 4 = 2 then 'beta' else 'none' end, count(*)::varchar from part group by 1
union all select 'kept', (4 * count(*))::varchar from part union all select 'count', sum(p_size) filter (p_partkey % 5 <> 0)::varchar from part""")
def small_lookups(spark, sf_dir):
    bridge, part = derive(spark, sf_dir, "bridge"), table(spark, sf_dir, "part")
    out = retrieval.first_bridge(bridge, ["steel"], ["chapter_title"], "ord").select(F.lit("bridge").alias("what"), F.col("chapter").alias("value"))
    out = out.union(retrieval.first_bridge(bridge, ["no such"], ["chapter_title"], "ord").select(F.lit("first"), "chapter"))
    books = part.select(F.coalesce(lint.book_of_path(F.expr(_SHELF), ALIASES), F.lit("none")).alias("book")).groupBy("book").count()
    out = out.union(books.select(F.concat(F.lit("book "), "book"), F.col("count").cast("string")))
    ledgers = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("one_sentence"), F.col("p_brand").alias("ward_limit"), F.array("p_name", "p_type").alias("claims"))
    out = out.union(lint.renderings(ledgers).agg(F.count_if("kept").cast("string").alias("value")).select(F.lit("kept"), "value"))
    report = F.concat(F.lit("Report\nChunks checked: "), F.when(F.col("p_partkey") % 5 == 0, "many").otherwise(F.col("p_size").cast("string")), F.lit("\nx"))
    return out.union(part.agg(F.sum(audit.reported_count(report, "Chunks checked")).cast("string").alias("value")).select(F.lit("count"), "value"))


_PRECISE = "case o_orderkey % 5 when 0 then 'PRECISE' when 1 then 'UNDER_INCLUSIVE' when 2 then 'OVER_INCLUSIVE' else 'UNRESOLVED' end"


@query("precision_summary", "A11 A12", f"with v as (select o_orderkey, {_PRECISE} as verdict, o_custkey % 4 as d from orders)" + """
select count(*) filter (verdict = 'PRECISE') as precise, count(*) filter (verdict = 'UNDER_INCLUSIVE') as under_inclusive, count(*) filter (verdict = 'OVER_INCLUSIVE') as over_inclusive, count(*) filter (verdict = 'UNRESOLVED') as unresolved,
 count(*) filter (verdict <> 'PRECISE' and d <> 0) as open from v""")
def precision_summary(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.lit("d").alias("doc"), F.col("o_orderkey").alias("chunk"), F.expr(_PRECISE).alias("verdict"), (F.col("o_custkey") % 4).alias("d"))
    said = orders.where("d < 2").select("doc", "chunk", F.when(F.col("d") == 0, "CHECKER_FALSE_POSITIVE").otherwise("CONFIRMED").alias("decision"))
    return spans.precision_summary(orders.drop("d"), said)


@query("bullet_gaps", "W09", """
with g as (select doc_id as doc, 0 as lo, 9 as hi from documents where text is not null), l as (select doc_id as doc, trim(unnest(string_split(text, chr(10))), ' ') as s, generate_subscripts(string_split(text, chr(10)), 1) as ln, len(string_split(text, chr(10))) as n, text from documents where text <> '')
select g.doc, g.lo, g.hi, coalesce(bool_and(s = '' or regexp_matches(s, '^[-*]\\s+\\S.{0,38}$')), true) as bullets_only from g left join l on l.doc = g.doc and l.ln between 1 and 8 and not (l.ln = l.n and l.s = '') group by all""")
def bullet_gaps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    gaps = docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("lo"), F.lit(9).alias("hi"))
    return spans.bullet_gaps(gaps, lines.explode_lines(docs, "doc_id", "text"))