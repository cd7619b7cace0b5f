"""Queries of setup scans, reviews, run traces, deck statements and stream progress over the Parquet tables.

Where the tables hold no such column, it is derived from theirs by an expression that both sides state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import patterns as P
from ..operators import lint, packaging
from ..registry import query, table
from ..streaming import progress

_FOLDERS = ["app", "app/.agents/x", "app/Hooks", "docs/skills", "src/memory/prompts", "lib/checks", "a/references", "b/tool-box"]
_FILES = [
    "AGENTS.md", "skill.md", "notes.txt", "Approval_Policy.json", "run_hook.py", "deck.PPTX", "id_ed25519", "Login Data", "server.key", ".env.local", "rules", "agent-rules.yaml", "prompt.prompt", "catalog.md",
    "credentials.yml", "openai.yaml", "README", "plan.csv", ".key", "memory.md", "test_all.sh", "main.ts", "config.toml",
]


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_PATHS = f"""p as (select p_partkey, {_sql_list(_FOLDERS)}[p_partkey % {len(_FOLDERS)} + 1] || '/' || {_sql_list(_FILES)}[(p_partkey // 3) % {len(_FILES)} + 1] as path from part),
n as (select *, lower(string_split(path, '/')[-1]) as name, string_split(lower(path), '/') as parts from p),
s as (select *, regexp_extract(name, '^.+(\\.[^.]+)$', 1) as suffix, parts[:-2] as folders from n),
m as (select *, name[:length(name) - length(suffix)] as stem from s),
k as (select *, case when name = 'skill.md' or list_contains(parts, 'skills') then 'skill-or-reference' when name in ('agents.md', 'claude.md', 'gemini.md') then 'project-instructions'
      when contains(stem, 'permission') or contains(stem, 'approval') then 'authority-config'
      when regexp_matches(stem, 'hook|validator|guardrail') or list_has_any(parts, ['hooks', 'validators', 'guardrails']) then 'deterministic-control'
      when contains(stem, 'memory') or list_contains(parts, 'memory') then 'memory-or-standing-context' when contains(stem, 'prompt') or list_contains(parts, 'prompts') then 'prompt'
      when regexp_matches(name, '\\.(json|toml|yaml|yml)$') then 'configuration' when suffix in ('.docx', '.pdf', '.pptx', '.rtf', '.xlsx') then 'supplied-document' else 'instruction-or-reference' end as kind,
      list_has_any(regexp_extract_all(stem, '[a-z]+'), {_sql_list(P.CONTROL_WORDS)}) as hinted from m),
c as (select *, name in ('.env', 'cookies', 'cookies.sqlite', 'credentials.json', 'id_dsa', 'id_ed25519', 'id_rsa', 'login data', 'secrets.json') or regexp_matches(name, '^(\\.env|credentials|secrets)\\.') or suffix in ('.key', '.p12', '.pfx', '.pem') as secret,
      list_contains({_sql_list(P.CONTROL_FILES)}, name) or (list_contains({_sql_list(P.TEXT_SUFFIXES)}, suffix) and (hinted or list_has_any(folders, {_sql_list(P.CONTROL_FOLDERS)})))
      or (suffix in ('.js', '.py', '.sh', '.ts') and (hinted or list_has_any(folders, ['checks', 'guardrails', 'hooks', 'validators']))) as candidate,
      case when kind = 'deterministic-control' or regexp_matches(lower(path), 'validator|guardrail|hook|receipt|test|check') then 'proves-done'
           when kind in ('authority-config', 'tool-or-action-config') or regexp_matches(lower(path), 'permission|approval|tool|mcp|sandbox|authority') then 'can-do'
           when kind = 'configuration' or (kind = 'skill-or-reference' and regexp_matches(lower(path), 'skill\\.md$|catalog|router|trigger')) then 'chooses-help'
           when kind in ('skill-or-reference', 'prompt', 'instruction-or-reference') then 'joins-job' else 'already-there' end as station from k)"""


def _paths(spark, sf_dir):
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at.cast("int") + 1)
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("/", pick(_FOLDERS, key % len(_FOLDERS)), pick(_FILES, F.floor(key / 3) % len(_FILES))).alias("path"))


@query("control_paths", "P19 P20 P21 P22 P23 P45", "with " + _PATHS + """
select p_partkey, path, kind, secret, candidate, station, case when kind in ('authority-config', 'deterministic-control') then 'HARD_CONTROL' when kind = 'configuration' then 'SYSTEM_CONFIGURATION' when kind = 'supplied-document' then 'CONTEXT_ONLY' else 'WRITTEN_GUIDANCE' end as enforcement from c""")
def control_paths(spark, sf_dir):
    path, kind = F.col("path"), F.col("kind")
    rows = _paths(spark, sf_dir).withColumn("kind", lint.control_kind(path))
    return rows.select("p_partkey", "path", "kind", lint.is_secret(F.element_at(F.split(path, "/"), -1)).alias("secret"), lint.is_candidate(path).alias("candidate"), lint.station(kind, path).alias("station"), lint.enforcement(kind).alias("enforcement"))


@query("setup_inventory", "S30 P20 P21 P22 W22 A38 A58", "with " + _PATHS + """,
d as (select distinct path, kind, secret, len(parts) as depth from c), e as (select *, case when secret then 'secret' when depth > 3 then 'depth' end as why from d),
r as (select *, case when why is null then row_number() over (partition by why is null order by path) end as n from e), x as (select path, kind, coalesce(why, case when n > 60 then 'limit' end) as excluded from r)
select path, excluded, case when excluded is null then kind end as kind, case when excluded is not null then null when kind in ('authority-config', 'deterministic-control') then 'HARD_CONTROL' when kind = 'configuration' then 'SYSTEM_CONFIGURATION' when kind = 'supplied-document' then 'CONTEXT_ONLY' else 'WRITTEN_GUIDANCE' end as enforcement from x""")
def setup_inventory(spark, sf_dir):
    return lint.inventory(_paths(spark, sf_dir).select("path").distinct(), 60, 3)


@query("setup_stations", "P45 A56", "with " + _PATHS + f"""
select t.station, t.place::bigint as place, count(c.station) as n from (select unnest({_sql_list(P.STATIONS)}) as station, unnest(range(5)) as place) t left join c on c.station = t.station group by all""")
def setup_stations(spark, sf_dir):
    got = packaging.stations(_paths(spark, sf_dir).withColumn("kind", lint.control_kind(F.col("path"))))
    return got.withColumn("place", F.col("place").cast("bigint"))


_STAGES = [*P.RUN_STAGES, "Dreamt"]
_STATES = [*P.STAGE_STATUSES, "MAYBE"]


@query("run_traces", "F53", f"""
with t as (select conv_id, {_sql_list(_STAGES)}[turn * (conv_id % 3 + 1) % 8 + 1] as stage, {_sql_list(_STATES)}[(turn + conv_id) % 6 + 1] as status, turn - 1 as n, case when turn % 4 = 3 then ' ' else role end as detail from conversations where turn < conv_id % 9),
f as (select conv_id, sum((stage = 'Dreamt')::int + (status = 'MAYBE')::int + (n < 0)::int + (trim(detail) = '')::int) + count(*) filter (stage <> 'Dreamt') - count(distinct case when stage <> 'Dreamt' then stage end) as bad, count(*) as stages from t group by conv_id),
c as (select distinct conv_id from conversations)
select c.conv_id, (coalesce(bad, 0) + (c.conv_id % 4 = 3)::int + (c.conv_id % 5 = 0)::int + (c.conv_id % 4 = 0 and coalesce(stages, 0) = 0)::int)::bigint as problems from c left join f on f.conv_id = c.conv_id""")
def run_traces(spark, sf_dir):
    turns, conv, turn = table(spark, sf_dir, "conversations"), F.col("conv_id"), F.col("turn")
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at.cast("int") + 1)
    stage = F.struct(pick(_STAGES, turn * (conv % 3 + 1) % 8).alias("stage"), pick(_STATES, (turn + conv) % 6).alias("status"), (turn - 1).alias("count"), F.when(turn % 4 == 3, " ").otherwise(F.col("role")).alias("detail"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(turn < conv % 9, F.struct(turn, stage.alias("s"))))).alias("f"))
    status = F.element_at(F.array(*map(F.lit, [*P.TRACE_STATUSES, "DONE"])), (conv % 4).cast("int") + 1)
    trace = F.to_json(F.struct(status.alias("trace_status"), F.when(conv % 5 == 0, "").otherwise("kept").alias("trace_note"), F.transform("f", lambda x: x["s"]).alias("funnel")))
    return rows.select("conv_id", F.size(packaging.trace_problems(trace)).cast("bigint").alias("problems"))


@query("review_violations", "J27 A57", """
with o as (select o_orderkey as id, o_orderkey % 10 as r, o_orderstatus as s, o_orderkey % 13 as e from orders),
d as (select *, case s when 'F' then 'KEEP' when 'O' then 'RETIRE' else 'SCRAP' end as decision from o where r in (0, 1, 2, 3, 4, 8) union all select *, 'KEEP' from o where r = 2 and id % 100 = 2),
u as (select id from o where r in (4, 5, 6)),
e as (select id, max(k) as k, sum(d) as d, sum(u) as u from (select id, 1 as k, 0 as d, 0 as u from o where r < 8 union all select id, 0, 1, 0 from d union all select id, 0, 0, 1 from u) group by id),
p as (select id, 'decided twice' as problem from e where d > 1 union all select id, 'reviewed and unreviewed' from e where d > 0 and u > 0 union all select id, 'unknown control' from e where k = 0
      union all select id, 'omitted control' from e where k > 0 and d + u = 0 union all select id, 'decision' from d where decision = 'SCRAP' union all select id, 'evidence_state' from d where e = 0 union all select id, 'reason' from d where id % 11 = 0)
select id as control_id, problem from p""")
def review_violations(spark, sf_dir):
    """Controls, decisions and undecided ids dealt from orders, with every kind of fault among them."""
    key, rest = F.col("o_orderkey"), F.col("o_orderkey") % 10
    orders = table(spark, sf_dir, "orders")
    texts = [F.when((key % 11 == 0) & F.lit(c == "reason"), F.lit(" \t")).otherwise(F.col("o_orderpriority")).alias(c) for c in P.DECISION_TEXTS]
    decision = F.when(F.col("o_orderstatus") == "F", "KEEP").when(F.col("o_orderstatus") == "O", "RETIRE").otherwise("SCRAP")
    say = lambda rows, d: rows.select(key.alias("control_id"), d.alias("decision"), F.when(key % 13 == 0, "GUESSED").otherwise("VERIFIED").alias("evidence_state"), *texts)
    decisions = say(orders.where(rest.isin(0, 1, 2, 3, 4, 8)), decision).unionAll(say(orders.where(key % 100 == 2), F.lit("KEEP")))
    return packaging.review_problems(orders.where(rest < 8).select(key.alias("control_id")), decisions, orders.where(rest.isin(4, 5, 6)).select(key.alias("control_id")))


@query("stale_guidance", "A31", """
with o as (select o_orderpriority as deck, o_orderkey as slide, case o_orderstatus when 'F' then 'Guideline' when 'O' then 'consensus' else 'Leaflet' end || ' of ' || o_custkey || ', ' || year(o_orderdate) || '. Position statement ' || (year(o_orderdate) + o_orderkey % 9) as text from orders),
m as (select deck, slide, unnest(regexp_extract_all(text, '(?i)\\b(?:guideline|guidance|recommendation|consensus|position statement)\\b[^.]{0,80}?\\b(?:19|20)\\d{2}\\b')) as match from o)
select deck, slide, match[:60] as match, right(match, 4)::int as year from m where right(match, 4)::int < 1996""")
def stale_guidance(spark, sf_dir):
    year = F.year("o_orderdate")
    kind = F.when(F.col("o_orderstatus") == "F", "Guideline").when(F.col("o_orderstatus") == "O", "consensus").otherwise("Leaflet")
    text = F.concat(kind, F.lit(" of "), F.col("o_custkey").cast("string"), F.lit(", "), year.cast("string"), F.lit(". Position statement "), (year + F.col("o_orderkey") % 9).cast("string"))
    slides = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("deck"), F.col("o_orderkey").alias("slide"), text.alias("text"))
    return lint.stale_guidance(slides, 1996).select("deck", "slide", "match", "year")


@query("missing_statements", "A31", """
with d as (select source as deck, doc_id as slide, text from documents union all select source, -1, 'This activity is accredited by the Accreditation Council' from (select distinct source from documents) where right(source, 1) in ('3', '7')
           union all select source, -2, 'No conflict of interest' from (select distinct source from documents) where right(source, 1) = '5'),
s as (select distinct deck from d),
r as (select * from (values ('CME-MISSING-ACCREDITATION-STATEMENT', 'ERROR', 'is accredited by the accreditation council'), ('CME-MISSING-CREDIT-DESIGNATION', 'ERROR', 'ama pra category 1 credit'), ('CME-MISSING-MITIGATION-STATEMENT', 'WARN', 'relevant financial relationships have been mitigated')) t(rule, severity, phrase)),
h as (select distinct deck, rule from d join r on contains(lower(d.text), r.phrase)), w as (select distinct deck from d where regexp_matches(lower(text), '\\b(disclosure|financial relationship|conflict of interest)\\b'))
select s.deck, r.rule, r.severity from s cross join r where not exists (select 1 from h where h.deck = s.deck and h.rule = r.rule)
union all select deck, 'CME-MISSING-DISCLOSURE', 'ERROR' from s where deck not in (select deck from w)""")
def missing_statements(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("deck"), F.col("doc_id").alias("slide"), "text")
    decks, end = docs.select("deck").distinct(), F.substring("deck", -1, 1)
    told = decks.where(end.isin("3", "7")).select("deck", F.lit(-1).alias("slide"), F.lit("This activity is accredited by the Accreditation Council").alias("text"))
    told = told.unionByName(decks.where(end == "5").select("deck", F.lit(-2).alias("slide"), F.lit("No conflict of interest").alias("text")))
    return lint.missing_statements(docs.unionByName(told))


@query("stream_progress", "T07 T09 T22", """
with e as (select user_id, event_type, (epoch_us(ts) // 3600000000)::bigint as hour, event_id from events)
select user_id as key, count(*) as events, max(hour) as section, arg_max(event_type, event_id) as status from e group by user_id""")
def stream_progress(spark, sf_dir):
    """The resume marker of every user after the events have come as a stream, read from the committed batches of its log."""
    return progress.run_events(spark, sf_dir)
