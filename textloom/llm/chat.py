"""Chat formatting by relational steps: sorted turn structs, merged runs of a role, one string a conversation.

Template, with control strings written out only by the template itself:
    <|turn|>ROLE<|text|>TEXT(<|next|>TEXT)*</s>
Inside roles and texts & < and [ become &amp; &lt; and &#91;, so that neither these
control strings nor other templates' ([INST] and the like) can occur in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "</s>"
ASSISTANT = "assistant"


def _replace(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column) -> Column:
    return _replace(c, (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")))


def unescape(c: Column) -> Column:
    return _replace(c, (("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")))


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """A row for each conversation: conv_col, formatted, loss_spans (start and length of each assistant text, in code points).

    Rows go by turn, then role, then text; null turns come first, null roles and texts read as empty, repeated
    rows stay. Rows of a null conversation form one conversation of their own. Other columns are not read.
    An empty table gives no rows.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        escape(F.coalesce(F.col(role_col).cast("string"), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
    )
    by = W.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(by)).withColumn("opens", ~F.lag("role").over(by).eqNullSafe(F.col("role")))
    head = F.when(F.col("opens"), F.length("role") + len(TURN + TEXT) + F.when(F.col("n") > 1, len(END)).otherwise(0)).otherwise(len(NEXT))
    rows = rows.withColumn("start", F.sum((head + F.length("text")).cast("long")).over(by.rowsBetween(W.unboundedPreceding, 0)) - F.length("text"))
    one = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("n", "role", "text", "opens", "start"))).alias("turns"))
    one = one.withColumn("opens", F.filter(F.transform("turns", lambda t: F.when(t["opens"], t["n"])), lambda n: n.isNotNull()))

    def merged(n: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("opens", k + 1), F.size("turns") + 1)
        own = F.slice("turns", n, stop - n)
        return F.concat(F.lit(TURN), F.get(own, F.lit(0))["role"], F.lit(TEXT), F.array_join(F.transform(own, lambda t: t["text"]), NEXT), F.lit(END))

    loss = F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: F.struct(t["start"].alias("start"), F.length(t["text"]).cast("long").alias("length")))
    return one.select(F.col("conv").alias(conv_col), F.array_join(F.transform("opens", merged), "").alias("formatted"), loss.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.slice(F.split(formatted, END, -1), 1, F.size(F.split(formatted, END, -1)) - 1)

    def turns(block: Column) -> Column:
        cut = F.split(block, r"<\|text\|>", 2)
        role = unescape(F.substring(F.get(cut, F.lit(0)), len(TURN) + 1, 1 << 30))
        return F.transform(F.split(F.get(cut, F.lit(1)), r"<\|next\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of turns and loss text, read back from formatted strings and their spans."""
    turns = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    rows = formatted.withColumn("__turns", turns).withColumn("__loss", F.array_join(loss, ""))
    return rows.select(
        conv_col,
        F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("__turns", ""), 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = """
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (select *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') as et,
             replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') as er,
             lag(role) over (partition by conv_id order by turn, role, text) as before from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length(et) + case when before is null or before <> role then length(er) + 20 else 8 end)::bigint as formatted_chars
from e group by conv_id"""
