"""The training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination

    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import toxicity
    from .langid import held_out

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _read(spark, sf_dir, "labels"), allowed=~held_out("doc_id", 4))
    scored = toxicity.score(docs, model).withColumn("held_out", held_out("doc_id", 4))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out("doc_id", 4)))
    return langid.predict(docs, model).withColumn("held_out", langid.held_out("doc_id", 4))


URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import Rule, judge

    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages, [Rule(*r) for r in URL_RULES]).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def with_links(pages: DataFrame) -> DataFrame:
    """The pages, each with links to the urls of two others; the given pages hold no links between hosts."""
    from pyspark.sql import functions as F

    n = pages.agg(F.max("page_id")).first()[0]
    n = (n or 0) + 1
    urls = pages.select(F.col("page_id").alias("__to"), F.col("url").alias("__url"))
    out = pages
    for a, b in ((3, 1), (5, 2)):
        out = out.withColumn("__to", (F.col("page_id") * a + b) % n).join(urls, "__to", "left")
        link = F.when(F.col("__url").contains("://"), F.concat(F.lit('<a href="'), "__url", F.lit('">'))).otherwise("")
        out = out.withColumn("html", F.concat(F.coalesce("html", F.lit("")), F.coalesce(link, F.lit("")))).drop("__to", "__url")
    return out


def linked_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL filter over pages that link to each other, so that trust and distrust travel."""
    from .url_filter import Rule, judge

    pages = with_links(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judge(pages, [Rule(*r) for r in URL_RULES]).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_boilerplate

    return drop_boilerplate(_read(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lm
    from .langid import held_out

    docs = _read(spark, sf_dir, "documents")
    return lm.score(docs, ~held_out("doc_id", 7)).withColumn("held_out", held_out("doc_id", 7))


def tokenizer_path() -> str:
    """The vocabulary file; TEXTLOOM_TOKENIZER overrides the installed one."""
    import os

    import public_tokenizers

    return os.environ.get("TEXTLOOM_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .pack import pack, tokenise

    pieces = tokenise(_read(spark, sf_dir, "documents"), tokenizer_path())
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import digests, format_conversations

    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", extra), (-7, 1, "assistant", extra)], turns.schema)
    return digests(format_conversations(turns.union(extra)))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .elkan import cluster

    return cluster(_read(spark, sf_dir, "embeddings"), k=16, rounds=3).drop("calculated")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie import prefix_trie

    return prefix_trie(_read(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_toxicity": op3_toxicity,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_url_filter": op6_url_filter,
    "linked_url_filter": linked_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_chat_format": op10_chat_format,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}


NGRAM_ORACLE = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as t from documents),
s as (select doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(t) - 3, 2)), lambda i: array_to_string(t[i:i + 4], ' ')))) as g from w where len(t) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select c.a, c.b from c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * k >= 75 * (x.n + y.n - k)),
r(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from r join l on l.a = r.b),
m as (select a, min(b) as component_id from r group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id, m.component_id = d.doc_id as kept from documents d left join n on n.doc_id = d.doc_id join m on m.a = d.doc_id"""

EMBEDDING_ORACLE = """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null),
u as (select *, sqrt(list_dot_product(e, e)) as z from v),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id where list_dot_product(a.e, b.e) / (a.z * b.z) >= 0.98),
r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on l.a = r.b),
m as (select a, min(b) as component_id from r group by a), n as (select a, count(*) as n from l group by a)
select x.vec_id, coalesce(n.n, 0) as n_links, m.component_id, m.component_id = x.vec_id as kept from embeddings x left join n on n.a = x.vec_id join m on m.a = x.vec_id"""


def _oracles() -> dict[str, str]:
    from . import chat, elkan, line_dedup, quality, trie

    return {"op11_centroid_clustering": elkan.oracle(), "op12_prefix_trie": trie.ORACLE, "op13_quality_rules": quality.oracle(), "op2_ngram_jaccard": NGRAM_ORACLE, "op4_embedding_near_dedup": EMBEDDING_ORACLE, "op7_line_dedup": line_dedup.oracle(), "op10_chat_format": chat.ORACLE}


#: No SQL where the method is a learnt model or the comparison is too slow on whole tables; tests/llm holds those against brute force.
ORACLE_SQL: dict[str, str] = _oracles()
