"""Names of one or more words in texts, by a trie of name prefixes that meets the texts' words level by level.

A text becomes rows of a word with what stands between it and its neighbours; the text itself stays behind. A
prefix of a name up to its k-th word is a node; a place that has reached a node goes on to
the next word only if the prefix so lengthened is a node too. Gaps are part of a prefix, so
spacing and punctuation inside a name have to agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WORD, GAP = "[A-Za-z0-9_]+", "[^A-Za-z0-9_]*"


def words_with_gaps(text: Column) -> Column:
    """Array of (word, before, after, next): every word of a text with what stands around it; the last word has a null next."""
    get = lambda k: F.regexp_extract_all(text, F.lit(f"({WORD})({GAP})"), F.lit(k))
    words, after = get(1), get(2)
    before = F.slice(F.concat(F.array(F.regexp_extract(text, f"^({GAP})", 1)), after), 1, F.size(words))
    return F.arrays_zip(words.alias("word"), before.alias("before"), after.alias("after"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("next"))


def prefixes(names: DataFrame) -> DataFrame:
    """(name, level, node, word, lead, tail): a row for each word of each name; node is the name up to it without its lead."""
    rows = names.select("name", F.regexp_extract("name", f"^({GAP})", 1).alias("lead"), words_with_gaps(F.col("name")).alias("w"))
    rows = rows.select("name", "lead", F.posexplode("w").alias("k", "s"), F.transform("w", lambda s: F.concat(s["word"], s["after"])).alias("all"))
    node = F.concat(F.array_join(F.slice("all", 1, F.col("k")), ""), F.col("s.word"))
    return rows.select("name", (F.col("k") + 1).alias("level"), node.alias("node"), F.col("s.word").alias("word"), "lead", F.when(F.col("s.next").isNull(), F.col("s.after")).alias("tail"))


def occurrences(names: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(name, id_col): the texts that hold each name (column `name`) with no word character right beside it. A name without a word character is found nowhere.

    A name that starts or ends in other characters needs a further such character, or the text's edge, beside it.
    """
    names = names.select("name").where("name is not null").distinct()
    plain = names.where(F.col("name").rlike(f"^{WORD}$"))
    longer = _placed(names.where(~F.col("name").rlike(f"^{WORD}$")), texts, id_col, text_col)
    # a name of one whole word needs no gaps or places, only the distinct words of a text
    words = texts.select(id_col, F.explode(F.array_distinct(F.split(F.col(text_col), "[^A-Za-z0-9_]+"))).alias("name"))
    found = words.join(plain, "name").select("name", id_col).distinct()
    return found if longer is None else found.unionByName(longer)


def _placed(names: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """`occurrences` of distinct names of several words or with other characters; None where there are no such names."""
    trie = prefixes(names)
    depth = trie.agg(F.coalesce(F.max("level"), F.lit(0)).alias("d")).first().d
    words = texts.select(F.col(id_col).alias("__id"), F.posexplode(words_with_gaps(F.col(text_col))).alias("pos", "w"))
    words = words.select("__id", "pos", "w.word", "w.before", "w.after", (F.col("pos") == 0).alias("first"), F.col("w.next").isNull().alias("last"))
    # words that no name has cannot be part of a match
    words = words.join(trie.select("word").distinct(), "word", "left_semi")
    found, reached = None, None
    for level in range(1, depth + 1):
        nodes = trie.where(F.col("level") == level)
        if reached is None:
            here = words.withColumn("node", F.col("word")).withColumn("opening", F.struct("before", "first"))
        else:
            following = words.select("__id", (F.col("pos") - 1).alias("pos"), F.col("word").alias("next"), F.col("after").alias("then"), F.col("last").alias("ends"))
            here = reached.join(following, ["__id", "pos"]).select("__id", (F.col("pos") + 1).alias("pos"), F.concat("node", "after", "next").alias("node"), F.col("then").alias("after"), F.col("ends").alias("last"), "opening")
        here = here.join(nodes.select("node").distinct(), "node", "left_semi").select("__id", "pos", "node", "after", "last", "opening")
        # only places whose gap some longer name has as well go on
        onward = trie.where(F.col("level") == level + 1).select(F.expr("left(node, length(node) - length(word))").alias("onward")).distinct()
        reached = here.join(onward, F.concat("node", "after") == F.col("onward"), "left_semi")
        own = here.join(nodes.where("tail is not null").select("node", "name", "lead", "tail"), "node")
        before, after = F.col("opening.before"), F.col("after")
        opens = (F.col("lead") == "") | (F.endswith(before, F.col("lead")) & ((F.length(before) > F.length("lead")) | F.col("opening.first")))
        shuts = (F.col("tail") == "") | (F.startswith(after, F.col("tail")) & ((F.length(after) > F.length("tail")) | F.col("last")))
        hits = own.where(opens & shuts).select("name", F.col("__id").alias(id_col))
        found = hits if found is None else found.unionByName(hits)
    return found if found is None else found.distinct()


def first_of_each(rows: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first `most` rows of each group; every task lets through no more than that of a group before rows are shuffled."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= most)
