"""Record modalities: tiers, triplets, cards, calculators and order rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.columns import any_word, ladder
from .ordered import positions


def tier(text: Column) -> Column:
    """The third tier's words are tested before the first's."""
    t = F.lower(text)
    return ladder([("Tier 3", any_word(t, P.TIER3_WORDS)), ("Tier 1", any_word(t, P.TIER1_WORDS))], "Tier 2")


def curriculum(records: DataFrame, bridge: DataFrame) -> DataFrame:
    """Records (record_id, title, domain, condition) with tier and reference; the last bridge row of a record counts."""
    last = bridge.withColumn("n", F.row_number().over(W.partitionBy("record_id").orderBy(F.desc("ord")))).where("n = 1").select("record_id", F.concat("chapter", F.lit(" ("), "chapter_title", F.lit(")")).alias("reference"))
    rows = records.withColumn("tier", tier(F.concat_ws(" ", "title", "domain", "condition"))).join(last, "record_id", "left")
    return rows.select("record_id", "title", "tier", F.coalesce("reference", F.lit("General Internal Medicine")).alias("reference"))


def triplets(claims: DataFrame, fixed: DataFrame) -> DataFrame:
    """Claims (claim_id, disease, claim_type, claim_text) as edges by type, with a fixed set appended."""
    kind = F.when(F.col("claim_type") == "CONTRAINDICATION", "CONTRAINDICATES").when(F.col("claim_type").isin("DIFFERENTIAL", "DIAGNOSIS"), "DIAGNOSTIC_PATHWAY").when(F.col("claim_type") == "TREATMENT", "TREATED_BY")
    subject = F.coalesce(F.nullif(F.trim("disease"), F.lit("")), F.lit("General Condition"))
    rows = claims.select(F.col("claim_id").alias("source_id"), subject.alias("subject"), kind.alias("predicate"), F.substring(F.trim("claim_text"), 1, 120).alias("object")).where("predicate is not null")
    return rows.unionByName(fixed)


def cards(claims: DataFrame) -> DataFrame:
    """(card_id, front, back): a cloze a claim, numbered in claim order."""
    rows = positions(claims, ["claim_id"], "n").withColumn("n", F.col("n") + 1)
    front = F.when(F.col("claim_type") == "CONTRAINDICATION", F.concat(F.lit("Contraindicated in "), "disease", F.lit(": {{c1::...}}"))).otherwise(F.concat("disease", F.lit(": {{c1::...}}")))
    return rows.select(F.format_string("CARD-%04d", "n").alias("card_id"), front.alias("front"), F.col("claim_text").alias("back"))


def fluids(weight: Column) -> Column:
    """struct of daily maintenance, deficit, 48-hour total, hourly rate and drops a minute; below 20 kg maintenance is weight x 100."""
    daily = F.when(weight > 20, F.lit(1500.0) + (weight - 20) * 20).otherwise(weight * 100.0)
    deficit, total = weight * 50.0, daily * 2 + weight * 50.0
    return F.struct(daily.alias("daily"), deficit.alias("deficit"), total.alias("total"), F.round(total / 48, 4).alias("hourly"), F.round(total / 144, 4).alias("drops"))


def anion_gap(na: Column, cl: Column, hco3: Column) -> Column:
    gap = na - (cl + hco3)
    return F.struct(gap.alias("gap"), F.when(gap > 12, "HAGMA").otherwise("NAGMA").alias("result"))


def mentzer(mcv: Column, rbc: Column) -> Column:
    index = F.try_divide(mcv, rbc)
    return F.struct(F.round(index, 4).alias("index"), F.when(index < 13, "thalassemia trait").when(index >= 13, "iron deficiency").alias("result"))


def drop_rates(rate: Column) -> Column:
    """Drops a minute of the three giving sets."""
    return F.struct(F.round(rate / 3, 4).alias("standard"), F.round(rate / 4, 4).alias("blood"), rate.alias("micro"))


def first_rule(orders: DataFrame, rules: list[tuple[str, list[str]]], text_col: str) -> DataFrame:
    """The first rule, in order, all of whose words an order contains, else PERMITTED."""
    t = F.lower(F.col(text_col))
    return orders.withColumn("rule", ladder([(name, F.forall(F.array(*map(F.lit, words)), lambda w: F.contains(t, w))) for name, words in rules], "PERMITTED"))
