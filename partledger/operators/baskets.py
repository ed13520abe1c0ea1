"""Parts claimed together: baskets, frequent itemsets, association rules.

Mining works on distinct (claim, item) rows. Items below the support limit are dropped before any basket is
built, so a basket array holds at most ``pairs / (min_support * baskets)`` items, however large the claim is.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window, functions as F

from partledger.config import DEFAULTS
from partledger.session import checkpointed

FEW_ITEMS = 32  # frequent items whose prefix trees are small anyway
MAX_PAIRS = 16  # pairs a kept row, up to which counting them is cheaper than prefix trees of rare items
ITEMSETS = "items array<string>, freq bigint, support double"
METRICS = (
    "antecedent_support",
    "consequent_support",
    "support",
    "confidence",
    "lift",
    "leverage",
    "conviction",
    "zhangs_metric",
)


def basket_items(rows: DataFrame, item: str, claim: str = DEFAULTS.claim_id) -> DataFrame:
    """Distinct ``claim, item`` rows."""
    return rows.where(F.col(claim).isNotNull()).select(F.col(claim).alias("claim"), F.col(item).alias("item")).distinct()


def multi_item(pairs: DataFrame) -> DataFrame:
    """Only the claims with more than one distinct item."""
    size = F.count(F.lit(1)).over(Window.partitionBy("claim"))
    return pairs.where(F.col("claim").isNotNull()).withColumn("_n", size).where("_n > 1").drop("_n")


def collect_baskets(pairs: DataFrame) -> DataFrame:
    """One sorted item array per claim."""
    return pairs.groupBy("claim").agg(F.array_sort(F.collect_list("item")).alias("items"))


@dataclass
class Itemsets:
    """``table``: items, freq, support; ``baskets``: number of multi-item baskets they were counted in."""

    table: DataFrame
    baskets: int


def frequent_itemsets(pairs: DataFrame, min_support: float = DEFAULTS.min_support) -> Itemsets:
    """All itemsets with ``freq / baskets >= min_support``; ``pairs`` come from ``multi_item``."""
    spark = pairs.sparkSession
    pairs = checkpointed(pairs)
    baskets = pairs.select("claim").distinct().count()
    empty = Itemsets(spark.createDataFrame([], ITEMSETS), baskets)
    if baskets == 0:
        return empty
    support = F.col("freq") / F.lit(float(baskets))
    frequent = checkpointed(pairs.groupBy("item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("item").isNotNull() & (support >= min_support)))
    kept = pairs.join(frequent.select("item"), "item", "left_semi")
    arrays = checkpointed(kept.groupBy("claim").agg(F.collect_list("item").alias("items")))
    singles = frequent.select(F.array("item").alias("items"), "freq")
    if frequent.count() > FEW_ITEMS:
        arrays = _of_frequent_pairs(arrays, min_support * baskets)
    else:
        arrays = arrays.where(F.size("items") > 1)
    rows = arrays.count()
    found = singles
    if rows:
        limit = min(1.0, max(0.0, min_support * baskets / rows - 1e-9))
        model = FPGrowth(itemsCol="items", minSupport=limit).fit(arrays)
        larger = model.freqItemsets.where(F.size("items") > 1)
        found = singles.unionByName(larger.select(F.array_sort("items").alias("items"), F.col("freq").cast("long").alias("freq")))
    return Itemsets(checkpointed(found.withColumn("support", support).where(F.col("support") >= min_support)), baskets)


def _of_frequent_pairs(arrays: DataFrame, least: float) -> DataFrame:
    """Baskets of those items alone that some other item accompanies ``least`` times; no larger itemset has any other.

    Prefix trees of many rare items are as large as the table. Pairs are counted first, if baskets are short enough for that.
    """
    size = F.size("items").cast("double")
    cost = arrays.agg(F.sum(size).alias("items"), F.sum(size * (size - 1) / 2).alias("pairs")).first()
    if not cost["items"] or cost["pairs"] > MAX_PAIRS * cost["items"]:
        return arrays.where(F.size("items") > 1)
    ordered = arrays.select(F.array_sort("items").alias("items"))
    later = F.transform("items", lambda x, i: F.transform(F.slice("items", i + 2, F.size("items")), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    pairs = ordered.select(F.explode(F.flatten(later)).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))
    company = checkpointed(pairs.where(F.col("n") >= least - 1e-9 * least).select(F.explode(F.array("a", "b")).alias("item")).distinct())
    if company.isEmpty():
        return arrays.limit(0)
    items = arrays.select("claim", F.explode("items").alias("item")).join(company, "item", "left_semi")
    return checkpointed(items.groupBy("claim").agg(F.collect_list("item").alias("items")).where(F.size("items") > 1))


def association_rules(
    itemsets: DataFrame,
    min_confidence: float = DEFAULTS.min_confidence,
    min_lift: float | None = DEFAULTS.min_lift,
) -> DataFrame:
    """Splits of every itemset into antecedent and consequent that reach the confidence, with their metrics.

    Consequents grow item by item (Agrawal and Srikant 1994): where one fails the confidence, larger ones of the same
    itemset fail too, so only splits next to a rule are ever looked at.
    """

    def supports(side: str, name: str) -> DataFrame:
        return itemsets.select(F.col("items").alias(side), F.col("support").alias(name))

    a, c, s = F.col("antecedent_support"), F.col("consequent_support"), F.col("support")
    conf, lev = F.col("confidence"), F.col("leverage")
    worst = F.greatest(s * (1 - a), a * (c - s))
    several = itemsets.where(F.size("items") > 1).select("items", "support")
    level = several.withColumn("consequents", F.explode(F.transform("items", lambda x: F.array(x))))
    found = []
    while True:
        sides = level.withColumn("antecedents", F.array_except("items", "consequents"))
        sure = sides.join(supports("antecedents", "antecedent_support"), "antecedents").withColumn("confidence", s / a)
        found.append(checkpointed(sure.where(conf >= min_confidence)))
        longer = found[-1].where(F.size("antecedents") > 1).select("items", "support", "consequents")
        if longer.isEmpty():
            break
        more = F.filter("items", lambda x: x > F.element_at("consequents", -1))
        level = longer.withColumn("_item", F.explode(more)).select(
            "items", "support", F.concat("consequents", F.array("_item")).alias("consequents")
        )
    sides = functools.reduce(DataFrame.unionByName, found)
    rules = (
        sides.join(supports("consequents", "consequent_support"), "consequents")
        .withColumn("lift", conf / c)
        .withColumn("leverage", s - a * c)
        .withColumn("conviction", F.when(conf < 1, (1 - c) / (1 - conf)).otherwise(F.lit(float("inf"))))
        .withColumn("zhangs_metric", F.when(worst == 0, F.lit(0.0)).otherwise(lev / worst))
        .select("antecedents", "consequents", *METRICS)
    )
    return rules if min_lift is None else rules.where(F.col("lift") >= min_lift)


def sort_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedents", "consequents")


def itemset_text(items: str) -> F.Column:
    return F.array_join(F.array_sort(items), ", ")


def export_itemsets(itemsets: DataFrame) -> DataFrame:
    return itemsets.select(itemset_text("items").alias("itemsets"), "freq", "support")


def export_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        itemset_text("antecedents").alias("antecedents"), itemset_text("consequents").alias("consequents"), *METRICS
    )


def rules_summary(itemsets: DataFrame, rules: DataFrame) -> DataFrame:
    """One row of counts, means and the highest lift; null means for no rules."""

    def four(value: F.Column) -> F.Column:
        return F.round(value.cast("decimal(20,8)"), 4).cast("double")

    return rules.agg(
        F.count(F.lit(1)).alias("num_rules"),
        four(F.avg("confidence")).alias("avg_confidence"),
        four(F.avg("lift")).alias("avg_lift"),
        four(F.avg("support")).alias("avg_support"),
        four(F.max("lift")).alias("max_lift"),
    ).withColumn("num_frequent_itemsets", itemsets.select(F.count(F.lit(1))).scalar())
