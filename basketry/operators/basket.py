"""Market baskets: itemsets and rules."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import rounded
from basketry.operators.similarity import shared_pairs
from basketry.session import materialise


def basket_lines(sales: DataFrame, item: str = "ProductKey") -> DataFrame:
    """Distinct (order, item). Whatever a single order holds, it is at most the catalogue."""
    return sales.select("SaleID", F.col(item).alias("item")).distinct()


def basket_items(sales: DataFrame) -> DataFrame:
    """Items per order as a sorted array."""
    baskets = basket_lines(sales).groupBy("SaleID").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return baskets.withColumn("item_count", F.size("items"))


def pair_rules(sales: DataFrame, min_count: int = 2, limit: int = 200) -> DataFrame:
    """Two-item rules: support, confidence both ways and lift of every pair bought together in at
    least ``min_count`` orders. Items in fewer orders cannot be in such a pair and are left out
    before pairing."""
    lines = materialise(basket_lines(sales), "baskets")
    orders = lines.agg(F.count_distinct("SaleID")).scalar()
    counts = lines.groupBy("item").agg(F.count("*").alias("c")).filter(F.col("c") >= min_count)
    frequent = lines.join(counts.select("item"), "item", "left_semi")
    named = frequent.select(F.col("item").alias("entity"), F.col("SaleID").alias("feature"), F.lit(1).alias("weight"))
    triples = materialise(named, "triples")
    pairs = shared_pairs(triples, min_count=min_count, limit=limit)
    a = counts.select(F.col("item").alias("a"), F.col("c").alias("ca"))
    b = counts.select(F.col("item").alias("b"), F.col("c").alias("cb"))
    joined = pairs.join(a, "a").join(b, "b").withColumn("n", orders)
    d = lambda c: F.col(c).cast("double")
    return joined.select(
        F.col("a").alias("item_a"),
        F.col("b").alias("item_b"),
        F.col("dot").cast("long").alias("orders_both"),
        rounded(d("dot") / d("n"), 8).alias("support"),
        rounded(d("dot") / d("ca"), 6).alias("confidence_ab"),
        rounded(d("dot") / d("cb"), 6).alias("confidence_ba"),
        rounded(d("dot") * d("n") / (d("ca") * d("cb")), 6).alias("lift"),
    )


def bundle_candidates(rules: DataFrame, min_lift: float = 1.0, min_orders: int = 2) -> DataFrame:
    """Pairs worth bundling: bought together more often than chance, and often enough."""
    kept = rules.filter((F.col("lift") > min_lift) & (F.col("orders_both") >= min_orders))
    return kept.select("item_a", "item_b", "orders_both", "support", "lift")


#: Orders that must share a set, however few there are.
LEAST_ORDERS = 2


def itemset_model(sales: DataFrame, min_support: float = 0.001, min_confidence: float = 0.1):
    """FP-Growth over the baskets. The threshold is a share of the orders, so it keeps its meaning at any size, but
    ``LEAST_ORDERS`` at least: what one order holds is no pattern, and every subset of a large order would be one.
    Every set that reaches the threshold is found."""
    baskets = materialise(basket_items(sales).select("items"), "baskets")
    orders = baskets.count()
    # Half an order below the least number that reaches the share, so that rounding does not lose a set.
    support = (max(math.ceil(min_support * orders), LEAST_ORDERS) - 0.5) / max(orders, 1)
    return FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)


def as_text(items: str) -> Column:
    return F.array_join(F.array_sort(items), ",")


def frequent_itemsets(model) -> DataFrame:
    return model.freqItemsets.select(as_text("items").alias("items"), F.size("items").alias("length"), F.col("freq").alias("orders"))


def association_rules(model, min_lift: float = 1.0) -> DataFrame:
    """Rules with one item on the right. ``lift`` above the minimum."""
    rules = model.associationRules.filter(F.col("lift") > min_lift)
    return rules.select(
        as_text("antecedent").alias("antecedent"),
        as_text("consequent").alias("consequent"),
        rounded("confidence", 6).alias("confidence"),
        rounded("lift", 6).alias("lift"),
        rounded("support", 8).alias("support"),
    )


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), "antecedent", "consequent").limit(n)
