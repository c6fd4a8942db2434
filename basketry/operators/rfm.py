"""Recency, frequency and monetary scoring, segments and reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import MONEY, date_from_key, is_named, number, ratio, rounded, share
from basketry.functions.ranking import number_rows, small_quantiles

SEGMENTS = ["At risk", "Champions", "Hibernating", "Loyal", "Other"]


def money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def rfm_base(sales: DataFrame) -> DataFrame:
    """Per customer: days from the last order to the last order of all, orders, amount spent."""
    latest = date_from_key(sales.agg(F.max("OrderDateKey")).scalar())
    per_customer = sales.groupBy("CustomerKey").agg(
        F.max("OrderDateKey").alias("_last"),
        F.count_distinct("SaleID").alias("Frequency"),
        F.sum("LineTotalAmount").alias("Monetary"),
    )
    return per_customer.select(
        "CustomerKey", F.date_diff(latest, date_from_key("_last")).alias("Recency"), "Frequency", "Monetary"
    )


def recency_quartile(df: DataFrame) -> Column:
    """4 for the most recent quarter down to 1. Edges are value quartiles, each bin closed on the
    right; where edges coincide a value takes the lowest bin it fits."""
    edges = small_quantiles(df, "Recency", [0.25, 0.5, 0.75])
    below = [F.col("Recency") <= F.element_at(edges, i) for i in (1, 2, 3)]
    return F.when(below[0], 4).when(below[1], 3).when(below[2], 2).otherwise(1)


def rank_quartile(rank: str, rows: Column) -> Column:
    """Quartile of a first-come rank among ``rows``: the value quartiles of the ranks 1..n. This is
    not ``ntile``: bins are closed on the right of interpolated edges."""
    k = F.col(rank) - 1
    q = F.floor((k * 4 + rows - 2) / F.greatest(rows - 1, F.lit(1))).cast("int")
    return F.when(rows <= 1, 1).otherwise(F.greatest(q, F.lit(1)))


def rfm_quartiles(base: DataFrame) -> DataFrame:
    """Add ``R_quartile``, ``F_quartile`` and ``M_quartile``. Ties go by customer key."""
    ranked = number_rows(base, ["Frequency", "CustomerKey"], "_f")
    ranked = number_rows(ranked, ["Monetary", "CustomerKey"], "_m")
    rows = ranked.agg(F.count("*")).scalar()
    return ranked.select(
        "CustomerKey",
        "Recency",
        "Frequency",
        "Monetary",
        recency_quartile(ranked).alias("R_quartile"),
        rank_quartile("_f", rows).alias("F_quartile"),
        rank_quartile("_m", rows).alias("M_quartile"),
    )


def segment_label() -> Column:
    """Ordered rules. ``Loyal`` cannot be reached: with r >= 3 such a customer is a champion,
    with r <= 2 at risk. The order is kept as specified."""
    r, f, m = F.col("R_quartile"), F.col("F_quartile"), F.col("M_quartile")
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), "Champions")
        .when((r <= 2) & (f <= 2), "Hibernating")
        .when(r <= 2, "At risk")
        .when((f >= 3) & (m >= 3), "Loyal")
        .otherwise("Other")
    )


def rfm_score() -> Column:
    return F.concat(*[F.col(f"{x}_quartile").cast("string") for x in "RFM"])


def rfm_segments(base: DataFrame) -> DataFrame:
    scored = rfm_quartiles(base).withColumn("RFM_score", rfm_score())
    return scored.withColumn("Segment", segment_label())


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("Segment").agg(F.count("*").alias("customers"))


def _means() -> list[Column]:
    n = F.count("*")
    return [ratio(F.sum(c), n).alias(f"avg_{c.lower()}") for c in ("Recency", "Frequency", "Monetary")]


def segment_means(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("Segment").agg(*_means())


def segment_profile(named: DataFrame) -> DataFrame:
    return named.groupBy("Segment").agg(*_means(), F.count("*").alias("customers"))


def segment_revenue_share(rfm: DataFrame) -> DataFrame:
    per_segment = rfm.groupBy("Segment").agg(F.sum("Monetary").alias("_s"))
    total = F.sum("_s").over(Window.partitionBy())
    return per_segment.select("Segment", number("_s").alias("revenue"), share("_s", total).alias("revenue_pct"))


def with_customers(rfm: DataFrame, customers: DataFrame) -> DataFrame:
    """RFM rows with names, region and sector; customers unknown to the dimension keep nulls."""
    attributes = ["AccountID", "AccountName", "RegionDescription", "SectorDescription"]
    return rfm.join(customers.select("CustomerKey", *attributes), "CustomerKey", "left")


def named_customers(joined: DataFrame) -> DataFrame:
    return joined.filter(is_named("AccountName"))


def top_customers(named: DataFrame, by: str, n: int = 10) -> DataFrame:
    best = named.orderBy(F.desc(by), "CustomerKey").limit(n)
    return best.select("CustomerKey", "AccountName", number(by).alias(by.lower()))


def region_segment_pivot(joined: DataFrame, top: int = 15) -> DataFrame:
    """Customers of the largest regions by segment, absent combinations as 0.

    One aggregate by region and segment gives both the cells and the totals."""
    cells = joined.filter("RegionDescription IS NOT NULL").groupBy("RegionDescription")
    pivot = cells.pivot("Segment", SEGMENTS).count().na.fill(0)
    total = sum((F.col(f"`{s}`") for s in SEGMENTS), F.lit(0))
    best = pivot.withColumn("customers", total).orderBy(F.desc("customers"), "RegionDescription").limit(top)
    names = {s: s.lower().replace(" ", "_") for s in SEGMENTS}
    return best.select("RegionDescription", *[F.col(f"`{s}`").alias(n) for s, n in names.items()], "customers")


def correlation(rfm: DataFrame, digits: int = 4) -> DataFrame:
    """Pearson matrix of the three measures, one row per measure, from one aggregate."""
    measures = ["Recency", "Frequency", "Monetary"]
    pairs = [(a, b) for i, a in enumerate(measures) for b in measures[i + 1 :]]
    stats = rfm.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(a + b) for a, b in pairs])

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        x, y = sorted((a, b), key=measures.index)
        return rounded(F.col(x + y), digits)

    rows = [F.struct(F.lit(a).alias("measure"), *[cell(a, b).alias(b.lower()) for b in measures]) for a in measures]
    return stats.select(F.inline(F.array(*rows)))
