"""Distributions: clipping, histograms, skewness, box plots and the concentration curve."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import col, rounded
from basketry.functions.quantiles import exact_points
from basketry.functions.ranking import running_total


def quantile(df: DataFrame, value: Column | str, p: float) -> Column:
    """One exact quantile as a constant; null when there are no values."""
    found, _ = exact_points(df, {"v": col(value)}, {"q": p})
    return F.lit(found["v"]["q"]).cast("double")


def log1p(c: Column | str) -> Column:
    return F.log1p(col(c).cast("double"))


def clip_at(df: DataFrame, value: str, p: float, name: str) -> DataFrame:
    """Values above the quantile become the quantile."""
    edge = quantile(df, value, p)
    v = F.col(value).cast("double")
    return df.withColumn(name, F.when(v > edge, edge).otherwise(v))


def keep_upto(df: DataFrame, value: str, p: float, positive_only: bool = False) -> DataFrame:
    """Rows whose value is at most the quantile, taken over the positive values if so asked."""
    rows = df.filter(F.col(value) > 0) if positive_only else df.filter(F.col(value).isNotNull())
    return rows.filter(F.col(value).cast("double") <= quantile(rows, value, p))


def histogram(df: DataFrame, value: Column | str, bins: int) -> DataFrame:
    """Rows in equal-width bins between the least and the greatest value, empty bins included.

    Bins are closed on the left, the last one on both sides."""
    values = df.select(col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    span = values.agg(F.min("v").alias("a"), F.max("v").alias("b"))
    flat = F.col("a") == F.col("b")
    span = span.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    place = F.floor((F.col("v") - lo) * float(bins) / (hi - lo)) + 1
    counted = values.groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    step = (hi - lo) / float(bins)
    full = spine.join(counted, "bin", "left")
    return full.select(
        "bin",
        rounded(lo + (F.col("bin") - 1) * step, 4).alias("lower"),
        rounded(lo + F.col("bin") * step, 4).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )


def skewness(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Population skewness per labelled expression."""
    stats = df.agg(*[rounded(F.skewness(e.cast("double")), 4).alias(name) for name, e in values.items()])
    return stats.unpivot([], list(values), "measure", "skewness")


def medians(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    found, _ = exact_points(df, values, {"median": 0.5})
    rows = [(n, q["median"]) for n, q in found.items()]
    return df.sparkSession.createDataFrame(rows, "measure string, median double").withColumn("median", rounded("median", 4))


def boxplot(df: DataFrame, value: Column, by: str, most: int = 1000) -> DataFrame:
    """Quartiles, whiskers and outliers per group. Whiskers end at the last value within one and a
    half quartile ranges. Every group is a column of its own for the quartiles, and the fences are constants,
    so no row is moved; ``by`` may have at most ``most`` values."""
    rows = df.select(by, value.cast("double").alias("v")).filter("v IS NOT NULL")
    groups = [r[0] for r in rows.select(by).distinct().limit(most + 1).collect()]
    if len(groups) > most:
        raise ValueError(f"{by} has more than {most} values")
    own = {str(i): F.when(F.col(by).eqNullSafe(F.lit(g)), F.col("v")) for i, g in enumerate(groups)}
    box, _ = exact_points(rows, own, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    kinds = rows.schema[by].dataType.simpleString()
    fences = []
    for i, g in enumerate(groups):
        reach = (box[str(i)]["q3"] - box[str(i)]["q1"]) * 1.5
        fences.append((F.col(by).eqNullSafe(F.lit(g)), box[str(i)]["q1"] - reach, box[str(i)]["q3"] + reach))
    inside = reduce(or_, [is_g & F.col("v").between(low, high) for is_g, low, high in fences], F.lit(False))
    counted = rows.groupBy(by).agg(
        F.count("*").alias("rows"),
        rounded(F.min(F.when(inside, F.col("v"))), 4).alias("whisker_low"),
        rounded(F.max(F.when(inside, F.col("v"))), 4).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    shown = df.sparkSession.createDataFrame([(g, *box[str(i)].values()) for i, g in enumerate(groups)], f"_g {kinds}, q1 double, q2 double, q3 double")
    return counted.join(shown, F.col(by).eqNullSafe(F.col("_g"))).select(
        by, "rows", *[rounded(q, 4).alias(q) for q in ("q1", "q2", "q3")], "whisker_low", "whisker_high", "outliers"
    )


def pareto_curve(customers: DataFrame, value: str, key: str) -> DataFrame:
    """Customers by falling value with the cumulative share of customers and of value."""
    run = running_total(customers.select(key, value), [F.desc(value), key], value, "run")
    percent = lambda a, b: F.col(a).cast("double") * 100.0 / F.col(b).cast("double")
    return run.select(
        key,
        F.col("run_rank").alias("rank"),
        rounded(percent("run_rank", "run_rows"), 6).alias("cum_pct_customers"),
        rounded(percent("run", "run_total"), 6).alias("cum_pct_revenue"),
    )


def pareto_point(curve: DataFrame, revenue_pct: float = 80.0) -> DataFrame:
    """Share of customers needed for the given share of revenue."""
    reached = curve.filter(F.col("cum_pct_revenue") >= revenue_pct)
    return reached.agg(F.min("cum_pct_customers").alias("pct_customers"))


__all__: Sequence[str] = [
    "boxplot", "clip_at", "histogram", "keep_upto", "log1p", "medians", "pareto_curve", "pareto_point", "quantile", "skewness",
]
