"""Customer lifetime value: history, model inputs, prediction and tiers."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import date_from_key, date_key, number, ratio, rounded
from basketry.functions.ranking import exact_quantiles
from basketry.operators.churn import NUMERIC, churn_features, cutoff_day, stratified_split
from basketry.operators.facts import MONTH
from basketry.session import materialise

# Fixed value: the share of variance a model of coming value must exceed.
LEAST_R2 = 0.50
TIERS = ["High", "Medium", "Low"]


def clv_historical(sales: DataFrame) -> DataFrame:
    totals = sales.groupBy("CustomerKey").agg(F.sum("LineTotalAmount").alias("_v"))
    return totals.select("CustomerKey", number("_v").alias("clv_historical"))


def clv_summary_table(sales: DataFrame) -> DataFrame:
    """Inputs of the purchase-frequency models: repeat order days, days from the first to the last
    order, days from the first order to the end of the data, mean order value."""
    end = date_from_key(sales.agg(F.max("OrderDateKey")).scalar())
    orders = sales.groupBy("CustomerKey", "OrderDateKey", "SaleID").agg(F.sum("LineTotalAmount").alias("a"))
    days = orders.groupBy("CustomerKey", "OrderDateKey").agg(F.sum("a").alias("a"), F.count("*").alias("n"))
    per_customer = days.groupBy("CustomerKey").agg(
        F.count("*").alias("d"),
        F.min("OrderDateKey").alias("first"),
        F.max("OrderDateKey").alias("last"),
        F.sum("a").alias("a"),
        F.sum("n").alias("n"),
    )
    first, last = date_from_key("first"), date_from_key("last")
    return per_customer.select(
        "CustomerKey",
        (F.col("d") - 1).alias("repeat_frequency"),
        F.date_diff(last, first).alias("recency_age"),
        F.date_diff(end, first).alias("age"),
        ratio("a", "n").alias("mean_order_value"),
    )


def clv_tiers(history: DataFrame, high: float = 0.8, low: float = 0.5) -> DataFrame:
    """High above the upper quantile of value, Low up to the lower one, Medium between."""
    edges = exact_quantiles(history, "clv_historical", {"low": low, "high": high})
    top, bottom = edges.select(rounded("high", 4)).scalar(), edges.select(rounded("low", 4)).scalar()
    value = F.col("clv_historical")
    tier = F.when(value > top, "High").when(value > bottom, "Medium").otherwise("Low")
    return history.withColumn("tier", tier)


def clv_churn_matrix(tiers: DataFrame, labels: DataFrame) -> DataFrame:
    """Customers per tier who left and who stayed."""
    joined = tiers.join(labels, "CustomerKey")
    return joined.groupBy("tier").agg(
        F.count_if(F.col("label") == 1).alias("churned"), F.count_if(F.col("label") == 0).alias("active")
    )


def clv_risk_matrix(tiers: DataFrame, risk: DataFrame, limit: float = 0.5) -> DataFrame:
    """Customers per tier of value and class of risk, with their mean risk and value, from a model's risk."""
    joined = tiers.join(risk, "CustomerKey").withColumn("risk", F.when(F.col("ChurnRisk") >= limit, "at risk").otherwise("safe"))
    return joined.groupBy("tier", "risk").agg(
        F.count("*").alias("customers"), rounded(F.avg("ChurnRisk"), 4).alias("avg_risk"), rounded(F.avg("clv_historical")).alias("avg_value")
    )


def clv_by_segment(history: DataFrame, rfm: DataFrame) -> DataFrame:
    """Distribution of value per segment."""
    joined = history.join(rfm.select("CustomerKey", "Segment"), "CustomerKey")
    points = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    spread = exact_quantiles(joined, "clv_historical", points, ["Segment"])
    return spread.select("Segment", F.col("n").alias("customers"), *[rounded(p).alias(p) for p in points])


def revenue_after(sales: DataFrame, cutoff: Column) -> DataFrame:
    """Revenue per customer after a day. Only months that reach beyond it are read, and days compare as keys."""
    month = F.year(cutoff) * 100 + F.month(cutoff)
    later = sales.filter((F.col(MONTH) >= month) & (F.col("OrderDateKey") > date_key(cutoff)))
    return later.groupBy("CustomerKey").agg(number(F.sum("LineTotalAmount")).alias("future_revenue"))


def clv_table(sales: DataFrame, customers: DataFrame, days: int = 90) -> DataFrame:
    """Features up to the cutoff and, as target, the revenue after it (0 for none)."""
    after = revenue_after(sales, cutoff_day(sales, days))
    rows = churn_features(sales, customers, days).join(after, "CustomerKey", "left")
    return materialise(stratified_split(rows.na.fill(0.0, ["future_revenue"]), by=None), "clv")


def current_customers(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Every customer with the features of the last day, ready for a fitted model."""
    return VectorAssembler(inputCols=NUMERIC, outputCol="features").transform(churn_features(sales, customers, 0))


def _regressors(seed: int = 42) -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": "future_revenue"}
    return {
        "linear_regression": LinearRegression(regParam=0.1, **common),
        "boosted_trees": GBTRegressor(maxIter=15, maxDepth=3, seed=seed, **common),
    }


def fit_clv(table: DataFrame) -> tuple[DataFrame, dict[str, object]]:
    ready = VectorAssembler(inputCols=NUMERIC, outputCol="features").transform(table)
    train = ready.filter("is_train = 1").persist()
    models = {name: r.fit(train) for name, r in _regressors().items()}
    train.unpersist()
    return ready, models


def clv_model_quality(ready: DataFrame, models: dict[str, object]) -> DataFrame:
    """Share of variance explained and mean error on the customers not trained on, and whether the share exceeds
    what is asked (``LEAST_R2``)."""
    rows = []
    for name, model in models.items():
        scored = model.transform(ready.filter("is_train = 0"))
        judge = RegressionEvaluator(labelCol="future_revenue")
        r2 = float(judge.evaluate(scored, {judge.metricName: "r2"}))
        error = float(judge.evaluate(scored, {judge.metricName: "mae"}))
        rows.append((name, r2, error, int(r2 > LEAST_R2)))
    return ready.sparkSession.createDataFrame(rows, "model string, r2 double, mean_error double, passes int")


def clv_predicted(ready: DataFrame, model) -> DataFrame:
    """Predicted revenue of the coming window, never below 0."""
    scored = model.transform(ready)
    return scored.select("CustomerKey", F.greatest(F.col("prediction"), F.lit(0.0)).alias("clv_predicted"))
