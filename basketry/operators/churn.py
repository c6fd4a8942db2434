"""Churn: label, features, models and their evaluation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import date_from_key, number, ratio, rounded
from basketry.functions.ranking import number_rows
from basketry.session import materialise
from basketry.specs import UNKNOWN_TEXT

# What is asked of a churn model, as least values that must be exceeded.
GATES = {"auc": 0.70, "recall": 0.60}

NUMERIC = ["recency", "frequency", "monetary", "avg_order_value", "avg_days_between_orders", "total_products"]
CATEGORIES = ["region", "sector"]


def cutoff_day(sales: DataFrame, days: int = 90) -> Column:
    """The day ``days`` before the last order: features look back from it, the label looks ahead."""
    return F.date_sub(date_from_key(sales.agg(F.max("OrderDateKey")).scalar()), days)


def churn_label(sales: DataFrame, days: int = 90) -> DataFrame:
    """Customers with an order up to the cutoff; 1 where none followed in the window after it."""
    cutoff = cutoff_day(sales, days)
    day = date_from_key("OrderDateKey")
    orders = sales.groupBy("CustomerKey").agg(
        F.count_if(day <= cutoff).alias("before"), F.count_if(day > cutoff).alias("after")
    )
    known = orders.filter("before > 0")
    return known.select("CustomerKey", (F.col("after") == 0).cast("int").alias("label"))


def churn_features(sales: DataFrame, customers: DataFrame, days: int = 90) -> DataFrame:
    """Behaviour up to the cutoff. Nothing after it enters, else recency would be the label."""
    cutoff = cutoff_day(sales, days)
    seen = sales.filter(date_from_key("OrderDateKey") <= cutoff)
    orders = seen.groupBy("CustomerKey", "SaleID").agg(
        F.max("OrderDateKey").alias("k"), F.min("OrderDateKey").alias("k0"), F.sum("LineTotalAmount").alias("a")
    )
    per_customer = orders.groupBy("CustomerKey").agg(
        F.max("k").alias("last"), F.min("k0").alias("first"), F.count("*").alias("frequency"), F.sum("a").alias("m")
    )
    products = seen.select("CustomerKey", "ProductKey").distinct().groupBy("CustomerKey").agg(
        F.count("*").alias("total_products")
    )
    last, first = date_from_key("last"), date_from_key("first")
    gap = F.try_divide(F.date_diff(last, first).cast("double"), (F.col("frequency") - 1).cast("double"))
    place = customers.select("CustomerKey", "RegionDescription", "SectorDescription")
    return (
        per_customer.join(products, "CustomerKey")
        .join(place, "CustomerKey", "left")
        .select(
            "CustomerKey",
            F.date_diff(cutoff, last).alias("recency"),
            "frequency",
            number("m").alias("monetary"),
            ratio("m", "frequency").alias("avg_order_value"),
            F.coalesce(rounded(gap, 4), F.lit(0.0)).alias("avg_days_between_orders"),
            "total_products",
            F.coalesce("RegionDescription", F.lit(UNKNOWN_TEXT)).alias("region"),
            F.coalesce("SectorDescription", F.lit(UNKNOWN_TEXT)).alias("sector"),
        )
    )


def stratified_split(labelled: DataFrame, train_pct: int = 80, by: str | None = "label") -> DataFrame:
    """Exactly ``train_pct`` percent of each label, rounded down, are for training: the first in the order of
    a hash of the key. Ranks come from ``number_rows``, so no task holds a label; labels are few. Without
    ``by`` all rows are one group."""
    group = F.col(by) if by else F.lit(0)
    hashed = F.conv(F.substring(F.md5(F.col("CustomerKey").cast("string")), 1, 8), 16, 10).cast("long")
    named = labelled.withColumns({"_group": group, "_hash": hashed})
    sizes = named.groupBy("_group").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0)))
    placed = number_rows(named, ["_group", "_hash", "CustomerKey"], "_place").join(sizes, "_group")
    train = (F.col("_place") - F.col("_before")) * 100 <= F.col("_size") * train_pct
    return placed.withColumn("is_train", train.cast("int")).drop("_group", "_hash", "_place", "_size", "_before")


def split_sizes(labelled: DataFrame) -> DataFrame:
    parts = stratified_split(labelled)
    return parts.groupBy("label", "is_train").agg(F.count("*").alias("customers"))


@dataclass(frozen=True)
class ChurnRun:
    """Fitted models with the table they were fitted on, and the customers as they are at the end of the data."""

    table: DataFrame
    current: DataFrame
    models: dict[str, PipelineModel]
    metrics: DataFrame | None = None

    def scored(self, name: str, rows: DataFrame) -> DataFrame:
        out = self.models[name].transform(rows)
        return out.withColumn("churn_probability", vector_to_array("probability")[1])

    @property
    def test(self) -> DataFrame:
        return self.table.filter("is_train = 0")


def estimators(seed: int = 42) -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "logistic_regression": LogisticRegression(maxIter=50, regParam=0.01, **common),
        "random_forest": RandomForestClassifier(numTrees=30, maxDepth=5, seed=seed, **common),
        "boosted_trees": GBTClassifier(maxIter=15, maxDepth=3, seed=seed, **common),
    }


def churn_table(sales: DataFrame, customers: DataFrame, days: int = 90) -> DataFrame:
    rows = churn_features(sales, customers, days).join(churn_label(sales, days), "CustomerKey")
    return materialise(stratified_split(rows), "churn")


def fit_churn(sales: DataFrame, customers: DataFrame, names: list[str] | None = None, days: int = 90) -> ChurnRun:
    """Fit the models on the training side. Text columns are indexed and one-hot encoded."""
    table = churn_table(sales, customers, days)
    indexed = [f"{c}_i" for c in CATEGORIES]
    encoded = [f"{c}_v" for c in CATEGORIES]
    prepare = [
        StringIndexer(inputCols=CATEGORIES, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*NUMERIC, *encoded], outputCol="features"),
    ]
    train = table.filter("is_train = 1")
    wanted = {n: e for n, e in estimators().items() if names is None or n in names}
    prepared = Pipeline(stages=prepare).fit(train)
    ready = prepared.transform(train).select("features", "label").persist()
    models = {}
    for name, estimator in wanted.items():
        models[name] = PipelineModel(stages=[*prepared.stages, estimator.fit(ready)])
    ready.unpersist()
    # Fitted on features at the cutoff, whose outcome is known; applied to those of the last day.
    return ChurnRun(table, materialise(churn_features(sales, customers, 0), "current"), models)


def confusion(run: ChurnRun) -> DataFrame:
    """Test customers by model, label and prediction."""
    parts = None
    for name in run.models:
        scored = run.scored(name, run.test).groupBy("label", F.col("prediction").cast("int").alias("predicted"))
        rows = scored.agg(F.count("*").alias("customers")).select(F.lit(name).alias("model"), "label", "predicted", "customers")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def churn_metrics(run: ChurnRun) -> DataFrame:
    """Accuracy, precision, recall, F1 and the area under the ROC curve per model on the test side, and whether the
    model reaches what is asked of it (``GATES``)."""
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction")
    parts = None
    for name in run.models:
        scored = run.scored(name, run.test)
        auc = float(area.evaluate(scored))
        hit = lambda y, p: F.count_if((F.col("label") == y) & (F.col("prediction") == p))
        counts = scored.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
        tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
        rows = counts.select(
            F.lit(name).alias("model"),
            ratio(tp + tn, tp + fp + fn + tn, 4).alias("accuracy"),
            F.coalesce(ratio(tp, tp + fp, 4), F.lit(0.0)).alias("precision"),
            F.coalesce(ratio(tp, tp + fn, 4), F.lit(0.0)).alias("recall"),
            F.coalesce(ratio(tp * 2, tp * 2 + fp + fn, 4), F.lit(0.0)).alias("f1"),
            F.lit(round(auc, 4)).alias("auc"),
        ).withColumn("passes", reduce(and_, [F.col(c) > least for c, least in GATES.items()]).cast("int"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def feature_importance(run: ChurnRun) -> DataFrame:
    """Importance per model and feature, with its rank in the model: of trees as given, of the regression the
    coefficient, ranked by its size.

    The list has one row per feature, a number set by the feature definition and the categories."""
    rows = []
    schema = next(iter(run.models.values())).transform(run.table.limit(1)).schema
    attributes = schema["features"].metadata["ml_attr"]["attrs"]
    named = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    for name, model in run.models.items():
        last = model.stages[-1]
        weights = last.coefficients if name == "logistic_regression" else last.featureImportances
        order = sorted(named, key=lambda i: (-abs(float(weights[i])), named[i]))  # noqa: B023
        rows += [(name, place, named[i], float(weights[i])) for place, i in enumerate(order, 1)]
    return run.table.sparkSession.createDataFrame(rows, "model string, rank int, feature string, importance double")


def churn_risk(run: ChurnRun, model: str) -> DataFrame:
    """Risk of every customer at the end of the data."""
    return run.scored(model, run.current).select("CustomerKey", F.col("churn_probability").alias("ChurnRisk"))


def at_risk_list(run: ChurnRun, model: str, n: int = 50) -> DataFrame:
    """The ``n`` customers most likely to leave after the end of the data."""
    ranked = run.scored(model, run.current).orderBy(F.desc("churn_probability"), "CustomerKey").limit(n)
    return ranked.select("CustomerKey", "recency", "frequency", "monetary", "churn_probability")
