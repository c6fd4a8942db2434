"""Scores belong to the end of the data; reports on the last months read only those."""

import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from basketry.operators import churn as CH
from basketry.operators import clustering as CL
from basketry.operators import clv as V
from basketry.operators import sales as SL
from basketry.plans import catalog
from basketry.plans import models as M
from basketry.plans.catalog import named_dim, sales


@pytest.fixture(scope="module")
def run(warehouse):
    return CH.fit_churn(sales(warehouse), named_dim(warehouse), ["logistic_regression"])


def test_every_customer_is_scored(warehouse, run):
    everyone = sales(warehouse).select("CustomerKey").distinct().count()
    risk = CH.churn_risk(run, "logistic_regression")
    assert risk.count() == risk.select("CustomerKey").distinct().count() == everyone
    ready, models = V.fit_clv(V.clv_table(sales(warehouse), named_dim(warehouse)))
    now = V.current_customers(sales(warehouse), named_dim(warehouse))
    assert V.clv_predicted(now, models["linear_regression"]).count() == everyone
    assert {c.name for c in ready.schema} > {c.name for c in now.schema}


def test_features_of_the_last_day(warehouse, run):
    last = sales(warehouse).agg(F.max("OrderDateKey")).first()[0]
    recent = {r.CustomerKey for r in sales(warehouse).filter(F.col("OrderDateKey") == last).collect()}
    assert recent == {r.CustomerKey for r in run.current.filter("recency = 0").collect()}


def test_the_split_is_exact(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(1000)]
    split = CH.stratified_split(spark.createDataFrame(rows, "CustomerKey int, label int"))
    found = {(r.label, r.is_train): r["count"] for r in split.groupBy("label", "is_train").count().collect()}
    assert found == {(0, 1): 685, (0, 0): 172, (1, 1): 114, (1, 0): 29}


def test_only_the_last_months_are_read(warehouse):
    plan = SL.loyal_customers(sales(warehouse))._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "order_month" in pruned and len(re.findall("Subquery", plan)) == 0


# ---- stored models ----------------------------------------------------------------------------


def test_models_are_fitted_once(warehouse, monkeypatch):
    first = M.models_of(warehouse).churn()
    monkeypatch.setattr(CH, "fit_churn", None)
    again = M.Models(warehouse).churn()  # another session of the same state reads what the first has stored
    risk = lambda run: {r.CustomerKey: r.ChurnRisk for r in CH.churn_risk(run, "random_forest").collect()}
    assert risk(first) == risk(again) and len(risk(first)) > 100
    metrics = {r.model: r for r in again.metrics.collect()}
    assert set(metrics) == set(CH.estimators())
    for r in metrics.values():
        assert r.passes == int(r.auc > 0.70 and r.recall > 0.60)
    ranks = {}
    for r in CH.feature_importance(again).collect():
        ranks.setdefault(r.model, []).append((r["rank"], abs(r.importance)))
    assert all([i for _, i in sorted(x)] == sorted((i for _, i in x), reverse=True) for x in ranks.values())


def test_a_fit_that_failed_is_done_again(warehouse, monkeypatch):
    models = M.Models(warehouse)
    models.root += "-again"
    calls = []

    def fit(folder):
        calls.append(folder)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return {"n": 5}

    for _ in range(3):
        try:
            found = models._once("x", fit, lambda folder, held: (folder, held["n"]))
        except RuntimeError:
            continue
        assert found == (calls[1], 5)
    assert len(calls) == 2


def test_logistic_regression_equals_a_plain_solver(warehouse):
    """Newton's method on the same objective: mean log loss and the squares of scaled coefficients."""
    run = M.models_of(warehouse).churn()
    model = run.models["logistic_regression"]
    ready = PipelineModel(model.stages[:-1]).transform(run.table.filter("is_train = 1")).select("features", "label").collect()
    x = np.array([r.features.toArray() for r in ready])
    y = np.array([r.label for r in ready], float)
    scale = x.std(axis=0, ddof=1)
    used = scale > 0
    z = np.column_stack([x[:, used] / scale[used], np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.append(np.full(used.sum(), 0.01), 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (p - y) / len(y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(penalty)
        w -= np.linalg.lstsq(hessian, gradient, rcond=None)[0]
    fitted = np.append(model.stages[-1].coefficients.toArray()[used] * scale[used], model.stages[-1].intercept)
    assert np.abs(1 / (1 + np.exp(-z @ fitted)) - 1 / (1 + np.exp(-z @ w))).max() < 0.01


def test_k_of_planted_clusters(spark):
    """Nine clusters lie outside the first range, which is widened until the knee stays."""
    rng = np.random.default_rng(8)
    centres = [(x * 10.0, y * 10.0) for x in range(3) for y in range(3)]
    rows = [(i, Vectors.dense(rng.normal(centres[i % 9], 0.3))) for i in range(540)]
    points = spark.createDataFrame(rows, ["CustomerKey", "scaled"]).cache()
    curve, elbow = CL.choose_k(points)
    assert elbow == 9 and CL.best_silhouette(curve).k == 9
    shown = {r.k: r for r in CL.k_curve_table(spark, curve, elbow).collect()}
    assert (shown[9].is_elbow, shown[9].is_best_silhouette) == (1, 1) and sum(r.is_elbow for r in shown.values()) == 1
    assert shown[9].silhouette > 0.9
    few = points.filter("CustomerKey < 4")
    assert max(t.k for t in CL.choose_k(few)[0]) <= 4


def test_knee():
    assert CL.knee([2, 3, 4, 5], [100, 10, 9, 8]) == 3
    assert CL.knee([2, 3, 4], [3, 2, 1]) == 2  # a straight line does not turn
    assert CL.knee([2], [5]) == 2


def test_segments_pass_their_gate(warehouse):
    """What is asked of the segments: a silhouette above 0.3."""
    run = M.models_of(warehouse).segments()
    assert CL.best_silhouette(run.curve).silhouette > 0.3


def test_projection_equals_a_dense_solver(warehouse):
    points = M.models_of(warehouse).segments().points
    x = np.array([r.scaled.toArray() for r in points.orderBy("CustomerKey").collect()])
    found = np.array([tuple(r)[1:] for r in CL.pca_project(points, 3).orderBy("CustomerKey").collect()])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    want = x @ vectors[:, ::-1]
    assert np.abs(np.abs(found) - np.abs(want)).max() < 1e-8


def test_value_by_risk(warehouse):
    risk = CH.churn_risk(M.models_of(warehouse).churn(), "logistic_regression")
    tiers = V.clv_tiers(V.clv_historical(sales(warehouse)))
    plain = {}
    of = {r.CustomerKey: r.ChurnRisk for r in risk.collect()}
    for r in tiers.collect():
        key = r.tier, "at risk" if of[r.CustomerKey] >= 0.5 else "safe"
        plain.setdefault(key, []).append(of[r.CustomerKey])
    found = {(r.tier, r.risk): (r.customers, r.avg_risk) for r in V.clv_risk_matrix(tiers, risk).collect()}
    assert {k: n for k, (n, _) in found.items()} == {k: len(v) for k, v in plain.items()}
    assert all(found[k][1] == pytest.approx(np.mean(v), abs=1e-4) for k, v in plain.items())


def test_the_projection_fits_no_clusters(spark, small, warehouse, monkeypatch, tmp_path):
    models = M.Models(warehouse)
    models.root = str(tmp_path / "models")
    monkeypatch.setattr(catalog, "models_of", lambda w: models)
    monkeypatch.setattr(CL, "choose_k", lambda *a, **k: pytest.fail("clusters were fitted"))
    assert catalog.QUERIES["pca_project"](spark, small).count() == warehouse.table("rfm").count()
