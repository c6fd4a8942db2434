"""Fitted models as stored artefacts: fitted once for a state of the tables, read by every query and session after that.

Models lie beside the tables, in a folder named after the versions and batches of the facts and customers they were
fitted on. A folder counts once its ``complete`` file is there; a fit that failed half way is done again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame

from basketry.operators import churn as CH
from basketry.operators import clustering as CL
from basketry.operators import clv as V
from basketry.operators import dimensions as D
from basketry.plans.warehouse import Warehouse
from basketry.session import path_exists
from basketry.sources.tables import create_once, read_text

_INPUTS = ("FactSales", "DimCustomer")
_REGRESSIONS = {"linear_regression": LinearRegressionModel, "boosted_trees": GBTRegressionModel}


@dataclass
class ClvRun:
    """Features with the revenue that followed, the fitted regressions, and the customers as they are now."""

    ready: DataFrame
    current: DataFrame
    models: dict[str, object]


@dataclass
class SegmentRun:
    """Scaled customers and the numbers of clusters that were tried."""

    points: DataFrame
    curve: list[CL.Tried]
    elbow: int


class Models:
    """The models over one state of a warehouse."""

    def __init__(self, w: Warehouse):
        self.w, self.spark = w, w.spark
        state = [(t, str(w.table(t).inputFiles())) for t in _INPUTS]
        self.root = f"{w.store.root}/models/{hashlib.sha256(repr(state).encode()).hexdigest()[:16]}"
        self._held: dict[str, object] = {}

    def _once(self, name: str, fit, load):
        """What ``load`` reads from the folder that ``fit`` has filled and whose name the ``complete`` file holds."""
        if name not in self._held:
            mark = f"{self.root}/{name}.complete"
            if not path_exists(self.spark, mark):
                folder = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
                create_once(self.spark, mark, json.dumps({"folder": folder, **(fit(folder) or {})}))
            held = json.loads(read_text(self.spark, mark))
            self._held[name] = load(held["folder"], held)
        return self._held[name]

    def _customers(self) -> DataFrame:
        return D.named_dimension(self.w.table("DimCustomer"))

    def churn(self) -> CH.ChurnRun:
        """All three classifiers, with the table they were fitted on and their metrics stored beside them."""

        def fit(folder: str) -> None:
            run = CH.fit_churn(self.w.table("FactSales"), self._customers())
            run.table.write.parquet(f"{folder}/table")
            run.current.write.parquet(f"{folder}/current")
            # First, since a model that was saved cannot be sent to tasks any more; readers load it.
            CH.churn_metrics(run).write.parquet(f"{folder}/metrics")
            for name, model in run.models.items():
                model.write().save(f"{folder}/{name}")

        def load(folder: str, _: dict) -> CH.ChurnRun:
            models = {name: PipelineModel.load(f"{folder}/{name}") for name in CH.estimators()}
            read = self.spark.read.parquet
            return CH.ChurnRun(read(f"{folder}/table"), read(f"{folder}/current"), models, read(f"{folder}/metrics"))

        return self._once("churn", fit, load)

    def value(self) -> ClvRun:
        """Both regressions of coming revenue."""

        def fit(folder: str) -> None:
            sales, customers = self.w.table("FactSales"), self._customers()
            ready, models = V.fit_clv(V.clv_table(sales, customers))
            ready.write.parquet(f"{folder}/table")
            V.current_customers(sales, customers).write.parquet(f"{folder}/current")
            for name, model in models.items():
                model.write().save(f"{folder}/{name}")

        def load(folder: str, _: dict) -> ClvRun:
            read = self.spark.read.parquet
            return ClvRun(read(f"{folder}/table"), read(f"{folder}/current"), {n: m.load(f"{folder}/{n}") for n, m in _REGRESSIONS.items()})

        return self._once("value", fit, load)

    def points(self) -> DataFrame:
        """Scaled customers, as the clusters and the projection read them."""

        def fit(folder: str) -> None:
            CL.scaled(CL.rfm_features(self.w.table("rfm"))).write.parquet(f"{folder}/points")

        return self._once("points", fit, lambda folder, _: self.spark.read.parquet(f"{folder}/points"))

    def segments(self) -> SegmentRun:
        """Clusters of customers for every number that was tried."""

        def fit(folder: str) -> dict:
            curve, elbow = CL.choose_k(self.points())
            for t in curve:
                t.model.write().save(f"{folder}/k{t.k}")
            return {"elbow": elbow, "curve": [(t.k, t.cost, t.silhouette) for t in curve]}

        def load(folder: str, held: dict) -> SegmentRun:
            curve = [CL.Tried(k, cost, score, KMeansModel.load(f"{folder}/k{k}")) for k, cost, score in held["curve"]]
            return SegmentRun(self.points(), curve, held["elbow"])

        return self._once("segments", fit, load)


_opened: dict[str, Models] = {}


def models_of(w: Warehouse) -> Models:
    """The models over the tables as they are now."""
    models = Models(w)
    return _opened.setdefault(models.root, models)
