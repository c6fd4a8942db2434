"""Clusters of customers: K-Means, projection and density clusters."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import number, rounded
from basketry.operators.distributions import log1p
from basketry.session import materialise

FEATURES = ["recency", "frequency", "log_monetary"]


def rfm_features(rfm: DataFrame) -> DataFrame:
    return rfm.select(
        "CustomerKey",
        number("Recency").alias("recency"),
        number("Frequency").alias("frequency"),
        log1p("Monetary").alias("log_monetary"),
    )


def scaled(features: DataFrame) -> DataFrame:
    """Features with mean 0 and deviation 1, as the vector ``scaled``."""
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(features)
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled).drop("raw")


def scaled_columns(features: DataFrame, digits: int = 4) -> DataFrame:
    parts = vector_to_array("scaled")
    return scaled(features).select(
        "CustomerKey", *[rounded(parts[i], digits).alias(f"{name}_z") for i, name in enumerate(FEATURES)]
    )


def _fit(points: DataFrame, k: int, seed: int):
    return KMeans(featuresCol="scaled", k=k, seed=seed, maxIter=20).fit(points)


@dataclass(frozen=True)
class Tried:
    """One number of clusters: the cost of the fit, its silhouette, its model."""

    k: int
    cost: float
    silhouette: float
    model: KMeansModel


#: Fits that run side by side: one is many short jobs with a wait for the driver after each.
FITS = 8


def k_curve(points: DataFrame, ks: Iterable[int], seed: int = 42) -> list[Tried]:
    """Cost and silhouette per number of clusters. ``points`` should be materialised."""
    judge = ClusteringEvaluator(featuresCol="scaled")

    def tried(k: int) -> Tried:
        model = _fit(points, k, seed)
        return Tried(k, float(model.summary.trainingCost), float(judge.evaluate(model.transform(points))), model)

    with ThreadPoolExecutor(max_workers=FITS) as pool:
        # The greatest numbers take longest.
        return list(pool.map(tried, sorted(ks, reverse=True)))[::-1]


def knee(ks: Sequence[int], costs: Sequence[float]) -> int:
    """The number at which the falling cost turns: farthest below the chord from the first to the last point, both
    axes scaled to one. The first of several; the first number when the curve does not turn."""
    fall = costs[0] - costs[-1]
    if len(ks) < 3 or fall <= 0:
        return ks[0]
    depth = [1 - (k - ks[0]) / (ks[-1] - ks[0]) - (c - costs[-1]) / fall for k, c in zip(ks, costs, strict=True)]
    return max(zip(ks, depth, strict=True), key=lambda x: (x[1], -x[0]))[0] if max(depth) > 1e-9 else ks[0]


def choose_k(points: DataFrame, first: int = 2, last: int = 6, seed: int = 42) -> tuple[list[Tried], int]:
    """The tried numbers, and the one at the knee of the cost.

    A range that ends before the knee shows a knee too. So the range is doubled until the knee stays where it was,
    or there are no more different points to divide."""
    most = points.select("scaled").distinct().limit(1 << 12).count()
    last = max(first, min(last, most))
    curve, turn = k_curve(points, range(first, last + 1), seed), None
    while True:
        found = knee([t.k for t in curve], [t.cost for t in curve])
        if found == turn or last >= most:
            return curve, found
        turn, wider = found, min(2 * last, most)
        curve += k_curve(points, range(last + 1, wider + 1), seed)
        last = wider


def best_silhouette(curve: Sequence[Tried]) -> Tried:
    return max(curve, key=lambda t: (t.silhouette, -t.k))


def k_curve_table(spark: SparkSession, curve: Sequence[Tried], elbow: int) -> DataFrame:
    """Both criteria for each number that was tried."""
    best = best_silhouette(curve).k
    rows = [(t.k, t.cost, t.silhouette, int(t.k == elbow), int(t.k == best)) for t in curve]
    return spark.createDataFrame(rows, "k int, cost double, silhouette double, is_elbow int, is_best_silhouette int")


def kmeans_segments(points: DataFrame, chosen: Tried) -> DataFrame:
    """Clusters of one of the numbers that were tried."""
    labelled = chosen.model.transform(points)
    return labelled.select("CustomerKey", F.col("prediction").alias("cluster"), F.lit(chosen.k).alias("k"), F.lit(chosen.silhouette).alias("silhouette"))


def cluster_profile(clusters: DataFrame, rfm: DataFrame) -> DataFrame:
    joined = clusters.select("CustomerKey", "cluster").join(rfm, "CustomerKey")
    return joined.groupBy("cluster").agg(
        F.count("*").alias("customers"),
        *[rounded(F.avg(number(c))).alias(f"avg_{c.lower()}") for c in ("Recency", "Frequency", "Monetary")],
    )


def pca_project(points: DataFrame, dimensions: int = 2) -> DataFrame:
    model = PCA(k=dimensions, inputCol="scaled", outputCol="projected").fit(points)
    parts = vector_to_array("projected")
    shown = model.transform(points)
    return shown.select("CustomerKey", *[parts[i].alias(f"pc{i + 1}") for i in range(dimensions)])


# ---- density --------------------------------------------------------------------------------

#: Pairs of points that one pair of boxes may give; boxes with more are halved first. Halvings at most.
FEW_PAIRS, DEEPEST = 4096, 40


def _near_cells(dimensions: int) -> list[tuple[int, ...]]:
    """Offsets of cells of side eps / sqrt(d) that may hold points within eps: a constant of the dimensions."""
    side = range(-math.isqrt(dimensions) - 1, math.isqrt(dimensions) + 2)
    return [o for o in itertools.product(side, repeat=dimensions) if sum(max(abs(x) - 1, 0) ** 2 for x in o) <= dimensions]


def _squared(a: list[str], b: list[str]) -> Column:
    return reduce(add, [(F.col(x) - F.col(y)) * (F.col(x) - F.col(y)) for x, y in zip(a, b, strict=True)])


class DensityCells:
    """Points of ``columns`` in cells of side eps / sqrt(d), so that any two points of a cell are within ``eps``."""

    def __init__(self, columns: list[str], eps: float):
        self.columns, self.eps, self.d = columns, eps, len(columns)
        self.side = eps / math.sqrt(self.d) * (1 - 1e-12)
        self.x = [f"x{i}" for i in range(self.d)]
        self.cell = [f"c{i}" for i in range(self.d)]
        self.low, self.high = [f"l{i}" for i in range(self.d)], [f"h{i}" for i in range(self.d)]

    def cells_of(self, level: int = 0) -> list[Column]:
        return [F.floor(F.col(x) / F.lit(self.side / 2**level)).cast("long") for x in self.x]

    def around(self) -> Column:
        """A row for each near cell, its own included."""
        near = F.array(*[F.struct(*[F.lit(v).cast("long").alias(f"o{i}") for i, v in enumerate(o)]) for o in _near_cells(self.d)])
        return F.inline(near)

    def shift(self, rows: DataFrame, kept: list[str]) -> DataFrame:
        """``rows`` once for each near cell, under the name of that cell."""
        spread = rows.select(*kept, *self.cell, self.around())
        return spread.select(*kept, *[(F.col(c) + F.col(f"o{i}")).alias(c) for i, c in enumerate(self.cell)])

    def boxes(self, spots: DataFrame, by: list[str]) -> DataFrame:
        """Extent and number of the spots of each group."""
        ends = [F.min(x).alias(n) for x, n in zip(self.x, self.low, strict=True)] + [F.max(x).alias(n) for x, n in zip(self.x, self.high, strict=True)]
        return spots.groupBy(*by).agg(F.count("*").alias("n"), *ends)

    def judged(self, pairs: DataFrame) -> DataFrame:
        """Pairs of boxes (columns ending in a and b) with ``verdict``: 1 all points within eps, 0 none, null open."""
        nearest = farthest = F.lit(0.0)
        for lo, hi in zip(self.low, self.high, strict=True):
            gap = F.greatest(F.col(f"{lo}b") - F.col(f"{hi}a"), F.col(f"{lo}a") - F.col(f"{hi}b"), F.lit(0.0))
            reach = F.greatest(F.col(f"{hi}b") - F.col(f"{lo}a"), F.col(f"{hi}a") - F.col(f"{lo}b"))
            nearest, farthest = nearest + gap * gap, farthest + reach * reach
        limit = F.lit(self.eps * self.eps)
        return pairs.withColumn("verdict", F.when(farthest <= limit, 1).when(nearest > limit, 0))


def density_clusters(features: DataFrame, columns: list[str], eps: float, min_points: int) -> DataFrame:
    """Density clusters (the DBSCAN definition) on true distances: ``CustomerKey, cluster, is_core``.

    A point with at least ``min_points`` points within ``eps``, itself included, is core; core points within ``eps``
    share a cluster, named by its least core point; other points join the least cluster of a core point within
    ``eps`` or are noise (-1), as are points with a null or NaN coordinate.

    Equal points are one with a weight. Any two points of a cell are near, so all points of a cell with
    ``min_points`` are core at once and the core points of a cell share a cluster. Distances are taken only from
    points of sparse cells, of which a cell has fewer than ``min_points``, to the cells around them; a crowded cell
    is a hot key on one plain side of that join, which adaptive execution splits. Whether two crowded cells touch is
    decided by the extents of their core points, halved until they say so or hold few points; never by all pairs."""
    grid = DensityCells(columns, eps)
    known = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])
    coordinates = [(F.col(c).cast("double") + 0.0).alias(x) for c, x in zip(columns, grid.x, strict=True)]
    points = materialise(features.select("CustomerKey", *coordinates, known.alias("known")), "points")
    usable = points.filter("known")
    spots = usable.groupBy(*grid.x).agg(F.count("*").alias("w"), F.min("CustomerKey").cast("long").alias("spot"))
    spots = materialise(spots.select("spot", "w", *grid.x, *[e.alias(c) for e, c in zip(grid.cells_of(), grid.cell, strict=True)]), "spots")
    crowds = materialise(spots.groupBy(*grid.cell).agg((F.sum("w") >= min_points).alias("full")), "crowds")
    spots = materialise(spots.join(crowds, grid.cell), "spots")

    theirs = [f"y{i}" for i in range(grid.d)]
    others = spots.select(*grid.cell, F.col("w").alias("v"), *[F.col(x).alias(y) for x, y in zip(grid.x, theirs, strict=True)])
    sparse = spots.filter("NOT full")
    within = _squared(grid.x, theirs) <= F.lit(eps * eps)
    met = grid.shift(sparse, ["spot", *grid.x]).join(others, grid.cell).filter(within)
    crowded = met.groupBy("spot").agg(F.sum("v").alias("crowd")).filter(F.col("crowd") >= min_points).select("spot")
    core = materialise(spots.filter("full").unionByName(sparse.join(crowded, "spot")), "core")

    name = core.groupBy(*grid.cell).agg(F.min("spot").alias("node"))
    cells = materialise(grid.boxes(core, grid.cell).join(name, grid.cell), "cells")
    labels = connected(cells.select("node"), _touching(grid, core, cells))
    named = materialise(cells.select(*grid.cell, "node").join(labels, "node").select(*grid.cell, F.col("label").alias("cluster")), "named")
    of_core = core.join(named, grid.cell)
    edge = spots.filter("NOT full").join(core.select("spot"), "spot", "left_anti")
    near = of_core.select(*grid.cell, "cluster", *[F.col(x).alias(y) for x, y in zip(grid.x, theirs, strict=True)])
    joined = grid.shift(edge, ["spot", *grid.x]).join(near, grid.cell).filter(within).groupBy("spot").agg(F.min("cluster").alias("cluster"))
    settled = of_core.select(*grid.x, "cluster", F.lit(1).alias("is_core")).unionByName(
        edge.join(joined, "spot", "left").select(*grid.x, "cluster", F.lit(0).alias("is_core"))
    )
    placed = points.join(settled, grid.x, "left")
    return placed.select("CustomerKey", F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"), F.coalesce("is_core", F.lit(0)).alias("is_core"))


def _touching(grid: DensityCells, core: DataFrame, cells: DataFrame) -> DataFrame:
    """``u, v``: cells, by their nodes, that hold core points within eps of each other."""
    stats = ["n", *grid.low, *grid.high]
    sides = lambda df, s: df.withColumnsRenamed({c: f"{c}{s}" for c in [*stats, "node"]})
    pairs = grid.shift(sides(cells, "a"), [f"{c}a" for c in [*stats, "node"]]).join(sides(cells, "b"), grid.cell)
    judged = materialise(grid.judged(pairs.filter("nodea < nodeb")).filter("verdict IS NULL OR verdict = 1"), "judged")
    links = judged.filter("verdict = 1").select(F.col("nodea").alias("u"), F.col("nodeb").alias("v"))
    # Cells that others connect need no answer of their own.
    labels = connected(cells.select("node"), links)
    same = labels.select(F.col("node").alias("nodea"), F.col("label").alias("la")), labels.select(F.col("node").alias("nodeb"), F.col("label").alias("lb"))
    open_ = judged.filter("verdict IS NULL").join(same[0], "nodea").join(same[1], "nodeb").filter("la <> lb")
    mine, theirs = [f"s{i}a" for i in range(grid.d)], [f"s{i}b" for i in range(grid.d)]
    ground = core.join(cells.select(*grid.cell, "node"), grid.cell).select("node", *grid.x)
    open_ = materialise(open_.select("nodea", "nodeb", "na", "nb", *[F.lit(0).cast("long").alias(c) for c in (*mine, *theirs)]), "open")
    for level in range(DEEPEST + 1):
        if open_.isEmpty():
            break
        # At level 0 the part of a cell is the cell itself.
        part = [e.alias(f"s{i}") for i, e in enumerate(grid.cells_of(level) if level else [F.lit(0).cast("long")] * grid.d)]
        placed = ground.select("node", *grid.x, *part)
        side = lambda s: placed.withColumnsRenamed({"node": f"node{s}", **{f"s{i}": f"s{i}{s}" for i in range(grid.d)}, **{x: f"{x}{s}" for x in grid.x}})  # noqa: E731,B023
        small = open_ if level == DEEPEST else open_.filter(F.col("na") * F.col("nb") <= FEW_PAIRS)
        close = small.join(side("a"), ["nodea", *mine]).join(side("b"), ["nodeb", *theirs])
        close = close.filter(_squared([f"{x}a" for x in grid.x], [f"{x}b" for x in grid.x]) <= F.lit(grid.eps * grid.eps))
        found = materialise(close.select(F.col("nodea").alias("u"), F.col("nodeb").alias("v")).distinct(), "touching")
        links = links.unionByName(found)
        large = open_.filter(F.col("na") * F.col("nb") > FEW_PAIRS).join(found, (F.col("nodea") == F.col("u")) & (F.col("nodeb") == F.col("v")), "left_anti")
        if level == DEEPEST or large.isEmpty():
            break
        finer = [e.alias(f"t{i}") for i, e in enumerate(grid.cells_of(level + 1))]
        children = ground.select("node", *grid.x, *part, *finer)
        boxes = materialise(grid.boxes(children, ["node", *[f"s{i}" for i in range(grid.d)], *[f"t{i}" for i in range(grid.d)]]), "boxes")
        child = lambda s: boxes.withColumnsRenamed({c: f"{c}{s}" for c in boxes.columns})  # noqa: E731,B023
        split = large.select("nodea", "nodeb", *mine, *theirs).join(child("a"), ["nodea", *mine]).join(child("b"), ["nodeb", *theirs])
        split = materialise(grid.judged(split).filter("verdict IS NULL OR verdict = 1"), "split")
        sure = materialise(split.filter("verdict = 1").select(F.col("nodea").alias("u"), F.col("nodeb").alias("v")).distinct(), "touching")
        links = links.unionByName(sure)
        rest = split.filter("verdict IS NULL").join(sure, (F.col("nodea") == F.col("u")) & (F.col("nodeb") == F.col("v")), "left_anti")
        moved = [F.col(f"t{i}{s}").alias(f"s{i}{s}") for s in "ab" for i in range(grid.d)]
        open_ = materialise(rest.select("nodea", "nodeb", "na", "nb", *moved), "open")
    return links.distinct()


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least node of each connected component (``node``, ``label``).

    Alternates two steps until nothing changes: each node links its greater neighbours to its least
    one, then its smaller ones. The number of rounds grows with the logarithm of the graph's size.
    Each round is written down, so a lost executor costs one round."""
    edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _signature(edges)
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    least = edges.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(least, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("label"))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return (row.n, row.h)


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_least_neighbour(both), "u").filter(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    rest = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
