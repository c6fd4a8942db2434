import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.functions import quantiles as Q
from basketry.functions.ranking import exact_quantiles, number_rows, running_total, seated
from basketry.operators import rfm as R
from basketry.operators.distributions import histogram, pareto_curve
from basketry.operators.sales import competition_rank


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value."""
    return spark.range(3000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 7919 % 1000).alias("v")
    ).cache()


def test_row_numbers_equal_the_sorted_order(skewed):
    rows = number_rows(skewed, ["v", "k"], "n").collect()
    expected = sorted((r.v, r.k) for r in rows)
    assert [(r.v, r.k) for r in sorted(rows, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in rows) == list(range(1, 3001))


def test_one_value_does_not_end_in_one_partition(skewed):
    parts = seated(skewed, ["v", "k"]).groupBy("_part").count().collect()
    assert max(r["count"] for r in parts) < 3000 / 2


def test_running_total(skewed):
    rows = sorted(running_total(skewed, [F.desc("v"), "k"], "v", "s").collect(), key=lambda r: r.s_rank)
    assert [r.s for r in rows] == list(np.cumsum([r.v for r in rows]))
    assert {r.s_total for r in rows} == {rows[-1].s} and {r.s_rows for r in rows} == {3000}


def test_quantiles_equal_numpy(skewed):
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    by = skewed.withColumn("g", (F.col("k") % 2).cast("string"))
    frame = by.toPandas()
    for r in exact_quantiles(by, "v", points, ["g"]).collect():
        own = frame[frame.g == r.g].v
        assert r.n == len(own)
        assert [r[p] for p in points] == pytest.approx([own.quantile(q) for q in points.values()])


@pytest.mark.parametrize("n", [*range(2, 9), 101])
def test_quartiles_equal_pandas(spark, n):
    rng = np.random.default_rng(n)
    frame = pd.DataFrame({"CustomerKey": range(n), "Recency": rng.choice(900, n, replace=False), "Frequency": rng.integers(1, 4, n), "Monetary": rng.integers(1, 50, n)})
    found = R.rfm_quartiles(spark.createDataFrame(frame)).orderBy("CustomerKey").toPandas()
    rank = lambda c: pd.qcut(frame[c].rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int).tolist()
    assert found.F_quartile.tolist() == rank("Frequency")
    assert found.M_quartile.tolist() == rank("Monetary")
    assert found.R_quartile.tolist() == pd.qcut(frame.Recency, 4, labels=[4, 3, 2, 1]).astype(int).tolist()


def test_one_customer(spark):
    row = R.rfm_segments(spark.createDataFrame([(1, 10, 2, 5)], "CustomerKey int, Recency int, Frequency int, Monetary int")).first()
    assert (row.R_quartile, row.F_quartile, row.M_quartile, row.Segment) == (4, 1, 1, "Other")


def test_equal_recency_takes_the_lowest_bin(spark):
    rows = [(i, 0 if i < 7 else i, i, i) for i in range(10)]
    found = R.rfm_quartiles(spark.createDataFrame(rows, "CustomerKey int, Recency int, Frequency int, Monetary int"))
    assert {r.R_quartile for r in found.filter("Recency = 0").collect()} == {4}


def test_competition_rank(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 9, 1, 1, 1])], "k int, v int")
    assert {r.k: r.r for r in competition_rank(df, "v", "r").collect()} == {2: 1, 0: 2, 1: 2, 3: 4, 4: 4, 5: 4}


def test_histogram_equals_numpy(skewed):
    counts, _ = np.histogram(skewed.toPandas().v, bins=31)
    assert [r.rows for r in histogram(skewed, "v", 31).orderBy("bin").collect()] == counts.tolist()


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "v double")
    counts, _ = np.histogram([4.0] * 3, bins=10)
    assert [r.rows for r in histogram(df, "v", 10).orderBy("bin").collect()] == counts.tolist()


def test_pareto_ends_at_one_hundred(skewed):
    last = pareto_curve(skewed, "v", "k").orderBy(F.desc("rank")).first()
    assert (last.cum_pct_customers, last.cum_pct_revenue) == (100.0, 100.0)


# ---- quantiles by bracketing ------------------------------------------------------------------


@pytest.mark.parametrize("few", [5, 100, 50_000])
@pytest.mark.parametrize("accuracy", [20, 1000])
def test_bracketed_quantiles_equal_numpy(spark, monkeypatch, few, accuracy):
    """However coarse the sketch and however few values are looked at one by one."""
    monkeypatch.setattr(Q, "FEW", few)
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    rng = np.random.default_rng(few + accuracy)
    n = 4000
    columns = {
        "spread": rng.standard_normal(n) * 1e6,
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 30, n)).astype(float),
        "one": np.full(n, 3.5),
        "few": rng.integers(0, 3, n).astype(float),
        "long tail": rng.pareto(0.7, n),
        "nothing": np.full(n, np.nan),
    }
    frame = pd.DataFrame(columns)
    frame.loc[::7, "spread"] = np.nan
    df = spark.createDataFrame(frame).repartition(6)
    points = {"a": 0.0, "b": 0.013, "c": 0.25, "d": 0.5, "e": 0.995, "f": 1.0}
    found, seen = Q.exact_points(df, {c: F.col(f"`{c}`") for c in frame}, points, [F.max("one").alias("most")])
    assert seen.most == 3.5 and set(found["nothing"].values()) == {None}
    for c in frame.columns.drop("nothing"):
        assert [found[c][p] for p in points] == pytest.approx([frame[c].quantile(q) for q in points.values()], rel=1e-12), c


def test_bracketed_quantiles_copy_and_sort_no_rows(spark, skewed):
    from basketry.operators.distributions import boxplot

    box = boxplot(skewed.withColumn("g", (F.col("k") % 3).cast("string")), F.col("v"), "g")
    plan = box._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "rangepartitioning" not in plan
    frame = skewed.toPandas()
    for r in box.collect():
        own = frame[frame.k % 3 == int(r.g)].v
        q1, q3 = own.quantile(0.25), own.quantile(0.75)
        kept = own[(own >= q1 - 1.5 * (q3 - q1)) & (own <= q3 + 1.5 * (q3 - q1))]
        assert (r.q1, r.q2, r.q3) == pytest.approx((q1, own.median(), q3))
        assert (r.whisker_low, r.whisker_high, r.outliers) == (kept.min(), kept.max(), len(own) - len(kept))
