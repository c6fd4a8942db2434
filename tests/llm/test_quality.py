import numpy as np
from pyspark.sql import functions as F

from basketry.llm import quality
from edge_rows import edge, nothing  # noqa: F401

MEDIUM = "/root/testdata/sf0.01"


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    good = truth == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.evaluate(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50
    assert auc(*map(np.array, zip(*held, strict=True))) > 0.95


def test_held_out_labels_do_not_matter(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.remainder() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda r: r.doc_id
    assert sorted(quality.evaluate(docs, labels).collect(), key=key) == sorted(quality.evaluate(docs, turned).collect(), key=key)


def test_follow_the_leader_against_plain_sums():
    """Without L1 the weight is -z / ((beta + sqrt(n)) / alpha + l2), from sums over the past."""
    rng, model = np.random.default_rng(1), quality.Ftrl(5, 0.3, 1.0, 0.0, 0.1)
    z, n = np.zeros(6), np.zeros(6)
    for _ in range(40):
        x, y = rng.random(5), int(rng.random() < 0.5)
        w = -z / ((1.0 + np.sqrt(n)) / 0.3 + 0.1)
        full = np.append(x, 1.0)
        g = (1 / (1 + np.exp(-(w @ full))) - y) * full
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.3 * w
        n += g * g
        model.update(np.arange(5), x, y)
    assert np.allclose(model.weights(np.arange(6)), -z / ((1.0 + np.sqrt(n)) / 0.3 + 0.1))


def test_the_sample_has_a_bound(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    assert not np.array_equal(quality.fit(docs, labels, max_rows=10), quality.fit(docs, labels))


def test_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None), (5, 1)], "doc_id long, quality int")
    scored = quality.score(edge, quality.fit(edge, labels)).collect()
    assert len(scored) == 7 and len({r.score for r in scored if r.doc_id in (1, 2, 4)}) == 1
    assert {r.score for r in quality.score(edge, quality.fit(edge, labels.filter("doc_id = 99"))).collect()} == {0.5}
    assert quality.evaluate(nothing, labels).collect() == []
    assert {r.held_out for r in quality.evaluate(edge, labels).collect() if r.doc_id is None} == {False}
