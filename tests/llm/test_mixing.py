import re

import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing
from edge_rows import edge, nothing  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(sizes: dict, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by handing the excess on in rounds."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = {}, share * sum(sizes.values())
    while True:
        rest = {s for s in names if s not in full}
        left = budget - sum(full.values())
        given = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s: most * sizes[s] for s in rest if given[s] > most * sizes[s]}
        if not above:
            return full | given
        full |= above


def check(docs, plan, sources):
    rows = plan.collect()
    assert len(rows) == docs.count()
    sizes = dict.fromkeys(sources, 0)
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    wanted, taken, largest = by_hand(sizes), dict.fromkeys(sources, 0), dict.fromkeys(sources, 0)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert len(r.copies) <= 2
        taken[r.source] += r.size * len(r.copies)
        largest[r.source] = max(largest[r.source], r.size)
    for s in sources:
        assert abs(taken[s] - wanted[s]) <= largest[s] / 2 + 1, s
    return rows


def test_targets_and_draw(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = mixing.plan(docs)
    rows = check(docs, plan, [r.source for r in docs.select("source").distinct().collect()])
    again = mixing.plan(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, str(r.copies))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_one_source_holds_nearly_all(spark):
    rows = [(i, "w " * (i % 50), "big" if i % 20 else f"s{i % 3}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(docs, mixing.plan(docs), ["big", "s0", "s1", "s2"])


def test_units_of_a_source_spread_over_shards(spark):
    rows = [(i, "w " * 10, f"s{i % 2}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = mixing.plan(docs, shards=4).select("source", F.explode("copies").alias("c"))
    counts = {(r.source, r.shard): r["count"] for r in copies.groupBy("source", F.col("c.shard").alias("shard")).count().collect()}
    assert len(counts) == 8
    for s in ("s0", "s1"):
        own = [n for (source, _), n in counts.items() if source == s]
        assert max(own) < 3 * min(own)


def test_mixed_holds_what_the_plan_says(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: len(r.copies) for r in mixing.plan(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert got == want


@pytest.mark.parametrize("others", [0, 40])
def test_equal_rows_are_taken_one_by_one(spark, others):
    """Equal rows are most of a source: as many are taken as fit, and the mix holds them."""
    rows = [(7, "one two three four", "a")] * 1500 + [(i, "w " * (i % 9), "a") for i in range(100, 100 + others)] + [(i, "b " * 6, "b") for i in range(2000, 2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = check(docs, mixing.plan(docs), ["a", "b"])
    want = {}
    for r in found:
        want[r.doc_id] = want.get(r.doc_id, 0) + len(r.copies)
    mixed = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert mixed == {d: n for d, n in want.items() if n}
    assert 1500 < want[7] < 3000 or others == 0


def test_columns_with_the_names_of_its_own(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5, "x", 3)], "doc_id long, text string, source string, draw int, copies string, mix_pass int")
    rows = mixing.mixed(docs).collect()
    assert rows and all((r.draw, r.copies) == (5, "x") and r.mix_pass in (1, 2) for r in rows)


def test_edges(edge, nothing):
    rows = mixing.plan(edge).collect()
    assert len(rows) == 7
    assert {r.size for r in rows if r.doc_id in (1, 2, 4)} == {0}
    assert all(len(r.copies) <= 2 for r in rows)
    assert mixing.plan(nothing).collect() == []
    assert mixing.mixed(edge).columns == [*edge.columns, "mix_pass", "mix_shard"]
