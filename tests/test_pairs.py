"""Pair operators against brute force, with a feature that most entities share."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import basket as B
from basketry.operators import clustering as CL
from basketry.functions import blocks
from basketry.operators import recommend as RC
from basketry.operators.similarity import prefix_pairs, shared_pairs


def vectors(seed, entities=60, features=40, hot=3, weighted=True):
    rng = np.random.default_rng(seed)
    out = {}
    for e in range(entities):
        own = {int(f): int(rng.integers(1, 4)) if weighted else 1 for f in rng.choice(range(hot, features), 3, replace=False)}
        for f in range(hot):
            if rng.random() < 0.6:
                own[f] = int(rng.integers(1, 9)) if weighted else 1
        out[e] = own
    for e in range(entities, entities + 8):
        out[e] = {0: 2} if weighted else {0: 1}
    return out


def triples(spark, data):
    rows = [(e, f, w) for e, own in data.items() for f, w in own.items()]
    return spark.createDataFrame(rows, "entity long, feature long, weight long")


def dot(a, b):
    return sum(w * b[f] for f, w in a.items() if f in b)


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.95])
def test_cosines_are_complete_at_any_limit(spark, limit, threshold):
    data = vectors(1)
    norm = {e: math.sqrt(dot(v, v)) for e, v in data.items()}
    expected = {}
    for a, b in itertools.combinations(sorted(data), 2):
        c = round(dot(data[a], data[b]) / (norm[a] * norm[b]), 6)
        if c >= threshold:
            expected[a, b] = c
    found = shared_pairs(triples(spark, data), min_cosine=threshold, limit=limit).collect()
    assert len(found) == len({(r.a, r.b) for r in found})
    assert {(r.a, r.b) for r in found} == set(expected)
    for r in found:
        assert r.cosine == pytest.approx(expected[r.a, r.b], abs=2e-6)


@pytest.mark.parametrize("limit", [1, 4, 1000])
@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_counts_are_complete_at_any_limit(spark, limit, threshold):
    data = vectors(2, weighted=False)
    expected = {(a, b): dot(data[a], data[b]) for a, b in itertools.combinations(sorted(data), 2)}
    found = shared_pairs(triples(spark, data), min_count=threshold, limit=limit).collect()
    assert {(r.a, r.b): r.dot for r in found} == {p: n for p, n in expected.items() if n >= threshold}


@pytest.mark.parametrize("limit", [5, 200])
def test_rules_with_one_giant_order(spark, limit):
    """One order with a third of all lines."""
    rng = np.random.default_rng(3)
    orders = {s: {int(i) for i in rng.choice(30, 4, replace=False)} for s in range(15)}
    orders[99] = set(range(30))
    rows = [(s, i) for s, items in orders.items() for i in items]
    sales = spark.createDataFrame(rows * 2, "SaleID long, ProductKey long")
    count = lambda *items: sum(set(items) <= o for o in orders.values())
    expected = {(a, b): count(a, b) for a, b in itertools.combinations(range(30), 2) if count(a, b) >= 2}
    found = {(r.item_a, r.item_b): r for r in B.pair_rules(sales, 2, limit).collect()}
    assert {p: r.orders_both for p, r in found.items()} == expected
    for (a, b), r in found.items():
        assert r.lift == pytest.approx(count(a, b) * len(orders) / (count(a) * count(b)), abs=1e-6)


def test_equal_customers_are_shown_once(spark):
    rows = [(c, 1, 1, 1) for c in range(50)] + [(60, 1, 1, 1), (60, 2, 1, 1)]
    matrix = spark.createDataFrame(rows, "CustomerKey int, ProductKey int, quantity long, orders long")
    found = {(r.profile_a, r.profile_b): (r.members_a, r.members_b, r.cosine) for r in RC.customer_cosine(matrix, 0.1).collect()}
    assert found == {(0, 0): (50, 50, 1.0), (0, 60): (50, 1, 0.707107)}
    tips = RC.recommend_top_n(matrix).collect()
    assert {(r.CustomerKey, r.ProductKey) for r in tips} == {(c, 2) for c in range(50)}


@pytest.mark.parametrize("threshold", [0.3, 0.7, 0.95])
def test_prefix_pairs_are_all_pairs(spark, threshold):
    rng = np.random.default_rng(9)
    data = {e: {int(f): int(rng.integers(1, 5)) for f in rng.choice(12, rng.integers(1, 6), replace=False)} for e in range(60)}
    data[90] = {f: 1 for f in range(12)}
    rows = [(e, f, w) for e, v in data.items() for f, w in v.items()]
    norm = {e: sum(w * w for w in v.values()) ** 0.5 for e, v in data.items()}
    cosine = lambda a, b: sum(w * data[b].get(f, 0) for f, w in data[a].items()) / norm[a] / norm[b]
    expected = {(a, b): cosine(a, b) for a, b in itertools.combinations(sorted(data), 2) if cosine(a, b) >= threshold}
    found = {(r.a, r.b): r.cosine for r in prefix_pairs(spark.createDataFrame(rows, "entity int, feature int, weight long"), threshold).collect()}
    assert set(found) == set(expected) and all(found[p] == pytest.approx(c, abs=1e-6) for p, c in expected.items())


def test_scores_add_up_over_all_customers(spark):
    rng = np.random.default_rng(2)
    data = {c: {int(p): int(rng.integers(1, 4)) for p in rng.choice(15, 5, replace=False)} for c in range(40)}
    data |= {100 + c: data[0] for c in range(5)}
    rows = [(c, p, 1, n) for c, v in data.items() for p, n in v.items()]
    matrix = spark.createDataFrame(rows, "CustomerKey int, ProductKey int, quantity long, orders long")
    norm = {c: sum(n * n for n in v.values()) ** 0.5 for c, v in data.items()}
    found = {(r.CustomerKey, r.ProductKey): r.score for r in RC.recommend_top_n(matrix, n=15).collect()}
    expected = {}
    for c, v in data.items():
        for p in range(15):
            score = sum(sum(n * data[o].get(f, 0) for f, n in v.items()) / norm[c] / norm[o] * data[o].get(p, 0) for o in data)
            if p not in v and score > 0:
                expected[c, p] = score
    assert set(found) == set(expected) and all(found[k] == pytest.approx(s, abs=1e-4) for k, s in expected.items())


def test_a_customer_of_many_products_is_not_multiplied_out(spark, monkeypatch):
    """Scores by definition, with large customers, several blocks of customers and columns, and few columns a block."""
    rng = np.random.default_rng(8)
    data = {c: {int(p): int(rng.integers(1, 4)) for p in rng.choice(30, rng.integers(1, 6), replace=False)} for c in range(40)}
    data |= {100 + c: {p: 1 + (p + c) % 3 for p in range(c, 25)} for c in range(2)}
    rows = [(c, p, 1, n) for c, v in data.items() for p, n in v.items()]
    matrix = spark.createDataFrame(rows, "CustomerKey int, ProductKey int, quantity long, orders long")
    for name, most in (("_LARGE", 10), ("_ENTRIES", 60), ("_MATRIX", 100)):
        monkeypatch.setattr(RC, name, most)
    norm = {c: sum(n * n for n in v.values()) ** 0.5 for c, v in data.items()}
    cosine = lambda a, b: sum(n * data[b].get(f, 0) for f, n in data[a].items()) / norm[a] / norm[b]
    expected = {}
    for c, v in data.items():
        scores = {p: sum(cosine(c, o) * w.get(p, 0) for o, w in data.items()) for p in range(30) if p not in v}
        ranked = sorted(((-round(x, 4), p) for p, x in scores.items() if x > 0))[:3]
        expected |= {(c, i + 1): (p, -x) for i, (x, p) in enumerate(ranked)}
    found = {(r.CustomerKey, r["rank"]): (r.ProductKey, r.score) for r in RC.recommend_top_n(matrix, n=3).collect()}
    assert set(found) == set(expected)
    for key, (p, x) in expected.items():
        assert found[key][0] == p and found[key][1] == pytest.approx(x, abs=1e-6)


def test_equal_scores_of_a_block_are_cut_by_key():
    """Of columns that surely round alike only the first are handed on."""
    one = np.ones(500)
    summed = blocks.outer_sums((np.array([1]), np.array([1]), one[:1]), (np.array([500]), np.arange(500) * 2, one))
    at, code, _ = blocks.best_of_sparse((np.array([2]), np.array([1, 4]), one[:2]), summed, 3, 1e-4)
    assert at.tolist() == [0, 0, 0] and sorted(code.tolist()) == [0, 2, 6]


@pytest.mark.parametrize("low", [-1.0, 0.0])
def test_best_products_are_those_of_all_products(spark, monkeypatch, low):
    for name, most in (("_CUSTOMERS", 20), ("_PRODUCTS", 300)):
        monkeypatch.setattr(RC, name, most)
    rng = np.random.default_rng(4)
    x, y = rng.uniform(low, 1, (60, 4)).astype("f4"), rng.uniform(low, 1, (1500, 4)).astype("f4")
    y[700:710] = y[0]
    frame = lambda v: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "id int, features array<float>")
    found = {(r.id, r["rank"]): (r["product"], r.score) for r in RC.best_products(frame(x), frame(y), 4).collect()}
    assert len(found) == 240
    for i, scores in enumerate(x.astype("f8") @ y.astype("f8").T):
        best = np.lexsort((np.arange(1500), -scores.astype("f4")))[:4]
        assert [found[i, k + 1][1] for k in range(4)] == pytest.approx(scores[best].tolist(), abs=1e-5)
        assert all(scores[found[i, k + 1][0]] == pytest.approx(found[i, k + 1][1], abs=1e-5) for k in range(4))


def test_two_equal_large_orders_do_not_give_all_their_subsets(spark):
    rows = [(s, i) for s in (1, 2) for i in range(40)] + [(10 + s, 100 + s % 7) for s in range(3000)]
    found = B.frequent_itemsets(B.itemset_model(spark.createDataFrame(rows, "SaleID long, ProductKey long"))).collect()
    assert {r["items"] for r in found} == {str(100 + i) for i in range(7)}


def brute_density(points, eps, min_points):
    """Labels by definition: neighbours by distance, components by search."""
    near = {a: [b for b in points if sum((x - y) ** 2 for x, y in zip(points[a], points[b], strict=True)) <= eps * eps] for a in points}
    core = {a for a in points if len(near[a]) >= min_points}
    label, seen = {}, set()
    for a in sorted(core):
        if a in seen:
            continue
        stack, members = [a], set()
        while stack:
            x = stack.pop()
            if x in members:
                continue
            members.add(x)
            stack += [b for b in near[x] if b in core and b not in members]
        seen |= members
        for m in members:
            label[m] = min(members)
    groups = {a: label.get(a) if a in core else min((label[b] for b in near[a] if b in core), default=-1) for a in points}
    return groups, core


def check_density(spark, spots, eps, min_points):
    names = ["a", "b", "c"][: len(spots[0])]
    rows = [(i, *map(float, x)) for i, x in enumerate(spots)]
    df = spark.createDataFrame(rows, "CustomerKey int, " + ", ".join(f"{n} double" for n in names)).repartition(4)
    expected, core = brute_density({r[0]: r[1:] for r in rows}, eps, min_points)
    found = {r.CustomerKey: (r.cluster, r.is_core) for r in CL.density_clusters(df, names, eps, min_points).collect()}
    assert {k for k, (_, c) in found.items() if c} == core
    assert {k: v for k, (v, _) in found.items()} == expected
    return expected


@pytest.mark.parametrize("seed", [1, 2])
def test_density_clusters_follow_the_definition(spark, seed):
    rng = np.random.default_rng(seed)
    spots = np.vstack([rng.normal(c, 0.25, (40, 2)) for c in ((0, 0), (3, 3), (0, 3))] + [rng.uniform(-2, 6, (40, 2)), np.zeros((60, 2))])
    assert len(set(check_density(spark, spots, 0.4, 5).values())) > 3


def test_density_clusters_in_space(spark):
    rng = np.random.default_rng(3)
    spots = np.vstack([rng.normal(c, 0.3, (50, 3)) for c in ((0, 0, 0), (1.5, 0, 0), (4, 4, 4))] + [rng.uniform(-1, 5, (30, 3))])
    check_density(spark, spots, 0.5, 6)


@pytest.mark.parametrize(("gap", "few"), [(0.999, 30), (1.001, 30), (0.999, 4096), (1.001, 4096)])
def test_two_crowds_that_just_touch(spark, monkeypatch, gap, few):
    """Two long walls of points whose nearest pair decides: their boxes are halved until it is found, or ruled out."""
    monkeypatch.setattr(CL, "FEW_PAIRS", few)
    rng = np.random.default_rng(5)
    left = np.column_stack([rng.uniform(-0.4, 0, 150), rng.uniform(0, 0.7, 150)])
    right = np.column_stack([rng.uniform(gap, gap + 0.4, 150), rng.uniform(0, 0.7, 150)])
    ends = np.array([[0.0, 0.35], [gap, 0.35]])
    left[:, 0] -= 0.02
    right[:, 0] += 0.02
    found = check_density(spark, np.vstack([left, right, ends]), 1.0, 20)
    assert len(set(found.values())) == (1 if gap < 1 else 2)


def test_points_without_a_place_are_noise(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.1), (3, None), (4, float("nan")), (5, -0.0)], "CustomerKey int, a double")
    found = {r.CustomerKey: (r.cluster, r.is_core) for r in CL.density_clusters(df, ["a"], 0.5, 3).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (-1, 0), 4: (-1, 0), 5: (1, 1)}
    assert CL.density_clusters(df.filter("CustomerKey > 9"), ["a"], 0.5, 3).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 160), 500]], "node long")
    edges = spark.createDataFrame(chain + star, "u long, v long")
    found = {r.node: r.label for r in CL.connected(nodes, edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 500: 500}


def test_inputs_are_checked(spark):
    with pytest.raises(ValueError):
        shared_pairs(triples(spark, {1: {1: 1}}), min_count=1, min_cosine=0.5)


def test_giant_feature_is_split_over_join_keys(spark):
    """The blocks of one heavy feature are spread: no join key holds more than a few blocks."""
    from basketry.operators.similarity import _expand_in_blocks

    rows = spark.range(400).select(
        F.col("id").alias("entity"), F.lit(1).alias("feature"), F.lit(1).alias("weight"), F.lit(1).alias("n"), F.lit(1).alias("h"), F.lit(400).alias("size")
    )
    pairs = _expand_in_blocks(rows, 50)
    assert pairs.count() == pairs.select("a", "b").distinct().count() == 400 * 399 // 2


@pytest.mark.parametrize("orders", [3, 900])
def test_sets_of_one_large_order_are_no_patterns(spark, orders):
    """An order of forty products among few orders: only what two orders share is found."""
    rows = [(1, p) for p in range(40)] + [(o, p) for o in range(2, orders + 1) for p in (1, 2, 100 + o)]
    sales = spark.createDataFrame(rows, "SaleID long, ProductKey int")
    found = {r["items"]: r.orders for r in B.frequent_itemsets(B.itemset_model(sales)).collect()}
    assert found == {"1": orders, "2": orders, "1,2": orders}


@pytest.mark.parametrize("limit", [7, 1000])
def test_pairs_of_a_popular_feature(spark, limit):
    """A feature that is all that many entities have: its pairs come in blocks, and none is missing."""
    rows = [(e, 0, 1) for e in range(60)] + [(e, 1 + e % 5, 1) for e in range(40, 60)]
    df = spark.createDataFrame(rows, "entity int, feature int, weight int")
    vectors = {e: {f: w for x, f, w in rows if x == e} for e in range(60)}
    cosine = lambda a, b: sum(w * vectors[b].get(f, 0) for f, w in vectors[a].items()) / (len(vectors[a]) * len(vectors[b])) ** 0.5
    want = {(a, b): round(cosine(a, b), 6) for a in range(60) for b in range(a + 1, 60) if round(cosine(a, b), 6) >= 0.6}
    found = {(r.a, r.b): r.cosine for r in prefix_pairs(df, 0.6, limit).collect()}
    assert found == pytest.approx(want, abs=2e-6)


def test_a_common_feature_beside_others_does_not_pair_all(spark):
    """All entities have one feature that is a small share of each: its pairs cannot reach and are not formed."""
    from basketry.operators import similarity as S

    rows = spark.range(300).select(F.col("id").alias("entity"), F.lit(1).alias("feature"), F.lit(1).alias("weight"), F.lit(30).alias("n"), F.lit(1).alias("h"), F.lit(300).alias("size"))
    assert S._expand_able(rows, 50, 0.1).count() == 0
    assert S._expand_able(rows.withColumn("n", F.lit(10)), 50, 0.1).count() == 300 * 299 // 2
    mixed = rows.withColumn("n", F.when(F.col("entity") < 2, 2).otherwise(40))
    pairs = {(r.a, r.b) for r in S._expand_able(mixed, 50, 0.1).collect()}
    assert (0, 1) in pairs and {(e, b) for e in (0, 1) for b in range(2, 300)} <= pairs and not any(a > 1 for a, _ in pairs)


def test_light_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Sums of pairs of light features are spread over as many tasks as the pairs ask for."""
    from basketry.operators import similarity as S

    monkeypatch.setattr(S, "_PAIRS_A_TASK", 10)
    data = {e: {e // 4: 1, 100 + e % 4: 2} for e in range(40)}
    found = {(r.a, r.b): r.cosine for r in S.prefix_pairs(triples(spark, data), 0.5).collect()}
    assert found == {(a, b): 0.8 for a, b in itertools.combinations(range(40), 2) if a % 4 == b % 4}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_pairs_of_light_features_are_no_rows(spark, monkeypatch, kind):
    """Blocks of entities give all pairs, whatever the type of features, and hand on those only that can be of the result."""
    from basketry.operators import similarity as S

    data = vectors(9, entities=120, features=60, hot=0)
    rows = [(e, f"f{f}" if kind == "string" else f, float(w), float(dot(own, own)), 0.0, None) for e, own in data.items() for f, w in own.items()]
    df = spark.createDataFrame(rows, f"entity int, feature {kind}, weight double, n double, h double, size long")
    monkeypatch.setattr(S, "_PAIRS_A_TASK", 100)
    found = S._summed(df, 1000, S._able(0.5))
    assert found.schema["a"].dataType.simpleString() == "int"
    norm = {e: math.sqrt(dot(v, v)) for e, v in data.items()}
    expected = {(a, b): dot(data[a], data[b]) for a, b in itertools.combinations(sorted(data), 2)}
    expected = {p: x for p, x in expected.items() if x / (norm[p[0]] * norm[p[1]]) >= 0.5}
    assert {(r.a, r.b): r.dot for r in found.collect()} == expected


def test_pairs_of_one_heavy_feature_are_no_rows_before_the_threshold(spark, monkeypatch):
    """A feature that all have gives only those pairs that reach the threshold, complete in the blocks that form them."""
    from basketry.operators import similarity as S

    rng = np.random.default_rng(4)
    data = {e: {0: int(rng.integers(1, 5)), **{int(f): int(rng.integers(1, 4)) for f in rng.choice(range(1, 300), 6, replace=False)}} for e in range(200)}
    monkeypatch.setattr(S, "_PAIRS_A_TASK", 1000)
    monkeypatch.setattr(S, "_finish", None)
    norm = {e: math.sqrt(dot(v, v)) for e, v in data.items()}
    expected = {(a, b): dot(data[a], data[b]) for a, b in itertools.combinations(sorted(data), 2)}
    expected = {p: x for p, x in expected.items() if round(x / (norm[p[0]] * norm[p[1]]), 6) >= 0.4}
    found = shared_pairs(triples(spark, data), min_cosine=0.4, limit=50).collect()
    assert {(r.a, r.b): r.dot for r in found} == expected


def test_factorisations_have_more_blocks_for_more_ratings(spark, monkeypatch):
    rows = [(c, p, 1) for c in range(20) for p in range(30) if (c * 7 + p) % 3]
    matrix = spark.createDataFrame(rows, "CustomerKey int, ProductKey int, orders long")
    asked = []
    fit = RC.ALS.fit
    monkeypatch.setattr(RC.ALS, "fit", lambda als, df: asked.append((als.getNumUserBlocks(), als.getNumItemBlocks())) or fit(als, df))
    few = {(r.CustomerKey, r["rank"]) for r in RC.als_recommend(matrix, n=2).collect()}
    monkeypatch.setattr(RC, "_RATINGS", 20)
    many = {(r.CustomerKey, r["rank"]) for r in RC.als_recommend(matrix, n=2).collect()}
    assert asked[0] == (10, 10) and asked[1][0] == asked[1][1] == len(rows) // 20
    assert few == many == {(c, k) for c in range(20) for k in (1, 2)}
