import numpy as np
import pytest

from basketry.llm import vectors


def clusters(seed=3, dims=16):
    rng, rows = np.random.default_rng(seed), []
    for label in (0, 1):
        for size in (1, 1, 1, 2, 5, 60, 300):
            centre = rng.normal(size=dims)
            for _ in range(size):
                v = centre + rng.normal(size=dims) * 0.09
                rows.append((len(rows), [float(x) for x in v.astype(np.float32)], label))
    rows += [(len(rows) + i, rows[10][1], 0) for i in range(4)]
    rows += [(len(rows) + i, [float(x) for x in rng.normal(size=dims).astype(np.float32)], 0) for i in range(300)]
    return rows


def by_hand(rows, threshold=0.98):
    ids, links, up = [r[0] for r in rows], {}, {}
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    near = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    up = list(range(len(ids)))
    changed = True
    while changed:
        new = [min([up[i], *(up[j] for j in np.flatnonzero(near[i]))]) for i in range(len(ids))]
        changed, up = new != up, new
    return {ids[i]: (int(near[i].sum()), ids[up[i]]) for i in range(len(ids))}


@pytest.mark.parametrize(("shard_rows", "block_rows"), [(20_000, 4096), (100, 70)])
def test_clusters(spark, monkeypatch, shard_rows, block_rows):
    monkeypatch.setattr(vectors, "COUNT_ROWS", 50)
    rows = clusters()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.classes(df, shard_rows=shard_rows, block_rows=block_rows).collect()}
    want = by_hand(rows)
    assert sum(n for n, _ in want.values()) > 1000
    assert got == want


def test_the_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(1500, 24)), rng.normal(size=24) + rng.normal(size=(400, 24)) * 0.05])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = vectors.Graph(x)
    found, _ = graph.query(x.astype(np.float32), 64)
    exact = np.argsort(-(x @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(e) & set(f)) / 10 for e, f in zip(exact, found, strict=True)]) > 0.9
    beam, recall = graph.audit(0.9)
    assert recall >= vectors.RECALL and beam >= vectors.BEAM
    again = vectors.Graph.unpack(graph.pack())
    assert np.array_equal(again.query(x[:50].astype(np.float32), 64)[0], found[:50])


@pytest.mark.parametrize("shard_rows", [20_000, 200])
def test_links_beyond_a_full_beam(spark, shard_rows):
    """Two dense groups, linked with each other, each of whose members has more nearer ones in its own group."""
    rng, rows = np.random.default_rng(4), []
    for side in (-1, 1):
        for _ in range(300):
            v = rng.normal(size=64) * 0.004
            v[:2] += (1.0, side * 0.086)
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], 0))
    want = by_hand(rows)
    assert {c for _, c in want.values()} == {0} and min(n for n, _ in want.values()) > 300
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectors.classes(df, shard_rows=shard_rows).collect()} == want


def test_edges(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [2.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
        (7, [1.0, float("nan")], 1), (8, [1.0, float("inf")], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1e30, 1e20], 1),
        (12, [1.0, 0.0], 2), (None, [5.0, 0.0], 1), (13, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, component_id string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.classes(df).collect()}
    linked = dict.fromkeys((1, 2, 11, 13, None), (4, 1))
    assert got == {**{i: (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)}, **linked}
    assert vectors.classes(df.filter("vec_id = 99")).collect() == []
