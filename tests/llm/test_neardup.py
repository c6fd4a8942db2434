import random
from itertools import combinations

import pytest

from basketry.llm import neardup
from basketry.llm.common import components
from edge_rows import edge, nothing  # noqa: F401


def runs(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def by_hand(docs: dict, width: int, percent: int) -> dict:
    sets, up = {i: runs(t, width) for i, t in docs.items()}, {i: i for i in docs}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            p, q = root(a), root(b)
            up[max(p, q)] = min(p, q)
    return {i: root(i) for i in docs}


def check(spark, docs: dict, width: int, percent: int):
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in neardup.classes(df, width, percent).collect()}
    want = by_hand(docs, width, percent)
    assert {i: r.component_id for i, r in found.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(runs(docs[r.doc_id], width)) for r in found.values())
    return want


def variant(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_documents(spark, small, width, percent):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = check(spark, docs, width, percent)
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("block", [8, 256])
def test_a_dense_group(spark, monkeypatch, block):
    """Many like texts: regions far larger than their limit, members that few others are like, and copies; compared
    in one cell a region, or in many."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    docs = {i: variant(rng, base, rng.choice([1, 2, 3, 4])) for i in range(150)}
    docs |= {200 + i: docs[i % 3] for i in range(50)}
    docs |= {300 + i: " ".join(f"x{rng.randrange(10**6)}" for _ in range(60)) for i in range(30)}
    monkeypatch.setattr(neardup, "REGION", 8)
    check(spark, docs, 3, 85)


def test_edges(spark, edge, nothing):
    found = neardup.classes(edge, 3, 85).collect()
    assert len(found) == 7
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i and by_id[i].kept for i in (1, 2, 4))
    assert by_id[3].n_shingles == 1 and by_id[3].component_id == 3
    assert by_id[5].n_shingles == 4
    assert by_id[None].component_id is None
    assert neardup.classes(nothing, 3, 85).collect() == []
    assert sorted(str(r.doc_id) for r in neardup.kept_only(edge).collect()) == ["1", "2", "3", "4", "5", "None"]
    assert neardup.kept_only(edge).columns == edge.columns
    clash = neardup.kept_only(edge.selectExpr("*", "'own' as text_hash", "1 as _text")).collect()
    assert all((r.text_hash, r._text) == ("own", 1) for r in clash)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(51), 0), 100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
