import hashlib
import random

import duckdb
import pytest

from basketry.llm import lines
from edge_rows import edge, nothing  # noqa: F401

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(texts, min_docs, keep_first=False):
    """Kept texts by counting keys in a dictionary; ``texts`` in document order."""
    split = [(t or "").split("\n") for t in texts]
    keys = [[x.strip(WHITE).translate(LOWER) for x in part] for part in split]
    often = {}
    for part in keys:
        for k in set(part):
            often[k] = often.get(k, 0) + 1
    seen, out = set(), []
    for part, own in zip(split, keys, strict=True):
        left = []
        for line, key in zip(part, own, strict=True):
            if key and often[key] >= min_docs and (not keep_first or key in seen):
                continue
            seen.add(key)
            left.append(line)
        out.append("\n".join(left))
    return out


def random_texts(n, seed=4):
    pick = random.Random(seed)
    common = ["The same line", " the SAME line\t", "other", "İ", "", "  ", "\x0b", "tail\r"]
    return ["\n".join(pick.choice(common) if pick.random() < 0.6 else f"own {pick.randrange(n)}" for _ in range(pick.randrange(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_equals_counting_keys(spark, min_docs, keep_first):
    texts = random_texts(400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    found = lines.without_repeated(docs, min_docs, keep_first=keep_first).orderBy("doc_id").collect()
    want = plain(texts, min_docs, keep_first)
    assert [r.text for r in found] == want
    assert [r.n_lines for r in found] == [t.count("\n") + 1 for t in texts]
    gone = [t.count("\n") - w.count("\n") for t, w in zip(texts, want, strict=True)]
    assert all(r.n_dropped in (g, g + 1) for r, g in zip(found, gone, strict=True))


def test_a_key_of_all_documents_is_spread_over_tasks(spark, monkeypatch):
    n = 5000
    docs = spark.range(n).selectExpr("id as doc_id", "concat('hot\n', id, '\nhot') as text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = lines.without_repeated(docs, 10, keep_first=True)
        assert found.filter("text = concat('hot\n', doc_id)").select("doc_id").collect() == [(0,)]
        assert found.filter("text = cast(doc_id as string) and n_dropped = 2").count() == n - 1
        order = ["h1", "h2", "doc_id", "t1", "t2"]
        rows = lines.Cut(docs.selectExpr("doc_id", "1L as t1", "1L as t2", "text").mapInArrow(lines._line_rows(1), lines.LINES), "lines").df
        sizes = rows.repartitionByRange(*order).groupBy("h1", __import__("pyspark").sql.functions.spark_partition_id()).count()
        assert sizes.agg({"count": "max"}).first()[0] < n / 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_streamed_runs_do_not_depend_on_batches():
    import pyarrow as pa

    pick = random.Random(1)
    keys = sorted(pick.randrange(30) for _ in range(600))
    rows = [(k, 0, i, i, i, 1, [0]) for i, k in enumerate(keys)]
    names = ["h1", "h2", "doc_id", "t1", "t2", "n_lines", "places"]
    results = set()
    for size in (1, 2, 7, 64, 600):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + size]]) for i in range(0, 600, size)]
        out = [r for b in lines._streamed(15)(iter(batches)) for r in b.to_pylist()]
        results.add(frozenset((r["doc_id"], r["kind"], r["head"]) for r in out))
    assert len(results) == 1


def test_bitmaps_come_back():
    import numpy as np

    for n in (1, 7, 8, 9, 1000):
        gone = np.arange(0, n, 3)
        stays = lines.unpack(lines.pack(gone, n), n)
        assert len(stays) == n and np.flatnonzero(~stays).tolist() == gone.tolist()


def test_rows_of_bitmaps(spark):
    docs = spark.createDataFrame([(i, f"a\nown {i}\nA ") for i in range(3)] + [(9, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in lines.line_bitmaps(docs, 3).collect()}
    assert found[9].n_lines == 1 and found[9].keep is None
    assert all(lines.unpack(found[i].keep, 3).tolist() == [False, True, False] and found[i].n_dropped == 2 for i in range(3))


def test_rows_equal_in_id_and_text(spark):
    """They count as documents of their own and keep the same lines."""
    docs = spark.createDataFrame([(1, "x\ny")] * 3 + [(2, "x\nz"), (None, "y")], "doc_id long, text string")
    every = sorted((r.doc_id or 0, r.text) for r in lines.without_repeated(docs, 3).collect())
    assert every == [(0, ""), (1, ""), (1, ""), (1, ""), (2, "z")]
    first = sorted((r.doc_id or 0, r.text) for r in lines.without_repeated(docs, 3, keep_first=True).collect())
    assert first == [(0, "y"), (1, "x"), (1, "x"), (1, "x"), (2, "z")]


def test_report_equals_its_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(con.execute(lines.report_sql()).fetchall())
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted(map(tuple, lines.report(docs).collect())) == want
    assert {r[3] for r in want} >= {hashlib.sha256((t or "").encode()).hexdigest() for t in plain([r.text for r in docs.collect()], 10)}


def test_edges(edge, nothing):
    found = lines.without_repeated(edge, 2).collect()
    assert set(found[0].asDict()) == {*edge.columns, "n_lines", "n_dropped"}
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped) for r in found) == [(0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 1), (3, 1, 1), (4, 2, 0), (5, 1, 0)]
    clash = edge.selectExpr("*", "1 as t1", "2 as keep", "3 as gone", "4 as T2_")
    kept = lines.without_repeated(clash, 2).collect()
    assert all((r.t1, r.keep, r.gone, r.T2_) == (1, 2, 3, 4) for r in kept)
    with pytest.raises(ValueError):
        lines.without_repeated(edge.withColumn("N_lines", edge.size))
    assert lines.report(nothing).collect() == []
    assert lines.line_bitmaps(nothing).collect() == []
