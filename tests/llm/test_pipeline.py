import zlib

import numpy as np
import public_tokenizers
import pytest
from comparison import connect, difference
from conftest import SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from basketry.llm import decontaminate, mixing, neardup, registry


@pytest.fixture(scope="module")
def stages(spark):
    docs = corpus_pipeline._table(spark, SMALL, "documents")
    kept = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        kept.append(docs.toPandas())
        docs = spark.createDataFrame(kept[-1])
    return kept


def test_each_stage_keeps_columns_and_decides(spark, stages):
    first, quality, unique, clean, mix, files = stages
    for frame in (quality, unique, clean, mix):
        assert list(frame.columns) == list(first.columns)
    ids = [set(f.doc_id) for f in (first, quality, unique, clean, mix)]
    assert ids[0] > ids[1] > ids[2] >= ids[3] >= ids[4]
    labels = corpus_pipeline._table(spark, SMALL, "labels").toPandas()
    good = set(labels[labels.quality == 1].doc_id)
    assert len(good & ids[1]) >= 0.97 * len(good)


def test_near_duplicates_and_decontamination(spark, stages):
    _, quality, unique, clean, _, _ = stages
    found = {r.doc_id for r in neardup.classes(spark.createDataFrame(quality)).filter("kept").collect()}
    assert set(unique.doc_id) == found
    assert not neardup.classes(spark.createDataFrame(unique)).filter("NOT kept").collect()
    items = corpus_pipeline._table(spark, SMALL, "benchmark")
    assert not decontaminate.contaminated(spark.createDataFrame(clean), items).collect()


def test_mix_and_files(spark, stages):
    *_, clean, mix, files = stages
    want = {r.doc_id: len(r.copies) for r in mixing.plan(spark.createDataFrame(clean)).collect() if r.copies}
    assert mix.doc_id.value_counts().to_dict() == want
    whole = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts = dict(zip(mix.doc_id, mix.text, strict=True))
    assert sorted(files.doc_id) == sorted(mix.doc_id)
    start = 0
    for r in files.sort_values("start").itertuples():
        ids = [*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_match_sql(spark, name):
    con = connect(SMALL)
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    assert difference(registry.QUERIES[name](spark, SMALL), con, registry.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SMALL).collect() or name == "op8_benchmark_templates"
