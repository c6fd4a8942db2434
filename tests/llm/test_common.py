import numpy as np
import xxhash

from basketry.llm import common


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(common, "CACHE_WORDS", 3)
    table, hashes = common.WordTable(lambda w: (len(w), w[0]), 2), common.WordHashes()
    for text in (b"a bb ccc a", b"dddd a eeeee dddd", b"eeeee bb f", b""):
        words = text.split()
        assert table.of(words).tolist() == [[len(w), w[0]] for w in words]
        assert hashes.of(words).tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    assert len(table) == len(hashes) == 3


def test_bitmap_holds_what_was_put_in(spark):
    rows = [(int(x),) for x in np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)] + [(0,), (-1,)]
    found = common.bitmap(spark.createDataFrame(rows, "h long"), 12)
    assert common.in_bitmap(found, np.array([r[0] for r in rows])).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 2000)
    assert common.in_bitmap(found, others).mean() < 0.2
    assert not common.in_bitmap(common.bitmap(spark.createDataFrame([], "h long"), 12), others).any()
