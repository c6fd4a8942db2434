import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import tokens
from edge_rows import edge, nothing  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


class Held(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def expected(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=12) | st.sampled_from(["Don't", "été,", "Ⅷ.", "²!", "tion***", "a|b", "x,", "a.", "e\u0301,", "<|endoftext|>", "<|EndOfText|>", "ß!", "3,5", "İ", "\u00a0"]), max_size=8).map(" ".join))
def test_runs_give_the_ids_of_the_whole_text(text):
    assert tokens.encoder_of(PATH).encode(text).tolist() == expected(text)


@pytest.mark.parametrize("signs", [",", ".!", "&x"])
def test_every_letter_before_signs(signs):
    """Some letters become one with a mark in normal form, and the mark goes with the signs."""
    letters = [chr(c) for c in range(0x80, 0x20000) if chr(c).isalpha()]
    texts = [" ".join(f"ab{c}{signs} {c}{signs}" for c in letters[i : i + 50]) for i in range(0, len(letters), 50)]
    found = tokens.ChunkEncoder(PATH).encode_all(texts)
    assert all(f.tolist() == expected(t) for f, t in zip(found, texts, strict=True))


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Two  words,\n and MORE.", "", "it's\tİ."]
    whole = Tokenizer.from_file(path)
    assert [t.tolist() for t in tokens.ChunkEncoder(path).encode_all(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_RUNS", 3)
    encoder = tokens.ChunkEncoder(PATH)
    for text in ("one two three four", "five, six. seven", "one seven five", ""):
        assert encoder.encode(text).tolist() == expected(text)
    assert len(encoder.known) < 12


def test_frames_are_independent_and_found_by_id():
    held = Held()
    writer = tokens.ShardWriter(held, frame_bytes=400)
    docs = {i: np.arange(i, dtype=np.uint32) for i in range(60)}
    for i, ids in docs.items():
        writer.add(i, ids)
    writer.add(60, docs[5])
    writer.add(60, docs[6])
    writer.close()
    reader = tokens.ShardReader(held)
    assert len(reader.table) > 5
    assert [d for d, _ in reader] == [*range(60), 60, 60]
    for i in (0, 17, 59):
        assert [t.tolist() for t in reader.find(i)] == [docs[i].tolist()]
    assert sorted(map(len, reader.find(60))) == [5, 6]
    assert reader.find(999) == []
    # Any reader of zstandard can take one frame; the tables are skippable frames for it.
    start = int(reader.starts[3])
    raw = zstandard.ZstdDecompressor().decompress(held.getvalue()[start : int(reader.starts[4])])
    assert len(raw) == reader.table[3][1]
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(held.getvalue()), read_across_frames=True) as all_frames:
        assert len(all_frames.read()) == reader.table[:, 1].sum()


def test_damage_is_noticed():
    held = Held()
    writer = tokens.ShardWriter(held)
    writer.add(1, np.arange(100, dtype=np.uint32))
    writer.close()
    table = bytearray(held.getvalue())
    reader = tokens.ShardReader(Held(bytes(table)))
    reader.table[0][2] ^= 1
    with pytest.raises(ValueError):
        list(reader)
    with pytest.raises(ValueError):
        tokens.ShardReader(Held(b"no table at the end of this"))


def test_round_trip(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = tokens.read_shards(tokens.write_shards(docs, PATH, frame_bytes=5000)).orderBy("doc_id").collect()
    start = 0
    for got, row in zip(found, docs.orderBy("doc_id").collect(), strict=True):
        ids = [*expected(row.text or ""), 1]
        assert (got.doc_id, got.start, got.n_tokens) == (row.doc_id, start, len(ids))
        assert got.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_edges(edge, nothing):
    found = tokens.read_shards(tokens.write_shards(edge, PATH)).collect()
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [None, 1, 2, 3, 3, 4, 5]
    sizes = {r.doc_id: r.n_tokens for r in found}
    assert sizes[1] == sizes[2] == sizes[4] == 1 and sizes[3] == 2 and sizes[5] == 80_001
    assert tokens.read_shards(tokens.write_shards(nothing, PATH)).collect() == []
