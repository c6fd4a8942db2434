import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import alignment
from edge_rows import edge, nothing  # noqa: F401

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokens_of(text):
    """Ids and byte spans of both tokenizers over the whole text, or nothing where bytes differ."""
    aligner = alignment.aligner_of(A_PATH, B_PATH)
    if not text:
        return [], []
    sides = []
    for ids, of in ((aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.a_bytes), (aligner.b.encode(text), aligner.b_bytes)):
        if b"".join(of[i] for i in ids) != (" " + text).encode():
            return [], []
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(of[i])))
            at += len(of[i])
        sides.append(spans)
    return sides


def plain(text):
    """Groups and links by comparing all spans."""
    a, b = tokens_of(text)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    start, groups = 0, []
    for cut in cuts:
        groups.append(",".join(str(i) for i, s, e in a if start <= s and e <= cut) + "|" + ",".join(str(j) for j, s, e in b if start <= s and e <= cut))
        start = cut
    links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
    return len(a), len(b), groups, links


def expected(rows):
    found = [plain(t) for _, t in rows]
    docs = Counter(p for f in found for p in set(f[3]))
    best = defaultdict(int)
    for (i, _), n in docs.items():
        best[i] = max(best[i], n)
    out = []
    for (doc_id, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links), digest))
    return sorted(out, key=str)


ODD = [" ", "  ", "\n", "\t", "\r", " ", "　", "▁", "a", "foo", "'s", "<0x41>", "<s>", "<|endoftext|>", "é", "é", "İ", "漢字", "😀", "\x1c", "\x85", "\x00", ";", ")", "12", "3.5", "▁▁", "﻿", "don't"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=8) | st.sampled_from(ODD), max_size=8).map("".join))
def test_pieces_give_what_the_whole_text_gives(text):
    (numbers, digest, codes, times), *_ = alignment.aligner_of(A_PATH, B_PATH).documents([text])
    n_a, n_b, groups, links = plain(text)
    assert numbers == [n_a, n_b, len(groups), len(links)]
    assert digest == (hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
    base = alignment.aligner_of(A_PATH, B_PATH).base
    assert dict(zip(codes.tolist(), times.tolist(), strict=True)) == Counter(i * base + j for i, j in links)


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"one two {i} three\nfour été, ▁ {i * i}" for i in range(40)]
    aligner = alignment.Aligner(A_PATH, B_PATH)
    whole = [(n, d, c.tolist(), t.tolist()) for n, d, c, t in aligner.documents(texts)]
    monkeypatch.setattr(alignment, "KEPT_PIECES", 3)
    monkeypatch.setattr(alignment, "AT_ONCE", 2)
    aligner = alignment.Aligner(A_PATH, B_PATH)
    again = [(n, d, c.tolist(), t.tolist()) for x in texts for n, d, c, t in aligner.documents([x])]
    assert again == whole


def test_links_come_back():
    for codes in ([], [5], [1, 2**31, 2**40]):
        found = alignment.unpack(alignment.pack(np.array(codes, np.int64), np.arange(1, len(codes) + 1)))
        assert found[0].tolist() == codes and found[1].tolist() == list(range(1, len(codes) + 1))


@pytest.mark.parametrize("held, summed", [(1 << 18, 1 << 20), (3, 5), (0, 1)])
def test_scores_equal_comparing_all_spans(spark, small, monkeypatch, held, summed):
    """Whatever is held in arrays, and whatever a task sums before it sends it."""
    monkeypatch.setattr(alignment, "HELD", held)
    monkeypatch.setattr(alignment, "SUMMED", summed)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").filter("length(text) < 1500").collect()]
    rows += [(None, "A tie. A tie."), (7, "A tie. A tie."), (7, "A tie. A tie."), (8, "▁"), (9, ""), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(map(tuple, alignment.report(docs, A_PATH, B_PATH).collect()), key=str)
    assert found == expected(rows)


def test_edges(edge, nothing):
    found = alignment.report(edge, A_PATH, B_PATH).collect()
    assert found[0].asDict().keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    empty = [r for r in found if r.doc_id in (1, 2)]
    assert len(empty) == 2 and all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in empty)
    assert len([r for r in found if r.doc_id == 3 and r.n_a]) == 2
    assert max(r.n_a for r in found) > 80_000
    assert alignment.report(nothing, A_PATH, B_PATH).collect() == []
