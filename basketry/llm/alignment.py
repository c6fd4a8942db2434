"""Cross-tokenizer alignment: which ids of one tokenizer cover the bytes of which ids of another.

A is a byte-level BPE of the ``tokenizers`` library over a space and the text, B a ``sentencepiece`` model over the
text, to which it adds that space. Both give the same bytes, token by token. Offsets where tokens of both end cut
the tokens into groups; tokens whose bytes overlap are linked; a pair of ids counts the documents that hold it linked.

1. Identity map: an array gives for each A id the B id of the same bytes, or none.
2. A text is cut where neither tokenizer can look across: before a space or line feed that follows a character
   other than white space. A worker aligns each distinct piece once. Where all tokens of a piece are one to one by
   the identity map, there is nothing to align. A text with a piece whose bytes differ is encoded and aligned whole.
3. The documents are written once, with their numbers, the digest of their groups and their distinct links packed.
4. Identity links are counted by each task in a vector as long as A's vocabulary; one short row an id leaves the
   task. Only the other links enter the shuffle of pairs, summed within tasks first.
5. Scores of a document come from the counts: identity links and the most frequent other pairs from arrays (at most
   as long as the vocabulary, and ``HELD`` pairs), every other pair from a join on the pair. A pair that a third of
   the documents hold is among the most frequent, so the join has no hot key.

Null and empty texts, and texts whose bytes either tokenizer changes, have no tokens: zeros and an empty digest.
Special tokens' names in a text are plain text. Repeated rows and rows with equal or null ids are documents of their
own. Other columns are ignored. Empty tables give empty results. Texts are never cut short; a piece is as long as
the text when it has no white space.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Cut, ship
from basketry.llm.tokens import parts_of

#: Pieces a worker keeps; it starts anew beyond them. Pieces encoded at once. Characters of texts taken at once.
KEPT_PIECES, AT_ONCE, CHARACTERS = 500_000, 16_384, 1 << 20
#: Pairs held in arrays. Pairs a task sums before it sends them.
HELD, SUMMED = 1 << 18, 1 << 20

#: From a space or line feed after another character to the next such place.
_PIECES = re.compile(r"\s+(?:\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?)?").findall

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others
    in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and what a worker has learnt about pieces of text."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.base = len(self.b_bytes)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (list(map(str, range(len(x)))) for x in (self.a_bytes, self.b_bytes))
        of_bytes = {p: i for i, p in reversed(list(enumerate(self.b_bytes)))}
        self.identity = np.array([of_bytes.get(p, -1) for p in self.a_bytes], np.int64)
        self.cuts = self._cuts_are_safe(a_path, pieces)
        self._forget()

    def _cuts_are_safe(self, a_path: str, pieces: list[str]) -> bool:
        """Whether neither tokenizer looks across the places where texts are cut."""
        with open(a_path, encoding="utf-8") as held:
            settings = json.load(held)
        before = settings["pre_tokenizer"] or {}
        plain = settings["normalizer"] is None and before.get("type") == "ByteLevel"
        plain = plain and not before.get("add_prefix_space") and before.get("use_regex", True)
        # A piece of B may hold the sign for a space at its beginning only, and no line feed.
        across = [p for p in pieces if "\n" in p or re.search("[^▁]▁", p)]
        same = all(self.b.decode(self.b.encode(t)) == t for t in (" a", "a  b ", "Å ﬁ é  .", "\ta　"))
        return bool(plain and same and not across)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.numbers = np.zeros((1 << 12, 5), np.int32)
        self.codes = np.zeros(1 << 14, np.int64)
        self.first = np.zeros((1 << 12) + 1, np.int64)

    def align(self, a: list[int], b: list[int]) -> tuple[int, bytes, np.ndarray]:
        """Groups, their text, and the code ``a * base + b`` of each link, for tokens of the same bytes."""
        n_groups, texts, links, _ = self._align_all([a], [b])
        return int(n_groups[0]), texts[0], links

    def _align_all(self, of_a: list[list[int]], of_b: list[list[int]]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """The same for many pieces of text at once, none empty: numbers of groups, texts, links of all, and where
        the links of each piece end. Between two neighbouring ends, of A or of B, lies the overlap of one A token
        with one B token, so every such end is a link, and an end of both closes a group."""
        flat_a = np.array([i for x in of_a for i in x], np.int64)
        flat_b = np.array([i for x in of_b for i in x], np.int64)
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        last = ends_a[np.cumsum([len(x) for x in of_a]) - 1]
        ends = np.union1d(ends_a, ends_b)
        links = flat_a[np.searchsorted(ends_a, ends)] * self.base + flat_b[np.searchsorted(ends_b, ends)]
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        # Places behind the last token of each group, in A and in B, and behind the last group of each piece.
        cut_a, cut_b = np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1
        of_piece = np.searchsorted(both, last) + 1
        name_a, name_b = self.a_names, self.b_names
        texts, i, j = [], 0, 0
        for p, q, x, y in zip(cut_a.tolist(), cut_b.tolist(), flat_a[cut_a - 1].tolist(), flat_b[cut_b - 1].tolist(), strict=True):
            if p - i == 1 and q - j == 1:
                texts.append(f"{name_a[x]}|{name_b[y]}")
            else:
                texts.append(f"{','.join([name_a[k] for k in flat_a[i:p].tolist()])}|{','.join([name_b[k] for k in flat_b[j:q].tolist()])}")
            i, j = p, q
        starts = [0, *of_piece[:-1].tolist()]
        joined = [";".join(texts[f:t]).encode() for f, t in zip(starts, of_piece.tolist(), strict=True)]
        return np.diff(of_piece, prepend=0), joined, links, np.searchsorted(ends, last) + 1

    def _same(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode()
        return b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b])

    def whole(self, text: str | None) -> tuple[int, int, int, bytes, np.ndarray]:
        """Numbers of A, B and groups, the groups' text and the links of a text, encoded as a whole."""
        if not text:
            return 0, 0, 0, b"", np.zeros(0, np.int64)
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        if not self._same(" " + text, a, b):
            return 0, 0, 0, b"", np.zeros(0, np.int64)
        return len(a), len(b), *self.align(a, b)

    def _learn(self, pieces: list[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if p not in self.known]
        for at in range(0, len(new), AT_ONCE):
            self._learn_some(new[at : at + AT_ONCE])

    def _learn_some(self, new: list[str]) -> None:
        of_a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        # B adds the space that a piece begins with; one that begins with a line feed has it cut off again.
        of_b = self.b.encode([p[1:] if p[0] == " " else p for p in new], num_threads=1)
        of_b = [b if p[0] == " " else b[1:] for p, b in zip(new, of_b, strict=True)]
        # Bytes that agree as a whole agree in each piece, if each side has the pieces' lengths.
        lengths = np.cumsum([len(p.encode()) for p in new])
        whole = [i for a in of_a for i in a], [i for b in of_b for i in b]
        good = [True] * len(new)
        ends = [np.cumsum(sizes[flat])[np.cumsum(list(map(len, ids))) - 1] for sizes, flat, ids in ((self.a_sizes, whole[0], of_a), (self.b_sizes, whole[1], of_b))]
        if not all(np.array_equal(e, lengths) for e in ends) or not self._same("".join(new), *whole):
            good = [self._same(p, a, b) for p, a, b in zip(new, of_a, of_b, strict=True)]
        here = [k for k, g in enumerate(good) if g]
        numbers, ends, codes, texts = np.zeros((len(new), 5), np.int32), np.zeros(len(new), np.int64), np.zeros(0, np.int64), [b""] * len(new)
        if here:
            n_groups, found, codes, stops = self._align_all([of_a[k] for k in here], [of_b[k] for k in here])
            tokens = np.array([(len(of_a[k]), len(of_b[k])) for k in here])
            numbers[here] = np.column_stack([tokens, n_groups, np.diff(stops, prepend=0), np.ones(len(here), np.int64)])
            ends[here] = np.diff(stops, prepend=0)
            for k, text in zip(here, found, strict=True):
                texts[k] = text
        n, held = len(self.groups), int(self.first[len(self.groups)])
        self.groups += texts
        while len(self.numbers) < len(self.groups):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.first = np.concatenate([self.first, np.zeros(len(self.first) - 1, np.int64)])
        while len(self.codes) < held + len(codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.numbers[n : n + len(new)] = numbers
        self.first[n + 1 : n + 1 + len(new)] = held + np.cumsum(ends)
        self.codes[held : held + len(codes)] = codes
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def documents(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray, np.ndarray]]:
        """For each text its NUMBERS, the digest of its groups, and its distinct links with how often it has each."""
        cut = [_PIECES(" " + t) if t and self.cuts else [] for t in texts]
        if len(self.known) > KEPT_PIECES:
            self._forget()
        self._learn([p for pieces in cut for p in pieces])
        at = [list(map(self.known.__getitem__, pieces)) for pieces in cut]
        good = [bool(a) and bool(self.numbers[a, 4].all()) for a in at]
        at = [a if g else [] for a, g in zip(at, good, strict=True)]
        sizes = np.array([len(a) for a in at], np.int64)
        flat = np.array([i for a in at for i in a], np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        numbers = np.zeros((len(texts), 4), np.int64)
        for k in range(4):
            numbers[:, k] = np.bincount(owner, self.numbers[flat, k], len(texts))
        # Distinct pieces of each text, then the distinct links of these.
        keys, times = np.unique((owner << 32) | flat, return_counts=True)
        piece, owner = keys & 0xFFFFFFFF, keys >> 32
        start, length = self.first[piece], self.first[piece + 1] - self.first[piece]
        total = np.cumsum(length)
        places = np.repeat(start - total + length, length) + np.arange(int(total[-1]) if len(total) else 0)
        codes, owner, times = self.codes[places], np.repeat(owner, length), np.repeat(times, length)
        order = np.lexsort((codes, owner))
        codes, owner, times = codes[order], owner[order], times[order]
        fresh = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])])) if len(codes) else np.zeros(0, np.int64)
        times = np.add.reduceat(times, fresh) if len(fresh) else times
        codes, owner = codes[fresh], owner[fresh]
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i, text in enumerate(texts):
            if good[i]:
                digest = hashlib.sha256(b";".join(map(self.groups.__getitem__, at[i]))).hexdigest()
                yield numbers[i].tolist(), digest, codes[bounds[i] : bounds[i + 1]], times[bounds[i] : bounds[i + 1]]
                continue
            n_a, n_b, n_groups, groups, links = self.whole(text)
            found, often = np.unique(links, return_counts=True)
            yield [n_a, n_b, n_groups, len(links)], hashlib.sha256(groups).hexdigest() if n_a else "", found, often


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner_of(a_path: str, b_path: str) -> Aligner:
    """The aligner of this worker process; it keeps one."""
    if (a_path, b_path) not in _aligners:
        _aligners.clear()
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


_pack = zstandard.ZstdCompressor(level=1).compress
_unpack = zstandard.ZstdDecompressor().decompress


def pack(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Distinct sorted codes as differences, then how often each comes."""
    if not len(codes):
        return b""
    steps = np.diff(codes, prepend=0)
    wide = np.uint32 if steps.max() < 2**32 else np.uint64
    raw = np.array([len(codes), np.dtype(wide).itemsize], "<u4").tobytes() + steps.astype(wide).tobytes() + times.astype(np.uint32).tobytes()
    return _pack(raw)


def unpack(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = _unpack(held)
    n, size = np.frombuffer(raw, "<u4", 2).tolist()
    steps = np.frombuffer(raw, f"<u{size}", n, 8).astype(np.int64)
    return np.cumsum(steps), np.frombuffer(raw, "<u4", n, 8 + size * n).astype(np.int64)


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A stored row (ALIGNED) for each document; ``row`` tells it from all others."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for part in parts_of(texts, CHARACTERS):
                found = [(*n, digest, pack(c, t)) for n, digest, c, t in aligner.documents(texts[part])]
                columns = [list(range(row, row + len(found))), ids[part], *map(list, zip(*found, strict=True))]
                types = [pa.int64()] * 6 + [pa.string(), pa.binary()]
                names = ["row", "doc_id", *NUMBERS, "groups_sha256", "links"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                row += len(found)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return Cut(texts.mapInArrow(rows, ALIGNED), "aligned").df


def _is_identity(codes: np.ndarray, identity: np.ndarray, base: int) -> np.ndarray:
    return identity[codes // base] == codes % base


def pair_counts(aligned: DataFrame, identity: np.ndarray, base: int) -> DataFrame:
    """``code, docs``: the documents that hold each linked pair of ids, stored. Identity pairs leave a task as one
    vector; other pairs are summed in the task as far as ``SUMMED`` of them go."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(identity), np.int64)
        codes, docs, loose = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([codes, *loose])
            weights = np.concatenate([docs, np.ones(len(every) - len(codes), np.int64)])
            found, inverse = np.unique(every, return_inverse=True)
            return found, np.bincount(inverse, weights, len(found)).astype(np.int64)

        def out(codes: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(docs)], names=["code", "docs"])

        waiting = 0
        for batch in batches:
            for held in batch.column(0).to_pylist():
                mine = unpack(held)[0]
                same = _is_identity(mine, identity, base)
                vector[mine[same] // base] += 1  # the codes of a document are distinct, so are these ids
                loose.append(mine[~same])
                waiting += len(loose[-1])
                if waiting >= SUMMED:
                    codes, docs = summed()
                    loose, waiting = [], 0
                    if len(codes) >= SUMMED:
                        yield out(codes, docs)
                        codes, docs = codes[:0], docs[:0]
        codes, docs = summed()
        yield out(codes, docs)
        ids = np.flatnonzero(vector)
        yield out(ids * base + identity[ids], vector[ids])

    parts = aligned.select("links").mapInArrow(rows, "code long, docs long")
    return Cut(parts.groupBy("code").agg(F.sum("docs").alias("docs")), "pairs").df


def _most_frequent(pairs: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """A power of two, and the pairs of at least so many documents: the least such power that leaves ``HELD`` pairs
    at most. One row for each power reaches the driver first."""
    by_power = pairs.groupBy(F.floor(F.log2("docs")).cast("int").alias("p")).count().collect()
    sizes, least, total = {r.p: r["count"] for r in by_power}, 0, 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > HELD:
            least = p + 1
            break
    held = pairs.filter(F.col("docs") >= (1 << least)).toArrow()
    codes = held["code"].to_numpy()
    order = np.argsort(codes)
    return 1 << least, codes[order], held["docs"].to_numpy()[order]


SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<long>, times array<long>"


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id``, NUMBERS, ``n_best`` (links whose pair is as frequent as any of its A id), ``count_sum`` (documents
    of its pair, summed over links) and ``groups_sha256`` of every document."""
    spark = docs.sparkSession
    aligner = aligner_of(a_path, b_path)
    identity, base = aligner.identity, aligner.base
    aligned = align_documents(docs, a_path, b_path)
    counts = pair_counts(aligned, identity, base)
    a_id = F.expr(f"code div {base}L")

    # At most one row for each A id comes to the driver here, twice.
    best = np.zeros(len(identity), np.int64)
    for r in counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("docs")).collect():
        best[r.a] = r.docs
    same = spark.createDataFrame([(int(i) * base + int(j),) for i, j in enumerate(identity) if j >= 0], "code long")
    vector = np.zeros(len(identity), np.int64)
    # Bounded by the vocabulary, whatever the corpus.
    for r in counts.join(F.broadcast(same), "code").collect():
        vector[r.code // base] = r.docs
    pairs = counts.join(F.broadcast(same), "code", "left_anti")
    least, held_codes, held_docs = _most_frequent(pairs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for held in batch.column(7).to_pylist():
                codes, times = unpack(held)
                a = codes // base
                docs = np.where(_is_identity(codes, identity, base), vector[a], 0)
                if len(held_codes):
                    at = np.minimum(np.searchsorted(held_codes, codes), len(held_codes) - 1)
                    docs = np.where(held_codes[at] == codes, held_docs[at], docs)
                rest = docs == 0
                rows.append((int(times[~rest & (docs == best[a])].sum()), int((times * docs).sum()), codes[rest], times[rest]))
            n_best, count_sum, rest, times = zip(*rows, strict=True) if rows else ([], [], [], [])
            long = pa.list_(pa.int64())
            added = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(rest, long), pa.array(times, long)]
            names = ["row", "doc_id", *NUMBERS, "groups_sha256", "n_best", "count_sum", "rest", "times"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *added], names=names)

    scored = Cut(aligned.mapInArrow(score, SCORED), "scored").df
    rare = pairs.filter(F.col("docs") < least)
    tops = spark.createDataFrame([(i, n) for i, n in enumerate(best.tolist()) if n], "a long, top long")
    rare = rare.withColumn("a", a_id).join(F.broadcast(tops), "a")
    links = scored.select("row", F.explode(F.arrays_zip(F.col("rest").alias("code"), F.col("times").alias("times"))).alias("x")).select("row", "x.code", "x.times")
    more = links.join(rare, "code").groupBy("row").agg(
        F.sum(F.when(F.col("docs") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"),
    )
    return scored.join(more, "row", "left").select(
        "doc_id",
        *NUMBERS,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
