"""Quality classifier: hashed word n-grams, logistic regression fitted by follow-the-regularised-leader.

Features of a text, hashed into ``2**BITS`` buckets: single words and pairs of neighbouring words, lower-
cased and without the signs around them, and runs of one to three word shapes. The shape of a word keeps
its signs and writes a run of lower-case letters as ``x``, of upper-case letters as ``X``, of digits as
``9``; so a text is seen by its words and by how it is set. Each of the two groups is scaled to length
one, a bucket weighing the square root of its count, so the length of a text does not matter.

Fitting reads a sample of at most ``max_rows`` labelled rows, those with the least hash of their id: a
documented bound, which makes one sequential learner possible. Texts are turned into sparse vectors where
they lie; only the sample's vectors go to the task that learns, which sees them ``epochs`` times in the
order of another hash. Its weights, ``2**BITS`` numbers whatever the data, are all that reaches the driver.

Scoring is one pass without a shuffle over every whole text. Null and empty texts have no features and
get the score of the bias. If no label can be used, every score is 0.5. Rows may repeat; null ids have a
null hash and are never learned from nor held out. Labels that are null are not learned from; of several
labels of one document each counts. Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import WordTable, kept, mix, ship

BITS = 18
MAX_ROWS = 12_000

_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def _describe(raw: bytes) -> tuple[int, int]:
    """Hashes of a word and of its shape."""
    text = raw.decode("utf-8", "replace")
    shape = _DIGIT.sub("9", _LOWER.sub("x", _UPPER.sub("X", text)))
    word = _EDGES.sub("", text).lower() or text
    return xxhash.xxh64_intdigest(word), xxhash.xxh64_intdigest(shape, 1)


def _words() -> WordTable:
    return kept("quality", lambda: WordTable(_describe, 2))


def _runs(codes: np.ndarray, longest: int) -> np.ndarray:
    found = []
    for n in range(1, min(longest, len(codes)) + 1):
        total = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            total = mix(total + codes[i : i + len(total)])
        found.append(total)
    return np.concatenate(found)


def features(text: str | None, words: WordTable, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in ascending order and their values."""
    split = (text or "").encode().split()
    if not split:
        return np.zeros(0, np.int64), np.zeros(0)
    codes = words.of(split)
    half = 1 << (bits - 1)
    parts = []
    for group, longest in ((0, 2), (1, 3)):
        hashed = (_runs(codes[:, group], longest) & np.uint64(half - 1)).astype(np.int64)
        at, counts = np.unique(hashed, return_counts=True)
        parts.append((at + group * half, np.sqrt(counts / counts.sum())))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, x))))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with L1 and L2 terms; the last weight is the bias."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        at, values = np.append(at, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        g = (sigmoid(float(w @ values)) - label) * values
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_rows: int = MAX_ROWS,
    bits: int = BITS,
    epochs: int = 4,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.0,
) -> np.ndarray:
    """Weights and bias learned from ``labels`` (doc_id and the label column, 0 or 1)."""
    ship(docs.sparkSession)
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    sample = (
        usable.select("doc_id", F.col(label).cast("int").alias("label"), F.xxhash64("doc_id").alias("draw"))
        .orderBy("draw", "doc_id", "label")
        .limit(max_rows)
    )
    # At most max_rows rows of 20 bytes, so the small side of the join has a proven bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pairs = [features(t, _words(), bits) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("draw"),
                        part.column("label"),
                        pa.array([p[0].astype("<u4").tobytes() for p in pairs], pa.binary()),
                        pa.array([p[1].astype("<f4").tobytes() for p in pairs], pa.binary()),
                    ],
                    names=["draw", "label", "at", "values"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            for y, at, values in zip(*(batch.column(c).to_pylist() for c in ("label", "at", "values")), strict=True):
                seen.append((y, np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(values, "<f4").astype(float)))
        model = Ftrl(1 << bits, alpha, beta, l1, l2)
        for _ in range(epochs):
            for y, at, values in seen:
                model.update(at, values, y)
        weights = model.weights(np.arange((1 << bits) + 1)).astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    found = (
        rows.mapInArrow(vectors, "draw long, label int, at binary, values binary")
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("draw", F.lit("order")), "label", "at", "values")
        .mapInArrow(learn, "weights binary")
        .collect()
    )
    if not found:
        return np.zeros((1 << bits) + 1)
    return np.frombuffer(found[0].weights, "<f4").astype(float)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted``; other columns are kept.

    Columns of these names in the input are replaced."""
    ship(docs.sparkSession)
    bits = (len(weights) - 1).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))
    kept = docs.drop("score", "predicted")

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(float)
        for batch in batches:
            found = []
            for text in batch.column("text"):
                at, values = features(text.as_py(), _words(), bits)
                found.append(sigmoid(float(w[at] @ values) + w[-1]))
            scored = np.array(found, float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scored), pa.array((scored >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    return kept.mapInArrow(scores, ", ".join([*columns, "score double", "predicted int"]))


def remainder(doc_id: str = "doc_id"):
    """The crc32 of the id as text, modulo 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def evaluate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; rows with remainder 1 are never
    learned from."""
    weights = fit(docs, labels.filter(remainder() != 1))
    held = F.coalesce(remainder() == 1, F.lit(False))
    return score(docs.select("doc_id", "text"), weights).select("doc_id", held.alias("held_out"), "score", "predicted")
