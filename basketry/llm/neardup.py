"""MinHash near-duplicates by an LSH forest.

1. Sketch: distinct runs of ``width`` words (all words as one run where there are fewer) of every whole text,
   as 64-bit hashes; from them two 64-bit prints of the set and a MinHash signature of ``SIGNATURE`` values.
2. Texts with equal sets are one representative from here on, named by the least id; a group of copies costs
   one row.
3. Forest: each of ``TREES`` trees reads the signature in an order of its own. All (tree, ordered signature)
   rows are sorted once by range partitions, so that texts with a long common prefix are neighbours, wherever
   they come from. A region is a run of rows with a common prefix; it starts at depth ``BASE``. A region of at
   most ``REGION`` texts gives its pairs. In a larger one the depth adapts: each text is paired with the two
   behind it in sorted order, with which it has the longest prefixes in common (``DEPTH`` values are sorted
   by), so a dense region gives pairs in proportion to its rows.
4. Pairs whose signatures differ too much are dropped (``SLACK`` standard deviations below the threshold). Each
   text's most similar partner is confirmed first, on full sets: shared runs against all runs, in whole numbers.
   Of the other pairs only those between different components so far are confirmed.
5. What dense regions left out: in every region that is larger or touches the edge of a partition, texts outside
   the region's largest component are compared with all texts of other components of that region, signatures
   first, then full sets, in cells of bounded size, each pair in the first tree where it shares a region. So
   leaving out pairs in step 3 loses no link between components.
6. Components of the confirmed links, by stars (``common.components``).

A pair of similarity s shares a region of one tree with probability s**BASE, of some tree 1-(1-s**BASE)**TREES:
0.99999 at 0.85, 0.9998 at 0.8.

Empty and null texts have no runs and stand alone. Null ids: such a row stands for a set only if no other row
has it, and is then linked with nothing. Rows that repeat are copies. Other columns are ignored by ``classes``
and kept by ``kept_only``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Cut, WordHashes, bitmap, components, in_bitmap, joined_labels, kept, merged, minima, mix, shingles, ship, unused

TREES, BASE, DEPTH, REGION, BLOCK = 16, 4, 8, 24, 256
SIGNATURE = 2 * TREES * BASE
SLACK = 3.5
#: Entries of a matrix of sets by members, up to which a cell's intersections are one product.
DENSE = 8_000_000
BITMAP_BITS = 24

_PREFIX = 1 + 4 * BASE
_ORDER = np.array([[(BASE * t + j) % (TREES * BASE) for j in range(DEPTH)] for t in range(TREES)])
_SKETCH = "doc_id long, n_shingles long, print1 long, print2 long, signature array<int>"


def _words() -> WordHashes:
    return kept("words", WordHashes)


def members(text: str | None, width: int, words: WordHashes) -> np.ndarray:
    """The distinct runs of a text as sorted hashes."""
    return np.unique(shingles(words.of((text or "").encode().lower().split()), width))


def sketch(docs: DataFrame, width: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, signatures = [], [], []
            for text in batch.column("text"):
                runs = members(text.as_py(), width, _words())
                sizes.append(len(runs))
                with np.errstate(over="ignore"):
                    both = mix(runs + np.uint64(1)).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(runs ^ np.uint64(0x5BF03635)))
                prints.append([int(np.uint64(x).astype(np.int64)) for x in both])
                signatures.append(minima(runs, SIGNATURE).view(np.int32) if len(runs) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()),
                    pa.array([p[1] for p in prints], pa.int64()),
                    pa.array(signatures, pa.list_(pa.int32())),
                ],
                names=["doc_id", "n_shingles", "print1", "print2", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _SKETCH)


def _binary(rows: np.ndarray) -> pa.Array:
    """Fixed-width rows of bytes as an Arrow binary column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tree and text: the tree and the signature in its order, as bytes that sort."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            n = part.num_rows
            flat = part.column("signature").flatten().to_numpy(zero_copy_only=False).view(np.uint32).reshape(n, SIGNATURE)
            keys = np.empty((n, TREES, 1 + 4 * DEPTH), np.uint8)
            keys[:, :, 0] = np.arange(TREES)
            keys[:, :, 1:] = flat[:, _ORDER].astype(">u4", order="C").view(np.uint8).reshape(n, TREES, 4 * DEPTH)
            ids = np.repeat(part.column("id").to_numpy(), TREES)
            yield pa.RecordBatch.from_arrays([_binary(keys.reshape(n * TREES, -1)), pa.array(ids)], names=["key", "id"])


def region_pairs(ids: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Pairs of a region: all of a small one; of a larger one each row with the two behind it, with which it
    has the longest prefixes in common."""
    reach = len(ids) if len(ids) <= limit else 3
    for i in range(len(ids)):
        for j in range(i + 1, min(i + reach, len(ids))):
            yield ids[i], ids[j]


def neighbours(sorted_rows: DataFrame, prefix: int, limit: int) -> DataFrame:
    """Candidate pairs of rows sorted by ``key`` within range partitions: ``kind`` 0 with ids ``a, b``;
    ``kind`` 1 says that id ``a`` is in region ``b`` which gave not all its pairs."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = b""
        ids: list[int] = []
        out: tuple[list, list, list] = ([], [], [])
        first = True

        def settle(edge: bool) -> None:
            if len(ids) > 1:
                for a, b in region_pairs(ids, limit):
                    if a != b:
                        out[0].append(0)
                        out[1].append(min(a, b))
                        out[2].append(max(a, b))
            if edge or len(ids) > limit:
                # A prefix of eight bytes is its own name.
                region = int.from_bytes(last, signed=True) if len(last) == 8 else int(np.uint64(xxhash.xxh64_intdigest(last)).astype(np.int64))
                out[0].extend([1] * len(ids))
                out[1].extend(ids)
                out[2].extend([region] * len(ids))

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names=["kind", "a", "b"]
            )
            for column in out:
                column.clear()
            return made

        for batch in batches:
            for key, i in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist(), strict=True):
                if ids and last != key[:prefix]:
                    settle(first)
                    first = False
                    ids.clear()
                last = key[:prefix]
                ids.append(i)
            if len(out[0]) >= 50_000:
                yield batch_of()
        if ids:
            settle(True)
        yield batch_of()

    return sorted_rows.mapInArrow(pair, "kind int, a long, b long")


def _agreeing(left: str, right: str) -> Column:
    """Number of equal values of two signatures."""
    return F.aggregate(F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def _sets(docs: DataFrame, needed: DataFrame, width: int) -> DataFrame:
    """``id, runs``: the full sets of the texts whose ids are ``needed``. A bitmap of these ids keeps the other
    texts out before anything is shuffled; a join on the ids follows."""
    known = Cut(needed.distinct(), "needed").df
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(known.select(F.xxhash64("id").alias("h")), BITMAP_BITS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.flatnonzero(in_bitmap(sent.value, batch.column("h").to_numpy()))
            for at in range(0, len(wanted), 512):
                part = batch.take(pa.array(wanted[at : at + 512]))
                runs = [members(t.as_py(), width, _words()).view(np.int64) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(runs, pa.list_(pa.int64()))], names=["id", "runs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id IS NOT NULL")
    found = rows.withColumn("h", F.xxhash64("id")).mapInArrow(cut, "id long, runs array<long>")
    return Cut(found.join(known, "id", "left_semi").dropDuplicates(["id", "runs"]), "sets").df


def _reaches(x: str, y: str, percent: int) -> Column:
    """Whether two full sets reach the threshold, in whole numbers."""
    shared = F.size(F.array_intersect(x, y))
    return (shared > 0) & (100 * shared >= percent * (F.size(x) + F.size(y) - shared))


def _confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that reach the threshold on full sets. Only texts that occur in a pair are cut again."""
    sets = _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), width)
    left = sets.select(F.col("id").alias("a"), F.col("runs").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("runs").alias("y"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b")
    return Cut(met.filter(_reaches("x", "y", percent)).select("a", "b"), "links").df


def linked(docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """``node, label``: components of the representatives (``id, signature``) that are linked with others."""
    s = percent / 100.0
    least = int(np.floor(SIGNATURE * (s - SLACK * np.sqrt(s * (1 - s) / SIGNATURE))))
    rows = reps.mapInArrow(_trees, "key binary, id long")
    order = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = Cut(neighbours(order, _PREFIX, REGION).distinct(), "forest")
    sa = reps.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    sb = reps.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
    likely = found.df.filter("kind = 0").select("a", "b").join(sa, "a").join(sb, "b").withColumn("alike", _agreeing("sa", "sb"))
    pairs = Cut(likely.filter(F.col("alike") >= least).select("a", "b", "alike"), "pairs")
    best = pairs.df.groupBy("b").agg(F.max(F.struct("alike", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b")
    first = Cut(best, "best")
    confirmed = _confirm(first.df, docs, width, percent)
    labels = Cut(components(confirmed), "labels").df
    rest = joined_labels(labels, pairs.df.join(first.df, ["a", "b"], "left_anti")).select("a", "b")
    rest = Cut(rest, "rest").df
    if not rest.isEmpty():
        labels = merged(labels, _confirm(rest, docs, width, percent))

    # Dense regions: rows outside the largest component of their region against the others of it.
    dense = found.df.filter("kind = 1").select(F.col("b").alias("region"), F.col("a").alias("id")).distinct()
    named = dense.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = Cut(named, "dense")
    sizes = named.df.groupBy("region", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("region").agg(F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("kinds"))
    largest = largest.filter("kinds > 1").select("region", F.col("m.label").alias("main"))
    open_ = Cut(named.df.join(largest, "region"), "open").df
    if open_.isEmpty():
        return labels
    sets = _sets(docs, open_.select("id"), width)
    rows = Cut(open_.join(reps.select("id", "signature"), "id").join(sets, "id"), "open").df
    more = Cut(links_in_cells(rows, _prefixes, lambda x, y: _equal_values(x, y) >= least, percent), "more").df
    return labels if more.isEmpty() else merged(labels, more)


def _prefixes(signatures: np.ndarray) -> np.ndarray:
    """Of each signature its region in every tree, as a number."""
    heads = signatures.view(np.uint32)[:, _ORDER[:, :BASE]].astype(np.uint64)
    codes = np.zeros(heads.shape[:2], np.uint64)
    for j in range(BASE):
        codes = mix(codes + heads[:, :, j])
    return codes


def _equal_values(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal values of each signature of one block with each of another."""
    return np.stack([(y == row).sum(axis=1) for row in x]) if len(x) else np.zeros((0, len(y)), np.int64)


def links_in_cells(rows: DataFrame, regions_of, likely, percent: int) -> DataFrame:
    """``a, b``: links between components inside regions. ``rows`` have ``region, id, label, main`` (the region's
    largest component), ``signature`` and ``runs``.

    Those outside the largest component are compared with all others of the region, in cells of about ``BLOCK``
    by ``BLOCK`` rows, so the work on one region is dealt to as many tasks as it has cells. A pair is compared in
    the first region it shares, as ``regions_of`` numbers them, if it is ``likely`` by its signatures, on full sets;
    and not if it is connected in its cell by then. Only links that connect leave a cell."""
    ship(rows.sparkSession)
    fringe = F.col("label") != F.col("main")
    sizes = rows.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).alias("down"), F.ceil(F.count_if(fringe) / BLOCK).alias("across"))
    sized = rows.join(sizes, "region")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    left = sized.filter(fringe).select("region", one("across").alias("i"), each("down").alias("j"), F.lit(0).alias("side"), "id", "label", "signature", "runs")
    right = sized.select("region", each("across").alias("i"), one("down").alias("j"), F.lit(1).alias("side"), "id", "label", "signature", "runs")

    def compare(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        side, ids = cell["side"].to_numpy(), cell["id"].to_numpy()
        labels = cell["label"].to_numpy()
        width = len(cell["signature"][0])
        signatures = cell["signature"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        runs = cell["runs"].combine_chunks()
        p, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        regions = regions_of(signatures)
        # This cell's region is one that all of its rows share; a pair that shares an earlier one is compared there.
        shared = (regions == regions[0]).all(axis=0)
        here = int(np.argmax(shared)) if shared.any() else regions.shape[1]
        earlier = np.zeros((len(p), len(q)), bool)
        for t in range(here):
            earlier |= regions[p, t][:, None] == regions[q, t][None, :]
        open_ = (labels[p][:, None] != labels[q][None, :]) & ~earlier & likely(signatures[p], signatures[q])
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        sets = {int(k): np.sort(runs[int(k)].values.to_numpy()) for k in np.unique(np.concatenate([p[open_.any(axis=1)], q[open_.any(axis=0)]]))}
        total = sum(map(len, sets.values()))
        if sets and len(sets) * total <= DENSE:
            # Small sets: all intersections of the cell in one product, which leaves only pairs that are links.
            at = {k: i for i, k in enumerate(sets)}
            _, member = np.unique(np.concatenate(list(sets.values())), return_inverse=True)
            has = np.zeros((len(sets) + 1, int(member.max(initial=0)) + 1), np.float32)
            sizes = np.array([*map(len, sets.values()), 0])
            has[np.repeat(np.arange(len(sets)), sizes[:-1]), member] = 1
            x, y = (np.array([at.get(int(k), len(sets)) for k in side_]) for side_ in (p, q))
            shared_runs = (has[x] @ has[y].T).astype(np.int64)
            open_ &= (shared_runs > 0) & (100 * shared_runs >= percent * (sizes[x][:, None] + sizes[y][None, :] - shared_runs))
        found = []
        for i, j in np.argwhere(open_).tolist():
            k, m = int(p[i]), int(q[j])
            a, b = root(int(labels[k])), root(int(labels[m]))
            if a == b:
                continue
            x, y = sets[k], sets[m]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if common and 100 * common >= percent * (len(x) + len(y) - common):
                up[a] = b
                found.append((int(min(ids[k], ids[m])), int(max(ids[k], ids[m]))))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return left.unionByName(right).groupBy("region", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    sketches = Cut(sketch(docs, width), "sketch").df
    prints = ["n_shingles", "print1", "print2"]
    sets = sketches.filter("n_shingles > 0").groupBy(*prints).agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"))
    reps = Cut(sets, "reps").df
    usable = reps.filter("id IS NOT NULL").select("id", "signature")
    labels = linked(docs, usable, width, percent)
    named = reps.select(*prints, "id").join(labels, F.col("id") == F.col("node"), "left")
    named = named.select(*prints, F.coalesce("label", "id").alias("component_id"))
    joined = sketches.select("doc_id", *prints).join(named, prints, "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def kept_only(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near-duplicates: of each component the rows of its least id; rows that repeat an id and its
    text stay once. Rows without id are dropped only as copies of each other. Columns are kept."""
    found = Cut(classes(docs, width, percent).filter("NOT kept").select("doc_id").distinct(), "dropped").df
    (text,) = unused(docs, "text_hash")
    rest = docs.join(found, "doc_id", "left_anti").withColumn(text, F.xxhash64("text"))
    return rest.dropDuplicates(["doc_id", text]).select(*[F.col(f"`{c}`") for c in docs.columns])
