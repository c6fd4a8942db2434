"""What the operators share: stored cuts, files written by tasks, word hashes, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import scratch_root, ship  # noqa: F401  ship is for the operators

#: Words a worker keeps; what it meets beyond them is described each time.
CACHE_WORDS = 400_000

_kept: dict[str, object] = {}


def kept(kind: str, make: Callable[[], object]):
    """What a worker process keeps from task to task for one kind of work. It keeps one kind: when another stage
    begins, what the last one kept is given back."""
    if kind not in _kept:
        _kept.clear()
        _kept[kind] = make()
    return _kept[kind]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


class Cut:
    """A table written to the shared folder: ``df`` reads it, ``drop`` deletes it after its last reader."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = fresh_folder(self.spark, label)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)


def unused(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that ``df`` does not have, so that none of its own is lost or meant twice."""
    taken, names = {c.lower() for c in df.columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        names.append(stem)
    return names


def file_at(path: str):
    """File system and path of a URI or absolute path, for use inside tasks. Only shared folders are
    handed in."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class WordHashes(dict):
    """64-bit hash of each word of bytes, computed once per distinct word."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class WordTable(dict):
    """Numbers that describe each word of bytes, computed once per word a worker meets."""

    def __init__(self, describe: Callable[[bytes], tuple[int, ...]], columns: int):
        super().__init__()
        self.describe, self.fresh, self.extra = describe, [], []
        self.table = np.zeros((1 << 14, columns), np.uint64)

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(self.describe(word))
        at = len(self)
        self[word] = at
        if at >= CACHE_WORDS:
            self.extra.append(word)
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row for each word."""
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            while len(self.table) < len(self):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[len(self) - len(self.fresh) : len(self)] = self.fresh
            self.fresh.clear()
        found = self.table[at]
        for word in self.extra:
            del self[word]
        self.extra.clear()
        return found


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; one run of all words when there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for i in range(width):
        total = (total ^ words[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return mix(total)


_RANDOM = np.random.default_rng(20240607)
_FACTORS = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64)


def minima(members: np.ndarray, size: int) -> np.ndarray:
    """MinHash signature: for each of ``size`` hash functions the least 32-bit hash of a member."""
    least = np.full(size, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(members), 4096):
        hashed = (members[at : at + 4096, None] * _FACTORS[None, :size] + _OFFSETS[None, :size]) >> np.uint64(32)
        np.minimum(least, hashed.min(axis=0), out=least)
    return least.astype(np.uint32)


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap over the top ``bits`` bits of the only column: at most ``2**(bits - 6)`` rows reach the driver,
    whatever the number of hashes. It lets tasks leave out most of what has no partner; an exact join follows."""
    name = hashes.columns[0]
    place = F.shiftrightunsigned(name, 64 - bits)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({name}, {64 - bits}) & 63 as int))")
    rows = hashes.groupBy(F.shiftright(place, 6).alias("place")).agg(F.bit_or(bit).alias("bits")).toArrow()
    found = np.zeros(1 << (bits - 6), np.int64)
    found[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return found.view(np.uint64)


def in_bitmap(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap may hold."""
    bits = len(found).bit_length() + 5
    place = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (found[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Each node that is not the least of its component, and the least."""
    up: dict[int, int] = {}

    def root(i: int) -> int:
        while up.setdefault(i, i) != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(i), root(j)
        up[max(p, q)] = min(p, q)
    nodes = [i for i in up if up[i] != i]
    return nodes, [root(i) for i in nodes]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars in place of the links of each batch of a task: chains become short before any shuffle."""
    for batch in batches:
        a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node reachable from each node of ``edges`` (columns ``a``, ``b``).

    Links are contracted where they lie, then large and small stars in turn until nothing changes; each round
    is written to the shared folder and the one before it deleted. Links never leave the executors; only one
    count and one hash do."""
    order = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    plain = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    now = Cut(plain.mapInArrow(_contract, "a long, b long").distinct(), "edges")
    seen = _print_of(now.df)
    while seen[0]:
        both = now.df.unionByName(now.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select(*order).distinct()
        floor = down.groupBy("a").agg(F.min("b").alias("m"))
        rest = down.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = rest.unionByName(floor.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        after = Cut(stars.select(*order), "edges")
        found = _print_of(after.df)
        now.drop()
        now = after
        if found == seen:
            break
        seen = found
    labels = now.df.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node")
    roots = now.df.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return labels.unionByName(roots.join(labels.select("node"), "node", "left_anti"))


def merged(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further links ``a, b``. Only labels that these join are looked at again."""
    ends = components(joined_labels(labels, pairs).select(F.col("la").alias("a"), F.col("lb").alias("b")))
    ends = Cut(ends.select(F.col("node").alias("end"), F.col("label").alias("to")), "ends").df
    known = labels.join(ends, F.col("label") == F.col("end"), "left").select("node", F.coalesce("to", "label").alias("label"))
    alone = ends.join(labels.select("node"), F.col("end") == F.col("node"), "left_anti")
    return Cut(known.unionByName(alone.select(F.col("end").alias("node"), F.col("to").alias("label"))), "labels").df


def joined_labels(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with the labels ``la`` and ``lb`` of these."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    named = pairs.join(la, "a", "left").join(lb, "b", "left")
    named = named.withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")})
    return named.filter("la <> lb")


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return (row.n, row.h)


