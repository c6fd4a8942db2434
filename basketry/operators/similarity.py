"""Pairs of entities that share features: co-occurrence counts and cosines, exact at any skew.

Input are triples (entity, feature, weight), at most one per entity and feature; entities are whole
numbers. Joining the
triples with themselves on the feature is quadratic in the number of entities of a feature, so a
feature that a third of all entities have would decide the run time. Hence features are split:

* light features (at most ``limit`` entities) pair their entities, at most ``limit`` times as many
  pairs as triples. Entities lie in blocks; a task has two of them and sums what their pairs share
  (``blocks.pair_sums``), and only pairs that can reach the threshold become rows;
* heavy features are not expanded up front. What they can add to a pair is bounded by the heavy
  parts of the two vectors, so pairs that cannot reach the threshold are dropped first, and the
  heavy part is computed for the pairs that are left, for cosines in the same task;
* pairs that share heavy features only matter where both heavy parts alone can reach the
  threshold. Only such entities are paired on heavy features, in blocks, so that one hot feature
  is spread over many tasks; for cosines only those whose heavy shares suffice together.

No partner is dropped that could belong to the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

from basketry.functions import blocks
from basketry.functions.columns import rounded
from basketry.session import materialise, ship

_SLACK = 1.0 - 1e-9
#: More than what rounding a cosine may add to it.
_ROUNDED = 1e-6
#: Pairs of single features that one task sums, about, and rows it deals to blocks at a time.
_PAIRS_A_TASK, _ROWS_AT_ONCE = 1 << 22, 1 << 20


def shared_pairs(
    triples: DataFrame,
    *,
    min_count: int | None = None,
    min_cosine: float | None = None,
    limit: int = 200,
) -> DataFrame:
    """Unordered pairs ``a < b`` with their dot product, at or above the threshold.

    ``triples`` has the columns entity, feature, weight and is read several times; hand in a stored
    table where it is costly to compute. With ``min_count`` the weights must be 1
    and ``dot`` is the number of shared features; with ``min_cosine`` the result also has ``cosine``.
    """
    if (min_count is None) == (min_cosine is None):
        raise ValueError("give either min_count or min_cosine")

    sizes = triples.groupBy("feature").agg(F.count("*").alias("size"))
    heavy_features = materialise(sizes.filter(F.col("size") > limit), "heavy")
    vectors = _vectors(triples, heavy_features)

    def norm(x: str, y: str) -> Column:
        return F.sqrt(F.col(x).cast("double") * F.col(y).cast("double"))

    if min_count is not None:
        need: Column = F.lit(min_count - 0.5)
        reach: Column = F.least("ha", "hb").cast("double")
        strong = F.col("h") >= min_count
        able = lambda dot, na, nb, ha, hb: dot + np.minimum(ha, hb) >= min_count - 0.5
    else:
        # A cosine just below the threshold may be rounded up to it.
        need = F.lit(float(min_cosine) - _ROUNDED) * norm("na", "nb")
        reach = norm("ha", "hb")
        strong = F.col("h").cast("double") >= F.col("n").cast("double") * (float(min_cosine) ** 2) * _SLACK
        able = _able(float(min_cosine))

    formed = _pairs_of(sizes, limit)
    if heavy_features.isEmpty():
        pairs = _summed(vectors, formed, able)
    elif min_cosine is not None:
        least = (float(min_cosine) - _ROUNDED) ** 2 * _SLACK
        pairs = _summed(vectors, formed + _pairs_able(vectors.filter(F.col("size").isNotNull() & strong), least), able, least)
    else:
        hot = _expand_in_blocks(vectors.filter(F.col("size").isNotNull() & strong), limit)
        light = _summed(vectors.filter("size IS NULL"), formed, able)
        pairs = _finish(light.filter(F.col("dot") + reach >= need), hot, vectors, reach, need)
    if min_count is not None:
        return pairs.filter(F.col("dot") >= min_count).select("a", "b", "dot")
    cosine = rounded(F.col("dot").cast("double") / norm("na", "nb"), 6)
    return pairs.withColumn("cosine", cosine).filter(F.col("cosine") >= min_cosine).select("a", "b", "dot", "cosine")


def _pairs_of(sizes: DataFrame, limit: int) -> int:
    """Pairs that the light features form."""
    formed = F.sum(F.col("size") * (F.col("size") - 1) / 2)
    return int(sizes.filter(F.col("size") <= limit).agg(formed).first()[0] or 0)


def _pairs_able(rows: DataFrame, least: float) -> int:
    """At most so many pairs have a heavy feature in common and shares of heavy features whose product is ``least``.
    Shares are told by level, halves, quarters and so on."""
    share = F.log2(F.col("n").cast("double") / F.col("h").cast("double")) - 1e-9
    levelled = rows.select("feature", F.greatest(F.floor(share).cast("int"), F.lit(0)).alias("level"))
    counts = materialise(levelled.groupBy("feature", "level").agg(F.count("*").alias("c")), "levels")
    others = counts.select("feature", F.col("level").alias("other"), F.col("c").alias("theirs"))
    met = counts.join(others, "feature").filter(F.col("level") + F.col("other") <= math.floor(1e-9 - math.log2(least)))
    return int(met.agg(F.sum(F.col("c") * F.col("theirs")) / 2).first()[0] or 0)


def _able(cosine: float):
    """Whether pairs can reach ``cosine`` with what heavy features may add; more than those that do."""
    least = cosine - _ROUNDED - 1e-9

    def able(dot, na, nb, ha, hb):
        return dot + np.sqrt(ha * hb) >= least * np.sqrt(na * nb)

    return able


def _summed(rows: DataFrame, formed: int, able, least: float | None = None) -> DataFrame:
    """Pairs ``a < b`` that share light features, with their dot product over these; those only that are ``able``. With
    ``least`` heavy features (with a ``size``) are among the rows and in the dot product (``blocks.pair_sums``).

    The pairs of single features, ``formed`` in all, never are rows: entities are dealt to blocks, and a task pairs those
    of two blocks. A row goes to as many tasks as there are blocks, the root of the pairs; a task forms a fixed number."""
    ship(rows.sparkSession)
    count = max(1, math.ceil(math.sqrt(2 * formed / _PAIRS_A_TASK)))
    types = {c: rows.schema[c].dataType for c in ("entity", "feature", "weight", "n", "h")}
    rows = rows.select(*types, F.col("size").isNotNull().alias("hot")).filter("entity IS NOT NULL AND feature IS NOT NULL AND weight IS NOT NULL")
    if not isinstance(types["feature"], IntegralType):
        numbers = materialise(rows.select("feature").distinct().withColumn("code", F.monotonically_increasing_id()), "features")
        rows = rows.join(numbers, "feature").drop("feature").withColumnRenamed("code", "feature")
    plain = rows.select(*[F.col(c).cast("long").alias(c) for c in ("entity", "feature")], *[F.col(c).cast("double").alias(c) for c in ("weight", "n", "h")], "hot")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= _ROWS_AT_ONCE:
                yield from blocks.shares(pa.Table.from_batches(held), count)
                held, size = [], 0
        if size:
            yield from blocks.shares(pa.Table.from_batches(held), count)

    dealt = plain.mapInArrow(deal, blocks.SHARES).repartition(count * (count + 1) // 2, "cell")
    sums = ", ".join(f"{c} double" for c in ("dot", "na", "nb", "ha", "hb"))
    found = dealt.groupBy("cell").applyInArrow(lambda cell: blocks.pair_sums(cell, count, able, least), f"a long, b long, {sums}")
    whole = "double" if isinstance(types["weight"], (DoubleType, FloatType)) else "long"
    kinds = {"a": types["entity"], "b": types["entity"], "dot": whole, "na": types["n"], "nb": types["n"], "ha": types["h"], "hb": types["h"]}
    no = F.lit(False)
    return found.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()], no.alias("sa"), no.alias("sb"))


def _vectors(triples: DataFrame, heavy_features: DataFrame) -> DataFrame:
    """The triples with the size of heavy features (null for light ones) and, per entity, the
    squared norm ``n`` and its heavy part ``h``. Nothing is joined that is not needed."""
    marked = triples.join(heavy_features, "feature", "left")
    square = F.col("weight") * F.col("weight")
    parts = marked.groupBy("entity").agg(
        F.sum(square).alias("n"), F.sum(F.when(F.col("size").isNotNull(), square).otherwise(F.lit(0))).alias("h")
    )
    # Several branches read the result: written once, it is not computed per branch.
    return materialise(marked.join(parts, "entity"), "vectors")


def _finish(light: DataFrame, hot: DataFrame, vectors: DataFrame, reach: Column, need: Column) -> DataFrame:
    """Pairs of light features and of heavy ones together, with the heavy part of those that miss it and can still
    reach the threshold."""
    both = light.unionByName(hot.select(light.columns))
    ends = [F.max(c).alias(c) for c in ("na", "nb", "ha", "hb", "sa", "sb")]
    found = materialise(both.groupBy("a", "b").agg(F.sum("dot").alias("dot"), *ends), "pairs")
    # Complete: no heavy part on one side, or both strong, so that the heavy join saw the pair.
    complete = (F.col("ha") == 0) | (F.col("hb") == 0) | (F.col("sa") & F.col("sb"))
    short = found.filter(~complete & (F.col("dot") + reach >= need))
    heavy_rows = vectors.filter("size IS NOT NULL").select("entity", "feature", "weight")
    left = heavy_rows.select(F.col("entity").alias("a"), "feature", F.col("weight").alias("wa"))
    right = heavy_rows.select(F.col("entity").alias("b"), "feature", F.col("weight").alias("wb"))
    rest = (
        short.select("a", "b")
        .join(left, "a")
        .join(right, ["b", "feature"])
        .groupBy("a", "b")
        .agg(F.sum(F.col("wa") * F.col("wb")).alias("more"))
    )
    finished = short.join(rest, ["a", "b"], "left").withColumn("dot", F.col("dot") + F.coalesce("more", F.lit(0)))
    return found.filter(complete).unionByName(finished.drop("more"))


def _side(df: DataFrame, name: str, on: list[str], strong: Column) -> DataFrame:
    return df.select(
        *on,
        F.col("entity").alias(name),
        F.col("weight").alias(f"w{name}"),
        F.col("n").alias(f"n{name}"),
        F.col("h").alias(f"h{name}"),
        strong.alias(f"s{name}"),
    )


def _pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    joined = left.join(right, on).filter(F.col("a") < F.col("b"))
    return joined.select("a", "b", (F.col("wa") * F.col("wb")).alias("dot"), "na", "nb", "ha", "hb", "sa", "sb")


def _expand(rows: DataFrame, on: list[str]) -> DataFrame:
    no = F.lit(False)
    return _pairs(_side(rows, "a", on, no), _side(rows, "b", on, no), on)


def _expand_in_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Pairs within each heavy feature. Its entities are cut into blocks of about ``limit`` and
    every pair of blocks is a join key of its own."""
    blocks = F.ceil(F.col("size") / F.lit(limit)).cast("int")
    own = rows.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("entity"), F.col("_blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    on = ["feature", "_row", "_column"]
    yes = F.lit(True)
    left = _side(own.withColumn("_row", F.col("_own")).withColumn("_column", others), "a", on, yes)
    right = _side(own.withColumn("_column", F.col("_own")).withColumn("_row", others), "b", on, yes)
    return _pairs(left, right, on)


def _expand_able(rows: DataFrame, limit: int, cosine: float) -> DataFrame:
    """As ``_expand_in_blocks``, only of entities whose heavy parts can reach ``cosine`` together.

    The product of the shares that the heavy parts have in the two vectors has to be ``cosine`` squared at least.
    Shares are told by level, halves, quarters and so on; blocks hold one level and meet only where the two levels
    allow it. So a feature that many entities have beside others does not pair them all."""
    top = math.floor(-2 * math.log2(cosine) + 1e-9)
    share = F.log2(F.col("n").cast("double") / F.col("h").cast("double")) - 1e-9
    levelled = rows.drop("size").withColumn("_level", F.greatest(F.floor(share).cast("int"), F.lit(0)))
    blocks = F.ceil(F.count("*") / F.lit(limit)).cast("int").alias("_blocks")
    counts = materialise(levelled.groupBy("feature", "_level").agg(blocks), "levels")
    own = levelled.join(counts, ["feature", "_level"]).withColumn("_own", F.pmod(F.xxhash64("entity"), F.col("_blocks")).cast("int"))
    partners = counts.select("feature", F.col("_level").alias("_other"), F.col("_blocks").alias("_others"))
    met = own.join(partners, "feature").filter(F.col("_level") + F.col("_other") <= top)
    met = met.withColumn("_theirs", F.explode(F.sequence(F.lit(0), F.col("_others") - 1)))
    on = ["feature", "_la", "_row", "_lb", "_column"]
    left = met.withColumnsRenamed({"_level": "_la", "_own": "_row", "_other": "_lb", "_theirs": "_column"})
    right = met.withColumnsRenamed({"_level": "_lb", "_own": "_column", "_other": "_la", "_theirs": "_row"})
    yes = F.lit(True)
    return _pairs(_side(left, "a", on, yes), _side(right, "b", on, yes), on)


def prefix_pairs(triples: DataFrame, min_cosine: float, limit: int = 1000) -> DataFrame:
    """Unordered pairs ``a < b`` with their ``cosine`` at or above the threshold, by prefix filtering.

    The features of an entity stand in one global order, rare ones first. Only those are joined from which on
    the rest of the vector still has ``min_cosine`` of its length: two vectors that reach the threshold share
    such a feature in both, namely the first they share. So features that most entities have are hardly ever
    joined, and the pairs that are can reach the threshold. Weights must not be negative."""
    sizes = triples.groupBy("feature").agg(F.count("*").alias("size"))
    square = F.col("weight").cast("double") * F.col("weight").cast("double")
    # Products over light features are summed in whole; prefixes are needed of the heavy ones only.
    rare_first = Window.partitionBy("entity").orderBy("size", "feature")
    whole = Window.partitionBy("entity")
    heavy = F.col("size") > limit
    ranked = triples.join(sizes, "feature").withColumns(
        {
            "n": F.sum(square).over(whole),
            "h": F.sum(F.when(heavy, square).otherwise(F.lit(0.0))).over(whole),
            "rest": F.sum(square).over(rare_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    kept = ["entity", "feature", F.col("weight").cast("double").alias("weight"), "n", "h", "rest"]
    vectors = materialise(ranked.select(*kept, F.when(heavy, F.col("size")).alias("size")), "prefixes")
    norm = F.sqrt(F.col("na") * F.col("nb"))
    need, reach = F.lit(min_cosine - _ROUNDED) * norm, F.sqrt(F.col("ha") * F.col("hb"))
    light = _summed(vectors.filter("size IS NULL"), _pairs_of(sizes, limit), _able(min_cosine))
    hot = vectors.filter("size IS NOT NULL")
    if hot.isEmpty():
        pairs = light
    else:
        prefix = hot.filter((F.col("rest") >= F.col("n") * (min_cosine**2) * _SLACK) & (F.col("h") >= F.col("n") * (min_cosine**2) * _SLACK)).drop("size")
        # A popular feature may be the only one of many entities: the pairs of such a feature are formed in blocks.
        common = prefix.groupBy("feature").agg(F.count("*").alias("size"))
        rows = materialise(prefix.join(common, "feature").withColumn("weight", F.lit(0.0)), "prefix")
        few = _expand(rows.filter(F.col("size") <= limit), ["feature"])
        many = _expand_in_blocks(rows.filter(F.col("size") > limit), limit).withColumns({"sa": F.lit(False), "sb": F.lit(False)})
        pairs = _finish(light.filter(F.col("dot") + reach >= need), few.unionByName(many).distinct(), vectors, reach, need)
    cosine = rounded(F.col("dot") / norm, 6)
    return pairs.select("a", "b", cosine.alias("cosine")).filter(F.col("cosine") >= min_cosine)


def profiles(triples: DataFrame) -> DataFrame:
    """``entity -> profile``: entities with the same features and weights share a profile, named
    after the least of them. Collapsing copies keeps a large group of equal customers from
    producing all their pairs, which would all be 1.

    Vectors are compared by two independent 64-bit hashes combined over their entries, so no
    vector is collected."""
    entry = [F.col("feature"), F.col("weight")]
    prints = triples.groupBy("entity").agg(
        F.count("*").alias("_k"),
        F.bit_xor(F.xxhash64(*entry)).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit("second"), *entry)).alias("_y"),
    )
    leaders = prints.groupBy("_k", "_x", "_y").agg(F.min("entity").alias("profile"), F.count("*").alias("members"))
    return prints.join(leaders, ["_k", "_x", "_y"]).select("entity", "profile", "members")


def profile_vectors(triples: DataFrame, membership: DataFrame) -> DataFrame:
    """The triples of one member per profile."""
    leaders = membership.filter("entity = profile").select("entity")
    return triples.join(leaders, "entity", "left_semi")
