"""Mixing sources to target weights: a splitting tree over blocks. DataFrame functions only.

* Size of a document: its number of runs of characters other than ASCII white space (null: 0).
* Targets: sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
  all words. No target exceeds ``most`` times its source; the excess goes to the others by weight until
  none is above. That fixed point is ``least(most * source, weight * level)`` for one level, found from
  sums over the sources ordered by the level at which they fill up.
* Drawing: every document has a hash of the seed, its id and its text, which puts it into one of
  ``BLOCKS`` blocks of its source and, within it, into one of ``FINE`` parts. A source is drawn in whole
  passes; the rest of its target takes blocks in the order of a hash as long as they fit, then parts of
  the smallest other block, then documents of the smallest other part, as near to the rest as whole
  documents allow. So the draw comes near its target without ranking the documents of a source, and
  each document is taken ``most`` times at most.
* Shards: a unit is one drawn block in one pass. At each node of a binary tree the units of a node are
  put in random order and the first half goes left, which draws the sources' quotas of a child from the
  multivariate hypergeometric law, exactly and without replacement. The tree ranks units, of which there
  are at most ``most * BLOCKS`` per source whatever the number of documents.

Hashes depend on seed, id and text, so reruns agree. Rows with equal id, source and text fall into the same
part; as many of them are taken as come nearest to the target, whichever these are. Null ids and sources are
kept; an empty table gives an empty result; only doc_id, text and source are read by ``plan``, all columns but
``mix_pass`` and ``mix_shard`` are kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.ranking import number_rows
from basketry.llm.common import unused
from basketry.session import materialise

BLOCKS, FINE = 64, 1024
_WORD = r"[^\x20\x09-\x0D]+"
_TRIPLE = ["source", "block", "fine"]


def _hash(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def sized(docs: DataFrame, seed: int) -> DataFrame:
    draw = _hash(F.lit(seed), "doc_id", "source", F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        draw.alias("draw"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumns(
        {
            "block": F.pmod("draw", F.lit(BLOCKS)).cast("int"),
            "fine": F.pmod(F.shiftrightunsigned("draw", 20), F.lit(FINE)).cast("int"),
        }
    )


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from one row per source with its ``source_size``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("weight", table[((F.row_number().over(order) - 1) % len(weights)).cast("int")])
    cap = F.col("source_size") * F.lit(float(most))
    ranked = weighed.withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    sums = ranked.withColumns(
        {
            "filled": F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)),
            "open": F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
            "place": F.row_number().over(by_level),
            "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
        }
    )
    # The level if this source and all later ones were open; the first that stays under its own fill
    # level is right. When all are full there is none.
    level = (F.col("budget") - F.coalesce("filled", F.lit(0.0))) / F.col("open")
    first = F.when(level <= F.col("full_at"), F.struct("place", level.alias("level")))
    return sums.withColumn("level", F.min(first).over(everything)["level"]).select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target"),
    )


def _greedy(rows: DataFrame, keys: list[str], item: str, order: Column, rest: str) -> DataFrame:
    """Take ``words`` of the items of a group in random order as long as they fit into ``rest``: state 2
    for those taken, 1 for the smallest of the others, in which the rest (``left``) ends, else 0. A
    group has at most ``BLOCKS`` or ``FINE`` items."""
    items = F.array_sort(F.collect_list(F.struct(order.alias("order"), F.col(item).alias("item"), "words")))
    grouped = rows.groupBy(*keys).agg(items.alias("items"), F.max(rest).cast("double").alias("rest"))
    nothing = F.struct(F.col("rest").alias("left"), F.array().cast("array<int>").alias("taken"))

    def step(state: Column, x: Column) -> Column:
        more = F.struct((state["left"] - x["words"]).alias("left"), F.array_append(state["taken"], x["item"]).alias("taken"))
        # Items without words change no total; they would only be taken once too often.
        return F.when((x["words"] > 0) & (x["words"] <= state["left"]), more).otherwise(state)

    done = grouped.withColumn("done", F.aggregate("items", nothing, step)).withColumns(
        {"left": F.col("done.left"), "taken": F.col("done.taken")}
    )
    others = F.filter("items", lambda x: (x["words"] > 0) & ~F.array_contains(F.col("taken"), x["item"]))
    smallest = F.array_min(F.transform(others, lambda x: F.struct(x["words"], x["item"])))["item"]
    state = (
        F.when(F.array_contains("taken", F.col("x.item")), F.lit(2))
        .when((F.col("left") > 0) & (F.col("x.item") == F.col("ends_in")), F.lit(1))
        .otherwise(F.lit(0))
    )
    return (
        done.withColumn("ends_in", smallest)
        .withColumn("x", F.explode("items"))
        .select(*keys, F.col("x.item").alias(item), state.alias("state"), "left")
    )


def plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    shards: int = 16,
    seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, and ``copies``, an array of
    (pass, shard) for each time it is taken. Local order within a shard is that of ``draw`` and pass."""
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    rows = materialise(sized(docs, seed), "sized")
    parts = materialise(rows.groupBy(*_TRIPLE).agg(F.sum("size").alias("words")), "parts")
    sources = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = materialise(
        targets(sources, weights, share, most)
        .withColumn("passes", F.least(full, F.lit(most)).cast("int"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "goals",
    )

    # Whole blocks of the last pass, then parts of the block where the rest of a source ends, then
    # documents of the part where it ends.
    blocks = parts.groupBy("source", "block").agg(F.sum("words").alias("words"))
    same = lambda *names: [F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]
    with_rest = blocks.alias("l").join(goal.alias("r"), same("source"), "left").select("l.*", "r.rest")
    chosen = _greedy(with_rest, ["source"], "block", _hash(F.lit(seed + 1), "source", "block"), "rest")
    drawn = materialise(
        chosen.alias("l").join(goal.alias("r"), same("source"), "left").select("l.*", "r.passes", "r.source_size", "r.target"),
        "blocks",
    )
    inner = parts.alias("l").join(drawn.filter("state = 1").alias("r"), same("source", "block")).select("l.*", "r.left")
    fine = materialise(
        _greedy(inner, ["source", "block"], "fine", _hash(F.lit(seed + 2), *_TRIPLE), "left").filter("state > 0"), "fine"
    )
    last = rows.alias("l").join(fine.filter("state = 1").alias("r"), same(*_TRIPLE)).select("l.*", "r.left")
    # Equal rows come as one with their number. Of the rows of a part, in the order of size and draw, those are
    # taken that end nearer to the target than they begin: for n equal rows that is a number from 0 to n.
    equal = last.filter("size > 0").groupBy(*_TRIPLE, "draw").agg(F.max("size").alias("size"), F.count("*").alias("n"), F.max("left").alias("left"))
    so_far = Window.partitionBy(*_TRIPLE).orderBy("size", "draw").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") * F.col("n")).over(so_far), F.lit(0))
    fitting = F.floor((F.col("left") - before) / F.col("size") + 0.5)
    nearest = equal.withColumn("fit", F.least("n", F.greatest(F.lit(0), fitting))).filter("fit > 0")
    nearest = materialise(nearest.select("source", "block", "draw", "n", "fit"), "nearest")
    # Where only some of the equal rows fit, rows are numbered; at most one draw of a source is such.
    some = rows.alias("l").join(nearest.filter("fit < n").alias("r"), same("source", "block", "draw")).select("l.draw", "l.row", "r.fit")
    numbered = materialise(number_rows(some, ["draw", "row"], "number"), "numbered")
    firsts = numbered.groupBy("draw").agg(F.min("number").alias("first"))
    not_taken = numbered.join(firsts, "draw").filter("number - first >= fit").select("row", F.lit(True).alias("not_taken"))

    # Units and the splitting tree.
    final = F.col("passes") + 1
    passes = F.sequence(F.lit(1), F.col("passes") + F.when(F.col("state") > 0, F.lit(1)).otherwise(F.lit(0)))
    units = drawn.filter("passes > 0 OR state > 0").select("source", "block", F.explode(passes).alias("pass"))
    units = units.withColumn("node", F.lit(0))
    for depth in range(shards.bit_length() - 1):
        shuffled = Window.partitionBy("node").orderBy(_hash(F.lit(seed + 10 + depth), "source", "block", "pass"), "source", "block", "pass")
        at, size = F.row_number().over(shuffled), F.count("*").over(Window.partitionBy("node"))
        # An odd unit goes left or right by a hash of the node, so that no shard is favoured.
        half = F.floor((size + F.pmod(_hash(F.lit(seed + 3), F.lit(depth), "node"), F.lit(2))) / 2)
        units = units.withColumn("right", (at > half).cast("int")).select(
            "source", "block", "pass", (F.col("node") * 2 + F.col("right")).alias("node")
        )
    by_block = units.groupBy("source", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", F.col("node").alias("shard")))).alias("units")
    )
    lots = materialise(
        drawn.alias("l")
        .join(by_block.alias("r"), same("source", "block"), "left")
        .select("l.source", "l.block", "l.source_size", "l.target", "l.passes", "l.state", "r.units"),
        "lots",
    )

    placed = rows.alias("l").join(lots.alias("r"), same("source", "block"), "left").select("l.*", *[f"r.{c}" for c in ("source_size", "target", "passes", "state", "units")])
    # Only documents of blocks where a source ends need the finer tables.
    settled = placed.filter("state <> 1").withColumn("extra", F.col("state") == 2)
    open_ = (
        placed.filter("state = 1").alias("l")
        .join(fine.filter("state = 2").alias("r"), same(*_TRIPLE), "left")
        .select("l.*", F.col("r.state").isNotNull().alias("whole"))
    )
    open_ = (
        open_.alias("l")
        .join(nearest.alias("r"), same("source", "block", "draw"), "left")
        .select("l.*", F.col("r.draw").isNotNull().alias("near"))
        .join(not_taken, "row", "left")
        .withColumn("extra", F.col("whole") | (F.col("near") & F.col("not_taken").isNull()))
        .drop("whole", "near", "not_taken")
    )
    keep = F.filter(F.coalesce("units", F.array()), lambda u: F.col("extra") | (u["pass"] < final))
    return settled.unionByName(open_).select(
        "doc_id", "source", "size", "source_size", "target", keep.alias("copies"), "draw"
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` once for every time it is taken, with ``mix_pass`` and
    ``mix_shard``, shards together and in random order inside each. Columns of ``docs`` are kept."""
    chosen = materialise(plan(docs, **settings).select("draw", "copies"), "chosen")
    seed = settings.get("seed", 7)
    by, copies, copy, order, number = unused(docs, "draw", "copies", "copy", "order", "number")
    keyed = docs.withColumn(by, _hash(F.lit(seed), "doc_id", "source", F.coalesce("text", F.lit(""))))
    # Rows with equal id, source and text have one draw and are mostly taken alike; where they are not, the rows
    # are numbered on both sides.
    per_draw = chosen.groupBy("draw").agg(F.min("copies").alias("least"), F.max("copies").alias("most"))
    alike = per_draw.filter("least = most AND size(most) > 0").select(F.col("draw").alias(by), F.col("most").alias(copies))
    unlike = materialise(per_draw.filter("least <> most").select(F.col("draw").alias(by)), "unlike")
    taken = keyed.join(alike, by)
    if not unlike.isEmpty():
        left = number_rows(materialise(keyed.join(unlike, by, "left_semi"), "equal"), [by], number)
        right = number_rows(chosen.withColumnRenamed("draw", by).join(unlike, by, "left_semi").withColumnRenamed("copies", copies), [by, copies], number)
        # Both sides hold as many rows of each draw and are numbered in the order of the draws.
        both = left.join(right.select(number, copies), number).filter(F.size(copies) > 0)
        taken = taken.unionByName(both.select(*taken.columns))
    rows = taken.withColumn(copy, F.explode(copies)).withColumn(order, _hash(F.lit(seed + 5), by, f"{copy}.pass"))
    return (
        rows.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("mix_pass", "mix_shard")], F.col(f"{copy}.pass").alias("mix_pass"), F.col(f"{copy}.shard").alias("mix_shard"), order)
        .repartitionByRange("mix_shard", order)
        .sortWithinPartitions("mix_shard", order)
        .drop(order)
    )
