"""Ranks, running totals and exact quantiles over whole tables, without one task holding them.

A window without PARTITION BY moves every row to one task. Here rows are range-partitioned on
the sort keys and sorted inside each partition; a row's place is then its seat in its partition
plus the rows of the partitions before. The latter is a table of one row per partition, so it is
broadcast. The ranged rows are written once, hence both passes agree on where each row sits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import col
from basketry.session import materialise

PART, SEAT = "_part", "_seat"


def seated(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Rows in global order: ``_part`` is the range they fall in, ``_seat`` the place inside it."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
    placed = ordered.withColumn("_slot", slot)
    return materialise(
        placed.withColumn(PART, F.shiftright("_slot", 33).cast("int"))
        .withColumn(SEAT, F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_slot"),
        "seated",
    )


def number_rows(df: DataFrame, order_by: Sequence[Column | str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in ``order_by`` order. The order must be total for a repeatable result."""
    rows = seated(df, order_by)
    before = _before(rows.groupBy(PART).agg(F.count("*").alias("_n")), ["_n"])
    return (
        rows.join(F.broadcast(before), PART)
        .withColumn(name, (F.col("_n_before") + F.col(SEAT) + F.lit(start)).cast("long"))
        .drop(PART, SEAT, "_n_before", "_n_total")
    )


def running_total(
    df: DataFrame, order_by: Sequence[Column | str], value: str, name: str = "running"
) -> DataFrame:
    """Add the rank, the running sum of ``value`` and both totals in global order.

    New columns: ``{name}_rank``, ``{name}``, ``{name}_rows`` and ``{name}_total``.
    """
    rows = seated(df, order_by)
    sums = rows.groupBy(PART).agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    inside = Window.partitionBy(PART).orderBy(SEAT)
    return (
        rows.join(F.broadcast(_before(sums, ["_n", "_s"])), PART)
        .withColumn(f"{name}_rank", F.col("_n_before") + F.col(SEAT) + 1)
        .withColumn(name, F.col("_s_before") + F.sum(value).over(inside))
        .withColumn(f"{name}_rows", F.col("_n_total"))
        .withColumn(f"{name}_total", F.col("_s_total"))
        .drop(PART, SEAT, "_n_before", "_n_total", "_s_before", "_s_total")
    )


def _before(blocks: DataFrame, amounts: list[str], within: Sequence[str] = ()) -> DataFrame:
    """Per block: total of the blocks before it and of all. ``blocks`` has one row per partition
    and group, so the window over it is small whatever the size of the data."""
    upto = Window.partitionBy(*within).orderBy(PART)
    whole = Window.partitionBy(*within)
    return blocks.select(
        PART,
        *within,
        *[(F.sum(a).over(upto) - F.coalesce(a, F.lit(0))).alias(f"{a}_before") for a in amounts],
        *[F.sum(a).over(whole).alias(f"{a}_total") for a in amounts],
    )


def exact_quantiles(
    df: DataFrame, value: Column | str, points: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group: ``by``, ``n`` and a column per point.

    Equal values are counted before anything moves, so a value that fills a third of the table
    travels as one row per task. ``by`` must name few groups (segments, column names).
    """
    groups = list(by)
    values = (
        df.select(*groups, col(value).alias("_v"))
        .filter(F.col("_v").isNotNull())
        .groupBy(*groups, "_v")
        .agg(F.count("*").alias("_n"))
    )
    rows = seated(values, [*groups, "_v"])
    blocks = rows.groupBy(PART, *groups).agg(F.sum("_n").alias("_n"))
    inside = Window.partitionBy(PART, *groups).orderBy("_v")
    ranks = (
        rows.join(F.broadcast(_before(blocks, ["_n"], groups)), [PART, *groups])
        .withColumn("_end", F.col("_n_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(place: Column) -> Column:
        holds = (F.col("_start") <= place) & (place < F.col("_end"))
        return F.max(F.when(holds, F.col("_v")))

    picks = []
    for label, p in points.items():
        place = F.lit(float(p)) * (F.col("_n_total") - 1)
        picks += [at(F.floor(place)).alias(f"_lo_{label}"), at(F.ceil(place)).alias(f"_hi_{label}")]
    found = ranks.groupBy(*groups).agg(F.max("_n_total").alias("n"), *picks)

    def between(label: str, p: float) -> Column:
        place = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{label}").cast("double"), F.col(f"_hi_{label}").cast("double")
        return (low + (high - low) * (place - F.floor(place))).alias(label)

    return found.select(*groups, "n", *[between(label, p) for label, p in points.items()])


def small_quantiles(df: DataFrame, value: Column | str, points: Sequence[float]) -> Column:
    """Quantiles of a column with few distinct values (days, scores), as a scalar array.

    Values are counted first, so the final aggregate sees one row per distinct value.
    """
    counted = (
        df.select(col(value).alias("_v")).filter("_v IS NOT NULL").groupBy("_v").agg(F.count("*").alias("_n"))
    )
    return counted.agg(F.percentile("_v", [float(p) for p in points], F.col("_n"))).scalar()
