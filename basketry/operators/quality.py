"""Profiling, data quality and integrity reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import rounded, share, strip, to_day
from basketry.functions.quantiles import exact_points
from basketry.sources.delimited import ORDINAL
from basketry.sources.tables import row_counts

table_row_counts = row_counts


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_") and c != "order_month"]


def per_column(df: DataFrame, measure, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column holding ``measure(column)``, plus the row count, from one aggregate."""
    columns = list(columns or data_columns(df))
    wide = df.agg(F.count("*").alias("_rows"), *[measure(F.col(c)).cast("long").alias(c) for c in columns])
    return wide.unpivot(["_rows"], columns, "column", name).withColumnRenamed("_rows", "rows")


def nulls(c: Column) -> Column:
    return F.count_if(c.isNull())


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Type, nulls and null share of every column."""
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    tidy = per_column(df, nulls, "nulls")
    return tidy.select(
        F.lit(table).alias("table"),
        "column",
        kinds[F.col("column")].alias("type"),
        "nulls",
        share("nulls", "rows", 1).alias("null_pct"),
    )


def profile_sample(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def as_text(df: DataFrame) -> Column:
    """A row as one text, its values in the order of the columns; null is shown as such."""
    return F.concat_ws(" | ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in df.columns])


def profile_samples(tables: dict[str, tuple[DataFrame, Sequence[str]]], n: int = 5) -> DataFrame:
    """The first rows of several tables, each in an order of its own, as texts."""
    return stack([profile_sample(df, order, n).select(F.lit(name).alias("table"), as_text(df).alias("row")) for name, (df, order) in tables.items()])


def duplicate_row_list(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row that occurs more than once, as text, with its copies."""
    found = {name: duplicate_rows(df) for name, df in tables.items()}
    return stack([df.select(F.lit(name).alias("table"), as_text(df.drop("copies")).alias("row"), "copies") for name, df in found.items()])


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max, one row per column.

    Moments and sketches of all columns come from one pass; quartiles are exact, from the values between brackets."""
    columns = list(columns)
    moments = {"count": F.count, "mean": lambda c: rounded(F.avg(c)), "std": lambda c: rounded(F.stddev_samp(c)), "min": lambda c: rounded(F.min(c)), "max": lambda c: rounded(F.max(c))}
    also = [f(F.col(f"`{c}`")).alias(f"{name} {c}") for c in columns for name, f in moments.items()]
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles, seen = exact_points(df, {c: F.col(f"`{c}`") for c in columns}, points, also)
    rows = [(c, *[seen[f"{name} {c}"] for name in moments], *[quartiles[c][p] for p in points]) for c in columns]
    kinds = "column string, count long, " + ", ".join(f"{n} double" for n in ("mean", "std", "min", "max", *points))
    shown = df.sparkSession.createDataFrame(rows, kinds)
    return shown.withColumns({p: rounded(p) for p in points})


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column. Each column is its own aggregate over a one-column scan; several
    exact distinct counts in one aggregate would copy every row once per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return stack([df.agg(count(c).alias("distinct")).select(F.lit(c).alias("column"), "distinct") for c in columns])


def unique_counts(df: DataFrame, table: str) -> DataFrame:
    counted = distinct_counts(df, data_columns(df))
    return counted.select(F.lit(table).alias("table"), "column", F.col("distinct").alias("unique_values"))


def missing_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns with nulls over all tables."""
    parts = []
    for name, df in tables.items():
        tidy = per_column(df, nulls, "missing").filter("missing > 0")
        parts.append(
            tidy.select(
                F.lit(name).alias("table"),
                "column",
                "missing",
                share("missing", "rows").alias("missing_pct"),
                F.col("rows").alias("total_rows"),
            )
        )
    return stack(parts)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with how often. Equal rows are counted before the shuffle."""
    counted = df.groupBy(*data_columns(df)).agg(F.count("*").alias("copies"))
    return counted.filter("copies > 1")


def duplicate_keys(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows whose key occurs more than once.

    Keys are counted, then joined back: no task collects the rows of one key."""
    repeated = df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("copies"))
    rows = df.join(repeated.filter("copies > 1"), list(keys))
    order = [*keys, ORDINAL] if ORDINAL in df.columns else list(keys)
    return rows.orderBy(*order).limit(n).select(*data_columns(df), "copies")


def whitespace_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Values with outer white space per text column."""
    parts = []
    for name, df in tables.items():
        text = [c for c in data_columns(df) if isinstance(df.schema[c].dataType, T.StringType)]
        tidy = per_column(df, lambda c: F.count_if(c != strip(c)), "padded", text)
        parts.append(tidy.select(F.lit(name).alias("table"), "column", "padded"))
    return stack(parts)


def negative_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Negative values per decimal column."""
    parts = []
    for name, df in tables.items():
        amounts = [c for c in data_columns(df) if isinstance(df.schema[c].dataType, T.DecimalType)]
        tidy = per_column(df, lambda c: F.count_if(c < 0), "negatives", amounts)
        parts.append(tidy.select(F.lit(name).alias("table"), "column", "negatives"))
    return stack(parts)


def invalid_dates(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that are no date, absent ones included."""
    tidy = per_column(raw, lambda c: F.count_if(to_day(c).isNull()), "invalid", columns)
    return tidy.select("column", "invalid", "rows")


def delivery_before_order(raw_header: DataFrame) -> DataFrame:
    early = to_day("delivdate") < to_day("orderdate")
    return raw_header.agg(F.count_if(early).alias("early_rows"), F.count("*").alias("rows"))


def date_range(columns: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """First and last value per labelled column, as text."""
    parts = [
        df.agg(F.min(c).cast("string").alias("first"), F.max(c).cast("string").alias("last")).select(
            F.lit(label).alias("column"), "first", "last"
        )
        for label, (df, c) in columns.items()
    ]
    return stack(parts)


@dataclass(frozen=True)
class Relation:
    name: str
    child: DataFrame
    child_key: str
    parent: DataFrame
    parent_key: str

    def orphans(self) -> DataFrame:
        """Distinct child keys without parent."""
        child = self.child.select(_key(self.child, self.child_key)).filter("key IS NOT NULL")
        return child.distinct().join(self.parent.select(_key(self.parent, self.parent_key)), "key", "left_anti")


def _key(df: DataFrame, name: str) -> Column:
    """Keys in text compare without outer white space, integer keys as they are."""
    text = isinstance(df.schema[name].dataType, T.StringType)
    return (strip(name) if text else F.col(name).cast("long")).alias("key")


def fk_orphans(relations: Sequence[Relation], examples: int = 10) -> DataFrame:
    """Number of orphan keys per relation and the first few of them."""
    parts = []
    for r in relations:
        orphans = r.orphans()
        few = orphans.orderBy("key").limit(examples)
        shown = few.agg(F.array_join(F.array_sort(F.collect_list("key")).cast("array<string>"), ",")).scalar()
        parts.append(
            orphans.agg(F.count("*").alias("orphan_keys")).select(
                F.lit(r.name).alias("relation"), "orphan_keys", shown.alias("examples")
            )
        )
    return stack(parts)


def fk_subset(relations: Sequence[Relation]) -> DataFrame:
    """1 where every child key has a parent."""
    return stack(
        [
            r.orphans().agg((F.count("*") == 0).cast("int").alias("is_subset")).select(
                F.lit(r.name).alias("relation"), "is_subset"
            )
            for r in relations
        ]
    )


def key_overlap(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Key ranges of a fact and a dimension, common and orphan keys."""
    left = fact.select(F.col(key).alias("f")).distinct()
    right = dim.select(F.col(key).alias("d")).distinct()
    both = left.join(right, F.col("f") == F.col("d"), "full_outer")
    return both.agg(
        F.min("f").alias("fact_min"),
        F.max("f").alias("fact_max"),
        F.min("d").alias("dim_min"),
        F.max("d").alias("dim_max"),
        F.count("f").alias("fact_keys"),
        F.count("d").alias("dim_keys"),
        F.count_if(F.col("f").isNotNull() & F.col("d").isNotNull()).alias("common_keys"),
        F.count_if(F.col("d").isNull()).alias("orphan_keys"),
    )


def anonymous_names_top(dim_customer: DataFrame, n: int = 20) -> DataFrame:
    """First stand-in names. The pattern's ``_`` matches any character, as in the original check."""
    return dim_customer.filter(F.col("AccountName").like("CLIENT_%")).select("AccountName").orderBy("AccountName").limit(n)


def anonymous_names_count(dim_customer: DataFrame) -> DataFrame:
    name = F.col("AccountName")
    return dim_customer.agg(
        F.count_if(name.like("CLIENT_%")).alias("by_pattern"),
        F.count_if(name.startswith("CLIENT_")).alias("by_prefix"),
    )
