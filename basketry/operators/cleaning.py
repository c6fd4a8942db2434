"""Cleaning: null keys, duplicates, business rules, referential integrity, types, counts.

``flag_entity`` does the work: it collapses duplicates, attaches one flag per rule and maps
foreign keys, all in one lazy plan. The clean table is a filter over the flags and the quality
counters are an aggregate over them, so both come from the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import plain_code, strip, tidy_text, to_day, to_money, to_whole
from basketry.session import materialise
from basketry.sources.delimited import ORDINAL
from basketry.specs import (
    CUSTOMER,
    ENTITIES,
    INVOICE,
    PRODUCT,
    REGION,
    SALES_HEADER,
    SALES_LINE,
    SECTOR,
    SELLER,
    UNKNOWN_KEY,
    UNKNOWN_TEXT,
    EntitySpec,
    Rule,
)

COPIES, KEYED, RULED = "_copies", "_keyed", "_ruled"
#: Hash of the keys as they came, by which a row is the same in every load. Whether a row stays.
ROW, KEPT = "_row", "_kept"
#: Whether another row of the table has, or may have, the same ``ROW``.
TWIN = "_twin"

#: Orphans of a key up to which the join with them is left to the session: so few are broadcast under any usual threshold.
FEW_ORPHANS = 10_000
#: Words of 64 bits of a sieve. It is broadcast, so its size is fixed.
SIEVE_WORDS = 1 << 18


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must be a value of ``parent_key`` in ``parent``; else map to unknown or drop."""

    column: str
    parent: DataFrame | None
    parent_key: str
    orphan: str = "map"


# ---- rows -----------------------------------------------------------------------------------


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: str = ORDINAL) -> DataFrame:
    """First row per key in file order, with the number of rows it stands for in ``_copies``.

    ``min_by`` aggregates before the shuffle: however often a key is repeated, one row per task
    and key is moved.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), order).alias("_first")
    grouped = df.groupBy(*keys).agg(first, F.count("*").alias(COPIES))
    return grouped.select(*[F.col(k) if k in keys else F.col(f"_first.{k}") for k in df.columns], COPIES)


def keep_first_of_few(df: DataFrame, keys: Sequence[str], order: str = ORDINAL) -> DataFrame:
    """As ``keep_first``, for large tables where most keys occur once.

    Hashes of the keys are counted first, which moves 8 bytes a row. The repeated ones are stored,
    so their size is known when the rows are marked with them. Rows with a hash of their own then
    pass through where they are; only those that share one are grouped, by their keys, and have
    ``_twin`` set. Rows with a null key are kept, one by one."""
    names, df = list(keys), df.drop(TWIN)
    hashed = df.withColumn("_hash", F.when(reduce(and_, [F.col(k).isNotNull() for k in names]), F.xxhash64(*names)))
    counted = hashed.filter("_hash IS NOT NULL").groupBy("_hash").agg(F.count("*").alias(COPIES))
    repeated = materialise(counted.filter(F.col(COPIES) > 1).select("_hash"), "repeated")
    marked = hashed.join(repeated.withColumn(TWIN, F.lit(True)), "_hash", "left")
    alone = marked.filter(F.col(TWIN).isNull())
    rest = [c for c in df.columns if c not in names]
    grouped = marked.filter(F.col(TWIN)).groupBy(*names).agg(
        F.min_by(F.struct(*rest), order).alias("_first"), F.count("*").alias(COPIES)
    )
    firsts = grouped.select(*[F.col(c) if c in names else F.col(f"_first.{c}") for c in df.columns], COPIES, F.lit(True).alias(TWIN))
    return alone.select(*df.columns, F.lit(1).cast("long").alias(COPIES), F.lit(False).alias(TWIN)).unionByName(firsts)


def rule_holds(rule: Rule, columns: Sequence[str]) -> Column:
    """Predicate of a rule, never null. A rule on an absent column or with an unknown operator
    holds for all rows; a null passes ``!=`` and fails every comparison."""
    if rule.column not in columns:
        return F.lit(True)
    number = F.col(rule.column).try_cast("double")
    tests = {
        ">": lambda: number > rule.value,
        ">=": lambda: number >= rule.value,
        "<": lambda: number < rule.value,
        "!=": lambda: ~F.col(rule.column).eqNullSafe(F.lit(rule.value)),
        "not_null": lambda: F.col(rule.column).isNotNull(),
    }
    if rule.op not in tests:
        return F.lit(True)
    return F.coalesce(tests[rule.op](), F.lit(False))


def rules_hold(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    return reduce(and_, [rule_holds(r, columns) for r in rules], F.lit(True))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(rules_hold(rules, df.columns))


# ---- types ----------------------------------------------------------------------------------


def typed(spec: EntitySpec, name: str) -> Column:
    c = F.col(name)
    if name in spec.decimals:
        return to_money(c).alias(name)
    if name in spec.integers:
        return to_whole(c).alias(name)
    if name in spec.dates:
        return to_day(c).alias(name)
    if name in spec.codes:
        c = plain_code(c)
    if name in spec.text:
        return tidy_text(c, spec.text[name]).alias(name)
    return strip(c).alias(name)


def cast_entity(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """All casts of a contract in one projection; undeclared columns are dropped."""
    known = [c for c in spec.columns if c in df.columns]
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(*[typed(spec, c) for c in known], *extra)


# ---- referential integrity ------------------------------------------------------------------


def orphan_keys(child: DataFrame, fk: ForeignKey) -> DataFrame:
    """Distinct child keys without parent, stored.

    Only the key columns move, and equal child keys are merged before they do. What remains is
    usually small; being a stored table its size is known, so the join that marks the child rows
    broadcasts it when it is under the session's threshold and shuffles when it is not. The wide
    child rows are not shuffled for the check, and a hot key costs nothing."""
    keys = child.select(strip(fk.column).alias("_key")).filter("_key IS NOT NULL").distinct()
    parents = fk.parent.select(strip(fk.parent_key).alias("_key"))
    orphans = keys.filter(F.col("_key") != UNKNOWN_KEY).join(parents, "_key", "left_anti")
    return materialise(orphans, "orphans")


def flag_orphans(df: DataFrame, fk: ForeignKey, flag: str, keys_from: DataFrame | None = None) -> DataFrame:
    """Add ``flag``: true where the key is null or has no parent. The unknown key is always valid.

    ``keys_from`` may name a table with the same keys that is cheaper to read than ``df``."""
    return _flag_with(df, fk, flag, orphan_keys(df if keys_from is None else keys_from, fk))


def _flag_with(df: DataFrame, fk: ForeignKey, flag: str, orphans: DataFrame) -> DataFrame:
    marked = df.join(orphans.withColumn("_found", F.lit(True)), strip(fk.column) == F.col("_key"), "left")
    flagged = F.col(fk.column).isNull() | F.coalesce("_found", F.lit(False))
    return marked.withColumn(flag, flagged).drop("_key", "_found")


def _sieve_word(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 6).bitwiseAND(F.lit(SIEVE_WORDS - 1))


def _sieve_bit(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(63)).cast("int")


def sift(df: DataFrame, suspects: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """The rows without any of the suspected keys for sure, and those that may have one: ``suspects`` are columns and
    stored tables of their ``_key``.

    Every key sets one of ``SIEVE_WORDS * 64`` bits by its hash. The words that have any are broadcast, so however many
    keys there are, at most that many small rows are, and no row of ``df`` moves to be told. A million keys let some 6 %
    of the other rows through. Rows marked as ``TWIN`` come from a shuffle already and count as suspected."""
    told, may = df, F.col(TWIN) if TWIN in df.columns else F.lit(False)
    for i, (column, keys) in enumerate(suspects):
        placed = keys.select(_sieve_word(F.col("_key")).alias(f"_word{i}"), _sieve_bit(F.col("_key")).alias("_bit"))
        words = placed.groupBy(f"_word{i}").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias(f"_bits{i}"))
        told = told.join(F.broadcast(words), _sieve_word(strip(column)) == F.col(f"_word{i}"), "left")
        may = may | F.coalesce(F.getbit(F.col(f"_bits{i}"), _sieve_bit(strip(column))) == 1, F.lit(False))
    return told.filter(~may).select(*df.columns), told.filter(may).select(*df.columns)


def flag_all_orphans(df: DataFrame, foreign_keys: Sequence[ForeignKey], keys_from: DataFrame, use_unknown: bool = True) -> DataFrame:
    """Add ``_orphan_{column}`` for every key, as ``flag_orphans`` does, and map the orphans where the key says so.

    The orphans of a key with many are too large for a broadcast, but few of the rows have one. Only rows that may
    have one are shuffled to meet them; the others stay in place."""
    found = [(fk, orphan_keys(keys_from, fk)) for fk in foreign_keys]
    many = {fk.column: orphans for fk, orphans in found if orphans.count() > FEW_ORPHANS}

    def flag_each(rows: DataFrame, without: Mapping[str, DataFrame]) -> DataFrame:
        for fk, orphans in found:
            flag = f"_orphan_{fk.column}"
            rows = rows.withColumn(flag, F.col(fk.column).isNull()) if fk.column in without else _flag_with(rows, fk, flag, orphans)
            if use_unknown and fk.orphan == "map":
                rows = rows.withColumn(fk.column, F.when(F.col(flag), F.lit(UNKNOWN_KEY)).otherwise(F.col(fk.column)))
        return rows

    if not many:
        return flag_each(df, {})
    sure, rest = sift(df, list(many.items()))
    return flag_each(sure, many).unionByName(flag_each(rest, {}))


def map_orphans(df: DataFrame, fk: ForeignKey) -> DataFrame:
    """Foreign keys without parent become the unknown key; ``_orphan`` tells which."""
    flagged = flag_orphans(df, fk, "_orphan")
    return flagged.withColumn(
        fk.column, F.when(F.col("_orphan"), F.lit(UNKNOWN_KEY)).otherwise(F.col(fk.column))
    )


def drop_orphans(df: DataFrame, fk: ForeignKey) -> DataFrame:
    return flag_orphans(df, fk, "_orphan").filter(~F.col("_orphan")).drop("_orphan")


def with_unknown_member(df: DataFrame, key: str) -> DataFrame:
    """Add the unknown member to a dimension that has rows and lacks it.

    Text columns get the unknown text, all others null; its file order is null, ahead of all.
    """
    present = df.agg(
        F.count("*").alias("n"), F.coalesce(F.bool_or(F.col(key) == UNKNOWN_KEY), F.lit(False)).alias("has")
    )
    kinds = dict(df.dtypes)

    def member(name: str) -> Column:
        if name == key:
            return F.lit(UNKNOWN_KEY).alias(name)
        text = kinds[name] == "string" and not name.startswith("_")
        return F.lit(UNKNOWN_TEXT if text else None).cast(df.schema[name].dataType).alias(name)

    extra = present.filter((F.col("n") > 0) & ~F.col("has")).select(*[member(c) for c in df.columns])
    return extra.unionByName(df)


# ---- entities -------------------------------------------------------------------------------


def row_hash(*keys: str) -> Column:
    """64-bit hash of the keys as text. Whether two rows share one is checked where it becomes a key."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def flag_entity(
    df: DataFrame, spec: EntitySpec, foreign_keys: Sequence[ForeignKey] = (), use_unknown: bool = True
) -> DataFrame:
    """Unique raw rows with their flags: ``_keyed``, ``_ruled`` and ``_orphan_{column}`` per key."""
    rows = keep_first_of_few(df, spec.keys) if foreign_keys else keep_first(df, spec.keys)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in spec.keys])
    rows = rows.withColumn(KEYED, keyed).withColumn(RULED, rules_hold(spec.rules, rows.columns))
    if foreign_keys:
        rows = rows.withColumn(ROW, row_hash(*spec.keys))
        if any(kind != "string" for kind in dict(df.select(*spec.keys).dtypes).values()):
            rows = rows.drop(TWIN)  # told by another hash than that of the keys as text
    return flag_all_orphans(rows, foreign_keys, df, use_unknown) if foreign_keys else rows


def _dropping(foreign_keys: Sequence[ForeignKey], use_unknown: bool) -> list[ForeignKey]:
    return [fk for fk in foreign_keys if fk.orphan == "drop" or not use_unknown]


def clean_flagged(
    flagged: DataFrame, spec: EntitySpec, foreign_keys: Sequence[ForeignKey] = (), use_unknown: bool = True
) -> DataFrame:
    kept = flagged.filter(F.col(KEYED) & F.col(RULED))
    for fk in _dropping(foreign_keys, use_unknown):
        kept = kept.filter(~F.col(f"_orphan_{fk.column}"))
    return cast_entity(kept, spec).select(*[c for c in spec.columns if c in flagged.columns], ORDINAL, *[c for c in [ROW, TWIN] if c in flagged.columns])


def quality_aggregates(spec: EntitySpec, foreign_keys: Sequence[ForeignKey] = (), use_unknown: bool = True) -> list[Column]:
    """The counters of one cleaning run over its flagged rows: rows after each stage and rows lost or mapped."""
    dropping = _dropping(foreign_keys, use_unknown)
    ok = F.col(KEYED)
    ruled = ok & F.col(RULED)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    count = lambda c: F.count_if(c).cast("long")

    # A row dropped by one key is not seen by the check of the next.
    seen, dropped, mapped = ruled, [], []
    for fk in foreign_keys:
        orphan = F.col(f"_orphan_{fk.column}")
        if fk in dropping:
            dropped.append(count(seen & orphan))
            seen = seen & ~orphan
        else:
            mapped.append(count(seen & orphan))
    zero = F.lit(0).cast("long")
    lost = reduce(lambda a, b: a + b, dropped, zero)
    moved = reduce(lambda a, b: a + b, mapped, zero)
    # Where a key drops its orphans by contract, mapped ones are no violations.
    violations = lost if any(fk.orphan == "drop" for fk in foreign_keys) else lost + moved
    return [
        total(COPIES).alias("raw_row_count"),
        total(F.when(~ok, F.col(COPIES))).alias("null_key_dropped"),
        total(F.when(ok, F.col(COPIES))).alias("after_null_drop"),
        total(F.when(ok, F.col(COPIES) - 1)).alias("duplicates_removed"),
        count(ok).alias("after_dedup"),
        count(ok & ~F.col(RULED)).alias("business_rule_violations"),
        count(ruled).alias("after_business_rules"),
        violations.alias("ri_violations"),
        moved.alias("ri_mapped_to_unknown"),
        count(seen).alias("after_ri_filter"),
        count(seen).alias("final_row_count"),
    ]


def quality_counts(
    flagged: DataFrame, spec: EntitySpec, foreign_keys: Sequence[ForeignKey] = (), use_unknown: bool = True
) -> DataFrame:
    """The counters as one row."""
    return flagged.agg(*quality_aggregates(spec, foreign_keys, use_unknown)).select(F.lit(spec.name).alias("entity"), "*")


def null_counts(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Nulls per declared column, one row each, from one aggregate. Text is counted as it is."""
    known = [c for c in spec.columns if c in df.columns]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in known])
    tidy = counted.unpivot([], known, "column", "nulls")
    return tidy.select(F.lit(spec.name).alias("entity"), "column", "nulls")


@dataclass(frozen=True)
class Cleaned:
    """A cleaned entity over its flagged rows: the rows that stay, and the counters of the run."""

    flagged: DataFrame | None
    spec: EntitySpec
    foreign_keys: Sequence[ForeignKey] = ()
    use_unknown: bool = True
    unknown_member: bool = False

    @property
    def rows(self) -> DataFrame:
        rows = clean_flagged(self.flagged, self.spec, self.foreign_keys, self.use_unknown)
        return with_unknown_member(rows, self.spec.keys[0]) if self.unknown_member else rows

    @property
    def counts(self) -> DataFrame:
        return quality_counts(self.flagged, self.spec, self.foreign_keys, self.use_unknown)

    @property
    def marked(self) -> DataFrame:
        """All unique rows, typed, with their flags and ``_kept``: what a load stores, so that the rows that stay and
        the counters of the run are both read from it. The hash of the keys as they came does not compress; it is
        stored only where the stored keys have another."""
        kept = F.col(KEYED) & F.col(RULED)
        for fk in _dropping(self.foreign_keys, self.use_unknown):
            kept = kept & ~F.col(f"_orphan_{fk.column}")
        rows = cast_entity(self.flagged.withColumn(KEPT, kept), self.spec)
        return rows.withColumn(ROW, F.when(F.col(ROW) != row_hash(*self.spec.keys), F.col(ROW))) if ROW in rows.columns else rows

    def of_marked(self, marked: DataFrame) -> DataFrame:
        """The rows that stay of stored ``marked`` ones."""
        columns = [c for c in [*self.spec.columns, ORDINAL, ROW, TWIN] if c in marked.columns]
        rows = marked.filter(KEPT).select(*columns)
        if ROW in columns:
            rows = rows.withColumn(ROW, F.coalesce(ROW, row_hash(*self.spec.keys)))
        return with_unknown_member(rows, self.spec.keys[0]) if self.unknown_member else rows

    def counts_of_marked(self, marked: DataFrame) -> DataFrame:
        return quality_counts(marked, self.spec, self.foreign_keys, self.use_unknown)


def clean_dimension(raw: DataFrame, spec: EntitySpec, add_unknown: bool = True) -> Cleaned:
    return Cleaned(flag_entity(raw, spec), spec, unknown_member=add_unknown)


def clean_fact(
    raw: DataFrame, spec: EntitySpec, foreign_keys: Sequence[ForeignKey], use_unknown: bool = True
) -> Cleaned:
    return Cleaned(flag_entity(raw, spec, foreign_keys, use_unknown), spec, foreign_keys, use_unknown)


def header_keys(customer: DataFrame | None, seller: DataFrame | None) -> list[ForeignKey]:
    return [ForeignKey("accountid", customer, "accountid"), ForeignKey("sellerid", seller, "sellerid")]


def line_keys(header: DataFrame | None, product: DataFrame | None) -> list[ForeignKey]:
    return [ForeignKey("saleid", header, "saleid", "drop"), ForeignKey("itemid", product, "itemid")]


def invoice_keys(header: DataFrame | None) -> list[ForeignKey]:
    return [ForeignKey("salesid", header, "saleid")]


def clean_sales_header(raw: DataFrame, customer: DataFrame, seller: DataFrame, use_unknown: bool = True) -> Cleaned:
    return clean_fact(raw, SALES_HEADER, header_keys(customer, seller), use_unknown)


def clean_sales_line(raw: DataFrame, header: DataFrame, product: DataFrame, use_unknown: bool = True) -> Cleaned:
    return clean_fact(raw, SALES_LINE, line_keys(header, product), use_unknown)


def clean_invoice(raw: DataFrame, header: DataFrame, use_unknown: bool = True) -> Cleaned:
    return clean_fact(raw, INVOICE, invoice_keys(header), use_unknown)


def outline(entity: str) -> Cleaned:
    """How an entity is cleaned, without rows: for reading what a load has stored."""
    keys = {"SalesHeader": header_keys, "SalesLine": line_keys}.get(entity)
    if keys:
        return Cleaned(None, ENTITIES[entity], keys(None, None))
    if entity == "Invoice":
        return Cleaned(None, INVOICE, invoice_keys(None))
    return Cleaned(None, ENTITIES[entity], unknown_member=True)


def clean_all(raw: Mapping[str, DataFrame], use_unknown: bool = True) -> dict[str, Cleaned]:
    """All entities in dependency order. Rows and counts are lazy; only the orphan keys are computed."""
    done = {s.name: clean_dimension(raw[s.name], s) for s in (REGION, SECTOR, CUSTOMER, SELLER, PRODUCT)}
    header = clean_sales_header(raw["SalesHeader"], done["Customer"].rows, done["Seller"].rows, use_unknown)
    done["SalesHeader"] = header
    done["SalesLine"] = clean_sales_line(raw["SalesLine"], header.rows, done["Product"].rows, use_unknown)
    done["Invoice"] = clean_invoice(raw["Invoice"], header.rows, use_unknown)
    return done
