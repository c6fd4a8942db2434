"""Dimensions, surrogate keys and dimension history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import MONEY, client_name, date_key, strip
from basketry.functions.ranking import number_rows
from basketry.operators.cleaning import keep_first
from basketry.session import materialise
from basketry.sources.delimited import ORDINAL
from basketry.specs import UNKNOWN_KEY, UNKNOWN_TEXT

# Fixed value: the calendar built when no sale has a date.
DEFAULT_CALENDAR = ("2024-01-01", "2025-12-31")


def calendar(first: Column, last: Column, spark: SparkSession) -> DataFrame:
    """One row per day from ``first`` to ``last``, Monday = 1, weekend flagged 1."""
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("d"))
    weekday = F.weekday("d") + 1
    return days.select(
        date_key("d").alias("DateKey"),
        F.col("d").alias("FullDate"),
        F.year("d").alias("Year"),
        F.quarter("d").alias("Quarter"),
        F.month("d").alias("Month"),
        F.dayofmonth("d").alias("Day"),
        weekday.alias("DayOfWeek"),
        F.date_format("d", "EEEE").alias("DayName"),
        F.date_format("d", "MMMM").alias("MonthName"),
        (weekday >= 6).cast("int").alias("IsWeekend"),
    )


def dim_date(header: DataFrame) -> DataFrame:
    """Calendar over all order and delivery dates of the cleaned headers."""
    span = header.agg(
        F.least(F.min("orderdate"), F.min("delivdate")).alias("lo"),
        F.greatest(F.max("orderdate"), F.max("delivdate")).alias("hi"),
    )
    lo, hi = (F.lit(x).cast("date") for x in DEFAULT_CALENDAR)
    first = F.coalesce(span.select("lo").scalar(), lo)
    last = F.coalesce(span.select("hi").scalar(), hi)
    return calendar(first, last, header.sparkSession)


# ---- surrogate keys -------------------------------------------------------------------------


def assign_keys(members: DataFrame, natural: str, key: str, order: Sequence[Column | str]) -> DataFrame:
    """A fresh map ``natural -> key``, numbered from 1 in ``order``."""
    extra = [F.col(o) if isinstance(o, str) else o for o in order]
    named = members.select(natural, *[c.alias(f"_o{i}") for i, c in enumerate(extra)])
    return number_rows(named, [F.col(f"_o{i}").asc_nulls_first() for i in range(len(extra))], key).select(
        natural, F.col(key).cast("int").alias(key)
    )


def extend_keys(
    stored: DataFrame, members: DataFrame, natural: str, key: str, order: Sequence[Column | str]
) -> DataFrame:
    """The stored key map, plus keys after its highest for members it does not know.

    A key once given never changes, so facts loaded earlier stay valid over any reload.
    """
    return stored.select(natural, key).unionByName(new_keys(stored, members, natural, key, order))


def new_keys(
    stored: DataFrame, members: DataFrame, natural: str, key: str, order: Sequence[Column | str]
) -> DataFrame:
    """Keys after the highest of the stored map for members it does not know."""
    fresh = members.join(stored.select(natural), natural, "left_anti")
    top = F.coalesce(stored.agg(F.max(key)).scalar(), F.lit(0))
    numbered = assign_keys(fresh, natural, key, order)
    return numbered.select(natural, (F.col(key) + top).cast("int").alias(key))


def keyed(members: DataFrame, keys: DataFrame, natural: str, key: str) -> DataFrame:
    joined = members.join(keys, natural)
    return joined.select(key, *[c for c in members.columns if not c.startswith("_")])


# ---- members --------------------------------------------------------------------------------


def _unique(df: DataFrame, natural: str) -> DataFrame:
    """Second deduplication: trimming may have made two keys equal. Unknown (null order) is first."""
    ranked = df.withColumn("_place", F.struct(F.col(ORDINAL).isNotNull(), F.col(ORDINAL)))
    return keep_first(ranked, [natural], "_place").drop("_place", "_copies")


def customer_members(customer: DataFrame, region: DataFrame, sector: DataFrame) -> DataFrame:
    """Customers with the descriptions of their region and sector, and a name for the nameless."""
    regions = _unique(region, "regionid").select(
        F.col("regionid").alias("_rid"), F.col("description").alias("RegionDescription")
    )
    sectors = _unique(sector, "sectorid").select(
        F.col("sectorid").alias("_sid"), F.col("description").alias("SectorDescription")
    )
    return (
        _unique(customer, "accountid")
        .join(regions, strip("regionid") == F.col("_rid"), "left")
        .join(sectors, strip("sectorid") == F.col("_sid"), "left")
        .select(
            F.col("accountid").alias("AccountID"),
            client_name("accountid", "accountname").alias("AccountName"),
            F.col("regionid").alias("RegionID"),
            "RegionDescription",
            F.col("sectorid").alias("SectorID"),
            "SectorDescription",
            ORDINAL,
        )
    )


def inferred_customers(raw_header: DataFrame, members: DataFrame) -> DataFrame:
    """Members for accounts that occur only in sales headers: a stand-in name, nothing else."""
    accounts = raw_header.select(strip("accountid").alias("AccountID")).filter("AccountID IS NOT NULL")
    missing = accounts.distinct().join(members.select("AccountID"), "AccountID", "left_anti")
    null = F.lit(None).cast("string")
    return missing.select(
        "AccountID",
        client_name("AccountID", null).alias("AccountName"),
        *[null.alias(c) for c in ("RegionID", "RegionDescription", "SectorID", "SectorDescription")],
    )


LATE = "_late"


def with_late(members: DataFrame, raw: DataFrame, column: str, natural: str) -> DataFrame:
    """Members and, marked as late, one for each key of ``raw`` that has none yet: what is known of it is its key
    and, for a customer, a stand-in name. Its real row replaces it under the same surrogate key when it comes."""
    if natural == "AccountID":
        missing = inferred_customers(raw.select(F.col(column).alias("accountid")), members)
    else:
        keys = raw.select(strip(column).alias(natural)).filter(F.col(natural).isNotNull()).distinct()
        missing = keys.join(members.select(natural), natural, "left_anti")
    every = members.withColumn(LATE, F.lit(False)).unionByName(missing.withColumn(LATE, F.lit(True)), allowMissingColumns=True)
    return every.filter(F.col(natural) != "")


def is_stand_in(dim: DataFrame, natural: str, key: str) -> Column:
    """A member of which nothing but its key is known."""
    rest = [c for c in dim.columns if c not in (natural, key)]
    nothing = [F.col(c).isNull() if c != "AccountName" else F.col(c) == F.concat(F.lit("CLIENT_"), F.col(natural)) for c in rest]
    return reduce(and_, nothing)


def seller_members(seller: DataFrame) -> DataFrame:
    return _unique(seller, "sellerid").select(
        F.col("sellerid").alias("SellerID"), F.col("sellername").alias("SellerName"), ORDINAL
    )


def product_members(product: DataFrame) -> DataFrame:
    return _unique(product, "itemid").select(
        F.col("itemid").alias("ItemID"),
        F.col("name").alias("ProductName"),
        F.col("namealias").alias("NameAlias"),
        F.col("marque").alias("Brand"),
        ORDINAL,
    )


def code_or_unknown(c: str) -> Column:
    """A code as its dimension member; lines without one belong to the unknown member."""
    return F.coalesce(strip(c), F.lit(UNKNOWN_TEXT))


def promotion_members(line: DataFrame) -> DataFrame:
    return line.select(code_or_unknown("promotype").alias("PromoType")).filter("PromoType <> ''").distinct()


def payment_members(invoice: DataFrame) -> DataFrame:
    codes = invoice.select(code_or_unknown("paymentmethod").alias("PaymentMethodCode"))
    distinct = codes.filter("PaymentMethodCode <> ''").distinct()
    return distinct.withColumn("PaymentMethodDescription", F.col("PaymentMethodCode"))


def named_dimension(dim_customer: DataFrame) -> DataFrame:
    """Customers without the technical unknown member, as the reports use them."""
    return dim_customer.filter(F.col("AccountID") != UNKNOWN_KEY)


# ---- history --------------------------------------------------------------------------------

VALID_FROM, VALID_TO, CURRENT = "ValidFrom", "ValidTo", "IsCurrent"
#: Versions of a member that rows may meet without being told apart by month.
FEW = 31


def open_versions(members: DataFrame, day: Column) -> DataFrame:
    """First load of a dimension with history: every member is current from ``day`` on."""
    return members.withColumns(
        {VALID_FROM: day.cast("date"), VALID_TO: F.lit(None).cast("date"), CURRENT: F.lit(1)}
    )


def merge_versions(stored: DataFrame, incoming: DataFrame, natural: str, day: Column) -> DataFrame:
    """Slowly changing dimension, type 2.

    A member whose attributes changed gets its current version closed on ``day`` and a new one
    opened. Members absent from ``incoming`` stay as they are. ``incoming`` has one row per key.
    Versions closed earlier do not take part in the join.
    """
    attributes = [c for c in incoming.columns if c != natural]
    current = stored.filter(F.col(CURRENT) == 1)
    closed = stored.filter(F.col(CURRENT) != 1)
    fresh = incoming.select(natural, F.struct(*attributes).alias("_new"))
    both = current.join(fresh, natural, "full_outer")
    had, came = F.col(CURRENT).isNotNull(), F.col("_new").isNotNull()
    same = F.struct(*attributes).eqNullSafe(F.col("_new"))
    changed = had & came & ~same
    kept = both.filter(had).select(
        natural,
        *attributes,
        VALID_FROM,
        F.when(changed, day.cast("date")).alias(VALID_TO),
        F.when(changed, 0).otherwise(1).alias(CURRENT),
    )
    opened = both.filter(changed | (came & ~had)).select(
        natural,
        *[F.col(f"_new.{a}").alias(a) for a in attributes],
        day.cast("date").alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO),
        F.lit(1).alias(CURRENT),
    )
    return closed.select(kept.columns).unionByName(kept).unionByName(opened)


def version_key(natural: str) -> Column:
    """A key of a member's version that every load gives alike."""
    return F.xxhash64(F.col(natural), F.col(VALID_FROM))


def valid_versions(rows: DataFrame, column: str, day: Column, versions: DataFrame, natural: str, key: str) -> DataFrame:
    """``rows`` with ``key``: the version of the member ``column`` that is valid on ``day``; null when there is none.

    ``versions`` has ``natural``, ``key`` and the days of validity, the last one excluded. Members with up to ``FEW``
    versions are joined as they are: a row meets ``FEW`` versions at most, and nothing is laid out. Versions of the
    others are laid out over the months they are valid in, as far as ``rows`` have any, and joined on member and
    month: a member with a version a day then meets a month of them at most. These have many versions, so the months
    add a few rows for each of them. At most one version is valid on a day, so no row comes twice."""
    last = F.coalesce(F.date_sub(VALID_TO, 1), F.lit("9999-12-31").cast("date"))
    held = versions.filter(F.coalesce(F.col(VALID_TO) > F.col(VALID_FROM), F.lit(True)))
    marked = rows.withColumn("_day", day.cast("date"))
    shown = [F.col(natural).alias("_member"), F.col(key), F.col(VALID_FROM).alias("_from"), F.col(VALID_TO).alias("_to")]
    holds = F.col(column) == F.col("_member")
    valid = (F.col("_day") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("_day") < F.col("_to")))
    counted = held.groupBy(F.col(natural).alias("_crowded")).agg(F.count("*").alias("_n")).filter(F.col("_n") > FEW)
    crowded = materialise(counted.select("_crowded"), "crowded")
    if crowded.isEmpty():
        return marked.join(held.select(*shown), holds & valid, "left").select(*rows.columns, key)
    # Members with few versions have them all under one month that is none.
    whole, found = F.lit("0001-01-01").cast("date"), F.col("_crowded").isNotNull()
    month = F.trunc(day, "MM")
    span = rows.agg(F.min(month).alias("lo"), F.max(month).alias("hi"))
    dated = held.join(crowded, F.col(natural) == F.col("_crowded"), "left").select(
        *shown,
        found.alias("_many"),
        F.greatest(F.trunc(VALID_FROM, "MM"), span.select("lo").scalar()).alias("_first"),
        F.least(F.trunc(last, "MM"), span.select("hi").scalar()).alias("_last"),
    )
    months = F.when(~F.col("_many"), F.array(whole)).when(
        F.col("_first") <= F.col("_last"), F.sequence("_first", "_last", F.expr("interval 1 month"))
    )
    monthly = dated.select("_member", key, "_from", "_to", F.explode(months).alias("_month"))
    placed = marked.join(crowded, F.col(column) == F.col("_crowded"), "left").withColumn("_of", F.when(found, month).otherwise(whole))
    return placed.join(monthly, holds & (F.col("_of") == F.col("_month")) & valid, "left").select(*rows.columns, key)


def enrich_customers(
    dim_customer: DataFrame, rfm: DataFrame, risk: DataFrame, value: DataFrame
) -> DataFrame:
    """Fill the analytic columns of the customer dimension from the result tables.

    ``rfm``: CustomerKey, Segment, Recency, Frequency, Monetary; ``risk``: CustomerKey, ChurnRisk;
    ``value``: CustomerKey, CLV_Historical, CLV_Predicted.
    """
    scores = rfm.select(
        "CustomerKey",
        "Segment",
        F.col("Recency").alias("RFM_Recency"),
        F.col("Frequency").alias("RFM_Frequency"),
        F.col("Monetary").cast(MONEY).alias("RFM_Monetary"),
    )
    results = scores.join(risk, "CustomerKey", "left").join(value, "CustomerKey", "left")
    return dim_customer.join(results, "CustomerKey", "left")
