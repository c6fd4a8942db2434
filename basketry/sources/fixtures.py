"""The eight source tables, derived from the driver's order tables with known defects in them.

The mapping and the defects are those of FIXTURES.md: every rule is a function of the keys, so
the SQL the results are compared with can state the same defects. ``_ord`` is the file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.delimited import ORDINAL

MONEY, RATE = "decimal(18,2)", "decimal(4,2)"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table, read as its files lie."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _key(c: str) -> Column:
    """Null key where the number is a multiple of 997."""
    return F.when(F.col(c) % 997 != 0, _text(F.col(c)))


def _comma(c: Column) -> Column:
    return F.replace(_text(c), F.lit("."), F.lit(","))


def _with_copies(df: DataFrame, key: str, spoiled: dict[str, Column]) -> DataFrame:
    """Follow every row whose key is a multiple of 500 by a copy with other contents."""
    first = df.withColumn(ORDINAL, F.col(key) * 2)
    copy = df.filter(F.col(key) % 500 == 0).withColumn(ORDINAL, F.col(key) * 2 + 1)
    return first.unionByName(copy.withColumns(spoiled))


def region(spark: SparkSession, folder: str) -> DataFrame:
    n = read_table(spark, folder, "nation")
    return n.select(
        _key("n_nationkey").alias("regionid"),
        F.col("n_name").alias("description"),
        F.col("n_nationkey").cast("long").alias(ORDINAL),
    )


def sector(spark: SparkSession, folder: str) -> DataFrame:
    c = read_table(spark, folder, "customer").select("c_mktsegment").distinct()
    s = F.col("c_mktsegment")
    return c.select(s.alias("sectorid"), F.concat(s, F.lit(" – équipé")).alias("description"), s.alias(ORDINAL))


def customer(spark: SparkSession, folder: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    dirty_name = (
        F.when(k % 56 == 0, F.lit("   "))
        .when(k % 40 == 0, F.lit("Unknown"))
        .when(k % 8 == 0, F.lit(None).cast("string"))
        .when(k % 41 == 0, F.concat(F.lit("  "), name, F.lit("  ")))
        .otherwise(name)
    )
    rows = _with_copies(
        read_table(spark, folder, "customer").withColumn("accountname", dirty_name),
        "c_custkey",
        {"accountname": F.lit("second copy")},
    )
    return rows.select(
        _key("c_custkey").alias("accountid"),
        "accountname",
        _text(F.col("c_nationkey")).alias("regionid"),
        F.col("c_mktsegment").alias("sectorid"),
        ORDINAL,
    )


def seller(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_copies(
        read_table(spark, folder, "supplier"), "s_suppkey", {"s_name": F.lit("second copy")}
    )
    return rows.select(_key("s_suppkey").alias("sellerid"), F.col("s_name").alias("sellername"), ORDINAL)


def product(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_copies(read_table(spark, folder, "part"), "p_partkey", {"p_brand": F.lit("second copy")})
    return rows.select(
        _key("p_partkey").alias("itemid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("namealias"),
        F.when(F.col("p_partkey") % 97 != 0, F.col("p_brand")).alias("marque"),
        ORDINAL,
    )


def _priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with exact amounts: prices and rates become decimals before any arithmetic."""
    lines = read_table(spark, folder, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    off, tax = F.col("l_discount").cast(RATE), F.col("l_tax").cast(RATE)
    one = F.lit(1).cast("decimal(4,2)")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("pieces"),
        price.alias("price"),
        off.alias("off"),
        tax.alias("tax"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.round(price * (one - off), 2).cast(MONEY).alias("ht"),
        F.round(price * (one - off) * (one + tax), 2).cast(MONEY).alias("ttc"),
    )


def sales_header(spark: SparkSession, folder: str) -> DataFrame:
    per_order = (
        _priced_lines(spark, folder)
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("sellerid"),
            F.min("shipped").alias("delivdate"),
            F.sum("price").cast(MONEY).alias("brute"),
            F.sum("ht").cast(MONEY).alias("net"),
            F.sum(F.col("ttc") - F.col("ht")).cast(MONEY).alias("vat"),
        )
    )
    k = F.col("o_orderkey")
    orders = read_table(spark, folder, "orders").filter(k % 50 != 7)
    joined = orders.join(per_order, k == F.col("l_orderkey"), "left")
    total = F.when(k % 1009 == 0, F.lit("n/a")).otherwise(_comma(F.col("o_totalprice").cast(MONEY)))
    rows = _with_copies(joined.withColumn("total", total), "o_orderkey", {"total": F.lit("0,00")})
    account = F.when(F.col("o_custkey") % 113 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    day = F.when(k % 1013 == 0, F.lit("2024-13-45")).otherwise(_text(F.col("o_orderdate").cast("date")))
    return rows.select(
        _key("o_orderkey").alias("saleid"),
        _text(account).alias("accountid"),
        _text(F.col("sellerid")).alias("sellerid"),
        day.alias("orderdate"),
        _text(F.col("delivdate")).alias("delivdate"),
        _comma(F.col("brute")).alias("bruteamount"),
        _comma(F.col("net")).alias("netamount"),
        _comma(F.col("vat")).alias("taxamount"),
        F.col("total").alias("totalamount"),
        ORDINAL,
    )


def sales_line(spark: SparkSession, folder: str) -> DataFrame:
    p, off = F.col("l_partkey"), F.col("off")
    promo = (
        F.when(off < 0.005, F.lit("No Promotion"))
        .when(off < 0.045, F.lit("Discount"))
        .when(off < 0.075, F.lit("Rebates"))
        .otherwise(F.lit("Gift"))
    )
    pieces = (
        F.when((p % 101 == 0) & (F.col("l_linenumber") % 2 == 0), -F.col("pieces"))
        .when(p % 101 == 0, F.lit(0))
        .otherwise(F.col("pieces"))
    )
    free = (off >= 0.075) & (p % 3 == 0)
    order = F.struct("l_linenumber", "pieces", "price", "off", "tax", "l_suppkey", "shipped")
    return _priced_lines(spark, folder).select(
        _key("l_orderkey").alias("saleid"),
        _text(F.when(p % 211 == 0, -p).otherwise(p)).alias("itemid"),
        _text(pieces).alias("qty"),
        _text(F.when(free, F.lit(0).cast(MONEY)).otherwise(F.col("price"))).alias("unitprice"),
        _text(F.col("ht")).alias("httotalamount"),
        _text(F.col("ttc")).alias("ttctotalamount"),
        promo.alias("promotype"),
        _text((off * 100).cast("int")).alias("promovalue"),
        order.alias(ORDINAL),
    )


def invoice(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    amount = F.when(k % 1009 == 0, F.lit("n/a")).otherwise(_comma(F.col("o_totalprice").cast(MONEY)))
    method = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("001"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("102"))
        .otherwise(F.lit("205"))
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", amount.alias("amount"), method.alias("method"))
    rows = _with_copies(orders, "o_orderkey", {"amount": F.lit("0,00")})
    return rows.select(
        F.when(k % 997 != 0, F.concat(F.lit("INV-"), _text(k))).alias("invoiceid"),
        _text(k).alias("salesid"),
        F.col("amount").alias("paymentamount"),
        F.col("method").alias("paymentmethod"),
        ORDINAL,
    )


RAW = {
    "Region": region,
    "Sector": sector,
    "Customer": customer,
    "Seller": seller,
    "Product": product,
    "SalesHeader": sales_header,
    "SalesLine": sales_line,
    "Invoice": invoice,
}
#: Entities whose rows are columns of one stored table, without a join or an aggregate.
IN_PLACE = ("Customer", "Seller", "Product", "SalesLine", "Invoice")


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in RAW.items()}
