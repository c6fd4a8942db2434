"""Fact tables: one join on the sale, key lookups, measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import MONEY, date_key, strip
from basketry.operators.cleaning import ROW, TWIN, keep_first_of_few, row_hash
from basketry.operators.dimensions import code_or_unknown
from basketry.session import materialise

MONTH = "order_month"


def with_row_keys(rows: DataFrame, naturals: Sequence[str], key: str) -> DataFrame:
    """Add ``key``: the hash of the row's keys as they came, the same in every load. Rows without the hash of their
    source get one of ``naturals``.

    Different rows may share a hash. Hashes are counted, only of rows that may share theirs where the cleaning has
    told which; of the rows of one that is shared all but the first, in the order of their keys, get another hash with
    their place in it."""
    hashed = rows if ROW in rows.columns else rows.withColumn(ROW, row_hash(*naturals))
    doubtful = hashed.filter(TWIN) if ROW in rows.columns and TWIN in rows.columns else hashed
    hashed = hashed.drop(TWIN)
    counted = doubtful.groupBy(ROW).agg(F.count("*").alias("_n")).filter("_n > 1")
    shared = materialise(counted.select(F.col(ROW).alias("_shared")), "shared")
    if shared.isEmpty():
        return hashed.withColumnRenamed(ROW, key)
    marked = hashed.join(shared, F.col(ROW) == F.col("_shared"), "left")
    alone = marked.filter("_shared IS NULL").drop("_shared").withColumnRenamed(ROW, key)
    place = F.row_number().over(Window.partitionBy(ROW).orderBy(*naturals))
    spread = marked.filter("_shared IS NOT NULL").drop("_shared").withColumn("_place", place)
    again = F.when(F.col("_place") == 1, F.col(ROW)).otherwise(F.xxhash64(ROW, "_place"))
    return alone.unionByName(spread.withColumn(key, again).drop(ROW, "_place"))


def look_up(df: DataFrame, column: Column, dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Surrogate key of ``column``, null when the dimension has no such member.

    Dimension keys are unique. No side is forced to broadcast: a dimension under the session's
    threshold is broadcast from its measured size, a larger one is joined by shuffle.
    """
    pairs = dim.select(F.col(natural).alias("_natural"), key)
    return df.withColumn("_code", column).join(pairs, F.col("_code") == F.col("_natural"), "left").drop("_code", "_natural")


def sale_number(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def sale_keys(header: DataFrame, dim_customer: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Headers as both facts need them: one per sale, keys looked up, dates as keys.

    Customers and sellers are looked up here, at header grain, where there are several times fewer
    rows than lines. Store the result before the facts are joined: their joins then have a plain
    shuffle on either side, which is what adaptive execution can split when one sale is hot."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(MONEY)
    # Amounts and dates are as narrow as they are stored before members too many for a broadcast are met.
    amounts = {"HeaderBruteAmount": "bruteamount", "HeaderNetAmount": "netamount", "HeaderTaxAmount": "taxamount", "HeaderTotalAmount": "totalamount"}
    rows = keep_first_of_few(header, ["saleid"]).select(
        "saleid",
        date_key("orderdate").alias("OrderDateKey"),
        date_key("delivdate").alias("DeliveryDateKey"),
        strip("accountid").alias("accountid"),
        strip("sellerid").alias("sellerid"),
        *[zero(c).alias(n) for n, c in amounts.items()],
    )
    rows = look_up(rows, F.col("accountid"), dim_customer, "AccountID", "CustomerKey").drop("accountid")
    rows = look_up(rows, F.col("sellerid"), dim_seller, "SellerID", "SellerKey")
    return rows.select("saleid", "OrderDateKey", "DeliveryDateKey", "CustomerKey", "SellerKey", *amounts)


def line_measures(line: DataFrame) -> DataFrame:
    """Measures of a line: brute and net are the amount before tax, discount is the raw promotion
    value, tax is the difference of the totals. Missing quantity, price and tax count as zero."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    ht, ttc = F.col("httotalamount"), F.col("ttctotalamount")
    measures = {
        "Quantity": zero(F.col("qty")).cast("int"),
        "UnitPrice": zero(F.col("unitprice")).cast(MONEY),
        "LineBruteAmount": ht.cast(MONEY),
        "LineDiscountAmount": F.col("promovalue").cast(MONEY),
        "LineNetAmount": ht.cast(MONEY),
        "LineTaxAmount": zero(ttc - ht).cast(MONEY),
        "LineTotalAmount": ttc.cast(MONEY),
    }
    kept = [c for c in ("saleid", "itemid", "promotype", "SalesKey") if c in line.columns]
    return line.select(*kept, *[e.alias(n) for n, e in measures.items()])


FACT_KEYS = ["OrderDateKey", "DeliveryDateKey", "CustomerKey", "SellerKey", "ProductKey", "PromotionKey"]
FACT_MEASURES = [
    "Quantity", "UnitPrice", "LineBruteAmount", "LineDiscountAmount", "LineNetAmount", "LineTaxAmount",
    "LineTotalAmount", "HeaderBruteAmount", "HeaderNetAmount", "HeaderTaxAmount", "HeaderTotalAmount",
]


def fact_sales(sales: DataFrame, line: DataFrame, dim_product: DataFrame, dim_promotion: DataFrame) -> DataFrame:
    """Sales at line grain; ``sales`` are the stored ``sale_keys``. The only large shuffle is the
    join of lines and sales; rows with a key that does not resolve are dropped before it."""
    headers = sales.na.drop(subset=["OrderDateKey", "DeliveryDateKey", "CustomerKey", "SellerKey"])
    lines = line_measures(with_row_keys(line, ["saleid", "itemid"], "SalesKey"))
    # A hash does not compress: products are met without those that the keys of the row give again.
    plain = row_hash("saleid", "itemid")
    lines = lines.withColumn("SalesKey", F.when(F.col("SalesKey") != plain, F.col("SalesKey")))
    # Promotions are few and broadcast: their text is gone before products too many for that are met.
    lines = look_up(lines, code_or_unknown("promotype"), dim_promotion, "PromoType", "PromotionKey").drop("promotype")
    lines = look_up(lines, strip("itemid"), dim_product, "ItemID", "ProductKey")
    lines = lines.withColumn("SalesKey", F.coalesce("SalesKey", plain)).drop("itemid")
    # The net amount is the brute one: it is named after the shuffle.
    lines = lines.na.drop(subset=["ProductKey", "PromotionKey"]).drop("LineNetAmount")
    return lines.join(headers, "saleid").withColumn("LineNetAmount", F.col("LineBruteAmount")).select(
        "SalesKey",
        sale_number("saleid").alias("SaleID"),
        *FACT_KEYS,
        *FACT_MEASURES,
        F.floor(F.col("OrderDateKey") / 100).cast("int").alias(MONTH),
    )


def fact_invoices(invoice: DataFrame, sales: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Invoices with the customer and order date of their sale; those that do not resolve are dropped.
    ``sales`` are the stored ``sale_keys``."""
    known = sales.select(
        F.col("saleid").try_cast("bigint").alias("SaleID"), "CustomerKey", F.col("OrderDateKey").alias("PaymentDateKey")
    ).na.drop()
    rows = with_row_keys(invoice, ["invoiceid"], "InvoiceKey")
    rows = rows.withColumn("SaleID", F.col("salesid").try_cast("bigint")).filter("SaleID IS NOT NULL")
    rows = look_up(rows, code_or_unknown("paymentmethod"), dim_payment, "PaymentMethodCode", "PaymentMethodKey")
    return (
        rows.filter("PaymentMethodKey IS NOT NULL")
        .join(known, "SaleID")
        .select(
            "InvoiceKey",
            F.col("invoiceid").alias("InvoiceID"),
            "SaleID",
            "PaymentDateKey",
            "CustomerKey",
            "PaymentMethodKey",
            F.coalesce(F.col("paymentamount"), F.lit(0)).cast(MONEY).alias("PaymentAmount"),
            F.floor(F.col("PaymentDateKey") / 100).cast("int").alias(MONTH),
        )
    )
