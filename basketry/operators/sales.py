"""Sales, promotion, delivery and payment reports."""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import (
    MONEY,
    client_name,
    date_from_key,
    number,
    payment_label,
    ratio,
    rounded,
    share,
    short_name,
)
from basketry.functions.ranking import exact_quantiles, running_total
from basketry.specs import MISSING_NAMES


def revenue() -> Column:
    return F.sum("LineTotalAmount")


def orders() -> Column:
    return F.count_distinct("SaleID")


def value_counts(df: DataFrame, column: str, n: int | None, name: str = "rows") -> DataFrame:
    """Rows per value, most frequent first; ``n`` of them or all. Nulls are no value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))
    return counted.orderBy(F.desc(name), column).limit(n) if n else counted


def products_by_brand_top(product: DataFrame, n: int = 20) -> DataFrame:
    brands = product.agg(F.count_distinct("marque")).scalar()
    return value_counts(product, "marque", n, "products").withColumn("all_brands", brands)


# ---- time -----------------------------------------------------------------------------------


def month_spine(df: DataFrame, day: str) -> DataFrame:
    """Every month between the first and the last, from one aggregate."""
    span = df.agg(F.trunc(F.min(day), "month").alias("lo"), F.trunc(F.max(day), "month").alias("hi"))
    months = F.sequence("lo", "hi", F.expr("interval 1 month"))
    return span.filter("lo IS NOT NULL").select(F.explode(months).alias("month"))


def monthly(header: DataFrame, measure: Column, name: str) -> DataFrame:
    """A measure per calendar month of the order date; months without orders count 0."""
    per_month = (
        header.filter("orderdate IS NOT NULL")
        .groupBy(F.trunc("orderdate", "month").alias("month"))
        .agg(measure.alias("_v"))
    )
    full = month_spine(header, "orderdate").join(per_month, "month", "left")
    return full.select(F.date_format("month", "yyyy-MM").alias("month"), F.coalesce("_v", F.lit(0)).alias(name))


def monthly_orders(header: DataFrame) -> DataFrame:
    return monthly(header, F.count("*"), "orders")


def monthly_header_revenue(header: DataFrame) -> DataFrame:
    return monthly(header, F.sum("totalamount"), "revenue").withColumn("revenue", number("revenue"))


def orders_by_weekday(header: DataFrame) -> DataFrame:
    """Orders per weekday, Monday first; all seven days."""
    counted = header.filter("orderdate IS NOT NULL").groupBy(F.weekday("orderdate").alias("d")).agg(
        F.count("*").alias("n")
    )
    # 2024-01-01 is a Monday.
    names = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int")), "EEEE")
    week = header.sparkSession.range(7).select(F.col("id").cast("int").alias("d"))
    days = week.join(counted, "d", "left")
    return days.select(
        (F.col("d") + 1).alias("day_of_week"), names.alias("day_name"), F.coalesce("n", F.lit(0)).alias("orders")
    )


def monthly_sales(sales: DataFrame) -> DataFrame:
    month = F.floor(F.col("OrderDateKey") / 100).cast("int").alias("year_month")
    per_month = sales.groupBy(month).agg(revenue().alias("_r"), orders().alias("orders"), F.count("*").alias("lines"))
    return per_month.select("year_month", number("_r").alias("revenue"), "orders", "lines")


def monthly_peaks(sales: DataFrame, n: int = 3) -> DataFrame:
    """The best months and the revenue of the average month."""
    month = F.floor(F.col("OrderDateKey") / 100).cast("int").alias("year_month")
    per_month = sales.groupBy(month).agg(revenue().alias("_r"))
    average = per_month.agg(ratio(F.sum("_r"), F.count("*"))).scalar()
    best = per_month.orderBy(F.desc("_r"), "year_month").limit(n)
    return best.select("year_month", number("_r").alias("revenue"), average.alias("avg_month_revenue"))


def _period(unit: str) -> list[Column]:
    day = date_from_key("OrderDateKey")
    parts = {"year": F.year(day), "quarter": F.quarter(day), "month": F.month(day)}
    upto = {"year": ["year"], "quarter": ["year", "quarter"], "month": ["year", "quarter", "month"]}[unit]
    return [parts[p].alias(p) for p in upto]


def sales_by_period(sales: DataFrame, unit: str) -> DataFrame:
    keys = _period(unit)
    names = ["year", "quarter", "month"][: len(keys)]
    grouped = sales.groupBy(*keys).agg(revenue().alias("_r"), orders().alias("orders"))
    return grouped.select(*names, number("_r").alias("revenue"), "orders")


def sales_rollup(sales: DataFrame) -> DataFrame:
    """Revenue and lines by month with quarter, year and grand totals (``-1`` marks "all").

    The rollup runs over the monthly sums, not over the sales."""
    per_month = sales.groupBy(*_period("month")).agg(revenue().alias("_r"), F.count("*").alias("_n"))
    rolled = per_month.rollup("year", "quarter", "month").agg(F.sum("_r").alias("_r"), F.sum("_n").alias("lines"))
    every = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("year", "quarter", "month")]
    return rolled.select(*every, number("_r").alias("revenue"), "lines")


# ---- geography ------------------------------------------------------------------------------


def sales_by_attribute(sales: DataFrame, customers: DataFrame, attribute: str) -> DataFrame:
    """Revenue and orders per value of a customer attribute (region, sector)."""
    joined = sales.join(customers.select("CustomerKey", attribute), "CustomerKey")
    grouped = joined.filter(F.col(attribute).isNotNull()).groupBy(attribute)
    totals = grouped.agg(revenue().alias("_r"), orders().alias("orders"))
    return totals.select(attribute, number("_r").alias("revenue"), "orders")


def sales_growth(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Growth over the previous quarter with sales, per region and per sector.

    Sales are summed by customer and quarter first, once for both; windows see the quarterly sums."""
    day = date_from_key("OrderDateKey")
    period = F.year(day) * 10 + F.quarter(day)
    base = sales.groupBy("CustomerKey", period.alias("period")).agg(revenue().alias("_r"))
    joined = base.join(customers.select("CustomerKey", "RegionDescription", "SectorDescription"), "CustomerKey")
    kinds = {"region": "RegionDescription", "sector": "SectorDescription"}
    long = joined.select(
        "period",
        "_r",
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("member")) for k, c in kinds.items()])),
    )
    sums = long.filter("member IS NOT NULL").groupBy("kind", "member", "period").agg(F.sum("_r").alias("_r"))
    before = F.lag("_r").over(Window.partitionBy("kind", "member").orderBy("period"))
    with_before = sums.withColumn("_p", before)
    return with_before.select(
        "kind",
        "member",
        "period",
        number("_r").alias("revenue"),
        number(F.coalesce("_p", F.lit(0))).alias("previous"),
        F.coalesce(share(F.col("_r") - F.col("_p"), "_p"), F.lit(0.0)).alias("growth_pct"),
    )


# ---- sellers --------------------------------------------------------------------------------


def top_sellers(header: DataFrame, seller: DataFrame, n: int = 15) -> DataFrame:
    grouped = header.filter("sellerid IS NOT NULL").groupBy("sellerid")
    totals = grouped.agg(
        F.count("saleid").alias("num_orders"),
        F.sum("totalamount").alias("_r"),
        ratio(F.sum("totalamount"), F.count("totalamount")).alias("avg_order_value"),
    )
    best = totals.orderBy(F.desc("_r"), "sellerid").limit(n)
    names = seller.select("sellerid", "sellername")
    return best.join(names, "sellerid", "left").select(
        "sellerid", "sellername", "num_orders", number("_r").alias("total_revenue"), "avg_order_value"
    )


def competition_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Rank from the highest value, equal values sharing a place, over the whole table."""
    counted = df.groupBy(value).agg(F.count("*").alias("_c"))
    placed = running_total(counted, [F.desc(value)], "_c", "_upto")
    places = placed.select(value, (F.col("_upto") - F.col("_c") + 1).cast("long").alias(name))
    return df.join(places, value)


def seller_rank_outliers(sales: DataFrame, sellers: DataFrame) -> DataFrame:
    """Sellers ranked on revenue, orders and average order value; 1 marks a value outside the
    fences one and a half quartile ranges away from the quartiles."""
    measures = ["revenue", "orders", "avg_order_value"]
    totals = sales.groupBy("SellerKey").agg(revenue().alias("_r"), orders().alias("orders"))
    per_seller = totals.select(
        "SellerKey", number("_r").alias("revenue"), "orders", ratio("_r", "orders").alias("avg_order_value")
    )
    long = per_seller.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], measures, "m", "v")
    fences = exact_quantiles(long, "v", {"q1": 0.25, "q3": 0.75}, ["m"])
    width = (F.col("q3") - F.col("q1")) * 1.5
    fences = fences.select("m", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))

    ranked = per_seller
    for m in measures:
        ranked = competition_rank(ranked, m, f"{m}_rank")

    def outside(m: str) -> Column:
        own = fences.filter(F.col("m") == m)
        value = F.col(m).cast("double")
        low, high = own.select("low").scalar(), own.select("high").scalar()
        return ((value < low) | (value > high)).cast("int").alias(f"{m}_outlier")

    flagged = ranked.select("SellerKey", *measures, *[f"{m}_rank" for m in measures], *[outside(m) for m in measures])
    return flagged.join(sellers.select("SellerKey", "SellerID", "SellerName"), "SellerKey", "left")


# ---- products -------------------------------------------------------------------------------


def top_products(sales: DataFrame, products: DataFrame, by: str, n: int = 15) -> DataFrame:
    """Best products by ``revenue`` or ``qty``. Sales are summed by key before names are joined."""
    per_key = sales.groupBy("ProductKey").agg(revenue().alias("revenue"), F.sum("Quantity").alias("qty"))
    named = per_key.join(products.select("ProductKey", "ItemID", "ProductName"), "ProductKey")
    per_item = named.groupBy("ItemID", "ProductName").agg(F.sum("revenue").alias("revenue"), F.sum("qty").alias("qty"))
    best = per_item.filter("ProductName IS NOT NULL").orderBy(F.desc(by), "ItemID").limit(n)
    return best.select(
        "ItemID", "ProductName", short_name("ProductName").alias("label"), number("revenue").alias("revenue"), "qty"
    )


def top_items_qty_raw(line: DataFrame, product: DataFrame, n: int = 15) -> DataFrame:
    """Best items by quantity over the typed raw lines; names are joined to the few that remain."""
    best = line.groupBy("itemid").agg(F.sum("qty").alias("qty")).orderBy(F.desc("qty"), "itemid").limit(n)
    names = product.select("itemid", "name", "marque")
    return best.join(names, "itemid", "left").select("itemid", "qty", "name", "marque")


def top_brands(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    known = products.filter(F.col("Brand").isNotNull() & ~F.col("Brand").isin(MISSING_NAMES))
    per_key = sales.groupBy("ProductKey").agg(revenue().alias("_r"))
    per_brand = per_key.join(known.select("ProductKey", "Brand"), "ProductKey").groupBy("Brand").agg(F.sum("_r").alias("_r"))
    return per_brand.orderBy(F.desc("_r"), "Brand").limit(n).select("Brand", number("_r").alias("revenue"))


def short_names(products: DataFrame, longest: int = 32) -> DataFrame:
    return products.select("ItemID", short_name("ProductName", longest).alias("label"))


def client_names(customer: DataFrame) -> DataFrame:
    return customer.select("accountid", client_name("accountid", "accountname").alias("name"))


# ---- promotions -----------------------------------------------------------------------------

NO_PROMOTION = "No Promotion"


def promo_revenue(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    per_key = sales.groupBy("PromotionKey").agg(revenue().alias("_r"))
    named = per_key.join(promotions, "PromotionKey")
    total = F.sum("_r").over(Window.partitionBy())
    return named.select("PromoType", number("_r").alias("revenue"), share("_r", total).alias("revenue_pct"))


def promo_mix(line: DataFrame) -> DataFrame:
    """Lines, share and average promotion value per type, over the typed raw lines."""
    all_lines = line.agg(F.count("*")).scalar()
    grouped = line.filter("promotype IS NOT NULL").groupBy("promotype")
    totals = grouped.agg(
        F.count("*").alias("lines"), ratio(F.sum("promovalue"), F.count("promovalue")).alias("avg_promo_value")
    )
    return totals.select("promotype", "lines", share("lines", all_lines).alias("lines_pct"), "avg_promo_value")


def zero_price_lines(line: DataFrame) -> DataFrame:
    """Lines with unit price zero by promotion type, and their share of all lines."""
    free = F.col("unitprice") == 0
    grouped = line.groupBy("promotype").agg(F.count_if(free).alias("zero_lines"), F.count("*").alias("_n"))
    whole = Window.partitionBy()
    of_all = share(F.sum("zero_lines").over(whole), F.sum("_n").over(whole))
    shares = grouped.select("promotype", "zero_lines", of_all.alias("zero_pct_of_all"))
    return shares.filter("promotype IS NOT NULL AND zero_lines > 0")


def promo_vs_no_promo(sales: DataFrame, promotions: DataFrame, products: DataFrame) -> DataFrame:
    """Lines, quantity and revenue per product with and without a promotion."""
    per_key = sales.groupBy("ProductKey", "PromotionKey").agg(
        F.count("*").alias("n"), F.sum("Quantity").alias("q"), revenue().alias("r")
    )
    typed = per_key.join(promotions, "PromotionKey")
    plain = F.col("PromoType") == NO_PROMOTION

    def split(c: str, name: str) -> list[Column]:
        zero = F.lit(0)
        return [
            F.sum(F.when(~plain, F.col(c)).otherwise(zero)).alias(f"{name}_promo"),
            F.sum(F.when(plain, F.col(c)).otherwise(zero)).alias(f"{name}_plain"),
        ]

    sums = typed.groupBy("ProductKey").agg(*split("n", "lines"), *split("q", "qty"), *split("r", "revenue"))
    named = sums.join(products.select("ProductKey", "ItemID"), "ProductKey")
    return named.select(
        "ItemID",
        "lines_promo",
        "lines_plain",
        "qty_promo",
        "qty_plain",
        number("revenue_promo").alias("revenue_promo"),
        number("revenue_plain").alias("revenue_plain"),
    )


def promo_response_by_segment(sales: DataFrame, promotions: DataFrame, rfm: DataFrame) -> DataFrame:
    """How each segment's lines and revenue divide among promotion types."""
    per_key = sales.groupBy("CustomerKey", "PromotionKey").agg(F.count("*").alias("n"), revenue().alias("r"))
    joined = per_key.join(rfm.select("CustomerKey", "Segment"), "CustomerKey").join(promotions, "PromotionKey")
    sums = joined.groupBy("Segment", "PromoType").agg(F.sum("n").alias("lines"), F.sum("r").alias("_r"))
    segment = Window.partitionBy("Segment")
    return sums.select(
        "Segment",
        "PromoType",
        "lines",
        share("lines", F.sum("lines").over(segment)).alias("lines_pct"),
        number("_r").alias("revenue"),
        share("_r", F.sum("_r").over(segment)).alias("revenue_pct"),
    )


def promo_roi(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Return per promotion type. The source has no promotion cost, so the promotion value stands in.

    Expected revenue of promoted quantities is taken at the product's average price without
    promotion; products never sold without one are left out of both sides."""
    per_key = sales.groupBy("ProductKey", "PromotionKey").agg(
        F.sum("Quantity").alias("q"), revenue().alias("r"), F.sum("LineDiscountAmount").alias("c")
    )
    typed = per_key.join(promotions, "PromotionKey").drop("PromotionKey")
    plain = typed.filter(F.col("PromoType") == NO_PROMOTION)
    price = rounded(F.try_divide(number("r"), number("q")), 4).cast("decimal(18,4)")
    prices = plain.select("ProductKey", price.alias("p")).filter("p IS NOT NULL")
    promoted = typed.filter(F.col("PromoType") != NO_PROMOTION).join(prices, "ProductKey")
    sums = promoted.groupBy("PromoType").agg(
        F.sum("r").alias("r"), F.sum(F.col("q").cast("decimal(18,0)") * F.col("p")).alias("e"), F.sum("c").alias("c")
    )
    extra = number("r") - number("e")
    return sums.select(
        "PromoType",
        number("r").alias("revenue"),
        rounded("e").alias("expected_revenue"),
        rounded(extra).alias("incremental_revenue"),
        number("c").alias("promo_cost"),
        rounded(F.try_divide(extra - number("c"), number("c"))).alias("roi"),
    )


# ---- delivery -------------------------------------------------------------------------------


def delay_days(sales: DataFrame) -> DataFrame:
    days = F.date_diff(date_from_key("DeliveryDateKey"), date_from_key("OrderDateKey"))
    return sales.select(days.alias("days")).filter(F.col("days").between(0, 30))


def delay_stats(days: DataFrame) -> DataFrame:
    """Mean, median and early shares of delays. Works on the at most 31 distinct values."""
    counted = days.groupBy("days").agg(F.count("*").alias("n"))
    n = F.sum("n")
    return counted.agg(
        n.alias("rows"),
        ratio(F.sum(F.col("days") * F.col("n")), n).alias("mean_days"),
        F.percentile("days", F.lit(0.5), F.col("n")).alias("median_days"),
        share(F.sum(F.when(F.col("days") == 0, F.col("n")).otherwise(0)), n).alias("same_day_pct"),
        share(F.sum(F.when(F.col("days") <= 3, F.col("n")).otherwise(0)), n).alias("within_3_pct"),
    )


def header_delay_days(header: DataFrame) -> DataFrame:
    days = header.select(F.date_diff("delivdate", "orderdate").alias("days"))
    return days.filter(F.col("days").between(0, 30))


def delivery_days_header(header: DataFrame) -> DataFrame:
    """Orders per delay in days, with the median on every row."""
    counted = header_delay_days(header).groupBy("days").agg(F.count("*").alias("orders"))
    median = counted.agg(F.percentile("days", F.lit(0.5), F.col("orders"))).scalar()
    return counted.select("days", "orders", median.alias("median_days"))


# ---- payments -------------------------------------------------------------------------------


def payment_by_method(invoices: DataFrame, methods: DataFrame) -> DataFrame:
    per_key = invoices.groupBy("PaymentMethodKey").agg(F.sum("PaymentAmount").alias("_a"))
    named = per_key.join(methods.select("PaymentMethodKey", "PaymentMethodCode"), "PaymentMethodKey")
    return named.select("PaymentMethodCode", number("_a").alias("amount"))


def payment_mix(invoice: DataFrame) -> DataFrame:
    """Invoices, share and average amount per payment code, over the typed raw invoices."""
    all_rows = invoice.agg(F.count("*")).scalar()
    grouped = invoice.filter("paymentmethod IS NOT NULL").groupBy("paymentmethod")
    totals = grouped.agg(
        F.count("*").alias("invoices"), ratio(F.sum("paymentamount"), F.count("paymentamount")).alias("avg_amount")
    )
    return totals.select(
        payment_label("paymentmethod").alias("method"), "invoices", share("invoices", all_rows).alias("invoices_pct"), "avg_amount"
    )


def payment_trend(invoices: DataFrame, methods: DataFrame) -> DataFrame:
    """Amount per month and method and the method's share of the month."""
    month = F.floor(F.col("PaymentDateKey") / 100).cast("int").alias("year_month")
    sums = invoices.groupBy(month, "PaymentMethodKey").agg(F.sum("PaymentAmount").alias("_a"), F.count("*").alias("invoices"))
    named = sums.join(methods.select("PaymentMethodKey", "PaymentMethodCode"), "PaymentMethodKey")
    in_month = F.sum("_a").over(Window.partitionBy("year_month"))
    return named.select(
        "year_month", "PaymentMethodCode", "invoices", number("_a").alias("amount"), share("_a", in_month).alias("amount_pct")
    )


def customer_payment_balance(sales: DataFrame, invoices: DataFrame) -> DataFrame:
    """Sales less invoiced amount per customer. The risk is the unpaid share, from 0 to 1: the
    source has no due or payment date a delay could be computed from."""
    sold = sales.groupBy("CustomerKey").agg(revenue().alias("s"))
    paid = invoices.groupBy("CustomerKey").agg(F.sum("PaymentAmount").alias("p"))
    both = sold.join(paid, "CustomerKey", "left").withColumn("p", F.coalesce("p", F.lit(0).cast(MONEY)))
    paid_ratio = F.try_divide(number("p"), number("s"))
    return both.select(
        "CustomerKey",
        number("s").alias("sales_total"),
        number("p").alias("invoiced_total"),
        number(F.col("s") - F.col("p")).alias("balance"),
        rounded(paid_ratio, 4).alias("paid_ratio"),
        rounded(F.greatest(F.lit(0.0), F.lit(1.0) - paid_ratio), 4).alias("risk_score"),
    )


def kpi_overview(sales: DataFrame) -> DataFrame:
    """Revenue, customers, orders and average basket.

    Sales are first reduced to one row per order and customer, so that one aggregate serves both
    distinct counts without copying the sales."""
    per_order = sales.groupBy("SaleID", "CustomerKey").agg(revenue().alias("_r"), F.count("*").alias("_n"))
    order_rows = per_order.agg(orders()).scalar()
    totals = per_order.groupBy("CustomerKey").agg(F.sum("_r").alias("_r"), F.sum("_n").alias("_n"))
    return totals.agg(
        F.sum("_r").alias("_r"), F.count("*").alias("customers"), F.sum("_n").alias("lines")
    ).select(
        number("_r").alias("total_revenue"),
        "customers",
        order_rows.alias("orders"),
        "lines",
        ratio("_r", order_rows).alias("avg_basket"),
    )


# ---- customers over time --------------------------------------------------------------------


def _active_months(sales: DataFrame) -> DataFrame:
    return sales.select("CustomerKey", order_month(sales).alias("year_month")).distinct()


def order_month(sales: DataFrame) -> Column:
    """Year and month of an order as a number; the column the stored fact is partitioned by, if it is there."""
    return F.col("order_month") if "order_month" in sales.columns else F.expr("cast(OrderDateKey div 100 as int)")


def retention_new_returning(sales: DataFrame) -> DataFrame:
    """Per month: active customers, those new in it, those returning, and the returning share."""
    first = F.min("year_month").over(Window.partitionBy("CustomerKey"))
    active = _active_months(sales).withColumn("_new", F.col("year_month") == first)
    sums = active.groupBy("year_month").agg(
        F.count("*").alias("active"),
        F.count_if("_new").alias("new_customers"),
        F.count_if(~F.col("_new")).alias("returning_customers"),
    )
    return sums.select("*", share("returning_customers", "active").alias("repeat_rate_pct"))


def loyal_customers(sales: DataFrame, months: int = 3) -> DataFrame:
    """Customers with an order in each of the last ``months`` whole months. The month the data end
    in counts only if they reach its last day."""
    latest = sales.agg(F.max("OrderDateKey")).first()[0]
    if latest is None:
        return sales.select("CustomerKey", F.lit(0).cast("long").alias("months_active")).limit(0)
    year, month, day = latest // 10000, latest // 100 % 100, latest % 100
    last = year * 12 + month - 1 - (day < calendar.monthrange(year, month)[1])
    # Plain numbers, so that only the folders of these months are read.
    wanted = [(last - i) // 12 * 100 + (last - i) % 12 + 1 for i in range(months)]
    recent = _active_months(sales.filter(order_month(sales).isin(wanted)))
    counted = recent.groupBy("CustomerKey").agg(F.count("*").alias("months_active"))
    return counted.filter(F.col("months_active") == months)
