"""SQL with the same meaning as the queries, for comparison on the same Parquet tables.

Each statement is a query over named building blocks (raw, clean and star tables); the blocks it
needs are put in front of it as common table expressions.
"""

from __future__ import annotations

import re

# ---- small expression builders --------------------------------------------------------------


def rnd(x: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def num(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def share(a: str, b: str, digits: int = 2) -> str:
    return rnd(f"CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0)", digits)


def ratio(a: str, b: str, digits: int = 2) -> str:
    return rnd(f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", digits)


def dkey(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def kdate(k: str) -> str:
    return f"make_date(CAST({k} // 10000 AS BIGINT), CAST({k} // 100 % 100 AS BIGINT), CAST({k} % 100 AS BIGINT))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def money(x: str) -> str:
    return f"TRY_CAST(replace({x}, ',', '.') AS DECIMAL(18,2))"


def comma(x: str) -> str:
    return f"replace(CAST({x} AS VARCHAR), '.', ',')"


def copies(source: str, key: str, select: str, spoiled: str) -> str:
    """Rows in file order, those with a key that is a multiple of 500 followed by a spoiled copy."""
    return f"""SELECT {select.format(v='v')} FROM (
        SELECT *, {key} * 2 AS _ord, CAST(NULL AS VARCHAR) AS _spoil FROM {source}
        UNION ALL SELECT *, {key} * 2 + 1, '{spoiled}' FROM {source} WHERE {key} % 500 = 0) v"""


def first_rows(source: str, keys: list[str], order: str = "_ord") -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS _rn,
        count(*) OVER (PARTITION BY {', '.join(keys)}) AS _copies FROM {source} WHERE {present}) WHERE _rn = 1)"""


def tidy(x: str, n: int) -> str:
    return f"substr(replace(replace({strip(x)}, chr(13) || chr(10), ' '), chr(10), ' '), 1, {n})"


RAW_COLUMNS = {
    "Region": ["regionid", "description"],
    "Sector": ["sectorid", "description"],
    "Customer": ["accountid", "accountname", "regionid", "sectorid"],
    "Seller": ["sellerid", "sellername"],
    "Product": ["itemid", "name", "namealias", "marque"],
    "SalesHeader": [
        "saleid", "accountid", "sellerid", "orderdate", "delivdate", "bruteamount", "netamount", "taxamount", "totalamount",
    ],
    "SalesLine": [
        "saleid", "itemid", "qty", "unitprice", "httotalamount", "ttctotalamount", "promotype", "promovalue",
    ],
    "Invoice": ["invoiceid", "salesid", "paymentamount", "paymentmethod"],
}
RAW = {n: f"raw_{n.lower()}" for n in RAW_COLUMNS}

# ---- building blocks ------------------------------------------------------------------------

B: dict[str, str] = {}

B["raw_region"] = """SELECT CASE WHEN n_nationkey % 997 <> 0 THEN CAST(n_nationkey AS VARCHAR) END AS regionid,
    n_name AS description, n_nationkey AS _ord FROM nation"""
B["raw_sector"] = """SELECT DISTINCT c_mktsegment AS sectorid, c_mktsegment || ' – équipé' AS description,
    c_mktsegment AS _ord FROM customer"""
B["raw_customer"] = copies(
    "customer",
    "c_custkey",
    """CASE WHEN c_custkey % 997 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS accountid,
    CASE WHEN _spoil IS NOT NULL THEN _spoil WHEN c_custkey % 56 = 0 THEN '   ' WHEN c_custkey % 40 = 0 THEN 'Unknown'
         WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN '  ' || c_name || '  ' ELSE c_name END AS accountname,
    CAST(c_nationkey AS VARCHAR) AS regionid, c_mktsegment AS sectorid, _ord""",
    "second copy",
)
B["raw_seller"] = copies(
    "supplier",
    "s_suppkey",
    """CASE WHEN s_suppkey % 997 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS sellerid,
    coalesce(_spoil, s_name) AS sellername, _ord""",
    "second copy",
)
B["raw_product"] = copies(
    "part",
    "p_partkey",
    """CASE WHEN p_partkey % 997 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS itemid, p_name AS name, p_type AS namealias,
    CASE WHEN p_partkey % 97 <> 0 THEN coalesce(_spoil, p_brand) END AS marque, _ord""",
    "second copy",
)
B["priced"] = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, pieces, price, off, tax, shipped,
    CAST(ROUND(price * (CAST(1 AS DECIMAL(4,2)) - off), 2) AS DECIMAL(18,2)) AS ht,
    CAST(ROUND(price * (CAST(1 AS DECIMAL(4,2)) - off) * (CAST(1 AS DECIMAL(4,2)) + tax), 2) AS DECIMAL(18,2)) AS ttc
    FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER) AS pieces,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS off,
        CAST(l_tax AS DECIMAL(4,2)) AS tax, CAST(l_shipdate AS DATE) AS shipped FROM lineitem)"""
B["joined_orders"] = f"""SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, p.*,
    CASE WHEN o.o_orderkey % 1009 = 0 THEN 'n/a' ELSE {comma('CAST(o.o_totalprice AS DECIMAL(18,2))')} END AS total
    FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sellerid, min(shipped) AS delivdate,
        CAST(sum(price) AS DECIMAL(18,2)) AS brute, CAST(sum(ht) AS DECIMAL(18,2)) AS net,
        CAST(sum(ttc - ht) AS DECIMAL(18,2)) AS vat FROM priced GROUP BY l_orderkey) p ON o.o_orderkey = p.l_orderkey
    WHERE o.o_orderkey % 50 <> 7"""
B["raw_salesheader"] = copies(
    "joined_orders",
    "o_orderkey",
    f"""CASE WHEN o_orderkey % 997 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS saleid,
    CAST(CASE WHEN o_custkey % 113 = 0 THEN -o_custkey ELSE o_custkey END AS VARCHAR) AS accountid,
    CAST(sellerid AS VARCHAR) AS sellerid,
    CASE WHEN o_orderkey % 1013 = 0 THEN '2024-13-45' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS orderdate,
    CAST(delivdate AS VARCHAR) AS delivdate, {comma('brute')} AS bruteamount, {comma('net')} AS netamount,
    {comma('vat')} AS taxamount, coalesce(_spoil, total) AS totalamount, _ord""",
    "0,00",
)
B["raw_salesline"] = """SELECT CASE WHEN l_orderkey % 997 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS saleid,
    CAST(CASE WHEN l_partkey % 211 = 0 THEN -l_partkey ELSE l_partkey END AS VARCHAR) AS itemid,
    CAST(CASE WHEN l_partkey % 101 = 0 AND l_linenumber % 2 = 0 THEN -pieces WHEN l_partkey % 101 = 0 THEN 0 ELSE pieces END AS VARCHAR) AS qty,
    CAST(CASE WHEN off >= 0.075 AND l_partkey % 3 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE price END AS VARCHAR) AS unitprice,
    CAST(ht AS VARCHAR) AS httotalamount, CAST(ttc AS VARCHAR) AS ttctotalamount,
    CASE WHEN off < 0.005 THEN 'No Promotion' WHEN off < 0.045 THEN 'Discount' WHEN off < 0.075 THEN 'Rebates' ELSE 'Gift' END AS promotype,
    CAST(CAST(off * 100 AS INTEGER) AS VARCHAR) AS promovalue,
    l_linenumber AS _o1, CASE WHEN l_partkey % 101 = 0 THEN pieces ELSE pieces END AS _o2, price AS _o3, off AS _o4, tax AS _o5, l_suppkey AS _o6, shipped AS _o7
    FROM priced"""
LINE_ORDER = "_o1, _o2, _o3, _o4, _o5, _o6, _o7"
B["priced_invoices"] = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 1009 = 0 THEN 'n/a' ELSE {comma('CAST(o_totalprice AS DECIMAL(18,2))')} END AS amount,
    CASE o_orderpriority WHEN '1-URGENT' THEN '001' WHEN '2-HIGH' THEN '102' ELSE '205' END AS method FROM orders"""
B["raw_invoice"] = copies(
    "priced_invoices",
    "o_orderkey",
    """CASE WHEN o_orderkey % 997 <> 0 THEN 'INV-' || CAST(o_orderkey AS VARCHAR) END AS invoiceid,
    CAST(o_orderkey AS VARCHAR) AS salesid, coalesce(_spoil, amount) AS paymentamount, method AS paymentmethod, _ord""",
    "0,00",
)


def _dimension(raw: str, key: str, columns: dict[str, int]) -> str:
    casts = ", ".join(f"{tidy(c, n)} AS {c}" for c, n in columns.items())
    unknown = ", ".join("'__UNKNOWN__'" if c == key else "'Unknown'" for c in columns)
    return f"SELECT {casts}, _ord FROM {first_rows(raw, [key])} UNION ALL SELECT {unknown}, NULL"


B["clean_region"] = _dimension("raw_region", "regionid", {"regionid": 50, "description": 100})
B["clean_sector"] = _dimension("raw_sector", "sectorid", {"sectorid": 50, "description": 100})
B["clean_customer"] = _dimension(
    "raw_customer", "accountid", {"accountid": 50, "accountname": 100, "regionid": 50, "sectorid": 50}
)
B["clean_seller"] = _dimension("raw_seller", "sellerid", {"sellerid": 50, "sellername": 100})
B["clean_product"] = _dimension(
    "raw_product", "itemid", {"itemid": 50, "name": 100, "namealias": 100, "marque": 50}
)


def _mapped(column: str, parent: str, key: str) -> str:
    return f"CASE WHEN {column} IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL) THEN {column} ELSE '__UNKNOWN__' END"


_HEADER_CASTS = f"""TRY_CAST(orderdate AS DATE) AS orderdate, TRY_CAST(delivdate AS DATE) AS delivdate,
    {money('bruteamount')} AS bruteamount, {money('netamount')} AS netamount, {money('taxamount')} AS taxamount, {money('totalamount')} AS totalamount"""
_LINE_CASTS = f"""CAST(round_even(TRY_CAST(qty AS DOUBLE), 0) AS INTEGER) AS qty, {money('unitprice')} AS unitprice,
    {money('httotalamount')} AS httotalamount, {money('ttctotalamount')} AS ttctotalamount, promotype, {money('promovalue')} AS promovalue"""
B["clean_salesheader"] = f"""SELECT saleid, {_mapped('accountid', 'clean_customer', 'accountid')} AS accountid,
    {_mapped('sellerid', 'clean_seller', 'sellerid')} AS sellerid, {_HEADER_CASTS}, _ord FROM {first_rows('raw_salesheader', ['saleid'])}"""
B["clean_salesline"] = f"""SELECT saleid, {_mapped('itemid', 'clean_product', 'itemid')} AS itemid, {_LINE_CASTS}
    FROM {first_rows('raw_salesline', ['saleid', 'itemid'], LINE_ORDER)} WHERE TRY_CAST(qty AS DOUBLE) > 0
    AND saleid IN (SELECT saleid FROM clean_salesheader)"""
B["clean_invoice"] = f"""SELECT invoiceid, {_mapped('salesid', 'clean_salesheader', 'saleid')} AS salesid,
    {money('paymentamount')} AS paymentamount, regexp_replace(paymentmethod, '^0+([0-9])', '\\1') AS paymentmethod
    FROM {first_rows('raw_invoice', ['invoiceid'])}"""

B["dim_date"] = f"""SELECT {dkey('d')} AS DateKey, CAST(d AS VARCHAR) AS FullDate, year(d) AS Year, quarter(d) AS Quarter, month(d) AS Month, day(d) AS Day,
    isodow(d) AS DayOfWeek, dayname(d) AS DayName, monthname(d) AS MonthName, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS IsWeekend
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM
      (SELECT least(min(orderdate), min(delivdate)) AS lo, greatest(max(orderdate), max(delivdate)) AS hi FROM clean_salesheader))"""
_CLIENT = "CASE WHEN accountname IS NULL OR {0} IN ('', 'Unknown', 'nan') THEN 'CLIENT_' || accountid ELSE accountname END".format(
    strip("accountname")
)
B["customer_members"] = f"""SELECT c.accountid AS AccountID, {_CLIENT} AS AccountName, c.regionid AS RegionID,
    r.description AS RegionDescription, c.sectorid AS SectorID, s.description AS SectorDescription, c._ord
    FROM clean_customer c LEFT JOIN clean_region r ON c.regionid = r.regionid LEFT JOIN clean_sector s ON c.sectorid = s.sectorid"""
_KEYED = "CAST(row_number() OVER (ORDER BY _ord NULLS FIRST) AS INTEGER)"
B["dim_customer"] = f"""SELECT {_KEYED} AS CustomerKey, AccountID, AccountName, RegionID, RegionDescription, SectorID, SectorDescription
    FROM customer_members"""
B["dim_seller"] = f"SELECT {_KEYED} AS SellerKey, sellerid AS SellerID, sellername AS SellerName FROM clean_seller"
B["dim_product"] = (
    f"SELECT {_KEYED} AS ProductKey, itemid AS ItemID, name AS ProductName, namealias AS NameAlias, marque AS Brand FROM clean_product"
)
B["dim_promotion"] = """SELECT CAST(row_number() OVER (ORDER BY PromoType) AS INTEGER) AS PromotionKey, PromoType
    FROM (SELECT DISTINCT coalesce(promotype, 'Unknown') AS PromoType FROM clean_salesline)"""
B["dim_payment"] = """SELECT CAST(row_number() OVER (ORDER BY PaymentMethodCode) AS INTEGER) AS PaymentMethodKey, PaymentMethodCode,
    PaymentMethodCode AS PaymentMethodDescription FROM (SELECT DISTINCT coalesce(paymentmethod, 'Unknown') AS PaymentMethodCode FROM clean_invoice)"""
B["fact_sales"] = f"""SELECT CAST(l.saleid AS BIGINT) AS SaleID, {dkey('h.orderdate')} AS OrderDateKey, {dkey('h.delivdate')} AS DeliveryDateKey,
    c.CustomerKey, s.SellerKey, p.ProductKey, m.PromotionKey, coalesce(l.qty, 0) AS Quantity,
    coalesce(l.unitprice, CAST(0 AS DECIMAL(18,2))) AS UnitPrice, l.httotalamount AS LineBruteAmount, l.promovalue AS LineDiscountAmount,
    l.httotalamount AS LineNetAmount, CAST(coalesce(l.ttctotalamount - l.httotalamount, 0) AS DECIMAL(18,2)) AS LineTaxAmount,
    l.ttctotalamount AS LineTotalAmount, coalesce(h.bruteamount, CAST(0 AS DECIMAL(18,2))) AS HeaderBruteAmount,
    coalesce(h.netamount, CAST(0 AS DECIMAL(18,2))) AS HeaderNetAmount, coalesce(h.taxamount, CAST(0 AS DECIMAL(18,2))) AS HeaderTaxAmount,
    coalesce(h.totalamount, CAST(0 AS DECIMAL(18,2))) AS HeaderTotalAmount
    FROM clean_salesline l JOIN clean_salesheader h ON l.saleid = h.saleid JOIN dim_customer c ON h.accountid = c.AccountID
    JOIN dim_seller s ON h.sellerid = s.SellerID JOIN dim_product p ON l.itemid = p.ItemID
    JOIN dim_promotion m ON coalesce(l.promotype, 'Unknown') = m.PromoType WHERE h.orderdate IS NOT NULL AND h.delivdate IS NOT NULL"""
B["fact_invoices"] = f"""SELECT i.invoiceid AS InvoiceID, CAST(h.saleid AS BIGINT) AS SaleID, {dkey('h.orderdate')} AS PaymentDateKey,
    c.CustomerKey, m.PaymentMethodKey, coalesce(i.paymentamount, CAST(0 AS DECIMAL(18,2))) AS PaymentAmount
    FROM clean_invoice i JOIN clean_salesheader h ON i.salesid = h.saleid JOIN dim_customer c ON h.accountid = c.AccountID
    JOIN dim_payment m ON coalesce(i.paymentmethod, 'Unknown') = m.PaymentMethodCode WHERE h.orderdate IS NOT NULL"""
B["named_dim"] = "SELECT * FROM dim_customer WHERE AccountID <> '__UNKNOWN__'"

B["rfm_base"] = f"""SELECT CustomerKey, CAST({kdate('(SELECT max(OrderDateKey) FROM fact_sales)')} - {kdate('last')} AS INTEGER) AS Recency, Frequency, Monetary
    FROM (SELECT CustomerKey, max(OrderDateKey) AS last, count(DISTINCT SaleID) AS Frequency, sum(LineTotalAmount) AS Monetary
          FROM fact_sales GROUP BY CustomerKey)"""
B["rfm_q"] = """SELECT CustomerKey, Recency, Frequency, Monetary,
    CASE WHEN Recency <= q1 THEN 4 WHEN Recency <= q2 THEN 3 WHEN Recency <= q3 THEN 2 ELSE 1 END AS R_quartile,
    CAST(greatest(1, ((f - 1) * 4 + n - 2) // greatest(n - 1, 1)) AS INTEGER) AS F_quartile,
    CAST(greatest(1, ((m - 1) * 4 + n - 2) // greatest(n - 1, 1)) AS INTEGER) AS M_quartile
    FROM (SELECT *, row_number() OVER (ORDER BY Frequency, CustomerKey) AS f, row_number() OVER (ORDER BY Monetary, CustomerKey) AS m,
          count(*) OVER () AS n FROM rfm_base),
         (SELECT quantile_cont(Recency, 0.25) AS q1, quantile_cont(Recency, 0.5) AS q2, quantile_cont(Recency, 0.75) AS q3 FROM rfm_base)"""
B["rfm"] = """SELECT *, CAST(R_quartile AS VARCHAR) || CAST(F_quartile AS VARCHAR) || CAST(M_quartile AS VARCHAR) AS RFM_score,
    CASE WHEN R_quartile >= 3 AND F_quartile >= 3 AND M_quartile >= 3 THEN 'Champions' WHEN R_quartile <= 2 AND F_quartile <= 2 THEN 'Hibernating'
         WHEN R_quartile <= 2 THEN 'At risk' WHEN F_quartile >= 3 AND M_quartile >= 3 THEN 'Loyal' ELSE 'Other' END AS Segment FROM rfm_q"""
B["rfm_joined"] = """SELECT r.*, d.AccountID, d.AccountName, d.RegionDescription, d.SectorDescription
    FROM rfm r LEFT JOIN named_dim d USING (CustomerKey)"""
B["rfm_named"] = (
    "SELECT * FROM rfm_joined WHERE AccountName IS NOT NULL AND NOT contains(AccountName, 'CLIENT_') AND NOT contains(AccountName, 'UNKNOWN')"
)
B["typed_header"] = f"SELECT saleid, accountid, sellerid, {_HEADER_CASTS} FROM raw_salesheader"
B["typed_line"] = f"SELECT saleid, itemid, {_LINE_CASTS} FROM raw_salesline"
B["typed_invoice"] = f"""SELECT invoiceid, salesid, {money('paymentamount')} AS paymentamount,
    regexp_replace(paymentmethod, '^0+([0-9])', '\\1') AS paymentmethod FROM raw_invoice"""
B["cutoff"] = f"SELECT {kdate('max(OrderDateKey)')} - 90 AS day FROM fact_sales"
B["churn_label"] = f"""SELECT CustomerKey, CASE WHEN count(*) FILTER ({kdate('OrderDateKey')} > day) = 0 THEN 1 ELSE 0 END AS label
    FROM fact_sales, cutoff GROUP BY CustomerKey HAVING count(*) FILTER ({kdate('OrderDateKey')} <= day) > 0"""
B["clv"] = f"SELECT CustomerKey, {num('sum(LineTotalAmount)')} AS clv_historical FROM fact_sales GROUP BY CustomerKey"
B["clv_tiered"] = f"""SELECT CustomerKey, clv_historical, CASE WHEN clv_historical > high THEN 'High' WHEN clv_historical > low THEN 'Medium' ELSE 'Low' END AS tier
    FROM clv, (SELECT {rnd('quantile_cont(clv_historical, 0.8)', 4)} AS high, {rnd('quantile_cont(clv_historical, 0.5)', 4)} AS low FROM clv)"""
B["basket"] = "SELECT DISTINCT SaleID, ProductKey AS item FROM fact_sales"
B["item_counts"] = "SELECT item, count(*) AS c FROM basket GROUP BY item"
B["pairs"] = """SELECT a.item AS item_a, b.item AS item_b, count(*) AS c FROM basket a JOIN basket b ON a.SaleID = b.SaleID AND a.item < b.item
    GROUP BY ALL HAVING count(*) >= 2"""
B["triples"] = """SELECT a.item AS item_a, b.item AS item_b, c.item AS item_c, count(*) AS c FROM basket a
    JOIN basket b ON a.SaleID = b.SaleID AND a.item < b.item JOIN basket c ON b.SaleID = c.SaleID AND b.item < c.item
    GROUP BY ALL HAVING count(*) >= 2"""
B["quads"] = """SELECT a.item AS item_a, b.item AS item_b, c.item AS item_c, d.item AS item_d, count(*) AS c FROM basket a
    JOIN basket b ON a.SaleID = b.SaleID AND a.item < b.item JOIN basket c ON b.SaleID = c.SaleID AND b.item < c.item
    JOIN basket d ON c.SaleID = d.SaleID AND c.item < d.item GROUP BY ALL HAVING count(*) >= 2"""
B["support"] = "SELECT greatest(2, CAST(ceil(CAST(0.001 AS DOUBLE) * CAST(n AS DOUBLE)) AS BIGINT)) AS least FROM orders_n"
B["orders_n"] = "SELECT count(DISTINCT SaleID) AS n FROM basket"
B["pair_rules"] = f"""SELECT item_a, item_b, p.c AS orders_both, {rnd('CAST(p.c AS DOUBLE) / CAST(n AS DOUBLE)', 8)} AS support,
    {rnd('CAST(p.c AS DOUBLE) / CAST(a.c AS DOUBLE)', 6)} AS confidence_ab, {rnd('CAST(p.c AS DOUBLE) / CAST(b.c AS DOUBLE)', 6)} AS confidence_ba,
    {rnd('CAST(p.c AS DOUBLE) * CAST(n AS DOUBLE) / (CAST(a.c AS DOUBLE) * CAST(b.c AS DOUBLE))', 6)} AS lift
    FROM pairs p JOIN item_counts a ON p.item_a = a.item JOIN item_counts b ON p.item_b = b.item, orders_n"""
_QUAD_RULES = " UNION ALL ".join(
    f"""SELECT q.{x} || ',' || q.{y} || ',' || q.{z}, CAST(q.{out} AS VARCHAR), q.c, t.c, i.c FROM quads q
    JOIN triples t ON t.item_a = q.{x} AND t.item_b = q.{y} AND t.item_c = q.{z} JOIN item_counts i ON i.item = q.{out}"""
    for out, (x, y, z) in {
        "item_d": ("item_a", "item_b", "item_c"),
        "item_c": ("item_a", "item_b", "item_d"),
        "item_b": ("item_a", "item_c", "item_d"),
        "item_a": ("item_b", "item_c", "item_d"),
    }.items()
)
B["rules"] = f"""SELECT * FROM (SELECT ante AS antecedent, cons AS consequent, {rnd('CAST(c AS DOUBLE) / CAST(ca AS DOUBLE)', 6)} AS confidence,
    {rnd('(CAST(c AS DOUBLE) / CAST(ca AS DOUBLE)) / (CAST(cc AS DOUBLE) / CAST(n AS DOUBLE))', 6)} AS lift, {rnd('CAST(c AS DOUBLE) / CAST(n AS DOUBLE)', 8)} AS support,
    CAST(c AS DOUBLE) / CAST(ca AS DOUBLE) AS conf_exact, (CAST(c AS DOUBLE) / CAST(ca AS DOUBLE)) / (CAST(cc AS DOUBLE) / CAST(n AS DOUBLE)) AS lift_exact
    FROM (SELECT CAST(item_a AS VARCHAR) AS ante, CAST(item_b AS VARCHAR) AS cons, p.c AS c, a.c AS ca, b.c AS cc FROM pairs p JOIN item_counts a ON a.item = item_a JOIN item_counts b ON b.item = item_b
      UNION ALL SELECT CAST(item_b AS VARCHAR), CAST(item_a AS VARCHAR), p.c, b.c, a.c FROM pairs p JOIN item_counts a ON a.item = item_a JOIN item_counts b ON b.item = item_b
      UNION ALL SELECT item_a || ',' || item_b, CAST(item_c AS VARCHAR), t.c, p.c, i.c FROM triples t JOIN pairs p USING (item_a, item_b) JOIN item_counts i ON i.item = item_c
      UNION ALL SELECT t.item_a || ',' || t.item_c, CAST(t.item_b AS VARCHAR), t.c, p.c, i.c FROM triples t JOIN pairs p ON p.item_a = t.item_a AND p.item_b = t.item_c JOIN item_counts i ON i.item = t.item_b
      UNION ALL SELECT t.item_b || ',' || t.item_c, CAST(t.item_a AS VARCHAR), t.c, p.c, i.c FROM triples t JOIN pairs p ON p.item_a = t.item_b AND p.item_b = t.item_c JOIN item_counts i ON i.item = t.item_a
      UNION ALL {_QUAD_RULES}), orders_n, support WHERE c >= least)
    WHERE conf_exact >= 0.05 AND lift_exact > 1"""
B["matrix"] = """SELECT CustomerKey, ProductKey, CAST(sum(Quantity) AS BIGINT) AS quantity, count(DISTINCT SaleID) AS orders FROM fact_sales GROUP BY ALL"""


def _cosine(table: str, entity: str, feature: str, weight: str = "orders") -> str:
    return f"""SELECT a.{entity} AS a, b.{entity} AS b, {rnd(f'CAST(sum(a.{weight} * b.{weight}) AS DOUBLE) / sqrt(CAST(max(na.n) AS DOUBLE) * CAST(max(nb.n) AS DOUBLE))', 6)} AS cosine
    FROM {table} a JOIN {table} b ON a.{feature} = b.{feature} AND a.{entity} < b.{entity}
    JOIN (SELECT {entity}, sum({weight} * {weight}) AS n FROM {table} GROUP BY {entity}) na ON na.{entity} = a.{entity}
    JOIN (SELECT {entity}, sum({weight} * {weight}) AS n FROM {table} GROUP BY {entity}) nb ON nb.{entity} = b.{entity} GROUP BY ALL"""


B["profile_of"] = """SELECT CustomerKey, min(CustomerKey) OVER (PARTITION BY v) AS profile, count(*) OVER (PARTITION BY v) AS members
    FROM (SELECT CustomerKey, string_agg(ProductKey || ':' || orders, ',' ORDER BY ProductKey) AS v FROM matrix GROUP BY CustomerKey)"""
B["profile_matrix"] = "SELECT m.* FROM matrix m JOIN profile_of p USING (CustomerKey) WHERE p.profile = m.CustomerKey"
B["profile_cosine"] = f"SELECT * FROM ({_cosine('profile_matrix', 'CustomerKey', 'ProductKey')}) WHERE cosine >= 0.5"
B["tokens"] = """SELECT DISTINCT ProductKey, kind || ':' || word AS token FROM (
    SELECT ProductKey, 'Brand' AS kind, unnest(string_split(lower(coalesce(Brand, '')), ' ')) AS word FROM dim_product
    UNION ALL SELECT ProductKey, 'ProductName', unnest(string_split(lower(coalesce(ProductName, '')), ' ')) FROM dim_product
    UNION ALL SELECT ProductKey, 'NameAlias', unnest(string_split(lower(coalesce(NameAlias, '')), ' ')) FROM dim_product) WHERE word <> ''"""
B["token_weights"] = """SELECT ProductKey, t.token, ln((n + 1.0) / (df + 1.0)) AS w FROM tokens t
    JOIN (SELECT token, CAST(count(*) AS DOUBLE) AS df FROM tokens GROUP BY token) d ON d.token = t.token,
    (SELECT CAST(count(DISTINCT ProductKey) AS DOUBLE) AS n FROM tokens) WHERE ln((n + 1.0) / (df + 1.0)) > 0"""
B["token_profiles"] = """SELECT ProductKey, min(ProductKey) OVER (PARTITION BY v) AS profile, count(*) OVER (PARTITION BY v) AS members
    FROM (SELECT ProductKey, string_agg(token, ' ' ORDER BY token) AS v FROM token_weights GROUP BY ProductKey)"""
B["token_leaders"] = "SELECT w.* FROM token_weights w JOIN token_profiles p USING (ProductKey) WHERE p.profile = w.ProductKey"
B["churn_features"] = f"""SELECT o.CustomerKey, CAST((SELECT day FROM cutoff) - {kdate('o.last')} AS INTEGER) AS recency, o.frequency, {num('o.m')} AS monetary,
    {ratio('o.m', 'o.frequency')} AS avg_order_value,
    coalesce({rnd(f"CAST({kdate('o.last')} - {kdate('o.first')} AS DOUBLE) / NULLIF(CAST(o.frequency - 1 AS DOUBLE), 0)", 4)}, 0.0) AS avg_days_between_orders,
    o.total_products, coalesce(d.RegionDescription, 'Unknown') AS region, coalesce(d.SectorDescription, 'Unknown') AS sector
    FROM (SELECT CustomerKey, max(OrderDateKey) AS last, min(OrderDateKey) AS first, count(DISTINCT SaleID) AS frequency, sum(LineTotalAmount) AS m,
          count(DISTINCT ProductKey) AS total_products FROM fact_sales, cutoff WHERE {kdate('OrderDateKey')} <= day GROUP BY CustomerKey) o
    LEFT JOIN named_dim d ON d.CustomerKey = o.CustomerKey"""

# ---- statements -----------------------------------------------------------------------------

S: dict[str, str] = {}


def raw(entity: str, marks: bool = False) -> str:
    return f"SELECT {', '.join(RAW_COLUMNS[entity])} FROM {RAW[entity]}"


FACT = """SaleID, OrderDateKey, DeliveryDateKey, CustomerKey, SellerKey, ProductKey, PromotionKey, Quantity"""
FACT_AMOUNTS = [
    "UnitPrice", "LineBruteAmount", "LineDiscountAmount", "LineNetAmount", "LineTaxAmount", "LineTotalAmount",
    "HeaderBruteAmount", "HeaderNetAmount", "HeaderTaxAmount", "HeaderTotalAmount",
]
FACT_OUT = FACT + ", " + ", ".join(f"{num(c)} AS {c}" for c in FACT_AMOUNTS)
HEADER_OUT = "saleid, accountid, sellerid, CAST(orderdate AS VARCHAR) AS orderdate, CAST(delivdate AS VARCHAR) AS delivdate, " + ", ".join(
    f"{num(c)} AS {c}" for c in ("bruteamount", "netamount", "taxamount", "totalamount")
)
LINE_OUT = "saleid, itemid, qty, " + ", ".join(
    f"{num(c)} AS {c}" for c in ("unitprice", "httotalamount", "ttctotalamount", "promovalue")
) + ", promotype"
INVOICE_OUT = f"invoiceid, salesid, {num('paymentamount')} AS paymentamount, paymentmethod"
UNMARKED_INVOICE = "invoiceid, salesid, nullif(paymentamount, 'n/a') AS paymentamount, paymentmethod"

# scans, sources, sinks
S["scan_csv"] = raw("Customer")
S["scan_csv_encoding"] = """SELECT accountid, sectorid || ' – "Hôtel"; à 3 € "\\' AS "libellé" FROM raw_customer"""
S["scan_skip_bad_lines"] = """SELECT accountid, sectorid, CASE WHEN CAST(accountid AS BIGINT) % 10 <> 7 THEN regionid END AS regionid
    FROM raw_customer WHERE accountid IS NOT NULL AND CAST(accountid AS BIGINT) % 10 NOT IN (3, 4)"""
S["scan_projected_table"] = f"SELECT SaleID, CustomerKey, ProductKey, Quantity, {num('LineTotalAmount')} AS LineTotalAmount FROM fact_sales"
S["scan_limit_sample"] = f"SELECT SaleID, ProductKey, Quantity, {num('UnitPrice')} AS UnitPrice FROM fact_sales ORDER BY SaleID, ProductKey LIMIT 1000"
S["count_file_lines"] = " UNION ALL ".join(
    f'SELECT \'{n}\' AS "table", count(*) AS lines FROM {RAW[n]}' for n in RAW_COLUMNS
)
_REQUIRED = {"Region": 1, "Sector": 1, "Customer": 1, "Seller": 1, "Product": 1, "SalesHeader": 4, "SalesLine": 3, "Invoice": 2}
S["validate_columns"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS entity, '{c}' AS "column", '{'required' if i < k else 'optional'}' AS declared, 1 AS found, count({c}) AS filled FROM {RAW[n]}"""
    for n, k in _REQUIRED.items()
    for i, c in enumerate(RAW_COLUMNS[n])
)
S["normalize_column_names"] = raw("Product")
S["stage_entity"] = raw("SalesLine")
S["sink_clean_csv"] = "SELECT invoiceid, salesid, CAST(paymentamount AS VARCHAR) AS paymentamount, paymentmethod FROM clean_invoice"
S["sink_rfm_csv"] = """SELECT CAST(CustomerKey AS VARCHAR) AS CustomerKey, CAST(Recency AS VARCHAR) AS Recency, CAST(Frequency AS VARCHAR) AS Frequency,
    CAST(CAST(Monetary AS DECIMAL(18,2)) AS VARCHAR) AS Monetary, RFM_score, Segment FROM rfm"""
S["sink_dim_append"] = "SELECT * FROM dim_product"
S["sink_fact_append"] = f"SELECT OrderDateKey // 100 AS order_month, count(*) AS rows, {num('sum(LineTotalAmount)')} AS amount FROM fact_sales GROUP BY 1"
S["batch_load"] = S["sink_fact_append"]
S["late_members"] = f"""SELECT h.accountid AS AccountID, 'CLIENT_' || h.accountid AS AccountName, CAST(NULL AS VARCHAR) AS RegionDescription, count(*) AS lines,
    {num('sum(f.LineTotalAmount)')} AS amount FROM fact_sales f JOIN ({first_rows('raw_salesheader', ['saleid'])}) h ON f.SaleID = TRY_CAST(h.saleid AS BIGINT)
    WHERE h.accountid NOT IN (SELECT accountid FROM clean_customer) GROUP BY h.accountid"""
S["truncate_reload"] = "SELECT * FROM dim_customer"
S["resume_fact_invoices"] = f"SELECT InvoiceID, SaleID, PaymentDateKey, CustomerKey, PaymentMethodKey, {num('PaymentAmount')} AS PaymentAmount FROM fact_invoices"
S["read_clean_or_rebuild"] = f"SELECT {INVOICE_OUT} FROM clean_invoice"
STAR = {
    "DimDate": "dim_date", "DimCustomer": "dim_customer", "DimSeller": "dim_seller", "DimProduct": "dim_product",
    "DimPromotion": "dim_promotion", "DimPaymentMethod": "dim_payment", "FactSales": "fact_sales", "FactInvoices": "fact_invoices",
}
S["warehouse_row_counts"] = " UNION ALL ".join(f'SELECT \'{n}\' AS "table", count(*) AS rows FROM {t}' for n, t in STAR.items())

# cleaning
S["drop_null_keys"] = raw("Invoice") + " WHERE invoiceid IS NOT NULL"
S["dedup_keep_first"] = f"SELECT saleid, itemid, qty, httotalamount, _copies AS copies FROM {first_rows('raw_salesline', ['saleid', 'itemid'], LINE_ORDER)}"
S["dedup_subset"] = f"SELECT accountid, saleid, sellerid, _copies AS copies FROM {first_rows('clean_salesheader', ['accountid'])}"
S["business_rules"] = """SELECT saleid, itemid, qty, unitprice, promotype FROM raw_salesline WHERE CAST(qty AS DOUBLE) > 0 AND CAST(unitprice AS DOUBLE) >= 1000
    AND CAST(promovalue AS DOUBLE) < 9 AND promotype IS DISTINCT FROM 'Rebates' AND saleid IS NOT NULL"""
S["cast_decimal_comma"] = f"SELECT saleid, {num(money('totalamount'))} AS totalamount FROM raw_salesheader"
S["cast_integer"] = """SELECT saleid, itemid, CAST(round_even(CAST(qty AS DOUBLE), 0) AS INTEGER) AS qty,
    CAST(round_even(CAST(qty || '.5' AS DOUBLE), 0) AS INTEGER) AS rounded FROM raw_salesline"""
S["cast_date"] = """SELECT saleid, CAST(TRY_CAST(orderdate AS DATE) AS VARCHAR) AS orderdate, CAST(TRY_CAST(delivdate AS DATE) AS VARCHAR) AS delivdate
    FROM raw_salesheader"""
S["trim_truncate"] = f"SELECT accountid, {tidy('accountname', 12)} AS accountname FROM raw_customer"
S["cast_entity"] = f"SELECT {HEADER_OUT} FROM typed_header"
S["null_counts"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS entity, '{c}' AS "column", count(*) - count({c}) AS nulls FROM clean_{n.lower()}"""
    for n in RAW_COLUMNS
    for c in RAW_COLUMNS[n]
)


def _metrics(entity: str, keys: list[str], order: str, flags: str, violations: str, mapped: str, kept: str, rule: str = "TRUE") -> str:
    table = RAW[entity]
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""SELECT '{entity}' AS entity, (SELECT count(*) FROM {table}) AS raw_row_count,
    (SELECT count(*) FROM {table} WHERE NOT ({present})) AS null_key_dropped, (SELECT count(*) FROM {table} WHERE {present}) AS after_null_drop,
    CAST(sum(_copies) - count(*) AS BIGINT) AS duplicates_removed, count(*) AS after_dedup, count(*) FILTER (NOT ({rule})) AS business_rule_violations,
    count(*) FILTER ({rule}) AS after_business_rules, {violations} AS ri_violations, {mapped} AS ri_mapped_to_unknown,
    {kept} AS after_ri_filter, {kept} AS final_row_count FROM (SELECT *{flags} FROM {first_rows(table, keys, order)})"""


def _orphan(column: str, parent: str, key: str) -> str:
    return f"({column} IS NULL OR {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL))"


S["dq_metrics"] = " UNION ALL ".join(
    [_metrics(n, [RAW_COLUMNS[n][0]], "_ord", "", "0", "0", "count(*)") for n in ("Region", "Sector", "Customer", "Seller", "Product")]
    + [
        _metrics(
            "SalesHeader", ["saleid"], "_ord",
            f", {_orphan('accountid', 'clean_customer', 'accountid')} AS o1, {_orphan('sellerid', 'clean_seller', 'sellerid')} AS o2",
            "count(*) FILTER (o1) + count(*) FILTER (o2)", "count(*) FILTER (o1) + count(*) FILTER (o2)", "count(*)",
        ),
        _metrics(
            "SalesLine", ["saleid", "itemid"], LINE_ORDER,
            f", {_orphan('saleid', 'clean_salesheader', 'saleid')} AS o1, {_orphan('itemid', 'clean_product', 'itemid')} AS o2, CAST(qty AS DOUBLE) > 0 AS ok",
            "count(*) FILTER (ok AND o1)", "count(*) FILTER (ok AND NOT o1 AND o2)", "count(*) FILTER (ok AND NOT o1)", "ok",
        ),
        _metrics(
            "Invoice", ["invoiceid"], "_ord", f", {_orphan('salesid', 'clean_salesheader', 'saleid')} AS o1",
            "count(*) FILTER (o1)", "count(*) FILTER (o1)", "count(*)",
        ),
    ]
)
S["ri_map_unknown"] = f"""SELECT saleid, {_mapped('accountid', 'clean_customer', 'accountid')} AS accountid, {_mapped('sellerid', 'clean_seller', 'sellerid')} AS sellerid,
    CAST({_orphan('accountid', 'clean_customer', 'accountid')} AS INTEGER) AS accountid_mapped, CAST({_orphan('sellerid', 'clean_seller', 'sellerid')} AS INTEGER) AS sellerid_mapped
    FROM raw_salesheader"""
S["ri_drop"] = "SELECT saleid, itemid, qty FROM raw_salesline WHERE saleid IN (SELECT saleid FROM clean_salesheader)"
S["unknown_member"] = "SELECT itemid, name, namealias, marque FROM clean_product"
S["clean_dimension"] = " UNION ALL ".join(
    f"SELECT '{n}' AS entity, {RAW_COLUMNS[n][0]} AS key, {RAW_COLUMNS[n][1]} AS label FROM clean_{n.lower()}"
    for n in ("Region", "Sector", "Customer", "Seller", "Product")
)
S["clean_sales_header"] = f"SELECT {HEADER_OUT} FROM clean_salesheader"
S["clean_sales_line"] = f"SELECT {LINE_OUT} FROM clean_salesline"
S["clean_invoice"] = f"SELECT {INVOICE_OUT} FROM clean_invoice"
S["clean_all"] = " UNION ALL ".join(f'SELECT \'{n}\' AS "table", count(*) AS rows FROM clean_{n.lower()}' for n in RAW_COLUMNS)

# dimensions and facts
S["dim_date"] = "SELECT * FROM dim_date"
S["date_key"] = f"SELECT saleid, {dkey('orderdate')} AS order_key, {dkey('delivdate')} AS delivery_key FROM clean_salesheader"
S["date_from_key"] = "SELECT DateKey, FullDate AS day FROM dim_date"
S["dim_customer"] = "SELECT * FROM dim_customer"
S["client_name_fill"] = f"SELECT accountid, {_CLIENT} AS name FROM clean_customer"
S["inferred_customers"] = """SELECT DISTINCT accountid AS AccountID, 'CLIENT_' || accountid AS AccountName, CAST(NULL AS VARCHAR) AS RegionID, CAST(NULL AS VARCHAR) AS RegionDescription,
    CAST(NULL AS VARCHAR) AS SectorID, CAST(NULL AS VARCHAR) AS SectorDescription FROM raw_salesheader WHERE accountid NOT IN (SELECT accountid FROM clean_customer)"""
S["dim_seller"] = "SELECT * FROM dim_seller"
S["dim_product"] = "SELECT * FROM dim_product"
S["dim_promotion"] = "SELECT * FROM dim_promotion"
S["dim_payment_method"] = "SELECT * FROM dim_payment"
S["surrogate_key"] = """SELECT AccountID, CAST(row_number() OVER (ORDER BY late, _ord NULLS FIRST) AS INTEGER) AS CustomerKey
    FROM (SELECT AccountID, _ord, coalesce(TRY_CAST(AccountID AS BIGINT) % 3 <> 0, FALSE) AS late FROM customer_members)"""
S["key_lookup"] = "SELECT h.saleid, h.accountid, c.CustomerKey FROM clean_salesheader h LEFT JOIN dim_customer c ON h.accountid = c.AccountID"
S["fact_sales"] = f"SELECT {FACT_OUT} FROM fact_sales"
S["line_measures"] = f"""SELECT saleid, itemid, promotype, qty AS Quantity, {num('unitprice')} AS UnitPrice, {num('httotalamount')} AS LineBruteAmount,
    {num('promovalue')} AS LineDiscountAmount, {num('httotalamount')} AS LineNetAmount, {num('ttctotalamount - httotalamount')} AS LineTaxAmount,
    {num('ttctotalamount')} AS LineTotalAmount FROM clean_salesline"""
S["fact_invoices"] = S["resume_fact_invoices"]
S["star_build"] = " UNION ALL ".join(
    f'SELECT \'{n}\' AS "table", count(*) AS rows, {num({"FactSales": "sum(LineTotalAmount)", "FactInvoices": "sum(PaymentAmount)"}.get(n, "0"))} AS amount FROM {t}'
    for n, t in STAR.items()
)
S["scd2_merge"] = """WITH m AS (SELECT AccountID, AccountName, RegionID, coalesce(TRY_CAST(AccountID AS BIGINT), -1) AS k FROM customer_members),
    f AS (SELECT * FROM m WHERE k % 5 <> 0), s AS (SELECT AccountID, AccountName, CASE WHEN k % 7 = 0 THEN 'moved' ELSE RegionID END AS RegionID FROM m WHERE k % 11 <> 0),
    j AS (SELECT f.AccountID, f.AccountName, f.RegionID, s.AccountID IS NOT NULL AND (f.AccountName IS DISTINCT FROM s.AccountName OR f.RegionID IS DISTINCT FROM s.RegionID) AS changed
          FROM f LEFT JOIN s USING (AccountID))
    SELECT AccountID, AccountName, RegionID, '2024-01-01' AS ValidFrom, CASE WHEN changed THEN '2024-06-01' END AS ValidTo, CASE WHEN changed THEN 0 ELSE 1 END AS IsCurrent FROM j
    UNION ALL SELECT AccountID, AccountName, RegionID, '2024-06-01', NULL, 1 FROM s WHERE AccountID NOT IN (SELECT AccountID FROM f) OR AccountID IN (SELECT AccountID FROM j WHERE changed)"""
S["scd2_as_of"] = " UNION ALL ".join(
    f"""SELECT '{dim}' AS dim, CASE WHEN moved THEN 'moved' ELSE label END AS label, CASE WHEN moved THEN '1995-06-17' ELSE '0001-01-01' END AS ValidFrom,
    count(*) AS lines, {num('sum(LineTotalAmount)')} AS amount FROM (SELECT d.{label} AS label, f.LineTotalAmount, d.{key} % 7 = 0 AND f.OrderDateKey >= 19950617 AS moved
    FROM fact_sales f JOIN {table} d ON f.{key} = d.{key}) GROUP BY ALL"""
    for dim, table, key, label in (
        ("DimCustomer", "dim_customer", "CustomerKey", "RegionID"),
        ("DimSeller", "dim_seller", "SellerKey", "SellerName"),
        ("DimProduct", "dim_product", "ProductKey", "Brand"),
    )
)
S["dim_customer_enrich"] = f"""SELECT d.*, r.Segment, r.Recency AS RFM_Recency, r.Frequency AS RFM_Frequency, {num('r.Monetary')} AS RFM_Monetary, {num('l.label')} AS ChurnRisk,
    v.clv_historical AS CLV_Historical, n.after AS CLV_Predicted FROM dim_customer d LEFT JOIN rfm r USING (CustomerKey)
    LEFT JOIN churn_label l USING (CustomerKey) LEFT JOIN clv v USING (CustomerKey) LEFT JOIN (SELECT CustomerKey, {num('sum(LineTotalAmount)')} AS after
    FROM fact_sales, cutoff WHERE {kdate('OrderDateKey')} > day GROUP BY CustomerKey) n USING (CustomerKey)"""

# profiling and quality
_D = "decimal(18,2)"
COLUMN_TYPES = {
    "DimCustomer": [("CustomerKey", "int")] + [(c, "string") for c in ("AccountID", "AccountName", "RegionID", "RegionDescription", "SectorID", "SectorDescription")],
    "DimProduct": [("ProductKey", "int")] + [(c, "string") for c in ("ItemID", "ProductName", "NameAlias", "Brand")],
    "DimSeller": [("SellerKey", "int"), ("SellerID", "string"), ("SellerName", "string")],
    "DimPromotion": [("PromotionKey", "int"), ("PromoType", "string")],
    "DimPaymentMethod": [("PaymentMethodKey", "int"), ("PaymentMethodCode", "string"), ("PaymentMethodDescription", "string")],
    "DimDate": [("DateKey", "int"), ("FullDate", "date")] + [(c, "int") for c in ("Year", "Quarter", "Month", "Day", "DayOfWeek")]
    + [("DayName", "string"), ("MonthName", "string"), ("IsWeekend", "int")],
    "FactSales": [("SalesKey", "bigint"), ("SaleID", "bigint")] + [(c, "int") for c in FACT.split(", ")[1:]] + [(c, _D) for c in FACT_AMOUNTS],
    "FactInvoices": [("InvoiceKey", "bigint"), ("InvoiceID", "string"), ("SaleID", "bigint"), ("PaymentDateKey", "int"), ("CustomerKey", "int"), ("PaymentMethodKey", "int"), ("PaymentAmount", _D)],
}


def _nulls(c: str) -> str:
    """Nulls of a column; row keys are given on writing and exist only in the stored facts."""
    return "count(*) - count(*)" if c in ("SalesKey", "InvoiceKey") else f"count(*) - count({c})"


S["profile_columns"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", '{k}' AS type, {_nulls(c)} AS nulls,
    {share(_nulls(c), 'count(*)', 1)} AS null_pct FROM {STAR[t]}"""
    for t, cs in COLUMN_TYPES.items()
    for c, k in cs
)
S["profile_sample"] = f"SELECT {FACT_OUT} FROM fact_sales ORDER BY fact_sales.SaleID, fact_sales.ProductKey LIMIT 5"


def _describe(table: str, c: str) -> str:
    x = num(c)
    q = lambda p: rnd(f"quantile_cont({x}, {p})")
    return f"""SELECT '{c}' AS "column", count({c}) AS count, {rnd(f'avg({x})')} AS mean, {rnd(f'stddev_samp({x})')} AS std, {rnd(f'min({x})')} AS min,
    {rnd(f'max({x})')} AS max, {q(0.25)} AS p25, {q(0.5)} AS p50, {q(0.75)} AS p75 FROM {table}"""


S["describe_numeric"] = " UNION ALL ".join(
    _describe("fact_sales", c) for c in ("Quantity", *FACT_AMOUNTS)
)
S["describe_tables"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", * FROM ({_describe(table, c)})"""
    for name, table, cs in (
        ("SalesHeader", "typed_header", ["bruteamount", "netamount", "taxamount", "totalamount"]),
        ("SalesLine", "typed_line", ["qty", "unitprice", "httotalamount", "ttctotalamount", "promovalue"]),
        ("Invoice", "typed_invoice", ["paymentamount"]),
        ("rfm", "rfm", ["Recency", "Frequency", "Monetary"]),
    )
    for c in cs
)


def _shown(columns: list[str]) -> str:
    return "concat_ws(' | ', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns) + ")"


_SAMPLE_ORDER = {"FactSales": "SaleID, ProductKey, Quantity, LineTotalAmount", "FactInvoices": "SaleID, InvoiceID"}
S["profile_samples"] = " UNION ALL ".join(
    f"""(SELECT '{t}' AS "table", {_shown([c for c, _ in cs if c not in ('SalesKey', 'InvoiceKey')])} AS "row" FROM {STAR[t]}
    ORDER BY {_SAMPLE_ORDER.get(t, cs[0][0])} LIMIT 5)"""
    for t, cs in COLUMN_TYPES.items()
)
S["duplicate_row_list"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", {_shown(cs)} AS "row", count(*) AS copies FROM {RAW[n]} GROUP BY {', '.join(cs)} HAVING count(*) > 1"""
    for n, cs in RAW_COLUMNS.items()
)
S["distinct_key_counts"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count(DISTINCT {c}) AS "distinct" FROM {STAR[t]}"""
    for t, cs in {"FactSales": ["SaleID", "CustomerKey", "SellerKey", "ProductKey"], "FactInvoices": ["InvoiceID", "CustomerKey", "SaleID"]}.items()
    for c in cs
)
S["missing_summary"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", '{c}' AS "column", count(*) - count({c}) AS missing, {share(f'count(*) - count({c})', 'count(*)')} AS missing_pct, count(*) AS total_rows FROM {RAW[n]}"""
    for n, cs in RAW_COLUMNS.items()
    for c in cs
) + ") WHERE missing > 0"
S["unique_counts"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", '{c}' AS "column", count(DISTINCT {c}) AS unique_values FROM {RAW[n]}"""
    for n in RAW_COLUMNS
    for c in RAW_COLUMNS[n]
)
S["duplicate_rows"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", coalesce(sum(copies), 0) AS rows, count(*) AS kinds FROM
    (SELECT count(*) AS copies FROM {RAW[n]} GROUP BY {', '.join(cs)} HAVING count(*) > 1)"""
    for n, cs in RAW_COLUMNS.items()
)
S["duplicate_keys"] = f"""SELECT {', '.join(RAW_COLUMNS['SalesHeader'])}, copies FROM raw_salesheader JOIN (SELECT saleid, count(*) AS copies FROM raw_salesheader
    WHERE saleid IS NOT NULL GROUP BY saleid HAVING count(*) > 1) USING (saleid) ORDER BY saleid, _ord LIMIT 20"""
S["whitespace_check"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", '{c}' AS "column", count(*) FILTER ({c} <> {strip(c)}) AS padded FROM {RAW[n]}"""
    for n in RAW_COLUMNS
    for c in RAW_COLUMNS[n]
)
_AMOUNTS = {
    "SalesHeader": ["bruteamount", "netamount", "taxamount", "totalamount"],
    "SalesLine": ["unitprice", "httotalamount", "ttctotalamount", "promovalue"],
    "Invoice": ["paymentamount"],
}
_TYPED = {"SalesHeader": "typed_header", "SalesLine": "typed_line", "Invoice": "typed_invoice"}
S["negative_check"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", '{c}' AS "column", count(*) FILTER ({c} < 0) AS negatives FROM {_TYPED[n]}""" for n, cs in _AMOUNTS.items() for c in cs
)
S["invalid_dates"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (TRY_CAST({c} AS DATE) IS NULL) AS invalid, count(*) AS rows FROM raw_salesheader""" for c in ("orderdate", "delivdate")
)
S["delivery_before_order"] = "SELECT count(*) FILTER (delivdate < orderdate) AS early_rows, count(*) AS rows FROM typed_header"
S["date_range"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS VARCHAR) AS first, CAST(max({c}) AS VARCHAR) AS last FROM {t}"""
    for c, t in {"orderdate": "typed_header", "delivdate": "typed_header", "OrderDateKey": "fact_sales", "PaymentDateKey": "fact_invoices"}.items()
)
_RELATIONS = [
    ("Customer", "regionid", "Region", "regionid"), ("Customer", "sectorid", "Sector", "sectorid"), ("SalesHeader", "accountid", "Customer", "accountid"),
    ("SalesHeader", "sellerid", "Seller", "sellerid"), ("SalesLine", "itemid", "Product", "itemid"), ("Invoice", "salesid", "SalesHeader", "saleid"),
]
S["fk_orphans"] = " UNION ALL ".join(
    f"""SELECT '{a}.{k}' AS relation, count(*) AS orphan_keys, coalesce(string_agg({k}, ',' ORDER BY {k}) FILTER (i <= 10), '') AS examples FROM
    (SELECT {k}, row_number() OVER (ORDER BY {k}) AS i FROM (SELECT DISTINCT {k} FROM {RAW[a]} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {p} FROM {RAW[b]} WHERE {p} IS NOT NULL)))"""
    for a, k, b, p in _RELATIONS
)
_SUBSETS = [
    ("FactSales.CustomerKey", "fact_sales", "CustomerKey", "dim_customer", "CustomerKey"), ("FactInvoices.CustomerKey", "fact_invoices", "CustomerKey", "dim_customer", "CustomerKey"),
    ("FactSales.ProductKey", "fact_sales", "ProductKey", "dim_product", "ProductKey"), ("FactSales.SellerKey", "fact_sales", "SellerKey", "dim_seller", "SellerKey"),
    ("FactSales.PromotionKey", "fact_sales", "PromotionKey", "dim_promotion", "PromotionKey"), ("FactInvoices.PaymentMethodKey", "fact_invoices", "PaymentMethodKey", "dim_payment", "PaymentMethodKey"),
    ("FactSales.OrderDateKey", "fact_sales", "OrderDateKey", "dim_date", "DateKey"), ("FactSales.DeliveryDateKey", "fact_sales", "DeliveryDateKey", "dim_date", "DateKey"),
    ("FactSales.CustomerKey (named)", "fact_sales", "CustomerKey", "named_dim", "CustomerKey"),
]
S["fk_subset"] = " UNION ALL ".join(
    f"SELECT '{n}' AS relation, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS is_subset FROM {f} WHERE {k} NOT IN (SELECT {p} FROM {d})" for n, f, k, d, p in _SUBSETS
)
S["key_overlap"] = """SELECT min(f) AS fact_min, max(f) AS fact_max, min(d) AS dim_min, max(d) AS dim_max, count(f) AS fact_keys, count(d) AS dim_keys,
    count(*) FILTER (f IS NOT NULL AND d IS NOT NULL) AS common_keys, count(*) FILTER (d IS NULL) AS orphan_keys
    FROM (SELECT DISTINCT CustomerKey AS f FROM fact_sales) FULL JOIN (SELECT CustomerKey AS d FROM named_dim) ON f = d"""
_COUNTS = " UNION ALL ".join(f'SELECT \'{n}\' AS "table", count(*) AS rows FROM {t}' for n, t in RAW.items())
S["table_row_counts"] = f"{_COUNTS} UNION ALL SELECT 'TOTAL', CAST(sum(rows) AS BIGINT) FROM ({_COUNTS})"
S["anonymous_names_top"] = "SELECT AccountName FROM dim_customer WHERE AccountName LIKE 'CLIENT_%' ORDER BY AccountName LIMIT 20"
S["anonymous_names_count"] = """SELECT count(*) FILTER (AccountName LIKE 'CLIENT_%') AS by_pattern, count(*) FILTER (left(AccountName, 7) = 'CLIENT_') AS by_prefix FROM dim_customer"""

# sales
_REV = "sum(LineTotalAmount)"
S["customers_by_region_top"] = "SELECT regionid, count(*) AS customers FROM raw_customer WHERE regionid IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"
S["customers_by_sector_top"] = "SELECT sectorid, count(*) AS customers FROM raw_customer WHERE sectorid IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
S["products_by_brand_top"] = """SELECT marque, count(*) AS products, (SELECT count(DISTINCT marque) FROM raw_product) AS all_brands FROM raw_product WHERE marque IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""
_SPINE = "(SELECT CAST(unnest(generate_series(date_trunc('month', min(orderdate)), date_trunc('month', max(orderdate)), INTERVAL 1 MONTH)) AS DATE) AS m FROM typed_header)"
S["monthly_orders"] = f"""SELECT strftime(m, '%Y-%m') AS month, count(saleid_or_row) AS orders FROM {_SPINE} LEFT JOIN (SELECT 1 AS saleid_or_row, CAST(date_trunc('month', orderdate) AS DATE) AS m FROM typed_header
    WHERE orderdate IS NOT NULL) USING (m) GROUP BY m"""
S["monthly_header_revenue"] = f"""SELECT strftime(m, '%Y-%m') AS month, {num('coalesce(sum(totalamount), 0)')} AS revenue FROM {_SPINE}
    LEFT JOIN (SELECT totalamount, CAST(date_trunc('month', orderdate) AS DATE) AS m FROM typed_header WHERE orderdate IS NOT NULL) USING (m) GROUP BY m"""
S["orders_by_weekday"] = """SELECT CAST(d AS INTEGER) AS day_of_week, dayname(DATE '2023-12-31' + CAST(d AS INTEGER)) AS day_name, count(o) AS orders FROM range(1, 8) t(d)
    LEFT JOIN (SELECT isodow(orderdate) AS d, 1 AS o FROM typed_header WHERE orderdate IS NOT NULL) USING (d) GROUP BY d"""
S["top_sellers"] = f"""SELECT t.sellerid, s.sellername, num_orders, {num('r')} AS total_revenue, avg_order_value FROM (SELECT sellerid, count(saleid) AS num_orders, sum(totalamount) AS r,
    {ratio('sum(totalamount)', 'count(totalamount)')} AS avg_order_value FROM typed_header WHERE sellerid IS NOT NULL GROUP BY sellerid ORDER BY r DESC, sellerid LIMIT 15) t
    LEFT JOIN clean_seller s ON s.sellerid = t.sellerid"""
for _kind in ("Region", "Sector"):
    S[f"sales_by_{_kind.lower()}"] = f"""SELECT {_kind}Description, {num(_REV)} AS revenue, count(DISTINCT SaleID) AS orders FROM fact_sales
    JOIN named_dim USING (CustomerKey) WHERE {_kind}Description IS NOT NULL GROUP BY 1"""
S["monthly_sales"] = f"SELECT OrderDateKey // 100 AS year_month, {num(_REV)} AS revenue, count(DISTINCT SaleID) AS orders, count(*) AS lines FROM fact_sales GROUP BY 1"
S["monthly_peaks"] = f"""SELECT m AS year_month, {num('r')} AS revenue, (SELECT {ratio('sum(r)', 'count(*)')} FROM (SELECT {_REV} AS r FROM fact_sales GROUP BY OrderDateKey // 100)) AS avg_month_revenue
    FROM (SELECT OrderDateKey // 100 AS m, {_REV} AS r FROM fact_sales GROUP BY 1) ORDER BY r DESC, m LIMIT 3"""
for _by, _name in (("r", "top_products_revenue"), ("qty", "top_products_qty")):
    S[_name] = f"""SELECT ItemID, ProductName, CASE WHEN length(ProductName) > 32 THEN substr(ProductName, 1, 32) || '…' ELSE ProductName END AS label, {num('r')} AS revenue, qty
    FROM (SELECT ItemID, ProductName, {_REV} AS r, CAST(sum(Quantity) AS BIGINT) AS qty FROM fact_sales JOIN dim_product USING (ProductKey) GROUP BY ALL) WHERE ProductName IS NOT NULL ORDER BY {_by} DESC, ItemID LIMIT 15"""
S["top_items_qty_raw"] = """SELECT t.itemid, t.qty, p.name, p.marque FROM (SELECT itemid, CAST(sum(qty) AS BIGINT) AS qty FROM typed_line GROUP BY itemid ORDER BY 2 DESC, 1 LIMIT 15) t LEFT JOIN clean_product p ON p.itemid = t.itemid"""
S["short_name"] = "SELECT ItemID, CASE WHEN length(ProductName) > 8 THEN substr(ProductName, 1, 8) || '…' ELSE ProductName END AS label FROM dim_product"
S["top_brands"] = f"""SELECT Brand, {num('r')} AS revenue FROM (SELECT Brand, {_REV} AS r FROM fact_sales JOIN dim_product USING (ProductKey)
    WHERE Brand IS NOT NULL AND Brand NOT IN ('', 'Unknown', 'nan') GROUP BY Brand) ORDER BY r DESC, Brand LIMIT 10"""
S["promo_revenue"] = f"""SELECT PromoType, {num('r')} AS revenue, {share('r', 'sum(r) OVER ()')} AS revenue_pct FROM (SELECT PromoType, {_REV} AS r FROM fact_sales JOIN dim_promotion USING (PromotionKey) GROUP BY 1)"""
S["promo_mix"] = f"""SELECT promotype, count(*) AS lines, {share('count(*)', '(SELECT count(*) FROM typed_line)')} AS lines_pct, {ratio('sum(promovalue)', 'count(promovalue)')} AS avg_promo_value
    FROM typed_line WHERE promotype IS NOT NULL GROUP BY promotype"""
S["zero_price_lines"] = f"""SELECT promotype, count(*) AS zero_lines, {share('(SELECT count(*) FROM typed_line WHERE unitprice = 0)', '(SELECT count(*) FROM typed_line)')} AS zero_pct_of_all
    FROM typed_line WHERE unitprice = 0 GROUP BY promotype"""
S["delivery_delay_stats"] = f"""SELECT count(*) AS rows, {ratio('sum(d)', 'count(*)')} AS mean_days, quantile_cont(d, 0.5) AS median_days, {share('count(*) FILTER (d = 0)', 'count(*)')} AS same_day_pct,
    {share('count(*) FILTER (d <= 3)', 'count(*)')} AS within_3_pct FROM (SELECT {kdate('DeliveryDateKey')} - {kdate('OrderDateKey')} AS d FROM fact_sales) WHERE d BETWEEN 0 AND 30"""
S["delivery_days_header"] = """WITH h AS (SELECT delivdate - orderdate AS d FROM typed_header WHERE delivdate - orderdate BETWEEN 0 AND 30)
    SELECT d AS days, count(*) AS orders, (SELECT quantile_cont(d, 0.5) FROM h) AS median_days FROM h GROUP BY d"""
S["payment_by_method"] = f"SELECT PaymentMethodCode, {num('sum(PaymentAmount)')} AS amount FROM fact_invoices JOIN dim_payment USING (PaymentMethodKey) GROUP BY 1"
S["payment_mix"] = f"""SELECT CASE paymentmethod WHEN '1' THEN '001 - Cash' WHEN '102' THEN '102 - Cheque' WHEN '205' THEN '205 - Transfer' ELSE paymentmethod END AS method, count(*) AS invoices,
    {share('count(*)', '(SELECT count(*) FROM typed_invoice)')} AS invoices_pct, {ratio('sum(paymentamount)', 'count(paymentamount)')} AS avg_amount FROM typed_invoice WHERE paymentmethod IS NOT NULL GROUP BY paymentmethod"""
_Y, _QT, _M = (f"{f}({kdate('OrderDateKey')})" for f in ("year", "quarter", "month"))
S["sales_by_quarter"] = f"SELECT {_Y} AS year, {_QT} AS quarter, {num(_REV)} AS revenue, count(DISTINCT SaleID) AS orders FROM fact_sales GROUP BY 1, 2"
S["sales_by_year"] = f"SELECT {_Y} AS year, {num(_REV)} AS revenue, count(DISTINCT SaleID) AS orders FROM fact_sales GROUP BY 1"
S["sales_rollup"] = f"""SELECT coalesce(y, -1) AS year, coalesce(q, -1) AS quarter, coalesce(m, -1) AS month, {num('sum(a)')} AS revenue, count(*) AS lines
    FROM (SELECT {_Y} AS y, {_QT} AS q, {_M} AS m, LineTotalAmount AS a FROM fact_sales) GROUP BY ROLLUP (y, q, m)"""
S["sales_growth"] = f"""WITH long AS (SELECT 'region' AS kind, RegionDescription AS member, {_Y} * 10 + {_QT} AS period, {_REV} AS r FROM fact_sales JOIN named_dim USING (CustomerKey) GROUP BY ALL
    UNION ALL SELECT 'sector', SectorDescription, {_Y} * 10 + {_QT}, {_REV} FROM fact_sales JOIN named_dim USING (CustomerKey) GROUP BY ALL),
    w AS (SELECT *, lag(r) OVER (PARTITION BY kind, member ORDER BY period) AS p FROM long WHERE member IS NOT NULL)
    SELECT kind, member, period, {num('r')} AS revenue, {num('coalesce(p, 0)')} AS previous, coalesce({share('r - p', 'p')}, 0.0) AS growth_pct FROM w"""
_MEASURES = ("revenue", "orders", "avg_order_value")
S["seller_rank_outliers"] = f"""WITH t AS (SELECT SellerKey, {num('r')} AS revenue, orders, {ratio('r', 'orders')} AS avg_order_value FROM
    (SELECT SellerKey, {_REV} AS r, count(DISTINCT SaleID) AS orders FROM fact_sales GROUP BY SellerKey)),
    q AS (SELECT {', '.join(f"quantile_cont({num(m)}, 0.25) AS {m}_q1, quantile_cont({num(m)}, 0.75) AS {m}_q3" for m in _MEASURES)} FROM t)
    SELECT t.*, {', '.join(f'rank() OVER (ORDER BY {m} DESC) AS {m}_rank' for m in _MEASURES)},
    {', '.join(f'CASE WHEN {m} < {m}_q1 - ({m}_q3 - {m}_q1) * 1.5 OR {m} > {m}_q3 + ({m}_q3 - {m}_q1) * 1.5 THEN 1 ELSE 0 END AS {m}_outlier' for m in _MEASURES)},
    SellerID, SellerName FROM t LEFT JOIN dim_seller USING (SellerKey), q"""
_PLAIN = "PromoType = 'No Promotion'"
S["promo_vs_no_promo"] = f"""SELECT ItemID, count(*) FILTER (NOT {_PLAIN}) AS lines_promo, count(*) FILTER ({_PLAIN}) AS lines_plain, CAST(coalesce(sum(Quantity) FILTER (NOT {_PLAIN}), 0) AS BIGINT) AS qty_promo,
    CAST(coalesce(sum(Quantity) FILTER ({_PLAIN}), 0) AS BIGINT) AS qty_plain, {num(f'coalesce(sum(LineTotalAmount) FILTER (NOT {_PLAIN}), 0)')} AS revenue_promo, {num(f'coalesce(sum(LineTotalAmount) FILTER ({_PLAIN}), 0)')} AS revenue_plain
    FROM fact_sales JOIN dim_promotion USING (PromotionKey) JOIN dim_product USING (ProductKey) GROUP BY ItemID"""
S["promo_response_by_segment"] = f"""SELECT Segment, PromoType, lines, {share('lines', 'sum(lines) OVER (PARTITION BY Segment)')} AS lines_pct, {num('r')} AS revenue, {share('r', 'sum(r) OVER (PARTITION BY Segment)')} AS revenue_pct
    FROM (SELECT Segment, PromoType, count(*) AS lines, {_REV} AS r FROM fact_sales JOIN rfm USING (CustomerKey) JOIN dim_promotion USING (PromotionKey) GROUP BY ALL)"""
S["promo_roi"] = f"""WITH k AS (SELECT ProductKey, PromoType, sum(Quantity) AS q, {_REV} AS r, sum(LineDiscountAmount) AS c FROM fact_sales JOIN dim_promotion USING (PromotionKey) GROUP BY ALL),
    p AS (SELECT ProductKey, CAST({rnd('CAST(r AS DOUBLE) / NULLIF(CAST(q AS DOUBLE), 0)', 4)} AS DECIMAL(18,4)) AS p FROM k WHERE {_PLAIN}),
    s AS (SELECT PromoType, sum(r) AS r, sum(CAST(q AS DECIMAL(18,0)) * p) AS e, sum(c) AS c FROM k JOIN p USING (ProductKey) WHERE NOT {_PLAIN} AND p IS NOT NULL GROUP BY PromoType)
    SELECT PromoType, {num('r')} AS revenue, {rnd('e')} AS expected_revenue, {rnd(f"{num('r')} - {num('e')}")} AS incremental_revenue, {num('c')} AS promo_cost,
    {rnd(f"({num('r')} - {num('e')} - {num('c')}) / NULLIF({num('c')}, 0)")} AS roi FROM s"""
S["payment_trend"] = f"""SELECT m AS year_month, PaymentMethodCode, n AS invoices, {num('a')} AS amount, {share('a', 'sum(a) OVER (PARTITION BY m)')} AS amount_pct
    FROM (SELECT PaymentDateKey // 100 AS m, PaymentMethodCode, count(*) AS n, sum(PaymentAmount) AS a FROM fact_invoices JOIN dim_payment USING (PaymentMethodKey) GROUP BY ALL)"""
_PAID = f"{num('coalesce(p, 0)')} / NULLIF({num('s')}, 0)"
S["customer_payment_balance"] = f"""SELECT CustomerKey, {num('s')} AS sales_total, {num('coalesce(p, 0)')} AS invoiced_total, {num('s - coalesce(p, 0)')} AS balance, {rnd(_PAID, 4)} AS paid_ratio,
    {rnd(f'greatest(0.0, 1.0 - {_PAID})', 4)} AS risk_score FROM (SELECT CustomerKey, {_REV} AS s FROM fact_sales GROUP BY 1) LEFT JOIN (SELECT CustomerKey, sum(PaymentAmount) AS p FROM fact_invoices GROUP BY 1) USING (CustomerKey)"""
S["kpi_overview"] = f"""SELECT {num(_REV)} AS total_revenue, count(DISTINCT CustomerKey) AS customers, count(DISTINCT SaleID) AS orders, count(*) AS lines, {ratio(_REV, 'count(DISTINCT SaleID)')} AS avg_basket FROM fact_sales"""
S["retention_new_returning"] = f"""SELECT ym AS year_month, count(*) AS active, count(*) FILTER (ym = f) AS new_customers, count(*) FILTER (ym <> f) AS returning_customers, {share('count(*) FILTER (ym <> f)', 'count(*)')} AS repeat_rate_pct
    FROM (SELECT ym, min(ym) OVER (PARTITION BY CustomerKey) AS f FROM (SELECT DISTINCT CustomerKey, OrderDateKey // 100 AS ym FROM fact_sales)) GROUP BY ym"""
S["loyal_customers"] = f"""WITH a AS (SELECT DISTINCT CustomerKey, OrderDateKey // 10000 * 12 + OrderDateKey // 100 % 100 AS i FROM fact_sales),
    e AS (SELECT {kdate('max(OrderDateKey)')} AS d FROM fact_sales), l AS (SELECT CASE WHEN d = last_day(d) THEN year(d) * 12 + month(d) ELSE year(d) * 12 + month(d) - 1 END AS last FROM e)
    SELECT CustomerKey, count(*) AS months_active FROM a, l WHERE i > last - 2 AND i <= last GROUP BY 1 HAVING count(*) = 2"""

# RFM and distributions
_M3 = {"recency": "Recency", "frequency": "Frequency", "log_monetary": "ln(1 + CAST(Monetary AS DOUBLE))"}
S["rfm_base"] = f"SELECT CustomerKey, Recency, Frequency, {num('Monetary')} AS Monetary FROM rfm_base"
S["rfm_quartiles"] = f"SELECT CustomerKey, Recency, Frequency, {num('Monetary')} AS Monetary, R_quartile, F_quartile, M_quartile FROM rfm_q"
S["rfm_score"] = "SELECT CustomerKey, RFM_score FROM rfm"
S["rfm_segment"] = f"SELECT CustomerKey, Recency, Frequency, {num('Monetary')} AS Monetary, R_quartile, F_quartile, M_quartile, RFM_score, Segment FROM rfm"
S["segment_counts"] = "SELECT Segment, count(*) AS customers FROM rfm GROUP BY 1"
_MEANS = ", ".join(f"{ratio(f'sum({c})', 'count(*)')} AS avg_{c.lower()}" for c in ("Recency", "Frequency", "Monetary"))
S["segment_means"] = f"SELECT Segment, {_MEANS} FROM rfm GROUP BY 1"
S["segment_revenue_share"] = f"SELECT Segment, {num('s')} AS revenue, {share('s', 'sum(s) OVER ()')} AS revenue_pct FROM (SELECT Segment, sum(Monetary) AS s FROM rfm GROUP BY 1)"
S["segment_profile_named"] = f"SELECT Segment, {_MEANS}, count(*) AS customers FROM rfm_named GROUP BY 1"
S["rfm_customer_join"] = f"SELECT CustomerKey, Recency, Frequency, {num('Monetary')} AS Monetary, Segment, AccountID, AccountName, RegionDescription, SectorDescription FROM rfm_joined"
S["named_customers"] = "SELECT CustomerKey, AccountName, Segment FROM rfm_named"
for _c in ("Frequency", "Monetary"):
    S[f"top_customers_{_c.lower()}"] = f"SELECT CustomerKey, AccountName, {num(_c)} AS {_c.lower()} FROM rfm_named ORDER BY rfm_named.{_c} DESC, CustomerKey LIMIT 10"
_SEG = {"At risk": "at_risk", "Champions": "champions", "Hibernating": "hibernating", "Loyal": "loyal", "Other": "other"}
S["region_segment_pivot"] = f"""SELECT RegionDescription, {', '.join(f"count(*) FILTER (Segment = '{s}') AS {n}" for s, n in _SEG.items())}, count(*) AS customers FROM rfm_joined
    WHERE RegionDescription IS NOT NULL GROUP BY 1 ORDER BY customers DESC, RegionDescription LIMIT 15"""
_MS = ["Recency", "Frequency", "Monetary"]
S["rfm_correlation"] = " UNION ALL ".join(
    f"SELECT '{a}' AS measure, " + ", ".join("1.0" + f" AS {b.lower()}" if a == b else f"{rnd(f'corr({num(a)}, {num(b)})', 4)} AS {b.lower()}" for b in _MS) + " FROM rfm" for a in _MS
)
S["clip_p99"] = f"SELECT CustomerKey, {rnd('least(CAST(Recency AS DOUBLE), (SELECT quantile_cont(CAST(Recency AS DOUBLE), 0.99) FROM rfm))', 4)} AS clipped FROM rfm"
S["filter_p99"] = f"""SELECT saleid, {num('totalamount')} AS totalamount FROM typed_header WHERE {num('totalamount')} <= (SELECT quantile_cont({num('totalamount')}, 0.99) FROM typed_header)"""
S["filter_p95"] = f"""SELECT saleid, itemid, {num('unitprice')} AS unitprice FROM typed_line WHERE unitprice > 0 AND {num('unitprice')} <= (SELECT quantile_cont({num('unitprice')}, 0.95) FROM typed_line WHERE unitprice > 0)"""
S["log1p"] = f"SELECT CustomerKey, {rnd(_M3['log_monetary'], 6)} AS log_monetary FROM rfm"


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""WITH v AS (SELECT CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL), s AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
    c AS (SELECT CAST(least(floor((v - lo) * {bins}.0::DOUBLE / (hi - lo)) + 1, {bins}) AS INTEGER) AS bin, count(*) AS n FROM v, s GROUP BY 1)
    SELECT CAST(b AS INTEGER) AS bin, {rnd(f'lo + (b - 1) * ((hi - lo) / {bins}.0::DOUBLE)', 4)} AS lower, {rnd(f'lo + b * ((hi - lo) / {bins}.0::DOUBLE)', 4)} AS upper, coalesce(n, 0) AS rows
    FROM range(1, {bins + 1}) t(b) LEFT JOIN c ON c.bin = b, s"""


S["histogram"] = _histogram("rfm", "Recency", 50)
S["histogram_payment"] = _histogram(
    f"(SELECT paymentamount FROM typed_invoice WHERE {num('paymentamount')} <= (SELECT quantile_cont({num('paymentamount')}, 0.99) FROM typed_invoice))", "paymentamount", 80
)
S["skewness"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS measure, {rnd('avg((x - m) ** 3) / (avg((x - m) ** 2) ** 1.5)', 4)} AS skewness FROM (SELECT CAST({e} AS DOUBLE) AS x FROM rfm), (SELECT avg(CAST({e} AS DOUBLE)) AS m FROM rfm)"""
    for n, e in _M3.items()
)
S["median_marker"] = " UNION ALL ".join(f"SELECT '{n}' AS measure, {rnd(f'quantile_cont(CAST({e} AS DOUBLE), 0.5)', 4)} AS median FROM rfm" for n, e in _M3.items())
S["boxplot_stats"] = f"""WITH v AS (SELECT Segment, {_M3['log_monetary']} AS v FROM rfm), q AS (SELECT Segment, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1),
    i AS (SELECT *, v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM v JOIN q USING (Segment))
    SELECT Segment, count(*) AS rows, {rnd('max(q1)', 4)} AS q1, {rnd('max(q2)', 4)} AS q2, {rnd('max(q3)', 4)} AS q3, {rnd('min(v) FILTER (inside)', 4)} AS whisker_low,
    {rnd('max(v) FILTER (inside)', 4)} AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM i GROUP BY 1"""
_CURVE = f"""SELECT CustomerKey, row_number() OVER w AS rank, {rnd('CAST(row_number() OVER w AS DOUBLE) * 100.0 / CAST(count(*) OVER () AS DOUBLE)', 6)} AS cum_pct_customers,
    {rnd('CAST(sum(Monetary) OVER w AS DOUBLE) * 100.0 / CAST(sum(Monetary) OVER () AS DOUBLE)', 6)} AS cum_pct_revenue FROM rfm_named WINDOW w AS (ORDER BY Monetary DESC, CustomerKey)"""
S["pareto_curve"] = _CURVE
S["pareto_80"] = f"SELECT min(cum_pct_customers) AS pct_customers FROM ({_CURVE}) WHERE cum_pct_revenue >= 80"

# models, baskets, recommendations
S["feature_scale"] = "SELECT CustomerKey, " + ", ".join(
    f"{rnd(f'(CAST({e} AS DOUBLE) - avg(CAST({e} AS DOUBLE)) OVER ()) / stddev_samp(CAST({e} AS DOUBLE)) OVER ()', 4)} AS {n}_z" for n, e in _M3.items()
) + " FROM rfm"
S["churn_label"] = "SELECT CustomerKey, label FROM churn_label"
S["churn_features"] = "SELECT * FROM churn_features"
S["stratified_split"] = """SELECT label, CASE WHEN i * 100 <= n * 80 THEN 1 ELSE 0 END AS is_train, count(*) AS customers FROM (SELECT label, count(*) OVER (PARTITION BY label) AS n,
    row_number() OVER (PARTITION BY label ORDER BY CAST('0x' || substr(md5(CAST(CustomerKey AS VARCHAR)), 1, 8) AS BIGINT), CustomerKey) AS i FROM churn_label) GROUP BY 1, 2"""
S["clv_historical"] = "SELECT * FROM clv"
S["clv_summary_table"] = f"""SELECT CustomerKey, count(DISTINCT OrderDateKey) - 1 AS repeat_frequency, {kdate('max(OrderDateKey)')} - {kdate('min(OrderDateKey)')} AS recency_age,
    (SELECT {kdate('max(OrderDateKey)')} FROM fact_sales) - {kdate('min(OrderDateKey)')} AS age, {ratio(_REV, 'count(DISTINCT SaleID)')} AS mean_order_value FROM fact_sales GROUP BY CustomerKey"""
S["clv_tiers"] = "SELECT * FROM clv_tiered"
S["clv_churn_matrix"] = "SELECT tier, count(*) FILTER (label = 1) AS churned, count(*) FILTER (label = 0) AS active FROM clv_tiered JOIN churn_label USING (CustomerKey) GROUP BY 1"
S["clv_by_segment"] = "SELECT Segment, count(*) AS customers, " + ", ".join(
    f"{rnd(f'quantile_cont(clv_historical, {p})')} AS {n}" for n, p in {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}.items()
) + " FROM clv JOIN rfm USING (CustomerKey) GROUP BY 1"
S["basket_items"] = "SELECT SaleID, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items, count(*) AS item_count FROM basket GROUP BY SaleID"
S["frequent_itemsets"] = """SELECT items, length, orders FROM (SELECT CAST(item AS VARCHAR) AS items, 1 AS length, c AS orders FROM item_counts UNION ALL SELECT item_a || ',' || item_b, 2, c FROM pairs
    UNION ALL SELECT item_a || ',' || item_b || ',' || item_c, 3, c FROM triples
    UNION ALL SELECT item_a || ',' || item_b || ',' || item_c || ',' || item_d, 4, c FROM quads), support WHERE orders >= least"""
_RULE = "antecedent, consequent, confidence, lift, support"
S["association_rules"] = f"SELECT {_RULE} FROM rules"
S["association_rules_top"] = f"SELECT {_RULE} FROM rules ORDER BY lift DESC, confidence DESC, antecedent, consequent LIMIT 10"
S["pair_rules"] = "SELECT * FROM pair_rules"
S["bundle_candidates"] = "SELECT item_a, item_b, orders_both, support, lift FROM pair_rules WHERE lift > 50 AND orders_both >= 2"
S["customer_product_matrix"] = "SELECT * FROM matrix"
S["item_cosine"] = f"SELECT a AS item_a, b AS item_b, cosine FROM ({_cosine('matrix', 'ProductKey', 'CustomerKey')}) WHERE cosine >= 0.1"
S["customer_cosine"] = """SELECT a AS profile_a, b AS profile_b, cosine, x.members AS members_a, y.members AS members_b FROM profile_cosine JOIN profile_of x ON x.CustomerKey = a JOIN profile_of y ON y.CustomerKey = b
    UNION ALL SELECT profile, profile, 1.0, members, members FROM profile_of WHERE profile = CustomerKey AND members > 1"""
S["recommend_top_n"] = f"""WITH norms AS (SELECT CustomerKey, sqrt(CAST(sum(orders * orders) AS DOUBLE)) AS norm FROM matrix GROUP BY 1),
    units AS (SELECT CustomerKey, ProductKey, orders, CAST(orders AS DOUBLE) / norm AS unit FROM matrix JOIN norms USING (CustomerKey)),
    middle AS (SELECT x.ProductKey AS f, y.ProductKey AS p, sum(x.unit * y.orders) AS part FROM units x JOIN units y USING (CustomerKey) GROUP BY 1, 2),
    sc AS (SELECT CustomerKey, p AS ProductKey, {rnd('sum(unit * part)', 4)} AS score FROM units JOIN middle ON f = ProductKey GROUP BY 1, 2),
    un AS (SELECT * FROM sc WHERE NOT EXISTS (SELECT 1 FROM matrix o WHERE o.CustomerKey = sc.CustomerKey AND o.ProductKey = sc.ProductKey))
    SELECT CustomerKey, ProductKey, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY CustomerKey ORDER BY score DESC, ProductKey) AS rank FROM un) WHERE rank <= 5"""
S["content_similar"] = f"""SELECT a AS profile_a, b AS profile_b, x.members AS members_a, y.members AS members_b, cosine FROM ({_cosine('token_leaders', 'ProductKey', 'token', 'w')})
    JOIN token_profiles x ON x.ProductKey = a JOIN token_profiles y ON y.ProductKey = b WHERE cosine >= 0.8"""
S["recommend_by_segment"] = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Segment ORDER BY customers DESC, quantity DESC, ProductKey) AS rank FROM
    (SELECT Segment, ProductKey, count(*) AS customers, CAST(sum(quantity) AS BIGINT) AS quantity FROM matrix JOIN rfm USING (CustomerKey) GROUP BY ALL)) WHERE rank <= 5"""


# ---- assembly -------------------------------------------------------------------------------

_WORD = re.compile(r"[A-Za-z_]\w*")


def _needed(text: str) -> list[str]:
    """Building blocks a text refers to, each after the ones it refers to itself."""
    ordered: list[str] = []

    def visit(body: str) -> None:
        for word in _WORD.findall(body):
            if word in B and word not in ordered:
                visit(B[word])
                if word not in ordered:
                    ordered.append(word)

    visit(text)
    return ordered


def statement(name: str) -> str:
    body = S[name]
    blocks = ",\n".join(f"{b} AS ({B[b]})" for b in _needed(body))
    if not blocks:
        return body
    if body.startswith("WITH "):
        return f"WITH {blocks},\n{body.removeprefix('WITH ')}"
    return f"WITH {blocks}\n{body}"


def statements() -> dict[str, str]:
    return {name: statement(name) for name in S}
