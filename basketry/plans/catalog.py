"""Every query by name: a function of the warehouse over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import columns as K
from basketry.operators import basket as B
from basketry.operators import churn as CH
from basketry.operators import cleaning as C
from basketry.operators import clustering as CL
from basketry.operators import clv as V
from basketry.operators import dimensions as D
from basketry.operators import distributions as S
from basketry.operators import facts as X
from basketry.operators import quality as Q
from basketry.operators import recommend as RC
from basketry.operators import rfm as R
from basketry.operators import sales as SL
from basketry.plans.models import models_of
from basketry.plans.warehouse import KEYED, STAR_TABLES, Warehouse, open_fixture
from basketry.session import materialise
from basketry.sources import delimited as L
from basketry.sources.delimited import ORDINAL
from basketry.sources.tables import TableStore, row_counts
from basketry.specs import CUSTOMER, ENTITIES, PRODUCT, SALES_HEADER, SALES_LINE, Rule

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register ``fn(warehouse)`` under ``name``."""

    def register(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(open_fixture(spark, folder))

        QUERIES[name] = run
        return fn

    return register


# ---- views the queries share ----------------------------------------------------------------


def sales(w: Warehouse) -> DataFrame:
    return w.table("FactSales")


def invoices(w: Warehouse) -> DataFrame:
    return w.table("FactInvoices")


def named_dim(w: Warehouse) -> DataFrame:
    return D.named_dimension(w.table("DimCustomer"))


def rfm(w: Warehouse) -> DataFrame:
    return w.table("rfm")


def rfm_joined(w: Warehouse) -> DataFrame:
    return R.with_customers(rfm(w), named_dim(w))


def rfm_named(w: Warehouse) -> DataFrame:
    return R.named_customers(rfm_joined(w))


def raw_typed(w: Warehouse, entity: str) -> DataFrame:
    return C.cast_entity(w.raw[entity], ENTITIES[entity])


def plain(df: DataFrame) -> DataFrame:
    """Without the technical columns."""
    return df.select(*[c for c in df.columns if not c.startswith("_") and c != X.MONTH])


def readable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text."""
    kinds = dict(df.dtypes)

    def show(c: str):
        if kinds[c].startswith("decimal"):
            return K.number(c).alias(c)
        return F.col(c).cast("string").alias(c) if kinds[c] == "date" else F.col(c)

    return df.select(*[show(c) for c in df.columns])


def scratch(w: Warehouse, name: str) -> str:
    return f"{w.store.root}/files/{name}"


def spare_store(w: Warehouse, name: str) -> TableStore:
    return TableStore(w.spark, f"{w.store.root}/{name}")


_RAW_ENCODING = {"Sector": "cp1252", "SalesLine": "cp1252", "Invoice": "cp1252"}


def source_files(w: Warehouse, *entities: str) -> str:
    """The raw entities as delimited files; written on first use."""
    folder = scratch(w, "source")
    for entity in entities:
        path = L.source_path(folder, entity)
        if not L.path_exists(w.spark, f"{path}/_SUCCESS"):
            L.write_delimited(plain(w.raw[entity]), path, _RAW_ENCODING.get(entity, "utf-8"))
    return folder


# ---- scans, sources, sinks ------------------------------------------------------------------


@query("scan_csv")
def _(w):
    folder = source_files(w, "Customer")
    return L.scan_delimited(w.spark, L.source_path(folder, "Customer"))


@query("scan_csv_encoding")
def _(w):
    path = scratch(w, "accented")
    accented = plain(w.raw["Customer"]).select(
        "accountid", F.concat(F.col("sectorid"), F.lit(' – "Hôtel"; à 3 € "\\')).alias("libellé")
    )
    L.write_delimited(accented, path, "cp1252")
    return L.scan_delimited(w.spark, path, ["utf-8", "cp1252"])


@query("scan_skip_bad_lines")
def _(w):
    path = scratch(w, "ragged")
    c = w.raw["Customer"].filter("accountid IS NOT NULL")
    number = F.col("accountid").cast("long") % 10
    whole = F.concat_ws(";", "accountid", "sectorid", "regionid")
    line = (
        F.when(number == 3, F.concat(whole, F.lit(";surplus")))
        .when(number == 4, F.concat(whole, F.lit(";;surplus")))
        .when(number == 7, F.concat_ws(";", "accountid", "sectorid"))
        .otherwise(whole)
    )
    lines = c.select(line.alias("accountid;sectorid;regionid"))
    lines.write.mode("overwrite").option("header", "true").option("sep", "\x01").option("quote", "\x00").csv(path)
    return L.scan_delimited(w.spark, path)


@query("scan_projected_table")
def _(w):
    return readable(sales(w).select("SaleID", "CustomerKey", "ProductKey", "Quantity", "LineTotalAmount"))


@query("scan_limit_sample")
def _(w):
    first = sales(w).orderBy("SaleID", "ProductKey").limit(1000)
    return readable(first.select("SaleID", "ProductKey", "Quantity", "UnitPrice"))


@query("count_file_lines")
def _(w):
    names = list(ENTITIES)
    folder = source_files(w, *names)
    counted = [
        L.count_lines(w.spark, L.source_path(folder, n)).select(F.lit(n).alias("table"), "lines") for n in names
    ]
    return reduce(DataFrame.unionByName, counted)


@query("file_overview")
def _(w):
    names = list(ENTITIES)
    return L.files_overview(w.spark, source_files(w, *names), names)


@query("validate_columns")
def _(w):
    """Declared and found columns with how many values each holds."""
    reports = []
    for spec in ENTITIES.values():
        raw = w.raw[spec.name]
        L.check_columns(spec, raw.columns)
        filled = Q.per_column(raw, F.count, "filled").select("column", "filled")
        reports.append(L.column_report(spec, raw).join(filled, "column"))
    return reduce(DataFrame.unionByName, reports)


@query("normalize_column_names")
def _(w):
    df = plain(w.raw["Product"])
    return L.normalise_columns(df.toDF(*[f"  {c} " for c in df.columns]))


@query("stage_entity")
def _(w):
    return plain(L.stage(w.spark, source_files(w, "SalesLine"), "SalesLine"))


@query("sink_clean_csv")
def _(w):
    path = scratch(w, "cleaned/Invoice.csv")
    L.write_delimited(plain(w.clean("Invoice")), path)
    return L.scan_delimited(w.spark, path)


@query("sink_rfm_csv")
def _(w):
    path = scratch(w, "rfm_customers.csv")
    L.write_delimited(rfm(w), path)
    return L.scan_delimited(w.spark, path).select("CustomerKey", "Recency", "Frequency", "Monetary", "RFM_score", "Segment")


def _in_two_batches(w: Warehouse, table: str, late, partition_by=()) -> DataFrame:
    """A stored table without its late rows, then a batch of them, then the same batch again."""
    store = spare_store(w, "sinks")
    rows = w.table(table)
    store.write(table, rows.filter(~late), partition_by)
    base = store.publish([table])
    batch = f"late-{table}-{base.number}"
    for _ in range(2):
        now = store.snapshot()
        if batch not in now.batches:
            store.publish([], {table: store.append(table, rows.filter(late), batch, now, partition_by)}, batch, now)
    return store.snapshot().read(table)


@query("sink_dim_append")
def _(w):
    return plain(_in_two_batches(w, "DimProduct", F.col("ProductKey") % 3 == 1))


@query("sink_fact_append")
def _(w):
    stored = _in_two_batches(w, "FactSales", F.col("SaleID") % 5 == 2, [X.MONTH])
    totals = stored.groupBy(X.MONTH).agg(F.count("*").alias("rows"), F.sum("LineTotalAmount").alias("amount"))
    return readable(totals)


_later_loads: dict[str, Warehouse] = {}


def later_load(w: Warehouse) -> Warehouse:
    """A warehouse that makes members of unknown keys, and gets some sales in a later batch and then again."""
    if w.store.root not in _later_loads:
        columns = {"SalesHeader": "saleid", "SalesLine": "saleid", "Invoice": "salesid"}
        late = {e: F.coalesce(F.col(c).try_cast("long") % 10 == 3, F.lit(False)) for e, c in columns.items()}
        raw = {e: w.raw[e].filter(~late[e]) if e in late else w.raw[e] for e in ENTITIES}
        loaded = Warehouse(spare_store(w, "later"), raw, late_members=True, in_place=w.in_place)
        for batch in ("later", "the same again"):
            loaded.append({e: w.raw[e].filter(late[e]) for e in late}, batch)
        _later_loads[w.store.root] = loaded
    return _later_loads[w.store.root]


@query("batch_load")
def _(w):
    """Facts by month after two batches: as many as one load gives."""
    facts = later_load(w).table("FactSales")
    return readable(facts.groupBy(X.MONTH).agg(F.count("*").alias("rows"), F.sum("LineTotalAmount").alias("amount")))


@query("late_members")
def _(w):
    """Members that the sales made, with what they bought."""
    star = later_load(w)
    known = star.clean("Customer").select(F.col("accountid").alias("AccountID"))
    late = star.table("DimCustomer").join(known, "AccountID", "left_anti")
    bought = star.table("FactSales").groupBy("CustomerKey").agg(F.count("*").alias("lines"), F.sum("LineTotalAmount").alias("amount"))
    return readable(late.join(bought, "CustomerKey").select("AccountID", "AccountName", "RegionDescription", "lines", "amount"))


@query("truncate_reload")
def _(w):
    """Two loads of one table: the reader sees the second as a whole, and no row twice."""
    store = spare_store(w, "reloads")
    store.write("DimCustomer", w.table("DimCustomer").limit(0))
    return store.write("DimCustomer", w.table("DimCustomer"))


@query("resume_fact_invoices")
def _(w):
    """Load only the missing fact from clean tables and stored dimensions; a second run adds nothing."""
    store = spare_store(w, "resumed")

    def build():
        return X.fact_invoices(*w.tables("clean_Invoice", "sale_keys", "DimPaymentMethod"))

    store.read_or_build("FactInvoices", build, [X.MONTH])
    again = store.read_or_build("FactInvoices", build, [X.MONTH])
    return readable(plain(again).drop("InvoiceKey"))


@query("read_clean_or_rebuild")
def _(w):
    store = spare_store(w, "rebuilt")

    def build():
        return C.clean_invoice(w.raw["Invoice"], w.clean("SalesHeader")).rows

    store.read_or_build("clean_Invoice", build)
    return readable(plain(store.read_or_build("clean_Invoice", build)))


@query("warehouse_row_counts")
def _(w):
    return row_counts(w.build_star())


# ---- cleaning -------------------------------------------------------------------------------


@query("drop_null_keys")
def _(w):
    return plain(C.drop_null_keys(w.raw["Invoice"], ["invoiceid"]))


@query("dedup_keep_first")
def _(w):
    kept = C.keep_first_of_few(C.drop_null_keys(w.raw["SalesLine"], SALES_LINE.keys), SALES_LINE.keys)
    return kept.select("saleid", "itemid", "qty", "httotalamount", F.col(C.COPIES).alias("copies"))


@query("dedup_subset")
def _(w):
    first = C.keep_first(w.clean("SalesHeader"), ["accountid"])
    return first.select("accountid", "saleid", "sellerid", F.col(C.COPIES).alias("copies"))


@query("business_rules")
def _(w):
    rules = [
        Rule("qty", ">", 0),
        Rule("unitprice", ">=", 1000),
        Rule("promovalue", "<", 9),
        Rule("promotype", "!=", "Rebates"),
        Rule("saleid", "not_null"),
        Rule("no_such_column", ">", 0),
    ]
    return plain(C.apply_rules(w.raw["SalesLine"], rules)).select("saleid", "itemid", "qty", "unitprice", "promotype")


@query("cast_decimal_comma")
def _(w):
    return w.raw["SalesHeader"].select("saleid", K.number(K.to_money("totalamount")).alias("totalamount"))


@query("cast_integer")
def _(w):
    halves = F.concat("qty", F.lit(".5"))
    return w.raw["SalesLine"].select("saleid", "itemid", K.to_whole("qty").alias("qty"), K.to_whole(halves).alias("rounded"))


@query("cast_date")
def _(w):
    days = [K.to_day(c).cast("string").alias(c) for c in ("orderdate", "delivdate")]
    return w.raw["SalesHeader"].select("saleid", *days)


@query("trim_truncate")
def _(w):
    return w.raw["Customer"].select("accountid", K.tidy_text("accountname", 12).alias("accountname"))


@query("cast_entity")
def _(w):
    return readable(plain(C.cast_entity(w.raw["SalesHeader"], SALES_HEADER)))


@query("null_counts")
def _(w):
    clean = {n: w.clean(n) for n in ENTITIES}
    return reduce(DataFrame.unionByName, [C.null_counts(df, ENTITIES[n]) for n, df in clean.items()])


@query("dq_metrics")
def _(w):
    """Counters of all eight cleaning runs, one row per entity, as stored with the load."""
    return w.quality_counters()


@query("ri_map_unknown")
def _(w):
    mapped = w.raw["SalesHeader"]
    for fk in C.header_keys(w.clean("Customer"), w.clean("Seller")):
        mapped = C.map_orphans(mapped, fk).withColumnRenamed("_orphan", f"{fk.column}_mapped")
    return mapped.select(
        "saleid", "accountid", "sellerid", *[F.col(f"{c}_mapped").cast("int").alias(f"{c}_mapped") for c in ("accountid", "sellerid")]
    )


@query("ri_drop")
def _(w):
    fk = C.ForeignKey("saleid", w.clean("SalesHeader"), "saleid", "drop")
    return C.drop_orphans(w.raw["SalesLine"], fk).select("saleid", "itemid", "qty")


@query("unknown_member")
def _(w):
    return plain(C.with_unknown_member(C.clean_dimension(w.raw["Product"], PRODUCT, add_unknown=False).rows, "itemid"))


@query("clean_dimension")
def _(w):
    parts = []
    for name in ("Region", "Sector", "Customer", "Seller", "Product"):
        spec = ENTITIES[name]
        df = C.clean_dimension(w.raw[name], spec).rows
        parts.append(df.select(F.lit(name).alias("entity"), F.col(spec.keys[0]).alias("key"), F.col(spec.optional[0]).alias("label")))
    return reduce(DataFrame.unionByName, parts)


@query("clean_sales_header")
def _(w):
    return readable(plain(C.clean_sales_header(w.raw["SalesHeader"], w.clean("Customer"), w.clean("Seller")).rows))


@query("clean_sales_line")
def _(w):
    return readable(plain(C.clean_sales_line(w.raw["SalesLine"], w.clean("SalesHeader"), w.clean("Product")).rows))


@query("clean_invoice")
def _(w):
    return readable(plain(C.clean_invoice(w.raw["Invoice"], w.clean("SalesHeader")).rows))


@query("clean_all")
def _(w):
    return row_counts({n: c.rows for n, c in C.clean_all(w.raw).items()})


# ---- dimensions and facts -------------------------------------------------------------------


@query("dim_date")
def _(w):
    return readable(D.dim_date(w.clean("SalesHeader")))


@query("date_key")
def _(w):
    return w.clean("SalesHeader").select("saleid", K.date_key("orderdate").alias("order_key"), K.date_key("delivdate").alias("delivery_key"))


@query("date_from_key")
def _(w):
    return w.table("DimDate").select("DateKey", K.date_from_key("DateKey").cast("string").alias("day"))


@query("dim_customer")
def _(w):
    return w.table("DimCustomer")


@query("client_name_fill")
def _(w):
    return SL.client_names(w.clean("Customer"))


@query("inferred_customers")
def _(w):
    members = D.customer_members(w.clean("Customer"), w.clean("Region"), w.clean("Sector"))
    return D.inferred_customers(w.raw["SalesHeader"], members)


@query("dim_seller")
def _(w):
    return w.table("DimSeller")


@query("dim_product")
def _(w):
    return w.table("DimProduct")


@query("dim_promotion")
def _(w):
    return w.table("DimPromotion")


@query("dim_payment_method")
def _(w):
    return w.table("DimPaymentMethod")


@query("surrogate_key")
def _(w):
    """A key map stored for some customers, extended to all: stored keys stay, new ones follow."""
    members = D.customer_members(w.clean("Customer"), w.clean("Region"), w.clean("Sector"))
    old = members.filter(F.coalesce(F.col("AccountID").try_cast("long") % 3 == 0, F.lit(True)))
    order = [ORDINAL, "AccountID"]
    stored = materialise(D.assign_keys(old, "AccountID", "CustomerKey", order), "keys")
    return D.extend_keys(stored, members, "AccountID", "CustomerKey", order)


@query("key_lookup")
def _(w):
    found = X.look_up(w.clean("SalesHeader"), K.strip("accountid"), w.table("DimCustomer"), "AccountID", "CustomerKey")
    return found.select("saleid", "accountid", "CustomerKey")


@query("fact_sales")
def _(w):
    return readable(plain(sales(w)).drop("SalesKey"))


@query("line_measures")
def _(w):
    return readable(X.line_measures(w.clean("SalesLine")))


@query("fact_invoices")
def _(w):
    return readable(plain(invoices(w)).drop("InvoiceKey"))


@query("star_build")
def _(w):
    """Row counts of the star with the amounts of its facts."""
    star = w.build_star()
    amounts = {"FactSales": "LineTotalAmount", "FactInvoices": "PaymentAmount"}
    parts = []
    for name in STAR_TABLES:
        amount = F.sum(amounts[name]) if name in amounts else F.lit(0)
        parts.append(star[name].agg(F.count("*").alias("rows"), K.number(amount).alias("amount")).select(F.lit(name).alias("table"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query("scd2_merge")
def _(w):
    """Two loads of the customer history: in the second, some regions change, some customers are
    missing and some are new."""
    members = D.customer_members(w.clean("Customer"), w.clean("Region"), w.clean("Sector")).select("AccountID", "AccountName", "RegionID")
    number = F.col("AccountID").try_cast("long")
    first = members.filter(F.coalesce(number % 5 != 0, F.lit(True)))
    second = members.filter(F.coalesce(number % 11 != 0, F.lit(True))).withColumn(
        "RegionID", F.when(number % 7 == 0, F.lit("moved")).otherwise(F.col("RegionID"))
    )
    stored = D.open_versions(first, F.lit("2024-01-01"))
    return readable(D.merge_versions(stored, second, "AccountID", F.lit("2024-06-01")))


@query("scd2_as_of")
def _(w):
    """Sale lines by the version of their customer, seller and product that is valid on the order date, after some
    members changed between two loads."""
    parts = []
    for dim, label in (("DimCustomer", "RegionID"), ("DimSeller", "SellerName"), ("DimProduct", "Brand")):
        natural, key = KEYED[dim]
        first = w.table(dim).select(natural, key, label)
        second = first.withColumn(label, F.when(F.col(key) % 7 == 0, F.lit("moved")).otherwise(F.col(label)))
        history = D.merge_versions(D.open_versions(first, F.lit("0001-01-01")), second, natural, F.lit("1995-06-17"))
        versions = materialise(history.withColumn("VersionKey", D.version_key(natural)), "history")
        lines = sales(w).select(key, "OrderDateKey", "LineTotalAmount")
        found = D.valid_versions(lines, key, K.date_from_key("OrderDateKey"), versions.select(key, "VersionKey", D.VALID_FROM, D.VALID_TO), key, "VersionKey")
        totals = found.groupBy("VersionKey").agg(F.count("*").alias("lines"), F.sum("LineTotalAmount").alias("amount"))
        named = totals.join(versions.select("VersionKey", F.col(label).alias("label"), D.VALID_FROM), "VersionKey", "left")
        parts.append(named.groupBy("label", D.VALID_FROM).agg(F.sum("lines").alias("lines"), F.sum("amount").alias("amount")).select(F.lit(dim).alias("dim"), "*"))
    return readable(reduce(DataFrame.unionByName, parts))


def _enriched(w, risk: DataFrame, predicted: DataFrame) -> DataFrame:
    value = V.clv_historical(sales(w)).join(predicted, "CustomerKey", "left")
    value = value.withColumnsRenamed({"clv_historical": "CLV_Historical", "clv_predicted": "CLV_Predicted"})
    full = D.enrich_customers(w.table("DimCustomer"), rfm(w), risk, value)
    return readable(full)


@query("dim_customer_enrich")
def _(w):
    """Analytic columns from observed figures: risk is whether the customer left, the prediction is
    what was spent after the cutoff."""
    labels = CH.churn_label(sales(w)).select("CustomerKey", K.number("label").alias("ChurnRisk"))
    later = V.revenue_after(sales(w), CH.cutoff_day(sales(w)))
    return _enriched(w, labels, later.withColumnRenamed("future_revenue", "clv_predicted"))


@query("dim_customer_enrich_models")
def _(w):
    """The same columns from the fitted models."""
    return _enriched(w, _risk(w), _clv_predictions(w))


# ---- profiling and quality ------------------------------------------------------------------


@query("profile_columns")
def _(w):
    return Q.stack([Q.profile_columns(w.table(t), t) for t in STAR_TABLES])


@query("profile_sample")
def _(w):
    return readable(plain(Q.profile_sample(sales(w), ["SaleID", "ProductKey"]).drop("SalesKey")))


_SAMPLE_ORDER = {"FactSales": ["SaleID", "ProductKey", "Quantity", "LineTotalAmount"], "FactInvoices": ["SaleID", "InvoiceID"]}


@query("profile_samples")
def _(w):
    """The first five rows of every star table."""
    tables = {t: plain(w.table(t)).drop("SalesKey", "InvoiceKey") for t in STAR_TABLES}
    return Q.profile_samples({t: (df, _SAMPLE_ORDER.get(t, df.columns[:1])) for t, df in tables.items()})


@query("describe_numeric")
def _(w):
    return Q.describe_numeric(sales(w), X.FACT_MEASURES)


@query("describe_tables")
def _(w):
    """The same figures of every numeric column of the raw facts, typed, and of the customer scores."""
    tables = {
        "SalesHeader": (raw_typed(w, "SalesHeader"), ["bruteamount", "netamount", "taxamount", "totalamount"]),
        "SalesLine": (raw_typed(w, "SalesLine"), ["qty", "unitprice", "httotalamount", "ttctotalamount", "promovalue"]),
        "Invoice": (raw_typed(w, "Invoice"), ["paymentamount"]),
        "rfm": (rfm(w), ["Recency", "Frequency", "Monetary"]),
    }
    return Q.stack([Q.describe_numeric(df, cs).select(F.lit(t).alias("table"), "*") for t, (df, cs) in tables.items()])


@query("distinct_key_counts")
def _(w):
    a = Q.distinct_counts(sales(w), ["SaleID", "CustomerKey", "SellerKey", "ProductKey"])
    b = Q.distinct_counts(invoices(w), ["InvoiceID", "CustomerKey", "SaleID"])
    name = lambda t, df: df.select(F.lit(t).alias("table"), "column", "distinct")
    return name("FactSales", a).unionByName(name("FactInvoices", b))


@query("missing_summary")
def _(w):
    return Q.missing_summary({n: w.raw[n] for n in ENTITIES})


@query("unique_counts")
def _(w):
    return Q.stack([Q.unique_counts(w.raw[n], n) for n in ENTITIES])


@query("duplicate_rows")
def _(w):
    """Rows of each table that are equal in every column, and how many different ones they are."""

    def of(name):
        found = Q.duplicate_rows(plain(w.raw[name])).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"), F.count("*").alias("kinds"))
        return found.select(F.lit(name).alias("table"), "rows", "kinds")

    return Q.stack([of(n) for n in ENTITIES])


@query("duplicate_row_list")
def _(w):
    return Q.duplicate_row_list({n: plain(w.raw[n]) for n in ENTITIES})


@query("duplicate_keys")
def _(w):
    return Q.duplicate_keys(w.raw["SalesHeader"], ["saleid"])


@query("whitespace_check")
def _(w):
    return Q.whitespace_check({n: w.raw[n] for n in ENTITIES})


@query("negative_check")
def _(w):
    return Q.negative_check({n: raw_typed(w, n) for n in ("SalesHeader", "SalesLine", "Invoice")})


@query("invalid_dates")
def _(w):
    return Q.invalid_dates(w.raw["SalesHeader"], ["orderdate", "delivdate"])


@query("delivery_before_order")
def _(w):
    return Q.delivery_before_order(w.raw["SalesHeader"])


@query("date_range")
def _(w):
    header = w.raw["SalesHeader"]
    return Q.date_range(
        {
            "orderdate": (header, K.to_day("orderdate")),
            "delivdate": (header, K.to_day("delivdate")),
            "OrderDateKey": (sales(w), F.col("OrderDateKey")),
            "PaymentDateKey": (invoices(w), F.col("PaymentDateKey")),
        }
    )


def _relations(w) -> list[Q.Relation]:
    r = w.raw
    return [
        Q.Relation("Customer.regionid", r["Customer"], "regionid", r["Region"], "regionid"),
        Q.Relation("Customer.sectorid", r["Customer"], "sectorid", r["Sector"], "sectorid"),
        Q.Relation("SalesHeader.accountid", r["SalesHeader"], "accountid", r["Customer"], "accountid"),
        Q.Relation("SalesHeader.sellerid", r["SalesHeader"], "sellerid", r["Seller"], "sellerid"),
        Q.Relation("SalesLine.itemid", r["SalesLine"], "itemid", r["Product"], "itemid"),
        Q.Relation("Invoice.salesid", r["Invoice"], "salesid", r["SalesHeader"], "saleid"),
    ]


@query("fk_orphans")
def _(w):
    return Q.fk_orphans(_relations(w))


@query("fk_subset")
def _(w):
    pairs = [
        ("FactSales", "CustomerKey", "DimCustomer"),
        ("FactInvoices", "CustomerKey", "DimCustomer"),
        ("FactSales", "ProductKey", "DimProduct"),
        ("FactSales", "SellerKey", "DimSeller"),
        ("FactSales", "PromotionKey", "DimPromotion"),
        ("FactInvoices", "PaymentMethodKey", "DimPaymentMethod"),
    ]
    stored = [Q.Relation(f"{f}.{k}", w.table(f), k, w.table(d), k) for f, k, d in pairs]
    dates = [Q.Relation(f"FactSales.{k}", sales(w), k, w.table("DimDate"), "DateKey") for k in ("OrderDateKey", "DeliveryDateKey")]
    without = Q.Relation("FactSales.CustomerKey (named)", sales(w), "CustomerKey", named_dim(w), "CustomerKey")
    return Q.fk_subset([*stored, *dates, without])


@query("key_overlap")
def _(w):
    return Q.key_overlap(sales(w), named_dim(w), "CustomerKey")


@query("table_row_counts")
def _(w):
    counts = row_counts({n: w.raw[n] for n in ENTITIES})
    return counts.unionByName(counts.agg(F.sum("rows").alias("rows")).select(F.lit("TOTAL").alias("table"), "rows"))


@query("anonymous_names_top")
def _(w):
    return Q.anonymous_names_top(w.table("DimCustomer"))


@query("anonymous_names_count")
def _(w):
    return Q.anonymous_names_count(w.table("DimCustomer"))


# ---- sales ----------------------------------------------------------------------------------

_SALES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "customers_by_region_top": lambda w: SL.value_counts(w.raw["Customer"], "regionid", 15, "customers"),
    "customers_by_sector_top": lambda w: SL.value_counts(w.raw["Customer"], "sectorid", 20, "customers"),
    "products_by_brand_top": lambda w: SL.products_by_brand_top(w.raw["Product"]),
    "monthly_orders": lambda w: SL.monthly_orders(raw_typed(w, "SalesHeader")),
    "monthly_header_revenue": lambda w: SL.monthly_header_revenue(raw_typed(w, "SalesHeader")),
    "orders_by_weekday": lambda w: SL.orders_by_weekday(raw_typed(w, "SalesHeader")),
    "top_sellers": lambda w: SL.top_sellers(raw_typed(w, "SalesHeader"), w.clean("Seller")),
    "sales_by_region": lambda w: SL.sales_by_attribute(sales(w), named_dim(w), "RegionDescription"),
    "sales_by_sector": lambda w: SL.sales_by_attribute(sales(w), named_dim(w), "SectorDescription"),
    "monthly_sales": lambda w: SL.monthly_sales(sales(w)),
    "monthly_peaks": lambda w: SL.monthly_peaks(sales(w)),
    "top_products_revenue": lambda w: SL.top_products(sales(w), w.table("DimProduct"), "revenue"),
    "top_products_qty": lambda w: SL.top_products(sales(w), w.table("DimProduct"), "qty"),
    "top_items_qty_raw": lambda w: SL.top_items_qty_raw(raw_typed(w, "SalesLine"), w.clean("Product")),
    "short_name": lambda w: SL.short_names(w.table("DimProduct"), 8),
    "top_brands": lambda w: SL.top_brands(sales(w), w.table("DimProduct")),
    "promo_revenue": lambda w: SL.promo_revenue(sales(w), w.table("DimPromotion")),
    "promo_mix": lambda w: SL.promo_mix(raw_typed(w, "SalesLine")),
    "zero_price_lines": lambda w: SL.zero_price_lines(raw_typed(w, "SalesLine")),
    "delivery_delay_stats": lambda w: SL.delay_stats(SL.delay_days(sales(w))),
    "delivery_days_header": lambda w: SL.delivery_days_header(raw_typed(w, "SalesHeader")),
    "payment_by_method": lambda w: SL.payment_by_method(invoices(w), w.table("DimPaymentMethod")),
    "payment_mix": lambda w: SL.payment_mix(raw_typed(w, "Invoice")),
    "sales_by_quarter": lambda w: SL.sales_by_period(sales(w), "quarter"),
    "sales_by_year": lambda w: SL.sales_by_period(sales(w), "year"),
    "sales_rollup": lambda w: SL.sales_rollup(sales(w)),
    "sales_growth": lambda w: SL.sales_growth(sales(w), named_dim(w)),
    "seller_rank_outliers": lambda w: SL.seller_rank_outliers(sales(w), w.table("DimSeller")),
    "promo_vs_no_promo": lambda w: SL.promo_vs_no_promo(sales(w), w.table("DimPromotion"), w.table("DimProduct")),
    "promo_response_by_segment": lambda w: SL.promo_response_by_segment(sales(w), w.table("DimPromotion"), rfm(w)),
    "promo_roi": lambda w: SL.promo_roi(sales(w), w.table("DimPromotion")),
    "payment_trend": lambda w: SL.payment_trend(invoices(w), w.table("DimPaymentMethod")),
    "customer_payment_balance": lambda w: SL.customer_payment_balance(sales(w), invoices(w)),
    "kpi_overview": lambda w: SL.kpi_overview(sales(w)),
    "retention_new_returning": lambda w: SL.retention_new_returning(sales(w)),
    "loyal_customers": lambda w: SL.loyal_customers(sales(w), 2),
}

# ---- RFM and distributions ------------------------------------------------------------------


def _rfm_columns(w) -> dict:
    return {"recency": F.col("Recency"), "frequency": F.col("Frequency"), "log_monetary": S.log1p("Monetary")}


_RFM: dict[str, Callable[[Warehouse], DataFrame]] = {
    "rfm_base": lambda w: readable(R.rfm_base(sales(w))),
    "rfm_quartiles": lambda w: readable(R.rfm_quartiles(R.rfm_base(sales(w)))),
    "rfm_score": lambda w: rfm(w).select("CustomerKey", R.rfm_score().alias("RFM_score")),
    "rfm_segment": lambda w: readable(R.rfm_segments(R.rfm_base(sales(w)))),
    "segment_counts": lambda w: R.segment_counts(rfm(w)),
    "segment_means": lambda w: R.segment_means(rfm(w)),
    "segment_revenue_share": lambda w: R.segment_revenue_share(rfm(w)),
    "segment_profile_named": lambda w: R.segment_profile(rfm_named(w)),
    "rfm_customer_join": lambda w: readable(rfm_joined(w)).drop("R_quartile", "F_quartile", "M_quartile", "RFM_score"),
    "named_customers": lambda w: rfm_named(w).select("CustomerKey", "AccountName", "Segment"),
    "top_customers_frequency": lambda w: R.top_customers(rfm_named(w), "Frequency"),
    "top_customers_monetary": lambda w: R.top_customers(rfm_named(w), "Monetary"),
    "region_segment_pivot": lambda w: R.region_segment_pivot(rfm_joined(w)),
    "rfm_correlation": lambda w: R.correlation(rfm(w)),
    "clip_p99": lambda w: S.clip_at(rfm(w), "Recency", 0.99, "clipped").select("CustomerKey", K.rounded("clipped", 4).alias("clipped")),
    "filter_p99": lambda w: readable(S.keep_upto(raw_typed(w, "SalesHeader"), "totalamount", 0.99).select("saleid", "totalamount")),
    "filter_p95": lambda w: readable(
        S.keep_upto(raw_typed(w, "SalesLine"), "unitprice", 0.95, positive_only=True).select("saleid", "itemid", "unitprice")
    ),
    "log1p": lambda w: rfm(w).select("CustomerKey", K.rounded(S.log1p("Monetary"), 6).alias("log_monetary")),
    "histogram": lambda w: S.histogram(rfm(w), "Recency", 50),
    "histogram_payment": lambda w: S.histogram(
        S.keep_upto(raw_typed(w, "Invoice"), "paymentamount", 0.99), "paymentamount", 80
    ),
    "skewness": lambda w: S.skewness(rfm(w), _rfm_columns(w)),
    "median_marker": lambda w: S.medians(rfm(w), _rfm_columns(w)),
    "boxplot_stats": lambda w: S.boxplot(rfm(w), S.log1p("Monetary"), "Segment"),
    "pareto_curve": lambda w: S.pareto_curve(rfm_named(w), "Monetary", "CustomerKey"),
    "pareto_80": lambda w: S.pareto_point(S.pareto_curve(rfm_named(w), "Monetary", "CustomerKey")),
}

# ---- models, baskets, recommendations -------------------------------------------------------


def _baskets_as_text(w) -> DataFrame:
    return B.basket_items(sales(w)).select("SaleID", B.as_text("items").alias("items"), "item_count")


def _segments(w) -> DataFrame:
    run = models_of(w).segments()
    return CL.kmeans_segments(run.points, CL.best_silhouette(run.curve))


def _k_curve(w) -> DataFrame:
    run = models_of(w).segments()
    return CL.k_curve_table(w.spark, run.curve, run.elbow)


def _clv_predictions(w) -> DataFrame:
    run = models_of(w).value()
    return V.clv_predicted(run.current, run.models["linear_regression"])


def _clv_quality(w) -> DataFrame:
    run = models_of(w).value()
    return V.clv_model_quality(run.ready, run.models)


def _risk(w) -> DataFrame:
    return CH.churn_risk(models_of(w).churn(), "logistic_regression")


_MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "feature_scale": lambda w: CL.scaled_columns(CL.rfm_features(rfm(w))),
    "kmeans_segments": _segments,
    "kmeans_k_curve": _k_curve,
    "cluster_profile": lambda w: CL.cluster_profile(_segments(w), rfm(w)),
    "pca_project": lambda w: CL.pca_project(models_of(w).points(), 3),
    "density_clusters": lambda w: CL.density_clusters(CL.scaled_columns(CL.rfm_features(rfm(w))), ["recency_z", "log_monetary_z"], 0.25, 10),
    "churn_label": lambda w: CH.churn_label(sales(w)),
    "churn_features": lambda w: CH.churn_features(sales(w), named_dim(w)),
    "stratified_split": lambda w: CH.split_sizes(CH.churn_label(sales(w))),
    "churn_models": lambda w: models_of(w).churn().metrics,
    "churn_metrics": lambda w: CH.confusion(models_of(w).churn()),
    "feature_importance": lambda w: CH.feature_importance(models_of(w).churn()),
    "at_risk_list": lambda w: CH.at_risk_list(models_of(w).churn(), "random_forest"),
    "clv_historical": lambda w: V.clv_historical(sales(w)),
    "clv_summary_table": lambda w: V.clv_summary_table(sales(w)),
    "clv_predicted": _clv_predictions,
    "clv_model_quality": _clv_quality,
    "clv_tiers": lambda w: V.clv_tiers(V.clv_historical(sales(w))),
    "clv_churn_matrix": lambda w: V.clv_churn_matrix(V.clv_tiers(V.clv_historical(sales(w))), CH.churn_label(sales(w))),
    "clv_risk_matrix": lambda w: V.clv_risk_matrix(V.clv_tiers(V.clv_historical(sales(w))), _risk(w)),
    "clv_by_segment": lambda w: V.clv_by_segment(V.clv_historical(sales(w)), rfm(w)),
    "basket_items": _baskets_as_text,
    "frequent_itemsets": lambda w: B.frequent_itemsets(B.itemset_model(sales(w))),
    "association_rules": lambda w: B.association_rules(B.itemset_model(sales(w), min_confidence=0.05)),
    "association_rules_top": lambda w: B.top_rules(B.association_rules(B.itemset_model(sales(w), min_confidence=0.05))),
    "pair_rules": lambda w: B.pair_rules(sales(w)),
    "bundle_candidates": lambda w: B.bundle_candidates(B.pair_rules(sales(w)), 50.0, 2),
    "customer_product_matrix": lambda w: RC.customer_product_matrix(sales(w)),
    "item_cosine": lambda w: RC.item_cosine(RC.customer_product_matrix(sales(w))),
    "customer_cosine": lambda w: RC.customer_cosine(RC.customer_product_matrix(sales(w))),
    "recommend_top_n": lambda w: RC.recommend_top_n(RC.customer_product_matrix(sales(w))),
    "als_recommend": lambda w: RC.als_recommend(RC.customer_product_matrix(sales(w))),
    "content_similar": lambda w: RC.content_similar(w.table("DimProduct")),
    "recommend_by_segment": lambda w: RC.recommend_by_segment(RC.customer_product_matrix(sales(w)), rfm(w)),
}

for _table in (_SALES, _RFM, _MODELS):
    for _name, _fn in _table.items():
        query(_name)(_fn)

