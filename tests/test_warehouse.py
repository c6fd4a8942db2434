import pytest
from pyspark.sql import functions as F

from basketry.operators import dimensions as D
from basketry.operators import facts as X
from basketry.operators import rfm as R
from basketry.operators import sales as SL
from basketry.plans.catalog import plain, source_files
from basketry.plans.warehouse import STAR_TABLES, Warehouse, open_files
from basketry.sources import fixtures
from basketry.sources.tables import TableStore
from basketry.specs import ENTITIES, UNKNOWN_KEY


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_files_give_the_same_star(spark, warehouse, tmp_path):
    folder = source_files(warehouse, *ENTITIES)
    star = open_files(spark, folder, str(tmp_path / "star")).build_star()
    for name in STAR_TABLES:
        assert star[name].count() == warehouse.table(name).count(), name
    # Which of several rows with one key comes first depends on the order in the files.
    raw = warehouse.raw
    repeated = [raw["SalesLine"].groupBy("saleid", "itemid"), raw["SalesHeader"].groupBy("saleid")]
    sales = {r.saleid for g in repeated for r in g.count().filter("count > 1").collect() if r.saleid}
    measures = ["SaleID", "OrderDateKey", *X.FACT_MEASURES]
    own = ~F.col("SaleID").isin([int(s) for s in sales])
    ours, theirs = (t.filter(own).select(measures) for t in (star["FactSales"], warehouse.table("FactSales")))
    assert as_set(ours) == as_set(theirs) and ours.count() > 4000
    names = ["AccountID", "AccountName", "SectorDescription"]
    assert as_set(star["DimCustomer"].select(names)) == as_set(warehouse.table("DimCustomer").select(names))


def test_keys_survive_a_reload(spark, small, tmp_path):
    raw = fixtures.raw_tables(spark, small)
    number = F.col("accountid").cast("long")
    first = {**raw, "Customer": raw["Customer"].filter(number % 4 != 0)}
    w = Warehouse(TableStore(spark, str(tmp_path / "reload")), first)
    before = {r.AccountID: r.CustomerKey for r in w.table("DimCustomer").collect()}
    facts_before = w.table("FactSales").count()
    star = w.reload(raw)
    after = {r.AccountID: r.CustomerKey for r in star["DimCustomer"].collect()}
    assert before.items() <= after.items() and len(after) > len(before)
    assert min(k for a, k in after.items() if a not in before) == max(before.values()) + 1
    assert sorted(after.values()) == list(range(1, len(after) + 1))
    assert star["FactSales"].count() == facts_before
    assert len(w.store.versions("FactSales")) == 2


def test_every_key_resolves_and_counts_agree(warehouse):
    star = warehouse.build_star()
    sales = star["FactSales"]
    dims = {"CustomerKey": "DimCustomer", "SellerKey": "DimSeller", "ProductKey": "DimProduct", "PromotionKey": "DimPromotion"}
    for key, dim in dims.items():
        assert sales.join(star[dim], key, "left_anti").isEmpty()
    for key in ("OrderDateKey", "DeliveryDateKey"):
        assert sales.join(star["DimDate"], sales[key] == star["DimDate"].DateKey, "left_anti").isEmpty()
    assert sales.select("SalesKey").distinct().count() == sales.count()
    assert star["DimDate"].count() == star["DimDate"].agg(F.date_diff(F.max("FullDate"), F.min("FullDate")) + 1).first()[0]
    segments = {r.Segment: r.customers for r in R.segment_counts(warehouse.table("rfm")).collect()}
    assert sum(segments.values()) == sales.select("CustomerKey").distinct().count()
    assert set(segments) <= {"Champions", "Hibernating", "At risk", "Other"}
    shares = SL.promo_revenue(sales, star["DimPromotion"]).agg(F.sum("revenue_pct")).first()[0]
    assert shares == pytest.approx(100, abs=0.05)
    unknown = star["DimCustomer"].filter(F.col("AccountID") == UNKNOWN_KEY).first()
    assert (unknown.CustomerKey, unknown.AccountName) == (1, f"CLIENT_{UNKNOWN_KEY}")


def test_facts_are_partitioned_by_month_and_pruned(warehouse):
    month = warehouse.table("FactSales").agg(F.min(X.MONTH)).first()[0]
    one = warehouse.table("FactSales").filter(F.col(X.MONTH) == month).select("SaleID", "LineTotalAmount")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "HeaderTotalAmount" not in plan


def test_a_hot_sale_is_split(spark):
    """A third of all lines on one sale: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        money = F.lit(1).cast("decimal(18,2)")
        line = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 5000).cast("string")).alias("saleid"),
            F.col("id").cast("string").alias("itemid"),
            F.lit(1).alias("qty"),
            *[money.alias(c) for c in ("unitprice", "httotalamount", "ttctotalamount", "promovalue")],
            F.lit("Gift").alias("promotype"),
        )
        sales = spark.range(5000).select(
            F.col("id").cast("string").alias("saleid"),
            *[F.lit(20240101).alias(c) for c in ("OrderDateKey", "DeliveryDateKey")],
            *[F.lit(1).alias(c) for c in ("CustomerKey", "SellerKey")],
            *[money.alias(f"Header{c}Amount") for c in ("Brute", "Net", "Tax", "Total")],
        )
        product = spark.range(n).select(F.col("id").cast("string").alias("ItemID"), F.col("id").cast("int").alias("ProductKey"))
        promotion = spark.createDataFrame([("Gift", 1)], "PromoType string, PromotionKey int")
        fact = X.fact_sales(sales, line, product, promotion).select("SaleID", "ProductKey")
        rows = fact.collect()
        assert len(rows) == n
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reports_do_not_gather_rows_in_one_task(spark, warehouse):
    """Ranks and running totals: the only single partition holds one row per range."""
    frame = R.rfm_quartiles(R.rfm_base(warehouse.table("FactSales")))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for block in plan.split("Exchange SinglePartition")[1:]:
        below = block.split("FileScan", 1)[0]
        assert "Aggregate" in below


def test_history(spark):
    schema = "id string, name string, region string"
    day = [F.lit(d) for d in ("2024-01-01", "2024-03-01", "2024-06-01")]
    one = D.open_versions(spark.createDataFrame([("a", "A", "r1"), ("b", "B", None), ("c", "C", "r1")], schema), day[0])
    two = D.merge_versions(one, spark.createDataFrame([("a", "A", "r2"), ("b", "B", None), ("d", "D", "r1")], schema), "id", day[1])
    three = D.merge_versions(two, spark.createDataFrame([("a", "A", "r3")], schema), "id", day[2])
    again = D.merge_versions(three, spark.createDataFrame([("a", "A", "r3")], schema), "id", day[2])
    found = {(r.id, r.region, str(r.ValidFrom), str(r.ValidTo), r.IsCurrent) for r in again.collect()}
    assert found == {
        ("a", "r1", "2024-01-01", "2024-03-01", 0),
        ("a", "r2", "2024-03-01", "2024-06-01", 0),
        ("a", "r3", "2024-06-01", "None", 1),
        ("b", None, "2024-01-01", "None", 1),
        ("c", "r1", "2024-01-01", "None", 1),
        ("d", "r1", "2024-03-01", "None", 1),
    }
    assert again.count() == 6


def test_default_calendar(spark):
    empty = spark.createDataFrame([], "orderdate date, delivdate date")
    days = D.dim_date(empty)
    assert days.count() == 731
    assert days.filter("FullDate = '2024-01-01'").first().DayName == "Monday"


def test_missing_promotion_keeps_its_lines(spark):
    line = spark.createDataFrame([("1", "a", None), ("1", "b", "Gift")], "saleid string, itemid string, promotype string")
    assert {r.PromoType for r in D.promotion_members(line).collect()} == {"Unknown", "Gift"}


def test_raw_columns_follow_the_contracts(spark, small):
    for name, df in fixtures.raw_tables(spark, small).items():
        assert plain(df).columns == ENTITIES[name].columns


# ---- batches, late members, history -----------------------------------------------------------


def split_raw(raw, condition):
    """The sales side of the raw tables where ``condition`` on the sale's number holds, and nothing else."""
    columns = {"SalesHeader": "saleid", "SalesLine": "saleid", "Invoice": "salesid"}
    return {e: raw[e].filter(condition(F.col(c).try_cast("long"))) for e, c in columns.items()}


def facts_of(w):
    """Facts by what they say, not by how their members are numbered."""
    sales = w.table("FactSales").join(w.table("DimCustomer").select("CustomerKey", "AccountID"), "CustomerKey")
    sales = sales.join(w.table("DimProduct").select("ProductKey", "ItemID"), "ProductKey")
    sales = sales.join(w.table("DimPromotion").select("PromotionKey", "PromoType"), "PromotionKey")
    bills = w.table("FactInvoices").join(w.table("DimPaymentMethod").select("PaymentMethodKey", "PaymentMethodCode"), "PaymentMethodKey")
    return (
        as_set(sales.select("SalesKey", "SaleID", "AccountID", "ItemID", "PromoType", "OrderDateKey", *X.FACT_MEASURES)),
        as_set(bills.select("InvoiceKey", "InvoiceID", "SaleID", "PaymentDateKey", "PaymentMethodCode", "PaymentAmount")),
    )


def test_batches_give_what_one_load_gives(spark, small, warehouse, tmp_path):
    raw = fixtures.raw_tables(spark, small)
    late = lambda n: F.coalesce(n % 4 == 1, F.lit(False))
    w = Warehouse(TableStore(spark, str(tmp_path / "batches")), {**raw, **split_raw(raw, lambda n: ~late(n))})
    base = w.publish()
    reader = base.read("FactSales")
    before, months = reader.count(), {r[0] for r in reader.select(X.MONTH).distinct().collect()}
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "batches" / "FactSales").rglob("*.parquet")}
    kept = files()
    second = split_raw(raw, late)
    done = w.append(second, "second")
    assert kept.items() <= files().items()
    assert reader.count() == before < done.read("FactSales").count()
    assert facts_of(w) == facts_of(warehouse)
    assert months and as_set(w.table("DimDate")) == as_set(warehouse.table("DimDate"))
    assert as_set(w.table("DimCustomer")) == as_set(warehouse.table("DimCustomer"))
    assert w.append(second, "second").number == done.number
    again = w.append(second, "sent again")
    assert again.tables["FactSales"] == done.tables["FactSales"]
    assert facts_of(w) == facts_of(warehouse)


def test_reload_gives_equal_fact_keys(spark, small, warehouse, tmp_path):
    w = Warehouse(TableStore(spark, str(tmp_path / "again")), fixtures.raw_tables(spark, small))
    keys = lambda t, k, *n: {(r[0], *r[1:]) for r in t.select(k, *n).collect()}
    for table, key, natural in (("FactSales", "SalesKey", ["SaleID", "ProductKey", "LineTotalAmount"]), ("FactInvoices", "InvoiceKey", ["InvoiceID"])):
        assert keys(w.table(table), key, *natural) == keys(warehouse.table(table), key, *natural)


def test_a_shared_hash_gives_two_keys(spark):
    rows = spark.createDataFrame([("1", "a", 5), ("1", "b", 5), ("2", "a", 6)], "saleid string, itemid string, _row long")
    found = {(r.saleid, r.itemid): r.SalesKey for r in X.with_row_keys(rows, ["saleid", "itemid"], "SalesKey").collect()}
    assert found["1", "a"] == 5 and found["2", "a"] == 6 and len(set(found.values())) == 3


def test_late_members_keep_their_key(spark, small, tmp_path):
    raw = fixtures.raw_tables(spark, small)
    number = F.col("accountid").cast("long")
    missing = F.coalesce(number % 4 == 0, F.lit(False))
    first = {**raw, "Customer": raw["Customer"].filter(~missing)}
    w = Warehouse(TableStore(spark, str(tmp_path / "late")), first, late_members=True)
    w.publish()
    customers = {r.AccountID: r for r in w.table("DimCustomer").collect()}
    sales = w.table("FactSales").join(w.table("DimCustomer").select("CustomerKey", "AccountID"), "CustomerKey").cache()
    accounts = {r[0] for r in raw["SalesHeader"].select("accountid").distinct().collect()}
    assert accounts - {None} <= set(customers)
    late = {a for a in accounts if a and int(a) > 0 and int(a) % 4 == 0}
    assert late and all(customers[a].AccountName == f"CLIENT_{a}" and customers[a].RegionID is None for a in late)
    assert sales.filter(F.col("AccountID").cast("long") % 4 == 0).count() > 100
    unknown = sales.filter(F.col("AccountID") == UNKNOWN_KEY).count()
    assert unknown == 0
    before = as_set(w.table("FactSales"))
    w.append({"Customer": raw["Customer"].filter(missing)}, "their real rows")
    after = {r.AccountID: r for r in w.table("DimCustomer").collect()}
    assert {a: r.CustomerKey for a, r in customers.items()}.items() <= {a: r.CustomerKey for a, r in after.items()}.items()
    assert all(after[a].RegionID is not None for a in late if int(a) % 997)
    assert as_set(w.table("FactSales")) == before
    assert len({r.CustomerKey for r in after.values()}) == len(after)


def test_counters_are_stored_by_the_load(spark, warehouse):
    """The same numbers as counting the flagged rows, without a second cleaning in the plan."""
    stored = {r.entity: r.asDict() for r in warehouse.quality_counters().collect()}
    assert set(stored) == set(ENTITIES)
    for entity in ENTITIES:
        assert warehouse._cleaned(entity).counts.first().asDict() == stored[entity], entity
    plan = warehouse.quality_counters()._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("FileScan") == len(ENTITIES)


def test_facts_point_at_the_version_of_their_day(spark):
    versions = spark.createDataFrame(
        [(1, "0001-01-01", "2024-03-10", 10), (1, "2024-03-10", "2024-03-11", 11), (1, "2024-03-11", None, 12), (2, "2024-02-01", "2024-02-01", 20), (2, "2024-02-01", None, 21)],
        "k int, f string, t string, v int",
    ).selectExpr("k", "to_date(f) as ValidFrom", "to_date(t) as ValidTo", "v")
    facts = spark.createDataFrame(
        [(1, "2023-12-31", 10), (1, "2024-03-09", 10), (1, "2024-03-10", 11), (1, "2024-03-11", 12), (1, "2031-01-01", 12), (2, "2024-01-31", None), (2, "2024-02-01", 21), (3, "2024-02-01", None), (1, None, None)],
        "k int, d string, want int",
    )
    found = D.valid_versions(facts, "k", F.to_date("d"), versions, "k", "v").collect()
    assert len(found) == 9 and all(r.v == r.want for r in found)


def test_columnar_sources_are_read_in_place(spark, small, warehouse, tmp_path):
    """Rows that lie in columnar tables already are neither copied nor shuffled before they are cleaned."""
    w = Warehouse(TableStore(spark, str(tmp_path / "place")), fixtures.raw_tables(spark, small), in_place=fixtures.IN_PLACE)
    w.tables("clean_Customer", "clean_Region")
    assert w.store.exists("raw_Region") and not w.store.exists("raw_Customer")
    assert not [e for e in fixtures.IN_PLACE if warehouse.store.exists(f"raw_{e}")]
    landed = Warehouse(TableStore(spark, str(tmp_path / "landed")), fixtures.raw_tables(spark, small))
    assert as_set(landed.clean("Customer")) == as_set(w.clean("Customer")) and landed.store.exists("raw_Customer")


def test_few_versions_are_not_laid_out_over_months(spark):
    """A version that holds for centuries is one row, not one a month; members with many versions are still told apart."""
    days = spark.sql("SELECT explode(sequence(to_date('2024-01-01'), to_date('2024-06-30'))) AS ValidFrom")
    many = days.selectExpr("1 as k", "ValidFrom", "date_add(ValidFrom, 1) as ValidTo", "datediff(ValidFrom, '2024-01-01') as v")
    few = spark.sql("SELECT 2 AS k, to_date('0001-01-01') AS ValidFrom, to_date(null) AS ValidTo, 900 AS v")
    spans = [(k, d) for k in (1, 2) for d in ("1000-01-01", "2024-01-01", "2024-03-01", "2024-07-01", "2500-01-01", None)]
    facts = spark.createDataFrame([*spans, (None, "2024-03-01"), (3, "2024-03-01")], "k int, d string")
    wanted = {(1, "2024-01-01"): 0, (1, "2024-03-01"): 60, **{(2, d): 900 for k, d in spans if k == 2 and d}}
    for versions in (few, many.unionByName(few)):
        found = D.valid_versions(facts, "k", F.to_date("d"), versions, "k", "v")
        rows, own = found.collect(), {r.k for r in versions.collect()}
        assert len(rows) == facts.count()
        assert all(r.v == (wanted.get((r.k, r.d)) if r.k in own else None) for r in rows)
    plan = D.valid_versions(facts, "k", F.to_date("d"), few, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_history_is_stored_and_facts_point_at_it(spark, small, tmp_path):
    raw = fixtures.raw_tables(spark, small)
    w = Warehouse(TableStore(spark, str(tmp_path / "history")), raw)
    w.load_history("2024-01-01")
    moved = F.when(F.col("accountid").cast("long") % 7 == 0, F.lit("1")).otherwise(F.col("regionid"))
    w.reload({**raw, "Customer": raw["Customer"].withColumn("regionid", moved)})
    day = w.table("FactSales").selectExpr("percentile_approx(OrderDateKey, 0.5)").first()[0]
    text = f"{day // 10000}-{day // 100 % 100:02d}-{day % 100:02d}"
    w.load_history(text)
    history = w.store.read("HistCustomer")
    changed = history.filter("IsCurrent = 0")
    assert changed.count() > 5 and history.filter("IsCurrent = 1").count() == w.table("DimCustomer").count()
    pointed = w.store.read("FactSalesVersions").join(w.table("FactSales"), "SalesKey")
    assert pointed.count() == w.table("FactSales").count()
    assert pointed.filter("CustomerVersion is null or SellerVersion is null or ProductVersion is null").isEmpty()
    joined = pointed.join(history.drop("CustomerKey"), pointed.CustomerVersion == history.VersionKey)
    on = F.to_date(F.col("OrderDateKey").cast("string"), "yyyyMMdd")
    assert joined.count() == pointed.count()
    assert joined.filter((on < F.col("ValidFrom")) | (on >= F.coalesce("ValidTo", F.lit("9999-01-01").cast("date")))).isEmpty()
    assert joined.filter("IsCurrent = 0").count() > 0
