import datetime

import pytest
from pyspark.sql import functions as F

from basketry.functions import columns as K
from basketry.operators import cleaning as C
from basketry.operators import facts as X
from basketry.specs import CUSTOMER, SALES_LINE, UNKNOWN_KEY, Rule


def values(df, expression):
    return [r[0] for r in df.orderBy("_id").select(expression).collect()]


def texts(spark, *items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], "_id int, x string")


def test_whole_numbers_round_half_to_even_and_reject_infinity(spark):
    df = texts(spark, "2.5", "3.5", "-2.5", "inf", "nan", "x", None, "7")
    assert values(df, K.to_whole("x")) == [2, 4, -2, None, None, None, None, 7]


def test_decimal_comma(spark):
    df = texts(spark, "18,676", "18.674", "n/a", None, "-3", "1e2")
    found = [None if v is None else float(v) for v in values(df, K.to_money("x"))]
    assert found == [18.676, 18.674, None, None, -3.0, 100.0]


def test_dates(spark):
    df = texts(spark, "2024-02-29", "2024-13-45", None, "2024-01-02 10:11:12")
    assert values(df, K.to_day("x")) == [datetime.date(2024, 2, 29), None, None, datetime.date(2024, 1, 2)]


def test_text_is_stripped_of_all_white_space_and_cut(spark):
    df = texts(spark, "  ab\r\ncd\t", "a\nb", "abcdefgh", None)
    assert values(df, K.tidy_text("x", 5)) == ["ab cd", "a b", "abcde", None]


def test_codes_lose_leading_zeros(spark):
    assert values(texts(spark, "001", "102", "000", "0"), K.plain_code("x")) == ["1", "102", "0", "0"]


def test_client_names(spark):
    df = spark.createDataFrame([(0, "7", None), (1, "8", "  "), (2, "9", "Unknown"), (3, "1", "nan"), (4, "2", "Ann")], "_id int, a string, n string")
    assert values(df, K.client_name("a", "n")) == ["CLIENT_7", "CLIENT_8", "CLIENT_9", "CLIENT_1", "Ann"]


@pytest.mark.parametrize(
    ("rule", "kept"),
    [
        (Rule("x", ">", 1), ["2"]),
        (Rule("x", ">=", 1), ["1", "2"]),
        (Rule("x", "<", 2), ["1"]),
        (Rule("x", "!=", "1"), ["2", "z", None]),
        (Rule("x", "not_null"), ["1", "2", "z"]),
        (Rule("x", "~", 1), ["1", "2", "z", None]),
        (Rule("other", ">", 1), ["1", "2", "z", None]),
    ],
)
def test_rules_on_nulls_and_bad_values(spark, rule, kept):
    df = C.apply_rules(texts(spark, "1", "2", "z", None), [rule])
    assert values(df, F.col("x")) == kept


def lines(spark, rows):
    return spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)],
        "saleid string, itemid string, qty string, unitprice string, httotalamount string, ttctotalamount string,"
        " promotype string, promovalue string, _ord int",
    )


def test_line_counters_add_up(spark):
    header = spark.createDataFrame([("1",), ("2",)], "saleid string")
    product = spark.createDataFrame([("a",), (UNKNOWN_KEY,)], "itemid string")
    tail = ("1", "1", "2", "Gift", "3")
    raw = lines(
        spark,
        [
            ("1", "a", "5", *tail),
            ("1", "a", "6", *tail),
            (None, "a", "5", *tail),
            ("1", None, "5", *tail),
            ("2", "zz", "5", *tail),
            ("9", "a", "5", *tail),
            ("9", "zz", "5", *tail),
            ("2", "a", "0", *tail),
            (" 2 ", "a", "2", *tail),
        ],
    )
    cleaned = C.clean_sales_line(raw, header, product)
    counts = cleaned.counts.first().asDict()
    assert counts["raw_row_count"] == 9
    assert counts["null_key_dropped"] == 2 and counts["after_null_drop"] == 7
    assert counts["duplicates_removed"] == 1 and counts["after_dedup"] == 6
    assert counts["business_rule_violations"] == 1 and counts["after_business_rules"] == 5
    assert counts["ri_violations"] == 2 and counts["ri_mapped_to_unknown"] == 1
    assert counts["final_row_count"] == 3 == cleaned.rows.count()
    rows = {(r.saleid, r.itemid): r.qty for r in cleaned.rows.collect()}
    assert rows == {("1", "a"): 5, ("2", UNKNOWN_KEY): 5, ("2", "a"): 2}


def test_empty_parent_drops_all_lines(spark):
    header = spark.createDataFrame([], "saleid string")
    product = spark.createDataFrame([("a",)], "itemid string")
    raw = lines(spark, [("1", "a", "5", "1", "1", "2", "Gift", "3")])
    assert C.clean_sales_line(raw, header, product).rows.count() == 0


def test_orphans_are_dropped_without_the_unknown_member(spark):
    header = spark.createDataFrame([("1",)], "saleid string")
    raw = spark.createDataFrame([("i", "1", "2", "001", 0), ("j", "5", "2", "001", 1)], "invoiceid string, salesid string, paymentamount string, paymentmethod string, _ord int")
    kept = C.clean_invoice(raw, header, use_unknown=False)
    assert [r.invoiceid for r in kept.rows.collect()] == ["i"]
    mapped = C.clean_invoice(raw, header)
    assert {r.invoiceid: r.salesid for r in mapped.rows.collect()} == {"i": "1", "j": UNKNOWN_KEY}
    assert kept.counts.first().ri_violations == 1 == mapped.counts.first().ri_mapped_to_unknown


@pytest.mark.parametrize("keep", [C.keep_first, C.keep_first_of_few])
def test_first_row_in_file_order_wins_even_for_one_hot_key(spark, keep):
    hot = spark.range(3000).select(F.lit("k").alias("key"), (3000 - F.col("id")).alias("_ord"), F.col("id").alias("v"))
    rest = spark.range(3000).select(F.col("id").cast("string").alias("key"), F.col("id").alias("_ord"), F.col("id").alias("v"))
    kept = keep(hot.unionByName(rest), ["key"]).filter("key = 'k'").collect()
    assert [(r.v, r[C.COPIES]) for r in kept] == [(2999, 3000)]


def test_only_rows_that_may_share_a_hash_are_twins(spark, monkeypatch):
    """Copies are one row; rows whose keys share a hash stay two rows, told as twins, and get two fact keys."""
    columns = "saleid string, itemid string, qty string, _ord int"
    raw = spark.createDataFrame([("1", "a", "5", 0), ("1", "a", "6", 1), ("1", "b", "7", 2), ("2", "c", "8", 3), (None, "c", "9", 4), (None, "c", "9", 5)], columns)
    rows = lambda: sorted((r.saleid or "", r.itemid, r.qty, r[C.COPIES], r[C.TWIN]) for r in C.keep_first_of_few(raw, ["saleid", "itemid"]).collect())
    assert rows() == [("", "c", "9", 1, False), ("", "c", "9", 1, False), ("1", "a", "5", 2, True), ("1", "b", "7", 1, False), ("2", "c", "8", 1, False)]
    monkeypatch.setattr(C.F, "xxhash64", lambda *keys: F.length(C.F.col("saleid")).cast("long"))
    assert rows() == [("", "c", "9", 1, False), ("", "c", "9", 1, False), ("1", "a", "5", 2, True), ("1", "b", "7", 1, True), ("2", "c", "8", 1, True)]


def test_clean_rows_tell_which_may_share_a_hash(spark, warehouse):
    """So that the keys of the facts are not counted once more."""
    lines = warehouse.clean("SalesLine")
    shared = lines.groupBy(C.ROW).count().filter("count > 1").select(C.ROW)
    assert C.TWIN in lines.columns and lines.filter(~F.col(C.TWIN)).join(shared, C.ROW).isEmpty()
    assert 0 < lines.filter(C.TWIN).count() < lines.count()


def test_unknown_member_only_joins_filled_dimensions(spark):
    schema = "accountid string, accountname string, regionid string, sectorid string, _ord int"
    empty = C.with_unknown_member(spark.createDataFrame([], schema), "accountid")
    assert empty.count() == 0
    one = C.with_unknown_member(spark.createDataFrame([("1", None, None, None, 0)], schema), "accountid")
    member = one.filter(F.col("accountid") == UNKNOWN_KEY).first()
    assert member.accountname == "Unknown" and member._ord is None
    assert C.with_unknown_member(one, "accountid").count() == 2


def test_padded_keys_survive_the_cleaner_as_two_rows(spark):
    raw = spark.createDataFrame([(" A", "x", None, None, 0), ("A", "y", None, None, 1)], "accountid string, accountname string, regionid string, sectorid string, _ord int")
    rows = C.clean_dimension(raw, CUSTOMER, add_unknown=False).rows
    assert [r.accountid for r in rows.collect()] == ["A", "A"]


def test_null_counts_see_nulls(spark):
    raw = spark.createDataFrame([("1", None, "r", None, 0)], "accountid string, accountname string, regionid string, sectorid string, _ord int")
    rows = C.clean_dimension(raw, CUSTOMER, add_unknown=False).rows
    assert {r.column: r.nulls for r in C.null_counts(rows, CUSTOMER).collect()} == {"accountid": 0, "accountname": 1, "regionid": 0, "sectorid": 1}


def test_line_rule_is_declared():
    assert SALES_LINE.rules == (Rule("qty", ">", 0),)


def test_amounts_keep_their_digits_until_the_facts(spark):
    """The difference of two amounts is rounded, not the amounts."""
    raw = spark.createDataFrame([("1", "a", "1", "3,005", "5,002", "10,006", "Gift", "0,125")], "saleid string, itemid string, qty string, unitprice string, httotalamount string, ttctotalamount string, promotype string, promovalue string")
    typed = C.cast_entity(raw, SALES_LINE)
    assert float(typed.first().ttctotalamount) == 10.006 and float(typed.first().promovalue) == 0.125
    measures = X.line_measures(typed).first()
    assert [str(measures[c]) for c in ("UnitPrice", "LineBruteAmount", "LineTaxAmount", "LineTotalAmount")] == ["3.01", "5.00", "5.00", "10.01"]
    sales = spark.createDataFrame([("1", 20240101, 20240102, 1, 1, 0, 0, 0, 0)], "saleid string, OrderDateKey int, DeliveryDateKey int, CustomerKey int, SellerKey int, HeaderBruteAmount int, HeaderNetAmount int, HeaderTaxAmount int, HeaderTotalAmount int")
    fact = X.fact_sales(sales, typed, spark.createDataFrame([("a", 1)], "ItemID string, ProductKey int"), spark.createDataFrame([("Gift", 1)], "PromoType string, PromotionKey int"))
    assert str(fact.first().LineTaxAmount) == "5.00" and dict(fact.dtypes)["LineTaxAmount"] == "decimal(18,2)"


def many_lines(spark):
    """Lines of 3,000 sales and 50 items, every seventh sale without header, item 7 unknown, with copies and null keys."""
    n = F.col("id")
    sale = F.when(n % 499 != 0, F.concat(F.lit(" "), (n % 3000).cast("string")))
    rest = [F.lit(v).alias(c) for c, v in {"qty": "1", "unitprice": "1", "httotalamount": "1", "ttctotalamount": "2", "promotype": "Gift", "promovalue": "3"}.items()]
    raw = spark.range(0, 12000, 1, 4).select(sale.alias("saleid"), F.when(n % 501 != 0, F.concat(F.lit("i"), (n % 50).cast("string"))).alias("itemid"), *rest, n.alias("_ord"))
    header = spark.range(3000).filter("id % 7 <> 0").select(F.col("id").cast("string").alias("saleid"))
    product = spark.range(50).filter("id <> 7").select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("itemid"))
    return raw, header, product


def test_many_orphans_are_flagged_as_few_are(spark, monkeypatch):
    raw, header, product = many_lines(spark)
    flagged = lambda: sorted(map(str, C.clean_sales_line(raw, header, product).flagged.select("saleid", "itemid", "_ord", C.COPIES, "_orphan_saleid", "_orphan_itemid").collect()))
    few = flagged()
    assert sum("_orphan_saleid=True" in r for r in few) > 400 and sum("_orphan_itemid=True" in r for r in few) > 50
    monkeypatch.setattr(C, "FEW_ORPHANS", 0)
    assert flagged() == few
    monkeypatch.setattr(C, "SIEVE_WORDS", 1)  # nearly every row is suspected
    assert flagged() == few


def test_rows_without_orphans_stay_in_place(spark):
    """Without broadcasts by size the rows that have no orphan for sure are told without a shuffle of them."""
    raw, header, _ = many_lines(spark)
    orphans = C.orphan_keys(raw, C.ForeignKey("saleid", header, "saleid"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sure, rest = C.sift(raw, [("saleid", orphans)])
        plan = sure._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    lost = {r[0] for r in orphans.collect()}
    assert not lost & {(r[0] or "").strip() for r in sure.select("saleid").collect()}
    assert sure.count() + rest.count() == raw.count() and rest.count() < 1.05 * raw.filter(F.trim("saleid").isin(lost)).count()


def test_hash_of_the_keys_is_stored_only_where_they_changed(spark):
    raw, header, product = many_lines(spark)
    cleaned = C.clean_sales_line(raw.withColumn("saleid", F.trim("saleid")), header, product)
    marked = cleaned.marked
    assert marked.filter(f"{C.ROW} IS NULL").count() > 0.9 * marked.count()
    assert marked.filter(f"{C.ROW} IS NULL AND _orphan_itemid AND itemid IS NOT NULL AND itemid <> '{UNKNOWN_KEY}'").isEmpty()
    of = lambda df: sorted((r.saleid, r.itemid, r[C.ROW]) for r in df.collect())
    assert of(cleaned.of_marked(marked)) == of(cleaned.rows)
