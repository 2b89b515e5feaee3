import pytest
from pyspark.sql import functions as F, types as T

from millrace import schemas
from millrace.functions import bands, text
from millrace.operators import quality
from millrace.plans import reports, shop
from millrace.streaming import accounts, bookings, vitals
from tests import fixtures


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_amount_defects(spark):
    feed = lines(spark, *(f"A1 deposit {a}" for a in ("NaN", "-1", "0", "abc", "5d", "")), "A1 5", "A 1 2 3", "")
    kept = accounts.parse(feed, accounts.ACCOUNT_LINE).collect()
    assert [(r.account, r.kind, r.amount) for r in kept] == [("A1", "DEPOSIT", 5.0)]


def test_other_columns_survive_parsing(spark):
    feed = spark.createDataFrame([(1, "T1, A1, B1, credit, 10"), (2, "bad")], "id int, value string")
    parsed = quality.parse_delimited(feed, accounts.BANK_LINE)
    assert [(r.id, r.is_valid) for r in parsed.orderBy("id").collect()] == [(1, True), (2, False)]
    assert parsed.filter("id = 1").first().kind == "CREDIT"


def test_transaction_lines_keep_six_of_ten(spark):
    feed = lines(
        spark,
        "1,ann,food,10", "2,bob,food,20.5", "3,ann,toys,5", "bad line", "4,bob,toys,-3",
        "5,,food,7", "6,cat,toys,abc", "7,cat,food,1", "8,dan,toys,2", "9,dan,toys,3",
    )
    made = reports.transaction_reports(feed)
    assert made["valid"].count() == 6
    assert {r.category: r.total for r in made["by_category"].collect()} == {"food": 31.5, "toys": 10.0}
    assert [r.customer for r in made["top_customers"].collect()] == ["bob", "ann", "dan"]
    assert made["average"].first().average == 41.5 / 6


def test_order_lines_and_counters(spark):
    feed = lines(
        spark,
        "O1,C1,P1,2,10.0,2025-01-01,Delivered",
        "O1,C1,P1,2,10.0,2025-01-01,Delivered",
        "O2,C1,P1,2,10.0,2025-01-01, CANCELLED ",
        ",C1,P1,2,10.0,2025-01-01,new",
        "O3,C1,P1,-2,10.0,2025-01-01,new",
        "O4,C1,P1,2,x,2025-01-01,new",
        "O5,C1,P1,2,10.0,2025-01-01",
        "O6,C1,P1,1.5,10.0,2025-01-01,new",
    )
    orders, seen, dropped = shop.clean_orders(feed)
    assert [r.order_id for r in orders.collect()] == ["O1"]
    assert seen.get == {"total": 8, "bad": 5}
    assert dropped.get == {"cancelled": 1}


def test_vitals(spark):
    feed = lines(spark, "p1,130,95,100,98.6", "p1,70,95,150,101", "p2,50,92,140,100.4", ",1,1,1,1", "p3,x,95,100,98")
    parsed, seen = quality.counted(
        vitals.readings(feed), "vitals", total=F.count("*"), invalid=F.count_if(~F.col("is_valid"))
    )
    found = vitals.alerts(quality.valid_only(parsed)).collect()
    assert sorted((r.patient_id, r.reasons) for r in found) == [("p1", "BP=150, Temp=101.0"), ("p1", "HeartRate=130")]
    assert seen.get == {"total": 5, "invalid": 2}


def test_booking_lines(spark):
    feed = lines(spark, "b1,hotel,H01,book,2", "b2,hotel,H01,hold,2", "b3,hotel,H01,cancel,0", "b4,bus,X99,BOOK,1")
    inventory = spark.createDataFrame(fixtures.INVENTORY, schemas.INVENTORY)
    kept = bookings.known_items(bookings.parse(feed), inventory).collect()
    assert [(r.booking_id, r.action) for r in kept] == [("b1", "BOOK")]


def test_range_rule_keeps_the_row_once(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (None, 9.0)], "a double, b double")
    found = frame.select(quality.out_of_range((("a", 0, 5, "A"), ("b", 0, 5, "B"))).alias("f")).collect()
    assert [r.f for r in found] == [[], ["B=9.0"]]


def test_native_band_equals_vectorised_twin(spark):
    salaries = spark.range(0, 150000, 500).select(F.col("id").cast("double").alias("salary"))
    both = salaries.select(
        bands.salary_band(F.col("salary")).alias("a"), bands.salary_band_udf("salary").alias("b")
    )
    assert quality.differing_rows(both, "a", "b") == 0
    money = salaries.select("salary", (F.col("salary") % 45000).alias("top"), (F.col("salary") % 12).cast("long").alias("n"))
    risks = money.select(
        bands.risk_category(F.col("salary"), F.col("top"), F.col("n")).alias("a"),
        bands.risk_category_udf("salary", "top", "n").alias("b"),
    )
    assert quality.differing_rows(risks, "a", "b") == 0
    assert {r.a for r in risks.distinct().collect()} == {"HIGH", "MEDIUM", "LOW"}


def test_functions_in_the_catalog(spark):
    bands.register_band_functions(spark)
    assert spark.catalog.functionExists("salary_band")
    assert spark.sql("SELECT salary_band(60000D) AS b").first().b == "MEDIUM"


def test_tier_limits_are_parameters(spark):
    spend = spark.createDataFrame([(5.0,), (50.0,), (500.0,)], "spend double")
    tier = bands.customer_tier(F.col("spend"), ((400, "GOLD"), (40, "SILVER")))
    assert [r.t for r in spend.orderBy("spend").select(tier.alias("t")).collect()] == ["BRONZE", "SILVER", "GOLD"]


def test_contract(spark):
    frame = spark.createDataFrame(fixtures.CUSTOMERS, schemas.CUSTOMERS)
    assert quality.same_contract(frame, schemas.CUSTOMERS)
    assert not quality.same_contract(frame.withColumn("age", F.col("age").cast("long")), schemas.CUSTOMERS)


def test_log_lines(spark):
    feed = lines(spark, "ERROR disk full", "INFO ok", "ERRORS none", "WARN low")
    assert reports.error_lines(feed).count() == 2
    assert {r.level: r.n for r in reports.level_counts(feed).collect()} == {"ERROR": 1, "INFO": 1, "ERRORS": 1, "WARN": 1}
    fields = lines(spark, "2025-01-01  10:00:00 ERROR  disk is full", "short").select(*text.log_fields(F.col("value")))
    assert tuple(fields.collect()[0]) == ("2025-01-01", "10:00:00", "ERROR", "disk is full")
    assert tuple(fields.collect()[1]) == ("short", None, None, None)


def test_words(spark):
    feed = spark.createDataFrame([("Error: disk, DISK  full!",), ("--",)], "text string")
    assert {r.word: r.n for r in text.word_counts(feed, clean=True).collect()} == {"error": 1, "disk": 2, "full": 1}
    assert text.word_counts(feed).count() == 5
    assert isinstance(text.word_counts(feed).schema["n"].dataType, T.LongType)


def test_exact_totals_match_decimal_sums(spark):
    from millrace.functions import money

    frame = spark.range(20000).select(
        (F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 11 > 0, (F.xxhash64("id") % 10**9) / 100.0).alias("x"),
        ((F.col("id") % 11) / 100.0).alias("d"),
    )
    x, d = F.col("x").cast("decimal(18,2)"), F.col("d").cast("decimal(6,4)")
    both = frame.groupBy("k").agg(
        money.exact_total("x", 2).cast("double").alias("a"),
        F.sum(x).cast("double").alias("b"),
        money.discounted_total("x", "d").alias("c"),
        F.sum(x * (1 - d)).cast("double").alias("e"),
    )
    assert both.filter("a != b OR c != e OR a IS NULL OR c IS NULL").count() == 0
    nothing = frame.filter("x IS NULL").agg(money.total("x").alias("a")).first()
    assert nothing.a is None
    huge = spark.range(4).select(F.lit(9.0e15).alias("x"))
    assert huge.agg(money.exact_total("x", 2).alias("a")).first().a == 36 * 10**15


def test_amounts_are_never_rounded_away(spark):
    from pyspark.errors import PySparkException

    from millrace.functions import money

    def totals(*values):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        return frame.agg(money.total("x").alias("a")).first().a

    def declared(*values, **scale):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        return frame.agg(money.exact_total("x", **scale).alias("a")).first().a

    assert totals(0.125, 0.004, None) == 0.129
    assert totals(1e9, 0.000001) == 1000000000.000001
    assert totals(1.0, float("inf")) == float("inf")
    assert totals(1.0, float("nan")) != totals(1.0, float("nan"))
    assert totals(float("inf"), float("-inf")) != 0
    for values, scale in (((0.1234567,), {}), ((0.125,), {"scale": 2})):
        assert totals(*values) == values[0]
        with pytest.raises(PySparkException):
            declared(*values, **scale)
    row = spark.range(1).select(money.line_amount(F.lit(3), F.lit(0.125)).alias("a"), money.money(F.lit(0.125)).alias("b")).first()
    assert row.a == 0.375 and float(row.b) == 0.125
    with pytest.raises(PySparkException):
        spark.range(1).select(money.price(F.lit(0.125))).collect()


def test_nothing_to_divide_by(spark):
    from millrace.operators import aggregates
    from millrace.plans import people, reports

    cancels_out = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "k string, x double")
    shares = aggregates.share_of_total(cancels_out, ["k"], F.col("x")).collect()
    assert {(r.k, r.total, r.share_pct) for r in shares} == {("a", 1.0, None), ("b", -1.0, None)}
    bills = spark.createDataFrame([(None, "x", 1, 1, 5.0)], "bill_id long, department string, month int, patients int, amount double")
    row = people.department_metrics(bills).first()
    assert row.avg_bill is None and row.share_pct == 100.0
    items = spark.createDataFrame([("1", "n", "t", 0)], "item_id string, item_name string, item_type string, capacity int")
    state = spark.createDataFrame([("b", "1", 2, "BOOKED")], "booking_id string, item_id string, seats int, status string")
    assert reports.occupancy(items, state).first().occupancy_pct is None
    ids = spark.createDataFrame([("k", 2**53 + 1), ("k", 2**53)], "k string, v long")
    chunks = aggregates.collect_in_chunks(ids, ["k"], "v", "v", 1)
    assert sorted(r.chunk for r in chunks.collect()) == [2**53, 2**53 + 1]


def test_infinite_numbers_are_bad_lines(spark):
    from millrace.plans import reports

    lines = spark.createDataFrame([("1,a,x,Infinity",), ("2,a,x,-Infinity",), ("3,a,x,NaN",), ("4,a,x,2.5",)], "value string")
    parsed = reports.transaction_reports(lines)
    assert [r.total for r in parsed["by_category"].collect()] == [2.5]
