import glob

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import aggregates, layout, quality
from millrace.plans import shop
from millrace.sinks import writers
from millrace.sources import readers
from tests import fixtures


def test_text_csv_json(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\nfour\n")
    assert [r.value for r in readers.read_lines(spark, str(tmp_path / "a.txt")).collect()] == ["one", "two", "", "four"]

    customers = spark.createDataFrame(fixtures.CUSTOMERS, schemas.CUSTOMERS)
    path = str(tmp_path / "customers")
    writers.write_csv(customers, path)
    declared = readers.read_csv(spark, path, schemas.CUSTOMERS)
    assert quality.same_contract(declared, schemas.CUSTOMERS)
    assert sorted(declared.collect()) == sorted(customers.collect())
    assert dict(readers.read_csv_inferred(spark, path).dtypes)["age"] == "int"
    assert {kind for _, kind in readers.read_csv_text(spark, path).dtypes} == {"string"}

    orders = spark.createDataFrame(fixtures.ORDERS, schemas.ORDERS_JSON)
    orders.write.json(str(tmp_path / "orders"))
    back = readers.read_json_lines(spark, str(tmp_path / "orders"), schemas.ORDERS_JSON)
    assert sorted(back.collect()) == sorted(orders.collect())


def test_unreadable_csv_field_becomes_null(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,name,dept,gender,salary\n1,Asha,HR,F,12\n2,Ravi,HR,M,lots\n")
    rows = readers.read_csv(spark, str(tmp_path / "s.csv"), schemas.STAFF).orderBy("id").collect()
    assert [r.salary for r in rows] == [12, None]


def test_views_and_memory_rows(spark):
    readers.as_views(branch_list=readers.rows(spark, fixtures.BRANCH_RISK, schemas.BRANCH_RISK))
    assert spark.sql("SELECT count(*) AS n FROM branch_list WHERE risk_level = 'HIGH'").first().n == 1


def test_generated_facts_are_repeatable(spark):
    first, second = readers.generated_facts(spark, 1000, 5), readers.generated_facts(spark, 1000, 5)
    assert first.exceptAll(second).count() == 0
    assert {r["count"] for r in first.groupBy("branch_id").count().collect()} == {200}


def test_report_is_one_file_only_on_request(spark, tmp_path):
    frame = spark.range(0, 100, 1, 4)
    writers.write_report(frame, str(tmp_path / "small"), single_file=True)
    writers.write_report(frame, str(tmp_path / "large"))
    assert len(glob.glob(f"{tmp_path}/small/*.csv")) == 1
    assert len(glob.glob(f"{tmp_path}/large/*.csv")) == 4
    assert spark.read.csv(f"{tmp_path}/large", header=True).count() == 100


def test_partitioned_write_is_pruned_on_read(spark, tmp_path):
    frame = spark.range(1000).select(
        "id", (2020 + F.col("id") % 3).alias("year"), (1 + F.col("id") % 12).alias("month")
    )
    writers.write_partitioned(frame, str(tmp_path), ["year", "month"])
    read = readers.read_parquet(spark, str(tmp_path), F.col("year") == 2021, F.col("month") == 5)
    assert read.count() == frame.filter("year = 2021 AND month = 5").count() > 0
    plan = layout.plan_text(read)
    assert "PartitionFilters: [isnotnull(year" in plan


def test_partition_counts(spark):
    frame = spark.range(0, 1000, 1, 8)
    assert layout.spread_evenly(frame, 12).rdd.getNumPartitions() == 12
    assert layout.shrink(frame, 3).rdd.getNumPartitions() == 3
    assert layout.shrink(frame, 30).rdd.getNumPartitions() == 8
    keyed = layout.spread_by(frame.withColumn("k", F.col("id") % 4), "k", partitions=6)
    assert keyed.select("k", F.spark_partition_id().alias("p")).distinct().count() == 4
    assert sum(r.n for r in aggregates.rows_per_partition(frame).collect()) == 1000


def test_reuse_is_released(spark):
    frame = spark.range(100)
    with layout.reused(frame) as kept:
        assert kept.count() == 100
        assert kept.is_cached
        assert "InMemoryTableScan" in layout.plan_text(kept.filter("id > 5"))
    assert not frame.is_cached


def test_written_frame_reads_back(spark):
    frame = spark.range(10).withColumn("k", F.col("id") % 2)
    assert sorted(layout.written(frame, "t", ("k",)).select("id", "k").collect()) == sorted(frame.collect())


def test_collected_chunks_hold_everything_and_stay_small(spark):
    frame = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9).alias("k"))
    chunks = aggregates.collect_in_chunks(frame, ["k"], "id", "id", chunk_size=100).collect()
    assert max(len(r.collected) for r in chunks) <= 100
    assert sum(len(r.collected) for r in chunks) == 5000
    assert all(list(r.collected) == sorted(r.collected) for r in chunks)


def test_shop_job(spark, tmp_path):
    lines = spark.createDataFrame(
        [
            ("O1,C1,P1,2,10.0,2025-01-01,delivered",),
            ("O2,C1,P2,1,5.0,2025-01-01,delivered",),
            ("O3,C2,P1,1,10.0,2025-02-01,delivered",),
            ("O4,C2,P1,1,10.0,2025-02-01,cancelled",),
            ("oops",),
        ],
        schemas.LINES,
    )
    products = spark.createDataFrame([("P1", "pen", "office"), ("P2", "mug", "home")], schemas.SHOP_PRODUCTS)
    customers = spark.createDataFrame([("C1", " india "), ("C2", "nepal")], schemas.SHOP_CUSTOMERS)
    assert shop.run(spark, lines, products, customers, str(tmp_path)) == {"total": 5, "bad": 1, "cancelled": 1}
    months = spark.read.parquet(f"{tmp_path}/monthly_revenue")
    assert {(r.order_month, r.category): r.revenue for r in months.collect()} == {
        ("2025-01", "office"): 20.0, ("2025-01", "home"): 5.0, ("2025-02", "office"): 10.0,
    }
    tiers = spark.read.csv(f"{tmp_path}/customer_tiers", header=True)
    assert {r.customer_id: r.tier for r in tiers.collect()} == {"C1": "BRONZE", "C2": "BRONZE"}
    orders, *_ = shop.clean_orders(lines)
    enriched = shop.enriched_orders(orders, products, customers)
    spend = {r.order_id: float(r.running_spend) for r in shop.running_spend(enriched).collect()}
    assert spend == {"O1": 20.0, "O2": 25.0, "O3": 10.0}
    assert {r.country for r in enriched.collect()} == {"INDIA", "NEPAL"}
