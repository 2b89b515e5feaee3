"""Projections, filters, predicates, scalar functions, sets."""

from pyspark.sql import functions as F

from millrace.checks.registry import check
from millrace.functions import bands, rules
from millrace.functions.money import price, rate, total
from millrace.operators import aggregates, joins, quality, sets


@check(
    "project_tax",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1.18 AS DECIMAL(6,4)) AS DOUBLE) AS with_tax
    FROM lineitem""",
)
def project_tax(t):
    taxed = price("l_extendedprice") * rate(F.lit("1.18"))
    return t.lineitem.select("l_orderkey", "l_linenumber", taxed.alias("with_tax"))


@check(
    "filter_chain",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity * 10 AS tenfold
    FROM lineitem WHERE l_quantity % 2 = 0 AND l_extendedprice > 1000 AND l_quantity * 10 > 50""",
)
def filter_chain(t):
    even = t.lineitem.filter(F.col("l_quantity") % 2 == 0).filter("l_extendedprice > 1000")
    tenfold = even.withColumn("tenfold", F.col("l_quantity") * 10).filter("tenfold > 50")
    return tenfold.select("l_orderkey", "l_linenumber", "tenfold")


@check(
    "filter_and",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'F'",
)
def filter_and(t):
    dear = (F.col("o_totalprice") > 300000) & (F.col("o_orderstatus") == "F")
    return t.orders.filter(dear).select("o_orderkey", "o_totalprice")


@check(
    "select_alias",
    "SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment FROM customer",
)
def select_alias(t):
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )


@check(
    "derived_columns",
    f"""
    WITH exact AS (
      SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
             round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST({rules.GST_RATE} AS DECIMAL(6,4)), 2) AS gst
      FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(gst AS DOUBLE) AS gst, CAST(amount + gst AS DOUBLE) AS total
    FROM exact""",
)
def derived_columns(t):
    amount = price("l_extendedprice")
    return (
        t.lineitem.withColumn("gst", F.round(amount * rate(F.lit(rules.GST_RATE)), 2))
        .withColumn("total", amount + F.col("gst"))
        .select("l_orderkey", "l_linenumber", "gst", "total")
    )


@check(
    "case_band",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'HIGH'
                            WHEN o_totalprice >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS band
    FROM orders""",
)
def case_band(t):
    steps = ((300000, "HIGH"), (100000, "MEDIUM"))
    return t.orders.select("o_orderkey", bands.band(F.col("o_totalprice"), steps, "LOW").alias("band"))


@check(
    "amount_band",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE WHEN l_extendedprice / l_quantity >= 1000 THEN 'HIGH'
                WHEN l_extendedprice / l_quantity >= 300 THEN 'MEDIUM' ELSE 'LOW' END AS order_size,
           CASE WHEN l_quantity < 30 THEN 'Young' ELSE 'Adult' END AS age_group
    FROM lineitem""",
)
def amount_band(t):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        bands.amount_band(unit).alias("order_size"),
        bands.age_group(F.col("l_quantity")).alias("age_group"),
    )


@check(
    "na_fill",
    """
    SELECT d.doc_id, CAST(coalesce(l.quality, 0) AS BIGINT) AS quality,
           CAST(coalesce(l.toxic, -1) AS BIGINT) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def na_fill(t):
    labelled = joins.enrich(t.documents.select("doc_id"), t.labels, "doc_id")
    return labelled.na.fill({"quality": 0, "toxic": -1})


@check(
    "flatmap_explode",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, v AS value
    FROM (SELECT l_orderkey, l_linenumber, unnest([l_quantity, l_quantity * 100]) AS v FROM lineitem)""",
)
def flatmap_explode(t):
    both = F.array(F.col("l_quantity"), F.col("l_quantity") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.explode(both).alias("value"))


_RANGES = (
    ("l_quantity", 5.0, 45.0, "Quantity"),
    ("l_discount", 0.01, 0.09, "Discount"),
    ("l_tax", 0.01, 0.07, "Tax"),
    ("l_extendedprice", 2000.0, 90000.0, "Price"),
)


@check(
    "range_rules",
    """
    WITH judged AS (
      SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(', ',
        CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 'Quantity=' || CAST(l_quantity AS VARCHAR) END,
        CASE WHEN l_discount < 0.01 OR l_discount > 0.09 THEN 'Discount=' || CAST(l_discount AS VARCHAR) END,
        CASE WHEN l_tax < 0.01 OR l_tax > 0.07 THEN 'Tax=' || CAST(l_tax AS VARCHAR) END,
        CASE WHEN l_extendedprice < 2000 OR l_extendedprice > 90000
             THEN 'Price=' || CAST(l_extendedprice AS VARCHAR) END) AS reasons
      FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, reasons
    FROM judged WHERE reasons <> ''""",
)
def range_rules(t):
    judged = t.lineitem.withColumn("found", quality.out_of_range(_RANGES))
    return judged.filter(F.size("found") > 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.array_join("found", ", ").alias("reasons")
    )


@check(
    "zip_arrays",
    """
    SELECT vec_id, CAST(i - 1 AS BIGINT) AS pos, CAST(embedding[i] AS DOUBLE) AS a,
           CAST(embedding[i + len(embedding) // 2] AS DOUBLE) AS b
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) // 2 + 1)) AS i FROM embeddings)""",
)
def zip_arrays(t):
    half = F.expr("cast(size(embedding) div 2 as int)")
    halves = F.arrays_zip(
        F.slice("embedding", 1, half).alias("a"), F.slice("embedding", half + 1, half).alias("b")
    )
    pairs = t.embeddings.select("vec_id", F.posexplode(halves).alias("pos", "pair"))
    return pairs.select("vec_id", "pos", "pair.a", "pair.b")


@check(
    "date_parts",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
           year(o_orderdate) AS y, month(o_orderdate) AS m, strftime(o_orderdate, '%Y-%m') AS ym
    FROM orders""",
)
def date_parts(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        day.alias("order_date"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.date_format(day, "yyyy-MM").alias("ym"),
    )


@check(
    "array_mean",
    """
    SELECT vec_id, CAST(label AS BIGINT) AS label,
           list_sum([CAST(x AS DOUBLE) FOR x IN embedding]) / len(embedding) AS mean_value
    FROM embeddings""",
)
def array_mean(t):
    mean = aggregates.array_mean(F.col("embedding")).alias("mean_value")
    return t.embeddings.select("vec_id", "label", mean)


@check(
    "union_all",
    """
    SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer
    UNION ALL SELECT s_name, CAST(s_nationkey AS BIGINT) FROM supplier""",
)
def union_all(t):
    return sets.append(
        t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
        t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")),
    )


@check(
    "union_distinct",
    """
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
    UNION SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) FROM lineitem""",
)
def union_distinct(t):
    return sets.append_distinct(
        t.orders.select(F.col("o_orderdate").cast("date").alias("day")),
        t.lineitem.select(F.col("l_shipdate").cast("date").alias("day")),
    )


_LINE_COLUMNS = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


@check(
    "dedupe_key",
    f"""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
           l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {", ".join(_LINE_COLUMNS)}) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def dedupe_key(t):
    unique = sets.one_per_key(
        t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c).asc() for c in _LINE_COLUMNS]
    )
    return unique.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@check(
    "salary_band",
    """
    SELECT c_custkey, CASE WHEN c_acctbal * 12 >= 100000 THEN 'HIGH'
                           WHEN c_acctbal * 12 >= 50000 THEN 'MEDIUM' ELSE 'LOW' END AS band
    FROM customer""",
)
def salary_band(t):
    return t.customer.select("c_custkey", bands.salary_band(F.col("c_acctbal") * 12).alias("band"))


@check(
    "salary_band_udf",
    """
    SELECT CASE WHEN c_acctbal * 12 >= 100000 THEN 'HIGH'
                WHEN c_acctbal * 12 >= 50000 THEN 'MEDIUM' ELSE 'LOW' END AS band,
           count(*) AS n
    FROM customer GROUP BY 1""",
)
def salary_band_udf(t):
    bands.register_band_functions(t.spark)
    return t.spark.sql(
        "SELECT salary_band(c_acctbal * 12) AS band, count(*) AS n FROM {customer} GROUP BY 1",
        customer=t.customer,
    )


@check(
    "money_sum",
    """
    SELECT o_orderpriority, exact_sum(o_totalprice) AS total
    FROM orders GROUP BY 1""",
)
def money_sum(t):
    return t.orders.groupBy("o_orderpriority").agg(
        total("o_totalprice").alias("total")
    )
