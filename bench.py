"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs once to warm up and then ``BENCH_RUNS`` times; the best time counts. The
``baseline_`` queries repeat the published join figures on rows of the same
number and shape (2,000,000 generated facts, 5 branches).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from millrace.checks import QUERIES
from millrace.operators.joins import hinted_if_small
from millrace.session import build_session
from millrace.sources.readers import generated_facts
from millrace.sources.tables import Tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = (
    "daily_sales revenue_by_city monthly_revenue top_products running_spend customer_tier "
    "customer_summary dept_metrics risk_category three_reports group_multi sum_by_key agg_distinct "
    "pivot_month share_of_total join_inner join_left join_full join_broadcast range_modulo_join "
    "win_row_number win_lag running_total top_n_df latest_per_key dedupe_key word_count_clean "
    "top_words parse_rows booking_state stream_running_totals stream_sliding_sum stream_tumbling"
).split()


def baseline(spark):
    """The four published join figures as (name, action)."""
    branches = Tables(spark, FOLDER).region.select(
        F.col("r_regionkey").alias("branch_id"), F.col("r_name").alias("branch_name")
    )
    facts = generated_facts(spark, 2_000_000, 5)
    broadcast = facts.join(hinted_if_small(branches), "branch_id")
    merged = facts.join(branches.hint("merge"), "branch_id")

    def per_branch(joined):
        return joined.groupBy("branch_name").agg(F.sum("amount").alias("total")).collect()

    return {
        "baseline_broadcast_count": broadcast.count,
        "baseline_merge_count": merged.count,
        "baseline_broadcast_sum": lambda: per_branch(broadcast),
        "baseline_merge_sum": lambda: per_branch(merged),
    }


def best_time(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = build_session(
        "millrace-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.driver.host": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        return lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    actions = {name: run(name) for name in HEADLINES}
    actions.update(baseline(spark))
    seconds = {name: best_time(action) for name, action in actions.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
