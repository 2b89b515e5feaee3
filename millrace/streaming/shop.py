"""Order stream: revenue per category in event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.money import line_amount, total
from millrace.operators import joins
from millrace.streaming.windows import timed, windowed


def category_revenue(
    orders: DataFrame,
    products: DataFrame,
    time_column: str = "event_time",
    size: str = rules.TUMBLING_SIZE,
    watermark: str = rules.WATERMARK,
) -> DataFrame:
    """Revenue and orders per window and category; late orders are dropped."""
    sound = timed(orders, time_column, watermark).filter("qty > 0 AND price > 0 AND price < double('Infinity')")
    named = joins.look_up(sound, products.select("product_id", "category"), "product_id")
    revenue = line_amount("qty", "price")
    return windowed(
        named, [total(revenue).alias("revenue"), F.count("*").alias("orders")], ["category"], size
    )
