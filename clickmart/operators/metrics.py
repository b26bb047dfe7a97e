"""Hourly sales metrics: one function for batch and stream.

Per tumbling 1-hour event-time window:
  visitors  = rows with a uid (rows, not distinct people)
  revenue   = sum of item_price over buys
  purchases = number of buys
  aov       = revenue / purchases
Sums over no matching row are NULL (not 0), so an hour without a buy has
NULL revenue, purchases and aov. The aggregate is partial per task before
the shuffle; state (in a stream) is keyed by window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import columns as C

# Fixed value: the tumbling window length.
WINDOW = "1 hour"


def hourly_metrics(events: DataFrame, watermark: str | None = None, window: str = WINDOW) -> DataFrame:
    """``start_ts, end_ts, revenue, visitors, purchases, aov``.

    ``events`` has ``event_type, item_price, uid, timestamp`` (epoch ms).
    ``watermark`` (off by default) bounds stream state; with it, rows later
    than the bound are dropped, which changes results, so it is opt-in.
    """
    df = events.select(
        "event_type", "item_price", "uid", C.millis_to_ts("timestamp").alias("event_time")
    )
    if watermark:
        df = df.withWatermark("event_time", watermark)
    buy = F.col("event_type") == "buy"
    agg = df.groupBy(F.window("event_time", window).alias("ts")).agg(
        F.sum(F.when(F.col("uid").isNotNull(), F.lit(1))).alias("visitors"),
        F.sum(F.when(buy, F.col("item_price"))).alias("revenue"),
        F.sum(F.when(buy, F.lit(1))).alias("purchases"),
    )
    return agg.select(
        F.unix_timestamp(F.col("ts.start")).alias("start_ts"),
        F.unix_timestamp(F.col("ts.end")).alias("end_ts"),
        F.col("revenue").cast("long").alias("revenue"),
        F.col("visitors").cast("long").alias("visitors"),
        F.col("purchases").cast("long").alias("purchases"),
        F.try_divide(F.col("revenue"), F.col("purchases")).cast("double").alias("aov"),
    )


def metrics_json(metrics: DataFrame) -> DataFrame:
    """``value`` = JSON text of each metrics row (NULL fields omitted)."""
    return metrics.select(C.encode_row().alias("value"))
