"""Event message operators: decode, day key, type filter, ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import columns as C
from clickmart.functions.schemas import EVENT_SCHEMA


def decode_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` (JSON text or bytes) -> event columns.

    A malformed message gives a row of NULLs; a field of the wrong type
    gives NULL for that field.
    """
    return messages.select(C.decode_event(value_col, EVENT_SCHEMA).alias("json")).select("json.*")


def with_day_key(events: DataFrame, ts_ms: str = "timestamp") -> DataFrame:
    """Adds ``date`` = ``yyyyMMdd`` of the epoch-ms timestamp (UTC)."""
    return events.withColumn("date", C.day_key(C.millis_to_ts(ts_ms)))


def filter_event_type(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type)


def newest_first(events: DataFrame) -> DataFrame:
    """Events ordered by day key, newest first (a range-partitioned sort).

    Inside a day the newest come first too, so a day is split over tasks.
    """
    return events.orderBy(F.col("date").desc(), F.col("timestamp").desc(), "uid")


def distinct_days(events: DataFrame) -> DataFrame:
    return events.select("date").distinct()
