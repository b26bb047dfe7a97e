"""Streaming hourly sales metrics.

Message stream (``value`` = event JSON) -> decode -> the same
``hourly_metrics`` operator as the batch job -> ``update`` output. The
aggregate is a stateful operator keyed by window; without a watermark late
rows always update their hour and state is kept (the reference's
behaviour); pass ``watermark`` to bound state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickmart.operators import events as E
from clickmart.operators import metrics as M
from clickmart.streaming import sinks

KEYS = ("start_ts",)
# State is keyed by hour window: a few hundred keys a month, already
# reduced map-side, so a handful of state partitions is enough at any scale.
STATE_PARTITIONS = 4


def hourly_metrics_stream(messages: DataFrame, watermark: str | None = None) -> DataFrame:
    return M.hourly_metrics(E.decode_events(messages), watermark=watermark)


def kafka_value_stream(metrics: DataFrame) -> DataFrame:
    """``value`` column ready for a Kafka sink (NULL fields left out)."""
    return M.metrics_json(metrics)


def run_to_table(
    spark: SparkSession,
    messages: DataFrame,
    out: str,
    checkpoint: str,
    watermark: str | None = None,
    state_partitions: int | None = STATE_PARTITIONS,
) -> DataFrame:
    """Run over everything available, return the current metrics table."""
    stream = hourly_metrics_stream(messages, watermark)
    sinks.run_available(stream, sinks.VersionedSink(out), checkpoint, "update", state_partitions=state_partitions)
    return sinks.latest(spark, out, KEYS)


def run_final(
    spark: SparkSession,
    messages: DataFrame,
    out: str,
    checkpoint: str,
    watermark: str,
    state_partitions: int | None = STATE_PARTITIONS,
):
    """Run over everything available in append mode: an hour is written once, when the watermark has passed its end.

    The hour then leaves the state, and messages of it that come later are
    dropped; hours the watermark hasn't passed stay in the checkpoint for the
    next run. Returns the stopped query; ``final_table`` reads what is written.
    """
    return sinks.run_available(
        hourly_metrics_stream(messages, watermark), sinks.VersionedSink(out), checkpoint, "append", state_partitions=state_partitions
    )


def final_table(spark: SparkSession, out: str) -> DataFrame:
    """All hours that ``run_final`` has written: the batches under one another."""
    return spark.read.parquet(out).drop(sinks.BATCH_COL)
