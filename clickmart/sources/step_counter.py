"""Stepped-counter stream source and an upper-casing batch sink.

Source semantics (option ``step`` required, schema ``id bigint, foo string``):
micro-batch 0 emits id 0; batch n >= 1 emits ids ``(n-1)*step+1 .. n*step``;
``foo`` is constant. The offset is the batch number; rows are computed from
the offset range only, so a replayed range yields the same rows, and the
range is cut into partitions that executors generate in parallel (nothing
is materialised on the driver). ``max_batches`` (optional) stops the
offset from advancing, which lets a run drain.

Offsets advance in one of two ways:

* counter (default, as the reference): one batch per trigger, counted in
  the reader's memory. A restarted query would count from 0 again, so use
  this mode only for runs that are not resumed.
* clock (``start_ms`` and ``interval_ms`` given): the latest batch is the
  number of whole intervals since ``start_ms``. The offset only ever grows
  with time, so a query resumed from its checkpoint carries on where it
  stopped and every id is emitted once.

Sink semantics: each micro-batch is shown or stored with ``foo``
upper-cased (``foreachBatch``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from clickmart.functions.schemas import COUNTER_SCHEMA

FORMAT = "clickmart_step_counter"
# Fixed value: the constant text of every generated row.
FOO = "hello world"
ROWS_PER_PARTITION = 100_000


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class StepCounterReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        if "step" not in options:
            raise ValueError("option 'step' is required")
        self.step = int(options["step"])
        self.max_batches = int(options["max_batches"]) if "max_batches" in options else None
        self.start_ms = int(options["start_ms"]) if "start_ms" in options else None
        self.interval_ms = int(options.get("interval_ms", 1000))
        self._next = 0

    def initialOffset(self) -> dict:
        return {"batch": -1}

    def latestOffset(self) -> dict:
        if self.start_ms is not None:
            n = (int(time.time() * 1000) - self.start_ms) // self.interval_ms
        else:
            n = self._next
        if self.max_batches is not None:
            n = min(n, self.max_batches - 1)
        n = max(n, -1)
        self._next = max(self._next, n + 1)
        return {"batch": n}

    def _ids(self, start: dict, end: dict) -> tuple[int, int]:
        s, e = int(start["batch"]), int(end["batch"])
        lo = 0 if s < 0 else s * self.step + 1
        return lo, e * self.step  # inclusive

    def partitions(self, start: dict, end: dict):
        lo, hi = self._ids(start, end)
        if hi < lo:
            return [_Range(1, 0)]
        return [
            _Range(a, min(a + ROWS_PER_PARTITION - 1, hi)) for a in range(lo, hi + 1, ROWS_PER_PARTITION)
        ]

    def read(self, partition: _Range):
        for i in range(partition.lo, partition.hi + 1):
            yield (i, FOO)

    def commit(self, end: dict) -> None:
        self._next = max(self._next, int(end["batch"]) + 1)


class StepCounterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COUNTER_SCHEMA.simpleString().replace("struct<", "").rstrip(">").replace(":", " ")

    def streamReader(self, schema) -> DataSourceStreamReader:
        return StepCounterReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StepCounterSource)


def read_stream(
    spark: SparkSession,
    step: int,
    max_batches: int | None = None,
    start_ms: int | None = None,
    interval_ms: int | None = None,
) -> DataFrame:
    register(spark)
    r = spark.readStream.format(FORMAT).option("step", str(step))
    if max_batches is not None:
        r = r.option("max_batches", str(max_batches))
    if start_ms is not None:
        r = r.option("start_ms", str(start_ms))
    if interval_ms is not None:
        r = r.option("interval_ms", str(interval_ms))
    return r.load()


def upper_foo(batch: DataFrame) -> DataFrame:
    return batch.withColumn("foo", F.upper(F.col("foo")))


class UpperCaseSink:
    """``foreachBatch`` sink: upper-case ``foo``; append to ``path`` and/or show."""

    def __init__(self, path: str | None = None, show: int = 0):
        self.path, self.show = path, show

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = upper_foo(batch)
        if self.path:
            out.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if self.show:
            out.show(self.show, truncate=False)
