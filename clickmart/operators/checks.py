"""A10: row counts as checks, without an extra job per step.

The reference prints ``count`` after most steps, each a full job. Here a
step is wrapped in ``df.observe``: the count is gathered as a side metric
of whatever action runs the plan anyway, and read afterwards. A stream gives
one set of counts a batch, which ``BatchCounts`` writes as a table.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` unchanged plus an ``Observation`` whose ``get["rows"]`` is its
    row count once an action over it has run."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def counted_with(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Like ``counted`` with extra named aggregate metrics (e.g. ``count_if``)."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [m.alias(k) for k, m in metrics.items()]
    return df.observe(obs, *exprs), obs


class BatchCounts(StreamingQueryListener):
    """Counts of every batch of one stream, written to ``<path>/batch=<id>/`` as batches end.

    ``observed`` adds the metrics (named aggregates) to the stream's plan; they
    come with the progress Spark reports after each batch, so counting costs no
    job over the data. A batch that is replayed replaces its own row. Reports
    are asynchronous: ``table`` waits until the query's end has been reported.
    ``spark`` is the session the stream belongs to.
    """

    def __init__(self, spark: SparkSession, path: str, **metrics: Column):
        self.spark, self.path = spark, path.rstrip("/")
        self.metrics = {"rows": F.count(F.lit(1)), **metrics}
        self.name = f"batch-counts-{uuid.uuid4().hex[:12]}"
        self.reported, self.ended = threading.Condition(), set()
        self.error: Exception | None = None

    def observed(self, stream: DataFrame) -> DataFrame:
        return stream.observe(self.name, *[m.cast("long").alias(k) for k, m in self.metrics.items()])

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        schema = ", ".join(f"`{k}` long" for k in self.metrics)
        try:
            counts = self.spark.createDataFrame([tuple(row[k] for k in self.metrics)], schema)
            counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={event.progress.batchId}")
        except Exception as e:  # noqa: BLE001 - Spark drops a listener's error; ``table`` raises it
            self.error = e

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.reported:
            self.ended.add(str(event.runId))
            self.reported.notify_all()

    def table(self, query, timeout: float = 120.0) -> DataFrame:
        """``batch`` and the counts, one row a batch, once the end of ``query`` has been reported."""
        with self.reported:
            if not self.reported.wait_for(lambda: str(query.runId) in self.ended, timeout):
                raise TimeoutError("the stream's end was not reported")
        if self.error is not None:
            raise self.error
        return self.spark.read.parquet(self.path)
