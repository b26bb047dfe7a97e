"""Replay-safe micro-batch sink for update-mode results.

Each micro-batch is written to ``<path>/batch=<id>/`` with overwrite, so a
replayed batch (after a failure) replaces its own folder instead of
appending twice. The current result table is the newest row per key over
all batches (``latest``), computed as a keyed window, i.e. partitioned by
the key, never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.session import shared_root
from clickmart.sources import files

BATCH_COL = "batch"


class VersionedSink:
    """``foreachBatch`` target; ``transform`` is applied to each batch first.

    With ``compact_every`` the table of ``keys`` is compacted after that many
    batches, so a stream that runs for ever keeps its reads short.
    """

    def __init__(
        self,
        path: str,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        compact_every: int | None = None,
        keys: Sequence[str] = (),
    ):
        self.path = path.rstrip("/")
        self.transform = transform
        self.compact_every, self.keys = compact_every, tuple(keys)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = self.transform(batch) if self.transform else batch
        out.write.mode("overwrite").parquet(f"{self.path}/{BATCH_COL}={batch_id}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            compact(batch.sparkSession, self.path, self.keys)


BASE_SUFFIX = "__base"
BASE_COL = "upto"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """All rows still needed: the newest compacted base (if any) plus the
    batches written after it (older batch folders are pruned, not read)."""
    bases = [int(v) for v in files.partition_values(spark, path + BASE_SUFFIX, BASE_COL, depth=1)]
    batches = spark.read.parquet(path)
    if not bases:
        return batches
    upto = max(bases)
    base = spark.read.parquet(f"{path}{BASE_SUFFIX}/{BASE_COL}={upto}").withColumn(BATCH_COL, F.lit(upto))
    return base.unionByName(batches.where(F.col(BATCH_COL) > upto), allowMissingColumns=True)


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch: the whole result of a complete-mode query."""
    ids = [int(v) for v in files.partition_values(spark, path, BATCH_COL, depth=1)]
    return spark.read.parquet(f"{path}/{BATCH_COL}={max(ids)}")


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key across all written batches.

    ``max_by`` over the batch id: an aggregate, partially computed per task
    before the shuffle, so a key updated in many batches costs one row per
    task rather than a sort of all its versions.
    """
    df = _versions(spark, path)
    values = [c for c in df.columns if c not in keys and c != BATCH_COL]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int | None:
    """Write the current table as a base covering every batch so far.

    Later reads start from the newest base and only read batches after it,
    so reading cost stays bounded however long the stream runs. Nothing is
    deleted; rerunning is harmless (the base folder is overwritten with the
    same rows). Returns the last batch id covered, or None if there is none.
    """
    ids = [int(v) for v in files.partition_values(spark, path, BATCH_COL, depth=1)]
    if not ids:
        return None
    upto = max(ids)
    current = latest(spark, path, keys)
    shared_root(spark)
    # Cut from its inputs first, so overwriting a base never reads itself.
    current = current.checkpoint(eager=True)
    current.write.mode("overwrite").parquet(f"{path}{BASE_SUFFIX}/{BASE_COL}={upto}")
    return upto


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for streams, with the same settings.

    What a query must have set when it starts (state partitions, state store) is
    set on its stream's session; on one of its own no other plan sees it.
    """
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and own.conf.get(k, None) != v and own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


class starting_with:  # noqa: N801 - used as a function
    """Settings that a new query records: ``partitions`` of its state and ``conf``.

    The number of state partitions is fixed when a query first starts; a
    key space that stays small (e.g. hour windows) needs few of them, each
    costing a task per micro-batch. A resumed query keeps the number stored
    in its checkpoint whatever is set here. The session has its own settings
    back once the query has started.
    """

    def __init__(self, spark: SparkSession, partitions: int | None, conf: dict[str, str] | None = None):
        self.spark, self.new = spark, dict(conf or {})
        if partitions:
            self.new["spark.sql.shuffle.partitions"] = str(partitions)
        self.old: dict[str, str | None] = {}

    def __enter__(self):
        for k, v in self.new.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def run_available(
    stream: DataFrame,
    sink: Callable,
    checkpoint: str,
    output_mode: str = "update",
    name: str | None = None,
    state_partitions: int | None = None,
    conf: dict[str, str] | None = None,
):
    """Process everything available now, then stop (batch-like runs, tests).

    The checkpoint is never wiped: a rerun resumes after the last committed
    batch.
    """
    w = stream.writeStream.outputMode(output_mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    with starting_with(stream.sparkSession, state_partitions, conf):
        q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_until_caught_up(
    stream: DataFrame,
    sink: Callable,
    checkpoint: str,
    output_mode: str = "update",
    state_partitions: int | None = None,
    conf: dict[str, str] | None = None,
):
    """Process everything available, then stop, for queries with state timeouts.

    Such a query would go on with batches without data to evaluate timeouts,
    and an available-now run of it never end. This run makes none: timeouts are
    evaluated in the batches that have data. A batch that an earlier run left
    unfinished is replayed first, and all input after it is still read.
    """
    spark = stream.sparkSession
    old = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return run_available(stream, sink, checkpoint, output_mode, state_partitions=state_partitions, conf=conf)
    finally:
        spark.conf.set(NO_DATA_BATCHES, old)


def start(
    stream: DataFrame,
    sink: Callable,
    checkpoint: str,
    output_mode: str = "update",
    processing_time: str = "5 seconds",
    name: str | None = None,
    state_partitions: int | None = None,
    conf: dict[str, str] | None = None,
):
    """Start a long-running query with a processing-time trigger."""
    w = stream.writeStream.outputMode(output_mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    with starting_with(stream.sparkSession, state_partitions, conf):
        return w.trigger(processingTime=processing_time).start()
