"""Snapshots of a user matrix as one dataset, and tables bucketed by user.

A dataset holds all snapshots in one folder tree ``<root>/snapshot=<yyyyMMdd>/``
(parquet). Read as a whole it has every column of any snapshot, and a filter on
``snapshot`` reads the folders it names alone. A bucketed table keeps its rows
hashed by ``uid``, so a join on ``uid`` shuffles only the other side.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators.matrix import union_matrices

SNAPSHOT = "snapshot"
# What a read of a folder that has no snapshot yet says.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_snapshot(matrix: DataFrame, root: str, day: str) -> str:
    """Write the rows as snapshot ``day`` (``yyyyMMdd``); a rerun replaces that snapshot and no other.

    The whole frame is one folder, so nothing is shuffled; rows are sorted by
    ``uid`` inside each file. Returns ``root``.
    """
    rows = matrix.sortWithinPartitions("uid").withColumn(SNAPSHOT, F.lit(int(day)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT).parquet(root)
    return root


def read_snapshots(spark: SparkSession, root: str) -> DataFrame | None:
    """All snapshots with ``snapshot`` (int); columns a snapshot doesn't have are NULL in its rows. None if there are none."""
    return _read(spark, root, root, merge=True)


def _read(spark: SparkSession, root: str, path: str, merge: bool = False) -> DataFrame | None:
    try:
        return spark.read.option("basePath", root).option("mergeSchema", merge).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


def previous_snapshot(spark: SparkSession, root: str, current: str) -> DataFrame | None:
    """The newest snapshot strictly older than ``current``, with its own columns, zero-filled, or None.

    The day comes from the partition column alone; the rows then come from that
    snapshot's folder, whatever newer snapshots hold.
    """
    snapshots = _read(spark, root, root)  # one footer is enough for the partition column
    if snapshots is None:
        return None
    day = snapshots.where(F.col(SNAPSHOT) < int(current)).agg(F.max(SNAPSHOT)).first()[0]
    if day is None:
        return None
    return _read(spark, root, f"{root.rstrip('/')}/{SNAPSHOT}={day}").drop(SNAPSHOT).na.fill(0)


def add_snapshot(spark: SparkSession, current: DataFrame, root: str, day: str, update: bool = True, fill_missing: bool = False) -> DataFrame:
    """Write ``current`` as snapshot ``day``, with ``update`` under it the rows of the snapshot before; returns what was written."""
    before = previous_snapshot(spark, root, day) if update else None
    write_snapshot(current if before is None else union_matrices(current, before, fill_missing), root, day)
    return _read(spark, root, f"{root.rstrip('/')}/{SNAPSHOT}={int(day)}").drop(SNAPSHOT)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "uid") -> DataFrame:
    """Write ``df`` as a table of ``buckets`` files hashed and sorted by ``key`` under ``path``; returns the table.

    Rows go to their bucket in one shuffle first, so each bucket is one file. Later joins and
    group-bys on ``key`` read the table without a shuffle of it.
    """
    rows = df.repartition(buckets, key)
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
