"""File sources and sinks: JSON lines, partitioned JSON, parquet snapshots.

Readers take an explicit schema by default (no inference scan); pass
``schema=None`` to let Spark infer it as the reference did.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions.schemas import VISIT_FILE_SCHEMA, WEBLOG_SCHEMA

SPLIT_COLUMNS = ("event_type", "date")
# Fixed value: Spark's folder name for a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_weblogs(spark: SparkSession, path: str, schema=WEBLOG_SCHEMA) -> DataFrame:
    """JSON-lines web logs, one user (with nested visits) per line."""
    return read_json(spark, path, schema)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_split_events(
    events: DataFrame,
    out_dir: str,
    types: Sequence[str] | None = ("view", "buy"),
    replace: bool = True,
) -> str:
    """K2/K3: one JSON folder per ``event_type``/``date`` in a single job.

    With ``replace`` the written partitions are overwritten and all others
    survive (dynamic partition overwrite), so a rerun never duplicates.
    Every day present in the data is written, for every type.

    Rows are rebalanced on the folder columns first: AQE then sizes the
    write tasks (small folders coalesced, a hot day split over several
    tasks), so each folder gets a few well-sized files instead of one file
    per input task.
    """
    ev = events if types is None else events.where(F.col("event_type").isin(*types))
    ev = ev.hint("rebalance", *SPLIT_COLUMNS)
    w = ev.write.partitionBy(*SPLIT_COLUMNS)
    if replace:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.json(out_dir)
    return out_dir


def read_split_events(spark: SparkSession, path: str, schema=VISIT_FILE_SCHEMA) -> DataFrame:
    """Event files split by type and day.

    Works for the partitioned layout (``event_type=view/date=20240101``;
    type and day come from the folder names, typed by ``schema``) and for
    plain ``<dir>/*/*`` globs whose files hold those fields themselves.
    """
    return spark.read.schema(schema).json(path)


def partition_values(spark: SparkSession, path: str, column: str, depth: int = 2) -> list[str]:
    """Values of a ``column=value`` folder level under ``path`` (metadata only).

    Looks ``depth`` levels down; e.g. the days of a type/day split. Returns
    a sorted list (empty when the folder does not exist). The folder of NULL
    values is no value, as ``max`` ignores NULL.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found, level = set(), [root]
    for _ in range(depth):
        nxt = []
        for d in level:
            for st in fs.listStatus(d):
                if not st.isDirectory():
                    continue
                name = st.getPath().getName()
                if name.startswith(column + "="):
                    value = name[len(column) + 1:]
                    if value != NULL_FOLDER:
                        found.add(value)
                else:
                    nxt.append(st.getPath())
        level = nxt
    return sorted(found)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: parquet snapshot (matrix, feature table)."""
    return spark.read.parquet(path)
