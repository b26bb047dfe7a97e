"""User x item matrices: long form, pivot, union, previous snapshot.

The working table is the long form ``(uid, item_name, n)``; the wide
pivot is made last, because its width grows with the item catalogue.
Snapshots live in ``<out_dir>/<yyyyMMdd>/`` (parquet), one folder per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import columns as C
from clickmart.operators.pivots import pivot_count


def item_rows(visits: DataFrame) -> DataFrame:
    """``uid, item_name`` with ``item_name = <event_type>_<clean item_id>``.

    Rows without a uid or item are dropped (a NULL item would otherwise
    become a pivot column called ``null``).
    """
    v = visits.where(F.col("uid").isNotNull() & F.col("item_id").isNotNull())
    name = C.normalize_name("item_id", F.concat(F.col("event_type"), F.lit("_")))
    return v.select("uid", name.alias("item_name"))


def item_counts(visits: DataFrame) -> DataFrame:
    """Long form ``uid, item_name, n``."""
    return item_rows(visits).groupBy("uid", "item_name").agg(F.count(F.lit(1)).alias("n"))


def latest_day(visits: DataFrame) -> DataFrame:
    """One row ``max_date``: the newest day key."""
    return visits.agg(F.max("date").alias("max_date"))


def user_item_matrix(
    visits: DataFrame, items: Sequence[str] | None = None, fill: bool = True
) -> DataFrame:
    """Wide ``uid, <item_name>...`` counts; absent cells 0 when ``fill``.

    The visits are read once, into the long form ``(uid, item_name, n)``.
    Without ``items`` that long form is written to the shared folder and the
    item names are read from it instead of from the raw visits, so the
    discovery does not cost a second pass over the input.
    """
    m = pivot_count(item_rows(visits), "uid", "item_name", items)
    return m.na.fill(0) if fill else m


def union_matrices(a: DataFrame, b: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Rows of both, columns aligned by name; a column missing on one side
    is NULL there (or 0 with ``fill_missing``). A user in both appears twice."""
    u = a.unionByName(b, allowMissingColumns=True)
    return u.na.fill(0) if fill_missing else u


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def snapshot_days(spark: SparkSession, out_dir: str) -> list[str]:
    """Day folders (``yyyyMMdd``) present under ``out_dir`` (metadata only)."""
    fs, p = _fs(spark, out_dir)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n for n in names if len(n) == 8 and n.isdigit())


def previous_snapshot(spark: SparkSession, out_dir: str, current: str) -> DataFrame | None:
    """The newest snapshot strictly older than ``current``, zero-filled, or None."""
    older = [d for d in snapshot_days(spark, out_dir) if d < current]
    if not older:
        return None
    return spark.read.parquet(f"{out_dir.rstrip('/')}/{older[-1]}").na.fill(0)


def carry_over(
    spark: SparkSession,
    current: DataFrame,
    out_dir: str,
    current_day: str,
    update: bool = True,
    fill_missing: bool = False,
) -> DataFrame:
    """Current matrix plus, with ``update``, the previous snapshot's rows."""
    if not update:
        return current
    prev = previous_snapshot(spark, out_dir, current_day)
    return current if prev is None else union_matrices(current, prev, fill_missing)


def write_snapshot(matrix: DataFrame, out_dir: str, day: str) -> str:
    """Write ``<out_dir>/<day>/`` (parquet), rows sorted by ``uid`` inside
    each file: a local sort, no shuffle, so row-group statistics let a
    pushed-down ``uid`` filter skip most of each file."""
    path = f"{out_dir.rstrip('/')}/{day}"
    matrix.sortWithinPartitions("uid").write.mode("overwrite").parquet(path)
    return path
