"""Pivots: per-key counts or sums spread into one column per value.

* A short known value list (at most ``SHORT_LIST`` values: weekdays, hours,
  category lists) becomes one conditional aggregate per value, in a single
  group-by: one shuffle, partially aggregated per task.
* A longer list uses Spark's pivot: a partial aggregate on ``(key, value)``,
  then the pivot of that (smaller) result; no discovery job.
* Without a list the values are found in the data. The rows are first
  counted into the long form ``(key, value, n)``, which is written to the
  shared folder; the discovery reads its value column and the pivot gets the
  names as its list, so the input is read once and any number of names works.

In all three an absent cell is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import columns as C
from clickmart.session import staging_path

SHORT_LIST = 100


def pivot_count(
    df: DataFrame, key: str | Sequence[str], pivot_col: str, values: Sequence[str] | None = None, weight: str | None = None
) -> DataFrame:
    """Rows per key and value; absent cells are NULL. Found values are the
    non-NULL ones, in order; their number is the width of the result. A row
    counts ``weight`` times if that column is given."""
    keys = [key] if isinstance(key, str) else list(key)
    if values is not None and len(values) <= SHORT_LIST:
        c = F.col(pivot_col)
        one = F.col(weight) if weight else F.lit(1)
        return df.groupBy(*keys).agg(*[F.sum(F.when(c == v, one)).alias(str(v)) for v in values])
    long = df.groupBy(*keys, pivot_col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    if values is None:
        path = staging_path(df.sparkSession, "long")
        long.write.parquet(path)
        long = df.sparkSession.read.schema(long.schema).parquet(path)
        found = long.select(pivot_col).where(F.col(pivot_col).isNotNull()).distinct()
        values = sorted(r[0] for r in found.toLocalIterator())
    return pivot_sum(long, keys, pivot_col, "_n", values)


def pivot_sum(
    df: DataFrame,
    key: str | Sequence[str],
    pivot_col: str,
    value_col: str,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Sum of ``value_col`` per key and value; absent cells are NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    if values is not None and len(values) <= SHORT_LIST:
        c = F.col(pivot_col)
        return df.groupBy(*keys).agg(*[F.sum(F.when(c == v, F.col(value_col))).alias(str(v)) for v in values])
    g = df.groupBy(*keys)
    g = g.pivot(pivot_col, list(values)) if values is not None else g.pivot(pivot_col)
    return g.agg(F.sum(value_col))


def weekday_pivot(labelled_visits: DataFrame) -> DataFrame:
    """``uid, web_day_mon..web_day_sun`` visit counts (NULL when none)."""
    return pivot_count(labelled_visits.select("uid", "web_week_day"), "uid", "web_week_day", C.WEEKDAY_COLUMNS)


def hour_pivot(labelled_visits: DataFrame) -> DataFrame:
    """``uid, web_hour_0..web_hour_23`` visit counts (NULL when none)."""
    return pivot_count(labelled_visits.select("uid", "web_hour"), "uid", "web_hour", C.HOUR_COLUMNS)


def hour_fractions(labelled_visits: DataFrame) -> DataFrame:
    """``uid, web_fraction_work_hours, web_fraction_evening_hours``."""
    s = labelled_visits.groupBy("uid").agg(
        F.sum("work_hours").alias("sum_work_hours"),
        F.sum("evening_hours").alias("sum_evening_hours"),
        F.count(F.lit(1)).alias("total_count"),
    )
    return s.select(
        "uid",
        F.try_divide(F.col("sum_work_hours"), F.col("total_count")).cast("double").alias("web_fraction_work_hours"),
        F.try_divide(F.col("sum_evening_hours"), F.col("total_count")).cast("double").alias("web_fraction_evening_hours"),
    )


def category_pivot(
    df: DataFrame, prefix: str, values: Sequence[str] | None = None, clean: bool = True, weight: str | None = None
) -> DataFrame:
    """``uid, <prefix><category>...``: visits per user and category.

    Shop categories are cleaned (``-``/space -> ``_``, lower-case); web
    categories only get the prefix (``clean=False``). Rows without a uid or
    category are dropped. ``values`` are the raw category values.
    """
    name = C.normalize_name("category", prefix) if clean else F.concat(F.lit(prefix), F.col("category"))
    rows = df.where(F.col("uid").isNotNull() & F.col("category").isNotNull()).select("uid", name.alias("name"), *([weight] if weight else []))
    cols = None
    if values is not None:
        cols = [
            (prefix + v.replace("-", "_").replace(" ", "_").lower()) if clean else prefix + v for v in values
        ]
    return pivot_count(rows, "uid", "name", cols, weight)
