"""Equi-join whose hot keys are found by a sketch and spread over tasks.

A join shuffles both sides by key, so a key with a third of all rows is a third
of the work in one task. Here one aggregate over the key column finds the keys
above a share of the rows (a frequent-items sketch, merged from partial ones),
and only their rows get a salt: on the large side one each, on the other side a
copy for each salt. All other rows are joined as they would be without.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items the sketch follows; its counts are short by less than 3.5 / 2^14 of all rows then.
TRACKED = 1 << 14
#: No share below this is asked for, so there are at most 1,000 hot keys.
LEAST_SHARE = 0.001
#: A hot key is cut into pieces of a quarter of an average task.
PIECES = 4


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """``key, _salts``: keys with more than ``share`` of the rows (default: an average task's) and their number of pieces.

    At most ``1 / share`` rows. NULL keys join nothing and are not counted. A key that the sketch
    takes to be smaller than it is may be left out, which costs time and no row.
    """
    spark, tasks = df.sparkSession, _partitions(df)
    share = max(LEAST_SHARE, share or 1 / tasks)
    most = math.ceil(1 / share)
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    found = keys.agg(F.expr(f"approx_top_k(k, {most}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    rows = [(r["item"], math.ceil(PIECES * tasks * r["count"] / found.n)) for r in found.top if r["count"] > share * found.n]
    return spark.createDataFrame(rows, f"`{key}` {df.schema[key].dataType.simpleString()}, `_salts` int")


def hot_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float | None = None) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` ``inner`` or ``left``, with the hot keys of ``left`` spread.

    Same rows and columns as that join, repeated rows and NULL keys included.
    The salt follows from a row's values and its input partition, so a task that
    is run again sends its rows to the same places.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    salt, salts = "_salt", "_salts"
    while {salt, salts} & {*left.columns, *right.columns}:
        salt, salts = salt + "_", salts + "_"
    hot = F.broadcast(hot_keys(left, key, share).withColumnRenamed("_salts", salts))  # at most 1 / share rows
    pieces = F.when(F.col(key).isNull(), F.lit(PIECES * _partitions(left))).otherwise(F.coalesce(salts, F.lit(1)))
    place = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]) + F.spark_partition_id()
    salted = left.join(hot, key, "left").withColumn(salt, F.pmod(place, pieces).cast("int")).drop(salts)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1))
    spread = right.join(hot, key, "left").withColumn(salt, copies).drop(salts)
    return salted.join(spread, [key, salt], how).drop(salt)
