"""Places in an order, and top-N of a keyed count table, without a task that sees all keys.

``with_place`` deals rows into sorted ranges, so each task orders one range;
what the ranges before it hold (one number a partition) is added afterwards.
``top_rows`` looks for a cut-off first: how many keys have each count (a table
of distinct counts, at most the square root of twice the total), and from it
the count at rank N. Rows below it are never put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.session import staging_path

# Bits of monotonically_increasing_id that count rows within a partition.
ROW_BITS = 33


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: later steps read it instead of deriving it again."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_place(df: DataFrame, *order: Column, place: str = "place") -> DataFrame:
    """``df`` with each row's place (from 0) in the order of ``order``, which must not tie.

    Rows are written once, in sorted ranges. The table that is broadcast has one
    row a partition.
    """
    at = F.monotonically_increasing_id()
    ranged = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "ranked")
    part, row = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_part", part).join(F.broadcast(before), "_part")
    return placed.select(*df.columns, (F.col("_before") + row).alias(place))


def cut_off(counts: DataFrame, n: int, count: str) -> tuple[int | None, int]:
    """The count at rank ``n`` (or the smallest one), and how many rows have that count or more."""
    sizes = counts.groupBy(count).agg(F.count(F.lit(1)).alias("_keys"))
    upto = F.sum("_keys").over(Window.orderBy(F.col(count).desc()))
    reached = sizes.select(count, upto.alias("_upto"), F.col("_keys")).where(F.col("_upto") - F.col("_keys") < n)
    edge, rows = reached.agg(F.min(count), F.max("_upto")).first()
    return edge, rows or 0


def top_rows(counts: DataFrame, n: int, count: str, tie: str, place: str | None = None) -> DataFrame:
    """The ``n`` rows of largest ``count``; ties by ascending ``tie`` (which differs in every row).

    With ``place`` a column of that name tells the rank, from 0. ``counts`` is
    derived once and written; only rows at or above the cut-off are ranked, and
    without ``place`` only if more of them tie than fit.
    """
    counts = staged(counts, "counts")
    edge, rows = cut_off(counts, n, count)
    if edge is None:
        return counts if place is None else counts.withColumn(place, F.lit(0).cast("long"))
    kept = counts.where(F.col(count) >= edge)
    if place is None and rows <= n:
        return kept
    name = place or "_place"
    ranked = with_place(kept, F.col(count).desc(), F.col(tie).asc(), place=name).where(F.col(name) < n)
    return ranked if place else ranked.drop(name)
