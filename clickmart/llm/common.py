"""Small helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.session import staging_path

#: White space of the word and line rules: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(text: str = "text") -> Column:
    """The text column with NULL as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and every other character left alone.

    ``lower`` is much the faster of the two and the same on ASCII text.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(*columns: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: a 128-bit key, never NULL."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


#: Rows of an Arrow batch where whole texts go to Python workers.
TEXT_ROWS = 1_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> str:
    """The session's queries send at most so many rows to a Python worker at a time; returns the setting before.

    An executor holds several copies of each task's batch outside its heap, and 10,000 texts are tens of MB.
    """
    before = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, min(rows, int(before)) if int(before) > 0 else rows)
    return before


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """``bound_text_batches`` for the queries that run in here."""
    before = bound_text_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    return staged_as(df, name)[0]


def staged_as(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stage`` that also tells the folder, for ``discard`` when nothing reads it any more."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``staged_as`` made, once what came of it is written elsewhere."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_cuts(df: DataFrame, key: str, blocks: int) -> list[int]:
    """Lower ends of at most ``blocks`` key ranges of about equal row counts.

    Spark's range partitioner finds them from the key column alone; the driver
    gets one value a block.
    """
    ranged = df.select(key).where(F.col(key).isNotNull()).repartitionByRange(max(1, blocks), key)
    rows = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("lo")).select("lo").collect()
    return sorted({r.lo for r in rows})


def block_of(key: Column, cuts: list[int]) -> Column:
    """Index of the last cut that is not above the key (NULL keys and keys below all: 0).

    Looks up a coarse and then a fine slice, so a row costs 2 * sqrt(blocks) comparisons.
    """
    if len(cuts) < 2:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))

    def fixed(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    coarse = F.greatest(F.size(F.filter(fixed(cuts[::step]), lambda c: c <= key)) - 1, F.lit(0)) * step
    fine = F.size(F.filter(F.slice(fixed(cuts), coarse + 1, step), lambda c: c <= key))
    return F.coalesce(F.greatest(coarse + fine - 1, F.lit(0)), F.lit(0))


def running_before(sums: DataFrame, block: str, columns: list[str]) -> dict[int, tuple[int, ...]]:
    """What all earlier blocks add up to, per block. ``sums`` has one row a block (bounded by the block count)."""
    before, total = {}, [0] * len(columns)
    for r in sums.select(block, *columns).orderBy(block).toLocalIterator():
        before[r[0]] = tuple(total)
        total = [t + (v or 0) for t, v in zip(total, r[1:], strict=True)]
    return before
