"""What the exact vector searches share: whole-number vectors, and blocks of rows that answer a stream of questions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import shuffle_partitions

#: A component x stands for the whole number floor(SCALE * x).
SCALE = 256
#: Largest whole number that doubles hold exactly with all below it.
EXACT = 1 << 53
#: Questions that one copy of a block answers: with more, the block is copied.
ASKED = 1 << 18


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, *keep: Column, length: int | None = None) -> DataFrame:
    """``id``, ``vec`` (whole numbers) and the columns ``keep`` of the rows that take part.

    Rows without an id or a vector, and vectors that hold a NULL or non-finite
    component, take no part; nor do vectors of another length than the most
    usual one (of equally usual ones the shortest; or than ``length``), as they
    can't be compared.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), *keep).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(~F.coalesce(bad, F.lit(False)))
    if length is None:
        usual = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
        length = usual.d if usual else 0
    v = v.where(F.size("vec") == length)
    return v.withColumn("vec", F.transform("vec", lambda x: F.floor(x * SCALE)))


def check_range(rows: DataFrame, limit: int) -> tuple[int, int, int]:
    """Row count, length and largest absolute component; an error if a score could pass ``limit``."""
    peak = F.greatest(F.abs(F.array_max("vec").cast("double")), F.abs(F.array_min("vec").cast("double")))
    n, d, most = rows.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(peak)).first()
    n, d, most = int(n), int(d or 0), int(most or 0)
    if d * most * most >= limit:
        raise ValueError(f"components up to {most} in {d} dimensions: the scores don't fit in a long")
    return n, d, most


def sample_vectors(rows: DataFrame, n: int, size: int) -> np.ndarray:
    """About ``size`` different vectors (at most twice that many), drawn by the hash of the vector, in a fixed order."""
    draw = F.pmod(F.xxhash64(F.lit("draw"), "vec"), F.lit(1 << 30))
    drawn = rows.where(draw < max(1, int(min(1.0, size / max(n, 1)) * (1 << 30)))).select("vec").distinct()
    found = sorted(tuple(r.vec) for r in drawn.orderBy(F.xxhash64("vec")).limit(2 * size).collect())
    if not found:
        found = [tuple(r.vec) for r in rows.orderBy("id").select("vec").limit(1).collect()]
    return np.array(found, dtype=np.float64).reshape(len(found), -1)


def matrix(column: pa.ChunkedArray | pa.Array, kind: str = "int64") -> np.ndarray:
    """A column of equally long lists as rows of an array."""
    n = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(n, -1 if n and len(flat) else 0)


def as_column(rows: np.ndarray) -> pa.Array:
    """The reverse: rows of an array as a column of lists."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(rows.ravel()))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows, exactly: in doubles where every sum is exact in them."""
    peak = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if peak < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def first_of_each(group: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` best entries of each group (higher score, then smaller id), by group and rank."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.array([], np.int64)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[rank < most]


def sweep(
    index: DataFrame,
    asked: DataFrame,
    keys: list[str],
    questions: int,
    build: Callable[[pa.Table], Any],
    answer: Callable[[Any, pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """Every block of ``index`` answers the rows of ``asked`` with the same ``keys`` (whole numbers).

    A block's rows come first in its partition and are built once; the
    questions then stream past in Arrow batches, so a task holds one block and
    one batch. Where there are many questions, blocks are copied and the
    questions of a block are dealt over the copies.
    """
    copies = max(1, -(-questions // ASKED))
    index = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("asks", F.lit(False))
    asked = asked.withColumn("copy", F.pmod(F.xxhash64(F.lit("copy"), "id"), F.lit(copies)).cast("int")).withColumn("asks", F.lit(True))
    both = index.unionByName(asked, allowMissingColumns=True)
    by = [*keys, "copy"]
    dealt = both.repartition(shuffle_partitions(index.sparkSession), *by).sortWithinPartitions(*by, "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for batch in batches:
            marks = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in (*by, "asks")]
            changed = np.zeros(batch.num_rows, bool)
            for m in marks:
                changed[1:] |= m[1:] != m[:-1]
            starts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                if a == b:
                    continue
                key = tuple(int(m[a]) for m in marks[:-1])
                if key != current:
                    current, parts, block = key, [], None
                piece = batch.slice(a, b - a)
                if not marks[-1][a]:
                    parts.append(piece)
                    continue
                if block is None and parts:
                    block, parts = build(pa.Table.from_batches(parts)), []
                if block is not None:
                    yield answer(block, piece)

    return dealt.mapInArrow(run, schema)
