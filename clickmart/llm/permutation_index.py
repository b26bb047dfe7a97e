"""Operator 4, approximate nearest neighbours by a permutation index.

Every vector is represented by its nearest pivots in order. A block of vectors
posts these in pivot inverted files; a query adds up, over its own pivots'
postings, how far the two orders agree (the footrule distance of the truncated
permutations), and the candidates with the smallest distance are reranked by
their exact inner product.

Pivots come from a bounded sample; every vector is indexed. Largest inner
product becomes nearest neighbour by one more coordinate that gives all vectors
the same length.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import shuffle_partitions, stage

#: Pivots, how many of them a vector keeps, and rows that pivots are drawn from.
PIVOTS, KEPT, SAMPLE = 256, 32, 4_096
#: Rows of a block and queries of a batch: what one task holds of each.
BLOCK, BATCH = 16_384, 1_024
#: Share of a block that is reranked, and how many rows of it at least.
SHARE, LEAST = 0.4, 512
TOP, EVERY = 20, 20


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``vec`` (doubles) and ``norm2`` of rows that take part: an id, finite components, not all zero.

    Vectors of another length than the most usual one can't be compared and take no part either.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(~F.coalesce(bad, F.lit(True))).withColumn("norm2", F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).where("norm2 > 0")
    sizes = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.where(F.size("vec") == (sizes.d if sizes else 0))


def pivot_orders(lifted: np.ndarray, pivots: np.ndarray, kept: int) -> np.ndarray:
    """The ``kept`` nearest pivots of each row, nearest first (largest inner product: all lengths are equal)."""
    near = lifted @ pivots.T
    kept = min(kept, len(pivots))
    some = np.argpartition(-near, kept - 1, axis=1)[:, :kept]
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype(np.int32)


class InvertedFiles:
    """Postings of one block: for each pivot the rows that keep it and at which place."""

    def __init__(self, orders: np.ndarray, pivots: int):
        n, self.kept = orders.shape
        flat = orders.ravel()
        by = np.argsort(flat, kind="stable")
        self.rows, self.places = (by // self.kept).astype(np.int64), by % self.kept
        self.ends = np.searchsorted(flat[by], np.arange(pivots + 1))
        self.n = n

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """What the footrule distance lacks to its largest value, for every row of the block."""
        spans = [slice(self.ends[p], self.ends[p + 1]) for p in order]
        rows = np.concatenate([self.rows[s] for s in spans])
        places = np.concatenate([np.maximum(self.places[s], i) for i, s in enumerate(spans)])
        return np.bincount(rows, 2.0 * (self.kept - places), minlength=self.n)


def nearest(index: pd.DataFrame, queries: pd.DataFrame, pivots: np.ndarray, kept: int, top: int, share: float, least: int) -> pd.DataFrame:
    """Each query's best rows of one block."""
    index = index.sort_values("id", kind="stable")  # ties go to smaller ids throughout
    ids, vecs = index["id"].to_numpy(), np.stack(index["vec"].to_numpy())
    files = InvertedFiles(pivot_orders(np.column_stack([vecs, index["lift"].to_numpy()]), pivots, kept), len(pivots))
    q_ids, q_vecs = queries["id"].to_numpy(), np.stack(queries["vec"].to_numpy())
    q_orders = pivot_orders(np.column_stack([q_vecs, np.zeros(len(q_vecs))]), pivots, kept)
    most = min(len(ids), max(least, math.ceil(share * len(ids))))
    out = []
    for q, v, order in zip(q_ids, q_vecs, q_orders, strict=True):
        if most < len(ids):
            gain = files.agreement(order)
            edge = np.partition(gain, len(ids) - most)[len(ids) - most]
            above, level = np.flatnonzero(gain > edge), np.flatnonzero(gain == edge)
            rows = np.concatenate([above, level[: most - len(above)]])
        else:
            rows = np.arange(len(ids))
        rows = rows[ids[rows] != q]
        score = np.einsum("ij,j->i", vecs[rows], v)
        best = np.lexsort((ids[rows], -score))[:top]
        out.append(pd.DataFrame({"query_id": q, "vec_id": ids[rows][best], "score": score[best]}))
    return pd.concat(out)


def search(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, pivots: int = PIVOTS, kept: int = KEPT, share: float = SHARE, least: int = LEAST
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``top`` rows of largest inner product found.

    A query never finds rows of its own id. Rows whose vector is NULL, zero, of
    another length or has NULL or non-finite components take no part, as rows or
    queries. Ties go to the smaller id; repeated rows are found once each. With
    ``top`` other rows or fewer all are returned. Extra columns are ignored.

    Blocks of rows meet batches of queries, one pair a task; a block gives ``top``
    rows a query on.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors, id_col, vec_col), "vectors")
    q = usable(queries, id_col, vec_col)
    n, longest = rows.agg(F.count(F.lit(1)), F.max("norm2")).first()
    n_queries = q.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not n_queries:
        return spark.createDataFrame([], schema)
    lift = F.sqrt(F.greatest(F.lit(longest) - F.col("norm2"), F.lit(0.0)))
    rows = rows.withColumn("lift", lift)
    draw = F.pmod(F.xxhash64(F.lit("pivots"), "id"), F.lit(1 << 30))
    sample = rows.where(draw < int(min(1.0, SAMPLE / n) * (1 << 30))).select("id", "vec", "lift").limit(2 * SAMPLE).toPandas().sort_values("id")
    if sample.empty:
        sample = rows.select("id", "vec", "lift").limit(1).toPandas()
    pick = np.random.default_rng(11).permutation(len(sample))[:pivots]
    at = np.column_stack([np.stack(sample["vec"].to_numpy()), sample["lift"].to_numpy()])[pick]

    blocks, batches = -(-n // BLOCK), -(-n_queries // BATCH)
    index = rows.select("id", "vec", "lift", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    index = index.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)).cast("array<bigint>")))
    asked = q.select("id", "vec", F.pmod(F.xxhash64(F.lit("q"), "id"), F.lit(batches)).alias("batch"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    parts = max(shuffle_partitions(spark), blocks * batches)
    index, asked = index.repartition(parts, "block", "batch"), asked.repartition(parts, "block", "batch")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": pd.Series([], "int64"), "vec_id": pd.Series([], "int64"), "score": pd.Series([], "float64")})
        return nearest(left, right, at, kept, top, share, least)

    found = index.groupBy("block", "batch").cogroup(asked.groupBy("block", "batch")).applyInPandas(run, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def query(vectors: DataFrame) -> DataFrame:
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
