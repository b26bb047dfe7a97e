"""Operator 11, exact top-k search: ball-tree branch and bound per shard.

Vectors are whole numbers. Rows fall into cells around centres of a bounded
sample; a cell is dealt into shards of about 8,192 rows. A shard keeps its rows
in a ball tree. A node's bound is the inner product with its centre plus the
query's length times its radius; a query visits nodes by descending bound and
leaves out those that can't beat its k-th score so far.

That score is shared: each query first searches one shard of the cell with the
best bound, and the k-th score found there goes with it to the others. Cells
whose ball can't beat it are not visited at all, and in the rest the search
begins with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import stage
from clickmart.llm.vectors import check_range, first_of_each, matrix, products, sample_vectors, sweep, whole_vectors

TOP, EVERY = 5, 50
#: Rows of a shard, rows of a leaf, most cells, sample rows that centres come from.
SHARD, LEAF, CELLS, SAMPLE = 8_192, 128, 1_024, 16_384
#: Scores stay below this, so that they and their negatives fit in a long.
LIMIT = 1 << 62
NONE, LAST = -LIMIT, np.iinfo(np.int64).max

FOUND = "query_id long, vec_id long, score long"


def bounds(queries: np.ndarray, lengths: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The largest whole inner product that each query can have in each ball, safe against rounding."""
    reach = np.linalg.norm(centres, axis=1) + radii
    high = queries @ centres.T + lengths[:, None] * radii[None, :]
    high += 1e-9 * lengths[:, None] * reach[None, :] + 1e-6
    return np.floor(np.clip(high, float(NONE), float(LIMIT))).astype(np.int64)


def ball(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, distances from it and radius of some points."""
    centre = points.mean(axis=0)
    away = np.linalg.norm(points - centre, axis=1)
    return centre, away, float(away.max(initial=0.0)) * (1 + 1e-9)


class BallTree:
    """Balls around halves of halves of the rows, down to leaves of at most ``leaf`` rows."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")  # equal rows split by id, so a node's smallest id tells more
        points = vecs[order].astype(np.float64)
        self.ends: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        place = np.arange(len(order))

        def grow(a: int, b: int) -> int:
            at = place[a:b]
            centre, away, radius = ball(points[at])
            node = len(self.ends)
            self.ends.append((a, b))
            self.children.append(None)
            centres.append(centre)
            radii.append(radius)
            if b - a > leaf:
                one = points[at[np.argmax(away)]]
                other = points[at[np.argmax(np.linalg.norm(points[at] - one, axis=1))]]
                place[a:b] = at[np.argsort(points[at] @ (other - one), kind="stable")]
                middle = (a + b) // 2
                self.children[node] = grow(a, middle), grow(middle, b)
            return node

        grow(0, len(order))
        self.ids, self.vecs = ids[order][place], vecs[order][place]
        self.centres, self.radii = np.array(centres).reshape(len(centres), -1), np.array(radii)
        self.least = np.array([self.ids[a:b].min(initial=LAST) for a, b in self.ends])

    def leaves(self) -> np.ndarray:
        """Centres of the leaves."""
        return self.centres[[i for i, c in enumerate(self.children) if c is None]]


class Search:
    """The best rows so far of a batch of queries, and the worst that still counts for each."""

    def __init__(self, tree: BallTree, own: np.ndarray, vecs: np.ndarray, floor_score: np.ndarray, floor_id: np.ndarray, top: int):
        self.tree, self.own, self.vecs, self.top = tree, own, vecs, top
        self.points = vecs.astype(np.float64)
        self.lengths = np.linalg.norm(self.points, axis=1)
        self.edge, self.edge_id = floor_score.copy(), floor_id.copy()
        self.rows: list[np.ndarray] = []
        self.score = np.full((len(own), top), NONE, np.int64)
        self.ids = np.full((len(own), top), LAST, np.int64)
        self.scored = 0
        self.visit(0, np.arange(len(own)), bounds(self.points, self.lengths, tree.centres[:1], tree.radii[:1])[:, 0])

    def alive(self, node: int, some: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which of some queries can gain by a node: a higher score, or the same one with a smaller id."""
        return (bound > self.edge[some]) | ((bound == self.edge[some]) & (self.tree.least[node] < self.edge_id[some]))

    def visit(self, node: int, some: np.ndarray, bound: np.ndarray) -> None:
        some = some[self.alive(node, some, bound)]
        if not len(some):
            return
        pair = self.tree.children[node]
        if pair is None:
            self.scan(node, some)
            return
        both = list(pair)
        high = bounds(self.points[some], self.lengths[some], self.tree.centres[both], self.tree.radii[both])
        left = (high[:, 0] > high[:, 1]) | ((high[:, 0] == high[:, 1]) & (self.tree.least[pair[0]] < self.tree.least[pair[1]]))
        for child, part in ((0, left), (1, ~left), (1, left), (0, ~left)):
            self.visit(pair[child], some[part], high[part, child])

    def scan(self, node: int, some: np.ndarray) -> None:
        a, b = self.tree.ends[node]
        ids = self.tree.ids[a:b]
        score = products(self.vecs[some], self.tree.vecs[a:b])
        self.scored += score.size
        score[self.own[some][:, None] == ids[None, :]] = NONE
        edge = self.edge[some]
        if len(ids) > self.top:
            edge = np.maximum(edge, np.partition(score, len(ids) - self.top, axis=1)[:, len(ids) - self.top])
        q, r = np.nonzero((score >= edge[:, None]) & (score > NONE))
        old = np.repeat(np.arange(len(some)), self.top)
        group = np.concatenate([old, q])
        scores = np.concatenate([self.score[some].ravel(), score[q, r]])
        found = np.concatenate([self.ids[some].ravel(), ids[r]])
        best = first_of_each(group, scores, found, self.top)
        self.score[some] = scores[best].reshape(-1, self.top)
        self.ids[some] = found[best].reshape(-1, self.top)
        last, last_id = self.score[some, -1], self.ids[some, -1]
        better = (last > self.edge[some]) | ((last == self.edge[some]) & (last_id < self.edge_id[some]))
        self.edge[some[better]], self.edge_id[some[better]] = last[better], last_id[better]

    def result(self) -> pa.RecordBatch:
        q, place = np.nonzero(self.score > NONE)
        return pa.RecordBatch.from_arrays([pa.array(self.own[q]), pa.array(self.ids[q, place]), pa.array(self.score[q, place])], ["query_id", "vec_id", "score"])


def _build(block: pa.Table) -> BallTree:
    return BallTree(block["id"].to_numpy(), matrix(block["vec"]))


def _searcher(top: int):
    def answer(tree: BallTree, asked: pa.RecordBatch) -> pa.RecordBatch:
        own, vecs = asked["id"].to_numpy(), matrix(asked["vec"])
        return Search(tree, own, vecs, asked["edge"].to_numpy(), asked["edge_id"].to_numpy(), top).result()

    return answer


def in_cells(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """``id, vec, cell, away``: the nearest centre and the distance from it."""
    half = (centres * centres).sum(axis=1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch["vec"], "float64").reshape(batch.num_rows, centres.shape[1])
            cell = (points @ centres.T - half).argmax(axis=1)
            away = np.linalg.norm(points - centres[cell], axis=1)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["vec"], pa.array(cell.astype(np.int64)), pa.array(away)], ["id", "vec", "cell", "away"])

    return rows.select("id", "vec").mapInArrow(run, "id long, vec array<long>, cell long, away double")


def fixed(values: list[int]) -> Column:
    """A short list of whole numbers as an array column."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def routed(asked: DataFrame, centres: np.ndarray, radii: np.ndarray, shards: np.ndarray, home: bool) -> DataFrame:
    """The shards that each query visits: one of its best cell's (``home``), or all others that its bound doesn't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch["vec"], "float64").reshape(batch.num_rows, centres.shape[1])
            high = bounds(points, np.linalg.norm(points, axis=1), centres, radii)
            best = high.argmax(axis=1)
            ids = batch["id"].to_numpy()
            own = ids % shards[best]
            if home:
                q, cell, shard = np.arange(len(ids)), best, own
            else:
                q, cell = np.nonzero(high >= batch["edge"].to_numpy()[:, None])
                many = shards[cell]
                q, cell = np.repeat(q, many), np.repeat(cell, many)
                shard = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
                other = (cell != best[q]) | (shard != own[q])
                q, cell, shard = q[other], cell[other], shard[other]
            for a in range(0, len(q), 8_192):
                part = slice(a, a + 8_192)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[part].astype(np.int64)), pa.array(shard[part].astype(np.int64)), *(batch[c].take(pa.array(q[part])) for c in ("id", "vec", "edge", "edge_id"))],
                    ["cell", "shard", "id", "vec", "edge", "edge_id"],
                )

    return asked.select("id", "vec", "edge", "edge_id").mapInArrow(run, "cell long, shard long, id long, vec array<long>, edge long, edge_id long")


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``top`` rows of highest whole-number inner product, exactly.

    A component x is taken as floor(256 * x). A query never finds rows of its
    own id; with ``top`` other rows or fewer all are returned. Ties go to the
    smaller id; repeated rows are found once each. Of several query rows with
    one id the smallest vector (in array order) asks. Zero vectors take part;
    rows without an id, NULL vectors, vectors with NULL or non-finite
    components, and vectors of another length than the most usual one don't.
    Components so large that a score doesn't fit in a long are an error. Other
    columns are ignored. An empty table or no query gives an empty result.
    """
    spark = vectors.sparkSession
    whole = stage(whole_vectors(vectors, id_col, vec_col), "whole-vectors")
    n, d, _ = check_range(whole, LIMIT)
    asked = whole_vectors(queries, id_col, vec_col, length=d).groupBy("id").agg(F.min("vec").alias("vec"))
    asked = stage(asked.withColumn("edge", F.lit(NONE)).withColumn("edge_id", F.lit(int(LAST))), "queries")
    many = asked.count()
    if not n or not many:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    sample = sample_vectors(whole, n, SAMPLE)
    wanted = min(CELLS, -(-n // shard))
    centres = BallTree(np.arange(len(sample)), sample, max(1, -(-len(sample) // wanted))).leaves()
    cells = stage(in_cells(whole, centres).withColumn("place", F.monotonically_increasing_id()), "cells")
    radii, shards = np.zeros(len(centres)), np.ones(len(centres), np.int64)
    for r in cells.groupBy("cell").agg(F.max("away").alias("away"), F.count(F.lit(1)).alias("n")).collect():  # a row a cell
        radii[r.cell], shards[r.cell] = r.away * (1 + 1e-9), -(-r.n // shard)
    index = cells.select("id", "vec", "cell", F.pmod("place", F.get(fixed(shards.tolist()), F.col("cell").cast("int"))).alias("shard"))

    near = sweep(index, routed(asked, centres, radii, shards, True), ["cell", "shard"], many, _build, _searcher(top), FOUND)
    near = stage(near, "home-found")
    worst = near.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))).alias("best"))
    worst = worst.where(F.size("best") >= top).select(F.col("query_id").alias("id"), F.col("best")[top - 1].alias("last"))
    shared = asked.select("id", "vec").join(worst, "id", "left").select(
        "id", "vec", F.coalesce(-F.col("last.s"), F.lit(NONE)).alias("edge"), F.coalesce(F.col("last.i"), F.lit(int(LAST))).alias("edge_id")
    )
    far = sweep(index, routed(shared, centres, radii, shards, False), ["cell", "shard"], many, _build, _searcher(top), FOUND)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.unionByName(far).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def query(vectors: DataFrame) -> DataFrame:
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
