"""Operator 13, hard-negative mining by angular triangle filtering.

Every row keeps its angles to a few reference directions and its length. With
an anchor's own angles the triangle inequality on the sphere gives an interval
for the angle between the two, and so for the cosine; times both lengths it
bounds the whole-number score, with room for rounding. Only rows whose interval
overlaps what is looked for get integer scoring: above the fifth best lower
bound for an anchor's positives, a window of scores under each positive for the
negatives.

Positives are looked for in blocks of one label; negatives in blocks of rows
that share their nearest reference direction, of which an anchor visits those
whose ranges of angles and lengths can reach one of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import stage
from clickmart.llm.vectors import as_column, check_range, first_of_each, matrix, sample_vectors, sweep, whole_vectors

POSITIVES, NEGATIVES, EVERY = 5, 3, 50
#: A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 50, 95
#: Reference directions, sample rows that they come from, rows of a block.
REFERENCES, SAMPLE, BLOCK = 16, 4_096, 8_192
#: Scores stay below this, so that a hundred times a score fits in a long.
LIMIT = 1 << 56
#: What an angle may be off by rounding (arccos loses half the digits near its ends).
SLACK = 1e-6
#: Pairs whose bounds, and whose scores, are worked out together.
TILE = 1 << 21

FOUND = "anchor_id long, slot int, id long, score long"


def references(sample: np.ndarray, most: int) -> np.ndarray:
    """Unit vectors far from each other: from the sample, each the one with the largest angle to those before."""
    lengths = np.linalg.norm(sample, axis=1)
    units = sample[lengths > 0] / lengths[lengths > 0, None]
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    picked = [0]
    nearest = units @ units[0]
    while len(picked) < min(most, len(units)):
        far = int(nearest.argmin())
        picked.append(far)
        nearest = np.maximum(nearest, units @ units[far])
    return units[picked]


def angles_of(points: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the points and their angles to the directions (a zero vector's angles count as 0: its scores are 0 anyway)."""
    norms = np.linalg.norm(points, axis=1)
    cosines = (points @ directions.T) / np.where(norms > 0, norms, 1)[:, None]
    angles = np.arccos(np.clip(cosines, -1, 1))
    angles[norms == 0] = 0
    return norms, angles


def with_angles(rows: DataFrame, directions: np.ndarray) -> DataFrame:
    """``id, label, vec, norm, angles, cell``: the stored angles; ``cell`` is the nearest direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch["vec"], "float64").reshape(batch.num_rows, directions.shape[1])
            norms, angles = angles_of(points, directions)
            cell = angles.argmin(axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], batch["vec"], pa.array(norms), as_column(angles), pa.array(cell)], ["id", "label", "vec", "norm", "angles", "cell"]
            )

    return rows.select("id", "label", "vec").mapInArrow(run, "id long, label long, vec array<long>, norm double, angles array<double>, cell long")


def whole_bounds(near: np.ndarray, far: np.ndarray, a: np.ndarray, short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole score from the ends of the angle, the anchors' lengths and the ends of the rows' lengths."""
    high, low = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, np.pi))
    slack = 1e-9 * a * long + 1e-6
    high = a * high * np.where(high >= 0, long, short) + slack
    low = a * low * np.where(low >= 0, short, long) - slack
    return np.ceil(low).astype(np.int64), np.floor(high).astype(np.int64)


def score_bounds(a_norms: np.ndarray, a_angles: np.ndarray, norms: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the score of every anchor and row, from one triangle a reference direction."""
    near = np.zeros((len(a_norms), len(norms)))
    far = np.full_like(near, np.pi)
    for r in range(angles.shape[1]):
        x, y = a_angles[:, r, None], angles[None, :, r]
        np.maximum(near, np.abs(x - y), out=near)
        both = x + y
        np.minimum(far, np.minimum(both, 2 * np.pi - both), out=far)
    return whole_bounds(near, far, a_norms[:, None], norms[None, :], norms[None, :])


class Block:
    """Rows of a block, in order of label."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["label"].to_numpy(), kind="stable")
        self.labels, self.ids = table["label"].to_numpy()[order], table["id"].to_numpy()[order]
        self.norms, self.angles, self.vecs = table["norm"].to_numpy()[order], matrix(table["angles"], "float64")[order], matrix(table["vec"])[order]
        self.bounded = self.scored = 0

    def tiles(self, batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Parts of a batch of anchors with the bounds of their scores with all rows."""
        norms, angles = batch["norm"].to_numpy(), matrix(batch["angles"], "float64")
        step = max(1, TILE // max(1, len(self.ids)))
        for a in range(0, len(norms), step):
            part = slice(a, a + step)
            low, high = score_bounds(norms[part], angles[part], self.norms, self.angles)
            self.bounded += low.size
            yield part, low, high

    def scores(self, anchors: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Whole scores of some pairs of anchor and row."""
        step = max(1, TILE // max(1, self.vecs.shape[1]))
        self.scored += len(a)
        parts = [np.einsum("ij,ij->i", anchors[a[i : i + step]], self.vecs[r[i : i + step]]) for i in range(0, len(a), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _found(anchor: np.ndarray, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(slot.astype(np.int32)), pa.array(ids), pa.array(score)], ["anchor_id", "slot", "id", "score"])


def _joined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    empty = (np.zeros(0, np.int64),) * 4
    return _found(*(np.concatenate(c) for c in zip(*(parts or [empty]), strict=True)))


def best_rows(most: int):
    """A block's best ``most`` rows for each anchor; the block holds rows of the anchors' label."""

    def answer(block: Block, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, vecs, out = batch["id"].to_numpy(), matrix(batch["vec"]), []
        for part, low, high in block.tiles(batch):
            own = ids[part][:, None] == block.ids[None, :]
            low[own], high[own] = -LIMIT, -LIMIT
            edge = np.full(len(low), -LIMIT)
            if len(block.ids) > most:
                edge = np.partition(low, len(block.ids) - most, axis=1)[:, len(block.ids) - most]
            a, r = np.nonzero((high >= edge[:, None]) & ~own)
            score = block.scores(vecs[part], a, r)
            best = first_of_each(a, score, block.ids[r], most)
            out.append((ids[part][a[best]], np.zeros(len(best), np.int32), block.ids[r[best]], score[best]))
        return _joined(out)

    return answer


def rows_in_windows(most: int):
    """For each window of each anchor the block's best ``most`` rows of other labels inside it."""

    def answer(block: Block, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, vecs, out = batch["id"].to_numpy(), batch["label"].to_numpy(), matrix(batch["vec"]), []
        windows = batch["windows"]
        ends = windows.offsets.to_numpy()
        flat = windows.values
        owner = np.repeat(np.arange(len(ids)), np.diff(ends))
        flat = flat.slice(ends[0], ends[-1] - ends[0])
        slot, low_end, high_end = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("slot", "low", "high"))
        for part, low, high in block.tiles(batch):
            usable = (labels[part][:, None] != block.labels[None, :]) & (ids[part][:, None] != block.ids[None, :])
            mine = np.flatnonzero((owner >= part.start) & (owner < part.start + len(low)))
            touched = np.zeros_like(usable)
            for w in mine:
                k = owner[w] - part.start
                touched[k] |= (high[k] >= low_end[w]) & (low[k] <= high_end[w])
            a, r = np.nonzero(touched & usable)
            score = block.scores(vecs[part], a, r)
            starts = np.searchsorted(a, np.arange(len(low) + 1))
            hits, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for w in mine:
                k = owner[w] - part.start
                own = slice(starts[k], starts[k + 1])
                inside = np.flatnonzero((score[own] >= low_end[w]) & (score[own] <= high_end[w])) + starts[k]
                hits.append(inside)
                of.append(np.full(len(inside), w))
            hit, w = np.concatenate(hits), np.concatenate(of)
            best = first_of_each(w, score[hit], block.ids[r[hit]], most)
            hit, w = hit[best], w[best]
            out.append((ids[owner[w]], slot[w], block.ids[r[hit]], score[hit]))
        return _joined(out)

    return answer


def cells_within_reach(anchors: DataFrame, n: np.ndarray, short: np.ndarray, long: np.ndarray, least: np.ndarray, most: np.ndarray) -> DataFrame:
    """The blocks of every cell whose ranges of angles and lengths allow a score in one of the anchor's windows."""
    names = ["id", "label", "vec", "norm", "angles", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            norms, angles = batch["norm"].to_numpy(), matrix(batch["angles"], "float64")
            near, far = np.zeros((len(norms), len(n))), np.full((len(norms), len(n)), np.pi)
            for r in range(angles.shape[1]):
                x = angles[:, r, None]
                np.maximum(near, np.maximum(x - most[None, :, r], least[None, :, r] - x), out=near)
                np.minimum(far, np.minimum(x + most[None, :, r], 2 * np.pi - x - least[None, :, r]), out=far)
            low, high = whole_bounds(near, np.maximum(far, near), norms[:, None], short[None, :], long[None, :])
            windows = batch["windows"]
            flat = windows.flatten()
            owner = np.repeat(np.arange(len(norms)), np.diff(windows.offsets.to_numpy()))
            touched = np.zeros(low.shape, bool)
            reach = (high[owner] >= flat.field("low").to_numpy()[:, None]) & (low[owner] <= flat.field("high").to_numpy()[:, None])
            np.logical_or.at(touched, owner, reach)
            q, cell = np.nonzero(touched & (n[None, :] > 0))
            q, cell, sub = _deal(q, cell, n)
            for a in range(0, len(q), 4_096):
                part = slice(a, a + 4_096)
                yield pa.RecordBatch.from_arrays([pa.array(cell[part]), pa.array(sub[part]), *(batch[c].take(pa.array(q[part])) for c in names)], ["cell", "sub", *names])

    window = "array<struct<slot:int,low:long,high:long>>"
    return anchors.select(*names).mapInArrow(run, f"cell long, sub long, id long, label long, vec array<long>, norm double, angles array<double>, windows {window}")


def _deal(q: np.ndarray, cell: np.ndarray, subs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (anchor, cell) once for each block of the cell."""
    many = subs[cell]
    sub = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(q, many), np.repeat(cell, many).astype(np.int64), sub.astype(np.int64)


def mine(
    vectors: DataFrame, anchors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    A component x is taken as floor(256 * x); a score is the whole-number inner
    product with the anchor. An anchor's positives are its ``positives`` best
    other rows of its label (ties to the smaller id). For each, the best
    ``negatives`` rows of other labels whose score is at least 50 and at most
    95 hundredths of the positive's. Anchors without positives, and positives
    without such rows, give no rows.

    Rows of the anchor's own id are neither. Repeated rows count once each, so
    a repeated positive has its own ``positive_rank`` and rows. Of several
    anchor rows with one id the one of smallest label, then vector (in array
    order), asks. Zero vectors take part; rows without an id or a label, NULL
    vectors, vectors with NULL or non-finite components, and vectors of another
    length than the most usual one don't. Components so large that a hundred
    times a score doesn't fit in a long are an error. Other columns are ignored.
    An empty table or no anchor gives an empty result.
    """
    spark = vectors.sparkSession
    label = F.col(label_col).cast("long").alias("label")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    known = vectors.where(F.col(label_col).isNotNull())
    whole = stage(whole_vectors(known, id_col, vec_col, label), "whole-vectors")
    n, d, _ = check_range(whole, LIMIT)
    asking = whole_vectors(anchors.where(F.col(label_col).isNotNull()), id_col, vec_col, label, length=d)
    asking = asking.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec")
    if not n or not asking.count():
        return spark.createDataFrame([], schema)
    directions = references(sample_vectors(whole, n, SAMPLE), REFERENCES)
    rows = stage(with_angles(whole, directions).withColumn("place", F.monotonically_increasing_id()), "angles")
    asking = stage(with_angles(asking, directions).drop("cell"), "anchors")
    many = asking.count()

    labels = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).alias("subs"))
    by_label = rows.drop("cell").join(labels, "label").withColumn("sub", F.pmod("place", "subs")).drop("place", "subs")
    asked = asking.join(labels, "label").withColumn("sub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1))).drop("subs")
    near = sweep(by_label, asked, ["label", "sub"], many, Block, best_rows(positives), FOUND)
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    near = near.withColumn("slot", place).where(F.col("slot") <= positives)
    near = stage(near.select("anchor_id", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Least and largest whole score of each window.
    low = -F.floor(-(F.col("positive_score") * LOW).cast("decimal(20,0)") / 100).cast("long")
    high = F.floor((F.col("positive_score") * HIGH).cast("decimal(20,0)") / 100).cast("long")
    windows = near.withColumn("low", low).withColumn("high", high).where("low <= high")
    windows = windows.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("slot", "low", "high"))).alias("windows"))
    ranges = rows.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("norm").alias("short"), F.max("norm").alias("long"),
        *(f(F.col("angles")[r]).alias(f"{name}{r}") for r in range(len(directions)) for f, name in ((F.min, "least"), (F.max, "most"))),
    ).collect()  # fmt: skip  (a row a direction)
    subs, short, long = np.zeros(len(directions), np.int64), np.zeros(len(directions)), np.zeros(len(directions))
    least, most = np.zeros((len(directions),) * 2), np.zeros((len(directions),) * 2)
    for c in ranges:
        subs[c.cell], short[c.cell], long[c.cell] = -(-c.n // block), c.short, c.long
        least[c.cell] = [c[f"least{r}"] for r in range(len(directions))]
        most[c.cell] = [c[f"most{r}"] for r in range(len(directions))]
    dealt = F.get(F.array(*(F.lit(int(max(1, s))).cast("long") for s in subs)), F.col("cell").cast("int"))
    by_cell = rows.withColumn("sub", F.pmod("place", dealt)).drop("place")
    reach = cells_within_reach(asking.join(windows, "id"), subs, short, long, least, most)
    hard = sweep(by_cell, reach, ["cell", "sub"], many, Block, rows_in_windows(negatives), FOUND)
    order = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id"))
    hard = hard.withColumn("rank", order).where(F.col("rank") <= negatives)
    return hard.join(near, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("slot").alias("positive_rank")
    )


def relabelled(vectors: DataFrame) -> DataFrame:
    """The table with the labels of every seventh id moved to the next of ten."""
    label: Column = F.col("label").cast("long")
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def query(vectors: DataFrame) -> DataFrame:
    moved = relabelled(vectors)
    return mine(moved, moved.where(F.col("vec_id") % EVERY == 0))


SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.w, c.w) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, p.positive_rank, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_rank ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE p.positive_rank <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank FROM n WHERE rank <= 3
"""
