"""Exact top-k search against all scores."""

import math

import numpy as np
import pytest

from clickmart.llm import exact_topk, vectors
from clickmart.llm.exact_topk import LAST, NONE, BallTree, Search

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute(rows, top=5, every=50):
    """(query_id, rank, vec_id, score) with Python's own whole numbers."""
    rows = [(i, whole(v)) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        own = min(v for i, v in rows if i == q)
        found = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in rows if i != q)
        out += [(q, k, i, -s) for k, (s, i) in enumerate(found[:top], 1)]
    return out


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def search(spark, rows, **kw):
    df = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in rows], SCHEMA).repartition(3)
    return result(exact_topk.search(df, df.where("vec_id % 50 = 0"), **kw))


def clusters(n, d, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(12, d))[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, d))
    return [(i, v) for i, v in enumerate(at.tolist())]


@pytest.mark.parametrize("shard", [64, 300, 8192])
def test_many_cells_and_shards(spark, shard):
    rows = clusters(1200, 8, 1)
    assert search(spark, rows, shard=shard) == brute(rows)


def test_hot_vector_and_ties(spark):
    """A third of all rows is one vector: its cell has several shards, and ties go to the smallest ids."""
    rows = clusters(900, 6, 2)
    rows = [(i, rows[7][1]) if i % 3 == 0 else (i, [round(x) / 4 for x in v]) for i, v in rows]
    assert search(spark, rows, shard=50) == brute(rows)


def test_questions_over_copies_of_blocks_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ASKED", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = clusters(600, 5, 3)
        assert search(spark, rows, shard=100) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [0.0, 0.0]), (50, [1.5, -2.0]), (50, [1.0, 9.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [-1.0, 0.3]), (100, [-0.001, 0.001]), (-50, [2.0, 2.0])]
    bad = [(150, None), (200, [1.0, None]), (250, [nan, 1.0]), (7, [inf, 0.0]), (None, [1.0, 1.0]), (300, [1.0, 2.0, 3.0]), (350, [])]
    clash = "vec_id long, embedding array<float>, id string, vec string, cell string, score string, rank string, edge string"
    df = spark.createDataFrame([(i, v, "x", "x", "x", "x", "x", "x") for i, v in good + bad], clash)
    assert result(exact_topk.query(df)) == brute(good)


def test_empty_and_lone_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_topk.query(empty).collect() == []
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []  # no query
    assert search(spark, [(50, [1.0])]) == []  # no other row
    assert search(spark, [(50, [1.0]), (3, [-1.0])]) == [(50, 1, 3, -65536)]


def test_scores_beyond_exact_doubles(spark):
    rows = [(i, [2.0**22 + i, 3.0 - 2**21 * (i % 2), float(i)]) for i in range(120)]
    assert search(spark, rows, shard=20) == brute(rows)
    with pytest.raises(ValueError, match="fit in a long"):
        search(spark, [(50, [1e10]), (1, [1e10])])


def test_no_cross_join_and_no_whole_table_window(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 1) for i in range(100)], SCHEMA)
    plan = exact_topk.query(df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_tree_leaves_out_nodes_and_a_shared_score_more():
    """On clustered rows most leaves are never scored, fewer still with another shard's k-th score."""
    rows = clusters(4000, 8, 5, 0.1)
    vecs = np.array([whole(v) for _, v in rows])
    ids = np.arange(len(vecs))
    tree = BallTree(ids, vecs, 64)
    own, asked = ids[::50], vecs[::50]
    alone = Search(tree, own, asked, np.full(len(own), NONE), np.full(len(own), LAST), 5)
    assert alone.scored < 0.5 * len(own) * len(vecs)
    for i, q in enumerate(own):
        score = vecs @ asked[i]
        want = sorted((-score[j], j) for j in ids if j != q)[:5]
        assert [(-s, j) for s, j in zip(alone.score[i], alone.ids[i], strict=True)] == want
    shared = Search(tree, own, asked, alone.score[:, -1], alone.ids[:, -1], 5)
    assert shared.scored < alone.scored


def test_a_copy_heavy_tree_scores_few_copies():
    """With a thousand copies of the best row only those of the smallest ids are looked at."""
    vecs = np.tile([[300, 0]], (2000, 1))
    tree = BallTree(np.arange(2000), vecs, 50)
    s = Search(tree, np.array([-1]), np.array([[256, 0]]), np.array([NONE]), np.array([LAST]), 5)
    assert s.ids.tolist() == [[0, 1, 2, 3, 4]] and s.scored <= 200
