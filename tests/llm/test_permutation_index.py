import numpy as np
import pytest

from clickmart.llm import permutation_index


def exact(ids, vecs, top=20):
    out = {}
    for q in sorted(i for i in set(ids) if i % 20 == 0):
        v = vecs[ids.index(q)]
        s = np.array([float(np.dot(v, w)) for w in vecs])
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-s[j], ids[j]))[:top]
        out[q] = [(ids[j], s[j]) for j in order]
    return out


def frame(spark, ids, vecs):
    return spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in zip(ids, vecs)], "vec_id long, embedding array<float>, label int")


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_small_table_is_exact_with_ties(spark):
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(300, 16)).astype("f4")
    vecs[100:160] = vecs[40]  # copies: ties go to smaller ids
    got, want = by_query(permutation_index.query(frame(spark, list(range(300)), vecs))), exact(list(range(300)), vecs.astype("f8"))
    assert set(got) == set(want)
    for q, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [(r[1]) for r in rows] == [i for i, _ in want[q]]
        assert [r[2] for r in rows] == pytest.approx([s for _, s in want[q]], abs=1e-12)


@pytest.mark.parametrize("kind", ["clusters", "uniform", "lengths"])
def test_recall_against_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    n = 6000
    vecs = rng.normal(size=(n, 32))
    if kind == "clusters":
        vecs = rng.normal(size=(40, 32))[rng.integers(0, 40, n)] + 0.4 * vecs
    if kind != "lengths":
        vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    vecs = vecs.astype("f4")
    df = frame(spark, list(range(n)), vecs)
    got = by_query(permutation_index.query(df))
    full = vecs.astype("f8")
    hit = total = 0
    for q in range(0, n, 20):
        s = full @ full[q]
        s[q] = -np.inf
        want = set(np.argsort(-s, kind="stable")[:20].tolist())
        hit += len(want & {r[1] for r in got[q]})
        total += 20
    assert hit / total >= 0.9, hit / total


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (1, [0.5, 0.5]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 1.0]), (120, [1.0, 2.0, 3.0]), (3, [])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, block string, score string")
    assert by_query(permutation_index.query(df)) == {0: [(1, 2, 2.0), (2, 2, 2.0), (3, 1, 0.5)]}
    assert permutation_index.query(df.limit(0)).count() == 0
    assert permutation_index.query(df.where("vec_id = 1")).count() == 0
    assert permutation_index.query(df.where("vec_id = 0")).count() == 0


def test_footrule_agreement_of_inverted_files():
    rng = np.random.default_rng(9)
    orders = np.stack([rng.permutation(20)[:6] for _ in range(50)]).astype("i4")
    files = permutation_index.InvertedFiles(orders, 20)
    q = rng.permutation(20)[:6]
    place = lambda o, p: list(o).index(p) if p in o else 6
    footrule = [sum(abs(place(q, p) - place(o, p)) for p in range(20)) for o in orders]
    most = 2 * sum(6 - i for i in range(6))
    assert [most - g for g in files.agreement(q)] == footrule


@pytest.mark.parametrize("block", [16_384, 500])
def test_recall_on_the_given_embeddings(spark, monkeypatch, block):
    """Of the true 20 nearest of the table's own queries, in one block and in several blocks and batches."""
    monkeypatch.setattr(permutation_index, "BLOCK", block)
    monkeypatch.setattr(permutation_index, "BATCH", 1_024 if block > 500 else 40)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, full = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = by_query(permutation_index.search(df, df.where("vec_id % 20 = 0"), least=0))
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = full @ full[i]
        s[i] = -np.inf
        want = set(ids[np.argsort(-s, kind="stable")[:20]].tolist())
        found = [r[1] for r in got[ids[i]]]
        assert len(found) == len(set(found)) == 20
        hit += len(want & set(found))
        total += 20
    print("recall", hit / total)
    assert hit / total >= 0.9
