import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import parity_join

from .edge import edge_docs, empty_docs, rows


def sets_of(docs, words):
    out = []
    for d, t in docs:
        w = (t or "").encode().lower().split()
        s = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        out.append((d, s))
    return out


def brute(docs, words=4, percent=85):
    sets = sets_of(docs, words)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            e, b = sets[j]
            if a and b and d is not None and e is not None:
                if 100 * len(a & b) >= percent * len(a | b):
                    root[find(i)] = find(j)
    low = {}
    for i, (d, s) in enumerate(sets):
        if d is not None and s:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low[find(i)] if d is not None and s else d) for i, (d, s) in enumerate(sets)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def run(df, **kw):
    return sorted(map(tuple, parity_join.jaccard_groups(df, **kw).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_edge_rows(spark):
    docs = [(r[0], r[1]) for r in rows()]
    assert run(edge_docs(spark, ("n", "key", "rep", "c1"))) == brute(docs)
    assert run(empty_docs(spark)) == []


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 60)])
def test_random_edits_of_every_size(spark, words, percent):
    """Copies with few to many edits: similarities on both sides of the threshold, short and long texts, chains."""
    rng = random.Random(words)
    docs, vocab = [], [f"w{i}" for i in range(3000)]
    for n in (1, 2, 3, 5, 6, 7, 8, 9, 10, 12, 14, 20, 33, 60, 100, 250, 700):
        for _ in range(3):
            base = [rng.choice(vocab) for _ in range(n)]
            for _ in range(8):
                text = list(base)
                for _ in range(rng.randint(0, max(1, n // 18))):
                    at = rng.randrange(len(text))
                    kind = rng.random()
                    if kind < 0.5:
                        text[at] = rng.choice(vocab)
                    elif kind < 0.75:
                        text.insert(at, rng.choice(vocab))
                    elif len(text) > 1:
                        del text[at]
                docs.append(" ".join(text).upper() if rng.random() < 0.2 else " ".join(text))
                if rng.random() < 0.3:
                    base = text  # a chain
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert run(df, words=words, percent=percent) == brute(docs, words, percent)


def test_large_groups_of_copies_and_shared_passages(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    base = [f"b{i}" for i in range(200)]
    docs = [" ".join(base)] * 120
    for _ in range(150):
        t = list(base)
        t[rng.randrange(len(t))] = f"x{rng.random()}"
        docs.append(" ".join(t))
    docs += [passage + " " + " ".join(f"q{rng.random()}" for _ in range(rng.randint(30, 90))) for _ in range(150)]
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    assert run(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_keys_of_linked_sets_meet():
    """The pigeonhole bound: any two sets within the distance share a key."""
    rng = np.random.default_rng(5)
    for n in (6, 7, 11, 12, 13, 19, 28, 29, 50, 97, 400, 1001):
        for _ in range(40):
            common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            extra = n * 100 // 85 - n
            a = np.unique(common)
            b = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, extra, dtype=np.uint64)]))
            if 100 * len(a) >= 85 * len(b) and len(a) != len(b):
                assert np.intersect1d(parity_join.block_keys(a, 85), parity_join.block_keys(b, 85)).size, n


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(6)
    for n in (5, 300, 20_000):
        s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        t = np.unique(np.concatenate([s[: n * 2 // 3], rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)]))
        apart = sum(int(x).bit_count() for x in parity_join.sketch(s) ^ parity_join.sketch(t))
        assert apart <= len(np.setxor1d(s, t))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(300, 301), (302, 301)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links]
    got = dict(map(tuple, parity_join.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 260)}, 300: 300, 301: 300, 302: 300}


def test_sketches_of_two_lengths_are_compared_at_the_shorter(spark):
    """The larger set's sketch is folded; what is left still bounds the difference from below."""
    rng = np.random.default_rng(8)
    rows, apart = [], []
    for n, m in ((250, 262), (500, 530), (4000, 4200), (100, 2000)):
        s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        t = np.unique(np.concatenate([s, rng.integers(0, 1 << 63, m - n, dtype=np.uint64)]))
        one, other = parity_join.sketch(s), parity_join.sketch(t)
        rows.append((len(rows), one.view(np.int64).tolist(), other.view(np.int64).tolist()))
        apart.append(len(t) - len(s))
    df = spark.createDataFrame(rows, "i int, a array<long>, b array<long>")
    got = [r.d for r in df.orderBy("i").select(parity_join.sketch_distance("a", "b").alias("d")).collect()]
    back = [r.d for r in df.orderBy("i").select(parity_join.sketch_distance("b", "a").alias("d")).collect()]
    assert len(rows[1][1]) * 2 == len(rows[1][2]) and got == back
    assert all(0 < d <= x for d, x in zip(got[:3], apart[:3], strict=True)) and got[3] is None


def test_a_common_key_in_blocks_gives_the_pairs_of_the_join(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    rows = []
    for i in range(150):
        s = np.unique(np.concatenate([base[: rng.integers(150, 300)], rng.integers(0, 1 << 63, rng.integers(0, 60), dtype=np.uint64)]))
        rows.append((7 if i % 3 else 8, 150, i, i // 4, len(s), parity_join.sketch(s).view(np.int64).tolist()))
    df = spark.createDataFrame(rows, "key long, size long, rep long, group long, n long, sketch array<long>")
    want = {tuple(r) for r in parity_join.near_pairs(df.withColumn("size", F.lit(2)), 85).collect()}
    monkeypatch.setattr(parity_join, "BLOCK_MEMBERS", 40)
    got = [tuple(r) for r in parity_join.near_pairs(df, 85).collect()]
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 100
    assert len(got) < 4 * len(want)  # folded to the shortest sketch, a few more may pass


def test_pairs_just_beyond_the_limit_do_not_leave_a_common_key(spark):
    """A large group whose members differ by a little too much: short sketches let a share of all its pairs pass, marks none."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(40)]  # 37 shingles; two changed words, 8 to 16 shingles apart: the limit is 6
    docs, rows = [], []
    for i in range(200):
        words = list(base)
        words[int(rng.integers(4, 36))] = f"x{i}"
        docs.append((i, " ".join(words)))
        s = parity_join.shingle_sets([docs[-1][1]], 4)[0]
        rows.append((1, 202, i, i, len(s), parity_join.sketch(s).view(np.int64).tolist()))
    for i, text in ((200, "one two three four " + " ".join(base)), (201, " ".join(base) + " five")):  # these two link
        docs.append((i, text))
        s = parity_join.shingle_sets([text], 4)[0]
        rows.append((1, 202, i, i, len(s), parity_join.sketch(s).view(np.int64).tolist()))
    members = spark.createDataFrame(rows, "key long, size long, rep long, group long, n long, sketch array<long>")
    table = spark.createDataFrame([*docs, docs[3], (5, "another text")], "doc_id long, text string")  # a repeated row, an id with two texts
    sets = dict(zip((d for d, _ in docs), (set(s.tolist()) for s in parity_join.shingle_sets([t for _, t in docs], 4)), strict=True))
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in parity_join.near_pairs(members, 85, lambda m: parity_join.with_marks(m, table, 4)).collect()]
    assert sorted(got) == sorted(want) and (200, 201) in want
    assert parity_join.near_pairs(members, 85).count() > len(want) + 50
