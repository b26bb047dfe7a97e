from collections import defaultdict

import pytest

from clickmart.llm import mixing

from .edge import edge_docs, empty_docs


def fill(sizes, weights, most):
    """Textbook water-filling: clamp, share the excess again, until none is above."""
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        level = left / sum(weights[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weights[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weights[s] for s in sizes}
        capped |= over


def test_targets_and_takes(spark):
    docs = [(i, "w " * (1 + i * 7 % 90), f"s{i * i % 11}" if i % 13 else None) for i in range(4000)]
    docs += [(10_000 + i, "w " * 30, "hot") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.mix(df).toPandas()
    sizes, longest = defaultdict(int), 0
    for _, t, s in docs:
        sizes[s] += len(t.split())
        longest = max(longest, len(t.split()))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = fill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    got["source"] = got["source"].astype(object).where(got["source"].notna(), None)
    taken = got.groupby("source", dropna=False)["taken"].sum()
    for r in got.drop_duplicates("source").itertuples():
        s = r.source if isinstance(r.source, str) else None
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-12)
    for s, t in taken.items():
        s = s if isinstance(s, str) else None
        assert abs(t - want[s]) <= longest
    assert (got.taken <= 3 * got["size"]).all() and (got.taken == got["copies"] * got["size"]).all()
    again = mixing.mix(df.repartition(13)).toPandas().sort_values("doc_id")
    assert list(again.taken) == list(got.sort_values("doc_id").taken)


def test_other_weights_and_caps(spark):
    df = spark.createDataFrame([(i, "a b c", f"s{i % 3}") for i in range(90)], "doc_id long, text string, source string")
    got = mixing.mix(df, weights=(1, 0, 9), max_epochs=2).toPandas()
    by = got.groupby("source").taken.sum()
    assert by["s1"] == 0 and by["s2"] == 180 and by["s0"] == 90


def test_edge_rows(spark):
    docs = edge_docs(spark, ("size", "target", "_draw", "taken", "place"))
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    by = {(r.doc_id, r.text): r for r in got}
    assert by[(2, None)]["size"] == 0 and by[(3, "")].taken == 0 and by[(9, "x")].place == "clash"
    assert mixing.query(empty_docs(spark)).count() == 0
