import random

import numpy as np
import pyarrow as pa
import pytest

from clickmart.llm import toxicity

from .edge import edge_docs, empty_docs

INSULTS = ["idiot", "worthless", "moronic"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(1 + len(words) // 15):
                w = rng.choice(INSULTS)
                if rng.random() < 0.5:  # a misspelling of its own
                    at = rng.randrange(1, len(w))
                    w = w[:at] + rng.choice("xyz") + w[at:]
                words.insert(rng.randrange(len(words)), w)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    truth = np.asarray(truth, dtype=bool)
    return (ranks[truth].mean() - (truth.sum() - 1) / 2) / (~truth).sum()


def test_held_out_accuracy_and_unseen_misspellings(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.query(d, lab).toPandas().set_index("doc_id")
    truth = dict(labels)
    held = got[got.held_out]
    assert 100 < len(held) < 300
    t = np.array([truth[i] for i in held.index])
    assert auc(held.score.to_numpy(), t) > 0.97 and (held.predicted == t).mean() > 0.93
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.5)).all()
    model = toxicity.fit(d, toxicity.training_rows(lab))
    new = spark.createDataFrame([(1, "abc dag idiqot hag bec"), (2, "abc dag bhhge hag bec")], "doc_id long, text string")
    s = {r.doc_id: r.score for r in toxicity.score(new, model).collect()}
    assert s[1] > 0.5 > s[2]


def test_scores_do_not_depend_on_held_out_labels_or_order(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    import zlib

    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    a, b = (
        {r.doc_id: r.score for r in toxicity.query(x, spark.createDataFrame(y, "doc_id long, toxic int")).collect()}
        for x, y in ((d, labels), (d.repartition(5), flipped))
    )
    assert a == b


def test_edge_rows_and_tables(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 0), (6, 1), (6, 0), (None, 1), (9, None), (77, 1)], "doc_id long, toxic int")
    docs = edge_docs(spark, ("score", "label", "_label", "words"))
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 for r in got) and got[0]["label"] == "clash"
    prior = 1 / (1 + np.exp(-model.bias))
    assert [r.score for r in got if r.text in (None, "", "\n\n\n")] == pytest.approx([prior] * 3)
    assert toxicity.query(empty_docs(spark), labels).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0))
    assert all(r.score < 0.5 for r in toxicity.score(docs, nothing).collect())
    one_class = toxicity.fit(docs, labels.where("toxic = 1"))
    assert all(r.score > 0.5 for r in toxicity.score(docs, one_class).collect())


def test_every_word_of_a_long_training_text_counts(spark):
    """The marked word is one of 20,000 distinct words of its documents; no sample of words is taken."""
    rng = random.Random(5)
    filler = [f"{a}{b}{c}{d}" for a in "bcdfghjklmnp" for b in "aeiou" for c in "bcdfghjklmnprst" for d in range(25)]
    long = [(i, " ".join(rng.sample(filler, 20_000) + (["zzyzzyx"] * 400 if i % 2 else []))) for i in range(1, 25)]
    docs = spark.createDataFrame(long, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in long], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    word = {w: float(model.margins[toxicity.subwords(w)].mean()) for w in ["zzyzzyx", *filler[:200]]}
    assert max(word, key=word.get) == "zzyzzyx"


def test_bags_of_sliced_columns():
    words, counts = pa.array([["x"], ["a", "b"], [], ["b", "c"]]), pa.array([[9], [1, 2], [], [3, 4]], pa.list_(pa.int32()))
    bags = toxicity.Bags.of(words.slice(1), counts.slice(1))
    assert [bags.lexicon[i] for i in bags.words] == ["a", "b", "b", "c"]
    assert bags.counts.tolist() == [1, 2, 3, 4] and bags.ends.tolist() == [0, 2, 2, 4]
