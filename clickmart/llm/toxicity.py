"""Operator 6, toxicity by subword-bag embeddings.

A word is the mean of the embeddings of its character n-grams (and of itself),
a text the mean of its words, and a linear softmax gives its class; embeddings
and softmax are trained jointly in numpy on a bounded sample of labelled rows.
A misspelling nobody has seen shares most n-grams, and so most of its vector,
with the word it spells.

The model is linear above the embeddings, so scoring needs one number a bucket
(512 KB, the same at every size); each distinct word is worked out once a worker.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import text_of
from clickmart.llm.tokens import chunks, worker_kept

BUCKETS, WIDTH = 1 << 17, 8
SHORTEST, LONGEST = 3, 5
#: Most training documents of each class (taken by a hash of their id); all words of each are used.
SAMPLE_DOCS = (6_000, 3_000)
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.5, 1e-6
FOLDS = 5
CACHE_WORDS = 400_000
#: Bytes of texts that are strings at a time.
CHUNK_BYTES = 1 << 19
_WORD = re.compile(r"\w+")


class Model(NamedTuple):
    """``margins``: what each bucket adds to the log odds of label 1; ``bias``: the rest."""

    margins: np.ndarray
    bias: float


def subwords(word: str) -> list[int]:
    """Buckets of the word and of its character n-grams, its ends marked."""
    w = f"<{word}>"
    grams = {w} | {w[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(w) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in sorted(grams)]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Bags(NamedTuple):
    """Distinct words of documents and how often each has them: document i has the entries ``ends[i]`` to ``ends[i + 1]``."""

    lexicon: list[str]
    words: np.ndarray  # places in the lexicon
    counts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, words: pa.ListArray, counts: pa.ListArray) -> Bags:
        """From columns of lists; strings are made of the distinct words only."""
        coded = words.flatten().dictionary_encode()
        return cls(coded.dictionary.to_pylist(), coded.indices.to_numpy(), counts.flatten().to_numpy(), words.offsets.to_numpy() - words.offsets[0].as_py())


def slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of many slices, one after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def train(bags: Bags, labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Joint training of embeddings and softmax: Adagrad on the weighted log loss, a batch of documents at a time.

    ``weights`` are what a document counts for. With one class only, or none,
    the model knows no words.
    """
    total = weights.sum()
    share = float((weights * labels).sum() / total) if total else 0.0
    share = min(max(share, 1e-4), 1 - 1e-4)
    prior = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, dtype=np.float32), prior)
    grams, sizes = array("i"), array("q")
    for word in bags.lexicon:
        own = subwords(word)
        grams.extend(own)
        sizes.append(len(own))
    flat, sizes = np.frombuffer(grams, np.intc), np.frombuffer(sizes, np.int64)
    firsts = np.cumsum(sizes) - sizes
    lengths = np.diff(bags.ends)
    n_words = np.maximum(1, np.add.reduceat(np.append(bags.counts, 0), bags.ends[:-1]) * (lengths > 0))

    rng = np.random.default_rng(7)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    soft = rng.normal(0, 1.0, WIDTH).astype(np.float32)  # the two classes' difference
    bias = np.float32(prior)
    seen, seen_soft, seen_bias = np.full(BUCKETS, 1e-8, dtype=np.float32), np.full(WIDTH, 1e-8, dtype=np.float32), np.float32(1e-8)
    weight = (weights / weights.mean()).astype(np.float32)
    trained = np.zeros(BUCKETS, dtype=bool)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            entry = slices(bags.ends[docs], lengths[docs])  # distinct words of these documents
            of = np.repeat(np.arange(len(docs)), lengths[docs])
            word = bags.words[entry]
            row, doc = flat[slices(firsts[word], sizes[word])], np.repeat(of, sizes[word])
            part = np.repeat(SCALE * bags.counts[entry] / n_words[docs][of] / sizes[word], sizes[word]).astype(np.float32)
            project = table[row] @ soft  # of each entry
            odds = np.bincount(doc, part * project, minlength=len(docs)) + bias
            error = ((1 / (1 + np.exp(-odds)) - labels[docs]) * weight[docs] / len(docs)).astype(np.float32)
            pull = error[doc] * part
            used, where = np.unique(row, return_inverse=True)
            by_row = np.bincount(where, pull, minlength=len(used)).astype(np.float32)
            to_soft = by_row @ table[used] + DECAY * soft
            to_rows = by_row[:, None] * soft[None, :] + DECAY * table[used]
            seen[used] += (to_rows * to_rows).mean(axis=1)
            table[used] -= rate / np.sqrt(seen[used])[:, None] * to_rows
            seen_soft += to_soft * to_soft
            soft -= rate / np.sqrt(seen_soft) * to_soft
            seen_bias += error.sum() ** 2
            bias -= rate / np.sqrt(seen_bias) * error.sum()
            trained[used] = True
    margins = np.where(trained, table @ soft * np.float32(SCALE), 0).astype(np.float32)
    return Model(margins, float(bias))


#: Text vectors are means over hundreds of words; this brings them to the size of one word's.
SCALE = 20.0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: tuple[int, int] = SAMPLE_DOCS) -> Model:
    """Train on labelled rows (doc_id, ``label`` 0 or 1): at most about ``sample`` documents of each class.

    The sample is weighted back to the classes' true shares. Rows without a label
    or id are left out; a document with several labels has the largest. Long texts
    are taken whole, NULL texts as empty; a repeated document counts each time.
    Without labelled documents the model is a prior of almost 0.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("_label"))
    count = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = {c: min(1.0, sample[c] / max(1, count.get(c, 0))) for c in (0, 1)}
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30))
    chosen = known.where(draw < F.when(F.col("_label") == 1, int(share[1] * (1 << 30))).otherwise(int(share[0] * (1 << 30)))).limit(2 * sum(sample))

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_kept("margins", dict)  # what earlier steps have kept goes
        for batch in batches:
            words, counts = [], []
            for text in batch.column("text").to_pylist():
                c = sorted(Counter(words_of(text)).items())
                words.append([w for w, _ in c])
                counts.append([n for _, n in c])
            columns = [batch.column("doc_id"), batch.column("_label"), pa.array(words, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_label", "words", "counts"])

    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # the sample's size is bounded
    rows = texts.mapInArrow(bag, "doc_id long, _label int, words array<string>, counts array<int>").toArrow()
    rows = rows.take(pa.compute.sort_indices(rows, [("doc_id", "ascending")])).combine_chunks()
    y = rows["_label"].to_numpy().astype(np.float32)
    weights = np.where(y > 0, 1 / max(share[1], 1e-12), 1 / max(share[0], 1e-12))
    bags = Bags.of(*(rows[c].combine_chunks() if rows[c].num_chunks != 1 else rows[c].chunk(0) for c in ("words", "counts")))
    return train(bags, y, weights)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of its whole text, from the text alone.

    NULL and empty texts, and texts without words, have the model's prior; long
    texts are scored whole. An empty table gives an empty one.
    Repeated texts score alike. Other columns pass through; one named ``column``
    is replaced.
    """
    margins, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("toxicity", zlib.crc32(margins.tobytes()))
        kept = worker_kept("margins", dict)
        if key not in kept:
            kept.clear()  # another model's words
        known = kept.setdefault(key, {})
        for batch in batches:
            out = []
            for text in (t for part in chunks(batch.column(batch.num_columns - 1), CHUNK_BYTES) for t in part.to_pylist()):
                words = words_of(text)
                new = set(words).difference(known)
                if len(known) + len(new) > CACHE_WORDS:
                    known.clear()
                    new = set(words)
                for w in new:
                    known[w] = float(margins[subwords(w)].mean(dtype=np.float64))
                odds = bias + sum(map(known.__getitem__, words)) / max(1, len(words))
                out.append(1 / (1 + np.exp(-odds)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], [*batch.schema.names[:-1], column])

    kept = docs.drop(column)
    schema = kept.schema.add(column, "double")
    return kept.select("*", text_of().alias(f"_{'_'.join(kept.columns)}")).mapInArrow(run, schema)  # a name that is in no table


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels whose crc32(doc_id) mod 5 is not 0."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, training_rows(labels))
    scored = score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
