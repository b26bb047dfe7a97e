"""The pipeline's stages against brute force on a small folder of tables."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from clickmart.llm import toxicity
from clickmart.llm.tokens import tokenizer_path
from clickmart.session import staging_path

from .edge import empty_docs, rows
from .test_line_dedup import brute as brute_lines
from .test_mixing import fill
from .test_packing import whole_ids
from .test_parity_join import brute as brute_groups


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(8)
    docs = []
    for i in range(300):
        words = [f"v{rng.randrange(2000)}" for _ in range(rng.randint(8, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "worthless", "moron"]))
        text = " ".join(words) + ("\nAll rights reserved by nobody" if i % 3 == 0 else "")
        docs.append((100 + i, text, "en", f"s{i % 5}", len(text), int(toxic)))
    for i in range(60):  # near copies of clean documents
        d = docs[i * 2 + 1]
        docs.append((1000 + i, d[1] + (" more" if len(d[1].split()) > 40 else ""), "de", "s9", d[4], d[5]))
    docs += [(*r, 0) for r in rows() if r[4] is None or r[4] < 1000]
    path = staging_path(spark, "t-pipeline")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, toxic int")
    df.drop("toxic").write.parquet(f"{path}/documents.parquet")
    df.where("doc_id >= 100").selectExpr("doc_id", "1 AS quality", "toxic").write.parquet(f"{path}/labels.parquet")
    return path


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    toxic, lines, near, mix, pack = (f for _, f in corpus_pipeline.STAGES)

    clean = toxic(spark, docs, folder)
    assert clean.columns == columns
    model = toxicity.fit(docs, toxicity.training_rows(spark.read.parquet(f"{folder}/labels.parquet")))
    want = Counter((r.doc_id, r.text) for r in toxicity.score(docs, model).collect() if r.score < 0.5)
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == want
    bad = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    assert len(bad & {d for d, _ in want}) <= 5 and sum(want.values()) >= docs.count() - len(bad) - 3

    cut = lines(spark, clean, folder)
    assert cut.columns == columns
    assert Counter(texts(cut)) == Counter((d, t) for d, _, _, t in brute_lines(texts(clean), 10, 1))
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    one = near(spark, cut, folder)
    groups = {d: c for d, _, c in brute_groups(texts(cut), 5, 80)}
    want = Counter({(d, t) for d, t in texts(cut) if d is not None and groups[d] == d}) + Counter((d, t) for d, t in texts(cut) if d is None)
    assert one.columns == columns and Counter(texts(one)) == want

    mixed = mix(spark, one, folder)
    assert mixed.columns == columns
    times = Counter((r.doc_id, r.source) for r in mixed.collect())
    size = {(r.doc_id, r.source): len((r.text or "").split()) for r in one.collect()}
    have, taken = defaultdict(int), defaultdict(int)
    for (d, s), n in size.items():
        have[s] += n
        taken[s] += n * times[(d, s)]
    order = sorted(s for s in have if s is not None) + ([None] if None in have else [])
    target = fill({s: n for s, n in have.items()}, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    assert max(times.values()) <= 3 and all(abs(taken[s] - target[s]) <= max(size.values()) for s in have)

    pieces = pack(spark, mixed, folder).collect()
    ids = {d: i for d, i in zip([d for d, _ in texts(mixed)], whole_ids([t for _, t in texts(mixed)], tokenizer_path("byte_bpe_50k.json")))}
    assert sum(r.length for r in pieces) == sum(len(ids[d]) + 1 for d, _ in texts(mixed))
    for r in pieces:
        import numpy as np

        assert zlib.crc32(np.array((ids[r.doc_id] + [0])[r.start : r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32


def test_run_is_the_stages_in_order_and_reruns_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        path = staging_path(spark, "t-stage")
        f(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).select(*key[:1], "ids_crc32", "doc_tokens").where("start = 0").collect())).keys() == Counter(
        map(tuple, docs.select(*key[:1], "ids_crc32", "doc_tokens").where("start = 0").collect())
    ).keys()


def test_empty_tables(spark):
    path = staging_path(spark, "t-pipeline-empty")
    empty_docs(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
