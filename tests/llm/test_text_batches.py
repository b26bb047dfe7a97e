"""Whole texts go to Python workers in small Arrow batches."""

import pyarrow as pa
import pytest

import corpus_pipeline
from clickmart.llm import common, packing, parity_join
from clickmart.llm.tokens import tokenizer_path

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture()
def setting(spark):
    before = spark.conf.get(KEY)
    yield before
    spark.conf.set(KEY, before)


def batch_sizes(spark) -> list[int]:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    return [r.n for r in spark.range(0, 2_500, 1, 1).mapInArrow(run, "n long").collect()]


def test_batches_are_bounded_inside_and_as_before_outside(spark, setting):
    spark.conf.set(KEY, 2_000)
    with pytest.raises(ZeroDivisionError), common.text_batches(spark):
        assert batch_sizes(spark) == [1_000, 1_000, 500]
        1 / 0  # noqa: B018
    assert batch_sizes(spark) == [2_000, 500]
    for own, bounded in ((300, "300"), (0, "1000"), (-1, "1000")):  # smaller ones stay; 0 and less: no bound
        spark.conf.set(KEY, own)
        with common.text_batches(spark):
            assert spark.conf.get(KEY) == bounded
        assert spark.conf.get(KEY) == str(own)


def test_steps_that_send_whole_texts_bound_them(spark, setting, monkeypatch):
    spark.conf.set(KEY, 10_000)
    seen = {}
    for module, name in ((packing, "stage"), (parity_join, "stage"), (parity_join, "staged_as")):
        write = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, to, write=write: (seen.setdefault(to, spark.conf.get(KEY)), write(df, to))[1])
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, None), (None, "a b")], "doc_id long, text string")
    assert packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).pieces.agg({"length": "sum"}).first()[0] > 400
    groups = {r.doc_id: r.component_id for r in parity_join.jaccard_groups(docs, 4, 85).collect()}
    assert groups == {1: 1, 2: 1, 3: 3, None: None}
    assert seen["token-ids"] == seen["shingled"] == seen["sets"] == "1000"
    assert seen["lengths"] == seen["components"] == spark.conf.get(KEY) == "10000"


def test_the_pipeline_bounds_them_before_its_first_stage(spark, setting, tmp):
    spark.conf.set(KEY, 10_000)
    docs = spark.createDataFrame([(1, "a fine day"), (2, "an idiot")], "doc_id long, text string")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp}/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, tmp)
    assert spark.conf.get(KEY) == "1000"
    assert kept.columns == docs.columns and kept.count() <= 2


def test_texts_with_fewer_words_together_than_a_shingle():
    one, two, none = parity_join.shingle_sets(["b", "a b", ""], 5)
    assert len(one) == len(two) == 1 and not len(none) and one[0] != two[0]
    assert parity_join.shingle_sets(["a b"], 5)[0] == two == parity_join.shingle_sets(["a b", "c d e f g h"], 5)[0]
    assert [len(s) for s in parity_join.shingle_sets([""], 4)] == [0]
