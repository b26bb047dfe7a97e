import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from clickmart.plans import model as Mo
from clickmart.session import staging_path
from clickmart.sources import derived as D

SF = "/root/testdata/sf0.001"


def test_vectorize_equals_count_vectorizer(spark):
    rows = [("u1", "a"), ("u1", "b"), ("u1", "a"), ("u2", "c"), ("u2", "z"), ("u3", None)]
    visits = spark.createDataFrame(rows, "uid string, domain string")
    bags = Mo.domain_bags(visits, ("uid",), keep_null_domains=True)
    vocab = Mo.fit_vocabulary(bags.where(F.col("domain") != "z"))
    ours = {r.uid: r.features for r in Mo.vectorize(bags, vocab, ("uid",)).collect()}
    words = [r.domain for r in vocab.orderBy("idx").collect()]
    assert words == ["a", "b", "c"]
    lists = visits.groupBy("uid").agg(F.collect_list("domain").alias("d"))
    cv = CountVectorizerModel.from_vocabulary(words, inputCol="d", outputCol="f")
    ref = {r.uid: r.f for r in cv.transform(lists).collect()}
    assert {k: v.toArray().tolist() for k, v in ours.items()} == {k: v.toArray().tolist() for k, v in ref.items()}


def test_split_is_stable_and_roughly_70_30(spark):
    users = spark.range(2000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("uid"))
    a = users.select("uid", Mo.split_column().alias("s"))
    b = users.repartition(7).select("uid", Mo.split_column().alias("s"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    share = a.where(F.col("s") == "train").count() / 2000
    assert 0.65 < share < 0.75


def test_train_save_load_score(spark):
    bags = Mo.labelled_bags(D.labelled_weblogs(spark, SF))
    model, pred = Mo.train(bags, max_iter=20)
    acc = Mo.accuracy(pred).first()
    assert 0.0 <= acc.accuracy <= 1.0 and acc.n_test > 0
    assert abs(acc.accuracy - Mo.evaluator_accuracy(pred)) < 1e-12
    path = staging_path(spark, "t-model")
    model.save(path)
    loaded = Mo.DomainModel.load(spark, path)
    labels = set(loaded.labels)
    # scoring input has no label column: the indexer stage skips it
    scored = loaded.score(bags.drop(Mo.LABEL), ("uid",)).collect()
    assert scored and {r.gender_age for r in scored} <= labels
    by_day = Mo.score_by_day(loaded, D.weblogs(spark, SF))
    assert set(by_day.columns) == {"uid", "gender_age", "date"} and by_day.count() > 0


def test_plain_pipeline_load_scores_alone(spark):
    """One artefact: Spark ML's own loader gives a pipeline that takes bag rows of any keys."""
    bags = Mo.labelled_bags(D.labelled_weblogs(spark, SF))
    model, _ = Mo.train(bags, max_iter=5)
    path = staging_path(spark, "t-pipeline")
    model.save(path)
    rows = bags.drop(Mo.LABEL)
    loaded = PipelineModel.load(path)
    got = loaded.transform(rows).select("uid", "predictedLabel")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, model.score(rows, ("uid",)).collect()))
    dated = loaded.transform(rows.withColumn("date", F.lit("20240101")))
    assert {"date", "uid", "features", "predictedLabel"} <= set(dated.columns) and dated.count() == rows.select("uid").distinct().count()
    assert loaded.stages[0].uid == model.pipeline.stages[0].uid
    # users without any known domain are scored too
    assert loaded.transform(spark.createDataFrame([("x", None, 0), ("y", "unseen.example", 3)], rows.schema)).count() == 2


def test_changed_vocabulary_is_refused(spark):
    bags = Mo.labelled_bags(D.labelled_weblogs(spark, SF))
    model, _ = Mo.train(bags, max_iter=1)
    path = staging_path(spark, "t-changed")
    model.save(path)
    stage = next(d for d in os.listdir(f"{path}/stages".removeprefix("file:")) if "BagVectorizer" in d)
    spark.createDataFrame([("other.example", 0)], "domain string, idx int").write.mode("overwrite").parquet(f"{path}/stages/{stage}/vocabulary")
    with pytest.raises(ValueError, match="vocabulary"):
        PipelineModel.load(path)


def test_label_indexer_frequency_then_alpha(spark):
    users = spark.createDataFrame([("u1", "b"), ("u2", "a"), ("u3", "c"), ("u4", "c")], "uid string, gender_age string")
    idx = Mo.label_indexer(users).fit(users)
    assert list(idx.labels) == ["c", "a", "b"]
