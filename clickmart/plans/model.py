"""Gender-age classifier on per-user domain counts.

The reference feeds every user's full list of visited domains (one entry
per visit) to a count vectoriser. Here each user is a *bag*: counts per
``(user, domain)``, made by a partially aggregated group-by, so a user's
row holds one entry per distinct in-vocabulary domain and never grows with
the number of visits. The vector is the same one a count vectoriser would
produce (term counts over the vocabulary).

* Vocabulary: domains by total visits (desc, then domain), at most
  ``vocab_size`` (the count vectoriser's default, 2^18), with
  ``min_df`` documents. Whether it is broadcast to the per-user join is left
  to AQE; it is saved in the pipeline's first stage.
* Label indexer: fitted on all labelled users before the split (as the
  reference does), frequency order with alphabetical ties.
* Split: a hash of ``uid`` and the seed, stable under repartitioning.
* Classifier: multinomial logistic regression, ``maxIter`` 100,
  ``regParam`` 0.001, inside a ``Pipeline`` with the vectoriser, the label
  indexer and the index-to-label stage. The fitted ``PipelineModel`` is one
  artefact: ``PipelineModel.load`` alone scores bag rows.

Assembling the ``SparseVector`` column is the only Python step (Spark SQL
has no vector constructor): an Arrow-batched pandas UDF that puts the
ready-made index and value arrays into the vector's storage struct.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators import visits as V
from clickmart.operators.ranking import top_rows
from clickmart.session import shared_root

# Vocabulary defaults (count vectoriser: 2^18 terms, min 1
# document), training parameters, split share and seed, label column.
VOCAB_SIZE = 1 << 18
MIN_DF = 1
MAX_ITER = 100
REG_PARAM = 0.001
TRAIN_FRACTION = 0.7
SEED = 123456789
LABEL = "gender_age"


@F.pandas_udf(VectorUDT())
def _to_sparse(size: pd.Series, idx: pd.Series, val: pd.Series) -> pd.DataFrame:
    """Columns -> sparse vectors, a whole Arrow batch at a time.

    A vector travels as its storage struct (type 0 = sparse, size, indices,
    values); the index and value arrays arrive ready-made, so nothing here
    loops over rows.
    """
    return pd.DataFrame({"type": 0, "size": size.astype("int32"), "indices": idx, "values": val})


def domain_bags(visits: DataFrame, keys: tuple[str, ...], keep_null_domains: bool = False) -> DataFrame:
    """``keys..., domain, n`` visit counts; NULL domains kept when asked (so a
    key whose URLs were all unusable still appears)."""
    v = visits if keep_null_domains else visits.where(F.col("domain").isNotNull())
    return V.user_domain_counts(v, keys)


def labelled_bags(weblogs_with_label: DataFrame) -> DataFrame:
    """``uid, gender_age, domain, n`` for known users' parsable visits."""
    v = V.visit_domains(weblogs_with_label.where(F.col("uid").isNotNull()), keep=("uid", LABEL))
    return domain_bags(v, ("uid", LABEL))


def fit_vocabulary(bags: DataFrame, vocab_size: int = VOCAB_SIZE, min_df: int = MIN_DF) -> DataFrame:
    """``domain, idx``: the vocabulary, most visited first."""
    totals = (
        bags.where(F.col("domain").isNotNull())
        .groupBy("domain")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min_df)
    )
    return top_rows(totals, vocab_size, "total", "domain", place="idx").select("domain", F.col("idx").cast("int").alias("idx"))


def index_domains(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Adds ``idx`` (NULL for domains outside the vocabulary) by a left join."""
    return df.join(vocab, "domain", "left")


def entries_to_vectors(indexed: DataFrame, vocab: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys..., idx, n`` rows -> ``keys..., features`` (one sparse vector per key).

    Rows with a NULL ``idx`` add nothing; a key with none left gets an
    all-zero vector. Each key's entry list is at most the vocabulary size.
    """
    entry = F.when(F.col("idx").isNotNull(), F.struct(F.col("idx"), F.col("n").cast("double").alias("n")))
    per = indexed.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    size = vocab.select(F.count(F.lit(1))).scalar()
    per = per.withColumn("_size", size)
    idx = F.transform("entries", lambda e: e["idx"])
    val = F.transform("entries", lambda e: e["n"])
    return per.select(*keys, _to_sparse(F.col("_size"), idx, val).alias("features"))


def vectorize(bags: DataFrame, vocab: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys..., features``: term counts over the vocabulary as a sparse vector."""
    return entries_to_vectors(index_domains(bags, vocab), vocab, keys)


def split_column(uid: str = "uid", seed: int = SEED, train_fraction: float = TRAIN_FRACTION):
    """``'train'``/``'test'`` from the first 32 bits of md5(uid:seed)."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(uid), F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return F.when(h % 100 < int(round(train_fraction * 100)), F.lit("train")).otherwise(F.lit("test"))


class BagVectorizer(Transformer, MLWritable, MLReadable):
    """ML stage: bag rows ``keys..., domain, n`` -> ``keys..., features``, one row a key.

    The keys are all columns but ``domain`` and ``n``. The vocabulary
    (``domain, idx``) is kept as a table, joined and not looked up row by row,
    and is saved inside the stage with its size and fingerprint.
    """

    def __init__(self, vocabulary: DataFrame | None = None):
        super().__init__()
        self.vocabulary = vocabulary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return vectorize(dataset, self.vocabulary, tuple(c for c in dataset.columns if c not in ("domain", "n")))

    def write(self) -> MLWriter:
        return _BagVectorizerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BagVectorizerReader()


class _BagVectorizerWriter(MLWriter):
    def __init__(self, stage: BagVectorizer):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802 - Spark's name
        spark = self.stage.vocabulary.sparkSession
        self.stage.vocabulary.write.parquet(f"{path}/vocabulary")
        kept = vocabulary_print(spark.read.parquet(f"{path}/vocabulary")).first()
        DefaultParamsWriter.saveMetadata(self.stage, path, spark, extraMetadata={"vocabulary": kept.asDict()})


class _BagVectorizerReader(MLReader):
    def load(self, path: str) -> BagVectorizer:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = BagVectorizer(spark.read.parquet(f"{path}/vocabulary"))
        stage._resetUid(metadata["uid"])
        if vocabulary_print(stage.vocabulary).first().asDict() != metadata["vocabulary"]:
            raise ValueError(f"{path}: the vocabulary is not the one that was saved")
        return stage


@dataclass
class DomainModel:
    """The fitted pipeline (vectoriser, label indexer, LR, un-indexer) with what the scorers ask of it.

    What is saved is the plain ``PipelineModel``: ``PipelineModel.load`` gives
    a pipeline that scores bag rows by itself.
    """

    pipeline: PipelineModel

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "DomainModel":
        return cls(PipelineModel.load(path))

    def _stage(self, kind: type):
        return next(s for s in self.pipeline.stages if isinstance(s, kind))

    @property
    def vocabulary(self) -> DataFrame:
        return self._stage(BagVectorizer).vocabulary

    @property
    def n_features(self) -> int:
        return int(self._stage(LogisticRegressionModel).numFeatures)

    @property
    def labels(self) -> list[str]:
        return list(self._stage(StringIndexerModel).labels)

    def transform(self, bags: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        return self.pipeline.transform(bags.select(*keys, "domain", "n"))

    def score(self, bags: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """``keys..., gender_age`` = predicted label."""
        out = self.transform(bags, keys)
        return out.select(*keys, F.col("predictedLabel").alias(LABEL))


def vocabulary_print(vocab: DataFrame) -> DataFrame:
    """One row: ``size`` and an order-free ``fingerprint`` of the vocabulary."""
    total = F.sum(F.xxhash64("domain", "idx").cast("decimal(38,0)"))
    return vocab.agg(F.count(F.lit(1)).alias("size"), F.coalesce(total.cast("string"), F.lit("0")).alias("fingerprint"))


def label_indexer(users: DataFrame) -> StringIndexer:
    return StringIndexer(inputCol=LABEL, outputCol="label", stringOrderType="frequencyDesc")


def train(
    bags: DataFrame,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
    train_fraction: float = TRAIN_FRACTION,
    vocab_size: int = VOCAB_SIZE,
    written: bool = False,
) -> tuple[DomainModel, DataFrame]:
    """Fit on the train share; returns the model and the test predictions.

    ``written`` says that ``bags`` is a table and needs no copy of its own.
    """
    keys = ("uid", LABEL)
    shared_root(bags.sparkSession)
    # The bags feed the indexer, the vocabulary, the vectors and the test
    # share: computed once and kept in the shared folder.
    bags = bags if written else bags.checkpoint(eager=True)
    users = bags.select(*keys).distinct()
    indexer = label_indexer(users).fit(users)
    split = split_column(seed=seed, train_fraction=train_fraction)
    tagged = bags.withColumn("_split", split)
    train_bags = tagged.where(F.col("_split") == "train").drop("_split")
    test_bags = tagged.where(F.col("_split") == "test").drop("_split")
    # Computed once and kept: the same vocabulary serves fitting, testing
    # and saving (it is at most vocab_size rows).
    vocab = fit_vocabulary(train_bags, vocab_size).checkpoint(eager=True)
    lr = LogisticRegression(
        maxIter=max_iter, regParam=reg_param, labelCol="label", featuresCol="features", predictionCol="prediction"
    )
    to_label = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=indexer.labels)
    # The optimiser makes up to max_iter passes: cut the lineage first so a
    # lost executor re-reads the checkpointed vectors from the shared folder
    # instead of re-running the whole derivation.
    train_vec = vectorize(train_bags, vocab, keys).checkpoint(eager=True)
    pipeline = Pipeline(stages=[indexer, lr, to_label]).fit(train_vec)
    model = DomainModel(PipelineModel([BagVectorizer(vocab), *pipeline.stages]))
    return model, model.transform(test_bags, keys)


def accuracy(predictions: DataFrame) -> DataFrame:
    """One row: ``accuracy`` (share of exact label hits) and ``n_test``."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_test"))


def evaluator_accuracy(predictions: DataFrame) -> float:
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    return ev.evaluate(predictions)


def dated_bags(weblogs: DataFrame) -> DataFrame:
    """``date, uid, domain, n`` (NULL uids and domains kept, as the scorers do)."""
    v = V.visit_domains(weblogs, keep=("date", "uid"))
    return domain_bags(v, ("date", "uid"), keep_null_domains=True)


def score_by_day(model: DomainModel, weblogs: DataFrame) -> DataFrame:
    """``uid, gender_age, date`` per user and day."""
    return model.score(dated_bags(weblogs), ("date", "uid")).select("uid", LABEL, "date")
