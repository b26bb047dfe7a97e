"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage takes all rows that the one before has kept. All but the last return
the columns of ``documents``; a changed text comes with its new ``n_chars``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmart.llm import line_dedup, mixing, packing, parity_join, toxicity
from clickmart.llm.common import bound_text_batches, stage, text_of
from clickmart.llm.tokens import tokenizer_path

#: Near duplicates: shingles of five words, similarity of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it is trained on the labelled documents outside its held-out fold."""
    bound_text_batches(spark)  # for the session: what this returns is run by the caller, and what a batch took stays with the executor
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, toxicity.training_rows(labels))
    new = fresh(docs, "toxic")
    return toxicity.score(docs, model, new).where(F.col(new) < 0.5).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go; every document stays, with what is left of it."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays.

    Texts without words are nobody's duplicate and rows without an id are in no
    group: they stay. Of rows that repeat a document one stays.
    """
    groups = parity_join.jaccard_groups(docs, NEAR_WORDS, NEAR_PERCENT)
    first = groups.where(F.col("component_id") == F.col("doc_id")).select("doc_id").distinct()
    place, text = fresh(docs, "place"), F.xxhash64(text_of())
    kept = docs.join(first, "doc_id", "left_semi").withColumn(place, F.row_number().over(Window.partitionBy("doc_id", text).orderBy("doc_id"))).where(F.col(place) == 1)
    return kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).where(F.col("copies") > 0)
    return mixed.withColumn(fresh(mixed, "copy"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).pieces
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The trained model and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
