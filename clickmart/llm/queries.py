"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickmart.llm import divergence, exact_topk, fingerprints, hard_negatives, line_dedup, maxent_lm, mixing, packing, parity_join, permutation_index, personal_data, token_files, toxicity
from clickmart.llm.common import documents


def _on_documents(query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": _on_documents(fingerprints.query),
    "op2_packing": _on_documents(packing.query),
    "op3_maxent_lm": _on_documents(maxent_lm.query),
    "op4_permutation_index": lambda spark, sf_dir: permutation_index.query(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
    "op5_personal_data": _on_documents(personal_data.query),
    "op6_toxicity": lambda spark, sf_dir: toxicity.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")),
    "op7_token_files": _on_documents(token_files.query),
    "op8_parity_join": _on_documents(parity_join.query),
    "op9_mixing": _on_documents(mixing.query),
    "op10_line_dedup": _on_documents(line_dedup.query),
    "op11_exact_topk": lambda spark, sf_dir: exact_topk.query(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
    "op12_divergence": _on_documents(divergence.query),
    "op13_hard_negatives": lambda spark, sf_dir: hard_negatives.query(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
}

ORACLE: dict[str, str] = {
    "op8_parity_join": parity_join.SQL,
    "op9_mixing": mixing.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_exact_topk": exact_topk.SQL,
    "op12_divergence": divergence.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
