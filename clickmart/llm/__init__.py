"""Training-data operators: fingerprints, packing, language-model scoring,
nearest neighbours, personal data, toxicity, token-id files, near-duplicate
joins, source mixing and line deduplication.

Each operator is a module with a ``DataFrame -> DataFrame`` interface;
``queries`` holds the registered queries and their SQL. Nothing else in the
library imports this subpackage.
"""
