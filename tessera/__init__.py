"""Spark-native evidence analytics: retrieval, screening, identity, ledger and audit operators."""
