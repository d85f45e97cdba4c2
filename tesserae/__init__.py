"""Spark-native analytics for single-cell count tables: long COO counts, cell tables, labels, embeddings."""
