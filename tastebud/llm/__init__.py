"""Operators of a training-data pipeline (documents, embeddings) on Spark."""
