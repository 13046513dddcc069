"""Operators for training-data pipelines: ten operators over a documents table (doc_id, text, ...)."""
