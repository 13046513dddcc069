"""The queries of the subpackage, by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from riskspark.llm import bpe, conversations, decontaminate, langid, licenses, merkle, neardup, perplexity, resample, secrets, substrings, tokenfiles, toxicity

_MODULES = (decontaminate, bpe, tokenfiles, secrets, toxicity, resample, neardup, perplexity, substrings, langid, merkle, licenses, conversations)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for m in _MODULES for k, f in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {k: q for m in (neardup, substrings, merkle, licenses, conversations) for k, q in m.SQL.items()}
