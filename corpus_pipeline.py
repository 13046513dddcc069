"""A corpus pipeline: toxic documents go, one document of each near-duplicate group stays, documents with benchmark
passages go, secrets are redacted, and the rest is encoded as token ids.

Each stage works on all rows that its predecessor kept, which were written as Parquet to the shared folder and
read again; a lost executor costs at most the stage at hand. Null texts, repeated rows and empty tables are
handled as each operator's module says; a document with a null text passes the first and the later stages as an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import bpe, decontaminate, neardup, secrets, toxicity
from riskspark.llm.common import materialize, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones of the learning folds, scores below one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    marked = docs.withColumnRenamed("toxicity", "_toxicity") if "toxicity" in docs.columns else docs
    kept = toxicity.score(marked, model).filter(F.col("toxicity") < 0.5).drop("toxicity")
    return kept.withColumnRenamed("_toxicity", "toxicity") if "_toxicity" in kept.columns else kept


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of texts with linked word 5-shingle similarity 0.8 or more."""
    return neardup.one_per_class(docs)


def not_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage within the error budget of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of secrets replaced by a mark."""
    return secrets.without_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of each document, and whether the decoded ids are its text."""
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path, P.PATTERN), path)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", not_benchmark),
    ("secret scans", no_secrets),
    ("byte-level BPE encoding and decoding", encoded),
]

ORACLE_SQL = None  # a fitted classifier and BPE have no SQL form; tests/llm/test_pipeline.py has the plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is a written table, too."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
