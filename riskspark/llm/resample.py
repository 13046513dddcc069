"""Operator 6: importance resampling with hashed n-gram models.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` places. Two generative models, of the target
texts and of all (raw) texts, are the smoothed shares of the places, counted over every row. A document's log
weight is the log of its likelihood ratio; a Gumbel number (from a hash of doc_id, text length and seed, so reruns
agree) is added, and the ``share`` of rows with the largest sums is the sample: Gumbel top-k, sampling without
replacement in proportion to the weights. The cut is found by counting rows in ever narrower ranges of the sum.

Null and empty texts have weight 1 (log weight 0). Rows that equal the last sampled one in sum and doc_id are all
sampled. An empty target leaves all log weights at 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import bitmap, in_bitmap, materialize, mix, slices, table, with_column, word_hashes, word_ids

BUCKETS = 1 << 14
SHARE = 0.8
SEED = 17
BINS = 4096


def places(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and of every pair of neighbouring words."""
    vocab, ids, offsets = word_ids(texts)
    h = word_hashes(vocab)[ids]
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    pair = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    inside = text[:-1] == text[1:]
    return np.concatenate([h, pair[inside]]) % np.uint64(buckets), np.concatenate([text, text[:-1][inside]])


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in slices(batches):
            total += np.bincount(places(texts, buckets)[0].astype(np.int64), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": some, "n": total[some]})
    return run


def model(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Smoothed share of each bucket over all rows of ``texts`` (column text); None if there are no words."""
    counts = texts.select("text").mapInArrow(_counts(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets)
    for r in counts.collect():  # at most ``buckets`` rows
        total[r.bucket] = r.n
    return (total + 1) / (total.sum() + buckets) if total.any() else None


def _weigh(shared, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for rows, texts in slices(batches):
            bucket, text = places(texts, buckets)
            w = np.bincount(text, weights=ratio[bucket.astype(np.int64)], minlength=len(texts)).astype(float)
            yield from rows.drop_columns(["text"]).append_column("log_weight", pa.array(w)).combine_chunks().to_batches()
    return run


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` without text, with ``log_weight``: log of target over raw likelihood of the whole text."""
    own, raw = model(target, buckets), model(docs, buckets)
    ratio = np.log(own / raw) if own is not None and raw is not None else np.zeros(buckets)
    docs = docs.drop("log_weight")
    return docs.mapInArrow(_weigh(docs.sparkSession.sparkContext.broadcast(ratio), buckets), with_column(docs.drop("text"), "log_weight", "double"))


def cut(sums: DataFrame, k: int) -> tuple[float, int | None] | None:
    """(sum, doc_id) of the k-th row by sum downwards, then doc_id upwards; None if there are at most k rows."""
    if k <= 0:
        return float("inf"), None
    part, ahead = sums, 0
    while True:
        edge = part.agg(F.min("gumbel_sum").alias("lo"), F.max("gumbel_sum").alias("hi"), F.count(F.lit(1)).alias("n")).first()
        if part is sums and edge.n <= k:
            return None
        if edge.n <= BINS or edge.lo == edge.hi:
            if edge.lo == edge.hi and edge.n > BINS:  # one sum: cut by doc_id, which ranks like a sum does
                ids = part.select((-F.col("doc_id").cast("double")).alias("gumbel_sum"), "doc_id").filter("doc_id is not null")
                found = cut(ids, k - ahead)
                return edge.lo, (found[1] if found else None)
            rows = sorted(((-r.gumbel_sum, r.doc_id is None, r.doc_id or 0) for r in part.select("gumbel_sum", "doc_id").collect()))
            v, none, doc = rows[k - ahead - 1]
            return -v, (None if none else doc)
        step = (edge.hi - edge.lo) / BINS
        place = F.least(F.lit(BINS - 1), F.floor((F.lit(edge.hi) - F.col("gumbel_sum")) / step).cast("int"))
        part = part.withColumn("bin", place)
        for b, n in sorted((r.bin, r.n) for r in part.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()):
            if ahead + n >= k:
                part = part.filter(F.col("bin") == b).drop("bin")
                break
            ahead += n


def resample(docs: DataFrame, target: DataFrame, share: float = SHARE, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, log_weight, gumbel_sum, sampled. ``docs``: doc_id, text; ``target``: text."""
    rows = weigh(docs.select("doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).alias("chars")), target, buckets)
    u = (F.pmod(F.xxhash64("doc_id", "chars", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = materialize(rows.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("gumbel_sum")), "weights")
    last = cut(rows, round(share * rows.count()))
    if last is None:
        return rows.withColumn("sampled", F.lit(True))
    v, doc = last
    tied = (F.col("gumbel_sum") == v) & (F.lit(True) if doc is None else F.coalesce(F.col("doc_id") <= doc, F.lit(False)))
    return rows.withColumn("sampled", (F.col("gumbel_sum") > v) | tied)


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, log_weight, gumbel_sum, sampled (four fifths of the rows); the target is the documents
    labelled quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    near = docs.filter(in_bitmap(F.xxhash64("doc_id"), bitmap(good.select(F.xxhash64("doc_id").alias("h")), "h")))
    return resample(docs, near.join(good, "doc_id").select("text"))


QUERIES = {"op6_importance_resampling": op6_importance_resampling}
