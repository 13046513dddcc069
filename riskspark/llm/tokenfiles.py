"""Operator 3: token ids as files of range-coded segments.

Documents are put in order of doc_id (a range partitioning; null ids come first, equal ids are ordered by the first
HEAD_CHARS characters of the text, then by its hash).
Each task tokenizes its rows with the tokenizers library, ends each document with the end id, and codes runs of
whole documents as segments (rangecoder.py). Segments are written as rows of uncompressed Parquet files (part,
segment number, number of ids, segment), since Spark's writers and readers reach every store that a cluster uses
and commit files only when a task has succeeded. Reading decodes the segments, checks each block's checksum, and
places documents by the running sum of ids over parts, then over the segments of a part.

Null text is empty and gives the end id alone. The strings of the tokenizer's special tokens in a text give their ids,
as in the library. A document is never split over segments; a segment may hold any number of different ids.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskspark.llm.bpe import Remembered, encode_slice
from riskspark.llm.common import ragged, scratch, slices, table
from riskspark.llm.rangecoder import BLOCK, read_segment, write_segment

END_ID = 2
HEAD_CHARS = 64
SEGMENT_CHARS = 8_000_000
KNOWN_WORDS = 300_000  # words that a worker remembers, some 50 MB
LAST_LATIN = "\u024f"  # letters up to here are letters to every version of Unicode
FILE_SCHEMA = "part int, segment long, n_ids long, data binary"
_READY: dict[int, tuple] = {}


def _tools(shared):
    """The encoder of pieces by the tokenizer of a broadcast file, which remembers pieces from slice to slice, and what cuts a piece."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
    from tokenizers import Tokenizer

    if id(shared) not in _READY:
        _READY.clear()
        tokenizer = Tokenizer.from_buffer(shared.value)
        marks = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

        def encode_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

        def parts(piece: str) -> list[str]:
            """A word and the marks at its end apart: no match of the byte-level pattern holds both, and the word is met more often alone."""
            head = piece.rstrip(string.punctuation)
            if len(head) == len(piece) or not head or head[-1] > LAST_LATIN or not head[-1].isalnum() or any(m in piece for m in marks):
                return [piece]
            return [head, piece[len(head):]]

        _READY[id(shared)] = (shared, Remembered(encode_pieces, KNOWN_WORDS), parts)
    return _READY[id(shared)][1:]


def _write(shared, end_id: int, chars: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_words, parts = _tools(shared)
        part, number = TaskContext.get().partitionId(), 0

        for rows, texts in slices(batches, "text", chars):
            # the pieces end where no match of the byte-level pattern crosses, so each is encoded once a slice
            flat, sizes = encode_slice(texts, parts, encode_words)
            ids = np.full(len(flat) + len(texts), end_id, np.int64)
            starts = np.cumsum(sizes) - sizes + np.arange(len(texts))
            ids[ragged(starts, sizes)] = flat
            data = write_segment(rows.column("doc_id").to_pylist(), sizes + 1, ids, block)
            yield pa.record_batch({"part": pa.array([part], pa.int32()), "segment": pa.array([number]), "n_ids": pa.array([len(ids)]), "data": pa.array([data], pa.binary())})
            number += 1
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, chars: int = SEGMENT_CHARS, block: int = BLOCK) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order."""
    with open(tokenizer_path, "rb") as f:  # a file of fixed size
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    # many rows with one id (null among them) are dealt on by their texts' beginnings, hashes and places in the input
    rows = docs.select("doc_id", "text", F.substring("text", 1, HEAD_CHARS).alias("_head"), F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_tie"))
    by = [F.col(c).asc_nulls_first() for c in ("doc_id", "_head", "_h", "_tie")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    ordered.mapInArrow(_write(shared, end_id, chars, block), FILE_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def _read(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, segments = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part, segment, data in zip(parts, segments, batch.column(3)):
                docs, lengths, ids = read_segment(data.as_buffer().to_pybytes())
                ends = np.cumsum(lengths)
                n = len(docs)
                yield pa.record_batch({
                    "part": pa.array([part] * n, pa.int32()), "segment": pa.array([segment] * n, pa.int64()), "place": np.arange(n),
                    "doc_id": pa.array(docs, pa.int64()), "before": ends - lengths, "n_tokens": lengths, **make(ids, ends - lengths, ends)})
    return run


def _crcs(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> dict:
    raw = ids.astype("<u4").tobytes()
    return {"ids_crc32": np.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())], np.int64)}


def _lists(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> dict:
    return {"ids": pa.ListArray.from_arrays(pa.array(np.append(begins, ends[-1:]).astype(np.int32)), pa.array(ids.astype(np.int32)))}


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, and ids (array of int), or
    with ``digest`` only ids_crc32 (crc32 of the ids as little-endian 32-bit numbers)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    last = "ids_crc32 long" if digest else "ids array<int>"
    docs = files.mapInArrow(_read(_crcs if digest else _lists), f"part int, segment long, place long, doc_id long, before long, n_tokens long, {last}")
    # sums within each part, then over the parts (one row a part)
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    sizes = sizes.withColumn("inner", F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids"))
    starts = sizes.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("inner")).alias("segment_start"))
    return docs.join(starts, ["part", "segment"]).select("doc_id", (F.col("segment_start") + F.col("before")).alias("start"), "n_tokens", last.split()[0])


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers as P

    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, P.path("byte_bpe_50k.json"))
    return read_tokens(spark, path, digest=True)


QUERIES = {"op3_token_files": op3_token_files}
