"""Shared helpers of the operators: table access, slices of a task's rows, word indexes.

Python operators work on *slices*: the rows of one task in runs of at most ``SLICE_CHARS`` characters
(one text is never cut). Words of a slice are numbered once in a dictionary, so per-word work is done
per distinct word and documents become integer arrays.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import ensure_checkpoint_dir, ship_package

SLICE_CHARS = 4_000_000
BATCH_BYTES = 4_000_000

BITMAP_BITS = 1 << 28  # 32 MB, the most that a bitmap takes
BITS_PER_KEY = 64
CELL = 32768  # bits in a row of Spark's bitmap functions


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES: ten thousand whole texts at once would fill a worker's memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; also makes the package available to the Python workers."""
    ship_package(spark)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (lineage ends there, copies survive
    the loss of an executor)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0 (a null id counts as held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for later tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", max_chars: int = SLICE_CHARS) -> Iterator[tuple[pa.Table, list[str]]]:
    """(rows, texts) of consecutive rows with at most ``max_chars`` characters together; null text is empty."""
    held, texts, chars = [], [], 0
    for batch in batches:
        rows, start = pa.Table.from_batches([batch]), 0
        own = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        for i, t in enumerate(own):
            if chars and chars + len(t) > max_chars:
                yield pa.concat_tables([*held, rows.slice(start, i - start)]), texts + own[start:i]
                held, texts, chars, start = [], [], 0, i
            chars += len(t)
        held.append(rows.slice(start))
        texts += own[start:]
    if texts:
        yield pa.concat_tables(held), texts
    held, texts = [], []
    give_back()


class Numbered(dict):
    """Numbers its keys in order of first sight."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def with_column(df: DataFrame | T.StructType, name: str, kind: str) -> T.StructType:
    """The schema of ``df`` (or a schema) with one more column."""
    fields = df.fields if isinstance(df, T.StructType) else df.schema.fields
    return T.StructType([*fields, *T.StructType.fromDDL(f"`{name}` {kind}").fields])


class Below(dict):
    """Numbers its keys -1, -2, ... in order of first sight."""

    def __missing__(self, key):
        n = self[key] = -1 - len(self)
        return n


def word_ids(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (UTF-8): distinct words, the number of each word, offsets by text."""
    vocab = Numbered()
    parts, offsets = [], np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words = t.encode().split()  # bytes.split() splits on exactly these six ASCII characters
        parts.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
        offsets[i + 1] = offsets[i] + len(words)
    return list(vocab), (np.concatenate(parts) if parts else np.zeros(0, np.int32)), offsets


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes starts[i], starts[i]+1, ... (counts[i] of them) for every i, one after the other."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total, dtype=np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two multiply-xorshift rounds) on uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same on every machine."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words), np.uint64, len(words))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive items of ``h`` (doubling: O(log k) vector operations)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    span, cur, done, out = 1, h, 0, None
    while True:
        if k & span:
            part = cur[done:len(h) - k + 1 + done]
            out = part if out is None else mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += span
        if done == k:
            return out
        cur = mix(cur[: len(cur) - span] * np.uint64(0xD6E8FEB86659FD93) + cur[span:])
        span *= 2


def bitmap(df: DataFrame, column: str, most: int = BITMAP_BITS):
    """Broadcast bitmap of the low bits of a long column: room for BITS_PER_KEY bits a row up to ``most`` bits, so
    its size is bounded whatever the table; beyond that it only lets more rows through."""
    bits = min(most, max(CELL, 1 << (BITS_PER_KEY * df.count()).bit_length()))
    low = df.select(F.col(column).bitwiseAND(F.lit(bits - 1)).alias("b"))
    cells = low.groupBy(F.floor(F.col("b") / CELL).alias("cell")).agg(F.expr(f"bitmap_construct_agg(b % {CELL})").alias("bytes"))
    whole = bytearray(bits // 8)
    for row in cells.collect():  # at most most / CELL rows of 4 KB
        whole[row.cell * (CELL // 8):(row.cell + 1) * (CELL // 8)] = row.bytes
    return df.sparkSession.sparkContext.broadcast(bytes(whole))


def bitmap_hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the low bits of each key (uint64) are set in the bitmap's bytes."""
    place = keys & np.uint64(len(bits) * 8 - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def in_bitmap(key: Column, shared) -> Column:
    """A filter: rows whose key (long) may be in the bitmap."""
    @F.pandas_udf("boolean")
    def hit(keys: pd.Series) -> pd.Series:
        return pd.Series(bitmap_hits(np.frombuffer(shared.value, np.uint8), keys.to_numpy(np.int64).view(np.uint64)))

    return hit(key)
