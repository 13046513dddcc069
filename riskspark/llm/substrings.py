"""Operator 9: removal of repeated word sequences by difference-cover anchors.

A window is ``window`` consecutive words. Hashing every window of the corpus would shuffle a row for
each word. Instead short runs of ``window - period + 1`` words are hashed only where their position in
the document is, modulo ``period``, in a difference cover: for any two positions some shift below
``period`` brings both into the cover, so two equal windows share an anchor at the same place within
them. Anchors that occur twice or more point out the few windows worth hashing in full (the extension
of a match around its anchor is all windows that hold the anchor); their counts over the corpus decide.

1. count anchors (one long a row, combined by slice and by task) and keep those seen twice;
2. hash the full windows around kept anchors and count them; keep those that start twice;
3. give each document the hashes of its kept windows and remove the words they cover.

The kept anchors reach step 2 as a bitmap of at most ``MAX_BITS`` bits (a false hit costs a row, never a
result), or, where there are too many for it, by a join on the anchor. Both ways give the same rows.
Documents meet their windows through a hash of their id and text, so that a set holds the windows of one text: null or
equal ids of different texts share none, and equal rows share one, which is the same for each. Null text has no words and keeps an empty text.
Equal rows are occurrences of their own, so repeated rows repeat each other's windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import BITS_PER_KEY, bitmap, bitmap_hits, materialize, rolling, slices, table, with_column, word_hashes, word_ids

WINDOW = 35
PERIOD = 21
# Perfect difference sets, by period.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
MAX_BITS = 1 << 28  # 32 MB


def _positions(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, offsets of the texts, local position of each word, words from it to its text's end)."""
    vocab, ids, offsets = word_ids(texts)
    lens = np.diff(offsets)
    local = np.arange(len(ids)) - np.repeat(offsets[:-1], lens)
    return word_hashes(vocab)[ids], offsets, local, np.repeat(lens, lens) - local


def _anchors(texts: list[str], window: int, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, offsets, places of anchors, their hashes)."""
    size = window - period + 1
    h, offsets, local, rest = _positions(texts, size)
    cover = np.zeros(period, bool)
    cover[list(COVERS[period])] = True
    at = np.flatnonzero(cover[local % period] & (rest >= size) & (local + rest >= window))
    return h, offsets, at, (rolling(h, size)[at] if len(at) else np.zeros(0, np.uint64))


def _anchor_counts(window: int, period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            _, _, _, a = _anchors(texts, window, period)
            value, n = np.unique(a, return_counts=True)
            if len(value):
                yield pa.record_batch({"anchor": value.view(np.int64), "n": n.astype(np.int64)})
    return run


def _anchors_by_key(window: int, period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            _, offsets, at, a = _anchors(texts, window, period)
            key = rows.column("key").to_numpy()[np.searchsorted(offsets, at, side="right") - 1]
            if len(a):
                yield pa.record_batch({"anchor": a.view(np.int64), "key": key})
    return run


def _windows_around(h: np.ndarray, offsets: np.ndarray, at: np.ndarray, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the windows that hold one of the anchors at ``at`` whole."""
    lens = np.diff(offsets)
    text = np.searchsorted(offsets, at, side="right") - 1
    low = np.maximum(at - (period - 1), offsets[text])
    high = np.minimum(at, offsets[text] + lens[text] - window)
    ok = high >= low
    edge = np.zeros(len(h) + 1, np.int32)
    np.add.at(edge, low[ok], 1)
    np.add.at(edge, high[ok] + 1, -1)
    starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    return starts, (rolling(h, window)[starts] if len(starts) else np.zeros(0, np.uint64))


def _candidates(window: int, period: int, bitmap=None):
    """Distinct windows of each text around kept anchors: those in the bitmap, or in the row's list ``anchors``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for rows, texts in slices(batches):
            h, offsets, at, a = _anchors(texts, window, period)
            if bits is not None:
                hit = bitmap_hits(bits, a)
            else:
                own = rows.column("anchors")
                hit = np.zeros(len(at), bool)
                for i in range(len(texts)):
                    lo, hi = np.searchsorted(at, offsets[i:i + 2])
                    hit[lo:hi] = np.isin(a[lo:hi].view(np.int64), own[i].values.to_numpy())
            starts, w = _windows_around(h, offsets, at[hit.astype(bool)], window, period)
            if not len(starts):
                continue
            text = np.searchsorted(offsets, starts, side="right") - 1
            order = np.lexsort((w, text))
            text, w = text[order], w[order]
            first = np.concatenate([[True], (text[1:] != text[:-1]) | (w[1:] != w[:-1])])
            n = np.diff(np.concatenate([np.flatnonzero(first), [len(w)]]))
            yield pa.record_batch({"w": w[first].view(np.int64), "key": rows.column("key").to_numpy()[text[first]], "n": n.astype(np.int64)})
    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            own = rows.column("repeated")
            n_words, n_removed, kept = [], [], []
            for i, t in enumerate(texts):
                words = t.encode().split()
                n_words.append(len(words))
                gone = 0
                if own[i].is_valid and len(words) >= window:
                    w = rolling(word_hashes(words), window)
                    edge = np.zeros(len(words) + 1, np.int32)
                    starts = np.flatnonzero(np.isin(w.view(np.int64), own[i].values.to_numpy()))
                    edge[starts] += 1
                    edge[starts + window] -= 1
                    covered = np.cumsum(edge[:-1]) > 0
                    gone = int(covered.sum())
                    if gone:
                        words = [x for x, c in zip(words, covered.tolist()) if not c]
                n_removed.append(gone)
                kept.append(b" ".join(words).decode())
            out = rows.drop_columns(["key", "repeated"])
            for name, values, kind in (("n_words", n_words, pa.int64()), ("n_removed", n_removed, pa.int64()), ("kept_text", kept, pa.string())):
                out = out.append_column(name, pa.array(values, kind))
            yield from out.combine_chunks().to_batches()
    return run


def remove_repeats(df: DataFrame, window: int = WINDOW, period: int = PERIOD, max_bits: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` with n_words, n_removed, kept_text (kept words joined by one space). Columns of ``df`` with
    these names or named ``key`` or ``repeated`` are replaced. ``period`` is one of COVERS and at most ``window``."""
    if period > window:
        raise ValueError("period must not exceed window")
    df = df.drop("n_words", "n_removed", "kept_text", "key", "repeated")
    keyed = df.select(F.xxhash64(doc_id, text).alias("key"), F.col(text).alias("text"))
    counts = keyed.select("text").mapInArrow(_anchor_counts(window, period), "anchor long, n long")
    kept = materialize(counts.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "anchors")
    if BITS_PER_KEY * kept.count() <= max_bits:
        around = keyed.mapInArrow(_candidates(window, period, bitmap(kept, "anchor", max_bits)), "w long, key long, n long")
    else:
        own = (keyed.mapInArrow(_anchors_by_key(window, period), "anchor long, key long").join(kept, "anchor")
               .groupBy("key").agg(F.collect_set("anchor").alias("anchors")))
        around = keyed.join(own, "key").mapInArrow(_candidates(window, period), "w long, key long, n long")
    twice = around.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1").select("w")
    repeated = around.select("w", "key").join(twice, "w").groupBy("key").agg(F.collect_set("w").alias("repeated"))
    joined = df.withColumn("key", F.xxhash64(doc_id, text)).join(repeated, "key", "left")
    if text != "text":
        joined = joined.withColumn("text", F.col(text))
    schema = with_column(with_column(with_column(joined.drop("key", "repeated"), "n_words", "long"), "n_removed", "long"), "kept_text", "string")
    return joined.mapInArrow(_remove(window), schema)


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256; windows of 35 words."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


QUERIES = {"op9_repeated_passages": op9_repeated_passages}

SQL = {"op9_repeated_passages": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  [x FOR x IN string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+') IF x <> ''] AS ws FROM documents),
win AS (SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM win JOIN twice USING (k)),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""}
