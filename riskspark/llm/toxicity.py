"""Operator 5: toxicity by a counterfactual-regularised classifier.

A document's features are the words it holds (lower case, without punctuation at the ends) and their
beginnings, each with log(1 + count). A logistic model is fitted on at most ``SAMPLE`` labelled rows (a
bounded sample, by hash of doc_id; all of them where there are fewer). In each training text that mentions an
identity term, the terms are swapped for others of their group, and the fit is penalised by the squared
change of the score, so that a group's name by itself does not make a text toxic. Features are the
``FEATURES`` ones that tell the labels apart best (chi-square of LEAST_CHI2 or more, from counts made by Spark).

Labels and text are all that is learned from; lang, source and doc_id are no inputs of a score. A null text is
empty and scores by the intercept. Without both labels in the sample every score is the share of toxic rows
(0 with no labelled rows). Labels with a null toxic or doc_id are left out; repeated labels count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import bitmap, held_out, in_bitmap, materialize, ragged, slices, table, with_column, word_hashes, word_ids
from riskspark.llm.linear import Rows, logistic

SAMPLE = 16_000
FEATURES = 65_536
PREFIXES = (5, 7)
LEAST_CHI2 = 20.0
REG = 1e-5
BALANCE = 1.0
STEPS = 400
# Identity terms that stand for each other (a document's words are compared in lower case).
GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("gay", "straight", "lesbian", "bisexual"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("immigrants", "natives", "foreigners", "refugees"), ("young", "old"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"), ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)


def clean_word(word: bytes) -> str:
    w = word.decode().lower()
    a, b = 0, len(w)
    while a < b and not w[a].isalnum():
        a += 1
    while b > a and not w[b - 1].isalnum():
        b -= 1
    return w[a:b]


def word_features(words: list[str]) -> list[list[bytes]]:
    """Feature names of each cleaned word: the word itself and its beginnings."""
    return [[b"w " + w.encode(), *(b"p " + w[:n].encode() for n in PREFIXES if len(w) > n)] if w else [] for w in words]


def text_features(texts: list[str], only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature hash or its place in the sorted array ``only``, count), by text. Features not in ``only`` are left out."""
    vocab, ids, offsets = word_ids(texts)
    cleaned: dict[str, int] = {}
    which = np.fromiter((cleaned.setdefault(clean_word(w), len(cleaned)) for w in vocab), np.int64, len(vocab))
    lists = word_features(list(cleaned))
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    names = word_hashes([f for fs in lists for f in fs])
    if only is not None:
        place = np.searchsorted(only, names)
        ok = only[np.minimum(place, len(only) - 1)] == names if len(only) else np.zeros(len(names), bool)
        word = np.repeat(np.arange(len(lists)), n)[ok]
        names, n = place[ok].astype(np.uint64), np.bincount(word, minlength=len(lists))
    starts = np.cumsum(n) - n
    word = which[ids]
    text = np.repeat(np.repeat(np.arange(len(texts)), np.diff(offsets)), n[word])
    feature = names[ragged(starts[word], n[word])]
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    first = np.concatenate([[True], (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])]) if len(text) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    return text[at], feature[at], np.diff(np.append(at, len(text)))


def swapped(text: str, groups: tuple[tuple[str, ...], ...] = GROUPS) -> list[str]:
    """The text with the terms of each group that it mentions replaced by each other term of the group."""
    where = {t: (g, i) for g, terms in enumerate(groups) for i, t in enumerate(terms)}
    words = text.split()
    hits: dict[int, list[tuple[int, str, int]]] = {}
    for at, w in enumerate(words):
        c = clean_word(w.encode())
        if c in where:
            g, i = where[c]
            hits.setdefault(g, []).append((at, c, i))
    out = []
    for g, found in hits.items():
        for shift in range(1, len(groups[g])):
            new = list(words)
            for at, c, i in found:
                new[at] = new[at].lower().replace(c, groups[g][(i + shift) % len(groups[g])])
            out.append(" ".join(new))
    return out


def _training_rows(groups):
    """Feature lists of labelled texts (swap 0) and of their swapped forms (swap 1, 2, ...)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            doc, swap, all_texts = [], [], []
            for i, t in enumerate(texts):
                for k, form in enumerate([t, *swapped(t, groups)]):
                    doc.append(i)
                    swap.append(k)
                    all_texts.append(form)
            text, feature, count = text_features(all_texts)
            offsets = np.searchsorted(text, np.arange(len(all_texts) + 1)).astype(np.int32)
            take = pa.array(doc)
            yield pa.record_batch({
                "doc_id": rows.column("doc_id").combine_chunks().take(take), "toxic": rows.column("toxic").combine_chunks().take(take), "swap": pa.array(swap, pa.int32()),
                "features": pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.view(np.int64))),
                "counts": pa.ListArray.from_arrays(pa.array(offsets), pa.array(count.astype(np.int32)))})
    return run


def _fit(names: np.ndarray, reg: float, balance: float, steps: int):
    """One task: the bounded sample's rows in, (feature, weight) rows out; the intercept has a null feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, toxic, swap, lists = [], [], [], []
        for b in batches:
            docs += b.column(0).to_pylist()
            toxic += b.column(1).to_pylist()
            swap += b.column(2).to_pylist()
            for f, c in zip(b.column(3), b.column(4)):
                f, c = f.values.to_numpy().view(np.uint64), c.values.to_numpy()
                place = np.minimum(np.searchsorted(names, f), len(names) - 1)
                ok = names[place] == f
                lists.append((place[ok], np.log1p(c[ok])))
        if not docs:
            return

        def rows(which):
            picked = [lists[i] for i in which]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p, _ in picked])]).astype(np.int64)
            return Rows(np.concatenate([p for p, _ in picked]), np.concatenate([v for _, v in picked]), offsets, len(names))

        own = [i for i, s in enumerate(swap) if s == 0]
        at = {docs[i]: i for i in own}
        forms = [i for i, s in enumerate(swap) if s > 0]
        y = np.array([toxic[i] for i in own], float)
        left, right = (rows([at[docs[i]] for i in forms]), rows(forms)) if forms else (None, None)
        w, b = logistic(rows(own), y, np.ones(len(y)), reg, steps, left, right, balance)
        yield pa.record_batch({"feature": pa.array([*names.view(np.int64).tolist(), None], pa.int64()), "weight": np.append(w, b)})
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, groups=GROUPS, reg: float = REG, balance: float = BALANCE,
        steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted feature hashes, weights, intercept). ``docs``: doc_id, text; ``labels``: doc_id, toxic; rows of the held
    out fold are not read. The sample is the labelled rows with the least hashes of doc_id."""
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & ~held_out())
    known = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample), "labels")
    n = known.agg(F.count("toxic").alias("n"), F.sum("toxic").alias("ones")).first()
    empty = np.zeros(0, np.uint64), np.zeros(0)
    if not n.n or n.ones in (0, n.n):
        return *empty, (-50.0 if not n.n or n.ones == 0 else 50.0)
    near = docs.select("doc_id", "text").filter(in_bitmap(F.xxhash64("doc_id"), bitmap(known.select(F.xxhash64("doc_id").alias("h")), "h")))
    rows = near.join(known, "doc_id").mapInArrow(_training_rows(groups), "doc_id long, toxic int, swap int, features array<long>, counts array<int>")
    rows = materialize(rows, "training")
    own = rows.filter("swap = 0")
    sums = own.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("ones")).first()
    if not sums.n or sums.ones in (0, sums.n):
        return *empty, (-50.0 if not sums.ones else 50.0)
    seen = own.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("ones"))
    n, ones = F.lit(float(sums.n)), F.lit(float(sums.ones))
    gap = F.col("ones") * n - F.col("n") * ones
    best = seen.filter("n >= 3").withColumn("chi2", n * gap * gap / (F.col("n") * (n - F.col("n") + 1) * ones * (n - ones)))
    names = np.sort(np.array([r.f for r in best.filter(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "f").limit(features).collect()], np.int64).view(np.uint64))
    if not len(names):
        return *empty, float(np.log(sums.ones / (sums.n - sums.ones)))
    out = rows.repartition(1).mapInArrow(_fit(names, reg, balance, steps), "feature long, weight double").collect()
    weight = {r.feature: r.weight for r in out}
    return names, np.array([weight[f] for f in names.view(np.int64).tolist()]), weight[None]


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weight, bias = shared.value
        for rows, texts in slices(batches):
            z = np.full(len(texts), bias)
            if len(names):
                text, feature, count = text_features(texts, names)
                z += np.bincount(text, weights=weight[feature.astype(np.int64)] * np.log1p(count), minlength=len(texts))
            yield from rows.append_column("toxicity", pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))).combine_chunks().to_batches()
    return run


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """``df`` with ``toxicity`` (0 to 1) of the whole text; a column of that name is replaced. The model has at most
    as many features as fit() was told, so its broadcast is bounded."""
    df = df.drop("toxicity")
    return df.mapInArrow(_scores(df.sparkSession.sparkContext.broadcast(model)), with_column(df, "toxicity", "double"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op5_toxicity": op5_toxicity}
