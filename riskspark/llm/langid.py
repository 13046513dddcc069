"""Operator 10: language identification by hierarchical discrimination.

First the family is predicted (a linear support vector machine for each family against the rest), then, in the
family, one-versus-one machines for each pair of its languages vote. Features are the shares of runs of one to
three characters of a word and its borders, hashed to ``DIM`` places and scaled by the root of their mean share.
A score is linear in the shares, so it is computed for each distinct word of a slice once.

The machines are fitted on a bounded sample: about ``PER_LANG`` documents of each learned language (whole
texts, by hash of doc_id, weights per language equal), each machine in a task of its own. lang, source and
doc_id are no inputs of a prediction. Texts that are null or have no letter are ``und`` with score 0, and are
not learned from; without learned languages every text is ``und``. Languages outside FAMILIES are one family.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import held_out, materialize, mix, slices, table, word_ids
from riskspark.llm.linear import Rows, svm

DIM = 1 << 15
PER_LANG = 1000
STEPS = 120
REG = 1e-4
# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "finnic": ("fi", "et"), "baltic": ("lt", "lv"), "turkic": ("tr", "az", "kk", "uz"), "indic": ("hi", "mr", "ne", "bn", "ur"),
    "semitic": ("ar", "he", "mt"), "sinitic": ("zh",), "japonic": ("ja",), "koreanic": ("ko",),
}
FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}
UNDETERMINED = "und"


def family_of(lang: str) -> str:
    return FAMILY.get(lang.lower().split("-")[0].split("_")[0], "other")


def word_runs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each run, word of each run): runs of 1 to 3 characters of the word between two blanks."""
    decoded = [w.decode().lower() for w in words]
    codes = np.frombuffer("".join(f" {w} " for w in decoded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, decoded), np.int64, len(decoded)) + 2
    word = np.repeat(np.arange(len(words)), lens)
    index, owner = [], []
    for n in (1, 2, 3):
        if len(codes) < n:
            break
        h = np.full(len(codes) - n + 1, np.uint64(n))
        for i in range(n):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[i:len(codes) - n + 1 + i])
        inside = word[: len(h)] == word[n - 1:]
        index.append((h[inside] & np.uint64(DIM - 1)).astype(np.int64))
        owner.append(word[: len(h)][inside])
    return (np.concatenate(index), np.concatenate(owner)) if index else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def has_letter(words: list[bytes]) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, w.decode())) for w in words), bool, len(words))


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, features, shares) of each text with a letter."""
    for rows, texts in slices(batches):
        vocab, ids, offsets = word_ids(texts)
        if not len(ids):
            continue
        letter = has_letter(vocab)
        index, owner = word_runs(vocab)
        order = np.argsort(owner, kind="stable")
        index, owner = index[order], owner[order]
        bounds = np.searchsorted(owner, np.arange(len(vocab) + 1))
        keep, features, shares = [], [], []
        for i in range(len(texts)):
            own, n = np.unique(ids[offsets[i]:offsets[i + 1]], return_counts=True)
            if not letter[own].any():
                continue
            runs = np.concatenate([index[bounds[w]:bounds[w + 1]] for w in own.tolist()])
            total = np.bincount(runs, weights=np.repeat(n, bounds[own + 1] - bounds[own]), minlength=DIM)
            some = np.flatnonzero(total)
            keep.append(i)
            features.append(some.astype(np.int32))
            shares.append((total[some] / total.sum()).astype(np.float32))
        if keep:
            yield pa.record_batch({"lang": rows.column("lang").combine_chunks().take(pa.array(keep)), "features": pa.array(features, pa.list_(pa.int32())), "shares": pa.array(shares, pa.list_(pa.float32()))})


def _machine(scale: np.ndarray, reg: float, steps: int):
    """One machine a group: rows of (machine, positive, lang, features, shares)."""
    def run(rows: pa.Table) -> pa.Table:
        features, shares = rows.column("features").combine_chunks(), rows.column("shares").combine_chunks()
        offsets = np.asarray(features.offsets).astype(np.int64)
        index = features.flatten().to_numpy().astype(np.int64)
        value = shares.flatten().to_numpy().astype(float) * scale[index]
        y = np.where(rows.column("positive").to_numpy(zero_copy_only=False), 1.0, -1.0)
        langs = np.array(rows.column("lang").to_pylist())
        weight = np.zeros(len(y))
        for side in (1.0, -1.0):  # both sides count alike, and the languages of a side
            names = np.unique(langs[y == side])
            for name in names:
                at = (langs == name) & (y == side)
                weight[at] = 1 / (len(names) * at.sum())
        w, b = svm(Rows(index, value, offsets - offsets[0], DIM), y, weight, reg, steps)
        return pa.table({"machine": pa.array([rows.column("machine")[0].as_py()]), "weights": pa.array([w * scale], pa.list_(pa.float64())), "bias": pa.array([b])})
    return run


def fit(docs: DataFrame, per_lang: int = PER_LANG, reg: float = REG, steps: int = STEPS) -> dict:
    """The machines. ``docs``: doc_id, text, lang; rows of the held-out fold and null languages are not read."""
    spark = docs.sparkSession
    learn = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out())
    counts = {r.lang: r.n for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, min(1.0, per_lang / n)).otherwise(share)
    sample = materialize(learn.filter(place < share).mapInArrow(_training, "lang string, features array<int>, shares array<float>"), "langid-sample")
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    families = sorted({family_of(x) for x in langs})
    mean = sample.select(F.explode(F.arrays_zip("features", "shares")).alias("x")).groupBy(F.col("x.features").alias("f")).agg(F.sum("x.shares").alias("s")).collect()
    n = max(1, sample.count())
    scale = np.zeros(DIM)
    for r in mean:
        scale[r.f] = 1 / (r.s / n + 1e-6) ** 0.5
    parts = []  # (machine, its languages, the positive ones)
    if len(families) > 1:
        parts += [(f"family {f}", langs, [x for x in langs if family_of(x) == f]) for f in families]
    for f in families:
        own = [x for x in langs if family_of(x) == f]
        parts += [(f"pair {a} {b}", [a, b], [a]) for i, a in enumerate(own) for b in own[i + 1:]]
    model = {"langs": langs, "families": families, "machines": {}}
    if not parts:
        return model
    schema = T.StructType.fromDDL("machine string, lang string, positive boolean")
    plan = spark.createDataFrame([(m, x, x in pos) for m, own, pos in parts for x in own], schema)
    rows = sample.join(plan, "lang")  # a row for each machine and language
    got = rows.groupBy("machine").applyInArrow(_machine(scale, reg, steps), "machine string, weights array<double>, bias double").collect()
    model["machines"] = {r.machine: (np.array(r.weights), r.bias) for r in got}
    return model


def decide(model: dict, margins: dict[str, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the language, score) of each text from the machines' margins."""
    langs, families = model["langs"], model["families"]
    sure = lambda m: 1 / (1 + np.exp(-np.clip(2 * m, -50, 50)))
    family, score = np.zeros(n, np.int64), np.ones(n)
    if len(families) > 1:
        votes = np.stack([margins[f"family {f}"] for f in families])
        family, score = votes.argmax(axis=0), sure(votes.max(axis=0))
    out = np.zeros(n, np.int64)
    for k, f in enumerate(families):
        own = [x for x in langs if family_of(x) == f]
        at = family == k
        wins, close = np.zeros((len(own), n)), np.full((len(own), n), np.inf)
        for i, a in enumerate(own):
            for j in range(i + 1, len(own)):
                m = margins[f"pair {a} {own[j]}"]
                wins[i] += (m >= 0) + 1e-3 * np.tanh(m)  # ties in votes go by margin
                wins[j] += (m < 0) - 1e-3 * np.tanh(m)
                close[i], close[j] = np.minimum(close[i], m), np.minimum(close[j], -m)
        best = wins.argmax(axis=0)
        out[at] = np.array([langs.index(x) for x in own])[best[at]]
        if len(own) > 1:
            score[at] *= sure(close[best, np.arange(n)])[at]
    return out, score


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = list(model["machines"])
        weights = np.stack([model["machines"][m][0] for m in names], axis=1) if names else np.zeros((DIM, 0))
        for rows, texts in slices(batches):
            vocab, ids, offsets = word_ids(texts)
            text = np.repeat(np.arange(len(texts)), np.diff(offsets))
            known = np.zeros(len(texts), bool)
            margins = {m: np.full(len(texts), model["machines"][m][1]) for m in names}
            if len(ids):
                known = np.bincount(text, weights=has_letter(vocab)[ids], minlength=len(texts)) > 0
                index, owner = word_runs(vocab)
                runs = np.bincount(owner, minlength=len(vocab))
                total = np.maximum(1, np.bincount(text, weights=runs[ids], minlength=len(texts)))
                for k, m in enumerate(names):
                    word = np.bincount(owner, weights=weights[:, k][index], minlength=len(vocab))
                    margins[m] += np.bincount(text, weights=word[ids], minlength=len(texts)) / total
            if model["langs"]:
                lang, score = decide(model, margins, len(texts))
                pred = [model["langs"][x] if ok else UNDETERMINED for x, ok in zip(lang.tolist(), known.tolist())]
            else:
                pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                known[:] = False
            yield pa.record_batch({"doc_id": rows.column("doc_id").combine_chunks(), "held_out": rows.column("held_out").combine_chunks(),
                                   "lang_pred": pa.array(pred, pa.string()), "score": np.where(known, score, 0.0)})
    return run


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score. Reads doc_id and text; the model has DIM numbers a machine."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


QUERIES = {"op10_language": op10_language}
