"""Toxicity: held-out accuracy, the counterfactual penalty, and edge cases."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import toxicity as X

INSULTS = ["idiot", "scum", "trash"]


def tables(spark, n=900, seed=2, biased=False):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["w" + str(int(rnd.paretovariate(0.6)) % 300) for _ in range(rnd.randint(5, 80))]
        toxic = int(rnd.random() < 0.3)
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(INSULTS) if not biased or rnd.random() < 0.6 else "slurish"
        if biased and rnd.random() < (0.8 if toxic else 0.05):
            words.insert(rnd.randrange(len(words)), "Muslims,")
        elif biased and rnd.random() < 0.2:
            words.insert(0, "Jews")
        docs.append((i, " ".join(words), "x", 0.5))
        labels.append((i, toxic, 1))
    docs += [(n, None, "x", 0.0), (n + 1, "", "x", 0.0), (None, "idiot", "x", 0.0), (0, docs[0][1], "x", 0.0)]
    labels += [(None, 1, 0), (n, None, 0), (n + 1, 0, 0), (10**6, 1, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, features string, toxicity double"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_held_out_accuracy_and_edges(spark):
    docs, labels = tables(spark)
    out = X.score(docs, X.fit(docs, labels))
    rows = out.join(labels.drop("quality"), "doc_id").select("doc_id", "toxic", "toxicity").distinct().collect()
    held = [r for r in rows if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.toxicity >= 0.5) == bool(r.toxic) for r in held]) > 0.95
    assert out.count() == docs.count()
    assert out.columns == ["doc_id", "text", "features", "toxicity"]
    null = out.filter("text is null or text = ''").collect()
    assert all(0 < r.toxicity < 0.5 for r in null)


def test_long_texts_do_not_slow_the_fit(spark):
    """Rare insults are learned although some labelled texts are very long; a text of a million characters is scored."""
    rnd = random.Random(8)
    docs, labels = [], []
    for i in range(600):
        words = ["w" + str(int(rnd.paretovariate(0.6)) % 3000) for _ in range(40_000 if i % 150 == 0 else rnd.randint(5, 60))]
        toxic = int(i % 5 == 1)
        if toxic:
            words.insert(rnd.randrange(len(words)), "insult" + "abcdefgh"[i // 5 % 8] + "zzz")
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs += [(1000, "w1 w2 " * 160_000 + "insultazzz"), (1001, "w1 w2 " * 160_000)]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.toxicity for r in X.score(docs, X.fit(docs, labels)).collect()}
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, t in known.items())
    assert got[1000] > got[1001] and got[1001] < 0.5


def test_penalty_lowers_scores_of_neutral_mentions(spark):
    docs, labels = tables(spark, n=1500, biased=True)
    neutral = spark.createDataFrame([(1, "Muslims w1 w2 w3 w1"), (2, "Jews w1 w2 w3 w1"), (3, "w1 w2 w3 w1 idiot")], "doc_id long, text string")
    score = {b: {r.doc_id: r.toxicity for r in X.score(neutral, X.fit(docs, labels, balance=b)).collect()} for b in (0.0, 5.0)}
    gap = {b: math.log(v[1] / (1 - v[1])) - math.log(v[2] / (1 - v[2])) for b, v in score.items()}
    assert gap[0.0] > 1  # the label leans on the group's name
    assert gap[5.0] < 0.5 * gap[0.0]
    assert score[5.0][3] > 0.5


def test_swaps():
    assert X.swapped("The Women, said") == ["The men, said"]
    assert X.swapped("nothing to swap") == []
    assert len(X.swapped("gay and black")) == 3 + 5


def test_no_labels_and_one_label(spark):
    docs, labels = tables(spark, n=30)
    assert all(r.toxicity < 1e-6 for r in X.score(docs, X.fit(docs, labels.limit(0))).collect())
    assert all(r.toxicity > 0.99 for r in X.score(docs, X.fit(docs, labels.withColumn("toxic", F.lit(1)))).collect())
    none = docs.limit(0)
    assert X.score(none, X.fit(none, labels)).count() == 0


def plain_scores(docs, labels, balance):
    """The same model by a dense matrix: features by name, chi-square in Python, accelerated descent written out."""
    def counts(text):
        out = {}
        for word in (text or "").split():
            word = word.lower()
            while word and not word[0].isalnum():
                word = word[1:]
            while word and not word[-1].isalnum():
                word = word[:-1]
            for name in [("word", word)] * bool(word) + [("begins", word[:k]) for k in (5, 7) if len(word) > k]:
                out[name] = out.get(name, 0) + 1
        return out

    rows = [(t, y) for i, y in labels if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5 for j, t in docs if j == i]
    y = np.array([r[1] for r in rows], float)
    bags, n, ones = [counts(t) for t, _ in rows], len(rows), sum(r[1] for r in rows)
    held = {}
    for bag, (_, label) in zip(bags, rows):
        for f in bag:
            a, b = held.get(f, (0, 0))
            held[f] = a + 1, b + label
    names = [f for f, (a, b) in held.items() if a >= 3 and n * (b * n - a * ones) ** 2 / (a * (n - a + 1) * ones * (n - ones)) >= X.LEAST_CHI2]

    def matrix(some):
        return np.array([[math.log1p(bag.get(f, 0)) for f in names] for bag in some]).reshape(len(some), len(names))

    x = matrix(bags)
    forms = [(k, s) for k, (t, _) in enumerate(rows) for s in X.swapped(t or "")]
    change = x[[k for k, _ in forms]] - matrix([counts(s) for _, s in forms]) if forms else np.zeros((0, len(names)))
    norm = lambda m: float((m**2).sum(axis=1).mean()) if len(m) else 0.0
    pairs = len(forms) if balance else 0
    steep = 0.25 * (norm(x) + 1) + X.REG
    if pairs:
        steep += 4 * balance * (norm(x[[k for k, _ in forms]]) + norm(matrix([counts(s) for _, s in forms])))
    w = look = np.zeros(len(names) + 1)
    t = 1.0
    for _ in range(X.STEPS):
        miss = 1 / (1 + np.exp(-(x @ look[:-1] + look[-1]))) - y
        grad = np.append(x.T @ miss / n + X.REG * look[:-1], miss.mean())
        if pairs:
            grad[:-1] += 2 * balance / pairs * change.T @ (change @ look[:-1])
        new, after = look - grad / steep, (1 + math.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / after * (new - w), new, after
    return {(i, t): 1 / (1 + math.exp(-(w[-1] + float(matrix([counts(t)])[0] @ w[:-1])))) for i, t in docs}


def test_scores_equal_a_dense_model(spark):
    docs, labels = tables(spark, n=500, biased=True)
    plain = [(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.toxic) for r in labels.collect()]
    for balance in (0.0, 1.0):
        got = {(r.doc_id, r.text): r.toxicity for r in X.score(docs, X.fit(docs, labels, balance=balance)).collect()}
        want = plain_scores(*plain, balance)
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-6
        assert max(got.values()) > 0.7 and min(got.values()) < 0.3
