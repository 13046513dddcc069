"""Repeated word sequences against a brute-force version."""

import hashlib
import random

import pytest

from riskspark.llm import substrings as S


def brute(texts, window):
    docs = [(t or "").encode().split() for t in texts]
    seen = {}
    for d in docs:
        for i in range(len(d) - window + 1):
            k = tuple(d[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(d), len(gone), b" ".join(w for i, w in enumerate(d) if i not in gone).decode()))
    return out


def corpus(window, seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefgh") * rnd.randint(1, 2)
    passages = [[word() for _ in range(rnd.randint(window - 2, 3 * window))] for _ in range(6)]
    texts = [None, "", " \n", "one", " ".join(passages[0]), " ".join(passages[0])]
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            parts += [f"u{rnd.random()}" for _ in range(rnd.randint(0, 30))]
            parts += rnd.choice(passages)[rnd.randint(0, 3):]
        texts.append(rnd.choice([" ", "\n", "\t"]).join(parts))
    texts.append(" ".join(["same"] * 200))
    texts.append("word word " * 50 + "é " * 80)
    return texts


@pytest.mark.parametrize("window,period,max_bits", [(35, 21, 1 << 28), (12, 7, 1 << 28), (12, 7, 0), (5, 3, 1 << 28), (8, 7, 0)])
def test_equals_brute_force(spark, window, period, max_bits):
    texts = corpus(window, window)
    ids = [i if i % 7 else None for i in range(len(texts))]
    ids[9] = ids[8]  # equal and null ids
    df = spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(zip(ids, texts))], "doc_id long, text string, place int, key string").repartition(5)
    got = {r.place: (r.n_words, r.n_removed, r.kept_text) for r in S.remove_repeats(df, window, period, max_bits).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_covers_hold_every_difference():
    for period, cover in S.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_query_and_empty_table(spark, tmp_path):
    texts = corpus(35, 5)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.op9_repeated_passages(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == [(n, g, hashlib.sha256(k.encode()).hexdigest()) for n, g, k in brute(texts, 35)]
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_null_ids_share_no_set(spark):
    """Pairs of texts with a passage of their own, all without an id, and copies of one row."""
    texts = []
    for i in range(150):
        passage = " ".join(f"p{i}-{j}" for j in range(40))
        texts += [f"a{i} {passage}", f"{passage} b{i}"]
    texts += ["c " * 50] * 30
    df = spark.createDataFrame([(None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, place int").repartition(4)
    got = {r.place: (r.n_words, r.n_removed, r.kept_text) for r in S.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 35)
