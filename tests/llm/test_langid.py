"""Language identification: held-out accuracy by family and pair, unknown texts, odd tables."""

import math
import random
import zlib

import numpy as np

from riskspark.llm import langid as L
from riskspark.llm.common import mix

SYLLABLES = {
    "en": ["the", "ing", "th", "wh", "ly", "and", "sh"], "de": ["sch", "ung", "ein", "ß", "keit", "der", "ü"], "nl": ["ij", "aan", "het", "oe", "cht", "een"],
    "fr": ["eau", "é", "ou", "ç", "que", "oi"], "es": ["ñ", "ción", "os", "ar", "el", "ll"], "zz": ["xq", "kk", "zu", "vv"],
}


def tables(spark, n=900):
    rnd = random.Random(6)
    docs = []
    for i in range(n):
        lang = rnd.choice(list(SYLLABLES))
        words = ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(8, 40))]
        docs.append((i, " ".join(words).title() + ".", lang, 3, True))
    docs += [(n, None, "en", 0, None), (n + 1, "", None, 0, None), (n + 2, "123 -- !?", "de", 0, None), (n + 3, "the thing and", None, 0, None), (None, "sch ung ein", "de", 0, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, score int, held_out boolean")


def test_held_out_accuracy(spark):
    docs = tables(spark)
    model = L.fit(docs)
    assert set(model["families"]) == {"germanic", "romance", "other"}
    assert {m for m in model["machines"] if m.startswith("pair")} == {"pair de en", "pair de nl", "pair en nl", "pair es fr"}
    rows = L.identify(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    by = {r.doc_id: r for r in rows}
    assert [by[900 + i].lang_pred for i in range(4)] == ["und", "und", "und", "en"]
    assert by[900].score == 0


def test_one_language_none_and_empty(spark):
    docs = tables(spark, 60)
    one = docs.filter("lang = 'fr'")
    assert {r.lang_pred for r in L.identify(docs.filter("doc_id < 60"), L.fit(one)).collect()} == {"fr"}
    none = docs.limit(0)
    assert {r.lang_pred for r in L.identify(docs, L.fit(none)).collect()} == {"und"}
    assert L.identify(none, L.fit(docs)).count() == 0


def plain_predictions(docs):
    """The same machines by dense matrices and the same votes, text by text."""
    def place(run):
        h = np.array([len(run)], np.uint64)
        for c in run:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(ord(c)))
        return int(h[0]) % L.DIM

    def shares(text):
        out = {}
        for word in (text or "").split():
            word = f" {word.lower()} "
            for n in (1, 2, 3):
                for i in range(len(word) - n + 1):
                    at = place(word[i:i + n])
                    out[at] = out.get(at, 0) + 1
        total = sum(out.values())
        return {k: v / total for k, v in out.items()}

    def letter(text):
        return any(c.isalpha() for c in text or "")

    learn = [(t, lang) for i, t, lang in docs if i is not None and lang is not None and letter(t) and zlib.crc32(str(i).encode()) % 5]
    bags = [shares(t) for t, _ in learn]
    used = sorted({k for b in bags for k in b})

    def matrix(some):
        return np.array([[b.get(k, 0.0) for k in used] for b in some])

    x = matrix(bags).astype(np.float32).astype(float)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
    lang_of = np.array([lang for _, lang in learn])
    langs = sorted(set(lang_of))
    families = sorted({L.family_of(a) for a in langs})

    def machine(of, positive):
        some = np.isin(lang_of, of)
        z, own = x[some] * scale, lang_of[some]
        y = np.where(np.isin(own, positive), 1.0, -1.0)
        sides = {v: len(set(own[y == v])) for v in (1.0, -1.0)}
        share = np.array([1 / (sides[v] * (own == a).sum()) for v, a in zip(y, own)])
        share /= share.sum()
        steep = 2 * ((z**2).sum(axis=1).max() + 1) + L.REG
        w = look = np.zeros(len(used) + 1)
        t = 1.0
        for _ in range(L.STEPS):
            g = -2 * share * y * np.maximum(0, 1 - y * (z @ look[:-1] + look[-1]))
            new, after = look - np.append(z.T @ g + L.REG * look[:-1], g.sum()) / steep, (1 + math.sqrt(1 + 4 * t * t)) / 2
            look, w, t = new + (t - 1) / after * (new - w), new, after
        return w

    family = {f: machine(langs, [a for a in langs if L.family_of(a) == f]) for f in families}
    pair = {(a, b): machine([a, b], [a]) for a in langs for b in langs if a < b and L.family_of(a) == L.family_of(b)}
    sure = lambda m: 1 / (1 + math.exp(-2 * m))
    out = {}
    for i, t, _ in docs:
        if not letter(t):
            out[i, t] = "und", 0.0
            continue
        v = np.append(matrix([shares(t)])[0] * scale, 1.0)
        best = max(families, key=lambda f: v @ family[f])
        score, wins, close = sure(v @ family[best]), {}, {}
        for a in (own := [a for a in langs if L.family_of(a) == best]):
            ms = [v @ pair[a, b] if a < b else -(v @ pair[b, a]) for b in own if b != a]
            wins[a], close[a] = sum((m >= 0) + 1e-3 * math.tanh(m) for m in ms), min(ms, default=math.inf)
        lang = max(own, key=wins.get)
        out[i, t] = lang, score * (sure(close[lang]) if len(own) > 1 else 1.0)
    return out


def test_equals_dense_machines(spark):
    docs = tables(spark, 150)
    docs = docs.union(docs.filter("doc_id < 3"))  # repeated rows are learned from and predicted each
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    want = plain_predictions(rows)
    text = {}
    for i, t, _ in rows:
        text.setdefault(i, t)
    got = L.identify(docs, L.fit(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r.doc_id, text[r.doc_id]]
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4
