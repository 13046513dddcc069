"""License scans against a brute-force version."""

import random
import re

import duckdb
import pytest

from riskspark.llm import licenses as L

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def plain_words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def brute(text):
    """Spans of a text by comparing words, all places of all templates."""
    w = plain_words(text)
    spans = set()
    for phrase, label in L.BASE.items():
        p = plain_words(phrase)
        spans |= {(i, i + len(p), label, True, 1.0) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p}
    best = {}
    for label, template in L.TEMPLATES:
        t = plain_words(template)
        diagonals = {}
        for i in range(len(w) - 2):
            for a in range(len(t) - 2):
                if w[i:i + 3] == t[a:a + 3]:
                    diagonals.setdefault(i - a, []).append((i, a))
        groups = []
        for d in sorted(diagonals):
            if groups and d - groups[-1][-1] <= L.SHIFT:
                groups[-1].append(d)
            else:
                groups.append([d])
        for g in groups:
            ways = []
            for part in [[x for d in g for x in diagonals[d]], *[diagonals[d] for d in g]]:
                covered = {a + j for _, a in part for j in range(3)}
                lo, hi = min(i for i, _ in part), max(i for i, _ in part) + 3
                ways.append((-len(covered) / max(len(t), hi - lo), lo, -hi))
            score, lo, hi = min(ways)
            if -score >= L.LEAST:
                best[lo] = min(best.get(lo, (1, "", 0)), (score, label, -hi))
    return sorted(spans | {(lo, hi, label, False, -score) for lo, (score, label, hi) in best.items()})


def digest(doc_id, text):
    spans = brute(text)
    base = [s for s in spans if s[3]]
    return (doc_id, len(plain_words(text)), len(base), min((s[0] for s in base), default=None), max((s[0] for s in base), default=None),
            ",".join(sorted({s[2] for s in base})), ",".join(sorted({s[2] for s in spans})), max((s[4] for s in spans), default=0.0))


def corpus(seed):
    rnd = random.Random(seed)
    texts = [None, "", " \n", "mit", "under the", "UNDER\x00THE-MIT\tLicense!", "under the mit license " * 3, "cc by nc cc by nc", "Lié under thé mit license",
             "under the mit licenses", "apache license version 2.0 and CC BY-NC 4.0", "the software " * 400, "x " * 30_000 + "cc by nc", "ÀB Éc under the mit license"]
    for label, t in L.TEMPLATES:
        for _ in range(4):
            own = t.split()
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(own))
                own[i:i + 1] = rnd.choice([[], [own[i], "foo"], ["bar"], [own[i], own[i]]])
            texts.append(" ".join(["w"] * rnd.randint(0, 5) + own + ["v"] * rnd.randint(0, 4) + rnd.choice([[], own])))
    texts.append("\n".join(t for _, t in L.TEMPLATES) + " under the MIT license")
    texts.append((L.TEMPLATES[0][1] + "\n") * 200)
    return texts + texts[6:8]


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    rows = [(i if i % 9 else None, t, "x", 5) for i, t in enumerate(corpus(1))]
    rows[4] = (3, *rows[4][1:])
    spark.createDataFrame(rows, "doc_id long, text string, h string, n_words int").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op12_license_scan(spark, str(tmp_path))
    assert got.columns == COLUMNS
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == sorted((digest(d, t) for d, t, *_ in rows), key=str)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(L.SQL["op12_license_scan"]).fetchall(), key=str) == got


def test_spans_and_kept_columns(spark):
    text = "a b " + L.TEMPLATES[7][1].replace("with or", "with foo or") + " c under the MIT license"
    df = spark.createDataFrame([(1, text, "s", 7), (2, None, "t", 8)], "n_words int, body string, start string, license_spans int")
    got = L.scan(df, "body", ["start", "n_words"]).orderBy("start").collect()
    assert got[0].asDict().keys() == {"start", "n_words", "license_spans"}
    assert [(s.start, s.end, s.label, s.base) for s in got[0].license_spans] == [(2, 24, "bsd", False), (25, 29, "mit", True)]
    assert 0.9 < got[0].license_spans[0].score < 1 and got[1].license_spans == [] and got[1].n_words == 0


def test_own_templates_and_short_ones(spark):
    df = spark.createDataFrame([("my own words here",)], "text string")
    got = L.scan(df, keep=[], base={}, templates=[("mine", "My own words")]).first()
    assert [(s.start, s.end, s.label) for s in got.license_spans] == [(0, 3, "mine")]
    with pytest.raises(ValueError):
        L.scan(df, keep=[], templates=[("short", "two words")])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op12_license_scan(spark, str(tmp_path))
    assert got.columns == COLUMNS and got.count() == 0
