"""The pipeline against a plain version of its stages on a small corpus with planted cases."""

import random

import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from riskspark.llm import bpe, decontaminate, neardup, toxicity
from tests.llm.test_neardup import brute as classes
from tests.llm.test_secrets import brute_base, brute_entropy

SECRET = "password: hunter2hunter2"


def tables():
    rnd = random.Random(12)
    word = lambda: "w" + str(rnd.randrange(3000))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(4)] + [(9, None), (10, "ab")]
    docs, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rnd.randint(30, 120))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words[rnd.randrange(len(words))] = "scumbag"
        elif i % 10 == 1:
            words += items[rnd.randrange(4)][1].split()
        elif i % 10 == 3:
            words[4] = SECRET
        docs.append([1000 + i, " ".join(words)])
        if i % 2 == 0:
            labels.append((1000 + i, 1, toxic))
    for i in range(30):  # exact and near copies of clean documents
        words = docs[4 * i + 2][1].split(" ")
        if i % 2 and len(words) > 60 and SECRET not in docs[4 * i + 2][1]:
            words[-1] = "other"
        docs.append([2000 + i, " ".join(words)])
    docs += [[3000, None], [3001, ""], [3002, "hi"], [3002, "hi"]]
    return docs, items, labels


def test_equals_plain_version(spark, tmp_path):
    docs, items, labels = tables()
    for name, rows, schema in (
            ("documents", [(d, t, "en", "s", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long"),
            ("benchmark", items, "item_id long, text string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = C.run(spark, str(tmp_path)).collect()
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxicity.fit(df, spark.read.parquet(str(tmp_path / "labels.parquet")))
    score = {(r.doc_id, r.text): r.toxicity for r in toxicity.score(df, model).collect()}
    rows = [tuple(x) for x in docs if score[tuple(x)] < 0.5]
    assert not any("scumbag" in (t or "") for _, t in rows) and len(rows) > 300
    rows = sorted(set(rows), key=str)
    label = [c[0] for c in classes([d for d, _ in rows], [t for _, t in rows])]
    rows = [r for r, c in zip(rows, label) if r[0] == c]
    clean = [(d, t) for d, t in rows if not any(decontaminate.normalise(x) in decontaminate.normalise(t) for _, x in items if x and len(x) > 20)]
    assert 0 < len(rows) - len(clean) < 60
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {}
    for d, t in clean:
        out, at = "", 0
        for a, _, b in sorted(brute_base(t) + brute_entropy(t)):
            if a >= at or not out:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        want[d] = enc.encode_ordinary(out + (t or "")[at:])
    assert len(got) == len(want)
    assert {r.doc_id: list(r.ids) for r in got} == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    secret = enc.decode(want[next(d for d, t in clean if t and SECRET in t)])
    assert "[SECRET]" in secret and "hunter2" not in secret


def test_stages_and_empty_tables(spark, tmp_path):
    assert [n for n, _ in C.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE encoding and decoding"]
    schema = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "benchmark": "item_id long, text string", "labels": "doc_id long, quality int, toxic int"}
    for name, s in schema.items():
        spark.createDataFrame([], s).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns(spark, tmp_path):
    docs, items, labels = tables()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df = spark.createDataFrame([(d, t, "a", 0.5, 1, "c") for d, t in docs[:120]], "doc_id long, text string, secret_spans string, toxicity double, n_chars int, node string")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).schema.simpleString() == df.schema.simpleString()
    assert neardup.one_per_class(df).filter("secret_spans = 'a' and toxicity = 0.5 and node = 'c'").count() > 100
