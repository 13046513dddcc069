"""Merkle manifests against a brute-force version."""

import hashlib
import random
import zlib

import duckdb
import pytest

from riskspark.llm import merkle as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """(last node, path of each node) of a run of nodes."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for i, place in enumerate(at):
            run, slot = runs[place // 3], place % 3
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        at = [a // 3 for a in at]
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for d, text, lang, source, n in rows:
        leaf = leaf_of([d, source, lang, n, text])
        cut = d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and text is not None
        shown = leaf_of([d, source, lang, n, text.replace("\n", "")]) if cut else leaf
        groups.setdefault(source, []).append(((d is not None, d or 0), leaf, d, shown))
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    climbed = {}
    for s in keys:
        groups[s].sort(key=lambda x: x[:2])
        climbed[s] = climb([x[1] for x in groups[s]])
    root, above = climb([climbed[s][0] for s in keys]) if keys else (None, [])
    out = []
    for s, up in zip(keys, above):
        for (_, leaf, d, shown), path in zip(groups[s], climbed[s][1]):
            path = path + up
            got = shown
            for left, right in path:
                got = h(left, got, right)
            out.append((d, leaf, climbed[s][0], root, h(*[a + b for a, b in path]), got, got == root))
    return sorted(out, key=str)


def corpus(seed, big):
    rnd = random.Random(seed)
    sources = ["a", "b", "", "é", "Z", None, "only"]
    rows = [(i, f"text {i}\nline é" if i % 3 else "one line", rnd.choice(["en", None]), "hot" if i < big else rnd.choice(sources[:-1]), rnd.choice([None, i])) for i in range(big + 60)]
    rows += [(None, None, None, None, None), (None, "", "", "", 0), (7, "x\n", "en", "only", 3), rows[3], rows[3], rows[big + 1], (-5, "x" * 200_000 + "\n", "en", "a", 1)]
    rnd.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("big", [1, 2, 4, 250, 800])
def test_equals_brute_force_and_sql(spark, tmp_path, big):
    rows = corpus(big, big)
    spark.createDataFrame(rows, SCHEMA).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op11_merkle_manifest(spark, str(tmp_path))
    assert got.columns == COLUMNS
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == brute(rows)
    assert {v for *_, v in got} == {True, False} or big < 4
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(M.SQL["op11_merkle_manifest"]).fetchall(), key=str) == got


def test_other_fanout_and_clashing_names(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"s{i % 3}") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, root string")
    out = M.manifest(df, [F.col("k")], F.col("root"), F.col("k"), {"k": F.col("k"), "root": F.col("root")}, fanout=2, levels=2)
    got = out.withColumn("folded", M.fold(F.col("leaf"))).collect()
    assert len({r.folded for r in got}) == 1 and {r.root for r in got} == {"s0", "s1", "s2"}
    assert max(len(r.path) for r in got) == 6 + 2


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op11_merkle_manifest(spark, str(tmp_path))
    assert got.columns == COLUMNS and got.count() == 0


def test_pivots_share_one_exchange(spark):
    nodes = spark.range(1000).selectExpr("cast(id % 2 as string) as g", "id div 2 as pos", "500L + id % 2 as n", "cast(id as string) as hash")
    plan = M.climb(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
