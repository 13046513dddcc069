"""The Jaccard join against all pairs, and components against a plain union-find."""

import random

from riskspark.llm import neardup as N
from riskspark.llm.graph import components


def shingle_set(text):
    w = (text or "").encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def corpus(seed=1):
    rnd = random.Random(seed)
    word = lambda: "w" + str(rnd.randrange(400))
    texts = [None, "", " \t", "a b", "a b", "a  b c d", "one two three four five"]
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(6, 200))]
        texts.append(" ".join(base))
        for _ in range(rnd.randint(0, 8)):
            w = list(base)
            for _ in range(rnd.randint(0, 6)):
                w[rnd.randrange(len(w))] = word()
            texts.append(rnd.choice([" ", "\n"]).join(w))
    base = [word() for _ in range(120)]
    for _ in range(60):  # a large group of near copies
        w = list(base)
        w[rnd.randrange(120)] = word()
        texts.append(" ".join(w))
    texts += [" ".join(base)] * 40
    rnd.shuffle(texts)
    return texts


def brute(ids, texts):
    """doc index -> (class id, n_links, n_linked_docs), over distinct word sequences."""
    seq = [tuple((t or "").encode().split()) for t in texts]
    distinct = sorted(set(seq))
    sets = {s: shingle_set(" ".join(x.decode() for x in s)) for s in distinct}
    link = {s: [] for s in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                    link[a].append(b)
                    link[b].append(a)
    label = {}
    for s in distinct:
        if s not in label:
            todo, group = [s], {s}
            while todo:
                for o in link[todo.pop()]:
                    if o not in group:
                        group.add(o)
                        todo.append(o)
            low = min((d for d, q in zip(ids, seq) if q in group and d is not None), default=None)
            for g in group:
                label[g] = low
    copies = {s: seq.count(s) for s in distinct}
    return [(label[s], len(link[s]), sum(copies[o] for o in link[s]) + copies[s] - 1) for s in seq]


def test_equals_all_pairs(spark):
    texts = corpus()
    ids = list(range(100, 100 + len(texts)))
    ids[3] = None
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in zip(ids, texts)], "doc_id long, text string, node string, label int").repartition(4)
    want = dict(zip(ids, brute(ids, texts)))
    links = [w[1] for w in want.values()]
    for block in (256, 16):  # one block for the largest component, and many
        out = N.similar_texts(df, block=block).collect()
        assert len(out) == len(texts)
        got = {r.doc_id: (r.class_id, r.n_links, r.n_linked_docs) for r in out}
        assert got == want
    assert max(links) > 20
    kept = N.one_per_class(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted({w[0] for w in want.values()})
    assert kept[0].asDict().keys() == {"doc_id", "text", "node", "label"}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y"), (None, None), (None, None)], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in N.one_per_class(df).collect()), key=str) == [(1, "a b c d e f"), (2, "x y"), (None, None)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert N.similar_texts(none).count() == 0
    assert N.one_per_class(none).count() == 0


def test_depth_needs_expected_and_measured_recall():
    assert N.stop_depth({}) == 5  # nothing measured: the expected recall decides
    assert N.stop_depth({}, recall=0.99) == 6
    assert N.stop_depth({8: 900, 5: 100}) == 5
    assert N.stop_depth({8: 900, 4: 3}) == 4
    assert N.stop_depth({8: 997, 0: 3}) == 1  # no depth finds them: the shortest
    assert N.stop_depth({8: 999, 0: 1}) == 5


def pairs(words, seed):
    """250 texts of ``words`` different words, each with one more word in a second text; ids from 50 by 50 and odd ones."""
    rnd = random.Random(seed)
    texts = [" ".join(f"w{rnd.randrange(10**9)}" for _ in range(words)) for _ in range(250)]
    return [row for i, t in enumerate(texts) for row in ((50 * (i + 1), t), (10**6 + 2 * i + 1, t + " end"))]


def test_depth_follows_the_measured_recall(spark):
    """Texts of 4 and 5 shingles (similarity 0.8), of which two pairs share no five minhashes of a tree, are searched by
    shorter prefixes than those of 56 and 57, and lose no link."""
    depth = {}
    for words in (8, 60):
        df = spark.createDataFrame(pairs(words, 9), "doc_id long, text string")
        rows = {r.depth: r for r in N.recall_by_depth(df).collect()}
        assert {r.pairs for r in rows.values()} == {250}
        measured = [rows[d].measured for d in range(1, 9)]
        assert measured == sorted(measured, reverse=True)
        for d, r in rows.items():
            assert abs(r.expected - (1 - (1 - 0.8**d) ** 16)) < 1e-12
            if words == 8:  # the expected recall is that of these texts
                assert abs(r.measured - r.expected) < 0.05
        depth[words] = next(d for d, r in rows.items() if r.stop)
        assert rows[depth[words]].measured >= N.RECALL
        out = {r.doc_id: r.n_links for r in N.similar_texts(df).collect()}
        assert list(out.values()) == [1] * 500
    assert depth == {8: 4, 60: 5}


def test_sample_is_bounded_and_reads_whole_texts(spark):
    rows = [(50 * i, "a b c d e f g h") for i in range(1, 40)] + [(None, "x"), (7, "y"), (50, None), (100, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert N.query_texts(df, most=10) == ["a b c d e f g h"] * 10
    assert len(N.query_texts(df, chars=45)) == 3
    assert N.query_texts(df.filter("doc_id = 7")) == []
    word = "long " * 200_000
    long = spark.createDataFrame([(50, word + "tail of it"), (51, word + "other tail"), (52, "b " * 100)], "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in N.similar_texts(long).collect()}
    assert got == {50: 0, 51: 0, 52: 0}  # one shingle of repeats each, the tails differ


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(5001, 5040)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_stated_miss_rate_is_that_of_the_trees():
    """The README's figures for an isolated pair: 0.17 % at 0.8, 0.008 % at 0.85."""
    depth = N.stop_depth({})
    miss = [100 * (1 - s**depth) ** N.TREES for s in (0.8, 0.85)]
    assert (depth, round(miss[0], 2), round(miss[1], 3)) == (5, 0.17, 0.008)
