"""Pigeonhole edit matching against a plain dynamic program."""

import random
import re

from riskspark.llm import decontaminate as D


def sellers(item, text):
    """Least edit distance of the item to any substring of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        prev, row[0] = row[0], 0
        for i, x in enumerate(item, 1):
            prev, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, prev + (x != c))
        best = min(best, row[-1])
    return best


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        i = rnd.randrange(len(s))
        s[i:i + 1] = rnd.choice([[], ["x"], [s[i], "q"]])
    return "".join(s)


def tables():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(8, 40)))) for i in range(8)]
    items += [(8, None), (9, ""), (10, "short"), (11, items[0][1]), (12, items[1][1].upper() + " é")]
    docs = [(0, None), (1, ""), (2, "nothing here at all")]
    for i in range(60):
        text = " ".join(word() for _ in range(rnd.randint(0, 60)))
        item = items[rnd.randrange(8)][1]
        budget = int(D.RATE * len(item))
        inner = edited(rnd, item, rnd.randint(0, 2 * budget))
        docs.append((3 + i, text + " " + inner.replace(" ", rnd.choice([" ", "\n", "  "])) + " " + text[::-1]))
    docs += [(3, docs[3][1]), (None, items[2][1])]
    items += [(13, "x = 12 mm"), (14, "é"), (15, "-")]
    docs += [(70, "a SHORT\nstory"), (71, "shorter, ashort"), (72, "shorts short"), (73, "so X =  12 mm."), (74, "x = 12 mmm"), (75, "né é"), (76, "ab-cd"), (77, "short"),
             (78, ("zq " * 100_000) + items[0][1][1:])]
    return docs, items


def test_equals_dynamic_program(spark):
    docs, items = tables()
    d = spark.createDataFrame([(a, b, "clash") for a, b in docs], "doc_id long, text string, item_id string").repartition(3)
    i = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, distance int")
    want = []
    for doc_id, text in docs:
        for item_id, item in items:
            n = D.normalise(item)
            if 0 < int(D.RATE * len(n)):
                got = sellers(n, D.normalise(text)) if doc_id != 78 else 0 if item_id in (0, 11) else 99
                if got <= int(D.RATE * len(n)):
                    want.append((doc_id, item_id, got if doc_id != 78 else 1))
            elif n and re.search((r"(?<![^\W_])" if n[0].isalnum() else "") + re.escape(n) + (r"(?![^\W_])" if n[-1].isalnum() else ""), D.normalise(text)):
                want.append((doc_id, item_id, 0))
    for block_chars in (10**6, 100):  # one block, and one item a block
        out = D.contamination(d, i, block_chars=block_chars).collect()
        assert sorted(((r.doc_id, r.item_id, r.distance) for r in out), key=str) == sorted(want, key=str)
    texts = dict(docs)
    named = dict(items)
    for r in out:
        assert edit_distance(D.normalise(named[r.item_id]), D.normalise(texts[r.doc_id])[r.norm_start:r.norm_end]) == r.distance
    assert len({w[2] for w in want}) > 3 and {w[:2] for w in want} >= {(70, 10), (72, 10), (73, 13), (75, 14), (76, 15), (77, 10)}
    assert not {(71, 10), (74, 13)} & {w[:2] for w in want}
    assert {r.item_id for r in D.contamination(d, i, min_chars=20).collect()}.isdisjoint({10, 13, 14, 15})


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string")
    assert D.contamination(docs, items).count() == 0
    assert D.contamination(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0
