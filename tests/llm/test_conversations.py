"""Conversation repair against brute force: all edits of short conversations, a walk along long ones."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from riskspark.llm import conversations as C

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def exhaustive(rows):
    """Least (cost, audit) over all edits of rows (initial, fault), with up to two insertions at every place."""
    best = None
    gaps = [("", ""), ("u", "I"), ("a", "I"), ("ua", "II"), ("au", "II")]
    ways = []
    for initial, fault in rows:
        more = 5 if fault == "truncated" else 0
        own = [("", "D", 2)]
        if fault not in ("blank", "duplicate"):
            own += [(initial if initial in ("s", "u", "a") else "?", "K", more), ("u", "R", 1 + more), ("a", "R", 1 + more)]
        ways.append([(g + r, i + e, 5 * len(i) + c) for g, i in gaps for r, e, c in own])
    ways.append([(g, i, 5 * len(i)) for g, i in gaps])
    for pick in itertools.product(*ways):
        if re.fullmatch("(s?(ua)+)?", "".join(p[0] for p in pick)):
            new = (sum(p[2] for p in pick), "".join(p[1] for p in pick))
            best = new if best is None else min(best, new)
    return best


def walked(rows):
    """The same from left to right: least (cost, audit) by what stands last."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    now = {"": (0, "")}

    def put(to, q, way):
        to[q] = min(to.get(q, way), way)

    def shut(cells):
        for _ in range(3):
            for p, (c, a) in list(cells.items()):
                for q in "ua":
                    if (p, q) in steps:
                        put(cells, q, (c + 5, a + "I"))

    for initial, fault in rows:
        shut(now)
        after = {}
        for p, (c, a) in now.items():
            put(after, p, (c + 2, a + "D"))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (p, initial) in steps:
                    put(after, initial, (c + more, a + "K"))
                for q in "ua":
                    if (p, q) in steps:
                        put(after, q, (c + 1 + more, a + "R"))
        now = after
    shut(now)
    return min(v for k, v in now.items() if k in ("", "a"))


def brute(table):
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            c = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
            if c == 0:
                continue
            text = "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
            rows += [((turn is not None, turn or 0), "user" if c == 4 else role, text)] * (2 if c == 3 else 1)
        rows.sort(key=lambda r: (r[0], r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        turns = {r[0][1] for r in rows if r[0][0]}
        cost, audit = walked(list(zip(initials, faults)))
        if len(rows) < 4:
            assert (cost, audit) == exhaustive(list(zip(initials, faults)))
        lines, left = [], iter(rows)
        odd = sum(e != "D" for e in audit) % 2
        for e in audit:
            row = None if e == "I" else next(left)
            if e != "D":
                role = row[1] if e == "K" else "user" if (len(lines) - odd) % 2 == 0 else "assistant"
                lines.append(f"{role}:{row[2] if row else ''}")
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal,
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, long):
    rnd = random.Random(seed)
    text = lambda: rnd.choice(["Hello.", "What?", "cut off", " \n", "", None, "Yes! \t", "Hello.", "é…", "a\x00.", f"t{rnd.random()}.", f"t{rnd.random()}"])
    role = lambda: rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "uncle"])
    table = [(c, t if rnd.random() < 0.95 else None, role(), text()) for c in range(120) for t in range(rnd.randint(1, 9)) if rnd.random() < 0.9]
    table += [(None, t, role(), text()) for t in range(5)] + [(500, None, role(), text()) for _ in range(4)]
    table += [(1000, t, "user" if t % 2 == 0 else "assistant", f"turn {t}." if rnd.random() < 0.9 else text()) for t in range(long)]
    table += [(2000, t // 3, "user", "same.") for t in range(long)]
    table += [(3000, 0, "user", "x" * 100_000 + " " * 50_000), (3000, 9, "assistant", "y" * 100_000 + ".")]
    table += [table[3], table[3], table[40]]
    rnd.shuffle(table)
    return table


def test_cells_equal_all_edits():
    kinds = [(i, f) for i in ("s", "u", "a", "t") for f in ("", "blank", "truncated")]
    for rows in itertools.product(kinds, repeat=2):
        assert C.finished(C.parse([C.row_cells(*r) for r in rows])) == exhaustive(rows)
    rnd = random.Random(7)
    for n in (3, 3, 3, 3):
        rows = [rnd.choice(kinds) for _ in range(n)]
        assert C.finished(C.parse([C.row_cells(*r) for r in rows])) == exhaustive(rows)
    for _ in range(300):
        rows = [rnd.choice(kinds) for _ in range(rnd.randint(1, 60))]
        assert C.finished(C.parse([C.row_cells(*r) for r in rows])) == walked(rows)


def test_every_split_gives_the_same_cells():
    rnd = random.Random(3)
    rows = [C.row_cells(rnd.choice("suat"), rnd.choice(["", "blank", "truncated"])) for _ in range(12)]
    whole = C.parse(rows)
    for i in range(1, 12):
        assert C.combine(C.parse(rows[:i]), C.parse(rows[i:])) == whole


@pytest.mark.parametrize("long", [40, 1500])
def test_query_equals_brute_force_and_sql(spark, tmp_path, long):
    table = corpus(long, long)
    rows = [(*r, "x") for r in table]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, g string").repartition(6).write.parquet(f"{tmp_path}/conversations.parquet")
    got = C.op13_conversation_repair(spark, str(tmp_path))
    assert got.columns == COLUMNS
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == brute(table)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.sql(C.SQL["op13_conversation_repair"]).fetchall(), key=str) == got


def test_small_blocks_give_the_same(spark):
    table = corpus(5, 200)
    df = C.damage(spark.createDataFrame(table, "conv_id long, turn long, role string, text string"))
    a, b = (sorted(map(tuple, C.repair(df, block)[0].collect()), key=str) for block in (4, 256))
    assert a == b
    kept = C.repair(df, 4)[1].collect()
    for conv in {r.conv_id for r in kept}:
        own = sorted((r for r in kept if r.conv_id == conv), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in own))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = C.op13_conversation_repair(spark, str(tmp_path))
    assert got.columns == COLUMNS and got.count() == 0
