"""Operator 13: conversation structure repair by weighted interval parsing.

A conversation's rows, by turn, become the cheapest sequence of role initials of the form ``(s?(ua)+)?``. Edits: K keeps a row
(cost 0), R gives it the role user or assistant (1), D deletes it (2), I inserts a user or assistant row with empty
text anywhere (5). Blank rows and repeats must go; a truncated row that stays costs 5 more. Of equal costs the audit
(the edits' initials in order) that is least in ASCII counts.

The grammar in Chomsky normal form has a symbol X[p,q] for each pair of places in the form (START, SYSTEM, USER,
ASSISTANT: what stands last): X[p,q] -> X[p,r] X[r,q], and X[p,q] -> row for what a row may become between p and q.
A cell holds the least (cost, audit) of a symbol over a span of rows; the closure under insertions is part of the cell of a
single row (insertions before it) and of the end. Spans are combined bottom-up by length 1, 2, 4, ...: the symbols are pairs of
places, so every split of a span gives the same least cell, and the middle one is taken. Equal costs within a cell
never have one audit as the beginning of another (the rows' letters are the same number, and further insertions cost), so the least
audit of a whole is made of least audits of its parts.

Rows are dealt by ranges of (conversation, turn) and numbered; cells are combined within blocks of BLOCK rows, then of
BLOCK blocks, and so on, in rounds of one shuffle each, so that a conversation with a third of all rows is
spread over its blocks. The parse's rows are small (role initial, fault); the letters of the audit are then joined
with the rows by place.

Null conv_id is a conversation of its own. Null turns come first; rows of one turn are ordered by role, then SHA-256 of the text. Null
roles and texts are one space. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import materialize, table
from riskspark.llm.positions import crc32_sql, group_key, numbered

BLOCK = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Places in the form: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
# (from, to, role initial) of one row or insertion
STEPS = ((START, SYSTEM, "s"), (START, USER, "u"), (SYSTEM, USER, "u"), (USER, ASSISTANT, "a"), (ASSISTANT, USER, "u"))
Cell = dict[tuple[int, int], tuple[int, str]]
GONE = ("blank", "duplicate")


def combine(left: Cell, right: Cell) -> Cell:
    """The cells of a span from those of its two parts."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(r, 4) if r < USER else (USER, ASSISTANT):
            more = right.get((r, q))
            if more is not None:
                new = (cost + more[0], audit + more[1])
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def insertions() -> Cell:
    """Cells of an empty span: any number of insertions (never s; more than two in a row lead nowhere new)."""
    empty: Cell = {(p, p): (0, "") for p in range(4)}
    one = empty | {(p, q): (INSERT, "I") for p, q, role in STEPS if role != "s"}
    return combine(one, one)


CLOSURE = insertions()
_ROWS: dict[tuple[str, str], Cell] = {}


def row_cells(initial: str, fault: str) -> Cell:
    """Cells of one row with the insertions before it."""
    key = (initial if initial in ("s", "u", "a") else "", fault)
    if key not in _ROWS:
        cells: Cell = {(p, p): (DELETE, "D") for p in range(4)}
        if fault not in GONE:
            more = TRUNCATED if fault == "truncated" else 0
            for p, q, role in STEPS:
                ways = [(KEEP + more, "K")] if role == key[0] else []
                ways += [(REROLE + more, "R")] if role != "s" else []
                if ways:
                    cells[p, q] = min(ways)
        _ROWS[key] = combine(CLOSURE, cells)
    return _ROWS[key]


def parse(spans: list[Cell]) -> Cell:
    """Combines neighbouring spans, then those of twice the length, until one is left."""
    while len(spans) > 1:
        spans = [combine(spans[i], spans[i + 1]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def finished(cells: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation: from the start to nothing, or to an assistant's row."""
    ends = combine(cells, CLOSURE)
    return min(ends[START, q] for q in (START, ASSISTANT) if (START, q) in ends)


# -- Spark ------------------------------------------------------------------------------------------------------

# cells as two arrays, by p * 4 + q; a cost of -1: no such cell
SPAN = "g string, pos long, first string, last string, illegal long, costs array<long>, audits array<string>"
LEGAL = ("su", "ua", "au")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows (g, block, ...), sorted, as one list for each (g, block)."""
    key, own = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:2] != key:
                if own:
                    yield key, own
                key, own = row[:2], []
            own.append(row[2:])
    if own:
        yield key, own


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]
    names = ["g", "pos", "first", "last", "illegal", "costs", "audits"]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def _span(key: tuple, cells: list[Cell], firsts: list[str], lasts: list[str], illegal: int) -> tuple:
    whole = parse(cells)
    illegal += sum(a + b not in LEGAL for a, b in zip(lasts, firsts[1:]))
    flat = [whole.get((p, q), (-1, "")) for p in range(4) for q in range(4)]
    return (*key, firsts[0], lasts[-1], illegal, [c for c, _ in flat], [a for _, a in flat])


def _flush(spans: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for s in spans:
        held.append(s)
        size += 200 + sum(map(len, s[-1]))
        if size > 4_000_000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _parse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _flush(_span(key, [row_cells(i, f) for i, f in own], [i for i, _ in own], [i for i, _ in own], 0) for key, own in _runs(batches))


def _parse_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def cells(costs, audits):
        return {(i // 4, i % 4): (c, a) for i, (c, a) in enumerate(zip(costs, audits)) if c >= 0}

    yield from _flush(_span(key, [cells(c, a) for *_, c, a in own], [r[0] for r in own], [r[1] for r in own], sum(r[2] for r in own)) for key, own in _runs(batches))


def _blocks(rows: DataFrame, columns: list[str], block: int) -> DataFrame:
    """(g, block, columns) dealt by block and sorted by place."""
    own = rows.select("g", F.expr(f"pos div {block}").alias("block"), "pos", *columns)
    return own.repartition("g", "block").sortWithinPartitions("g", "block", "pos").drop("pos")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = [finished({(i // 4, i % 4): (c, a) for i, (c, a) in enumerate(zip(costs, audits)) if c >= 0})
                for costs, audits in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.record_batch({"g": batch.column(0), "illegal": batch.column(1), "cost": pa.array([c for c, _ in ends], pa.int64()), "audit": pa.array([a for _, a in ends], pa.string())})


def faults(rows: DataFrame) -> DataFrame:
    """Numbered rows (g, pos, role, text, ...) with ``fault``: blank, duplicate (role and text of an earlier row of the
    conversation), truncated, or an empty text. Earlier rows are found by place, one for each (role, text), so that a
    row repeated many times is one row of the join."""
    same = rows.groupBy(F.col("g"), F.sha2(F.concat_ws("\x00", F.octet_length("role").cast("string"), "role", "text"), 256)).agg(F.min("pos").alias("pos"))
    marked = rows.join(same.select("g", "pos", F.lit(True).alias("_new")), ["g", "pos"], "left")
    solid = r"[^\x20\x09-\x0D]"
    end = F.regexp_extract("text", rf"({solid})[\x20\x09-\x0D]*+\z", 1)
    return marked.withColumn("fault", F.when(~F.col("text").rlike(solid), "blank").when(F.col("_new").isNull(), "duplicate")
                             .when(~end.isin(".", "!", "?"), "truncated").otherwise("")).drop("_new")


def plan(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(g, illegal, cost, audit) of each conversation of numbered rows (g, pos, n, role, fault)."""
    initial = F.substring("role", 1, 1).alias("initial")
    spans = materialize(_blocks(rows.select("*", initial), ["initial", "fault"], block).mapInArrow(_parse_rows, SPAN), "conversation-spans")
    left = -(-(rows.agg(F.max("n")).first()[0] or 0) // block)  # blocks of the longest conversation
    while left > 1:
        spans = materialize(_blocks(spans, ["first", "last", "illegal", "costs", "audits"], block).mapInArrow(_parse_spans, SPAN), "conversation-spans")
        left = -(-left // block)
    return spans.select("g", "illegal", "costs", "audits").mapInArrow(_finish, "g string, illegal long, cost long, audit string")


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per edit of each audit: the row's place (null: inserted), the edit, the place in the result, the role given."""
    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        gs, audits, pos, place, system = zip(*held)
        audits, pos, place = np.concatenate(audits), np.concatenate(pos), np.concatenate(place)
        sizes = [len(p) for _, p, *_ in held]
        odd = (place - np.repeat(system, sizes)) % 2
        whole = pa.record_batch({
            "g": pa.array(gs, pa.string()).take(pa.array(np.repeat(np.arange(len(gs)), sizes))), "pos": pa.array(pos, pa.int64(), mask=audits == ord("I")),
            "edit": pa.array(list(audits.tobytes().decode()), pa.string()), "place": pa.array(place, pa.int64()),
            "_role": pa.array(["user", "assistant"]).take(pa.array(odd))})
        for i in range(0, len(audits), 50_000):
            yield whole.slice(i, 50_000)

    held, size = [], 0
    for batch in batches:
        for g, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(audit.encode(), np.uint8)
            stays = own != ord("D")
            # (ua)+ is even, so an odd result begins with s
            held.append((g, own, np.cumsum(own != ord("I")) - 1, np.cumsum(stays) - 1, int(stays.sum()) % 2))
            size += len(own)
            if size > 50_000:
                yield from flush(held)
                held, size = [], 0
    if held:
        yield from flush(held)


def repair(conversations: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(report, repaired) of conversations (conv_id, turn, role, text).

    report: conv_id, gaps (turns missing between the least and the largest), blank, duplicate, truncated, illegal
    (neighbouring role initials other than su, ua, au), cost, audit. repaired: conv_id, place, role, text, edit, turn (null: inserted)."""
    own = conversations.select(group_key(F.col("conv_id")).alias("g"), "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = numbered(own, "g", [F.col("turn"), F.col("role"), F.sha2("text", 256)], "conversation-rows")
    rows = materialize(faults(rows), "conversation-faults")
    audits = materialize(plan(rows, block), "conversation-audits")
    turns = rows.groupBy("g", "turn").agg(F.first("conv_id").alias("conv_id"), *[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])
    counts = turns.groupBy("g").agg(
        F.first("conv_id").alias("conv_id"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    report = counts.join(audits, "g").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    letters = audits.select("g", "audit").mapInArrow(_letters, "g string, pos long, edit string, place long, _role string").where("edit != 'D'")
    kept = rows.join(letters.where("pos is not null"), ["g", "pos"]).select("g", "conv_id", "place", F.when(F.col("edit") == "R", F.col("_role")).otherwise(F.col("role")).alias("role"), "text", "edit", "turn")
    names = counts.select("g", "conv_id")
    new = letters.where("pos is null").join(names, "g").select("g", "conv_id", "place", F.col("_role").alias("role"), F.lit("").alias("text"), "edit", F.lit(None).cast("long").alias("turn"))
    return report, kept.unionByName(new).drop("g")


def _sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the parts of each key, which come sorted one after the other."""
    key, state = None, None
    for batch in batches:
        done = []
        for g, part, lines in zip(*[c.to_pylist() for c in batch.columns]):
            if g != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = g, hashlib.sha256()
            state.update((("\n" if part else "") + lines).encode())
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done]), pa.array([d[1] for d in done])], ["g", "sha"])
    if state is not None:
        yield pa.record_batch([pa.array([key], pa.string()), pa.array([state.hexdigest()], pa.string())], ["g", "sha"])


def digests(repaired: DataFrame, block: int = BLOCK) -> DataFrame:
    """(g, sha) of each conversation's ``role:text`` lines. Lines are joined in blocks first; a digest can only be made from
    front to back, so one task reads the blocks of a conversation, holding one batch at a time."""
    lines = repaired.select(group_key(F.col("conv_id")).alias("g"), F.expr(f"place div {block}").alias("part"), "place", F.concat_ws(":", "role", "text").alias("line"))
    parts = lines.groupBy("g", "part").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    return parts.repartition("g").sortWithinPartitions("g", "part").select("g", "part", "lines").mapInArrow(_sha, "g string, sha string")


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that the crc32 of ``conv_id:turn`` chooses; nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("_c"))
    own = own.where("_c != 0").select(
        "conv_id", "turn", F.when(F.col("_c") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_c") == 1, "").when(F.col("_c") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return own.drop("_copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per original conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of the damaged rows."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair(damage(conversations))
    names = conversations.groupBy(group_key(F.col("conv_id")).alias("g")).agg(F.first("conv_id").alias("conv_id"))
    out = names.join(report.withColumn("g", group_key(F.col("conv_id"))).drop("conv_id"), "g", "left").join(digests(repaired), "g", "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _sql() -> str:
    states = "SUAE"  # columns of the walk: after s, u, a, and E for nothing yet
    lit = lambda cost, letter: f"{{'c': {cost}, 'a': '{letter}'}}"

    def plus(state: str, cost: str, letters: str) -> str:
        return f"CASE WHEN {state} IS NULL THEN NULL ELSE {{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}'}} END"

    def least(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"

    shut = lambda s, u, a, e: {  # noqa: E731 - with insertions
        "s": s, "e": e, "u": least(u, plus(a, "5", "I"), plus(s, "5", "I"), plus(e, "5", "I")),
        "a": least(a, plus(u, "5", "I"), plus(s, "10", "II"), plus(e, "10", "II"))}
    more = "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)"

    def become(role: str, *before: str) -> list[str]:
        out = []
        for b in before:
            out.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = '{role}' THEN {plus(b, more, 'K')} END")
            if role != "s":
                out.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN {plus(b, '1 + ' + more, 'R')} END")
        return out

    before = shut("s", "u", "a", "e")
    step = {"s": least(plus("s0", "2", "D"), *become("s", "e0")), "u": least(plus("u0", "2", "D"), *become("u", "e0", "s0", "a0")),
            "a": least(plus("a0", "2", "D"), *become("a", "u0")), "e": plus("e0", "2", "D")}
    ends = shut("s", "u", "a", "e")
    cell = "STRUCT(c BIGINT, a VARCHAR)"
    solid = r"[^\x20\x09-\x0D]"
    return rf"""
    WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS c FROM conversations),
    damaged AS (SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN c = 1 THEN '' WHEN c = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN c = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM given WHERE c != 0),
    placed AS (SELECT *, coalesce('+' || conv_id, '') AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM damaged),
    judged AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '{solid}') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY pos) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
            lag(substr(role, 1, 1)) OVER (PARTITION BY g ORDER BY pos) AS prev FROM placed),
    walk AS (SELECT g, 0::BIGINT AS pos, NULL::{cell} AS s, NULL::{cell} AS u, NULL::{cell} AS a, {lit(0, '')}::{cell} AS e FROM (SELECT DISTINCT g FROM judged)
        UNION ALL SELECT g, pos, {step['s']}, {step['u']}, {step['a']}, {step['e']}
        FROM (SELECT j.g, j.pos, j.initial, j.fault, {before['s']} AS s0, {before['u']} AS u0, {before['a']} AS a0, {before['e']} AS e0 FROM walk w JOIN judged j ON j.g = w.g AND j.pos = w.pos + 1)),
    best AS (SELECT g, {least('e', ends['a'])} AS w FROM walk QUALIFY row_number() OVER (PARTITION BY g ORDER BY pos DESC) = 1),
    letters AS (SELECT g, unnest(string_split(w.a, '')) AS edit, generate_subscripts(string_split(w.a, ''), 1) AS i FROM best WHERE w.a != ''),
    lined AS (SELECT *, count(*) FILTER (edit != 'I') OVER (PARTITION BY g ORDER BY i) AS pos, count(*) FILTER (edit != 'D') OVER (PARTITION BY g ORDER BY i) AS place,
            count(*) FILTER (edit != 'D') OVER (PARTITION BY g) % 2 AS system FROM letters),
    lines AS (SELECT l.g, l.place, CASE WHEN edit = 'K' THEN j.role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE j.text END AS line
        FROM lined l LEFT JOIN judged j ON j.g = l.g AND j.pos = l.pos WHERE edit != 'D'),
    hashed AS (SELECT g, sha256(string_agg(line, chr(10) ORDER BY place)) AS sha FROM lines GROUP BY g),
    counted AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (prev IS NOT NULL AND prev || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY g)
    SELECT n.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.w.c, 0)::BIGINT AS cost, coalesce(b.w.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce('+' || conv_id, '') AS g FROM conversations) n LEFT JOIN counted USING (g) LEFT JOIN best b USING (g) LEFT JOIN hashed USING (g)"""


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
SQL = {"op13_conversation_repair": _sql()}
