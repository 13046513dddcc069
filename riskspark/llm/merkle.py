"""Operator 11: a Merkle manifest of a dataset by slot pivots.

Each row is a leaf: the SHA-256 (lowercase hex) of its fields, each ``-`` if null, else its UTF-8 byte count, ``:``
and its value. Within a group the leaves ascend by an order column; FANOUT consecutive nodes become the hash of their
concatenated hex digests, the last run may be shorter (even one node), until one node, the subroot, remains. The
subroots by group (null first, bytewise) give the root in the same way.

A level is a slot pivot: conditional aggregates over the children of one parent spread them into FANOUT slot columns;
the concatenated columns hash to the parent, and the columns before and behind a node's own slot are its siblings.
LEVELS levels are taken at once: nodes are dealt by (group, block of FANOUT^LEVELS places), so every pivot inside a
block finds its rows already together, and a group with a third of all rows is spread over its blocks. Blocks' tops
are written and are the nodes of the next round, so rounds are a logarithm of the largest group. Paths are put
together from the top down, by joins with tables that are FANOUT^LEVELS times smaller than the nodes below.

Null group: a group of its own, the first. Null order values come first, equal ones are ordered by leaf; equal
leaves (repeated rows) each keep their own place. Empty table: no rows. Other columns don't matter, except that
columns to be carried along are named by the caller and win over the results' names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskspark.llm.common import materialize, table
from riskspark.llm.positions import crc32_sql, group_key, numbered

FANOUT = 3
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each with its byte count."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def climb(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Nodes (g, pos, n, hash, ...) with ``block``, ``top`` (the block's node ``levels`` levels up, or the group's last
    node where that comes earlier) and ``path``: the siblings left and right of the way there, level by level."""
    out = nodes.withColumn("block", F.expr(f"pos div {fanout**levels}")).repartition("g", "block")
    out = out.withColumn("top", F.col("hash"))
    steps = []
    for level in range(levels):
        w = Window.partitionBy("g", "block", F.expr(f"pos div {fanout ** (level + 1)}"))
        slot = F.expr(f"pos div {fanout**level} % {fanout}")
        slots = [f"_s{level}_{j}" for j in range(fanout)]
        out = out.withColumns({s: F.max(F.when(slot == j, F.col("top"))).over(w) for j, s in enumerate(slots)})
        more = F.col("n") > fanout**level  # more than one node on this level
        side = lambda keep: F.concat_ws("", *[F.when(keep(F.lit(j), slot), F.col(s)) for j, s in enumerate(slots)])  # noqa: B023, E731
        steps.append(f"_p{level}")
        out = out.withColumn(steps[-1], F.when(more, F.struct(side(lambda j, own: j < own).alias("left"), side(lambda j, own: j > own).alias("right"))))
        out = out.withColumn("top", F.when(more, F.sha2(F.concat_ws("", *slots), 256)).otherwise(F.col("top"))).drop(*slots)
    return out.withColumn("path", F.filter(F.array(*steps), lambda s: s.isNotNull())).drop(*steps)


def tree(nodes: DataFrame, name: str, above=None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame | None:
    """Nodes (g, pos, n, hash, ...) of a written table with ``subroot`` and the whole ``path`` to it. ``above`` takes
    the groups' last nodes (g, subroot) and returns them with ``root`` and ``path`` above: then there is ``root``, too,
    and paths lead to it. None for an empty table."""
    most = nodes.agg(F.max("n")).first()[0]
    if most is None:
        return None
    rounds, now = [], nodes
    while not rounds or most > 1:
        up = climb(now, fanout, levels)
        rounds.append(up)
        span = fanout**levels
        now = materialize(up.where(F.col("pos") % span == 0).select(
            "g", F.col("block").alias("pos"), F.expr(f"(n + {span - 1}) div {span}").alias("n"), F.col("top").alias("hash")), name)
        most = -(-most // span)
    tops = now.select("g", F.col("hash").alias("subroot"))
    more = ["subroot"]
    if above is None:
        found = tops.withColumn("path", F.expr(f"cast(array() as {PATH})"))
    else:
        found, more = above(tops), ["subroot", "root"]
    found = found.select("g", F.lit(0).cast("long").alias("block"), *more, F.col("path").alias("_above"))
    for up in reversed(rounds):
        joined = up.join(found, ["g", "block"]).withColumn("path", F.concat("path", "_above")).drop("_above", "top")
        found = joined.select("g", F.col("pos").alias("block"), *more, F.col("path").alias("_above"))
    return joined.drop("block")


def manifest(rows: DataFrame, fields: list[Column], group: Column, order: Column, carry: dict[str, Column] | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row: the columns of ``carry``, ``leaf``, ``subroot``, ``root`` and ``path`` (array of the siblings left and
    right of the way from the leaf to the root)."""
    carry = carry or {}
    leaves = rows.select(group_key(group).alias("g"), order.alias("_order"), digest(fields).alias("hash"), F.struct(F.lit(0), *[c.alias(k) for k, c in carry.items()]).alias("_carry"))
    nodes = numbered(leaves, "g", [F.col("_order"), F.col("hash")], "merkle-leaves")
    nodes = materialize(nodes.drop("_order"), "merkle-nodes")

    def above(tops: DataFrame) -> DataFrame:
        subroots = numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("_source"), F.col("subroot").alias("hash")), "g", [F.col("_source")], "merkle-subroots")
        whole = tree(subroots, "merkle-root", None, fanout, levels)
        return whole.select(F.col("_source").alias("g"), F.col("hash").alias("subroot"), F.col("subroot").alias("root"), "path")

    out = tree(nodes, "merkle-blocks", above, fanout, levels)
    if out is None:
        out = nodes.select("*", F.lit("").alias("subroot"), F.lit("").alias("root"), F.expr(f"cast(array() as {PATH})").alias("path")).limit(0)
    kept = [F.col("_carry").getField(k).alias(k) for k in carry]
    results = {"leaf": F.col("hash"), "subroot": F.col("subroot"), "root": F.col("root"), "path": F.col("path")}
    return out.select(*kept, *[c.alias(k) for k, c in results.items() if k not in carry])


def proof(path: str = "path") -> Column:
    """SHA-256 of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def tampered(doc_id: str = "doc_id") -> Column:
    """Rows that the query tampers with: 2 divides the crc32 of the id in decimal (a null id: never)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256 (untampered), folded_root, verified."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(f) for f in FIELDS]
    cut = F.when(tampered() & F.col("text").contains("\n"), digest([*fields[:-1], F.translate("text", "\n", "")]))
    out = manifest(docs, fields, F.col("source"), F.col("doc_id"), {"doc_id": F.col("doc_id"), "cut": cut})
    out = out.select("doc_id", "leaf", "subroot", "root", proof().alias("proof_sha256"), fold(F.coalesce("cut", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql() -> str:
    part = lambda c: f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(part, [*FIELDS[:-1], text])) + ")"
    climb_sql = lambda name: f"""{name} AS (SELECT g, 0 AS lvl, pos, n, hash FROM {name}_0
            UNION ALL SELECT g, lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
                FROM {name} WHERE n > 1 GROUP BY g, lvl, pos // 3)"""  # noqa: E731
    return f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('+' || source, '') AS g, {leaf('text')} AS leaf,
            CASE WHEN doc_id IS NOT NULL AND {crc32_sql("coalesce(doc_id, 0)::VARCHAR")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS shown
        FROM documents),
    rows_ AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
    low_0 AS (SELECT g, pos, n, leaf AS hash FROM rows_),
    {climb_sql('low')},
    subroots AS (SELECT g AS s, hash AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
    high_0 AS (SELECT 0 AS g, pos, n, subroot AS hash FROM subroots),
    {climb_sql('high')},
    root AS (SELECT hash AS root FROM high WHERE n = 1),
    way AS (SELECT g AS g0, pos AS pos0, g, lvl, pos, n, lvl AS step, false AS top FROM low WHERE lvl = 0
        UNION ALL SELECT w.g0, w.pos0,
            w.g, w.lvl + 1, CASE WHEN w.n > 1 THEN w.pos // 3 ELSE s.pos END, CASE WHEN w.n > 1 THEN (w.n + 2) // 3 ELSE s.n END, w.step + 1, w.top OR w.n = 1
        FROM way w JOIN subroots s ON s.s = w.g WHERE w.n > 1 OR NOT w.top),
    kids AS (SELECT g, lvl, pos // 3 AS parent, max(CASE WHEN pos % 3 = 0 THEN hash END) AS s0, max(CASE WHEN pos % 3 = 1 THEN hash END) AS s1,
            max(CASE WHEN pos % 3 = 2 THEN hash END) AS s2 FROM (SELECT g, lvl, pos, hash, false AS top FROM low) GROUP BY ALL),
    tops AS (SELECT lvl, pos // 3 AS parent, max(CASE WHEN pos % 3 = 0 THEN hash END) AS s0, max(CASE WHEN pos % 3 = 1 THEN hash END) AS s1,
            max(CASE WHEN pos % 3 = 2 THEN hash END) AS s2 FROM high GROUP BY ALL),
    height AS (SELECT g, max(lvl) AS h FROM low GROUP BY g),
    sides AS (SELECT w.g0, w.pos0, w.step, concat(CASE WHEN w.pos % 3 > 0 THEN coalesce(k.s0, t.s0) END, CASE WHEN w.pos % 3 > 1 THEN coalesce(k.s1, t.s1) END) AS l,
            concat(CASE WHEN w.pos % 3 < 1 THEN coalesce(k.s1, t.s1) END, CASE WHEN w.pos % 3 < 2 THEN coalesce(k.s2, t.s2) END) AS r
        FROM way w JOIN height h ON h.g = w.g LEFT JOIN kids k ON NOT w.top AND k.g = w.g AND k.lvl = w.lvl AND k.parent = w.pos // 3
            LEFT JOIN tops t ON w.top AND t.lvl = w.lvl - h.h - 1 AND t.parent = w.pos // 3
        WHERE w.n > 1),
    paths AS (SELECT g0, pos0, list({{'l': l, 'r': r}} ORDER BY step) AS path, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM sides GROUP BY g0, pos0),
    folded AS (SELECT r.*, coalesce(p.proof, sha256('')) AS proof_sha256, list_reduce(list_prepend({{'l': '', 'r': r.shown}}, coalesce(p.path, [])),
            lambda a, b: {{'l': '', 'r': sha256(b.l || a.r || b.r)}}).r AS folded_root
        FROM rows_ r LEFT JOIN paths p ON p.g0 = r.g AND p.pos0 = r.pos)
    SELECT f.doc_id, f.leaf, s.subroot, root.root, f.proof_sha256, f.folded_root, f.folded_root = root.root AS verified
    FROM folded f JOIN subroots s ON s.s = f.g CROSS JOIN root"""


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
SQL = {"op11_merkle_manifest": _sql()}
