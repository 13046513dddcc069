"""Operator 7: n-gram Jaccard join by a MinHash LSH forest, with exact verification.

Each text is the set of its runs of five words (a shorter text with words is one shingle). Texts with the
same word sequence are one *node*, so copies are handled once. Every node has a key of ``DEEPEST`` minhashes in each of
``TREES`` trees. In a tree the sorted keys are a trie; its branches of depth d are the runs of keys that share their first
d minhashes. Matches start at the whole key and the prefix is shortened, level by level, until both hold:

* the expected recall at the threshold, 1 - (1 - threshold^d)^TREES, reaches the target (so that no data can lower it), and
* the recall measured on the sample reaches it: the texts of at most ``SAMPLE_TEXTS`` documents with an id divisible by 50 are
  compared exactly with every text of the table while the keys are made, and each pair found tells the longest prefix
  that it shares in some tree. ``recall_by_depth`` returns this table.

Every node is then linked to the least node of its branch in each tree (stars, never pairs; only the least of a branch
is needed, so Spark groups by the prefix and does not sort the keys). Connected components of the
stars are the places where links can be. Inside a component all nodes are compared exactly, in blocks of
``BLOCK`` nodes: a large component is split over a task for each pair of its blocks, and tasks return counts
of links and a spanning forest, not pairs. Components of the verified links are the classes.

Only documents that meet another in some tree ship their text. They are picked by a bitmap of bounded size
(a false hit costs a row, never a result) and then by the join itself.

Null and empty texts have no shingle and no links; they are copies of each other. Rows with a null doc_id
take part like any other; the id of a class is its least doc_id (null if it has none). A table without near copies of
the sample's texts is searched at the depth of the expected recall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import bitmap, in_bitmap, materialize, mix, ragged, rolling, slices, table, with_column, word_hashes, word_ids
from riskspark.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
TREES = 16
DEEPEST = 8
RECALL = 0.998
BLOCK = 256
SAMPLE_TEXTS = 256
SAMPLE_CHARS = 2_000_000
MARK_BITS = 22


def expected_recall(depth: int, threshold: float = THRESHOLD, trees: int = TREES) -> float:
    """Chance that a pair with a similarity of ``threshold`` shares a prefix of ``depth`` minhashes in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def stop_depth(shared: dict[int, int], threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix whose expected and measured recall reach the target. ``shared``: pairs of the sample by the
    longest prefix that they share in some tree."""
    for depth in range(DEEPEST, 0, -1):
        found = sum(n for d, n in shared.items() if d >= depth)
        if expected_recall(depth, threshold, trees) >= recall and found >= recall * sum(shared.values()):
            return depth
    if expected_recall(1, threshold, trees) < recall:
        raise ValueError(f"{trees} trees cannot reach a recall of {recall} at {threshold}")
    return 1


def shingles(texts: list[str], n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all shingles, how many each text has, hash of each text's word sequence)."""
    vocab, ids, offsets = word_ids(texts)
    h = word_hashes(vocab)[ids]
    lens = np.diff(offsets)
    local = np.arange(len(ids)) - np.repeat(offsets[:-1], lens)
    rest = np.repeat(lens, lens) - local
    counts = np.where(lens >= n, lens - n + 1, np.minimum(lens, 1))
    out = np.empty(int(counts.sum()), np.uint64)
    starts = np.cumsum(counts) - counts
    full = np.flatnonzero(rest >= n)
    if len(full):
        out[starts[np.searchsorted(offsets, full, side="right") - 1] + local[full]] = rolling(h, n)[full]
    key = np.empty(len(texts), np.uint64)
    place = mix(h + mix(local.astype(np.uint64) + np.uint64(1)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(place, dtype=np.uint64)])
    key = mix(total[offsets[1:]] - total[offsets[:-1]] + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for i in np.flatnonzero((lens > 0) & (lens < n)).tolist():
        out[starts[i]] = key[i]
    return out, counts, key


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n multipliers (odd) and offsets of the minhash family, by a rule, so the same everywhere."""
    seed = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seed[:n] | np.uint64(1), seed[n:]


def forest_keys(hashes: np.ndarray, counts: np.ndarray, trees: int) -> np.ndarray:
    """Keys of texts with shingles: 16 bits of each of DEEPEST minhashes in each tree, (texts, trees, DEEPEST).
    Texts that agree by chance in 16 bits are candidates that verification drops."""
    starts = np.cumsum(counts) - counts
    a, b = _family(trees * DEEPEST)
    out = np.empty((len(counts), trees * DEEPEST), np.uint16)
    for i in range(trees * DEEPEST):
        out[:, i] = mix(np.minimum.reduceat(hashes * a[i] + b[i], starts)) & np.uint64(0xFFFF)
    return out.reshape(-1, trees, DEEPEST)


@dataclass
class Sample:
    """The texts on which recall is measured: which of them hold each shingle, their sizes, keys and nodes."""

    vocab: np.ndarray  # sorted distinct shingles
    first: np.ndarray  # where the texts of each begin in ``query``
    query: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray
    nodes: np.ndarray

    @classmethod
    def of(cls, texts: list[str], trees: int) -> Sample:
        hashes, counts, nodes = shingles([t for t in texts if t and t.encode().split()])
        sets = [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])] if len(counts) else []
        sizes = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate(sets) if sets else hashes
        order = np.argsort(flat, kind="stable")
        vocab, first = np.unique(flat[order], return_index=True)
        keys = forest_keys(hashes, counts, trees) if sets else np.zeros((0, trees, DEEPEST), np.uint16)
        return cls(vocab, np.append(first, len(flat)), np.repeat(np.arange(len(sets)), sizes)[order], sizes, keys, nodes)

    def marks(self) -> np.ndarray:
        """Marks of the low bits of the sample's shingles, so that most others are passed over without a search."""
        out = np.zeros(1 << MARK_BITS, bool)
        out[self.vocab & np.uint64(out.size - 1)] = True
        return out

    def met(self, marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash is a shingle of the sample."""
        out = marks[hashes & np.uint64(len(marks) - 1)]
        at = np.flatnonzero(out)
        if len(at):
            out[at] = self.vocab[np.minimum(np.searchsorted(self.vocab, hashes[at]), len(self.vocab) - 1)] == hashes[at]
        return out

    def shared(self, own: np.ndarray, key: np.ndarray, node: np.uint64, threshold: float) -> list[int]:
        """For each sample text with another word sequence and a similarity of ``threshold`` or more to the text with the
        distinct shingles ``own``: the longest prefix that both keys share in some tree."""
        place = np.minimum(np.searchsorted(self.vocab, own), len(self.vocab) - 1)
        met = place[self.vocab[place] == own]
        if len(met) < threshold * len(own) - 1e-9:
            return []
        queries = self.query[ragged(self.first[met], self.first[met + 1] - self.first[met])]
        both = np.bincount(queries, minlength=len(self.sizes))
        near = np.flatnonzero((both >= threshold * (len(own) + self.sizes - both) - 1e-9) & (self.nodes != node))
        return [int(np.cumprod(self.keys[q] == key, axis=1).sum(axis=1).max()) for q in near]


def query_texts(docs: DataFrame, most: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> list[str]:
    """One text of each of at most ``most`` documents with an id divisible by 50, in order of a hash of the id, as far as
    they hold at most ``chars`` characters together: the bound of what the sample puts on the driver and in each task."""
    ids = docs.filter(F.col("doc_id") % 50 == 0).groupBy("doc_id").agg(F.max(F.length("text")).alias("n")).filter("n > 0")
    rows = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    fits = np.cumsum([r.n for r in rows], dtype=np.int64) <= chars
    picked = [r.doc_id for r, ok in zip(rows, fits) if ok]
    if not picked:
        return []
    return [r.text for r in docs.filter(F.col("doc_id").isin(picked)).groupBy("doc_id").agg(F.min("text").alias("text")).collect()]


def _sign(trees: int, threshold: float, shared):
    """doc_id, node, keys (null: no shingle), near (shared prefixes with near texts of the sample)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = shared.value
        marks = sample.marks()
        for rows, texts in slices(batches):
            hashes, counts, node = shingles(texts)
            some = np.flatnonzero(counts > 0)
            keys, near = [None] * len(texts), [[] for _ in texts]
            if len(some):
                key = forest_keys(hashes, counts[some], trees)
                starts = np.cumsum(counts[some]) - counts[some]
                hit = np.logical_or.reduceat(sample.met(marks, hashes), starts)
                for n, i in enumerate(some.tolist()):
                    keys[i] = key[n].astype(">u2").tobytes()
                    if hit[n]:
                        near[i] = sample.shared(np.unique(hashes[starts[n]:starts[n] + counts[i]]), key[n], node[i], threshold)
            yield pa.record_batch({"doc_id": rows.column("doc_id").combine_chunks(), "node": node.view(np.int64),
                                   "keys": pa.array(keys, pa.binary()), "near": pa.array(near, pa.list_(pa.int32()))})
    return run


def signatures(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """(doc_id and node of each row; least, copies, keys, near of each node), written tables."""
    own = docs.select("doc_id", "text")
    sample = docs.sparkSession.sparkContext.broadcast(Sample.of(query_texts(own), trees))
    kind = "doc_id long, node long, keys binary, near array<int>"
    signed = materialize(own.mapInArrow(_sign(trees, threshold, sample), kind), "signatures")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
                                       F.max("keys").alias("keys"), F.max("near").alias("near"))
    return signed.select("doc_id", "node"), materialize(nodes, "nodes")


def _shared(nodes: DataFrame) -> dict[int, int]:
    """Pairs of a text and a near one of the sample, by the longest prefix that they share: at most DEEPEST + 1 numbers."""
    return {r.depth: r["count"] for r in nodes.select(F.explode("near").alias("depth")).groupBy("depth").count().collect()}


def recall_by_depth(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """Per depth: pairs of the sample, those found at that depth, the measured recall (null without pairs), the expected
    one at the threshold, and whether the search stops there."""
    shared = _shared(signatures(docs, threshold, trees)[1])
    stop, pairs = stop_depth(shared, threshold, trees, recall), sum(shared.values())
    found = {d: sum(n for x, n in shared.items() if x >= d) for d in range(1, DEEPEST + 1)}
    return docs.sparkSession.createDataFrame(
        [(d, pairs, n, n / pairs if pairs else None, expected_recall(d, threshold, trees), d == stop) for d, n in found.items()],
        "depth int, pairs long, found long, measured double, expected double, stop boolean")


def branches(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """(node, label): the branch of ``depth`` minhashes that a node is in, for each tree."""
    label = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(t, F.substring("keys", t * (2 * DEEPEST) + 1, F.lit(2 * depth))))
    return nodes.filter("keys IS NOT NULL").select("node", F.explode(label).alias("label"))


def _with_node(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            yield from rows.append_column(name, pa.array(shingles(texts)[2].view(np.int64))).combine_chunks().to_batches()
    return run


def _compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, its partners j) by exact Jaccard similarity; each pair once. ``same``: left and right are one block."""
    sizes = np.array([len(s) for s in sets])
    vocab, local = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    right_ids = np.concatenate([local[bounds[j]:bounds[j + 1]] for j in right])
    right_starts = np.cumsum(sizes[right]) - sizes[right]
    mark = np.zeros(len(vocab), np.int32)
    for n, i in enumerate(left.tolist()):
        own = local[bounds[i]:bounds[i + 1]]
        mark[own] = 1
        first = n + 1 if same else 0
        if first < len(right):
            skip = right_starts[first]
            both = np.add.reduceat(mark[right_ids[skip:]], right_starts[first:] - skip)
            others = right[first:]
            hit = both >= threshold * (sizes[i] + sizes[others] - both) - 1e-9
            if hit.any():
                yield i, others[hit]
        mark[own] = 0


def _verify(threshold: float):
    def block(rows: list[tuple]) -> pa.RecordBatch:
        """Rows of one pair of blocks: (group, node, copies, side, text)."""
        nodes = np.array([r[1] for r in rows], np.int64)
        copies = np.array([r[2] for r in rows], np.int64)
        side = np.array([r[3] for r in rows])
        hashes, counts, _ = shingles([r[4] for r in rows])
        sets = [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        links, linked, root = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        if len(left) and len(right):
            for i, js in _compare(sets, left, right, not side.any(), threshold):
                links[i] += len(js)
                links[js] += 1
                linked[i] += copies[js].sum()
                linked[js] += copies[i]
                for j in js.tolist():
                    a, b = find(i), find(j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
        some = np.flatnonzero(links)
        return pa.record_batch({"node": nodes[some], "links": links[some], "linked": linked[some],
                                "root": nodes[[find(x) for x in some.tolist()]].astype(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)
    return run


def similar_texts(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per document row: doc_id, node (its text), class_id (least doc_id among the texts that links lead to),
    n_links (other texts with a similarity of ``threshold`` or more), n_linked_docs (documents with an equal or
    linked text, itself not counted), kept (the one document of its class that stays). Reads doc_id and text."""
    own = docs.select("doc_id", "text")
    signed, nodes = signatures(own, threshold, trees)
    label = branches(nodes, trees, stop_depth(_shared(nodes), threshold, trees, recall))
    stars = label.groupBy("label").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = components(label.join(stars, "label").select(F.col("node").alias("u"), "v"))
    members = near.join(nodes.drop("keys", "near"), "node")
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    members = materialize(members.join(sizes, "label"), "members")
    # a row for each pair of blocks that a node's block takes part in: side 0 where both are one block
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = members.withColumn("b", F.pmod(F.xxhash64("node", "label"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select("least", "node", "copies", F.xxhash64("label", F.least("b", "other"), F.greatest("b", "other")).alias("pair"),
                           F.when(F.col("b") == F.col("other"), 0).when(F.col("b") < F.col("other"), 1).otherwise(2).alias("side"))
    picked = own.filter(in_bitmap(F.xxhash64("doc_id"), bitmap(members.select(F.xxhash64("least").alias("h")), "h")))
    picked = picked.mapInArrow(_with_node("node"), with_column(own, "node", "long"))
    texts = picked.join(members.select("node", "least"), (picked.doc_id.eqNullSafe(members.least)) & (picked.node == members.node), "left_semi")
    texts = materialize(texts.dropDuplicates(["node"]).select("node", "text"), "texts")
    work = (placed.join(texts, "node").select("pair", "node", "copies", "side", "text")
            .repartitionByRange("pair").sortWithinPartitions("pair"))  # ranges of equal size, a pair of blocks in one of them
    checked = materialize(work.mapInArrow(_verify(threshold), "node long, links long, linked long, root long"), "links")
    classes = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    found = checked.groupBy("node").agg(F.sum("links").alias("links"), F.sum("linked").alias("linked"))
    whole = nodes.select("node", "least", "copies").join(classes, "node", "left").join(found, "node", "left").select(
        "node", "least", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("n_links"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_linked_docs"))
    whole = materialize(whole, "classes")
    heads = whole.groupBy("label").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("head"))
    whole = whole.join(heads, "label").select("node", F.col("head.least").alias("class_id"), F.col("head.node").alias("head"), "n_links", "n_linked_docs")
    return signed.join(whole, "node").select(
        "doc_id", "node", "class_id", "n_links", "n_linked_docs",
        ((F.col("node") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id (repeated rows leave one)."""
    kept = similar_texts(docs, **options).filter("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).distinct()
    named = docs.drop("_node").mapInArrow(_with_node("_node"), with_column(docs.drop("_node"), "_node", "long"))
    return named.join(kept, named.doc_id.eqNullSafe(kept._id) & (named._node == kept._node), "left_semi").dropDuplicates(["doc_id", "_node"]).select(docs.columns)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, class_id, n_links, n_linked_docs, kept; word 5-shingles, similarity 0.8 or more."""
    return similar_texts(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_linked_docs", "kept")


QUERIES = {"op7_jaccard_join": op7_jaccard_join}

SQL = {"op7_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
                  [x FOR x IN string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+') IF x <> ''] AS ws FROM documents),
nodes AS (SELECT ws, min(doc_id) AS least, count(*) AS copies, row_number() OVER () AS node FROM d GROUP BY ws),
shingle AS (SELECT DISTINCT node, array_to_string(ws[i:i + 4], ' ') AS s
            FROM (SELECT node, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM nodes WHERE len(ws) > 0)),
size AS (SELECT node, count(*) AS n FROM shingle GROUP BY node),
both_ AS (SELECT a.node AS a, b.node AS b, count(*) AS m FROM shingle a JOIN shingle b ON a.s = b.s AND a.node < b.node GROUP BY 1, 2),
pair AS (SELECT a, b FROM both_ JOIN size x ON x.node = a JOIN size y ON y.node = b WHERE m >= 0.8 * (x.n + y.n - m) - 1e-9),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT a AS node, min(least) AS class_id FROM reach JOIN nodes ON nodes.node = b GROUP BY a),
links AS (SELECT a AS node, count(*) AS n, sum(copies) AS docs FROM link JOIN nodes ON nodes.node = b GROUP BY a)
SELECT doc_id, class_id, coalesce(links.n, 0)::BIGINT AS n_links, (coalesce(links.docs, 0) + copies - 1)::BIGINT AS n_linked_docs, doc_id = class_id AS kept
FROM d JOIN nodes ON d.ws = nodes.ws JOIN class USING (node) LEFT JOIN links USING (node)"""}
