"""Boosted trees with second-order gain (M13) and the search of a whole grid in one pass.

Spark's own boosted trees have no L2 leaf term and draw columns per node, and a grid of them is one fit for each
point and fold. Here all models of a grid (one for each point and fold, and one on all rows) grow side by side. Cells of at most HELD
bytes are sent to every task, which grows its share of the models to the end (``_whole``: one Spark job); larger ones stay where they
are and the models' sums are sent, level by level (steps 2 and 4). Both give the same trees, but for the order of additions:

1. features are cut into at most ``max_bins`` bins once (all their values where there are few, quantiles else), rows
   become bytes; rows of the same bins and label are one cell, which keeps the keys and folds of its rows (a row is drawn by its own
   key) and has one margin for each model. Cells are runs of rows sorted by range, so a frequent one is several;
2. each level of each tree is one Spark job for all models: tasks add up gradients and hessians by (model, node,
   feature, bin) over their cells; the sums are shuffled by groups of models, added, and each group's tasks find the best split of
   every node, so only splits reach the driver (a row for each group of models);
3. a model with fewer trees is the beginning of one with more, so numbers of trees are read off at stages of one fit;
4. every CHECKPOINT trees the cells' margins are written, which bounds what a job has to score anew and what a lost
   executor costs.

What is held per cell grows with the number of models (8 bytes each), not with the trees. The trees (models x trees x
2^(depth + 1) nodes) are on the driver where cells stay, and else in a table, of which the models that are asked for are read.

Gradients: p - y and p (1 - p) of the logistic loss, times the positive weight for rows of class 1. A leaf is worth
-G / (H + l2) x rate; a split's gain is GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2) and must be positive, both
children must reach ``min_child`` of H. Rows are drawn per tree by a hash of their key, columns per tree by a hash of
their number: the shares of the grid see the same order. Of gains that are equal to 9 digits the first feature and
lowest cut counts. A missing value (NaN) goes right. Null labels are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from riskspark.session import shuffle_partitions

CHECKPOINT = 4
MESSAGE = 4_000_000  # bytes of sums that one task adds up: models are dealt into so many groups
WORK = 400_000  # cells x models for which a task is worth its start
MOST = 8_000_000  # cells x models of a task, where there are more than the cores take at WORK each: each task sends its own sums
BLOCK = 400_000  # cells x models that a task handles at once
READ = 4_000_000  # cells x models that a task reads at once
PATTERNS = 128  # features that take at most so many values together are added up together
HELD = 128_000_000  # bytes of cells up to which tasks hold them all and the models are dealt out
TRIES = 80_000_000  # cells x models x trees of a task that holds all cells
START = 1_000_000  # cells x models x trees for which such a task is worth its start
RENEW = 20  # trees after which exp(-margin) is worked out anew
NEAR = 65_536  # cells x models that such a task adds up at once: what stays in a core's own memory
TOGETHER = 12  # models whose splits such a task looks for at once, or more where the cells are few
TIE = 1e-9
CELLS = "_x binary, _y int, _keys binary, _folds binary, _m binary"
BUNDLE = "x binary, y binary, rows binary, keys binary, folds binary"
GROWN = "model int, stage int, p double, pos long, neg long, feature binary, cut binary, value binary, cover binary"


@dataclass(frozen=True)
class Point:
    """One point of the grid."""
    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    positive_weight: float = 1.0
    row_share: float = 1.0
    column_share: float = 1.0


def grid(trees=(100, 150, 200), depths=(3, 4, 5), rates=(0.03, 0.05, 0.1), positive_weights=(1.0,), row_shares=(0.8, 1.0),
         column_shares=(0.8, 1.0)) -> list[Point]:
    """The points of all axes. With three positive weights (1, the imbalance and three quarters of it) the defaults are the
    reference's 324 points."""
    return [Point(*p) for p in product(trees, depths, rates, positive_weights, row_shares, column_shares)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def draw(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each key and tree."""
    salt = mix(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    return (mix(keys.astype(np.uint64) ^ salt) >> np.uint64(11)).astype(np.float64) / 2.0**53


def columns_of(tree: int, share: float, features: int, seed: int) -> np.ndarray:
    """Which features a tree may use: the ones of the smallest draws."""
    order = np.argsort(draw(np.arange(features, dtype=np.uint64) + np.uint64(1 << 40), tree, seed), kind="stable")
    used = np.zeros(features, bool)
    used[order[: max(1, int(share * features))]] = True
    return used


def fit_bins(df: DataFrame, features_col: str, max_bins: int = 32) -> list[np.ndarray]:
    """Cut values per feature, rising: a value is in the bin of the first cut that it does not exceed. All distinct values
    where there are at most ``max_bins``, else approximate quantiles; NaN is no cut. A model parameter: at most
    ``max_bins`` numbers for each feature."""
    from pyspark.ml.functions import vector_to_array

    every = df.select(F.posexplode(vector_to_array(F.col(features_col))).alias("f", "v"))
    long = every.where(~F.isnan("v"))
    ends = every.groupBy("f").agg(F.max(F.when(~F.isnan("v"), F.col("v"))).alias("top"), F.max(F.isnan("v")).alias("missing"))
    ranks = [i / max_bins for i in range(1, max_bins)]
    values = long.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    few = values.groupBy("f").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") <= max_bins)
    listed = values.join(few, "f").groupBy("f").agg(F.sort_array(F.collect_list("v")).alias("cuts"))
    quantiles = long.groupBy("f").agg(F.percentile_approx("v", ranks, 10_000).alias("q"))
    rows = ends.join(quantiles, "f", "left").join(listed, "f", "left").select("f", "top", "missing", F.coalesce("cuts", "q", F.array()).alias("cuts")).collect()
    # behind the largest value there are missing ones only
    cuts = {r.f: np.unique(np.array([c for c in r.cuts if r.missing or c < r.top], float)) for r in rows}
    return [cuts.get(i, np.zeros(0)) for i in range(max(cuts, default=-1) + 1)]


@dataclass
class Forest:
    """Trees of all models: node i has children 2i + 1 (value <= cut) and 2i + 2; feature -1 is a leaf."""
    feature: np.ndarray  # models, trees, nodes
    cut: np.ndarray  # number of the cut
    value: np.ndarray  # of leaves, rate included
    cover: np.ndarray  # sum of hessians

    @staticmethod
    def empty(models: int, trees: int, depth: int) -> Forest:
        shape = (models, trees, 2 ** (depth + 1) - 1)
        return Forest(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape), np.zeros(shape))

    def part(self, begin: int, end: int, models: np.ndarray | slice = slice(None)) -> Forest:
        return Forest(*(x[models, begin:end].copy() for x in (self.feature, self.cut, self.value, self.cover)))


def places(forest: Forest, tree: int, x: np.ndarray, levels: int) -> np.ndarray:
    """Place (models, cells) among the nodes of the level after ``levels`` splits of each model's tree (``x``: bins by feature and cell); from a
    leaf above that level cells go left."""
    place = np.zeros((len(forest.feature), x.shape[1]), np.uint8 if levels <= 8 else np.uint32)
    for level in range(levels):
        place = _below(place, forest, tree, x, level)
    return place


def _below(place: np.ndarray, forest: Forest, tree: int, x: np.ndarray, level: int) -> np.ndarray:
    """Places among the nodes below those of ``level``."""
    right = np.zeros(place.shape, bool)
    for k in range(2**level):
        f, c = forest.feature[:, tree, 2**level - 1 + k], forest.cut[:, tree, 2**level - 1 + k].astype(np.uint8)
        own = np.flatnonzero(f >= 0)
        if len(own) == len(f):
            right |= (x[f] > c[:, None]) & (place == k)
        elif len(own):
            right[own] |= (x[f[own]] > c[own, None]) & (place[own] == k)
    return 2 * place + right


def _leaves(forest: Forest, tree: int, depth: int) -> np.ndarray:
    """(models, nodes after ``depth`` splits): what a row that comes there is worth."""
    value = forest.value[:, tree].copy()
    for node in range(2**depth - 1):  # what a leaf is worth, down to the last level
        value[:, 2 * node + 1] = np.where(forest.feature[:, tree, node] >= 0, value[:, 2 * node + 1], value[:, node])
    return value[:, 2**depth - 1:2 ** (depth + 1) - 1]


def add_trees(margins: np.ndarray, forest: Forest, x: np.ndarray, depth: int) -> np.ndarray:
    """Margins (models, cells) after the trees of ``forest``."""
    m, width = len(forest.feature), 2**depth
    for t in range(forest.feature.shape[1]):
        at = places(forest, t, x, depth) + np.arange(m, dtype=np.int64)[:, None] * width
        margins = margins + _leaves(forest, t, depth).reshape(-1)[at]
    return margins


def reached(forest: Forest, level: int) -> np.ndarray:
    """(models, nodes of the level): whether all nodes above split, in the first tree."""
    out = np.ones((len(forest.feature), 1), bool)
    for above in range(level):
        split = forest.feature[:, 0, 2**above - 1:2 ** (above + 1) - 1] >= 0
        out = np.repeat(out & split, 2, axis=1)
    return out


@dataclass(frozen=True)
class Models:
    """What the models are: arrays by model."""
    points: tuple[Point, ...]
    folds: tuple[int, ...]  # the fold that a model does not see; -1: it sees all

    def array(self, name: str) -> np.ndarray:
        return np.array([getattr(p, name) for p in self.points])

    def take(self, own: np.ndarray) -> Models:
        return Models(tuple(self.points[i] for i in own), tuple(self.folds[i] for i in own))


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Cells:
    x: np.ndarray  # bins: features, cells
    y: np.ndarray
    key: np.ndarray  # of the rows
    fold: np.ndarray
    cell: np.ndarray
    margins: np.ndarray  # cells, models

    def counts(self, drawn: np.ndarray) -> np.ndarray:
        return np.bincount(self.cell[drawn], minlength=len(self.y)).astype(float)


def _cells(batches: Iterator[pa.RecordBatch], dim: int, models: int) -> Iterator[Cells]:
    """Blocks of cells; no margins yet: zeros."""
    step = max(1, READ // models)
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            col = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
            n, (keys, ends) = part.num_rows, _binary(col("_keys"))
            margins = np.zeros((n, models)) if col("_m").null_count else _binary(col("_m"))[0].view(np.float64).reshape(n, models)
            yield Cells(np.ascontiguousarray(_binary(col("_x"))[0].reshape(n, dim).T), col("_y").to_numpy().astype(float), keys.view(np.uint64),
                        _binary(col("_folds"))[0].view(np.int32), np.repeat(np.arange(n), np.diff(ends) // 8), margins)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows with the same bins and label."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x, y, key, fold = (batch.column(batch.schema.get_field_index(c)) for c in ("_x", "_y", "_k", "_fold"))
        ids = x.dictionary_encode().indices.to_numpy()
        label, key, fold = y.to_numpy(), key.to_numpy(), fold.to_numpy().astype(np.int32)
        begin = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (label[1:] != label[:-1])])
        end = np.r_[begin[1:], n]
        packed = lambda v: pa.array([v[a:b].tobytes() for a, b in zip(begin, end)], pa.binary())
        yield pa.record_batch([x.take(pa.array(begin)), pa.array(label[begin], pa.int32()), packed(key), packed(fold), pa.nulls(len(begin), pa.binary())],
                              ["_x", "_y", "_keys", "_folds", "_m"])


def _bin(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_features")
            x = np.array(batch.column(at).to_pylist(), float).reshape(batch.num_rows, len(cuts))
            bins = np.empty(x.shape, np.uint8)
            for j, c in enumerate(cuts):
                bins[:, j] = np.searchsorted(c, x[:, j], side="left")  # NaN is behind all
            yield batch.set_column(at, "_x", pa.array([r.tobytes() for r in bins], pa.binary()))
    return run


def _packs(x: np.ndarray, bins: list[int], most: int = PATTERNS) -> list[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Features in packs: number of its pattern for each cell, a cell of each pattern, features."""
    out: list[tuple[np.ndarray, np.ndarray, list[int]]] = []
    code, first, own = np.zeros(x.shape[1], np.int64), np.zeros(1, np.int64), []
    for j, b in enumerate(bins):
        if b < 2:
            continue
        for _ in range(2):
            both = code * b + x[j]
            there = np.flatnonzero(np.bincount(both, minlength=len(first) * b))
            if len(there) <= most or not own:
                break
            out.append((code, first, own))
            code, first, own = np.zeros(x.shape[1], np.int64), np.zeros(1, np.int64), []
        number = np.zeros(len(first) * b, np.int64)
        number[there] = np.arange(len(there))
        code, first, own = number[both], np.zeros(len(there), np.int64), [*own, j]
        first[code] = np.arange(len(code))
    return [*out, (code, first, own)]


def split_sums(cells: Cells, own: np.ndarray, since: Forest, forest: Forest, level: int, depth: int, tree: int, models: Models, bins: list[int], seed: int) -> np.ndarray:
    """Sums (models, nodes of the level, 1 + bins, 2) of gradients and hessians over these cells: the whole, then of each
    feature the bins but the last, which the whole gives. ``own`` are the models' numbers among the margins."""
    width, starts = 2**level, np.cumsum([1, *(b - 1 for b in bins)])
    out = np.zeros((len(own), width, starts[-1], 2))
    number, share, folds = draw(cells.key, tree, seed), models.array("row_share"), np.array(models.folds)
    seen = {(s, f): i for i, (s, f) in enumerate(dict.fromkeys(zip(share.tolist(), folds.tolist())))}
    counts = np.stack([cells.counts((number < s) & (cells.fold != f)) for s, f in seen])
    counted = np.array([seen[k] for k in zip(share.tolist(), folds.tolist())])
    weight, positive, alive = models.array("positive_weight"), cells.y == 1, reached(forest, level)
    packs = []
    for code, first, features in _packs(cells.x, bins):
        places_of = np.concatenate([np.arange(starts[j], starts[j + 1]) for j in features]) if features else np.zeros(0, np.int64)
        has = np.concatenate([cells.x[j, first][:, None] == np.arange(bins[j] - 1)[None, :] for j in features], axis=1) if features else np.zeros((1, 0))
        packs.append((code, len(first), places_of, has.astype(float)))
    step = max(1, BLOCK // max(1, len(cells.y)))
    for i in range(0, len(own), step):
        some = slice(i, min(len(own), i + step))
        m = some.stop - i
        margins = add_trees(np.ascontiguousarray(cells.margins[:, own[some]].T), since.part(0, since.feature.shape[1], some), cells.x, depth)
        p = 1.0 / (1.0 + np.exp(-margins))
        w = np.where(positive[None, :], weight[some, None], 1.0) * counts[counted[some]]
        g, h = (w * (p - cells.y[None, :])).reshape(-1), (w * p * (1.0 - p)).reshape(-1)
        base = places(forest.part(0, 1, some), 0, cells.x, level) + np.arange(m, dtype=np.int64)[:, None] * width
        for n, (code, size, at, has) in enumerate(packs):
            key = (base * size + code[None, :]).reshape(-1)
            for k, v in enumerate((g, h)):
                added = np.bincount(key, v, m * width * size).reshape(m * width, size)
                out[some, :, at, k] = (added @ has).reshape(m, width, len(at))
                if not n:
                    out[some, :, 0, k] = added.sum(axis=1).reshape(m, width)
    out[~alive] = 0.0  # below a leaf
    return out


def all_cuts(bins: Sequence[int]) -> np.ndarray:
    """(2, cuts): feature and number of each cut, feature by feature."""
    return np.concatenate([np.zeros((2, 0), int), *(np.stack([np.full(b - 1, j), np.arange(b - 1)]) for j, b in enumerate(bins))], axis=1)


def best_splits(left: np.ndarray, total: np.ndarray, cuts: np.ndarray, allowed: np.ndarray, l2: float, min_child: float) -> np.ndarray:
    """(models, nodes, 7): feature (-1: none), cut, gain, GL, HL, G, H of the best split of each node. ``left``: gradients and hessians
    (2, models, nodes, cuts) up to each of the ``cuts``; ``total``: those of the nodes; ``allowed`` says by (model, feature) which features
    may be used."""
    out = np.zeros((*total.shape[1:], 7))
    out[..., 0] = -1
    out[..., 5], out[..., 6] = total
    if not cuts.shape[1]:
        return out
    right = total[..., None] - left
    ok = (left[1] >= min_child) & (right[1] >= min_child) & allowed[:, None, cuts[0]]
    gain, other = left[0] ** 2, right[0] ** 2
    gain /= left[1] + l2
    other /= right[1] + l2
    gain += other
    gain -= (total[0] ** 2 / (total[1] + l2))[..., None]
    gain[~ok] = -np.inf
    top = gain.max(axis=2)
    first = (gain >= (top - TIE * np.abs(top))[..., None]).argmax(axis=2)
    better = top > TIE
    m, k = np.nonzero(better)
    at = first[m, k]
    out[m, k, 0], out[m, k, 1], out[m, k, 2], out[m, k, 3], out[m, k, 4] = cuts[0, at], cuts[1, at], top[m, k], left[0, m, k, at], left[1, m, k, at]
    return out


def _level(cuts_n, all_models: int, own: np.ndarray, models: Models, since: Forest, forest: Forest, level: int, depth: int, tree: int, seed: int, groups: list[np.ndarray]):
    """Map side of a level: this task's sums for the models ``own``, one message for each group of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for cells in _cells(batches, len(cuts_n), all_models):
            sums = split_sums(cells, own, since, forest, level, depth, tree, models, cuts_n, seed)
            whole = sums if whole is None else whole + sums
        if whole is not None:
            yield pa.record_batch({"group": pa.array(range(len(groups)), pa.int32()), "data": pa.array([whole[g].tobytes() for g in groups], pa.binary())})
    return run


def _choose(cuts_n, width: int, groups: list[np.ndarray], allowed: np.ndarray, l2: float, min_child: float):
    """Reduce side: adds the messages of each group of models and finds its splits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added: dict[int, np.ndarray] = {}
        for batch in batches:
            for g, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(data.as_buffer(), np.float64)
                added[g] = added[g] + own if g in added else own
        ends = np.cumsum([1, *(b - 1 for b in cuts_n)])
        for g, flat in added.items():
            total, *sums = np.split(np.moveaxis(flat.reshape(len(groups[g]), width, ends[-1], 2), 3, 0), ends[:-1], axis=3)
            left = np.concatenate([np.cumsum(x, axis=3) for x in sums], axis=3)
            yield pa.record_batch({"group": pa.array([g], pa.int32()), "data": pa.array([best_splits(left, total[..., 0], all_cuts(cuts_n), allowed[groups[g]], l2, min_child).tobytes()], pa.binary())})
    return run


def _advance(models: int, dim: int, since: Forest, depth: int):
    """Cells with the margins after the trees of ``since``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, max(1, READ // models)):
                part = batch.slice(i, max(1, READ // models))
                for cells in _cells(iter([part]), dim, models):
                    step = max(1, BLOCK // len(cells.y))
                    new = np.empty(cells.margins.shape)
                    for j in range(0, models, step):
                        some = slice(j, min(models, j + step))
                        new[:, some] = add_trees(np.ascontiguousarray(cells.margins[:, some].T), since.part(0, since.feature.shape[1], some), cells.x, depth).T
                    yield part.set_column(part.schema.get_field_index("_m"), "_m", pa.array([r.tobytes() for r in new], pa.binary()))
    return run


def _enter(now: Forest, best: np.ndarray, level: int, open_: np.ndarray, rate: np.ndarray, l2: float) -> None:
    """Enters a level's splits, and the values that their children have as leaves."""
    width = 2**level
    nodes = np.arange(width) + width - 1
    leaf = lambda g, h: -g / (h + l2) * rate[:, None]
    g_left, h_left, g, h = (best[..., i] for i in (3, 4, 5, 6))
    if level == 0:
        now.value[:, 0, 0], now.cover[:, 0, 0] = np.where(open_, leaf(g, h)[:, 0], 0.0), h[:, 0]
    split = (best[..., 0] >= 0) & open_[:, None]
    now.feature[:, 0, nodes] = np.where(split, best[..., 0], -1)
    now.cut[:, 0, nodes] = np.where(split, best[..., 1], 0)
    for child, cg, ch in ((2 * nodes + 1, g_left, h_left), (2 * nodes + 2, g - g_left, h - h_left)):
        now.value[:, 0, child] = np.where(split, leaf(cg, ch), 0.0)
        now.cover[:, 0, child] = np.where(split, ch, 0.0)


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of bytes for each batch of cells."""
    for batch in batches:
        if batch.num_rows:
            x, y, keys, folds = (batch.column(batch.schema.get_field_index(c)) for c in ("_x", "_y", "_keys", "_folds"))
            (key, ends), number = _binary(keys), lambda v: np.asarray(v).astype(np.int32)
            yield pa.record_batch([pa.array([v.tobytes()], pa.binary()) for v in (_binary(x)[0], number(y), number(np.diff(ends) // 8), key, _binary(folds)[0])],
                                  ["x", "y", "rows", "keys", "folds"])


class Held:
    """All cells of the table, those of equal bins and different labels as one: its rows count by fold and label."""

    def __init__(self, bundles: list[dict[str, bytes]], bins: list[int], folds: Sequence[int]):
        join = lambda name, kind: np.frombuffer(b"".join(b[name] for b in bundles), kind)
        y, rows = join("y", np.int32), join("rows", np.int32)
        x = join("x", np.uint8).reshape(len(y), len(bins))
        first, cell = np.unique(np.ascontiguousarray(x).view(f"V{len(bins)}")[:, 0], return_index=True, return_inverse=True)[1:]
        self.x = np.ascontiguousarray(x[first].T)
        self.labels, label = np.unique(y, return_inverse=True)
        self.key, fold = join("keys", np.uint64), join("folds", np.int32)
        self.folds = sorted(set(folds))
        known = np.searchsorted(self.folds, fold)
        known[~np.isin(fold, self.folds)] = len(self.folds)  # seen by all models
        place = (known * len(self.labels) + np.repeat(label, rows)) * len(first) + np.repeat(cell, rows)
        order = np.argsort(place, kind="stable")
        self.place, self.key = place[order], self.key[order]
        self.all = self.counts(np.ones(len(self.place)))
        self.packs, at = [], np.cumsum([0, *(b - 1 for b in bins)])
        for code, cells, features in _packs(self.x, bins, int(np.clip(len(first) // 32, PATTERNS, 320))):
            column = np.concatenate([np.arange(at[j], at[j + 1]) for j in features]) if features else np.zeros(0, np.int64)
            upto = np.concatenate([self.x[j, cells][:, None] <= np.arange(bins[j] - 1)[None, :] for j in features], axis=1) if features else np.zeros((1, 0))
            self.packs.append((code, len(cells), column, upto.astype(float)))
        self.cuts, self.tiles = all_cuts(bins), {}

    def counts(self, drawn: np.ndarray) -> np.ndarray:
        """Drawn rows by (fold, label, cell); ``drawn``: 1 or 0 for each row."""
        shape = len(self.folds) + 1, len(self.labels), self.x.shape[1]
        return np.bincount(self.place, drawn, shape[0] * shape[1] * shape[2]).reshape(shape)

    def drawn(self, tree: int, share: float, seed: int) -> np.ndarray:
        if share >= 1.0:
            return self.all
        return self.counts(np.concatenate([(draw(self.key[i:i + READ], tree, seed) < share).astype(float) for i in range(0, len(self.key), READ)]))

    def codes(self, models: int) -> list[np.ndarray]:
        """Patterns of the cells by pack, repeated for so many models."""
        if models not in self.tiles:
            self.tiles[models] = [np.tile(code, models) for code, *_ in self.packs]
        return self.tiles[models]

    def sums(self, slots: int, slot: np.ndarray | None, codes: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and hessians of cells by slot, up to each cut (2, slots, cuts) and in all (2, slots); no slot: the only one."""
        left, total = np.empty((2, slots, self.cuts.shape[1])), np.empty((2, slots))
        for n, (code, (_, size, column, upto)) in enumerate(zip(codes, self.packs)):
            key = code if slot is None else slot * size + code
            for k, v in enumerate((g, h)):
                added = np.bincount(key, v, slots * size).reshape(slots, size)
                left[k][:, column] = added @ upto
                if not n:
                    total[k] = added.sum(axis=1)
        return left, total

    def grow(self, odds: np.ndarray, weights: list[np.ndarray], seen: list[np.ndarray], allowed: np.ndarray, depth: int, rate: np.ndarray, l2: float, min_child: float) -> tuple[Forest, np.ndarray, np.ndarray]:
        """A tree for each row of ``odds``, the odds against class 1 (models, cells) so far; the values of the nodes where cells end (models,
        nodes), and the node of each cell. By model: ``weights`` of a row and of its label by label, and counts (label, cell) of ``seen`` rows.
        Sums are added up for the lighter child of each split; the other child has the rest."""
        m, n = odds.shape
        step = max(1, NEAR // n)
        blocks = [slice(i, min(m, i + step)) for i in range(0, m, step)]
        g, h = np.empty((m, n)), np.empty((m, n))
        now, place = Forest.empty(m, 1, depth), np.zeros((m, n), np.uint8 if depth <= 8 else np.uint32)
        left, total = np.empty((2, m, 1, self.cuts.shape[1])), np.empty((2, m, 1))
        for block in blocks:
            for j in range(block.start, block.stop):
                whole, labels = weights[j] @ seen[j]
                p = 1.0 / (1.0 + odds[j])
                np.multiply(whole, p, out=g[j])
                np.multiply(g[j], 1.0 - p, out=h[j])
                g[j] -= labels
            k = block.stop - block.start
            left[:, block, 0], total[:, block, 0] = self.sums(k, np.repeat(np.arange(k), n) if k > 1 else None, self.codes(k), g[block].reshape(-1), h[block].reshape(-1))
        for level in range(depth):
            width = 2**level
            best = best_splits(left, total, self.cuts, allowed, l2, min_child)
            _enter(now, best, level, np.ones(m, bool), rate, l2)
            split = best[..., 0] >= 0
            if not split.any():
                break
            place = _below(place, now, 0, self.x, level)
            if level + 1 == depth:
                level = depth
                break
            right = 2 * best[..., 4] > best[..., 6]  # the right child is the lighter one
            light = np.stack([split & ~right, split & right], axis=2).reshape(m, -1)
            less, part = np.empty(left.shape), np.empty(total.shape)
            for block in blocks:
                k = block.stop - block.start
                at = (place[block] + np.arange(k)[:, None] * (2 * width) if k > 1 else place[block]).reshape(-1)
                own = np.flatnonzero(light[block].reshape(-1).take(at))
                sums = self.sums(k * width, (at.take(own) >> 1).astype(np.int64), [c.take(own) for c in self.codes(k)], g[block].reshape(-1).take(own), h[block].reshape(-1).take(own))
                less[:, block], part[:, block] = (x.reshape(2, k, width, *x.shape[2:]) for x in sums)
            rest = np.where(split[..., None], left - less, 0.0), np.where(split, total - part, 0.0)
            left, total = (np.stack([np.where(r, b, a), np.where(r, a, b)], axis=3).reshape(2, m, 2 * width, *a.shape[3:])
                           for r, a, b in ((right[..., None], less, rest[0]), (right, part, rest[1])))
        return now, _leaves(now, 0, level), place


def _whole(models: Models, ends: np.ndarray, stages: list[int], bins: list[int], groups: list[np.ndarray], l2: float, min_child: float, seed: int):
    """Grows the models of a group over all cells, which each group gets: their trees, and at each stage the distinct probabilities
    of the rows that a model has not seen, with numbers of rows of class 1 and others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                cells.setdefault(r.pop("group"), []).append(r)
        todo = sorted(cells)
        held = Held(cells[todo[0]], bins, models.folds) if todo else None  # the same cells for each group
        cells.clear()
        for group in todo:
            yield from grow(held, groups[group])

    def grow(held: Held, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = own[np.lexsort((ends[own], models.array("depth")[own], models.array("row_share")[own]))]  # models that grow together are side by side
        mine, n, dim = models.take(own), held.x.shape[1], len(bins)
        deep, rate, weight, share, columns = (mine.array(x) for x in ("depth", "rate", "positive_weight", "row_share", "column_share"))
        fold, last, depth, step = np.searchsorted(held.folds, mine.folds), ends[own], max(p.depth for p in models.points), max(TOGETHER, NEAR // n)
        weights = np.where(held.labels[None, :] == 1, weight[:, None], 1.0)
        weights = np.stack([weights, weights * held.labels], axis=1)
        forest, margins, odds = Forest.empty(len(own), stages[-1], depth), np.zeros((len(own), n)), np.ones((len(own), n))
        for tree in range(stages[-1]):
            allowed = {c: columns_of(tree, c, dim, seed) for c in set(columns.tolist())}
            for s in set(share[last > tree].tolist()):
                drawn = held.drawn(tree, s, seed)
                whole = drawn.sum(axis=0)
                seen = {f: whole - drawn[f] for f in set(fold.tolist())}
                for d in set(deep[(share == s) & (last > tree)].tolist()):
                    alike = np.flatnonzero((share == s) & (deep == d) & (last > tree))
                    for i in range(alike[0], alike[-1] + 1, step):
                        some = slice(i, min(alike[-1] + 1, i + step))
                        now, value, place = held.grow(odds[some], weights[some], [seen[f] for f in fold[some]], np.stack([allowed[c] for c in columns[some].tolist()]), d, rate[some], l2, min_child)
                        anew, factor = tree % RENEW == RENEW - 1 or np.abs(value).max() > 30.0, np.exp(-value)
                        for j in range(some.start, some.stop):
                            margins[j] += value[j - i].take(place[j - i])
                            if anew:  # exp(-margin) by its factors drifts, and may be too large
                                np.exp(-margins[j], out=odds[j])
                            else:
                                odds[j] *= factor[j - i].take(place[j - i])
                        for of, by in ((forest.feature, now.feature), (forest.cut, now.cut), (forest.value, now.value), (forest.cover, now.cover)):
                            of[some, tree, :by.shape[2]] = by[:, 0]
            if tree + 1 in stages:
                for j, f in enumerate(mine.folds):
                    left_out = held.all[fold[j]]
                    at = np.flatnonzero(left_out.sum(axis=0))
                    p, place = np.unique(1.0 / (1.0 + np.exp(-margins[j, at])), return_inverse=True)
                    pos, neg = (np.bincount(place, left_out[k].sum(axis=0)[at], len(p)).astype(np.int64) for k in (held.labels == 1, held.labels != 1))
                    if len(p):
                        yield _row(len(p), model=own[j], stage=tree + 1, p=p, pos=pos, neg=neg)
        for j, i in enumerate(own):
            yield _row(1, model=i, stage=0, **{k: [getattr(forest, k)[j].tobytes()] for k in ("feature", "cut", "value", "cover")})

    def _row(n: int, **columns) -> pa.RecordBatch:
        kinds = {"model": pa.int32(), "stage": pa.int32(), "p": pa.float64(), "pos": pa.int64(), "neg": pa.int64()}
        return pa.record_batch({k: pa.nulls(n, kinds.get(k, pa.binary())) if k not in columns else pa.array(np.full(n, columns[k]) if np.isscalar(columns[k]) else columns[k], kinds.get(k, pa.binary()))
                                for k in (c.split()[0] for c in GROWN.split(", "))})
    return run


def _held_out(models: Models, dim: int, config: np.ndarray):
    """Per config and fold: the distinct probabilities by the model that has not seen the fold's rows, with numbers of rows of
    class 1 and others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds = np.array(models.folds)
        for cells in _cells(batches, dim, len(folds)):
            positive = cells.y == 1
            for f in set(folds.tolist()):
                n = cells.counts(cells.fold == f)
                at = np.flatnonzero(n)
                own = np.flatnonzero(folds == f) if len(at) else []
                found = [np.unique(1.0 / (1.0 + np.exp(-cells.margins[at, m])), return_inverse=True) for m in own]
                if found:
                    size = [len(p) for p, _ in found]
                    pos, neg = (np.concatenate([np.bincount(place, n[at] * c[at], len(p)) for p, place in found]).astype(np.int64) for c in (positive, ~positive))
                    yield pa.record_batch([pa.array(np.repeat(config[own], size), pa.int32()), pa.array(np.full(sum(size), f), pa.int32()),
                                           pa.array(np.concatenate([p for p, _ in found])), pa.array(pos), pa.array(neg)], ["config", "_fold", "p", "pos", "neg"])
    return run


def _out_of_fold(forest: Forest, folds: np.ndarray, dim: int, depth: int, keep: list[str]):
    """Per row: kept columns and the probability by the model of its fold (of one point's models)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _binary(batch.column(batch.schema.get_field_index("_x")))[0].reshape(batch.num_rows, dim)
                margins = add_trees(np.zeros((len(folds), len(x))), forest, np.ascontiguousarray(x.T), depth)
                model, row = np.nonzero(folds[:, None] == batch.column(batch.schema.get_field_index("_fold")).to_numpy()[None, :])
                yield pa.record_batch([*batch.select(keep).take(pa.array(row)).columns, pa.array(1.0 / (1.0 + np.exp(-margins[model, row])))], [*keep, "p_oof"])
    return run


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a folder that this module wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Boosting:
    """All models of a grid over one table of training rows."""

    def __init__(self, df: DataFrame, features_col: str, label: str, key_cols: Sequence[str], fold_col: str | None = None, keep: Sequence[str] = (),
                 max_bins: int = 32, l2: float = 1.0, min_child: float = 1.0, seed: int = 42):
        import uuid

        from pyspark.ml.functions import vector_to_array

        from riskspark.session import ship_package
        from riskspark.sources.io import scratch_path

        if not 2 <= max_bins <= 255:
            raise ValueError("max_bins is 2 to 255")
        self.spark, self.label, self.l2, self.min_child, self.seed = df.sparkSession, label, l2, min_child, seed
        ship_package(self.spark)
        self.root = scratch_path(self.spark, f"boosting-{uuid.uuid4().hex}")
        df = df.where(F.col(label).isNotNull())
        self.keep = list(dict.fromkeys([*key_cols, *keep]))
        self.cuts = fit_bins(df, features_col, max_bins)
        self.bins = [len(c) + 1 for c in self.cuts]
        fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-2)) if fold_col else F.lit(0)  # without a fold: seen by all models
        own = df.select(*self.keep, F.col(label).cast("int").alias("_y"), fold.alias("_fold"), F.xxhash64(*key_cols).alias("_k"),
                        vector_to_array(F.col(features_col)).alias("_features"))
        self.schema = StructType([StructField("_x", BinaryType()) if f.name == "_features" else f for f in own.schema.fields])
        start = self._write(own.mapInArrow(_bin(self.cuts), self.schema), "start", self.schema)
        self.rows, last = start.agg(F.count(F.lit(1)), F.max("_fold")).first()
        self.folds = (last or 0) + 1 if fold_col else 0
        runs = start.select("_x", "_y", "_k", "_fold").repartitionByRange(shuffle_partitions(self.spark), "_x", "_y", "_k").sortWithinPartitions("_x", "_y", "_k")
        self.cells = self._write(runs.mapInArrow(_pack, CELLS), "cells").count()

    def _write(self, df: DataFrame, name: str, schema: StructType | str = CELLS) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self._read(name, schema)

    def _read(self, name: str, schema: StructType | str = CELLS) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def fit(self, points: Sequence[Point], whole: bool = True) -> GridFit:
        """Grows every point's models: one for each fold, and with ``whole`` one on all rows."""
        configs = list(dict.fromkeys(replace(p, trees=0) for p in points))
        stages = sorted({p.trees for p in points})
        folds = [*range(self.folds), *([-1] if whole or not self.folds else [])]
        models = Models(tuple(c for c in configs for _ in folds), tuple(f for _ in configs for f in folds))
        last = {c: max(p.trees for p in points if replace(p, trees=0) == c) for c in configs}
        ends = np.array([last[c] for c in models.points])
        if self.bins and self.cells and 12 * self.rows + (len(self.bins) + 8) * self.cells <= HELD:
            self._grow_whole(models, ends, stages)
            return GridFit(self, list(points), configs, models, None, stages)
        return GridFit(self, list(points), configs, models, self._grow_levels(models, ends, stages), stages)

    def _grow_whole(self, models: Models, ends: np.ndarray, stages: list[int]) -> None:
        """Every task holds all cells and grows some models to the end; models of one row share are together."""
        n, share = len(models.folds), models.array("row_share")
        work, cores = self.cells * n * stages[-1], self.spark.sparkContext.defaultParallelism
        tasks = min(n, max(-(-work // TRIES), min(3 * cores, -(-work // START))))
        groups = []
        for s in sorted(set(share.tolist())):
            own = np.flatnonzero(share == s)
            parts = max(1, round(tasks * len(own) / n))
            groups += [own[i::parts] for i in range(min(parts, len(own)))]  # dealt in turn: each has all depths
        bundles = self._read("cells").mapInArrow(_bundle, BUNDLE)
        # the cells have at most HELD bytes
        dealt = self.spark.range(0, len(groups), 1, len(groups)).select(F.col("id").cast("int").alias("group")).crossJoin(F.broadcast(bundles))
        self._write(dealt.mapInArrow(_whole(models, ends, stages, self.bins, groups, self.l2, self.min_child, self.seed), GROWN), "grown", GROWN)

    def _grow_levels(self, models: Models, ends: np.ndarray, stages: list[int]) -> Forest:
        """Cells stay in their tasks, sums are sent level by level; margins are written at each stage."""
        n, depth, dim = len(models.folds), max(c.depth for c in models.points), len(self.bins)
        forest = Forest.empty(n, stages[-1], depth)
        deep, rate = models.array("depth"), models.array("rate")
        # a cell's work is that of all models: cells are spread by it, to at most as many tasks as shuffles have
        work, cores = self.cells * n, self.spark.sparkContext.defaultParallelism
        tasks = max(1, min(shuffle_partitions(self.spark), -(-work // WORK), max(cores, -(-work // MOST))))
        state, at, name = self._read("cells").repartitionByRange(tasks, "_x", "_y").persist(), 0, "start"
        for tree in range(stages[-1]):
            now = forest.part(tree, tree + 1)
            shares = {s: columns_of(tree, s, dim, self.seed) for s in set(models.array("column_share").tolist())}
            allowed = np.stack([shares[s] for s in models.array("column_share").tolist()])
            for level in range(depth):
                own = np.flatnonzero((deep > level) & (ends > tree))
                if not len(own) or (level and not (now.feature[own, 0, 2 ** (level - 1) - 1:2**level - 1] >= 0).any()):
                    break
                groups = np.array_split(np.arange(len(own)), min(len(own), -(-16 * len(own) * 2**level * sum(self.bins) // MESSAGE)))
                sums = state.mapInArrow(_level(self.bins, n, own, models.take(own), forest.part(at, tree, own), now.part(0, 1, own), level, depth, tree, self.seed, groups), "group int, data binary")
                found = sums.repartition(len(groups), "group").mapInArrow(_choose(self.bins, 2**level, groups, allowed[own], self.l2, self.min_child), "group int, data binary")
                best = np.zeros((n, 2**level, 7))
                best[..., 0] = -1
                for r in found.collect():  # one row for each group of models
                    best[own[groups[r.group]]] = np.frombuffer(r.data, np.float64).reshape(-1, 2**level, 7)
                _enter(now, best, level, np.isin(np.arange(n), own), rate, self.l2)
            forest.feature[:, tree], forest.cut[:, tree], forest.value[:, tree], forest.cover[:, tree] = (x[:, 0] for x in (now.feature, now.cut, now.value, now.cover))
            if (tree + 1) % CHECKPOINT == 0 or tree + 1 in stages:
                after = self._write(state.mapInArrow(_advance(n, dim, forest.part(at, tree + 1), depth), CELLS), f"after-{tree + 1}")
                state.unpersist()
                if name != "start" and int(name.split("-")[1]) not in stages:
                    drop_path(self.spark, f"{self.root}/{name}")
                state, at, name = after.persist(), tree + 1, f"after-{tree + 1}"
        state.unpersist()
        return forest


@dataclass
class GridFit:
    """What Boosting.fit returns."""
    boosting: Boosting
    points: list[Point]
    configs: list[Point]
    models: Models
    forest: Forest | None  # None: in the table "grown"
    stages: list[int]

    def trees_of(self, own: Sequence[int], trees: int) -> Forest:
        """The first trees of these models."""
        if self.forest is not None:
            return self.forest.part(0, trees, np.array(own, int))
        if not len(own):
            return Forest.empty(0, trees, max(c.depth for c in self.configs))
        rows = self.boosting._read("grown", GROWN).where(F.col("stage") == 0).where(F.col("model").isin([int(i) for i in own]))
        found = {r.model: r for r in rows.select("model", "feature", "cut", "value", "cover").collect()}  # a row for each of these models
        kinds = {"feature": np.int16, "cut": np.int16, "value": float, "cover": float}
        return Forest(*(np.stack([np.frombuffer(found[i][k], kind).reshape(self.stages[-1], -1)[:trees] for i in own]) for k, kind in kinds.items()))

    def held_out(self, stage: int) -> DataFrame:
        """Config, fold, probabilities of the fold's rows by the config's model that has not seen them, and numbers of rows of
        class 1 and others; a probability may come more than once."""
        b = self.boosting
        config = np.array([self.configs.index(p) for p in self.models.points])
        if self.forest is None:
            numbers = F.array(*map(F.lit, config.tolist())), F.array(*map(F.lit, self.models.folds))
            return b._read("grown", GROWN).where(F.col("stage") == stage).select(*(F.get(x, F.col("model")).alias(c) for x, c in zip(numbers, ("config", "_fold"))), "p", "pos", "neg")
        return b._read(f"after-{stage}").mapInArrow(_held_out(self.models, len(b.bins), config), "config int, _fold int, p double, pos long, neg long")

    def scores(self) -> DataFrame:
        """One row for each point: its number and axes, roc_auc by fold, mean_auc and rank (first point on ties)."""
        from pyspark.sql import Window

        from riskspark.operators.evaluate import roc_auc_of_counts

        spark = self.boosting.spark
        parts = [self.held_out(s).withColumn("trees", F.lit(s)) for s in self.stages]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        auc = roc_auc_of_counts(rows, "p", "pos", "neg", by=["trees", "config", "_fold"])
        by_point = auc.groupBy("trees", "config").agg(F.sort_array(F.collect_list(F.struct(F.col("_fold").alias("fold"), "roc_auc"))).alias("folds"), F.avg("roc_auc").alias("mean_auc"))
        axes = [(i, self.configs.index(replace(p, trees=0)), *asdict(p).values()) for i, p in enumerate(self.points)]
        names = spark.createDataFrame(axes, "point int, config int, trees int, depth int, rate double, positive_weight double, row_share double, column_share double")
        # one row a point: the grid is a parameter
        return names.join(by_point, ["trees", "config"]).drop("config").withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_auc"), "point")))

    def best(self) -> Point:
        """The point of the highest mean ROC-AUC over the folds."""
        return self.points[self.scores().where("rank = 1").first().point]

    def out_of_fold(self, point: Point) -> DataFrame:
        """Key columns, label and ``p_oof`` of every row by the model of its fold."""
        b = self.boosting
        own = np.array([i for i, (p, f) in enumerate(zip(self.models.points, self.models.folds)) if p == replace(point, trees=0) and f >= 0], int)
        rows = b._read("start", b.schema)
        keep = list(dict.fromkeys([*b.keep, "_y"]))
        schema = StructType([rows.schema[c] for c in keep] + StructType.fromDDL("p_oof double").fields)
        scored = rows.mapInArrow(_out_of_fold(self.trees_of(own.tolist(), point.trees), np.array(self.models.folds)[own], len(b.bins), max(c.depth for c in self.configs), keep), schema)
        return scored.select(*b.keep, *([F.col("_y").alias(b.label)] if b.label not in b.keep else []), "p_oof")

    def model(self, point: Point, fold: int = -1) -> BoostedTrees:
        """The point's model on all rows, or the one that has not seen ``fold``."""
        i = next(i for i, (p, f) in enumerate(zip(self.models.points, self.models.folds)) if p == replace(point, trees=0) and f == fold)
        trees, own = [], self.trees_of([i], point.trees)
        for t in range(point.trees):
            feature, cut, value, cover = (x[0, t] for x in (own.feature, own.cut, own.value, own.cover))
            threshold = [float(self.boosting.cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(feature.tolist(), cut.tolist())]
            trees.append({"feature": feature.astype(int), "threshold": np.array(threshold), "value": value, "cover": cover})
        return BoostedTrees(trees, point)

    def close(self) -> None:
        """Removes the written rows; scores and out-of-fold frames can't be read after it."""
        drop_path(self.boosting.spark, self.boosting.root)


@dataclass
class BoostedTrees:
    """One fitted model: complete binary trees in arrays (children of i: 2i + 1 for value <= threshold, 2i + 2)."""
    trees: list[dict]
    point: Point

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, row = np.zeros(len(x)), np.arange(len(x))
        for t in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = t["feature"][node]
                if (f < 0).all():
                    break
                right = ~(x[row, np.maximum(f, 0)] <= t["threshold"][node])
                node = np.where(f >= 0, 2 * node + 1 + right, node)
            total += t["value"][node]
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``features``) with ``probability`` (vector) and ``prediction`` (0.5 and above is 1), as Spark's models add."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        from riskspark.session import ship_package

        ship_package(df.sparkSession)

        @F.pandas_udf("double")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(1.0 / (1.0 + np.exp(-self.margins(np.vstack(x.to_numpy()).astype(float))))) if len(x) else pd.Series([], dtype=float)

        p = df.withColumn("_p", probability(vector_to_array(F.col("features"))))
        return p.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), "_p"))).withColumn("prediction", (F.col("_p") >= 0.5).cast("double")).drop("_p")

    def rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, value, cover) of the nodes that a row can reach."""
        out = []
        for t, tree in enumerate(self.trees):
            todo = [0]
            while todo:
                i = todo.pop()
                f = int(tree["feature"][i])
                out.append((t, i, f, float(tree["threshold"][i]), float(tree["value"][i]), float(tree["cover"][i])))
                todo += [2 * i + 1, 2 * i + 2] if f >= 0 else []
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """IO8: the nodes as a table, the point as one row."""
        spark.createDataFrame(self.rows(), "tree int, node int, feature int, threshold double, value double, cover double").coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([tuple(asdict(self.point).values())], "trees int, depth int, rate double, positive_weight double, row_share double, column_share double").coalesce(1).write.mode("overwrite").parquet(f"{path}/point")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        point = Point(**spark.read.parquet(f"{path}/point").first().asDict())
        size = 2 ** (point.depth + 1) - 1
        trees = [{"feature": np.full(size, -1), "threshold": np.zeros(size), "value": np.zeros(size), "cover": np.zeros(size)} for _ in range(point.trees)]
        for r in spark.read.parquet(f"{path}/nodes").collect():  # bounded by trees x 2^(depth + 1)
            for name in ("feature", "threshold", "value", "cover"):
                trees[r.tree][name][r.node] = r[name]
        return BoostedTrees(trees, point)
