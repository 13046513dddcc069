"""The grid of boosted trees against a plain numpy version."""

from dataclasses import astuple

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from riskspark.operators import boosting as B


def make(n, seed, dims=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, dims)), 1)
    x[:, 1] = rng.integers(0, 2, n)
    x[:, 2] = x[:, 0]  # a copy: equal gains
    x[rng.random(n) < 0.05, 3] = np.nan
    y = (x[:, 0] + 0.8 * x[:, 1] + rng.normal(size=n) > 0.7).astype(int)
    return x, y


def table(spark, x, y, folds=3):
    rows = [(i, Vectors.dense(v), int(c), i % folds, "z") for i, (v, c) in enumerate(zip(x, y))]
    rows.append((len(rows), Vectors.dense(x[0]), None, 0, "z"))  # no label: left out
    return spark.createDataFrame(rows, ["k", "features", "label", "fold", "extra"]).repartition(4)


def plain(x, y, keys, point, cuts, l2=1.0, min_child=1.0, seed=42, masks=None):
    """One model, node by node."""
    margin, trees = np.zeros(len(x)), []
    w = np.where(y == 1, point.positive_weight, 1.0)
    for t in range(point.trees):
        used = np.flatnonzero(B.columns_of(t, point.column_share, x.shape[1], seed))
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        drawn = (B.draw(keys, t, seed) < point.row_share) & (masks if masks is not None else True)
        tree = {}

        def grow(node, own, depth):
            G, H = g[own & drawn].sum(), h[own & drawn].sum()
            best = (0.0, None)
            if depth < point.depth:
                for f in used:
                    for c in cuts[f]:
                        left = x[:, f] <= c
                        gl, hl = g[own & drawn & left].sum(), h[own & drawn & left].sum()
                        gr, hr = G - gl, H - hl
                        if hl >= min_child and hr >= min_child:
                            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - G**2 / (H + l2)
                            if gain > max(best[0] * (1 + 1e-9), 1e-9):
                                best = (gain, (f, c))
            if best[1] is None:
                tree[node] = (-1, 0.0, -G / (H + l2) * point.rate, H)
                margin[own] += tree[node][2]
                return
            f, c = best[1]
            tree[node] = (f, c, best[0], H)
            left = x[:, f] <= c
            grow(2 * node + 1, own & left, depth + 1)
            grow(2 * node + 2, own & ~left, depth + 1)

        grow(0, np.ones(len(x), bool), 0)
        trees.append(tree)
    return margin, trees


def keys_of(spark, n):
    return np.array([r[0] for r in spark.range(n).selectExpr("xxhash64(id)", "id").orderBy("id").collect()], np.int64).view(np.uint64)


POINTS = [B.Point(12, 3, 0.3, 1.0, 1.0, 1.0), B.Point(7, 3, 0.3, 1.0, 1.0, 1.0), B.Point(12, 2, 0.1, 2.5, 0.8, 0.6)]


def test_all_models_equal_plain_ones(spark, monkeypatch):
    """500 rows: splits, leaf values and covers of each model equal those of a plain version, whatever the other models."""
    monkeypatch.setattr(B, "CHECKPOINT", 5)
    x, y = make(500, 1)
    boost = B.Boosting(table(spark, x, y), "features", "label", ["k"], "fold", max_bins=64)
    fit = boost.fit(POINTS)
    keys, fold = keys_of(spark, 500), np.arange(500) % 3
    for point in POINTS:
        for f in (-1, 1):
            margin, trees = plain(x, y, keys, point, boost.cuts, masks=fold != f)
            model = fit.model(point, f)
            rows = {(t, i): (feature, thr, value, cover) for t, i, feature, thr, value, cover in model.rows()}
            assert len(rows) == sum(map(len, trees))
            for t, tree in enumerate(trees):
                for i, (feature, c, value, cover) in tree.items():
                    got = rows[t, i]
                    assert got[0] == feature and abs(got[3] - cover) < 1e-9
                    assert got[1] == c if feature >= 0 else abs(got[2] - value) < 1e-9
            assert np.allclose(model.margins(x), margin, atol=1e-9)
    # stages: 7 trees are the first of 12; out-of-fold probabilities are those of the fold's own models
    for point in POINTS:
        oof = {r.k: r.p_oof for r in fit.out_of_fold(point).collect()}
        assert len(oof) == 500
        for f in range(3):
            m = fit.model(point, f).margins(x)
            assert all(abs(oof[i] - 1 / (1 + np.exp(-m[i]))) < 1e-9 for i in range(f, 500, 3))
    fit.close()


def test_scores_and_best_point_equal_separate_fits(spark):
    x, y = make(300, 5)
    points = [B.Point(4, 2, 0.3), B.Point(2, 2, 0.3), B.Point(4, 2, 0.1, 2.5, 0.8, 0.6)]
    df = table(spark, x, y)
    boost = B.Boosting(df, "features", "label", ["k"], "fold")
    fit = boost.fit(points, whole=False)
    rows = fit.scores().orderBy("point").collect()
    fold = np.arange(300) % 3
    for r, point in zip(rows, points):
        aucs = []
        for f in range(3):
            own = B.Boosting(df, "features", "label", ["k"], "fold").fit([point], whole=False)
            m = own.model(point, f).margins(x)[fold == f]
            own.close()
            pos, neg = m[y[fold == f] == 1], m[y[fold == f] == 0]
            p = lambda v: 1 / (1 + np.exp(-v))
            aucs.append(np.mean([(p(a) > p(b)) + 0.5 * (p(a) == p(b)) for a in pos for b in neg]))
        assert np.allclose([f.roc_auc for f in r.folds], aucs) and abs(r.mean_auc - np.mean(aucs)) < 1e-12
    best = max(range(3), key=lambda i: (rows[i].mean_auc, -i))
    assert fit.best() == points[best] and rows[best]["rank"] == 1
    fit.close()


def test_model_scores_and_round_trip(spark, tmp_path):
    x, y = make(200, 9)
    df = table(spark, x, y)
    boost = B.Boosting(df, "features", "label", ["k"])
    fit = boost.fit([B.Point(5, 3)])
    model = fit.model(B.Point(5, 3))
    fit.close()
    model.save(spark, str(tmp_path / "m"))
    back = B.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert back.point == model.point and sorted(back.rows()) == sorted(model.rows())
    got = {r.k: r for r in back.transform(df).collect()}
    assert len(got) == 201
    for i in range(200):
        p = 1 / (1 + np.exp(-model.margins(x[i:i + 1])[0]))
        assert abs(got[i].probability[1] - p) < 1e-12 and got[i].prediction == float(p >= 0.5)


def test_grid_and_bounds(spark):
    assert len(B.grid(positive_weights=(1.0, 3.0, 2.25))) == 324
    x, y = make(50, 2)
    with pytest.raises(ValueError):
        B.Boosting(table(spark, x, y), "features", "label", ["k"], max_bins=256)
    # one class, one row: no split, the root's value alone
    one = spark.createDataFrame([(1, Vectors.dense([1.0]), 1)], ["k", "features", "label"])
    fit = B.Boosting(one, "features", "label", ["k"]).fit([B.Point(2, 3)])
    assert [r[:3] for r in fit.model(B.Point(2, 3)).rows()] == [(0, 0, -1), (1, 0, -1)]
    fit.close()


def test_equal_rows_are_one_cell(spark, monkeypatch):
    """40 different rows, 600 times in all: work goes by cell, and draws, folds, splits and probabilities are those of the single rows."""
    monkeypatch.setattr(B, "CHECKPOINT", 3)
    x, y = make(40, 3)
    pick = np.r_[np.arange(40), np.zeros(200, int), np.random.default_rng(1).integers(0, 40, 360)]  # one of them frequent
    x, y = x[pick], y[pick]
    rows = [(i, Vectors.dense(v), int(c), None if i % 50 == 49 else i % 3) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["k", "features", "label", "fold"])
    boost = B.Boosting(df.repartition(5), "features", "label", ["k"], "fold")
    assert boost.rows == 600 and boost.cells < 60
    fit = boost.fit(POINTS)
    keys, fold = keys_of(spark, 600), np.array([-2 if r[3] is None else r[3] for r in rows])
    for point in POINTS:
        for f in (-1, 0, 2):
            margin, trees = plain(x, y, keys, point, boost.cuts, masks=fold != f)
            model = fit.model(point, f)
            assert len(model.rows()) == sum(map(len, trees)) and np.allclose(model.margins(x), margin, atol=1e-9)
    scores = {r.point: {f.fold: f.roc_auc for f in r.folds} for r in fit.scores().collect()}
    for i, point in enumerate(POINTS):
        oof = {r.k: r.p_oof for r in fit.out_of_fold(point).collect()}
        assert sorted(oof) == [i for i in range(600) if fold[i] >= 0]  # a row without a fold trains all models
        for f in range(3):
            p = np.array([oof[k] for k in np.flatnonzero(fold == f)])
            pos, neg = p[y[fold == f] == 1], p[y[fold == f] == 0]
            assert abs(scores[i][f] - ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())) < 1e-9
    fit.close()


def test_dealt_models_equal_dealt_cells(spark, monkeypatch):
    """Models grown in tasks that hold all cells are those of sums sent level by level: nodes, scores, ranks, out-of-fold probabilities."""
    monkeypatch.setattr(B, "START", 1)  # many tasks
    monkeypatch.setattr(B, "RENEW", 3)
    x, y = make(240, 11)
    x[100:], y[100:] = x[:140], y[:140]  # equal rows, some of them with both labels
    y[120:130] = 1 - y[120:130]
    rows = [(i, Vectors.dense(v), None if i % 40 == 39 else int(c), None if i % 30 == 29 else i % 3) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["k", "features", "label", "fold"]).repartition(5)
    points = [p for share in (0.7, 1.0) for rate in (0.1, 0.6) for p in (B.Point(7, 3, rate, 0.4, share, 0.6), B.Point(3, 3, rate, 0.4, share, 0.6), B.Point(5, 1, rate, 2.5, share))]
    found = []
    for most in (B.HELD, 0):
        monkeypatch.setattr(B, "HELD", most)
        fit = B.Boosting(df, "features", "label", ["k"], "fold").fit(points)
        assert (fit.forest is None) == (most > 0)
        scores = [(r.point, r["rank"], r.mean_auc, [tuple(f) for f in r.folds]) for r in fit.scores().orderBy("point").collect()]
        oof = [sorted((r.k, r.label, r.p_oof) for r in fit.out_of_fold(p).collect()) for p in points[:3]]
        held = [sorted(map(tuple, fit.held_out(s).groupBy("config", "_fold").sum("pos", "neg").collect())) for s in fit.stages]
        found.append((scores, oof, held, [fit.model(p, f).rows() for p in points for f in (-1, 0, 1, 2)]))
        fit.close()
    (scores, oof, held, trees), (scores_, oof_, held_, trees_) = found
    assert held == held_ and [s[:2] for s in scores] == [s[:2] for s in scores_]
    assert all(np.allclose([a[2], *np.ravel(a[3])], [b[2], *np.ravel(b[3])], atol=1e-12) for a, b in zip(scores, scores_))
    assert all(len(a) == len(b) and np.allclose(a, b, atol=1e-9) for a, b in zip([*oof, *trees], [*oof_, *trees_]))


def test_queries_search_the_whole_grid(spark, monkeypatch):
    """grid_search_gbt and grid_search_facts: every point of the reference's grid, with all its trees, on 5 folds."""
    from itertools import product

    from riskspark.plans import ml_queries as Q
    x, y = make(60, 4)
    tr = spark.createDataFrame([(i, Vectors.dense(v), int(c)) for i, (v, c) in enumerate(zip(x, y))], ["doc_id", "features", Q.LABEL])
    seen = []
    monkeypatch.setattr(B.Boosting, "fit", lambda self, points, whole=True: seen.append((points, whole, self.folds, self.rows)))
    Q._searched_trees(tr)
    [(points, whole, folds, rows)] = seen
    r = (len(y) - sum(y)) / sum(y)
    assert whole and folds == 5 and rows == 60
    want = sorted(product((100, 150, 200), (3, 4, 5), (0.03, 0.05, 0.1), (1.0, r, 0.75 * r), (0.8, 1.0), (0.8, 1.0)))
    assert len(points) == 324 and np.allclose(sorted(astuple(p) for p in points), want)
