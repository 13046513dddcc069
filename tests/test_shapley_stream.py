"""Tree Shapley values against brute-force subsets; streaming scoring smoke."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from riskspark.operators.shapley import Explainer, explain, extract_gbt
from tests.conftest import SF_SMALL
from tests.shapley_reference import expected, tree_shap_subsets


def test_tree_shap_sum_rule_and_brute_force(spark):
    from pyspark.ml.classification import GBTClassifier
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1] * x[:, 2]) > 0).astype(int)
    df = spark.createDataFrame([(Vectors.dense(r.tolist()), int(t)) for r, t in zip(x, y)], ["features", "label"])
    model = GBTClassifier(maxIter=5, maxDepth=2, seed=1).fit(df)
    trees, weights = extract_gbt(model)
    phi, base, followed = Explainer.from_trees(trees, weights).batch(x[:20])
    margin = sum(w * expected(t, x[:20], frozenset(range(3))) for t, w in zip(trees, weights))
    assert np.allclose(phi.sum(axis=1) + base, margin, atol=1e-10) and np.allclose(followed, margin, atol=1e-10)
    # Spark's own margin: probability = 1 / (1 + exp(-2F))
    # equal to the Shapley average over all feature subsets of each tree
    phi_s, base_s = tree_shap_subsets(trees, weights, x[:20])
    assert np.allclose(phi, phi_s, atol=1e-10) and base == pytest.approx(base_s)
    prob = [r["probability"][1] for r in model.transform(df.limit(20)).collect()]
    assert np.allclose(prob, 1 / (1 + np.exp(-2 * margin)), atol=1e-9)


def test_stream_score_matches_batch(spark):
    import __spark_entry__ as entry
    qs = entry.queries()
    a = sorted(qs["stream_score"](spark, SF_SMALL).collect())
    b = sorted(qs["risk_tier"](spark, SF_SMALL).collect())
    assert a == b


def test_stream_restart_is_exactly_once(spark, tmp_path):
    """A restarted query on the same checkpoint processes nothing twice."""
    from riskspark.streaming.stream import file_stream, run_to_files
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    base = str(tmp_path / "s")
    out1 = run_to_files(file_stream(spark, SF_SMALL, schema, "events.parquet"), "t", base=base)
    n1 = spark.read.parquet(out1).count()
    out2 = run_to_files(file_stream(spark, SF_SMALL, schema, "events.parquet"), "t", base=base)
    assert out1 == out2
    assert spark.read.parquet(out2).count() == n1 == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_streams_read_a_table_that_is_a_folder_of_parts(spark, tmp_path):
    """One file, a folder of part files, a pattern of file names and a folder without rows."""
    from riskspark.streaming import stream as S

    rows = spark.range(40).selectExpr("id", "id * 2 AS v")
    rows.repartition(4).write.parquet(str(tmp_path / "parts" / "t.parquet"))
    rows.where("id < 0").write.parquet(str(tmp_path / "none" / "t.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (name,) = [p.name for p in (tmp_path / "one").glob("*.parquet")]
    scorer = lambda df: df.selectExpr("id", "v + 1 AS w")
    want = [(i, 2 * i + 1) for i in range(40)]
    for folder, glob in (("parts", "t.parquet"), ("parts/", "t.parquet"), ("one", name), ("one", "*.parquet"), ("one", None)):
        out = S.score_stream(spark, str(tmp_path) + "/" + folder, "id long, v long", scorer, glob)
        assert out.columns == ["id", "w"] and sorted(map(tuple, out.collect())) == want
    assert S.score_stream(spark, str(tmp_path / "none"), "id long, v long", scorer, "t.parquet").collect() == []


def test_tree_shap_deep_trees_sum_rule(spark):
    from pyspark.ml.classification import GBTClassifier
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 8))
    y = ((x[:, 0] * x[:, 1] + x[:, 2] - x[:, 3] * x[:, 4] + 0.5 * x[:, 5]) > 0).astype(int)
    df = spark.createDataFrame([(Vectors.dense(r.tolist()), int(t)) for r, t in zip(x, y)], ["features", "label"])
    model = GBTClassifier(maxIter=4, maxDepth=6, seed=3).fit(df)
    trees, weights = extract_gbt(model)
    phi, base, _ = Explainer.from_trees(trees, weights).batch(x[:50])
    margin = sum(w * expected(t, x[:50], frozenset(range(8))) for t, w in zip(trees, weights))
    assert np.allclose(phi.sum(axis=1) + base, margin, atol=1e-9)


def test_a_stream_with_a_time_limit_raises(spark, tmp_path):
    import time

    from riskspark.streaming import stream as S

    spark.range(40).repartition(4).write.parquet(str(tmp_path / "in"))

    def slow(batches):
        for b in batches:
            time.sleep(3)
            yield b

    s = S.file_stream(spark, str(tmp_path / "in"), "id long", max_files_per_trigger=1).mapInArrow(slow, "id long")
    with pytest.raises(TimeoutError):
        S.run_to_files(s, "slow", timeout_s=1)
    assert spark.read.parquet(S.run_to_files(s, "slow")).count() == 40


def test_explainer_round_trip_and_missing_values(spark, tmp_path):
    from riskspark.operators.boosting import Boosting, Point

    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 4))
    x[::7, 1] = np.nan
    y = (np.nan_to_num(x[:, 1], nan=2.0) + x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([(i, Vectors.dense(r.tolist()), int(t)) for i, (r, t) in enumerate(zip(x, y))], ["k", "features", "label"])
    fit = Boosting(df, "features", "label", ["k"]).fit([Point(6, 3)])
    model = fit.model(Point(6, 3))
    fit.close()
    own = Explainer.of(model)
    own.save(spark, str(tmp_path / "e"), df.limit(10))
    back, background = Explainer.load(spark, str(tmp_path / "e"))
    assert back == own and background.count() == 10
    rows = explain(df, back, "features", ["k"]).orderBy("k").collect()
    assert np.allclose([r.margin for r in rows], model.margins(x), atol=1e-12)
    assert np.allclose([sum(r.shap) + r.base for r in rows], model.margins(x), atol=1e-9)
    phi, base = tree_shap_subsets(*extract_gbt(model), x[1:7])
    assert np.allclose([r.shap for r in rows[1:7]], phi, atol=1e-9) and abs(rows[0].base - base) < 1e-9
    with pytest.raises(FileNotFoundError):
        Explainer.load(spark, str(tmp_path / "none"))
