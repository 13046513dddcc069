"""Splits, class weights and classifiers (M8-M18) on Spark ML.

Stratified split and folds are exact and neither sort nor shuffle the rows: each class has cut values of
a seeded hash (``cuts.py``), and a row is placed by comparing its own hash with them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators import features as W
from riskspark.operators.clean import hash_uniform
from riskspark.operators.cuts import chosen, hash_cuts, hashed_key, with_cuts
from riskspark.operators.prefix import running_sums


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """M8: adds ``is_test``; each class (null among them) contributes round(test_fraction * n_class) test rows
    (HALF_UP), the ones with the smallest seeded hash of the key columns."""
    cuts = hash_cuts(df, [label], key_cols, seed, [lambda n: F.round(n * F.lit(float(test_fraction)))])
    return with_cuts(df, cuts, [label]).withColumn("is_test", chosen(key_cols, seed)).drop("_cuts")


def stratified_folds(df: DataFrame, label: str, key_cols: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """M9: adds ``fold`` in 0..k-1, class shares equal across folds (sizes differ by at most one): k ranges of the
    seeded hash of the key in each class."""
    targets = [lambda n, j=j: F.floor(n / k) * j + F.least(F.lit(j), n % k) for j in range(1, k)]
    rows = with_cuts(df, hash_cuts(df, [label], key_cols, seed, targets), [label])
    own = hashed_key(key_cols, seed)
    above = F.size(F.filter("_cuts", lambda c: c["cut"] < own))
    # a target of 0 rows has no cut: every row is beyond it
    fold = F.when(F.col("_cuts").isNull(), F.lit(k - 1)).otherwise(above + (k - 1) - F.size("_cuts"))
    return rows.withColumn("fold", fold.cast("int")).drop("_cuts")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: n, balanced weight N / (2 n), and the imbalance factor negatives/positives."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_total"), F.sum(F.when(F.col("class") == 0, F.col("n"))).alias("neg"),
                     F.sum(F.when(F.col("class") == 1, F.col("n"))).alias("pos"))
    return counts.crossJoin(F.broadcast(tot)).select(  # one totals row
        "class", "n", (F.col("_total") / (2.0 * F.col("n"))).alias("weight"),
        F.try_divide(F.col("neg").cast("double"), F.col("pos")).alias("imbalance"))


def with_weights(df: DataFrame, label: str, out: str = "weight", factors: Sequence[float] = ()) -> DataFrame:
    """Adds the balanced class weight ``out``, ``unit_weight`` (1.0), and for each factor f ``positive_weight_<100 f>``: f times the
    imbalance (negatives / positives) for positive rows, 1.0 for the others."""
    scaled = [F.when(F.col("class") == 1, F.lit(float(f)) * F.col("imbalance")).otherwise(F.lit(1.0)).alias(f"positive_weight_{round(100 * f)}") for f in factors]
    w = class_weights(df, label).select(F.col("class").alias(label), F.col("weight").alias(out), *scaled)
    return df.join(w, label, "left").withColumn("unit_weight", F.lit(1.0))


@dataclass
class Prep:
    """Fitted preprocessing: scaler parameters, kept categories, and the feature order (M3-M7)."""
    numeric: list[str]
    categorical: list[str]
    scaler: W.ScalerParams = field(default_factory=W.ScalerParams)
    categories: dict[str, list[str]] = field(default_factory=dict)

    @property
    def feature_names(self) -> list[str]:
        return list(self.numeric) + W.one_hot_names(self.categories, self.categorical)

    def transform(self, df: DataFrame, eps: float = W.SCALE_EPS, out: str = "features") -> DataFrame:
        """Adds the feature vector ``out``; input columns are left unchanged (scaled values and
        dummies live in temporary columns that are dropped after assembly)."""
        from riskspark.operators.clean import complete_schema
        x = complete_schema(df, self.numeric, self.categorical)
        x = W.apply_scaler(x, self.scaler, eps=eps, suffix="__z")
        dummies = W.one_hot_names(self.categories, self.categorical)
        tmp = {n: f"__d{i}" for i, n in enumerate(dummies)}
        x = W.apply_one_hot(x, self.categories, self.categorical)
        x = x.withColumnsRenamed(tmp)
        cols = [f"{c}__z" for c in self.numeric] + [tmp[n] for n in dummies]
        return W.assemble(x, cols, out).drop(*cols)


def fit_prep(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Prep:
    p = Prep(list(numeric), list(categorical))
    p.scaler = W.ScalerParams.from_table(W.fit_scaler(train, numeric))
    p.categories = W.collect_categories(W.fit_one_hot(train, categorical)) if categorical else {}
    return p


PREP_SCHEMA = ("numeric array<string>, categorical array<string>, mean map<string,double>, scale map<string,double>, "
               "categories map<string,array<string>>")


def save_prep(spark: SparkSession, prep: Prep, path: str) -> None:
    """IO8: the fitted preprocessing as one JSON row."""
    row = (prep.numeric, prep.categorical, prep.scaler.mean, prep.scaler.scale, prep.categories)
    spark.createDataFrame([row], PREP_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def load_prep(spark: SparkSession, path: str) -> Prep:
    """The preprocessing that save_prep wrote; FileNotFoundError if it is not there."""
    from riskspark.sources.io import optional_frame

    rows = optional_frame(spark, path, lambda p: spark.read.schema(PREP_SCHEMA).json(p))
    row = rows.first() if rows is not None else None
    if row is None:
        raise FileNotFoundError(f"no fitted preprocessing at {path}")
    return Prep(list(row.numeric), list(row.categorical), W.ScalerParams(dict(row["mean"]), dict(row["scale"])),
                {k: list(v) for k, v in row.categories.items()})


def logistic(label: str = "label", weight: str | None = None, reg: float = 0.0, max_iter: int = 100) -> LogisticRegression:
    """L2 logistic regression (regParam = 1 / (C * sum of weights) mirrors liblinear's C)."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg,
                            elasticNetParam=0.0, standardization=False)
    if weight:
        lr.setWeightCol(weight)
    return lr


def boosted_trees(label: str = "label", weight: str | None = None, max_iter: int = 50, max_depth: int = 3,
                  step: float = 0.1, subsample: float = 1.0, seed: int = 42, feature_subset: str = "all") -> GBTClassifier:
    """Spark ML's gradient-boosted trees (no L2 leaf term, columns drawn per node); M13 and its grid are in boosting.py."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                        subsamplingRate=subsample, seed=seed, featureSubsetStrategy=feature_subset)
    if weight:
        gbt.setWeightCol(weight)
    return gbt


def grid_search(estimator, grid, train: DataFrame, label: str, fold_col: str = "fold", parallelism: int = 4):
    """Best mean CV ROC-AUC over the grid with the given fold column (0, 1, ... up to its maximum), refit on all rows.
    The evaluator uses every distinct score (numBins=0) instead of down-sampling the curve."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
                                       numBins=0)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, foldCol=fold_col,
                        numFolds=train.agg(F.max(fold_col)).first()[0] + 1, parallelism=parallelism, seed=42)
    return cv.fit(train)


def lr_grid(lr: LogisticRegression, weight_total: float, cs: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
            weights: Sequence[str] = ("weight", "unit_weight")):
    """M12 grid: inverse regularisation strengths C (regParam = 1 / (C * sum of weights)) x weight columns, balanced
    and plain; both kinds of weights add up to the number of rows."""
    return (ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * weight_total) for c in cs])
            .addGrid(lr.weightCol, list(weights)).build())


def positive_probability(pred: DataFrame, out: str = "p") -> DataFrame:
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


def out_of_fold(estimator, df: DataFrame, fold_col: str = "fold", k: int = 5, out: str = "p_oof") -> DataFrame:
    """Every row scored by the model that did not see its fold (k fits, one union)."""
    parts = []
    for i in range(k):
        model = estimator.fit(df.where(F.col(fold_col) != i))
        parts.append(positive_probability(model.transform(df.where(F.col(fold_col) == i)), out))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def save_model(model, path: str) -> None:
    """IO8: persist a fitted model (Spark ML format, overwrite)."""
    model.write().overwrite().save(path)


def oversample_minority(df: DataFrame, features_col: str, label: str, key_cols: Sequence[str], seed: int = 42,
                        out_col: str = "synthetic", k: int = 5) -> DataFrame:
    """Synthesise minority rows until the classes are equal, x + u * (neighbour - x).

    Each minority row has a rank by the hash of its key; it makes floor(need / m) synthetic rows, plus one for the
    first (need mod m) ranks, so exactly ``need`` rows are added. The neighbour of each new row is drawn, by a hash of
    (key, copy), from the row's ``k`` nearest minority rows (neighbours.knn, exact); a row without others is copied. u is a seeded hash, too.
    Returns the input plus the new rows (``synthetic`` = true)."""
    from pyspark.ml.functions import array_to_vector

    from riskspark.operators.neighbours import knn
    from riskspark.session import cut_lineage

    counts = {r[label]: r["n"] for r in df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # classes
    if len(counts) < 2:
        return df.withColumn(out_col, F.lit(False))
    minority = min(counts, key=lambda c: (counts[c], c))
    m, need = counts[minority], max(counts.values()) - counts[minority]
    base = df.withColumn(out_col, F.lit(False))
    if need == 0:
        return base
    mino = df.where(F.col(label) == F.lit(minority)).select(*key_cols, label, features_col, F.xxhash64(F.lit(seed), *key_cols).alias("_h"), F.lit(1).alias("_one"))
    ranked = cut_lineage(running_sums(mino, "_h", ["_one"]).select(*key_cols, label, features_col, F.col("cum__one").alias("_rank")))
    near = knn(ranked, features_col, "_rank", k).select("_rank", F.col("neighbours.id").alias("_near"))
    # the new rows are numbered first and dealt to the minority rows, so a row's copies are made by many tasks
    new = df.sparkSession.range(need).select((F.col("id") % m + 1).alias("_rank"), (F.floor(F.col("id") / m) + 1).cast("int").alias("_j"))
    own = ranked.join(near, "_rank", "left").withColumn("_x", vector_to_array(F.col(features_col))).drop(features_col)
    drawn = F.pmod(F.xxhash64(F.lit(seed + 1), *key_cols, "_j"), F.size("_near")).cast("int")
    syn = new.join(own, "_rank").withColumn("_partner", F.when(F.size("_near") > 0, F.get("_near", drawn)).otherwise(F.col("_rank")))
    partner = ranked.select(F.col("_rank").alias("_partner"), vector_to_array(F.col(features_col)).alias("_nx"))
    u = hash_uniform([*key_cols, F.col("_j")], seed)
    new_x = F.zip_with("_x", "_nx", lambda a, b: a + u * (b - a))
    synth = syn.join(partner, "_partner").select(*[F.col(c) for c in key_cols], F.col(label), array_to_vector(new_x).alias(features_col), F.lit(True).alias(out_col))
    return base.select(*key_cols, label, features_col, out_col).unionByName(synth)
