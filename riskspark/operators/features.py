"""Feature operators: group-relative ratios, offset ratios, lookups, scaling, one-hot."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.exprs import offset_div
from riskspark.session import cut_lineage

# The guard constants of the reference's ratios and scaler.
GROUP_MEAN_EPS = 1e-5
TENURE_OFFSET = 1.0
SCALE_EPS = 1e-10
# Scoring-time defaults when the inputs of a ratio are absent.
DEFAULT_INCOME_RATIO = 1.0
DEFAULT_TENURE_RATIO = 0.5
DEFAULT_LEVEL_AVERAGE = 5000.0
DEFAULT_LEVEL = 1


def group_means(df: DataFrame, value: str, key: str) -> DataFrame:
    """Per-key mean of ``value`` (partial aggregation; one row per key)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(F.col(value).cast("double")).alias("_grp_mean"))


def ratio_to_group_mean(df: DataFrame, value: str, key: str, out: str, eps: float = GROUP_MEAN_EPS,
                        means: DataFrame | None = None) -> DataFrame:
    """Value / (mean of value over the row's key group + eps).

    Aggregate + join instead of a window: a window on five job levels would put the table on
    five tasks; the aggregate is map-side combined and the (small) mean table is joined back,
    broadcast by AQE when its measured size allows, otherwise shuffled. A null key gives null (N1).
    ``means`` may be a precomputed (key, _grp_mean) table, e.g. fitted on training rows only."""
    m = means if means is not None else group_means(df, value, key)
    j = df.join(m, on=key, how="left")
    return j.withColumn(out, offset_div(F.col(value), F.col("_grp_mean"), eps)).drop("_grp_mean")


def offset_ratio(df: DataFrame, num: str, den: str, out: str, offset: float = TENURE_OFFSET) -> DataFrame:
    """num / (den + offset)."""
    return df.withColumn(out, offset_div(num, den, offset))


def lookup(key: str | Column, table: Mapping, default) -> Column:
    """Dictionary lookup with a default, as a literal map (no join, no shuffle)."""
    k = F.col(key) if isinstance(key, str) else key
    pairs = []
    for a, b in table.items():
        pairs += [F.lit(a), F.lit(b)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), k), F.lit(default))


def lookup_ratio(df: DataFrame, value: str, key: str, table: Mapping, out: str,
                 default_avg: float = DEFAULT_LEVEL_AVERAGE) -> DataFrame:
    """Value / reference average of the key (default 5000.0), no epsilon (scoring side)."""
    return df.withColumn(out, F.col(value).cast("double") / lookup(key, table, float(default_avg)))


def engineer_features(df: DataFrame, income: str = "MonthlyIncome", level: str = "JobLevel",
                      role_years: str = "YearsInCurrentRole", company_years: str = "YearsAtCompany") -> DataFrame:
    """M1: the two engineered ratios of the reference."""
    out = ratio_to_group_mean(df, income, level, "income_ratio_to_joblevel_avg")
    return offset_ratio(out, role_years, company_years, "role_tenure_ratio")


def scoring_features(df: DataFrame, mode: str = "batch_mean", reference_table: Mapping | None = None,
                     income: str = "MonthlyIncome", level: str = "JobLevel",
                     role_years: str = "YearsInCurrentRole", company_years: str = "YearsAtCompany",
                     keep_given: bool = False) -> DataFrame:
    """M2: scoring-time features. ``batch_mean``: W1 on the batch itself (eps 1e-5); ``reference_table``: J3
    against fixed level averages (no eps), with level 1 where the level column is absent. Absent inputs
    give the defaults 1.0 / 0.5 (F4). ``keep_given`` keeps ratios that the caller supplies (single
    entities); otherwise they are computed anew."""
    out = df
    if keep_given and "income_ratio_to_joblevel_avg" in df.columns:
        pass
    elif income in df.columns and level in df.columns and mode == "batch_mean":
        out = ratio_to_group_mean(out, income, level, "income_ratio_to_joblevel_avg")
    elif income in df.columns and (level in df.columns or not keep_given):
        leveled = out if level in df.columns else out.withColumn(level, F.lit(DEFAULT_LEVEL))
        out = lookup_ratio(leveled, income, level, reference_table or {}, "income_ratio_to_joblevel_avg")
        out = out if level in df.columns else out.drop(level)
    else:
        out = out.withColumn("income_ratio_to_joblevel_avg", F.lit(DEFAULT_INCOME_RATIO))
    if keep_given and "role_tenure_ratio" in df.columns:
        return out
    if role_years in df.columns and company_years in df.columns:
        out = offset_ratio(out, role_years, company_years, "role_tenure_ratio")
    else:
        out = out.withColumn("role_tenure_ratio", F.lit(DEFAULT_TENURE_RATIO))
    return out


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M3: mean and population standard deviation (N7) of each column in one aggregate; a zero
    deviation is stored as 1.0. Returns the parameter table (feature, mean, scale)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_pop(x).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"),
                              F.when(F.col(f"s__{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s__{c}")).alias("scale"))
                     for c in cols])
    return wide.select(F.inline(rows))


@dataclass
class ScalerParams:
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    @staticmethod
    def from_table(params: DataFrame) -> ScalerParams:
        # one row per feature: fitted model parameters, bounded by the feature list
        p = ScalerParams()
        for r in params.collect():
            p.mean[r["feature"]] = r["mean"]
            p.scale[r["feature"]] = r["scale"]
        return p


def apply_scaler(df: DataFrame, params: ScalerParams, eps: float = SCALE_EPS, suffix: str = "") -> DataFrame:
    """M4: (x - mean) / (scale + eps); eps = 0 reproduces the fit-side transform."""
    return df.withColumns({f"{c}{suffix}": (F.col(c).cast("double") - F.lit(params.mean[c]))
                           / (F.lit(params.scale[c]) + F.lit(eps)) for c in params.mean})


def fit_one_hot(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> DataFrame:
    """M5: sorted distinct categories per column minus the alphabetically first (N8). Distinct values are found by
    an aggregate on (feature, value); one-hot columns are meant for short category lists, and the list of a
    column, which names its columns, is one row. Returns (feature, categories array<string>); a column with a
    single category has no row."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "v")
    distinct = long.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")).drop("n")
    if drop_first:
        first = distinct.groupBy("feature").agg(F.min("v").alias("_first"))
        distinct = distinct.join(first, "feature").where(F.col("v") != F.col("_first")).drop("_first")
    return distinct.groupBy("feature").agg(F.sort_array(F.collect_list("v")).alias("categories"))


def one_hot_names(categories: Mapping[str, Sequence[str]], order: Sequence[str]) -> list[str]:
    return [f"{c}_{v}" for c in order for v in categories.get(c, [])]


def collect_categories(params: DataFrame) -> dict[str, list[str]]:
    # fitted categories are model parameters (bounded by the category lists)
    return {r["feature"]: list(r["categories"]) for r in params.collect()}


def apply_one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]], order: Sequence[str] | None = None) -> DataFrame:
    """M6: one 0/1 double column ``<col>_<value>`` per kept category; unseen and null
    values are all zeros."""
    order = list(order) if order else list(categories)
    return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
                           for c in order for v in categories.get(c, [])})


PART_BITS = 33  # of monotonically_increasing_id(): the lower 33 bits count the rows of a partition


def category_index(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> tuple[DataFrame, int]:
    """M5 for category lists of any length: ((feature, value, index), number of indexes). Values are numbered in sorted
    order within a column and the columns in the order of ``cols``, like ``one_hot_names``; the first value of a column has
    no row if ``drop_first``. The list stays a table: values are dealt by ranges of (feature, value), numbered within
    their partition, and shifted by the counts of the partitions before. Nulls are no category."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "value")
    distinct = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    ranged = distinct.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value")
    rows = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", PART_BITS))
    runs = rows.groupBy("feature", "_part").agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    runs = runs.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_lo"))
    sizes = {r["feature"]: r["_n"] for r in runs.groupBy("feature").agg(F.sum("_n").alias("_n")).collect()}  # a row a column
    skip, first, size = int(drop_first), {}, 0
    for c in cols:
        first[c] = size
        size += max(0, sizes.get(c, 0) - skip)
    placed = rows.join(runs.drop("_lo", "_n"), ["feature", "_part"]).withColumn("_pos", F.col("_at") + F.col("_shift") - skip)
    return placed.where("_pos >= 0").select("feature", "value", (F.col("_pos") + lookup("feature", first, 0)).cast("int").alias("index")), size


def one_hot_indices(df: DataFrame, index: DataFrame, cols: Sequence[str], out: str = "indices") -> DataFrame:
    """M6 for category lists of any length: ``df`` with the ascending places of the ones of each row (array of int).
    The index is joined column by column, broadcast or shuffled by its measured size; unseen and null values have no one."""
    places = [f"_place_{i}" for i in range(len(cols))]
    for c, place in zip(cols, places):
        own = index.where(F.col("feature") == c).select(F.col("value").alias(f"{place}_v"), F.col("index").alias(place))
        df = df.join(own, F.col(c).cast("string") == F.col(f"{place}_v"), "left").drop(f"{place}_v")
    return df.withColumn(out, F.array_compact(F.array(*places))).drop(*places)


def sparse_ones(df: DataFrame, size: int, indices: str = "indices", out: str = "features") -> DataFrame:
    """M7: sparse vectors of ``size`` places with ones at ``indices`` (null: none). A column named ``out`` is replaced."""
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, VectorUDT())])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
        for batch in batches:
            own = pc.fill_null(batch.column(batch.schema.get_field_index(indices)), [])
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(own).to_numpy(zero_copy_only=False))]).astype(np.int32)
            flat = own.flatten()
            parts = [pa.array(np.zeros(len(own), np.int8)), pa.array(np.full(len(own), size, np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), flat), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ones(len(flat))))]
            vectors = pa.StructArray.from_arrays(parts, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def assemble(df: DataFrame, feature_names: Sequence[str], out: str = "features") -> DataFrame:
    """M7: vector in ``feature_names`` order; nulls kept as NaN (handleInvalid='keep')."""
    cast = df.withColumns({c: F.col(c).cast("double") for c in feature_names})
    return VectorAssembler(inputCols=list(feature_names), outputCol=out, handleInvalid="keep").transform(cast)


def pay_band_flag(ratio: str | Column, low: float = 0.85, high: float = 1.15) -> Column:
    """Below / above / within the peer average."""
    r = F.col(ratio) if isinstance(ratio, str) else ratio
    return F.when(r.isNull(), F.lit(None).cast("string")).when(r < low, F.lit("below")).when(r > high, F.lit("above")).otherwise(F.lit("within"))
