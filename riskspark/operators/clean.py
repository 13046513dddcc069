"""Projection, filtering and cleaning operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The label encoding and the null tokens of a pandas CSV read.
DEFAULT_LABEL_MAP = {"Yes": 1, "No": 0}
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Constant columns the reference drops.
CONSTANT_COLUMNS = ["EmployeeCount", "StandardHours", "Over18"]


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop listed columns that exist (``DataFrame.drop`` ignores absent names)."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct, null equals null (N10). One shuffle on all columns."""
    return df.dropDuplicates()


def encode_label(df: DataFrame, col: str, mapping: Mapping[str, int] | None = None) -> DataFrame:
    """Map a text label to ints; values outside the map become null. Numeric labels pass."""
    if col not in df.columns:
        return df
    if not isinstance(df.schema[col].dataType, StringType):
        return df
    mapping = dict(DEFAULT_LABEL_MAP if mapping is None else mapping)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(int(v))) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(int(v))))
    return df.withColumn(col, expr if expr is not None else F.lit(None).cast("int"))


def clean(df: DataFrame, drop: Sequence[str] = tuple(CONSTANT_COLUMNS), label: str | None = "Attrition",
          mapping: Mapping[str, int] | None = None) -> DataFrame:
    """Drop, then de-duplicate, then encode the label (this order: dedup after the drop)."""
    out = drop_duplicate_rows(drop_if_present(df, drop))
    return encode_label(out, label, mapping) if label else out


def normalise_null_tokens(df: DataFrame, cols: Iterable[str] | None = None,
                          tokens: Sequence[str] = tuple(NULL_TOKENS)) -> DataFrame:
    """Text tokens a CSV reader treats as missing become null."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)
             and (cols is None or f.name in set(cols))]
    return df.withColumns({c: F.when(F.col(c).isin(list(tokens)), F.lit(None)).otherwise(F.col(c)) for c in names})


def two_way_band(c: str | Column, cut: float, high: str, low: str) -> Column:
    """``c >= cut`` -> high, ``c < cut`` -> low, null stays null (no otherwise)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x >= F.lit(cut), F.lit(high)).when(x < F.lit(cut), F.lit(low))


def select_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def complete_schema(df: DataFrame, numeric: Iterable[str], categorical: Iterable[str],
                    num_default: float = 0.0, cat_default: str = "Unknown") -> DataFrame:
    """Add absent columns (numeric 0.0, categorical 'Unknown'); nulls in present ones stay."""
    add = {c: F.lit(float(num_default)) for c in numeric if c not in df.columns}
    add.update({c: F.lit(cat_default) for c in categorical if c not in df.columns})
    return df.withColumns(add) if add else df


def conform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: reorder to the training column order."""
    return df.select(*cols)


def file_position(df: DataFrame) -> Column | None:
    """(file, row in the file) of each row of a Parquet scan and of filters and projections of it, the same in every
    run; None for other frames."""
    from pyspark.errors import AnalysisException

    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        df.select(place).schema  # noqa: B018 - only looked up
    except AnalysisException:
        return None
    return place


def positional_split(df: DataFrame, order_key: str, first_n: int | None = None,
                     cutoff: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """baseline/current split. With ``cutoff`` (preferred at scale) it is a plain filter; with ``first_n`` the
    first n rows by ``order_key`` (nulls last) form the baseline. Prefix counts over the distinct values find the value at the
    cut; among the rows that share it, those with the smallest hash of the row's place come first. Rows of Parquet files
    have a place of their own (file and row in it), so nothing is written; others are numbered and
    written once, so both frames see the same order. Rows sharing a key value are cut by position, like a
    positional slice."""
    if cutoff is not None:
        return df.where(cutoff), df.where(~cutoff | cutoff.isNull())
    from riskspark.operators.cuts import chosen, hash_cuts, with_cuts
    from riskspark.operators.prefix import running_sums
    from riskspark.session import cut_lineage

    n = int(first_n)
    if n <= 0:
        return df.where(F.lit(False)), df
    place = file_position(df)
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id())) if place is None else df.withColumn("_row", place)
    key = F.col(order_key)
    values = rows.where(key.isNotNull()).groupBy(order_key).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(values, order_key, ["_c"])
    hit = (F.col("cum__c") - F.col("_c") < n) & (F.col("cum__c") >= n)
    # one row: the value at the cut (null: all rows with a key are in the baseline) and how many of its rows are
    edge = cum.agg(F.max(F.when(hit, key)).alias("_edge"), F.max(F.when(hit, n - F.col("cum__c") + F.col("_c"))).alias("_part"), F.sum("_c").alias("_keyed"))
    edge = edge.select("_edge", F.coalesce("_part", n - F.coalesce("_keyed", F.lit(0))).cast("long").alias("_need"))
    marked = rows.crossJoin(F.broadcast(edge))
    tied = F.coalesce(key.eqNullSafe(F.col("_edge")), F.lit(False))
    before = key.isNotNull() & (F.col("_edge").isNull() | (key < F.col("_edge")))
    cuts = hash_cuts(marked.where(tied), ["_need"], ["_row"], 42, [lambda c: F.least(c, F.col("_need"))])
    first = F.coalesce(before, F.lit(False)) | (tied & chosen(["_row"], 42))
    out = with_cuts(marked, cuts.drop("_need"), []).withColumn("_first", first)
    drop = ["_row", "_edge", "_need", "_cuts", "_first"]
    return out.where("_first").drop(*drop), out.where(~F.col("_first")).drop(*drop)


def hash_fraction(key_cols: Sequence[str], fraction: float, seed: int = 42) -> Column:
    """P13 (fraction): a seeded, deterministic Bernoulli draw keyed by the row's own columns, in steps of 2^-64."""
    if fraction >= 1:
        return F.lit(True)
    cut = round(fraction * 2**64) - 2**63  # the hash is a signed long
    return F.lit(False) if fraction <= 0 else F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]) < F.lit(min(cut, 2**63 - 1))


def hash_uniform(key_cols: Sequence[str | Column], seed: int) -> Column:
    """A seeded number in [0, 1) from the row's own columns (53 bits)."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in key_cols])
    return F.shiftrightunsigned(h, 11).cast("double") / float(2**53)


def seeded_sample(df: DataFrame, key_cols: Sequence[str], n: int | None = None, fraction: float | None = None,
                  seed: int = 42) -> DataFrame:
    """Exact n rows (smallest seeded hash; a sampling operator, so the limit is the feature)
    or a seeded fraction."""
    if fraction is not None:
        return df.where(hash_fraction(key_cols, fraction, seed))
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols])
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(int(n)).drop("_h")


def shape(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def validate_domains(df: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None,
                     allowed: Mapping[str, Sequence[str]] | None = None, id_cols: Sequence[str] = ()) -> DataFrame:
    """Long-form violations (ids..., column, value, rule) of numeric ranges and category sets.
    Nulls are not violations."""
    checks = []
    for c, (lo, hi) in (ranges or {}).items():
        bad = ~F.col(c).between(lo, hi)
        checks.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                                           F.lit(f"range[{lo},{hi}]").alias("rule"))))
    for c, vals in (allowed or {}).items():
        bad = ~F.col(c).isin(list(vals))
        checks.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                                           F.lit("allowed_set").alias("rule"))))
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.select(*id_cols, F.explode(arr).alias("_v")).select(*id_cols, "_v.*")


def violation_counts(violations: DataFrame) -> DataFrame:
    """P16 summary: violations per column and rule."""
    return violations.groupBy("column", "rule").agg(F.count(F.lit(1)).alias("violations"))
