"""Sources and sinks (IO1-IO11): CSV/Parquet/JSON with explicit schemas, temp views, SQL files,
report and metadata JSON. Writers go to shared storage paths (on a cluster, never a local folder)."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, MapType, StringType, StructField, StructType)

from riskspark.operators.clean import NULL_TOKENS, normalise_null_tokens

# microseconds are kept (Spark's own formats cut them to milliseconds); quotes inside a value are doubled, as pandas writes them
CSV_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             null_tokens: Sequence[str] = tuple(NULL_TOKENS)) -> DataFrame:
    """IO1: header CSV with an explicit schema (no inference pass at scale). Text tokens that a
    pandas reader treats as missing become null (N11)."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return normalise_null_tokens(df, tokens=null_tokens)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """IO2/IO3: overwrite a table (Parquet by default; CSV with a header, no index)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').options(**CSV_TIMES).csv(path)
    else:
        w.format(fmt).save(path)


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """IO4: replace session views from frames (the reference's replace-table load)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def split_sql(text: str) -> list[tuple[str, str]]:
    """IO5 parsing: statements split on ';', blanks skipped; title = the first '--' comment line."""
    out = []
    for i, stmt in enumerate(s for s in text.split(";") if s.strip()):
        lines = [ln.strip() for ln in stmt.strip().splitlines()]
        title = next((ln[2:].strip() for ln in lines if ln.startswith("--")), f"Query {i + 1}")
        out.append((title, stmt.strip()))
    return out


def executed(df: DataFrame) -> DataFrame:
    """The result of ``df``, written to the shared folder and read back in its order. A command without columns has run already."""
    import uuid

    if not df.columns:
        return df
    path, names = scratch_path(df.sparkSession, "results", uuid.uuid4().hex), df.columns
    # numbered columns: a statement may name two alike
    own = df.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("at", F.monotonically_increasing_id())
    own.write.parquet(path)
    return df.sparkSession.read.schema(own.schema).parquet(path).orderBy("at").drop("at").toDF(*names)


def run_sql_text(spark: SparkSession, text: str, execute: bool = True) -> list[tuple[str, DataFrame | Exception]]:
    """IO5: run each statement under its own guard; an error, at analysis or at run time, is reported for that statement
    and the rest go on. Without ``execute`` the results stay lazy, and only errors of analysis are caught."""
    results = []
    for title, stmt in split_sql(text):
        try:
            df = spark.sql(stmt)
            results.append((title, executed(df) if execute else df))
        except Exception as e:  # noqa: BLE001 - reported per query, like the reference
            results.append((title, e))
    return results


def run_sql_file(spark: SparkSession, path: str, execute: bool = True) -> list[tuple[str, DataFrame | Exception]]:
    with open(path, encoding="utf-8") as fh:
        return run_sql_text(spark, fh.read(), execute)


def error_class(e: Exception) -> str:
    """The engine's name of an error, or the exception's type."""
    condition = getattr(e, "getCondition", lambda: None)()
    return condition or type(e).__name__


def write_json_report(df: DataFrame, path: str) -> None:
    """IO6: a (small) report as JSON lines, one object per row."""
    df.write.mode("overwrite").json(path)


METADATA_SCHEMA = StructType([
    StructField("feature_names", ArrayType(StringType())),
    StructField("numerical_cols", ArrayType(StringType())),
    StructField("categorical_cols", ArrayType(StringType())),
    StructField("training_cols", ArrayType(StringType())),
    StructField("tuned_threshold", DoubleType()),
    StructField("baseline_threshold", DoubleType()),
    StructField("scaling_params", MapType(StringType(), StructType([
        StructField("mean", DoubleType()), StructField("scale", DoubleType())]))),
])


def metadata_frame(spark: SparkSession, feature_names: Sequence[str], numeric: Sequence[str],
                   categorical: Sequence[str], scaler_params: DataFrame, tuned: float, baseline: float = 0.5) -> DataFrame:
    """IO7 (write side): one metadata row; the scaling map is built from the parameter table by an
    aggregate (map_from_entries), not on the driver."""
    scaling = scaler_params.agg(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct(F.col("mean").cast("double").alias("mean"),
                            F.col("scale").cast("double").alias("scale"))))).alias("scaling_params"))
    return scaling.select(
        F.array(*[F.lit(c) for c in feature_names]).alias("feature_names"),
        F.array(*[F.lit(c) for c in numeric]).alias("numerical_cols"),
        F.array(*[F.lit(c) for c in categorical]).alias("categorical_cols"),
        F.array(*[F.lit(c) for c in [*numeric, *categorical]]).alias("training_cols"),
        F.lit(float(tuned)).alias("tuned_threshold"),
        F.lit(float(baseline)).alias("baseline_threshold"),
        "scaling_params")


def write_metadata(meta: DataFrame, path: str) -> None:
    meta.coalesce(1).write.mode("overwrite").json(path)  # one row


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """IO7 (read side) with the explicit nested schema."""
    return spark.read.schema(METADATA_SCHEMA).option("multiLine", False).json(path)


def scaling_table(meta: DataFrame) -> DataFrame:
    """IO7: the scaling map as a parameter table (feature, mean, scale)."""
    return meta.select(F.explode("scaling_params").alias("feature", "p")).select(
        "feature", F.col("p.mean").alias("mean"), F.col("p.scale").alias("scale"))


def read_metrics_report(spark: SparkSession, path: str) -> DataFrame:
    """IO9: a nested metrics JSON (one object per model) flattened to (model, metric, value)."""
    raw = spark.read.option("multiLine", True).json(path)
    models = raw.columns
    long = raw.select(F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.to_json(F.col(m)).alias("j"))
                                          for m in models])).alias("r"))
    kv = long.select("r.model", F.from_json("r.j", MapType(StringType(), StringType())).alias("m"))
    return kv.select("model", F.explode("m").alias("metric", "value"))


def frame_from_records(spark: SparkSession, records: Sequence[Mapping], schema: StructType | str) -> DataFrame:
    """IO10: in-memory rows (e.g. one entity) to a table; missing keys become null."""
    return spark.createDataFrame([dict(r) for r in records], schema)


def optional_frame(spark: SparkSession, path: str, reader, default: DataFrame | None = None) -> DataFrame | None:
    """IO11: read when the path exists, otherwise return the default (and go on)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        exists = fs.exists(hpath)
    except Exception:  # noqa: BLE001
        exists = os.path.exists(path)
    return reader(path) if exists else default


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (``spark.checkpoint.dir``)."""
    from riskspark.session import ensure_checkpoint_dir

    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])
