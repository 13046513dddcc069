"""Structured Streaming (ST1, ST2).

ST1: score files as they land: ``readStream`` with a schema -> stateless scoring -> file sink.
ST2: drift per tumbling event-time window: watermark + window counts by (window, category) in
update mode (late rows within the delay are still counted; the last update of a window stands, also
where the input ends before the watermark closes it), then the chi-square per window against a
static baseline. Rows without a category are left out, as in the batch test. Numeric features: the same
state by (window, value), then the KS test per window.

Sinks and checkpoints live under the session's shared checkpoint folder, so a restarted query
resumes exactly once; nothing is collected to the driver (no memory sink).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskspark.operators import drift as D
from riskspark.sources.io import scratch_path


def file_stream(spark: SparkSession, source_dir: str, schema: StructType | str, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder, with ``glob`` those of that name. A table of that name may also be a folder of
    part files, as Spark writes it: then these are the files."""
    reader = spark.readStream.schema(schema)
    if glob and _is_folder(spark, f"{source_dir.rstrip('/')}/{glob}"):
        source_dir, glob = f"{source_dir.rstrip('/')}/{glob}", None
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def _is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def run_to_files(stream: DataFrame, name: str, output_mode: str = "append", base: str | None = None,
                 timeout_s: float | None = None) -> str:
    """Run a streaming query until the available input is processed; returns the sink folder. With a time limit,
    a query that is not done by then is stopped and TimeoutError raised."""
    spark = stream.sparkSession
    root = base or scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{root}/_checkpoint").option("path", f"{root}/out")
         .trigger(availableNow=True).start())
    _wait(q, timeout_s)
    return f"{root}/out"


def _wait(q, timeout_s: float | None) -> None:
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream was not done after {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_updates(stream: DataFrame, name: str, keys: list[str], timeout_s: float | None = None) -> DataFrame:
    """Run an aggregating stream in update mode until the available input is processed; returns the last row of each
    key, also of windows that are still open when the input ends. Each batch replaces its own folder, so a batch
    that is run again after a failure counts once."""
    spark = stream.sparkSession
    root = scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex}")

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{root}/out/batch-{number:010d}")

    q = (stream.writeStream.outputMode("update").option("checkpointLocation", f"{root}/_checkpoint")
         .foreachBatch(save).trigger(availableNow=True).start())
    _wait(q, timeout_s)
    schema = f"{stream.schema.toDDL()}, _batch int"
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/out")
    rest = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_batch")).alias("_last")).select(*keys, "_last.*")


def score_stream(spark: SparkSession, source_dir: str, schema: StructType | str, scorer: Callable[[DataFrame], DataFrame],
                 glob: str | None = None) -> DataFrame:
    """ST1: stateless scoring of arriving files; returns the scored output as a batch frame."""
    scored = scorer(file_stream(spark, source_dir, schema, glob))
    return spark.read.schema(scored.schema).parquet(run_to_files(scored, "score"))


def windowed_counts_stream(stream: DataFrame, time_col: str, category: str, window: str = "1 day",
                           delay: str = "1 day") -> DataFrame:
    """ST2 (stateful part): counts per (tumbling window, category) with a watermark. Event time must be
    a zoned timestamp for the watermark; a timestamp_ntz column is read in the session time zone."""
    timed = stream.where(F.col(category).isNotNull()).withColumn("_event_time", F.col(time_col).cast("timestamp"))
    return (timed.withWatermark("_event_time", delay)
            .groupBy(F.window(F.col("_event_time"), window).alias("w"), F.col(category).alias("v"))
            .agg(F.count(F.lit(1)).alias("c"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "v", "c"))


def window_drift(spark: SparkSession, source_dir: str, schema: StructType | str, time_col: str, category: str,
                 baseline: DataFrame, glob: str | None = None, window: str = "1 day", delay: str = "1 day",
                 alpha: float = D.DEFAULT_ALPHA) -> DataFrame:
    """ST2: chi-square per window of the stream against the baseline's category counts; the windows that are open
    when the input ends are reported with what they hold."""
    counts = windowed_counts_stream(file_stream(spark, source_dir, schema, glob), time_col, category, window, delay)
    cur = run_updates(counts, "window-counts", ["window_start", "window_end", "v"])
    ref = (baseline.where(F.col(category).isNotNull()).groupBy(F.col(category).cast("string").alias("v"))
           .agg(F.count(F.lit(1)).alias("r")))
    # every window against the baseline without repeating the baseline's categories per window
    chi = D.chi2_against_reference(
        ref.withColumn("feature", F.lit(category)),
        cur.select("window_start", F.lit(category).alias("feature"), F.col("v").cast("string").alias("v"),
                   F.col("c").cast("long").alias("c")),
        ["window_start"])
    return D._chi2_finish(chi, alpha)


def window_ks(spark: SparkSession, source_dir: str, schema: StructType | str, time_col: str, value: str, baseline: DataFrame,
              glob: str | None = None, window: str = "1 day", delay: str = "1 day", alpha: float = D.DEFAULT_ALPHA, method: str = "asymptotic") -> DataFrame:
    """ST2 for a numeric feature: the two-sample KS test of each window of the stream against the baseline. The state is the count
    of each (window, value), which the watermark bounds to the open windows; each batch's updates replace the counts
    before, so windows that are open when the input ends are reported with what they hold. The windows' values and the
    baseline's are merged in one value order, the baseline is not repeated per window. Missing values are left out."""
    from riskspark.functions.stats import ks_pvalue_col

    stream = file_stream(spark, source_dir, schema, glob).where(~F.isnan(F.col(value).cast("double")))
    counts = windowed_counts_stream(stream.withColumn(value, F.col(value).cast("double")), time_col, value, window, delay)
    cur = run_updates(counts, "window-values", ["window_start", "window_end", "v"])
    base = baseline.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    ref = base.groupBy("v").agg(F.count(F.lit(1)).alias("r")).select(F.lit(value).alias("feature"), "v", "r")
    ks = D.ks_against_reference(ref, cur.select("window_start", F.lit(value).alias("feature"), "v", F.col("c").cast("long").alias("c")), ["window_start"])
    if method == "exact":
        ks = D._spread(ks, ["window_start", "feature"])
    return ks.withColumn("p_value", ks_pvalue_col("statistic", "n_ref", "n_cur", method)).withColumn("drift_detected", F.col("p_value") < F.lit(alpha))
