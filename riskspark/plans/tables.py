"""Driver tables and the role each query gives their columns (survey §7.3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the mapping: the cut between the two drift samples, the score threshold and
# the label definitions on the driver tables.
EVENTS_CUT = "2024-01-16"
EVENT_POSITIVE = "purchase"
EVENT_THRESHOLD = 50.0
RETURN_POSITIVE = "R"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from riskspark.session import ship_package

    ship_package(spark)  # workers need the package for the Python parts (p-values, Shapley)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with y = purchase (int), score = value, yhat = value >= 50."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumns({
        "y": (F.col("event_type") == F.lit(EVENT_POSITIVE)).cast("int"),
        "yhat": (F.col("value") >= F.lit(EVENT_THRESHOLD)).cast("int"),
    })


def events_before_cut() -> Column:
    return F.col("ts") < F.lit(EVENTS_CUT).cast("timestamp_ntz")


def lineitem_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("label", (F.col("l_returnflag") == F.lit(RETURN_POSITIVE)).cast("int"))
