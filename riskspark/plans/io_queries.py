"""Source/sink queries (IO1-IO11): SQL file reports over session views, metadata JSON round trip,
CSV round trip. Scratch output goes under the session's shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskspark.functions.exprs import round_all
from riskspark.operators import features as W
from riskspark.plans.queries import register
from riskspark.plans.tables import table
from riskspark.sources import io as IO

SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sql")
DRIVER_SQL = os.path.join(SQL_DIR, "driver_reports.sql")


def _views(spark, sf):
    IO.load_tables(spark, {n: table(spark, sf, n) for n in ("lineitem", "orders", "customer")})


@register("sql_file_reports")
def q_sql_file_reports(spark, sf):
    _views(spark, sf)
    out = None
    for i, (title, res) in enumerate(IO.run_sql_file(spark, DRIVER_SQL)):
        if isinstance(res, Exception):
            part = spark.createDataFrame([(i + 1, title, -1)], "idx int, title string, n_rows long")
        else:
            part = res.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(i + 1).alias("idx"), F.lit(title).alias("title"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


RUNTIME_SQL = """
-- Lines by flag
SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag;
-- Quantity per line of no order
SELECT l_linenumber, SUM(l_quantity) / (COUNT(*) - COUNT(l_orderkey)) AS share FROM lineitem GROUP BY l_linenumber;
-- A table that is not there
SELECT * FROM no_such_table;
-- Orders by status
SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus
"""


@register("sql_runtime_errors")
def q_sql_runtime_errors(spark, sf):
    """IO5: the second statement fails while it runs, the third at analysis; the others give their rows."""
    _views(spark, sf)
    out = None
    for i, (title, res) in enumerate(IO.run_sql_text(spark, RUNTIME_SQL)):
        if isinstance(res, Exception):
            part = spark.createDataFrame([(i + 1, title, None, IO.error_class(res))], "idx int, title string, n_rows long, error string")
        else:
            part = res.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(i + 1).alias("idx"), F.lit(title).alias("title"), "n_rows", F.lit(None).cast("string").alias("error"))
        out = part if out is None else out.unionByName(part)
    return out


@register("json_report")
def q_json_report(spark, sf):
    """IO6: a report written as JSON and read back."""
    import uuid

    from riskspark.plans.queries import all_queries

    report, path = all_queries()["rate_by_two_keys"](spark, sf), IO.scratch_path(spark, "reports", uuid.uuid4().hex)
    IO.write_json_report(report, path)
    return spark.read.schema(report.schema).json(path)


@register("scored_export")
def q_scored_export(spark, sf):
    """IO3: events with their score and prediction written as CSV, read back and compared with the table row by row."""
    import uuid

    from riskspark.plans.tables import events_labeled

    own = events_labeled(spark, sf).select("event_id", "user_id", "event_type", "value", "y", "yhat")
    path = IO.scratch_path(spark, "exports", uuid.uuid4().hex)
    IO.write_table(own, path, "csv")
    back = IO.read_csv(spark, path, own.schema)
    j = own.join(back.select("event_id", F.struct(*own.columns).alias("b")), "event_id")
    return j.agg(F.count(F.lit(1)).alias("n"), F.sum("yhat").cast("long").alias("flagged"), F.bool_and(F.struct(*own.columns).eqNullSafe(F.col("b"))).alias("identical"))


@register("sql_file_report_rows")
def q_sql_file_report_rows(spark, sf):
    """All rows of the reports, a row for each measure: report, key columns as text, measure, value."""
    _views(spark, sf)
    out = None
    for i, (_, res) in enumerate(IO.run_sql_file(spark, DRIVER_SQL, execute=False)):
        if isinstance(res, Exception):
            raise res
        measures = [c for c in res.columns if c in ("rate_pct", "n", "avg_quantity", "avg_price", "total", "avg_acctbal") or (c == "returned" and i == 2)]
        keys = F.concat_ws("/", *[F.col(c).cast("string") for c in res.columns if c not in measures])
        part = res.select(F.lit(i + 1).alias("idx"), keys.alias("row_key"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures])).alias("m")).select("idx", "row_key", "m.*")
        out = part if out is None else out.unionByName(part)
    return out


@register("sql_report_join")
def q_sql_report_join(spark, sf):
    _views(spark, sf)
    return IO.run_sql_file(spark, DRIVER_SQL, execute=False)[3][1]


@register("json_metadata")
def q_json_metadata(spark, sf):
    part = table(spark, sf, "part")
    params = W.fit_scaler(part, ["p_size", "p_retailprice"])
    meta = IO.metadata_frame(spark, ["p_size", "p_retailprice"], ["p_size", "p_retailprice"], [], params, tuned=0.26795)
    path = IO.scratch_path(spark, "metadata", uuid.uuid4().hex)
    IO.write_metadata(meta, path)
    return round_all(IO.scaling_table(IO.read_metadata(spark, path)), 6)


EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _csv_and_back(spark, sf):
    """All columns of the events, and the same after a round trip through CSV."""
    ev = table(spark, sf, "events")
    path = IO.scratch_path(spark, "csv", uuid.uuid4().hex)
    IO.write_table(ev, path, fmt="csv")
    return ev, IO.read_csv(spark, path, EVENTS_SCHEMA)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    _, back = _csv_and_back(spark, sf)
    return round_all(back.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum_value"),
                              F.count_if(F.col("props").isNull()).alias("null_props")), 4)


@register("csv_roundtrip_rows")
def q_csv_roundtrip_rows(spark, sf):
    """The round trip compared row by row: rows of the source, and how many of them were lost, or added, on the way
    (rows that differ in any column count as both; repeated rows count each time)."""
    ev, back = _csv_and_back(spark, sf)
    both = ev.withColumn("d", F.lit(1)).unionByName(back.select(ev.columns).withColumn("d", F.lit(-1)))
    rows = both.groupBy(*ev.columns).agg(F.sum("d").alias("d"), F.count_if(F.col("d") == 1).alias("n"))
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("lost"),
                    F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("added"))


@register("stream_score")
def q_stream_score(spark, sf):
    """ST1: the events file streamed through stateless scoring (risk tier), then tier counts."""
    from riskspark.operators.score import risk_tier
    from riskspark.streaming.stream import score_stream

    def scorer(df):
        s = df.withColumn("score", F.col("value") / 100.0)
        return s.withColumn("tier", risk_tier("score", 0.5))

    out = score_stream(spark, sf, EVENTS_SCHEMA, scorer, glob="events.parquet")
    return round_all(out.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("avg_score")), 6)


@register("stream_window_drift")
def q_stream_window_drift(spark, sf):
    """ST2: daily windows of the events stream (watermark 1 day) against the first week."""
    from riskspark.streaming.stream import window_drift

    base = table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    res = window_drift(spark, sf, EVENTS_SCHEMA, "ts", "event_type", base, glob="events.parquet")
    return round_all(res.select(F.to_date("window_start").alias("window_start"), "feature", "statistic", "dof",
                                "p_value", "drift_detected"), 6)


@register("stream_window_ks")
def q_stream_window_ks(spark, sf):
    """ST2 numeric: KS of ``value`` per daily window of the events stream against the first week."""
    from riskspark.streaming.stream import window_ks

    base = table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    res = window_ks(spark, sf, EVENTS_SCHEMA, "ts", "value", base, glob="events.parquet")
    return round_all(res.select(F.to_date("window_start").alias("window_start"), "feature", "statistic", F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur")), 6)
