"""Sources and sinks: SQL file runner, CSV null tokens, metadata JSON, metrics report, optional input."""
import json


from riskspark.operators import features as W
from riskspark.sources import io as IO


def test_sql_text_titles_and_errors_per_statement(spark):
    spark.createDataFrame([(1, 1), (2, 0)], "k int, y int").createOrReplaceTempView("t_io")
    text = "-- First report\nSELECT k FROM t_io;\n\n;-- Broken\nSELECT nope FROM missing_table;\nSELECT COUNT(*) AS n FROM t_io"
    res = IO.run_sql_text(spark, text)
    assert [t for t, _ in res] == ["First report", "Broken", "Query 3"]
    assert isinstance(res[1][1], Exception)
    assert res[2][1].first()["n"] == 2


def test_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("a,b\n1,NA\n2,x\n3,\n")
    df = IO.read_csv(spark, str(p), "a int, b string")
    assert [r["b"] for r in df.orderBy("a").collect()] == [None, "x", None]


def test_metadata_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 10.0), (3.0, 30.0)], "a double, b double")
    params = W.fit_scaler(df, ["a", "b"])
    meta = IO.metadata_frame(spark, ["a", "b"], ["a", "b"], [], params, tuned=0.3)
    IO.write_metadata(meta, str(tmp_path / "meta"))
    back = IO.read_metadata(spark, str(tmp_path / "meta"))
    r = back.first()
    assert r["tuned_threshold"] == 0.3 and r["feature_names"] == ["a", "b"]
    tab = {x["feature"]: (x["mean"], x["scale"]) for x in IO.scaling_table(back).collect()}
    assert tab == {"a": (2.0, 1.0), "b": (20.0, 10.0)}


def test_metrics_report_and_optional_input(spark, tmp_path):
    p = tmp_path / "metrics.json"
    p.write_text(json.dumps({"logistic_regression": {"accuracy": 0.87, "roc_auc": 0.82},
                             "xgboost": {"accuracy": 0.84, "roc_auc": 0.80}}))
    long = IO.read_metrics_report(spark, str(p))
    got = {(r["model"], r["metric"]): float(r["value"]) for r in long.collect()}
    assert got[("xgboost", "roc_auc")] == 0.80 and len(got) == 4
    assert IO.optional_frame(spark, str(tmp_path / "absent"), spark.read.parquet, default=None) is None


def test_records_to_frame(spark):
    df = IO.frame_from_records(spark, [{"Age": 30}, {"Age": 41, "Gender": "Female"}], "Age int, Gender string")
    assert [r["Gender"] for r in df.orderBy("Age").collect()] == [None, "Female"]


def test_csv_round_trip_writes_all_columns_and_sees_a_changed_one(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from riskspark.plans import io_queries as Q

    rows = [(1, datetime(2024, 1, 2, 3, 4, 5, 678901), 7, "a,b", 0.1, '{"k": "v \\"q\\""}'), (2, None, None, None, None, None),
            (1, datetime(2024, 1, 2, 3, 4, 5, 678901), 7, "a,b", 0.1, '{"k": "v \\"q\\""}')]
    spark.createDataFrame(rows, Q.EVENTS_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    assert Q.q_csv_roundtrip_rows(spark, str(tmp_path)).first().asDict() == {"n": 3, "lost": 0, "added": 0}
    ev, back = Q._csv_and_back(spark, str(tmp_path))
    assert sorted(back.columns) == sorted(ev.columns)
    real = IO.write_table
    monkeypatch.setattr(IO, "write_table", lambda df, *a, **k: real(df.withColumn("user_id", df.user_id + 1), *a, **k))
    assert Q.q_csv_roundtrip_rows(spark, str(tmp_path)).first().asDict() == {"n": 3, "lost": 2, "added": 2}


def test_statements_are_run_under_their_own_guard(spark, tmp_path):
    from riskspark.sources import io as IO

    spark.range(10).createOrReplaceTempView("ten")
    text = "-- a\nSELECT id, id AS id FROM ten ORDER BY id DESC; -- b\nSELECT 1 / (id - id) FROM ten; CREATE OR REPLACE TEMP VIEW five AS SELECT * FROM ten WHERE id < 5; SELECT COUNT(*) AS n FROM five"
    got = IO.run_sql_text(spark, text)
    assert [r[0] for r in got[0][1].collect()] == list(range(9, -1, -1)) and got[0][1].columns == ["id", "id"]
    assert IO.error_class(got[1][1]) == "DIVIDE_BY_ZERO" and got[2][1].columns == [] and got[3][1].first().n == 5
    lazy = IO.run_sql_text(spark, text, execute=False)
    assert not isinstance(lazy[1][1], Exception) and IO.error_class(ValueError("x")) == "ValueError"


def test_json_report(spark, tmp_path):
    from riskspark.sources import io as IO

    df = spark.createDataFrame([("a", 1.5, None), ("b", None, [1, 2])], "k string, x double, l array<int>")
    IO.write_json_report(df, str(tmp_path / "r"))
    assert sorted(spark.read.schema(df.schema).json(str(tmp_path / "r")).collect(), key=str) == sorted(df.collect(), key=str)
