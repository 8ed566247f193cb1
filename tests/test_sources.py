import datetime as dt

import pytest
from helpers import at, panel
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.sources import csv, tables


def test_csv_keeps_stamps_and_nulls(spark, tmp_path):
    rows = [(dt.datetime(2024, 3, 31, 2, 30, 0, 123456), 1, 2.5), (at(1), None, None)]
    df = panel(spark, rows, "ts timestamp_ntz, n int, v double")
    path = str(tmp_path / "t.csv")
    csv.write_csv(df, path)
    assert csv.read_csv(spark, path, df.schema).orderBy("ts").collect() == df.orderBy("ts").collect()


def test_nan_is_missing(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("ts,v\n2024-01-01T00:00:00.000000,NaN\n2024-01-01T01:00:00.000000,2.0\n")
    df = csv.read_csv(spark, str(path), "ts timestamp_ntz, v double")
    assert df.agg(F.avg("v")).first()[0] == 2.0


def test_hourly_input_format(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        "datetime,season,holiday,workingday,weather,temp,atemp,humidity,windspeed,casual,registered,count\n"
        "2011-01-01 00:00:00,1,0,0,1,9.84,14.395,81,0.0,3,13,16\n"
    )
    row = csv.read_hourly_csv(spark, str(path)).first()
    assert (row.datetime, row.temp, row["count"]) == (dt.datetime(2011, 1, 1), 9.84, 16)


def test_an_existing_table_is_left_alone_unless_overwritten(spark, tmp_path):
    one, two = (spark.range(n) for n in (1, 2))
    for write, read in ((csv.write_csv, spark.read.option("header", True).csv), (tables.write_table, spark.read.parquet)):
        path = str(tmp_path / write.__name__)
        write(one, path)
        write(two, path, overwrite=False)
        assert read(path).count() == 1
        write(two, path, overwrite=True)
        assert read(path).count() == 2


def test_rewriting_one_model_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "predictions")
    schema = "model string, k string, ts timestamp_ntz, segment string, log_pred double"
    tables.write_predictions(panel(spark, [("m", "a", at(0), "s", 1.0), ("n", "a", at(0), "s", 2.0)], schema), path)
    tables.write_predictions(panel(spark, [("m", "a", at(0), "s", 5.0)], schema), path)
    got = {r.model: r.log_pred for r in tables.read_predictions(spark, path).collect()}
    assert got == {"m": 5.0, "n": 2.0}
    assert tables.read_predictions(spark, path, ["n"]).count() == 1


def test_wide_prediction_files_align_by_outer_join(spark, tmp_path):
    for model, hours in (("rf", [0, 1]), ("gb", [1, 2])):
        df = panel(spark, [(at(h), float(h)) for h in hours], f"ts timestamp_ntz, log_s_{model}_pred double")
        csv.write_csv(df, str(tmp_path / model))
    paths = {m: str(tmp_path / m) for m in ("rf", "gb")}
    rows = tables.read_wide_predictions(spark, paths, [], "ts", ["s"]).orderBy("ts").collect()
    assert [(r.log_s_rf_pred, r.log_s_gb_pred) for r in rows] == [(0.0, None), (1.0, 1.0), (None, 2.0)]


def test_submission_header(spark, tmp_path):
    path = str(tmp_path / "submit")
    tables.write_submission(panel(spark, [(at(0), 4)], "ts timestamp_ntz, count_pred int"), path, ["ts"], "count_pred")
    assert spark.read.option("header", True).csv(path).columns == ["ts", "count"]


def test_stages_are_read_back_and_dropped(spark):
    df = session.stage(spark.range(5).toDF("id"), "numbers")
    assert df.count() == 5
    path = session._STAGED[-1]
    assert session.drop_stages(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
