import datetime as dt

import pytest
from helpers import at, column, panel
from pyspark.sql import functions as F

from seriesloom.functions.scalars import fold_label, to_count
from seriesloom.operators import calendar as cal
from seriesloom.operators import gaps, grid, lags, trend

SERIES = "k string, ts timestamp_ntz, v double"


def hourly(spark, values, key="a"):
    return panel(spark, [(key, at(h), v) for h, v in enumerate(values)], SERIES)


def test_both_grids_fill_the_span_of_each_series(spark):
    rows = [("a", at(0), 1.0), ("a", at(30), 2.0), ("b", at(5), 3.0)]
    df = panel(spark, rows, SERIES)
    by_window = grid.regular_grid(df, ["k"], "ts").orderBy("k", "ts").collect()
    by_join = grid.spine_grid(df, ["k"], "ts").select("k", "ts", "v").orderBy("k", "ts").collect()
    assert by_window == by_join
    assert len(by_window) == 32 and sum(r.v is not None for r in by_window) == 3


def test_bad_day_threshold_is_exclusive(spark):
    rows = [("a", at(24 * d + h), 1.0) for d in range(3) for h in range(24) if h >= d + 1 or d == 0]
    full = grid.regular_grid(panel(spark, rows, SERIES), ["k"], "ts")
    days = {r.day.day: (r.missing, r.bad_day) for r in grid.missing_by_day(full, ["k"], "ts", "v").collect()}
    assert days == {2: (2, 0), 3: (3, 1)}
    flags = grid.flag_bad_days(full, ["k"], "ts", "v").groupBy(F.to_date("ts")).agg(F.sum("bad_day")).collect()
    assert sorted(r[1] for r in flags) == [0, 0, 24]


def test_an_empty_day_sums_to_null(spark):
    df = hourly(spark, [1.0] * 24 + [None] * 24)
    sums = {r.day.day: r.v for r in grid.daily_rollup(df, ["k"], "ts", ["v"], []).collect()}
    assert sums == {1: 24.0, 2: None}


def run_days(spark, off_days, days, chunk=None):
    rows = [("a", at(24 * d + h), 0 if d in off_days else 1) for d in range(days) for h in range(24)]
    df = panel(spark, rows, "k string, ts timestamp_ntz, workingday int")
    out = cal.offday_run_length(df, ["k"], "ts", chunk=chunk)
    return [column(out, "weekend")[24 * d] for d in range(days)]


@pytest.mark.parametrize("chunk", [None, "day", "week"])
def test_off_day_runs(spark, chunk):
    # Jan 1 2024 is a Monday: a lone holiday, a weekend, a long weekend, an open end.
    off = {2, 5, 6, 11, 12, 13, 18}
    assert run_days(spark, off, 19, chunk) == [0, 0, 1, 0, 0, 2, 2, 0, 0, 0, 0, 3, 3, 3, 0, 0, 0, 0, 1]


def test_a_run_may_open_the_series(spark):
    assert run_days(spark, {0, 1}, 4) == [2, 2, 0, 0]


def test_overrides_touch_all_hours_of_their_day_only(spark):
    rows = [("a", at(h), 1, 0) for h in range(72)]
    df = panel(spark, rows, "k string, ts timestamp_ntz, workingday int, holiday int")
    out = cal.override_flags(df, "ts", {dt.date(2024, 1, 2): {"workingday": 0, "holiday": 1}})
    assert column(out, "workingday") == [1] * 24 + [0] * 24 + [1] * 24
    assert column(out, "holiday") == [0] * 24 + [1] * 24 + [0] * 24
    assert out.schema == df.schema


@pytest.mark.parametrize("chunk", ["day", "week"])
def test_chunked_lags_equal_plain_ones(spark, chunk):
    df = hourly(spark, [float(h) for h in range(24 * 9)])
    plain = lags.clock_lag(df, ["k"], "ts", {"v": [1, 24]})
    chunked = lags.clock_lag(df, ["k"], "ts", {"v": [1, 24]}, chunk=chunk)
    assert plain.orderBy("ts").collect() == chunked.select(plain.columns).orderBy("ts").collect()


def test_a_chunk_shorter_than_the_lag_is_refused(spark):
    with pytest.raises(ValueError):
        lags.clock_lag(hourly(spark, [1.0]), ["k"], "ts", {"v": [25]}, chunk="day")


def test_sparse_lags_go_by_the_clock(spark):
    rows = [("a", at(0), 1.0), ("a", at(1), 2.0), ("a", at(24), 3.0), ("a", at(25), 4.0)]
    out = lags.clock_lag_sparse(panel(spark, rows, SERIES), ["k"], "ts", {"v": [1, 24]})
    assert column(out, "v_01h_ago") == [None, 1.0, None, 3.0]
    assert column(out, "v_24h_ago") == [None, None, 1.0, 2.0]


def test_a_day_absent_from_the_daily_side_inherits_the_last(spark):
    days = [("a", dt.date(2024, 1, 1), 10.0), ("a", dt.date(2024, 1, 3), 30.0)]
    daily = panel(spark, days, "k string, day date, total double")
    out = trend.daily_to_hourly(hourly(spark, [0.0] * 96), daily, ["k"], "ts", ["total"])
    assert column(out, "total") == [10.0] * 48 + [30.0] * 48


def test_a_day_known_only_to_the_daily_side_still_counts(spark):
    daily = panel(spark, [("a", dt.date(2023, 12, 31), 5.0)], "k string, day date, total double")
    out = trend.daily_to_hourly(hourly(spark, [0.0] * 3), daily, ["k"], "ts", ["total"])
    assert column(out, "total") == [5.0] * 3


def test_daily_lag_back_fills_its_first_day(spark):
    rows = [("a", dt.date(2024, 1, d), float(d)) for d in (1, 2, 3)]
    df = panel(spark, rows, "k string, day date, v double")
    assert column(lags.daily_lag(df, ["k"], "day", ["v"]), "v_1d_ago", "day") == [1.0, 1.0, 2.0]


def test_fold_labels(spark):
    df = spark.range(1, 32).select(F.make_date(F.lit(2024), F.lit(1), F.col("id").cast("int")).alias("ts"))
    assert column(df.withColumn("f", fold_label("ts")), "f") == [0] * 5 + [-1] * 9 + [1] * 5 + [None] * 12


def test_rounding_to_counts(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (2.9,)], "v double")
    assert [r[0] for r in df.select(to_count("v")).collect()] == [0, 2, 2, 3]
    assert [r[0] for r in df.select(to_count("v", "truncate")).collect()] == [0, 1, 2, 2]


@pytest.mark.parametrize("hours, told", [([0, 1.5, 3], "off the step"), ([0, 1, 1, 2], "repeated stamp"), ([0, 2, 2.25], "off the step")])
def test_stamps_off_the_step_are_refused_by_name(spark, hours, told):
    """A half hour would leave the hours around it out; a repeated one would be a row of its own."""
    rows = [("fine", at(h), 1.0, 1) for h in range(3)] + [("odd one", at(h), 1.0, 1) for h in hours]
    df = panel(spark, rows, "k string, ts timestamp_ntz, v double, f int")
    for made in (grid.regular_grid(df, ["k"], "ts"), gaps.fill_grid(df, ["k"], "ts", ["v"], [], ["f"], "v")):
        with pytest.raises(Exception, match=f"{told}.*k=odd one"):
            made.collect()
    assert grid.regular_grid(df.where("k = 'fine'"), ["k"], "ts").count() == 3
