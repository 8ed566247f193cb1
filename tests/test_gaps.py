import datetime as dt
import random

import pytest
from helpers import at, column, panel, random_series
from pyspark.sql import functions as F

from seriesloom.operators import calendar as cal
from seriesloom.operators import gaps, grid, lags
from seriesloom.plans import forecast
from seriesloom.plans.spec import PanelSpec

SERIES = "k string, ts timestamp_ntz, v double"


def filled(spark, rows, **kw):
    df = panel(spark, [("a", t, v) for t, v in rows], SERIES)
    return column(gaps.interpolate_time(df, ["k"], "ts", ["v"], **kw), "v")


def test_inner_gap_is_linear(spark):
    rows = [(at(0), 1.0), (at(1), None), (at(2), None), (at(3), 4.0)]
    assert filled(spark, rows) == [1.0, 2.0, 3.0, 4.0]


def test_position_does_not_count_time_does(spark):
    assert filled(spark, [(at(0), 0.0), (at(0.5), None), (at(2), 4.0)]) == [0.0, 1.0, 4.0]


def test_trailing_gap_holds_and_leading_gap_stays(spark):
    rows = [(at(0), None), (at(1), 7.0), (at(2), 5.0), (at(3), None), (at(4), None)]
    assert filled(spark, rows) == [None, 7.0, 5.0, 5.0, 5.0]


def test_ordinals_round_half_to_even(spark):
    rows = [(at(0), 0.0), (at(1), None), (at(2), 1.0), (at(3), None), (at(4), 2.0), (at(5), None), (at(6), 3.0)]
    assert filled(spark, rows, ordinals=["v"]) == [0, 0, 1, 2, 2, 2, 3]


@pytest.mark.parametrize("chunk", ["day", "week"])
def test_chunked_fill_equals_the_plain_one(spark, chunk):
    df = panel(spark, random_series(24 * 20, seed=3, keep=0.05), SERIES)
    for fill in (gaps.interpolate_time, gaps.forward_fill, gaps.back_fill):
        plain = column(fill(df, ["k"], "ts", ["v"]), "v")
        assert column(fill(df, ["k"], "ts", ["v"], chunk=chunk), "v") == plain


def test_a_missing_last_hour_keeps_the_flag_of_its_day(spark):
    friday = [("a", at(24 * 4 + h), 1 if h < 23 else None) for h in range(24)]
    saturday = [("a", at(24 * 5 + h), 0) for h in range(24)]
    df = panel(spark, friday + saturday, "k string, ts timestamp_ntz, v int")
    assert column(gaps.back_fill(df, ["k"], "ts", ["v"]), "v")[23] == 1
    assert column(gaps.back_fill(df, ["k"], "ts", ["v"], mode="plain"), "v")[23] == 0


def test_a_wholly_missing_day_takes_the_next_flag(spark):
    rows = [("a", at(0), 1), ("a", at(24), None), ("a", at(47), None), ("a", at(48), 0)]
    df = panel(spark, rows, "k string, ts timestamp_ntz, v int")
    assert column(gaps.back_fill(df, ["k"], "ts", ["v"]), "v") == [1, 0, 0, 0]


def test_fused_grid_and_repair_equal_the_single_steps(spark):
    rows = []
    for key, seed in (("a", 1), ("b", 2), ("c", 5)):
        for i, (_, ts, v) in enumerate(random_series(24 * 9, seed, keep=0.3)):
            if v is None and i not in (0, 24 * 9 - 1):
                continue
            level = None if v is not None and v % 3 == 0 else v
            rows.append((key, ts, level, int(v) if v is not None else None, int(ts.weekday() < 5), v))
    df = panel(spark, rows, "k string, ts timestamp_ntz, lin double, ord int, flag int, y double")
    steps = grid.flag_bad_days(grid.regular_grid(df, ["k"], "ts"), ["k"], "ts", "ord", 18)
    steps = gaps.repair(steps, ["k"], "ts", ["lin"], ["ord"], ["flag"])
    steps = gaps.interpolate_time(steps.withColumn("y2", F.col("y")), ["k"], "ts", ["y2"])
    fused = gaps.fill_grid(df, ["k"], "ts", ["lin"], ["ord"], ["flag"], "ord", 18, also={"y": "y2"})
    order = ["k", "ts", "lin", "ord", "flag", "y", "y2", "bad_day"]
    assert fused.select(order).orderBy("k", "ts").collect() == steps.select(order).orderBy("k", "ts").collect()


def test_fused_repair_flags_days_by_their_missing_hours(spark):
    missing = {1: 2, 2: 3}
    rows = [
        ("a", at(24 * d + h), 1.0, 1)
        for d in range(4)
        for h in range(24)
        if not 5 <= h < 5 + missing.get(d, 0)
    ]
    df = panel(spark, rows, "k string, ts timestamp_ntz, v double, flag int")
    out = gaps.fill_grid(df, ["k"], "ts", ["v"], [], ["flag"], probe="v")
    by_day = {r.day: r.bad for r in out.groupBy(F.to_date("ts").alias("day")).agg(F.max("bad_day").alias("bad")).collect()}
    assert by_day == {dt.date(2024, 1, 1 + d): int(d == 2) for d in range(4)}
    assert out.count() == 96


def test_unknown_mode_is_refused(spark):
    df = panel(spark, [("a", at(0), 1.0)], SERIES)
    with pytest.raises(ValueError):
        gaps.back_fill(df, ["k"], "ts", ["v"], mode="sideways")


def _panel_with_gaps(spark):
    """Hours of some users with gaps of hours and days, missing values, and flags that differ within a day."""
    rng = random.Random(5)
    rows = []
    for user in (1, 2, 3, None):
        for h in range(24 * 40):
            if rng.random() < (0.02 if user == 3 else 0.15) and not (user == 2 and 200 < h < 420):
                stamp = dt.datetime(2024, 1, 3) + dt.timedelta(hours=h)
                test = stamp.day > 19
                kind = rng.choice([1, 1, 0, None]) if user == 1 else int(stamp.weekday() < 5)
                value = lambda: rng.choice([None, rng.random() * 100])
                count = None if test else rng.randrange(5)
                rows.append((user, stamp, count, count, count, value(), value(), value(), rng.choice([None, 0, 1]), rng.choice([None, 3, 4]), kind, 0, int(test), 1 if test else None))
    schema = "user_id long, ts timestamp_ntz, casual long, registered long, count long, temp double, atemp double, windspeed double, weather int, humidity int, workingday int, holiday int, data_set int, submit int"
    return spark.createDataFrame(rows, schema)


def test_features_by_spans_equal_those_of_the_grid(spark):
    """Asked hours and days get the values of the complete grid, which is not made for them."""
    spec = PanelSpec(["user_id"], max_missing=23, base_year=2024, overrides={dt.date(2024, 1, 15): {"workingday": 0, "holiday": 1}})
    tagged = _panel_with_gaps(spark)
    lagged = spec.lags | {"registered_filled": [24]}
    hours = forecast.repair(tagged, spec)
    grid_made = cal.add_date_parts(cal.add_log_targets(hours, spec.counts), "ts", 2024)
    grid_made = cal.offday_run_length(lags.clock_lag(grid_made, ["user_id"], "ts", lagged), ["user_id"], "ts")
    asked = forecast.asked_features(tagged, spec, lagged)
    names = asked.columns
    key = lambda r: (r["user_id"] is None, r["user_id"] or 0, r["ts"])
    expected = sorted(forecast.asked_rows(grid_made, spec).select(names).collect(), key=key)
    assert sorted(asked.collect(), key=key) == expected
    assert sum(r["temp_24h_ago"] is not None for r in expected) > 100
    days = forecast.day_features(tagged, spec)
    assert sorted(days.collect(), key=key) == sorted(grid_made.select(days.columns).collect(), key=key)


def test_spans_are_far_fewer_than_hours(spark):
    tagged = _panel_with_gaps(spark).where("user_id = 3")
    spread = gaps.spans(gaps.lines(tagged, ["user_id"], "ts", ["temp"], [], ["holiday"], "temp"), ["user_id"], "ts", ["holiday"])
    hours = gaps.fill_spans(spread, "ts", ["temp"], [])
    assert spread.count() * 5 < hours.count() == grid.regular_grid(tagged, ["user_id"], "ts").count()
