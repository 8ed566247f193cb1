"""Queries on reading, gridding, repairing and describing the panel."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from queries import fixtures as fx
from queries import sql
from seriesloom.functions.scalars import day_of, fold_label
from seriesloom.operators import calendar as cal
from seriesloom.operators import gaps, grid, lags
from seriesloom.session import scratch_path, stage
from seriesloom.sources.csv import read_csv, write_csv

KEYS, TS = fx.KEYS, fx.TS
VALUE_COLUMNS = "registered, casual, count, weather, temp, atemp, humidity, windspeed"


def csv_roundtrip(spark, sf_dir):
    """The tagged table through a CSV file and back, by declared schema."""
    df = fx.tagged(spark, sf_dir)
    path = scratch_path(spark, "csv")
    write_csv(df, path, overwrite=False)
    return read_csv(spark, path, df.schema)


def tagged_union(spark, sf_dir):
    return fx.tagged_parts(spark, sf_dir)


def train_test_split_by_tag(spark, sf_dir):
    """Training rows, and test rows that are asked for, each with its share of columns."""
    df = fx.tagged(spark, sf_dir)
    train = df.where(F.col("data_set") == 0).select(*KEYS, TS, "registered", "casual")
    test = df.where((F.col("data_set") == 1) & (F.col("submit") == 1)).select(*KEYS, TS)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")), allowMissingColumns=True
    )


def hourly_grid(spark, sf_dir):
    return fx.gridded(spark, sf_dir).select(*KEYS, TS, "registered", "casual", "weather", "temp")


def hourly_grid_by_join(spark, sf_dir):
    """The same grid for few long series: joined onto a spine."""
    return fx.by_type_grid(spark, sf_dir)


def calendar_spine(spark, sf_dir):
    """All hours between a user's first and last event."""
    events = fx.table(spark, sf_dir, "events")
    hours = grid.hourly_buckets(events, KEYS, TS, [F.count(F.lit(1)).alias("n")])
    return grid.spine(hours, KEYS, TS)


def missing_by_day(spark, sf_dir):
    return grid.missing_by_day(fx.gridded(spark, sf_dir), KEYS, TS, "weather", fx.MAX_MISSING)


def bad_day_flag(spark, sf_dir):
    df = grid.flag_bad_days(fx.gridded(spark, sf_dir), KEYS, TS, "weather", fx.MAX_MISSING)
    return df.select(*KEYS, TS, "bad_day")


def bad_day_mask(spark, sf_dir):
    """Daily sums and means with bad days blanked."""
    marked = grid.flag_bad_days(fx.gridded(spark, sf_dir), KEYS, TS, "weather", fx.MAX_MISSING)
    day = grid.daily_rollup(marked, KEYS, TS, ["registered", "casual"], ["temp", "bad_day"])
    masked = grid.null_where(day, F.col("bad_day") == 1, ["registered", "casual", "temp"])
    return masked.withColumn("temp", F.round("temp", 6))


def interpolate_time(spark, sf_dir):
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS, *fx.LINEAR)
    return gaps.interpolate_time(df, KEYS, TS, fx.LINEAR)


def interpolate_ordinal(spark, sf_dir):
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS, *fx.ORDINALS)
    return gaps.interpolate_time(df, KEYS, TS, fx.ORDINALS, ordinals=fx.ORDINALS)


def interpolate_time_chunked(spark, sf_dir):
    """Interpolation of few series, each split by day over many tasks."""
    df = fx.by_type_grid(spark, sf_dir).select("event_type", TS, "level")
    return gaps.interpolate_time(df, ["event_type"], TS, ["level"], chunk="day")


def backfill(spark, sf_dir):
    """Flags from the same day first, and from the next row whatever its day."""
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS, "workingday", "data_set")
    df = df.withColumns({"workingday_plain": F.col("workingday"), "data_set_plain": F.col("data_set")})
    same = gaps.back_fill(df, KEYS, TS, ["workingday", "data_set"])
    return gaps.back_fill(same, KEYS, TS, ["workingday_plain", "data_set_plain"], mode="plain")


def forward_fill(spark, sf_dir):
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS, "temp", "atemp")
    return gaps.forward_fill(df, KEYS, TS, ["temp", "atemp"])


def forward_fill_chunked(spark, sf_dir):
    df = fx.by_type_grid(spark, sf_dir).select("event_type", TS, "n", "level")
    return gaps.forward_fill(df, ["event_type"], TS, ["n", "level"], chunk="day")


def grid_repair(spark, sf_dir):
    """Grid, bad days, interpolation and flags in one pass over the observed rows."""
    cols = [*fx.LINEAR, *fx.ORDINALS, *fx.FLAGS]
    return fx.clean(spark, sf_dir).select(*KEYS, TS, "registered", "registered_filled", "bad_day", *cols)


def calendar_override(spark, sf_dir):
    df = fx.tagged(spark, sf_dir).select(*KEYS, TS, "workingday", "holiday")
    return cal.override_flags(df, TS, fx.OVERRIDES)


def date_parts(spark, sf_dir):
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS)
    return cal.add_date_parts(df, TS, fx.BASE_YEAR)


def log_targets(spark, sf_dir):
    df = cal.add_log_targets(fx.tagged(spark, sf_dir), fx.COUNTS)
    return df.select(*KEYS, TS, *[F.round(f"log_{c}", 6).alias(f"log_{c}") for c in fx.COUNTS])


def clock_lag(spark, sf_dir):
    cols = list(fx.LAGS)
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS, *cols)
    return lags.clock_lag(df, KEYS, TS, fx.LAGS).drop(*cols)


def clock_lag_sparse(spark, sf_dir):
    """Lags by clock on the observed rows alone, without a grid."""
    df = fx.tagged(spark, sf_dir).select(*KEYS, TS, "temp", "weather")
    return lags.clock_lag_sparse(df, KEYS, TS, {"temp": [1, 24], "weather": [24]})


def clock_lag_chunked(spark, sf_dir):
    df = fx.by_type_grid(spark, sf_dir).select("event_type", TS, "level", "n")
    return lags.clock_lag(df, ["event_type"], TS, {"level": [7, 24], "n": [1]}, chunk="week")


def lag_fanout(spark, sf_dir):
    df = fx.gridded(spark, sf_dir).select(*KEYS, TS, "temp")
    return lags.lag_fan_out(df, KEYS, TS, "temp")


def offday_run_length(spark, sf_dir):
    df = fx.clean(spark, sf_dir).select(*KEYS, TS, "workingday")
    return cal.offday_run_length(df, KEYS, TS)


def offday_run_length_chunked(spark, sf_dir):
    df = fx.by_type_grid(spark, sf_dir).select("event_type", TS)
    df = df.withColumn("workingday", (F.weekday(TS) < 5).cast("int"))
    df = cal.override_flags(df, TS, {d: {"workingday": f["workingday"]} for d, f in fx.OVERRIDES.items()})
    return cal.offday_run_length(df, ["event_type"], TS, chunk="day")


def feature_projection(spark, sf_dir):
    """Feature columns by name: a subset, and a drop of bookkeeping columns."""
    df = fx.tagged(spark, sf_dir).drop("submit", "data_set", "holiday")
    return df.select(*KEYS, TS, *fx.WEATHER, "workingday")


def complete_cases(spark, sf_dir):
    """Training rows without any missing value; ``submit`` is dropped first,
    because it is missing on every training row."""
    df = fx.clean(spark, sf_dir).where(F.col("data_set") == 0).drop("submit")
    return df.na.drop().select(*KEYS, TS, "registered", "casual", *fx.WEATHER)


def panel_counts(spark, sf_dir):
    """What a run reports: slots, missing ones and the days they are on, bad days, training samples and features.

    The first four are counted while the days are written, the samples while the rows pass."""
    slots, rows = Observation("slots"), Observation("rows")
    seen = fx.gridded(spark, sf_dir).observe(slots, F.count(F.lit(1)).alias("slots"), F.count_if(F.col("weather").isNull()).alias("missing"))
    days = grid.missing_by_day(seen, KEYS, TS, "weather", fx.MAX_MISSING)
    bad = stage(days.observe(rows, F.count(F.lit(1)).alias("days"), F.sum("bad_day").alias("bad_days")), "missing-days")
    samples, passed = Observation("samples"), complete_cases(spark, sf_dir)
    stage(passed.observe(samples, F.count(F.lit(1)).alias("samples")), "samples")
    features = len([c for c in passed.columns if c not in (*KEYS, TS, "registered", "casual")])
    counted = (slots.get["slots"], slots.get["missing"], rows.get["days"], rows.get["bad_days"] or 0, samples.get["samples"], features)
    return bad.sparkSession.createDataFrame([counted], "slots long, missing long, missing_days long, bad_days long, samples long, features int")


def fold_assign(spark, sf_dir):
    df = fx.tagged(spark, sf_dir).select(*KEYS, TS)
    return df.withColumn("fold", fold_label(TS))


def holdout_mask(spark, sf_dir):
    """Daily counts; those of the test part are hidden."""
    events = fx.table(spark, sf_dir, "events")
    hours = fx.observed(events)
    day = hours.groupBy(*KEYS, day_of(TS).alias("day")).agg(
        *[F.sum(c).alias(c) for c in fx.COUNTS]
    )
    return grid.null_where(day, fx.held_out("day"), fx.COUNTS)


QUERIES = {
    f.__name__: f
    for f in (
        csv_roundtrip, tagged_union, train_test_split_by_tag, hourly_grid, hourly_grid_by_join,
        calendar_spine, missing_by_day, bad_day_flag, bad_day_mask, interpolate_time,
        interpolate_ordinal, interpolate_time_chunked, backfill, forward_fill,
        forward_fill_chunked, grid_repair, calendar_override, date_parts, log_targets, clock_lag,
        clock_lag_sparse, clock_lag_chunked, lag_fanout, offday_run_length,
        offday_run_length_chunked, feature_projection, complete_cases, fold_assign, holdout_mask, panel_counts,
    )
}

_TAGGED_COLS = f"user_id, ts, {VALUE_COLUMNS}, workingday, holiday, data_set, submit"
_LAG_SELECT = ", ".join(
    f"lag({c}, {k}) OVER w AS {c}_{k:02d}h_ago" for c, ks in fx.LAGS.items() for k in ks
)
_FAN_SELECT = ", ".join(f"lag(temp, {k}) OVER w AS temp_{k:02d}h_ago" for k in range(1, 25))


def _near(cols, source="gridded", key="user_id"):
    return f"near_rows AS (SELECT *, {sql.neighbours(cols, key, 'ts')} FROM {source})"


def _filled(cols, expr):
    return ", ".join(f"{expr(c, 'ts')} AS {c}" for c in cols)


ORACLES = {
    "csv_roundtrip": sql.panel(sql.TAGGED, f"SELECT {_TAGGED_COLS} FROM tagged"),
    "tagged_union": sql.panel(sql.TAGGED, f"SELECT {_TAGGED_COLS} FROM tagged"),
    "train_test_split_by_tag": sql.panel(
        sql.TAGGED,
        """SELECT user_id, ts, registered, casual, 'train' AS part FROM tagged WHERE data_set = 0
UNION ALL SELECT user_id, ts, NULL, NULL, 'test' FROM tagged WHERE data_set = 1 AND submit = 1""",
    ),
    "hourly_grid": sql.panel(sql.GRID, "SELECT user_id, ts, registered, casual, weather, temp FROM gridded"),
    "hourly_grid_by_join": sql.types("SELECT event_type, ts, n, level, workingday FROM by_type_grid"),
    "calendar_spine": """SELECT user_id, unnest(generate_series(min(date_trunc('hour', ts)),
  max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS ts FROM events GROUP BY user_id""",
    "missing_by_day": sql.panel(
        sql.GRID,
        """SELECT user_id, ts::DATE AS day, count(*) AS missing, (count(*) > 23)::INT AS bad_day
FROM gridded WHERE weather IS NULL GROUP BY 1, 2""",
    ),
    "bad_day_flag": sql.panel(sql.CLEAN, "SELECT user_id, ts, bad_day FROM marked"),
    "bad_day_mask": sql.panel(
        sql.CLEAN,
        """SELECT user_id, ts::DATE AS day, avg(bad_day) AS bad_day,
  CASE WHEN max(bad_day) = 0 THEN sum(registered)::BIGINT END AS registered,
  CASE WHEN max(bad_day) = 0 THEN sum(casual)::BIGINT END AS casual,
  CASE WHEN max(bad_day) = 0 THEN round(avg(temp), 6) END AS temp
FROM marked GROUP BY 1, 2""",
    ),
    "interpolate_time": sql.panel(
        sql.GRID, f"SELECT user_id, ts, {_filled(fx.LINEAR, sql.linear)} FROM near_rows", _near(fx.LINEAR)
    ),
    "interpolate_ordinal": sql.panel(
        sql.GRID, f"SELECT user_id, ts, {_filled(fx.ORDINALS, sql.ordinal)} FROM near_rows", _near(fx.ORDINALS)
    ),
    "interpolate_time_chunked": sql.types(
        f"""SELECT event_type, ts, {sql.linear('level', 'ts')} AS level
FROM (SELECT *, {sql.neighbours(['level'], 'event_type', 'ts')} FROM by_type_grid)"""
    ),
    "backfill": sql.panel(
        sql.GRID,
        f"""SELECT user_id, ts, {_filled(['workingday', 'data_set'], sql.same_day)},
  v1_workingday AS workingday_plain, v1_data_set AS data_set_plain FROM near_rows""",
        _near(["workingday", "data_set"]),
    ),
    "forward_fill": sql.panel(
        sql.GRID,
        """SELECT user_id, ts, last_value(temp IGNORE NULLS) OVER w AS temp,
  last_value(atemp IGNORE NULLS) OVER w AS atemp
FROM gridded WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)""",
    ),
    "forward_fill_chunked": sql.types(
        """SELECT event_type, ts, last_value(n IGNORE NULLS) OVER w AS n,
  last_value(level IGNORE NULLS) OVER w AS level
FROM by_type_grid WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING)"""
    ),
    "grid_repair": sql.panel(
        sql.CLEAN,
        f"""SELECT user_id, ts, registered, bad_day, workingday, holiday, data_set, weather, humidity,
  temp, atemp, windspeed, {sql.linear('registered', 'ts')} AS registered_filled
FROM (SELECT *, {sql.neighbours(['registered'], 'user_id', 'ts')} FROM clean)""",
    ),
    "calendar_override": sql.panel(
        sql.TAGGED,
        """SELECT user_id, ts,
  CASE ts::DATE WHEN DATE '2024-01-15' THEN 0 WHEN DATE '2024-01-20' THEN 1 ELSE workingday END AS workingday,
  CASE ts::DATE WHEN DATE '2024-01-15' THEN 1 WHEN DATE '2024-01-20' THEN 0 ELSE holiday END AS holiday
FROM tagged""",
    ),
    "date_parts": sql.panel(
        sql.GRID,
        """SELECT user_id, ts, (year(ts) - 2024)::INT AS year, month(ts)::INT AS month,
  (isodow(ts) - 1)::INT AS day_of_week, dayofyear(ts)::INT AS day_of_year, hour(ts)::INT AS hour
FROM gridded""",
    ),
    "log_targets": sql.panel(
        sql.TAGGED,
        """SELECT user_id, ts, round(ln(count + 1), 6) AS log_count,
  round(ln(registered + 1), 6) AS log_registered, round(ln(casual + 1), 6) AS log_casual FROM tagged""",
    ),
    "clock_lag": sql.panel(
        sql.GRID,
        f"SELECT user_id, ts, {_LAG_SELECT} FROM gridded WINDOW w AS (PARTITION BY user_id ORDER BY ts)",
    ),
    "clock_lag_sparse": sql.panel(
        sql.TAGGED,
        """SELECT a.user_id, a.ts, a.temp, a.weather, b.temp AS temp_01h_ago, c.temp AS temp_24h_ago,
  c.weather AS weather_24h_ago
FROM tagged a LEFT JOIN tagged b ON a.user_id = b.user_id AND a.ts = b.ts + INTERVAL 1 HOUR
LEFT JOIN tagged c ON a.user_id = c.user_id AND a.ts = c.ts + INTERVAL 24 HOUR""",
    ),
    "clock_lag_chunked": sql.types(
        """SELECT event_type, ts, level, n, lag(level, 7) OVER w AS level_07h_ago,
  lag(level, 24) OVER w AS level_24h_ago, lag(n, 1) OVER w AS n_01h_ago
FROM by_type_grid WINDOW w AS (PARTITION BY event_type ORDER BY ts)"""
    ),
    "lag_fanout": sql.panel(
        sql.GRID,
        f"SELECT user_id, ts, temp, {_FAN_SELECT} FROM gridded WINDOW w AS (PARTITION BY user_id ORDER BY ts)",
    ),
    "offday_run_length": sql.panel(sql.FEATURES, "SELECT user_id, ts, workingday, weekend FROM features"),
    "offday_run_length_chunked": sql.types(
        """SELECT event_type, ts, workingday,
  CASE WHEN workingday = 1 THEN 0 ELSE (count(*) OVER (PARTITION BY event_type, island) // 24) END::INT AS weekend
FROM (SELECT *, sum(turn) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, CASE WHEN workingday = lag(workingday) OVER (PARTITION BY event_type ORDER BY ts)
      THEN 0 ELSE 1 END AS turn
    FROM (SELECT event_type, ts, CASE ts::DATE WHEN DATE '2024-01-15' THEN 0 WHEN DATE '2024-01-20' THEN 1
        ELSE (isodow(ts) <= 5)::INT END AS workingday FROM by_type_grid)))"""
    ),
    "feature_projection": sql.panel(
        sql.TAGGED, "SELECT user_id, ts, atemp, humidity, temp, weather, windspeed, workingday FROM tagged"
    ),
    "complete_cases": sql.panel(
        sql.CLEAN,
        """SELECT user_id, ts, registered, casual, atemp, humidity, temp, weather, windspeed FROM clean
WHERE data_set = 0 AND atemp IS NOT NULL AND humidity IS NOT NULL AND windspeed IS NOT NULL
  AND temp IS NOT NULL AND weather IS NOT NULL AND registered IS NOT NULL AND casual IS NOT NULL""",
    ),
    "panel_counts": sql.panel(
        sql.CLEAN,
        """SELECT (SELECT count(*) FROM gridded) AS slots, sum(n)::BIGINT AS missing, count(*) AS missing_days, (count(*) FILTER (n > 23)) AS bad_days,
  (SELECT count(*) FROM clean WHERE data_set = 0 AND atemp IS NOT NULL AND humidity IS NOT NULL AND windspeed IS NOT NULL
    AND temp IS NOT NULL AND weather IS NOT NULL AND registered IS NOT NULL AND casual IS NOT NULL) AS samples, 5 AS features
FROM (SELECT user_id, ts::DATE AS day, count(*) AS n FROM gridded WHERE weather IS NULL GROUP BY 1, 2)""",
    ),
    "fold_assign": sql.panel(
        sql.TAGGED,
        """SELECT user_id, ts, CASE WHEN day(ts) <= 5 THEN 0 WHEN day(ts) <= 14 THEN -1
  WHEN day(ts) <= 19 THEN 1 END::INT AS fold FROM tagged""",
    ),
    "holdout_mask": sql.panel(
        sql.OBS,
        """SELECT user_id, ts::DATE AS day,
  CASE WHEN day(ts::DATE) <= 19 THEN sum(casual)::BIGINT END AS casual,
  CASE WHEN day(ts::DATE) <= 19 THEN sum(registered)::BIGINT END AS registered,
  CASE WHEN day(ts::DATE) <= 19 THEN sum(count)::BIGINT END AS count
FROM obs GROUP BY 1, 2""",
    ),
}
