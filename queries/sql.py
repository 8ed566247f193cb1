"""DuckDB equivalents of the fixtures, as a chain of common table expressions.

Blocks that several others read are materialised, so that each is computed once.
"""

from __future__ import annotations

COUNTS = ["casual", "registered", "count"]
WEATHER = ["atemp", "humidity", "temp", "weather", "windspeed"]
SEGMENTS = ["registered", "casual"]
LAGS = {
    "atemp": [7, 24],
    "humidity": [11, 24],
    "temp": [24],
    "weather": [1, 24],
    "windspeed": [11, 24],
}


def neighbours(cols: list[str], key: str, ts: str) -> str:
    """Nearest non-missing stamp and value on both sides of each row."""
    before = f"OVER (PARTITION BY {key} ORDER BY {ts} ROWS UNBOUNDED PRECEDING)"
    after = f"OVER (PARTITION BY {key} ORDER BY {ts} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    parts = []
    for c in cols:
        stamp = f"CASE WHEN {c} IS NOT NULL THEN {ts} END"
        parts += [
            f"last_value({stamp} IGNORE NULLS) {before} AS t0_{c}",
            f"last_value({c} IGNORE NULLS) {before} AS v0_{c}",
            f"first_value({stamp} IGNORE NULLS) {after} AS t1_{c}",
            f"first_value({c} IGNORE NULLS) {after} AS v1_{c}",
        ]
    return ", ".join(parts)


def linear(c: str, ts: str) -> str:
    run = f"date_diff('microsecond', t0_{c}::TIMESTAMP, {ts}::TIMESTAMP)::DOUBLE"
    span = f"date_diff('microsecond', t0_{c}::TIMESTAMP, t1_{c}::TIMESTAMP)::DOUBLE"
    return (
        f"CASE WHEN {c} IS NOT NULL THEN {c}::DOUBLE WHEN v0_{c} IS NULL THEN NULL "
        f"WHEN v1_{c} IS NULL THEN v0_{c}::DOUBLE "
        f"ELSE v0_{c}::DOUBLE + (v1_{c}::DOUBLE - v0_{c}::DOUBLE) * {run} / {span} END"
    )


def ordinal(c: str, ts: str) -> str:
    return f"round_even({linear(c, ts)}, 0)::INT"


def same_day(c: str, ts: str) -> str:
    return (
        f"CASE WHEN t1_{c}::DATE = {ts}::DATE THEN v1_{c} "
        f"WHEN t0_{c}::DATE = {ts}::DATE THEN v0_{c} ELSE v1_{c} END"
    )


OBS = """
obs AS MATERIALIZED (
  SELECT user_id, date_trunc('hour', ts) AS ts,
    count(*) FILTER (event_type IN ('purchase', 'signup')) AS registered,
    count(*) FILTER (event_type IN ('click', 'view')) AS casual,
    (count(*) FILTER (event_type = 'error'))::INT AS weather,
    sum(h)::DOUBLE / count(*) AS temp,
    (sum(h) FILTER (event_type = 'click'))::DOUBLE / count(*) FILTER (event_type = 'click') AS atemp,
    round_even((sum(h) FILTER (event_type = 'view'))::DOUBLE
      / count(*) FILTER (event_type = 'view') / 100, 0)::INT AS humidity,
    (sum(h) FILTER (event_type = 'purchase'))::DOUBLE
      / count(*) FILTER (event_type = 'purchase') AS windspeed,
    count(*) FILTER (event_type IN ('purchase', 'signup', 'click', 'view')) AS count
  FROM (SELECT *, round(value * 100)::BIGINT AS h FROM events) GROUP BY 1, 2)"""

TAGGED = """
tagged AS MATERIALIZED (
  SELECT user_id, ts, weather, temp, atemp, humidity, windspeed,
    (isodow(ts) <= 5)::INT AS workingday, 0::INT AS holiday,
    CASE WHEN day(ts) <= 19 THEN registered END AS registered,
    CASE WHEN day(ts) <= 19 THEN casual END AS casual,
    CASE WHEN day(ts) <= 19 THEN count END AS count,
    (day(ts) > 19)::INT AS data_set,
    CASE WHEN day(ts) > 19 THEN 1 END AS submit
  FROM obs)"""

GRID = """
slots AS (
  SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
  FROM tagged GROUP BY user_id),
gridded AS MATERIALIZED (SELECT * FROM slots LEFT JOIN tagged USING (user_id, ts))"""

_FILLED = ["temp", "atemp", "windspeed", "weather", "humidity", "workingday", "holiday", "data_set"]

CLEAN = f"""
marked AS (
  SELECT *, (count(*) FILTER (weather IS NULL) OVER (PARTITION BY user_id, ts::DATE) > 23)::INT AS bad_day
  FROM gridded),
near AS (SELECT *, {neighbours(_FILLED, "user_id", "ts")} FROM marked),
repaired AS (
  SELECT user_id, ts, casual, registered, count, submit, bad_day,
    {", ".join(f"{linear(c, 'ts')} AS {c}" for c in ["temp", "atemp", "windspeed"])},
    {", ".join(f"{ordinal(c, 'ts')} AS {c}" for c in ["weather", "humidity"])},
    {", ".join(f"{same_day(c, 'ts')} AS {c}" for c in ["workingday", "holiday", "data_set"])}
  FROM near),
clean AS MATERIALIZED (
  SELECT * REPLACE (
    CASE ts::DATE WHEN DATE '2024-01-15' THEN 0 WHEN DATE '2024-01-20' THEN 1 ELSE workingday END AS workingday,
    CASE ts::DATE WHEN DATE '2024-01-15' THEN 1 WHEN DATE '2024-01-20' THEN 0 ELSE holiday END AS holiday)
  FROM repaired)"""

_LAG_COLS = ", ".join(
    f"lag({c}, {k}) OVER (PARTITION BY user_id ORDER BY ts) AS {c}_{k:02d}h_ago"
    for c, ks in LAGS.items()
    for k in ks
)

FEATURES = f"""
turns AS (
  SELECT *, CASE WHEN workingday = lag(workingday) OVER (PARTITION BY user_id ORDER BY ts)
    THEN 0 ELSE 1 END AS turn FROM clean),
islands AS (
  SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM turns),
features AS MATERIALIZED (
  SELECT * EXCLUDE (turn, island),
    ln(count + 1) AS log_count, ln(registered + 1) AS log_registered, ln(casual + 1) AS log_casual,
    (year(ts) - 2024)::INT AS year, month(ts)::INT AS month, (isodow(ts) - 1)::INT AS day_of_week,
    dayofyear(ts)::INT AS day_of_year, hour(ts)::INT AS hour, {_LAG_COLS},
    CASE WHEN workingday = 1 THEN 0
      ELSE (count(*) OVER (PARTITION BY user_id, island) // 24) END::INT AS weekend
  FROM islands)"""

_BRIDGED = [*COUNTS, *WEATHER]

DAILY = f"""
hourly_near AS (SELECT *, {neighbours(COUNTS, "user_id", "ts")} FROM features),
hourly_filled AS (
  SELECT * REPLACE ({", ".join(f"{linear(c, 'ts')} AS {c}" for c in COUNTS)}) FROM hourly_near),
rolled AS (
  SELECT user_id, ts::DATE AS day,
    {", ".join(f"sum({c}) AS {c}" for c in COUNTS)},
    {", ".join(f"avg({c}) AS {c}" for c in ["data_set", "workingday", "weekend", "bad_day", "day_of_week", "month", *WEATHER])}
  FROM hourly_filled GROUP BY 1, 2),
masked AS (
  SELECT * REPLACE ({", ".join(f"CASE WHEN bad_day = 1 THEN NULL ELSE {c} END AS {c}" for c in _BRIDGED)})
  FROM rolled),
daily_near AS (SELECT *, {neighbours(_BRIDGED, "user_id", "day")} FROM masked),
daily AS MATERIALIZED (
  SELECT user_id, day, data_set, workingday, weekend, bad_day, day_of_week, month,
    {", ".join(f"{linear(c, 'day')} AS {c}" for c in _BRIDGED)}
  FROM daily_near)"""

TREND = """
average_trend AS (
  SELECT user_id, day,
    avg(CASE WHEN data_set = 1 THEN NULL ELSE registered END) OVER w AS registered_ma,
    avg(CASE WHEN data_set = 1 THEN NULL ELSE casual END) OVER w AS casual_ma
  FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
carried AS (
  SELECT user_id, day,
    last_value(registered_ma IGNORE NULLS) OVER w AS registered_ma,
    last_value(casual_ma IGNORE NULLS) OVER w AS casual_ma
  FROM average_trend WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)),
totals AS MATERIALIZED (
  SELECT f.*, c.registered_ma, c.casual_ma
  FROM features f LEFT JOIN carried c ON f.user_id = c.user_id AND f.ts::DATE = c.day)"""

PROFILE = """
mean_share AS (
  SELECT user_id, workingday, hour,
    avg(registered / nullif(registered_ma, 0)) AS r, avg(casual / nullif(casual_ma, 0)) AS c
  FROM totals WHERE workingday IS NOT NULL GROUP BY 1, 2, 3),
shares AS (
  SELECT user_id, workingday, hour,
    r / nullif(sum(r) OVER w, 0) AS registered_share, c / nullif(sum(c) OVER w, 0) AS casual_share
  FROM mean_share WINDOW w AS (PARTITION BY user_id, workingday)),
hourly_trend AS (
  SELECT t.*, coalesce(registered_share, 0) * registered_ma AS registered_trend,
    coalesce(casual_share, 0) * casual_ma AS casual_trend
  FROM totals t LEFT JOIN shares s
    ON t.user_id = s.user_id AND t.workingday = s.workingday AND t.hour = s.hour),
residuals AS MATERIALIZED (
  SELECT *, ln(registered_trend + 1) AS log_registered_trend, ln(casual_trend + 1) AS log_casual_trend,
    log_registered - ln(registered_trend + 1) AS log_registered_diff,
    log_casual - ln(casual_trend + 1) AS log_casual_diff
  FROM hourly_trend)"""

BY_TYPE = """
by_type AS (
  SELECT event_type, date_trunc('hour', ts) AS ts, count(*) AS n,
    sum(round(value * 100)::BIGINT)::DOUBLE / count(*) AS level
  FROM events GROUP BY 1, 2),
type_slots AS (
  SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
  FROM by_type GROUP BY 1),
by_type_grid AS (
  SELECT s.event_type, s.ts, n, level,
    CASE WHEN n IS NOT NULL THEN (isodow(s.ts) <= 5)::INT END AS workingday
  FROM type_slots s LEFT JOIN by_type b USING (event_type, ts))"""

_ORDER_COLS = ["n", "amount", "closed"]

ORDERS = f"""
orders_daily AS (
  SELECT o_orderpriority, o_orderdate::DATE AS day, count(*) AS n,
    sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS amount,
    count(*) FILTER (o_orderstatus = 'F') AS closed
  FROM orders GROUP BY 1, 2),
order_days AS (
  SELECT o_orderpriority, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day
  FROM orders_daily GROUP BY 1),
order_near AS (
  SELECT *, {neighbours(_ORDER_COLS, "o_orderpriority", "day")}
  FROM order_days LEFT JOIN orders_daily USING (o_orderpriority, day)),
orders_filled AS (
  SELECT o_orderpriority, day, {", ".join(f"{linear(c, 'day')} AS {c}" for c in _ORDER_COLS)}
  FROM order_near)"""

CHAIN = [OBS, TAGGED, GRID, CLEAN, FEATURES, DAILY, TREND, PROFILE]


def panel(upto: str, final: str, extra: str = "") -> str:
    """A query on the user panel, with the chain up to the named block."""
    blocks = CHAIN[: CHAIN.index(upto) + 1]
    ctes = ",".join(blocks) + (f",{extra}" if extra else "")
    return f"WITH {ctes}\n{final}"


def types(final: str) -> str:
    return f"WITH {BY_TYPE}\n{final}"


def orders(final: str, extra: str = "") -> str:
    return f"WITH {ORDERS}{',' + extra if extra else ''}\n{final}"
