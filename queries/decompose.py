"""Queries on daily trends, share profiles, residuals and scored forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries import sql
from seriesloom.functions.scalars import fold_label, log_plus_one
from seriesloom.plans import forecast
from seriesloom.operators import grid, lags, linear, predictions, profile, scoring, trend
from seriesloom.operators import weighted
from seriesloom.session import scratch_path, stage
from seriesloom.sources import tables
from seriesloom.sources.csv import read_csv, write_csv

KEYS, TS, SEGMENTS = fx.KEYS, fx.TS, fx.SEGMENTS
MODELS = ["profile", "average", "previous"]
PRIORITY = ["o_orderpriority"]


def _rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _residuals(spark, sf_dir):
    return fx.residuals(fx.kept_features(spark, sf_dir))


def daily_rollup(spark, sf_dir):
    """Daily sums and means, bad days bridged by interpolation."""
    day = forecast.daily(fx.features(spark, sf_dir), fx.SPEC)
    measured = [*fx.COUNTS, *fx.WEATHER, "day_of_week"]
    # Means of few values end in a 5 at the seventh place often; move them off the tie.
    return day.withColumns({c: F.round(F.col(c) + 1e-8, 6) for c in measured})


def midnight_pick(spark, sf_dir):
    """Each day with the elapsed-day number read off its midnight row."""
    hourly = fx.gridded(spark, sf_dir).select(*KEYS, TS, "registered")
    hourly = hourly.withColumn("elapsed", F.dayofyear(TS) + 365 * (F.year(TS) - fx.BASE_YEAR))
    return grid.daily_rollup(hourly, KEYS, TS, ["registered"], [], midnights=["elapsed"])


def elapsed_days(spark, sf_dir):
    return grid.elapsed_days(fx.orders_daily(spark, sf_dir).select(*PRIORITY, "day", "n"), PRIORITY, "day")


def daily_lag(spark, sf_dir):
    filled = fx.orders_daily_filled(spark, sf_dir)
    return lags.daily_lag(filled, PRIORITY, "day", ["n", "amount", "closed"])


def moving_average_trend(spark, sf_dir):
    filled = fx.orders_daily_filled(spark, sf_dir)
    averaged = trend.moving_average(filled, PRIORITY, "day", ["n", "amount"])
    return _rounded(averaged.select(*PRIORITY, "day", "n_ma", "amount_ma"), ["n_ma", "amount_ma"], 4)


def trend_rmse(spark, sf_dir):
    """Error of the log daily trend, per series and kind of day."""
    filled = fx.orders_daily_filled(spark, sf_dir)
    averaged = trend.moving_average(filled, PRIORITY, "day", ["n"])
    typed = averaged.withColumn("workingday", (F.weekday("day") < 5).cast("int"))
    scores = scoring.rmse(typed, [*PRIORITY, "workingday"], log_plus_one("n"), log_plus_one("n_ma"))
    return _rounded(scores, ["rmse"])


def daily_to_hourly_asof(spark, sf_dir):
    """Daily totals on hours: days without a row inherit the last one."""
    observed = stage(fx.tagged(spark, sf_dir).select(*KEYS, TS, *SEGMENTS), "hours")
    hourly = grid.regular_grid(observed.select(*KEYS, TS), KEYS, TS)
    sums = grid.daily_rollup(observed, KEYS, TS, ["registered", "casual"], [])
    return trend.daily_to_hourly(hourly, sums, KEYS, TS, ["registered", "casual"])


def normalised_demand(spark, sf_dir):
    totals = fx.totals(fx.kept_features(spark, sf_dir))
    norm = profile.normalise(totals, {"registered": "registered_total", "casual": "casual_total"})
    return _rounded(
        norm.select(*KEYS, TS, "registered_norm", "casual_norm"), ["registered_norm", "casual_norm"]
    )


def hourly_profile(spark, sf_dir):
    shares = forecast.shares(fx.profile_hours(spark, sf_dir), fx.SPEC)
    return _rounded(shares, ["registered_share", "casual_share"])


def hourly_profile_geo(spark, sf_dir):
    shares = profile.geometric_profile(
        fx.profile_hours(spark, sf_dir),
        KEYS,
        TS,
        {"registered_share": ("registered", "registered_total"), "casual_share": ("casual", "casual_total")},
    )
    return _rounded(shares, ["registered_share", "casual_share"])


def hourly_trend(spark, sf_dir):
    df = forecast.hourly_trend(fx.totals(fx.kept_features(spark, sf_dir)), fx.SPEC)
    cols = ["registered_trend", "casual_trend"]
    return _rounded(df.select(*KEYS, TS, *cols), cols)


def residual_target(spark, sf_dir):
    cols = [f"log_{s}_{w}" for s in SEGMENTS for w in ("trend", "diff")]
    return _rounded(_residuals(spark, sf_dir).select(*KEYS, TS, *cols), cols)


def _hour_effect(df):
    """A residual model without a fit: mean training residual by hour of day."""
    effect = (
        df.where(F.col("data_set") == 0)
        .groupBy("hour")
        .agg(*[F.avg(f"log_{s}_diff").alias(f"{s}_residual") for s in SEGMENTS])
    )
    return df.join(F.broadcast(effect), "hour", "left")  # 24 rows, by the clock


def recombine_segments(spark, sf_dir):
    """Residual plus trend, back to counts: rounded and cut to whole numbers."""
    df = _hour_effect(_residuals(spark, sf_dir))
    df = profile.recombine(df, SEGMENTS, rounding="half_even")
    df = profile.recombine(df, SEGMENTS, out="count_cut", rounding="truncate")
    logs = [f"log_{s}_pred" for s in SEGMENTS]
    return _rounded(df.select(*KEYS, TS, *logs, "count_pred", "count_cut"), logs)


def rmsle(spark, sf_dir):
    """Score of the training part, overall by kind of day."""
    df = profile.recombine(_hour_effect(_residuals(spark, sf_dir)), SEGMENTS)
    train = df.where((F.col("data_set") == 0) & F.col("count").isNotNull())
    return _rounded(scoring.rmsle(train, ["workingday"], "count", "count_pred"), ["rmsle"])


def _model_table(spark, sf_dir):
    """Log predictions of three fit-free models in long form."""
    df = fx.asked_residuals(spark, sf_dir, {f"{s}_filled": [24] for s in SEGMENTS}, [])
    wide = df.withColumns(
        {f"{s}_average": log_plus_one(F.col(f"{s}_total") / 24) for s in SEGMENTS}
        | {f"{s}_previous": log_plus_one(f"{s}_filled_24h_ago") for s in SEGMENTS}
    )
    columns = {("profile", s): f"log_{s}_trend" for s in SEGMENTS}
    columns |= {(m, s): f"{s}_{m}" for m in ("average", "previous") for s in SEGMENTS}
    return predictions.long_predictions(wide, KEYS, TS, columns)


def prediction_table(spark, sf_dir):
    """Predictions written by model, replaced by a rerun, and read back."""
    path = scratch_path(spark, "predictions")
    table = _model_table(spark, sf_dir)
    tables.write_predictions(table, path, KEYS, TS)
    tables.write_predictions(table.where(F.col("model") == "average"), path, KEYS, TS)
    read = tables.read_predictions(spark, path)
    return _rounded(read.select("model", *KEYS, TS, "segment", "log_pred"), ["log_pred"])


def predictions_pivot(spark, sf_dir):
    wide = predictions.pivot_predictions(_model_table(spark, sf_dir), KEYS, TS, MODELS, SEGMENTS)
    return _rounded(wide, [f"log_{s}_{m}_pred" for m in MODELS for s in SEGMENTS])


def prediction_files(spark, sf_dir):
    """A CSV of both segments for each model, read back one by one and aligned on the key."""
    table = stage(_model_table(spark, sf_dir), "predictions", ["model"])
    parts = []
    for m in MODELS:
        columns = [f"log_{s}_{m}_pred" for s in SEGMENTS]
        path = scratch_path(spark, f"{m}_hourly_pred")
        write_csv(predictions.pivot_predictions(table.where(F.col("model") == m), KEYS, TS, [m], SEGMENTS), path)
        parts.append(read_csv(spark, path, f"user_id bigint, ts timestamp_ntz, {', '.join(f'{c} double' for c in columns)}"))
    aligned = predictions.outer_align(parts, [*KEYS, TS])
    return _rounded(aligned, [f"log_{s}_{m}_pred" for m in MODELS for s in SEGMENTS])


def prediction_full_outer(spark, sf_dir):
    """Observed targets and the predictions of each model, aligned on the key."""
    table = stage(_model_table(spark, sf_dir), "predictions", ["model"])
    parts = [fx.tagged(spark, sf_dir).select(*KEYS, TS, *SEGMENTS)]
    for m in MODELS:
        for s in SEGMENTS:
            own = table.where((F.col("model") == m) & (F.col("segment") == s))
            parts.append(own.select(*KEYS, TS, F.round("log_pred", 6).alias(f"log_{s}_{m}_pred")))
    return predictions.outer_align(parts, [*KEYS, TS])


def forecast_submission(spark, sf_dir):
    """Whole counts for the test hours that are asked for."""
    df = _hour_effect(_residuals(spark, sf_dir)).where(
        (F.col("data_set") == 1) & (F.col("submit") == 1)
    )
    df = profile.recombine(df, SEGMENTS)
    path = scratch_path(spark, "submission")
    table = predictions.submission(df, KEYS, TS, [f"log_{s}_pred" for s in SEGMENTS])
    tables.write_submission(table, path, [*KEYS, TS], "count")
    return read_csv(spark, path, "user_id bigint, ts timestamp_ntz, count bigint")


def _stack_inputs(spark, sf_dir):
    """Targets next to the three models' predictions, one row per key."""
    table = _model_table(spark, sf_dir)
    wide = predictions.pivot_predictions(table, KEYS, TS, MODELS, SEGMENTS)
    targets = fx.tagged(spark, sf_dir).select(
        *KEYS, TS, "data_set", *[log_plus_one(s).alias(f"log_{s}") for s in SEGMENTS]
    )
    return targets.join(wide, [*KEYS, TS], "left")


def _stack(spark, sf_dir):
    df = stage(_stack_inputs(spark, sf_dir), "stack")
    inputs = {s: ([f"log_{s}_{m}_pred" for m in MODELS], f"log_{s}") for s in SEGMENTS}
    return linear.ridge_stack(df, inputs, F.col("data_set") == 0)


def stack_ridge(spark, sf_dir):
    """Three models' log predictions combined by a ridge without intercept."""
    scored, _ = _stack(spark, sf_dir)
    cols = [f"log_{s}_stack_pred" for s in SEGMENTS]
    return _rounded(scored.select(*KEYS, TS, *cols), cols)


def ridge_coefficients(spark, sf_dir):
    _, coefficients = _stack(spark, sf_dir)
    return _rounded(coefficients, ["coef"])


def ridge_gram(spark, sf_dir):
    """Sums of products of line quantities, discounts and taxes, by return flag."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.col("l_quantity").alias("q"),
        F.rint(F.col("l_discount") * 100).alias("d"),
        F.rint(F.col("l_tax") * 100).alias("t"),
        F.rint(F.col("l_extendedprice")).alias("y"),
    )
    return linear.gram(lines, ["l_returnflag"], ["q", "d", "t"], "y")


def weighted_median(spark, sf_dir):
    """Price at half the quantity, for groups as large as a third of the table."""
    lines = fx.table(spark, sf_dir, "lineitem")
    return weighted.weighted_median(lines, ["l_returnflag"], "l_extendedprice", "l_quantity")


def weighted_median_rowwise(spark, sf_dir):
    """The ensemble form: within a row, over an array of (value, weight)."""
    lines = fx.table(spark, sf_dir, "lineitem")
    discount, tax = F.rint(F.col("l_discount") * 100), F.rint(F.col("l_tax") * 100)
    members = [(F.col("l_quantity"), tax + 1), (discount, F.lit(3.0)), (tax, discount + 1)]
    entries = F.array(*[F.struct(v.alias("value"), w.alias("weight")) for v, w in members])
    return lines.select("l_orderkey", weighted.weighted_median_of(entries).alias("median"))


def _lag_scores(spark, sf_dir):
    targets = [f"log_{s}_diff" for s in SEGMENTS]
    known = {t: F.when(F.col("data_set") == 0, F.col(t)) for t in targets}
    df = _residuals(spark, sf_dir).select(*KEYS, TS, *fx.WEATHER, *(c.alias(t) for t, c in known.items()))
    scores = lags.lag_correlations(df, KEYS, TS, fx.WEATHER, targets)
    segment = F.regexp_extract("y", "log_(.*)_diff", 1).alias("segment")
    return scores.select(segment, F.col("x").alias("feature"), "r")


def lag_correlation(spark, sf_dir):
    """Correlation of every weather column and its lags with the residuals, in one pass."""
    return _rounded(_lag_scores(spark, sf_dir), ["r"])


def ranked_pairs(spark, sf_dir):
    """Lags by strength of correlation, both segments side by side."""
    scores = _lag_scores(spark, sf_dir).select(
        "segment", "feature", F.round(F.abs("r"), 6).alias("importance")
    )
    return scoring.ranked_pairs(scores, SEGMENTS)


def _fold_scores(spark, sf_dir):
    df = fx.asked_residuals(spark, sf_dir, {}, ["temp"]).where(F.col("data_set") == 0)
    cases = F.array(
        *[
            F.struct(
                F.lit(s).alias("segment"),
                F.col(f"log_{s}_trend").alias("x1"),
                (F.col("temp") / 10000).alias("x2"),
                F.col(f"log_{s}_diff").alias("y"),
            )
            for s in SEGMENTS
        ]
    )
    rows = df.select(fold_label(TS).alias("fold"), F.inline(cases))
    return linear.ridge_fold_scores(rows, ["segment"], "fold", ["x1", "x2"], "y", [0.1, 1.0, 10.0])


def predefined_fold_cv(spark, sf_dir):
    """Hold-out errors of a ridge on both folds for three penalties, from one pass."""
    return _rounded(_fold_scores(spark, sf_dir), ["mse"])


def cv_score_table(spark, sf_dir):
    """Fold scores appended to a log, read back."""
    path = scratch_path(spark, "cv_scores")
    tables.append_scores(_fold_scores(spark, sf_dir), path)
    return _rounded(spark.read.parquet(path), ["mse"])


def cv_summary(spark, sf_dir):
    summary = scoring.cv_summary(_fold_scores(spark, sf_dir), ["segment", "alpha"])
    return _rounded(summary, ["mean_mse", "std_mse"])


QUERIES = {
    f.__name__: f
    for f in (
        daily_rollup, midnight_pick, elapsed_days, daily_lag, moving_average_trend, trend_rmse,
        daily_to_hourly_asof, normalised_demand, hourly_profile, hourly_profile_geo, hourly_trend,
        residual_target, recombine_segments, rmsle, prediction_table, predictions_pivot,
        prediction_files, prediction_full_outer, forecast_submission, stack_ridge, ridge_coefficients, ridge_gram,
        weighted_median, weighted_median_rowwise, lag_correlation, ranked_pairs,
        predefined_fold_cv, cv_score_table, cv_summary,
    )
}


def _round(cols, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


_EFFECT = """
effect AS (
  SELECT hour, avg(log_registered_diff) AS registered_residual, avg(log_casual_diff) AS casual_residual
  FROM residuals WHERE data_set = 0 GROUP BY hour),
fitted AS (
  SELECT r.*, e.registered_residual + log_registered_trend AS log_registered_pred,
    e.casual_residual + log_casual_trend AS log_casual_pred
  FROM residuals r LEFT JOIN effect e ON r.hour = e.hour)"""

_TOTAL = "(exp(log_registered_pred) - 1 + exp(log_casual_pred) - 1)"

_MODEL_PARTS = "\n  UNION ALL ".join(
    f"SELECT '{m}' AS model, user_id, ts, '{s}' AS segment, {expr.format(s=s)} AS log_pred FROM asked"
    for m, expr in (
        ("profile", "log_{s}_trend"),
        ("average", "ln({s}_ma / 24 + 1)"),
        ("previous", "ln({s}_day_ago + 1)"),
    )
    for s in SEGMENTS
)
_MODEL_TABLE = f"""
day_ago AS (
  SELECT user_id, ts, lag(registered, 24) OVER w AS registered_day_ago, lag(casual, 24) OVER w AS casual_day_ago
  FROM hourly_filled WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
asked AS (
  SELECT * FROM residuals LEFT JOIN day_ago USING (user_id, ts) WHERE count IS NOT NULL OR submit = 1),
model_rows AS ({_MODEL_PARTS}),
model_table AS (SELECT * FROM model_rows WHERE log_pred IS NOT NULL)"""

_WIDE = ", ".join(
    f"max(log_pred) FILTER (model = '{m}' AND segment = '{s}') AS log_{s}_{m}_pred"
    for m in MODELS
    for s in SEGMENTS
)
_PIVOT = f"{_MODEL_TABLE},\nwide AS (SELECT user_id, ts, {_WIDE} FROM model_table GROUP BY 1, 2)"

# Three equations by Cramer's rule, with 1 added to the diagonal.
_DET = "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))"


def _cramer(m, rhs):
    det = _DET.format(*m)
    answers = []
    for col in range(3):
        swapped = [rhs[i // 3] if i % 3 == col else m[i] for i in range(9)]
        answers.append(f"{_DET.format(*swapped)} / {det}")
    return answers


_SYM = ["(a + 1)", "b", "c", "b", "(d + 1)", "e", "c", "e", "(f + 1)"]
_B = _cramer(_SYM, ["p", "q", "r"])


def _stack_sql(s):
    x = [f"log_{s}_{m}_pred" for m in MODELS]
    sums = {
        "a": (x[0], x[0]), "b": (x[0], x[1]), "c": (x[0], x[2]), "d": (x[1], x[1]), "e": (x[1], x[2]),
        "f": (x[2], x[2]), "p": (x[0], "y"), "q": (x[1], "y"), "r": (x[2], "y"),
    }
    columns = ", ".join(f"sum({u} * {v}) AS {n}" for n, (u, v) in sums.items())
    return f"""
sums_{s} AS (
  SELECT {columns} FROM (SELECT w.*, ln(t.{s} + 1) AS y FROM wide w JOIN tagged t USING (user_id, ts)
    WHERE t.data_set = 0)
  WHERE y IS NOT NULL AND {x[0]} IS NOT NULL AND {x[1]} IS NOT NULL AND {x[2]} IS NOT NULL),
coef_{s} AS (SELECT {_B[0]} AS b1, {_B[1]} AS b2, {_B[2]} AS b3 FROM sums_{s})"""


_STACK = f"{_PIVOT},{_stack_sql('registered')},{_stack_sql('casual')}"


def _stack_score(s):
    return (
        f"round(log_{s}_profile_pred * {s[0]}.b1 + log_{s}_average_pred * {s[0]}.b2"
        f" + log_{s}_previous_pred * {s[0]}.b3, 6) AS log_{s}_stack_pred"
    )


_LAG_PAIRS = "\nUNION ALL ".join(
    f"SELECT '{s}' AS segment, '{c}' AS feature, corr({c}, log_{s}_diff) AS r FROM fan"
    for s in SEGMENTS
    for base in fx.WEATHER
    for c in [base, *[f"{base}_{k:02d}h_ago" for k in range(1, 25)]]
)
_FAN = f"""
fan_all AS (
  SELECT data_set, log_registered_diff, log_casual_diff, {", ".join(fx.WEATHER)},
    {", ".join(f"lag({c}, {k}) OVER w AS {c}_{k:02d}h_ago" for c in fx.WEATHER for k in range(1, 25))}
  FROM residuals WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
fan AS (SELECT * FROM fan_all WHERE data_set = 0),
lag_scores AS ({_LAG_PAIRS})"""

_CV = f"""
cv_rows AS (
  {" UNION ALL ".join(f'''SELECT '{s}' AS segment, CASE WHEN day(ts) <= 5 THEN 0 WHEN day(ts) <= 14 THEN -1
    ELSE 1 END AS fold, log_{s}_trend AS x1, temp / 10000 AS x2, log_{s}_diff AS y
  FROM residuals WHERE data_set = 0''' for s in SEGMENTS)}),
cv_known AS (SELECT * FROM cv_rows WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL),
cv_fits AS (
  SELECT segment, k.fold, alpha, sum(x1 * x1) + alpha AS a, sum(x1 * x2) AS b, sum(x2 * x2) + alpha AS c,
    sum(x1 * y) AS p, sum(x2 * y) AS q
  FROM cv_known t, (VALUES (0), (1)) k(fold), (VALUES (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) g(alpha)
  WHERE t.fold <> k.fold GROUP BY 1, 2, 3),
fold_scores AS (
  SELECT t.segment, t.fold::INT AS fold, f.alpha, count(*) AS n,
    avg(power(y - x1 * (p * c - q * b) / (a * c - b * b) - x2 * (q * a - p * b) / (a * c - b * b), 2)) AS mse
  FROM cv_known t JOIN cv_fits f ON t.segment = f.segment AND t.fold = f.fold GROUP BY 1, 2, 3)"""

_RATES = ["n", "amount", "closed"]

ORACLES = {
    "daily_rollup": sql.panel(
        sql.DAILY,
        f"""SELECT user_id, day, data_set, workingday, weekend, bad_day, month,
  {", ".join(f"round({c} + 1e-8, 6) AS {c}" for c in [*fx.COUNTS, *fx.WEATHER, 'day_of_week'])} FROM daily""",
    ),
    "midnight_pick": sql.panel(
        sql.GRID,
        """SELECT user_id, ts::DATE AS day, sum(registered)::BIGINT AS registered,
  max(CASE WHEN hour(ts) = 0 THEN dayofyear(ts) + 365 * (year(ts) - 2024) END)::INT AS elapsed
FROM gridded GROUP BY 1, 2""",
    ),
    "elapsed_days": sql.orders(
        """SELECT o_orderpriority, day, n,
  date_diff('day', min(day) OVER (PARTITION BY o_orderpriority), day)::DOUBLE AS elapsed FROM orders_daily"""
    ),
    "daily_lag": sql.orders(
        f"""SELECT o_orderpriority, day, {", ".join(_RATES)},
  {", ".join(f'''coalesce(lag({c}) OVER w, first_value({c}) OVER w) AS {c}_1d_ago''' for c in _RATES)}
FROM orders_filled WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day)"""
    ),
    "moving_average_trend": sql.orders(
        """SELECT o_orderpriority, day, round(avg(n) OVER w, 4) AS n_ma, round(avg(amount) OVER w, 4) AS amount_ma
FROM orders_filled WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""
    ),
    "trend_rmse": sql.orders(
        """SELECT o_orderpriority, (isodow(day) <= 5)::INT AS workingday,
  round(sqrt(avg(power(ln(n + 1) - ln(n_ma + 1), 2))), 6) AS rmse, count(*) AS n
FROM (SELECT *, avg(n) OVER (PARTITION BY o_orderpriority ORDER BY day
  ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS n_ma FROM orders_filled) GROUP BY 1, 2"""
    ),
    "daily_to_hourly_asof": sql.panel(
        sql.GRID,
        """SELECT g.user_id, g.ts,
  last_value(d.registered IGNORE NULLS) OVER w AS registered, last_value(d.casual IGNORE NULLS) OVER w AS casual
FROM gridded g LEFT JOIN (
  SELECT user_id, ts::DATE AS day, sum(registered)::BIGINT AS registered, sum(casual)::BIGINT AS casual
  FROM tagged GROUP BY 1, 2) d ON g.user_id = d.user_id AND g.ts::DATE = d.day
WINDOW w AS (PARTITION BY g.user_id ORDER BY g.ts ROWS UNBOUNDED PRECEDING)""",
    ),
    "normalised_demand": sql.panel(
        sql.TREND,
        """SELECT user_id, ts, round(registered / nullif(registered_ma, 0), 6) AS registered_norm,
  round(casual / nullif(casual_ma, 0), 6) AS casual_norm FROM totals""",
    ),
    "hourly_profile": sql.panel(
        sql.PROFILE,
        f"SELECT user_id, workingday, hour, {_round(['registered_share', 'casual_share'])} FROM shares",
    ),
    "hourly_profile_geo": sql.panel(
        sql.TREND,
        """SELECT user_id, workingday, hour, round(r / nullif(sum(r) OVER w, 0), 6) AS registered_share,
  round(c / nullif(sum(c) OVER w, 0), 6) AS casual_share
FROM (SELECT user_id, workingday, hour, exp(avg(ln(registered + 1) - ln(registered_ma + 1))) AS r,
    exp(avg(ln(casual + 1) - ln(casual_ma + 1))) AS c
  FROM totals WHERE workingday IS NOT NULL GROUP BY 1, 2, 3)
WINDOW w AS (PARTITION BY user_id, workingday)""",
    ),
    "hourly_trend": sql.panel(
        sql.PROFILE,
        f"SELECT user_id, ts, {_round(['registered_trend', 'casual_trend'])} FROM hourly_trend",
    ),
    "residual_target": sql.panel(
        sql.PROFILE,
        f"SELECT user_id, ts, {_round([f'log_{s}_{w}' for s in SEGMENTS for w in ('trend', 'diff')])} FROM residuals",
    ),
    "recombine_segments": sql.panel(
        sql.PROFILE,
        f"""SELECT user_id, ts, {_round(['log_registered_pred', 'log_casual_pred'])},
  round_even({_TOTAL}, 0)::BIGINT AS count_pred, trunc({_TOTAL})::BIGINT AS count_cut FROM fitted""",
        _EFFECT,
    ),
    "rmsle": sql.panel(
        sql.PROFILE,
        f"""SELECT workingday, round(sqrt(avg(power(log_count - ln({_TOTAL} + 1), 2))), 6) AS rmsle,
  count(log_count - {_TOTAL}) AS n
FROM fitted WHERE data_set = 0 AND count IS NOT NULL GROUP BY 1""",
        _EFFECT,
    ),
    "prediction_table": sql.panel(
        sql.PROFILE,
        "SELECT model, user_id, ts, segment, round(log_pred, 6) AS log_pred FROM model_table",
        _MODEL_TABLE,
    ),
    "predictions_pivot": sql.panel(
        sql.PROFILE,
        f"SELECT user_id, ts, {_round([f'log_{s}_{m}_pred' for m in MODELS for s in SEGMENTS])} FROM wide",
        _PIVOT,
    ),
    "prediction_files": sql.panel(
        sql.PROFILE,
        f"""SELECT user_id, ts,
  {", ".join(f"round(max(log_pred) FILTER (model = '{m}' AND segment = '{s}'), 6) AS log_{s}_{m}_pred" for m in MODELS for s in SEGMENTS)}
FROM model_table GROUP BY user_id, ts""",
        _MODEL_TABLE,
    ),
    "prediction_full_outer": sql.panel(
        sql.PROFILE,
        f"""SELECT user_id, ts, max(registered) AS registered, max(casual) AS casual,
  {", ".join(f"round(max(p) FILTER (model = '{m}' AND segment = '{s}'), 6) AS log_{s}_{m}_pred" for m in MODELS for s in SEGMENTS)}
FROM (SELECT user_id, ts, registered, casual, NULL AS model, NULL AS segment, NULL::DOUBLE AS p FROM tagged
  UNION ALL SELECT user_id, ts, NULL, NULL, model, segment, log_pred FROM model_table) GROUP BY user_id, ts""",
        _MODEL_TABLE,
    ),
    "forecast_submission": sql.panel(
        sql.PROFILE,
        f"""SELECT user_id, ts, round_even({_TOTAL}, 0)::BIGINT AS count
FROM fitted WHERE data_set = 1 AND submit = 1""",
        _EFFECT,
    ),
    "stack_ridge": sql.panel(
        sql.PROFILE,
        f"""SELECT user_id, ts, {_stack_score('registered')}, {_stack_score('casual')}
FROM tagged LEFT JOIN wide USING (user_id, ts), coef_registered r, coef_casual c""",
        _STACK,
    ),
    "ridge_coefficients": sql.panel(
        sql.PROFILE,
        "\nUNION ALL ".join(
            f"SELECT '{s}' AS segment, 'log_{s}_{m}_pred' AS feature, round(b{i + 1}, 6) AS coef FROM coef_{s}"
            for s in SEGMENTS
            for i, m in enumerate(MODELS)
        ),
        _STACK,
    ),
    "ridge_gram": """SELECT l_returnflag, sum(q * q) AS xx_0_0, sum(q * d) AS xx_0_1, sum(q * t) AS xx_0_2,
  sum(d * d) AS xx_1_1, sum(d * t) AS xx_1_2, sum(t * t) AS xx_2_2, sum(q * y) AS xy_0, sum(d * y) AS xy_1,
  sum(t * y) AS xy_2, sum(y * y) AS yy, count(*) AS n
FROM (SELECT l_returnflag, l_quantity AS q, round(l_discount * 100) AS d, round(l_tax * 100) AS t,
  round_even(l_extendedprice, 0) AS y FROM lineitem) GROUP BY 1""",
    "weighted_median": """SELECT l_returnflag, min(v) AS median
FROM (SELECT l_returnflag, l_extendedprice AS v,
    sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS run,
    sum(l_quantity) OVER (PARTITION BY l_returnflag) AS total FROM lineitem)
WHERE run >= 0.5 * total GROUP BY 1""",
    "weighted_median_rowwise": """WITH numbered AS (
  SELECT row_number() OVER () AS id, l_orderkey, l_quantity AS q, round(l_discount * 100) AS d,
    round(l_tax * 100) AS t FROM lineitem),
members AS (
  SELECT id, l_orderkey, q AS v, t + 1 AS w FROM numbered
  UNION ALL SELECT id, l_orderkey, d, 3 FROM numbered
  UNION ALL SELECT id, l_orderkey, t, d + 1 FROM numbered)
SELECT l_orderkey, median FROM (
  SELECT id, l_orderkey, min(v) AS median
  FROM (SELECT *, sum(w) OVER (PARTITION BY id ORDER BY v) AS run, sum(w) OVER (PARTITION BY id) AS total
    FROM members) WHERE run >= 0.5 * total GROUP BY 1, 2)""",
    "lag_correlation": sql.panel(
        sql.PROFILE, "SELECT segment, feature, round(r, 6) AS r FROM lag_scores", _FAN
    ),
    "ranked_pairs": sql.panel(
        sql.PROFILE,
        f"""SELECT rank, {", ".join(f'''max(feature) FILTER (segment = '{s}') AS {s}_feature,
  max(importance) FILTER (segment = '{s}') AS {s}_importance''' for s in SEGMENTS)}
FROM (SELECT segment, feature, importance,
    row_number() OVER (PARTITION BY segment ORDER BY importance DESC, feature)::INT AS rank
  FROM (SELECT segment, feature, round(abs(r), 6) AS importance FROM lag_scores)) GROUP BY rank""",
        _FAN,
    ),
    "predefined_fold_cv": sql.panel(
        sql.PROFILE, "SELECT segment, fold, alpha, n, round(mse, 6) AS mse FROM fold_scores", _CV
    ),
    "cv_score_table": sql.panel(
        sql.PROFILE, "SELECT segment, fold, alpha, n, round(mse, 6) AS mse FROM fold_scores", _CV
    ),
    "cv_summary": sql.panel(
        sql.PROFILE,
        """SELECT segment, alpha, round(sum(mse * n) / sum(n), 6) AS mean_mse,
  round(stddev_pop(mse), 6) AS std_mse, count(*) AS folds FROM fold_scores GROUP BY 1, 2""",
        _CV,
    ),
}
