"""Queries that fit models. The settings of the original stand in ``seriesloom.models.trees``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries import fixtures as fx
from queries import sql
from seriesloom.functions.scalars import fold_label
from seriesloom.models import capped, smoother, trees
from seriesloom.models.adaboost import AdaBoostR2, BaggedAdaBoost
from seriesloom.models.search import fold_search
from seriesloom.operators import linear, predictions, scoring
from seriesloom.plans import forecast, learn
from seriesloom.session import scratch_path, side_by_side, stage
from seriesloom.sources import tables

KEYS, TS, SEGMENTS, SPEC = fx.KEYS, fx.TS, fx.SEGMENTS, fx.SPEC
# Settings of the registered fits: all of them cross a checkpoint of their weights or
# residuals. Those of the original are in ``seriesloom.models.trees``.
SMALL_FOREST = {"numTrees": 20, "maxDepth": 8, "minInstancesPerNode": 4, "featureSubsetStrategy": "all"}
DAILY_FOREST = {"numTrees": 20, "maxDepth": 8, "featureSubsetStrategy": "0.2"}
SMALL_BOOSTED = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.7}
TREE = {"rate": 0.1, "maxDepth": 4, "minInstancesPerNode": 4}
# The original's: no limit to the depth but the leaves.
LEAVES = {"maxDepth": None, "minSplit": 8, "minInstancesPerNode": 4}
BOOST = {"rounds": 500, "rate": 0.01, "maxLeaves": 2**7, **LEAVES}
BAGS = {"bags": 20, "sample": 0.7, "rounds": 50, "rate": 0.1, "maxLeaves": 2**10, **LEAVES}
# Models that the importances and the search fit themselves.
FEW = {"forest": 10, "gbt": 10, "adaboost": 6, "bags": 2}
FOLDS = [0, 1]


def _bags(label, **settings):
    return BaggedAdaBoost(label, [*KEYS, TS], **settings)


def _capped(how, settings):
    return lambda label: capped.Capped(label, [*KEYS, TS], how, **settings)


# The three models that the stacks combine, each fitted per fold and segment.
BASES = {
    "gb": _capped(capped.boosted, capped.BOOSTED),
    "rf": _capped(capped.forest, capped.FOREST),
    "ada": lambda label: _bags(label, **BAGS),
}
SEARCHED = {
    "gb": lambda label: trees.boosted(label, maxIter=FEW["gbt"], maxDepth=4),
    "rf": lambda label: trees.forest(label, numTrees=FEW["forest"], maxDepth=6),
    "ada": lambda label: _bags(label, bags=FEW["bags"], rounds=FEW["adaboost"], **TREE),
}
OWN = {s: [f"log_{s}_{m}_pred" for m in BASES] for s in SEGMENTS}


def _inputs(spark, sf_dir):
    trees.ready(spark)
    return learn.residual_inputs(fx.asked_residuals(spark, sf_dir), SPEC)


def _forecast(spark, sf_dir, make):
    df, _ = learn.predict_residuals(_inputs(spark, sf_dir), SPEC, make)
    return df.select(*KEYS, TS, "data_set", *[f"log_{s}_pred" for s in SEGMENTS], "count_pred")


def daily_trend_forest(spark, sf_dir):
    """Daily totals of both segments from forests on calendar and weather."""
    return _forest_trend(fx.day_features(spark, sf_dir))


def daily_trend_gp(spark, sf_dir):
    """Smooth curves of daily orders by priority and kind of day; days after the
    19th of a month are not fitted but predicted."""
    day = fx.orders_daily_filled(spark, sf_dir)
    known = F.dayofmonth("day") <= 19
    rows = day.select(
        "o_orderpriority",
        (F.weekday("day") < 5).cast("int").alias("workingday"),
        F.datediff("day", F.lit("1995-01-01").cast("date")).alias("x"),
        F.when(known, F.log1p("n")).alias("y"),
        F.lit(0.5).alias("nugget"),
    )
    return smoother.smooth(rows, ["o_orderpriority", "workingday"], "x", "y", "nugget")


def _chain(spark, sf_dir, trend):
    """Fitted daily trend, hourly profile and trend, residual forest, recombined counts."""
    trees.ready(spark)
    asked, hours = fx.asked_hours(spark, sf_dir)
    day = stage(trend(hours), "daily_trend")
    inputs = learn.residual_inputs(forecast.residuals(asked, day, SPEC), SPEC)
    df, _ = learn.predict_residuals(inputs, SPEC, lambda label: trees.forest(label, **SMALL_FOREST))
    logs = [f"log_{s}{suffix}" for s in SEGMENTS for suffix in ("", "_trend", "_pred")]
    return df.select(*KEYS, TS, "data_set", *logs, "count", "count_pred")


def _forest_trend(feats):
    inputs = stage(learn.filled_daily(feats, SPEC), "daily_inputs")
    return learn.forest_trend(inputs, SPEC, **DAILY_FOREST)


def _smooth_trend(feats):
    return learn.smooth_trend(feats, SPEC, {"registered": 0.5, "casual": 2.0})


def forecast_forest(spark, sf_dir):
    """The whole forecast from a daily forest: every training hour and every asked one."""
    return _chain(spark, sf_dir, _forest_trend)


def forecast_smooth(spark, sf_dir):
    """The same from smooth daily curves by segment and kind of day."""
    return _chain(spark, sf_dir, _smooth_trend)


def forecast_scores(spark, sf_dir):
    """Training errors of the logs, by trend and segment, before and after the residual model."""
    parts = []
    for name, trend in (("forest", _forest_trend), ("smooth", _smooth_trend)):
        df = stage(_chain(spark, sf_dir, trend), f"forecast_{name}").where(F.col("data_set") == 0)
        for s in SEGMENTS:
            named = df.withColumns({"trend": F.lit(name), "segment": F.lit(s)})
            before = scoring.rmse(named, ["trend", "segment"], f"log_{s}", f"log_{s}_trend", "trend_rmsle")
            after = scoring.rmse(named, ["trend", "segment"], f"log_{s}", f"log_{s}_pred", "rmsle")
            parts.append(before.drop("n").join(after, ["trend", "segment"]))
    return reduce(DataFrame.unionByName, parts)


def residual_forest(spark, sf_dir):
    return _forecast(spark, sf_dir, lambda label: trees.forest(label, **SMALL_FOREST))


def residual_gbt(spark, sf_dir):
    """500 rounds of trees of at most 100 leaves, each on 70 % of the rows."""
    return _forecast(spark, sf_dir, lambda label: capped.Capped(label, [*KEYS, TS], capped.boosted, **capped.BOOSTED))


def residual_adaboost(spark, sf_dir):
    """500 rounds of trees of at most 128 leaves."""
    return _forecast(spark, sf_dir, lambda label: AdaBoostR2(label, **BOOST))


def residual_bagged_adaboost(spark, sf_dir):
    """20 bags of 50 rounds of trees of at most 1,024 leaves."""
    return _forecast(spark, sf_dir, lambda label: _bags(label, **BAGS))


def asked_rows_complete(spark, sf_dir):
    """Test hours and panel days that are asked for, and those that got a prediction of both segments."""
    hours = residual_forest(spark, sf_dir).where("data_set = 1").select(F.lit("hours").alias("part"), "count_pred")
    asked_hours = fx.tagged(spark, sf_dir).where("submit = 1").select(F.lit("hours").alias("part"))
    total = F.col("registered_total") + F.col("casual_total")
    days = daily_trend_forest(spark, sf_dir).select(F.lit("days").alias("part"), total.alias("count_pred"))
    asked_days = fx.gridded(spark, sf_dir).select(*KEYS, F.to_date(TS).alias("day")).distinct().select(F.lit("days").alias("part"))
    asked = asked_hours.unionByName(asked_days).groupBy("part").agg(F.count("*").alias("asked"))
    predicted = hours.unionByName(days).groupBy("part").agg(F.count("count_pred").alias("predicted"))
    return asked.join(predicted, "part", "left")


def _stack_inputs(spark, sf_dir):
    """Features next to the out-of-fold predictions of the three fitted models, each
    written to the prediction table and read back from it."""
    inputs = _inputs(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    for name, make in BASES.items():
        preds = learn.out_of_fold(inputs, SPEC, make, fold_label(TS), FOLDS, name)
        columns = {(name, s): f"log_{s}_{name}_pred" for s in SEGMENTS}
        tables.write_predictions(predictions.long_predictions(preds, KEYS, TS, columns), path, KEYS, TS)
    table = tables.read_predictions(spark, path)
    wide = predictions.pivot_predictions(table, KEYS, TS, list(BASES), SEGMENTS)
    joined = learn.usable(inputs.join(wide, [*KEYS, TS], "left"), [c for own in OWN.values() for c in own])
    return stage(joined, "stack_inputs")


def _held_out():
    """Rows that a base model predicted without having seen them."""
    return fold_label(TS) >= 0


def _tree_stack(spark, sf_dir, make):
    df = learn.tree_stack(_stack_inputs(spark, sf_dir), SPEC, OWN, make, _held_out())
    return df.select(*KEYS, TS, "data_set", *[f"log_{s}_stack_pred" for s in SEGMENTS])


def stack_gbt(spark, sf_dir):
    return _tree_stack(spark, sf_dir, lambda label: trees.boosted(label, **SMALL_BOOSTED))


def stack_forest(spark, sf_dir):
    """1,000 trees of at most 16,384 leaves, splits of 4 rows, leaves of 2, over the three whole models."""
    return _tree_stack(spark, sf_dir, _capped(capped.forest, capped.STACK_FOREST))


def stack_out_of_fold(spark, sf_dir):
    """Ridge stack of the three fitted models, without and with a constant column."""
    df = _stack_inputs(spark, sf_dir).withColumn("offset", F.lit(1.0))
    train = (F.col("data_set") == 0) & _held_out()
    plain = {s: (OWN[s], f"log_{s}") for s in SEGMENTS}
    offset = {s: ([*OWN[s], "offset"], f"log_{s}") for s in SEGMENTS}
    df, _ = linear.ridge_stack(df, plain, train)
    df, _ = linear.ridge_stack(df, offset, train, out="log_{}_stack_offset_pred")
    return df.select(*KEYS, TS, *[f"log_{s}_{c}_pred" for s in SEGMENTS for c in ("stack", "stack_offset")])


def feature_importance(spark, sf_dir):
    """Forest importances of both segments, ranked side by side."""
    _, models = learn.predict_residuals(
        _inputs(spark, sf_dir), SPEC, lambda label: trees.forest(label, **SMALL_FOREST)
    )
    return scoring.ranked_pairs(trees.importances(models, SPEC.hourly_features, spark), SEGMENTS)


def model_importances(spark, sf_dir):
    """Importances of boosted trees, AdaBoost, the daily forest and a stack, ranked per model."""
    inputs = _stack_inputs(spark, sf_dir)
    parts = {}
    for name, make in {
        "gbt": lambda label: trees.boosted(label, maxIter=FEW["gbt"], maxDepth=4),
        "adaboost": lambda label: AdaBoostR2(label, rounds=FEW["adaboost"], **TREE),
    }.items():
        _, models = learn.predict_residuals(inputs, SPEC, make)
        parts[name] = trees.importances(models, SPEC.hourly_features, spark)
    days = stage(learn.filled_daily(fx.day_features(spark, sf_dir), SPEC), "daily_inputs")
    parts["daily_forest"] = trees.importances(learn.daily_forests(days, SPEC, **DAILY_FOREST), SPEC.daily_features, spark)
    _, models = learn.fit_tree_stack(inputs, SPEC, OWN, SEARCHED["rf"], _held_out())
    parts["stack_forest"] = reduce(
        DataFrame.unionByName,
        [trees.importances({s: models[s]}, [*SPEC.hourly_features, *OWN[s]], spark) for s in SEGMENTS],
    )
    ranked = [scoring.ranked_pairs(p, SEGMENTS).withColumn("model", F.lit(name)) for name, p in parts.items()]
    return reduce(DataFrame.unionByName, ranked)


def lag_screening(spark, sf_dir):
    """Importance of every weather column and each of its 24 hourly lags."""
    feats = fx.kept_features(spark, sf_dir)
    counted = feats.where(F.coalesce(*SEGMENTS).isNotNull())
    residuals = forecast.residuals(counted, fx.daily_trend(feats), SPEC)
    fans = learn.lag_fans(learn.with_targets(feats, residuals, SPEC), SPEC, SPEC.covariates)
    parts = []
    for base in SPEC.covariates:
        scores = learn.screen_fan(fans, SPEC, base, lambda label: trees.forest(label, numTrees=FEW["forest"], maxDepth=6))
        parts.append(scoring.ranked_pairs(scores, SEGMENTS).withColumn("base", F.lit(base)))
    return reduce(DataFrame.unionByName, parts)


def forest_fold_search(spark, sf_dir):
    """Two forest settings on both hold-out folds, for both segments."""
    inputs = _inputs(spark, sf_dir).withColumn("fold", fold_label(TS)).where("fold IS NOT NULL")
    parts = []
    for s in SEGMENTS:
        label = f"log_{s}_diff"
        rows = trees.assemble(learn.training_rows(inputs, label), SPEC.hourly_features)
        candidates = {f"depth={d}": trees.forest(label, numTrees=5, maxDepth=d) for d in (3, 6)}
        parts.append(fold_search(rows, "fold", label, candidates).withColumn("segment", F.lit(s)))
    return reduce(DataFrame.unionByName, parts)


def model_fold_search(spark, sf_dir):
    """Hold-out errors of every family, segment and fold, appended to the score log and read back.

    Residual models are scored on ``log_S_diff``, stacks and the daily forest on ``log_S``.
    """
    path = scratch_path(spark, "cv_scores")
    hours = _stack_inputs(spark, sf_dir).withColumn("fold", fold_label(TS)).where("fold IS NOT NULL")
    days = stage(learn.filled_daily(fx.day_features(spark, sf_dir), SPEC), "daily_inputs")
    days = days.withColumn("fold", fold_label("day")).where("fold IS NOT NULL")

    def score(task):
        s, part = task
        diff, log = f"log_{s}_diff", f"log_{s}"
        held = learn.training_rows(hours, log).where(_held_out())
        if part == "residual":
            rows = trees.assemble(learn.training_rows(hours, diff), SPEC.hourly_features)
            candidates = {name: make(diff) for name, make in SEARCHED.items()}
            candidates["adaboost"] = AdaBoostR2(diff, rounds=FEW["adaboost"], **TREE)
            return fold_search(rows, "fold", diff, candidates, keep=[*KEYS, TS])
        if part == "stack":
            stacks = {"stack_rf": SEARCHED["rf"](log), "stack_gb": SEARCHED["gb"](log)}
            return fold_search(trees.assemble(held, [*SPEC.hourly_features, *OWN[s]]), "fold", log, stacks)
        if part == "daily":
            daily = trees.assemble(learn.training_rows(days, log), SPEC.daily_features)
            return fold_search(daily, "fold", log, {"daily_forest": trees.forest(log, **DAILY_FOREST)})
        ridge = linear.ridge_fold_scores(held.withColumn("segment", F.lit(s)), ["segment"], "fold", OWN[s], log, [1.0])
        return ridge.select(F.lit("stack_ridge").alias("params"), "fold", "mse", F.col("n").cast("bigint").alias("n"))

    tasks = [(s, part) for part in ("residual", "stack", "daily", "ridge") for s in SEGMENTS]
    scores = dict(zip(tasks, side_by_side(spark, score, tasks, 2)))
    for s in SEGMENTS:
        own = reduce(DataFrame.unionByName, [scores[s, part] for part in ("residual", "stack", "daily", "ridge")])
        tables.append_scores(own.withColumn("segment", F.lit(s)), path)
    return spark.read.parquet(path)


QUERIES = {
    f.__name__: f
    for f in (
        daily_trend_forest, daily_trend_gp, forecast_forest, forecast_smooth, forecast_scores, residual_forest, residual_gbt, residual_adaboost,
        residual_bagged_adaboost, stack_gbt, stack_forest, stack_out_of_fold, feature_importance,
        lag_screening, forest_fold_search, asked_rows_complete, model_importances, model_fold_search,
    )
}

# Fits have no SQL equivalent; tests/test_models.py checks their invariants.
ORACLES: dict[str, str] = {
    "asked_rows_complete": sql.panel(
        sql.GRID,
        """SELECT 'hours' AS part, count(*) AS asked, count(*) AS predicted FROM tagged WHERE submit = 1
UNION ALL SELECT 'days', count(*), count(*) FROM (SELECT DISTINCT user_id, ts::DATE FROM gridded)""",
    )
}
