"""Fitted trends, residual models and stacks over a decomposed panel."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.scalars import exp_minus_one
from seriesloom.models import smoother, trees
from seriesloom.operators import lags, profile
from seriesloom.plans import forecast
from seriesloom.plans.forecast import asked_rows, daily
from seriesloom.plans.spec import TEST, TRAIN, PanelSpec
from seriesloom.session import side_by_side, stage

MakeEstimator = Callable[[str], Estimator]


def usable(rows: DataFrame, features: list[str]) -> DataFrame:
    """Complete training rows and all test rows, with 0 for what the latter lack."""
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(c).isNotNull()
    return rows.where((F.col("data_set") == TEST) | whole).fillna(0, subset=features)


def filled_daily(feats: DataFrame, spec: PanelSpec) -> DataFrame:
    """Daily inputs with every covariate filled from the series' next day, then from
    its last one; what a series never saw counts as 0. No day is lost."""
    day = forecast.daily_inputs(feats, spec)
    later = Window.partitionBy(*spec.keys).orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*spec.keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    day = day.withColumns({c: F.last(c, ignorenulls=True).over(later) for c in spec.daily_features})
    day = day.withColumns({c: F.last(c, ignorenulls=True).over(earlier) for c in spec.daily_features})
    return day.fillna(0, subset=spec.daily_features)


def daily_forests(inputs: DataFrame, spec: PanelSpec, **params) -> dict:
    """One fitted forest per segment on the training days."""
    rows = trees.assemble(inputs, spec.daily_features)
    fit = lambda s: trees.forest(f"log_{s}", f"log_{s}_hat", **params).fit(training_rows(rows, f"log_{s}"))
    return dict(zip(spec.segments, side_by_side(inputs.sparkSession, fit, spec.segments)))


def forest_trend(inputs: DataFrame, spec: PanelSpec, **params) -> DataFrame:
    """``keys, day, S_total`` from one forest per segment on the daily inputs."""
    rows = trees.assemble(inputs, spec.daily_features)
    for model in daily_forests(inputs, spec, **params).values():
        rows = model.transform(rows)
    totals = [exp_minus_one(f"log_{s}_hat").alias(f"{s}_total") for s in spec.segments]
    return rows.select(*spec.keys, "day", *totals)


def smooth_trend(
    feats: DataFrame, spec: PanelSpec, nuggets: dict[str, float], thetas: list[float] | None = None
) -> DataFrame:
    """``keys, day, S_total`` from a smooth curve per series, segment and kind of
    day, fitted to the good training days."""
    day = stage(daily(feats, spec).select(*spec.keys, "day", "workingday", "data_set", "bad_day", *spec.segments), "smooth_days")
    elapsed = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("double")
    fit_on = (F.col("data_set") == TRAIN) & (F.col("bad_day") == 0)
    entries = F.array(
        *[
            F.struct(
                F.lit(s).alias("segment"),
                F.when(fit_on, F.log1p(s)).alias("y"),
                F.lit(nuggets[s]).alias("nugget"),
            )
            for s in spec.segments
        ]
    )
    long = day.select(
        *spec.keys, "day", (F.col("workingday") >= 0.5).cast("int").alias("workingday"),
        elapsed.alias("x"), F.explode(entries).alias("e"),
    ).select(*spec.keys, "day", "workingday", "x", "e.segment", "e.y", "e.nugget")
    group = [*spec.keys, "segment", "workingday"]
    curve = smoother.smooth(long, group, "x", "y", "nugget", thetas)
    back = F.date_add(F.lit("1970-01-01").cast("date"), F.col("x").cast("int"))
    cells = [
        F.max(F.when(F.col("segment") == s, exp_minus_one("y_hat"))).alias(f"{s}_total")
        for s in spec.segments
    ]
    return curve.withColumn("day", back).groupBy(*spec.keys, "day").agg(*cells)


def residual_inputs(residuals: DataFrame, spec: PanelSpec, extra: list[str] | None = None) -> DataFrame:
    """Rows to fit and predict, narrowed and staged. Incomplete training rows go;
    every asked test row stays, a feature it lacks counting as 0."""
    keep = [
        *spec.keys, spec.ts, "data_set", spec.total, *spec.hourly_features, *(extra or []),
        *[f"log_{s}{suffix}" for s in spec.segments for suffix in ("_trend", "_diff", "")],
    ]
    complete = asked_rows(residuals, spec).select(*dict.fromkeys(keep))
    return stage(usable(complete, [*spec.hourly_features, *(extra or [])]), "residual_inputs")


def training_rows(inputs: DataFrame, label: str) -> DataFrame:
    return inputs.where((F.col("data_set") == TRAIN) & F.col(label).isNotNull())


def predict_residuals(inputs: DataFrame, spec: PanelSpec, make: MakeEstimator) -> tuple[DataFrame, dict]:
    """Fit one model per segment on ``log_S_diff``; add ``S_residual``, the
    recombined ``log_S_pred`` and ``count_pred``. Also returns the models."""
    rows = trees.assemble(inputs, spec.hourly_features)
    fit = lambda s: make(f"log_{s}_diff").fit(training_rows(rows, f"log_{s}_diff"))
    models = dict(zip(spec.segments, side_by_side(inputs.sparkSession, fit, spec.segments)))
    for s in spec.segments:
        rows = models[s].transform(rows).withColumnRenamed("prediction", f"{s}_residual")
    return profile.recombine(rows, spec.segments), models


def out_of_fold(
    inputs: DataFrame, spec: PanelSpec, make: MakeEstimator, fold: Column, folds: list[int], name: str
) -> DataFrame:
    """``log_S_NAME_pred`` for a stack. A fold's rows are predicted by a model
    that did not see them; test rows and rows that always train, by a model of
    all training rows."""
    rows = trees.assemble(inputs, spec.hourly_features).withColumn("__fold", fold)
    given = rows

    def fit(task: tuple[str, int | None]):
        label = f"log_{task[0]}_diff"
        train = training_rows(given, label)
        return make(label).fit(train if task[1] is None else train.where(F.coalesce(F.col("__fold"), F.lit(-1)) != task[1]))

    tasks = [(s, k) for s in spec.segments for k in (None, *folds)]
    models = dict(zip(tasks, side_by_side(inputs.sparkSession, fit, tasks)))
    # A row is read by the models of its own fold only, so a task scores two at a time, however many folds there are.
    held_out = F.when((F.col("data_set") == TRAIN) & F.col("__fold").isin(folds), F.col("__fold"))
    parts = []
    for k in (None, *folds):
        part = rows.where(held_out.isNull() if k is None else held_out == k)
        for s in spec.segments:
            part = models[s, k].transform(part).withColumnRenamed("prediction", "__residual")
            part = part.withColumn(f"log_{s}_{name}_pred", F.col("__residual") + F.col(f"log_{s}_trend")).drop("__residual")
        parts.append(part.select(*spec.keys, spec.ts, *(f"log_{s}_{name}_pred" for s in spec.segments)))
    return reduce(DataFrame.unionByName, parts)


def tree_stack(
    inputs: DataFrame, spec: PanelSpec, own: dict[str, list[str]], make: MakeEstimator, fit_on: Column | None = None
) -> DataFrame:
    """Stack on all features plus a segment's own base predictions, target ``log_S``."""
    return fit_tree_stack(inputs, spec, own, make, fit_on)[0]


def fit_tree_stack(
    inputs: DataFrame, spec: PanelSpec, own: dict[str, list[str]], make: MakeEstimator, fit_on: Column | None = None
) -> tuple[DataFrame, dict]:
    """The same with the models, which see the training rows that meet ``fit_on``."""
    fit_on = F.lit(True) if fit_on is None else fit_on
    given = inputs

    def fit(s: str):
        rows = trees.assemble(given, [*spec.hourly_features, *own[s]])
        return make(f"log_{s}").fit(training_rows(rows, f"log_{s}").where(fit_on))

    models = dict(zip(spec.segments, side_by_side(inputs.sparkSession, fit, spec.segments)))
    for s in spec.segments:
        rows = trees.assemble(inputs, [*spec.hourly_features, *own[s]])
        inputs = models[s].transform(rows).withColumnRenamed("prediction", f"log_{s}_stack_pred")
        inputs = inputs.drop("features")
    return inputs, models


def with_targets(feats: DataFrame, residuals: DataFrame, spec: PanelSpec) -> DataFrame:
    """``keys, ts, data_set``, covariates and ``log_S_diff`` of every hour; hours without a
    residual have none.

    Rows are laid by series before they are matched, which the lag windows need anyway.
    """
    on, targets = [*spec.keys, spec.ts], [f"log_{s}_diff" for s in spec.segments]
    hours = feats.select(*on, "data_set", *spec.covariates)
    stacked = hours.unionByName(residuals.select(*on, *targets), allowMissingColumns=True)
    laid = stacked.repartition(*spec.keys) if spec.keys else stacked
    return laid.groupBy(*on).agg(*(F.max(c).alias(c) for c in ["data_set", *spec.covariates, *targets]))


def lag_fans(residuals: DataFrame, spec: PanelSpec, bases: list[str], up_to: int = 24) -> DataFrame:
    """Training rows with all targets, next to every lag of all ``bases`` over one sort; staged."""
    targets = [f"log_{s}_diff" for s in spec.segments]
    fan = residuals.select(*spec.keys, spec.ts, "data_set", *bases, *targets)
    for base in bases:
        fan = lags.lag_fan_out(fan, spec.keys, spec.ts, base, up_to)
    known = fan.where(F.col("data_set") == TRAIN).na.drop(subset=[*spec.keys, spec.ts, *targets])
    return stage(known, "lag_fans")


def screen_fan(fans: DataFrame, spec: PanelSpec, base: str, make: MakeEstimator, up_to: int = 24) -> DataFrame:
    """How much each lag of one of the ``lag_fans`` tells about the residuals:
    ``(segment, feature, importance)`` of models that see the column and its lags only."""
    names = [base, *[lags.lag_name(base, k) for k in range(1, up_to + 1)]]
    targets = [f"log_{s}_diff" for s in spec.segments]
    rows = trees.assemble(fans.select(*names, *targets).na.drop(), names)
    models = dict(zip(spec.segments, side_by_side(fans.sparkSession, lambda s: make(f"log_{s}_diff").fit(rows), spec.segments)))
    return trees.importances(models, names, fans.sparkSession)


def screen_lags(
    residuals: DataFrame, spec: PanelSpec, base: str, make: MakeEstimator, up_to: int = 24
) -> DataFrame:
    """``screen_fan`` of a single covariate."""
    return screen_fan(lag_fans(residuals, spec, [base], up_to), spec, base, make, up_to)
