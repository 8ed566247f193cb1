"""The whole forecast on CSV input of the original shape: one gappy series."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from seriesloom.functions.scalars import fold_label
from seriesloom.models import trees
from seriesloom.operators import lags, predictions, scoring
from seriesloom.plans import forecast, learn
from seriesloom.plans.spec import PanelSpec
from seriesloom.session import stage
from seriesloom.sources import csv, tables

HEAD = "datetime,season,holiday,workingday,weather,temp,atemp,humidity,windspeed"
SPEC = PanelSpec(["series"], "datetime")


@pytest.fixture(scope="module")
def feats(spark, tmp_path_factory):
    """Three months of hours: a commuting pattern, a warmer and colder cycle, holes."""
    rng = random.Random(1)
    train, test = [HEAD + ",casual,registered,count"], [HEAD]
    for i in range(91 * 24):
        ts = dt.datetime(2011, 1, 1) + dt.timedelta(hours=i)
        if rng.random() < 0.02 or (ts.date() == dt.date(2011, 2, 9) and ts.hour > 5):
            continue
        work = int(ts.weekday() < 5)
        temp = 10 + 8 * math.sin(i / 24 / 14)
        row = f"{ts},1,0,{work},{rng.choice([1, 1, 2])},{temp:.2f},{temp + 1:.2f},{rng.randint(40, 80)},{rng.randint(0, 9)}.0"
        peak = math.exp(-((ts.hour - (8 if work else 14)) ** 2) / 8)
        casual, registered = int((5 + 60 * peak) * temp / 10), int((10 + 200 * peak) * temp / 10)
        if ts.day <= 19:
            train.append(f"{row},{casual},{registered},{casual + registered}")
        else:
            test.append(row)
    folder = tmp_path_factory.mktemp("input")
    for name, lines in (("train", train), ("test", test)):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    parts = [
        csv.read_hourly_csv(spark, str(folder / f"{n}.csv"), n == "train").drop("season").withColumn("series", F.lit("all"))
        for n in ("train", "test")
    ]
    tagged = forecast.tag_and_union(*parts)
    df = stage(forecast.features(forecast.repair(tagged, SPEC), SPEC), "features")
    return df.cache()


def score(df):
    known = df.where(F.col("data_set") == 0).where(F.col("count").isNotNull())
    return scoring.rmsle(known, [], "count", "count_pred").first().rmsle


def trend_score(df):
    return score(df.withColumn("count_pred", F.col("registered_trend") + F.col("casual_trend")))


def test_the_grid_is_complete_and_unique(feats):
    lo, hi, n, distinct = feats.agg(
        F.min("datetime"), F.max("datetime"), F.count("*"), F.countDistinct("datetime")
    ).first()
    assert n == distinct == (hi - lo).total_seconds() / 3600 + 1
    holes = [c for c in [*SPEC.covariates, *SPEC.flags] if feats.where(F.col(c).isNull()).count()]
    assert holes == []
    assert {r[0] for r in feats.where("bad_day = 1").select(F.to_date("datetime")).distinct().collect()} >= {
        dt.date(2011, 2, 9)
    }


def test_forest_trend_to_submission(spark, feats, tmp_path):
    daily = learn.forest_trend(
        stage(forecast.daily_inputs(feats, SPEC), "daily"), SPEC, numTrees=20, maxDepth=6
    )
    residuals = stage(forecast.residuals(feats, stage(daily, "trend"), SPEC), "residuals")
    assert trend_score(residuals) < 0.5
    inputs = learn.residual_inputs(residuals, SPEC)
    preds, models = learn.predict_residuals(
        inputs, SPEC, lambda label: trees.forest(label, numTrees=10, maxDepth=8)
    )
    # A residual model may not be worse than the trend it corrects.
    assert score(preds) <= trend_score(residuals)
    assert set(models) == {"registered", "casual"}

    asked = preds.where((F.col("data_set") == 1))
    table = predictions.submission(asked, ["series"], "datetime", ["log_registered_pred", "log_casual_pred"])
    path = str(tmp_path / "submit")
    tables.write_submission(table, path, ["datetime"], "count")
    out = csv.read_csv(spark, path, "datetime timestamp_ntz, count int")
    assert out.count() == feats.where("submit = 1").count()
    assert out.where("count < 0 OR count IS NULL").count() == 0


def test_smooth_trend_covers_every_day(feats):
    curve = learn.smooth_trend(feats, SPEC, {"registered": 0.5, "casual": 2.0}, [1.0, 10.0])
    assert curve.count() == feats.select(F.to_date("datetime")).distinct().count() == 91
    assert curve.where("registered_total IS NULL OR casual_total IS NULL").count() == 0
    residuals = forecast.residuals(feats, stage(curve, "curve"), SPEC)
    assert trend_score(residuals) < 0.5


def test_average_trend_profile_has_unit_shares(feats):
    totals = forecast.with_totals(feats, forecast.average_trend(feats, SPEC), SPEC)
    sums = forecast.shares(totals, SPEC).groupBy("workingday").agg(
        F.sum("registered_share").alias("r"), F.count("*").alias("n")
    )
    assert [(r.n, round(r.r, 9)) for r in sums.orderBy("workingday").collect()] == [(24, 1.0), (24, 1.0)]


def test_stack_and_lag_screening(feats):
    residuals = stage(forecast.residuals(feats, stage(forecast.average_trend(feats, SPEC), "t"), SPEC), "r")
    inputs = learn.residual_inputs(residuals, SPEC)
    base = learn.out_of_fold(
        inputs, SPEC, lambda label: trees.forest(label, numTrees=3, maxDepth=4), fold_label("datetime"), [0, 1], "rf"
    )
    joined = stage(inputs.join(base, ["series", "datetime"]), "joined")
    own = {s: [f"log_{s}_rf_pred"] for s in SPEC.segments}
    out = learn.tree_stack(joined, SPEC, own, lambda label: trees.forest(label, numTrees=3, maxDepth=4))
    assert out.count() == inputs.count()
    assert out.where("log_registered_stack_pred IS NULL OR log_casual_stack_pred IS NULL").count() == 0
    scores = learn.screen_lags(residuals, SPEC, "temp", lambda label: trees.forest(label, numTrees=3, maxDepth=4), 3)
    assert scores.count() == 8
    assert scores.groupBy("segment").agg(F.sum("importance").alias("s")).where("abs(s - 1) > 1e-6").count() == 0


def test_lags_of_all_columns_come_from_one_staged_table(feats, monkeypatch):
    trend = stage(forecast.average_trend(feats, SPEC), "t")
    counted = feats.where(F.coalesce(*SPEC.segments).isNotNull())
    joined = stage(learn.with_targets(feats, forecast.residuals(counted, trend, SPEC), SPEC), "j")
    targets = [f"log_{s}_diff" for s in SPEC.segments]
    names = [*SPEC.keys, SPEC.ts, "data_set", *SPEC.covariates, *targets]
    whole = forecast.residuals(feats, trend, SPEC).select(*names)
    rows = lambda df: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    assert rows(joined.select(*names)) == rows(whole)

    staged = []
    monkeypatch.setattr(learn, "stage", lambda df, name: staged.append(name) or stage(df, name))
    fans = learn.lag_fans(joined, SPEC, SPEC.covariates, 3)
    for base in SPEC.covariates:
        own = [base, *[lags.lag_name(base, k) for k in (1, 2, 3)], *targets]
        alone = lags.lag_fan_out(whole.select(*SPEC.keys, SPEC.ts, "data_set", base, *targets), SPEC.keys, SPEC.ts, base, 3)
        assert rows(fans.select(*own).na.drop()) == rows(alone.where("data_set = 0").na.drop().select(*own)) != []
    assert staged == ["lag_fans"]
