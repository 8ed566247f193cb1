"""Hourly and daily panels derived from the given tables, stage by stage.

The role mapping onto ``events``: a user is a series; ``registered`` are
purchases and signups, ``casual`` are clicks and views; weather columns are
hourly means of ``value`` (in hundredths, so that sums are exact), overall and
for single event types; days 1 to 19 of each month are the training part, later
ones the test part, whose counts are hidden.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.scalars import day_of
from seriesloom.operators import gaps, grid
from seriesloom.plans import forecast
from seriesloom.plans.spec import SCREENED_LAGS, PanelSpec
from seriesloom.session import prepare, stage

KEYS = ["user_id"]
TS = "ts"
SEGMENTS = ["registered", "casual"]
COUNTS = ["casual", "registered", "count"]
LINEAR = ["temp", "atemp", "windspeed"]
ORDINALS = ["weather", "humidity"]
WEATHER = ["atemp", "humidity", "temp", "weather", "windspeed"]
FLAGS = ["workingday", "holiday", "data_set"]
# The last days of each month are the test part.
HELD_OUT_AFTER = 19
# A user is active in few hours, so only a day without any counts as bad.
MAX_MISSING = 23
BASE_YEAR = 2024
OVERRIDES = {
    dt.date(2024, 1, 15): {"workingday": 0, "holiday": 1},
    dt.date(2024, 1, 20): {"workingday": 1, "holiday": 0},
}
LAGS = SCREENED_LAGS
SPEC = PanelSpec(
    KEYS, TS, SEGMENTS, max_missing=MAX_MISSING, base_year=BASE_YEAR, overrides=OVERRIDES
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(stamp: str = TS) -> Column:
    return F.dayofmonth(stamp) > HELD_OUT_AFTER


def observed(events: DataFrame) -> DataFrame:
    """One row per user and hour with events."""
    kind = F.col("event_type")
    hundredths = F.rint(F.col("value") * 100).cast("bigint")

    def mean_of(which):
        return F.try_divide(F.sum(F.when(kind == which, hundredths)), F.count_if(kind == which))

    hourly = grid.hourly_buckets(
        events,
        KEYS,
        TS,
        [
            F.count_if(kind.isin("purchase", "signup")).alias("registered"),
            F.count_if(kind.isin("click", "view")).alias("casual"),
            F.count_if(kind == "error").cast("int").alias("weather"),
            (F.sum(hundredths) / F.count(F.lit(1))).alias("temp"),
            mean_of("click").alias("atemp"),
            F.rint(mean_of("view") / 100).cast("int").alias("humidity"),
            mean_of("purchase").alias("windspeed"),
        ],
    )
    return hourly.withColumn("count", F.col("registered") + F.col("casual")).withColumns(
        {"workingday": (F.weekday(TS) < 5).cast("int"), "holiday": F.lit(0)}
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and test parts, tagged, in one table; test counts are missing.

    One pass over the events: no hour lies in both parts.
    """
    hours = grid.null_where(observed(table(spark, sf_dir, "events")), held_out(), COUNTS)
    return hours.withColumns({"data_set": held_out().cast("int"), "submit": F.when(held_out(), 1)})


def tagged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two inputs, as training and test files would come."""
    events = table(spark, sf_dir, "events")
    train = observed(events.where(~held_out()))
    test = observed(events.where(held_out())).drop(*COUNTS)
    return forecast.tag_and_union(train, test)


def gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.regular_grid(tagged(spark, sf_dir), KEYS, TS)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.repair(tagged(spark, sf_dir), SPEC)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.features(clean(spark, sf_dir), SPEC)


def day_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all hours without the lags, for daily values."""
    return forecast.day_features(tagged(spark, sf_dir), SPEC)


def kept_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly features as a table, since the trend reads them by day and by hour.

    Only what the decomposition needs is computed and written: the lags and most
    of the weather fall out of the plan.
    """
    df = features(spark, sf_dir).select(
        *KEYS, TS, "hour", "workingday", "data_set", "submit", "bad_day", *WEATHER,
        *[f"{p}{c}" for c in COUNTS for p in ("", "log_")], *[f"{c}_filled" for c in COUNTS],
    )
    return stage(df, "features")


def asked_hours(
    spark: SparkSession, sf_dir: str, lagged: dict[str, list[int]] | None = None, covariates: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Features of the asked hours as a table, and those of all hours, of which the trend is
    made by day without writing them. ``covariates`` names those that are needed, if not all
    are, nor run lengths, which then fall out of the plan."""
    observed = stage(tagged(spark, sf_dir), "observed")
    if covariates is None:
        asked = forecast.asked_features(observed, SPEC, lagged)
    else:
        spec = replace(SPEC, linear=[c for c in LINEAR if c in covariates], ordinals=[c for c in ORDINALS if c in covariates])
        asked = forecast.asked_features(observed, spec, lagged).drop("weekend")
    return stage(asked, "asked_hours"), forecast.day_features(observed, SPEC)


def asked_residuals(spark: SparkSession, sf_dir: str, *needed) -> DataFrame:
    """``residuals`` of the asked hours, which are made as in ``asked_hours``."""
    asked, hours = asked_hours(spark, sf_dir, *needed)
    return forecast.residuals(asked, daily_trend(hours), SPEC)


def profile_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``totals`` is to a profile: hours with a count next to the trend of their day, and
    every hour without either, of which a profile only has the kind of day and the clock."""
    asked, hours = asked_hours(spark, sf_dir, {}, [])
    counted = forecast.with_totals(asked, daily_trend(hours), SPEC)
    slot = [*KEYS, TS, "workingday"]
    counted = counted.select(*slot, *SEGMENTS, *[f"{s}_total" for s in SEGMENTS])
    return counted.unionByName(hours.select(*slot), allowMissingColumns=True)


def daily_trend(feats: DataFrame) -> DataFrame:
    """Moving-average trend, kept too: the profile and the hourly trend read it."""
    return stage(forecast.average_trend(feats, SPEC), "daily_trend")


def totals(feats: DataFrame) -> DataFrame:
    """Hours with the moving-average trend of their day."""
    return forecast.with_totals(feats, daily_trend(feats), SPEC)


def residuals(feats: DataFrame) -> DataFrame:
    return forecast.residuals(feats, daily_trend(feats), SPEC)


def by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few, dense series: hourly count and mean value of each event type."""
    events = table(spark, sf_dir, "events")
    hundredths = F.rint(F.col("value") * 100).cast("bigint")
    return grid.hourly_buckets(
        events,
        ["event_type"],
        TS,
        [F.count(F.lit(1)).alias("n"), (F.sum(hundredths) / F.count(F.lit(1))).alias("level")],
    ).withColumn("workingday", (F.weekday(TS) < 5).cast("int"))


def by_type_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.spine_grid(by_type(spark, sf_dir), ["event_type"], TS)


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their value per priority and observed day."""
    orders = table(spark, sf_dir, "orders")
    hundredths = F.rint(F.col("o_totalprice") * 100).cast("bigint")
    return orders.groupBy("o_orderpriority", day_of("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hundredths).alias("amount"),
        F.count_if(F.col("o_orderstatus") == "F").alias("closed"),
    )


def orders_daily_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = grid.regular_grid(orders_daily(spark, sf_dir), ["o_orderpriority"], "day", "1 DAY")
    return gaps.interpolate_time(full, ["o_orderpriority"], "day", ["n", "amount", "closed"])
