"""From two raw hourly tables to a decomposed panel.

Each function is a stage; :func:`seriesloom.session.stage` or
``sources.tables.write_table`` may be put between any two. ``features`` is the
one worth keeping, since the daily and the hourly side both read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import calendar as cal
from seriesloom.operators import gaps, grid, lags, profile, trend
from seriesloom.plans.spec import TEST, TRAIN, PanelSpec


def tag_and_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """One table with ``data_set`` (0 training, 1 test) and ``submit`` (1 on the
    test rows that were given, as opposed to hours filled in later)."""
    tagged = test.withColumns({"data_set": F.lit(TEST), "submit": F.lit(1)})
    return train.withColumn("data_set", F.lit(TRAIN)).unionByName(tagged, allowMissingColumns=True)


def repair(tagged: DataFrame, spec: PanelSpec) -> DataFrame:
    """Complete, repaired hours; ``C_filled`` are the counts with gaps bridged."""
    repaired = gaps.fill_grid(
        tagged,
        spec.keys,
        spec.ts,
        spec.linear,
        spec.ordinals,
        spec.flags,
        probe=spec.probe,
        max_missing=spec.max_missing,
        also={c: f"{c}_filled" for c in spec.counts},
    )
    return cal.override_flags(repaired, spec.ts, spec.overrides) if spec.overrides else repaired


def features(repaired: DataFrame, spec: PanelSpec) -> DataFrame:
    """Log targets, date parts, lags and off-day run lengths."""
    df = cal.add_log_targets(repaired, spec.counts)
    df = cal.add_date_parts(df, spec.ts, spec.base_year)
    df = lags.clock_lag(df, spec.keys, spec.ts, spec.lags)
    return cal.offday_run_length(df, spec.keys, spec.ts)


def _lines(tagged: DataFrame, spec: PanelSpec, counts: list[str]) -> DataFrame:
    return gaps.lines(tagged, spec.keys, spec.ts, spec.linear, spec.ordinals, spec.flags, spec.probe, counts)


def _spans(rows: DataFrame, spec: PanelSpec, packed: str | None = None) -> DataFrame:
    """``gaps.spans`` with flags corrected, and the run lengths of ``features``."""
    spread = gaps.spans(rows, spec.keys, spec.ts, spec.flags, spec.max_missing, packed)
    spread = cal.override_flags(spread, spec.ts, spec.overrides) if spec.overrides else spread
    return cal.offday_run_length(spread, spec.keys, spec.ts, until="__until")


def _dated(hours: DataFrame, spec: PanelSpec) -> DataFrame:
    return cal.add_date_parts(cal.add_log_targets(hours, spec.counts), spec.ts, spec.base_year)


def day_features(tagged: DataFrame, spec: PanelSpec) -> DataFrame:
    """``features`` of all hours but for the lags, which no daily value is made of.

    Run lengths are found among spans of hours, so no window holds the grid."""
    spread = _spans(_lines(tagged, spec, spec.counts), spec)
    filled = {c: f"{c}_filled" for c in spec.counts}
    return _dated(gaps.fill_spans(spread, spec.ts, spec.linear, spec.ordinals, filled), spec)


def asked_features(tagged: DataFrame, spec: PanelSpec, lagged: dict[str, list[int]] | None = None) -> DataFrame:
    """``features`` of the hours with a count and the test hours that were given, of which
    alone residual models are made: hours in between are looked through, not written.

    ``lagged`` stands in for the lags of ``spec``. Covariates that ``spec`` does not list stay
    as observed; counts are bridged where a lag of them is asked for."""
    lagged = spec.lags if lagged is None else lagged
    filled = {c: f"{c}_filled" for c in spec.counts if f"{c}_filled" in lagged}
    rows = _lines(tagged, spec, [*filled])
    if lagged:
        rows = lags.clock_lag_lines(rows, spec.keys, spec.ts, lagged, spec.ordinals, filled)
    rows = gaps.own_slots(rows, spec.ts, spec.linear, spec.ordinals, filled)
    spread = _spans(rows, spec, "__own").where("__own IS NOT NULL")
    return _dated(asked_rows(spread.select("*", "__own.*").drop("__own", "__until"), spec), spec)


def asked_rows(hours: DataFrame, spec: PanelSpec) -> DataFrame:
    """Training hours with a count, and the test hours that were given; hours
    that exist only because the grid was completed are neither."""
    return hours.where(F.col(spec.total).isNotNull() | (F.col("submit") == 1))


def daily(feats: DataFrame, spec: PanelSpec, counts_only: bool = False) -> DataFrame:
    """Daily sums and means; bad days bridged by interpolation.

    ``counts_only`` leaves out the calendar and weather means, which only a
    fitted trend needs.
    """
    filled = feats.drop(*spec.counts).withColumnsRenamed({f"{c}_filled": c for c in spec.counts})
    extra = [] if counts_only else ["workingday", "weekend", "day_of_week", "month", *spec.covariates]
    day = grid.daily_rollup(filled, spec.keys, spec.ts, spec.counts, ["data_set", "bad_day", *extra])
    bridged = spec.counts if counts_only else [*spec.counts, *spec.covariates]
    masked = grid.null_where(day, F.col("bad_day") == 1, bridged)
    return gaps.interpolate_time(masked, spec.keys, "day", bridged)


def daily_inputs(feats: DataFrame, spec: PanelSpec) -> DataFrame:
    """Daily targets and inputs of a trend model; test targets hidden."""
    day = cal.add_log_targets(daily(feats, spec), spec.counts)
    day = lags.daily_lag(day, spec.keys, "day", spec.covariates)
    day = grid.elapsed_days(day, spec.keys, "day")
    return grid.null_where(day, F.col("data_set") == TEST, [f"log_{c}" for c in spec.counts])


def average_trend(feats: DataFrame, spec: PanelSpec, span: int = 3) -> DataFrame:
    """``keys, day, S_total``: moving average over the training days."""
    known = grid.null_where(daily(feats, spec, counts_only=True), F.col("data_set") == TEST, spec.counts)
    averaged = trend.moving_average(known, spec.keys, "day", spec.segments, span, suffix="_total")
    return averaged.select(*spec.keys, "day", *[f"{s}_total" for s in spec.segments])


def with_totals(feats: DataFrame, daily_trend: DataFrame, spec: PanelSpec) -> DataFrame:
    """Hours with the daily trend ``S_total`` of their day, or of the last day that has one.

    The trend has a row for every day of the hours, which it was made of."""
    totals = [f"{s}_total" for s in spec.segments]
    return trend.daily_to_hourly(feats, daily_trend, spec.keys, spec.ts, totals, complete=True)


def shares(totals: DataFrame, spec: PanelSpec) -> DataFrame:
    """Hour-of-day profile ``S_share`` by series and kind of day."""
    norm = profile.normalise(totals, {s: f"{s}_total" for s in spec.segments})
    means = {f"{s}_share": F.col(f"{s}_norm") for s in spec.segments}
    return profile.share_profile(norm, spec.keys, spec.ts, means)


def hourly_trend(totals: DataFrame, spec: PanelSpec) -> DataFrame:
    """``S_trend`` = share of the hour x daily total."""
    spread = {f"{s}_trend": (f"{s}_share", f"{s}_total") for s in spec.segments}
    return profile.spread_over_day(totals, shares(totals, spec), spec.keys, spec.ts, spread)


def residuals(feats: DataFrame, daily_trend: DataFrame, spec: PanelSpec) -> DataFrame:
    """Everything the residual models need: ``log_S_trend`` and ``log_S_diff``."""
    totals = with_totals(feats, daily_trend, spec)
    return profile.residual_targets(hourly_trend(totals, spec), spec.segments)
