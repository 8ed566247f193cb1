"""Hour-of-day share profiles and the trend they spread over the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.scalars import exp_minus_one, log_plus_one, to_count


def normalise(df: DataFrame, pairs: dict[str, str], suffix: str = "_norm") -> DataFrame:
    """``y / daily total`` per pair; a total of zero gives NULL, which no mean counts."""
    return df.withColumns({f"{y}{suffix}": F.try_divide(F.col(y), F.col(t)) for y, t in pairs.items()})


def share_profile(
    hourly: DataFrame,
    keys: list[str],
    ts: str,
    shares: dict[str, Column],
    workingday: str = "workingday",
) -> DataFrame:
    """Mean share by (series, working day, hour), scaled to sum to 1 over the day.

    ``shares`` maps output names to the expression that is averaged. The mean
    combines map-side; what is shuffled is at most 48 rows per series and task.
    """
    per_hour = hourly.where(F.col(workingday).isNotNull()).groupBy(
        *keys, F.col(workingday), F.hour(ts).alias("hour")
    ).agg(*[F.avg(expr).alias(name) for name, expr in shares.items()])
    return _unit_sum(per_hour, keys, list(shares), workingday)


def geometric_profile(
    hourly: DataFrame,
    keys: list[str],
    ts: str,
    pairs: dict[str, tuple[str, str]],
    workingday: str = "workingday",
) -> DataFrame:
    """``share_profile`` by the geometric mean: ``pairs`` maps output names to
    (value, daily total)."""
    per_hour = hourly.where(F.col(workingday).isNotNull()).groupBy(
        *keys, F.col(workingday), F.hour(ts).alias("hour")
    ).agg(
        *[
            F.exp(F.avg(log_plus_one(y) - log_plus_one(total))).alias(name)
            for name, (y, total) in pairs.items()
        ]
    )
    return _unit_sum(per_hour, keys, list(pairs), workingday)


def _unit_sum(per_hour: DataFrame, keys, names, workingday) -> DataFrame:
    day = Window.partitionBy(*keys, workingday)
    return per_hour.withColumns({c: F.try_divide(F.col(c), F.sum(c).over(day)) for c in names})


def spread_over_day(
    hourly: DataFrame,
    profile: DataFrame,
    keys: list[str],
    ts: str,
    trend: dict[str, tuple[str, str]],
    workingday: str = "workingday",
) -> DataFrame:
    """Hourly trend = share of the hour x daily total, looked up by
    (series, working day, hour).

    ``trend`` maps output names to (share column, daily total column). An hour
    the profile never saw has share 0. The profile grows with the number of
    series, so it carries no broadcast hint; Spark compares its size with the
    broadcast threshold at run time.
    """
    names = hourly.columns
    looked_up = hourly.withColumn("hour", F.hour(ts)).join(
        profile, [*keys, workingday, "hour"], "left"
    )
    spread = {
        name: F.coalesce(F.col(share), F.lit(0.0)) * F.col(total)
        for name, (share, total) in trend.items()
    }
    return looked_up.withColumns(spread).select(*names, *trend)


def residual_targets(df: DataFrame, segments: list[str], trend: str = "{}_trend") -> DataFrame:
    """``log_S_trend`` and ``log_S_diff`` = log target - log trend, per segment."""
    logs = {f"log_{s}_trend": log_plus_one(trend.format(s)) for s in segments}
    with_logs = df.withColumns(logs)
    return with_logs.withColumns(
        {f"log_{s}_diff": F.col(f"log_{s}") - F.col(f"log_{s}_trend") for s in segments}
    )


def recombine(
    df: DataFrame,
    segments: list[str],
    residual: str = "{}_residual",
    log_trend: str = "log_{}_trend",
    out: str = "count_pred",
    rounding: str | None = None,
) -> DataFrame:
    """Residual + log trend, back to counts, summed over the segments."""
    logs = {f"log_{s}_pred": F.col(residual.format(s)) + F.col(log_trend.format(s)) for s in segments}
    df = df.withColumns(logs)
    total = sum((exp_minus_one(f"log_{s}_pred") for s in segments[1:]), exp_minus_one(f"log_{segments[0]}_pred"))
    return df.withColumn(out, to_count(total, rounding) if rounding else total)
