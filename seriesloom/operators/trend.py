"""Daily trends without a fit, and daily values on the hourly grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def moving_average(
    daily: DataFrame, keys: list[str], day: str, cols: list[str], span: int = 3, suffix: str = "_ma"
) -> DataFrame:
    """Centred moving average over ``span`` daily rows."""
    side = span // 2
    around = Window.partitionBy(*keys).orderBy(day).rowsBetween(-side, span - 1 - side)
    return daily.withColumns({f"{c}{suffix}": F.avg(c).over(around) for c in cols})


def daily_to_hourly(
    hourly: DataFrame, daily: DataFrame, keys: list[str], ts: str, cols: list[str], complete: bool = False
) -> DataFrame:
    """Give each hour the daily values of its day, or of the last earlier day
    that has them.

    The days are completed, not the hours: a day's values are repeated up to the
    next row's day, and hours look theirs up by (series, day), so wide hourly
    rows are not sorted. Hours after the last daily row take its values by series;
    ``complete`` says that there are none and saves that look-up.
    """
    by_day = Window.partitionBy(*keys).orderBy("day")
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = daily.select(*keys, F.to_date("day").alias("day"), *cols)
    known = known.withColumns({c: F.last(c, True).over(upto) for c in cols}).withColumn("__next", F.lead("day").over(by_day))
    end = F.greatest("day", F.coalesce(F.date_sub("__next", 1), F.col("day")))
    filled = known.withColumn("__day", F.explode(F.sequence("day", end)))
    rest = [c for c in hourly.columns if c not in cols]

    def joined(rows: DataFrame, values: DataFrame, mark: str, *extra) -> DataFrame:
        named = values.select(*(F.col(k).alias(f"{mark}{k}") for k in keys), *(F.col(c).alias(f"{mark}{c}") for c in cols), *extra)
        on = [F.col(k).eqNullSafe(F.col(f"{mark}{k}")) for k in keys]
        if mark == "__on_":
            on.append(F.to_date(ts) == F.col("__day"))
        return rows.join(named, on, "left")

    out = joined(hourly.select(*rest), filled, "__on_", "__day")
    if complete:
        return out.select(*rest, *(F.col(f"__on_{c}").alias(c) for c in cols))
    out = joined(out, known.where("__next IS NULL"), "__past_", F.col("day").alias("__last"))
    past = F.to_date(ts) > F.col("__last")
    return out.select(*rest, *(F.when(past, F.col(f"__past_{c}")).otherwise(F.col(f"__on_{c}")).alias(c) for c in cols))
