"""Complete time grids, and coarser roll-ups of them.

Rows per series on a grid are bounded by the calendar, not by traffic: an
hourly series holds at most 8,784 rows a year however many raw events fed it.
Windows keyed by series are therefore safe *after* the hourly aggregation, and
that aggregation combines map-side, so a series with a third of all events
costs one row per hour and map task. Series without such a bound (finer or
irregular stamps) take the ``chunk`` argument of the gap operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.scalars import day_of, hour_of, micros_between
from seriesloom.session import spread_by_keys


def hourly_buckets(
    df: DataFrame, keys: list[str], ts: str, aggregates: list[Column]
) -> DataFrame:
    """Raw rows to one row per observed (series, hour)."""
    slot = hour_of(ts).alias(ts)
    return df.groupBy(*keys, slot).agg(*aggregates)


def regular_grid(
    df: DataFrame, keys: list[str], ts: str, step: str = "1 HOUR"
) -> DataFrame:
    """Every slot from a series' first to its last stamp; absent ones are NULL rows.

    Each row is stretched up to the slot before the next row of its series, so
    the grid needs one shuffle by series and no join. A stamp that repeats, or
    that does not lie on the series' steps, is refused by name on the way.
    """
    interval = F.expr(f"INTERVAL {step}")
    following = F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts))
    values = [c for c in df.columns if c not in keys and c != ts]
    rows = spread_by_keys(df, keys).withColumn("__next", following)
    slots = rows.withColumn("__until", on_step(F.col("__next") - interval, keys, ts, "__next", interval)).withColumn(
        "__slot", F.explode(F.sequence(F.col(ts), F.col("__until"), interval))
    )
    observed = F.col("__slot") == F.col(ts)
    return slots.select(
        *keys,
        F.col("__slot").alias(ts),
        *[F.when(observed, F.col(c)).alias(c) for c in values],
    )


def on_step(until: Column, keys: list[str], ts: str, following: str, interval: Column) -> Column:
    """``until``, or the stamp itself where no row follows; an error naming the series if the next stamp is not whole steps later."""
    gap, length = micros_between(following, ts), micros_between(F.col(ts) + interval, ts)
    named = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys))
    told = F.concat(
        F.when(gap == 0, "repeated stamp ").otherwise("stamp off the step after "), F.col(ts).cast("string"), F.lit(" in series "), named,
    )
    return F.when(F.col(following).isNull(), F.col(ts)).when((gap > 0) & (gap % length == 0), until).otherwise(F.raise_error(told))


def spine(df: DataFrame, keys: list[str], ts: str, step: str = "1 HOUR") -> DataFrame:
    """Only the slots, from each series' extent (a map-side min/max).

    Days are laid out first and spread before they become slots, so one very
    long series is not unrolled by a single task.
    """
    interval = F.expr(f"INTERVAL {step}")
    one_day = F.expr("INTERVAL 1 DAY")
    extent = df.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    first_midnight = F.date_trunc("day", "__lo").cast("timestamp_ntz")
    days = extent.withColumn(
        "__day", F.explode(F.sequence(first_midnight, F.col("__hi"), one_day))
    ).repartition(*keys, "__day")
    slots = days.withColumn(
        ts, F.explode(F.sequence("__day", F.col("__day") + one_day - interval, interval))
    )
    return slots.where(F.col(ts).between(F.col("__lo"), F.col("__hi"))).select(*keys, ts)


def spine_grid(df: DataFrame, keys: list[str], ts: str, step: str = "1 HOUR") -> DataFrame:
    """``regular_grid`` by joining a spine on ``(keys, ts)``.

    Costs a join but no window keyed by series: the form for few, long series.
    """
    return spine(df, keys, ts, step).join(df, [*keys, ts], "left")


def missing_by_day(
    grid: DataFrame, keys: list[str], ts: str, probe: str, max_missing: int = 2
) -> DataFrame:
    """Days with missing slots, their count, and whether the day counts as bad."""
    missing = F.count_if(F.col(probe).isNull())
    return (
        grid.groupBy(*keys, day_of(ts).alias("day"))
        .agg(missing.alias("missing"))
        .where(F.col("missing") > 0)
        .withColumn("bad_day", (F.col("missing") > max_missing).cast("int"))
    )


def flag_bad_days(
    grid: DataFrame, keys: list[str], ts: str, probe: str, max_missing: int = 2
) -> DataFrame:
    """Mark all slots of a day that misses more than ``max_missing`` of them.

    The window holds one day of one series.
    """
    per_day = Window.partitionBy(*keys, day_of(ts))
    missing = F.count_if(F.col(probe).isNull()).over(per_day)
    return grid.withColumn("bad_day", (missing > max_missing).cast("int"))


def null_where(df: DataFrame, condition: Column, cols: list[str]) -> DataFrame:
    """Replace ``cols`` by NULL on the rows that meet ``condition``."""
    masked = {c: F.when(condition, None).otherwise(F.col(c)) for c in cols}
    return df.withColumns(masked)


def daily_rollup(
    hourly: DataFrame,
    keys: list[str],
    ts: str,
    sums: list[str],
    means: list[str],
    midnights: list[str] | None = None,
) -> DataFrame:
    """Hourly to daily: sums and means; a day without values stays NULL.

    ``midnights`` are columns that keep the value stamped at the day's midnight.
    """
    picks = [F.max(F.when(F.hour(ts) == 0, F.col(c))).alias(c) for c in midnights or []]
    return hourly.groupBy(*keys, day_of(ts).alias("day")).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means], *picks
    )


def elapsed_days(df: DataFrame, keys: list[str], day: str, out: str = "elapsed") -> DataFrame:
    """Days since the first day of the series, for daily rows."""
    first = F.min(day).over(Window.partitionBy(*keys))
    return df.withColumn(out, F.datediff(day, first).cast("double"))
