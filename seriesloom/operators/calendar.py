"""Calendar corrections, date features and off-day run lengths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.scalars import date_part_columns, day_of, log_plus_one, micros_between
from seriesloom.operators.gaps import with_neighbours

MICROS_PER_HOUR = 3_600_000_000


def override_flags(
    df: DataFrame, ts: str, overrides: dict[dt.date, dict[str, int]]
) -> DataFrame:
    """Set flags on every row of the listed dates, e.g.
    ``{date(2024, 1, 15): {"workingday": 0, "holiday": 1}}``.

    The list is an argument, so it becomes literals in the projection: no join.
    """
    by_target: dict[str, dict[int, list[dt.date]]] = {}
    for day, flags in overrides.items():
        for name, value in flags.items():
            by_target.setdefault(name, {}).setdefault(value, []).append(day)
    changed: dict[str, Column] = {}
    for name, by_value in by_target.items():
        col = F.col(name)
        for value, days in by_value.items():
            col = F.when(day_of(ts).isin(days), F.lit(value)).otherwise(col)
        changed[name] = col.cast(df.schema[name].dataType)
    return df.withColumns(changed)


def add_date_parts(df: DataFrame, ts: str, base_year: int) -> DataFrame:
    return df.withColumns(date_part_columns(ts, base_year))


def add_log_targets(df: DataFrame, targets: list[str]) -> DataFrame:
    return df.withColumns({f"log_{c}": log_plus_one(c) for c in targets})


def offday_run_length(
    df: DataFrame,
    keys: list[str],
    ts: str,
    workingday: str = "workingday",
    out: str = "weekend",
    rows_per_day: int = 24,
    chunk: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Length in days of the run of off rows a row belongs to, 0 on working rows.

    On a complete hourly grid the length of a run is the distance between the
    working rows on either side (or the ends of the series), which the
    neighbour primitive already finds; no island numbering is needed, and the
    chunked form comes with it. ``until`` names the last hour that a row stands for,
    where rows are spans of hours (``gaps.spans``); a series' last row is one hour.
    """
    names = df.columns
    marked = df.withColumn("__w", F.when(F.coalesce(F.col(workingday), F.lit(1)) != 0, F.col(until or ts)))
    near = with_neighbours(marked, keys, ts, ["__w"], chunk, extent=True)
    hour = F.expr("INTERVAL 1 HOUR")
    opened = F.coalesce(F.col("__prev___w")["v"], F.col("__lo") - hour)
    closed = F.coalesce(F.col("__next___w")["t"], F.col("__hi") + hour)
    rows = micros_between(closed, opened) / F.lit(MICROS_PER_HOUR) - F.lit(1)
    length = (
        F.when(F.col(workingday).isNull(), None)
        .when(F.col(workingday) != 0, F.lit(0))
        .otherwise(F.floor(rows / F.lit(rows_per_day)))
        .cast("int")
    )
    return near.withColumn(out, length).select(*names, out)
