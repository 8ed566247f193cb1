"""Column expressions: log targets, date parts, rounding, fold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hold-out plan by day of month. Days 1-5 are fold 0, 6-14
# always train (-1), 15-19 are fold 1; later days carry no label.
FOLD_BY_LAST_DAY = ((5, 0), (14, -1), (19, 1))


def hour_of(ts: str | Column) -> Column:
    """Start of the hour, still without a zone."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_of(ts: str | Column) -> Column:
    return F.to_date(ts)


def log_plus_one(x: str | Column) -> Column:
    return F.log1p(x)


def exp_minus_one(x: str | Column) -> Column:
    return F.expm1(x)


def to_count(x: str | Column, rounding: str = "half_even") -> Column:
    """Whole number from a real one: ``half_even`` rounds, ``truncate`` cuts."""
    col = F.col(x) if isinstance(x, str) else x
    if rounding == "half_even":
        return F.rint(col).cast("bigint")
    if rounding == "truncate":
        return col.cast("bigint")
    raise ValueError(f"unknown rounding {rounding!r}")


def date_part_columns(ts: str, base_year: int) -> dict[str, Column]:
    """Integer date parts; ``day_of_week`` starts at Monday = 0."""
    t = F.col(ts)
    return {
        "year": F.year(t) - F.lit(base_year),
        "month": F.month(t),
        "day_of_week": F.weekday(t),
        "day_of_year": F.dayofyear(t),
        "hour": F.hour(t),
    }


def fold_label(
    ts: str | Column, plan: Sequence[tuple[int, int]] = FOLD_BY_LAST_DAY
) -> Column:
    """Fold number from the day of month; NULL after the last listed day."""
    day = F.dayofmonth(ts)
    label = None
    for last_day, fold in plan:
        hit = day <= last_day
        label = F.when(hit, F.lit(fold)) if label is None else label.when(hit, F.lit(fold))
    return label.cast("int")


def micros_between(later: str | Column, earlier: str | Column) -> Column:
    """Elapsed time as a DOUBLE count of microseconds."""
    a = F.unix_micros(F.col(later).cast("timestamp") if isinstance(later, str) else later.cast("timestamp"))
    b = F.unix_micros(F.col(earlier).cast("timestamp") if isinstance(earlier, str) else earlier.cast("timestamp"))
    return (a - b).cast("double")


def nan_to_null(c: str) -> Column:
    """Missing values travel as NULL only; NaN would survive averages."""
    return F.when(F.isnan(c), None).otherwise(F.col(c))
