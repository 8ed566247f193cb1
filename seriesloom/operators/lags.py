"""Values a fixed time ago."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.gaps import LINE, on_line
from seriesloom.operators.scoring import pearson

MICROS_PER_HOUR = 3_600_000_000

# Shortest span, in hours, of the date_trunc units a series may be cut by.
CHUNK_HOURS = {"day": 24, "week": 168, "month": 672, "quarter": 2160, "year": 8760}


def lag_name(col: str, hours: int) -> str:
    return f"{col}_{hours:02d}h_ago"


def clock_lag(
    df: DataFrame,
    keys: list[str],
    ts: str,
    lags: dict[str, list[int]],
    chunk: str | None = None,
) -> DataFrame:
    """Add ``col_KKh_ago``: the value exactly ``K`` hours earlier.

    Expects a complete hourly grid, where ``K`` hours are ``K`` rows. With
    ``chunk`` the last rows of every chunk are also handed to the following
    one, so rows are windowed inside ``(keys, chunk)`` only; the chunk must
    span at least the longest lag.
    """
    names = df.columns
    if chunk is None:
        win = Window.partitionBy(*keys).orderBy(ts)
        return df.withColumns(_lag_columns(lags, win))

    longest = max(k for ks in lags.values() for k in ks)
    if CHUNK_HOURS[chunk] < longest:
        raise ValueError(f"a {chunk} is shorter than the longest lag, {longest} h")
    own = F.date_trunc(chunk, ts).cast("timestamp_ntz")
    ahead = F.date_trunc(chunk, F.col(ts) + F.expr(f"INTERVAL {longest} HOURS")).cast("timestamp_ntz")
    spread = df.withColumn("__own", own).withColumn(
        "__chunk", F.explode(F.array_distinct(F.array(F.col("__own"), ahead)))
    )
    win = Window.partitionBy(*keys, "__chunk").orderBy(ts)
    lagged = spread.withColumns(_lag_columns(lags, win))
    added = [lag_name(c, k) for c, ks in lags.items() for k in ks]
    return lagged.where(F.col("__own") == F.col("__chunk")).select(*names, *added)


def _lag_columns(lags: dict[str, list[int]], win) -> dict[str, Column]:
    return {lag_name(c, k): F.lag(c, k).over(win) for c, ks in lags.items() for k in ks}


def clock_lag_sparse(
    df: DataFrame, keys: list[str], ts: str, lags: dict[str, list[int]]
) -> DataFrame:
    """``clock_lag`` for rows with gaps: matched by clock, not by position.

    The rows before the current one within the longest lag are few (one per
    hour), so each lag is a range frame that covers exactly one instant.
    """
    hours = (F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(MICROS_PER_HOUR)).cast("bigint")
    base = df.withColumn("__h", hours)
    added = {}
    for c, ks in lags.items():
        for k in ks:
            at = Window.partitionBy(*keys).orderBy("__h").rangeBetween(-k, -k)
            added[lag_name(c, k)] = F.first(c).over(at)
    return base.withColumns(added).drop("__h")


def clock_lag_lines(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    lags: dict[str, list[int]],
    ordinals: list[str] | None = None,
    also: dict[str, str] | None = None,
) -> DataFrame:
    """``clock_lag`` on the complete grid, for the observed rows of ``gaps.lines`` only.

    The value ``K`` hours earlier lies on the line of the last row up to then, so the grid
    itself is not made. Those in ``ordinals`` are rounded as on the grid; ``also`` maps
    columns to the names of their interpolated copies, whose lags are asked for.
    """
    column = {name: c for c, name in (also or {}).items()}
    hours = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(MICROS_PER_HOUR))
    by_hour = Window.partitionBy(*keys).orderBy("__h")
    wanted = [(name, k) for name, ks in lags.items() for k in ks]
    then = {
        lag_name(name, k): F.last(F.struct(*(F.col(f"__{part}_{column.get(name, name)}").alias(part) for part in LINE)))
        .over(by_hour.rangeBetween(Window.unboundedPreceding, -k))
        for name, k in wanted
    }
    found = rows.withColumn("__h", hours).withColumns(then).drop("__h")
    values = {}
    for name, k in wanted:
        at = F.unix_micros(F.col(ts).cast("timestamp")) - F.lit(k * MICROS_PER_HOUR)
        value = on_line(at, *(F.col(lag_name(name, k))[part] for part in LINE))
        values[lag_name(name, k)] = F.rint(value).cast("int") if name in (ordinals or []) else value
    return found.withColumns(values)


def lag_fan_out(
    df: DataFrame, keys: list[str], ts: str, col: str, up_to: int = 24, chunk: str | None = None
) -> DataFrame:
    """All lags 1 … ``up_to`` of one column over a single sort."""
    return clock_lag(df, keys, ts, {col: list(range(1, up_to + 1))}, chunk)


def lag_correlations(df: DataFrame, keys: list[str], ts: str, cols: list[str], ys: list[str], up_to: int = 24) -> DataFrame:
    """``(y, x, r)``: Pearson correlation of every column and each of its lags with every target.

    Equal to ``scoring.correlations`` over the lag columns, which are never made: tasks
    get a series' rows in order, with their places in it, and look back in the arrays.
    """
    ordered = Window.partitionBy(*keys).orderBy(ts)
    rows = df.withColumn("__at", F.row_number().over(ordered)).sortWithinPartitions(*keys, ts)
    rows = rows.select("__at", *(F.col(c).cast("double") for c in [*cols, *ys]))
    width, n_y = len(cols), len(ys)
    names = [[c if k == 0 else lag_name(c, k) for c in cols] for k in range(up_to + 1)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, past = np.zeros((up_to + 1, 3 * n_y, 3 * width)), np.zeros((up_to, 3 * width))
        for b in batches:
            at = b.column(0).to_numpy()
            own = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]]).astype(float)
            has = ~np.isnan(own)
            own = np.where(has, own, 0.0)
            x, y = own[:, :width], own[:, width:]
            x = np.concatenate([past, np.hstack([has[:, :width], x, x * x])])
            y = np.hstack([has[:, width:], y, y * y])
            for k in range(up_to + 1):
                total[k] += (y * (at > k)[:, None]).T @ x[up_to - k : up_to - k + len(at)]
            past = x[len(x) - up_to :]
        cells: dict[str, list] = {c: [] for c in ("y", "x", "n", "sx", "sy", "sxx", "syy", "sxy")}
        for k in range(up_to + 1):
            for j, target in enumerate(ys):
                for i, name in enumerate(names[k]):
                    pick = lambda a, b: total[k, a * n_y + j, b * width + i]  # noqa: B023, E731
                    values = (target, name, pick(0, 0), pick(0, 1), pick(1, 0), pick(0, 2), pick(2, 0), pick(1, 1))
                    for column, v in zip(cells.values(), values):
                        column.append(v)
        yield pa.RecordBatch.from_pydict(cells)

    parts = rows.mapInArrow(sums, "y string, x string, n double, sx double, sy double, sxx double, syy double, sxy double")
    return pearson(parts)


def daily_lag(df: DataFrame, keys: list[str], day: str, cols: list[str]) -> DataFrame:
    """Add ``c_1d_ago``, the value of the previous calendar day; the first day
    of a series takes its own next known value.

    Expects one row per (series, day) without missing days.
    """
    win = Window.partitionBy(*keys).orderBy(day)
    back = (
        Window.partitionBy(*keys)
        .orderBy(F.col(day).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shifted = df.withColumns({f"{c}_1d_ago": F.lag(c, 1).over(win) for c in cols})
    return shifted.withColumns(
        {f"{c}_1d_ago": F.last(f"{c}_1d_ago", True).over(back) for c in cols}
    )
