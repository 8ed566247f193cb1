"""Gap repair: carry, back-fill and time-linear interpolation.

All of it rests on one primitive, the nearest non-missing value on either side
of each row. Both sides use *running* frames (the right-hand one over the
reversed order): a frame that starts at the row and is unbounded to its right
is re-evaluated per row by Spark and costs the square of the series length.

With ``chunk`` (a ``date_trunc`` unit such as ``day``) a series is split: each
chunk is summarised to its first and last non-missing values, the summaries
(one row per chunk) are carried along the series, and the rows themselves are
only ever windowed inside ``(keys, chunk)``. No task then sees a whole series,
whatever its length. Both forms give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.scalars import day_of, micros_between
from seriesloom.operators.grid import on_step
from seriesloom.session import spread_by_keys


def _stamped(ts: str, c: str) -> Column:
    """(ts, value) where the value is there, else NULL."""
    return F.expr(f"IF(`{c}` IS NOT NULL, named_struct('t', `{ts}`, 'v', `{c}`), NULL)")


def _running(order_col: Column, part: list) -> Window:
    return (
        Window.partitionBy(*part)
        .orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    ts: str,
    cols: list[str],
    chunk: str | None = None,
    sides: tuple[str, ...] = ("prev", "next"),
    extent: bool = False,
) -> DataFrame:
    """Add ``__prev_c`` / ``__next_c`` structs ``(t, v)``: nearest non-missing
    value at or before / at or after the row. ``extent`` also adds ``__lo`` and
    ``__hi``, the first and last stamp of the series."""
    part = list(keys)
    if chunk is not None:
        df = df.withColumn("__chunk", F.date_trunc(chunk, ts).cast("timestamp_ntz"))
        part.append("__chunk")
    asc = _running(F.col(ts).asc(), part)
    desc = _running(F.col(ts).desc(), part)

    inner: dict[str, Column] = {}
    if "prev" in sides:
        inner |= {f"__prev_{c}": F.last(_stamped(ts, c), True).over(asc) for c in cols}
    if "next" in sides:
        inner |= {f"__next_{c}": F.last(_stamped(ts, c), True).over(desc) for c in cols}
    if extent and chunk is None:
        inner |= {"__lo": F.first(ts).over(asc), "__hi": F.first(ts).over(desc)}
    if chunk is None:
        return df.withColumns(inner)

    carry = _chunk_carry(df, keys, ts, cols, sides, extent)
    joined = df.join(carry, part, "left").withColumns(inner)
    merged = {
        name: F.coalesce(F.col(name), F.col(f"__carry{name}")) for name in inner
    }
    return joined.withColumns(merged).drop("__chunk", *[f"__carry{n}" for n in inner])


def _chunk_carry(df, keys, ts, cols, sides, extent) -> DataFrame:
    """Per chunk, the nearest values in earlier and later chunks of the series."""
    summary = df.groupBy(*keys, "__chunk").agg(
        F.min(ts).alias("__min_ts"),
        F.max(ts).alias("__max_ts"),
        *[F.max(_stamped(ts, c)).alias(f"__last_{c}") for c in cols],
        *[F.min(_stamped(ts, c)).alias(f"__first_{c}") for c in cols],
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(F.col("__chunk").asc()).rowsBetween(Window.unboundedPreceding, -1)
    later = whole.orderBy(F.col("__chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    if "prev" in sides:
        carried += [F.last(f"__last_{c}", True).over(earlier).alias(f"__carry__prev_{c}") for c in cols]
    if "next" in sides:
        carried += [F.last(f"__first_{c}", True).over(later).alias(f"__carry__next_{c}") for c in cols]
    if extent:
        carried += [
            F.min("__min_ts").over(whole).alias("__lo"),
            F.max("__max_ts").over(whole).alias("__hi"),
        ]
    return summary.select(*keys, "__chunk", *carried)


def forward_fill(df, keys: list[str], ts: str, cols: list[str], chunk: str | None = None) -> DataFrame:
    names = df.columns
    near = with_neighbours(df, keys, ts, cols, chunk, sides=("prev",))
    return near.withColumns({c: F.col(f"__prev_{c}")["v"] for c in cols}).select(*names)


def back_fill(
    df: DataFrame,
    keys: list[str],
    ts: str,
    cols: list[str],
    mode: str = "same_day",
    chunk: str | None = None,
) -> DataFrame:
    """Fill from the next value.

    ``same_day`` prefers a value of the same day, on either side, so that a
    missing last hour does not take the next day's flag; ``plain`` always takes
    the next value.
    """
    names = df.columns
    if mode == "plain":
        near = with_neighbours(df, keys, ts, cols, chunk, sides=("next",))
        filled = {c: F.col(f"__next_{c}")["v"] for c in cols}
    elif mode == "same_day":
        near = with_neighbours(df, keys, ts, cols, chunk)
        filled = {c: _same_day_first(ts, c) for c in cols}
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return near.withColumns(filled).select(*names)


def _same_day_first(ts: str, c: str) -> Column:
    before, after, day = f"`__prev_{c}`", f"`__next_{c}`", f"CAST(`{ts}` AS DATE)"
    return F.expr(
        f"CASE WHEN CAST({after}.t AS DATE) = {day} THEN {after}.v "
        f"WHEN CAST({before}.t AS DATE) = {day} THEN {before}.v ELSE {after}.v END"
    )


def _linear(ts: str, c: str) -> Column:
    """Value on the line between the neighbours; flat after the last, NULL before the first.

    The distance is elapsed time, in microseconds, so uneven stamps count right.
    """
    before, after = f"`__prev_{c}`", f"`__next_{c}`"
    at, t0, t1 = (f"unix_micros(CAST({t} AS TIMESTAMP))" for t in (f"`{ts}`", f"{before}.t", f"{after}.t"))
    v0, v1 = f"CAST({before}.v AS DOUBLE)", f"CAST({after}.v AS DOUBLE)"
    return F.expr(
        f"CASE WHEN {before} IS NULL THEN NULL "
        f"WHEN {after} IS NULL OR {before}.t = `{ts}` THEN {v0} "
        f"ELSE {v0} + ({v1} - {v0}) * CAST({at} - {t0} AS DOUBLE) / CAST({t1} - {t0} AS DOUBLE) END"
    )


def _line(c: str) -> list[Column]:
    """The line between the neighbours of ``_linear`` as numbers: value and stamp at its start, rise and length."""
    before, after = f"`__prev_{c}`", f"`__next_{c}`"
    v0, v1 = f"CAST({before}.v AS DOUBLE)", f"CAST({after}.v AS DOUBLE)"
    t0, t1 = (f"unix_micros(CAST({t}.t AS TIMESTAMP))" for t in (before, after))
    parts = {"v0": v0, "t0": t0, "rise": f"IF({after} IS NULL, 0D, {v1} - {v0})", "length": f"IF({after} IS NULL, 1D, CAST({t1} - {t0} AS DOUBLE))"}
    return [F.expr(e).alias(f"__{name}_{c}") for name, e in parts.items()]


LINE = ("v0", "t0", "rise", "length")


def on_line(at: Column, v0: Column, t0: Column, rise: Column, length: Column) -> Column:
    gone = at - t0
    return F.when(gone == 0, v0).otherwise(v0 + rise * gone.cast("double") / length)


def _on_line(at: Column, c: str) -> Column:
    return on_line(at, *(F.col(f"__{part}_{c}") for part in LINE))


def _sides(c: str) -> list[Column]:
    """Values of the neighbours of ``_same_day_first``, and their days."""
    sides = {"before": F.col(f"__prev_{c}"), "after": F.col(f"__next_{c}")}
    return [col for side, near in sides.items() for col in (near["v"].alias(f"__{side}_{c}"), near["t"].cast("date").alias(f"__{side}_day_{c}"))]


def interpolate_time(
    df: DataFrame,
    keys: list[str],
    ts: str,
    cols: list[str],
    ordinals: list[str] | None = None,
    chunk: str | None = None,
) -> DataFrame:
    """Interpolate ``cols`` linearly in time; those in ``ordinals`` are then
    rounded half to even and stay whole numbers."""
    names = df.columns
    ordinals = ordinals or []
    near = with_neighbours(df, keys, ts, cols, chunk)
    filled = {
        c: F.rint(_linear(ts, c)).cast("int") if c in ordinals else _linear(ts, c) for c in cols
    }
    return near.withColumns(filled).select(*names)


def repair(
    grid: DataFrame,
    keys: list[str],
    ts: str,
    linear: list[str],
    ordinals: list[str],
    flags: list[str],
    mode: str = "same_day",
    chunk: str | None = None,
) -> DataFrame:
    """Interpolate values and back-fill flags over the same two windows."""
    names = grid.columns
    near = with_neighbours(grid, keys, ts, [*linear, *ordinals, *flags], chunk)
    out = {c: _linear(ts, c) for c in linear}
    out |= {c: F.rint(_linear(ts, c)).cast("int") for c in ordinals}
    for c in flags:
        out[c] = F.col(f"__next_{c}")["v"] if mode == "plain" else _same_day_first(ts, c)
    return near.withColumns(out).select(*names)


def lines(
    observed: DataFrame,
    keys: list[str],
    ts: str,
    linear: list[str],
    ordinals: list[str],
    flags: list[str],
    probe: str,
    also: list[str] | None = None,
) -> DataFrame:
    """Observed rows with all that the slots up to the next row are filled from: the line of
    each value (``_line``), the neighbours of each flag, the stamp after and the extent."""
    valued = [*linear, *ordinals, *(also or [])]
    series = Window.partitionBy(*keys)
    asc, desc = series.orderBy(ts), series.orderBy(F.col(ts).desc())
    upto = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = desc.rowsBetween(Window.unboundedPreceding, -1)
    back = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    rows = spread_by_keys(observed, keys).withColumn(
        "__seen", F.count(probe).over(Window.partitionBy(*keys, day_of(ts)))
    )
    rows = rows.withColumns(
        {f"__prev_{c}": F.last(_stamped(ts, c), True).over(upto) for c in [*valued, *flags]}
        | {
            "__lo": F.first(ts).over(upto),
            "__next_ts": F.lead(ts).over(asc),
            "__next_seen": F.lead("__seen").over(asc),
        }
    )
    rows = rows.withColumns(
        {f"__next_{c}": F.last(_stamped(ts, c), True).over(after) for c in [*valued, *flags]}
        | {"__hi": F.first(ts).over(back)}
    )
    # Every row is copied once a slot: plain numbers, not neighbours, go along.
    return rows.select(
        *observed.columns, "__seen", "__lo", "__hi", "__next_ts", "__next_seen",
        *[col for c in valued for col in _line(c)],
        *[col for c in flags for col in _sides(c)],
    )


def _values(at: Column, linear: list[str], ordinals: list[str], also: dict[str, str]) -> dict[str, Column]:
    """Values on their lines by name."""
    out = {c: _on_line(at, c) for c in linear}
    out |= {c: F.rint(_on_line(at, c)).cast("int") for c in ordinals}
    return out | {name: _on_line(at, c) for c, name in also.items()}


def own_slots(rows: DataFrame, ts: str, linear: list[str], ordinals: list[str], also: dict[str, str]) -> DataFrame:
    """``lines`` with the values of the observed slots themselves in place of the lines."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    drawn = [f"__{part}_{c}" for c in [*linear, *ordinals, *also] for part in LINE]
    return rows.withColumns(_values(at, linear, ordinals, also)).drop(*drawn)


def spans(
    rows: DataFrame, keys: list[str], ts: str, flags: list[str], max_missing: int = 2, packed: str | None = None
) -> DataFrame:
    """The grid of ``lines`` as spans of slots that are alike but for the values on lines: an
    observed slot, or the slots of one day between two observed ones.

    ``ts`` is a span's first slot and ``__until`` its last one. Flags and ``bad_day`` are
    filled; what was only observed is empty on other spans; lines go along. ``packed``
    names a struct for the former, so that the other spans, which have none, stay narrow.
    """
    observed = [c for c in rows.columns if c not in (*keys, ts, *flags) and not c.startswith("__")]
    hour, one_day = F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 DAY")
    until = on_step(F.col("__next_ts") - hour, keys, ts, "__next_ts", hour)
    rows = rows.withColumn("__end", F.when(F.col(ts).isNotNull(), until))
    none = F.expr("CAST(array() AS array<timestamp_ntz>)")
    past_hour = F.col(ts) - F.date_trunc("hour", ts).cast("timestamp_ntz")
    tomorrow = F.date_trunc("day", ts).cast("timestamp_ntz") + one_day + past_hour
    starts = F.array_distinct(
        F.concat(
            F.array(ts),
            F.when(F.col("__end") > F.col(ts), F.array(F.col(ts) + hour)).otherwise(none),
            F.when(tomorrow <= F.col("__end"), F.sequence(tomorrow, F.col("__end"), one_day)).otherwise(none),
        )
    )
    rows = rows.withColumn("__starts", F.when(F.col(ts).isNotNull(), starts))
    if packed:
        rows = rows.withColumn(packed, F.struct(*observed)).drop(*observed)

    def part(at: Column, i: Column) -> Column:
        until = F.coalesce(F.get("__starts", i + 1) - hour, F.col("__end"))
        own = [F.when(i == 0, F.col(packed)).alias(packed)] if packed else []
        return F.struct(at.alias("__slot"), until.alias("__until"), *own)

    names = [c for c in rows.columns if c not in ("__starts", "__end", packed)]
    slots = rows.select(*names, F.inline(F.transform("__starts", part)))

    own = F.col("__slot") == F.col(ts)
    today = day_of("__slot")
    midnight = F.date_trunc("day", "__slot").cast("timestamp_ntz")
    first = F.greatest(F.col("__lo"), midnight)
    last = F.least(F.col("__hi"), midnight + F.expr("INTERVAL 23 HOURS"))
    expected = micros_between(last, first) / F.lit(3.6e9) + 1
    seen = (
        F.when(today == day_of(ts), F.col("__seen"))
        .when(today == day_of("__next_ts"), F.col("__next_seen"))
        .otherwise(0)
    )
    out = {}
    for c in flags:
        later_too = F.coalesce(F.col(f"__after_day_{c}") == today, F.lit(False))
        nearest = F.when((F.col(f"__before_day_{c}") == today) & ~later_too, F.col(f"__before_{c}")).otherwise(F.col(f"__after_{c}"))
        out[c] = F.when(own & F.col(c).isNotNull(), F.col(c)).otherwise(nearest)
    out |= {packed: F.col(packed)} if packed else {c: F.when(own, F.col(c)) for c in observed}
    return slots.select(
        *keys,
        F.col("__slot").alias(ts),
        "__until",
        *[col.alias(c) for c, col in out.items()],
        *[c for c in names if c.startswith(("__v0_", "__t0_", "__rise_", "__length_"))],
        (expected - seen > max_missing).cast("int").alias("bad_day"),
    )


def fill_spans(
    spread: DataFrame, ts: str, linear: list[str], ordinals: list[str], also: dict[str, str] | None = None
) -> DataFrame:
    """Every slot of ``spans``, with the values on their lines. ``also`` maps columns to the
    names of interpolated copies, next to which the column itself stays as observed."""
    on_lines = [*linear, *ordinals]
    rest = [c for c in spread.columns if c not in on_lines and c != ts and not c.startswith("__")]
    slots = spread.withColumn("__slot", F.explode(F.sequence(F.col(ts), F.col("__until"), F.expr("INTERVAL 1 HOUR"))))
    values = _values(F.unix_micros(F.col("__slot").cast("timestamp")), linear, ordinals, also or {})
    return slots.select(F.col("__slot").alias(ts), *rest, *[v.alias(c) for c, v in values.items()])


def fill_grid(
    observed: DataFrame,
    keys: list[str],
    ts: str,
    linear: list[str],
    ordinals: list[str],
    flags: list[str],
    probe: str,
    max_missing: int = 2,
    also: dict[str, str] | None = None,
) -> DataFrame:
    """``regular_grid``, ``flag_bad_days`` and ``repair`` (same-day flags) in one.

    The neighbours and the per-day counts are found among the *observed* rows,
    before these are stretched into slots: on a sparse panel the windows sort a
    fraction of the grid. ``also`` maps columns to the names of interpolated
    copies, next to which the column itself stays as observed.
    """
    also = also or {}
    rows = lines(observed, keys, ts, linear, ordinals, flags, probe, [*also])
    slots = fill_spans(spans(rows, keys, ts, flags, max_missing), ts, linear, ordinals, also)
    on_lines = [*linear, *ordinals, *flags]
    rest = [c for c in observed.columns if c not in on_lines and c not in keys and c != ts]
    return slots.select(*keys, ts, *on_lines, *rest, *also.values(), "bad_day")
