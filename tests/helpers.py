"""Small literal panels."""

from __future__ import annotations

import datetime as dt
import random

DAY0 = dt.datetime(2024, 1, 1)


def at(hours: float) -> dt.datetime:
    return DAY0 + dt.timedelta(hours=hours)


def panel(spark, rows, schema):
    """Rows of plain values under an explicit schema (NTZ stamps)."""
    return spark.createDataFrame(rows, schema)


def column(df, value, order="ts"):
    return [r[value] for r in df.orderBy(order).select(value).collect()]


def random_series(n_hours: int, seed: int, keep: float = 0.4):
    """(k, ts, v) rows of one sparse series; the first and last hour are kept."""
    rng = random.Random(seed)
    return [
        ("a", at(h), float(rng.randint(0, 50)) if rng.random() < keep else None)
        for h in range(n_hours)
    ]
