"""What a panel looks like: its key, its columns, and how to treat them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# The lags, in hours, that the lag screening settled on.
SCREENED_LAGS = {
    "atemp": [7, 24],
    "humidity": [11, 24],
    "temp": [24],
    "weather": [1, 24],
    "windspeed": [11, 24],
}

# Days whose flags the original data gets wrong (tax day, the
# Friday after Thanksgiving).
US_2011_2012 = {
    dt.date(2011, 4, 15): {"workingday": 1, "holiday": 0},
    dt.date(2012, 4, 16): {"workingday": 1, "holiday": 0},
    dt.date(2011, 11, 25): {"workingday": 0, "holiday": 1},
    dt.date(2012, 11, 23): {"workingday": 0, "holiday": 1},
}

TRAIN, TEST = 0, 1


@dataclass(frozen=True)
class PanelSpec:
    """Columns of an hourly demand panel.

    ``keys`` may be a constant column for a single series. ``linear`` and
    ``ordinals`` are the covariates, interpolated and (ordinals) rounded;
    ``flags`` are constant within a day and back-filled. ``fold_plan`` of the
    hold-out and the model inputs are listed explicitly, so that a new column
    never becomes a feature by accident.
    """

    keys: list[str]
    ts: str = "ts"
    segments: list[str] = field(default_factory=lambda: ["registered", "casual"])
    total: str = "count"
    linear: list[str] = field(default_factory=lambda: ["temp", "atemp", "windspeed"])
    ordinals: list[str] = field(default_factory=lambda: ["weather", "humidity"])
    flags: list[str] = field(default_factory=lambda: ["workingday", "holiday", "data_set"])
    probe: str = "weather"
    max_missing: int = 2
    base_year: int = 2011
    lags: dict[str, list[int]] = field(default_factory=lambda: dict(SCREENED_LAGS))
    overrides: dict[dt.date, dict[str, int]] = field(default_factory=lambda: dict(US_2011_2012))

    @property
    def counts(self) -> list[str]:
        return [*self.segments, self.total]

    @property
    def covariates(self) -> list[str]:
        return [*self.linear, *self.ordinals]

    @property
    def hourly_features(self) -> list[str]:
        lagged = [f"{c}_{k:02d}h_ago" for c, ks in self.lags.items() for k in ks]
        return [
            "holiday", "workingday", *self.covariates,
            "year", "month", "day_of_week", "hour", *lagged, "weekend",
        ]

    @property
    def daily_features(self) -> list[str]:
        return [
            "workingday", "weekend", "day_of_week", "month", *self.covariates, "elapsed",
            *[f"{c}_1d_ago" for c in self.covariates],
        ]
