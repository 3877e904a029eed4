"""Job parameters, one immutable object passed to every operator that has a knob."""

from __future__ import annotations

import datetime
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # calendar and forecast
    horizon_days: int = 90
    backtest_days: int = 30
    season_days: int = 7
    band_width: float = 1.96
    # anomaly detector
    window_days: int = 28
    min_periods: int = 10
    z_threshold: float = 3.5
    mad_scale: float = 1.4826
    trailing: bool = False  # a day is measured against the days before it, not also against itself
    # reports
    top_products: int = 10
    top_customers: int = 25
    rfm_tiles: int = 5
    as_of: datetime.date | None = None  # recency counts from here; None: from the end of the calendar


DEFAULTS = Settings()
