"""Daily forecasts: damped additive trend with an additive weekly season, one fit per series."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.rounding import round_cents
from salesmart.operators.series import daily_by, daily_sales, dense_daily
from salesmart.settings import Settings

# Smoothing weights of level, trend and season, and the damping of the trend, tried first.
GRID = {
    "alpha": [0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7],
    "beta": [0.0, 0.01, 0.05, 0.1, 0.2],
    "gamma": [0.0, 0.01, 0.05, 0.1, 0.2],
    "phi": [0.8, 0.9, 0.95, 0.98],
}
# The second pass tries these multiples of a winning weight, these weights around a winning
# zero, and these shifts of the winning damping.
FACTORS = [0.7, 0.85, 1.0, 1.2, 1.4]
NEAR_ZERO = [0.0, 0.001, 0.002, 0.004, 0.006]
SHIFTS = [-0.03, -0.015, 0.0, 0.01, 0.018]
PHI_RANGE = (0.8, 0.998)


def _combine(alpha, beta, gamma, phi) -> np.ndarray:
    """All combinations as rows; the season's weight leaves room for the level's."""
    points = np.array(list(product(alpha, beta, gamma, phi)))
    return points[points[:, 2] <= 1 - points[:, 0]]


def _around(best: np.ndarray) -> np.ndarray:
    weights = [[w * f for f in FACTORS] if w > 0 else NEAR_ZERO for w in best[:3]]
    damping = [min(PHI_RANGE[1], max(PHI_RANGE[0], best[3] + s)) for s in SHIFTS]
    return _combine(*weights, damping)


def _smooth(values: np.ndarray, points: np.ndarray, season_days: int):
    """Run the recursion for every parameter row at once.

    Returns one-step predictions of the first row, squared error per row, and the final
    level, trend and season per row.  The level starts at the first season's mean, the trend
    at zero and the season at each day's mean deviation from its own season, in whole cents.
    """
    m = season_days if len(values) >= season_days else 1  # a part of a season has no pattern yet
    cents = np.rint(values * 100).astype(np.int64)
    seasons = len(values) // m
    blocks = cents[: seasons * m].reshape(seasons, m)
    deviation = m * blocks - blocks.sum(axis=1, keepdims=True)
    start = deviation.sum(axis=0) / (100.0 * m * seasons)
    alpha, beta, gamma, phi = points.T
    level = np.full(len(points), cents[:m].sum() / (100.0 * m))
    trend = np.zeros(len(points))
    season = np.repeat(start[:, None], len(points), axis=1)
    error = np.zeros(len(points))
    fitted = np.empty(len(values))
    for t, value in enumerate(values):
        s = season[t % m]
        damped = phi * trend
        base = level + damped
        miss = value - (base + s)
        fitted[t] = base[0] + s[0]
        error += miss * miss
        new_level = alpha * (value - s) + (1 - alpha) * base
        season[t % m] = gamma * (value - level - damped) + (1 - gamma) * s
        trend = beta * (new_level - level) + (1 - beta) * damped
        level = new_level
    return fitted, error, level, trend, season


def _fit(values: np.ndarray, horizon: int, season_days: int):
    """Best parameters by one-step squared error, fitted values, and the next days."""
    coarse = _combine(*GRID.values())
    best = coarse[np.argmin(_smooth(values, coarse, season_days)[1])]
    fine = _around(best)
    best = fine[np.argmin(_smooth(values, fine, season_days)[1])]
    fitted, _, level, trend, season = _smooth(values, best[None, :], season_days)
    ahead = np.empty(horizon)
    growth, power = 0.0, 1.0
    for h in range(horizon):
        power *= best[3]
        growth += power
        ahead[h] = level[0] + growth * trend[0] + season[(len(values) + h) % len(season), 0]
    return best, fitted, ahead


def fit_series(
    daily: DataFrame, keys: list[str], settings: Settings, backtest: bool = True
) -> DataFrame:
    """Fit every gap-free daily series on its own and return history and future rows.

    A group is one series, bounded by the length of the calendar; groups are spread over the
    cluster by their key.  ``held_out`` is the prediction of the last days by a fit that has
    not seen them.  A short series is fitted and tested like a long one: below one season there is
    no seasonal pattern, and at most half of its days are held out.
    """
    horizon, m, held = settings.horizon_days, settings.season_days, settings.backtest_days
    width = settings.band_width
    schema = ", ".join(
        [f"`{k}` {dict(daily.dtypes)[k]}" for k in keys]
        + [
            "date date",
            "actual double",
            "prediction double",
            "band double",
            "segment string",
            "held_out double",
            "alpha double",
            "beta double",
            "gamma double",
            "phi double",
        ]
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("date")
        values = group["net_sales"].to_numpy(dtype=float)
        n = len(values)
        best, fitted, ahead = _fit(values, horizon, m)
        tested = np.full(n, np.nan)
        out_of = min(held, n // 2)
        if backtest and out_of:
            tested[n - out_of :] = _fit(values[: n - out_of], out_of, m)[2]
        days = pd.to_datetime(group["date"])
        future = pd.date_range(days.iloc[-1] + pd.Timedelta(days=1), periods=horizon)
        none = np.full(horizon, np.nan)
        out = pd.DataFrame({k: group[k].iloc[0] for k in keys}, index=range(n + horizon))
        out["date"] = [*days.dt.date, *future.date]
        out["actual"] = np.concatenate([values, none])
        out["prediction"] = np.concatenate([fitted, ahead])
        out["band"] = width * float(np.std(values - fitted))
        out["segment"] = ["actual"] * n + ["forecast"] * horizon
        out["held_out"] = np.concatenate([tested, none])
        out[["alpha", "beta", "gamma", "phi"]] = best
        return out

    if keys:
        series = daily.groupBy(*keys)
    else:
        series = daily.groupBy(F.lit("all"))
    fitted = series.applyInPandas(fit, schema)
    missing = ["actual", "held_out"]  # pandas has no null double, Spark's NaN is not null
    return fitted.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in missing})


def fitted_sales(star, keys: list[str], backtest: bool = False) -> DataFrame:
    """The fit of total daily sales, or of one series per value of ``keys``."""
    daily = daily_by(star, keys) if keys else daily_sales(star)
    return fit_series(dense_daily(daily, keys, star.span()), keys, star.settings, backtest)


def as_mart(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """History with one-step predictions, then the forecast with its constant band."""
    value, band = F.col("prediction"), F.col("band")
    ahead = F.col("segment") == "forecast"
    return fitted.select(
        *keys,
        "date",
        round_cents(F.col("actual")).alias("actual"),
        round_cents(value).alias("forecast"),
        F.when(ahead, round_cents(value - band)).alias("lower_bound"),
        F.when(ahead, round_cents(value + band)).alias("upper_bound"),
        "segment",
    )


def _tested() -> Column:
    """Held-out days with sales; days without do not count in the error."""
    return F.col("held_out").isNotNull() & (F.col("actual") > 0)


def _mape(tested: Column) -> Column:
    miss = F.abs((F.col("actual") - F.col("held_out")) / F.col("actual"))
    return round_cents(F.avg(F.when(tested, miss)) * 100)


def backtest_error(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """Mean absolute percentage error on the held-out days."""
    return fitted.groupBy(*keys).agg(
        F.count_if(_tested()).cast("bigint").alias("tested_days"),
        _mape(_tested()).alias("mape_pct"),
    )


def summary(fitted: DataFrame) -> DataFrame:
    """One row: days ahead, their total, and the error of the back-test."""
    ahead = F.col("segment") == "forecast"
    return fitted.agg(
        F.count_if(ahead).cast("bigint").alias("horizon_days"),
        F.rint(F.sum(F.when(ahead, F.col("prediction")))).alias("forecast_total"),
        _mape(_tested()).alias("backtest_mape_30d"),
    )


def forecast_daily(star, keys: tuple[str, ...] = ()) -> DataFrame:
    return as_mart(fitted_sales(star, list(keys)), list(keys))


def forecast_backtest(star, keys: tuple[str, ...] = ()) -> DataFrame:
    return backtest_error(fitted_sales(star, list(keys), backtest=True), list(keys))


def forecast_summary(star) -> DataFrame:
    return summary(fitted_sales(star, [], backtest=True))
