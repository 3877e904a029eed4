"""Robust rolling anomaly detection on daily sales per entity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.rounding import money_sum, round_cents
from salesmart.operators.lookup import attach
from salesmart.operators.series import Keep, daily_by, with_rolling_spread
from salesmart.settings import Settings


def robust_scores(
    daily: DataFrame, entity: list[str], settings: Settings, span: DataFrame | None = None, hits_only: bool = False
) -> DataFrame:
    """Score every day against the rolling median and the rolling MAD of its entity.

    With ``span`` the days may have gaps, which are filled with 0 over the whole span; without, they have none.

    Both medians are found in one pass over an entity's days.  A deviation is measured against
    the median of its own day; the score is null while the window is short or when the MAD is
    zero.  Windows that end the day before (``trailing``) keep a long closure from becoming its
    own baseline.

    With ``hits_only`` every day is scored, and those below the threshold are not given back.
    """
    rows, least, lag = settings.window_days, settings.min_periods, int(settings.trailing)
    z = (F.col("net_sales") - F.col("expected")) / (
        settings.mad_scale * F.nullif("mad", F.lit(0.0))
    )
    keep = _hits(settings.mad_scale, settings.z_threshold) if hits_only else None
    found = with_rolling_spread(daily, "net_sales", "expected", "mad", entity, rows, least, lag, span, keep)
    return found.withColumn("z", z)


def _hits(scale: float, threshold: float) -> Keep:
    """The rows whose score, by the arithmetic of ``robust_scores``, reaches the threshold."""

    def keep(values: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
        scored = np.flatnonzero(~np.isnan(values) & ~np.isnan(middle) & ~np.isnan(spread) & (spread != 0))
        z = (values[scored] - middle[scored]) / (scale * spread[scored])
        hit = np.zeros(len(values), bool)
        hit[scored] = ~(np.abs(z) < threshold)  # as Spark does, not a number counts as large
        return hit

    return keep


def flagged(scored: DataFrame, entity: list[str], settings: Settings) -> DataFrame:
    """Rounded output with flag and direction; the flag uses the unrounded score."""
    hit = F.coalesce(F.abs("z") >= settings.z_threshold, F.lit(False))
    return scored.select(
        "date",
        *entity,
        round_cents(F.col("net_sales")).alias("net_sales"),
        round_cents(F.col("expected")).alias("expected"),
        round_cents(F.col("z")).alias("robust_z"),
        hit.cast("int").alias("is_anomaly"),
        F.when(F.col("z") < 0, "dip").otherwise("spike").alias("direction"),
    )


def entity_anomalies(star, entity: str, hits_only: bool = False) -> DataFrame:
    """Scored daily sales of any key or attribute of the star; with ``hits_only`` the flagged days of them."""
    scored = robust_scores(daily_by(star, [entity]), [entity], star.settings, star.span(), hits_only)
    return flagged(scored, [entity], star.settings)


def anomalies(star, hits_only: bool = False) -> DataFrame:
    """Store-day anomalies over the whole calendar of sales, with the store's names."""
    names = star.dim_store.select("store_key", "store_id", "store_name", "region")
    scored = entity_anomalies(star, "store_key", hits_only)
    return attach(scored, names, "store_key").select(
        "date",
        "store_id",
        "store_name",
        "region",
        "net_sales",
        "expected",
        "robust_z",
        "is_anomaly",
        "direction",
    )


def monitor(star, found: DataFrame) -> DataFrame:
    """Flagged days only, with the calendar's day name and holiday flag."""
    calendar = star.dim_date.select("date", "day_name", "is_holiday")
    hits = found.where(F.col("is_anomaly") == 1).drop("is_anomaly")
    return hits.join(F.broadcast(calendar), "date")  # one row per day


def expected_line(found: DataFrame, column: str, value) -> DataFrame:
    """Actual and expected sales per day of the sliced entities."""
    return found.where(F.col(column) == value).groupBy("date").agg(
        money_sum(F.col("net_sales")).alias("net_sales"),
        money_sum(F.col("expected")).alias("expected"),
    )


def counts(found: DataFrame, by: str) -> DataFrame:
    hit = F.col("is_anomaly") == 1
    return found.groupBy(by).agg(
        F.count_if(hit).cast("bigint").alias("anomaly_count"),
        F.count_if(hit & (F.col("direction") == "dip")).cast("bigint").alias("dip_anomalies"),
    )


def top_entities(found: DataFrame, by: str, limit: int = 3) -> DataFrame:
    """Entities with the most flagged days."""
    return (
        found.where(F.col("is_anomaly") == 1)
        .groupBy(by)
        .agg(F.count("*").cast("bigint").alias("anomalies"))
        .orderBy(F.desc("anomalies"), F.asc(by))
        .limit(limit)
    )


def summary(found: DataFrame) -> DataFrame:
    """One row: scored days and flagged days."""
    return found.agg(
        F.count("*").cast("bigint").alias("store_days"),
        F.sum("is_anomaly").cast("bigint").alias("anomalies"),
    )
