"""What-if transforms of the sale lines: closures, demand spikes and dips, promo tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.calendar import Period
from salesmart.functions.rounding import money_sum, ratio
from salesmart.operators.anomalies import entity_anomalies
from salesmart.plans.star import ScenarioStar


def closure(star, column: str, value, period: Period) -> ScenarioStar:
    """Remove the lines of one store (or any other entity) in a period."""
    closed = period.covers(F.col("date")) & F.col(column).eqNullSafe(F.lit(value))
    return ScenarioStar(star, ["date", column], lambda lines: lines.where(~closed))


def most_sold_product(star) -> DataFrame:
    """One row: the product on most lines, the smallest key among equals."""
    return (
        star.sales("product_key")
        .groupBy("product_key")
        .agg(F.count("*").alias("lines"))
        .orderBy(F.desc("lines"), F.asc("product_key"))
        .limit(1)
        .select("product_key")
    )


def spike(star, period: Period, factor: int) -> ScenarioStar:
    """Multiply the lines of the most sold product in a period."""
    hot = period.covers(F.col("date")) & (
        F.col("product_key") == most_sold_product(star).scalar()
    )
    copies = F.when(hot, factor).otherwise(1)
    return ScenarioStar(
        star,
        ["date", "product_key"],
        lambda lines: lines.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))),
    )


def surge(star, column: str, value, period: Period, factor: int) -> ScenarioStar:
    """Multiply the lines of one store (or any other entity) in a period."""
    hot = period.covers(F.col("date")) & F.col(column).eqNullSafe(F.lit(value))
    copies = F.when(hot, factor).otherwise(1)
    return ScenarioStar(
        star,
        ["date", column],
        lambda lines: lines.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))),
    )


def _share(columns: list[str], types: dict[str, str], seed: int) -> Column:
    """A number in [0, 1) that depends only on the line and the seed."""
    texts = [
        F.rint(F.col(c) * 100).cast("bigint").cast("string")
        if types[c] == "double"
        else F.col(c).cast("string")
        for c in columns
    ]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / float(1 << 32)


def dip(star, region: str, period: Period, fraction: float, seed: int) -> ScenarioStar:
    """Drop a fraction of a region's lines in a period.

    Each line decides by a hash of its own identity, so the choice is the same however the
    lines are partitioned and nothing is shuffled.
    """

    def change(lines: DataFrame) -> DataFrame:
        hit = period.covers(F.col("date")) & (F.col("region") == region)
        drop = _share(star.line_id, dict(lines.dtypes), seed) < fraction
        return lines.where(~F.coalesce(hit & drop, F.lit(False)))

    return ScenarioStar(star, ["date", "region", *star.line_id], change)


def promo_window(day: Column) -> Column:
    """Promotion season of a date.  Fixed values: July, January, and late November."""
    return (
        F.when(F.month(day) == 7, "summer_sale")
        .when(F.month(day) == 1, "winter_sale")
        .when((F.month(day) == 11) & (F.day(day) >= 20), "black_friday")
        .otherwise("none")
    )


def promo_discount(window: Column) -> Column:
    """The discount each promotion season stands for."""
    return (
        F.when(window == "summer_sale", 0.20)
        .when(window == "winter_sale", 0.25)
        .when(window == "black_friday", 0.30)
        .otherwise(0.0)
    )


def promo_sales(star) -> DataFrame:
    """Net sales, lines and mean discount per promotion season; days are summed first."""
    daily = star.sales("date", "net_sales", "discount_pct").groupBy("date").agg(
        money_sum(F.col("net_sales")).alias("net_sales"),
        F.count("*").alias("line_count"),
        money_sum(F.col("discount_pct")).alias("discounts"),
    )
    return (
        daily.groupBy(promo_window(F.col("date")).alias("promo_window"))
        .agg(
            money_sum(F.col("net_sales")).alias("net_sales"),
            F.sum("line_count").cast("bigint").alias("line_count"),
            money_sum(F.col("discounts")).alias("discounts"),
        )
        .select(
            "promo_window",
            promo_discount(F.col("promo_window")).alias("season_discount"),
            "net_sales",
            "line_count",
            ratio(F.col("discounts"), F.col("line_count")).alias("mean_discount"),
        )
    )


def detector_recall(star, column: str, value, period: Period, factor: int = 0) -> DataFrame:
    """Plant a closure or a surge, run the detector, and count the planted days that it flags.

    Without a factor the entity is closed and its days should be dips; with one its lines are
    multiplied and its days should be spikes.  Planted days are those on which the entity had lines.
    """
    changed = surge(star, column, value, period, factor) if factor else closure(star, column, value, period)
    planted = (
        star.sales("date", column)
        .where(period.covers(F.col("date")) & (F.col(column) == value))
        .select("date")
        .distinct()
    )
    found = (
        entity_anomalies(changed, column)
        .where((F.col(column) == value) & period.covers(F.col("date")))
        .select("date", "is_anomaly", "direction")
    )
    hit = (F.col("is_anomaly") == 1) & (F.col("direction") == ("spike" if factor else "dip"))
    return (
        planted.join(found, "date", "left")
        .agg(
            F.count("*").cast("bigint").alias("planted_days"),
            F.count_if(hit).cast("bigint").alias("flagged_days"),
        )
        .withColumn("recall", ratio(F.col("flagged_days").cast("double"), F.col("planted_days")))
    )
