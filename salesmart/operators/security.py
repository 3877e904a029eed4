"""Row-level security: sales, or a whole star, restricted to the regions a user may see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.lookup import attach, fits_broadcast
from salesmart.plans.star import ViewStar


def _lines_of(star, stores: DataFrame, columns: list[str]) -> DataFrame:
    """Sale lines of the allowed stores only; the store list is broadcast when it is small."""
    lines = star.sales("store_key", *[c for c in columns if c != "store_key"])
    allowed = stores.select("store_key")
    return attach(lines, allowed, "store_key")


def for_region(star, region: str, columns: list[str]) -> DataFrame:
    """Static role: one region."""
    return _lines_of(star, star.dim_store.where(F.col("region") == region), columns)


def for_user(star, user: str, user_region: DataFrame, columns: list[str]) -> DataFrame:
    """Dynamic role: the regions mapped to the user.  An unknown user sees nothing."""
    mine = user_region.where(F.col("email") == user).select("region").distinct()
    if fits_broadcast(user_region):
        mine = F.broadcast(mine)
    return _lines_of(star, star.dim_store.join(mine, "region", "left_semi"), columns)


def as_region(star, region: str) -> ViewStar:
    """The star as a static role sees it: measures, reports and detectors run on it unchanged."""
    return ViewStar(star, {"region": [region]})


def as_user(star, user: str, user_region: DataFrame) -> ViewStar:
    """The star as a user sees it: the regions mapped to the user, none for an unknown one."""
    return ViewStar(star, {"region": user_region.where(F.col("email") == user).select("region")})


def sliced(star, slicers: dict[str, object]) -> ViewStar:
    """The star under slicers: a value or a list of values for each attribute or calendar column."""
    return ViewStar(star, {c: list(v) if isinstance(v, (list, tuple, set)) else [v] for c, v in slicers.items()})
