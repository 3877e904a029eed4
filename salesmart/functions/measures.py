"""The measure library: named measures over a few aggregates that work at any grain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.rounding import cents, ratio, round_half_up

# base -> the fact column whose cents it sums
MONEY = {
    "net": "net_sales",
    "gross": "gross_sales",
    "cost": "cost_amount",
    "margin": "gross_margin",
    "discount": "discount_amount",
}
# base -> (fact columns it reads, aggregate over lines); all of them add up from partial results
COUNTS = {
    "units": ({"quantity"}, lambda: F.sum("quantity")),
    "lines": (set(), lambda: F.count(F.lit(1))),
    "returns": ({"is_return"}, lambda: F.count_if(F.col("is_return") == 1)),
}
SUMS = [*MONEY, *COUNTS]
# the one base that does not add up: distinct customers
CUSTOMERS = "customers"

# measure -> (numerator, denominator or None) over the bases
MEASURES = {
    "total_net_sales": ("net", None),
    "total_gross_sales": ("gross", None),
    "total_cost": ("cost", None),
    "gross_margin": ("margin", None),
    "gross_margin_pct": ("margin", "net"),
    "total_quantity": ("units", None),
    "total_discount": ("discount", None),
    "discount_rate_pct": ("discount", "gross"),
    "sales_line_count": ("lines", None),
    "customer_count": (CUSTOMERS, None),
    "avg_order_value": ("net", "lines"),
    "sales_per_customer": ("net", CUSTOMERS),
    "return_lines": ("returns", None),
    "return_rate_pct": ("returns", "lines"),
}


def columns_of(bases: list[str]) -> list[str]:
    """The fact columns that the sums of these bases read."""
    read = {MONEY[b] for b in bases if b in MONEY}
    return sorted(read.union(*[COUNTS[b][0] for b in bases if b in COUNTS]))


def partial(base: str) -> Column:
    """A base summed over lines: money in whole cents, so that sums of sums stay exact."""
    value = F.sum(cents(F.col(MONEY[base]))) if base in MONEY else COUNTS[base][1]()
    return value.cast("bigint").alias(base)


def merged(base: str) -> Column:
    """Partial sums of a base added up, still in whole cents; nothing counted is 0, nothing summed is blank."""
    total = F.sum(base)
    return (F.coalesce(total, F.lit(0).cast("bigint")) if base in ("lines", "returns") else total).alias(base)


def final(base: str) -> Column:
    """A base as reports show it."""
    return (F.col(base) / F.lit(100.0) if base in MONEY else F.col(base)).alias(base)


def bases_of(names: list[str]) -> list[str]:
    """The bases the named measures are made of, each once."""
    parts = [base for name in names for base in MEASURES[name] if base]
    return list(dict.fromkeys(parts))


def measure(name: str) -> Column:
    """A measure as an expression over the columns of its bases."""
    numerator, denominator = MEASURES[name]
    value = F.col(numerator)
    if denominator:
        value = ratio(value.cast("double"), F.col(denominator).cast("double"))
    return value.alias(name)


def trend_label(change: Column) -> Column:
    """Arrow and percentage of a relative change; empty text when there is none."""
    arrow = F.when(change >= 0, "▲ ").otherwise("▼ ")
    percent = F.format_string("%.1f%%", round_half_up(change * 100, 1))
    return F.when(change.isNull(), "").otherwise(F.concat(arrow, percent))


def margin_status(margin_pct: Column) -> Column:
    """Traffic light of a margin ratio; a missing margin counts as low."""
    return (
        F.when(margin_pct >= 0.40, "🟢 Healthy")
        .when(margin_pct >= 0.30, "🟡 Watch")
        .otherwise("🔴 Low")
    )
