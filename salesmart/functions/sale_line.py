"""Row-level measures of one sale line; a return line reverses the sale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.rounding import round_cents

# which inputs each derived column needs, for column pruning
INPUTS = {
    "quantity": {"quantity", "is_return"},
    "unit_price": {"unit_price"},
    "discount_pct": {"discount_pct"},
    "gross_sales": {"quantity", "unit_price", "is_return"},
    "discount_amount": {"quantity", "unit_price", "discount_pct", "is_return"},
    "net_sales": {"quantity", "unit_price", "discount_pct", "is_return"},
    "cost_amount": {"quantity", "unit_cost", "is_return"},
    "gross_margin": {"quantity", "unit_price", "discount_pct", "unit_cost", "is_return"},
    "is_return": {"is_return"},
}


def _sign() -> Column:
    return F.when(F.col("is_return") == 1, -1.0).otherwise(1.0)


def _quantity() -> Column:
    return F.col("quantity").cast("double")


def _gross() -> Column:
    return _quantity() * F.col("unit_price")


def _discount() -> Column:
    return _gross() * F.col("discount_pct")


def _net() -> Column:
    return _gross() - _discount()


def _cost() -> Column:
    return _quantity() * F.col("unit_cost")


# Each amount is computed from unrounded inputs, signed, and rounded last.
LINE_MEASURES = {
    "quantity": lambda: (_quantity() * _sign()).cast("int"),
    "unit_price": lambda: F.col("unit_price"),
    "discount_pct": lambda: F.col("discount_pct"),
    "gross_sales": lambda: round_cents(_gross() * _sign()),
    "discount_amount": lambda: round_cents(_discount() * _sign()),
    "net_sales": lambda: round_cents(_net() * _sign()),
    "cost_amount": lambda: round_cents(_cost() * _sign()),
    "gross_margin": lambda: round_cents((_net() - _cost()) * _sign()),
    "is_return": lambda: F.col("is_return").cast("int"),
}
