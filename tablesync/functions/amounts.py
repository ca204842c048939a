"""Derived business columns of order data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value.
TAX_RATE = 0.08


def order_tax(total: Column, shipping: Column, discount: Column) -> Column:
    """8 % of what is left after shipping and discount, in exact cents."""
    exact = lambda c: c.cast("decimal(18,2)")
    rate = F.lit(str(TAX_RATE)).cast("decimal(4,2)")
    return F.round((exact(total) - exact(shipping) - exact(discount)) * rate, 2)


def line_total(quantity: Column, unit_price: Column) -> Column:
    return F.round(quantity * unit_price, 2)


def line_discount(total: Column, percent: Column) -> Column:
    return F.round(total * percent / 100, 2)


def line_tax(total: Column, discount: Column, rate: Column | None = None) -> Column:
    return F.round((total - discount) * (F.lit(TAX_RATE) if rate is None else rate), 2)


def available(on_hand: Column, reserved: Column) -> Column:
    """Stock that is not reserved, never negative."""
    return F.greatest(F.lit(0), on_hand - reserved)


def backorder(quantity: Column, shipped: Column) -> Column:
    return quantity - shipped

