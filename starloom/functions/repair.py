"""Repair rules: each returns the repaired value as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.contracts import AMOUNT_TOLERANCE, MARGIN, MONEY


def _nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def repair_invoice_date(invoice_date: Column, due_date: Column, term_days: Column) -> Column:
    """A missing invoice date is the due date less the payment term."""
    return F.coalesce(invoice_date, F.date_sub(due_date, term_days))


def swap_day_month(order_date: Column, ship_date: Column) -> Column:
    """The order date with day and month exchanged, where it is later than the shipment and the
    exchange both exists and resolves that; NULL otherwise."""
    swapped = F.when(F.day(order_date) <= 12,
                     F.make_date(F.year(order_date), F.day(order_date), F.month(order_date)))
    return F.when((order_date > ship_date) & (swapped <= ship_date), swapped)


def repair_order_date(order_date: Column, ship_date: Column, invoice_date: Column,
                      swap: bool = True) -> Column:
    """Order date; when later than the first shipment the exchanged date (if ``swap``) or the
    invoice date; when missing the invoice date, then the shipment date."""
    replacement = F.coalesce(swap_day_month(order_date, ship_date), invoice_date) if swap else invoice_date
    plausible = F.when(order_date > ship_date, replacement).otherwise(order_date)
    return F.coalesce(plausible, invoice_date, ship_date)


def repair_quantity(quantity: Column, subtotal: Column, price: Column) -> Column:
    return F.coalesce(quantity, F.round(subtotal / _nonzero(price), 0).cast("int"))


def repair_discount(amount: Column, subtotal: Column, rate: Column) -> Column:
    return F.coalesce(amount, subtotal * F.coalesce(rate, F.lit(0.0)))


def repair_rate(rate: Column, amount: Column, subtotal: Column) -> Column:
    return F.coalesce(rate, amount / _nonzero(subtotal))


def recompute_amount(subtotal: Column, discount: Column) -> Column:
    """Net line amount from the source's subtotal and the repaired discount."""
    return (F.coalesce(subtotal, F.lit(0.0)) - discount).cast(MONEY)


def amount_gap(source: Column, recomputed: Column) -> Column:
    return F.abs(source - recomputed)


def amount_mismatch(source: Column, recomputed: Column, tolerance: str = AMOUNT_TOLERANCE) -> Column:
    """True when both amounts are known and differ by more than the tolerance."""
    limit = F.lit(tolerance).cast("decimal(19,4)")
    return F.coalesce(amount_gap(source, recomputed) > limit, F.lit(False))


def repair_unit_cost(cost: Column, quantity: Column, total: Column,
                     tolerance: str = AMOUNT_TOLERANCE) -> Column:
    """Unit cost from total and quantity where cost x quantity does not give the total."""
    off = F.abs(cost * quantity - total) > F.lit(float(tolerance))
    return F.when(off, F.coalesce(total / _nonzero(quantity.cast("double")), cost)).otherwise(cost)


def unit_margin(price: Column, cost: Column) -> Column:
    """Margin share of the price; NULL unless the price is positive."""
    return F.when(price > 0, F.round((price - cost).cast("double") / price.cast("double"), 6).cast(MARGIN))


def money(c: Column) -> Column:
    return c.cast(MONEY)
