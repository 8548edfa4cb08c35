"""Promotions, order totals, loyalty and refunds."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.schema import MONEY

# Fixed values.
ETA_BUFFER_MIN = Decimal("8.00")
REFUND_BASE = {"misplaced": 0.90, "not_delivered": 1.00, "wrong_order": 0.50}
LOYALTY_BONUS = 0.10
REFUND_FLOOR = 5.0


def percent_off(subtotal: Column, pct: Column) -> Column:
    return F.round(subtotal * pct * F.lit(Decimal("0.01")), 2).cast(MONEY)


def half_off(subtotal: Column) -> Column:
    return F.round(subtotal * F.lit(Decimal("0.5")), 2).cast(MONEY)


def discount(promo_type: Column, pct: Column, flat: Column, subtotal: Column) -> Column:
    return (
        F.when(promo_type == "discount_pct", percent_off(subtotal, pct))
        .when(promo_type == "flat_discount", flat.cast(MONEY))
        .when(promo_type == "bogo", half_off(subtotal))
        .otherwise(F.lit(0).cast(MONEY))
    )


def waives_fee(promo_type: Column) -> Column:
    return F.coalesce(promo_type == "free_delivery", F.lit(False))


def promised_eta(prep: Column, travel: Column) -> Column:
    return prep + travel + F.lit(ETA_BUFFER_MIN)


def order_total(subtotal: Column, discount: Column, fee: Column, tip: Column) -> Column:
    return subtotal - discount + fee + tip


def loyalty(tenure_days: Column, orders: Column, gmv: Column) -> Column:
    """Mean of three parts between 0 and 1: tenure, order count, spend."""
    parts = [tenure_days / 365.0, orders / 20.0, gmv.cast("double") / 500.0]
    a, b, c = [F.least(F.lit(1.0), p) for p in parts]
    return (a + b + c) / 3.0


def refund(issue: Column, total: Column, loyalty: Column) -> Column:
    """Zero without an issue; else a share of the total, at least the floor
    and never above the total."""
    base = F.element_at(F.create_map(*[F.lit(x) for kv in REFUND_BASE.items() for x in kv]), issue)
    share = F.least(F.lit(1.0), base + loyalty * LOYALTY_BONUS)
    amount = total.cast("double")
    paid = F.least(amount, F.greatest(F.lit(REFUND_FLOOR), amount * share))
    return F.when(issue.isNull(), 0.0).otherwise(F.round(paid, 2))
