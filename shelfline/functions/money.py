"""Money arithmetic: integer cents until the last step, then exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from shelfline.schemas import MONEY, MONEY_SUM


def net_cents(gross_cents: Column, discount_pct: Column) -> Column:
    """Discounted amount in whole cents, halves rounded away from zero.

    Long arithmetic only, so it stays inside generated code; overflow raises.
    """
    scaled = gross_cents.cast("bigint") * (F.lit(100).cast("bigint") - discount_pct)
    away = F.when(scaled < 0, scaled - 50).otherwise(scaled + 50)
    return F.call_function("div", away, F.lit(100).cast("bigint"))


def cents_to_dollars(cents: Column, places: int = 2) -> Column:
    return F.round(cents.cast("decimal(20,0)") * F.lit(Decimal("0.01")), places).cast(MONEY)


def money_sum(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY_SUM)


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Exact decimal quotient; NULL when the denominator is zero."""
    return F.round(numerator / F.nullif(denominator, F.lit(0).cast(MONEY_SUM)), places)


def percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    return F.round(numerator / F.nullif(denominator, F.lit(0).cast(MONEY_SUM)) * 100, places)
