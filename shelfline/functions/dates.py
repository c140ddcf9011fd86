"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_component(later: Column, earlier: Column) -> Column:
    """Months part of the age between two dates: whole months modulo twelve, sign kept."""
    return F.months_between(later, earlier).cast("int") % 12
