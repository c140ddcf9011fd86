"""Row scope by role, from a mapping that the caller keeps: a role sees one country, or everything."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


class UnknownRole(LookupError):
    """A role that the mapping does not hold sees nothing, not everything."""


def country_of(role: str, limits: Mapping[str, str | None]) -> str | None:
    """The country a role is limited to, None for no limit."""
    try:
        return limits[role]
    except KeyError:
        raise UnknownRole(role) from None


def scoped(df: DataFrame, role: str, limits: Mapping[str, str | None], column: str = "country") -> DataFrame:
    """The rows a role may see. A table without the column holds nothing to limit."""
    only = country_of(role, limits)
    limited = only is not None and column in df.columns
    return df.where(F.col(column) == F.lit(only)) if limited else df
