"""Row-choosing helpers shared by the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_row_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter becomes a group limit that also runs before the shuffle, so a
    key held by a large share of the rows sends one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def distinct_on_email(customers: DataFrame, *also_by: str) -> DataFrame:
    """One row per email, smallest customer_id first; remaining columns settle ties."""
    keys = [*also_by, "email"]
    rest = [c for c in customers.columns if c not in (*keys, "customer_id")]
    return first_per_key(customers, keys, [F.col("customer_id"), *map(F.col, rest)])
