"""Raw tables that arrive as dated batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.schemas import EXEC_DATE

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class BatchTable:
    """Rows tagged with ``_execution_date``, as one or more batches.

    ``dates`` lists the batches when they are known without reading data, as from a
    partition listing; picking the latest batch is then a literal partition filter.
    """

    whole: Callable[[], DataFrame]
    dates: tuple[dt.date, ...] | None = None
    # One batch on its own, for tables that can produce it without the others.
    single: Callable[[dt.date], DataFrame] | None = None

    @cached_property
    def frame(self) -> DataFrame:
        return self.whole()

    def latest(self) -> DataFrame:
        if self.dates and self.single:
            return self.single(max(self.dates))
        if self.dates:
            newest = F.lit(max(self.dates))
        else:
            newest = self.frame.agg(F.max(EXEC_DATE)).scalar()
        return self.frame.where(F.col(EXEC_DATE) == newest)

    def then(self, step: Step) -> "BatchTable":
        """The same batches after a row-wise step."""
        single = self.single
        return BatchTable(
            lambda: step(self.frame),
            self.dates,
            None if single is None else lambda day: step(single(day)),
        )

    def where(self, condition: Column) -> "BatchTable":
        return self.then(lambda df: df.where(condition))

    def until(self, day: dt.date) -> "BatchTable":
        kept = tuple(d for d in self.dates if d <= day) if self.dates else None
        rows = self.then(lambda df: df.where(F.col(EXEC_DATE) <= F.lit(day)))
        return BatchTable(rows.whole, kept, rows.single)

    @staticmethod
    def of(dates: Sequence[dt.date], batch: Callable[[dt.date], DataFrame]) -> "BatchTable":
        """One table from a frame per date."""
        def single(day: dt.date) -> DataFrame:
            return batch(day).withColumn(EXEC_DATE, F.lit(day))

        return BatchTable(
            lambda: reduce(DataFrame.unionByName, (single(d) for d in dates)), tuple(dates), single
        )


@dataclass(frozen=True)
class RawTables:
    customers: BatchTable
    products: BatchTable
    orders: BatchTable

    def until(self, day: dt.date) -> "RawTables":
        """The tables as they were after the batch of ``day``."""
        return RawTables(*(t.until(day) for t in (self.customers, self.products, self.orders)))
