"""Demand forecast per category.

Input is one row per day and category, so a series is bounded by the calendar however
many orders stand behind it.
"""

from __future__ import annotations

import datetime as dt
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.sources.versions import VersionedTable

# The model functions below travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HORIZON = 30
MIN_DAYS_ARIMA = 10
MIN_DAYS_AVERAGE = 3
AVERAGE_WINDOW = 7
FORECAST_SCHEMA = (
    "product_category string, forecast_date date, forecasted_net_revenue double, model string"
)


def densify(daily: DataFrame) -> DataFrame:
    """Every day between a category's first and last, missing days as zero.

    Each row fills the gap up to the next one, so the series is read once and not joined
    to a calendar.
    """
    series = Window.partitionBy("product_category").orderBy("order_date")
    gap_end = F.coalesce(
        F.date_sub(F.lead("order_date").over(series), 1), F.col("order_date")
    )
    days = (
        daily.where(F.col("order_date").isNotNull())
        .withColumn("_end", gap_end)
        .withColumn("day", F.explode(F.sequence("order_date", "_end")))
    )
    zero = F.lit(0).cast(daily.schema["daily_net_revenue"].dataType)
    return days.select(
        "product_category",
        F.col("day").alias("order_date"),
        F.when(F.col("day") == F.col("order_date"), F.col("daily_net_revenue")).otherwise(zero)
        .alias("daily_net_revenue"),
    )


def _future(days: int) -> Column:
    first = F.date_add(F.col("last_day"), 1)
    return F.explode(F.sequence(first, F.date_add(F.col("last_day"), days)))


def moving_average(dense: DataFrame, days: int = HORIZON) -> DataFrame:
    """The mean of the last seven days, held constant. Series under three days are left out."""
    newest = Window.partitionBy("product_category").orderBy(F.desc("order_date"))
    ranked = dense.withColumn("_r", F.row_number().over(newest)).where(
        F.col("_r") <= AVERAGE_WINDOW
    )
    amount = F.col("daily_net_revenue")
    last = ranked.groupBy("product_category").agg(
        F.max("order_date").alias("last_day"),
        F.count("*").alias("n"),
        (F.sum(amount) / F.count(amount)).alias("mean"),
        F.max(F.when(F.col("_r") == 1, amount)).alias("latest"),
    ).where(F.col("n") >= MIN_DAYS_AVERAGE)
    level = F.when(F.col("mean") > 0, F.col("mean")).otherwise(F.col("latest"))
    return last.select(
        "product_category",
        _future(days).alias("forecast_date"),
        F.bround(F.greatest(level, F.lit(0)), 2).cast("double").alias("forecasted_net_revenue"),
    )


def _arma_scan(w: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """Exact Gaussian likelihood of an ARMA(1,1), for many parameter pairs at once.

    Innovations recursion. Returns the profile deviance, the last one-step prediction
    error and its coefficient.
    """
    r = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    prediction = np.zeros_like(phi)
    squares = np.zeros_like(phi)
    logs = np.zeros_like(phi)
    for value in w:
        error = value - prediction
        gain = theta / r
        squares += error**2 / r
        logs += np.log(r)
        prediction = phi * value + gain * error
        r = 1 + theta**2 - theta * gain
    n = len(w)
    deviance = n * np.log(np.maximum(squares / n, 1e-300)) + logs
    return deviance, prediction


def fit_arma(w: np.ndarray, rounds: int = 9, points: int = 33) -> tuple[float, float]:
    """Maximum likelihood (phi, theta) by a grid that closes in on the best cell."""
    centre, reach = np.zeros(2), 0.995
    for _ in range(rounds):
        axes = [np.clip(np.linspace(c - reach, c + reach, points), -0.995, 0.995) for c in centre]
        phi, theta = (g.ravel() for g in np.meshgrid(*axes))
        deviance, _ = _arma_scan(w, phi, theta)
        best = int(np.nanargmin(deviance))
        centre, reach = np.array([phi[best], theta[best]]), reach / 4
    return float(centre[0]), float(centre[1])


def arima_111(series: np.ndarray, steps: int) -> np.ndarray:
    """Forecast of an ARIMA(1,1,1) without constant."""
    w = np.diff(series)
    if not np.any(w):
        return np.full(steps, series[-1])
    scale = np.std(w) or 1.0
    phi, theta = fit_arma(w / scale)
    _, ahead = _arma_scan(w / scale, np.array([phi]), np.array([theta]))
    changes = ahead[0] * phi ** np.arange(steps) * scale
    return series[-1] + np.cumsum(changes)


def _average_level(series: np.ndarray) -> float | None:
    if len(series) < MIN_DAYS_AVERAGE:
        return None
    mean = float(np.mean(series[-min(AVERAGE_WINDOW, len(series)):]))
    return mean if mean > 0 else float(series[-1])


def arima(dense: DataFrame, days: int = HORIZON) -> DataFrame:
    """ARIMA(1,1,1) for series of ten days or more; shorter or failing ones use the average."""

    def one_category(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order_date")
        series = pdf["daily_net_revenue"].to_numpy(dtype=float)
        values, model = None, "arima"
        if len(series) >= MIN_DAYS_ARIMA:
            fitted = arima_111(series, days)
            values = fitted if np.all(np.isfinite(fitted)) else None
        if values is None:
            level, model = _average_level(series), "moving_average"
            values = None if level is None else np.full(days, level)
        if values is None:
            return pd.DataFrame(
                columns=["product_category", "forecast_date", "forecasted_net_revenue", "model"]
            )
        last = pdf["order_date"].iloc[-1]
        return pd.DataFrame({
            "product_category": pdf["product_category"].iloc[0],
            "forecast_date": [last + dt.timedelta(days=i + 1) for i in range(days)],
            "forecasted_net_revenue": [round(max(float(v), 0.0), 2) for v in values],
            "model": model,
        })

    numbers = dense.withColumn("daily_net_revenue", F.col("daily_net_revenue").cast("double"))
    return numbers.groupBy("product_category").applyInPandas(one_category, FORECAST_SCHEMA)


class ForecastTable:
    """The stored forecast, stamped with the moment it was made. A new one takes the place of all rows in one step."""

    CATEGORY = "product_category"

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, self.CATEGORY)

    def read(self) -> DataFrame:
        return self.table.read(
            "forecast_date date, product_category string, forecasted_net_revenue double, model_generated_at timestamp"
        )

    def write(self, forecast: DataFrame, generated_at: dt.datetime) -> int:
        """Replace the stored rows and return their number. An empty forecast leaves the table as it is."""
        rows = forecast.select(
            "forecast_date", self.CATEGORY, F.col("forecasted_net_revenue").cast("double").alias("forecasted_net_revenue"),
            F.lit(generated_at).cast("timestamp").alias("model_generated_at"),
        )
        if rows.isEmpty():
            return 0
        self.table.replace(rows)
        return self.read().count()


def with_history(daily: DataFrame, forecast: DataFrame) -> DataFrame:
    """Past and predicted revenue in one series, told apart by ``type``."""
    past = daily.select(
        F.col("order_date").alias("date"), "product_category",
        F.col("daily_net_revenue").cast("double").alias("revenue"), F.lit("Historical").alias("type"),
    )
    ahead = forecast.select(
        F.col("forecast_date").alias("date"), "product_category",
        F.col("forecasted_net_revenue").alias("revenue"), F.lit("Forecast").alias("type"),
    )
    return past.unionByName(ahead)
