"""Trailing-mean baseline: one window serves both the forecast and the
spike/drop rules."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .demand import SERIES_KEYS


def trailing_window(window_rows: int):
    """The previous ``window_rows`` rows of the series; the current row is excluded.

    The frame counts rows, not days: a gap in the dates does not widen it.
    """
    return Window.partitionBy(*SERIES_KEYS).orderBy("date").rowsBetween(-window_rows, -1)


def with_baseline(demand: DataFrame, window_rows: int = 14) -> DataFrame:
    """Add ``rolling_mean`` (null on the first row of a series) and
    ``forecast_units`` = coalesce(rolling_mean, units_sold, 0.0).

    The window partitions the frame by series (or uses a join's partitioning by
    series), and the stock fold that follows shares that exchange.
    """
    mean = F.avg("units_sold").over(trailing_window(window_rows))
    return (demand.withColumn("rolling_mean", mean)
            .withColumn("forecast_units",
                        F.coalesce(F.col("rolling_mean"), F.col("units_sold"), F.lit(0.0))))


def repeats_date() -> Column:
    """Whether a row has the date of the row before it; shares the baseline's sort."""
    before = F.lag("date").over(Window.partitionBy(*SERIES_KEYS).orderBy("date"))
    return F.coalesce(before == F.col("date"), F.lit(False))


def build_forecast(demand: DataFrame, window_rows: int = 14) -> DataFrame:
    """The forecast table: date, store_id, item_id, forecast_units."""
    return with_baseline(demand, window_rows).select("date", "store_id", "item_id",
                                                     "forecast_units")


def attach_forecast(demand: DataFrame, forecast: DataFrame) -> DataFrame:
    """Left-join an outside forecast on (date, store, item); a missing forecast
    falls back to the day's units."""
    fc = forecast.select("date", "store_id", "item_id",
                         F.col("forecast_units").alias("_forecast"))
    return (demand.join(fc, on=["date", *SERIES_KEYS], how="left")
            .withColumn("forecast_units", F.coalesce(F.col("_forecast"), F.col("units_sold")))
            .drop("_forecast"))
