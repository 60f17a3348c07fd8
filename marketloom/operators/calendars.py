"""Holidays and trading days from a calendar table (date, country, name)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a trading day missing from the published list.
EXTRA_TRADING_DAY = "1992-05-04"


def mark_holidays(days: DataFrame, holidays: DataFrame, country: str = "中国") -> DataFrame:
    """Add ``is_holiday``: listed for the country, or a weekend."""
    listed = (
        holidays.where(F.col("country") == country)
        .select(F.col("date").cast("date").alias("date"))
        .distinct()
        .withColumn("_listed", F.lit(True))
    )
    weekend = F.weekday("date") >= 5
    return (
        days.join(listed, "date", "left")
        .withColumn("is_holiday", F.col("_listed").isNotNull() | weekend)
        .drop("_listed")
    )


def trading_calendar(published: DataFrame) -> DataFrame:
    """Published trading days with the missing one added, and their year."""
    extra = published.sparkSession.range(1).select(F.lit(EXTRA_TRADING_DAY).cast("date").alias("date"))
    return (
        published.select(F.col("date").cast("date").alias("date"))
        .unionByName(extra)
        .distinct()
        .withColumn("year", F.year("date"))
    )


def on_trading_days(frame: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Rows that fall on a trading day."""
    return frame.join(calendar.select(F.col("date").alias(date)), date, "left_semi")
