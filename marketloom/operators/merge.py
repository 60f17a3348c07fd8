"""Merging bar tables: last-wins union, approximate fallback, page normalization."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.times import within_days
from marketloom.operators.minutes import ticks_to_minutes
from marketloom.operators.scan import keep_latest

BAR_KEY = ("market", "code", "ts")


def stack(frames: Sequence[DataFrame], tag: str = "_priority") -> DataFrame:
    """Union by name with the frame's position in ``tag``; absent columns are NULL."""
    tagged = [frame.withColumn(tag, F.lit(i)) for i, frame in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def merge_bars(*frames: DataFrame, key: Sequence[str] = BAR_KEY, seq: str | None = None) -> DataFrame:
    """One row per key; a later frame wins, and inside a frame the higher ``seq``."""
    if not frames:
        raise ValueError("nothing to merge")
    order = [F.col("_priority").desc()] + ([F.col(seq).desc()] if seq else [])
    return keep_latest(stack(frames), key, order).drop("_priority")


def approximate(fallback: DataFrame, source: str = "trade") -> DataFrame:
    """Fallback rows, marked as such."""
    return fallback.withColumn("source", F.lit(source)).withColumn("is_approximate", F.lit(True))


def merge_fallback(
    primary: DataFrame, fallback: DataFrame, source: str = "trade", key: Sequence[str] = BAR_KEY
) -> DataFrame:
    """Fill the keys missing from ``primary`` with fallback rows marked approximate."""
    missing = approximate(fallback, source).join(primary.select(*key), list(key), "left_anti")
    return primary.unionByName(missing, allowMissingColumns=True)


def coverage(bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last time and number of bars per series."""
    return bars.groupBy(*keys).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("count")
    )


def normalize_pages(
    pages: DataFrame,
    *,
    source: str = "tdx",
    lots: bool = False,
    timezone: str = "Asia/Shanghai",
    start: str | None = None,
    end: str | None = None,
    key: Sequence[str] = BAR_KEY,
    page: str = "page",
) -> DataFrame:
    """Normalized bars from overlapping newest-first pages.

    ``vol`` becomes ``volume`` in shares, provenance is stamped, rows outside
    [start, end) are dropped and the newest page's copy (lowest number) wins.
    """
    frame = pages
    if "vol" in frame.columns:
        frame = frame.drop("vol") if "volume" in frame.columns else frame.withColumnRenamed("vol", "volume")
    if lots and "volume" in frame.columns:
        frame = frame.withColumn("volume", F.col("volume") * 100)
    if start is not None:
        frame = frame.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        frame = frame.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    newest = keep_latest(frame, key, [F.col(page).asc()]).drop(page)
    return newest.withColumns(
        {
            "source": F.lit(source),
            "volume_unit": F.lit("shares"),
            "timezone": F.lit(timezone),
            "is_approximate": F.lit(False),
        }
    )


def fallback_minutes(
    ticks: DataFrame,
    start: str,
    end: str,
    frequency: int = 8,
    timezone: str = "Asia/Shanghai",
    zero_price: bool = False,
) -> DataFrame:
    """Approximate minute bars in [start, end) from tick days; Shanghai and Shenzhen,
    one-minute only.  Whole days are built, then cut, so carried prices are right."""
    if frequency != 8:
        raise ValueError("tick fallback is one-minute only")
    supported = ticks.where(F.col("market").isin(0, 1))
    upper_day = F.date_add(F.lit(end).cast("timestamp_ntz").cast("date"), 1)
    days = supported.where(within_days("date", F.lit(start).cast("timestamp_ntz").cast("date"), upper_day))
    ts = F.col("ts")
    return ticks_to_minutes(days, timezone=timezone, zero_price=zero_price).where(
        (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
    )
