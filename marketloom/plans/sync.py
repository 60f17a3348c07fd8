"""Incremental synchronization of a bar table from source tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.asof import asof_lookup
from marketloom.operators.intervals import merge_ranges, missing_ranges, plan_incremental
from marketloom.operators.merge import approximate
from marketloom.schemas import STORED_BARS
from marketloom.session import shared_scratch
from marketloom.sources.bar_table import IDENTITY, KEY, BarTable


def planned_ranges(
    requested: DataFrame, covered: DataFrame, latest: DataFrame, overlap: str = "0 seconds"
) -> DataFrame:
    """Gaps of the coverage plus the tail refresh of series already stored, merged.  Requests
    span years, so ranges are merged by years, not in a piece per month."""
    gaps = missing_ranges(requested, covered, IDENTITY)
    stored = requested.join(latest.select(*IDENTITY), IDENTITY, "left_semi")
    tails = plan_incremental(stored, latest, IDENTITY, overlap)
    return merge_ranges(gaps.unionByName(tails), IDENTITY, "year")


def rows_in_ranges(bars: DataFrame, ranges: DataFrame, bucket: str = "day") -> DataFrame:
    """Bars inside the (disjoint) ranges of their series, with the range they fall in.

    The latest range starting at or before a bar is the only one that can hold it, so
    this is an as-of lookup, not a range join over all pairs.
    """
    found = asof_lookup(
        bars,
        ranges.select(*IDENTITY, "start", "end", F.col("start").alias("_from")),
        IDENTITY,
        "ts",
        "_from",
        ["start", "end"],
        bucket=bucket,
        prefix="range_",
    )
    return found.where(F.col("ts") < F.col("range_end"))


#: Ranges of one series up to which each bar is held against all of them.
_FEW = 16


def rows_in_few_ranges(bars: DataFrame, ranges: DataFrame) -> DataFrame:
    """The same by one join on the series, for few ranges each: nothing is filled in by month,
    and bars of other series go at once."""
    named = ranges.select(*IDENTITY, F.col("start").alias("range_start"), F.col("end").alias("range_end"))
    inside = (F.col("ts") >= F.col("range_start")) & (F.col("ts") < F.col("range_end"))
    return bars.join(named, IDENTITY).where(inside).select(*bars.columns, "range_start", "range_end")


def _needed(feed: DataFrame, ranges: DataFrame, lo, hi, most) -> DataFrame:
    """Rows of a feed that the plan asks for; the outermost bounds reach its scan."""
    bounded = feed.where(F.col("ts").between(F.lit(lo), F.lit(hi)) if lo is not None else F.lit(False))
    if most is None or most <= _FEW:
        return rows_in_few_ranges(bounded, ranges)
    return rows_in_ranges(bounded, ranges, "month")


def _unadjusted(bars: DataFrame) -> DataFrame:
    return bars if "adjustment" in bars.columns else bars.withColumn("adjustment", F.lit("none"))


def sync(
    store: BarTable,
    source: DataFrame,
    requested: DataFrame,
    *,
    fallback: DataFrame | None = None,
    overlap: str = "0 seconds",
) -> DataFrame:
    """Bring the requested series (identity, start, end) up to date and return them.

    The plan is made from one snapshot of the table, and everything planned is read before
    anything becomes visible.  Rows and the coverage of ranges that had rows are one commit,
    so an empty answer erases nothing.
    """
    first, last, adjusted = requested.agg(F.min("start"), F.max("end"), F.max(F.col("adjustment") != "none")).first()
    if adjusted:
        raise ValueError("only unadjusted bars can be synchronized")
    source = _unadjusted(source)
    fallback = None if fallback is None else _unadjusted(fallback)
    now = store.snapshot()
    ranges = planned_ranges(requested, now.coverage().select(*IDENTITY, "start", "end"), now.last_stamps(), overlap)
    # The plan is small, read for each feed, and bounds the scans: write it once.
    plan = f"{shared_scratch(store.spark)}/plan-{uuid.uuid4().hex}"
    ranges.write.parquet(plan)
    ranges = store.spark.read.schema(ranges.schema).parquet(plan)
    per_series = ranges.groupBy(*IDENTITY).agg(F.min("start").alias("lo"), F.max("end").alias("hi"), F.count(F.lit(1)).alias("n"))
    lo, hi, most = per_series.agg(F.min("lo"), F.max("hi"), F.max("n")).first()
    rows = _needed(source, ranges, lo, hi, most).withColumn("_feed", F.lit(1))
    if fallback is not None:
        # The store keeps the row of the better feed anyway, so no join looks for missing keys.
        spare = approximate(_needed(fallback, ranges, lo, hi, most)).withColumn("_feed", F.lit(0))
        rows = rows.unionByName(spare, allowMissingColumns=True)
    store.upsert(rows, answers=("range_start", "range_end"), seq="_feed")
    # Bars that are not wanted go before the rest is put in order, which then takes one shuffle.
    wanted = requested.select(*IDENTITY, F.col("start").alias("_lo"), F.col("end").alias("_hi"))
    now = store.snapshot()
    found = (
        now.versions(first, last)
        .join(wanted, IDENTITY)
        .where((F.col("ts") >= F.col("_lo")) & (F.col("ts") < F.col("_hi")))
        .drop("_lo", "_hi")
    )
    return now.resolved(found, ordered=True).select(*STORED_BARS.names).orderBy(*KEY)
