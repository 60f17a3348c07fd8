"""Share capital in force: as-of turnover and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.labels import EQUITY_CATEGORIES, category_name
from marketloom.functions.numbers import finite_or_null, truncated
from marketloom.operators.asof import asof_lookup
from marketloom.operators.scan import keep_latest
from marketloom.schemas import ACTION_NUMBERS

SERIES = ("market", "code")


def normalize_actions(actions: DataFrame) -> DataFrame:
    """Calendar date, integer category with its name, missing numbers as 0."""
    out = actions.withColumn("date", F.col("date").cast("date")).withColumn(
        "category", F.col("category").cast("int")
    )
    out = out.withColumn("category_name", category_name("category"))
    for name in ACTION_NUMBERS:
        if name in out.columns:
            out = out.withColumn(name, F.coalesce(finite_or_null(name), F.lit(0.0)))
    return out


def _scale(actions: DataFrame) -> Column:
    """Online records count ten-thousand shares, local ones shares."""
    if "equity_unit" not in actions.columns:
        return F.lit(1.0)
    return F.when(F.col("equity_unit") == "ten_thousand_shares", 10_000.0).otherwise(1.0)


def equity_events(actions: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Float equity in shares, one row per security and date; of several records on
    a day the last in source order counts."""
    events = normalize_actions(actions).where(F.col("category").isin(EQUITY_CATEGORIES))
    return events.groupBy(*keys, "date").agg(
        F.max_by(F.col("panhouliutong") * _scale(actions), F.col("seq")).alias("float_equity")
    )


def enrich_turnover(
    bars: DataFrame, actions: DataFrame, keys: Sequence[str] = SERIES, column: str = "turnover"
) -> DataFrame:
    """Daily turnover percent from the latest share capital in force.

    Bar volume is in lots.  Unknown or non-positive capital leaves NULL; an older
    positive record is not looked for.
    """
    matched = asof_lookup(bars, equity_events(actions, keys), keys, "date", "date", ["float_equity"])
    lots = finite_or_null("volume")
    rate = F.greatest(lots, F.lit(0.0)) * 100.0 / F.col("float_equity") * 100.0
    return matched.withColumn(
        column, F.when(lots.isNotNull() & (F.col("float_equity") > 0), rate)
    ).drop("float_equity")


def equity_snapshot(
    actions: DataFrame, at: str | None = None, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Latest share-capital record of each security, in whole shares.

    Ten-thousands are scaled before the fraction is cut off.
    """
    events = normalize_actions(actions).where(F.col("category").isin(EQUITY_CATEGORIES))
    if at is not None:
        events = events.where(F.col("date") <= F.lit(at).cast("date"))
    scale = _scale(actions)
    latest = keep_latest(events, keys, [F.col("date").desc(), F.col("seq").desc()])
    return latest.select(
        *keys,
        "date",
        "category",
        truncated(F.col("panhouliutong") * scale).alias("float_equity"),
        truncated(F.col("houzongguben") * scale).alias("total_equity"),
    )
