"""Whole user questions, composed from the operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.times import since as on_or_after
from marketloom.functions.trades import DEFAULT_THRESHOLDS
from marketloom.operators import adjust, capital_flow, equity
from marketloom.session import shared_scratch
from marketloom.sources.flow_table import FlowTable

SERIES = ["market", "code"]


def price_history(
    bars: DataFrame,
    actions: DataFrame,
    *,
    since: str | None = None,
    adjusted: str | None = None,
    turnover: bool = False,
) -> DataFrame:
    """Daily bars of all securities from a date on, adjusted and with turnover.

    The date filter comes first and reaches the scan, so backward adjustment is
    anchored at the first bar returned.  Turnover uses raw volume.
    """
    out = bars if since is None else bars.where(on_or_after("date", since))
    if adjusted is not None:
        out = adjust.adjust_bars(out, actions, adjusted)
    if turnover:
        out = equity.enrich_turnover(out, actions)
    return out


def flow_history(
    bars: DataFrame,
    ticks: DataFrame,
    days: int | None = 20,
    windows: Sequence[int] = (5, 20),
    strict: bool = False,
    kept: FlowTable | None = None,
) -> DataFrame:
    """Daily flow with rolling sums from the ticks of the days that count.

    The newest bars of each security name the days; they are worked out once and written to
    the shared folder.  Their earliest date bounds the scan of the ticks, and a semi join
    keeps other days from the aggregation.  Where all days are wanted (None), bars bound
    nothing and meet the flow once, as they are.  With a table of ``kept`` daily flow, its
    closed days are read from there, and ticks of the days after them only.
    """
    spark = bars.sparkSession
    recent = capital_flow.recent_days(bars, days, windows)
    closed = None if kept is None else kept.closed_until()
    if days is not None:
        path = f"{shared_scratch(spark)}/days-{uuid.uuid4().hex}"
        recent.write.parquet(path)
        recent = spark.read.schema(recent.schema).parquet(path)
        first = recent.agg(F.min("date")).scalar()
        ticks = ticks.where(F.col("date") >= first).join(recent.select(*SERIES, "date"), [*SERIES, "date"], "left_semi")
    if closed is not None:
        ticks = ticks.where(F.col("date") > F.lit(closed))
    summary = capital_flow.flow_summary(capital_flow.flow_sums(ticks))
    if closed is not None:
        old = kept.rows(None if days is None else first)
        summary = summary.select(*old.columns).unionByName(old)
    return capital_flow.flow_history(bars, summary, days, windows, strict, recent)


def sector_report(
    name: str,
    industries: DataFrame,
    ticks: DataFrame,
    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(totals, ranked members) of one named sector.

    Only the members' ticks are aggregated: the semi join keeps the others from the
    shuffle.  In strict mode a member without trades is an error.
    """
    members = capital_flow.sector_members(industries, name).select(*SERIES, F.lit(name).alias("sector"))
    traded = ticks.join(members.select(*SERIES).distinct(), SERIES, "left_semi")
    summary = capital_flow.flow_summary(capital_flow.flow_sums(traded, SERIES, thresholds), SERIES)
    return (
        capital_flow.sector_flow(members, summary, strict=strict),
        capital_flow.rank_members(members, summary),
    )
