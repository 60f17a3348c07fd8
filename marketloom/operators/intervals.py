"""Half-open time ranges per series: merging, gaps, incremental planning.

Equal starts are reduced first, and a series with very many ranges is spread over its
months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.asof import time_bucket
from marketloom.operators.scan import add_running_max_before

SERIES = ("market", "code")


def _chunk(column: str, unit: str) -> Column:
    return time_bucket(F.col(column), unit)


def _islands(starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlapping or touching ranges joined within equal keys, by one exchange on the keys."""
    so_far = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max("end").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(F.col("_reached").isNull() | (F.col("start") > F.col("_reached")), F.col("start"))
    # An island is named by its first start.
    return (
        starts.withColumn("_reached", reached)
        .withColumn("_opened", opened)
        .withColumn("_island", F.max("_opened").over(so_far))
        .groupBy(*keys, "_island")
        .agg(F.max("end").alias("end"))
        .withColumnRenamed("_island", "start")
    )


def merge_ranges(ranges: DataFrame, keys: Sequence[str] = SERIES, chunk: str = "month") -> DataFrame:
    """Join overlapping or touching ranges (dates or timestamps) of a series.

    Ranges are cut at the borders of calendar chunks (``month`` or ``year``), joined within
    (series, chunk), and what touches a border is joined across chunks.  That takes three
    exchanges: one that reduces equal starts first, one per chunk, and one where pieces away
    from all borders stand alone, so a series with very many ranges stays spread and brings
    at most two pieces per chunk together.  A range becomes one piece per chunk it reaches:
    take ``year`` for ranges of centuries.  Empty and reversed ranges are left out.
    """
    keys = list(keys)
    months = {"month": 1, "year": 12}[chunk]
    kind = ranges.schema["start"].dataType
    chunks = F.sequence(F.trunc("start", chunk), F.trunc("end", chunk), F.expr(f"interval {months} month"))
    low, high = F.col("_chunk").cast(kind), F.add_months("_chunk", months).cast(kind)
    pieces = (
        ranges.where(F.col("start") < F.col("end"))
        .select(*keys, "start", "end", F.explode(chunks).alias("_chunk"))
        .select(*keys, "_chunk", F.greatest("start", low).alias("start"), F.least("end", high).alias("end"))
        .where(F.col("start") < F.col("end"))
        .groupBy(*keys, "_chunk", "start")
        .agg(F.max("end").alias("end"))
    )
    inside = _islands(pieces, [*keys, "_chunk"])
    border = (F.col("start") == low) | (F.col("end") == high)
    alone = inside.select(*keys, "start", "end", F.when(~border, F.col("start")).alias("_alone"))
    return _islands(alone, [*keys, "_alone"]).select(*keys, "start", "end")


def missing_ranges(
    requested: DataFrame, covered: DataFrame, keys: Sequence[str] = SERIES, chunk: str = "month"
) -> DataFrame:
    """Requested minus covered, per series (one requested range each).

    Two empty ranges at the request's ends stand for its borders, so head, inner and
    tail gaps are all "start beyond what was reached"; a series without coverage gives
    its whole request.
    """
    keys = list(keys)
    wanted = requested.where(F.col("start") < F.col("end")).select(
        *keys, F.col("start").alias("_lo"), F.col("end").alias("_hi")
    )
    clipped = (
        covered.select(*keys, "start", "end")
        .join(wanted, keys)
        .select(
            *keys,
            F.greatest("start", "_lo").alias("start"),
            F.least("end", "_hi").alias("end"),
        )
        .where(F.col("start") < F.col("end"))
    )
    borders = wanted.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("_lo").alias("start"), F.col("_lo").alias("end")),
                F.struct(F.col("_hi").alias("start"), F.col("_hi").alias("end")),
            )
        ),
    )
    points = clipped.unionByName(borders).groupBy(*keys, "start").agg(F.max("end").alias("end"))
    scanned = add_running_max_before(points, keys, ["start"], "end", _chunk("start", chunk), "_reached")
    return scanned.where(F.col("start") > F.col("_reached")).select(
        *keys, F.col("_reached").alias("start"), F.col("start").alias("end")
    )


def plan_incremental(
    requested: DataFrame, latest: DataFrame, keys: Sequence[str] = SERIES, overlap: str = "0 seconds"
) -> DataFrame:
    """Tail refresh per series: from ``last`` less the overlap, or the whole request
    where nothing is stored.  Series already complete give no row."""
    begin = F.greatest(F.col("start"), F.col("last") - F.expr(f"interval {overlap}"))
    return (
        requested.join(latest.select(*keys, "last"), list(keys), "left")
        .withColumn("start", F.coalesce(begin, F.col("start")))
        .where(F.col("start") < F.col("end"))
        .select(*keys, "start", "end")
    )


def mark_coverage(
    stored: DataFrame, added: DataFrame, keys: Sequence[str], provenance: Sequence[str] = ("source", "is_approximate")
) -> DataFrame:
    """Coverage after adding ranges: merged only within equal provenance."""
    columns = [*keys, *provenance, "start", "end"]
    return merge_ranges(
        stored.select(*columns).unionByName(added.select(*columns)), [*keys, *provenance]
    ).select(*columns)
