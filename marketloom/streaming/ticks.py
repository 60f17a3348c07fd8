"""The tick questions asked of a stream (Structured Streaming).

Each keeps the batch operator's maths, so a finished stream equals the batch result
for every key that is no longer open.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from marketloom.functions.times import at_minute, second_of_day
from marketloom.functions.trades import DEFAULT_THRESHOLDS
from marketloom.operators.capital_flow import flow_summary, flow_sums
from marketloom.operators.minutes import exact_units, minute_bucket, tick_order
from marketloom.sources.bar_table import BarTable


def stream_minutes(
    ticks: DataFrame, watermark: str = "10 minutes", keys: Sequence[str] = ("market", "code")
) -> DataFrame:
    """Minute bars of a tick stream with event time ``ts`` (TIMESTAMP).

    Only traded minutes: carrying closes into empty ones needs the finished day and is
    a batch step.  The watermark runs on the bar's own time, so append mode closes a
    bar once it lies behind, and state is one row per open (series, minute).  Order
    inside a minute is (ts, seq) where the ticks have a ``seq``.
    """
    order = tick_order(F.unix_micros("ts")) if "seq" in ticks.columns else F.unix_micros("ts")
    second = second_of_day("ts")
    minute = minute_bucket(F.floor(second / 60))
    zone_free = at_minute(F.to_date("ts"), minute).cast("timestamp")
    return (
        ticks.withColumns({"bucket": zone_free, "_order": order, "_shares": F.col("vol").cast("double") * 100})
        .withWatermark("bucket", watermark)
        .groupBy(*keys, F.window("bucket", "1 minute").alias("_window"))
        .agg(
            F.min_by("price", "_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_order").alias("close"),
            F.sum("_shares").alias("volume"),
            (F.sum(exact_units(F.col("price") * F.col("_shares"))) / 10_000).alias("amount"),
        )
        .select(*keys, F.col("_window.start").alias("ts"), "open", "high", "low", "close", "volume", "amount")
    )


def stream_flow(
    ticks: DataFrame,
    watermark: str = "1 day",
    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
    zero_price: bool = False,
) -> DataFrame:
    """Running flow summary per (market, code, day), for update mode; append mode gives
    each day once, when the watermark has passed it.

    Windows cut at UTC midnight, so event time is shifted to the session zone's wall clock
    first, and the day read back from there.
    """
    keys = ["market", "code", "day"]
    zone = ticks.sparkSession.conf.get("spark.sql.session.timeZone")
    local = ticks.withColumn("_local", F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone))
    timed = local.withWatermark("_local", watermark).withColumn("day", F.window("_local", "1 day"))
    return flow_summary(flow_sums(timed, keys, thresholds, zero_price=zero_price), keys).withColumn(
        "day", F.to_date(F.to_utc_timestamp("day.start", zone))
    )


def first_snapshots(
    snapshots: DataFrame,
    watermark: str = "10 minutes",
    keys: Sequence[str] = ("market", "code", "round"),
    seq: str = "seq",
    span: str = "1 day",
) -> DataFrame:
    """The first response of each key by ``seq``, whatever order rows arrive in; a key's
    responses belong together if they fall into the same ``span``.  For update mode; append
    mode gives each key once, and state ends with the watermark."""
    row = F.struct(*snapshots.columns)
    return (
        snapshots.withWatermark("ts", watermark)
        .groupBy(*keys, F.window("ts", span).alias("_span"))
        .agg(F.min_by(row, seq).alias("_first"))
        .select("_first.*")
    )


def upsert_batches(bars: DataFrame, store: BarTable) -> DataStreamWriter:
    """Writer that upserts every micro-batch.

    Upserting by key makes a replayed batch harmless: the same rows replace themselves.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch)

    sink: Callable[[DataFrame, int], None] = write
    return bars.writeStream.foreachBatch(sink)
