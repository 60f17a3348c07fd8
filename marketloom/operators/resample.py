"""Bar resampling: fixed counts, calendar periods, trading sessions.

Each is a key expression plus one hash aggregation; only the fixed-count form needs
row positions, and gets them from the two-level scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.times import second_of_day
from marketloom.operators.asof import time_bucket
from marketloom.operators.scan import add_ordinal

SERIES = ("market", "code")
CALENDAR_PERIODS = ("week", "month", "quarter", "year")


def aggregate_bars(
    bars: DataFrame, group: Sequence[str], ts: str = "ts", keep: Sequence[str] = ()
) -> DataFrame:
    """OHLCV aggregate of each group, in time order.

    ``ts`` must be unique in a group.  Sums are NULL only where all inputs are; every
    other column takes the last bar's value; the source is the last non-empty one,
    among approximate bars where there are any.
    """
    aggregates: dict[str, Column] = {}
    for name in bars.columns:
        if name in group or name in keep:
            continue
        if name == ts:
            aggregates[name] = F.max(ts)
        elif name == "open":
            aggregates[name] = F.min_by(name, ts)
        elif name == "high":
            aggregates[name] = F.max(name)
        elif name == "low":
            aggregates[name] = F.min(name)
        elif name in ("volume", "amount", "turnover"):
            aggregates[name] = F.sum(name)
        elif name == "is_approximate":
            aggregates[name] = F.bool_or(F.coalesce(F.col(name), F.lit(False)))
        elif name == "source":
            named = F.coalesce(F.col(name), F.lit("")) != ""
            latest = F.max_by(name, F.when(named, F.col(ts)))
            if "is_approximate" in bars.columns:
                rough = F.coalesce(F.col("is_approximate"), F.lit(False))
                rough_latest = F.max_by(name, F.when(named & rough, F.col(ts)))
                latest = F.when(F.bool_or(rough), rough_latest).otherwise(latest)
            aggregates[name] = F.coalesce(latest, F.lit(""))
        else:
            aggregates[name] = F.max_by(name, ts)
    return bars.groupBy(*group).agg(*[c.alias(n) for n, c in aggregates.items()])


def every_n_bars(
    bars: DataFrame, n: int, keys: Sequence[str] = SERIES, ts: str = "ts", chunk: str = "month"
) -> DataFrame:
    """Every ``n`` consecutive bars of a series; the last group may be short."""
    if isinstance(n, bool) or not isinstance(n, int) or n <= 0:
        raise ValueError("n must be a positive integer")
    if n == 1:
        return bars
    numbered = add_ordinal(bars, keys, [ts], time_bucket(F.col(ts), chunk), "_position")
    grouped = numbered.withColumn("_group", F.floor(F.col("_position") / n)).drop("_position")
    return aggregate_bars(grouped, [*keys, "_group"], ts).drop("_group").select(*bars.columns)


def calendar_period(ts: Column, period: str) -> Column:
    """Sortable number of the local ISO week, month, quarter or year."""
    if period == "week":
        return F.extract(F.lit("YEAROFWEEK"), ts) * 100 + F.weekofyear(ts)
    if period == "month":
        return F.year(ts) * 100 + F.month(ts)
    if period == "quarter":
        return F.year(ts) * 100 + F.quarter(ts)
    if period == "year":
        return F.year(ts)
    raise ValueError(f"unsupported calendar period: {period!r}")


def days_to_calendar(
    bars: DataFrame, period: str, keys: Sequence[str] = SERIES, ts: str = "ts"
) -> DataFrame:
    """Daily bars per ISO week, month, quarter or year, stamped with the last bar."""
    keyed = bars.withColumn("_period", calendar_period(F.col(ts), period))
    return aggregate_bars(keyed, [*keys, "_period"], ts).drop("_period").select(*bars.columns)


@dataclass(frozen=True)
class TradingSession:
    """Minutes of the day; an end before the start means overnight."""

    start: int
    end: int

    def __post_init__(self) -> None:
        if not (0 <= self.start <= 1439 and 0 <= self.end <= 1440) or self.start == self.end:
            raise ValueError(f"invalid trading session: {self.start}-{self.end}")

    @classmethod
    def of(cls, start: str, end: str) -> TradingSession:
        def minute(text: str) -> int:
            hour, _, rest = text.partition(":")
            return int(hour) * 60 + int(rest)

        return cls(minute(start), minute(end))

    @property
    def length(self) -> int:
        return self.end - self.start if self.end > self.start else self.end + 1440 - self.start


def _check_sessions(sessions: Sequence[TradingSession]) -> None:
    if not sessions:
        raise ValueError("trading sessions must not be empty")
    spans = []
    for session in sessions:
        last = session.start + session.length - (1 if session.length == 1440 else 0)
        spans += [(session.start, min(last, 1439))] + ([(0, last - 1440)] if last >= 1440 else [])
    spans.sort()
    for (_, end), (start, _) in zip(spans, spans[1:]):
        if start <= end:
            raise ValueError("trading sessions overlap or touch")


def session_bucket(ts: Column, n: int, sessions: Sequence[TradingSession]) -> Column:
    """Struct (begin day number, session, bucket) of the first session holding ``ts``.

    Sessions are few and fixed, so the choice is a CASE expression, not a join.  A bar
    exactly at the begin is a bucket of its own (-1); NULL outside all sessions.
    """
    _check_sessions(sessions)
    second = second_of_day(ts)
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    bucket = F.lit(None).cast("struct<day:int,session:int,bucket:bigint>")
    for index in reversed(range(len(sessions))):
        session = sessions[index]
        for back in (1, 0):
            elapsed = second + back * 86_400 - session.start * 60
            inside = (elapsed >= 0) & (elapsed <= session.length * 60)
            bucket = F.when(
                inside,
                F.struct(
                    (day - back).alias("day"),
                    F.lit(index).alias("session"),
                    F.when(elapsed == 0, F.lit(-1))
                    .otherwise(F.floor((elapsed - 1) / (n * 60)))
                    .cast("bigint")
                    .alias("bucket"),
                ),
            ).otherwise(bucket)
    return bucket


def minutes_to_sessions(
    bars: DataFrame,
    n: int,
    sessions: Sequence[TradingSession],
    keys: Sequence[str] = SERIES,
    ts: str = "ts",
    strict: bool = True,
) -> DataFrame:
    """Minute bars to ``n``-minute bars aligned to session starts, never crossing them.

    Bars outside all sessions are an error in strict mode; otherwise they are left out
    (read them with :func:`outside_sessions`).
    """
    if isinstance(n, bool) or not isinstance(n, int) or n <= 0:
        raise ValueError("n must be a positive integer")
    bucket = session_bucket(F.col(ts), n, sessions)
    if strict:
        bucket = F.coalesce(
            bucket,
            F.raise_error(F.concat(F.lit("bar outside trading sessions: "), F.col(ts).cast("string"))),
        )
    keyed = bars.withColumn("_bucket", bucket).where(F.col("_bucket").isNotNull())
    keyed = keyed.withColumns(
        {"_day": F.col("_bucket.day"), "_session": F.col("_bucket.session"), "_slot": F.col("_bucket.bucket")}
    ).drop("_bucket")
    out = aggregate_bars(keyed, [*keys, "_day", "_session", "_slot"], ts)
    return out.select(*bars.columns)


def outside_sessions(bars: DataFrame, sessions: Sequence[TradingSession], ts: str = "ts") -> DataFrame:
    return bars.where(session_bucket(F.col(ts), 1, sessions).isNull())
