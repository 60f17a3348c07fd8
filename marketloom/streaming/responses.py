"""The first response of each key, as a stateful processor with timers.

Windows cut time at fixed places, so answers to one request on both sides of a border (a
midnight, say) would count as two.  Here a key's first answer opens a span of its own, and
answers nearer to it in event time than the span's length belong to it, whatever order rows
arrive in; a timer ends it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstResponse(StatefulProcessor):
    """State per key: its open spans, each with the time that opened it and the answer with the
    least ``seq`` so far (mostly one; more where the watermark lags behind).  Times are
    microseconds since 1970."""

    def __init__(self, schema: T.StructType, seq: str, ts: str, span: int, final: bool) -> None:
        self.schema, self.seq, self.ts, self.span, self.final = schema, seq, ts, span, final

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", T.StructType([T.StructField("_opened", T.LongType()), *self.schema.fields]))

    def _row(self, values: Sequence[Any]) -> Row:
        return Row(**dict(zip(self.schema.fieldNames(), values, strict=True)))

    def _spans(self) -> list[tuple[Any, ...]]:
        return [tuple(x) for x in self.open.get()] if self.open.exists() else []

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        at, place = self.schema.fieldNames().index(self.ts), self.schema.fieldNames().index(self.seq)
        spans, better = self._spans(), set()
        for row in sorted((tuple(r)[: len(self.schema)] for r in rows), key=lambda r: r[at]):
            k = next((k for k, s in enumerate(spans) if abs(row[at] - s[0]) < self.span), None)
            if k is None:
                k = len(spans)
                spans.append((row[at], *row))
                self.handle.registerTimer((row[at] + self.span) // 1000)
                better.add(k)
            elif row[place] < spans[k][1 + place]:
                spans[k] = (spans[k][0], *row)
                better.add(k)
        self.open.put(spans)
        if not self.final:
            yield from (self._row(spans[k][1:]) for k in sorted(better))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        spans, now = self._spans(), expiredTimerInfo.getExpiryTimeInMs()
        left = [s for s in spans if (s[0] + self.span) // 1000 > now]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        if self.final:
            yield from (self._row(s[1:]) for s in spans if (s[0] + self.span) // 1000 <= now)


def first_responses(
    answers: DataFrame,
    keys: Sequence[str] = ("market", "code"),
    watermark: str = "10 minutes",
    span: dt.timedelta = dt.timedelta(hours=12),
    seq: str = "seq",
    ts: str = "ts",
    final: bool = True,
) -> DataFrame:
    """The answer with the least ``seq`` of each key and span.

    With ``final`` each comes once, when the watermark has passed its span (append mode);
    without, whenever a better one arrives (update mode; the last one counts).  State ends
    with the span.  Rows without event time are left out.

    Needs the RocksDB state store, which is set here for queries of this session.
    """
    answers.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    # Times pass through Python as numbers, in no time zone.
    stamps = [f.name for f in answers.schema if isinstance(f.dataType, T.TimestampType)]
    timed = answers.where(F.col(ts).isNotNull()).withColumn("_event", F.col(ts)).withWatermark("_event", watermark)
    numbers = timed.withColumns({n: F.unix_micros(n) for n in stamps})
    schema = T.StructType([f for f in numbers.schema if f.name != "_event"])
    found = numbers.groupBy(*keys).transformWithState(
        statefulProcessor=FirstResponse(schema, seq, ts, span // dt.timedelta(microseconds=1), final),
        outputStructType=schema,
        outputMode="append" if final else "update",
        timeMode="eventTime",
    )
    return found.withColumns({n: F.timestamp_micros(n) for n in stamps})
