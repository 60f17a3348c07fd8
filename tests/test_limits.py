"""Values beyond the usual: nothing is cut, wrapped or dropped silently."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions.times import in_session
from marketloom.operators import capital_flow, selection
from marketloom.plans import tables
from marketloom.sources import finance_files
from marketloom.sources.bar_table import BarTable
from marketloom.streaming import ticks as streams


def test_a_page_has_the_rows_asked_for(spark):
    bars = spark.range(1000).select(F.lit(1).alias("market"), F.lit("a").alias("code"), F.timestamp_seconds("id").alias("ts"))
    assert selection.newest_page(bars, 50, 900).count() == 900


def test_wide_records_are_not_cut(spark):
    records = spark.createDataFrame([("a", 20310101, [1.0, 2.0, 3.0])], "code string, report_date long, values array<float>")
    with pytest.raises(Exception, match="width 2"):
        finance_files.widen(records, 2).collect()
    assert finance_files.widen(records, 3).first()["col3"] == 3.0
    assert finance_files.too_wide(records, 2).count() == 1
    with pytest.raises(ValueError):
        finance_files.widen(records, 1, ["d", "x", "y"])


def test_an_absurd_tick_is_excluded(spark):
    rows = [(1, "600000", dt.date(2031, 5, 1), 2.0, 5.0, 0), (1, "600000", dt.date(2031, 5, 1), 1e300, 9.0, 0)]
    ticks = spark.createDataFrame(rows, "market int, code string, date date, price double, vol double, side int")
    row = capital_flow.flow_summary(capital_flow.flow_sums(ticks)).first()
    assert (row["trade_count"], row["excluded_trade_count"], row["total_turnover"]) == (1, 1, 1000.0)


def test_line_order_holds_for_large_keys(spark):
    rows = [(70_000_000_000, 7, 999_999.99), (70_000_000_001, 1, 0.01), (70_000_000_000, 6, 167_772.17), (70_000_000_000, 7, 0.01)]
    frame = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_extendedprice double")
    out = [tuple(r)[:3] for r in frame.withColumn("seq", tables._line_order()).orderBy("seq").collect()]
    assert out == sorted(rows)


def test_session_edges_count_microseconds(spark):
    stamps = ["09:30:00", "09:30:00.000001", "09:30:00.5", "11:29:59.999999", "11:30:00", "12:00:00", "13:00:00.1", "15:00:00.000001"]
    frame = spark.createDataFrame([(dt.datetime.fromisoformat(f"2031-05-01 {s}"),) for s in stamps], "ts timestamp_ntz")
    assert [r[0] for r in frame.select(in_session("ts")).collect()] == [False, True, True, True, False, False, True, False]


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "America/New_York"])
def test_stream_days_are_local(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        clocks = ["2031-01-06 01:30:00", "2031-01-06 23:10:00", "2031-01-07 00:05:00", "2031-07-07 12:00:00"]
        frame = spark.createDataFrame([(c,) for c in clocks], "at string").select(
            F.lit(1).alias("market"), F.lit("600000").alias("code"), F.to_timestamp("at").alias("ts"),
            F.lit(2.0).alias("price"), F.lit(1.0).alias("vol"), F.lit(0).alias("side"),
        )
        frame.write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        found = []
        (
            streams.stream_flow(stream).writeStream.outputMode("update")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
            .foreachBatch(lambda batch, _: found.extend(batch.select(F.col("day").cast("string"), "trade_count").collect()))
            .start().awaitTermination()
        )
        assert sorted(map(tuple, found)) == [("2031-01-06", 2), ("2031-01-07", 1), ("2031-07-07", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_compaction_keeps_what_is_read(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    kind = "market string, code string, frequency string, ts timestamp_ntz, close double"
    at = lambda d: dt.datetime(2031, 5, d)
    store.upsert(spark.createDataFrame([("sh", c, "day", at(d), 1.0 * d) for c in "ab" for d in range(1, 9)], kind))
    store.upsert(spark.createDataFrame([("sh", "a", "day", at(3), 30.0)], kind))
    store.upsert(spark.createDataFrame([("sh", "b", "day", at(5), 50.0)], kind), replace_from="2031-05-04")
    read = lambda: sorted((r["code"], r["ts"].day, r["close"]) for r in store.bars().collect())
    first = read()
    assert ("a", 3, 30.0) in first and [d for c, d, _ in first if c == "b"] == [1, 2, 3, 5]
    last = {r["code"]: r["last"].day for r in store.last_stamps().collect()}
    assert last == {"a": 8, "b": 5}
    store.compact()
    assert read() == first and store.snapshot().versions().count() == len(first)
