import datetime as dt
import os
import time

from pyspark.sql import functions as F

from marketloom.operators import capital_flow, minutes
from marketloom.sources.bar_table import BarTable
from marketloom.streaming import ticks as streams

TICKS = "market int, code string, ts timestamp, price double, vol double, side int"


def write_days(spark, folder, days):
    """One file per day, written one after the other: the file source reads them in
    order of modification time."""
    for i in range(days):
        rows = spark.range(200).select(
            F.lit(1).alias("market"),
            F.concat(F.lit("60000"), (F.col("id") % 3).cast("string")).alias("code"),
            (F.lit(f"2026-01-{5 + i:02d} 09:25:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 61).cast("decimal(18,6)"))).alias("ts"),
            (F.col("id") % 17 + 1).cast("double").alias("price"),
            (F.col("id") % 5 + 1).cast("double").alias("vol"),
            (F.col("id") % 4).cast("int").alias("side"),
        ).where("hour(ts) * 60 + minute(ts) <= 690")
        stage = f"{folder}-stage{i}"
        rows.coalesce(1).write.parquet(stage)
        os.makedirs(folder, exist_ok=True)
        part = next(f for f in os.listdir(stage) if f.endswith(".parquet"))
        os.rename(f"{stage}/{part}", f"{folder}/day{i}.parquet")
        os.utime(f"{folder}/day{i}.parquet", (time.time() + i, time.time() + i))


def stream(spark, folder):
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(query, tmp_path, name):
    out = {}

    def keep(batch, batch_id):
        out[batch_id] = batch.collect()

    query.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return [row for batch in sorted(out) for row in out[batch]]


def batch_minutes(spark, folder):
    ticks = spark.read.parquet(folder).withColumns(
        {"date": F.to_date("ts"), "seq": F.unix_micros("ts"), "sod": (F.hour("ts") * 60 + F.minute("ts")) * 60 + F.second("ts")}
    )
    rows = minutes.traded_minutes(ticks.withColumn("seq", F.col("seq") % 1_000_000)).collect()
    return {(r["code"], dt.datetime.combine(r["date"], dt.time()) + dt.timedelta(minutes=r["_minute"])): (r["open"], r["high"], r["low"], r["close"], r["volume"], r["amount"]) for r in rows}


def test_minutes_equal_the_batch(spark, tmp_path):
    folder = str(tmp_path / "ticks")
    write_days(spark, folder, 3)
    want = batch_minutes(spark, folder)
    value = lambda r: (r["open"], r["high"], r["low"], r["close"], r["volume"], r["amount"])
    updates = drain(streams.stream_minutes(stream(spark, folder)).writeStream.outputMode("update"), tmp_path, "u")
    assert {(r["code"], r["ts"]): value(r) for r in updates} == want
    closed = drain(streams.stream_minutes(stream(spark, folder)).writeStream.outputMode("append"), tmp_path, "a")
    got = {(r["code"], r["ts"]): value(r) for r in closed}
    # The newest minutes wait for the watermark; all others are out, once, and equal.
    assert len(got) == len(closed) and got.items() <= want.items()
    assert len(want) - len(got) <= 3 * 12


def test_running_flow_equals_the_batch(spark, tmp_path):
    folder = str(tmp_path / "ticks")
    write_days(spark, folder, 2)
    out = drain(streams.stream_flow(stream(spark, folder)).writeStream.outputMode("update"), tmp_path, "f")
    got = {(r["code"], r["day"]): (r["main_net"], r["total_turnover"], r["trade_count"], r["excluded_trade_count"]) for r in out}
    ticks = spark.read.parquet(folder).withColumn("date", F.to_date("ts"))
    rows = capital_flow.flow_summary(capital_flow.flow_sums(ticks)).collect()
    want = {(r["code"], r["date"]): (r["main_net"], r["total_turnover"], r["trade_count"], r["excluded_trade_count"]) for r in rows}
    assert got == want
    # Append mode closes days behind the watermark: state does not grow for ever.
    closed = drain(streams.stream_flow(stream(spark, folder), "1 hour").writeStream.outputMode("append"), tmp_path, "g")
    assert {(r["code"], r["day"]): r["total_turnover"] for r in closed} == {k: v[1] for k, v in want.items() if k[1].day == 5}


def test_first_snapshot_wins(spark, tmp_path):
    folder = str(tmp_path / "ticks")
    write_days(spark, folder, 2)
    rounds = stream(spark, folder).withColumns({"round": F.to_date("ts"), "seq": -F.unix_micros("ts")})
    out = drain(streams.first_snapshots(rounds, "1 day").writeStream.outputMode("update"), tmp_path, "s")
    # By seq, not by arrival: here the latest tick of a day has the smallest.
    rows = spark.read.parquet(folder).groupBy("code", F.to_date("ts").alias("d")).agg(F.max("ts").alias("ts")).collect()
    got = {(r["code"], r["round"]): r["ts"] for r in out}
    assert len(got) == 6 and got == {(r["code"], r["d"]): r["ts"] for r in rows}


def test_replayed_batches_change_nothing(spark, tmp_path):
    folder = str(tmp_path / "ticks")
    write_days(spark, folder, 2)
    store = BarTable(spark, str(tmp_path / "store"))

    def run(name):
        bars = streams.stream_minutes(stream(spark, folder)).withColumns(
            {"market": F.col("market").cast("string"), "frequency": F.lit("1m"), "ts": F.col("ts").cast("timestamp_ntz")}
        )
        query = streams.upsert_batches(bars, store).outputMode("update").option("checkpointLocation", str(tmp_path / name))
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, store.bars().select("code", "ts", "high", "volume").collect()))

    first = run("one")
    assert len(first) == len(batch_minutes(spark, folder)) and run("two") == first


def write_answers(spark, folder, *batches):
    """One file per batch of (code, stamp, seq, price), read in order."""
    os.makedirs(folder)
    for i, rows in enumerate(batches):
        stage = f"{folder}-stage{i}"
        frame = spark.createDataFrame([(c, dt.datetime.fromisoformat(t), s, p) for c, t, s, p in rows], ANSWERS)
        frame.coalesce(1).write.parquet(stage)
        part = next(f for f in os.listdir(stage) if f.endswith(".parquet"))
        os.rename(f"{stage}/{part}", f"{folder}/{i}.parquet")
        os.utime(f"{folder}/{i}.parquet", (time.time() + i, time.time() + i))


ANSWERS = "code string, ts timestamp, seq bigint, price double"


def test_responses_on_both_sides_of_midnight_are_one(spark, tmp_path):
    from marketloom.streaming.responses import first_responses

    folder = str(tmp_path / "answers")
    write_answers(
        spark, folder,
        [("a", "2031-03-01 23:58:00", 5, 1.0), ("b", "2031-03-01 10:00:00", 2, 7.0)],
        [("a", "2031-03-02 00:03:00", 3, 2.0), ("a", "2031-03-02 00:04:00", 9, 3.0)],
        [("b", "2031-03-02 11:00:00", 8, 8.0), ("c", "2031-03-02 11:30:00", 1, 9.0)],
        [("c", "2031-03-05 00:00:00", 4, 9.5)], [("d", "2031-03-09 00:00:00", 1, 0.0)], [("e", "2031-03-10 00:00:00", 1, 0.0)],
    )
    source = lambda: spark.readStream.schema(ANSWERS).option("maxFilesPerTrigger", 1).parquet(folder)
    value = lambda rows: sorted((r["code"], r["seq"], r["price"]) for r in rows)
    span = dt.timedelta(hours=6)
    once = drain(first_responses(source(), ["code"], span=span).writeStream.outputMode("append"), tmp_path, "once")
    # One row for the span over midnight, its least seq; a later span of a key is another.
    assert value(once) == [("a", 3, 2.0), ("b", 2, 7.0), ("b", 8, 8.0), ("c", 1, 9.0), ("c", 4, 9.5), ("d", 1, 0.0)]
    assert next(r["ts"] for r in once if r["seq"] == 3) == dt.datetime(2031, 3, 2, 0, 3)
    better = drain(first_responses(source(), ["code"], span=span, final=False).writeStream.outputMode("update"), tmp_path, "better")
    assert value(better) == [("a", 3, 2.0), ("a", 5, 1.0), ("b", 2, 7.0), ("b", 8, 8.0), ("c", 1, 9.0), ("c", 4, 9.5), ("d", 1, 0.0), ("e", 1, 0.0)]
