import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketloom.functions.trades import order_tier
from marketloom.operators import capital_flow as flow
from marketloom.plans import recipes

DAY = dt.date(2026, 9, 18)
TICKS = "market int, code string, date date, price double, vol double, side int"


def ticks(spark, rows, market=1, code="600000"):
    return spark.createDataFrame([(market, code, DAY, *r) for r in rows], TICKS)


def test_seven_levels(spark):
    frame = ticks(spark, [(10.0, 1500.0, 0), (10.0, 500.0, 1), (10.0, 100.0, 0), (10.0, 10.0, 1)])
    sums = flow.flow_sums(frame)
    levels = {r["level"]: r for r in flow.capital_flow(sums).collect()}
    net = {name: r["net_amount"] for name, r in levels.items()}
    assert net == {
        "超大单": 1_500_000.0,
        "大单": -500_000.0,
        "中单": 100_000.0,
        "小单": -10_000.0,
        "主力(超大+大单)": 1_000_000.0,
        "散户(中+小单)": 90_000.0,
        "合计": 1_090_000.0,
    }
    assert levels["超大单"]["net_pct"] == round(1_500_000 / 2_110_000 * 100, 2)
    assert levels["合计"]["buy_volume"] == 1600.0
    summary = flow.flow_summary(sums).first()
    assert (summary["main_net"], summary["retail_net"], summary["total_turnover"]) == (1e6, 9e4, 2.11e6)


def test_edges_stay_in_the_lower_tier(spark):
    frame = spark.createDataFrame([(40_000.0,), (200_000.0,), (1_000_000.0,), (1_000_000.01,)], "a double")
    right = [r[0] for r in frame.select(order_tier("a")).collect()]
    left = [r[0] for r in frame.select(order_tier("a", closed="left")).collect()]
    assert right == ["小单", "中单", "大单", "超大单"]
    assert left == ["中单", "大单", "超大单", "超大单"]
    # 10 x 1000 lots x 100 = 1,000,000 exactly.
    levels = flow.capital_flow(flow.flow_sums(ticks(spark, [(10.0, 1000.0, 0)])))
    amounts = {r["level"]: r["buy_amount"] for r in levels.collect()}
    assert amounts["大单"] == 1_000_000.0 and amounts["超大单"] == 0.0


def test_only_valid_executions_count(spark):
    frame = ticks(
        spark,
        [(4.582, v, s) for v, s in [(10.0, 0), (20.0, 1), (30.0, 2), (40.0, 5), (0.0, 8), (-1.0, 0)]],
        code="510300",
    )
    summary = flow.flow_summary(flow.flow_sums(frame)).first()
    assert summary["trade_count"] == 3 and summary["excluded_trade_count"] == 3
    assert summary["total_turnover"] == pytest.approx(4.582 * 60 * 100)
    assert summary["neutral_turnover"] == pytest.approx(4.582 * 30 * 100)
    assert flow.unknown_side_counts(frame).first()["unknown_side_counts"] == {5: 1, 8: 1}


def test_nan_and_infinite_ticks_are_excluded(spark):
    bad = [(float("nan"), 1.0, 0), (10.0, float("inf"), 0), (None, 1.0, 1), (10.0, 1.0, None)]
    summary = flow.flow_summary(flow.flow_sums(ticks(spark, [*bad, (10.0, 1.0, 0)]))).first()
    assert summary["trade_count"] == 1 and summary["excluded_trade_count"] == 4
    assert summary["total_turnover"] == 1000.0


def test_unconfirmed_unit_is_rejected(spark):
    bond = ticks(spark, [(100.0, 1.0, 0)], code="113052")
    assert flow.flow_summary(flow.flow_sums(bond)).first()["trade_count"] == 0
    with pytest.raises(PySparkException, match="not confirmed"):
        flow.flow_sums(bond, strict=True).collect()


def history(spark, n, hole=None, repeat=False):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    bars = [(1, "600000", d, 10.0 + i) for i, d in enumerate(days)]
    if repeat:
        bars.append(bars[-1])
    summary = spark.createDataFrame(
        [(1, "600000", d, 100.0, 10.0, 100.0, 0.0, 0.0, -100.0, -100.0, -10.0, 1000.0, 5)
         for i, d in enumerate(days) if i != hole],
        "market int, code string, date date, main_net double, main_net_pct double, super_net double, "
        "large_net double, medium_net double, small_net double, retail_net double, retail_net_pct double, "
        "total_turnover double, trade_count long",
    )
    return spark.createDataFrame(bars, "market int, code string, date date, close double"), summary


def test_windows_do_not_depend_on_the_days_returned(spark):
    bars, summary = history(spark, 60)
    short = flow.flow_history(bars, summary, 5).orderBy("date").collect()
    long = flow.flow_history(bars, summary, 20).orderBy("date").collect()
    assert len(short) == 5 and len(long) == 20
    assert long[-5:] == short
    for r in long:
        assert r["main_20d_net"] == 2000.0 and r["main_20d_pct"] == 10.0 and r["window_20d_days"] == 20
        assert r["main_5d_net"] == 500.0 and r["retail_20d_net"] == -2000.0 and r["total_20d_amount"] == 20000.0


def test_short_life_gives_null_not_a_partial_total(spark):
    bars, summary = history(spark, 6)
    out = flow.flow_history(bars, summary, 5).orderBy("date").collect()
    assert [r["window_20d_days"] for r in out] == [2, 3, 4, 5, 6]
    assert all(r["main_20d_net"] is None and r["main_20d_pct"] is None for r in out)
    assert out[-1]["main_5d_net"] == 500.0
    first = flow.flow_history(bars, summary, 6).orderBy("date").first()
    assert first["change_pct"] is None


def test_incomplete_history_is_marked_or_fails(spark):
    for arguments, status in (({"hole": 50}, "missing_trades"), ({"repeat": True}, "duplicate_dates")):
        bars, summary = history(spark, 60, **arguments)
        out = flow.flow_history(bars, summary, 20)
        assert {r["status"] for r in out.collect()} == {status}
        assert all(r["main_5d_net"] is None for r in out.collect())
        with pytest.raises(PySparkException, match=status):
            flow.flow_history(bars, summary, 20, strict=True).collect()
    # A hole before the warm-up is never used.
    bars, summary = history(spark, 60, hole=2)
    assert {r["status"] for r in flow.flow_history(bars, summary, 20).collect()} == {"ok"}


def test_sector_needs_every_member(spark):
    summary = spark.createDataFrame(
        [(1, "a", 5.0, 1.0, 2.0, 3.0, 10.0, 1), (1, "b", -2.0, 1.0, 0.0, -2.0, 30.0, 1)],
        "market int, code string, main_net double, retail_net double, super_net double, large_net double, "
        "total_turnover double, trade_count long",
    )
    members = spark.createDataFrame(
        [("s", 1, "a", 1, "SH.a"), ("s", 1, "b", 2, "b"), ("s", 1, "a", 3, "a"), ("t", 1, "a", 4, "a"), ("t", 1, "c", 5, "c")],
        "sector string, market int, code string, seq int, symbol string",
    )
    out = {r["sector"]: r for r in flow.sector_flow(members, summary).collect()}
    assert out["s"]["stock_count"] == 2 and out["s"]["main_net"] == 3.0 and out["s"]["main_net_pct"] == 7.5
    assert (out["s"]["top_inflow_code"], out["s"]["top_outflow_code"]) == ("SH.a", "b")
    assert out["t"]["status"] == "missing_trades" and out["t"]["main_net"] is None
    with pytest.raises(PySparkException, match="without trades"):
        flow.sector_flow(members, summary, strict=True).collect()


def test_sector_name_prefers_equality(spark):
    industries = spark.createDataFrame(
        [("1", "白酒", None), ("2", "白酒II", None), ("3", None, "银行")], "code string, tdx_industry_name string, sw_industry_name string"
    )
    assert [r["code"] for r in flow.sector_members(industries, "白酒").collect()] == ["1"]
    assert sorted(r["code"] for r in flow.sector_members(industries, "白").collect()) == ["1", "2"]
    with pytest.raises(Exception, match="no sector"):
        flow.sector_members(industries, "nothing").collect()


def test_tier_sums_add_up(spark):
    frame = spark.range(2000).select(
        F.lit(1).alias("market"),
        F.concat(F.lit("60000"), (F.col("id") % 7).cast("string")).alias("code"),
        F.lit(DAY).alias("date"),
        ((F.col("id") % 97) / 4 + 1).alias("price"),
        (F.col("id") % 311 + 1).cast("double").alias("vol"),
        (F.col("id") % 3).cast("int").alias("side"),
    )
    sums = flow.flow_sums(frame)
    for r in sums.collect():
        tiers = sum(r[f"{t}_{s}_units"] for t in ("super", "large", "medium", "small") for s in ("buy", "sell"))
        assert tiers == r["total_units"] - r["neutral_units"]


def kept_days(spark, count=30):
    import datetime as dt

    day = lambda k: dt.date(2031, 1, 1) + dt.timedelta(days=k)
    ticks = [(0, c, day(k), 10.0 + k, 100 * (i + 1) * (k + 1), i % 3) for c in ("000001", "000002") for k in range(count) for i in range(4)]
    bars = [(0, c, day(k), 10.0 + k) for c in ("000001", "000002") for k in range(count)]
    return (
        spark.createDataFrame(bars, "market tinyint, code string, date date, close double"),
        spark.createDataFrame(ticks, "market tinyint, code string, date date, price double, vol bigint, side int"),
        day,
    )


def test_history_reads_kept_days_and_ticks_of_open_ones(spark, tmp_path, rows):
    from marketloom.operators.capital_flow import flow_summary, flow_sums
    from marketloom.plans.recipes import flow_history
    from marketloom.sources.flow_table import FlowTable
    from pyspark.sql import functions as F

    bars, ticks, day = kept_days(spark)
    table = FlowTable(spark, str(tmp_path))
    assert table.closed_until() is None
    table.close_days(flow_summary(flow_sums(ticks)), until=day(24))
    assert table.closed_until() == day(24)
    # Only the ticks after the closed days are at hand.
    for days in (5, None):
        want = rows(flow_history(bars, ticks, days))
        assert rows(flow_history(bars, ticks.where(F.col("date") > F.lit(day(24))), days, kept=table)) == want
    # A corrected day replaces the first; a write that dies before its mark does not count.
    changed = flow_summary(flow_sums(ticks.withColumn("vol", F.when(F.col("date") == F.lit(day(20)), F.col("vol") * 2).otherwise(F.col("vol")))))
    table.close_days(changed.where(F.col("date") == F.lit(day(20))))
    assert rows(table.rows()) == rows(changed.where(F.col("date") <= F.lit(day(24))).select(*table.rows().columns))
    lost = changed.withColumns({"total_turnover": F.lit(0.0), "batch": F.lit("lost"), "period": F.lit("2031-01")})
    lost.write.mode("append").partitionBy("period").parquet(str(tmp_path / "flow"))
    assert table.rows().where("total_turnover = 0").count() == 0 and table.rows().count() == 50


def test_a_stream_closes_days(spark, tmp_path, rows):
    """Days behind the watermark are kept by the running stream, replays included."""
    from marketloom.operators.capital_flow import flow_summary, flow_sums
    from marketloom.sources.flow_table import FlowTable, keep_closed_days
    from marketloom.streaming.ticks import stream_flow
    from pyspark.sql import functions as F

    _, ticks, day = kept_days(spark, 6)
    stamped = ticks.withColumn("ts", F.col("date").cast("timestamp"))
    for k in range(6):
        stamped.where(F.col("date") == F.lit(day(k))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = FlowTable(spark, str(tmp_path / "kept"))
    for name in ("first", "replayed"):
        stream = spark.readStream.schema(stamped.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        writer = keep_closed_days(stream_flow(stream.drop("date"), "1 hour"), table).outputMode("append")
        writer.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
    last = table.closed_until()
    assert last >= day(3)
    want = flow_summary(flow_sums(ticks.where(F.col("date") <= F.lit(last))))
    assert rows(table.rows()) == rows(want.select(*table.rows().columns))


def test_history_of_all_days_neither_ranks_nor_stores_them(spark, tmp_path, monkeypatch):
    """The same rows as a history of more days than there are, without their folder."""
    monkeypatch.setattr(recipes, "shared_scratch", lambda _: str(tmp_path))
    days = spark.range(30).selectExpr("explode(array('000001', '000002')) as code", "date_add(date'2024-01-01', cast(id as int)) as date", "id")
    bars = days.selectExpr("0 as market", "code", "date", "10.0 + id as close")
    ticks = days.selectExpr("0 as market", "code", "date", "id as seq", "10.0 + id as price", "100.0D as vol", "cast(id % 3 as int) as side")
    whole = recipes.flow_history(bars, ticks, None)
    assert list(tmp_path.glob("days-*")) == []
    assert "_age" not in whole._jdf.queryExecution().optimizedPlan().toString()
    many = recipes.flow_history(bars, ticks, 1000)
    assert len(list(tmp_path.glob("days-*"))) == 1
    assert whole.columns == many.columns
    rows = sorted(map(tuple, whole.collect()))
    assert len(rows) == 60 and rows == sorted(map(tuple, many.collect()))
