import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.plans.sync import rows_in_few_ranges, rows_in_ranges, sync
from marketloom.sources.bar_table import BarTable

BARS = "market string, code string, frequency string, ts timestamp_ntz, close double, volume double"
RANGE = "market string, code string, frequency string, adjustment string, start timestamp_ntz, end timestamp_ntz"


def at(text):
    return dt.datetime.fromisoformat(text)


def bars(spark, *rows, frequency="day"):
    return spark.createDataFrame([("sh", code, frequency, at(ts), price, 1.0) for code, ts, price in rows], BARS)


def request(spark, start, end, code="a"):
    return spark.createDataFrame([("sh", code, "day", "none", at(start), at(end))], RANGE)


def prices(frame):
    return [(r["code"], str(r["ts"])[:10], r["close"]) for r in frame.orderBy("code", "ts").collect()]


def test_upsert_updates_and_keeps_the_rest(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    assert store.bars().count() == 0 and store.coverage().count() == 0
    store.upsert(bars(spark, ("a", "2026-01-01", 1.0), ("a", "2026-02-01", 2.0), ("b", "2026-01-01", 3.0), ("a", "2025-06-01", 9.0)))
    store.upsert(bars(spark, ("a", "2026-02-01", 20.0), ("a", "2026-02-02", float("nan"))))
    assert prices(store.bars()) == [
        ("a", "2025-06-01", 9.0), ("a", "2026-01-01", 1.0), ("a", "2026-02-01", 20.0), ("a", "2026-02-02", None), ("b", "2026-01-01", 3.0),
    ]
    both_ends = store.read_bars({"market": "sh", "code": "a"}, "2026-01-01", "2026-02-01")
    assert prices(both_ends) == [("a", "2026-01-01", 1.0), ("a", "2026-02-01", 20.0)]
    row = store.bars().first()
    assert (row["adjustment"], row["volume_unit"], row["timezone"], row["is_approximate"]) == ("none", "shares", "Asia/Shanghai", False)


def test_tail_replacement(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    store.upsert(bars(spark, ("a", "2025-12-31", 0.5), ("a", "2026-01-01", 1.0), ("a", "2026-02-01", 2.0), ("a", "2027-03-01", 4.0), ("b", "2026-03-01", 3.0)))
    store.upsert(bars(spark, ("a", "2026-01-15", 7.0)), replace_from="2026-01-10")
    want = [("a", "2025-12-31", 0.5), ("a", "2026-01-01", 1.0), ("a", "2026-01-15", 7.0), ("b", "2026-03-01", 3.0)]
    assert prices(store.bars()) == want
    with pytest.raises(ValueError, match="repeated"):
        store.upsert(bars(spark, ("a", "2026-01-20", 1.0), ("a", "2026-01-20", 2.0)), replace_from="2026-01-01")
    assert prices(store.bars()) == want
    store.upsert(bars(spark, ("a", "2026-01-20", 1.0)).limit(0), replace_from="2025-01-01")
    assert prices(store.bars()) == want


def test_failed_write_leaves_the_table(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    store.upsert(bars(spark, ("a", "2026-01-01", 1.0)))
    broken = bars(spark, ("a", "2026-01-01", 5.0)).withColumn("close", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        store.upsert(broken)
    assert prices(BarTable(spark, str(tmp_path)).bars()) == [("a", "2026-01-01", 1.0)]


def test_minute_bars_are_kept_by_month(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    store.upsert(bars(spark, ("a", "2026-01-01 09:31", 1.0), ("a", "2026-02-01 09:31", 2.0), frequency="1m"))
    assert {p.name for p in tmp_path.glob("bars/write=*/market=sh/frequency=1m/adjustment=none/*")} == {"period=2026-01", "period=2026-02"}


def test_sync_fetches_gaps_and_tail_only(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    feed = bars(spark, *[("a", f"2026-01-{d:02d}", float(d)) for d in range(1, 21)])
    assert len(prices(sync(store, feed, request(spark, "2026-01-05", "2026-01-10")))) == 5
    assert [(str(r["start"])[:10], str(r["end"])[:10]) for r in store.coverage().collect()] == [("2026-01-05", "2026-01-10")]
    # The feed changes: stored days stay, except the last bar; new days come in.
    changed = feed.withColumn("close", F.col("close") + 100)
    out = prices(sync(store, changed, request(spark, "2026-01-03", "2026-01-12")))
    assert [p for _, _, p in out] == [103.0, 104.0, 5.0, 6.0, 7.0, 8.0, 109.0, 110.0, 111.0]
    # An overlap refreshes more; an empty answer erases nothing.
    out = prices(sync(store, changed, request(spark, "2026-01-03", "2026-01-12"), overlap="3 days"))
    assert [p for _, _, p in out] == [103.0, 104.0, 5.0, 6.0, 7.0, 108.0, 109.0, 110.0, 111.0]
    again = prices(sync(store, feed.limit(0), request(spark, "2026-01-01", "2026-01-20")))
    assert len(again) == 9
    with pytest.raises(ValueError):
        sync(store, feed, request(spark, "2026-01-01", "2026-01-02").withColumn("adjustment", F.lit("qfq")))


def test_sync_marks_fallback_rows(spark, tmp_path):
    store = BarTable(spark, str(tmp_path))
    feed = bars(spark, ("a", "2026-01-01", 1.0), ("a", "2026-01-03", 3.0)).withColumns({"source": F.lit("feed"), "is_approximate": F.lit(False)})
    spare = bars(spark, ("a", "2026-01-02", 2.0), ("a", "2026-01-03", 30.0))
    out = sync(store, feed, request(spark, "2026-01-01", "2026-01-05"), fallback=spare).collect()
    assert [(r["close"], r["source"], r["is_approximate"]) for r in out] == [(1.0, "feed", False), (2.0, "trade", True), (3.0, "feed", False)]


def test_sync_moves_bars_once_per_step(spark, tmp_path, monkeypatch):
    """A fallback is not joined with the feed, marks come from one pass over what was written,
    and reading in order shuffles the bars once."""
    store = BarTable(spark, str(tmp_path))
    feed = bars(spark, *[("a", f"2026-01-0{d}", float(d)) for d in (1, 3, 3, 5)]).withColumns({"source": F.lit("feed"), "is_approximate": F.lit(False)})
    spare = bars(spark, *[("a", f"2026-01-0{d}", 10.0 * d) for d in range(1, 8)], ("b", "2026-01-02", 0.0))
    plans = {}

    def noted(name):
        whole = getattr(BarTable, name)

        def call(self, rows, write):
            plans.setdefault(name, []).append(rows._jdf.queryExecution().optimizedPlan().toString())
            return whole(self, rows, write)

        monkeypatch.setattr(BarTable, name, call)

    noted("_write_rows")
    noted("_write_marks")
    sync(store, feed, request(spark, "2026-01-01", "2026-01-04"))
    out = sync(store, feed, request(spark, "2026-01-01", "2026-01-07"), fallback=spare)
    assert [(p, a) for p, a in ((r["close"], r["is_approximate"]) for r in out.collect())] == [
        (1.0, False), (3.0, False), (40.0, True), (5.0, False), (60.0, True),
    ]
    assert all("LeftAnti" not in p for p in plans["_write_rows"])
    assert [p.count("Relation [") for p in plans["_write_marks"]] == [1, 1]
    order = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert order.count("Exchange rangepartitioning") == 1
    # What was noted down is what the rows say.
    assert [(r["code"], str(r["last"])[:10]) for r in store.last_stamps().collect()] == [("a", "2026-01-06")]
    assert [(str(r["start"])[:10], str(r["end"])[:10]) for r in store.coverage().collect()] == [("2026-01-01", "2026-01-07")]


def test_few_and_many_ranges_find_the_same_rows(spark, rows):
    feed = bars(spark, *[(c, f"2026-0{m}-{d:02d}", 1.0) for c in "abc" for m in (1, 2, 3) for d in range(1, 28)]).withColumn("adjustment", F.lit("none"))
    wanted = [("a", f"2026-01-{d:02d}", f"2026-01-{d + 1:02d}") for d in range(2, 24, 4)] + [("a", "2026-02-20", "2026-03-05"), ("b", "2025-01-01", "2026-01-03"), ("d", "2026-01-01", "2026-02-01")]
    ranges = spark.createDataFrame([("sh", c, "day", "none", at(lo), at(hi)) for c, lo, hi in wanted], RANGE)
    few = rows_in_few_ranges(feed, ranges)
    assert rows(few) == rows(rows_in_ranges(feed, ranges, "month")) and few.count() == 6 + 8 + 4 + 2


@pytest.mark.parametrize("step", ["_write_rows", "_write_marks", "_commit"])
def test_interrupted_upsert_shows_the_old_state(spark, tmp_path, monkeypatch, step):
    """A job that dies before or after any of its writes but the commit changes nothing:
    neither rows nor the cut tail nor coverage; the same write again then takes effect."""
    store = BarTable(spark, str(tmp_path))
    cover = request(spark, "2026-01-01", "2026-01-04").withColumns({"source": F.lit(""), "is_approximate": F.lit(False)})
    store.upsert(bars(spark, ("a", "2026-01-01", 1.0), ("a", "2026-01-05", 5.0)), coverage=cover)
    state = lambda: (prices(store.bars()), sorted(map(tuple, store.coverage().collect())), sorted(map(tuple, store.last_stamps().collect())))
    old = state()
    change = bars(spark, ("a", "2026-01-02", 2.0), ("a", "2026-01-03", 3.0))
    more = cover.withColumn("end", F.lit("2026-02-01").cast("timestamp_ntz"))
    whole = getattr(BarTable, step)
    for before in (True, False):
        if step == "_commit" and not before:
            continue

        def dies(self, *args, before=before, **kwargs):
            if not before:
                whole(self, *args, **kwargs)
            raise RuntimeError("lost")

        monkeypatch.setattr(BarTable, step, dies)
        with pytest.raises(RuntimeError, match="lost"):
            store.upsert(change, replace_from="2026-01-02", coverage=more)
        assert state() == old
    monkeypatch.setattr(BarTable, step, whole)
    store.upsert(change, replace_from="2026-01-02", coverage=more)
    now = state()
    assert now[0] == [("a", "2026-01-01", 1.0), ("a", "2026-01-02", 2.0), ("a", "2026-01-03", 3.0)]
    assert [str(r[4])[:10] + str(r[5])[:10] for r in now[1]] == ["2026-01-012026-02-01"] and str(now[2][0][-1])[:10] == "2026-01-03"


def test_writers_beside_each_other_lose_nothing(spark, tmp_path, monkeypatch):
    """A second writer commits while the first is between its rows and its commit."""
    one, two = BarTable(spark, str(tmp_path)), BarTable(spark, str(tmp_path))
    cover = lambda a, b: request(spark, a, b).withColumns({"source": F.lit(""), "is_approximate": F.lit(False)})
    whole = BarTable._write_marks

    def meanwhile(self, *args):
        monkeypatch.setattr(BarTable, "_write_marks", whole)
        two.upsert(bars(spark, ("a", "2026-02-01", 2.0), ("a", "2026-01-01", 20.0)), coverage=cover("2026-02-01", "2026-03-01"))
        whole(self, *args)

    monkeypatch.setattr(BarTable, "_write_marks", meanwhile)
    one.upsert(bars(spark, ("a", "2026-01-01", 1.0)), coverage=cover("2026-01-01", "2026-01-15"))
    assert prices(one.bars()) == [("a", "2026-01-01", 1.0), ("a", "2026-02-01", 2.0)]  # the later commit counts
    assert sorted(str(r["start"])[:10] for r in one.coverage().collect()) == ["2026-01-01", "2026-02-01"]


def test_compaction_keeps_what_is_written_meanwhile(spark, tmp_path, monkeypatch):
    store = BarTable(spark, str(tmp_path))
    store.upsert(bars(spark, ("a", "2026-01-01", 1.0), ("a", "2026-01-02", 2.0), ("b", "2026-01-09", 9.0)))
    store.upsert(bars(spark, ("a", "2026-01-02", 3.0)), replace_from="2026-01-02")
    whole = BarTable._write_rows

    def meanwhile(self, *args):
        whole(self, *args)
        monkeypatch.setattr(BarTable, "_write_rows", whole)
        store.upsert(bars(spark, ("a", "2026-01-03", 4.0), ("a", "2026-01-01", 10.0)))

    monkeypatch.setattr(BarTable, "_write_rows", meanwhile)
    store.compact()
    want = [("a", "2026-01-01", 10.0), ("a", "2026-01-02", 3.0), ("a", "2026-01-03", 4.0), ("b", "2026-01-09", 9.0)]
    assert prices(store.bars()) == want and len(store.snapshot().live) == 2
    assert store.vacuum() == 2 and prices(store.bars()) == want
    store.compact()
    assert prices(store.bars()) == want and len(store.snapshot().live) == 1
    assert {r["code"]: str(r["last"])[:10] for r in store.last_stamps().collect()} == {"a": "2026-01-03", "b": "2026-01-09"}


def test_a_write_reads_no_stored_bars(spark, tmp_path):
    """Stored rows that cannot be read at all do not matter to a write."""
    store = BarTable(spark, str(tmp_path))
    store.upsert(bars(spark, ("a", "2026-01-01", 1.0)))
    for part in tmp_path.glob("bars/write=*/**/*.parquet"):
        part.write_bytes(b"not parquet")
        part.with_name(f".{part.name}.crc").unlink()
    store.upsert(bars(spark, ("a", "2026-02-01", 2.0)), replace_from="2026-01-15")
    assert len(store.snapshot().live) == 2


def test_merge_needs_a_catalog_that_has_it(spark, tmp_path):
    from marketloom.schemas import STORED_BARS
    from marketloom.sources.bar_table import merge_into

    spark.createDataFrame([], STORED_BARS).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("plain_bars")
    for cut in (None, "2026-01-01"):
        with pytest.raises(Exception, match="(?i)merge|row-level"):
            merge_into(bars(spark, ("a", "2026-01-01", 1.0)), "plain_bars", replace_from=cut)
    spark.sql("drop table plain_bars")


def test_reading_in_order_shuffles_once(spark, tmp_path):
    """Versions of a key meet in ranges of the key, which are the order of the result."""
    table = BarTable(spark, str(tmp_path / "bars"))
    days = spark.range(40).selectExpr(
        "'0' as market", "array('000002', '000001')[id % 2] as code", "'day' as frequency", "'none' as adjustment",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int)) as ts", "double(id) as close", "id",
    )
    table.upsert(days.drop("id"))
    table.upsert(days.where("id % 4 = 1").selectExpr("* except (close, id)", "-close as close"))
    found = table.read_bars({"market": "0"}, "2024-01-03", "2024-02-05")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1
    # The one by hash gathers what later commits cut off.
    assert plan.count("Exchange hashpartitioning") == 1
    read = [(r.code, r.ts.isoformat(), r.close) for r in found.collect()]
    want = [
        (r.code, r.ts.isoformat(), -r.close if r.id % 4 == 1 else r.close)
        for r in days.where("id between 2 and 35").orderBy("code", "ts").collect()
    ]
    assert read == want
