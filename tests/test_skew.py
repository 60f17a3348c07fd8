"""Two-level scans and as-of lookups against brute force, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators.asof import asof_lookup, time_bucket
from marketloom.operators.intervals import merge_ranges
from marketloom.operators.adjust import legacy_factor_adjust, ratio_chain_adjust
from marketloom.operators.scan import (
    add_following,
    add_ordinal,
    add_previous,
    add_running_max_before,
    add_running_product,
    fill_forward,
    rows_between,
)
from marketloom.operators.selection import directory_page, newest_page


def day(n):
    return F.date_add(F.lit("2020-01-01").cast("date"), n)


@pytest.fixture(scope="module")
def series():
    rng = random.Random(3)
    hot = [("hot", n) for n in sorted(rng.sample(range(2000), 400))]
    return hot + [(f"k{i}", n) for i in range(10) for n in sorted(rng.sample(range(2000), 15))]


def frame(spark, rows, *names):
    schema = "k string, n int" + "".join(f", {n} int" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("t", day(F.col("n")))


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("bucket", ["month", "day"])
def test_asof(spark, series, direction, strict, bucket):
    rng = random.Random(4)
    events = [(k, n, n * 7 if n % 5 else None) for k in ("hot", "k1", "k2", "other") for n in sorted(rng.sample(range(300, 1500), 40))]
    left, right = frame(spark, series), frame(spark, events, "v").withColumnRenamed("n", "m")
    out = asof_lookup(left, right, ["k"], "t", "t", ["v", "m"], direction=direction, strict=strict, bucket=bucket)

    def expected(k, n):
        fits = [e for e in events if e[0] == k and (e[1] < n if direction == "backward" else e[1] > n or False)]
        fits += [e for e in events if e[0] == k and e[1] == n and not strict]
        best = (max if direction == "backward" else min)(fits, key=lambda e: e[1], default=None)
        return (best[2], best[1]) if best else (None, None)

    rows = out.collect()
    assert len(rows) == len(series)
    assert all((r["v"], r["m"]) == expected(r["k"], r["n"]) for r in rows)


def test_scans(spark, series):
    rows = [(k, n, (n * 37) % 101) for k, n in series]
    source = frame(spark, rows, "v")
    chunk = time_bucket(F.col("t"), "month")
    want, position, top, previous = {}, {}, {}, {}
    for k, n, v in rows:
        want[k, n] = (position.get(k, 0), top.get(k), previous.get(k))
        position[k] = position.get(k, 0) + 1
        top[k] = max(v, top.get(k, v))
        previous[k] = v
    out = add_ordinal(source, ["k"], ["t"], chunk, "at")
    out = add_running_max_before(out, ["k"], ["t"], "v", chunk, "top")
    out = add_previous(out, ["k"], "t", "v", chunk, "before")
    assert {(r["k"], r["n"]): (r["at"], r["top"], r["before"]) for r in out.collect()} == want


def test_ranges(spark, series):
    rng = random.Random(5)
    spans = [(k, n, n + rng.choice([1, 3, 40, 200])) for k, n in series]
    source = frame(spark, spans, "e").select("k", F.col("t").cast("timestamp_ntz").alias("start"), day(F.col("e")).cast("timestamp_ntz").alias("end"))
    want = []
    for key in {s[0] for s in spans}:
        merged = []
        for _, s, e in sorted(x for x in spans if x[0] == key):
            if merged and s <= merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], e)
            else:
                merged.append([key, s, e])
        want += map(tuple, merged)
    base = F.lit("2020-01-01").cast("date")
    out = merge_ranges(source, ["k"]).select("k", F.datediff(F.col("start").cast("date"), base), F.datediff(F.col("end").cast("date"), base))
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_products_neighbours_and_fills(spark, series):
    rows = [(k, n, float(n * 37 % 11 + 1) if n % 3 else None) for k, n in series]
    source = spark.createDataFrame(rows, "k string, n int, v double").withColumn("t", day(F.col("n")))
    chunk = time_bucket(F.col("t"), "month")
    out = add_running_product(source, ["k"], ["t"], "v", chunk, "forward")
    out = add_running_product(out, ["k"], ["t"], "v", chunk, "backward", reverse=True)
    out = add_following(out, ["k"], "t", "v", chunk, "after")
    out = fill_forward(out.withColumn("known", F.col("v")), ["k"], "t", ["known"], chunk)
    got = {(r["k"], r["n"]): (r["forward"], r["backward"], r["after"], r["known"]) for r in out.collect()}
    for key in {k for k, _, _ in rows}:
        own = sorted((n, v) for k, n, v in rows if k == key)
        for at, (n, _) in enumerate(own):
            up, down, last = 1.0, 1.0, None
            for _, v in own[: at + 1]:
                up, last = (up * v, v) if v is not None else (up, last)
            for _, v in own[at:]:
                down = down * v if v is not None else down
            forward, backward, after, known = got[key, n]
            assert forward == pytest.approx(up, rel=1e-9) and backward == pytest.approx(down, rel=1e-9)
            assert after == (own[at + 1][1] if at + 1 < len(own) else None) and known == last


def limits(plan):
    return [x for x in ("GlobalLimit", "CollectLimit", "TakeOrdered") if x in plan]


def test_deep_pages(spark):
    """A page 5,000 minutes deep, and a deep page of a directory, without a whole series or
    the whole directory in one task."""
    count = 9_000
    stamp = F.timestamp_seconds(F.lit(1_900_000_000) + F.col("id") * 900).cast("timestamp_ntz")
    one = spark.range(count).select(F.lit(1).alias("market"), F.lit("hot").alias("code"), stamp.alias("ts"), F.col("id").alias("v"))
    bars = one.unionByName(one.where("v < 5010").withColumn("code", F.lit("few")))
    page = newest_page(bars, 5_000, 20)
    got = sorted((r["code"], r["v"]) for r in page.collect())
    assert got == sorted([("hot", v) for v in range(count - 5_020, count - 5_000)] + [("few", v) for v in range(10)])
    assert newest_page(bars, 20_000, 10).count() == 0
    directory = spark.range(20_000).select((F.col("id") % 3).cast("int").alias("market"), F.lpad((F.col("id") * 7919 % 1_000_000).cast("string"), 6, "0").alias("code"))
    whole = sorted(map(tuple, directory.collect()))
    for start, size in ((0, 1000), (14_321, 777), (19_990, 1000), (30_000, 10)):
        page = directory_page(directory, start, size)
        assert list(map(tuple, page.collect())) == whole[start : start + size]
    assert limits(page._jdf.queryExecution().executedPlan().toString()) == []


def test_pages_of_null_keys(spark):
    rows = [(None, k) for k in range(50)] + [("a", k) for k in range(30)]
    frame = spark.createDataFrame(rows, "k string, v int")
    out = rows_between(frame, ["k"], [F.col("v")], F.floor(F.col("v") / 7), 10, 20)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(None, k) for k in range(10, 20)] + [("a", k) for k in range(10, 20)], key=repr)


def minute_series(spark):
    rng = random.Random(8)
    rows = []
    for code, days in (("hot", 75), ("b", 3)):
        price = 10.0
        for d in range(days):
            for m in range(6):
                price *= 1 + rng.uniform(-0.01, 0.01)
                rows.append((1, code, d * 1440 + 570 + m * 40, price))
    stamp = (F.lit("2031-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("minute"))).alias("ts")
    frame = spark.createDataFrame(rows, "market int, code string, minute int, close double")
    return frame.select("market", "code", stamp, F.col("close").alias("open"), "close"), rows


@pytest.mark.parametrize("method", ["qfq", "hfq"])
def test_ratio_chain_of_minutes_over_chunks(spark, method):
    """Chunks of a day give what one window over the whole series gives."""
    bars, rows = minute_series(spark)
    events = [(1, "hot", d, k, 1, 0.5, 0.0, 0.0, 1.0) for k, d in enumerate(("2031-01-20", "2031-02-01", "2031-03-03"))]
    names = "market int, code string, date string, seq bigint, category int, fenhong double, peigu double, peigujia double, songzhuangu double"
    actions = spark.createDataFrame(events, names)
    by_day = ratio_chain_adjust(bars, actions, method, time="ts", chunk="day").orderBy("code", "ts").collect()
    # One chunk a series: the window form.
    whole = ratio_chain_adjust(bars, actions, method, time="ts", chunk="century").orderBy("code", "ts").collect()
    assert len(by_day) == len(whole) == len(rows)
    for a, b in zip(by_day, whole, strict=True):
        assert (a["code"], a["ts"]) == (b["code"], b["ts"])
        assert a["adj"] == pytest.approx(b["adj"], rel=1e-9) and a["close"] == pytest.approx(b["close"], rel=1e-9)
        assert a["preclose"] == (None if b["preclose"] is None else pytest.approx(b["preclose"], rel=1e-9))


@pytest.mark.parametrize("method", ["qfq", "hfq"])
def test_legacy_factors_of_minutes_over_chunks(spark, method):
    bars, rows = minute_series(spark)
    factors = bars.where("minute(ts) % 7 = 3").withColumn("factor", 1 + F.hour("ts") / 10).select("market", "code", "ts", "factor")
    read = lambda chunk: sorted(map(tuple, legacy_factor_adjust(bars, factors, method, time="ts", chunk=chunk).collect()))
    assert read("day") == read("century") and 0 < len(read("day")) <= len(rows)
