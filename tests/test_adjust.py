"""Price adjustment, share capital and factors against models in rational arithmetic."""

import datetime as dt
import random
from fractions import Fraction as Q

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketloom.operators import adjust, equity

FIELDS = ["fenhong", "peigujia", "songzhuangu", "peigu", "suogu", "panhouliutong", "houzongguben"]
ACTIONS = (
    "market int, code string, date date, seq long, category int, " + ", ".join(f"{n} double" for n in FIELDS) + ", equity_unit string"
)
BARS = "market int, code string, date date, open double, high double, low double, close double, volume double, amount double"
FIRST = dt.date(2031, 3, 3)


def on(n):
    return FIRST + dt.timedelta(days=n)


def action_frame(spark, events, unit=None):
    rows = [
        (1, e["code"], on(e["day"]), e.get("seq", i), e["category"], *[None if e.get(n) is None else float(e[n]) for n in FIELDS], unit)
        for i, e in enumerate(events)
    ]
    return spark.createDataFrame(rows, ACTIONS)


def bar_frame(spark, series):
    """{code: [(day, price)]}; the four prices lie around the close."""
    rows = [
        (1, code, on(d), p, p + 0.5, p - 0.25, p, 40.0 + d, 7.0) for code, points in series.items() for d, p in points
    ]
    return spark.createDataFrame(rows, BARS)


def exact(x):
    return Q(str(x or 0))


def steps(events, category=None):
    """(day, m, c): a price turns into (price - c) / m, in the order of day and seq."""
    out = []
    for i, e in enumerate(events):
        if e["category"] == 11:
            out.append((e["day"], e.get("seq", i), exact(e["suogu"]), Q(0)))
        elif e["category"] == 1:
            rights = exact(e.get("peigu"))
            m = (10 + exact(e.get("songzhuangu")) + rights) / 10
            out.append((e["day"], e.get("seq", i), m, (exact(e.get("fenhong")) - rights * exact(e.get("peigujia"))) / 10))
    return [(d, m, c) for d, _, m, c in sorted(out, key=lambda x: x[:2]) if m]


def through(price, events):
    for _, m, c in events:
        price = (price - c) / m
    return price


def rounded(value, digits):
    scaled = abs(value) * 10**digits
    whole = int(scaled + Q(1, 2))
    return float(Q(whole, 10**digits)) * (-1 if value < 0 else 1)


def line(events, after, last):
    """(mul, add) of all steps in (after, last]."""
    mine = [s for s in events if after < s[0] <= last]
    return through(Q(1), mine) - through(Q(0), mine), through(Q(0), mine)


def market(seed, count=10):
    rng = random.Random(seed)
    series, events = {}, []
    for k in range(count):
        code = f"60{k:04d}"
        days = sorted(rng.sample(range(900), rng.choice([1, 2, 30, 60])))
        series[code] = [(d, round(rng.uniform(3, 60), 2)) for d in days]
        for s in range(rng.randrange(14)):
            events.append(
                {"code": code, "day": rng.choice([*days, rng.randrange(-40, 950)]), "seq": s, "category": rng.choice([1, 1, 11, 5]),
                 "fenhong": rng.choice([0, 0.37, 1.8]), "songzhuangu": rng.choice([0, 3, 7.5]), "peigu": rng.choice([0, 0, 2]),
                 "peigujia": 4.2, "suogu": rng.choice([0.8, 1.6, 4])}
            )
    return series, events


@pytest.mark.parametrize("seed", [11, 12])
def test_forward_and_backward_prices(spark, seed):
    series, events = market(seed)
    bars, actions = bar_frame(spark, series), action_frame(spark, events)
    got = {
        (method, r["code"], r["date"]): r["close"]
        for method in ("qfq", "hfq")
        for r in adjust.adjust_prices(bars, actions, method, 3).collect()
    }
    assert len(got) == 2 * sum(map(len, series.values()))
    for code, points in series.items():
        own, last = steps([e for e in events if e["code"] == code]), points[-1][0]
        mul0, add0 = line(own, points[0][0], last)
        for d, p in points:
            mul, add = line(own, d, last)
            assert got["qfq", code, on(d)] == pytest.approx(rounded(exact(p) * mul + add, 3), abs=1e-9)
            back = (exact(p) * mul + add - add0) / mul0
            assert got["hfq", code, on(d)] == pytest.approx(rounded(back, 3), abs=1e-9)


@pytest.mark.parametrize("seed", [21, 22])
def test_reference_preclose(spark, seed):
    series, events = market(seed)
    out = adjust.reference_preclose(bar_frame(spark, series), action_frame(spark, events)).collect()
    got = {(r["code"], r["date"]): r["preclose"] for r in out}
    for code, points in series.items():
        own, before = steps([e for e in events if e["code"] == code]), None
        for d, p in points:
            if before is None:
                assert got[code, on(d)] is None
            else:
                want = through(exact(before[1]), [s for s in own if before[0] < s[0] <= d])
                assert got[code, on(d)] == pytest.approx(float(want), rel=1e-9, abs=1e-9)
            before = (d, p)


def test_intraday_bars_take_the_factor_of_their_day(spark):
    series, events = market(31, 6)
    rng = random.Random(5)
    rows = []
    for code, points in series.items():
        for d, p in points:
            for minute in rng.sample(range(240), 3):
                ts = dt.datetime.combine(on(d), dt.time(9, 30)) + dt.timedelta(minutes=minute)
                rows.append((1, code, ts, round(p + minute / 100, 2), 5.0))
    bars = spark.createDataFrame(rows, "market int, code string, ts timestamp_ntz, close double, volume double")
    actions = action_frame(spark, events)
    out = {(r["code"], r["ts"]): r for r in adjust.adjust_intraday(bars, actions, "qfq", 3).collect()}
    assert len(out) == len(rows)
    for code, points in series.items():
        own, last = steps([e for e in events if e["code"] == code]), points[-1][0]
        before = None
        for _, _, ts, close, _ in sorted((r for r in rows if r[1] == code), key=lambda r: r[2]):
            d = (ts.date() - FIRST).days
            mul, add = line(own, d, last)
            assert out[code, ts]["close"] == pytest.approx(rounded(exact(close) * mul + add, 3), abs=1e-9)
            if before is None:
                assert out[code, ts]["preclose"] is None
            else:
                gone = through(exact(before[1]), [s for s in own if before[0] < s[0] <= d])
                assert out[code, ts]["preclose"] == pytest.approx(rounded(gone * mul + add, 3), abs=2e-3)
            before = (d, close)


def test_full_adjustment_joins_prices_preclose_and_multiplier(spark):
    series, events = market(41)
    series["510777"] = [(0, 2.3456), (9, 1.2)]  # a fund: three decimals
    events.append({"code": "510777", "day": 4, "category": 11, "suogu": 2})
    series["000099"] = [(0, 0.0), (1, 8.125)]  # nothing happens: left alone
    out = {(r["code"], r["date"]): r for r in adjust.adjust_bars(bar_frame(spark, series), action_frame(spark, events)).collect()}
    assert (out["510777", on(0)]["close"], out["510777", on(0)]["adj"]) == (1.173, 0.5)
    assert [out["000099", on(k)]["close"] for k in (0, 1)] == [0.0, 8.125] and out["000099", on(1)]["adj"] is None
    for code, points in series.items():
        own = steps([e for e in events if e["code"] == code])
        if not [e for e in events if e["code"] == code and e["category"] in (1, 11)]:
            continue
        for d, p in points:
            mul, add = line(own, d, points[-1][0])
            digits = 3 if code.startswith("51") else 2
            opened = rounded(exact(p) * mul + add, digits)
            assert ((code, on(d)) in out) == (opened != 0)
            if opened:
                assert out[code, on(d)]["adj"] == pytest.approx(float(mul), rel=1e-9)


def test_wrong_parameters_and_splits(spark):
    bars = bar_frame(spark, {"600001": [(0, 4.0), (2, 4.0)]})
    fine = action_frame(spark, [{"code": "600001", "day": 1, "category": 1, "fenhong": 2}])
    for options in ({"price_decimals": 5}, {"method": "other"}):
        with pytest.raises(ValueError):
            adjust.adjust_prices(bars, fine, **options)
    for ratio in (0.0, -2.0, float("nan"), float("inf"), None):
        bad = action_frame(spark, [{"code": "600001", "day": 1, "category": 11, "suogu": ratio}])
        with pytest.raises(PySparkException, match="split ratio"):
            adjust.adjust_prices(bars, bad).collect()
    # A share ratio that would divide by zero is not applied; the reference ignores its event.
    void = action_frame(spark, [{"code": "600001", "day": 1, "category": 1, "songzhuangu": -10}])
    assert {r["close"] for r in adjust.adjust_prices(bars, void).collect()} == {4.0}
    void = action_frame(spark, [{"code": "600001", "day": 1, "category": 1, "songzhuangu": -10, "fenhong": 6}])
    assert {r["preclose"] for r in adjust.reference_preclose(bars, void).collect()} == {None, 4.0}


def test_turnover_takes_the_last_record_in_force(spark):
    rng = random.Random(3)
    series = {f"00{k:04d}": [(d, 5.0) for d in sorted(rng.sample(range(60), 9))] for k in range(5)}
    events = [
        {"code": rng.choice(list(series)), "day": rng.randrange(60), "seq": s, "category": rng.choice([2, 3, 5, 1]),
         "panhouliutong": rng.choice([None, 0, 250_000, 8_000_000])}
        for s in range(60)
    ]
    for unit, scale in ((None, 1), ("ten_thousand_shares", 10_000)):
        told = [{**e, "panhouliutong": e["panhouliutong"] and e["panhouliutong"] / scale} for e in events]
        out = equity.enrich_turnover(bar_frame(spark, series), action_frame(spark, told, unit)).collect()
        for r in out:
            known = [e for e in events if e["code"] == r["code"] and e["category"] != 1 and on(e["day"]) <= r["date"]]
            held = max(known, key=lambda e: (e["day"], e["seq"]))["panhouliutong"] if known else None
            want = r["volume"] * 100 / held * 100 if held else None
            assert r["turnover"] == (pytest.approx(want) if want is not None else None)


def test_capital_snapshot_truncates_shares(spark):
    events = [{"code": "600001", "day": 3, "category": 5, "panhouliutong": 0.00019, "houzongguben": 7.77777}]
    actions = action_frame(spark, events, "ten_thousand_shares")
    row = equity.equity_snapshot(actions).first()
    assert (row["float_equity"], row["total_equity"]) == (1, 77777)
    assert equity.equity_snapshot(actions, at=str(on(2))).count() == 0


def factor_frame(spark, factors):
    return spark.createDataFrame([(1, c, on(d), f) for c, d, f in factors], "market int, code string, date date, factor double")


def test_external_factors(spark):
    series = {"600001": [(0, 9.0), (5, 9.0), (9, 9.0), (30, 9.0)], "600002": [(1, 3.0)], "600003": [(0, 2.0), (8, 2.0)]}
    factors = [("600001", 4, 3.0), ("600001", 9, 1.5), ("600002", 7, 5.0)]
    bars, frame = bar_frame(spark, series), factor_frame(spark, factors)

    def force(code, d):
        own = sorted((day, f) for c, day, f in factors if c == code)
        return next((f for day, f in reversed(own) if day <= d), own[0][1] if own else None)

    for method in ("qfq", "hfq"):
        got = {(r["code"], r["date"]): (r["close"], r["factor"]) for r in adjust.factor_adjust(bars, frame, method).collect()}
        for code, points in series.items():
            for d, p in points:
                f = force(code, d)
                if f is not None and method == "qfq":
                    f = f / force(code, points[-1][0])
                assert got[code, on(d)] == (pytest.approx(p * (f or 1)), f if f is None else pytest.approx(f))


def test_legacy_factor_rule(spark):
    points = [(0, 6.0), (2, 6.0), (3, 7.0), (6, 7.0), (7, 6.0)]
    bars = bar_frame(spark, {"600001": points}).withColumn("volume", F.lit(1.0))
    factors = [("600001", 1, 2.0), ("600001", 6, 5.0)]
    # Rows of either side by day, both filled forward; the first of equal bars stays.
    price, factor, seen, want = None, None, set(), []
    for d in sorted({d for d, _ in points} | {d for _, d, _ in factors}):
        price = dict(points).get(d, price)
        factor = {day: f for _, day, f in factors}.get(d, factor)
        if price is not None and factor is not None and price not in seen:
            seen.add(price)
            want.append((on(d), price * factor, price / factor))
    for k, method in ((1, "hfq"), (2, "qfq")):
        out = adjust.legacy_factor_adjust(bars, factor_frame(spark, factors), method).orderBy("date").collect()
        assert [(r["date"], r["close"]) for r in out] == [(w[0], pytest.approx(w[k])) for w in want]


def test_iterative_rule_counts_every_category(spark):
    series = {"600001": [(d, 20.0 + d) for d in range(0, 50, 7)]}
    rng = random.Random(8)
    events = [
        {"code": "600001", "day": rng.randrange(60), "seq": s, "category": c, "fenhong": rng.choice([0.5, 3]), "songzhuangu": rng.choice([0, 4])}
        for s, c in enumerate([1, 2, 5, 9, 14])
    ]
    as_dividends = steps([{**e, "category": 1} for e in events])
    out = adjust.iterative_forward_adjust(bar_frame(spark, series), action_frame(spark, events)).collect()
    prices = dict(series["600001"])
    for r in out:
        d = (r["date"] - FIRST).days
        assert r["close"] == pytest.approx(float(through(exact(prices[d]), [s for s in as_dividends if s[0] > d])))


def test_ratio_chain(spark):
    points = [(0, 8.0), (1, 8.8), (4, 5.5), (5, 5.0), (9, 5.2)]
    events = [
        {"code": "600001", "day": 3, "category": 1, "songzhuangu": 6, "fenhong": 1},
        {"code": "600001", "day": 5, "category": 1, "fenhong": 2},
        {"code": "600001", "day": 2, "category": 11, "suogu": 3},  # not a dividend: no part of the chain
    ]
    for until in (None, str(on(3))):
        mine = {e["day"]: e for e in events if e["category"] == 1 and (until is None or on(e["day"]) <= dt.date.fromisoformat(until))}
        days = sorted({d for d, _ in points} | set(mine))
        closes, references, close = [], [], None
        for d in days:
            e = mine.get(d, {})
            ten = 10 + exact(e.get("songzhuangu"))
            references.append(None if close is None else (close * 10 - exact(e.get("fenhong"))) / ten)
            close = exact(dict(points)[d]) if d in dict(points) else close
            closes.append(close)
        ratios = [references[i + 1] / closes[i] if i + 1 < len(days) else Q(1) for i in range(len(days))]
        for method in ("qfq", "hfq"):
            out = adjust.ratio_chain_adjust(bar_frame(spark, {"600001": points}), action_frame(spark, events), method, until)
            for r in out.collect():
                i, product = days.index((r["date"] - FIRST).days), Q(1)
                for x in ratios[i:] if method == "qfq" else ratios[: i + 1]:
                    product *= x
                want = closes[i] * product if method == "qfq" else closes[i] / product
                assert r["close"] == pytest.approx(float(want))


def test_ratio_chain_reads_its_bars_few_times(spark):
    from marketloom.plans import load_queries

    frame = load_queries()["ratio_chain_qfq"].run(spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice#") and sum("Relation" in line and "l_suppkey" in line for line in plan.splitlines()) <= 4


def test_running_products_multiply_in_order(spark):
    from marketloom.operators.scan import add_running_product

    rows = [("a", i, v) for i, v in enumerate([2.0, 3.0, None, 5.0, 7.0])]
    frame = spark.createDataFrame(rows, "k string, i int, v double")
    for reverse, wanted in ((False, [2, 6, 6, 30, 210]), (True, [210, 105, 35, 35, 7])):
        out = add_running_product(frame, ["k"], ["i"], "v", F.floor(F.col("i") / 2), "p", reverse)
        assert [r["p"] for r in out.orderBy("i").collect()] == wanted


def test_preclose_carries_only_what_is_asked_for(spark):
    """Other columns of the bars are not sorted along where only the reference is wanted."""
    bars = spark.sql("select 0 as market, code, to_date(d) as date, close, volume from values ('1', '2024-01-02', 4.0D, 7.0D), ('1', '2024-01-03', 5.0D, null) as t(code, d, close, volume)")
    actions = spark.sql("select 0 as market, '1' as code, date'2024-01-03' as date, 1L as seq, 1 as category, 10.0D as fenhong, 0.0D as peigujia, 0.0D as songzhuangu, 0.0D as peigu, 0.0D as suogu")
    out = adjust.reference_preclose(bars, actions)
    assert sorted((str(r["date"]), r["close"], r["volume"], r["preclose"]) for r in out.collect()) == [("2024-01-02", 4.0, 7.0, None), ("2024-01-03", 5.0, None, 3.0)]
    assert "volume" not in out.select("code", "date", "preclose")._jdf.queryExecution().optimizedPlan().toString()
