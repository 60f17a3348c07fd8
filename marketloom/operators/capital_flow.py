"""Tick capital flow: order-size tiers, per-security summaries, rolling windows,
sector roll-ups.

Amounts are summed as BIGINT ten-thousandths of a yuan: exact, order-independent
and codegen-friendly (a security-day may reach 9e14 yuan before ANSI mode reports
an overflow).  Every tick-level step is one hash aggregation with map-side partial
sums, so a hot security costs no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.labels import FLOW_MAIN, FLOW_RETAIL, FLOW_TIERS, FLOW_TOTAL
from marketloom.functions.numbers import finite_or_null, percent
from marketloom.functions.symbols import volume_multiplier
from marketloom.functions.trades import BUY, DEFAULT_THRESHOLDS, NEUTRAL, SELL

SERIES_DAY = ("market", "code", "date")
UNIT = 10_000
_SHORT = dict(zip(FLOW_TIERS, ("super", "large", "medium", "small")))


def _money(name: str | Column) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return column.cast("double") / UNIT


def price_ticks(
    ticks: DataFrame,
    keys: Sequence[str] = SERIES_DAY,
    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
    closed: str = "right",
    strict: bool = False,
    zero_price: bool = False,
) -> DataFrame:
    """Keys and side of each tick with ``_units`` (amount) and ``_lots``, both NULL where
    the tick is not usable, and its ``_tier`` (0 = smallest).  A price of 0 is not usable
    unless ``zero_price``."""
    price, lots = finite_or_null("price"), finite_or_null("vol")
    shares_per_lot = volume_multiplier("market", "code", strict)
    usable = F.col("side").isin(BUY, SELL, NEUTRAL) & (price >= 0 if zero_price else price > 0) & (lots > 0)
    # An amount beyond BIGINT makes a tick unusable, not the market's job fail.
    units = F.when(usable, F.round(price * lots * shares_per_lot * UNIT).try_cast("bigint"))
    amount = F.col("_units") / UNIT
    passed = [amount > limit if closed == "right" else amount >= limit for limit in map(float, thresholds)]
    tier = F.when(passed[2], 3).when(passed[1], 2).when(passed[0], 1).otherwise(0)
    return (
        ticks.select(*keys, "side", units.alias("_units"), lots.alias("_lots"))
        .withColumn("_lots", F.when(F.col("_units").isNotNull(), F.col("_lots")))
        .withColumn("_tier", tier)
    )


def flow_sums(
    ticks: DataFrame,
    keys: Sequence[str] = SERIES_DAY,
    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
    closed: str = "right",
    strict: bool = False,
    zero_price: bool = False,
) -> DataFrame:
    """One row per key with buy/sell units and lots of each tier and the totals.

    The single shuffle behind the seven-row report, the summary, the history and the
    sector flow; persist it when several of them are wanted.
    """

    def when_sum(test: Column, value: str) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(value))), F.lit(0))

    sums = []
    for number, short in enumerate(reversed(_SHORT.values())):
        for side, word in ((BUY, "buy"), (SELL, "sell")):
            test = (F.col("_tier") == number) & (F.col("side") == side)
            sums.append(when_sum(test, "_units").alias(f"{short}_{word}_units"))
            sums.append(when_sum(test, "_lots").cast("double").alias(f"{short}_{word}_lots"))
    return (
        price_ticks(ticks, keys, thresholds, closed, strict, zero_price)
        .groupBy(*keys)
        .agg(
            *sums,
            F.coalesce(F.sum("_units"), F.lit(0)).alias("total_units"),
            F.coalesce(F.sum("_lots"), F.lit(0.0)).alias("total_lots"),
            when_sum(F.col("side") == NEUTRAL, "_units").alias("neutral_units"),
            F.count("_units").alias("trade_count"),
            F.count_if(F.col("_units").isNull()).alias("excluded_trade_count"),
        )
    )


def _net_units(*shorts: str) -> Column:
    total = F.lit(0).cast("bigint")
    for short in shorts:
        total = total + F.col(f"{short}_buy_units") - F.col(f"{short}_sell_units")
    return total


def capital_flow(sums: DataFrame, keys: Sequence[str] = SERIES_DAY) -> DataFrame:
    """The seven-level report of each key from :func:`flow_sums`.

    The levels are fixed, so they come from exploding an array beside the sums, with
    no second shuffle.  Shares are of the total including neutral trades.
    """
    levels = [(name, [_SHORT[name]]) for name in FLOW_TIERS]
    levels += [
        (FLOW_MAIN, ["super", "large"]),
        (FLOW_RETAIL, ["medium", "small"]),
        (FLOW_TOTAL, list(_SHORT.values())),
    ]

    def total(shorts: list[str], field: str) -> Column:
        column = F.col(f"{shorts[0]}_{field}")
        for short in shorts[1:]:
            column = column + F.col(f"{short}_{field}")
        return column

    rows = []
    for position, (name, shorts) in enumerate(levels):
        buy, sell = total(shorts, "buy_units"), total(shorts, "sell_units")
        buy_lots, sell_lots = total(shorts, "buy_lots"), total(shorts, "sell_lots")
        rows.append(
            F.struct(
                F.lit(position).alias("level_no"),
                F.lit(name).alias("level"),
                _money(buy).alias("buy_amount"),
                _money(sell).alias("sell_amount"),
                _money(buy - sell).alias("net_amount"),
                percent(buy - sell, F.col("total_units")).alias("net_pct"),
                buy_lots.alias("buy_volume"),
                sell_lots.alias("sell_volume"),
                (buy_lots - sell_lots).alias("net_volume"),
            )
        )
    return sums.select(*keys, F.inline(F.array(*rows)))


def flow_summary(sums: DataFrame, keys: Sequence[str] = SERIES_DAY) -> DataFrame:
    """One row per key: main/retail net, turnover, counts, and each tier's net."""
    total = F.col("total_units")
    main, retail = _net_units("super", "large"), _net_units("medium", "small")
    return sums.select(
        *keys,
        _money(main).alias("main_net"),
        percent(main, total).alias("main_net_pct"),
        _money(retail).alias("retail_net"),
        percent(retail, total).alias("retail_net_pct"),
        *[_money(_net_units(short)).alias(f"{short}_net") for short in _SHORT.values()],
        _money("total_units").alias("total_turnover"),
        F.col("total_lots").alias("total_volume"),
        _money("neutral_units").alias("neutral_turnover"),
        "trade_count",
        "excluded_trade_count",
    )


def unknown_side_counts(ticks: DataFrame, keys: Sequence[str] = SERIES_DAY) -> DataFrame:
    """Map of unrecognized side -> tick count.  Counted per (key, side) first, so
    the map is built from a handful of rows."""
    return (
        ticks.where(F.col("side").isNotNull() & ~F.col("side").isin(BUY, SELL, NEUTRAL))
        .groupBy(*keys, "side")
        .count()
        .groupBy(*keys)
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("side", "count")))).alias(
                "unknown_side_counts"
            )
        )
    )


def recent_days(bars: DataFrame, days: int | None = 20, windows: Sequence[int] = (5, 20)) -> DataFrame:
    """One row per security and day that a history of ``days`` rows needs: the days, the
    warm-up of their windows, and one more close.  ``_age`` counts from the newest; a history
    of all days (None) has no use for it, so nothing is ranked.

    The rank filter is a window group limit: each mapper ships only the newest rows.
    """
    keys = ["market", "code"]
    daily = bars.groupBy(*keys, "date").agg(F.max("close").alias("close"), F.count(F.lit(1)).alias("_copies"))
    if days is None:
        return daily
    newest = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return daily.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= days + max(windows))


def flow_history(
    bars: DataFrame,
    summary: DataFrame,
    days: int | None = 20,
    windows: Sequence[int] = (5, 20),
    strict: bool = False,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Daily flow with rolling main-flow sums, the last ``days`` rows per security (None: all).

    ``bars`` needs market, code, date, close (``recent``: their :func:`recent_days`, where they
    are known already); ``summary`` is :func:`flow_summary` per
    (market, code, date).  Warm-up rows are read before the cut, so the windows of
    returned rows are whole.  A security with repeated dates or a day without trades
    is marked ``status <> 'ok'`` with NULL windows (an error in strict mode); it
    cannot spoil others.

    Both sides are made one row per security and day, so a window partition never
    outgrows the trading calendar.
    """
    keys = ["market", "code"]
    warm_up = max(windows) - 1
    if recent is None:
        recent = recent_days(bars, days, windows)
    flows = summary.select(
        *keys,
        "date",
        "main_net",
        "main_net_pct",
        "super_net",
        "large_net",
        "medium_net",
        "small_net",
        "retail_net",
        "retail_net_pct",
        "total_turnover",
        "trade_count",
    )
    by_date = Window.partitionBy(*keys).orderBy("date")
    everything = Window.partitionBy(*keys)
    used = F.lit(True) if days is None else F.col("_age") <= days + warm_up
    silent = used & (F.coalesce(F.col("trade_count"), F.lit(0)) == 0)
    ready = (
        recent.join(flows, [*keys, "date"], "left")
        .withColumns(
            {
                "_previous": F.lag("close").over(by_date),
                "_repeats": F.max(F.col("_copies") > 1).over(everything),
                "_holes": F.max(silent).over(everything),
            }
        )
        .withColumn("change_pct", F.round((F.try_divide("close", "_previous") - 1) * 100, 2))
        .where(used)
        .withColumn(
            "status",
            F.when(F.col("_repeats"), "duplicate_dates").when(F.col("_holes"), "missing_trades").otherwise("ok"),
        )
    )
    if strict:
        ready = ready.withColumn(
            "status",
            F.when(F.col("status") == "ok", "ok").otherwise(
                F.raise_error(F.concat_ws(" ", "market", "code", "date", "status"))
            ),
        )
    out = []
    ok = F.col("status") == "ok"
    for size in windows:
        frame = by_date.rowsBetween(-(size - 1), 0)
        position = F.least(F.row_number().over(by_date), F.lit(size))
        whole = ok & (position == size)
        # Rolling sums of exact units: no drift along the series.
        net = F.sum(F.round(F.col("main_net") * UNIT).cast("bigint")).over(frame)
        amount = F.sum(F.round(F.col("total_turnover") * UNIT).cast("bigint")).over(frame)
        out += [
            F.when(whole, _money(net)).alias(f"main_{size}d_net"),
            F.when(whole & (amount != 0), F.round(net / amount * 100, 2)).alias(f"main_{size}d_pct"),
            position.alias(f"window_{size}d_days"),
            (position == size).alias(f"window_{size}d_complete"),
            F.when(whole, _money(F.sum(F.round(F.col("retail_net") * UNIT).cast("bigint")).over(frame))).alias(
                f"retail_{size}d_net"
            ),
            F.when(whole, _money(amount)).alias(f"total_{size}d_amount"),
        ]
    return (
        ready.select(
            *keys,
            "date",
            "close",
            "change_pct",
            F.col("total_turnover").alias("total_amount"),
            "main_net",
            F.col("main_net_pct").alias("main_pct"),
            "super_net",
            "large_net",
            "medium_net",
            "small_net",
            "retail_net",
            F.col("retail_net_pct").alias("retail_pct"),
            "status",
            *([] if days is None else ["_age"]),
            *out,
        )
        .where(F.lit(True) if days is None else F.col("_age") <= days)
        .drop("_age")
    )


INDUSTRY_NAME_COLUMNS = (
    "tdx_industry_name",
    "sw_industry_name",
    "sw_level1_name",
    "sw_level2_name",
    "sw_level3_name",
)


def sector_members(industries: DataFrame, name: str, strict: bool = True) -> DataFrame:
    """Securities of a named sector: equal on any industry name, or, only where
    nothing equals it, matching it as a regular expression."""
    columns = [c for c in INDUSTRY_NAME_COLUMNS if c in industries.columns]
    equal, like = F.lit(False), F.lit(False)
    for column in columns:
        equal = equal | F.coalesce(F.col(column) == name, F.lit(False))
        like = like | F.coalesce(F.col(column), F.lit("")).rlike(name)
    ranked = industries.where(equal | like).withColumn("_rank", F.when(equal, 1).otherwise(2))
    best = ranked.agg(F.min("_rank").alias("_best"))
    if strict:
        best = best.select(
            F.when(F.col("_best").isNotNull(), F.col("_best")).otherwise(
                F.raise_error(F.lit(f"no sector or industry named {name!r}"))
            ).alias("_best")
        )
    return ranked.where(F.col("_rank") == best.select("_best").scalar()).drop("_rank")


def distinct_members(members: DataFrame, sector: str = "sector") -> DataFrame:
    """One row per (sector, market, code), keeping the first spelling (lowest ``seq``)."""
    order = "seq" if "seq" in members.columns else "code"
    spelling = "symbol" if "symbol" in members.columns else "code"
    return members.groupBy(sector, "market", "code").agg(F.min_by(spelling, order).alias("symbol"))


def sector_flow(
    members: DataFrame, summary: DataFrame, sector: str = "sector", strict: bool = False
) -> DataFrame:
    """Sector totals from per-security flow.

    ``summary`` has one row per (market, code).  A sector with a member that has no
    trades is not summed: its money columns are NULL and ``status`` says why (an
    error in strict mode).  Ties of top/bottom flow go to the lower code.
    """
    flows = summary.select(
        "market", "code", "main_net", "retail_net", "super_net", "large_net", "total_turnover", "trade_count"
    )
    joined = distinct_members(members, sector).join(flows, ["market", "code"], "left")
    silent = F.coalesce(F.col("trade_count"), F.lit(0)) == 0
    names = ("main_net", "retail_net", "super_net", "large_net", "total_turnover")
    units = [F.sum(F.round(F.col(n) * UNIT).cast("decimal(38,0)")).alias(n) for n in names]
    sums = joined.groupBy(sector).agg(
        F.count(F.lit(1)).alias("stock_count"),
        F.count_if(silent).alias("silent_members"),
        *units,
        F.min_by("symbol", F.struct(-F.col("main_net"), F.col("symbol"))).alias("top_inflow_code"),
        F.max_by("symbol", F.struct(-F.col("main_net"), F.col("symbol"))).alias("top_outflow_code"),
    )
    whole = F.col("silent_members") == 0
    status = F.when(whole, "ok").otherwise(
        F.raise_error(F.concat(F.lit("sector has members without trades: "), F.col(sector)))
        if strict
        else F.lit("missing_trades")
    )
    return sums.select(
        sector,
        status.alias("status"),
        "stock_count",
        *[F.when(whole, _money(n)).alias(n) for n in names],
        F.when(whole, percent(F.col("main_net").cast("double"), F.col("total_turnover").cast("double"))).alias(
            "main_net_pct"
        ),
        F.when(whole, F.col("top_inflow_code")).alias("top_inflow_code"),
        F.when(whole, F.col("top_outflow_code")).alias("top_outflow_code"),
    )


def rank_members(members: DataFrame, summary: DataFrame, sector: str = "sector") -> DataFrame:
    """Member detail of each sector, to be read by descending main flow then code."""
    return (
        distinct_members(members, sector)
        .join(summary, ["market", "code"])
        .select(
            sector,
            "market",
            "code",
            "main_net",
            F.col("main_net_pct").alias("main_pct"),
            "retail_net",
            "super_net",
            "large_net",
            F.col("total_turnover").alias("total_amount"),
        )
        .orderBy(sector, F.desc("main_net"), "code")
    )
