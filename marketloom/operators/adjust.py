"""Corporate-action price adjustment.

A day's events compose to one affine price map; a security's maps compose to a
factor per event date.  Only the (small) event table is sorted; bars then pick
their factor with one as-of equi-join, so no window ever runs over bars here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numbers import half_up
from marketloom.functions.symbols import security_type
from marketloom.operators.asof import FORWARD, asof_lookup, time_bucket
from marketloom.operators.equity import normalize_actions
from marketloom.operators.scan import add_running_product, before, fill_forward, keep_latest

SERIES = ("market", "code")
OHLC = ("open", "high", "low", "close")
PRICE_COLUMNS = (*OHLC, "high_limit", "low_limit", "preclose")
DIVIDEND, SPLIT = 1, 11

_METHODS = {
    "qfq": "qfq", "01": "qfq", "before": "qfq",
    "hfq": "hfq", "02": "hfq", "after": "hfq",
}


def adjustment_method(value: str) -> str:
    try:
        return _METHODS[str(value).lower()]
    except KeyError:
        raise ValueError(f"unsupported adjustment: {value!r}") from None


def _number(name: str, columns: Sequence[str]) -> Column:
    return F.col(name) if name in columns else F.lit(0.0)


def event_maps(actions: DataFrame, *, splits: bool = True, only_price_events: bool = True) -> DataFrame:
    """Add ``_m`` and ``_c`` so that an event turns price p into (p - _c) / _m.

    Dividends, bonus and rights shares are per ten shares.  A split ratio must be a
    positive finite number; others are an error.
    """
    events = normalize_actions(actions)
    if only_price_events:
        events = events.where(F.col("category").isin(DIVIDEND, SPLIT))
    names = events.columns
    rights = _number("peigu", names)
    multiplier = (10 + _number("songzhuangu", names) + rights) / 10
    cash = (_number("fenhong", names) - rights * _number("peigujia", names)) / 10
    if only_price_events:
        multiplier = F.when(multiplier == 0, 1.0).otherwise(multiplier)
    if splits:
        ratio = _number("suogu", names)
        is_split = F.col("category") == SPLIT
        multiplier = F.when(
            is_split,
            F.when(ratio > 0, ratio).otherwise(F.raise_error(F.lit("split ratio must be positive"))),
        ).otherwise(multiplier)
        cash = F.when(is_split, 0.0).otherwise(cash)
    return events.withColumn("_m", multiplier).withColumn("_c", cash)


def daily_maps(events: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Compose each day's events in source order: price p becomes ``day_mul`` * p + ``day_add``."""
    later_today = (
        Window.partitionBy(*keys, "date")
        .orderBy(F.col("seq").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shrink = F.lit(1.0) / F.col("_m")
    return (
        events.withColumn("_reach", F.product(shrink).over(later_today))
        .groupBy(*keys, "date")
        .agg(F.product(shrink).alias("day_mul"), (-F.sum(F.col("_c") * F.col("_reach"))).alias("day_add"))
    )


def event_factors(
    days: DataFrame, keys: Sequence[str] = SERIES, keep: Sequence[str] = ()
) -> DataFrame:
    """Per event date, the map of that day and all later ones (``mul``, ``add``).

    One row per security and event date, so a window partition is bounded by the
    calendar.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    through = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = newest_first.rowsBetween(Window.unboundedPreceding, -1)
    beyond = F.coalesce(F.product("day_mul").over(after), F.lit(1.0))
    return days.withColumn("_beyond", beyond).select(
        *keys,
        "date",
        *keep,
        F.product("day_mul").over(through).alias("mul"),
        F.sum(F.col("day_add") * F.col("_beyond")).over(through).alias("add"),
    )


def series_bounds(bars: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    return bars.groupBy(*keys).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def price_factors(bars: DataFrame, actions: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Factor table: per security one row per event date, one at its first bar and one
    the day after its last.

    A bar uses the first row strictly after its date: the events from there on.
    Events beyond the last bar do not count.  hfq is qfq anchored so that the first
    bar keeps its price.  The two outer rows stand for "no event" and make every bar
    find a row.  Windows see event rows only, at most one per security and date.
    """
    keys = list(keys)
    bounds = series_bounds(bars, keys)
    days = daily_maps(event_maps(actions), keys)
    limits = ["first_date", "last_date"]
    known = days.join(bounds, keys).where(F.col("date") <= F.col("last_date"))
    outer = bounds.select(
        *keys,
        F.explode(F.array("first_date", F.date_add("last_date", 1))).alias("date"),
        F.lit(1.0).alias("day_mul"),
        F.lit(0.0).alias("day_add"),
        *limits,
    )
    # An event on the first bar's date merges with the outer row there.
    merged = (
        known.select(*keys, "date", "day_mul", "day_add", *limits)
        .unionByName(outer)
        .groupBy(*keys, "date", *limits)
        .agg(F.product("day_mul").alias("day_mul"), F.sum("day_add").alias("day_add"))
    )
    factors = event_factors(merged, keys, limits)
    after_first = F.when(F.col("date") > F.col("first_date"), F.col("date"))
    series = Window.partitionBy(*keys)
    anchored = factors.withColumns(
        {
            "_mul0": F.min_by("mul", after_first).over(series),
            "_add0": F.min_by("add", after_first).over(series),
        }
    )
    usable = F.col("_mul0") != 0
    return anchored.select(
        *keys,
        "date",
        F.col("mul").alias("qfq_mul"),
        F.col("add").alias("qfq_add"),
        F.when(usable, F.col("mul") / F.col("_mul0")).otherwise(1.0).alias("hfq_mul"),
        F.when(usable, (F.col("add") - F.col("_add0")) / F.col("_mul0")).otherwise(0.0).alias("hfq_add"),
    )


def adjustment_factors(bars: DataFrame, actions: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Bars with qfq_mul, qfq_add, hfq_mul, hfq_add; identity without events."""
    return _with_factors(bars, price_factors(bars, actions, keys), keys)


def _with_factors(bars: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = ["qfq_mul", "qfq_add", "hfq_mul", "hfq_add"]
    return asof_lookup(
        bars, table, keys, "date", "date", names, direction=FORWARD, strict=True, spans=True
    )


def apply_factors(factored: DataFrame, method: str, price_decimals: int | Column = 2) -> DataFrame:
    """Replace the price columns; volume and amount stay.  ``price_decimals`` may be a
    column choosing 2 or 3 per row."""
    method = adjustment_method(method)
    if isinstance(price_decimals, int) and price_decimals not in (2, 3):
        raise ValueError("price_decimals must be 2 or 3")
    mul, add = F.col(f"{method}_mul"), F.col(f"{method}_add")

    def adjusted(name: str) -> Column:
        exact = F.col(name) * mul + add
        if isinstance(price_decimals, int):
            return half_up(exact, price_decimals)
        return F.when(price_decimals == 3, half_up(exact, 3)).otherwise(half_up(exact, 2))

    return factored.withColumns({name: adjusted(name) for name in PRICE_COLUMNS if name in factored.columns})


def adjust_prices(
    bars: DataFrame,
    actions: DataFrame,
    method: str = "qfq",
    price_decimals: int = 2,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    factored = adjustment_factors(bars, actions, keys)
    return apply_factors(factored, method, price_decimals).select(*bars.columns)


def reference_preclose(bars: DataFrame, actions: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Add ``preclose``: the previous close carried through the events since then.

    Events up to and including the bar's date, after the previous bar's, are applied
    in order.  The first bar has none.  ``bars`` hold one row per security and date
    and events are composed per date first, so partitions are bounded by the
    calendar; grouping by (keys, gap) reuses the window's partitioning.
    """
    keys = list(keys)
    days = daily_maps(_preclose_events(actions), keys)
    # Flat columns: Spark drops those that nobody asks for before they are sorted.
    others = {n: f"_bar_{n}" for n in bars.columns if n not in (*keys, "date", "close")}
    bar_rows = bars.select(
        *keys,
        "date",
        F.lit(1).alias("_is_bar"),
        F.lit(None).cast("double").alias("day_mul"),
        F.lit(None).cast("double").alias("day_add"),
        F.col("close").alias("_own"),
        *[F.col(n).alias(at) for n, at in others.items()],
    )
    event_rows = days.select(
        *keys,
        "date",
        F.lit(0).alias("_is_bar"),
        "day_mul",
        "day_add",
        *[F.lit(None).cast(bar_rows.schema[n].dataType).alias(n) for n in ("_own", *others.values())],
    )
    order = Window.partitionBy(*keys).orderBy("date", "_is_bar")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    is_event = F.col("_is_bar") == 0
    timeline = (
        bar_rows.unionByName(event_rows)
        .withColumn("_gap", F.coalesce(F.sum("_is_bar").over(earlier), F.lit(0)))
        .withColumn("_close", F.last("_own", ignorenulls=True).over(earlier))
    )
    step = F.when(is_event, F.struct("date", "day_mul", "day_add"))
    # Each gap ends in one bar at most, so its columns are the only values there.
    shown = {n: others.get(n, "_own" if n == "close" else n) for n in bars.columns if n not in keys}
    gaps = timeline.groupBy(*keys, "_gap").agg(
        F.array_sort(F.collect_list(step)).alias("_steps"),
        F.max("_is_bar").alias("_ended"),
        *[F.first(F.when(~is_event, F.col(at)), ignorenulls=True).alias(f"_at_{n}") for n, at in {**shown, "before": "_close"}.items()],
    )
    folded = F.aggregate(
        "_steps", F.col("_at_before").cast("double"), lambda price, e: price * e["day_mul"] + e["day_add"]
    )
    return gaps.where("_ended = 1").select(
        *[F.col(n if n in keys else f"_at_{n}").alias(n) for n in bars.columns], folded.alias("preclose")
    )


def _preclose_events(actions: DataFrame) -> DataFrame:
    """Events as maps; one that would divide by zero leaves the price alone."""
    events = normalize_actions(actions).where(F.col("category").isin(DIVIDEND, SPLIT))
    names = events.columns
    void = (10 + _number("songzhuangu", names) + _number("peigu", names)) == 0
    return event_maps(events.where((F.col("category") == SPLIT) | ~void))


def adjust_bars(
    bars: DataFrame, actions: DataFrame, method: str = "qfq", keys: Sequence[str] = ("market", "code")
) -> DataFrame:
    """Full adjustment: reference preclose, prices, the multiplier ``adj``; rows opening
    at 0 are dropped.  Securities without price events pass through unchanged (NULL
    ``preclose`` and ``adj``).  Funds keep three decimals."""
    keys = list(keys)
    method = adjustment_method(method)
    priced = (
        normalize_actions(actions)
        .where(F.col("category").isin(DIVIDEND, SPLIT))
        .select(*keys)
        .distinct()
        .withColumn("_priced", F.lit(True))
    )
    # The factor table comes from the bars themselves, not from the longer plan.
    table = price_factors(bars, actions, keys)
    factored = _with_factors(reference_preclose(bars, actions, keys), table, keys).join(priced, keys, "left")
    is_fund = F.coalesce(security_type("market", "code").endswith("_FUND"), F.lit(False))
    decimals = F.when(is_fund, 3).otherwise(2)
    touched = F.coalesce(F.col("_priced"), F.lit(False))
    raw = {name: F.col(name) for name in bars.columns}
    kept = factored.withColumns({f"_raw_{n}": c for n, c in raw.items() if n in PRICE_COLUMNS})
    out = apply_factors(kept, method, decimals)
    prices = [
        F.when(touched, F.col(n)).otherwise(F.col(f"_raw_{n}")).alias(n) if n in PRICE_COLUMNS else F.col(n)
        for n in bars.columns
    ]
    return out.where(~touched | (F.col("open") != 0)).select(
        *prices,
        F.when(touched, F.col("preclose")).alias("preclose"),
        F.when(touched, F.col(f"{method}_mul")).alias("adj"),
    )


def adjust_intraday(
    bars: DataFrame,
    actions: DataFrame,
    method: str = "qfq",
    price_decimals: int = 2,
    keys: Sequence[str] = SERIES,
    ts: str = "ts",
) -> DataFrame:
    """Adjust bars of any frequency by the factors of their day, and add ``preclose``: the
    day's reference for its first bar, the bar before for the others (adjusted alike).

    Factors and references are worked out on one row per security and day, then joined;
    the only window over the bars themselves stays inside a day.
    """
    keys = list(keys)
    dated = bars.withColumn("date", F.to_date(ts))
    daily = dated.groupBy(*keys, "date").agg(F.max_by("close", ts).alias("close"))
    reference = reference_preclose(daily, actions, keys).select(*keys, "date", F.col("preclose").alias("_reference"))
    factors = adjustment_factors(daily.select(*keys, "date"), actions, keys)
    day = Window.partitionBy(*keys, "date").orderBy(ts)
    before = dated.withColumns({"_before": F.lag("close").over(day), "_first": F.row_number().over(day) == 1})
    joined = before.join(factors, [*keys, "date"]).join(reference, [*keys, "date"], "left")
    priced = joined.withColumn("preclose", F.when(F.col("_first"), F.col("_reference")).otherwise(F.col("_before")))
    out = apply_factors(priced, method, price_decimals)
    exact = F.col("preclose") * F.col(f"{adjustment_method(method)}_mul") + F.col(f"{adjustment_method(method)}_add")
    kept = [n for n in bars.columns if n != "preclose"]
    if "preclose" in PRICE_COLUMNS:
        return out.select(*kept, "preclose")
    return out.withColumn("preclose", half_up(exact, price_decimals)).select(*kept, "preclose")


def iterative_forward_adjust(
    bars: DataFrame, actions: DataFrame, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Compatibility rule: every action of any category adjusts all earlier bars as a
    dividend/rights event; no rounding, no anchor."""
    keys = list(keys)
    maps = event_maps(actions, splits=False, only_price_events=False)
    table = event_factors(daily_maps(maps, keys), keys)
    matched = asof_lookup(
        bars, table, keys, "date", "date", ["mul", "add"], direction=FORWARD, strict=True
    )
    mul, add = F.coalesce("mul", F.lit(1.0)), F.coalesce("add", F.lit(0.0))
    return matched.withColumns({n: F.col(n) * mul + add for n in OHLC if n in bars.columns}).select(
        *bars.columns
    )


def factor_adjust(
    bars: DataFrame, factors: DataFrame, method: str = "qfq", keys: Sequence[str] = SERIES
) -> DataFrame:
    """Multiply OHLC by an external factor series: latest factor in force, the first
    factor before that; qfq is scaled so that the last bar keeps its price.
    Securities without factors are returned as they are, ``factor`` NULL."""
    keys = list(keys)
    method = adjustment_method(method)
    table = _factor_table(bars, factors, keys)
    scale = F.when(F.col("_final") != 0, F.col("_scale") / F.col("_final")).otherwise(F.col("_scale"))
    table = table.withColumn("factor", scale if method == "qfq" else F.col("_scale"))
    aligned = asof_lookup(bars, table, keys, "date", "date", ["factor"], spans=True)
    prices = {n: F.col(n) * F.coalesce("factor", F.lit(1.0)) for n in OHLC if n in bars.columns}
    return aligned.withColumns(prices).select(*bars.columns, "factor")


def _factor_table(bars: DataFrame, factors: DataFrame, keys: list[str]) -> DataFrame:
    """The factor in force (``_scale``) from each date on, and that of the last bar
    (``_final``), with rows at the first and last bar, so that every bar finds one.

    All of it is worked out on the factors' side, brought together by key once; bars are
    shuffled for their own as-of join only.
    """
    known = factors.select(*keys, "date", F.struct(F.col("factor").cast("double").alias("v")).alias("_known"), F.lit(None).cast("date").alias("_end"))
    outer = series_bounds(bars, keys).select(
        *keys, F.explode(F.array("first_date", "last_date")).alias("date"),
        F.lit(None).cast(known.schema["_known"].dataType).alias("_known"), F.col("last_date").alias("_end"),
    )
    daily = (
        known.unionByName(outer).repartition(*keys)
        .groupBy(*keys, "date").agg(F.max("_known.v").alias("_v"), F.max(F.col("_known").isNotNull()).alias("_real"), F.max("_end").alias("_end"))
    )
    order = Window.partitionBy(*keys).orderBy("date")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A date without a value counts as a row of its own, before it is replaced by the first.
    value = F.when(F.col("_real"), F.struct("_v"))
    first = F.first(value, ignorenulls=True).over(whole)
    in_force = F.last(value, ignorenulls=True).over(so_far)
    at_end = F.col("date") <= F.max("_end").over(whole)
    return (
        daily.withColumn("_scale", F.coalesce(in_force["_v"], first["_v"]))
        .withColumn("_final", F.max_by("_scale", F.when(at_end, F.col("date"))).over(whole))
        .select(*keys, "date", "_scale", "_final")
    )


def legacy_factor_adjust(
    bars: DataFrame, factors: DataFrame, method: str, keys: Sequence[str] = SERIES, time: str = "date", chunk: str = "month"
) -> DataFrame:
    """Compatibility rule: outer join by time, fill forward, drop incomplete rows, keep
    the first row of each repeated OHLCV, then hfq multiplies and qfq divides.

    Both sides are one row per security and ``time`` (a date or, for bars within the day, a
    timestamp); the fill is a two-level scan, so a long series is spread over its chunks.
    """
    keys = list(keys)
    method = adjustment_method(method)
    filled_columns = [n for n in bars.columns if n not in (*keys, time)]
    joined = bars.join(factors.select(*keys, time, "factor"), [*keys, time], "full")
    filled = fill_forward(joined, keys, time, [*filled_columns, "factor"], time_bucket(F.col(time), chunk)).dropna()
    shape = [n for n in (*OHLC, "volume") if n in bars.columns]
    kept = keep_latest(filled, [*keys, *shape], [F.col(time).asc()])
    factor = F.col("factor")
    prices = {n: F.col(n) * factor if method == "hfq" else F.col(n) / factor for n in OHLC if n in shape}
    return kept.withColumns(prices).select(*bars.columns)


def ratio_chain_adjust(
    bars: DataFrame,
    actions: DataFrame,
    method: str = "qfq",
    until: str | None = None,
    keys: Sequence[str] = SERIES,
    time: str = "date",
    chunk: str = "month",
) -> DataFrame:
    """Purely multiplicative adjustment: chain preclose(next) / close over the series.

    Event-only days carry the last bar (suspension) and are dropped at the end.
    ``until`` limits the events to that date.  One row per security and ``time``, a date or,
    for bars within the day, a timestamp; events count from the first moment of their date.

    Carried closes and neighbours are one two-level scan, products a second: windows stay
    inside (security, chunk), and one row per chunk goes between them.  Every such scan reads
    what is below it twice, so they are few.
    """
    keys = list(keys)
    method = adjustment_method(method)
    events = normalize_actions(actions).where(F.col("category") == DIVIDEND)
    if until is not None:
        events = events.where(F.col("date") <= F.lit(until).cast("date"))
    fields = ["fenhong", "peigu", "peigujia", "songzhuangu"]
    daily = events.groupBy(*keys, "date").agg(*[F.max_by(n, "seq").alias(f"_{n}") for n in fields])
    kind = bars.schema[time].dataType
    daily = daily.withColumn("_at", F.col("date").cast(kind)).drop("date").withColumnRenamed("_at", time)

    # Events before the first bar stay in: without a close their ratio is 1.
    part = time_bucket(F.col(time), chunk)
    timeline = (
        bars.withColumn("_traded", F.lit(True))
        .join(daily, [*keys, time], "full")
        .withColumns({f"_{n}": F.coalesce(f"_{n}", F.lit(0.0)) for n in fields})
        .withColumns(
            {
                "_chunk": part,
                "_cash": F.col("_peigu") * F.col("_peigujia") - F.col("_fenhong"),
                "_shares": F.lit(10) + F.col("_peigu") + F.col("_songzhuangu"),
            }
        )
    )
    # One row per chunk: the close carried into it, and the event that follows it.
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    borders = (
        timeline.groupBy(*keys, "_chunk")
        .agg(
            F.max_by("close", F.when(F.col("close").isNotNull(), F.col(time))).alias("_final"),
            *[F.min_by(n, time).alias(f"{n}_first") for n in ("_cash", "_shares")],
        )
        .select(
            *keys,
            "_chunk",
            F.last("_final", ignorenulls=True).over(before(keys, "_chunk")).alias("_carried"),
            *[F.lead(f"{n}_first").over(by_chunk).alias(f"{n}_after") for n in ("_cash", "_shares")],
        )
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(time)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_close = F.coalesce(F.last("close", ignorenulls=True).over(so_far), F.col("_carried"))
    chained = (
        timeline.join(borders, [*keys, "_chunk"])
        .withColumn("_close", last_close)
        .withColumns(
            {
                "_prior": F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(F.lag("_close").over(inside)),
                **{f"{n}_next": F.coalesce(F.lead(n).over(inside), F.col(f"{n}_after")) for n in ("_cash", "_shares")},
            }
        )
        .withColumn("preclose", (F.col("_prior") * 10 + F.col("_cash")) / F.col("_shares"))
        .withColumn("_next", (F.col("_close") * 10 + F.col("_cash_next")) / F.col("_shares_next"))
        .withColumn("_ratio", F.coalesce(F.try_divide("_next", "_close"), F.lit(1.0)))
        .select(*bars.columns, "preclose", "_ratio", "_traded")
    )
    adjusted = add_running_product(chained, keys, [time], "_ratio", part, "adj", reverse=method == "qfq").where(F.col("_traded"))
    scale = F.col("adj") if method == "qfq" else F.lit(1.0) / F.col("adj")
    names = [n for n in (*OHLC, "preclose") if n in adjusted.columns]
    return (
        adjusted.where(F.col("open") != 0)
        .withColumns({n: F.col(n) * scale for n in names})
        .select(*bars.columns, "preclose", "adj")
    )
