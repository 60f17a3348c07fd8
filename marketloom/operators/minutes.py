"""Ticks to minute bars, the call-auction split, intraday point clocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numbers import finite_or_null
from marketloom.functions.times import at_minute, clock_seconds, minute_of_day
from marketloom.operators.scan import add_ordinal

SERIES_DAY = ("market", "code", "date")
SLOTS = 241


def with_clock(ticks: DataFrame) -> DataFrame:
    """Add ``sod`` (second of the day) from ``mod``, or from the text ``time``."""
    if "sod" in ticks.columns:
        return ticks
    if "mod" in ticks.columns:
        return ticks.withColumn("sod", F.col("mod").cast("int") * 60)
    return ticks.withColumn("sod", clock_seconds("time"))


def tick_order(time: Column, seq: str = "seq") -> Column:
    """(time, seq) as one orderable number: 18 digits of time (not negative), then the BIGINT."""
    return time.cast("decimal(18,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + F.col(seq).cast("decimal(19,0)")


def exact_units(amount: Column) -> Column:
    """Ten-thousandths as BIGINT; NULL where the amount is beyond its range."""
    return F.round(amount * 10_000).try_cast("bigint")


def minute_bucket(minute: Column) -> Column:
    """Minute bar of a tick: the next minute, with auction, noon and close clamped."""
    following = F.greatest(minute, F.lit(569)) + 1
    noon = F.when((following > 690) & (following <= 780), F.lit(690)).otherwise(following)
    return F.least(noon, F.lit(900))


def slot_of(minute: Column) -> Column:
    """0..240 for 570..690 and 781..900."""
    return F.when(minute <= 690, minute - 570).otherwise(minute - 660)


def minute_of_slot(slot: Column) -> Column:
    return F.when(slot <= 120, slot + 570).otherwise(slot + 660)


def usable_price(price: Column, zero: bool = False) -> Column:
    """Positive; with ``zero``, a price of 0 counts too."""
    return price >= 0 if zero else price > 0


def tick_problem(ticks: DataFrame, zero_price: bool = False) -> Column:
    """Why a tick cannot be used for minute bars, else NULL."""
    minute = F.floor(F.col("sod") / 60)
    clocked = F.coalesce(minute.between(565, 690) | minute.between(780, 900), F.lit(False))
    price, volume = finite_or_null("price"), finite_or_null("vol")
    problem = (
        F.when(~clocked, "time")
        .when(~F.coalesce(usable_price(price, zero_price), F.lit(False)), "price")
        .when(~F.coalesce(volume >= 0, F.lit(False)), "volume")
        .when(exact_units(price * volume * 100).isNull(), "amount")
    )
    if "num" in ticks.columns:
        problem = problem.when(~F.coalesce(finite_or_null("num") >= 0, F.lit(False)), "num")
    return problem


def traded_minutes(
    ticks: DataFrame, keys: Sequence[str] = SERIES_DAY, strict: bool = False, zero_price: bool = False
) -> DataFrame:
    """One row per key and minute that traded: OHLC, shares, amount, orders.

    Hash aggregation with map-side partial results; input order inside a minute is
    (second, seq), as one decimal with room for any BIGINT.  A day with an unusable tick, or without
    volume, is left out (an error in strict mode) -- see :func:`rejected_days`.  A price of 0 is
    unusable unless ``zero_price``.
    """
    keys = list(keys)
    clocked = with_clock(ticks)
    problem = tick_problem(clocked, zero_price)
    bad = problem.isNotNull()
    if strict:
        bad = F.when(bad, F.raise_error(F.concat(F.lit("unusable tick: "), problem))).otherwise(False)
    order = tick_order(F.col("sod"))
    orders = F.col("num").cast("double") if "num" in ticks.columns else F.lit(0.0)
    minutes = (
        clocked.withColumns(
            {
                "_bad": bad,
                "_minute": minute_bucket(F.floor(F.col("sod") / 60)),
                "_order": order,
                "_shares": F.col("vol").cast("double") * 100,
            }
        )
        .groupBy(*keys, "_minute")
        .agg(
            F.min_by("price", "_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_order").alias("close"),
            F.sum("_shares").alias("volume"),
            # Exact units: the result does not depend on the order of summation.
            (F.sum(exact_units(F.col("price") * F.col("_shares"))) / 10_000).alias("amount"),
            F.sum(orders).alias("order"),
            F.count_if("_bad").alias("_bad"),
        )
    )
    day = Window.partitionBy(*keys)
    volume = F.sum("volume").over(day)
    checked = minutes.withColumn("_bad", F.sum("_bad").over(day)).withColumn("_day_volume", volume)
    if strict:
        checked = checked.withColumn(
            "_day_volume",
            F.when(F.col("_day_volume") > 0, F.col("_day_volume")).otherwise(
                F.raise_error(F.lit("trade volume of a day must be positive"))
            ),
        )
    return checked.where((F.col("_bad") == 0) & (F.col("_day_volume") > 0)).drop("_bad", "_day_volume")


def rejected_days(ticks: DataFrame, keys: Sequence[str] = SERIES_DAY, zero_price: bool = False) -> DataFrame:
    """Days :func:`ticks_to_minutes` leaves out, with the reasons."""
    clocked = with_clock(ticks)
    return (
        clocked.withColumn("_problem", tick_problem(clocked, zero_price))
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_set("_problem")).alias("problems"),
            F.coalesce(F.sum(finite_or_null("vol")), F.lit(0.0)).alias("volume"),
        )
        .where((F.size("problems") > 0) | (F.col("volume") <= 0))
    )


def ticks_to_minutes(
    ticks: DataFrame,
    keys: Sequence[str] = SERIES_DAY,
    strict: bool = False,
    timezone: str = "Asia/Shanghai",
    zero_price: bool = False,
) -> DataFrame:
    """The 241 one-minute bars of each traded day.

    A minute without trades carries the previous close (before the first trade, the
    first price).  Each traded minute unfolds into itself and the empty slots up to
    the next one, so no skeleton join is needed; windows see at most 241 rows.
    """
    keys = list(keys)
    traded = traded_minutes(ticks, keys, strict, zero_price).withColumn("_slot", slot_of(F.col("_minute")))
    order = Window.partitionBy(*keys).orderBy("_slot")
    unfolded = traded.select(
        "*",
        F.coalesce(F.lead("_slot").over(order), F.lit(SLOTS)).alias("_next"),
        F.when(F.row_number().over(order) == 1, F.lit(0).cast("bigint"))
        .otherwise(F.col("_slot").cast("bigint"))
        .alias("_from"),
    ).withColumn("_at", F.explode(F.sequence("_from", F.col("_next").cast("bigint") - 1)))
    own = F.col("_at") == F.col("_slot")
    idle_price = F.when(F.col("_at") < F.col("_slot"), F.col("open")).otherwise(F.col("close"))
    minute = minute_of_slot(F.col("_at")).cast("int")
    return unfolded.select(
        *keys,
        minute.alias("minute"),
        at_minute("date", minute).alias("ts"),
        *[F.when(own, F.col(n)).otherwise(idle_price).alias(n) for n in ("open", "high", "low", "close")],
        *[F.when(own, F.col(n)).otherwise(0.0).alias(n) for n in ("volume", "amount", "order")],
        F.lit("trade").alias("source"),
        F.lit("shares").alias("volume_unit"),
        F.lit(timezone).alias("timezone"),
        F.lit(True).alias("is_approximate"),
    )


def auction_values(
    ticks: DataFrame, keys: Sequence[str] = SERIES_DAY, multiplier: float = 100, zero_price: bool = False
) -> DataFrame:
    """Opening auction of each day from its 09:25-09:30 ticks.

    One distinct price: 'derived'; several: 'inconsistent' with nothing else kept.
    Days without usable ticks have no row ('missing').  A price of 0 is unusable unless
    ``zero_price``.
    """
    if not multiplier > 0:
        raise ValueError("multiplier must be positive")
    price, lots = finite_or_null("price"), finite_or_null("vol")
    orders = F.coalesce(finite_or_null("num"), F.lit(0.0)) if "num" in ticks.columns else F.lit(0.0)
    usable = (
        with_clock(ticks)
        .where(
            F.col("sod").between(565 * 60, 570 * 60 - 1)
            & F.col("side").isin(0, 1, 2)
            & usable_price(price, zero_price)
            & (lots > 0)
        )
        .groupBy(*keys)
        .agg(
            F.min(price).alias("_low"),
            F.max(price).alias("_high"),
            (F.sum(lots) * multiplier).alias("_volume"),
            F.sum(orders).alias("_order"),
        )
    )
    amount = finite_or_null(F.col("_low") * F.col("_volume"))
    good = (F.col("_low") == F.col("_high")) & amount.isNotNull()
    return usable.select(
        *keys,
        F.when(good, F.col("_low")).alias("auction_price"),
        F.when(good, F.col("_volume")).otherwise(0.0).alias("auction_volume"),
        F.when(good, amount).otherwise(0.0).alias("auction_amount"),
        F.when(good, F.col("_order")).otherwise(0.0).alias("auction_order"),
        F.when(good, "derived").otherwise("inconsistent").alias("auction_status"),
    )


def minute_241_dates(bars: DataFrame, keys: Sequence[str] = ("market", "code")) -> DataFrame:
    """Days that have a 09:31 bar."""
    return bars.where(minute_of_day("ts") == 571).select(*keys, F.to_date("ts").alias("date")).distinct()


def latest_day(bars: DataFrame, keys: Sequence[str] = ("market", "code"), ts: str = "ts") -> DataFrame:
    """Rows of each series' newest calendar day (aggregate and join, not a window over
    the series)."""
    newest = bars.groupBy(*keys).agg(F.max(F.to_date(ts)).alias("_newest"))
    return (
        bars.join(newest, list(keys)).where(F.to_date(ts) == F.col("_newest")).select(*bars.columns)
    )


def build_minute_241(
    bars: DataFrame, ticks: DataFrame, multiplier: float = 100, zero_price: bool = False
) -> DataFrame:
    """Split the opening auction out of the 09:31 bar as a 09:30 bar.

    The auction must fit its bar, else both stay as they are and the inserted row has
    a NULL price.  OHLC of 09:31 cannot be recovered and is kept.  ``last`` defaults
    to the previous close, 0 at the start of the series.  Days with a 09:30 bar are
    left alone.  All joins are on (market, code, date).  ``zero_price``: prices of 0, and so
    amounts of 0, are as good as others.
    """
    keys = ["market", "code"]
    day_keys = [*keys, "date"]
    columns = bars.columns
    full = bars.withColumn("date", F.to_date("ts"))
    if "vol" not in columns:
        full = full.withColumn("vol", F.col("volume") if "volume" in columns else F.lit(0.0))
    if "volume" not in columns:
        full = full.withColumn("volume", F.col("vol"))
    for name in ("amount", "order"):
        if name not in columns:
            full = full.withColumn(name, F.lit(0.0))
    if "auction_status" not in columns:
        full = full.withColumn("auction_status", F.lit("not_applicable"))

    # One summary row per day carries all that a bar needs from outside its own row:
    # the close before the day, whether 09:30 exists, and the auction.
    minute = minute_of_day("ts")
    by_date = Window.partitionBy(*keys).orderBy("date")
    days = (
        full.groupBy(*day_keys)
        .agg(F.max_by("close", "ts").alias("_final"), F.bool_or(minute == 570).alias("_has_auction"))
        .withColumn("_before", F.lag("_final").over(by_date))
        .drop("_final")
        .join(
            auction_values(ticks, day_keys, multiplier, zero_price).withColumnRenamed("auction_status", "_auction_status"),
            day_keys,
            "left",
        )
    )
    joined = full.join(days, day_keys)
    if "last" not in columns:
        inside = Window.partitionBy(*day_keys).orderBy("ts")
        previous = F.when(F.row_number().over(inside) == 1, F.col("_before")).otherwise(
            F.lag("close").over(inside)
        )
        joined = joined.withColumn("last", F.coalesce(previous, F.lit(0.0)))

    number = {n: finite_or_null(n) for n in ("vol", "volume", "amount", "low", "high")}
    fits = (
        (number["vol"] > 0)
        & (number["volume"] > 0)
        & usable_price(number["amount"], zero_price)
        & usable_price(number["low"], zero_price)
        & (F.col("auction_volume") <= F.least(number["vol"], number["volume"]))
        & (F.col("auction_amount") <= number["amount"] + 0.01)
        & F.col("auction_price").between(number["low"], number["high"])
    )
    target = (minute == 571) & ~F.col("_has_auction")
    status = (
        F.when(F.col("_auction_status").isNull(), "missing")
        .when((F.col("_auction_status") == "derived") & F.coalesce(fits, F.lit(False)), "derived")
        .otherwise("inconsistent")
    )
    joined = joined.withColumn("_status", F.when(target, status))
    derived = F.coalesce(F.col("_status") == "derived", F.lit(False))
    taken = {
        "vol": "auction_volume",
        "volume": "auction_volume",
        "amount": "auction_amount",
        "order": "auction_order",
    }
    names = [n for n in full.columns if n != "date"] + ([] if "last" in columns else ["last"])
    kinds = {n: joined.schema[n].dataType for n in names}

    def first_bar(name: str) -> Column:
        if name == "last":
            return F.when(derived, F.col("auction_price")).otherwise(F.col("last"))
        if name in taken:
            rest = F.greatest(F.coalesce(F.col(name), F.lit(0.0)) - F.col(taken[name]), F.lit(0.0))
            return F.when(derived, rest).otherwise(F.col(name))
        return F.col(name)

    def auction_bar(name: str) -> Column:
        if name == "ts":
            return at_minute("date", F.lit(570))
        if name in ("open", "high", "low", "close"):
            return F.when(derived, F.col("auction_price"))
        if name in taken:
            return F.when(derived, F.col(taken[name])).otherwise(0.0)
        if name == "last":
            return F.coalesce(F.col("last"), F.lit(0.0))
        if name == "auction_status":
            return F.col("_status")
        if name == "hour":
            return F.lit(9)
        if name == "minute":
            return F.lit(30)
        return F.col(name)

    def typed(make) -> Column:
        return F.struct(*[make(n).cast(kinds[n]).alias(n) for n in names])

    pair = F.when(F.col("_status").isNotNull(), F.array(typed(auction_bar), typed(first_bar))).otherwise(
        F.array(typed(first_bar))
    )
    return joined.select(F.inline(pair))


def attach_minute_clock(
    points: DataFrame, keys: Sequence[str] = SERIES_DAY, order: str = "seq", strict: bool = True
) -> DataFrame:
    """Clock of ordered intraday points: the i-th is 09:31..11:30, then 13:01..15:00.

    More than 240 points is an error; without ``strict`` such rows get a NULL time.
    Positions come from the two-level scan over runs of the whole-number ``order``, so
    a series that is far too long fails, or is marked, without filling one task.
    """
    run = F.floor(F.col(order) / 65_536)
    placed = add_ordinal(points, keys, [order], run, "_position").withColumn("_position", F.col("_position") + 1)
    position = F.col("_position")
    minute = F.when(position <= 120, position + 570).when(position <= 240, position + 660)
    if strict:
        minute = F.coalesce(minute, F.raise_error(F.lit("more than 240 intraday points")).cast("int"))
    return placed.withColumn("ts", at_minute("date", minute)).drop("_position")
