"""The 37-column security summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numbers import finite_or_null
from marketloom.functions.symbols import category_and_board, exchange_name, market_id, six_digits
from marketloom.functions.times import parse_date
from marketloom.operators.equity import equity_snapshot
from marketloom.operators.scan import keep_latest
from marketloom.schemas import INDUSTRY_COLUMNS, SUMMARY_COLUMNS

KEY = ["market", "code"]
# Earnings-per-share fields, first present one is used.
_EPS_FIELDS = ["eps", "basic_eps", "diluted_eps", "meigushouyi"]


def _prefixed(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.select(*KEY, *[F.col(n).alias(prefix + n) for n in frame.columns if n not in KEY])


def _one_per_key(frame: DataFrame, order: str | None, first: bool = True) -> DataFrame:
    """One row per key: the first (or last) in ``order``; where there is none, any row, but
    always the same."""
    if order is None:
        ranking = F.xxhash64(*[n for n in frame.columns if n not in KEY])
    else:
        ranking = F.col(order).asc() if first else F.col(order).desc()
    return keep_latest(frame, KEY, [ranking])


def latest_auction(auctions: DataFrame, zero_price: bool = False) -> DataFrame:
    """Opening amount of the last usable auction record (Shanghai and Shenzhen); a price of 0
    is unusable unless ``zero_price``."""
    price, matched = finite_or_null("price"), finite_or_null("matched")
    return (
        auctions.where(F.col("market").isin(0, 1) & (price >= 0 if zero_price else price > 0) & (matched >= 0))
        .groupBy(*KEY)
        .agg(F.max_by(price * matched * 100.0, F.col("seq")).alias("open_amount_yuan"))
    )


def security_summary(
    requested: DataFrame,
    directory: DataFrame,
    quotes: DataFrame,
    industries: DataFrame,
    finance: DataFrame,
    actions: DataFrame,
    auctions: DataFrame,
    zero_price: bool = False,
) -> DataFrame:
    """One row per requested (pos, market, code), in request order with repeats.

    Facts are looked up once per distinct security and joined back, so repeated
    requests cost nothing.  A quote without its market is used by bare code only
    where that code is unique among the quotes.  ``directory``: the last row per
    security counts, and so for ``quotes`` and ``finance`` (by ``seq`` if present).
    """
    wanted = requested.select(*KEY).distinct()
    seq = lambda frame: "seq" if "seq" in frame.columns else None

    securities = _one_per_key(
        directory.withColumn("code", six_digits("code")).where(F.col("code").isNotNull()),
        seq(directory),
        first=False,
    )
    priced = quotes.withColumn("code", six_digits("code")).withColumn("market", market_id("market"))
    volume = "vol" if "vol" in quotes.columns else "volume"
    fields = ["price", "last_close", "open", "high", "low", volume, "amount"]
    priced = priced.where(F.col("code").isNotNull()).select(
        *KEY, *fields, *([seq(quotes)] if seq(quotes) else [])
    )
    by_market = _one_per_key(priced.where(F.col("market").isNotNull()), seq(quotes), first=False)
    by_code = (
        priced.groupBy("code")
        # Of the one row there is, any aggregate gives the value.
        .agg(F.count(F.lit(1)).alias("_copies"), *[F.max(n).alias(n) for n in fields])
        .where("_copies = 1")
        .select("code", F.struct(*fields).alias("_only"))
    )
    money = _one_per_key(finance, seq(finance))
    equity = equity_snapshot(actions).select(*KEY, "float_equity", "total_equity")
    sectors = _one_per_key(industries.select(*KEY, *INDUSTRY_COLUMNS), None)

    q = F.coalesce(F.col("_quote"), F.col("_only"))
    facts = (
        wanted.join(_prefixed(securities, "_s_"), KEY, "left")
        .join(by_market.select(*KEY, F.struct(*fields).alias("_quote")), KEY, "left")
        .join(by_code, "code", "left")
        .join(sectors, KEY, "left")
        .join(_prefixed(money, "_f_"), KEY, "left")
        .join(equity, KEY, "left")
        .join(latest_auction(auctions, zero_price), KEY, "left")
        .withColumn("_q", q)
    )

    def quoted(name: str) -> Column:
        return finite_or_null(F.col(f"_q.{name}"))

    def reported(name: str) -> Column:
        return F.col(f"_f_{name}") if name in finance.columns else F.lit(None)

    def whole(own: str, fallback: str) -> Column:
        value = F.coalesce(
            F.when(F.col(own) > 0, F.col(own).cast("double")), finite_or_null(reported(fallback))
        )
        return F.when(value > 0, value.cast("bigint"))

    eps_field = next((n for n in _EPS_FIELDS if n in finance.columns), None)
    category, board = category_and_board("market", "code", "_s_name")
    facts = facts.select(
        *KEY,
        F.concat(exchange_name("market"), "code").alias("full_code"),
        exchange_name("market").alias("exchange"),
        F.col("market").alias("market_id"),
        F.col("_s_name").alias("name"),
        category.alias("category"),
        board.alias("board"),
        quoted("price").alias("last_price"),
        quoted("last_close").alias("pre_close_price"),
        quoted("open").alias("open_price"),
        quoted("high").alias("high_price"),
        quoted("low").alias("low_price"),
        quoted(volume).alias("volume_hand"),
        quoted("amount").alias("amount"),
        "open_amount_yuan",
        whole("float_equity", "liutongguben").alias("circulating_shares"),
        whole("total_equity", "zongguben").alias("total_shares"),
        (finite_or_null(reported(eps_field)) if eps_field else F.lit(None).cast("double")).alias("eps"),
        F.date_format(parse_date(reported("ipo_date").cast("string")), "yyyy-MM-dd").alias("ipo_date"),
        F.date_format(parse_date(reported("updated_date").cast("string")), "yyyy-MM-dd").alias("updated_date"),
        *INDUSTRY_COLUMNS,
    )
    price, previous = F.col("last_price"), F.col("pre_close_price")
    facts = facts.withColumns(
        {
            "change": price - previous,
            "change_pct": F.when(previous > 0, (price - previous) / previous * 100.0),
            "turnover_rate": F.when(
                F.col("volume_hand") >= 0, F.col("volume_hand") * 100.0 / F.col("circulating_shares") * 100.0
            ),
            "circulating_market_value": F.when(price >= 0, price * F.col("circulating_shares")),
            "total_market_value": F.when(price >= 0, price * F.col("total_shares")),
        }
    )
    return requested.select("pos", *KEY).join(facts, KEY).select("pos", *SUMMARY_COLUMNS).orderBy("pos")
