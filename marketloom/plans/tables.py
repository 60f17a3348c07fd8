"""Market-data views of the driver's star-schema tables.

These only rename and rescale; every query built on them reads its tables whole.
Securities are suppliers on the Shenzhen A-share range ('00' + number), so that tick
volumes have a confirmed unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def security_code(number) -> Column:
    text = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.lit("00"), F.lpad(text, F.greatest(F.lit(4), F.length(text)), F.lit("0")))


def six_digits(number: Column) -> Column:
    """A code of six digits; a number that needs more is an error, never cut."""
    text = number.cast("string")
    return F.when(number < 1_000_000, F.lpad(text, 6, "0")).otherwise(F.raise_error(F.concat(F.lit("no six-digit code for "), text)))


def spread_code(number: Column) -> Column:
    """Six digits that differ for all numbers below a million and reach into all ranges;
    larger numbers are an error."""
    return F.when(number < 1_000_000, F.lpad((number * 7919 % 1_000_000).cast("string"), 6, "0")).otherwise(
        F.raise_error(F.concat(F.lit("no six-digit code for "), number.cast("string")))
    )


def market(value: int = 0) -> Column:
    return F.lit(value).alias("market")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticks: amount = 10 x extended price, side by return flag."""
    return table(spark, sf_dir, "lineitem").select(
        market(),
        security_code("l_suppkey").alias("code"),
        F.to_date("l_shipdate").alias("date"),
        _line_order().alias("seq"),
        (F.col("l_extendedprice") / F.col("l_quantity") / 10).alias("price"),
        F.col("l_quantity").alias("vol"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2).alias("side"),
    )


def _line_order() -> Column:
    """Source order of line items: order, line, then cents of the price, because
    (order, line) repeats.  Line and cents share a BIGINT (7 and 12 digits, overflow is an
    error), the order comes before them in a decimal that stays in hash aggregates."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    within = F.col("l_linenumber").cast("bigint") * 10**12 + cents
    order = F.col("l_orderkey").cast("decimal(19,0)") * F.lit(str(10**18)).cast("decimal(19,0)")
    return order + within.cast("decimal(19,0)")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: one row per security and ship date."""
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.select(
            "l_suppkey",
            F.to_date("l_shipdate").alias("date"),
            _line_order().alias("seq"),
            F.col("l_quantity").cast("bigint").alias("vol"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        )
        # Whole cents by integer division: no rounding ties between engines.
        .withColumn("price", F.expr("cents div vol") / 100)
        .groupBy("l_suppkey", "date")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("vol").cast("double").alias("volume"),
            (F.sum("cents") / 100).alias("amount"),
        )
        .select(market(), security_code("l_suppkey").alias("code"), "date", "open", "high", "low", "close", "volume", "amount")
    )


def timed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars stamped at midnight."""
    return bars(spark, sf_dir).withColumn("ts", F.col("date").cast("timestamp_ntz")).drop("date")


def supplier_count(spark: SparkSession, sf_dir: str) -> Column:
    """Number of suppliers, as a scalar sub-query."""
    return table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as corporate actions of a supplier."""
    number = F.col("o_custkey") % supplier_count(spark, sf_dir)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    high = F.col("o_orderpriority") == "2-HIGH"
    return table(spark, sf_dir, "orders").select(
        market(),
        security_code(number).alias("code"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("seq"),
        F.when(urgent, 1).when(high, 11).otherwise(5).alias("category"),
        F.when(urgent, (F.col("o_orderkey") % 50) / 1000).otherwise(0.0).alias("fenhong"),
        F.lit(0.0).alias("peigujia"),
        F.when(urgent, (F.col("o_orderkey") % 4) / 10).otherwise(0.0).alias("songzhuangu"),
        F.lit(0.0).alias("peigu"),
        F.when(high, 1 + (F.col("o_orderkey") % 3) / 100).otherwise(0.0).alias("suogu"),
        F.when(~urgent & ~high, F.round(F.col("o_totalprice") * 100)).alias("panhouliutong"),
        F.when(~urgent & ~high, F.round(F.col("o_totalprice") * 200)).alias("houzongguben"),
        F.lit("shares").alias("equity_unit"),
    )


def minute_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as minute ticks; the day is squeezed into the trading minutes 565-690
    and 780-900.  Some events are worth 0, which queries count as a price (``zero_price``)."""
    minute = F.hour("ts") * 60 + F.minute("ts")
    k = F.floor(minute * 247 / 1440).cast("int")
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        market(),
        security_code("user_id").alias("code"),
        F.to_date("ts").alias("date"),
        F.col("event_id").alias("seq"),
        F.when(k < 126, k + 565).otherwise(k + 654).alias("mod"),
        F.col("value").alias("price"),
        (F.col("event_id") % 7 + 1).alias("vol"),
        (F.col("event_id") % 3 + 1).alias("num"),
        F.when(kind == "view", 0)
        .when(kind == "purchase", 1)
        .when(kind == "click", 2)
        .when(kind == "signup", 5)
        .otherwise(8)
        .alias("side"),
    )


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 30-day range per order, by customer."""
    start = F.col("o_orderdate").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(
        market(),
        F.col("o_custkey").cast("string").alias("code"),
        start.alias("start"),
        (start + F.expr("interval 30 days")).alias("end"),
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a directory that spreads over all markets and number ranges, a million
    codes a market."""
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 3).cast("int").alias("market"),
        spread_code(F.expr("c_custkey div 3")).alias("code"),
        F.concat(
            F.col("c_name"), F.when(F.col("c_mktsegment") == "MACHINERY", "etf").otherwise("")
        ).alias("name"),
        F.col("c_custkey").alias("seq"),
    )


def sector_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the sectors of their nation and of their region."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select(
            market(),
            security_code("s_suppkey").alias("code"),
            F.col("s_suppkey").alias("seq"),
            F.explode(F.array("n_name", "r_name")).alias("sector"),
        )
    )


def text(column) -> Column:
    """Dates and timestamps leave queries as text, the same in every engine."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def exact(value, digits: int) -> Column:
    """Decimal rounding for output, so exact half-way values agree between engines."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def rounded(digits: int = 6, *names: str) -> list[Column]:
    return [exact(n, digits).alias(n) for n in names]
