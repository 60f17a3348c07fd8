"""Explicit schemas of the engine's tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "TINYINT": T.ByteType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """'name TYPE, ...' without a session (schemas are built at import)."""
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SECURITY_KEY = ["market", "code"]

BARS = _struct(
    "market TINYINT, code STRING, ts TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE, amount DOUBLE"
)

STORED_BARS = _struct(
    "market STRING, code STRING, frequency STRING, adjustment STRING, ts TIMESTAMP_NTZ, "
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, amount DOUBLE, "
    "turnover DOUBLE, float_stock DOUBLE, total_stock DOUBLE, source STRING, "
    "volume_unit STRING, timezone STRING, is_approximate BOOLEAN"
)

COVERAGE = _struct(
    "market STRING, code STRING, frequency STRING, adjustment STRING, "
    "start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, source STRING, is_approximate BOOLEAN"
)

# ``seq`` is the source order: minute-resolution ticks have ties.
TICKS = _struct(
    "market TINYINT, code STRING, date DATE, seq BIGINT, time STRING, price DOUBLE, vol BIGINT, "
    "num BIGINT, side INT"
)

ACTIONS = _struct(
    "market TINYINT, code STRING, date DATE, seq BIGINT, category INT, fenhong DOUBLE, "
    "peigujia DOUBLE, songzhuangu DOUBLE, peigu DOUBLE, suogu DOUBLE, panqianliutong DOUBLE, "
    "panhouliutong DOUBLE, qianzongguben DOUBLE, houzongguben DOUBLE, fenshu DOUBLE, "
    "xingquanjia DOUBLE, equity_unit STRING"
)

ACTION_NUMBERS = [
    "fenhong", "peigujia", "songzhuangu", "peigu", "suogu", "panqianliutong", "panhouliutong",
    "qianzongguben", "houzongguben", "fenshu", "xingquanjia",
]

AUCTION = _struct(
    "market TINYINT, code STRING, ts TIMESTAMP_NTZ, seq BIGINT, price DOUBLE, matched BIGINT, "
    "unmatched BIGINT, flag INT"
)

DIRECTORY = _struct(
    "market TINYINT, code STRING, name STRING, volunit INT, decimal_point INT, pre_close DOUBLE"
)

INDUSTRY_COLUMNS = [
    "tdx_industry_code", "tdx_industry_name", "tdx_industry_source",
    "sw_industry_code", "sw_industry_name", "sw_industry_source",
    "sw_level1_code", "sw_level1_name", "sw_level2_code", "sw_level2_name",
    "sw_level3_code", "sw_level3_name",
]

SUMMARY_COLUMNS = [
    "full_code", "exchange", "market_id", "code", "name", "category", "board",
    "last_price", "pre_close_price", "open_price", "high_price", "low_price",
    "change", "change_pct", "volume_hand", "amount", "open_amount_yuan",
    "circulating_shares", "total_shares", "turnover_rate",
    "circulating_market_value", "total_market_value", "eps", "ipo_date", "updated_date",
    *INDUSTRY_COLUMNS,
]
