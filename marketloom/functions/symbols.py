"""Security identity: symbols, markets, classes and unit coefficients.

Markets are 0 = Shenzhen, 1 = Shanghai, 2 = Beijing.  All rules are ordered CASE
expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numbers import as_column

SZ, SH, BJ = 0, 1, 2

_SYMBOL = r"^(?:(SH|SZ|BJ)[.#]?)?([0-9A-Z]+)$"

# Number ranges of the exchanges, used to infer a market.
_SH_HEADS = ["60", "68", "50", "51", "52", "56", "58", "110", "113", "132", "204", "90"]
_SZ_HEADS = ["00", "12", "13", "15", "16", "18", "20", "30", "39"]

# Directory classes.
SECURITY_CLASSES = ["a_stock", "b_stock", "index", "etf", "fund", "bond", "other"]

# Price coefficient of each fine security type.
PRICE_COEFFICIENTS = {
    "SH_A_STOCK": 0.01, "SH_B_STOCK": 0.001, "SH_INDEX": 0.01, "SH_FUND": 0.001, "SH_BOND": 0.001,
    "SZ_A_STOCK": 0.01, "SZ_B_STOCK": 0.01, "SZ_INDEX": 0.01, "SZ_FUND": 0.001, "SZ_BOND": 0.001,
    "BJ_A_STOCK": 0.01, "BJ_INDEX": 0.01,
}

# Types whose tick volume is in lots of 100.
LOT_TYPES = ["SH_A_STOCK", "SZ_A_STOCK", "BJ_A_STOCK", "SH_FUND", "SZ_FUND"]


def starts_with_any(value: Column, heads: Iterable[str]) -> Column:
    """One pattern test, so ``value`` is evaluated once."""
    return value.rlike("^(?:" + "|".join(heads) + ")")


def _by_head(market: Column, code: Column, table: dict[str, list[str]]) -> Column:
    """Look '<market><first two digits>' up in a small fixed table (one literal map, so
    the generated code stays short)."""
    pairs = [F.lit(x) for name, heads in table.items() for head in heads for x in (head, name)]
    key = F.concat(market.cast("string"), F.substring(code, 1, 2))
    return F.try_element_at(F.create_map(*pairs), key)


def _clean(symbol) -> Column:
    return F.upper(F.trim(as_column(symbol)))


def symbol_prefix(symbol) -> Column:
    """'SH', 'SZ', 'BJ' or NULL."""
    return F.nullif(F.regexp_extract(_clean(symbol), _SYMBOL, 1), F.lit(""))


def bare_code(symbol) -> Column:
    """Code without its market prefix; NULL where the symbol is malformed."""
    return F.nullif(F.regexp_extract(_clean(symbol), _SYMBOL, 2), F.lit(""))


def require(value: Column, valid: Column, message: str) -> Column:
    """Strict mode: fail the task on a bad row instead of returning NULL."""
    return F.when(valid, value).otherwise(F.raise_error(F.lit(message)))


def exchange_name(market) -> Column:
    market = as_column(market)
    return F.when(market == SZ, "sz").when(market == SH, "sh").when(market == BJ, "bj")


def market_id(value) -> Column:
    """Market number of '0'..'2' or 'sz'/'sh'/'bj' in any case."""
    text = F.lower(F.trim(as_column(value).cast("string")))
    return (
        F.when(text.isin("0", "sz"), SZ).when(text.isin("1", "sh"), SH).when(text.isin("2", "bj"), BJ)
    )


def infer_market(symbol) -> Column:
    """Explicit prefix first, then number ranges; the order of the tests matters."""
    prefix, code = symbol_prefix(symbol), bare_code(symbol)
    return (
        F.when(code.isNull(), F.lit(None))
        .when(prefix.isNotNull(), market_id(prefix))
        .when(code.startswith("920"), BJ)
        .when(starts_with_any(code, _SH_HEADS), SH)
        .when(code.startswith("1318"), SZ)
        .when(F.substring(code, 1, 2).isin(_SZ_HEADS), SZ)
        .when(starts_with_any(code, ["4", "8"]), BJ)
        .otherwise(SZ)
    )


def infer_index_market(symbol, market=None) -> Column:
    prefix, code = symbol_prefix(symbol), bare_code(symbol)
    explicit = F.lit(None).cast("int") if market is None else market_id(market)
    inferred = (
        F.when(code.isNull(), F.lit(None))
        .when(code.startswith("89"), BJ)
        .when(starts_with_any(code, ["00", "88", "99"]), SH)
        .otherwise(SZ)
    )
    return F.coalesce(explicit, market_id(prefix), inferred)


def six_digits(value) -> Column:
    """Digits only, '.0' tail dropped, zero-padded to six; otherwise NULL."""
    text = F.regexp_replace(F.trim(as_column(value).cast("string")), r"^([0-9]+)\.0$", "$1")
    return F.when(
        text.rlike("^[0-9]+$"),
        F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text),
    )


def strip_exchange(value) -> Column:
    """Lower-cased code without one leading sh/sz/bj."""
    return F.regexp_replace(F.lower(F.trim(as_column(value))), r"^(sh|sz|bj)", "")


def action_code(value) -> Column:
    """Code spelling used to match corporate actions."""
    text = F.regexp_replace(F.upper(F.trim(as_column(value).cast("string"))), r"\.", "")
    text = F.regexp_replace(text, r"^(SH|SZ|BJ)", "")
    return F.when(text.rlike("^[0-9]+$") & (F.length(text) < 6), F.lpad(text, 6, "0")).otherwise(text)


# Directory class by market digit and first two digits of the code.
_CLASS_HEADS = {
    "a_stock": ["000", "030", "160", "168"],
    "b_stock": ["020", "190"],
    "index": ["039", "100", "188", "199"],
    "etf": ["151", "156"],
    "bond": [
        "010", "011", "012", "013", "014",
        "101", "102", "110", "111", "112", "113", "114", "115", "116", "117", "118", "119", "120",
    ],
    "fund": ["015", "016", "018", "150", "152", "158"],
}
_ETF_RANGES = ["0159", "1588", "1589"]

# Fine type by market digit and first two digits of the code.
_TYPE_HEADS = {
    "SZ_A_STOCK": ["000", "030"],
    "SZ_B_STOCK": ["020"],
    "SZ_INDEX": ["039"],
    "SZ_FUND": ["015", "016", "018"],
    "SZ_BOND": ["010", "011", "012", "013", "014"],
    "SH_A_STOCK": ["160", "168"],
    "SH_B_STOCK": ["190"],
    "SH_INDEX": ["100", "188", "199"],
    "SH_FUND": ["150", "151", "152", "156", "158"],
    "SH_BOND": ["101", "110", "111", "112", "113", "114", "120"],
}


def _padded(code: Column) -> Column:
    text = F.trim(code.cast("string"))
    return F.when(text.rlike("^[0-9]{1,5}$"), F.lpad(text, 6, "0")).otherwise(text)


def classify_security(market, code, name) -> Column:
    """One of the seven directory classes.  A name holding ETF outranks bond/fund ranges,
    but not stock and index ranges."""
    market, code = as_column(market), _padded(as_column(code))
    base = _by_head(market, code, _CLASS_HEADS)
    etf = (
        F.coalesce(base == "etf", F.lit(False))
        | F.concat(market.cast("string"), F.substring(code, 1, 3)).isin(_ETF_RANGES)
        | F.coalesce(F.upper(as_column(name)), F.lit("")).contains("ETF")
    )
    return (
        F.when(market == BJ, F.when(code.startswith("89"), "index").otherwise("a_stock"))
        .when(~market.isin(SZ, SH), F.lit(None))
        .when(base.isin("a_stock", "b_stock", "index"), base)
        .when(etf, "etf")
        .when(market.isNotNull(), F.coalesce(base, F.lit("other")))
    )


def security_type(market, code) -> Column:
    """Fine type such as SH_A_STOCK; NULL where no rule applies."""
    market, code = as_column(market), as_column(code).cast("string")
    return (
        F.when(market.isin(SZ, SH), _by_head(market, code, _TYPE_HEADS))
        .when((market == BJ) & code.rlike("^89[0-9]{4}$"), "BJ_INDEX")
        .when((market == BJ) & code.rlike("^(920[0-9]{3}|[48][0-9]{5})$"), "BJ_A_STOCK")
    )


def category_and_board(market, code, name) -> tuple[Column, Column]:
    market, code = as_column(market), as_column(code)
    kind = classify_security(market, code, name)
    category = F.regexp_replace(kind, "^([ab])_stock$", "$1_share")
    padded = _padded(code)
    board = (
        F.when((market == BJ) & ~padded.startswith("89"), "北交所")
        .when((market == SZ) & padded.rlike("^30[01]"), "创业板")
        .when((market == SH) & padded.rlike("^68[89]"), "科创板")
        .when((market == SZ) & padded.rlike("^(?:00|30)"), "主板")
        .when((market == SH) & padded.rlike("^6[08]"), "主板")
    )
    return category, board


def price_coefficient(market, code) -> Column:
    """Quote price unit; 0.01 where the type is unknown."""
    kind = security_type(market, code)
    milli = [name for name, unit in PRICE_COEFFICIENTS.items() if unit == 0.001]
    return F.when(kind.isin(milli), 0.001).otherwise(0.01)


def tick_coefficient(market, code) -> Column:
    """Tick price unit: bonds use three decimals."""
    kind = security_type(market, code)
    return F.when(F.coalesce(kind.endswith("_BOND"), F.lit(False)), 0.001).otherwise(
        price_coefficient(market, code)
    )


def volume_multiplier(market, code, strict: bool = False) -> Column:
    """Shares per tick volume unit: 100 for the types where that is confirmed.

    Others are rejected: an error in strict mode, NULL otherwise (such ticks then
    count as excluded).  Runs on every tick, so it is one set test rather than a
    lookup of the type.
    """
    market, code = as_column(market), as_column(code).cast("string")
    heads = [head for name in LOT_TYPES for head in _TYPE_HEADS.get(name, [])]
    beijing = (market == BJ) & (security_type(market, code) == "BJ_A_STOCK")
    listed = F.concat(market.cast("string"), F.substring(code, 1, 2)).isin(heads)
    known = F.coalesce(listed | beijing, F.lit(False))
    if strict:
        return require(F.lit(100), known, "tick volume unit is not confirmed for this security")
    return F.when(known, F.lit(100))


def split_extended_symbol(symbol, market=None) -> tuple[Column, Column]:
    """(market, code) of '47#IFL0'; a given market wins and leaves the symbol whole."""
    symbol = as_column(symbol)
    tagged = symbol.contains("#")
    tag, tail = F.split_part(symbol, F.lit("#"), F.lit(1)), F.split_part(symbol, F.lit("#"), F.lit(2))
    if market is None:
        return F.when(tagged, tag.try_cast("int")), F.when(tagged, tail).otherwise(symbol)
    given = as_column(market).cast("string").try_cast("int")
    has = F.coalesce(given != 0, F.lit(False))
    return (
        F.when(has, given).when(tagged, tag.try_cast("int")),
        F.when(~has & tagged, tail).otherwise(symbol),
    )


def normalize_index_quotes(quotes: DataFrame) -> DataFrame:
    """Index snapshots carry advance/decline counts in the first book level; move
    them out, blank the book, and drop wire-only columns."""
    kind = security_type("market", "code")
    is_index = F.coalesce(kind.endswith("_INDEX"), F.lit(False))
    counted = is_index & (kind != "BJ_INDEX")
    book = [f"{side}{level}" for level in range(1, 6) for side in ("bid", "ask", "bid_vol", "ask_vol")]
    out = []
    for name in quotes.columns:
        if name in ("active1", "active2") or name.startswith("reversed_bytes"):
            continue
        out.append(F.when(~is_index, F.col(name)).alias(name) if name in book else F.col(name))
    counts = [
        F.when(counted, F.col(source)).alias(target)
        for source, target in (("bid_vol1", "up_count"), ("ask_vol1", "down_count"))
        if source in quotes.columns
    ]
    return quotes.select(*out, *counts)
