"""Fixed names and codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.numbers import as_column

# Corporate-action categories.
CATEGORY_NAMES = {
    1: "除权除息",
    2: "送配股上市",
    3: "非流通股上市",
    4: "未知股本变动",
    5: "股本变化",
    6: "增发新股",
    7: "股份回购",
    8: "增发新股上市",
    9: "转配股上市",
    10: "可转债上市",
    11: "扩缩股",
    12: "非流通股缩股",
    13: "送认购权证",
    14: "送认沽权证",
}

# Categories that carry a share-capital record.
EQUITY_CATEGORIES = [2, 3, 5, 7, 8, 9, 10]

# Bar frequencies; the position is the numeric code.
FREQUENCIES = ["5m", "15m", "30m", "1h", "days", "week", "mon", "ex_1m", "1m", "day", "3mon", "year"]
FREQUENCY_ALIASES = {"daily": "day", "1d": "day", "monthly": "mon", "weekly": "week"}

# The seven flow levels, largest tier first, then the three roll-ups.
FLOW_TIERS = ["超大单", "大单", "中单", "小单"]
FLOW_MAIN = "主力(超大+大单)"
FLOW_RETAIL = "散户(中+小单)"
FLOW_TOTAL = "合计"


def category_name(category) -> Column:
    category = as_column(category)
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(CATEGORY_NAMES.items())])
    return F.coalesce(F.try_element_at(names, category.cast("int")), category.cast("string"))


def frequency_code(value: int | str) -> int:
    """Numeric frequency of a parameter given as name, alias or number."""
    if isinstance(value, str):
        name = value.strip().lower()
        name = FREQUENCY_ALIASES.get(name, name)
        if name in FREQUENCIES:
            return FREQUENCIES.index(name)
    elif isinstance(value, int) and not isinstance(value, bool) and 0 <= value < len(FREQUENCIES):
        return value
    raise ValueError(f"unsupported bar frequency: {value!r}")


def frequency_column(value) -> Column:
    """Numeric frequency of a column of names, aliases or numbers; NULL if there is none."""
    names = {**{n: i for i, n in enumerate(FREQUENCIES)}, **{a: FREQUENCIES.index(n) for a, n in FREQUENCY_ALIASES.items()}}
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    text = F.lower(F.trim(as_column(value).cast("string")))
    number = text.try_cast("int")
    return F.coalesce(F.try_element_at(table, text), F.when(number.between(0, len(FREQUENCIES) - 1), number))
