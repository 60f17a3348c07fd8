"""Row-level trade rules: order-size tiers, futures trade nature, auction records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.labels import FLOW_TIERS
from marketloom.functions.numbers import as_column, half_up

DEFAULT_THRESHOLDS = (40_000.0, 200_000.0, 1_000_000.0)
BUY, SELL, NEUTRAL = 0, 1, 2


def order_tier(amount, thresholds: Sequence[float] = DEFAULT_THRESHOLDS, closed: str = "right") -> Column:
    """Tier name by trade amount.

    ``closed='right'``: an amount equal to a threshold stays in the lower tier
    (exactly 1,000,000 is 大单).  ``'left'`` moves it up.
    """
    amount = as_column(amount)
    small, medium, large = (float(x) for x in thresholds)
    super_name, large_name, medium_name, small_name = FLOW_TIERS

    def above(limit: float) -> Column:
        return amount > limit if closed == "right" else amount >= limit

    return (
        F.when(above(large), super_name)
        .when(above(medium), large_name)
        .when(above(small), medium_name)
        .when(amount.isNotNull(), small_name)
    )


def trade_nature(market, volume, position_change, nature) -> tuple[Column, Column, Column]:
    """(direction, label, second) of a futures trade.

    The encoded nature holds the aggressor in its ten-thousands and the second
    in the rest.  Every row stands alone: an unmatched case is always 换手.
    """
    market, volume = as_column(market), as_column(volume).cast("bigint")
    change, nature = as_column(position_change).cast("bigint"), as_column(nature).cast("int")
    aggressor = F.floor(nature / 10_000)
    other = "换手"

    def label(opened: str, both_opened: str, turned: str, both_closed: str, closed: str, loose_close: bool):
        grew = F.when(volume > change, opened).when(volume == change, both_opened).otherwise(other)
        if loose_close:
            shrank = F.when(volume == -change, both_closed).otherwise(closed)
        else:
            shrank = F.when(volume > -change, closed).when(volume == -change, both_closed).otherwise(other)
        return F.when(change > 0, grew).when(change == 0, turned).otherwise(shrank)

    name = (
        F.when(aggressor == 0, label("多开", "双开", "多换", "双平", "空平", True))
        .when(aggressor == 1, label("空开", "双开", "空换", "双平", "多平", True))
        .otherwise(label("开仓", "双开", other, "双平", "平仓", False))
    )
    direction = F.when(aggressor == 0, 1).when(aggressor == 1, -1).otherwise(0)
    stock_option = market.isin(31, 48)
    direction = F.when(
        stock_option, F.when(nature == 0, 1).when(nature == 256, -1).otherwise(0)
    ).otherwise(direction)
    name = F.when(
        stock_option, F.when(nature == 0, "B").when(nature == 256, "S").otherwise("")
    ).otherwise(name)
    second = nature % 10_000
    return direction, name, F.when(second > 59, 0).otherwise(second)


def auction_fields(price, signed_unmatched) -> tuple[Column, Column, Column]:
    """(price, unmatched, flag) of a call-auction record."""
    unmatched = as_column(signed_unmatched)
    return (
        half_up(as_column(price).cast("double"), 3),
        F.abs(unmatched),
        F.when(unmatched < 0, -1).otherwise(1),
    )
