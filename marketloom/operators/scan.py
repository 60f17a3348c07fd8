"""Ordered computations that never hold a whole key in one task.

A running value over a long series is split in two levels: windows inside
(keys, chunk), and a window over one summary row per (keys, chunk) that gives each
chunk what came before it.  ``chunk`` must grow with the order (a month, a day), so
a key with a third of all rows is spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def before(keys: Sequence[str], order) -> Window:
    """All earlier summary rows of a key."""
    return (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def add_ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], chunk: Column, name: str
) -> DataFrame:
    """0-based position of each row within its key."""
    keys = list(keys)
    chunked = df.withColumn("_chunk", chunk)
    offsets = (
        chunked.groupBy(*keys, "_chunk")
        .count()
        .select(
            *keys,
            "_chunk",
            F.coalesce(F.sum("count").over(before(keys, "_chunk")), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (
        chunked.join(offsets, [*keys, "_chunk"])
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_offset")
    )


def add_running_max_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, chunk: Column, name: str
) -> DataFrame:
    """Largest ``value`` of the rows before each row in its key (NULL for the first)."""
    keys = list(keys)
    chunked = df.withColumn("_chunk", chunk)
    carried = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.max(value).alias("_top"))
        .select(*keys, "_chunk", F.max("_top").over(before(keys, "_chunk")).alias("_carried"))
    )
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.join(carried, [*keys, "_chunk"])
        .withColumn(name, F.greatest(F.col("_carried"), F.max(value).over(inside)))
        .drop("_chunk", "_carried")
    )


def add_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    chunk: Column,
    name: str,
) -> DataFrame:
    """``value`` of the row before each row in its key, across chunk borders."""
    keys = list(keys)
    chunked = df.withColumn("_chunk", chunk)
    carried = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.max_by(value, order).alias("_final"))
        .select(
            *keys,
            "_chunk",
            F.lag("_final").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carried"),
        )
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    return (
        chunked.join(carried, [*keys, "_chunk"])
        .withColumn(
            name,
            F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(
                F.lag(value).over(inside)
            ),
        )
        .drop("_chunk", "_carried")
    )


def _chunk_window(keys: Sequence[str], order: Sequence[Column | str], reverse: bool) -> Window:
    named = [F.col(c) if isinstance(c, str) else c for c in order]
    return Window.partitionBy(*keys, "_chunk").orderBy(*[c.desc() if reverse else c for c in named])


def _chunk_order(keys: Sequence[str], reverse: bool) -> Window:
    """Summary rows of a key that lie before a chunk (behind it, in reverse)."""
    return before(keys, F.col("_chunk").desc() if reverse else F.col("_chunk"))


def add_running_product(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, chunk: Column, name: str, reverse: bool = False
) -> DataFrame:
    """Product of ``value`` from the first row of a key through each row, or from each row
    through the last (``reverse``).  Multiplications compose, so the product of a chunk is all
    that other chunks need of it.  A NULL value is left out."""
    keys = list(keys)
    chunked = df.withColumn("_chunk", chunk)
    through = _chunk_window(keys, order, reverse).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = chunked.withColumn("_through", F.coalesce(F.product(value).over(through), F.lit(1.0)))
    # A chunk's product is its last running one: the order of multiplication stays fixed.
    furthest = F.min_by if reverse else F.max_by
    carried = (
        running.groupBy(*keys, "_chunk")
        .agg(furthest("_through", F.struct(*order)).alias("_whole"))
        .select(*keys, "_chunk", F.coalesce(F.product("_whole").over(_chunk_order(keys, reverse)), F.lit(1.0)).alias("_carried"))
    )
    return (
        running.join(carried, [*keys, "_chunk"])
        .withColumn(name, F.col("_through") * F.col("_carried"))
        .drop("_chunk", "_through", "_carried")
    )


def fill_forward(df: DataFrame, keys: Sequence[str], order: str, names: Sequence[str], chunk: Column) -> DataFrame:
    """Columns with NULLs replaced by the last value before them in their key.  ``order`` is
    unique in a key."""
    keys, names = list(keys), list(names)
    chunked = df.withColumn("_chunk", chunk)
    earlier = _chunk_order(keys, False)
    final = chunked.groupBy(*keys, "_chunk").agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(order))).alias(f"_final_{n}") for n in names]
    )
    carried = final.select(*keys, "_chunk", *[F.last(f"_final_{n}", ignorenulls=True).over(earlier).alias(f"_carried_{n}") for n in names])
    so_far = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {n: F.coalesce(F.last(n, ignorenulls=True).over(so_far), F.col(f"_carried_{n}")) for n in names}
    return chunked.join(carried, [*keys, "_chunk"]).withColumns(filled).select(*df.columns)


def add_following(df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column, name: str) -> DataFrame:
    """``value`` of the row after each row in its key, across chunk borders (NULL for the last)."""
    keys = list(keys)
    chunked = df.withColumn("_chunk", chunk)
    carried = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.min_by(value, order).alias("_initial"))
        .select(*keys, "_chunk", F.lead("_initial").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carried"))
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    last = F.row_number().over(_chunk_window(keys, [order], True)) == 1
    return (
        chunked.join(carried, [*keys, "_chunk"])
        .withColumn(name, F.when(last, F.col("_carried")).otherwise(F.lead(value).over(inside)))
        .drop("_chunk", "_carried")
    )


def rows_between(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column, start: int, stop: int, newest_first: bool = False
) -> DataFrame:
    """Rows at positions ``start`` .. ``stop - 1`` of each key in ``order``.  ``chunk`` grows
    with the order, or falls with it (``newest_first``).

    Counts per (key, chunk) say which chunks reach into the page; only their rows are
    ordered, so neither a long series nor a deep page comes together in one task.
    """
    keys = list(keys)
    chunked = df.withColumn("_chunk", chunk)
    ahead = Window.partitionBy(*keys).orderBy(F.col("_chunk").desc() if newest_first else F.col("_chunk"))
    counts = chunked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    placed = counts.withColumn("_offset", F.sum("_rows").over(ahead) - F.col("_rows"))
    reached = placed.where((F.col("_offset") < stop) & (F.col("_offset") + F.col("_rows") > start)).drop("_rows")
    position = F.col("_offset") + F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*order)) - 1
    same = [chunked[c].eqNullSafe(reached[c]) for c in [*keys, "_chunk"]]
    joined = chunked.join(reached, same).select(chunked["*"], reached["_offset"])
    return (
        joined.withColumn("_position", position)
        .where((F.col("_position") >= start) & (F.col("_position") < stop))
        .drop("_chunk", "_offset", "_position")
    )


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Written as ``row_number() = 1`` so Spark's window group limit cuts each mapper to
    one row per key before the shuffle, however many copies a key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
