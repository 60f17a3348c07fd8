"""As-of lookup as an equi-join.

The right side (events, factors, gaps) is cut into time buckets.  Each bucket row
holds its few entries as a sorted array plus the value carried in from outside the
bucket, and empty buckets between two entries are filled in.  The left side then
needs one equi-join on (keys, bucket) and a look into a short array: no union, no
sort and no window over the left rows, so a hot key on the left is an ordinary
skewed join that AQE can split, and a small right side is broadcast by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BACKWARD, FORWARD = "backward", "forward"


def time_bucket(time: Column, unit: str) -> Column:
    """Consecutive integers for calendar centuries, months, days or hours."""
    if unit == "century":
        return F.floor(F.year(time) / 100)
    if unit == "month":
        return F.year(time) * 12 + F.month(time)
    days = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date"))
    if unit == "day":
        return days
    if unit == "hour":
        return days * 24 + F.hour(time)
    raise ValueError(f"unsupported bucket: {unit!r}")


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    *,
    direction: str = BACKWARD,
    strict: bool = False,
    bucket: str = "month",
    prefix: str = "",
    spans: bool = False,
) -> DataFrame:
    """Add the right row's ``values`` that is nearest in time to each left row.

    ``backward`` takes the latest right row at or before the left time, ``forward``
    the earliest at or after it; ``strict`` excludes equal times.  The matched row
    wins even where its values are NULL.  ``right`` must hold one row per (keys,
    right_time), so an array never outgrows the distinct times of one bucket.

    ``spans`` promises that each key's right rows reach over its left rows on the open
    side (a last row after them when looking forward, with one at or before their
    first, and the reverse backward); the join for the range's edge is then left out.
    """
    if direction not in (BACKWARD, FORWARD):
        raise ValueError(f"unsupported direction: {direction!r}")
    keys, values = list(keys), list(values)
    backward = direction == BACKWARD

    entry = F.struct(F.col(right_time).alias("t"), F.struct(*values).alias("v"))
    slices = (
        right.where(F.col(right_time).isNotNull())
        .groupBy(*keys, time_bucket(F.col(right_time), bucket).alias("_bucket"))
        .agg(F.array_sort(F.collect_list(entry)).alias("_slice"))
    )
    # One row per key and bucket from here on.
    order = Window.partitionBy(*keys).orderBy(F.col("_bucket") if backward else F.col("_bucket").desc())
    nearest = F.element_at("_slice", -1 if backward else 1)["v"]
    step = 1 if backward else -1
    following = F.lead("_bucket").over(order) - step
    filled = (
        slices.select(
            *keys,
            "_bucket",
            "_slice",
            nearest.alias("_own"),
            F.lag(nearest).over(order).alias("_before"),
            F.coalesce(following, F.col("_bucket") + step).alias("_last"),
        )
        .withColumn("_at", F.explode(F.sequence("_bucket", "_last")))
        .select(
            *keys,
            F.col("_at").alias("_bucket"),
            F.when(F.col("_at") == F.col("_bucket"), F.col("_slice")).alias("_slice"),
            F.when(F.col("_at") == F.col("_bucket"), F.col("_before"))
            .otherwise(F.col("_own"))
            .alias("_carry"),
        )
    )
    own_bucket = time_bucket(F.col(left_time), bucket)
    if spans:
        placed = left.withColumn("_bucket", own_bucket)
    else:
        # Left rows beyond the last bucket (before the first, when looking forward) use
        # the one filler bucket there.
        edge_of = F.max if backward else F.min
        edges = slices.groupBy(*keys).agg((edge_of("_bucket") + step).alias("_edge"))
        clamp = F.least if backward else F.greatest
        placed = left.join(edges, keys, "left").withColumn("_bucket", clamp(own_bucket, F.col("_edge")))

    hit_test = {
        (True, False): lambda e: e["t"] <= F.col(left_time),
        (True, True): lambda e: e["t"] < F.col(left_time),
        (False, False): lambda e: e["t"] >= F.col(left_time),
        (False, True): lambda e: e["t"] > F.col(left_time),
    }[(backward, strict)]
    hits = F.filter("_slice", hit_test)
    hit = F.get(hits, F.size(hits) - 1 if backward else F.lit(0))["v"]

    joined = placed.join(filled, [*keys, "_bucket"], "left").withColumn(
        "_hit", F.coalesce(hit, F.col("_carry"))
    )
    return joined.select(
        *[F.col(name) for name in left.columns],
        *[F.col("_hit")[name].alias(prefix + name) for name in values],
    )
