"""Mix sources to target weights.

Sizes are summed per source (map-side combine), the target of each source comes from water
filling over the source table, and every document is emitted floor(rate) times plus one
more time with probability frac(rate), drawn by a hash of seed and id: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import maybe_broadcast, stored, unit_hash, words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
#: Sources above which the rates are joined by shuffle instead of broadcast.
BROADCAST_SOURCES = 10_000


def word_count(text_col: str = "text") -> Column:
    return F.size(words(text_col)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` for rows of ``source, size``.

    Sources in code-point order, null last, weigh ``weights``, repeating.  Together they get
    ``share`` times all sizes; none gets over ``most`` times its own, and what that cuts off
    goes to the others by weight until none is above.  The level is found in one step: in
    the order of cap / weight, the first k sources are at their caps, where k is the
    smallest number for which the rest, at the common level, stay below theirs.

    The windows run over one row per source, not over documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = per_source.withColumn("_rank", F.row_number().over(by_name) - 1).withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    )
    by_fill = Window.orderBy("_ratio", "_rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leveled = (
        weighted.withColumn("_cap", most * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", share * F.sum("source_size").over(everything))
        # The common level if all sources before this one are at their caps.
        .withColumn(
            "_level",
            (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after),
        )
        .withColumn("_fits", F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")))
        .withColumn("_final", F.first("_fits", ignorenulls=True).over(everything))
    )
    return leveled.select(
        "source",
        "source_size",
        F.least(F.col("_cap"), F.coalesce(F.col("_final") * F.col("_weight"), F.col("_cap"))).alias("target"),
    )


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED, broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """``_row`` (all columns of ``docs`` as a struct), ``size, source_size, target, copies``,
    one row per row of ``docs``.

    * A null text has size 0; a null source is a source of its own, last in order.
    * A source without words has target 0, and its documents are taken 0 times.
    * Rows that repeat an id get the same number of copies; null ids count as the empty id.
    * An empty table gives an empty result; columns of any name are kept inside ``_row``.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        word_count(text_col).alias("size"),
    )
    rates = maybe_broadcast(
        stored(
            targets(rows.select(F.col("_source").alias("source"), "size"), weights, share, most).withColumnRenamed("source", "_of"),
            "source-targets",
        ),
        broadcast_sources,
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (unit_hash(F.lit(seed), F.col("_id")) < rate - whole).cast("bigint")
    return rows.join(rates, F.col("_source").eqNullSafe(F.col("_of"))).select(
        "_row", "_id", "size", "source_size", "target", (whole + extra).alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken."""
    taken = copies(docs, **options).filter("copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return repeated.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
