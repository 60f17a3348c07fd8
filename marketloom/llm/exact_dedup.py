"""Exact duplicates by 128-bit content hash, verified byte by byte.

Documents are grouped by the MD5 of their text without white space.  The group summary is
an aggregate with map-side combine, so a group that holds a third of all rows reaches the
shuffle as one row per task.  Only groups of two or more are compared: they are grouped
again by hash *and* normalised text, and a hash with more than one text is a collision,
which is then told apart by its text.  Rows find their group with an equi-join that Spark
splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored, whole_text, without_space


def _best(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key: rows, the longest original, and the smallest id among the longest."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        # Longest first, then the smallest id; a null id comes last.
        F.max(F.struct(F.col("_size"), (-F.col("_id")).alias("_neg"))).alias("_top"),
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Column | None = None) -> DataFrame:
    """One row per document: ``<id>, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after removing white space; of equal texts the
    one with the most code points in the original stays, then the smallest id.

    * Ids are integers, above the least BIGINT; ids of other types fail.
    * A null text counts as empty, and all empty texts form one group.
    * Rows that repeat an id are each counted; all copies of the kept id are ``kept``.
    * A null id is kept only if its whole group has null ids; ``keep_id`` is then null.
    * Other columns of ``docs`` are ignored; an empty table gives an empty result.

    ``content_hash`` replaces the MD5 over the column ``_text`` (tests force collisions).
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.length(whole_text(text_col)).cast("bigint").alias("_size"),
        without_space(text_col).alias("_text"),
    )
    rows = rows.withColumn("_hash", F.md5("_text") if content_hash is None else content_hash)
    best = _best(rows, "_hash")
    repeated = best.filter("_n > 1").select("_hash")

    # Byte comparison inside the groups: one row per task and distinct text is shuffled.
    variants = rows.join(repeated, "_hash", "left_semi").groupBy("_hash", "_text").agg(F.count(F.lit(1)).alias("_n"))
    collided = stored(
        variants.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts")).filter("_texts > 1").select("_hash"),
        "collided-hashes",
    )
    slim = rows.select("_id", "_hash", F.sha2("_text", 256).alias("text_sha256"))
    if collided.isEmpty():
        found = slim.join(best, "_hash")
    else:
        sound = slim.join(best, "_hash").join(collided, "_hash", "left_anti")
        rest = rows.join(collided, "_hash", "left_semi").withColumn("text_sha256", F.sha2("_text", 256))
        found = sound.unionByName(
            rest.select("_id", "_hash", "text_sha256", "_text")
            .join(_best(rest, "_hash", "_text"), ["_hash", "_text"])
            .drop("_text")
        )
    keep = -F.col("_top._neg")
    return found.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Where several rows carry the id that stays and an equal text, the longest original
    stays (then the greatest text); the other cases are as in :func:`groups`.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("bigint").alias("_id"),
        F.sha2(without_space(text_col), 256).alias("_sha"),
        whole_text(text_col).alias("_text"),
    )
    kept = stored(
        groups(docs, id_col, text_col).filter("kept").groupBy("keep_id", "text_sha256").agg(F.count(F.lit(1)).alias("_n")),
        "kept-documents",
    )
    same = (F.col("_id").eqNullSafe(F.col("keep_id"))) & (F.col("_sha") == F.col("text_sha256"))
    out = rows.join(kept.filter("_n = 1"), same, "left_semi").select("_row")
    repeated = kept.filter("_n > 1")
    if not repeated.isEmpty():
        out = out.unionByName(
            rows.join(repeated, same, "left_semi")
            .groupBy("_id", "_sha")
            .agg(F.max_by("_row", F.struct(F.length("_text"), "_text")).alias("_row"))
            .select("_row")
        )
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
