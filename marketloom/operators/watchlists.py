"""Watch lists as a membership table (name, market, code)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["name", "market", "code"]


def create(lists: DataFrame, new: DataFrame) -> DataFrame:
    """Add new lists.  A name that already exists is an error."""
    existing = lists.select("name").distinct().withColumn("_taken", F.lit(True))
    checked = (
        new.select(*KEY)
        .distinct()
        .join(existing, "name", "left")
        .withColumn(
            "name",
            F.when(F.col("_taken").isNull(), F.col("name")).otherwise(
                F.raise_error(F.concat(F.lit("watch list exists: "), F.col("name")))
            ),
        )
    )
    return lists.select(*KEY).unionByName(checked.select(*KEY))


def update(lists: DataFrame, changes: DataFrame, overflow: bool = False) -> DataFrame:
    """Add members to lists, making absent ones; with ``overflow`` the given members
    replace the old ones of those lists."""
    current = lists.select(*KEY)
    if overflow:
        current = current.join(changes.select("name").distinct(), "name", "left_anti").select(*KEY)
    return current.unionByName(changes.select(*KEY)).distinct()


def remove(lists: DataFrame, names: DataFrame) -> DataFrame:
    return lists.join(names.select("name").distinct(), "name", "left_anti").select(*KEY)


def search(lists: DataFrame, name: str) -> DataFrame:
    return lists.where(F.col("name") == name).select("market", "code").distinct()
