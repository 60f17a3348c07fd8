"""Duplicate financial records: identical ones collapse, conflicting ones are reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("code", "report_date")


def duplicate_report(records: DataFrame, key: Sequence[str] = KEY, values: str = "values") -> DataFrame:
    """Per key the number of records and whether they all hold the same values.

    Rows are grouped by key and values first (hash aggregates, so copies combine before the
    shuffle), then variants are counted; NaN equals NaN in Spark's grouping, as it must
    here.  Of conflicting variants the least is shown.
    """
    variants = records.groupBy(*key, values).agg(F.count(F.lit(1)).alias("_n"))
    per_key = variants.groupBy(*key).agg(F.sum("_n").alias("copies"), (F.count(F.lit(1)) > 1).alias("conflict"))
    same = [F.col(f"v.{k}").eqNullSafe(F.col(f"p.{k}")) for k in key]
    joined = variants.alias("v").join(per_key.alias("p"), same)
    one = joined.select(*[f"p.{k}" for k in key], "copies", "conflict", f"v.{values}")
    clear = one.where("not conflict")
    mixed = one.where("conflict").groupBy(*key, "copies", "conflict").agg(F.min(values).alias(values))
    return clear.unionByName(mixed)


def unique_records(
    records: DataFrame, key: Sequence[str] = KEY, values: str = "values", strict: bool = True
) -> DataFrame:
    """One record per key.  Conflicting copies are an error in strict mode; otherwise
    their keys are left out (see :func:`conflicting_keys`)."""
    report = duplicate_report(records, key, values)
    if strict:
        message = F.concat_ws(" ", F.lit("conflicting financial records:"), *[F.col(k).cast("string") for k in key])
        report = report.withColumn(
            "conflict", F.when(F.col("conflict"), F.raise_error(message)).otherwise(F.lit(False))
        )
    return report.where(~F.col("conflict")).select(*key, values, (F.col("copies") - 1).alias("duplicates"))


def conflicting_keys(records: DataFrame, key: Sequence[str] = KEY, values: str = "values") -> DataFrame:
    return duplicate_report(records, key, values).where("conflict").select(*key, "copies")
