"""Daily capital flow of closed days, kept so that histories need no ticks of the past.

Rows are those of :func:`marketloom.operators.capital_flow.flow_summary` per security and
day, in Parquet partitioned by month.  Each day is written by one batch and closed by a mark
that names it, so a day whose write died is not closed and its rows do not count; a day that
is written again (a correction, a replayed micro-batch) is replaced by its newest batch.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from marketloom.operators.capital_flow import flow_summary, flow_sums

KEY = ["market", "code", "date"]
_DAYS = "date DATE, batch STRING, number BIGINT"


class FlowTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _days(self) -> DataFrame | None:
        """Closed days with the batch that counts for each."""
        try:
            marks = self.spark.read.schema(_DAYS).parquet(f"{self.path}/days")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return marks.groupBy("date").agg(F.max_by("batch", "number").alias("batch"))

    def closed_until(self) -> dt.date | None:
        """The last closed day; days up to it are complete."""
        days = self._days()
        return None if days is None else days.agg(F.max("date")).first()[0]

    def rows(self, since: Column | None = None) -> DataFrame:
        """Daily flow of all closed days, or of those from a date on, whose months alone are
        opened."""
        rows = self.spark.read.schema(self._schema()).parquet(f"{self.path}/flow")
        if since is not None:
            rows = rows.where((F.col("period") >= F.date_format(since, "yyyy-MM")) & (F.col("date") >= since))
        return rows.join(self._days(), ["date", "batch"], "left_semi").drop("batch", "period")

    def _schema(self) -> T.StructType:
        nothing = self.spark.createDataFrame([], "market TINYINT, code STRING, date DATE, price DOUBLE, vol BIGINT, side INT")
        summary = flow_summary(flow_sums(nothing))
        return T.StructType([*summary.schema.fields, T.StructField("batch", T.StringType()), T.StructField("period", T.StringType())])

    def close_days(self, summary: DataFrame, until: str | dt.date | None = None) -> None:
        """Keep the daily flow in ``summary`` and close its days; with ``until`` all earlier
        ones stay closed and later days in ``summary`` are left out."""
        if until is not None:
            summary = summary.where(F.col("date") <= F.lit(until).cast("date"))
        schema = [f for f in self._schema() if f.name not in ("batch", "period")]
        batch = uuid.uuid4().hex
        (
            summary.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], F.lit(batch).alias("batch"))
            .withColumn("period", F.date_format("date", "yyyy-MM"))
            .hint("rebalance", "period")
            .sortWithinPartitions("period", "date")
            .write.mode("append")
            .partitionBy("period")
            .parquet(f"{self.path}/flow")
        )
        written = self.spark.read.schema(self._schema()).parquet(f"{self.path}/flow").where(F.col("batch") == batch)
        if written.isEmpty():
            return
        number = 0
        if self._days() is not None:
            number = 1 + self.spark.read.schema(_DAYS).parquet(f"{self.path}/days").agg(F.max("number")).first()[0]
        # One small file: all days of the batch close at once.
        written.select("date", "batch").distinct().withColumn("number", F.lit(number).cast("bigint")).coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.path}/days")


def keep_closed_days(daily: DataFrame, table: FlowTable) -> DataStreamWriter:
    """Writer of :func:`marketloom.streaming.ticks.stream_flow` in append mode: a day arrives
    whole, once the watermark has passed it, and is closed then.  A replayed micro-batch
    writes the same days again, and its newest copy counts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.close_days(batch.withColumnRenamed("day", "date"))

    return daily.writeStream.foreachBatch(write)
