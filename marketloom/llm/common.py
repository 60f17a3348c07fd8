"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: str | Column) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.array_remove(F.split(whole_text(text), SPACE), "")


def without_space(text: str | Column) -> Column:
    return F.regexp_replace(whole_text(text), SPACE, "")


def unit_hash(*parts: Column) -> Column:
    """Evenly spread number in [0, 1) from the parts' text: 52 bits of an MD5, the same
    in every engine and every run.  Null parts count as empty text."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.  Only where the
    setting is absent (tests, notebooks on one machine) is a temporary one made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return folder


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it again: cuts lineage, and
    lost executors cost nothing that was stored."""
    spark = frame.sparkSession
    path = os.path.join(checkpoint_folder(spark), f"{name}-{uuid.uuid4().hex}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small(frame: DataFrame, most_rows: int) -> bool:
    """Whether a (stored) frame has at most so many rows."""
    return frame.limit(most_rows + 1).count() <= most_rows


def maybe_broadcast(frame: DataFrame, most_rows: int) -> DataFrame:
    """Mark a stored frame for broadcast if it has at most ``most_rows`` rows; beyond that
    it stays an ordinary join side, which Spark splits where it is skewed."""
    return F.broadcast(frame) if small(frame, most_rows) else frame
