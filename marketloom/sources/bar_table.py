"""Stored bars with their coverage, as plain Parquet that is only ever added to.

A write puts its rows into a folder of its own, then what it says about them (the last bar
of each series, ranges it covers, a tail it cuts off), and at last one commit row: a single
small file, whose appearance makes all of it visible at once.  A job that dies before that
leaves the table as it was.  Readers resolve a :class:`Snapshot`, the commits they found, so
rows, coverage and last stamps of one snapshot belong together.

The newest row of each key counts, newest by commit, not by clock.  A write costs what it
writes: nothing stored is read for it but the commits.  Two writers cannot lose each other's
rows or coverage, since each adds its own and they are merged on reading.
:meth:`BarTable.compact` folds the commits of a snapshot into one that takes their place;
what is committed meanwhile stays beside it.  :meth:`BarTable.vacuum` deletes folders that
compactions have replaced.

Folders: ``bars/write=<id>/market=/frequency=/adjustment=/period=`` (a month of minute bars,
a year of coarser ones), ``marks/write=<id>`` and ``commits``.

Catalogs with MERGE have transactions of their own; :func:`merge_into` is the same upsert
there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.intervals import merge_ranges
from marketloom.operators.scan import keep_latest
from marketloom.schemas import COVERAGE, STORED_BARS

IDENTITY = ["market", "code", "frequency", "adjustment"]
KEY = [*IDENTITY, "ts"]
_PARTITION = ["market", "frequency", "adjustment", "period"]
_FINE = ["1m", "5m", "15m", "30m", "1h", "ex_1m"]
#: ``kind`` is last (start: time of the last bar), cut (start: tail cut off from there) or
#: range (start, end, provenance).  ``origin`` is the commit of compacted rows, else NULL.
_MARKS = T.StructType([
    *COVERAGE.fields, T.StructField("kind", T.StringType()), T.StructField("origin", T.LongType()), T.StructField("write", T.StringType()),
])
_COMMITS = "write STRING, version BIGINT, live BOOLEAN"
_EXTRA = [T.StructField("origin", T.LongType()), T.StructField("write", T.StringType()), T.StructField("period", T.StringType())]
_ROWS = T.StructType([*STORED_BARS.fields, *_EXTRA])


class Snapshot:
    """The table as of the commits found when it was taken."""

    def __init__(self, spark: SparkSession, path: str, commits: Sequence[Row]) -> None:
        self.spark = spark
        self.path = path
        replaced = {r["write"] for r in commits if not r["live"]}
        #: Commit number of each write that counts.
        self.live = {r["write"]: r["version"] for r in commits if r["live"] and r["write"] not in replaced}
        self.replaced = sorted(replaced)
        self.version = max((r["version"] for r in commits), default=0)

    def _read(self, part: str, schema: T.StructType | str) -> DataFrame:
        """Rows of the live writes, with ``version``, the commit that each belongs to."""
        if not self.live:
            return self.spark.createDataFrame([], schema).withColumn("version", F.lit(0).cast("bigint"))
        base = f"{self.path}/{part}"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/write={w}" for w in sorted(self.live)])
        if len(self.live) == 1:
            return rows.withColumn("version", F.coalesce("origin", F.lit(*self.live.values()).cast("bigint")))
        # One row per live write, which compaction keeps few.
        numbers = self.spark.sql(
            "select explode(from_json(:live, 'map<string, bigint>')) as (write, _version)", args={"live": json.dumps(self.live)}
        )
        return rows.join(numbers, "write").withColumn("version", F.coalesce("origin", "_version")).drop("_version")

    def marks(self, kind: str) -> DataFrame:
        return self._read("marks", _MARKS).where(F.col("kind") == kind)

    # -- bars -------------------------------------------------------------------
    def versions(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """All rows of the periods that reach into [start, end], with their commit."""
        rows = self._read("bars", _ROWS)
        # On the partition column alone, so other periods are never listed for reading.
        size = F.length("period")
        if start is not None:
            rows = rows.where(F.col("period") >= F.lit(str(start)).substr(F.lit(1), size))
        if end is not None:
            rows = rows.where(F.col("period") <= F.lit(str(end)).substr(F.lit(1), size))
        return rows

    def resolved(self, rows: DataFrame, ordered: bool = False) -> DataFrame:
        """The newest row of each key, less what a later commit cut off.  ``ordered`` deals
        rows by ranges of the key, so that sorting the result by it needs no second shuffle."""
        if len(self.live) < 2:  # one write holds each key once
            return rows
        cuts = self.marks("cut")
        per_series = cuts.groupBy(*IDENTITY).agg(F.collect_list(F.struct("version", "start")).alias("_cuts"))
        gone = F.exists("_cuts", lambda c: (c["version"] > F.col("version")) & (F.col("ts") >= c["start"]))
        rows = rows.join(per_series, IDENTITY, "left").where(~F.coalesce(gone, F.lit(False))).drop("_cuts")
        if ordered:
            rows = rows.repartitionByRange(*KEY)
        return keep_latest(rows, KEY, [F.col("version").desc(), F.col("write").desc()])

    def bars(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return self.resolved(self.versions(start, end)).select(*STORED_BARS.names)

    # -- marks ------------------------------------------------------------------
    def last_stamps(self) -> DataFrame:
        """Time of the last stored bar of each series, from what every write noted down."""
        noted = self.marks("last").groupBy(*IDENTITY).agg(F.max("start").alias("last"))
        if len(self.live) < 2:
            return noted
        cut = self.marks("cut").select(*IDENTITY).distinct()
        # Replaced series may have lost their last bar: only those are read.
        changed = self.bars().join(cut, IDENTITY, "left_semi").groupBy(*IDENTITY).agg(F.max("ts").alias("last"))
        return noted.join(cut, IDENTITY, "left_anti").unionByName(changed)

    def coverage(self) -> DataFrame:
        """Covered ranges, merged within equal provenance."""
        columns = COVERAGE.names
        keys = [c for c in columns if c not in ("start", "end")]
        # Ranges of stored series are long: pieces of a year, not of a month.
        return merge_ranges(self.marks("range").select(*columns), keys, "year").select(*columns)


class BarTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    # -- reading ----------------------------------------------------------------
    def snapshot(self) -> Snapshot:
        try:
            commits = self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            commits = []
        return Snapshot(self.spark, self.path, commits)

    def bars(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Stored bars; with bounds, those of the periods that reach into them."""
        return self.snapshot().bars(start, end)

    def last_stamps(self) -> DataFrame:
        return self.snapshot().last_stamps()

    def coverage(self) -> DataFrame:
        return self.snapshot().coverage()

    def read_bars(self, identity: dict[str, str], start: str | None = None, end: str | None = None) -> DataFrame:
        """One series or many, both ends inclusive, in time order.

        Partitions of other identities and periods are never opened.
        """
        now = self.snapshot()
        rows = now.versions(start, end)
        for name, value in identity.items():
            rows = rows.where(F.col(name) == value)
        if start is not None:
            rows = rows.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            rows = rows.where(F.col("ts") <= F.lit(end).cast("timestamp_ntz"))
        return now.resolved(rows, ordered=True).select(*STORED_BARS.names).orderBy(*KEY)

    # -- writing ----------------------------------------------------------------
    def upsert(
        self,
        bars: DataFrame,
        *,
        replace_from: str | None = None,
        coverage: DataFrame | None = None,
        answers: tuple[str, str] | None = None,
        seq: str | None = None,
        timezone: str = "Asia/Shanghai",
    ) -> None:
        """Insert or update bars and mark what they cover, in one commit.

        Without ``replace_from`` a row replaces the stored one of its key (the highest
        ``seq`` among repeats).  With it, the stored tail (``ts`` >= it) of the given
        series is cut off and repeats in the input are an error.  ``answers`` names two
        columns of ``bars`` with the range that each row belongs to; these ranges are
        covered too.  Empty input changes nothing.
        """
        write = uuid.uuid4().hex
        rows = _with_period(_normalize(bars, timezone, [*([seq] if seq else []), *(answers or [])]))
        # Repeats inside one write need an order too: any row, but always the same.
        same = F.xxhash64(*[c for c in STORED_BARS.names if c not in KEY]).desc()
        if seq:
            rows = keep_latest(rows, KEY, [F.col(seq).desc(), same]).drop(seq)
        elif replace_from is None:
            rows = keep_latest(rows, KEY, [same])
        self._write_rows(rows, write)
        # From here on what was written is read, so the input is worked out once.
        covers = list(answers or [])
        stamp = [T.StructField(name, T.TimestampNTZType()) for name in covers]
        written = self.spark.read.schema(T.StructType([*_ROWS.fields, *stamp])).parquet(f"{self.path}/bars/write={write}")
        if replace_from is not None and (repeated := written.groupBy(*KEY).count().where("count > 1").first()):
            raise ValueError(f"repeated bar in replacement: {tuple(repeated)[:-1]}")
        if answers:
            # One pass for both marks; readers take the last bar over the ranges of a series.
            start, end = map(F.col, answers)
            each = written.groupBy(*IDENTITY, start.alias("start"), end.alias("end")).agg(F.max("ts").alias("_last"))
            ends = F.struct(F.lit("last").alias("kind"), F.col("_last").alias("start"), F.lit(None).cast("timestamp_ntz").alias("end"))
            spans = F.struct(F.lit("range").alias("kind"), "start", "end")
            answered = each.select(*IDENTITY, F.explode(F.array(ends, spans)).alias("_mark")).select(*IDENTITY, "_mark.*")
            ranged = F.col("kind") == "range"
            marks = _marks(answered.withColumns({"source": F.when(ranged, ""), "is_approximate": F.when(ranged, False)}))
        else:
            marks = _marks(written.groupBy(*IDENTITY).agg(F.max("ts").alias("start")), "last")
        if replace_from is not None:
            cut = written.select(*IDENTITY).distinct().withColumn("start", F.lit(replace_from).cast("timestamp_ntz"))
            marks = marks.unionByName(_marks(cut, "cut"))
        if coverage is not None:
            marks = marks.unionByName(_marks(coverage, "range"))
        self._write_marks(marks, write)
        if self.spark.read.schema(_MARKS).parquet(f"{self.path}/marks/write={write}").where("kind = 'last'").isEmpty():
            return
        self._commit(write)

    def _write_rows(self, rows: DataFrame, write: str) -> None:
        # AQE sizes the files of each partition (large ones are split, however skewed);
        # sorted inside each file, so code and time filters prune row groups.
        (
            rows.hint("rebalance", *_PARTITION)
            .sortWithinPartitions(*_PARTITION, "code", "ts")
            .write.partitionBy(*_PARTITION)
            .parquet(f"{self.path}/bars/write={write}")
        )

    def _write_marks(self, marks: DataFrame, write: str) -> None:
        marks.write.parquet(f"{self.path}/marks/write={write}")

    def _commit(self, write: str, replaced: Sequence[str] = ()) -> None:
        """Make a write visible: one file, which is there or not.  Numbers are given here and
        not when a write begins, so they follow the order in which readers see commits; of
        two at the same moment the greater id counts as newer."""
        version = self.snapshot().version + 1
        rows = [(write, version, True), *((w, version, False) for w in replaced)]
        self.spark.createDataFrame(rows, _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def compact(self) -> None:
        """Fold the commits of a snapshot into one with a row per key.  Rows keep the number
        of their commit, so what others commit meanwhile is resolved rightly beside it."""
        now = self.snapshot()
        if len(now.live) < 2:
            return
        write = uuid.uuid4().hex
        self._write_rows(now.resolved(now.versions()).withColumn("origin", F.col("version")).drop("version", "write"), write)
        written = self.spark.read.schema(_ROWS).parquet(f"{self.path}/bars/write={write}")
        last = written.groupBy(*IDENTITY).agg(F.max("ts").alias("start"), F.max("origin").alias("origin"))
        # Cuts have taken effect: whatever is committed later is newer than they are.
        self._write_marks(_marks(last, "last").unionByName(_marks(now.coverage(), "range")), write)
        self._commit(write, sorted(now.live))

    def vacuum(self) -> int:
        """Delete the folders of writes that compactions replaced; readers of older
        snapshots must have ended.  Returns how many writes went."""
        replaced = self.snapshot().replaced
        jvm = self.spark._jvm
        gone = 0
        for write in replaced:
            for part in ("bars", "marks"):
                path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}/write={write}")
                gone += path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return gone // 2


def merge_into(bars: DataFrame, table: str, *, replace_from: str | None = None, timezone: str = "Asia/Shanghai") -> None:
    """The upsert as one MERGE statement, for a ``table`` of stored bars in a catalog that has
    it (Spark refuses other tables, which :class:`BarTable` serves).

    Input must hold each key once.  With ``replace_from`` stored bars from there on, of the
    series in the input, that the input does not hold, are deleted by the same statement.
    """
    rows = _normalize(bars, timezone, [])
    if replace_from is not None:
        # Stored tail bars come along as deletions, so that one statement sees both.
        cut = F.lit(replace_from).cast("timestamp_ntz")
        tail = bars.sparkSession.table(table).where(F.col("ts") >= cut).select(*STORED_BARS.names)
        tail = tail.join(rows.select(*IDENTITY).distinct(), IDENTITY, "left_semi").join(rows.select(*KEY), KEY, "left_anti")
        rows = rows.withColumn("_gone", F.lit(False)).unionByName(tail.withColumn("_gone", F.lit(True)))
    else:
        rows = rows.withColumn("_gone", F.lit(False))
    same = [F.col(f"_new.{c}").eqNullSafe(F.col(f"{table}.{c}")) for c in KEY]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    values = {c: F.col(f"_new.{c}") for c in STORED_BARS.names}
    (
        rows.alias("_new").mergeInto(table, condition)
        .whenMatched(F.col("_new._gone")).delete()
        .whenMatched().update(values)
        .whenNotMatched().insert(values)
        .merge()
    )


def _marks(rows: DataFrame, kind: str | None = None) -> DataFrame:
    """Marks of a kind (else of that in the rows), with all columns."""
    fields = [f for f in _MARKS if f.name != "write"]
    given = {f.name: F.lit(kind) if f.name == "kind" and kind else F.col(f.name) if f.name in rows.columns else F.lit(None) for f in fields}
    return rows.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in fields])


def _with_period(bars: DataFrame) -> DataFrame:
    fine = F.col("frequency").isin(_FINE)
    return bars.withColumn("period", F.date_format("ts", "yyyy-MM").substr(F.lit(1), F.when(fine, 7).otherwise(4)))


def _normalize(bars: DataFrame, timezone: str, extra: list[str]) -> DataFrame:
    """All stored columns with their defaults; non-finite numbers are NULL."""
    defaults = {"source": "", "volume_unit": "shares", "is_approximate": False, "adjustment": "none"}
    out: list[Column] = []
    for field in STORED_BARS.fields:
        kind = field.dataType.simpleString()
        if field.name == "timezone":
            column = F.lit(timezone)
        elif field.name not in bars.columns:
            column = F.lit(defaults.get(field.name))
        elif kind == "double":
            value = F.col(field.name).cast("double")
            column = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
        elif field.name in defaults:
            column = F.coalesce(F.col(field.name), F.lit(defaults[field.name]))
        else:
            column = F.col(field.name)
        out.append(column.cast(kind).alias(field.name))
    return bars.select(*out, *extra)
