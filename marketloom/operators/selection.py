"""Selecting securities and rows: pages, request order, completeness, directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.symbols import SECURITY_CLASSES, classify_security, strip_exchange
from marketloom.operators.merge import stack
from marketloom.operators.scan import add_ordinal, rows_between
from marketloom.operators.asof import time_bucket

SERIES = ("market", "code")


#: Rows up to which Spark's window group limit cuts every mapper's share of a series.
GROUP_LIMIT = 1000


def newest_page(
    bars: DataFrame, start: int, size: int, keys: Sequence[str] = SERIES, ts: str = "ts", chunk: str = "month"
) -> DataFrame:
    """Rows ``start`` .. ``start + size`` counted back from the newest, per series.

    Near pages are a rank filter, which becomes a window group limit: each mapper ships at
    most start + size rows of a series.  Beyond that limit, months are counted first and only
    those that reach into the page are ordered.
    """
    if start < 0 or size <= 0:
        raise ValueError("start must not be negative and size must be positive")
    newest = F.col(ts).desc()
    if start + size > GROUP_LIMIT:
        page = rows_between(bars, keys, [newest], time_bucket(F.col(ts), chunk), start, start + size, newest_first=True)
        return page.orderBy(*keys, ts)
    age = F.row_number().over(Window.partitionBy(*keys).orderBy(newest))
    return (
        bars.withColumn("_age", age)
        .where((F.col("_age") > start) & (F.col("_age") <= start + size))
        .drop("_age")
        .orderBy(*keys, ts)
    )


def last_rows(frame: DataFrame, n: int, keys: Sequence[str] = SERIES, ts: str = "ts") -> DataFrame:
    """The newest ``n`` rows of each series."""
    return newest_page(frame, 0, n, keys, ts)


def chronological(frame: DataFrame, keys: Sequence[str] = SERIES, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Stable time order: ties keep their input order."""
    return frame.orderBy(*keys, ts, seq)


def directory_page(directory: DataFrame, start: int, size: int = 1000, prefix: int = 3) -> DataFrame:
    """A page of the directory in (market, code) order.

    Securities are counted by market and the first ``prefix`` characters of their code, and
    only those groups that reach into the page are ordered: a deep page costs what a near one
    does.
    """
    chunk = F.struct("market", F.substring("code", 1, prefix).alias("head"))
    page = rows_between(directory, [], [F.col("market"), F.col("code")], chunk, start, start + size)
    return page.orderBy("market", "code")


def in_request_order(frame: DataFrame, requested: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Rows of each requested key, in request order, repeats kept."""
    return requested.select("pos", *keys).join(frame, list(keys)).orderBy("pos")


def completeness(requested: DataFrame, returned: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per distinct key of either side: requested position, copies, and whether
    it is ok, missing or unexpected."""
    keys = list(keys)
    wanted = requested.groupBy(*keys).agg(
        F.min("pos").alias("pos"), (F.count(F.lit(1)) - 1).alias("duplicates_removed")
    )
    got = returned.select(*keys).distinct().withColumn("_got", F.lit(True))
    return wanted.join(got, keys, "full").select(
        *keys,
        "pos",
        F.coalesce("duplicates_removed", F.lit(0)).alias("duplicates_removed"),
        F.when(F.col("pos").isNull(), "unexpected")
        .when(F.col("_got").isNull(), "missing")
        .otherwise("ok")
        .alias("state"),
    )


def completeness_status(detail: DataFrame) -> DataFrame:
    """Overall counts of :func:`completeness` and ok / missing / empty_input."""
    counts = detail.agg(
        F.count_if(F.col("state") != "unexpected").alias("requested"),
        F.count_if(F.col("state") == "missing").alias("missing"),
        F.count_if(F.col("state") == "unexpected").alias("unexpected"),
        F.coalesce(F.sum("duplicates_removed"), F.lit(0)).alias("duplicates_removed"),
    )
    return counts.withColumn(
        "status",
        F.when(F.col("requested") == 0, "empty_input").when(F.col("missing") > 0, "missing").otherwise("ok"),
    )


def first_response(rows: DataFrame, keys: Sequence[str] = SERIES, seq: str = "seq") -> DataFrame:
    """Keep the first row that answered for each key."""
    rest = [n for n in rows.columns if n not in keys]
    return (
        rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_row")).select(*keys, "_row.*")
    )


def filter_directory(directory: DataFrame, security_class: str | None = None) -> DataFrame:
    """Rows of one class; the directory order is not touched."""
    if security_class is None:
        return directory
    wanted = security_class.strip().lower()
    if wanted not in SECURITY_CLASSES:
        raise ValueError(f"unsupported security class: {security_class!r}")
    return directory.where(classify_security("market", "code", "name") == wanted)


def stock_count(directory: DataFrame, market: int, security_class: str | None = None) -> DataFrame:
    if market not in (0, 1, 2):
        raise ValueError(f"unsupported market: {market!r}")
    return filter_directory(directory, security_class).where(F.col("market") == market).agg(
        F.count(F.lit(1)).alias("count")
    )


def all_securities(*markets: DataFrame, security_class: str | None = None) -> DataFrame:
    """Directories of several markets, in the given order."""
    return filter_directory(stack(markets, "market_no"), security_class)


def union_blocks(**sources: DataFrame) -> DataFrame:
    """Block tables stacked, each tagged with its name."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in sources.items()]
    return stack(tagged).drop("_priority")


def by_bare_codes(table: DataFrame, codes: DataFrame | Sequence[str]) -> DataFrame:
    """Rows whose code is requested, whatever exchange prefix the request uses."""
    if isinstance(codes, DataFrame):
        wanted = codes.select(strip_exchange(codes.columns[0]).alias("code")).distinct()
        return table.join(wanted, "code", "left_semi")
    return table.where(F.col("code").isin([_strip(code) for code in codes]))


def _strip(code: str) -> str:
    text = str(code).strip().lower()
    return text[2:] if text.startswith(("sh", "sz", "bj")) else text


def window_days(frame: DataFrame, k: int, keys: Sequence[str] = SERIES, ts: str = "date") -> DataFrame:
    """How many rows a k-row window holds at each row (``window_days``)."""
    numbered = add_ordinal(frame, keys, [ts], time_bucket(F.col(ts), "month"), "_position")
    return numbered.withColumn("window_days", F.least(F.col("_position") + 1, F.lit(k))).drop("_position")
