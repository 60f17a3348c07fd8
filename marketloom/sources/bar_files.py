"""Fixed-record binary bar files.

One row per file goes through a numpy structured view inside ``mapInArrow``, or files are
read in splits (:mod:`marketloom.sources.record_source`); unit rules, dates and validation
are Catalyst expressions afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.symbols import require
from marketloom.functions.times import at_minute, unpack_date
from marketloom.sources.files import file_stem


_STEP = 1 << 16  # records decoded at once


@dataclass(frozen=True)
class RecordLayout:
    """Little-endian fields of one record, after an optional header with a count."""

    fields: tuple[tuple[str, str], ...]
    header: int = 0
    count_at: int | None = None

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(list(self.fields))


DAILY = RecordLayout(
    (("day", "<u4"), ("open", "<u4"), ("high", "<u4"), ("low", "<u4"), ("close", "<u4"),
     ("amount", "<f4"), ("volume", "<u4"), ("reserved", "<u4"))
)
MINUTE_LEGACY = RecordLayout(
    (("day", "<u2"), ("minutes", "<u2"), ("open", "<u4"), ("high", "<u4"), ("low", "<u4"), ("close", "<u4"),
     ("amount", "<f4"), ("volume", "<u4"), ("reserved", "<u4"))
)
MINUTE_LC = RecordLayout(
    (("day", "<u2"), ("minutes", "<u2"), ("open", "<f4"), ("high", "<f4"), ("low", "<f4"), ("close", "<f4"),
     ("amount", "<f4"), ("volume", "<u4"), ("reserved", "<u4"))
)
EXTENDED_DAILY = RecordLayout(
    (("day", "<u4"), ("open", "<f4"), ("high", "<f4"), ("low", "<f4"), ("close", "<f4"),
     ("amount", "<u4"), ("volume", "<u4"), ("settlement", "<f4"))
)
DELISTED = RecordLayout(
    (("day", "<u4"), ("open", "<f4"), ("high", "<f4"), ("low", "<f4"), ("close", "<f4"),
     ("amount", "<f4"), ("volume", "<u4"), ("reserved", "<u4")),
    header=14,
    count_at=10,
)

# Fixed values: (price, volume) coefficients of daily files by security type.
DAILY_COEFFICIENTS = {
    "SH_A_STOCK": (0.01, 0.01),
    "SH_B_STOCK": (0.001, 0.01),
    "SH_STAR_STOCK": (0.01, 0.01),
    "SH_INDEX": (0.01, 1.0),
    "SH_FUND": (0.001, 1.0),
    "SH_BOND": (0.001, 1.0),
    "SZ_A_STOCK": (0.01, 0.01),
    "SZ_B_STOCK": (0.01, 0.01),
    "SZ_INDEX": (0.01, 1.0),
    "SZ_FUND": (0.001, 0.01),
    "SZ_BOND": (0.001, 0.01),
    "BJ_A_STOCK": (0.01, 0.01),
    "BJ_INDEX": (0.01, 1.0),
}


def record_count(layout: RecordLayout, size: int, head: bytes) -> tuple[int, str | None]:
    """Records in a file of ``size`` bytes that begins with ``head`` (the header at least),
    and what is wrong with its length."""
    if size < layout.header:
        return 0, f"file shorter than its header: {size} bytes"
    item = layout.dtype.itemsize
    if layout.count_at is not None:
        count = int.from_bytes(head[layout.count_at : layout.count_at + 4], "little")
        return count, f"{count} records exceed the file size" if layout.header + count * item > size else None
    return size // item, f"length {size} is not a multiple of {item}" if size % item else None


def decode_records(files: DataFrame, layout: RecordLayout, strict: bool = True) -> DataFrame:
    """(path, position, fields...) of every record.

    A file whose length does not fit is an error in strict mode, else one row with its
    ``error`` and NULL fields.  ``files`` that are records already, from
    :func:`marketloom.sources.record_source.scan_records`, are returned.
    """
    if "content" not in files.columns:
        return files
    dtype, header = layout.dtype, layout.header
    names = [name for name, _ in layout.fields]
    spark_type = {"u": "bigint", "f": "double"}
    schema = "path string, position int, error string, " + ", ".join(
        f"{name} {spark_type[dtype[name].kind]}" for name in names
    )
    kinds = {"u": np.dtype("int64"), "f": np.dtype("float64")}
    most = _STEP

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: list[tuple[str, int, np.ndarray]]) -> pa.RecordBatch:
            """Records of several files, or parts of them, as one batch."""
            counts = [len(records) for _, _, records in parts]
            paths = pa.array([path for path, _, _ in parts], pa.string()).take(pa.array(np.repeat(np.arange(len(parts)), counts)))
            position = np.concatenate([np.arange(low, low + n, dtype="int32") for (_, low, _), n in zip(parts, counts)])
            records = np.concatenate([r for _, _, r in parts])
            arrays = [paths, pa.array(position), pa.nulls(len(records), pa.string())]
            # Unsigned and float32 widened; NaN means NULL downstream.
            arrays += [pa.array(records[n].astype(kinds[dtype[n].kind]), from_pandas=True) for n in names]
            return pa.RecordBatch.from_arrays(arrays, ["path", "position", "error", *names])

        held: list[tuple[str, int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                count, error = record_count(layout, data.size, data.slice(0, min(header, data.size)).to_pybytes())
                if error:
                    if strict:
                        raise ValueError(f"{path}: {error}")
                    empty = [pa.nulls(1, pa.from_numpy_dtype(kinds[dtype[n].kind])) for n in names]
                    marks = [pa.array([path], pa.string()), pa.nulls(1, pa.int32()), pa.array([error], pa.string())]
                    yield pa.RecordBatch.from_arrays([*marks, *empty], ["path", "position", "error", *names])
                    continue
                records = np.frombuffer(data, dtype=dtype, count=count, offset=header) if count else np.empty(0, dtype)
                for low in range(0, count, most):
                    part = records[low : low + most]
                    held.append((path, low, part))
                    size += len(part)
                    if size >= most:
                        yield rows(held)
                        held, size = [], 0
            # What is held points into the batch.
            if held:
                yield rows(held)
                held, size = [], 0

    return files.select("path", "content").mapInArrow(decode, schema)


def _packed_day(day: Column) -> Column:
    return F.try_to_date(day.cast("string"), "yyyyMMdd")


def daily_file_type(path: Column) -> Column:
    """Security type by file name; *_OTHER and NULL have no coefficients."""
    stem = F.lower(file_stem(path))
    exchange, head = F.substring(stem, 1, 2), F.substring(stem, 3, 2)
    shenzhen = (
        F.when(head.isin("00", "30"), "SZ_A_STOCK")
        .when(head == "20", "SZ_B_STOCK")
        .when(head == "39", "SZ_INDEX")
        .when(head.isin("15", "16", "18"), "SZ_FUND")
        .when(head.isin("10", "11", "12", "13", "14"), "SZ_BOND")
        .otherwise("SZ_OTHER")
    )
    shanghai = (
        F.when(head == "60", "SH_A_STOCK")
        .when(head == "90", "SH_B_STOCK")
        .when(head == "68", "SH_STAR_STOCK")
        .when(head.isin("00", "88", "99"), "SH_INDEX")
        .when(head.isin("50", "51", "58"), "SH_FUND")
        .when(head.isin("01", "02", *[str(n) for n in range(10, 21)]), "SH_BOND")
        .otherwise("SH_OTHER")
    )
    beijing = F.when(F.substring(stem, 3, 3) == "899", "BJ_INDEX").otherwise("BJ_A_STOCK")
    return F.when(exchange == "sz", shenzhen).when(exchange == "sh", shanghai).when(exchange == "bj", beijing)


def daily_bars(files: DataFrame, strict: bool = True) -> DataFrame:
    """Daily files: prices and volume scaled by security type; a bad date is NULL.

    A file of unknown type is an error in strict mode, else its numbers are NULL.
    """
    records = decode_records(files, DAILY, strict).withColumn("security_type", daily_file_type(F.col("path")))
    known = F.coalesce(F.col("security_type").isin(list(DAILY_COEFFICIENTS)), F.lit(False))
    if strict:
        kind = require(F.col("security_type"), known, "daily file of unknown security type")
        records = records.withColumn("security_type", kind)

    def coefficient(part: int) -> Column:
        choice = F.lit(None).cast("double")
        for unit in sorted({pair[part] for pair in DAILY_COEFFICIENTS.values()}):
            names = [n for n, pair in DAILY_COEFFICIENTS.items() if pair[part] == unit]
            choice = F.when(F.col("security_type").isin(names), unit).otherwise(choice)
        return choice

    return records.select(
        "path",
        "position",
        _packed_day(F.col("day")).alias("date"),
        *[(F.col(n) * coefficient(0)).alias(n) for n in ("open", "high", "low", "close")],
        "amount",
        (F.col("volume") * coefficient(1)).alias("volume"),
        "security_type",
        *([] if strict else ["error"]),
    )


def _minute_bars(records: DataFrame, price_unit: float, strict: bool) -> DataFrame:
    date = unpack_date("day")
    return records.select(
        "path",
        "position",
        at_minute(date, F.col("minutes")).alias("ts"),
        *[(F.col(n) / price_unit).alias(n) for n in ("open", "high", "low", "close")],
        "amount",
        F.col("volume").cast("double").alias("volume"),
        *([] if strict else ["error"]),
    )


def minute_bars_legacy(files: DataFrame, strict: bool = True) -> DataFrame:
    """``.1`` / ``.5`` files: integer prices in hundredths."""
    return _minute_bars(decode_records(files, MINUTE_LEGACY, strict), 100.0, strict)


def minute_bars_lc(files: DataFrame, strict: bool = True) -> DataFrame:
    """``.lc1`` / ``.lc5`` files: float prices as they are."""
    return _minute_bars(decode_records(files, MINUTE_LC, strict), 1.0, strict)


def extended_daily_bars(files: DataFrame, strict: bool = True) -> DataFrame:
    """Extended-market daily files; ``hk_stock_amount`` is the amount's bits as float32.

    The bit pattern is re-read arithmetically (sign, exponent, fraction), inside codegen.
    """
    bits = F.col("amount")
    sign = F.when(F.shiftright(bits, 31) == 1, -1.0).otherwise(1.0)
    exponent = F.shiftright(bits, 23).bitwiseAND(F.lit(255))
    fraction = bits.bitwiseAND(F.lit(8_388_607)).cast("double") / 8_388_608
    value = F.when(exponent == 0, fraction * F.pow(F.lit(2.0), F.lit(-126))).when(
        exponent < 255, (fraction + 1) * F.pow(F.lit(2.0), exponent.cast("double") - 127)
    )
    return decode_records(files, EXTENDED_DAILY, strict).select(
        "path",
        "position",
        _packed_day(F.col("day")).alias("date"),
        "open", "high", "low", "close", "amount", "volume", "settlement",
        (sign * value).alias("hk_stock_amount"),
        *([] if strict else ["error"]),
    )


def delisted_bars(files: DataFrame, strict: bool = True) -> DataFrame:
    """Delisted-security cache: 14-byte header with a count; volume in lots."""
    return decode_records(files, DELISTED, strict).select(
        "path",
        "position",
        _packed_day(F.col("day")).alias("date"),
        "open", "high", "low", "close", "amount",
        (F.col("volume") / 100).alias("volume"),
        *([] if strict else ["error"]),
    )
