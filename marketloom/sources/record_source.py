"""Fixed-record files as a Spark data source that splits them.

``binaryFile`` brings a file as one row, which bounds it by a row's size and reads it in one
task.  Here the files' lengths are listed, ranges of whole records are planned, small files
together and large ones in parts, and each task reads its own byte ranges in steps.  Rows are
those of :func:`marketloom.sources.bar_files.decode_records`.

Only wanted columns are decoded (``columns``), and conditions on the packed ``day`` are
applied to the records before they leave Python.

Paths are whatever ``pyarrow.fs`` opens (mounted folders, HDFS, object stores); for other
stores ``binaryFile`` and ``decode_records`` remain.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from marketloom.sources import bar_files

LAYOUTS = {
    "daily": bar_files.DAILY,
    "minute_legacy": bar_files.MINUTE_LEGACY,
    "minute_lc": bar_files.MINUTE_LC,
    "extended_daily": bar_files.EXTENDED_DAILY,
    "delisted": bar_files.DELISTED,
}
SPLIT_BYTES = 128 << 20
OPEN_COST = 1 << 18  # what opening another file counts as, in bytes
STEP = 1 << 16  # records decoded at once
_TESTS = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; ``file:/x`` as Spark writes it is local."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class Ranges(InputPartition):
    """Parts of files: (path, file size, first record, records)."""

    def __init__(self, parts: list[tuple[str, int, int, int]]) -> None:
        super().__init__(None)
        self.parts = parts


class FixedRecords(DataSource):
    """Options: ``path``, ``layout``, ``splitBytes``, ``strict``, ``columns``, ``suffix``."""

    @classmethod
    def name(cls) -> str:
        return "fixed_records"

    def schema(self) -> T.StructType:
        dtype = LAYOUTS[self.options["layout"]].dtype
        kinds = {"u": T.LongType(), "f": T.DoubleType()}
        fields = [("path", T.StringType()), ("position", T.IntegerType()), ("error", T.StringType())]
        fields += [(n, kinds[dtype[n].kind]) for n in dtype.names]
        wanted = self.options.get("columns")
        names = [n for n, _ in fields] if wanted is None else wanted.split(",")
        return T.StructType([T.StructField(n, dict(fields)[n]) for n in names])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RecordReader(schema, dict(self.options))


class RecordReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.names = schema.names
        self.root = options["path"]
        self.layout = LAYOUTS[options["layout"]]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.strict = options.get("strict", "true").lower() == "true"
        self.suffix = options.get("suffix", "").lower()
        self.tests: list[tuple[type, int]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on ``day`` are applied here, all others by Spark."""
        for condition in filters:
            if type(condition) in _TESTS and condition.attribute == ("day",) and isinstance(condition.value, int):
                self.tests.append((type(condition), condition.value))
            yield condition  # error rows have no day, so Spark looks again

    def partitions(self) -> Sequence[Ranges]:
        store, path = opened(self.root)
        info = store.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(path, recursive=True))
        out: list[Ranges] = []
        parts, size = [], 0
        item = self.layout.dtype.itemsize
        per_split = max(1, self.split // item)
        for file in sorted((f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.path):
            if not file.path.lower().endswith(self.suffix):
                continue
            # With a count in the header this is an upper bound; tasks read the count.
            records = max(0, file.size - self.layout.header) // item
            for first in range(0, max(records, 1), per_split):
                count = min(per_split, records - first)
                cost = count * item + OPEN_COST
                if parts and size + cost > self.split + OPEN_COST:
                    out.append(Ranges(parts))
                    parts, size = [], 0
                parts.append((file.path, file.size, first, count))
                size += cost
        return [*out, Ranges(parts)] if parts or not out else out

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.root)
        shown = "file:" if isinstance(store, pafs.LocalFileSystem) else self.root.split("://")[0] + "://"
        layout, item = self.layout, self.layout.dtype.itemsize
        for path, size, first, count in partition.parts:
            with store.open_input_file(path) as file:
                head = file.read_at(min(layout.header, size), 0) if layout.header else b""
                stated, error = bar_files.record_count(layout, size, head)
                if error:
                    if self.strict:
                        raise ValueError(f"{path}: {error}")
                    if first == 0:
                        yield self._batch(shown + path, np.zeros(1, np.int32), None, error)
                    continue
                count = min(count, stated - first)
                for low in range(first, first + count, STEP):
                    step = min(STEP, first + count - low)
                    records = np.frombuffer(file.read_at(step * item, layout.header + low * item), dtype=layout.dtype)
                    keep = np.ones(len(records), dtype=bool)
                    for kind, value in self.tests:
                        keep &= _TESTS[kind](records["day"].astype(np.int64), value)
                    position = np.arange(low, low + step, dtype=np.int32)
                    yield self._batch(shown + path, position[keep], records[keep], None)

    def _batch(self, path: str, position: np.ndarray, records: np.ndarray | None, error: str | None) -> pa.RecordBatch:
        count = len(position)
        given = {
            "path": pa.array([path] * count, pa.string()),
            "position": pa.array(position if records is not None else [None], pa.int32()),
            "error": pa.array([error] * count, pa.string()),
        }
        for name in self.names:
            if name not in given:
                kind = np.int64 if self.layout.dtype[name].kind == "u" else np.float64
                given[name] = pa.nulls(count, pa.from_numpy_dtype(kind)) if records is None else pa.array(records[name].astype(kind))
        return pa.RecordBatch.from_arrays([given[n] for n in self.names], self.names)


def scan_records(
    spark: SparkSession, path: str, layout: str, *, strict: bool = True, columns: Sequence[str] | None = None,
    split_bytes: int = SPLIT_BYTES, suffix: str = "",
) -> DataFrame:
    """Records of a file or of all files below a folder, read in splits.

    The functions of :mod:`marketloom.sources.bar_files` take the result in place of files.
    """
    # Conditions reach Python readers behind this setting.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FixedRecords)
    reader = spark.read.format("fixed_records").option("layout", layout).option("splitBytes", split_bytes).option("suffix", suffix)
    if columns is not None:
        reader = reader.option("columns", ",".join(columns))
    return reader.option("strict", str(strict).lower()).load(path)
