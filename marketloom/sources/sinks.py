"""Sinks: delimited and JSON exports, JSON-safe records."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FORMATS = ("csv", "json", "parquet")
_ZONE_OFFSET = "+08:00"


def export(frame: DataFrame, path: str, fmt: str = "csv", by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write a table; ``by`` makes one folder per value (a bundle by security).

    Rows of a folder are brought together first, so a bundle does not turn into
    tasks x securities small files; a large folder is split over several tasks.  A text
    bundle is written by its tasks through ``pyarrow.fs``, where that knows the path.
    """
    if fmt not in _FORMATS:
        raise ValueError(f"unsupported export format: {fmt!r}")
    if by and fmt != "parquet" and mode in ("errorifexists", "error", "append") and (known := _arrow_path(frame, path)):
        _export_text(frame, known, fmt, by, mode)
        return
    if by:
        frame = frame.hint("rebalance", *by)
    writer = frame.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)


def _arrow_path(frame: DataFrame, path: str) -> str | None:
    """The path with its file system, as Spark resolves it; None where ``pyarrow.fs`` lacks it."""
    from marketloom.sources.record_source import opened

    spark = frame.sparkSession
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()
    try:
        opened(whole)
    except (pa.ArrowException, OSError):
        return None
    return whole


_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder_name(text: str) -> str:
    """A column's name or value in a path, as Spark escapes it."""
    return re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", text)


def _export_text(frame: DataFrame, path: str, fmt: str, by: Sequence[str], mode: str) -> None:
    """A bundle of text, written by the tasks that hold the rows.

    Spark's own writer costs a local file system two processes per file and two per folder
    (permissions of the file, its checksum and the folders) and one rename per folder on the
    driver.  Here a file gets its name when it is whole, a retried task replaces the files of
    the one before it, and ``_SUCCESS`` follows when all are there.
    """
    from marketloom.sources.record_source import opened

    # Spark checks the mode and the columns, and makes the folder.
    empty = frame.limit(0).write.mode(mode).partitionBy(*by).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    empty.format(fmt).save(path)
    given = [F.col(f"`{f.name}`") for f in frame.schema.fields if f.name not in by]
    head = b""
    if fmt == "csv":
        line = F.to_csv(F.struct(*given))
        titles = F.to_csv(F.struct(*[F.lit(f.name).alias(f.name) for f in frame.schema.fields if f.name not in by]))
        head = (frame.sparkSession.range(1).select(titles).first()[0] + "\n").encode()
    else:
        line = F.to_json(F.struct(*given), {"ignoreNullFields": "false"})
    names = [f"_by{i}" for i in range(len(by))]
    values = [F.coalesce(F.nullif(F.col(f"`{b}`").cast("string"), F.lit("")), F.lit(_NO_VALUE)).alias(n) for b, n in zip(by, names)]
    lines = frame.select(*values, line.alias("_line")).hint("rebalance", *names).sortWithinPartitions(*names)
    folders = [_folder_name(b) for b in by]
    export_id = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{export_id}.{fmt}"
        store, base = opened(path)
        held = out = None

        def finish():
            out.close()
            store.move(f"{held}/_{task.taskAttemptId()}-{name}", f"{held}/{name}")

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i) for i in range(len(by))]
            changed = np.zeros(batch.num_rows - 1, dtype=bool)
            for key in keys:
                changed |= pc.not_equal(key.slice(1), key.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
            for low, high in zip(starts, starts[1:]):
                folder = "/".join([base, *(f"{f}={_folder_name(k[low].as_py())}" for f, k in zip(folders, keys))])
                if folder != held:
                    if out is not None:
                        finish()
                    held = folder
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(f"{folder}/_{task.taskAttemptId()}-{name}")
                    out.write(head)
                out.write("".join(f"{text}\n" for text in batch.column(len(by)).slice(low, high - low).to_pylist()).encode())
        if out is not None:
            finish()
        return iter(())

    lines.mapInArrow(write, "done boolean").write.format("noop").mode("overwrite").save()
    store, base = opened(path)
    store.open_output_stream(f"{base}/_SUCCESS").close()


def write_files(files: DataFrame, folder: str) -> int:
    """Write (path, content) rows as files below ``folder``, from the tasks that hold them;
    a retried task writes the same bytes again.  Returns how many were written."""
    from marketloom.sources.record_source import opened

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(folder)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                target = f"{base}/{path.lstrip('/')}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(target) as out:
                    out.write(bytes(content))
            yield pd.DataFrame({"files": [len(batch)]})

    written = files.select("path", "content").mapInPandas(write, "files bigint").agg(F.coalesce(F.sum("files"), F.lit(0)))
    return written.first()[0]


def _iso(value: Column, zone: Column) -> Column:
    """ISO-8601 with microseconds only where there are any."""
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")), zone)


def json_safe(value: Column, kind: T.DataType) -> Column:
    """NULL for NaN and infinities, ISO times with their zone, base64 bytes, at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    if isinstance(kind, T.TimestampNTZType):
        return _iso(value, F.lit(_ZONE_OFFSET))
    if isinstance(kind, T.TimestampType):
        return _iso(value, F.date_format(value, "xxx"))
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: json_safe(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: json_safe(x, kind.valueType))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[json_safe(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    return value


def to_records(frame: DataFrame) -> DataFrame:
    """One JSON object per row in column ``record``; NULL fields are kept."""
    fields = [json_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in frame.schema.fields]
    return frame.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))
