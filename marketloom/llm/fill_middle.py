"""Fill-in-the-middle transformation on piece tables.

A document is a row of descriptors (buffer, start, stop) over two immutable buffers: the
UTF-8 text as Arrow delivered it, and the sentinels.  Cutting splits a descriptor in three,
an arrangement permutes the parts among sentinels, the inverse permutation restores their
order, and hashes are streamed over the descriptors; bytes are copied once, for the output.

One pass without a shuffle; each task holds about 2 MB of text at a time, or one text where
that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import whole_text
from marketloom.llm.text_arrays import bytes_of, pieces

#: The sentinel buffer and the letters of its entries, three bytes each.
SENTINELS = np.frombuffer(b"<P><S><M>", dtype=np.uint8)
_LETTERS = (ord("P"), ord("S"), ord("M"))
#: Parts of a piece table: three of the text, then the sentinels.
PREFIX, MIDDLE, SUFFIX, P, S, M = range(6)
#: Order of the parts in the output.
ARRANGEMENTS = {
    "plain": np.array([PREFIX, MIDDLE, SUFFIX]),
    "psm": np.array([P, PREFIX, S, SUFFIX, M, MIDDLE]),
    "spm": np.array([S, SUFFIX, P, PREFIX, M, MIDDLE]),
}
FORMS = np.array(list(ARRANGEMENTS))


def cut(offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Descriptors ``buffer, start, stop`` (rows x 6 parts): each row's text split at two
    byte places, and the sentinels."""
    rows = len(first)
    marks = np.arange(0, 9, 3)
    start = np.column_stack([offsets[:-1], first, second, *np.broadcast_to(marks[:, None], (3, rows))])
    stop = np.column_stack([first, second, offsets[1:], *np.broadcast_to(marks[:, None] + 3, (3, rows))])
    buffer = np.broadcast_to(np.array([0, 0, 0, 1, 1, 1]), (rows, 6))
    return buffer, start, stop


def arrange(table: tuple[np.ndarray, ...], row: int, order: np.ndarray) -> list[tuple[int, int, int]]:
    """The row's descriptors in the given order, without empty ones."""
    chosen = zip(*(part[row, order].tolist() for part in table), strict=True)
    return [(buffer, start, stop) for buffer, start, stop in chosen if stop > start]


def inverse(order: np.ndarray) -> np.ndarray:
    """Places, in an arrangement, of prefix, middle and suffix."""
    return np.argsort(order)[:3]


def stream(descriptors: list[tuple[int, int, int]], buffers: tuple[memoryview, ...]) -> str:
    """SHA-256 of the described bytes, fed one descriptor at a time."""
    digest = hashlib.sha256()
    for buffer, start, stop in descriptors:
        digest.update(buffers[buffer][start:stop])
    return digest.hexdigest()


def sentinels_in(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each sentinel: rows and byte places where it stands whole inside a row."""
    if len(data) < 3:
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 3
    framed = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")))
    row = np.searchsorted(offsets, framed, "right") - 1
    whole = framed + 3 <= offsets[row + 1]
    framed, row = framed[whole], row[whole]
    letter = data[framed + 1]
    return [(row[letter == x], framed[letter == x]) for x in _LETTERS]


def _strings(parts: list[list[tuple[int, int, int]]], buffers: tuple[memoryview, ...]) -> pa.Array:
    """Strings put together from their descriptors."""
    lengths = [sum(stop - start for _, start, stop in row) for row in parts]
    ends = np.cumsum([0, *lengths]).astype(np.int64)
    data = b"".join(buffers[b][start:stop] for row in parts for b, start, stop in row)
    return pa.LargeStringArray.from_buffers(len(parts), pa.py_buffer(ends.tobytes()), pa.py_buffer(data)).cast(pa.string())


def _listed(parts: list[list[tuple[int, int, int]]], offsets: np.ndarray) -> pa.Array:
    """Descriptors as ``array<struct<buffer, start, length>>``, text places within the row."""
    flat = np.array([(b, x - (0 if b else base), y - x) for base, row in zip(offsets.tolist(), parts, strict=False) for b, x, y in row])
    flat = flat.reshape(-1, 3).astype(np.int64)
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    columns = [pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1]), pa.array(flat[:, 2])]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["buffer", "start", "length"]))


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20
) -> DataFrame:
    """One row per document: ``<id>, n, form, prefix_chars, middle_chars, output,
    output_sha256, pieces``.

    The first four groups of eight hex digits of the SHA-256 of ``<seed>:<id>`` place the two
    cuts (in code points) and draw the form: ``plain`` for ``plain_percent`` of documents, and
    for those that are empty or contain a sentinel; ``spm`` for ``spm_percent`` of the others,
    else ``psm``.  ``pieces`` are the descriptors of the output: buffer 0 is the text, 1 the
    sentinels; start and length in bytes.

    * A null text counts as empty; a null id as empty text in the hash.
    * Rows that repeat an id get the same draw, each for its own text.
    * Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    draw = {f"_h{k}": F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)}
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col).cast("string")).alias("_text"))
    rows = rows.withColumn("_digest", digest).withColumns(draw).drop("_digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(4)]
            for first, last, data, offsets in pieces(*bytes_of(batch.column(1))):
                h = [x[first:last] for x in draws]
                # Code points begin at bytes that do not continue one.
                begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                before = np.searchsorted(begins, offsets)
                n = np.diff(before)
                a, b = np.minimum(h[0] % (n + 1), h[1] % (n + 1)), np.maximum(h[0] % (n + 1), h[1] % (n + 1))
                plain = (n == 0) | (h[2] % 100 >= 100 - plain_percent)
                for row, _ in sentinels_in(data, offsets):
                    plain[row] = True
                form = np.where(plain, 0, np.where(h[3] % 100 < spm_percent, 2, 1))
                a, b = np.where(plain, n, a), np.where(plain, n, b)
                table = cut(offsets, begins[before[:-1] + a], begins[before[:-1] + b])
                parts = [arrange(table, k, ARRANGEMENTS[name]) for k, name in enumerate(FORMS[form].tolist())]
                buffers = memoryview(data), memoryview(SENTINELS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first), pa.array(n), pa.array(FORMS[form].tolist(), pa.string()),
                        pa.array(a, mask=plain), pa.array(b - a, mask=plain), _strings(parts, buffers),
                        pa.array([stream(p, buffers) for p in parts], pa.string()), _listed(parts, offsets),
                    ],
                    names,
                )

    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"]
    kind = rows.schema["_id"].dataType.simpleString()
    schema = (
        f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, output_sha256 string, "
        "pieces array<struct<buffer: int, start: bigint, length: bigint>>"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` with ``restored`` and ``restored_sha256`` in place of ``pieces`` and the output:
    the text rebuilt from output and form alone.

    The sentinels of the output cut it into parts, and the inverse of the form's arrangement
    puts them in order.  A null output counts as empty, a null form as plain.  An output
    that lacks a sentinel of its form, or has one twice, is an error.
    """
    kept = [c for c in rows.columns if c not in (output_col, "pieces", "restored", "restored_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [f or "plain" for f in batch.column(1).to_pylist()]
            for first, last, data, offsets in pieces(*bytes_of(batch.column(0))):
                count = last - first
                # Starts and ends of the three sentinels, in the order of _LETTERS.
                places, seen = np.zeros((count, 3), np.int64), np.zeros((count, 3), np.int64)
                for k, (row, at) in enumerate(sentinels_in(data, offsets)):
                    places[row, k] = at
                    seen[:, k] = np.bincount(row, minlength=count)
                parts = []
                for k in range(count):
                    low, high = int(offsets[k]), int(offsets[k + 1])
                    if forms[first + k] == "plain":
                        parts.append([(0, low, high)])
                        continue
                    order = ARRANGEMENTS[forms[first + k]]
                    # In both arrangements every second part is a sentinel, followed by text.
                    at = places[k, order[0::2] - P]
                    if (seen[k] != 1).any() or at[0] != low or (np.diff(at) < 3).any():
                        raise ValueError(f"not an output of form {forms[first + k]}: its sentinels are not in place")
                    starts, stops = at + 3, np.append(at[1:], high)
                    table = (np.zeros((1, 6), np.int64), np.zeros((1, 6), np.int64), np.zeros((1, 6), np.int64))
                    table[1][0, 0::2], table[2][0, 0::2] = at, starts
                    table[1][0, 1::2], table[2][0, 1::2] = starts, stops
                    parts.append(arrange(table, 0, inverse(order)))
                buffers = (memoryview(data),)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(2 + k).slice(first, count) for k in range(len(kept))),
                        _strings(parts, buffers), pa.array([stream(p, buffers) for p in parts], pa.string()),
                    ],
                    [*kept, "restored", "restored_sha256"],
                )

    given = rows.select(
        F.col(f"`{output_col}`").cast("string").alias("_output"), F.col(f"`{form_col}`").cast("string").alias("_form"),
        *[F.col(f"`{c}`") for c in kept],
    )
    schema = T.StructType([
        *[rows.schema[c] for c in kept], T.StructField("restored", T.StringType()), T.StructField("restored_sha256", T.StringType()),
    ])
    return given.mapInArrow(run, schema)
