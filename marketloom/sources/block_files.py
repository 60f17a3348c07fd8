"""Sector block files and watch-list folders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.sources.files import decode_text, file_name, file_stem, split_lines

# Block file layout.
_HEAD, _SLOT, _CODE = 384, 2800, 7

_BLOCK_SCHEMA = "path string, blockname string, block_type int, code_index int, code string"


def block_members(files: DataFrame) -> DataFrame:
    """Flat rows of block files, one per (block, code)."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                data = bytes(content)
                blocks = int.from_bytes(data[_HEAD : _HEAD + 2], "little")
                at = _HEAD + 2
                for _ in range(blocks):
                    name = data[at : at + 9].decode("gbk", "ignore").rstrip("\x00")
                    count, kind = np.frombuffer(data, dtype="<u2", count=2, offset=at + 9)
                    first = at + 13
                    codes = np.frombuffer(data[first : first + int(count) * _CODE], dtype=f"S{_CODE}")
                    yield pd.DataFrame(
                        {
                            "path": path,
                            "blockname": name,
                            "block_type": int(kind),
                            "code_index": np.arange(len(codes), dtype="int32"),
                            "code": [c.decode("utf-8", "ignore").rstrip("\x00") for c in codes.tolist()],
                        }
                    )
                    at = first + _SLOT

    return files.select("path", "content").mapInPandas(decode, _BLOCK_SCHEMA)


def watchlist_index(files: DataFrame) -> DataFrame:
    """(blockname, block_type) records of ``blocknew.cfg``: 50 + 70 byte GBK fields."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                data = bytes(content)
                rows = []
                for at in range(0, len(data), 120):
                    fields = (data[at : at + 50], data[at + 50 : at + 120])
                    rows.append([f.decode("gbk", "ignore").split("\x00")[0] for f in fields])
                yield pd.DataFrame(rows, columns=["blockname", "block_type"])

    return files.select("content").mapInPandas(decode, "blockname string, block_type string")


def watchlist_members(files: DataFrame) -> DataFrame:
    """Members of a watch-list folder: index entries joined with their ``.blk`` files.

    Lines are a market digit and a code; blank lines are skipped but keep their index.
    An entry without its file is an error.
    """
    is_index = F.lower(file_name(F.col("path"))) == "blocknew.cfg"
    index = watchlist_index(files.where(is_index))
    lists = files.where(F.lower(file_name(F.col("path"))).endswith(".blk")).select(
        file_stem(F.col("path")).alias("block_type"), decode_text("content").alias("_text")
    )
    joined = index.join(lists, "block_type", "left")
    text = F.when(F.col("_text").isNotNull(), F.col("_text")).otherwise(
        F.raise_error(F.concat(F.lit("watch list file is missing: "), "block_type"))
    )
    return (
        joined.select("blockname", "block_type", F.posexplode(split_lines(text)).alias("code_index", "_line"))
        .where(F.col("_line") != "")
        .select("blockname", "block_type", "code_index", F.expr("substring(_line, 2)").alias("code"))
    )
