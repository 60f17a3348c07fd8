"""Whole files as rows, their identity from the path, and text decoding."""

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.symbols import bare_code, exchange_name, infer_market

# What Python's str.splitlines breaks on, after CR handling.
_LINE_BREAK = r"\r\n?|[\n\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"


def read_files(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """(path, content) of every file; directories are searched to any depth."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths).select("path", "content")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def file_identity(files: DataFrame) -> DataFrame:
    """Add market folder, sub-folder, stem and extension of each path, lower-cased."""
    parts = F.split(F.lower(F.col("path")), "/")
    name = F.lower(file_name(F.col("path")))
    return files.withColumns(
        {
            "market_dir": F.get(parts, F.size(parts) - 3),
            "subdir": F.get(parts, F.size(parts) - 2),
            "stem": F.regexp_extract(name, r"^(.*?)\.([^.]*)$", 1),
            "ext": F.regexp_extract(name, r"^(.*?)\.([^.]*)$", 2),
        }
    )


def locate(files: DataFrame, symbols: DataFrame, subdir: str, suffixes: Sequence[str]) -> DataFrame:
    """The file of each symbol: market/subdir/symbol.ext, case ignored, the first
    suffix that exists.  '#' marks the extended market, 88xxxx is Shanghai; in the
    delisted cache T<code> is an alias.  Symbols without a file have no row."""
    symbol = F.lower(F.trim("symbol"))
    located = file_identity(files)
    ranked = F.array_position(F.array(*[F.lit(s.lstrip(".").lower()) for s in suffixes]), F.col("ext"))
    located = located.withColumn("_rank", ranked).where(F.col("_rank") > 0)
    if subdir == "ds_cache":
        tail = F.regexp_replace(F.element_at(F.split(symbol, "#"), -1), "^(sh|sz|bj)", "")
        alias = F.when(tail.startswith("t"), tail).otherwise(F.concat(F.lit("t"), tail))
        wanted = symbols.withColumn("_want", alias)
        located = located.where(F.col("subdir") == "ds_cache").withColumn(
            "_want", F.element_at(F.split("stem", "#"), -1)
        )
    else:
        extended = symbol.contains("#")
        market = (
            F.when(extended, "ds")
            .when(symbol.startswith("88"), "sh")
            .otherwise(exchange_name(infer_market(symbol)))
        )
        stem = F.when(extended, symbol).otherwise(F.concat(market, F.lower(bare_code(symbol))))
        wanted = symbols.withColumn("_want", F.concat_ws("/", market, stem))
        located = located.where(F.col("subdir") == subdir).withColumn(
            "_want", F.concat_ws("/", "market_dir", "stem")
        )
    best = located.groupBy("_want").agg(F.min_by("path", F.struct("_rank", "path")).alias("path"))
    return wanted.join(best, "_want").drop("_want")


def decode_text(content) -> Column:
    """UTF-8 (a leading mark dropped), else GB18030 with replacement.

    Valid UTF-8 is decoded by Spark itself; only the rest crosses to Python.  The function
    is nested so that workers get it by value and need no package.
    """

    def decode(contents: pd.Series) -> pd.Series:
        def one(data):
            if data is None:
                return None
            try:
                return bytes(data).decode("utf-8-sig")
            except UnicodeDecodeError:
                return bytes(data).decode("gb18030", errors="replace")

        return contents.map(one)

    content = F.col(content) if isinstance(content, str) else content
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    # A CASE alone would still send every value: others are NULL on the way to Python.
    other = F.pandas_udf(decode, "string")(F.when(~valid, content))
    marked = text.startswith("\ufeff")
    return F.when(valid, F.when(marked, F.substring(text, 2, 1 << 30)).otherwise(text)).otherwise(other)


def split_lines(text: Column) -> Column:
    return F.split(text, _LINE_BREAK)


def stripped(text: Column) -> Column:
    """Without surrounding Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def text_lines(files: DataFrame) -> DataFrame:
    """(path, line_no, line) of text files, lines stripped of blanks and NULs."""
    return files.select(
        "path", F.posexplode(split_lines(decode_text("content"))).alias("line_no", "_raw")
    ).select("path", "line_no", F.btrim(stripped(F.col("_raw")), F.lit("\x00")).alias("line"))
