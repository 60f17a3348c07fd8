"""Smaller text sources: exported bars, factor payloads, company documents, checksums."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numbers import finite_or_null
from marketloom.functions.symbols import exchange_name
from marketloom.functions.texts import normalize_document
from marketloom.functions.times import parse_date
from marketloom.sources.files import decode_text, file_name, split_lines, stripped

_EXPORT_COLUMNS = ["date", "open", "high", "low", "close", "volume", "amount"]


def exported_bars(files: DataFrame) -> DataFrame:
    """Vendor text exports: three header lines, one footer line, seven comma columns.

    A file that is not of that shape gives no rows.
    """
    lines = F.filter(F.transform(split_lines(decode_text("content")), stripped), lambda x: x != "")
    body = F.slice("_lines", F.lit(4), F.greatest(F.size("_lines") - 4, F.lit(0)))
    rows = files.select("path", lines.alias("_lines")).select(
        "path", F.posexplode(body).alias("position", "_line")
    )
    fields = F.split("_line", ",")
    return rows.where(F.size(fields) >= 7).select(
        "path",
        "position",
        parse_date(F.translate(stripped(F.get(fields, F.lit(0))), "/", "-")).alias("date"),
        *[finite_or_null(F.get(fields, F.lit(i))).alias(n) for i, n in enumerate(_EXPORT_COLUMNS) if i],
    )


def adjustment_payloads(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """(date, factor) rows of 'name={json};' texts, with the payload's other columns.

    A malformed or empty payload is an error in strict mode, else gives no rows.
    """
    body = F.regexp_extract(F.trim("text"), r"(?s)^[^=]*=(.+?);*\s*$", 1)
    parsed = F.from_json(body, "data array<struct<d:string, f:string>>")
    rows = F.coalesce(parsed["data"], F.array().cast("array<struct<d:string,f:string>>"))
    if strict:
        rows = F.when(F.size(rows) > 0, rows).otherwise(F.raise_error(F.lit("no factors in payload")))
    others = [n for n in payloads.columns if n != "text"]
    return payloads.select(*others, F.explode(rows).alias("_row")).select(
        *others, parse_date("_row.d").alias("date"), finite_or_null("_row.f").alias("factor")
    )


def company_documents(
    catalogue: DataFrame, contents: DataFrame, section: str | None = None
) -> DataFrame:
    """Catalogue entries (market, code, position, section, filename, start, length) with
    their normalized content, in catalogue order.  A section must match exactly after
    trimming.  Content is joined on (market, code, filename, start)."""
    wanted = catalogue
    if section is not None and section.strip():
        wanted = wanted.where(F.col("section") == section.strip())
    exchange = exchange_name("market")
    return (
        wanted.join(contents, ["market", "code", "filename", "start"], "left")
        .select(
            F.concat(exchange, "code").alias("full_code"),
            exchange.alias("exchange"),
            F.col("market").alias("market_id"),
            "code",
            "position",
            "section",
            "filename",
            "start",
            "length",
            normalize_document("content").alias("content"),
        )
        .orderBy("market_id", "code", "position")
    )


def verify_files(files: DataFrame, manifest: DataFrame, strict: bool = True) -> DataFrame:
    """Compare files with a manifest (filename, filesize, hash).

    Names are compared in composed, case-folded form.  Identical manifest repeats
    collapse; conflicting ones are an error (or status 'conflict').  Status is ok,
    missing, size, md5, conflict or unlisted.
    """
    entries = (
        manifest.withColumn("_key", _name_key("filename"))
        .groupBy("_key")
        .agg(
            F.min("filename").alias("filename"),
            F.max("filesize").alias("filesize"),
            F.lower(F.max("hash")).alias("hash"),
            F.count_distinct("filename", "filesize", F.lower("hash")).alias("_variants"),
        )
    )
    conflict = F.col("_variants") > 1
    if strict:
        conflict = F.when(
            conflict, F.raise_error(F.concat(F.lit("conflicting manifest entries: "), "filename"))
        ).otherwise(False)
    found = files.select(
        _name_key(file_name(F.col("path"))).alias("_key"),
        "path",
        F.length("content").alias("_size"),
        F.md5("content").alias("_md5"),
    )
    joined = entries.withColumn("_conflict", conflict).join(found, "_key", "full")
    status = (
        F.when(F.col("filename").isNull(), "unlisted")
        .when(F.col("_conflict"), "conflict")
        .when(F.col("path").isNull(), "missing")
        .when(F.col("_size") != F.col("filesize"), "size")
        .when(F.col("_md5") != F.col("hash"), "md5")
        .otherwise("ok")
    )
    return joined.select(F.coalesce("filename", file_name(F.col("path"))).alias("filename"), "path", status.alias("status"))


def _name_key(names) -> Column:
    """Composed (NFC), case-folded file name."""

    def fold(values: pd.Series) -> pd.Series:
        import unicodedata

        return values.map(lambda n: None if n is None else unicodedata.normalize("NFC", n).casefold())

    return F.pandas_udf(fold, "string")(names)
