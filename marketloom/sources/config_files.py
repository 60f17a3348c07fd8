"""Vendor configuration tables: pipe-separated text, UTF-8 or GB18030.

All parsing is Catalyst on exploded lines; only byte decoding is a Python step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numbers import finite_or_null, whole_or_null, whole_or_zero
from marketloom.sources.files import decode_text, file_name, split_lines, stripped, text_lines

# Separator of dictionary sections.
_SECTION = "######"


def _market(value: Column) -> Column:
    key = F.lower(F.trim(value))
    return (
        F.when(key.isin("0", "sz"), "sz").when(key.isin("1", "sh"), "sh").when(key.isin("2", "bj"), "bj")
    )


def _fields(line: Column) -> Column:
    return F.transform(F.split(line, r"\|", -1), stripped)


def _field(index: int) -> Column:
    """Field text; '' beyond the end of a short line."""
    return F.coalesce(F.get("raw_fields", F.lit(index)), F.lit(""))


def _records(files: DataFrame) -> DataFrame:
    """Data lines with their fields; blanks and comments are gone."""
    lines = text_lines(files).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    return lines.select(
        F.col("path"),
        "line_no",
        file_name(F.col("path")).alias("source"),
        _fields(F.col("line")).alias("raw_fields"),
    )


def _table(
    files: DataFrame, minimum: int, required: tuple[int, ...], columns: dict[str, Column]
) -> DataFrame:
    """Rows with at least ``minimum`` fields and non-empty ``required`` ones."""
    rows = _records(files).where(F.size("raw_fields") >= minimum)
    for index in required:
        rows = rows.where(_field(index) != "")
    return rows.select(*[c.alias(n) for n, c in columns.items()], "source", "raw_fields", "line_no")


def spblock(files: DataFrame) -> DataFrame:
    """Block members under '#name' headers; a header holds for the lines after it."""
    lines = text_lines(files).where(F.col("line") != "")
    is_header = F.col("line").startswith("#")
    order = (
        Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    header = F.when(is_header, stripped(F.expr("substring(line, 2)")))
    return (
        lines.withColumn("block_name", F.last(header, ignorenulls=True).over(order))
        .where(~is_header & F.col("block_name").isNotNull() & F.col("line").rlike("^[0-9]{7}$"))
        .select(
            "block_name",
            _market(F.substring("line", 1, 1)).alias("market"),
            F.expr("substring(line, 2)").alias("code"),
            F.col("line").alias("raw_code"),
            file_name(F.col("path")).alias("source"),
            "line_no",
        )
    )


def tdxzs(files: DataFrame) -> DataFrame:
    return _table(
        files,
        2,
        (0, 1),
        {
            "name": _field(0),
            "code": _field(1),
            "type": whole_or_zero(_field(2)),
            "sub_type": whole_or_zero(_field(3)),
            "ref": _field(5),
        },
    )


def tdxbk(files: DataFrame) -> DataFrame:
    return _table(files, 3, (1, 2), {"short_name": _field(1), "full_name": _field(2)})


def tdxhy(files: DataFrame) -> DataFrame:
    shenwan = F.when(F.size("raw_fields") >= 6, _field(5)).otherwise(F.element_at("raw_fields", -1))
    return _table(
        files,
        3,
        (0, 1),
        {
            "market": _market(_field(0)),
            "code": _field(1),
            "tdx_industry_code": _field(2),
            "sw_industry_code": shenwan,
        },
    )


def tdxbjmore(files: DataFrame) -> DataFrame:
    return _table(
        files,
        4,
        (1, 3),
        {"market": F.lit("bj"), "code": _field(1), "name": _field(3), "security_type": F.lit("stock")},
    )


def incon(files: DataFrame) -> DataFrame:
    """Industry dictionary: sections named by their first line."""
    clean = F.filter(
        F.transform(
            split_lines(F.col("_section")), lambda line: F.btrim(stripped(line), F.lit("\x00"))
        ),
        lambda line: line != "",
    )
    sections = files.select(
        "path", F.posexplode(F.split(decode_text("content"), _SECTION)).alias("_number", "_section")
    ).select("path", "_number", clean.alias("_lines"))
    named = sections.where(F.size("_lines") >= 2).withColumn(
        "source", stripped(F.regexp_replace(F.get("_lines", F.lit(0)), "^#", ""))
    )
    rows = named.where(F.col("source") != "").select(
        "source",
        "_number",
        F.posexplode(F.slice("_lines", F.lit(2), F.size("_lines"))).alias("_position", "_line"),
    )
    return (
        rows.where(~F.col("_line").startswith("#"))
        .withColumn("raw_fields", _fields(F.col("_line")))
        .where((F.size("raw_fields") >= 2) & (_field(0) != "") & (_field(1) != ""))
        .select(
            "source",
            _field(0).alias("code"),
            _field(1).alias("name"),
            "raw_fields",
            (F.col("_number").cast("bigint") * 10_000_000 + F.col("_position")).alias("line_no"),
        )
    )


def hspy(files: DataFrame, longer_codes: bool = False) -> DataFrame:
    """Name/pinyin records of varying layout: the first six-digit field is the code, its
    neighbours the market, name and pinyin; unmatched lines are kept.  With ``longer_codes``,
    more than six digits are a code too."""
    lines = text_lines(files).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    fields = F.when(F.col("line").contains("|"), _fields(F.col("line"))).otherwise(
        F.split("line", r"(?U)\s+")
    )
    code = "^[0-9]{6,}$" if longer_codes else "^[0-9]{6}$"
    at = F.array_position(F.transform("raw_fields", lambda f: f.rlike(code)), True).cast("int")
    found = F.col("_at") > 0
    return (
        lines.withColumn("raw_fields", fields)
        .withColumn("_at", at)
        .select(
            F.when(found & (F.col("_at") > 1), _market(F.get("raw_fields", F.col("_at") - 2))).alias("market"),
            F.when(found, F.get("raw_fields", F.col("_at") - 1)).alias("code"),
            F.when(found, F.get("raw_fields", F.col("_at"))).alias("name"),
            F.when(found, F.get("raw_fields", F.col("_at") + 1)).alias("pinyin"),
            file_name(F.col("path")).alias("source"),
            "raw_fields",
            "line_no",
        )
    )


def tdxstat(files: DataFrame) -> DataFrame:
    # Field positions.
    numbers = {
        "pe_ttm": 3, "change_pct": 6, "pe_static": 9, "dividend_yield": 10, "change_5d": 28,
        "change_10d": 30, "change_20d": 18, "change_60d": 20, "change_ytd": 21,
    }
    return _table(
        files,
        5,
        (1,),
        {
            "market": _market(_field(0)),
            "code": _field(1),
            "date": _field(4),
            "trend_days": whole_or_null(_field(5)),
            **{name: finite_or_null(_field(index)) for name, index in numbers.items()},
        },
    )


def tdxstat2(files: DataFrame) -> DataFrame:
    """Amounts in yuan; ``raw_fields`` keep the ten-thousands."""
    return _table(
        files,
        14,
        (1,),
        {
            "market": _market(_field(0)),
            "code": _field(1),
            "date": _field(2),
            "block_index": _field(13),
            "amount": finite_or_null(_field(3), 10_000),
            "amount_prev": finite_or_null(_field(5), 10_000),
            "ipo_price": finite_or_null(_field(16)),
            "high_52w": finite_or_null(_field(17)),
            "low_52w": finite_or_null(_field(18)),
        },
    )


def xgsg(files: DataFrame) -> DataFrame:
    return _table(
        files,
        15,
        (1,),
        {
            "market": _market(_field(0)),
            "code": _field(1),
            "date": _field(2),
            "issue_price": finite_or_null(_field(3)),
            "name": _field(14),
        },
    )


Parser = Callable[[DataFrame], DataFrame]
# Table kinds and their default file names.
KINDS: dict[str, Parser] = {
    "spblock.dat": spblock,
    "tdxzs.cfg": tdxzs,
    "tdxzs3.cfg": tdxzs,
    "tdxdszs.cfg": tdxzs,
    "tdxbk.cfg": tdxbk,
    "tdxhy.cfg": tdxhy,
    "tdxbjmore.cfg": tdxbjmore,
    "incon.dat": incon,
    "hspy.dat": hspy,
    "tdxstat.cfg": tdxstat,
    "tdxstat2.cfg": tdxstat2,
    "xgsg.cfg": xgsg,
}


def parse_config(files: DataFrame, kind: str) -> DataFrame:
    """Parse (path, content) rows as one kind, given as file name or bare name."""
    name = kind.strip().lower().rsplit("/", 1)[-1]
    for known, parser in KINDS.items():
        if name in (known, known.rsplit(".", 1)[0]):
            return parser(files)
    raise ValueError(f"unsupported configuration table: {kind!r}")
